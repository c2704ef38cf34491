"""Prefix trie of conversations, its subtree totals by time-forward processing.

Every distinct sequence of first turns is a node, known by a hash chained over its
turns. What a node's members tell comes from one aggregation. Totals of whole
subtrees pass from children to parents by time-forward processing: the nodes of a
shard are sorted externally in reverse level order (Spark's sort) and read once; a
finished node is sent to its parent's place in that order through a priority queue
that spills, and a parent takes its children from the front of the queue when its turn
comes. No node waits in memory for another.

A shard is a set of whole subtrees. Nodes with more than a ``1 / SHARES`` part of all
conversations below them are large; a subtree hangs from a large node and holds none,
so it is small whatever turns or conversations are common. Fewer than SHARES nodes of
a level are large. These few, with the sums of what hangs from each, are the last
shard, across the roots of the others.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.shared import stored

FAMILY = 5
MOST_SHARED = 9
SHARES = 1024
# Entries of a queue in memory, and of a spilled run that are read back at a time.
QUEUE = 100_000
CHUNK = 1_000
RUNS = 64
ROOT = bytes(16)


def _prefix(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=16).digest()


def _shared_turns(conv_id: int) -> int:
    """Fixed rule: how many first turns a conversation takes over."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for low in range(0, batch.num_rows, 8192):
            yield from zip(*[c.to_pylist() for c in batch.slice(low, 8192).columns], strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 8192:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)],
                schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)],
            schema=schema)


PATHS = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()),
                   ("bytes", pa.int64()), ("conv_id", pa.int64()), ("last", pa.bool_())])
PATHS_SQL = "node binary, parent binary, depth long, bytes long, conv_id long, last boolean"


def _paths_of(turns: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes on the path of every rebuilt conversation, from turns sorted by family,
    conversation and turn. Holds the first turns of one conversation and one node."""
    family = conv = None
    base: list[tuple[bytes, int]] = []
    own = shared = depth = 0
    node, open_row = ROOT, None

    def step(turn: bytes, size: int):
        nonlocal node, depth, open_row
        row, parent = open_row, node
        node, depth = _prefix(parent, turn), depth + 1
        open_row = (node, parent, depth, size, conv)
        return (*row, False)

    for its_family, its_conv, turn, size in turns:
        if its_family != family:
            family, base = its_family, []
        if its_conv != conv:
            if open_row:
                yield (*open_row, True)
            conv, own, shared = its_conv, 0, _shared_turns(its_conv)
            node, depth, open_row = ROOT, 0, (ROOT, None, 0, 0, conv)
            if conv != family:
                for first in base[:shared]:
                    yield step(*first)
        if conv == family and own < MOST_SHARED - 1:
            base.append((turn, size))
        if conv == family or own >= shared:
            yield step(turn, size)
        own += 1
    if open_row:
        yield (*open_row, True)


def paths(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """node, parent, depth, bytes, conv_id, last: a row per rebuilt conversation and
    number of its first turns, from none on.

    The turns are shuffled as hashes and sorted within a family of conversations; a
    task reads them in order with a few in memory, however long a conversation is.
    """
    role_text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    mark = F.unhex(F.md5(F.concat(
        F.octet_length(role_text[0]).cast("string"), F.lit(":"), *role_text).cast("binary")))
    c = F.col(conv_id).cast("long")
    turns = conversations.filter(c.isNotNull()).select(
        (c - F.pmod(c, F.lit(FAMILY))).alias("family"), c.alias("conv_id"),
        F.col(turn).alias("turn"), mark.alias("mark"),
        F.octet_length(role_text[1]).cast("long").alias("bytes"))
    ordered = turns.repartition("family").sortWithinPartitions(
        "family", "conv_id", F.col("turn").asc_nulls_first(), "mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_paths_of(_rows(batches)), PATHS)

    return ordered.select("family", "conv_id", "mark", "bytes").mapInArrow(run, PATHS_SQL)


def _ends_of(rows: Iterator[tuple]) -> Iterator[tuple]:
    """node and the hash of its ids, from rows sorted by both; holds one hash."""
    node, digest = None, None
    for its_node, conv in rows:
        if its_node != node:
            if node is not None:
                yield node, digest.hexdigest()
            node, digest = its_node, hashlib.sha256(str(conv).encode())
        else:
            digest.update(b",%d" % conv)
    if node is not None:
        yield node, digest.hexdigest()


def _ends(rows: DataFrame) -> DataFrame:
    """node, ends_sha256 of the nodes where conversations end."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_ends_of(_rows(batches)), schema)

    return (rows.filter("last").select("node", "conv_id").repartition("node")
            .sortWithinPartitions("node", "conv_id").mapInArrow(run, "node binary, ends_sha256 string"))


class SpillingQueue:
    """Priority queue of (key, entry) that keeps ``limit`` entries in memory.

    Beyond, the entries are written as a sorted run to a file that belongs to the task
    alone, like a run of Spark's own sort: with a lost executor the task starts anew.
    """

    def __init__(self, limit: int = QUEUE, chunk: int = CHUNK):
        self.limit, self.chunk = limit, chunk
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (first key, number, entries left in memory, file)
        self.number = 0

    def _run(self, entries: Iterable[tuple]) -> None:
        file = tempfile.TemporaryFile()
        held = []
        for entry in entries:
            held.append(entry)
            if len(held) == self.chunk:
                pickle.dump(held, file)
                held = []
        if held:
            pickle.dump(held, file)
        file.seek(0)
        self._more([], file)

    def _more(self, held: list, file) -> None:
        """Put a run back with its next entries, or close it."""
        if not held:
            try:
                held = pickle.load(file)[::-1]
            except EOFError:
                file.close()
                return
        self.number += 1
        heapq.heappush(self.runs, (held[-1][0], self.number, held, file))

    def _drain(self) -> Iterator[tuple]:
        while self.runs:
            _, _, held, file = heapq.heappop(self.runs)
            yield held.pop()
            self._more(held, file)

    def push(self, key, entry: tuple) -> None:
        self.number += 1
        heapq.heappush(self.heap, (key, self.number, entry))
        if len(self.heap) > self.limit:
            if len(self.runs) >= RUNS:
                self._run(self._drain())
            self._run((k, e) for k, _, e in sorted(self.heap))
            self.heap = []

    def pop(self, key) -> Iterator[tuple]:
        """Take all entries of a key that no entry left is below."""
        while self.heap and self.heap[0][0] == key:
            yield heapq.heappop(self.heap)[2]
        while self.runs and self.runs[0][0] == key:
            _, _, held, file = heapq.heappop(self.runs)
            entry = held.pop()[1]
            self._more(held, file)
            yield entry

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)


TOTALS = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()),
                    ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                    ("parent_conv_id", pa.int64())])
TOTALS_SQL = ("node binary, parent binary, depth long, conv_id long, n_convs long, "
              "n_children long, n_leaves long, saved_tokens long, parent_conv_id long")


def _totals_of(nodes: Iterator[tuple], limit: int = QUEUE) -> Iterator[tuple]:
    """Nodes (node, parent, depth, conv_id, n_convs, own, is_top, children, leaves, saved)
    in reverse level order, by hash within a level, with the totals of their subtrees.

    ``own`` is what the node itself saves, the last three are sums over children of
    other shards. A node leaves when its parent comes; one with ``is_top`` at once.
    """
    queue = SpillingQueue(limit)
    for node, parent, depth, conv, n_convs, own, is_top, children, leaves, saved in nodes:
        saved += own
        for child in queue.pop((-depth, node)):
            children += 1
            leaves += child[6]
            saved += child[7]
            yield (*child, conv)
        done = (node, parent, depth, conv, n_convs, children, leaves if children else 1, saved)
        if is_top:
            yield (*done, None)
        else:
            queue.push((1 - depth, parent), done)
    if queue:
        raise ValueError("a node's parent is not in its shard")


def _totals(nodes: DataFrame) -> DataFrame:
    """Totals of nodes that lie in partitions of whole subtrees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_totals_of(_rows(batches)), TOTALS)

    columns = ["node", "parent", "depth", "conv_id", "n_convs", "own", "is_top", "children",
               "leaves", "saved"]
    return (nodes.sortWithinPartitions(F.desc("depth"), "node").select(*columns)
            .mapInArrow(run, TOTALS_SQL))


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text", shares: int = SHARES) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 of every node.

    Turns are ordered by ``turn``, null first, rows of equal turns by the hash of their
    role and text, repeated rows all count. A null role or text is empty. Rows without
    a conversation id belong to none and are left out. The conversation that others
    take turns from is the multiple of five at or below their id. Other columns are
    left out, whatever their names. An empty table has no nodes.
    """
    steps = stored(paths(conversations, conv_id, turn, role, text), "paths")
    nodes = stored(steps.groupBy("node", "parent", "depth", "bytes").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")), "nodes")
    every = nodes.filter("depth = 0").select("n_convs").scalar()
    large = stored(nodes.filter(
        (F.col("depth") == 0) | (F.col("n_convs") * shares > every)).select("node"), "large")
    zero = F.lit(0).cast("long")
    nodes = nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("bytes"))
    # a small node hangs below the first small node on the path of its least member
    tops = (steps.join(large, "node", "left_anti").groupBy("conv_id")
            .agg(F.min(F.struct("depth", "node")).alias("top")))
    small = (nodes.join(large, "node", "left_anti").join(tops, "conv_id")
             .withColumn("is_top", F.col("node") == F.col("top.node"))
             .withColumn("children", zero).withColumn("leaves", zero).withColumn("saved", zero))
    below = stored(_totals(small.repartition("top.node")), "subtrees")
    hung = below.filter(F.col("parent_conv_id").isNull()).groupBy("parent").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved")).withColumnRenamed("parent", "node")
    # fewer than ``shares`` nodes of a level, whatever the input
    above = (nodes.join(large, "node", "left_semi").join(hung, "node", "left")
             .fillna(0, ["children", "leaves", "saved"])
             .withColumn("is_top", F.col("depth") == 0))
    above = stored(_totals(above.repartition(1)), "large-totals")
    parents = above.select(F.col("node").alias("parent"), F.col("conv_id").alias("above_id"))
    joined = below.join(parents, "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above_id")).drop("above_id")
    all_nodes = joined.unionByName(above)
    none = hashlib.sha256(b"").hexdigest()
    return all_nodes.join(_ends(steps), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
