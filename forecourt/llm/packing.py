"""Mixture-controlled packing: deficit round robin over the queues of the sources.

Every round gives each source's queue its quantum, a share of the window: its
whole tokens are served, the fraction stays as the deficit of the next round. After n rounds
the queue of a source has given floor(n * quantum) tokens, so the deficit at any
round follows from its number, and partitions go on where others stop without
waiting for them. Rounds follow each other in one stream that is cut every
``window`` tokens: every sequence but the last is full and holds each source at
its target share, to within as many tokens as there are sources.

A queue is the documents of a source in the order of the written token table:
block by block, a block being one partition of the pass that made the tokens.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forecourt.llm.shared import few_rows, stored

WINDOW = 2048
END = 1
MOST_SOURCES = 100_000
# Fraction bits of a quantum; positions stay exact below 10**14 tokens.
BITS = 16


def _byte_names() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable
    Latin-1 for itself, the others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}


# Fixed value: how the vocabulary's tokenizer splits a text before it merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TextTokens:
    """Ids of texts by a byte-level vocabulary file, as little-endian 32-bit bytes."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        spec = json.loads(vocabulary)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        names = _byte_names()
        ranks = {bytes(names[c] for c in word): i for word, i in spec["model"]["vocab"].items()
                 if word not in self.special}
        self.encode = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encode(text)
        return np.array(ids, dtype="<u4").tobytes()


TOKENS = "block int, at long, doc_id {id}, source string, start_in_block long, tokens long, ids binary"


def _tokenized(vocabulary: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, closing = TextTokens(vocabulary), np.array([end], dtype="<u4").tobytes()
        block, at, given = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids = [(tokens.ids(t) if t else b"") + closing
                       for t in part.column("text").to_pylist()]
                sizes, starts = [len(i) // 4 for i in ids], []
                for source, n in zip(part.column("source").to_pylist(), sizes, strict=True):
                    starts.append(given.get(source, 0))
                    given[source] = starts[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(ids), pa.int32()),
                     pa.array(range(at, at + len(ids)), pa.int64()), part.column("doc_id"),
                     part.column("source"), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    ["block", "at", "doc_id", "source", "start_in_block", "tokens", "ids"])
                at += len(ids)

    return run


def token_table(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id",
                source: str = "source", end: int = END) -> DataFrame:
    """Ids of every document, written once, with its place in its source's queue of the block."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.col(source).cast("string").alias("source"))
    return stored(rows.mapInArrow(_tokenized(vocabulary, end), TOKENS.format(id=kind)), "tokens")


# Cells of a table of rounds by sources, and tokens, that are cut at a time.
CELLS = 1 << 18
CHUNK = 1 << 18


class Rounds:
    """Where the rounds of each queue lie in the stream of all rounds."""

    def __init__(self, sizes: list[int], quanta: list[int]):
        self.sizes = np.array(sizes, dtype=np.int64)
        self.quanta = np.array(quanta, dtype=np.int64)

    def given(self, n: np.ndarray, queue: int) -> np.ndarray:
        """Tokens that a queue has given before round n."""
        return np.minimum(self.sizes[queue], (n * self.quanta[queue]) >> BITS)

    def begins(self, n: np.ndarray, queue: int) -> np.ndarray:
        """Places in the stream at which a queue's part of round n begins.

        All queues' tokens before the round, and those of the earlier queues in it; the
        table of rounds by sources is made in parts of ``CELLS``, however many there are.
        """
        out = np.empty(len(n), dtype=np.int64)
        step = max(1, CELLS // max(1, len(self.sizes)))
        for low in range(0, len(n), step):
            some = n[low:low + step, None]
            here = np.minimum(self.sizes, (some * self.quanta) >> BITS)
            place = here[:, queue:].sum(axis=1)
            if queue:
                some = some + 1
                place += np.minimum(self.sizes[:queue],
                                    (some * self.quanta[:queue]) >> BITS).sum(axis=1)
            out[low:low + step] = place
        return out

    def cut(self, queue: int, start: int, tokens: int, window: int):
        """Cut tokens [start, start + tokens) of a queue at rounds and windows: where in
        the queue each part starts, and its place in the stream."""
        quantum = int(self.quanta[queue])
        # the round of token i is the last n with floor(n * quantum) <= i
        if quantum >> BITS:
            n = np.arange(((start + 1 << BITS) - 1) // quantum,
                          ((start + tokens << BITS) - 1) // quantum + 1, dtype=np.int64)
        else:  # a round gives a token at most
            n = ((np.arange(start + 1, start + tokens + 1, dtype=np.int64) << BITS) - 1) // quantum
        before = self.given(n, queue)
        begin = np.maximum(before, start)
        end = np.minimum(self.given(n + 1, queue), start + tokens)
        place = self.begins(n, queue) + begin - before
        # cut where a window ends; a queue's share of a round may lie in two
        parts = (place + (end - begin) - 1) // window - place // window + 1
        which = np.repeat(np.arange(len(n)), parts)
        step = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        low = np.maximum(place[which], (place[which] // window + step) * window)
        return begin[which] + low - place[which], low

    def pieces(self, queue: int, starts: np.ndarray, ends: np.ndarray, window: int):
        """Pieces of documents that follow each other in a queue: which one, from where on
        in the queue, how many tokens, at which place."""
        found = []
        for low in range(int(starts[0]), int(ends[-1]), CHUNK):
            high = min(low + CHUNK, int(ends[-1]))
            begin, place = self.cut(queue, low, high - low, window)
            inside = starts[np.searchsorted(starts, low):np.searchsorted(starts, high)]
            at = np.union1d(begin, inside)
            part = np.searchsorted(begin, at, side="right") - 1
            found.append((np.searchsorted(starts, at, side="right") - 1, at,
                          np.diff(at, append=high), place[part] + at - begin[part]))
        return [np.concatenate(c) for c in zip(*found, strict=True)]


def _cut(names: list, sizes: list[int], quanta: list[int], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds, number = Rounds(sizes, quanta), {s: i for i, s in enumerate(names)}
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                start = part.column("start").to_numpy(zero_copy_only=False)
                tokens = part.column("tokens").to_numpy(zero_copy_only=False)
                texts = [memoryview(i.as_buffer()) for i in part.column("ids")]
                # runs of a source's documents that follow each other in its queue
                queue = np.array([number[s] for s in part.column("source").to_pylist()])
                order = np.lexsort((start, queue))
                apart = (np.diff(queue[order]) != 0) | (
                    (start + tokens)[order][:-1] != start[order][1:])
                found = []
                for run_ in np.split(order, np.flatnonzero(apart) + 1):
                    which, *rest = rounds.pieces(int(queue[run_[0]]), start[run_],
                                                 (start + tokens)[run_], window)
                    found.append((run_[which], *rest))
                rows, at, length, place = (np.concatenate(c) for c in zip(*found, strict=True))
                at = at - start[rows]
                crcs = [zlib.crc32(texts[r][4 * a:4 * (a + k)])
                        for r, a, k in zip(rows.tolist(), at.tolist(), length.tolist(),
                                           strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows)), pa.array(at), pa.array(length),
                     pa.array(crcs, pa.int64()), pa.array(tokens[rows]),
                     pa.array(place // window), pa.array(place % window)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                     "offset"])

    return run


def pack(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id",
         source: str = "source", window: int = WINDOW, end: int = END,
         shares: Mapping[str | None, float] | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``vocabulary`` is the content of a byte-level vocabulary file. ``shares`` are
    the target shares of the sources in every window; without them each source has
    its share of all tokens, so that all queues end together. A queue that ends
    early leaves its place to the others. Null and empty texts are the ``end`` id
    alone; a null source is a queue of its own; null ids and repeated rows are
    documents like others. The result's order of documents follows the partitions
    of the pass that made the tokens. An empty table gives no pieces. The sources'
    totals come to the driver; more than ``MOST_SOURCES`` sources are an error.
    """
    tokens = token_table(docs, vocabulary, text, doc_id, source, end)
    by_block = tokens.groupBy("block", "source").agg(F.sum("tokens").alias("here"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    # written, so that its size is known and the ids need not move to meet a small table
    offsets = stored(by_block.select(
        F.col("block").alias("o_block"), F.col("source").alias("o_source"),
        F.coalesce(F.sum("here").over(before), F.lit(0)).alias("ahead")), "offsets")
    totals = few_rows(tokens.groupBy("source").agg(F.sum("tokens").alias("size"))
                      .orderBy(F.asc_nulls_last("source")), MOST_SOURCES, "sources")
    names, sizes = [r["source"] for r in totals], [r["size"] for r in totals]
    goal = [shares[s] if shares else n for s, n in zip(names, sizes, strict=True)]
    whole = sum(goal) or 1
    quanta = [max(1, -(-int(window * g * (1 << BITS)) // whole)) if shares is None
              else max(1, round(window * g / whole * (1 << BITS))) for g in goal]
    kind = docs.schema[doc_id].dataType.simpleString()
    placed = (tokens.join(offsets, (F.col("block") == F.col("o_block"))
                          & F.col("source").eqNullSafe(F.col("o_source")))
              .select("doc_id", "source", "tokens", "ids",
                      (F.col("ahead") + F.col("start_in_block")).alias("start")))
    return placed.mapInArrow(
        _cut(names, sizes, quanta, window),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long")
