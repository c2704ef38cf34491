"""Near duplicates by bottom-k sketches of one hash function.

1. Each text becomes its set of word shingles, hashed to 64 bits. Equal sets are
   one class, told by a 128-bit digest, so exact copies are never compared.
2. A class keeps the ``k`` least hashes, its sketch. Every retained value has an
   inverted list of the classes that hold it. Classes whose sets are similar
   enough share at least ``needed`` sketch values, so they also meet in one of
   the lists of their rarest ``size - needed + 1`` values: only those are kept,
   and values that very many texts share rarely are among them.
3. The members of a list are compared with its pivot, the member with the most
   widely held sketch, not with each other. Those that link are connected, which
   is what is asked for.
4. Two members that were compared with the same pivot, one of which does not link
   with it, can only link if they differ from the pivot in some of the same
   shingles. (With x of size n_x differing in d_x shingles and r = (100 - percent) /
   (100 + percent), a link means d_x + d_y - 2 * common <= r * (n_x + n_y); y not
   linking means d_y > r * (n_y + n_p); and d_x >= |n_x - n_p|; so common > 0.) They
   meet in inverted lists of their differences, which are short where texts are
   near, again of the rarest ones that have to hold a common one.
5. A list is open if its members lie in different components and some were not compared
   with its pivot, being too unlike it. Its members of similar size get a further pivot,
   one of those, and all of them are compared with it on the full sets, a row per
   member. Those mostly within the pivot go through step 4 again. Of the others, what
   they have beyond the pivot tells: with e_y such extras, a link means that they share
   at least e_y - r * (n_x + n_y) of them, so they meet in inverted lists of the rarest
   r * (n_x + n_y) + 1 ones. No pairs of a list are made, however long it is.
6. Of each pair the sketch of the union estimates the similarity, and what can
   reach the bound is confirmed on the full sets.

A sketch of a set of up to ``k`` shingles is the set itself and step 2 is exact.
For larger sets ``needed`` lies six standard deviations below the expected number,
so a link is missed with a probability of about 1e-9. No list, group or number
of partners is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.components import stars
from forecourt.llm.shared import stored

SHINGLE = 5
PERCENT = 80
K = 64
FILTER_BITS = 1 << 23
MOST_FILTER_BITS = 1 << 28
ROOM = 16
# Fixed value: the bits of one of Spark's bitmaps
BITMAP = 1 << 15

# Odd multipliers of the shingle hash.
_POWER = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; words are lower-cased in A-Z."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    length = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - length + 1, length, np.uint64)
        for i in range(length):
            total = total * np.uint64(_POWER) + hashes[i:len(hashes) - length + 1 + i]
        for shift, factor in zip((30, 27), _MIX, strict=True):
            total = (total ^ (total >> np.uint64(shift))) * np.uint64(factor)
        total ^= total >> np.uint64(31)
    return np.unique(total.view(np.int64))


def _digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _sketches(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                sets = [shingle_set(t, size) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("mark"),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([s[:k] for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "mark", "n", "digest", "sketch"])

    return run


def filter_size(pairs: int) -> int:
    """Bits of the array that tells the texts of so many pairs: ``ROOM`` a text, 32 MB at most."""
    wanted = 1 << (2 * ROOM * max(pairs, 1) - 1).bit_length()
    return max(FILTER_BITS, min(MOST_FILTER_BITS, wanted))


def _bit(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:6], "big") % bits


def _marks(digests: DataFrame, bits: int) -> bytes:
    """A bit array with the bits of all digests set, put together from Spark's bitmaps."""
    bit = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long") % bits
    blocks = (digests.select(F.floor(bit / BITMAP).alias("block"), (bit % BITMAP).alias("at"))
              .repartition("block").groupBy("block")
              .agg(F.bitmap_construct_agg("at").alias("marks")).toArrow())
    marks = bytearray(-(-bits // BITMAP) * BITMAP // 8)
    for block, part in zip(blocks["block"].to_pylist(), blocks["marks"].to_pylist(), strict=True):
        marks[block * BITMAP // 8:(block + 1) * BITMAP // 8] = part
    return bytes(marks)


def _wanted_sets(size: int, bits: int, marks: bytes):
    """Sets of the texts whose digest may be wanted, each digest once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                digests, sets = [], []
                for text in batch.slice(low, 256).column("text").to_pylist():
                    members = shingle_set(text, size)
                    if not len(members):
                        continue
                    digest = _digest(members)
                    bit = _bit(digest, bits)
                    if marks[bit >> 3] >> (bit & 7) & 1 and digest not in done:
                        if len(done) >= 100_000:
                            done.clear()  # bounded; a repeat is dropped later
                        done.add(digest)
                        digests.append(digest)
                        sets.append(members)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                    ["digest", "members"])

    return run


def needed(n: Column, k: int, percent: int) -> Column:
    """Sketch values that a similar class shares at least with a class of n shingles."""
    # up to this size a similar set is no larger than k, and both sketches are whole sets
    whole = k * percent // 100
    # below the mean of a binomial by six standard deviations
    share = percent / 100
    least = max(1, int(k * share - 6 * (k * share * (1 - share)) ** 0.5))
    return F.when(n <= whole, F.ceil(n * percent / 100)).otherwise(least).cast("int")


def similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


class _Search:
    """The tables of one search; each is written once and read by the steps after it."""

    def __init__(self, docs: DataFrame, size: int, percent: int, k: int, bits: int | None):
        self.docs, self.size, self.percent, self.k, self.bits = docs, size, percent, k, bits
        kind = docs.schema["doc_id"].dataType.simpleString()
        self.rows = stored(docs.mapInArrow(
            _sketches(size, k),
            f"doc_id {kind}, mark binary, n long, digest binary, sketch array<long>"), "sketches")
        # copies are combined before they move
        self.classes = stored(
            self.rows.where("n > 0").groupBy("digest")
            .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                 F.first("sketch").alias("sketch"))
            .withColumn("cls", F.monotonically_increasing_id()), "classes")
        self.lists = stored(self._lists(), "lists")

    def _lists(self) -> DataFrame:
        """(value, cls, n, p, n_p): inverted lists of each class's rarest values, with pivots."""
        entries = self.classes.select("cls", "n", F.explode("sketch").alias("value"))
        common = (entries.groupBy("value").agg(F.count("*").alias("held")).where("held > 1")
                  .withColumnRenamed("value", "common"))
        size = F.least("n", F.lit(self.k))
        alone = size - F.size("values")  # values no other class holds are the rarest
        keep = size - needed(F.col("n"), self.k, self.percent) + 1 - alone
        rare = F.slice(F.sort_array("values"), F.lit(1),
                       F.greatest(keep, F.lit(0)).cast("int"))
        weight = F.aggregate("values", F.lit(0).cast("long"), lambda s, x: s + x["held"])
        lists = stored(
            entries.join(common, F.col("value") == F.col("common"))
            .groupBy("cls", "n").agg(F.collect_list(F.struct("held", "value")).alias("values"))
            .select("cls", "n", weight.alias("weight"), F.explode(rare).alias("entry"))
            .select(F.col("entry.value").alias("value"), "cls", "n", "weight"), "entries")
        pivots = (lists.groupBy("value")
                  .agg(F.max(F.struct("weight", "cls", "n")).alias("top"), F.count("*").alias("c"))
                  .where("c > 1").select(F.col("value").alias("v"), F.col("top.cls").alias("p"),
                                         F.col("top.n").alias("n_p")))
        return (lists.join(pivots, F.col("value") == F.col("v"))
                .select("value", "cls", "n", "p", "n_p"))

    def with_pivot(self) -> DataFrame:
        """Pairs (a: pivot, b) of each list's pivot with its members."""
        near = similar_sizes(F.col("n"), F.col("n_p"), self.percent)
        return (self.lists.where((F.col("cls") != F.col("p")) & near)
                .select(F.col("p").alias("a"), F.col("cls").alias("b")).distinct())

    def by_difference(self, near: DataFrame) -> DataFrame:
        """Links between classes that were compared with the same pivot, where one does not link.

        ``near``: a (the pivot), b, n_a, n_b, delta, linked.
        """
        up, down = 100 + self.percent, 100 - self.percent
        d = F.col("d")
        members = near.withColumn("d", F.size("delta").cast("long")).withColumns({
            # how many of the differences the other one has at least, if it does not link
            "short": d - F.expr(f"(d * {up} - (n_b - n_a) * {down}) DIV {2 * up}"),
            # ... and if it may link, but this one does not
            "long": d - F.expr(f"(d * {up} - (n_b + n_a) * {down}) DIV {2 * up}")})
        entries = members.select("a", "b", F.explode("delta").alias("e"))
        common = (entries.groupBy("a", "e").agg(F.count("*").alias("held")).where("held > 1")
                  .select(F.col("a").alias("ca"), F.col("e").alias("ce"), "held"))
        ranked = (entries.join(common, (F.col("a") == F.col("ca")) & (F.col("e") == F.col("ce")))
                  .groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("held", "e")))
                                         .alias("values")))
        placed = (ranked.join(members.drop("delta"), ["a", "b"])
                  .select("*", (d - F.size("values")).alias("alone"),
                          F.posexplode("values").alias("at", "entry"))
                  .withColumn("rank", F.col("alone") + F.col("at")))
        index = placed.where("rank < short").select(
            F.col("a").alias("xa"), F.col("entry.e").alias("xe"), F.col("b").alias("x"),
            F.col("d").alias("dx"), F.col("n_b").alias("nx"), F.col("linked").alias("lx"),
            (F.col("d") - F.col("rank")).alias("left_x"))
        probe = placed.where("not linked and rank < long").select(
            "a", F.col("entry.e").alias("e"), F.col("b").alias("y"), "d", "n_b",
            (F.col("rank") < F.col("short")).alias("is_short"), (d - F.col("rank")).alias("left"))
        # from their first common difference on, both still need to hold enough
        enough = ((F.col("dx") + F.col("d") - 2 * F.least("left", "left_x")) * up
                  <= (F.col("nx") + F.col("n_b")) * down)
        pairs = probe.join(
            index, (F.col("a") == F.col("xa")) & (F.col("e") == F.col("xe"))
            & (F.col("x") != F.col("y"))
            & (F.col("lx") | (F.col("is_short") & (F.col("x") < F.col("y"))))
            & enough
        ).select("a", "x", "y").distinct()
        return self.confirmed(pairs, near)

    def open_pairs(self, near: DataFrame, hung: DataFrame) -> DataFrame:
        """Pairs (a: a further pivot, b, n_a, n_b, fresh) for the members of open lists, by
        size: two classes of sizes a list, so that members of similar size share one."""
        known = hung.select(F.col("a").alias("k"), F.col("b").alias("r"))
        done = near.select(F.col("a").alias("da"), F.col("b").alias("db"))
        placed = (self.lists.join(known, F.col("cls") == F.col("k"), "left")
                  .withColumn("root", F.coalesce("r", "cls")))
        placed = (placed.join(done, (F.col("p") == F.col("da")) & (F.col("cls") == F.col("db")),
                              "left")
                  .withColumn("fresh", F.col("db").isNull() & (F.col("cls") != F.col("p"))))
        size = F.floor(F.log("n") / F.log(F.lit(100 / self.percent)))
        sized = stored(placed.select(
            "value", "cls", "n", "root", "fresh",
            F.explode(F.array(size, size + 1)).alias("size")), "sized")
        open_ = (sized.groupBy("value", "size").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"),
            F.max(F.when(F.col("fresh"), F.struct("n", "cls"))).alias("top"))
            .where("lo < hi AND top IS NOT NULL")
            .select(F.col("value").alias("v"), F.col("size").alias("s"),
                    F.col("top.cls").alias("a"), F.col("top.n").alias("n_a")))
        return (sized.join(open_, (F.col("value") == F.col("v")) & (F.col("size") == F.col("s")))
                .where("cls <> a").groupBy("a", F.col("cls").alias("b"))
                .agg(F.first("n_a").alias("n_a"), F.first("n").alias("n_b"),
                     F.max("fresh").alias("fresh")))

    def beyond(self, extras: Column, n: Column) -> Column:
        """Whether a set of n has so much beyond the pivot that links share some of it."""
        # r * (n_x + n_y) is at most this, as the sizes of linked sets are similar
        return (extras * (100 + self.percent) * self.percent
                > n * (100 - self.percent) * (100 + self.percent))

    def by_extras(self, met: DataFrame) -> DataFrame:
        """Links of the members that have much beyond their pivot (``far``) and are new to
        it (``fresh``) with other members. ``met``: a, b, n_b, delta, extras, fresh, far."""
        up, down = 100 + self.percent, 100 - self.percent
        e = F.col("extras")
        own = F.slice("delta", F.size("delta") - e + 1, e)
        entries = met.where("extras > 0").select("a", "b", F.explode(own).alias("e"))
        common = (entries.groupBy("a", "e").agg(F.count("*").alias("held")).where("held > 1")
                  .select(F.col("a").alias("ca"), F.col("e").alias("ce"), "held"))
        ranked = (entries.join(common, (F.col("a") == F.col("ca")) & (F.col("e") == F.col("ce")))
                  .groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("held", "e")))
                                         .alias("values")))
        # r * (n_x + n_y) <= n * down * (100 + percent) / (up * percent)
        most = F.expr(f"n_b * {down * (100 + self.percent)} DIV {up * self.percent}") + 1
        placed = (ranked.join(met.drop("delta"), ["a", "b"])
                  .select("*", (e - F.size("values")).alias("alone"),
                          F.posexplode("values").alias("at", "entry"))
                  .withColumn("rank", F.col("alone") + F.col("at")).where(F.col("rank") < most)
                  .withColumn("left", e - F.col("rank")).withColumn("asks", F.expr("far AND fresh")))
        index = placed.select(
            F.col("a").alias("xa"), F.col("entry.e").alias("xe"), F.col("b").alias("x"),
            F.col("extras").alias("ex"), F.col("n_b").alias("nx"), F.col("left").alias("left_x"),
            F.col("asks").alias("asks_x"))
        probe = placed.where("asks").select("a", F.col("entry.e").alias("e"),
                                            F.col("b").alias("y"), "extras", "n_b", "left")
        # from their first common extra on, both still need to hold enough
        enough = ((F.col("ex") + e - 2 * F.least("left", "left_x")) * up
                  <= (F.col("nx") + F.col("n_b")) * down)
        pairs = probe.join(
            index, (F.col("a") == F.col("xa")) & (F.col("e") == F.col("xe"))
            & (F.col("x") != F.col("y")) & (~F.col("asks_x") | (F.col("x") < F.col("y"))) & enough
        ).select("a", "x", "y").distinct()
        return self.confirmed(pairs, met)

    def confirmed(self, pairs: DataFrame, met: DataFrame) -> DataFrame:
        """Of pairs (a: their pivot, x, y) those that link by what they differ in from it."""
        up, down = 100 + self.percent, 100 - self.percent
        sides = [met.select(F.col("a").alias(f"{c}a"), F.col("b").alias(f"{c}b"),
                            F.col("n_b").alias(f"n{c}"), F.col("delta").alias(f"delta{c}"))
                 for c in "xy"]
        for c, side in zip("xy", sides, strict=True):
            pairs = pairs.join(side, (F.col("a") == F.col(f"{c}a")) & (F.col(c) == F.col(f"{c}b")))
        apart = (F.size("deltax") + F.size("deltay")
                 - 2 * F.size(F.array_intersect("deltax", "deltay")))
        return (pairs.where(apart * up <= (F.col("nx") + F.col("ny")) * down)
                .select(F.col("x").alias("a"), F.col("y").alias("b")))

    def likely(self, pairs: DataFrame, wide: int = 1) -> DataFrame:
        """Pairs that the sketch of their union does not rule out; ``wide`` lowers the bar.

        Members of a list are compared with its pivot at half the bar: what they differ
        in spares comparing those that don't link with all the others.
        """
        def side(name: str, c: str) -> DataFrame:
            return self.classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{name}"),
                                       F.col("sketch").alias(f"s_{name}"))
        both = pairs.join(side("b", "cb"), F.col("b") == F.col("cb")).join(
            side("a", "ca"), F.col("a") == F.col("ca"))
        union = F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, self.k)
        met = F.array_intersect("s_a", "s_b")
        # of the least k values of the union, those in both sketches
        both = (both.select("a", "b", "n_a", "n_b", union.alias("u"), met.alias("met"))
                .withColumn("hits", F.size(F.array_intersect("met", "u"))))
        least = F.least(needed(F.col("n_a"), self.k, self.percent),
                        needed(F.col("n_b"), self.k, self.percent))
        return both.where(F.col("hits") * wide >= least).select("a", "b", "n_a", "n_b")

    def compared(self, pairs: DataFrame) -> DataFrame:
        """Pairs with ``delta``, where their full sets differ, ``extras``, how many of the
        last ones of these b alone has, and ``linked``; other columns stay."""
        taken = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        wanted = self.classes.join(taken, "cls", "left_semi").select("cls", "digest")
        # a bit array says which texts are needed; hits are joined exactly. Pairs are a
        # written table, so they are counted from its footers
        bits = self.bits or filter_size(pairs.count())
        marks = _marks(wanted.select("digest"), bits)
        sets = (self.docs.select("text").mapInArrow(
            _wanted_sets(self.size, bits, marks), "digest binary, members array<long>")
            .groupBy("digest").agg(F.first("members").alias("members")))
        sets = stored(sets.join(wanted, "digest").select("cls", "members"), "sets")
        of_b = sets.select(F.col("cls").alias("cb"), F.col("members").alias("m_b"))
        of_a = sets.select(F.col("cls").alias("ca"), F.col("members").alias("m_a"))
        others = [c for c in pairs.columns if c not in ("a", "b", "n_a", "n_b")]
        # with d = size of delta: union (n_a + n_b + d) / 2, intersection (n_a + n_b - d) / 2
        linked = (F.size("delta") * (100 + self.percent)
                  <= (F.col("n_a") + F.col("n_b")) * (100 - self.percent))
        return (pairs.join(of_b, F.col("b") == F.col("cb")).join(of_a, F.col("a") == F.col("ca"))
                .select("a", "b", "n_a", "n_b", *others, F.array_except("m_a", "m_b").alias("less"),
                        F.array_except("m_b", "m_a").alias("more"))
                .select("a", "b", "n_a", "n_b", *others, F.concat("less", "more").alias("delta"),
                        F.size("more").cast("long").alias("extras"))
                .withColumn("linked", linked))


def _mark(text: str) -> Column:
    """Tells the texts of rows that share an id, or have none, apart."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _rooted(docs: DataFrame, text: str, doc_id: str, shingle: int, percent: int, k: int,
            filter_bits: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, mark, n, digest, ...), and digest, root, component_id of every class."""
    search = _Search(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                                 _mark(text).alias("mark")),
                     shingle, percent, k, filter_bits)
    near = stored(search.compared(stored(search.likely(search.with_pivot(), wide=2), "likely")),
                  "near")
    links = stored(near.where("linked").select("a", "b").union(search.by_difference(near)),
                   "links")
    hung = stars(links)  # roots are not listed, a class that is not is its own
    rest = stored(search.open_pairs(near, hung), "open")
    if not rest.isEmpty():
        met = stored(search.compared(rest).withColumn(
            "far", search.beyond(F.col("extras"), F.col("n_b"))), "met")
        more = stored(met.where("linked").select("a", "b")
                      .union(search.by_difference(met.where("NOT far")))
                      .union(search.by_extras(met)), "links")
        if not more.isEmpty():
            hung = stars(hung.union(more))
    roots = hung.select(F.col("a").alias("node"), F.col("b").alias("root"))
    rooted = search.classes.join(roots, F.col("cls") == F.col("node"), "left").select(
        "digest", "doc_id", F.coalesce("root", "cls").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return search.rows, rooted.join(least, "root").select(
        F.col("digest").alias("d"), "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    shingle: int = SHINGLE, percent: int = PERCENT, k: int = K,
                    filter_bits: int | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Rows link when their shingle sets share ``percent`` % of their union or more;
    ``component_id`` is the least id that links reach, the row's own included, and
    ``kept`` says that it is the row's own. Null and empty texts, or texts without
    words, link with nothing. A null id never is the least; it is the component
    of rows that reach no other id, and such rows are kept. Rows that repeat an id
    are that document each time. An empty table gives an empty result; other
    columns are not read. ``filter_bits`` sets the size of the bit array that tells
    which texts are read for comparing; else it follows from the pairs to compare.
    """
    rows, classes = _rooted(docs, text, doc_id, shingle, percent, k, filter_bits)
    own = F.col("doc_id")
    return (rows.join(classes, F.col("digest") == F.col("d"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(own)
                    .alias("component_id"))
            .withColumn("kept", own.eqNullSafe(F.col("component_id"))))


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
               shingle: int = SHINGLE, percent: int = PERCENT, k: int = K,
               filter_bits: int | None = None) -> DataFrame:
    """The documents without near duplicates, one of each group, columns as they were.

    The one with the least id stays, of several texts with that id, or of a group
    without ids, the one whose text has the least hash. Rows of equal id and text are
    one document and stay or go together. Texts without words stay.
    """
    rows, classes = _rooted(docs, text, doc_id, shingle, percent, k, filter_bits)
    grouped = rows.where("n > 0").join(classes, F.col("digest") == F.col("d")).select(
        "root", "doc_id", "mark")
    stays = grouped.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")).alias("stays"))
    gone = (grouped.join(stays, "root")
            .where(~(F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))
                     & (F.col("mark") == F.col("stays.mark"))))
            .select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct())
    return docs.join(gone, F.col(doc_id).eqNullSafe(F.col("__id"))
                     & (_mark(text) == F.col("__mark")), "left_anti")
