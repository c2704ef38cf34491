"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words the shorter one (of equal length, either) contributes its two disjoint
chunks, its halves, the other one its positional grams. One edit lies in one half and
keeps the other as it is, moved by the difference of the lengths, so by one at most.
As only grams within that shift of a chunk's place can meet it, no others are made.
The half with the edit is chunked once more in the same way: one of its halves is
whole as well. A join key therefore holds three quarters of a word, which keeps
groups small however common a beginning or an ending is, and names the quarter with
the edit. A pair that meets is verified: the rest must be equal and the quarters one
edit apart. An edit at the border of two quarters, or in a run of equal characters,
fits several quarters; the first one counts, so a pair is found once.

All of it are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.shared import stored

# Letters of a word, of which only these are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEAST_LENGTH = 7
LEAST_COUNT = 2
DAMAGED = 31
RATIO = 10
QUARTERS = 4


def damaged_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  least: int = LEAST_LENGTH, one_in: int = DAMAGED) -> DataFrame:
    """A row per occurrence: the word of at least ``least`` letters, after one run in
    ``one_in``, chosen by the crc32 of ``<doc_id>:<run>``, has lost a letter.

    A null id counts as an empty one. A null text has no words.
    """
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(
            F.col(text), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", hashed.alias("h"), F.char_length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    word = F.when(F.col("h") % one_in == 0, F.concat(
        F.substring(F.col("run"), F.lit(1), at),
        F.substring(F.col("run"), at + 2, F.col("size")))).otherwise(F.col("run"))
    # a run of exactly ``least`` letters that lost one is too short
    return runs.select(word.alias("word")).filter(F.char_length("word") >= least)


def vocabulary(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """word and its occurrences n, of those with at least ``least``."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _border(size: Column, quarter: int) -> Column:
    """Where a quarter of a word begins: halves first, then halves of the halves."""
    half = F.floor(size / 2)
    border = {0: F.lit(0), 1: F.floor(half / 2), 2: half,
              3: half + F.floor((size - half) / 2), 4: size}[quarter]
    return border.cast("int")


def _cut(word: str, size: Column, shift: int, quarter: int) -> Column:
    """Key, quarter and parts of a word as it meets words of ``size`` characters, itself
    longer than those by ``shift``."""
    low, high = _border(size, quarter), _border(size, quarter + 1)
    before = F.substring(F.col(word), F.lit(1), low)
    after = F.substring(F.col(word), high + 1 + shift, size)
    middle = F.substring(F.col(word), low + 1, high - low + shift)
    return F.struct(
        F.xxhash64(size, F.lit(quarter), before, after).alias("key"),
        F.lit(quarter).alias("quarter"), F.lit(shift).alias("shift"), middle.alias("middle"))


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair of words that differ by one inserted, deleted or replaced code point,
    once: word, n, other, other_n; ``other`` is the longer one, or the later one of two
    of equal length. ``words`` holds distinct words (word, n)."""
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    chunks = sized.select(
        "word", "n", "size",
        F.inline(F.array(*[_cut("word", F.col("size"), 0, q) for q in range(QUARTERS)])))
    grams = sized.select(
        F.col("word").alias("other"), F.col("n").alias("other_n"),
        F.inline(F.array(*[_cut("word", F.col("size") - s, s, q)
                           for s in (0, 1) for q in range(QUARTERS)])))
    grams = grams.withColumnsRenamed(
        {"quarter": "other_quarter", "middle": "other_middle"})
    quarter, size = F.col("quarter"), F.col("size")
    low = F.element_at(F.array(*[_border(size, q) for q in range(QUARTERS)]), quarter + 1)
    high = F.element_at(F.array(*[_border(size, q + 1) for q in range(QUARTERS)]), quarter + 1)
    rest_equal = (
        (F.char_length("other") == size + F.col("shift"))
        & (F.substring("word", F.lit(1), low) == F.substring("other", F.lit(1), low))
        & (F.substring(F.col("word"), high + 1, size)
           == F.substring(F.col("other"), high + 1 + F.col("shift"), size)))
    one_edit = F.levenshtein("middle", "other_middle", 1) == 1
    # the inserted character fits the quarter before as well if this one is only moved
    first = ((F.col("shift") == 0) | (quarter == 0)
             | (F.col("middle") != F.substring(F.col("other_middle"), F.lit(2), size)))
    met = chunks.drop("shift").join(grams, "key").filter(
        (quarter == F.col("other_quarter")) & one_edit & rest_equal & first
        & ((F.col("shift") == 1) | (F.col("word") < F.col("other"))))
    return met.select("word", "n", "other", "other_n")


def _roots(links: DataFrame) -> DataFrame:
    """word and root: forms followed to the last one.

    Pointers double in every round. A form has several times the occurrences of its
    word, so chains, and rounds, are bounded by the logarithm of the greatest count.
    """
    links = stored(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        links = stored(links.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")), "forms")


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every distinct word.

    ``words`` holds occurrences (word); words of fewer than ``LEAST_COUNT`` are left out.
    n_near counts the words one edit apart. The form is the one of these with most
    occurrences, of equals the smallest in code-point order, if it has at least
    ``ratio`` times (above 1) those of the word, else null. The root is where following
    forms ends, the word itself without a form. A null word is none; an empty table
    gives no rows.
    """
    if ratio <= 1:
        raise ValueError("forms must be more frequent than their words")
    known = stored(vocabulary(words.filter(F.col("word").isNotNull())), "words")
    pairs = near_pairs(known)
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("word"), F.struct((-F.col("other_n")).alias("less"),
                                         F.col("other").alias("near")).alias("best")),
        F.struct(F.col("other").alias("word"), F.struct(
            (-F.col("n")).alias("less"), F.col("word").alias("near")).alias("best")))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    judged = stored(known.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"),
        F.when(fits, -F.col("best.less")).alias("form_n")), "judged")
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
