"""A hidden Markov language model trained by Baum-Welch over all training texts.

The most frequent words are symbols of their own and all others one symbol, whose
words share its probability by their smoothed counts. Each iteration's expected
counts are summed over partitions; the exact likelihood of a text comes from the
scaled forward recursion over its whole length.

1. Word counts of the training texts, combined before they move.
2. Each text becomes numbers of symbols plus its rare words, written once.
3. Rounds of Baum-Welch: tasks add up expected starts, transitions and
   emissions of their texts, the sums make the next model, which has a fixed size.
   They end when a round gains too little likelihood. States begin apart, each with
   words of its own and staying for some words: from states that are nearly alike the
   first rounds lead nowhere.
4. Scores: the forward recursion in each task; the rare words' counts are
   joined by word. Frequent words never take part in that join, so no word is hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.shared import crc_fold, stored

FOLDS = 7
HELD_OUT = 2
STATES = 8
SYMBOLS = 1 << 15
# Rounds end below this relative gain in log likelihood, and after so many at the latest.
GAIN = 0.001
ITERATIONS = 5
SEED = 11
# Training sequences: a longer text is that many words at a time.
SEQUENCE = 512
TRAIN_TOKENS, SCORE_TOKENS = 400_000, 2_000_000
# The token after the last word; no word holds white space.
END = b"\n"


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())],
            ["word", "c"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                strict=True):
            if crc_fold(doc_id, FOLDS) != HELD_OUT:
                seen.update(tokens(text.as_py()))
                if len(seen) > 300_000:
                    yield out()
                    seen.clear()
    yield out()


TAIL = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))


def _encoded(words: list[bytes], counts: list[int], total: int, distinct: int):
    number = {w: i for i, w in enumerate(words)}
    base = np.log10((np.array([*counts, 0], np.float64) + 1) / (total + distinct + 1))
    rare = len(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids, held, n, scores, tails = [], [], [], [], []
                for text, doc_id in zip(part.column("text").to_pylist(),
                                        part.column("doc_id").to_pylist(), strict=True):
                    words_ = tokens(text)
                    found = np.array(list(map(number.get, words_, repeat(rare))))
                    tail = Counter([words_[i] for i in np.flatnonzero(found == rare).tolist()])
                    ids.append(found.astype("<u2").tobytes())
                    held.append(crc_fold(doc_id, FOLDS) == HELD_OUT)
                    n.append(len(words_))
                    scores.append(float(base[found[found < rare]].sum()))
                    tails.append(list(tail.items()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(uid, uid + len(n)), pa.int64()), part.column("doc_id"),
                     pa.array(held), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(scores, pa.float64()),
                     pa.array(tails, TAIL)],
                    ["uid", "doc_id", "held_out", "n_tokens", "ids", "base", "tail"])
                uid += len(n)

    return run


@dataclass
class Model:
    """Start (K), transitions (K x K) and emissions (symbols x K), all probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def first(counts: np.ndarray, states: int, seed: int) -> Model:
        """States that share out the corpus frequencies unevenly and mostly go on."""
        random = np.random.default_rng(seed)
        emit = (counts[:, None] + 0.5) * (random.gamma(0.3, size=(len(counts), states)) + 1e-3)
        move = np.full((states, states), 0.16 / states) + 0.84 * np.eye(states)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @staticmethod
    def of(start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
        """From expected counts, with a little added so that nothing is impossible."""
        start, move, emit = start + 0.1, move + 0.1, emit + 0.01
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True),
                     emit / emit.sum(axis=0))


    def within(self) -> np.ndarray:
        """Probabilities of the states somewhere within a text: those that moves keep."""
        kept = np.linalg.matrix_power(self.move, 64).mean(axis=0)
        return kept / kept.sum()


class _Batch:
    """Sequences side by side, longest first, so that those still running are the first ones.

    Tokens lie step by step, those of a step side by side, so that a step is a slice.
    ``opens`` tells which sequences begin a text; others go on within one.
    """

    def __init__(self, sequences: list[np.ndarray], opens: list[bool] | None = None):
        self.order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        self.opens = np.array([opens is None or opens[i] for i in self.order])
        lengths = np.array([len(sequences[i]) for i in self.order])
        flat = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        begin = np.cumsum(lengths) - lengths
        steps = np.arange(1, int(lengths[0]) + 1)
        self.running = np.searchsorted(-lengths, -steps, side="right")
        self.ends = np.cumsum(self.running)
        step = np.repeat(steps - 1, self.running)
        inside = np.arange(len(flat)) - np.repeat(self.ends - self.running, self.running)
        self.flat = flat[begin[inside] + step]

    def steps(self) -> list[slice]:
        return [slice(b, e) for b, e in zip((self.ends - self.running).tolist(),
                                            self.ends.tolist(), strict=True)]

    def likelihood(self, model: Model) -> np.ndarray:
        """log10 probability of each sequence, in the order they came."""
        total = np.zeros(len(self.order))
        alpha = None
        for at in self.steps():
            live = at.stop - at.start
            alpha = (model.start if alpha is None else alpha[:live] @ model.move) * (
                model.emit[self.flat[at]])
            scale = alpha.sum(axis=1, keepdims=True)
            alpha /= scale
            total[:live] += np.log10(scale[:, 0])
        back = np.empty_like(total)
        back[self.order] = total
        return back

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of starts, transitions and emissions (states x symbols), and the
        log10 probability of all sequences."""
        states, steps = len(model.start), self.steps()
        emits = model.emit[self.flat]
        alphas, scales = np.empty_like(emits), np.empty(len(self.flat))
        alpha = None
        for at in steps:
            ahead = (np.where(self.opens[:, None], model.start, model.within())
                     if alpha is None else alpha[:at.stop - at.start] @ model.move)
            alpha = ahead * emits[at]
            scales[at] = alpha.sum(axis=1)
            alpha /= scales[at][:, None]
            alphas[at] = alpha
        emits /= scales[:, None]
        move, back = np.zeros((states, states)), model.move.T
        beta = np.ones((0, states))
        for at in reversed(steps):
            now = np.ones((at.stop - at.start, states))
            if len(beta):
                # those that go on; the others end here
                now[:len(beta)] = beta @ back
                move += alphas[at][:len(beta)].T @ beta
            alphas[at] *= now
            beta = now * emits[at]
        emit = np.stack([np.bincount(self.flat, alphas[:, k], len(model.emit))
                         for k in range(states)])
        starts = alphas[steps[0]][self.opens].sum(axis=0)
        return starts, move * model.move, emit, float(np.log10(scales).sum())


def _grouped(batches: Iterator[pa.RecordBatch], most: int, sequence: int | None = None):
    """(rows, sequences) of about ``most`` tokens; texts in parts of ``sequence`` if asked.
    A row is its batch, its place in it, and the part's place in the text."""
    rows, sequences, size = [], [], 0
    for batch in batches:
        for i, raw in enumerate(batch.column("ids")):
            ids = np.frombuffer(raw.as_py(), "<u2")
            for low in range(0, len(ids), sequence or len(ids)):
                part = ids[low:low + (sequence or len(ids))]
                rows.append((batch, i, low))
                sequences.append(part)
                size += len(part)
            if size >= most:
                yield rows, sequences
                rows, sequences, size = [], [], 0
    if sequences:
        yield rows, sequences


def _expected(model: Model):
    """Expected counts of a task as rows: kind 0 start, 1 transition, 2 emission, and 3 the
    log likelihood (in the first column)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = len(model.start)
        start, move = np.zeros(states), np.zeros((states, states))
        emit, fit = np.zeros((states, len(model.emit))), np.zeros(states)
        for rows, sequences in _grouped(batches, TRAIN_TOKENS, SEQUENCE):
            a, b, c, d = _Batch(sequences, [low == 0 for *_, low in rows]).expected(model)
            start += a
            move += b
            emit += c
            fit[0] += d
        seen = np.flatnonzero(emit.any(axis=0))
        kinds = [0, 3] + [1] * states + [2] * len(seen)
        numbers = [0, 0, *range(states), *seen.tolist()]
        values = np.concatenate([start[None, :], fit[None, :], move, emit[:, seen].T])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(numbers, pa.int32()),
             *[pa.array(values[:, k]) for k in range(states)]],
            ["kind", "number", *[f"s{k}" for k in range(states)]])

    return run


def baum_welch(encoded: DataFrame, model: Model, iterations: int, gain: float = GAIN) -> Model:
    """Iterate over all training sequences; only sums of the model's fixed size are collected.

    Ends when a round fits better than the one before by less than ``gain`` of its log
    likelihood, and after ``iterations`` rounds at the latest.
    """
    last = None
    states = len(model.start)
    names = [f"s{k}" for k in range(states)]
    schema = "kind int, number int, " + ", ".join(f"{n} double" for n in names)
    training = encoded.where(~F.col("held_out")).select("ids")
    for _ in range(iterations):
        sums = (training.mapInArrow(_expected(model), schema).groupBy("kind", "number")
                .agg(*[F.sum(n).alias(n) for n in names]).toArrow())
        kind, number = sums.column("kind").to_numpy(), sums.column("number").to_numpy()
        values = np.stack([sums.column(n).to_numpy() for n in names], axis=1)
        start, move = np.zeros(states), np.zeros((states, states))
        emit = np.zeros_like(model.emit)
        start[:] = values[kind == 0].sum(axis=0)
        move[number[kind == 1]] = values[kind == 1]
        emit[number[kind == 2]] = values[kind == 2]
        model = Model.of(start, move, emit)
        fit = values[kind == 3].sum()
        if last is not None and fit - last < gain * abs(last):
            break
        last = fit
    return model


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sequences in _grouped(batches, SCORE_TOKENS):
            scores = _Batch(sequences).likelihood(model)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column("uid")[i].as_py() for b, i, _ in rows], pa.int64()),
                 pa.array([b.column("doc_id")[i].as_py() for b, i, _ in rows],
                          rows[0][0].column("doc_id").type),
                 pa.array([b.column("held_out")[i].as_py() for b, i, _ in rows]),
                 pa.array([b.column("n_tokens")[i].as_py() for b, i, _ in rows], pa.int64()),
                 pa.array([b.column("base")[i].as_py() for b, i, _ in rows]), pa.array(scores)],
                ["uid", "doc_id", "held_out", "n_tokens", "base", "hidden"])

    return run


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", states: int = STATES,
          symbols: int = SYMBOLS, iterations: int = ITERATIONS, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Texts whose id's crc32 modulo ``FOLDS`` is ``HELD_OUT`` are scored, not learned
    from. ``base_score`` is the add-one unigram log10 probability, ``score`` that of
    the hidden Markov model. Null and empty texts are the end token alone; a null id
    is in no fold and learned from; repeated rows count each time. Without training
    texts the counts are 0 and every state emits alike. An empty table gives an
    empty result. ``symbols`` is at most 65,535.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = stored(rows.mapInArrow(_counts, "word binary, c long").groupBy("word")
                    .agg(F.sum("c").alias("c")), "word-counts")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, distinct = int(sums[0]), int(sums[1])
    top = counts.orderBy(F.desc("c"), "word").limit(symbols).collect()
    words, held = [bytes(r["word"]) for r in top], [r["c"] for r in top]
    rest, rest_words = total - sum(held), distinct - len(held)
    kind = docs.schema[doc_id].dataType.simpleString()
    encoded = stored(rows.mapInArrow(
        _encoded(words, held, total, distinct),
        f"uid long, doc_id {kind}, held_out boolean, n_tokens long, ids binary, base double, "
        "tail array<struct<word: binary, n: long>>"), "encoded")
    model = baum_welch(encoded, Model.first(np.array([*held, rest], np.float64), states, seed),
                       iterations)
    hidden = encoded.select("uid", "doc_id", "held_out", "n_tokens", "ids", "base").mapInArrow(
        _scored(model), f"uid long, doc_id {kind}, held_out boolean, n_tokens long, base double, "
        "hidden double")
    # every rare word's share of the rare symbol; frequent words are not in this join
    tail = encoded.select("uid", F.explode("tail").alias("t")).select("uid", "t.word", "t.n")
    c = F.coalesce("c", F.lit(0))
    n = F.col("n")
    tail = (tail.join(counts, "word", "left").groupBy("uid")
            .agg(F.sum(n * F.log10((c + 1) / F.lit(float(total + distinct + 1)))).alias("t_base"),
                 F.sum(n * F.log10((c + 1) / F.lit(float(rest + rest_words + 1)))).alias("t_share"),
                 F.sum(n).alias("t_n"), F.sum(F.when(c > 0, n).otherwise(0)).alias("t_known"))
            .withColumnRenamed("uid", "t_uid"))
    zero = F.lit(0)
    return (hidden.join(tail, F.col("uid") == F.col("t_uid"), "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_tokens") - F.coalesce("t_n", zero) + F.coalesce("t_known", zero))
                    .alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("t_base", F.lit(0.0))).alias("base_score"),
                    (F.col("hidden") + F.coalesce("t_share", F.lit(0.0))).alias("score")))
