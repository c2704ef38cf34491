"""Language identification with a string kernel.

The blended-spectrum presence kernel of two texts counts the character n-grams,
of one to three letters, that occur in both, over the roots of their own counts.
Nystroem landmarks, some training texts, give each text as many features as there
are landmarks, and one-versus-rest kernel ridge regression weighs them. A batch
of texts is scored by two matrix products.

n-grams are those of the training sample; a text's other n-grams count for nothing.
Only landmarks are held as a matrix over n-grams, other texts batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.shared import crc_fold, few_rows, fold_of

FOLDS = 5
PER_LANGUAGE = 300
MOST_TEXTS = 20_000
LANDMARKS = 128
LANDMARKS_EACH = 2
BATCH = 128
LEAST_TEXTS = 3
RIDGE = 1e-3
LONGEST = 3
MOST_LANGUAGES = 1000
UNKNOWN = "und"
CHUNK = 1 << 18
TABLE_BITS = 18
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters; made once a process."""
    global _letters
    if _letters is None:
        _letters = _letter_table()
    return _letters


def code_points(text: str, before: np.ndarray | None = None) -> np.ndarray:
    """Lower-cased letters; every run of other characters is one space.

    ``before`` holds the last points of the part before, for texts in parts.
    """
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(letters()[raw], raw, 32).astype(np.int64)
    if before is not None:
        points = np.concatenate([before, points])
    again = (points[1:] == 32) & (points[:-1] == 32)
    return points[np.append(True, ~again)] if len(points) else points


def parts(text: str) -> Iterator[np.ndarray]:
    """The code points of a text between two spaces, in parts that together hold all n-grams."""
    padded, before = f" {text} ", None
    for low in range(0, len(padded), CHUNK):
        points = code_points(padded[low:low + CHUNK], before)
        yield points
        before = points[1 - LONGEST:]


def grams(points: np.ndarray) -> Iterator[np.ndarray]:
    """n-grams of one to three code points as whole numbers, 21 bits a code point."""
    whole = points
    yield whole
    for n in range(1, LONGEST):
        whole = (whole[:-1] << 21) | points[n:]
        yield whole


class GramIndex:
    """Place of an n-gram in the vocabulary, by a few hash tables; exact."""

    def __init__(self, vocabulary: np.ndarray):
        self.keys = np.append(vocabulary, -1)
        self.tables: list[tuple[np.uint64, np.ndarray]] = []
        left = np.arange(len(vocabulary))
        step = 0
        while len(left):
            factor = np.uint64((_ODD[step % 3] * (2 * step + 1)) & (2**64 - 1) | 1)
            table = np.full(1 << TABLE_BITS, len(vocabulary), np.int32)
            place = self._place(vocabulary[left], factor)
            table[place] = left
            self.tables.append((factor, table))
            left = left[table[place] != left]
            step += 1

    @staticmethod
    def _place(values: np.ndarray, factor: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (values.view(np.uint64) * factor) >> np.uint64(64 - TABLE_BITS)

    def mark(self, values: np.ndarray, row: np.ndarray) -> None:
        """Set the row's entries of the n-grams that are in the vocabulary."""
        for factor, table in self.tables:
            at = table[self._place(values, factor)]
            row[at[self.keys[at] == values]] = 1

    def presence(self, texts: list[str]) -> np.ndarray:
        found = np.zeros((len(texts), len(self.keys)), np.float32)
        for row, text in zip(found, texts, strict=True):
            for points in parts(text):
                for values in grams(points):
                    self.mark(values, row)
        return found[:, :-1]


@dataclass
class Model:
    languages: list[str]
    index: GramIndex
    landmarks: np.ndarray  # n-grams x landmarks, columns of length 1
    weights: np.ndarray  # landmarks x languages

    def scores(self, texts: list[str]) -> np.ndarray:
        return kernel(self.index.presence(texts), self.landmarks) @ self.weights


def kernel(presence: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Rows of presence against landmarks: common n-grams over the roots of both counts."""
    own = np.sqrt(np.maximum(presence.sum(axis=1, keepdims=True), 1))
    return (presence @ landmarks) / own


def train(rows: list[tuple[str, str]], landmarks: int = LANDMARKS,
          ridge: float = RIDGE) -> Model | None:
    """A model from (text, language) rows in a fixed order; None without rows.

    There are ``landmarks`` landmarks, or ``LANDMARKS_EACH`` a language if those are more.
    """
    if not rows:
        return None
    texts, names = [r[0] for r in rows], sorted({r[1] for r in rows})
    sets = [np.unique(np.concatenate([g for p in parts(t) for g in grams(p)])) for t in texts]
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    vocabulary = values[counts >= min(LEAST_TEXTS, len(texts))]
    index = GramIndex(vocabulary)
    # landmarks take turns over the languages
    places: dict[str, int] = {}
    turn = [(places.setdefault(n, 0), places.update({n: places[n] + 1})) for _, n in rows]
    order = sorted(range(len(rows)), key=lambda i: (turn[i][0], rows[i][1]))
    order = order[:max(landmarks, LANDMARKS_EACH * len(names))]
    presence = index.presence([texts[i] for i in order])
    marks = presence.T
    marks = marks / np.sqrt(np.maximum(marks.sum(axis=0, keepdims=True), 1))
    between = kernel(presence, marks).astype(np.float64)
    values_, vectors = np.linalg.eigh(between)
    keep = values_ > 1e-6 * values_.max()
    root = vectors[:, keep] / np.sqrt(values_[keep])
    features = np.concatenate([kernel(index.presence(texts[low:low + BATCH]), marks) @ root
                               for low in range(0, len(texts), BATCH)])
    target = np.array([[1.0 if n == name else -1.0 for name in names] for _, n in rows])
    # languages weigh the same, however many rows they have
    weight = np.array([1 / places[n] for _, n in rows])[:, None]
    square = (features * weight).T @ features + ridge * len(names) * np.eye(features.shape[1])
    solved = np.linalg.solve(square, (features * weight).T @ target)
    return Model(names, index, marks.astype(np.float32), (root @ solved).astype(np.float32))


def sample(docs: DataFrame, text: str, doc_id: str, lang: str, per_language: int,
           folds: int, most: int = MOST_TEXTS) -> list[tuple[str, str]]:
    """About ``per_language`` texts of every language, by the hash of their id; fewer of
    each if all languages' would be more than ``most``.

    Rows of fold 0 and rows without id, text or language are never among them.
    """
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"),
                        F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (fold_of(F.col("id"), folds) != 0))
    counts = few_rows(known.groupBy("lang").count(), MOST_LANGUAGES, "languages")
    if not counts:
        return []
    per_language = max(1, min(per_language, most // len(counts)))
    share = F.create_map(*[F.lit(x) for r in counts
                           for x in (r["lang"], min(1.0, per_language / r["count"]))])
    point = F.pmod(F.xxhash64(F.lit("language"), "id"), F.lit(1 << 30)) / float(1 << 30)
    rows = (known.where(point < F.element_at(share, F.col("lang")))
            .orderBy(F.xxhash64("id"), "id", "text").limit(2 * per_language * len(counts))
            .collect())
    return [(r["text"], r["lang"]) for r in rows]


def _predicted(model: Model | None, folds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                texts = part.column("text").to_pylist()
                held = [crc_fold(d, folds) == 0 for d in part.column("doc_id").to_pylist()]
                known = [model is not None and t is not None and any(map(str.isalpha, t))
                         for t in texts]
                names, points = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if any(known):
                    rows = [i for i, k in enumerate(known) if k]
                    scores = model.scores([texts[i] for i in rows])
                    best = scores.argmax(axis=1)
                    for i, b, s in zip(rows, best, scores.max(axis=1), strict=True):
                        names[i] = model.languages[b]
                        points[i] = float(min(1.0, max(0.0, (s + 1) / 2)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(held), pa.array(names, pa.string()),
                     pa.array(points, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
             per_language: int = PER_LANGUAGE, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    The model learns from about ``per_language`` texts of each language, ``MOST_TEXTS``
    in all, among rows whose id's crc32 modulo ``folds`` is not 0; a prediction sees the text alone. A
    null text, one without a letter, or any text when there is nothing to learn
    from is ``und`` with score 0. A null id is not held out and not learned from.
    Every row gives one row; an empty table gives an empty result.
    """
    model = train(sample(docs, text, doc_id, lang, per_language, folds))
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _predicted(model, folds), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
