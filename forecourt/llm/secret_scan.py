"""Secrets by fixed patterns and a linear-chain conditional random field.

The field tags every token as begin, inside or outside of a secret from its shape,
its neighbouring words and facts about the file, and is decoded by Viterbi. It
learns from the pattern matches, which are looked for in all documents and then
bounded, and from a bounded sample of other documents, with features that see
shapes rather than the patterns themselves. Each match is also learned under other
names, cut and with other letters, and ordinary words in the same frames, so that
neither a name nor a length decides. It adds the spans that look alike; matches of
the patterns always stay.

A token's score depends on the token, its two neighbours and the file, so each
distinct word is looked at once and long texts are scored by table. The best tag
sequence can leave "outside" only where an upper bound of the gain is positive;
Viterbi runs over those stretches, which changes nothing in its result.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from string import ascii_letters

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.shared import WORD, stored

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# a run of hexadecimal digits shorter than 24 fails, so only longer ones are looked for
HEX = re.compile(r"[0-9a-f]{24,}")
# the same three at their least lengths, for Spark: whether a text has a match
ANY = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
       r"""[A-Za-z0-9+/_.=-]{6}|AKIA[A-Z0-9]{16}|[0-9a-f]{24}""")
KINDS = ("assign", "access", "hex", "field")
LEAST_VALUE, LEAST_ACCESS = 6, 20
_WORD = re.compile(WORD)
_KEYWORD = re.compile(rb"passw|secret|token|api_?key")
_MAYBE_HEX = re.compile(rb"[0-9a-f]{24}")

SAMPLE = 20_000
WINDOWS = 6_000
AROUND = 8
# Besides the window of a secret, so many more with its value in one of so many frames, cut
# to this length or more.
ALTERED, FRAMES, LEAST_CUT = 2, 7, 14
FEATURES = 1 << 14
EPOCHS = 60
KNOWN_WORDS = 500_000
TAGS = 3  # outside, begin, inside
O, B, I = range(TAGS)  # noqa: E741
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the pattern matches, by start, then kind as listed."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def may_match(word: bytes) -> bool:
    """Whether a text with this word has to be searched for base patterns."""
    return (len(word) > 4 and (_KEYWORD.search(word.lower()) is not None or b"AKIA" in word)
            or len(word) > 23 and _MAYBE_HEX.search(word) is not None)


def _entropy(word: str) -> float:
    return -sum(n / len(word) * math.log2(n / len(word)) for n in Counter(word).values())


class _Outline(dict):
    """Code point to a for lower case letters, A for others, d for digits, or itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "d" if c in "0123456789" else "a" if c.islower() else (
            "A" if c.isalpha() else c)
        return kind


_outline = _Outline()
_RUN = re.compile(r"(.)\1+")
_VOWELS = re.compile("[aeiouAEIOU]")
_DIGITS = re.compile("[0-9]")
_LETTERS = re.compile("[A-Za-z]")


def shape(word: str) -> str:
    """Runs of lower, upper, digit and other characters, as a, A, d and the others themselves."""
    return _RUN.sub(r"\1+", word.translate(_outline))


def is_plain(word: str) -> bool:
    """A short word of letters, with or without marks around it."""
    return len(word) < 16 and word.strip(".,;:!?").isalpha()


def word_features(word: str, outline: str) -> list[str]:
    """What the field sees of a token by itself. Of a plain word that is its outline and length."""
    if is_plain(word):
        return ["1", "plain", f"len{len(word) // 4}", f"shape{outline[:12]}"]
    bare = word.strip("\"'`,;()[]{}<>")
    value = _SIGN.split(bare)[-1] or bare or word
    digits, vowels = len(_DIGITS.findall(value)), len(_VOWELS.findall(value))
    inner = outline if value == word else shape(value)
    return ["1", f"len{min(len(value), 40) // 4}", f"shape{inner[:12]}",
            f"runs{min(len(inner), 24) // 2}", f"dig{round(4 * digits / len(value))}",
            f"vow{round(5 * vowels / len(value))}", f"ent{round(2 * _entropy(value))}",
            f"mix{digits > 0}{value.isalnum()}{value.lower() == value}{value.upper() == value}",
            f"sign{'=' in bare}{':' in bare}{word != bare}", f"of{bare[:-len(value)].lower()[:16]}"]


_SIGN = re.compile("[=:]")


def neighbour_features(word: str, outline: str) -> list[str]:
    """What the field sees of the token before or after: the word itself, then its outline."""
    return ["digits" if "d" in outline else f"w{word[:16]}", f"s{outline[:8]}"]


def file_features(text: str) -> list[str]:
    lines = text.count("\n")
    return [f"lines{min(8, lines.bit_length())}", f"eq{min(3, text.count('='))}",
            f"code{sum(c in text for c in '{};')}", f"size{min(20, len(text).bit_length())}"]


# A feature has another weight for the token itself, before it, after it, and for the file.
_PLACES = {"=": 0, "<": 0x5BD1E995, ">": 0x27D4EB2F, "#": 0x165667B1}


def _numbers(features: list[str], place: str) -> list[int]:
    salt = _PLACES[place]
    return [(zlib.crc32(f.encode()) ^ salt) % FEATURES for f in features]


def token_features(words: list[str], i: int, about_file: list[int]) -> list[int]:
    def near(j: int, edge: str) -> list[str]:
        return neighbour_features(words[j], shape(words[j])) if 0 <= j < len(words) else [edge]

    return [*_numbers(word_features(words[i], shape(words[i])), "="),
            *_numbers(near(i - 1, "first"), "<"), *_numbers(near(i + 1, "last"), ">"), *about_file]


def tags_of(places: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """Begin, inside, outside of each token; one that a span touches belongs to it."""
    tags = []
    spans = sorted(spans, key=lambda s: s[1])
    last_owner, k, reach = None, 0, []
    for a, b in places:
        while k < len(spans) and spans[k][1] < b:
            reach.append(spans[k])
            k += 1
        reach = [s for s in reach if s[2] > a]
        owner = reach[0] if reach else None
        joined_ = owner is not None and last_owner is not None and (
            owner == last_owner or owner[1] < last_owner[2])
        tags.append(O if owner is None else I if joined_ else B)
        last_owner = owner
    return tags


def framed(name: str, value: str, frame: int) -> list[str]:
    """The tokens of a value by itself, quoted, or given to a name."""
    return ([value], [f'"{value}"'], [f"{name}={value}"], [f"{name}:", value],
            [name, "=", value], [name, "=", f'"{value}"'], [f'{name}="{value}"'])[frame % FRAMES]


def altered(words: list[str], first: int, last: int, secret: bool,
            chance: int) -> tuple[list[str], list[int], int]:
    """Words, tags, and the place, with the value in ``words[last]`` in another frame.

    The tokens from ``first`` to ``last`` are replaced. The name is the word before, so names
    tell nothing. A secret loses a part of its end, so its length tells little, and every
    second one gets other letters, so its alphabet does not: the field has to go by the make
    of the value and where it stands. Other values are cut to any length, and marks may
    follow. What is drawn depends on ``chance`` alone.
    """
    bare = words[last].strip("\"'`,;()[]{}<>")
    value = _SIGN.split(bare)[-1] or bare or words[last]
    if secret and len(value) > LEAST_CUT:
        value = value[:LEAST_CUT + chance // FRAMES % (len(value) - LEAST_CUT + 1)]
        if chance & 1 << 20:
            draw = random.Random(chance)
            value = _LETTERS.sub(lambda _: draw.choice(ascii_letters), value)
    elif not secret and chance & 1 << 21:
        value = value[:1 + chance // FRAMES % len(value)]
    name = words[first - 1] if first and words[first - 1].isalpha() else "name"
    tokens = framed(name, value, chance)
    tokens[-1] += ("", "", ",", ".", ";")[(chance >> 8) % 5]
    tags = [B, *[I] * (len(tokens) - 1)] if secret else [O] * len(tokens)
    low = max(0, first - AROUND)
    after = words[last + 1:last + 1 + AROUND]
    return ([*words[low:first], *tokens, *after],
            [*[O] * (first - low), *tags, *[O] * len(after)], first - low)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training windows: tokens around every pattern match, and here and there others, as
    they are and with the value in other frames."""
    for batch in batches:
        features, tags = [], []

        def add(words: list[str], labels: list[int], i: int, about: list[int]) -> None:
            some = range(max(0, i - AROUND), min(len(words), i + AROUND + 1))
            features.append([token_features(words, j, about) for j in some])  # noqa: B023
            tags.append([labels[j] for j in some])  # noqa: B023

        for text in batch.column("text").to_pylist():
            if not text:
                continue
            places = [m.span() for m in _WORD.finditer(text)]
            words = [text[a:b] for a, b in places]
            labels = tags_of(places, base_spans(text))
            about = _numbers(file_features(text), "#")
            chance = zlib.crc32(text.encode())
            for i in [i for i, t in enumerate(labels) if t == B]:
                add(words, labels, i, about)
                last = i
                while last + 1 < len(labels) and labels[last + 1] == I:
                    last += 1
                for turn in range(ALTERED):
                    mark = zlib.crc32(f"{i}:{turn}".encode(), chance)
                    add(*altered(words, i, last, True, mark), about)
            calm = [i for i, t in enumerate(labels) if t == O]
            # of the others, in some texts, a word and one with a digit
            for turn, some in enumerate((calm, [i for i in calm if _DIGITS.search(words[i])])):
                if some and chance % (16, 2)[turn] == 0:
                    i = some[chance // 16 % len(some)]
                    add(words, labels, i, about)
                    for again in range(ALTERED):
                        mark = zlib.crc32(f"{i}:{turn}:{again}".encode(), chance)
                        changed = altered(words, i, i, False, mark)
                        if not base_spans(" ".join(changed[0])):
                            add(*changed, about)
        yield pa.RecordBatch.from_arrays(
            [pa.array(features, pa.list_(pa.list_(pa.int32()))),
             pa.array(tags, pa.list_(pa.int32()))], ["features", "tags"])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis=axis, keepdims=True))).squeeze(axis)


class Field:
    """Weights of the tags' features and of their transitions."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((FEATURES, TAGS)) if weights is None else weights
        self.moves = np.zeros((TAGS, TAGS)) if moves is None else moves

    def fit(self, windows: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS,
            rate: float = 0.3, ridge: float = 1e-4) -> Field:
        """Gradient ascent on the conditional log-likelihood, with Adagrad steps.

        Windows are padded to one length; padding carries no weight and no tag.
        """
        if not any(any(t) for _, t in windows):
            self.weights[_numbers(["1"], "="), O] = 1.0  # nothing to learn from: all outside
            return self
        count, most = len(windows), max(len(t) for _, t in windows)
        wide = max(len(f) for fs, _ in windows for f in fs)
        ids = np.full((count, most, wide), FEATURES, np.int64)
        gold = np.zeros((count, most), np.int64)
        live = np.zeros((count, most), bool)
        for w, (features, tags) in enumerate(windows):
            gold[w, :len(tags)], live[w, :len(tags)] = tags, True
            for t, f in enumerate(features):
                ids[w, t, :len(f)] = f
        weights = np.vstack([self.weights, np.zeros(TAGS)])
        seen_w, seen_m = np.full_like(weights, 1e-6), np.full_like(self.moves, 1e-6)
        row = np.arange(count)
        for _ in range(epochs):
            scores = weights[ids].sum(axis=2)
            alpha = np.empty_like(scores)
            alpha[:, 0] = scores[:, 0]
            for t in range(1, most):
                ahead = _log_sum(alpha[:, t - 1, :, None] + self.moves, 1) + scores[:, t]
                alpha[:, t] = np.where(live[:, t, None], ahead, alpha[:, t - 1])
            total = _log_sum(alpha[:, -1], 1)
            beta = np.zeros_like(scores)
            move_grad = np.zeros_like(self.moves)
            for t in range(most - 2, -1, -1):
                after = self.moves + (scores[:, t + 1] + beta[:, t + 1])[:, None, :]
                on = live[:, t + 1]
                beta[:, t] = np.where(on[:, None], _log_sum(after, 2), 0.0)
                pair = np.exp(alpha[:, t, :, None] + after - total[:, None, None])
                move_grad -= pair[on].sum(axis=0)
                np.add.at(move_grad, (gold[row[on], t], gold[row[on], t + 1]), 1.0)
            grad = -np.exp(alpha + beta - total[:, None, None])
            grad[np.arange(count)[:, None], np.arange(most), gold] += 1.0
            grad *= live[:, :, None]
            flat = ids.reshape(-1)
            step = np.stack([np.bincount(flat, np.repeat(grad[:, :, y].reshape(-1), wide),
                                         FEATURES + 1) for y in range(TAGS)], axis=1)
            step -= ridge * count * weights
            step[FEATURES] = 0.0
            seen_w += step ** 2
            seen_m += move_grad ** 2
            weights += rate * step / np.sqrt(seen_w)
            self.moves = self.moves + rate * move_grad / np.sqrt(seen_m)
        self.weights = weights[:-1]
        return self

    def viterbi(self, scores: np.ndarray) -> list[int]:
        """Best tags of a stretch with "outside" before and after it."""
        best = self.moves[O] + scores[0]
        back = []
        for now in scores[1:]:
            ways = best[:, None] + self.moves
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + now
        tag = int((best + self.moves[:, O]).argmax())
        tags = [tag]
        for step in reversed(back):
            tag = int(step[tag])
            tags.append(tag)
        return tags[::-1]


class Scanner:
    """Scores texts by tables of the words seen so far."""

    def __init__(self, field: Field):
        self.field = field
        moves = field.moves - field.moves[O, O]
        # most that a transition into or out of a secret can add, and the slack that a
        # stretch must reach when it is cut short
        self.into = float(moves[:, [B, I]].max())
        self.slack = max(0.0, self.into - float(moves[O, I]), self.into - float(moves[O, B])) + max(
            0.0, float(moves[[B, I], O].max()))
        self.clear()

    def clear(self) -> None:
        """Forget the words; row 0 of the tables is the edge of a text."""
        self.number: dict[bytes, int] = {}
        self.tables = [np.zeros((1024, TAGS)) for _ in range(3)]
        self.tables[1][0] = self._sum(["first"], "<")
        self.tables[2][0] = self._sum(["last"], ">")
        self.flags = np.zeros(1024, bool)
        # rows of scores that words share: by outline, as a neighbour and as a plain word
        self.sides: dict[str, int] = {}
        self.side_rows = np.zeros((64, 2, TAGS))
        self.owns: dict[tuple[int, str], int] = {}
        self.own_rows = np.zeros((64, TAGS))

    def _sum(self, features: list[str], place: str) -> np.ndarray:
        return self.field.weights[_numbers(features, place)].sum(axis=0)

    def _learn(self, words: list[bytes]) -> None:
        low = len(self.number) + 1
        high = low + len(words)
        while high > len(self.flags):
            self.tables = [np.vstack([t, np.zeros_like(t)]) for t in self.tables]
            self.flags = np.append(self.flags, np.zeros_like(self.flags))
        sides, owns, numbers, odd, flags = [], [], [], [], []
        for row, raw in enumerate(words):
            word = raw.decode()
            self.number[raw] = low + row
            outline = shape(word)
            itself, *rest = neighbour_features(word, outline)
            side = self.sides.get(outline)
            if side is None:
                side = self.sides[outline] = len(self.sides)
                if side >= len(self.side_rows):
                    self.side_rows = np.concatenate([self.side_rows, self.side_rows * 0])
                self.side_rows[side] = self._sum(rest, "<"), self._sum(rest, ">")
            sides.append(side)
            numbers.append(zlib.crc32(itself.encode()))
            if is_plain(word):
                key = len(word) // 4, outline
                own = self.owns.get(key)
                if own is None:
                    own = self.owns[key] = len(self.owns)
                    if own >= len(self.own_rows):
                        self.own_rows = np.concatenate([self.own_rows, self.own_rows * 0])
                    self.own_rows[own] = self._sum(word_features(word, outline), "=")
                owns.append(own)
            else:
                owns.append(0)
                odd.append((row, self._sum(word_features(word, outline), "=")))
            flags.append(may_match(raw))
        if not words:
            return
        own = self.own_rows[owns]
        for row, scores in odd:
            own[row] = scores
        found = np.array(numbers)
        side_scores = self.side_rows[sides]
        self.tables[0][low:high] = own
        for i, place in enumerate("<>"):
            self.tables[i + 1][low:high] = side_scores[:, i] + self.field.weights[
                (found ^ _PLACES[place]) % FEATURES]
        self.flags[low:high] = flags

    def scan(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """(base spans, added spans) of each text."""
        if len(self.number) > KNOWN_WORDS:
            self.clear()
        split = [t.encode().split() for t in texts]
        self._learn([w for w in dict.fromkeys(w for ws in split for w in ws)
                     if w not in self.number])
        return [self._one(t, ws) if ws else ([], []) for t, ws in zip(texts, split, strict=True)]

    def _one(self, text: str, words: list[bytes]) -> tuple[list[Span], list[Span]]:
        ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        base = base_spans(text) if self.flags[ids].any() else []
        own, before, after = self.tables
        # row 0 of the tables of neighbours is the edge of the text
        scores = (own[ids] + before[np.append(0, ids[:-1])] + after[np.append(ids[1:], 0)]
                  + self._sum(file_features(text), "#"))
        gain = scores[:, B:].max(axis=1) - scores[:, O] + self.into
        total = np.append(0.0, np.cumsum(gain))
        run = total[1:] - np.minimum.accumulate(total[:-1])
        open_ = np.flatnonzero(run > -self.slack)
        if not len(open_):
            return base, []
        added, places = [], None
        for stretch in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            tags = self.field.viterbi(scores[stretch])
            begin = None
            for i, tag in zip([*stretch.tolist(), -1], [*tags, O], strict=True):
                if begin is not None and tag != I:
                    places = places or [m.span() for m in _WORD.finditer(text)]
                    added.append(("field", places[begin][0], places[end][1]))  # noqa: F821
                    begin = None
                if tag != O:
                    begin = i if begin is None else begin
                    end = i  # noqa: F841
        met = [(a, b) for _, a, b in base]
        # what a base span already reports is not reported again
        return base, [s for s in added if not any(a < s[2] and s[1] < b for a, b in met)]


def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE,
          windows: int = WINDOWS) -> Field:
    """A field from at most ``windows`` windows, half of them with a secret in it.

    The documents are at most ``sample`` of all those with a pattern match and at
    most ``sample`` of all, with the least hashes of their id; the bounds are on
    what the field is fitted to only. Documents without an id are not learned from.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(
        F.col("doc_id").isNotNull())

    def least(some: DataFrame) -> DataFrame:
        return (some.select(F.col("doc_id").alias("s_id")).distinct()
                .orderBy(F.xxhash64("s_id"), "s_id").limit(sample))

    ids = least(rows.where(F.col("text").rlike(ANY))).union(least(rows)).distinct()
    found = (rows.join(F.broadcast(ids), F.col("doc_id") == F.col("s_id")).select("text")
             .mapInArrow(_windows, "features array<array<int>>, tags array<int>"))
    found = stored(found.withColumn("secret", F.exists("tags", lambda t: t != O)), "windows")
    fit = [r for kind in (True, False) for r in found.where(F.col("secret") == kind).orderBy(
        F.xxhash64("features"), F.to_json("features")).limit(windows // 2).collect()]
    return Field().fit([(r["features"], r["tags"]) for r in fit])


# The last scanner of this process, so that tasks of one job share the words seen.
_last: list[tuple[bytes, Scanner]] = []


def _scanner(field: Field) -> Scanner:
    mark = hashlib.sha256(field.weights.tobytes() + field.moves.tobytes()).digest()
    if not _last or _last[0][0] != mark:
        _last[:] = [(mark, Scanner(field))]
    return _last[0][1]


def _scanned(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(field)
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                found = scanner.scan([t or "" for t in part.column("text").to_pylist()])
                counts = [[sum(k == kind for k, _, _ in base) for base, _ in found]
                          for kind in KINDS[:3]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                     pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]),
                     pa.array([joined(in_order(b + a)) for b, a in found])],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def secrets(docs: DataFrame, field: Field, text: str = "text",
            doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row.

    ``spans`` lists kind:start:end of all spans in code points, end exclusive, by
    start, then kind; ``field`` are those that the model adds, where no pattern
    matches. Null text counts as empty; every row, repeated or without id, gives
    one row; other columns are not read; an empty table gives an empty result.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _scanned(field), f"doc_id {kind}, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, spans string")
