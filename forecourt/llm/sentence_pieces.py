"""SentencePiece ids of whole texts and back, merged in vectorised rounds.

A model of byte-pair pieces merges, in every word, the adjacent pair whose piece has
the best score, the leftmost of equals, until no pair makes a piece. Here all
distinct words of a batch lie in one flat array of symbols. A round finds the least
rank of a pair in every word by one segmented minimum, merges all its places that do
not overlap, from the left, and compacts the array; words without a pair leave it.

Merging all places at once gives what merging them one by one gives unless a merged
piece makes a pair that is no worse than itself. The vocabulary tells for which
pieces that can be (``eager``): of those a round merges the leftmost place only.

Characters that never stand side by side inside of any piece are never merged
across, so words are cut there, which changes no result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How the models write a space, a byte and an unknown piece.
SPACE = "▁"
BYTE = "<0x{:02X}>"
UNKNOWN = " ⁇ "

CODES = 0x110000
NONE = np.iinfo(np.int32).max
# Characters that a step merges at a time, and words a task keeps the ids of.
STEP = 1 << 21
KNOWN_WORDS = 300_000


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _in_sorted(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted table, and whether it is there."""
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


class PieceModel:
    """What merging needs of a SentencePiece model file's content.

    Models of byte-pair pieces with byte fallback, the identity normaliser, a space
    put before each text and pieces without user-defined entries; others are an error.
    """

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(content)
        kinds = proto.ModelProto.SentencePiece
        norm, trained = spec.normalizer_spec, spec.trainer_spec
        if (trained.model_type != proto.TrainerSpec.BPE or not trained.byte_fallback
                or norm.precompiled_charsmap or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or trained.treat_whitespace_as_suffix
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces)):
            raise ValueError("not a plain byte-pair model with byte fallback")
        self.size = len(spec.pieces)
        ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        named = {p.piece: i for i, p in enumerate(spec.pieces)}
        self.begin, self.end = named["<s>"], named["</s>"]
        self.bytes = np.array([named[BYTE.format(b)] for b in range(256)], dtype=np.int64)
        best = sorted({p.score for p in spec.pieces if p.type == kinds.NORMAL}, reverse=True)
        place = {score: i for i, score in enumerate(best)}
        rank = np.full(self.size, NONE, dtype=np.int32)
        for i in ids.values():
            rank[i] = place[spec.pieces[i].score]

        # a symbol is a piece's id, or ``size`` + code point for a character without one
        def symbol(part: str) -> int | None:
            return ids.get(part, self.size + ord(part) if len(part) == 1 else None)

        pairs, side_by_side = {}, set()
        for piece, i in ids.items():
            side_by_side.update(ord(a) * CODES + ord(b)
                                for a, b in zip(piece, piece[1:], strict=False))
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * (self.size + CODES) + right] = i
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.made = np.array([pairs[k] for k in self.pairs.tolist()], dtype=np.int64)
        self.rank = rank[self.made]
        self.side_by_side = np.array(sorted(side_by_side), dtype=np.int64)
        self.spaced = not any(k % CODES == ord(SPACE) != k // CODES for k in side_by_side)
        self.eager = np.zeros(self.size, dtype=bool)
        for part in (self.pairs // (self.size + CODES), self.pairs % (self.size + CODES)):
            piece = part < self.size
            self.eager[part[piece][self.rank[piece] <= rank[part[piece]]]] = True
        chars = {ord(p): i for p, i in ids.items() if len(p) == 1}
        self.char_codes = np.array(list(chars), dtype=np.int64)
        self.char_ids = np.array(list(chars.values()), dtype=np.int64)
        self.is_byte = np.array([p.type == kinds.BYTE for p in spec.pieces])
        self.is_control = np.array([p.type == kinds.CONTROL for p in spec.pieces])
        shown = [UNKNOWN.encode() if p.type == kinds.UNKNOWN else b"" if p.type == kinds.CONTROL
                 else p.piece.replace(SPACE, " ").encode() for p in spec.pieces]
        for b, i in enumerate(self.bytes.tolist()):
            shown[i] = bytes([b])
        self.shown = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.shown_sizes = np.array([len(s) for s in shown], dtype=np.int64)
        self.shown_starts = np.cumsum(self.shown_sizes) - self.shown_sizes
        self.leading = np.array([p.piece.startswith(SPACE) for p in spec.pieces])

    def encoder(self) -> Encoder:
        return Encoder(self)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: one space before the text goes, bytes that are no character
        become U+FFFD one by one, control ids give nothing."""
        flat = self.shown[_ranges(self.shown_starts[ids], self.shown_sizes[ids])].tobytes()
        # only the first piece that isn't a control id loses the space put before the text
        real = np.flatnonzero(~self.is_control[ids])
        if len(real) and self.leading[ids[real[0]]]:
            flat = flat[1:]
        try:
            return flat.decode()
        except UnicodeDecodeError:
            return self._decode_slowly(ids)

    def _decode_slowly(self, ids: np.ndarray) -> str:
        out, run = [], bytearray()

        def flush():
            at = 0
            while at < len(run):
                for size in range(1, 5):
                    try:
                        out.append(run[at:at + size].decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        first = True
        for i in ids.tolist():
            low, size = self.shown_starts[i], self.shown_sizes[i]
            if self.is_byte[i]:
                run += self.shown[low:low + size].tobytes()
            else:
                flush()
                text = self.shown[low:low + size].tobytes().decode()
                out.append(text[1:] if first and self.leading[i] else text)
            first = first and bool(self.is_control[i])
        flush()
        return "".join(out)


class Encoder:
    """Ids of texts; a task keeps those of the words it has met, up to a number."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.symbol_of = np.arange(CODES, dtype=np.int64) + model.size
        self.symbol_of[model.char_codes] = model.char_ids
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self._forget()

    def _forget(self) -> None:
        self.seen: defaultdict[str, int] = defaultdict()
        self.seen.default_factory = self.seen.__len__
        self.ids = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text without begin and end ids."""
        if len(self.seen) > KNOWN_WORDS:
            self._forget()
        known, places = len(self.seen), []
        for text in texts:
            text = SPACE + text.replace(" ", SPACE) if text else ""
            words = self.words.findall(text) if self.model.spaced else [text] if text else []
            places.append(np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words)))
        if len(self.seen) > known:
            new = list(self.seen)[known:]
            ids, sizes = self.merged(new)
            starts = np.cumsum(sizes) - sizes + len(self.ids)
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, starts])
            self.sizes = np.concatenate([self.sizes, sizes])
        return [self.ids[_ranges(self.starts[p], self.sizes[p])] for p in places]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        cut = np.zeros(len(codes), dtype=bool)
        cut[1:] = ~_in_sorted(self.model.side_by_side, codes[:-1] * CODES + codes[1:])[1]
        cut[np.cumsum(lengths) - lengths] = True
        part = np.cumsum(cut) - 1
        word_of_part = np.repeat(np.arange(len(words)), lengths)[cut]
        symbols, part = self._rounds(self.symbol_of[codes], part)
        symbols, repeats = self._with_bytes(symbols)
        sizes = np.bincount(np.repeat(word_of_part[part], repeats), minlength=len(words))
        return symbols, sizes

    def _pairs(self, symbols: np.ndarray, part: np.ndarray, at: np.ndarray):
        """Rank and product of the pairs that begin at the given places."""
        model = self.model
        rank = np.full(len(at), NONE, dtype=np.int32)
        made = np.zeros(len(at), dtype=np.int64)
        inner = np.flatnonzero(at + 1 < len(symbols))
        inner = inner[part[at[inner]] == part[at[inner] + 1]]
        here = at[inner]
        found, there = _in_sorted(
            model.pairs, symbols[here] * (model.size + CODES) + symbols[here + 1])
        rank[inner[there]] = model.rank[found[there]]
        made[inner[there]] = model.made[found[there]]
        return rank, made

    def _rounds(self, symbols: np.ndarray, part: np.ndarray):
        rank, made = self._pairs(symbols, part, np.arange(len(symbols)))
        done_symbols, done_parts = [], []
        while len(symbols):
            heads = np.flatnonzero(np.diff(part, prepend=-1))
            sizes = np.diff(heads, append=len(symbols))
            least = np.minimum.reduceat(rank, heads)
            stays = np.repeat(least < NONE, sizes)
            if not stays.all():
                done_symbols.append(symbols[~stays])
                done_parts.append(part[~stays])
                symbols, part, rank, made = (a[stays] for a in (symbols, part, rank, made))
                if not len(symbols):
                    break
                sizes, least = sizes[least < NONE], least[least < NONE]
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            # one place at a time where the product may make a pair as good as itself
            first = np.flatnonzero(np.diff(part[at], prepend=-1))
            wary = np.logical_or.reduceat(self.model.eager[made[at]], first)
            if wary.any():
                alone = np.repeat(wary, np.diff(first, append=len(at)))
                alone[first] = False
                at = at[~alone]
            # of places that overlap every other one, from the left
            begins = np.diff(at, prepend=-2) != 1
            order = np.arange(len(at))
            at = at[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, part, rank, made = (a[keep] for a in (symbols, part, rank, made))
            at = at - np.arange(len(at))
            new = np.union1d(at, at[at > 0] - 1)
            rank[new], made[new] = self._pairs(symbols, part, new)
        symbols = np.concatenate([np.zeros(0, np.int64), *done_symbols])
        part = np.concatenate([np.zeros(0, np.int64), *done_parts])
        order = np.argsort(part, kind="stable")
        return symbols[order], part[order]

    def _with_bytes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the ids of their bytes; how many ids each symbol is."""
        model = self.model
        code = symbols - model.size
        repeats = np.ones(len(symbols), dtype=np.int64)
        for low in (0x80, 0x800, 0x10000):
            repeats += code >= low
        out = np.repeat(symbols, repeats)
        odd = np.flatnonzero(code >= 0)
        if len(odd):
            text = "".join(map(chr, code[odd].tolist())).encode("utf-8", "surrogatepass")
            ends = np.cumsum(repeats)
            out[_ranges((ends - repeats)[odd], repeats[odd])] = model.bytes[
                np.frombuffer(text, dtype=np.uint8)]
        return out, repeats


def _steps(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of some ``STEP`` characters; a longer text is a step of its own."""
    low, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > STEP:
            yield low, i
            low, size = i, 0
        size += n
    if low < len(texts):
        yield low, len(texts)


def _encoded(model: PieceModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model.encoder()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in _steps(texts):
                found = encoder.encode([t or "" for t in texts[low:high]])
                ids = [np.concatenate([[model.begin], i, [model.end]]).astype("<u4").tobytes()
                       for i in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(ids, pa.binary())],
                    ["doc_id", "ids"])

    return run


def _decoded(model: PieceModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            texts = [model.decode(np.frombuffer(i, dtype="<u4")) for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(texts)],
                                             ["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, model: PieceModel, text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ids: begin id, ids of the whole text and end id as little-endian
    unsigned 32-bit integers.

    A null text is empty; an empty text has the two ids alone. Null ids and repeated
    rows are documents like others; other columns are left out, whatever their names.
    An empty table gives no rows. A text lies in the memory of its task, with some
    hundred bytes a character of its distinct words.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(_encoded(model), f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, model: PieceModel) -> DataFrame:
    """The rows of ``encode`` with the text that their ids stand for (``decoded``)."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoded(model), f"doc_id {kind}, ids binary, decoded string")
