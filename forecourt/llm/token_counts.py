"""Word-piece lengths by a linear longest-match automaton.

Greedy word pieces take the longest vocabulary entry that begins the rest of the
word, again and again. A trie of the entries with failure links does that in one
pass over the characters: where the trie has no way on, the link leads to the
node for what is left after the pieces that are certain by then are popped, and
their number was worked out when the trie was built. No piece is ever built.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN_WORDS = 500_000
# Fixed value: the mark that begins a word in the vocabulary.
MARK = "▁"


class LongestMatch:
    """Number of greedy longest-match pieces of a word over a vocabulary.

    ``mark`` is put before every word; entries that begin with it match only there
    (or where a text has the mark itself).
    """

    def __init__(self, pieces: Iterable[str], mark: str = MARK):
        self.mark = mark
        ways: list[dict[str, int]] = [{}]
        entry = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in ways[node]:
                    ways[node][c] = len(ways)
                    ways.append({})
                    entry.append(False)
                node = ways[node][c]
            entry[node] = entry[node] or node > 0
        # link[v]: node for what is left of v's string, -1 if nothing can be popped;
        # popped[v]: pieces popped on the way there
        link, popped = [-1] * len(ways), [0] * len(ways)
        level = [0]
        while level:
            below = []
            for u in level:
                for c, v in ways[u].items():
                    below.append(v)
                    if entry[v]:
                        link[v], popped[v] = 0, 1
                        continue
                    z, count = link[u], popped[u]
                    while z >= 0 and c not in ways[z]:
                        count += popped[z]
                        z = link[z]
                    if z >= 0:
                        link[v], popped[v] = ways[z][c], count
            level = below
        self.ways, self.link, self.popped = ways, link, popped

    def count(self, word: str) -> int:
        """Pieces of one word; 0 if its characters can't all be matched."""
        ways, link, popped = self.ways, self.link, self.popped
        node = count = 0
        for c in self.mark + word:
            while c not in ways[node]:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return 0
            node = ways[node][c]
        while node:
            count += popped[node]
            node = link[node]
            if node < 0:
                return 0
        return count


def _counted(automaton: LongestMatch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            words_of, tokens_of, unknown_of = [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()
                tokens = unknown = 0
                for word in words:
                    n = known.get(word)
                    if n is None:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        n = known[word] = automaton.count(word.decode())
                    if n:
                        tokens += n
                    else:
                        unknown += 1
                words_of.append(len(words))
                tokens_of.append(tokens + unknown)
                unknown_of.append(unknown)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words_of, pa.int64()),
                 pa.array(tokens_of, pa.int64()), pa.array(unknown_of, pa.int64())],
                ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return run


def token_counts(docs: DataFrame, automaton: LongestMatch, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every row.

    A word without a full match is one unknown token. Null and empty texts have
    no words. Every row, repeated or without id, gives one row; other columns are
    not read; an empty table gives an empty result.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _counted(automaton), f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
