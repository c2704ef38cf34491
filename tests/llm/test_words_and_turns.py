"""Spelling variants, SentencePiece ids and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from conftest import rows
from forecourt.llm import prefix_trie, queries, sentence_pieces, spelling

SF = "/root/testdata/sf0.001"
A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# --- spelling variants ---

def damaged(docs):
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            yield run


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(occurrences):
    n = {w: k for w, k in Counter(occurrences).items() if k >= 2}
    by_rest = defaultdict(set)  # words that are equal without one of their letters
    for w in n:
        by_rest[w].add(w)
        for i in range(len(w)):
            by_rest[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in by_rest.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return sorted(out)


def got_variants(df):
    return sorted(tuple(r) for r in df.select(
        "word", "n", "n_near", "form", "form_n", "root").collect())


def test_spelling_variants_of_the_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = variants(w for w in damaged((r.doc_id, r.text) for r in docs.collect()) if len(w) >= 7)
    assert any(w[3] for w in want)
    assert got_variants(queries.op11_spelling_variants(spark, "/root/testdata/sf0.01")) == want


def test_spelling_variants_of_runs_and_chains(spark):
    """Runs of equal letters, edits at the borders of quarters, ties, chains of forms."""
    rng = random.Random(3)
    words = {"".join(rng.choices("ab", k=rng.randint(7, 10))) for _ in range(300)}
    words |= {"aaaaaaa" + "a" * i for i in range(30)} | {"éééééééé", "ééééééé", "éééééééè"}
    counts = {w: rng.choice([1, 2, 2, 3, 30, 40, 500]) for w in sorted(words)}
    chain = ["zzzzzzz", "zzzzzzy", "zzzzzxy", "zzzzwxy"]
    counts |= {w: 2 * 10 ** i for i, w in enumerate(chain)}
    frame = spark.createDataFrame([(w, k) for w, k in counts.items()], "word string, k int")
    spread = frame.select(F.explode(F.array_repeat("word", F.col("k"))).alias("word"))
    want = variants(w for w, k in counts.items() for _ in range(k))
    assert {w[5] for w in want if w[0] in chain} == {chain[-1]}
    assert got_variants(spelling.spelling_variants(spread.repartition(5))) == want


def test_short_words_pair_as_well(spark):
    """The pairs need no least length: words of no and of few letters."""
    texts = ["", "a", "b", "ab", "ba", "abc", "bc", "abd", "aa", "aaa"]
    frame = spark.createDataFrame([(t, 2) for t in texts], "word string, n long")
    got = rows(spelling.near_pairs(frame).select("word", "other"))
    want = sorted(tuple(sorted((a, b), key=lambda w: (len(w), w)))
                  for i, a in enumerate(texts) for b in texts[i + 1:] if one_edit(a, b))
    assert got == want


def test_odd_texts_have_words_or_none(spark):
    docs = [(1, None), (2, ""), (None, "Wörtern ÀÉÎÕÜÿß xWORTERNx"), (3, "abcdefg abcdefg"),
            (3, "abcdefg abcdefg"), (4, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999)]
    schema = "doc_id long, text string, word string, n long, key long, id string"
    frame = spark.createDataFrame([(*d, "q", 1, 2, "i") for d in docs], schema)
    got = rows(spelling.damaged_words(frame))
    assert got == sorted((w,) for w in damaged(docs) if len(w) >= 7)
    want = variants(w for (w,) in got)
    assert got_variants(spelling.spelling_variants(spelling.damaged_words(frame))) == want
    empty = spark.createDataFrame([], schema)
    assert spelling.spelling_variants(spelling.damaged_words(empty)).count() == 0
    nulls = spark.createDataFrame([(None,), (None,)], "word string")
    assert spelling.spelling_variants(nulls).count() == 0


# --- SentencePiece ---

@pytest.fixture(scope="module")
def content():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def pieces(content):
    return sentence_pieces.PieceModel(content)


@pytest.fixture(scope="module")
def library(content):
    return sentencepiece.SentencePieceProcessor(model_proto=content)


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b", "e", "th", "▁", " ", "  ", "\n", "é", "日", "①", "=", "-", "0", "1", ".",
             "<", "0x41", "<s>", "<0x0A>", "́", "😀", "\t", "in", "ing", "The", "\x00", "ﬁ"]
    mixed = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(n)]
    wide = ["".join(chr(rng.choice([rng.randint(1, 0x7F), rng.randint(1, 0x2FFF),
                                    rng.randint(0xE000, 0x10FFFF)]))
                    for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*mixed, *wide, "", " ", "▁", "=" * 3000, "a" * 3001, " " * 501,
            "".join(rng.choices("etaoin", k=20_000))]


def test_ids_and_texts_equal_the_library(pieces, library):
    texts = odd_texts(1, 3000)
    got = pieces.encoder().encode(texts)
    want = library.encode(texts)
    assert [g.tolist() for g in got] == want
    framed = [[1, *i, 2] for i in want]
    assert [pieces.decode(np.array(i)) for i in framed] == [library.decode(i) for i in framed]


def test_any_ids_decode_like_the_library(pieces, library):
    """Bytes that are no characters, unknown and control ids anywhere."""
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.randrange(600) if rng.random() < 0.5 else rng.randrange(32_000)
               for _ in range(rng.randint(0, 12))]
        assert pieces.decode(np.array(ids, dtype=np.int64)) == library.decode(ids), ids


def test_one_merge_at_a_time_where_a_product_may_be_first(pieces, library):
    """Words of a vocabulary's own pieces, where merged pieces compete."""
    rng = random.Random(4)
    eager = [library.id_to_piece(int(i)) for i in np.flatnonzero(pieces.eager)]
    texts = ["".join(rng.choices(eager, k=4)).replace("▁", " ") for _ in range(5000)]
    texts += ["".join(rng.choices(eager, k=1)) * 7 for _ in range(2000)]
    assert [g.tolist() for g in pieces.encoder().encode(texts)] == library.encode(texts)


def test_known_words_may_be_forgotten(pieces, library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "KNOWN_WORDS", 5)
    encoder, texts = pieces.encoder(), odd_texts(5, 40)
    assert [encoder.encode([t])[0].tolist() for t in texts] == library.encode(texts)


def test_other_models_are_an_error():
    from sentencepiece import sentencepiece_model_pb2 as proto
    with pytest.raises(ValueError):
        sentence_pieces.PieceModel(proto.ModelProto().SerializeToString())


def test_sentence_piece_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op12_sentence_pieces(spark, SF).collect()}
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_bos=True, add_eos=True)
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_rows(spark, pieces, library):
    texts = [(1, None), (None, ""), (2, "word " * 200_000), (2, "same"), (2, "same"), (3, "é①")]
    frame = spark.createDataFrame(
        [(*t, b"x", "y") for t in texts], "doc_id long, text string, ids binary, decoded string")
    got = sentence_pieces.decode(sentence_pieces.encode(frame, pieces), pieces).collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    want = []
    for doc_id, text in texts:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((doc_id, np.array(ids, dtype="<u4").tobytes(), library.decode(ids)))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    none = spark.createDataFrame([], frame.schema)
    assert sentence_pieces.encode(none, pieces).count() == 0


# --- prefix trie ---

def trie(turns):
    """Nodes as the contract words them, from (conv_id, turn, role, text) rows."""
    original = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            original[conv].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in original.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(c - c % 5, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = Counter(), Counter()
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        saved[node] += own
        leaves[node] += not children[node]
        if node:
            saved[node[:-1]] += saved[node]
            leaves[node[:-1]] += leaves[node]
    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def got_trie(df):
    return sorted((tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256").collect()), key=str)


def turns_of(spark, path):
    return [tuple(r) for r in spark.read.parquet(path).select(
        "conv_id", "turn", "role", "text").collect()]


def test_trie_of_the_test_conversations(spark):
    want = trie(turns_of(spark, "/root/testdata/sf0.01/conversations.parquet"))
    assert got_trie(queries.op13_prefix_trie(spark, "/root/testdata/sf0.01")) == want


TURNS = "conv_id long, turn long, role string, text string, node string, depth long, last boolean"


def frame_of(spark, turns, parts=5):
    return spark.createDataFrame([(*t, "x", 1, True) for t in turns], TURNS).repartition(parts)


@pytest.mark.parametrize("shares", [2, 20, 100_000])
def test_trie_of_shared_turns(spark, shares):
    """A hot first turn, copies of one conversation, missing bases, short and long ones:
    all nodes large, some, or hardly any."""
    rng = random.Random(7)
    turns = []
    for c in range(0, 700):
        if rng.random() < 0.1:
            continue
        if c % 3 == 0:
            seq = [("user", "hot"), ("bot", "hot too"), ("user", str(rng.randint(0, 3)))]
        elif c % 7 == 0:
            seq = [("user", "copy")] * 6
        else:
            seq = [("user", rng.choice("abé")) for _ in range(rng.randint(1, 12))]
        turns += [(c, i, *t) for i, t in enumerate(seq)]
    turns += [(1001, i, "user", rng.choice("ab")) for i in range(300)]
    assert got_trie(prefix_trie.prefix_trie(frame_of(spark, turns), shares=shares)) == trie(turns)


def test_trie_of_odd_rows(spark):
    turns = [(None, 1, "user", "lost"), (0, None, None, None), (0, 1, "", ""), (0, 3, "a", "bc"),
             (1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "user", "é" * 100_000),
             (5, 0, "u", "t"), (5, 1, "u", "t"), (7, 0, "u", "t"), (14, 0, "u", "alone"),
             (-3, 0, "u", "below zero"), (-5, 0, "u", "base below zero")]
    assert got_trie(prefix_trie.prefix_trie(frame_of(spark, turns))) == trie(turns)
    assert prefix_trie.prefix_trie(frame_of(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(frame_of(spark, [(None, 1, "u", "t")])).count() == 0


def test_equal_turns_have_one_order(spark):
    turns = [(0, 0, "u", "b"), (0, 0, "u", "a"), (0, 0, "u", "a"), (0, 1, "u", "c")]
    results = [got_trie(prefix_trie.prefix_trie(frame_of(spark, t, p)))
               for t, p in ((turns, 1), (turns[::-1], 3), (turns[2:] + turns[:2], 4))]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 5


def test_queue_spills_and_keeps_the_order():
    rng = random.Random(1)
    queue = prefix_trie.SpillingQueue(limit=10, chunk=3)
    entries = [((rng.randint(0, 50), b"k"), (i,)) for i in range(3000)]
    for key, entry in entries:
        queue.push(key, entry)
    assert queue.runs and len(queue.heap) <= 10 and len(queue.runs) <= prefix_trie.RUNS + 1
    for k in range(51):
        want = sorted(e for key, e in entries if key[0] == k)
        assert sorted(queue.pop((k, b"k"))) == want
    assert not queue


def test_totals_through_a_spilling_queue():
    """The pass gives the same totals when nearly every message is spilled."""
    rng = random.Random(2)
    names, parent = [prefix_trie.ROOT], {}
    depth = {prefix_trie.ROOT: 0}
    for i in range(1, 800):
        name, above = i.to_bytes(16, "big"), rng.choice(names[-300:])
        parent[name], depth[name] = above, depth[above] + 1
        names.append(name)
    rng.shuffle(names)
    order = sorted(names, key=lambda v: (-depth[v], v))
    nodes = [(v, parent.get(v), depth[v], 1, 2, 3, depth[v] == 0, 0, 0, 0) for v in order]
    plain = sorted(prefix_trie._totals_of(iter(nodes)), key=str)
    assert sorted(prefix_trie._totals_of(iter(nodes), limit=3), key=str) == plain
    root = next(r for r in plain if r[0] == prefix_trie.ROOT)
    assert root[7] == 3 * 800
    assert root[6] == len(set(names) - set(parent.values()))
