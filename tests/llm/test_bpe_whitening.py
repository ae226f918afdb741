import hashlib
import random

import numpy as np
import pytest
import tiktoken
from conftest import SF

from granary.llm import byte_bpe as B
from granary.llm import whitening as W

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = [*"  \n\t'''sstremvdllLA1!?,é中١  \x1c\x85😀̈　", "'re", "'ll", "\n\n", "   "]


@pytest.fixture(scope="module")
def whole():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(RANKS), special_tokens={}).encode_ordinary


def test_bpe_whole_table(spark, whole, duck):
    got = {r.doc_id: tuple(r)[1:] for r in B.op12_byte_bpe(spark, SF).collect()}
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(got) == len(rows)
    for i, text in rows:
        ids = whole(text or "")
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4")).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_bpe_of_random_texts_over_many_chunks(spark, whole):
    """Kinds of characters, suffixes, white space of all kinds, empty, null, repeated and very long texts; ids of text; clashing columns."""
    rng = random.Random(5)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "", "'s", "a's's 're", " " * 3000, "x" * 50_000, "<|endoftext|>", texts[0]]
    rows = [(None if i == 7 else i, t, "1", "2") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, TEXT string, ids string").repartition(5)
    encoded = B.encode(df, RANKS, chunk_chars=2000)
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in B.decode(encoded, RANKS).collect()}
    assert got == {i: (whole(t or ""), (t or "").encode()) for i, t, *_ in rows}
    named = B.encode(spark.createDataFrame([("p", "a b"), ("q", None), (None, "a b")], "doc_id string, text string"), RANKS)
    assert {r.doc_id: r.ids for r in named.collect()} == {"p": whole("a b"), "q": [], None: whole("a b")}
    assert B.decode(B.encode(df.limit(0), RANKS), RANKS).collect() == []


def test_each_distinct_word_is_encoded_once(monkeypatch):
    asked = []

    class Counted:
        def encode_ordinary(self, word):
            asked.append(word)
            return [1]

    monkeypatch.setattr(B, "_encoding", lambda path: Counted())
    import pandas as pd

    messages = [B._bytes_of([b"a", b" b"]), B._bytes_of([b" b", b"c", b"a"])]
    out = B._encode_range(pd.DataFrame({"range": [0, 0], "chunk": [1, 2], "words": messages}), "")
    assert sorted(asked) == [" b", "a", "c"] and len(out) == 2


def test_words_of_one_hash_are_told_apart(monkeypatch):
    plain, seeds = B._hashes, []

    def collides(buffer, starts, sizes, seed=0):
        seeds.append(seed)
        return np.zeros(len(starts), np.uint64) if seed < 2 else plain(buffer, starts, sizes, seed)

    monkeypatch.setattr(B, "_hashes", collides)
    words, codes, n = B.words_of(["a b", "b"])
    assert seeds == [0, 1, 2] and [words[c] for c in codes] == [b"a", b" b", b"b"] and n.tolist() == [2, 1]


def test_decoding_unknown_ids_fails(spark):
    assert B.decode_ids(np.array([], np.int64), RANKS) == b""
    for ids in ([50256], [-1], [1 << 30]):
        with pytest.raises(KeyError):
            B.decode_ids(np.array(ids), RANKS)
    df = spark.createDataFrame([([220], "x"), (None, "y")], "ids array<int>, decoded string")
    assert B.decode(df, RANKS, to="bytes").collect()[1]["bytes"] is None


def check_whitening(got, vectors, components=32):
    """Of {id: vector}: the contract's columns against numpy."""
    x = np.floor(64 * np.array(list(vectors.values()), float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    deviation = {i: sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s, strict=True)) for i, row in zip(vectors, x, strict=True)}
    assert all(r.n == n and r.deviation == deviation[r.vec_id] for r in got)
    e = np.linalg.eigvalsh(np.cov((x - s / n).T, bias=True))[::-1]
    k = min(components, int((e > e[0] * 1e-12).sum()))
    assert {r.component for r in got} == set(range(1, k + 1)) and len(got) == n * k
    assert all(r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9) for r in got)
    w = np.zeros((n, k))
    at = {i: j for j, i in enumerate(vectors)}
    for r in got:
        w[at[r.vec_id], r.component - 1] = r.whitened
    error = np.abs(np.cov(w.T, bias=True) - np.eye(k)).max()
    assert error < 1e-9 and all(r.identity_error < 1e-9 for r in got)


def test_whitening_whole_table(spark, duck):
    check_whitening(W.op13_whitening(spark, SF).collect(), dict(duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall()))


def test_whitening_leaves_out_broken_vectors(spark):
    rng = np.random.default_rng(1)
    good = {i: rng.normal(size=3).tolist() for i in range(30)}
    good[30] = good[0]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1e300, 0.0, 0.0], [1.0, 2.0]]
    rows = [*good.items(), *((100 + i, v) for i, v in enumerate(bad))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, EMBEDDING string").repartition(4)
    check_whitening(W.whiten(df).collect(), good)
    check_whitening(W.whiten(df, components=2).collect(), good, 2)


def test_whitening_of_few_directions(spark):
    line = {i: [float(i), 2.0 * i, 0.0] for i in range(8)}
    df = spark.createDataFrame(list(line.items()), "vec_id long, embedding array<float>")
    check_whitening(W.whiten(df).collect(), line)
    same = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert W.whiten(same).collect() == []
    assert W.whiten(df.limit(0)).collect() == []
    named = W.whiten(spark.createDataFrame([("a", [0.0]), ("b", [1.0]), (None, [2.0])], "vec_id string, embedding array<float>")).collect()
    assert {r.vec_id for r in named} == {"a", "b", None}


def test_deviation_beyond_a_long_is_null():
    w = W.Whitening(10**10, (10**16, 0), np.zeros((2, 0)), np.zeros(0))
    assert w.deviation(np.array([[10**6, 0], [10**6 + 1, 0], [2 * 10**6, 5]])) == [0, None, None]
    assert W.Whitening(10, (15, 0), np.zeros((2, 0)), np.zeros(0)).deviation(np.array([[1, 2]])) == [25 + 400]
