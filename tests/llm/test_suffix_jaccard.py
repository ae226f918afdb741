import random

import brute
import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm.components import components
from granary.llm.hashing import pack, unpack, word_hashes
from granary.llm.jaccard_join import jaccard_components, prefix_size
from granary.llm.suffix_dedup import common_prefixes, remove_repeats, repeated_starts, two_stage_suffixes

SMALL = [(1, "a" * 50), (2, "a" * 30), (3, None), (4, ""), (5, "abcabcabcabcabcabc"), (6, "é" * 20), (7, "xyz" * 7), (7, "xyz" * 7), (None, "xyz" * 7)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=6))
def test_two_stage_order_and_prefixes(texts):
    raw = b"\0".join(texts) + b"\0"
    text = np.frombuffer(raw, np.uint8)
    wanted = np.flatnonzero(text)
    got = two_stage_suffixes(text, wanted, len(raw)).tolist()
    assert got == sorted(wanted.tolist(), key=lambda i: raw[i:])
    for a, b, n in zip(got, got[1:], common_prefixes(text, np.array(got), 4).tolist(), strict=False):
        assert raw[a : a + n] == raw[b : b + n] and (n == 4 or raw[a : a + n + 1] != raw[b : b + n + 1] or max(a, b) + n >= len(raw))


def test_repeated_starts():
    rng = random.Random(1)
    for _ in range(100):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(5, 50))) for _ in range(rng.randint(1, 6))]
        starts = [rng.randint(1, len(t) - 4) for t in texts]
        seen = [t[i : i + 5] for t, n in zip(texts, starts, strict=True) for i in range(n)]
        for t, n, got in zip(texts, starts, repeated_starts(texts, starts, 5), strict=True):
            assert got.tolist() == [seen.count(t[i : i + 5]) > 1 for i in range(n)]


@pytest.mark.parametrize(("length", "how"), [(400, {}), (400, {"most": 0, "chunk_bytes": 1 << 17}), (37, {"most": 2, "per_range": 500, "chunk_bytes": 1 << 16})])
def test_remove_repeats_whole_table(spark, duck, length, how):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    got = sorted(map(tuple, remove_repeats(spark.read.parquet(f"{SF}/documents.parquet"), length=length, **how).collect()), key=str)
    assert got == brute.repeats(rows, length)


@pytest.mark.parametrize("how", [{}, {"most": 0}])
def test_remove_repeats_edges(spark, how):
    df = spark.createDataFrame([(*r, 0) for r in SMALL], "doc_id long, text string, Text int")
    got = remove_repeats(df, length=8, keep_bytes=True, **how)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute.repeats(SMALL, 8)
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in got.collect())
    assert remove_repeats(df.limit(0), length=8).collect() == []


def test_a_passage_shorter_than_the_length_stays(spark, duck):
    """Benchmark passages of over 50 words have under 400 bytes: quoted twice they stay at 400, and go whole at the length of the shortest."""
    passages = [t for (t,) in duck.execute("SELECT text FROM benchmark").fetchall() if len(t.split()) > 50]
    sizes = [len(t.encode()) for t in passages]
    assert passages and max(sizes) < 400
    rng = random.Random(8)
    passages += ["".join(rng.choice("abc ") for _ in range(n)) for n in (399, 400)]
    rows = [(2 * i + j, f"{before}{t}{after}") for i, t in enumerate(passages) for j, (before, after) in enumerate(("ik", "jl"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in remove_repeats(df).collect()}
    assert got == {i: 400 * (i // 2 == len(passages) - 1) for i, _ in rows}
    got = {r.doc_id: r.n_removed for r in remove_repeats(df, length=min(sizes)).collect()}
    assert got == {i: len(t.encode()) - 2 for i, t in rows}


def test_a_hot_stretch_weighs_one_entry_a_chunk(spark):
    """Runs of one byte have as many anchors as bytes, all of one stretch; a passage in all texts has as many stretches as texts."""
    from pyspark.sql import functions as F

    from granary.llm import suffix_dedup as S

    df = spark.createDataFrame([(i, "a" * 20_000) for i in range(4)], "row_id long, text string").select("row_id", F.col("text").cast("binary").alias("raw"))
    sent = S._send(S._chunks(df.coalesce(1), 1 << 30), 400, 4).collect()
    assert [(len(r.copies), bytes(r.copies)) for r in sent] == [(1, b"\2")]
    rng = random.Random(3)
    passage = " ".join(str(rng.random()) for _ in range(12))
    rows = [(i, f"{rng.random()} {passage} {rng.random()}") for i in range(60)] + [(99, "a" * 3000), (98, "b" + "a" * 1000)]
    for most in (256, 10):
        got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), length=100, most=most, per_range=20, per_sort=10)
        assert sorted(map(tuple, got.collect()), key=str) == brute.repeats(rows, 100)


def test_frames_of_a_size():
    import pandas as pd

    from granary.llm.common import pooled

    rng = random.Random(4)
    for limit in (1, 5, 20, 1000):
        batches = [pd.DataFrame({"n": [rng.randrange(12) for _ in range(rng.randrange(9))]}) for _ in range(6)]
        frames = list(pooled(iter(batches), lambda b: b["n"], limit))
        assert [n for f in frames for n in f["n"]] == [n for b in batches for n in b["n"]]
        assert all(len(f) and (f["n"].sum() <= limit or len(f) == 1) for f in frames)
        assert all(a["n"].sum() + b["n"].iloc[0] > limit for a, b in zip(frames, frames[1:], strict=False))


def test_messages_grow_with_the_input():
    from granary.llm import jaccard_join as J
    from granary.llm.common import UNIT_BYTES, root_sized

    def messages(size):
        chunks = size / root_sized(J.CHUNK_BYTES, J.MOST_CHUNK_BYTES, size, UNIT_BYTES)
        return chunks * (size / UNIT_BYTES * J.UNIT_WORDS / root_sized(J.KEYS_PER_RANGE, J.MOST_PER_RANGE, size / UNIT_BYTES * J.UNIT_WORDS, J.UNIT_WORDS))

    assert messages(5 * UNIT_BYTES) == pytest.approx(5 * messages(UNIT_BYTES), rel=0.01)


@pytest.mark.parametrize(("k", "percent", "how"), [(4, 85, {}), (5, 80, {"block": 5, "chunk_bytes": 1 << 18}), (3, 50, {"block": 7})])
def test_jaccard_whole_table(spark, duck, k, percent, how):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    got = jaccard_components(spark.read.parquet(f"{SF}/documents.parquet"), words=k, percent=percent, **how)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got.collect()} == brute.jaccard(rows, k, percent)


def test_jaccard_of_a_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        w = base[:]
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(60)] = f"x{rng.randrange(500)}"
        rows.append((i, " ".join(w)))
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), block=40)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got.collect()} == brute.jaccard(rows, 4, 85)


def test_jaccard_of_a_large_group_of_many_sizes(spark):
    """Documents with one rare token in common, from a few words to hundreds: blocks of far levels never meet, and no link is lost."""
    rng = random.Random(6)
    rows, base = [], [f"w{i}" for i in range(400)]
    for i in range(260):
        n = int(4 * 1.02 ** rng.randint(0, 220))
        rows.append((i, " ".join(["r a r e", *base[: max(1, n - rng.randint(0, 2))]])))
    for percent, block in ((85, 20), (60, 9), (100, 15)):
        got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent, block=block)
        assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got.collect()} == brute.jaccard(rows, 4, percent)


def test_jaccard_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A  b"), (6, "b a"), (9, "x"), (8, "x"), (8, "x"), (None, "q r s t u"), (10, "q r s t u"), (11, "word " * 5000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id int, text string, DOC_ID string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (9, 1, 8), (8, 1, 8), (8, 1, 8), (None, 2, None), (10, 2, None), (11, 1, 11)], key=str)
    assert jaccard_components(df.limit(0)).collect() == []


def test_jaccard_of_ids_with_several_texts(spark):
    text = lambda c, last="z": " ".join(f"{c}{i}" for i in range(60)) + f" {last}"
    rows = [(None, text("x")), (7, text("x")), (9, text("x", "y")), (None, text("y")), (8, text("y", "x")), (20, text("a")), (20, text("b")), (21, text("b", "y")), (30, text("a", "y")), (31, text("c")), (40, ""), (40, text("c")), (41, "")]
    for turn in range(3):
        df = spark.createDataFrame(rows[turn * 4 :] + rows[: turn * 4], "doc_id long, text string")
        got = sorted(((r.doc_id, r.component_id, r.n_links) for r in jaccard_components(df).collect()), key=str)
        want = [(None, None, 2), (7, None, 2), (9, None, 2), (None, None, 1), (8, None, 1), (20, 20, 1), (20, 20, 1), (21, 20, 1), (30, 20, 1), (31, 31, 1), (40, 31, 0), (40, 31, 1), (41, 41, 0)]
        assert got == sorted(want, key=str)


def test_prefix_size_is_safe():
    for n in range(1, 200):
        for percent in (50, 80, 85, 100):
            assert prefix_size(n, percent) == n - min(o for o in range(n + 1) if 100 * o >= percent * n) + 1


def test_components(spark):
    rng = random.Random(2)
    for edges in ([(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 60)], [(rng.randrange(100), rng.randrange(100)) for _ in range(70)], [(3, 3)]):
        parent = {x: x for e in edges for x in e if e[0] != e[1]}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a != b:
                a, b = sorted((find(a), find(b)))
                parent[b] = a
        assert dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect())) == {x: find(x) for x in parent}


def test_word_hashes():
    texts = ["A b\x0bc", None, "", " x", "a" * 50 + " " + "a" * 51, "B\nC a", "é É"]
    h, n = word_hashes(texts)
    assert n.tolist() == [3, 0, 0, 1, 2, 3, 2]
    words = [w for t in texts for w in brute.WORD.findall((t or "").translate(brute.LOW))]
    assert len({*zip(h.tolist(), words, strict=True)}) == len(set(words)) == len(set(h.tolist()))
    assert unpack(pack(h), np.uint64).tolist() == h.tolist()
