import random
import struct
import zlib

import brute
import numpy as np
import pytest
from conftest import SF
from tokenizers import Tokenizer

from granary.llm import language_model as L
from granary.llm import quality as Q
from granary.llm.decontaminate import contaminated, op5_decontaminate, smith_waterman
from granary.llm.packing import PieceEncoder, pack, plan_packing

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_language_model_base_and_held_out(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    got = {r.doc_id: r for r in L.language_scores(spark.read.parquet(f"{SF}/documents.parquet"), chunk_bytes=1 << 17).collect()}
    for i, held, n, known, total, base in brute.base_scores(rows):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_scores_and_weights(spark, duck):
    """Scores against plain counts of all trigrams and the same weights; the weights against expectation-maximisation over single observations."""
    import brute

    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    train = {0, 1, 4, 5, 6}
    counts, everything = brute.ngram_counts(rows, train), brute.ngram_counts(rows, train | {3})
    tokens, vocabulary = sum(counts[0].values()), len(counts[0])
    second, triple, context, pair, token = np.concatenate(list(brute.ngram_places(rows, counts, {3}).values())).T
    b = L.bucket(context, second)
    ratios = L.ratio(triple, second), L.ratio(pair, context)
    weights = L.learn_weights(L.cells(b, *ratios, token), tokens, vocabulary)
    exact = np.concatenate((np.tile([0, 0.5, 0.4, 0.1], (66, 1)), np.tile([0.4, 0.3, 0.2, 0.1], (66, 1))))
    exact[0] = [0, 0, 0.5, 0.5]
    p = L.estimates(*ratios, token, tokens, vocabulary)
    for _ in range(60):
        share = exact[b] * p
        share /= share.sum(axis=1)[:, None]
        seen = np.stack([np.bincount(b, weights=x, minlength=132) for x in share.T], axis=1)
        for own in (slice(1, 66), slice(66, 132)):
            every = seen[own].sum(axis=0) / seen[own].sum()
            exact[own] = (seen[own] + 100 * every) / (seen[own].sum(axis=1) + 100)[:, None]
        if seen[0].sum():
            exact[0] = seen[0] / seen[0].sum()
    assert np.abs(weights - exact)[np.unique(b)].max() < 0.03
    total, distinct = sum(everything[0].values()), len(everything[0])
    got = {r.doc_id: r.score for r in L.language_scores(spark.read.parquet(f"{SF}/documents.parquet"), chunk_bytes=1 << 18).collect()}
    sums = {}
    for i, own in brute.ngram_places(rows, everything, set(range(7))).items():
        second, triple, context, pair, token = own.T
        p = L.estimates(L.ratio(triple, second), L.ratio(pair, context), token, total, distinct)
        sums[i] = [np.log10((w[L.bucket(context, second)] * p).sum(axis=1)).sum() for w in (weights, exact)]
        assert got[i] == pytest.approx(sums[i][0], rel=1e-9, abs=1e-6)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(sums[i][0] for i in held) == pytest.approx(sum(sums[i][1] for i in held), rel=1e-3)


def test_language_model_edges(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (2, ""), (3, " \n"), (4, "x" * 3000 + " y " * 1000), (5, "É é A a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, TEXT int")
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in L.language_scores(df).collect()), key=str)
    assert got == sorted(((i, n, known, round(b, 6)) for i, _, n, known, _, b in brute.base_scores(rows)), key=str)
    assert L.language_scores(df.limit(0)).collect() == []
    named = spark.createDataFrame([("p", "a"), ("q", None)], "doc_id string, text string")
    assert sorted(r.doc_id for r in L.language_scores(named).collect()) == ["p", "q"]


def test_weights_are_probabilities_and_prefer_what_predicts():
    rng = np.random.default_rng(0)
    b, ratios = rng.integers(0, 132, 500), [rng.random(500) * (rng.random(500) < 0.7) for _ in range(2)]
    w = L.learn_weights(L.cells(b, *ratios, rng.integers(0, 80, 500).astype(float)), 10_000, 1000)
    assert np.allclose(w.sum(axis=1), 1) and (w >= 0).all() and not w[:66, 0].any()
    sure, none, ones = np.full(10_000, 5), np.zeros(10_000), np.ones(10_000)
    assert L.learn_weights(L.cells(sure, none, ones, 2 * ones), 10_000, 1000)[5, 1] > 0.95
    assert L.learn_weights(L.cells(sure + 66, ones, 0.01 * ones, 2 * ones), 10_000, 1000)[71, 0] > 0.95
    assert len(L.learn_weights(L.cells(sure[:0], none[:0], ones[:0], ones[:0]), 0, 0)) == 132


def test_packing_plan():
    rng = random.Random(4)
    for cap in (10, 16, 1024):
        for _ in range(30):
            counts = {}
            for _ in range(rng.choice([1, 40, 3000])):
                n = rng.randint(1, cap) if rng.random() < 0.6 else min(cap, 1 + int(rng.expovariate(8 / cap)))
                counts[n] = counts.get(n, 0) + 1
            places, used = plan_packing(counts, cap)
            bins, placed = {}, {}
            for n, first_rank, pieces, first, each, offset in places:
                assert first_rank == placed.get(n, 0)
                placed[n] = first_rank + pieces
                for i in range(pieces):
                    bins.setdefault(first + i // each, []).append((offset + i % each * n, n))
            assert placed == counts and len(bins) == used
            for own in bins.values():
                end = 0
                for at, n in sorted(own):
                    assert at == end
                    end += n
                assert end <= cap and sum(3 * n > cap for _, n in own) <= 2
            total = sum(n * c for n, c in counts.items())
            assert used <= 2 + 1.25 * max(total / cap, sum(c for n, c in counts.items() if 2 * n > cap))


def test_encoder_equals_tokenizer(duck):
    tokenizer, encode = Tokenizer.from_file(BPE), PieceEncoder(BPE)
    texts = [t for (t,) in duck.execute("SELECT text FROM documents").fetchall()]
    texts += ["", "a b  c \n\n x", "it's I'LL we'll 12a3 ²³ x\t\ty  ", "   ", "\r\n \r\n", "<|endoftext|> a", "ÿĀɏ×÷ª º ab", "日本 text", "a\x1cb\x85c", "''s's 's", "ǅ ʰ", "x   \n", "½ ¼", "\xa0x\xadx"]
    for t in texts:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        assert encode.encode(t) == struct.pack(f"<{len(ids)}I", *ids), t[:40]


def test_pack_whole_table_and_edges(spark, duck):
    rows = [*duck.execute("SELECT doc_id, text FROM documents").fetchall(), (None, None), (-1, ""), (-2, "word " * 3000), (-2, "word " * 3000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, Doc_Id int").repartition(3)
    got = pack(df, BPE).collect()
    tokenizer = Tokenizer.from_file(BPE)
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        at, n = 0, (len(ids) - 1) % 1024 + 1
        for piece in range(-(-len(ids) // 1024)):
            want.append((i, piece, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            at, n = at + n, 1024
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        end = 0
        for at, n in sorted(own):
            assert at == end
            end += n
        assert end <= 1024
    assert len(bins) <= 1.02 * -(-sum(w[3] for w in want) // 1024) + 1
    assert pack(df.limit(0), BPE).collect() == []


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q.op3_quality_rules(spark, d).collect()}
    held = [(got[r.doc_id].predicted, r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())


def test_rules_as_column_equal_rules_in_numpy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = Q.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = Q.with_statistics(docs, docs["text"]).select("_statistics.*", model.column().alias("score")).toPandas()
    assert np.allclose(model.score(rows[list(Q.FEATURES)].to_numpy()), rows["score"])
    assert model.rules and all(len(r) <= Q.DEPTH for r, _ in model.rules)


def test_quality_edges(spark):
    schema = "doc_id long, text string, TEXT string"
    docs = spark.createDataFrame([(None, None, "x"), (1, "", "x"), (1, " \n", "x"), (2, "w " * 100_000, "x")], schema)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.fit_quality(docs, labels)
    got = Q.score_quality(docs, model).collect()
    assert [r.score for r in got] == [0.5] * 4 and [r.predicted for r in got] == [1] * 4
    assert Q.score_quality(docs.limit(0), model).collect() == []
    one = Q.RuleModel.fit(np.zeros((3, len(Q.FEATURES))), np.ones(3))
    assert 0.99 < one.score(np.zeros((1, len(Q.FEATURES))))[0] <= 1


def test_lasso_drops_useless_rules():
    rng = np.random.default_rng(1)
    z = rng.integers(0, 2, (2000, 20)).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(4 * z[:, 0] - 2)))).astype(float)
    b, w = Q.lasso_logistic(z, y, 0.02)
    assert w[0] > 1 and (np.abs(w[1:]) < 1e-6).sum() >= 15


def test_smith_waterman_against_plain():
    rng = random.Random(3)
    for _ in range(60):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in "ab")
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        score, start, end = smith_waterman(np.array(a), np.array(b))
        assert score == max(map(max, h)) and 0 <= start <= end <= len(b)
        if score:
            assert smith_waterman(np.array(a), np.array(b[start:end]))[0] == score


def test_decontaminate(spark, duck):
    planted = duck.execute("SELECT d.doc_id, b.item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)").fetchall()
    got = op5_decontaminate(spark, SF).collect()
    assert set(planted) <= {(r.doc_id, r.item_id) for r in got}
    assert len({r.doc_id for r in got}) <= len({i for i, _ in planted}) + 2
    items = dict(duck.execute("SELECT item_id, text FROM benchmark WHERE length(text) > 150").fetchall())
    i, j, k = sorted(items)[:3]
    cut = " ".join(w for n, w in enumerate(items[i].split()) if n % 7 != 3)
    new = " ".join(w if n % 5 != 2 else "zzz" for n, w in enumerate(items[j].split()))
    rows = [(1, cut), (2, f"aa bb {new} cc"), (3, None), (4, ""), (5, items[k].upper()), (5, items[k].upper()), (None, items[k]), (6, "clean words " * 50)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, TEXT int")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert sorted(((r.doc_id, r.item_id) for r in contaminated(df, bench).collect()), key=str) == sorted([(1, i), (2, j), (5, k), (5, k), (None, k)], key=str)
    # Seeds are then the rarest n-grams of each stretch alone: six unchanged words in a row hold one.
    assert sorted(((r.doc_id, r.item_id) for r in contaminated(df.where("doc_id != 2 or doc_id is null"), bench, rare_items=0).collect()), key=str) == sorted([(1, i), (5, k), (5, k), (None, k)], key=str)
    assert contaminated(df.limit(0), bench).collect() == [] and contaminated(df, bench.limit(0)).collect() == []
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "one two")], "item_id int, text string")
    assert contaminated(df, odd).collect() == []


def test_decontaminate_recurring_edited_copies(spark):
    rng = np.random.default_rng(5)
    text = lambda n: [f"w{x}" for x in rng.integers(0, 3000, n)]
    items = [text(n) for n in (16, 24, 37, 59)]
    edits = [(5, 2), (4, 1), (6, 3), (5, 0)]
    docs = [text(40) + [w if n % every != at else "zzz" for n, w in enumerate(item)] + text(20) for item, (every, at) in zip(items, edits, strict=True) for _ in range(50)]
    docs += [text(100) for _ in range(50)] + [[x for w in items[1] for x in (w, "put", "in")[: 1 + (rng.random() < 0.3)]] for _ in range(20)]
    code = {w: n for n, w in enumerate(sorted({w for d in docs + items for w in d}))}
    coded = lambda d: np.array([code[w] for w in d])
    want = {}
    for i, item in enumerate(items):
        for d, doc in enumerate(docs):
            score = smith_waterman(coded(item), coded(doc))[0]
            if score >= len(item):
                want[d, i] = score / (2 * len(item))
    assert len(want) >= 200
    df = spark.createDataFrame([(d, " ".join(doc)) for d, doc in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id int, text string")
    assert {(r.doc_id, r.item_id): r.score for r in contaminated(df, bench).collect()} == want


def test_decontaminate_recall_of_edited_copies(spark):
    """Words replaced, left out and put in at random: against the alignment of every document with every item."""
    rng = np.random.default_rng(11)
    text = lambda n: [f"w{int(x)}" for x in rng.zipf(1.3, n).clip(max=4000)]
    items = [text(int(n)) for n in rng.integers(12, 60, 40)] + [text(300)]
    docs = [text(120) for _ in range(60)]
    for rate in (0.0, 0.1, 0.2, 0.3):
        for item in items[:-1]:
            out = []
            for w in item:
                x = rng.random()
                out += [] if x < rate / 3 else ["new"] if x < rate * 2 / 3 else [w, "more"] if x < rate else [w]
            docs.append(text(int(rng.integers(0, 60))) + out + text(int(rng.integers(0, 60))))
    docs.append(text(30) + items[-1][100:160] + text(30))  # a quotation of under half of a long item
    code = {w: n for n, w in enumerate(sorted({w for d in docs + items for w in d}))}
    coded = lambda d: np.array([code[w] for w in d])
    want = {(d, i) for i, item in enumerate(items) for d, doc in enumerate(docs) if smith_waterman(coded(item), coded(doc))[0] >= min(len(item), 100)}
    df = spark.createDataFrame([(d, " ".join(doc)) for d, doc in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(df, bench).collect()}
    assert got <= want and (len(docs) - 1, len(items) - 1) in got
    assert len(got) >= 0.95 * len(want) and len(want) > 120


def test_decontaminate_seeds(spark):
    """Rare n-grams, and of stretches without one the rarest; the filter lets all seeds pass."""
    from granary.llm import decontaminate as D

    rows = [(i, f"a b c d e f g x{i}") for i in range(5)]
    items = D.stage(D._read_items(spark.createDataFrame(rows, "item_id int, text string").selectExpr("cast(item_id as string) item_id", "text")), "items")
    seeds = D.stage(D._seeds(items, 3, 2), "seeds")
    nth = sorted((r.item_key, r.nth) for r in seeds.collect())
    assert all([n for k, n in nth if k == key][-1] == 5 and len([n for k, n in nth if k == key]) == 2 for key in {k for k, _ in nth})  # one of five common ones, and "f g x"
    bits = D._filter(seeds)
    for r in seeds.collect():
        first = (r.gram % 2**64) >> (64 - D.FILTER_BITS)
        assert bits[first >> 5] >> np.uint32(first & 31) & 1
    assert bits.nbytes == 2 << 20


def test_quality_scores_against_plain_rules(spark):
    """The compiled column gives each whole text what the rules give to its statistics."""
    from granary.llm import quality as Q
    from granary.llm.common import table

    docs = table(spark, SF, "documents")
    model = Q.fit_quality(docs, table(spark, SF, "labels"))
    rows = docs.select("doc_id", "text").collect() + [(-1, None), (-2, ""), (-3, " \n"), (-4, "word " * 60_000), (-5, "x")]
    x = np.array([Q.statistics(t) for _, t in rows])
    want = {i: v for (i, _), v in zip(rows, model.score(x), strict=True)}
    got = Q.score_quality(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-9) and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
