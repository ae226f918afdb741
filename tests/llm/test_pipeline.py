import brute
import corpus_pipeline as P
import pytest
from conftest import SF
from pyspark.sql import functions as F

from granary.llm.common import stage


def test_stages_by_hand(spark, duck):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, f in P.STAGES[:-1]:
        docs = stage(f(spark, docs, SF), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    labels = duck.execute("SELECT doc_id, quality FROM labels").fetchall()
    wrong = [i for i, q in labels if (i in kept["quality"]) != bool(q)]
    assert len(wrong) <= 0.03 * len(labels)
    same = {}
    for i, t in kept["quality"].items():
        same.setdefault(t.translate(brute.LOW), []).append(i)
    assert set(kept["exact"]) == {max(g) for g in same.values()}
    near = brute.jaccard(list(kept["exact"].items()), 5, 80)
    assert set(kept["near"]) == {c for _, c, _ in near.values()}
    leaks = {i for i, b in duck.execute("SELECT d.doc_id, b.item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)").fetchall()}
    assert not leaks & set(kept["decontaminate"])
    assert len(set(kept["near"]) - leaks - set(kept["decontaminate"])) <= 2
    assert texts.items() >= kept["decontaminate"].items()
    packed = P.packed(spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == set(kept["decontaminate"])
    assert {r.doc_id for r in P.run(spark, SF).collect()} == set(kept["decontaminate"])


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_on_odd_rows(spark, duck, name):
    good = duck.execute("SELECT text FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND n_chars > 500 LIMIT 1").fetchone()[0]
    rows = [(1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c d e f", None, None, None), (3, "x " * 50, "en", "s", 1), (4, good, None, "s", 1), (4, good, None, "s", 1), (5, good * 40, "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    f = dict(P.STAGES)[name]
    got = f(spark, df, SF)
    ids = sorted((r.doc_id for r in got.collect()), key=str)
    if name == "exact":
        assert ids == [2, 3, 4, 5, None]
    elif name == "pack":
        assert set(ids) == {1, 2, 3, 4, 5, None} and got.where("piece = 0").count() == len(rows)
    elif name == "quality":
        assert ids.count(4) == 2 and ids.count(1) in (0, 2)
    else:
        assert ids == [1, 1, 2, 3, 4, 4, *([5] if name == "decontaminate" else []), None]  # 5 has the shingles of 4
    assert f(spark, df.limit(0), SF).collect() == []
    # Columns whose names differ from others in case only, or are those of a stage's own.
    odd = df.toDF("doc_id", "text", "TEXT", "Doc_ID", "_statistics")
    clash = f(spark, odd, SF)
    if name != "pack":
        assert clash.columns == odd.columns and got.columns == df.columns
        assert sorted(map(tuple, clash.collect()), key=str) == sorted(map(tuple, got.collect()), key=str)
    else:
        assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in clash.where("doc_id is not null").collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in got.where("doc_id is not null").collect())


def test_exact_keeps_texts_without_a_copy(spark):
    rows = [(7, "A1"), (7, "A1"), (7, "B2"), (8, "X3"), (8, "Y4"), (9, "X3"), (None, "Z5"), (None, "Z5")]
    got = P.exact(spark, spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, Text int"), SF).collect()
    assert sorted(((r[0], r[1]) for r in got), key=str) == sorted([(7, "A1"), (7, "B2"), (8, "Y4"), (9, "X3"), (None, "Z5")], key=str)


@pytest.mark.parametrize("hash_of", ["its own", "octet_length(text) % 2", "7L"])
def test_stages_decide_by_row(spark, duck, monkeypatch, hash_of):
    """Also where rows share their hash, or all have the same."""
    if hash_of != "its own":
        monkeypatch.setattr(P, "_hash", lambda: F.coalesce(F.expr(hash_of).cast("long"), F.lit(0)))
    text = lambda c, last: " ".join(f"{c}{i}" for i in range(60)) + f" {last}"
    run = lambda f, rows: sorted(((r.doc_id, r.text) for r in f(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()), key=str)
    rows = [(None, text("a", "x")), (7, text("a", "y")), (9, text("a", "z")), (1, text("b", "x")), (5, text("b", "y")), (5, text("c", "x")), (None, text("d", "x")), (None, text("d", "y"))]
    got = run(P.near, rows)
    assert (7, text("a", "y")) in got and (1, text("b", "x")) in got and (5, text("c", "x")) in got
    assert len(got) == 4 and sum(i is None for i, _ in got) == 1
    assert run(P.exact, [(5, "one two"), (8, "ONE two"), (5, "other"), (None, "null"), (None, "NULL"), (None, "one two")]) == sorted([(8, "ONE two"), (5, "other"), (None, "NULL")], key=str)
    leak = duck.execute("SELECT text FROM benchmark ORDER BY length(text) DESC").fetchone()[0]
    assert run(P.decontaminate, [(None, leak), (3, leak), (3, "clean"), (None, "clean too")]) == sorted([(3, "clean"), (None, "clean too")], key=str)
