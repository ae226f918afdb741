import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from granary.functions import columns as C


def values(spark, expr, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_normalize_text_nulls_whole_values_only(spark):
    got = values(spark, C.normalize_text(F.col("x"), C.COLUMN_TOKENS["brand"]), [("\t a b\n",), ("",), (" NULL ",), ("N/A",), ("nan",), ("NA",), ("*",), ("* star",), ("Geen",), (None,), (" x",)])
    assert got == ["a b", None, None, None, "nan", "NA", None, "* star", None, None, "x"]


def test_decode_code_is_idempotent_and_strict(spark):
    decode = C.decode_code(F.col("x"), ["kcalb", "eulb"], ["black", "blue"])
    assert values(spark, decode, [("kcalb",), (" blue ",), (None,), ("n/a",)]) == ["black", "blue", None, None]
    for unknown in ("BLUE", "red"):
        with pytest.raises(Exception, match="unknown code"):
            values(spark, decode, [(unknown,)])
    with pytest.raises(ValueError, match="both"):
        C.decode_code(F.col("x"), ["a"], ["a"])


def test_lookup_fails_on_unknown(spark):
    expr = C.lookup(F.col("x"), {"a": "Alpha"}, "shop")
    assert values(spark, expr, [("a",), (None,)]) == ["Alpha", None]
    with pytest.raises(Exception, match="unknown shop"):
        values(spark, expr, [("b",)])


@pytest.mark.parametrize(("code", "region"), [("1000", "Brussels"), ("1299", "Brussels"), ("1300", "Wallonia"), ("1499", "Wallonia"), ("1500", "Flanders"), ("3999", "Flanders"), ("4000", "Wallonia"), ("7999", "Wallonia"), ("8000", "Flanders"), ("9999", "Flanders"), ("0999", None), ("12345", None), ("B-1000", None), (None, None), (" 1000 ", "Brussels")])
def test_region(spark, code, region):
    assert values(spark, C.region(F.col("x")), [(code,)]) == [region]


def test_nfc_and_tokens(spark):
    assert values(spark, C.nfc("x"), [("é",), (None,)]) == ["é", None]
    assert values(spark, C.tokens(F.col("x")), [("Café CAFÉ the cafés ab",), (None,)]) == [["café", "cafés"], None]


def test_composed_sends_only_places_that_change_to_python(spark, monkeypatch):
    rng = random.Random(1)
    marks = "\u0301\u0338\u0345\u0323\u0344\u0f71\u3099\u1100\u1161\u11a8\uac00\u212b\uf900\U0002f800\U0001d15e\u0958e<A\nа\u2028か中\U0001f600\x00i"
    texts = [None, "", "plain", "caf\u00e9 \u4e2d\U0001f600", "\u0301", "\u0301\n\u0301a\u0323\u0301", "\uf900" * 20_000, *("".join(rng.choices(marks, k=rng.randint(1, 60))) for _ in range(2_000))]
    texts += [unicodedata.normalize("NFD", "Ångström, crème brûlée 한국어 がぎ ") * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, x string")
    assert [r["x"] for r in C.composed(df, "x").orderBy("n").collect()] == [t and unicodedata.normalize("NFC", t) for t in texts]

    @F.pandas_udf("string")
    def short(texts):
        assert texts.str.len().max() < 100, "whole texts in Python"
        return texts.map(lambda t: unicodedata.normalize("NFC", t))

    monkeypatch.setattr(C, "nfc", short)
    long = "words of a long text – “quoted”, with é " * 5_000
    rows = spark.createDataFrame([(long + "cafe\u0301",), (long,)], "x string")
    assert [r["x"] for r in C.composed(rows, "x").collect()].count(long + "caf\u00e9") == 1


def test_box_location_type_and_flags(spark):
    df = spark.createDataFrame([(50.0, 4.0, "Default "), (49.39, 4.0, None), (None, 4.0, "x"), (53.6, 7.3, "default")], "a double, b double, n string")
    assert [r[0] for r in df.select(C.outside_box(F.col("a"), F.col("b"))).collect()] == [False, True, False, False]
    assert [r[0] for r in df.select(C.location_type(F.col("n"))).collect()] == ["National price (online)", "Store", "Store", "National price (online)"]


def test_iso_week_53(spark):
    df = spark.createDataFrame([("2020-12-28",), ("2021-01-03",), ("2021-01-04",)], "x string").select(C.iso_week_label(F.col("x").cast("date")))
    assert [r[0] for r in df.collect()] == ["2020-W53", "2020-W53", "2021-W01"]


def test_only_value_ignores_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (2, "b"), (3, None)], "k int, v string")
    assert dict(df.groupBy("k").agg(C.only_value(F.col("v"))).collect()) == {1: "a", 2: None, 3: None}
