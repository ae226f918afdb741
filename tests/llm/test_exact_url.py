import pytest
from conftest import SF
from pyspark.sql import functions as F

from granary.llm import catalog
from granary.llm.common import LOWER, UPPER, ascii_lower
from granary.llm.exact_dedup import exact_dedup
from granary.llm.url_filter import PatternRule, RuleIndex, SiteRule, filter_urls, split_url


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_oracle(spark, same_as_sql, name):
    same_as_sql(catalog.QUERIES[name](spark, SF), catalog.ORACLES[name])


TEXTS = [(1, None), (2, ""), (3, "A" * 20000), (3, "a" * 20000), (4, "a" * 19999 + "b"), (5, "Éa"), (6, "éa"), (None, "x"), (None, "X")]


def one_digest(block):
    return [F.lit(1).cast("long"), F.lit(2).cast("long")]


@pytest.mark.parametrize("how", [{"block_bytes": 700}, {"block_bytes": 4096}, {"block_bytes": 5000, "digest": one_digest}])
def test_exact_dedup_edges_and_collisions(spark, how):
    got = exact_dedup(spark.createDataFrame(TEXTS, "doc_id long, text string"), **how).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == sorted([(1, 2, 2, False), (2, 2, 2, True), (3, 3, 2, True), (3, 3, 2, False), (4, 4, 1, True), (5, 5, 1, True), (6, 6, 1, True), (None, None, 2, True), (None, None, 2, False)], key=str)


def test_exact_dedup_plan_has_no_python(spark):
    plan = catalog.QUERIES["op7_exact_dedup"](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_extra_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", "n", 5)], "doc_id long, text string, TEXT string, name int")
    assert exact_dedup(df).count() == 1
    assert exact_dedup(df.limit(0)).collect() == []
    urls = spark.createDataFrame([(1, "http://a.com/", "x")], "page_id long, url string, URL string")
    assert [r.verdict for r in filter_urls(urls).collect()] == ["allow"]
    assert filter_urls(urls.limit(0)).collect() == []


@pytest.mark.parametrize(("url", "host", "path"), [(None, "", ""), ("", "", ""), ("no scheme", "", ""), ("HTTP://A.Com", "a.com", ""), ("x://H/P?q#f", "h", "/P"), ("x://h#f/y", "h", ""), ("x://h?a://b/c", "h", ""), ("a://b://c/d", "b:", "//c/d"), ("://É/é", "É", "/é")])
def test_split_url(url, host, path):
    assert split_url(url) == (host, path)


@pytest.mark.parametrize(("url", "rule", "verdict"), [
    ("http://a.com/x", "com/", "allow"), ("http://example.com/en/1", "example.com/en/", "block"), ("http://www.example.com/en/", "www.example.com/en/", "allow"), ("http://badexample.com/en/", "com/", "allow"),
    ("http://x.www.example.com/en/", "www.example.com/en/", "allow"), ("http://example.com/en", "com/", "allow"), ("http://a.net/fr/2", "net/fr/", "block"), ("http://a.net/de/", None, "allow"), ("http://a.com", None, "allow"),
    ("http://example.com:80/en/", None, "allow"), ("http://a.org/?utm_source=feed", None, "block"), (None, None, "allow"),
])
def test_contract_rules(spark, url, rule, verdict):
    r = filter_urls(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (r.rule, r.verdict) == (rule, verdict)


def test_rules_are_fetched_by_their_rarest_token():
    rules = [PatternRule("block", f"/common/rare{i}/") for i in range(50)] + [PatternRule("block", "ads*")]
    index = RuleIndex([SiteRule("allow", "com", "/")], rules, {"common": 1000, **{f"rare{i}": 1 for i in range(50)}})
    assert set(index.by_token) == {"com", *(f"rare{i}" for i in range(50))} and len(index.always) == 1
    *_, verdict, run = index.judge("http://a.org/common/rare7/x")
    assert verdict == "block" and run == 2


def test_lower_casing_touches_a_to_z_only(spark):
    """Every code point, alone and beside letters, against translate()."""
    points = spark.range(1, 0x110000).where("id not between 55296 and 57343")  # no surrogates
    point = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    for text in (point, F.concat(F.lit("AzÉ"), point, F.lit("Z"))):
        rows = points.select(text.alias("text"))
        assert rows.where(~ascii_lower(F.col("text")).eqNullSafe(F.translate("text", UPPER, LOWER))).isEmpty()
    assert [r[0] for r in spark.createDataFrame([(None,), ("",), ("[A@Z`",)], "text string").select(ascii_lower(F.col("text"))).collect()] == [None, "", "[a@z`"]
