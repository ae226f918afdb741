import pytest

from granary.plans import parity


def test_errors_of_data_are_told_and_others_raised(spark, monkeypatch):
    """A table without the columns asked for is a text among the metrics; a fault of the program is no changed figure."""
    tables = dict.fromkeys([*parity._one_pass(), "dim_product", "fact_weekly_prices"], spark.range(3))
    for name in ("DISTINCT", "_bridge", "_inferred_rows", "_periods"):
        monkeypatch.setattr(parity, name, {} if name == "DISTINCT" else lambda t: {})
    told = parity.metrics(tables)
    assert told and all(v.startswith("error: AnalysisException") for v in told.values())
    monkeypatch.setattr(parity, "_bridge", lambda t: {"x": 1 // 0})
    with pytest.raises(ZeroDivisionError):
        parity.metrics(tables)
