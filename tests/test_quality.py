import pytest
from pyspark.sql import functions as F

from ridelake.operators.quality import (ModelChecks, QualityGateError, accepted_values, expression,
                                        gate, not_null, relationships, row_checks, run_model_checks,
                                        summarize, unique, unique_combination)


def _fails(df):
    return {(r.check_name, r.target): r.failures for r in df.collect()}


def test_row_checks_pass_and_fail(spark):
    df = spark.createDataFrame([("a", "x", 1), (None, "y", 2), ("c", None, 3)], "id string, v string, n int")
    res = _fails(row_checks(df, "m", [not_null("id"), accepted_values("v", ["x"]),
                                      expression("n_small", F.col("n") > 2)]))
    assert res == {("not_null", "id"): 1, ("accepted_values", "v"): 1, ("expression", "n_small"): 1}
    ok = _fails(row_checks(df.filter("id = 'a'"), "m", [not_null("id"), accepted_values("v", ["x"])]))
    assert set(ok.values()) == {0}


def test_unique_and_combination(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), (None, 2)], "k string, j int")
    assert _fails(unique(df, "m", "k"))[("unique", "k")] == 1          # NULLs ignored
    assert _fails(unique_combination(df, "m", ["k", "j"]))[("unique_combination", "k,j")] == 2
    assert _fails(unique(df.filter("k = 'b'"), "m", "k"))[("unique", "k")] == 0


def test_relationships_warn(spark):
    child = spark.createDataFrame([("A",), ("Z",), (None,)], "c string")
    parent = spark.createDataFrame([("A",)], "p string")
    r = relationships(child, "m", "c", parent, "p").first()
    assert r.failures == 1 and r.severity == "warn"


def test_gate_stops_on_error_not_on_warn(spark):
    df = spark.createDataFrame([("a",), (None,)], "id string")
    parent = spark.createDataFrame([("b",)], "id2 string")
    warn_only = run_model_checks(df, ModelChecks("m", relations=[("id", "p", "id2")]), {"p": parent})
    assert len(gate(warn_only)) == 1
    with pytest.raises(QualityGateError):
        gate(run_model_checks(df, ModelChecks("m", rows=[not_null("id")])))
    s = summarize(warn_only).first()
    assert s.status == "warn" and s.failed_warnings == 1
