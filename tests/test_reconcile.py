import pytest

from tallywork.operators.reconcile import acceptable, reconcile


def table(spark, values):
    return spark.createDataFrame(list(values.items()), "key STRING, value STRING")


def test_verdicts(spark):
    left = {"same": "5", "near": "1000", "far": "1000", "gone": "1", "zero": "0", "text": "a",
            "none": None, "minus": "-1000", "format": "2.0"}
    right = {"same": "5", "near": "1000.5", "far": "1010", "new": "1", "zero": "1", "text": "b",
             "none": None, "minus": "-1010", "format": "2"}
    got = {r.key: r for r in reconcile(table(spark, left), table(spark, right)).collect()}
    assert {k: r.verdict for k, r in got.items()} == {
        "same": "equal",
        "near": "within tolerance",
        "far": "changed",
        "gone": "missing",
        "new": "extra",
        "zero": "changed",
        "text": "changed",
        "none": "equal",
        "minus": "changed",
        "format": "within tolerance",
    }
    assert got["far"].relative_error == pytest.approx(0.01)
    assert got["zero"].relative_error is None and got["text"].relative_error is None


def test_acceptable(spark):
    a = table(spark, {"x": "1000", "y": "t"})
    near = table(spark, {"x": "1000.9", "y": "t"})
    assert acceptable(reconcile(a, near)).first().acceptable
    assert not acceptable(reconcile(a, near, tolerance=1e-6)).first().acceptable
    assert not acceptable(reconcile(a, a.limit(1))).first().acceptable


def test_a_hot_key_is_not_multiplied(spark):
    many = spark.range(20000).selectExpr("'hot' AS key", "'1' AS value")
    got = reconcile(many, many).collect()
    assert [(r.key, r.verdict) for r in got] == [("hot", "equal")]


def test_several_key_columns_with_nulls(spark):
    a = spark.createDataFrame([(None, "k", "1"), (1, "k", "1")], "r INT, key STRING, value STRING")
    got = {r.r: r.verdict for r in reconcile(a, a.filter("r = 1"), ["r", "key"]).collect()}
    assert got == {None: "missing", 1: "equal"}


def test_different_values_under_a_key_are_duplicates(spark):
    rows = [("a", "1"), ("a", "5"), ("b", "2"), ("b", "2"), ("c", None), ("c", "3")]
    left = spark.createDataFrame(rows, "key STRING, value STRING")
    right = table(spark, {"a": "5", "b": "2", "c": "3"})
    for compared in (reconcile(left, right), reconcile(right, left)):
        assert {r.key: r.verdict for r in compared.collect()} == {"a": "duplicate", "b": "equal", "c": "duplicate"}
        counts = acceptable(compared).first()
        assert counts.duplicate == 2 and not counts.acceptable
