import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallywork.functions import names
from tallywork.operators import measure, warmup

from helpers import plan_of, rows_of

KEYS = ["compiler", "model", "prompt"]


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(3)
    return [
        (c, m, p, run, (400.0 if run == 1 else 10.0) * i + pick.random(), pick.random() + 1, 10**9 + run)
        for i, c in enumerate(["gcc", "clang", "blis"], 1)
        for m in ("small", "big")
        for p in ("p0", "p1")
        for run in range(1, 9)
    ]


@pytest.fixture(scope="module")
def runs(spark, rows):
    schema = "compiler STRING, model STRING, prompt STRING, run INT, ttft DOUBLE, tpot DOUBLE, mem BIGINT"
    return spark.createDataFrame(rows, schema)


def test_measured_runs_and_configuration(runs):
    kept = measure.measured_runs(measure.configuration(runs, compiler="gcc", model="big"), 2, 3)
    assert sorted({r.run for r in kept.collect()}) == [3, 4, 5]
    assert kept.count() == 6
    assert measure.configuration(runs).count() == runs.count()


def test_config_stats(rows, runs):
    got = measure.config_stats(measure.measured_runs(runs, 1, 5), KEYS, ["ttft", "mem"]).collect()
    assert len(got) == 12
    for r in got:
        values = [x[4] for x in rows if x[:3] == (r.compiler, r.model, r.prompt) and 1 < x[3] <= 6]
        assert r.ttft_mean == pytest.approx(statistics.mean(values))
        assert r.ttft_stdev == pytest.approx(statistics.stdev(values))


def geomeans(values):
    """{option: geomean of value / best value of the setting} of {(option, setting): [values]}."""
    best = {}
    for (_, setting), found in values.items():
        best[setting] = min(best.get(setting, math.inf), *found)
    ratios = {}
    for (option, setting), found in values.items():
        ratios.setdefault(option, []).extend(v / best[setting] for v in found)
    return {o: statistics.geometric_mean(r) for o, r in ratios.items()}


def test_rank_options(rows, runs):
    ranked = measure.rank_options(runs, "compiler", ["model", "prompt"], ["ttft", "tpot"]).collect()
    for column, metric in ((4, "ttft"), (5, "tpot")):
        values = {}
        for r in rows:
            values.setdefault((r[0], r[1:3]), []).append(r[column])
        expected = geomeans({k: [statistics.mean(v)] for k, v in values.items()})
        assert {r.compiler: r[f"{metric}_geomean"] for r in ranked} == pytest.approx(expected)
    order = [r.tpot_geomean for r in ranked]
    assert order == sorted(order)


def test_rank_cold_runs(rows, runs):
    got = measure.rank_cold_runs(runs, "compiler", ["model", "prompt"], "ttft").collect()
    expected = geomeans({(r[0], r[1:3]): [r[4]] for r in rows if r[3] == 1})
    assert {r.compiler: r.ttft_geomean for r in got} == pytest.approx(expected)
    assert got[0].compiler == "gcc"


def test_cold_runs_with_several_values_each(spark):
    rows = [("a", "s", 1, 2.0), ("a", "s", 1, 8.0), ("b", "s", 1, 4.0), ("b", "s", 1, None), ("b", "s", 2, 9.0)]
    df = spark.createDataFrame(rows, "o STRING, s STRING, run INT, x DOUBLE")
    got = {r.o: (r.x_geomean, r.x_left_out) for r in measure.rank_cold_runs(df, "o", ["s"], "x").collect()}
    assert got == {"a": (pytest.approx(2.0), 0), "b": (pytest.approx(2.0), 1)}


def test_a_best_value_of_zero_is_counted_as_left_out(spark):
    rows = [("a", "s", 1, 2.0), ("b", "s", 1, 0.0), ("a", "t", 1, 3.0), ("b", "t", 1, 6.0), ("c", "s", 1, 1.0)]
    df = spark.createDataFrame(rows, "o STRING, s STRING, run INT, x DOUBLE")
    cold = measure.rank_cold_runs(df, "o", ["s"], "x")
    for ranked in (cold, measure.rank_options(df, "o", ["s"], ["x"])):
        got = {r.o: (r.x_geomean, r.x_left_out) for r in ranked.collect()}
        assert got == {"a": (pytest.approx(1.0), 1), "b": (pytest.approx(2.0), 1), "c": (None, 1)}


def test_geometric_mean_of_zeros_and_of_what_is_below(spark):
    from tallywork.functions.numbers import geomean

    rows = [("a", 2.0), ("a", 8.0), ("z", 0.0), ("z", 5.0), ("n", -1.0), ("n", 4.0), ("e", None)]
    df = spark.createDataFrame(rows, "k STRING, x DOUBLE").groupBy("k").agg(geomean(F.col("x")).alias("m"))
    assert {r.k: r.m for r in df.collect()} == {"a": pytest.approx(4.0), "z": 0.0, "n": None, "e": None}


def test_best_option(spark):
    df = spark.createDataFrame(
        [("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "o STRING, x_geomean DOUBLE"
    )
    assert measure.best_option(df, "o", "x").collect() == [("a", 1.0)]


def test_paired_compare_keeps_common_configurations(runs):
    left = measure.configuration(runs, model="small")
    pairs = measure.paired_compare(left, runs, KEYS, ["ttft"], ("a", "b"))
    assert pairs.count() == 6
    assert all(r.a_ttft_mean == r.b_ttft_mean for r in pairs.collect())


def t_by_hand(a, b):
    df = len(a) + len(b) - 2
    pooled = (statistics.variance(a) * (len(a) - 1) + statistics.variance(b) * (len(b) - 1)) / df
    return (statistics.mean(a) - statistics.mean(b)) / math.sqrt(pooled * (1 / len(a) + 1 / len(b)))


def p_by_hand(t, df, steps=20000):
    """One less the area under the density between -|t| and |t|, by Simpson's rule."""
    scale = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    h = abs(t) / steps
    weights = [1 if i in (0, steps) else 4 if i % 2 else 2 for i in range(steps + 1)]
    area = sum(w * (1 + (i * h) ** 2 / df) ** (-(df + 1) / 2) for i, w in enumerate(weights))
    return 1 - 2 * scale * area * h / 3


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ([0.7, -1.6, -0.2, -1.2, -0.1, 3.4, 3.7, 0.8, 0.0, 2.0],
         [1.9, 0.8, 1.1, 0.1, -0.1, 4.4, 5.5, 1.6, 4.6, 3.4]),
        ([1.0, 2.0, 3.0], [2.0, 4.0, 6.0, 8.0, 10.0]),
        ([5.0, 5.1], [1.0, 1.1]),
        ([1.0, 2.0], [1.0, 2.0]),
    ],
)
def test_t_test(spark, a, b):
    longest = max(len(a), len(b))
    rows = list(zip(a + [None] * (longest - len(a)), b + [None] * (longest - len(b))))
    pairs = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")
    row = measure.t_test(pairs, {"x": ("a", "b")}).first()
    assert (row.n_a, row.n_b, row.df) == (len(a), len(b), len(a) + len(b) - 2)
    assert row.t == pytest.approx(t_by_hand(a, b), abs=1e-12)
    assert row.p_value == pytest.approx(p_by_hand(t_by_hand(a, b), row.df), abs=1e-9)


def test_p_value_against_closed_forms(spark):
    """One degree of freedom is Cauchy's distribution; two have a root in closed form."""
    from tallywork.functions.student import two_sided_p

    ts = [0.001, 0.1, 0.5, 1.0, 1.5, 3.0, 12.0, 400.0]
    df = spark.createDataFrame([(t,) for t in ts], "t DOUBLE")
    for r in df.select("t", two_sided_p(F.col("t"), F.lit(1)).alias("one"),
                       two_sided_p(-F.col("t"), F.lit(2)).alias("two")).collect():
        assert r.one == pytest.approx(1 - 2 / math.pi * math.atan(r.t), rel=1e-9)
        assert r.two == pytest.approx(2 / (2 + r.t**2 + r.t * math.sqrt(2 + r.t**2)), rel=1e-9)


def test_p_value_with_many_degrees_of_freedom(spark):
    from tallywork.functions.student import two_sided_p

    df = spark.createDataFrame([(0.5,), (2.0,), (5.0,)], "t DOUBLE")
    for r in df.select("t", two_sided_p(F.col("t"), F.lit(10**9)).alias("p")).collect():
        assert r.p == pytest.approx(math.erfc(r.t / math.sqrt(2)), rel=1e-6)


def test_variant_union(spark, runs):
    with_threads = runs.withColumn("threads", F.lit(12))
    a = measure.labelled_stats(runs, F.lit("48T NO-NUMA"), KEYS, ["ttft"])
    b = measure.labelled_stats(
        with_threads, names.variant_label(F.col("threads"), "T NUMA"), KEYS, ["ttft"]
    )
    both = measure.variant_union(a, b, b)
    assert {r.threads for r in both.collect()} == {"12T NUMA", "48T NO-NUMA"}
    assert both.count() == 24
    ranked = measure.rank_means(both, "threads", KEYS, ["ttft"]).collect()
    assert [r.ttft_geomean for r in ranked] == pytest.approx([1.0, 1.0])


def test_property_check(spark):
    rows = [("m", 1, 5), ("m", 1, 1), ("m", 2, 1), ("m", 2, 2), ("n", 3, None)]
    df = spark.createDataFrame(rows, "model STRING, run INT, prompt_n INT")
    got = measure.property_check(df, df.filter("run = 1"), *measure.cache_rules(F.col("prompt_n")))
    assert rows_of(got) == [("m", 4, 2), ("n", 1, 0)]


def trailing_by_hand(series):
    """{key: [(run, value)]} -> {(key, w): mse} with plain loops."""
    result = {}
    for key, found in series.items():
        found = sorted(found)
        for i, (run, _) in enumerate(found):
            values = [v for _, v in found[i:] if v is not None]
            if len(values) > 1:
                result[key, run - 1] = statistics.variance(values) / (len(found) - i)
    return result


@pytest.mark.parametrize("bits", [0, 1, 4, 20])
def test_trailing_error_of_sparse_numbers(spark, bits):
    """Order numbers 2^21 apart: every row is a block of its own, or blocks of blocks."""
    pick = random.Random(9)
    rows = [(k, run, run << 21, 100 + pick.random()) for k in "ab" for run in range(1, 40)]
    df = spark.createDataFrame(rows, "k STRING, run INT, event BIGINT, ttft DOUBLE")
    dense = rows_of(warmup.trailing_error(df, ["k"]))
    sparse = rows_of(warmup.trailing_error(df, ["k"], run="event", numbered=False, bits=bits))
    for got, expected in zip(sparse, dense, strict=True):
        assert got[:2] == expected[:2]
        assert got[2] == pytest.approx(expected[2], rel=1e-9)
        assert (got[3] is None) == (expected[3] is None)
        assert got[3] is None or got[3] == pytest.approx(expected[3], rel=1e-9)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 16])
def test_trailing_error_by_hand(spark, bits):
    pick = random.Random(8)
    rows = [
        (key, run, None if pick.random() < 0.1 else (9000.0 if run == 1 else 100.0) + pick.random())
        for key in ("a", "b", None)
        for run in range(1, 24)
        if pick.random() < 0.9
    ]
    df = spark.createDataFrame(rows, "k STRING, run INT, ttft DOUBLE")
    series = {}
    for key, run, value in rows:
        series.setdefault(key, []).append((run, value))
    expected = trailing_by_hand(series)
    got = {(r.k, r.warmup_runs): r for r in warmup.trailing_error(df, ["k"], bits=bits).collect()}
    assert {k: r.mse for k, r in got.items()} == pytest.approx(expected, rel=1e-7)
    for (key, w), row in got.items():
        earlier = [r - 1 for r, _ in series[key] if r - 1 < w]
        if earlier:
            assert row.previous_mse == pytest.approx(expected[key, max(earlier)], rel=1e-7)
        else:
            assert row.previous_mse is None


def test_trailing_error_without_run_numbers(spark):
    """Order numbers with gaps give the same as the run numbers that they stand for."""
    pick = random.Random(4)
    rows = [(k, run, 1000 + 7 * run + run % 3, pick.random()) for k in "ab" for run in range(1, 30)]
    df = spark.createDataFrame(rows, "k STRING, run INT, event BIGINT, ttft DOUBLE")
    numbered = rows_of(warmup.trailing_error(df, ["k"]))
    for bits in (2, 4, 16):
        counted = warmup.trailing_error(df, ["k"], run="event", numbered=False, bits=bits)
        for got, expected in zip(rows_of(counted), numbered, strict=True):
            assert got[:2] == expected[:2]
            assert got[2] == pytest.approx(expected[2], rel=1e-9)
            assert (got[3] is None) == (expected[3] is None)
            assert got[3] is None or got[3] == pytest.approx(expected[3], rel=1e-9)


def test_trailing_error_windows_rows_by_block(spark):
    """No window takes a whole configuration, of rows or of block rows."""
    df = spark.range(10).selectExpr("id % 3 AS k", "CAST(id AS INT) AS run", "rand(1) AS ttft")
    plan = plan_of(warmup.trailing_error(df, ["k"]))
    windows = [line for line in plan.splitlines() if "+- Window [" in line]
    assert windows and all("_block_" in line.split("windowspecdefinition(")[1][:60] for line in windows)
    assert "SortAggregate" not in plan
    assert "Exchange SinglePartition" not in plan


def test_error_quotients(spark):
    rows = [("a", 1, 8.0, 16.0), ("b", 1, 1.0, 8.0), ("a", 2, 1.0, 3.0), ("c", 1, 0.0, 5.0), ("a", 0, 1.0, None)]
    df = spark.createDataFrame(rows, "k STRING, warmup_runs INT, mse DOUBLE, previous_mse DOUBLE")
    got = {r.warmup_runs: (r.mse_quotient_geomean, r.left_out) for r in warmup.error_quotients(df).collect()}
    assert got == {1: (pytest.approx(4.0), 1), 2: (pytest.approx(3.0), 0)}
