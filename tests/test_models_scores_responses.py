import json

import pytest
from pyspark.sql import functions as F

from tallywork.functions import names
from tallywork.operators import cost_model, responses, scores
from tallywork.sources import measurements

from helpers import rows_of

BANDWIDTH = cost_model.Bandwidth(gb_per_s=1.0, factor=1.0, extra_ms=0.0)
SCHEMA = "name STRING, n_params BIGINT, bpw DOUBLE, observed_tpot_ms DOUBLE"


def models(spark, *times):
    """Models that take one, two, ... milliseconds at best over a bus of 1 GB/s, and the times given."""
    rows = [(f"m{n}", n * 500_000, 16.0, time) for n, time in enumerate(times, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_prediction(spark):
    exact = models(spark, 5.0).select(cost_model.predicted_ms(BANDWIDTH), cost_model.predicted_ms(BANDWIDTH, 3))
    assert tuple(exact.first()) == pytest.approx((1.0, 3.0))
    default = models(spark, 5.0).select(cost_model.predicted_ms(cost_model.Bandwidth())).first()[0]
    assert default == pytest.approx(1.1e6 / 818e9 * 1000 + 0.5)


@pytest.mark.parametrize(
    ("method", "times", "k", "mse"),
    [
        ("none", (1.0, 2.0), 1.0, 0.0),
        ("none", (4.0, 2.0), 1.0, 4.5),
        # A common factor is found whole by either fit.
        ("mse", (2.5, 5.0, 7.5), 2.5, 0.0),
        ("geomean", (2.5, 5.0, 7.5), 2.5, 0.0),
        # sum(ideal * observed) / sum(ideal^2) = (1 * 6 + 2 * 2) / 5; off by -4 and 2.
        ("mse", (6.0, 2.0), 2.0, 10.0),
        # Ratios 9 and 1: the root of their product; off by -6 and 4.
        ("geomean", (9.0, 2.0), 3.0, 26.0),
    ],
)
def test_fits(spark, method, times, k, mse):
    table = models(spark, *times)
    if method != "none":
        assert cost_model.fit_multiplier(table, method, BANDWIDTH).first().k == pytest.approx(k)
    row = cost_model.fit_error(table, method, bandwidth=BANDWIDTH).first()
    assert (row.k, row.mse) == pytest.approx((k, mse))


def test_model_report(spark):
    rows = {r.name: r for r in cost_model.model_report(models(spark, 6.0, 2.0), "mse", bandwidth=BANDWIDTH).collect()}
    one = rows["m1"]
    assert one.memory_gib == pytest.approx(1e6 / 2**30)
    assert (one.k, one.predicted_ms, one.observed_ms, one.ratio) == pytest.approx((2.0, 2.0, 6.0, 6.0))
    assert one.error_percent == pytest.approx(200 / 3)


def test_given_multiplier_wins(spark):
    assert cost_model.model_report(models(spark, 6.0, 2.0), "mse", k=2.5).first().k == 2.5


def test_overhead_in_bytes(spark):
    """Half a GiB more to read instead of half a millisecond: the other published form."""
    bandwidth = cost_model.Bandwidth(extra_bytes=0.5 * 2**30, extra_ms=0.0)
    first = models(spark, 5.0).select(cost_model.predicted_ms(bandwidth)).first()[0]
    assert first == pytest.approx((1.1e6 + 2**29) / 818e9 * 1000)


def test_zero_observations_and_empty_models(spark):
    table = models(spark, 0.0, 4.0).unionByName(spark.createDataFrame([("none", 0, 16.0, 1.0)], SCHEMA))
    rows = {r.name: r for r in cost_model.model_report(table, k=1.0, bandwidth=BANDWIDTH).collect()}
    assert rows["m1"].ratio == 0.0 and rows["m1"].error_percent is None
    assert rows["none"].ratio is None and rows["none"].error_percent == 100.0
    assert cost_model.fit_multiplier(table, "mse", BANDWIDTH).first().k == pytest.approx(8 / 5)
    assert cost_model.fit_multiplier(table, "geomean", BANDWIDTH).first().k == 0.0
    only = table.filter("name = 'none'")
    assert cost_model.fit_multiplier(only, "mse", BANDWIDTH).first().k is None


def test_wrong_arguments(spark):
    table = models(spark, 1.0)
    with pytest.raises(ValueError, match="has to be above 0"):
        cost_model.model_report(table, k=0)
    with pytest.raises(ValueError, match="only none, mse, geomean"):
        cost_model.fit_multiplier(table, "best")
    with pytest.raises(Exception, match="without models"):
        cost_model.fit_multiplier(table.filter("false"), "mse").collect()


@pytest.fixture(scope="module")
def marks(spark):
    rows = [("S0", "x", 2), ("S0", "y", 1), ("M1", "x", 0), ("M1", "y", 2), ("M1", "z", 1), (None, "x", 1)]
    return spark.createDataFrame(rows, "prompt STRING, evaluator STRING, score INT")


def test_score_totals(marks):
    totals = scores.score_totals(marks, ["prompt", "evaluator"])
    got = {(r.prompt, r.evaluator): r.total for r in totals.collect()}
    assert got["Total", "Total"] == 7
    assert got["Total", "x"] == 3 and got["S0", "Total"] == 3 and got["M1", "z"] == 1
    assert got[None, "x"] == 1 and got[None, "Total"] == 1
    assert len(got) == 6 + 3 + 3 + 1


def test_score_table(marks):
    table = {r.prompt: r for r in scores.score_table(marks, "prompt", "evaluator", ["x", "y"]).collect()}
    assert (table["S0"].x, table["S0"].y, table["S0"].Other, table["S0"].Total) == (2, 1, 0, 3)
    assert (table["M1"].x, table["M1"].y, table["M1"].Other, table["M1"].Total) == (0, 2, 1, 3)
    assert table["Total"].Total == 7 and table["Total"].Other == 1 and table[None].Total == 1


TEXTS = ['He said "no"\\ and\tleft', "línea uno\nlínea dos", "", "日本語 😀 \u0001"]


def test_requests(spark):
    prompts = spark.createDataFrame([(t,) for t in TEXTS], "text STRING")
    made = responses.build_requests(prompts, seed=3, max_tokens=10).collect()
    for row in made:
        assert json.loads(row.request) == {
            "messages": [{"role": "user", "content": row.text}], "seed": 3, "max_tokens": 10,
        }


def test_responses(spark):
    def body(n, text):
        return json.dumps({
            "id": n,
            "timings": {"prompt_n": n, "predicted_n": 8, "cache_n": 41, "prompt_ms": 74.074,
                        "predicted_per_token_ms": 63.941, "other": 1},
            "choices": [{"message": {"role": "assistant", "content": text}}, {"message": {}}],
        })

    bodies = [(n, body(n, text)) for n, text in enumerate(TEXTS)] + [(9, "not json")]
    df = spark.createDataFrame(bodies, "n INT, body STRING")
    timing = {r.n: r for r in responses.response_timings(df).collect()}
    assert (timing[1].prompt_n, timing[1].predicted_n, timing[1].cache_n) == (1, 8, 41)
    assert timing[1].ttft == pytest.approx(138.015) and timing[1].tpot == 63.941
    assert timing[9].ttft is None
    texts = {r.n: r.content for r in responses.response_content(df).collect()}
    assert texts == {**dict(enumerate(TEXTS)), 9: None}


def test_names(spark):
    files = ["../models/SmolLM2-135M-Instruct-Q4_K_M.gguf", "gemma-3-it-4B-Q8_0.gguf", "x.gguf"]
    df = spark.createDataFrame([(f,) for f in files], "model_file STRING")
    got = responses.with_model_parts(df).select(
        "model", "quantization", names.parent_name(F.col("model_file"))
    )
    assert [tuple(r) for r in got.collect()] == [
        ("SmolLM2-135M-Instruct", "Q4_K_M", "models"),
        ("gemma-3-it-4B", "Q8_0", None),
        ("x.gguf", "", None),
    ]


HEADER = "COMPILER,MODEL,QUANTIZATION,SEEDING,PROMPT,RUN,PROMPT_N,PREDICTED_N,CACHE_N,TTFT,TPOT,MEM"


def test_measurement_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for model in "ab":
        lines = [f"gcc,{model},Q8_0,static,small,{r},42,8,0,{r}.5,64.0,24330698752" for r in (1, 2)]
        (source / f"{model}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    read = measurements.read_measurements(spark, str(source / "*.csv"))
    assert read.columns == HEADER.lower().split(",")
    assert read.count() == 4

    out = str(tmp_path / "out")
    measurements.write_measurements(read, out)
    again = spark.read.option("header", True).csv(out)
    assert rows_of(again.select("compiler", "model", "quantization", "run")) == rows_of(
        read.selectExpr("compiler", "model", "quantization", "CAST(run AS STRING)")
    )

    (source / "c.csv").write_text("COMPILER,OTHER\n1,2\n")
    with pytest.raises(Exception, match="header|column"):
        measurements.read_measurements(spark, str(source)).collect()


def test_prompts_and_response_files(spark, tmp_path):
    for kind, name, text in (("small", "0", "one\ntwo\n"), ("small", "1", "x"), ("large", "0", "long")):
        (tmp_path / "prompts" / kind).mkdir(parents=True, exist_ok=True)
        (tmp_path / "prompts" / kind / name).write_text(text)
    prompts = measurements.read_prompts(spark, str(tmp_path / "prompts"))
    assert rows_of(prompts) == [("large", "0", "long"), ("small", "0", "one\ntwo\n"), ("small", "1", "x")]

    answers = prompts.select(
        F.lit("m-Q8_0").alias("model"), "prompt_type", "prompt_id", F.col("text").alias("content")
    )
    measurements.write_responses(answers, str(tmp_path / "table"))
    stored = spark.read.parquet(str(tmp_path / "table"))
    columns = ["model", "prompt_type", "content"]
    assert rows_of(stored, *columns) == rows_of(answers, *columns)
    measurements.write_response_files(answers, str(tmp_path / "files"))
    directory = tmp_path / "files" / "model=m-Q8_0" / "prompt_type=large" / "prompt_id=0"
    assert [f.read_text() for f in directory.glob("part-*")] == ["long\n"]
