"""Files that are written and read back: extracts, inferred types, reports, measurements, prompts, nested records."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from helpers import SF, plan_of, rows_of
from tallywork.operators import profile, usage
from tallywork.plans import driver_tables, registered
from tallywork.sources import files, measurements, shared_folder, tables
from tallywork.sources import jobs as source


@pytest.fixture(scope="module")
def extract(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("extracts"))
    source.write_jobs(driver_tables.job_extract(spark, SF), path)
    return path


def files_read(df):
    """How many files the scans of an executed frame have opened."""
    df.collect()
    found = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name == "FileSourceScanExec":
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_extracts_are_named_by_month_in_folders_of_years(extract, spark):
    names = {row[0] for row in source.read_jobs(spark, extract).select("file_name").distinct().collect()}
    assert all(re.fullmatch(r"jobs_[A-Z][a-z]{2}\.[0-9]+\.txt", name) for name in names)
    periods = {row[0] for row in source.read_jobs(spark, extract).select("period").distinct().collect()}
    assert periods == {row[0] for row in driver_tables.jobs(spark, SF).select("period").distinct().collect()}


def test_all_rows_come_back(extract, spark):
    columns = ["JobIDRaw", "ElapsedRaw", "CPUTimeRAW", "Account", "Partition", "State", "period"]
    written = driver_tables.job_extract(spark, SF).select(*[F.col(c).cast("string") for c in columns])
    read = source.read_jobs(spark, extract).select(*[F.col(c).cast("string") for c in columns])
    assert rows_of(read) == rows_of(written)


def test_the_files_of_other_months_and_years_stay_closed(extract, spark):
    jobs = source.read_jobs(spark, extract)
    (every,) = files_read(jobs.select("JobIDRaw"))
    (one,) = files_read(usage.usage_cube(source.of_period(jobs, dt.date(1996, 2, 1))))
    months = jobs.select("period").distinct().count()
    assert 0 < one <= every // months + 2 and every >= months


def test_a_folder_that_is_no_year_stops_the_job(spark, tmp_path):
    folder = tmp_path / "late"
    folder.mkdir()
    (folder / "jobs_Jan.txt").write_text("|".join(field.name for field in source.JOB_SCHEMA) + "\n" + "|".join(["1"] * 17) + "\n")
    with pytest.raises(Exception, match="no known month"):
        source.read_jobs(spark, str(tmp_path)).select("period").collect()
    assert source.read_jobs(spark, str(tmp_path), 2025).count() == 0  # not looked for below
    assert source.read_jobs(spark, str(folder), 2025).select("period").first()[0] == dt.date(2025, 1, 1)


@pytest.mark.parametrize(("texts", "kind"), [
    ([None, ""], None), (["1", "-2", "+3"], "INT"), (["1", "2147483648"], "BIGINT"), (["1", "99999999999999999999"], "DOUBLE"),
    (["1", "2.5", ".5", "1e3", "7."], "DOUBLE"), (["1", "x"], "STRING"), (["0:0"], "STRING"), (["1d"], "STRING"), (["NaN"], "STRING"), ([" 1"], "STRING"), (["2020-01-01"], "STRING"),
])
def test_types_of_texts(spark, texts, kind):
    df = spark.createDataFrame([("f", text) for text in texts], "file string, a string")
    assert [tuple(row) for row in source.inferred_types(df, ["a"], ["file"]).collect()] == [("f", "a", kind)]


def test_types_are_widened_over_files(spark):
    rows = [("f", "a", "INT"), ("g", "a", "BIGINT"), ("f", "b", "INT"), ("g", "b", "DOUBLE"), ("f", "c", "INT"), ("g", "c", "STRING"), ("f", "d", None), ("g", "d", "INT"), ("f", "e", None)]
    merged = source.merged_types(spark.createDataFrame(rows, "file string, name string, type string"))
    assert rows_of(merged) == sorted([("a", "BIGINT"), ("b", "DOUBLE"), ("c", "STRING"), ("d", "INT"), ("e", None)], key=repr)


def test_inferred_read_is_one_pass_more_and_has_the_same_rows(extract, spark):
    types = source.inferred_types(source.read_texts(spark, extract), ["JobIDRaw", "CPUTimeRAW"], ["file_name"])
    assert plan_of(types).count("FileScan") == 1
    inferred = source.read_jobs_inferred(spark, extract)
    kinds = dict(inferred.dtypes)
    assert (kinds["JobIDRaw"], kinds["CPUTimeRAW"], kinds["Reservation"], kinds["ReservationId"], kinds["ExitCode"], kinds["AllocNodes"]) == ("int", "bigint", "string", "bigint", "string", "int")
    declared = source.read_jobs(spark, extract)
    assert rows_of(usage.usage_cube(inferred)) == rows_of(usage.usage_cube(declared))


def test_parts_are_moved_by_their_values(spark, tmp_path):
    rows = spark.createDataFrame([("a/b", 1, "x"), ("a/b", 2, "y"), ("c d", 1, "z")], "k string, n int, v string")
    staged = f"{tmp_path}/_staged"
    rows.repartition(1).write.partitionBy("k", "n").text(staged)
    files.move_parts(spark, staged, str(tmp_path), lambda values, number: f"{values['k'].replace('/', '-')}/{values['n']}.{number}")
    assert sorted(str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*") if f.is_file() and not f.name.endswith(".crc")) == ["a-b/1.0", "a-b/2.0", "c d/1.0"]
    assert not (tmp_path / "_staged").exists()


def test_prompts_keep_their_texts(spark, tmp_path):
    rows = [("small", "1", "one\ntwo\n"), ("small", "2", ""), ("large", "1", "été \U0001f600")]
    prompts = spark.createDataFrame(rows, "prompt_type string, prompt_id string, text string")
    measurements.write_prompts(prompts, str(tmp_path / "prompts"))
    read = registered.names.without_last_feed(F.col("text"))
    assert rows_of(measurements.read_prompts(spark, str(tmp_path / "prompts")).withColumn("text", read)) == sorted(rows)
    answers = prompts.select(F.lit("m").alias("model"), "prompt_type", "prompt_id", F.col("text").alias("content"))
    measurements.write_response_files(answers, str(tmp_path / "responses"))
    assert rows_of(measurements.read_response_files(spark, str(tmp_path / "responses"))) == rows_of(answers)


def test_measurements_with_another_header_stop_the_read(spark, tmp_path):
    measurements.write_measurements(driver_tables.file_measurements(spark, SF).limit(20), str(tmp_path / "m"))
    assert measurements.read_written_measurements(spark, str(tmp_path / "m")).count() == 20
    folder = tmp_path / "m" / "compiler=x" / "model=y" / "quantization=z"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("other,header\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|column"):
        measurements.read_written_measurements(spark, str(tmp_path / "m")).collect()


def test_reports_come_back_under_their_months(spark, tmp_path):
    params = spark.createDataFrame([(dt.date(2025, 1, 1), 0, "a", "1"), (dt.date(2025, 2, 1), 0, "a", "{x}")], "report date, position int, key string, value string")
    tables.write_reports(params, str(tmp_path / "r"))
    assert rows_of(tables.read_reports(spark, str(tmp_path / "r"))) == [(dt.date(2025, 1, 1), "a", "1"), (dt.date(2025, 2, 1), "a", "{x}")]


def test_nested_records_of_jobs(spark, tmp_path):
    jobs = spark.createDataFrame([(1, "a"), (2, "b")], "job_id bigint, name string")
    stages = spark.createDataFrame([(10, 4), (11, 5)], "stage_id bigint, num_tasks bigint")
    links = spark.createDataFrame([(1, 11), (1, 10), (1, 12)], "job_id bigint, stage_id bigint")
    documents = profile.job_documents(jobs, links, stages)
    tables.write_json(documents, str(tmp_path / "j"))
    read = {row["job_id"]: row for row in tables.read_json(spark, str(tmp_path / "j"), documents.schema).collect()}
    assert [(s["stage_id"], s["record"] and s["record"]["num_tasks"]) for s in read[1]["stages"]] == [(10, 4), (11, 5), (12, None)]
    assert read[2]["stages"] == []


def test_tables_go_to_the_folder_that_the_session_names(spark, tmp_path, monkeypatch):
    # A running session does not let the setting itself be changed.
    monkeypatch.setattr(shared_folder, "CHECKPOINT_SETTING", "spark.tests.checkpoint")
    spark.conf.set("spark.tests.checkpoint", f"file://{tmp_path}/")
    try:
        assert shared_folder.written(spark.range(3).toDF("x"), "some").count() == 3
        assert [path.name.split("-")[0] for path in (tmp_path / "tallywork").iterdir()] == ["some"]
    finally:
        spark.conf.unset("spark.tests.checkpoint")


class Cluster:
    """As much of a session on a cluster as the folder is asked of, without a setting."""

    class conf:
        get = staticmethod(lambda name, default: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder.shared_folder(Cluster)


def test_files_are_written_and_named_in_tasks(spark, tmp_path, monkeypatch):
    """No file goes through the driver, and names and texts are those that Spark's own writer gives."""
    monkeypatch.setattr(files, "move_parts", None)
    keys = [("a/b", "1:2"), ("c d=%", "ä^{"), ("m", "it's [x]?*#"), (None, "n"), ("", "e")]
    rows = [(kind, name, text, i) for i, (kind, name) in enumerate(keys) for text in ("one\ntwo", "", None)]
    answers = spark.createDataFrame(rows, "prompt_type string, prompt_id string, content string, n int").withColumn("model", F.concat(F.lit("m"), "n"))
    measurements.write_response_files(answers, str(tmp_path / "own"))
    plain = answers.orderBy("content").coalesce(1).select("model", "prompt_type", "prompt_id", F.col("content").alias("value"))
    plain.write.partitionBy("model", "prompt_type", "prompt_id").text(str(tmp_path / "spark"))
    texts = [{str(f.parent.relative_to(tmp_path / name)): sorted(f.read_bytes().split(b"\n")) for f in (tmp_path / name).rglob("part-*")} for name in ("own", "spark")]
    assert texts[0] == texts[1] and len(texts[0]) == len(keys)
    read = [measurements.read_response_files(spark, str(tmp_path / name)).drop("content") for name in ("own", "spark")]
    assert rows_of(read[0]) == rows_of(read[1])
    measurements.write_response_files(answers.limit(0), str(tmp_path / "own"))
    assert measurements.read_response_files(spark, str(tmp_path / "own")).count() == 0
    prompts = answers.select("prompt_type", "prompt_id", F.col("content").alias("text")).where("prompt_type = 'm' OR prompt_type IS NULL")
    measurements.write_prompts(prompts, str(tmp_path / "prompts"))
    found = sorted(str(f.relative_to(tmp_path / "prompts")) for f in (tmp_path / "prompts").rglob("*") if f.is_file())
    assert found == [f"{files.NO_VALUE}/n", "m/it's [x]?*#"]
