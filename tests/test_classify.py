import pytest
from pyspark.sql import functions as F

from tallywork.functions import classify
from tallywork.operators import usage

EDGE_ROWS = [
    # Partition, AllocTRES, NNodes, expected cluster, expected nodes
    ("normal-arm", "billing=1,gres/gpu=4", 2, "arm", 2),
    ("normal-a100-40", None, 3, "gpu", 3),
    ("normal-a100-40", "", 3, "gpu", 3),
    ("normal-a100-40", "billing=1,gres/gpu=2", 1, "gpu", 2),
    ("normal-a100-40", "cpu=1,gres/gpu=12,node=3", 3, "gpu", 12),
    ("normal-a100-80", "billing=1", 2, "gpu", 8),
    ("normal-a100-80", "gres/gpu=", 2, "gpu", 8),
    ("arm-a100", None, 1, "arm", 1),
    ("arm-a100", "billing=1", 1, "arm", 4),
    ("normal-x86", "gres/gpu=9", 5, "amd", 5),
    (None, "gres/gpu=9", 5, "amd", 5),
]


def test_cluster_and_virtual_nodes(spark):
    rows = [(n, *row) for n, row in enumerate(EDGE_ROWS)]
    schema = "n INT, Partition STRING, AllocTRES STRING, NNodes INT, cluster STRING, nodes BIGINT"
    got = spark.createDataFrame(rows, schema).select(
        "n",
        classify.cluster(F.col("Partition")).alias("cluster"),
        classify.virtual_nodes(F.col("Partition"), F.col("AllocTRES"), F.col("NNodes")),
    )
    assert [tuple(r)[1:] for r in got.orderBy("n").collect()] == [row[3:] for row in EDGE_ROWS]


@pytest.mark.parametrize(
    ("account", "expected"),
    [("f123", "FCT"), ("ee123", "EHPC"), ("e1", "LOCAL"), ("xf", "LOCAL"), (None, "LOCAL")],
)
def test_agency(spark, account, expected):
    df = spark.createDataFrame([(account,)], "a STRING")
    assert df.select(classify.agency(F.col("a"))).first()[0] == expected


def test_outcome_and_state(spark):
    states = ["COMPLETED", "FAILED", "CANCELLED by 12", "COMPLETED+", None]
    df = spark.createDataFrame([(n, s) for n, s in enumerate(states)], "n INT, State STRING")
    got = df.orderBy("n").select(
        classify.outcome(F.col("State")), classify.base_state(F.col("State"))
    )
    assert [tuple(r) for r in got.collect()] == [
        ("COMPLETED", "COMPLETED"),
        ("FAILED", "FAILED"),
        ("FAILED", "CANCELLED"),
        ("FAILED", "COMPLETED+"),
        ("FAILED", None),
    ]


def test_gpu_share_nodes(spark):
    rows = [("a100", 1, 7), ("a100", 32, 7), ("a100", 33, 7), ("a100", 0, 7), ("x", 33, 7)]
    df = spark.createDataFrame(rows, "p STRING, cpus INT, nodes INT")
    shares = classify.gpu_share_nodes(F.col("p"), F.col("cpus"), F.col("nodes"))
    assert [r[0] for r in df.select(shares).collect()] == [1, 1, 2, 0, 7]


def test_node_seconds_do_not_overflow(spark):
    df = spark.createDataFrame([(2**31 - 1, 1632)], "ElapsedRaw INT, nodes INT")
    seconds = classify.node_seconds(F.col("ElapsedRaw"), F.col("nodes"))
    assert df.select(seconds).first()[0] == (2**31 - 1) * 1632


def test_jobs_by_state(spark):
    states = [("CANCELLED by 1",), ("CANCELLED by 2",), ("COMPLETED",)]
    got = usage.jobs_by_state(spark.createDataFrame(states, "State STRING"))
    assert {r.state: r.job_count for r in got.collect()} == {"CANCELLED": 2, "COMPLETED": 1}
