"""From job records to grouped usage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions import classify, numbers


def classified(jobs: DataFrame) -> DataFrame:
    """Add outcome, cluster, agency, virtual nodes and node-seconds to every job."""
    partition = F.col("Partition")
    nodes = classify.virtual_nodes(partition, F.col("AllocTRES"), F.col("NNodes"))
    return jobs.select(
        "*",
        classify.outcome(F.col("State")).alias("outcome"),
        classify.cluster(partition).alias("cluster"),
        classify.agency(F.col("Account")).alias("agency"),
        nodes.alias("vnodes"),
        classify.node_seconds(F.col("ElapsedRaw"), nodes).alias("job_seconds"),
    )


def narrow(jobs: DataFrame) -> DataFrame:
    """The five columns that reports need; this is what is worth storing."""
    return classified(jobs).select("period", "outcome", "cluster", "agency", "job_seconds")


def _counts_and_seconds(jobs: DataFrame, *keys: str) -> DataFrame:
    return jobs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("job_count"),
        F.coalesce(F.sum("job_seconds"), F.lit(0)).alias("total_secs"),
    )


def usage_cube(jobs: DataFrame) -> DataFrame:
    """Jobs and node-seconds by period, cluster, agency and outcome, in one pass.

    At most 18 rows per period, and every task sends at most that many: the size of the input
    and a busy cluster or month make no difference to the shuffle.
    """
    return _counts_and_seconds(narrow(jobs), "period", "cluster", "agency", "outcome")


def cube_of(stored: DataFrame) -> DataFrame:
    """The same cube from a stored narrow table."""
    return _counts_and_seconds(stored, "period", "cluster", "agency", "outcome")


def jobs_by_outcome(jobs: DataFrame, *more: str) -> DataFrame:
    return (
        classified(jobs)
        .groupBy(*more, "outcome", "cluster")
        .agg(F.count(F.lit(1)).alias("job_count"))
    )


def nonlocal_seconds(jobs: DataFrame, *more: str) -> DataFrame:
    """Node-seconds by cluster of the work that is not local."""
    work = classified(jobs).filter(F.col("agency") != classify.OTHER_AGENCY)
    return work.groupBy(*more, "cluster").agg(
        F.coalesce(F.sum("job_seconds"), F.lit(0)).alias("total_secs")
    )


def nonlocal_hours(jobs: DataFrame, *more: str) -> DataFrame:
    seconds = nonlocal_seconds(jobs, *more)
    return seconds.select(*more, "cluster", numbers.hours(F.col("total_secs")).alias("used_hours"))


def nonlocal_jobs(jobs: DataFrame, *more: str) -> DataFrame:
    work = classified(jobs).filter(F.col("agency") != classify.OTHER_AGENCY)
    return work.groupBy(*more, "cluster").agg(F.count(F.lit(1)).alias("job_count"))


def agency_jobs(jobs: DataFrame, agency: str, *more: str) -> DataFrame:
    """Jobs by cluster of one agency; filtered before the aggregate."""
    work = classified(jobs).filter(F.col("agency") == agency)
    return work.groupBy(*more, "agency", "cluster").agg(F.count(F.lit(1)).alias("job_count"))


def agency_sums(jobs: DataFrame, agency: str, columns: list[str], *more: str) -> DataFrame:
    """Sums of the named columns by cluster of one agency."""
    work = classified(jobs).filter(F.col("agency") == agency)
    return work.groupBy(*more, "agency", "cluster").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{c.lower()}") for c in columns]
    )


def jobs_by_state(jobs: DataFrame) -> DataFrame:
    state = classify.base_state(F.col("State"))
    return jobs.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("job_count"))
