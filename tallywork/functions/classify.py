"""How one accounting record is classified.

The rules are tables: a site with other partition or account names changes them here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, str]]

# Fixed values: (text to look for, class), first match wins, then the class of everything else.
CLUSTER_RULES: Rules = (("arm", "arm"), ("a100", "gpu"))
OTHER_CLUSTER = "amd"
AGENCY_RULES: Rules = (("f", "FCT"), ("ee", "EHPC"))
OTHER_AGENCY = "LOCAL"
GPU_PARTITION = "a100"
GPUS_PER_NODE = 4
CPUS_PER_GPU_SHARE = 32
GPU_COUNT = r"gres/gpu=(\d+)"

CLUSTERS = ("arm", "amd", "gpu")


def _first_match(rules: Rules, test, default: str) -> Column:
    hits = [F.when(test(text), F.lit(label)) for text, label in rules]
    return F.coalesce(*hits, F.lit(default))


def outcome(state: Column) -> Column:
    """COMPLETED, or FAILED for every other state and for none."""
    return F.when(state == "COMPLETED", "COMPLETED").otherwise("FAILED")


def base_state(state: Column) -> Column:
    """The state without the user that a cancelled job carries behind it."""
    return F.regexp_replace(state, "CANCELLED(.*)", "CANCELLED")


def cluster(partition: Column) -> Column:
    return _first_match(CLUSTER_RULES, partition.contains, OTHER_CLUSTER)


def agency(account: Column) -> Column:
    return _first_match(AGENCY_RULES, account.startswith, OTHER_AGENCY)


def gpu_share_nodes(partition: Column, alloc_cpus: Column, nnodes: Column) -> Column:
    """GPU partitions are shared: a node counts once per started block of 32 cores."""
    blocks = F.ceil(alloc_cpus.cast("bigint") / CPUS_PER_GPU_SHARE)
    return F.when(partition.contains(GPU_PARTITION), blocks).otherwise(nnodes).cast("bigint")


def virtual_nodes(partition: Column, alloc_tres: Column, nnodes: Column) -> Column:
    """Nodes, where a whole GPU node counts as its four GPUs.

    A GPU job counts the GPUs it asked for; without any resource text it counts its nodes.
    """
    nodes = nnodes.cast("bigint")
    no_text = alloc_tres.isNull() | (alloc_tres == "")
    # No match gives an empty text; casting NULL instead spares a failed cast per row.
    asked = F.nullif(F.regexp_extract(alloc_tres, GPU_COUNT, 1), F.lit("")).try_cast("bigint")
    gpus = F.when(no_text, nodes).otherwise(F.coalesce(asked, nodes * GPUS_PER_NODE))
    return F.when(partition.contains(GPU_PARTITION), gpus).otherwise(nodes)


def node_seconds(elapsed: Column, nodes: Column) -> Column:
    return elapsed.cast("bigint") * nodes
