from __future__ import annotations

import pytest
from odd_rows import CLASHING, DOCUMENTS, rows
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with other columns under names that operators use inside."""
    return spark.createDataFrame(rows(), DOCUMENTS).repartition(3).withColumns({name: F.lit(1) for name in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
