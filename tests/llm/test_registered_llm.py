"""The training-data queries that have SQL, against it."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from odd_rows import SMALL

from tallywork.llm import registered


def test_one_query_for_each_operator():
    numbers = sorted(int(name.split("_")[0].removeprefix("op")) for name in registered.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_same_as_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got = registered.QUERIES[name](spark, SMALL)
    found = duck.execute(registered.ORACLES[name])
    names = [column[0] for column in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(found.fetchall(), key=repr)
