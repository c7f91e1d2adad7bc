"""Running totals and row numbers that no single task has to compute alone.

A plain window sends all rows of a key to one task. When one configuration holds a third of the
table that task never ends. Here the rows of a key are cut into blocks by their sequence number:

* the window runs inside (key, block), so a group has at most 2^bits rows;
* what comes before a block is one small aggregate per block (combined before the shuffle), and
  the same scan over those block rows, one level up.

The order column is an integer that is unique within a key (a run number, an event number), which
is what bounds a block. Two levels of 2^20 cover 2^60 sequence numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 20
LEVELS = 2


def in_blocks(
    df: DataFrame, keys: Sequence[str], order: str, bits: int, level: int = 1
) -> tuple[DataFrame, list[str]]:
    """Add the block number, and the key as one struct, so that NULL keys join with themselves.

    Also returns the names of the two columns. Neither can be NULL: the join on them adds no
    filter to either side, and the block rows are shuffled once for all that use them.
    """
    group, block = f"_group_{level}", f"_block_{level}"
    number = F.shiftright(F.coalesce(F.col(order).cast("bigint"), F.lit(0)), bits)
    return df.select("*", F.struct(*keys).alias(group), number.alias(block)), [group, block]


def scan_before(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Mapping[str, Column],
    bits: int = BITS,
    levels: int = LEVELS,
    last: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add sums over all rows of the key that come earlier in ``order``, 0 where there are none.

    ``last`` adds what the nearest earlier row has, NULL for the first row, and ``following`` what the nearest
    later one has, NULL for the last row.
    """
    last, following = last or {}, following or {}

    def so_far(
        group: Sequence[str],
        sums: Mapping[str, Column],
        last: Mapping[str, Column],
        following: Mapping[str, Column],
    ) -> list[Column]:
        earlier = Window.partitionBy(*group).orderBy(order)
        before = earlier.rowsBetween(Window.unboundedPreceding, -1)
        return (
            [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for n, c in sums.items()]
            + [F.lag(c).over(earlier).alias(n) for n, c in last.items()]
            + [F.lead(c).over(earlier).alias(n) for n, c in following.items()]
        )

    if levels == 0:
        return df.select("*", *so_far(keys, sums, last, following))

    rows, at = in_blocks(df, keys, order, bits, levels)
    group, block = at
    own, carried, local = f"_own_{levels}_", f"_carry_{levels}_", f"_local_{levels}_"
    names = [*sums, *last, *following]
    blocks = rows.groupBy(at).agg(
        *[F.sum(c).alias(own + n) for n, c in sums.items()],
        *[F.max_by(c, order).alias(own + n) for n, c in last.items()],
        *[F.min_by(c, order).alias(own + n) for n, c in following.items()],
    )
    carry = scan_before(
        blocks,
        [group],
        block,
        {carried + n: F.col(own + n) for n in sums},
        bits,
        levels - 1,
        {carried + n: F.col(own + n) for n in last},
        {carried + n: F.col(own + n) for n in following},
    ).select(*at, *[carried + n for n in names])
    within = so_far(at, *({local + n: c for n, c in own.items()} for own in (sums, last, following)))
    in_order = Window.partitionBy(*at).orderBy(order)
    marks = [(F.row_number().over(in_order) == 1).alias(f"_opens_{levels}")] if last else []
    marks += [F.lead(F.lit(1)).over(in_order).isNull().alias(f"_closes_{levels}")] if following else []
    scanned = rows.join(carry, at).select("*", *within, *marks)
    return scanned.selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"{local}{n} + {carried}{n} AS {n}" for n in sums],
        *[f"CASE WHEN _opens_{levels} THEN {carried}{n} ELSE {local}{n} END AS {n}" for n in last],
        *[f"CASE WHEN _closes_{levels} THEN {carried}{n} ELSE {local}{n} END AS {n}" for n in following],
    )


def first_rows(
    df: DataFrame, keys: Sequence[str], order: str, count: int, name: str = "run", bits: int = BITS
) -> DataFrame:
    """The first rows of every key in ``order``, numbered from 1.

    First the rows of each block are cut to that many and then those of the key, so a key's last
    window sees so many rows of each block at most. Spark cuts small counts in every task before
    the shuffle.
    """
    rows, at = in_blocks(df, keys, order, bits)
    for group in (at, list(keys)):
        number = F.row_number().over(Window.partitionBy(*group).orderBy(order))
        rows = rows.withColumn(name, number).filter(F.col(name) <= count)
    return rows.select(*[f"`{c}`" for c in df.columns], name)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str, name: str = "run", bits: int = BITS
) -> DataFrame:
    """Number the rows of every key from 1 in ``order``."""
    numbered = scan_before(df, keys, order, {name: F.lit(1)}, bits=bits)
    return numbered.withColumn(name, F.col(name) + 1)
