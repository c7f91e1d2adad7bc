"""Document fingerprints by invertible Bloom lookup sketches.

A text's set of paragraphs (lines, long ones cut every 32 words) is hashed to 64-bit digests. Each digest goes
to one cell of each of three tables; a cell holds a count, the digests' exclusive or and their checks'. The
sketches of two versions subtract cell by cell, which cancels what they share. A cell with one digest left
gives it away; taking it out of its other cells uncovers more, until the differing digests of both sides are
recovered or cells remain. Then the pair is tried again with larger tables and other hashes.

Cells are rows. Texts are shuffled once, by ranges of doc_id, and all peeling rounds aggregate within the
partitions that this gives, so no cell is shuffled. A round looks at one table only, where a digest has one
cell, so that it can't be taken out twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm import shared

PARAGRAPH = r"\S++(?:[^\S\n]++\S++){0,31}+"
TABLES = 3
STORED_CELLS = 4
ROUNDS = 9
FILL = 1.0
LEAST_CELLS = 16

CELL = "struct<n:int,ids:bigint,checks:int>"
PAIRS = ("edited", "next")


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda paragraph: F.xxhash64(paragraph)))


def _cell(digest: Column, table: Column, size: Column, attempt: int) -> Column:
    return F.pmod(F.xxhash64(digest, table, F.lit(attempt)), size)


def _check(digest: Column) -> Column:
    return F.hash(digest)


def stored_cells(ids: Column, cells: int = STORED_CELLS) -> Column:
    """The sketch of a set of digests that is kept as its fingerprint: three tables of a few cells, in order."""

    def cell(number: Column) -> Column:
        table, place = F.floor(number / cells).cast("int"), (number % cells).cast("bigint")
        own = F.filter(ids, lambda digest: _cell(digest, table, F.lit(cells).cast("bigint"), 0) == place)
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("ids"), F.lit(0).alias("checks"))
        add = lambda acc, digest: F.struct((acc["n"] + 1).alias("n"), acc["ids"].bitwiseXOR(digest).alias("ids"), acc["checks"].bitwiseXOR(_check(digest)).alias("checks"))
        return F.aggregate(own, zero, add)

    return F.transform(F.sequence(F.lit(0), F.lit(TABLES * cells - 1)), cell)


def fingerprint(ids: Column) -> Column:
    """The stored sketch as hexadecimal text: of each cell count, digests and checks."""
    part = lambda value, width: F.lpad(F.hex(value), width, "0")
    cell = lambda c: F.concat(part(c["n"], 4), part(c["ids"], 16), F.right(part(c["checks"], 16), F.lit(8)))
    return F.lower(F.array_join(F.transform(stored_cells(ids), cell), ""))


def versions(documents: DataFrame, bounds: list[int]) -> DataFrame:
    """Each document with the next one by doc_id: range, key, doc_id, n_chars, own, next, edited (digests), edited_text, copy.

    The next one of the last is the first. Rows that share a doc_id follow one another by text, NULL doc_ids come
    first. `key` stands for doc_id and both texts; `copy` is true on all but the first row of a key. The first
    document of each range is read a second time, as the one after the range before; at most MOST_RANGES are.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.withColumn("range", shared.range_of(F.col("doc_id"), bounds))
    firsts = documents.select("doc_id").withColumn("range", shared.range_of(F.col("doc_id"), bounds)).groupBy("range").agg(F.min(F.struct("doc_id")).alias("first"))
    order = Window.orderBy("range")
    before = firsts.select(F.col("first.doc_id").alias("first_id"), F.lag("range").over(order).alias("before"), F.max("range").over(Window.partitionBy()).alias("last"))
    after = rows.join(F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("first_id")))
    ends = after.select("doc_id", "text", F.coalesce("before", "last", F.lit(0)).alias("range"), F.lit(True).alias("end"), F.col("before").isNull().alias("wrapped"))
    every = ranged.select("doc_id", "text", "range", F.lit(False).alias("end"), F.lit(False).alias("wrapped")).unionByName(ends).withColumn("own", digests(F.col("text")))
    window = Window.partitionBy("range").orderBy("wrapped", "doc_id", "end", "text")
    following = every.select("*", F.lead("text").over(window).alias("next_text"), F.lead("own").over(window).alias("next")).where("NOT end")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    keyed = following.select("range", "doc_id", "text", F.xxhash64("doc_id", "text", "next_text").alias("key"), F.length("text").cast("bigint").alias("n_chars"), "own", "next", edited.alias("edited_text"))
    within = Window.partitionBy("range").orderBy("doc_id", "text", "key")
    numbered = keyed.withColumn("copy", F.coalesce(F.lag("key").over(within) == F.col("key"), F.lit(False))).drop("text")
    return numbered.withColumn("edited", digests(F.col("edited_text")))


def _slot(level: Column, pair: Column, table: Column, cell: Column) -> Column:
    """A cell's name in one number: level, pair, table and place."""
    place = F.call_function("shiftleft", ((level * 2 + pair) * 4 + table).cast("bigint"), F.lit(40))
    return place.bitwiseOR(cell)


def _of_slot(slot: Column) -> tuple[Column, Column, Column]:
    high = F.call_function("shiftright", slot, F.lit(40)).cast("int")
    return F.floor(high / 8).cast("int"), F.floor(high / 4).cast("int") % 2, high % 4


def subtracted(rows: DataFrame, attempt: int) -> DataFrame:
    """The cells of both pairs of each row, the second version's taken from the first's: range, key, slot, digest, n, ids, checks."""

    def level(other: str) -> Column:
        fit = F.log2(F.greatest(F.ceil((F.size("own") + F.size(other)) * FILL), F.lit(LEAST_CELLS)).cast("double"))
        return F.ceil(fit).cast("int") + attempt

    side = lambda pair, other, sign, ids: F.struct(F.lit(pair).alias("pair"), F.lit(sign).alias("n"), level(other).alias("level"), F.col(ids).alias("set"))
    sides = F.array(*(side(pair, other, sign, ids) for pair, other in enumerate(PAIRS) for sign, ids in ((1, "own"), (-1, other))))
    sets = rows.select("range", "key", F.inline(sides))
    each = sets.select("range", "key", "pair", "n", "level", F.explode("set").alias("ids"))
    put = each.select("*", F.explode(F.array(*map(F.lit, range(TABLES)))).alias("table"))
    cell = _cell(F.col("ids"), F.col("table"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("level")), attempt)
    cells = put.select("range", "key", _slot(F.col("level"), F.col("pair"), F.col("table"), cell).alias("slot"), F.lit(None).cast("bigint").alias("digest"), "n", "ids", _check(F.col("ids")).alias("checks"))
    return _summed(cells)


def _summed(cells: DataFrame) -> DataFrame:
    total = cells.groupBy("range", "key", "slot", "digest").agg(F.sum("n").cast("int").alias("n"), F.bit_xor("ids").alias("ids"), F.bit_xor("checks").alias("checks"))
    return total.where("n <> 0 OR ids <> 0 OR checks <> 0")


def peeled(cells: DataFrame, attempt: int, rounds: int = ROUNDS) -> DataFrame:
    """The cells after some rounds; a recovered digest is a row of the fourth table, its n the side that has it."""

    def one(cells: DataFrame, table: int) -> DataFrame:
        level, pair, own = _of_slot(F.col("slot"))
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        alone = (own == table) & (F.abs("n") == 1) & (F.col("checks") == _check(F.col("ids")))

        def row(slot: Column, digest: Column, n: Column) -> Column:
            return F.struct(slot.alias("slot"), digest.alias("digest"), n.alias("n"), F.col("ids").alias("ids"), F.col("checks").alias("checks"))

        nothing = F.lit(None).cast("bigint")
        out = [row(_slot(level, pair, F.lit(other), _cell(F.col("ids"), F.lit(other), size, attempt)), nothing, -F.col("n")) for other in range(TABLES) if other != table]
        known = row(_slot(level, pair, F.lit(TABLES), F.lit(0).cast("bigint")), F.col("ids"), F.col("n"))
        kept = row(F.col("slot"), F.col("digest"), F.col("n"))
        return _summed(cells.select("range", "key", F.inline(F.when(alone, F.array(*out, known)).otherwise(F.array(kept)))))

    return reduce(one, [r % TABLES for r in range(rounds)], cells)


def differences(rows: DataFrame, attempt: int) -> DataFrame:
    """Of each row with a difference: range, key, and for both pairs how many digests are the first's alone, the other's, and whether cells remain."""
    _, pair, table = _of_slot(F.col("slot"))
    known = table == TABLES
    found = [
        aggregate
        for number, name in enumerate(PAIRS)
        for aggregate in (
            F.count(F.when(known & (pair == number) & (F.col("n") > 0), 1)).alias(f"{name}_gone"),
            F.count(F.when(known & (pair == number) & (F.col("n") < 0), 1)).alias(f"{name}_new"),
            F.max(~known & (pair == number)).alias(f"{name}_left"),
        )
    ]
    return peeled(subtracted(rows.where("NOT copy"), attempt), attempt).groupBy("range", "key").agg(*found)


SETS = ("own", *PAIRS)


def _judged(rows: DataFrame, attempt: int) -> DataFrame:
    """The rows with both likenesses, and whether a pair has failed; only rows that have keep their digests. A table in the shared folder."""
    both = rows.join(differences(rows, attempt), ["range", "key"], "left")
    size = {name: F.size(name) for name in SETS}
    likeness, failed = [], F.lit(False)
    for name in PAIRS:
        gone, new, left = F.coalesce(f"{name}_gone", F.lit(0)), F.coalesce(f"{name}_new", F.lit(0)), F.coalesce(f"{name}_left", F.lit(False))
        every = size["own"] + new
        likeness.append(F.when(every == 0, 1.0).otherwise((size["own"] - gone) / F.nullif(every, F.lit(0))).alias(f"near_{name}"))
        failed = failed | left | (size["own"] - gone != size[name] - new)
    judged = both.select("range", "key", "copy", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *SETS, *likeness, failed.alias("failed"))
    return shared.written(judged.withColumns({name: F.when(F.col("failed"), F.col(name)) for name in SETS}), "sketches")


def compared(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Likeness is the shared part of all distinct paragraphs of both texts, from the digests that peeling
    recovers; texts without any paragraph are alike (1.0). NULL texts are empty; a text that is all white space
    has no paragraph. The only document is its own next one. Rows that repeat are answered alike. No documents:
    no rows. Other columns are ignored. Rows with a pair whose cells don't come out even are tried again from
    their digests, with tables twice as large each time, until none is left.
    """
    rows = versions(documents, shared.range_bounds(documents, "doc_id"))
    prints = [fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint")]
    named = rows.select("range", "key", "copy", "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), *prints, *SETS)
    attempt, parts = 0, [_judged(named, 0)]
    while parts[-1].where("failed").limit(1).count():
        attempt += 1
        again = parts[-1].where("failed").drop("failed", *(f"near_{name}" for name in PAIRS))
        parts.append(_judged(again, attempt))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return reduce(DataFrame.unionByName, [part.where("NOT failed").select(columns) for part in parts])
