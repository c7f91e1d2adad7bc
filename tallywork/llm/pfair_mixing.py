"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in order of doc_id, are cut into blocks of equal size. Its k-th block (from 0) of a phase
is released at slot floor(k / w) and due by slot ceil((k + 1) / w), w being its share of the weights of the
sources that still have blocks. Each slot goes to the released block that is due first, so at any time a source
has had less than one block more or less than its weight gives it. Weights are whole parts, so a phase repeats
after as many slots as the parts add up to: one period is laid out on the driver, and Spark finds the slot of
each block from its number. When a source has given its last block a new phase begins with the others.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm import shared

BLOCK_CHARS = 1 << 16
PARTS = 1000
TEMPERATURE = 0.7
MOST_SOURCES = 1000
#: Bytes of phases that are broadcast. Their number may grow with the square of that of the sources; beyond this they are joined by shuffle.
MOST_BROADCAST = 16 << 20


@dataclass(frozen=True)
class Phase:
    """One source in one phase: its blocks from `used` to before `until`, and the slots of one period."""

    source: str
    phase: int
    used: int
    until: int
    base: int
    period: int
    parts: int
    slots: list[int]


def period(parts: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source in one period, by earliest deadline among released blocks; ties go by name."""
    total = sum(parts.values())
    slots: dict[str, list[int]] = {name: [] for name in parts}
    released: list[tuple[int, str]] = []
    coming = [(0, name) for name in sorted(parts)]
    heapq.heapify(coming)
    for slot in range(total):
        while coming and coming[0][0] <= slot:
            _, name = heapq.heappop(coming)
            heapq.heappush(released, (-(-(len(slots[name]) + 1) * total // parts[name]), name))
        _, name = heapq.heappop(released)
        slots[name].append(slot)
        if len(slots[name]) < parts[name]:
            heapq.heappush(coming, (len(slots[name]) * total // parts[name], name))
    return slots


def phases(blocks: dict[str, int], parts: dict[str, int]) -> list[Phase]:
    """All phases until each source has given its blocks; a source that gives none in a phase has no row there.

    A phase is laid out only up to its end, at most for one period, and what has one part, as most of many sources have, waits
    in the order of names. So the work and the rows follow the blocks, and not the square of the number of sources.
    """
    left = {name: number for name, number in blocks.items() if number > 0}
    several = [name for name in sorted(left) if parts[name] != 1]
    ones = [name for name in sorted(left) if parts[name] == 1]
    used, base, number = dict.fromkeys(left, 0), 0, 0
    out: list[Phase] = []
    while several or ones:
        total = len(ones) + sum(parts[name] for name in several)
        slots: dict[str, list[int]] = {}
        released, coming, at, ended = [(-(-total // parts[name]), name) for name in several], [], 0, None
        heapq.heapify(released)
        for slot in range(total):
            while coming and coming[0][0] <= slot:
                _, name = heapq.heappop(coming)
                heapq.heappush(released, (-(-(len(slots[name]) + 1) * total // parts[name]), name))
            if at < len(ones) and not (released and released[0] < (total, ones[at])):
                name, at = ones[at], at + 1
            else:
                _, name = heapq.heappop(released)
            own = slots.setdefault(name, [])
            own.append(slot)
            if len(own) == left[name]:
                ended = name
                break
            if len(own) < parts[name]:
                heapq.heappush(coming, (len(own) * total // parts[name], name))
        if ended is not None:
            length, given = slot + 1, {name: len(own) for name, own in slots.items()}
        else:
            ends = {}
            for name, own in slots.items():
                whole, rest = divmod(left[name] - 1, parts[name])
                ends[name] = whole * total + own[rest] + 1
            length = min(ends.values())
            whole, rest = divmod(length, total)
            given = {name: whole * parts[name] + sum(slot < rest for slot in own) for name, own in slots.items()}
        for name in sorted(given):
            out.append(Phase(name, number, used[name], used[name] + given[name], base, total, parts[name], slots[name]))
            used[name] += given[name]
            left[name] -= given[name]
            if not left[name]:
                (ones if parts[name] == 1 else several).remove(name)
        base, number = base + length, number + 1
    return out


def target_parts(sizes: dict[str, int], temperature: float = TEMPERATURE) -> dict[str, int]:
    """Weights in whole parts, from sizes to the power of the temperature: 1 keeps the sizes' shares, 0 makes all equal."""
    powers = {name: size**temperature for name, size in sizes.items()}
    total = sum(powers.values())
    return {name: max(1, round(PARTS * power / total)) for name, power in powers.items()}


def _source(source: Column) -> Column:
    return F.coalesce(source.cast("string"), F.lit(""))


def scheduled(documents: DataFrame, parts: dict[str, int] | None = None, temperature: float = TEMPERATURE, block_chars: int = BLOCK_CHARS, grouped: bool = False, bounded: bool = True) -> DataFrame:
    """The documents with mix_source, block, phase, release, deadline, slot and mix_place.

    `parts` are the target weights by source; without them they follow the sizes of the sources, counted over
    all documents. A source that isn't among them gets one part. slot and then mix_place (characters of the
    source before the document) give the order of the mixture. A document that is longer than a block takes as
    many blocks as it fills. A NULL source is the source ''; a NULL or empty text counts one character; rows
    that share a doc_id go by a hash of their text, NULL doc_ids first. No documents: no rows. Existing columns stay, but those
    with one of the seven names are replaced.

    No source has to fit into a task: running sizes are taken within ranges of doc_id and carried over as one
    number for each range and source. Each source is scheduled for itself, however many there are, if not `bounded`: the driver gets
    one row for each and plans all of their blocks. Bounded, more than MOST_SOURCES are an error. Only if `grouped`, whatever their
    number, half as many sources, those with the most characters, stay, and
    the others share groups by the hash of their name. A group has the sum of its sources' weights, its name begins
    with a zero character, and its documents follow one another by a hash, so its sources are mixed in it.
    """
    added = ("mix_source", "block", "phase", "release", "deadline", "slot", "mix_place")
    rest = [name for name in documents.columns if name not in added]
    given = shared.folded(documents, "text")
    bounds = shared.range_bounds(documents, "doc_id")
    size = F.length(F.coalesce("text", F.lit(""))) + 1
    rows = given.select("row", "text", F.col("row.doc_id").alias("doc_id"), _source(F.col("row.source")).alias("mix_source"), shared.range_of(F.col("row.doc_id"), bounds).alias("mix_range"), size.cast("bigint").alias("mix_size"), F.xxhash64("text").alias("mix_tie"))
    sums = shared.written(rows.groupBy("mix_source", "mix_range").agg(F.sum("mix_size").alias("sum")), "source-sizes")
    totals = sums.groupBy("mix_source").agg(F.sum("sum").alias("sum"))
    rows = rows.withColumn("mix_key", F.col("doc_id"))
    if grouped:
        kept = [row["mix_source"] for row in totals.orderBy(F.desc("sum"), "mix_source").limit(MOST_SOURCES // 2).collect()]
        single = F.col("mix_source").isin(kept)
        group = F.when(single, F.col("mix_source")).otherwise(F.concat(F.lit("\0"), F.pmod(F.xxhash64("mix_source"), F.lit(MOST_SOURCES - len(kept))).cast("string")))
        given_parts = F.create_map(*(F.lit(x) for pair in parts.items() for x in pair)) if parts else None
        weight = F.coalesce(F.try_element_at(given_parts, F.col("mix_source")), F.lit(1)).cast("double") if parts else F.pow("sum", F.lit(temperature))
        groups = totals.select(group.alias("mix_group"), "sum", weight.alias("weight")).groupBy("mix_group").agg(F.sum("sum").alias("sum"), F.sum("weight").alias("weight")).orderBy("mix_group").collect()
        sizes = {row["mix_group"]: row["sum"] for row in groups}
        every = sum(row["weight"] for row in groups)
        own = {row["mix_group"]: int(row["weight"]) if parts else max(1, round(PARTS * row["weight"] / every)) for row in groups}
        key = F.when(single, F.col("doc_id")).otherwise(F.xxhash64("doc_id", "mix_source"))
        hashed = F.call_function("shiftright", F.xxhash64("doc_id", "mix_source"), F.lit(50)).cast("int")
        rows = rows.withColumns({"mix_key": key, "mix_range": F.when(single, F.col("mix_range")).otherwise(hashed), "mix_source": group})
        sums = shared.written(rows.groupBy("mix_source", "mix_range").agg(F.sum("mix_size").alias("sum")), "group-sizes")
    else:
        found = (totals.orderBy("mix_source").limit(MOST_SOURCES + 1) if bounded else totals.orderBy("mix_source")).collect()
        if bounded and len(found) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources: give groups of them one name before mixing, or mix without a bound")
        sizes = {row["mix_source"]: row["sum"] for row in found}
        own = {name: (parts or {}).get(name, 1) for name in sizes} if parts else target_parts(sizes, temperature)
    plan = phases({name: (total - 1) // block_chars + 1 for name, total in sizes.items()}, own)
    schema = "mix_source string, phase int, used bigint, until bigint, base bigint, period bigint, parts bigint, slots array<int>"
    table = documents.sparkSession.createDataFrame([tuple(vars(line).values()) for line in plan], schema)

    before = Window.partitionBy("mix_source").orderBy("mix_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = shared.written(sums.select("mix_source", "mix_range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("mix_base")), "source-bases")
    within = Window.partitionBy("mix_source", "mix_range").orderBy("mix_key", "mix_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("mix_run", F.sum("mix_size").over(within)).join(bases, ["mix_source", "mix_range"])
    place = F.col("mix_base") + F.col("mix_run") - F.col("mix_size")
    blocked = placed.withColumn("mix_place", place).withColumn("block", F.floor(F.col("mix_place") / block_chars).cast("bigint"))
    size = sum(64 + len(line.source) + 4 * len(line.slots) for line in plan)
    met = blocked.join(F.broadcast(table) if size <= MOST_BROADCAST else table, "mix_source").where("block >= used AND block < until")
    k = F.col("block") - F.col("used")
    whole, step = F.floor(k / F.col("parts")).cast("bigint"), (k % F.col("parts")).cast("int")
    release = F.col("base") + F.expr("(block - used) * period div parts")
    deadline = F.col("base") + F.expr("((block - used + 1) * period + parts - 1) div parts")
    slot = F.col("base") + whole * F.col("period") + F.get("slots", step)
    return met.select(*shared.unfolded(rest, "text"), "mix_source", "block", "phase", release.alias("release"), deadline.alias("deadline"), slot.alias("slot"), "mix_place")


def mixed(documents: DataFrame, parts: dict[str, int] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """The documents, their columns as they are, laid out in the order of the mixture: its files, read by number, give it."""
    own = scheduled(shared.folded(documents, "text", "doc_id", "source"), parts, temperature, bounded=False)
    ordered = own.repartitionByRange("slot", "mix_place").sortWithinPartitions("slot", "mix_place")
    return ordered.select(shared.unfolded(documents.columns, "text", "doc_id", "source"))
