"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Expressions on a row only: nothing is shuffled, and all work on a text is in proportion to its length (times
the logarithm of its number of spans). A pattern's matches and the gaps between them give all positions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEARBY = 40
KEPT_FROM = 60
CONTEXT_BONUS = 25


def _whole_number(span: Column) -> Column:
    """No digit, letter or hyphen touches the span."""
    return ~span["before"].rlike("[0-9A-Za-z-]$") & ~span["after"].rlike("^[0-9A-Za-z-]")


def _digits(span: Column) -> Column:
    return F.regexp_replace(span["value"], "[^0-9]", "")


def _small_parts(span: Column) -> Column:
    def small(part: Column) -> Column:
        number = F.regexp_replace(part, "^0+", "")
        return (F.length(number) <= 3) & (F.concat(F.lit("0"), F.substring(number, 1, 3)).cast("int") <= 255)

    return F.forall(F.split(span["value"], "[.]"), small)


def _luhn(least: int, most: int) -> Callable[[Column], Column]:
    return lambda span: F.length(_digits(span)).between(least, most) & F.call_function("luhn_check", _digits(span))


def _mod_97(span: Column) -> Column:
    """The rest by 97 of the number that an account code gives, its first four characters moved to the end, is 1."""
    code = F.translate(span["value"], " ", "")
    moved = F.concat(F.substr(code, F.lit(5)), F.substring(code, 1, 4))

    def step(rest: Column, character: Column) -> Column:
        value = F.ascii(character)
        return F.when(value <= 57, rest * 10 + value - 48).otherwise(rest * 100 + value - 55) % 97

    return F.length(code).between(15, 34) & (F.aggregate(F.split(moved, ""), F.lit(0), step) == 1)


@dataclass(frozen=True)
class Kind:
    """A kind of span. sign: a character that each of its matches has; score: in hundredths, before context."""

    name: str
    pattern: str
    sign: str | None
    confirmed: Callable[[Column], Column] | None
    score: int
    words: str


# Possessive repeats give the matches of plain ones, as what follows can't begin with what they repeat, and
# need no stack. An address is looked for only where a run of its characters begins or a match has ended.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", None, 80, "mail|contact|write to|@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", ".", _small_parts, 60, "address|host|server|ip"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", None, _luhn(16, 19), 75, "card|visa|credit|payment|pay"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", lambda span: F.length(_digits(span)).between(8, 15), 60, "phone|call|tel|mobile|fax"),
)
ADDED = (
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", None, lambda span: _whole_number(span) & _mod_97(span), 75, "iban|account|bank|konto|compte|cuenta"),
    Kind("short_card", r"[0-9](?:[ -]?[0-9])++", None, lambda span: _whole_number(span) & _luhn(13, 15)(span), 45, "card|visa|credit|amex|payment"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-", _whole_number, 40, "ssn|social security"),
)

# Added kinds whose greedy match may run on into what follows: a beginning, and how often its last part may repeat.
# Each end where no letter, digit or hyphen touches is tried, the longest first.
AGAIN = {
    "iban": (r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d}", range(30, 10, -1)),
    "short_card": (r"[0-9](?:[ -]?[0-9]){%d}", range(14, 11, -1)),
}
LONGEST = 64
PART = 64


def _running(values: Column, added: Callable[[Column, Column], Column] = lambda a, b: b + a, none: Column | None = None) -> Column:
    """Running totals of an array, or of another operation of what lies before and a value, by doubling steps."""
    none = F.lit(0) if none is None else none
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))

    def doubled(totals: Column, step: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), step)
        return F.transform(totals, lambda value, at: added(F.when(at >= back, F.get(totals, at - back)).otherwise(none), value))

    return F.aggregate(steps, values, doubled)


def _spans(kind: Kind, matches: Column, gaps: Column, ends: Column) -> Column:
    def span(value: Column, at: Column) -> Column:
        end = F.get(ends, at)
        before, after = F.get(gaps, at), F.get(gaps, at + 1)
        return F.struct(F.lit(kind.name).alias("kind"), (end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"), F.right(before, F.lit(NEARBY)).alias("before"), F.left(after, F.lit(NEARBY)).alias("after"))

    return F.transform(matches, span)


def _scored(kind: Kind, span: Column) -> Column:
    nearby = F.lower(F.concat_ws(" ", span["before"], span["after"]))
    score = F.least(F.lit(kind.score) + F.when(nearby.rlike(kind.words), CONTEXT_BONUS).otherwise(0), F.lit(100))
    return F.struct(*(span[name].alias(name) for name in ("kind", "start", "end", "value")), score.alias("score"))


def _begin(kind: Kind) -> str:
    """Where a span of a kind may begin, without a character of it."""
    pattern, repeats = AGAIN[kind.name]
    return rf"(?<![0-9A-Za-z-])(?={pattern % repeats[-1]})"


def _values(kind: Kind, tails: Column) -> Column:
    """The longest confirmed end at each possible beginning, NULL where there is none."""
    pattern, repeats = AGAIN[kind.name]

    def longest(tail: Column) -> Column:
        ends = F.array(*(F.regexp_extract(tail, rf"^({pattern % n})(?![0-9A-Za-z-])", 1) for n in repeats))
        return F.get(F.filter(ends, lambda value: (value != "") & kind.confirmed({"value": value, "before": F.lit(""), "after": F.lit("")})), F.lit(0))

    return F.transform(tails, longest)


def _again(kind: Kind, values: Column, tails: Column, befores: Column, starts: Column) -> Column:
    """Scored spans at all beginnings with a confirmed end."""

    def span(value: Column, at: Column) -> Column:
        start = F.get(starts, at)
        after = F.substr(F.get(tails, at), F.length(value) + 1, F.lit(NEARBY))
        return F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), F.get(befores, at).alias("before"), after.alias("after"))

    return F.transform(F.filter(F.transform(values, span), lambda span: span["value"].isNotNull()), lambda span: _scored(kind, span))


def _free(spans: Column, taken: Column) -> Column:
    """Spans that overlap no taken one, in their order.

    Spans ask at their ends how far those reach that have begun before: one sort of both, and a running maximum.
    """
    asking = F.transform(spans, lambda span, at: F.struct(span["end"].alias("at"), F.lit(0).alias("kind"), F.lit(0).alias("reach"), at.alias("number")))
    begun = F.transform(taken, lambda span: F.struct(span["start"].alias("at"), F.lit(1).alias("kind"), span["end"].alias("reach"), F.lit(-1).alias("number")))
    events = F.array_sort(F.concat(asking, begun))
    reached = F.zip_with(events, _running(F.transform(events, lambda event: event["reach"]), F.greatest), lambda event, reach: F.struct(event["number"].alias("number"), reach.alias("reach")))
    answers = F.array_sort(F.filter(reached, lambda answer: answer["number"] >= 0))
    both = F.zip_with(spans, answers, lambda span, answer: F.struct(span.alias("span"), answer["reach"].alias("reach")))
    return F.transform(F.filter(both, lambda x: x["reach"] <= x["span"]["start"]), lambda x: x["span"])


def _apart(spans: Column, taken: Column) -> Column:
    """Spans in order of their starts without those that overlap a taken one or one kept before.

    They are taken in parts of PART, so that what has been kept is copied once for each part and not for each span.
    """
    free = _free(spans, taken)
    none = F.filter(spans, lambda span: F.lit(False))

    def kept_from(end: Column, part: Column) -> Column:
        start = F.struct(end.alias("end"), none.alias("kept"))
        step = lambda held, span: F.when(held["end"] <= span["start"], F.struct(span["end"].alias("end"), F.concat(held["kept"], F.array(span)).alias("kept"))).otherwise(held)
        return F.aggregate(part, start, step)

    def joined(held: Column, at: Column) -> Column:
        found = kept_from(held["end"], F.slice(held["spans"], at * PART + 1, F.lit(PART)))
        return F.transform(F.array(found), lambda new: F.struct(new["end"].alias("end"), F.concat(held["kept"], new["kept"]).alias("kept"), held["spans"].alias("spans")))[0]

    parts = F.sequence(F.lit(0), F.floor(F.size(spans) / PART).cast("int"))
    # The sorted spans are part of what is carried: as an expression they would be made anew for each part.
    begin = F.transform(F.array(free), lambda own: F.struct(F.lit(0).alias("end"), none.alias("kept"), own.alias("spans")))[0]
    return F.aggregate(parts, begin, joined)["kept"]


def _patterns(kinds: tuple[Kind, ...]) -> dict[str, Kind]:
    """One kind for each different pattern, by the name of its column."""
    return {f"p{kinds.index(next(x for x in kinds if x.pattern == kind.pattern))}": kind for kind in reversed(kinds)}


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, base_spans and spans: arrays of (kind, start, end, value, score), by kind and then start.

    Positions count code points from 0, the end excluded. `base_spans` are all confirmed matches of the four
    base kinds, whatever their score. `spans` has them and those of the added kinds that, with the bonus for a
    context word within NEARBY characters (up to the next match), reach KEPT_FROM. Where a match of an added kind
    of AGAIN is not confirmed, its other beginnings and ends are tried. A NULL or empty text has none; rows that repeat are answered each for itself; no documents: no rows; other columns are ignored.
    """
    kinds = BASE + ADDED
    patterns = _patterns(kinds)
    column = {kind.pattern: name for name, kind in patterns.items()}
    text = F.col("text")
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    searched = rows.select("doc_id", "text", *((F.regexp_extract_all(text if kind.sign is None else F.when(F.contains(text, F.lit(kind.sign)), text).otherwise(""), F.lit(kind.pattern), F.lit(0))).alias(name) for name, kind in patterns.items()))
    some = {name: F.size(F.col(name)) > 0 for name in patterns}
    cut = searched.select("doc_id", "text", *patterns, *(F.when(some[name], F.split(text, kind.pattern, -1)).alias(f"gaps_{name}") for name, kind in patterns.items()))
    placed = cut.select("*", *(F.when(some[name], _running(F.zip_with(F.col(name), F.col(f"gaps_{name}"), lambda match, gap: F.coalesce(F.length(match), F.lit(0)) + F.length(gap)))).alias(f"ends_{name}") for name in patterns))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:int>>")

    def found(kind: Kind, least: int) -> Column:
        name = column[kind.pattern]
        spans = _spans(kind, F.col(name), F.col(f"gaps_{name}"), F.col(f"ends_{name}"))
        confirmed = F.filter(spans, kind.confirmed) if kind.confirmed else spans
        return F.when(some[name], F.filter(F.transform(confirmed, lambda span: _scored(kind, span)), lambda span: span["score"] >= least)).otherwise(none)

    retried = [kind for kind in ADDED if kind.name in AGAIN]
    plain = [kind for kind in ADDED if kind.name not in AGAIN]
    based = placed.select("doc_id", "text", F.concat(*(found(kind, 0) for kind in BASE)).alias("base_spans"), *(found(kind, 0).alias(kind.name) for kind in retried), F.concat(none, *(found(kind, KEPT_FROM) for kind in plain)).alias("plain"))
    tails = based.select("*", *(F.regexp_extract_all("text", F.lit(_begin(kind) + rf"(?=([\s\S]{{1,{LONGEST + NEARBY}}}))"), F.lit(1)).alias(f"tails_{kind.name}") for kind in retried))
    taken = F.filter("base_spans", lambda span: span["kind"] == "card")
    for kind in retried:
        # A sign in front keeps the piece before a beginning at 0.
        pieces = f"pieces_{kind.name}"
        tails = tails.withColumn(pieces, F.split(F.concat(F.lit(" "), "text"), _begin(kind), -1))
        starts = F.transform(_running(F.transform(pieces, F.length)), lambda end: end - 1)
        befores = _running(F.transform(pieces, lambda piece: F.right(piece, F.lit(NEARBY))), lambda before, piece: F.right(F.concat(before, piece), F.lit(NEARBY)), F.lit(""))
        some_tails = F.size(f"tails_{kind.name}") > 0
        tails = tails.withColumns({f"befores_{kind.name}": F.when(some_tails, befores), f"starts_{kind.name}": F.when(some_tails, starts)})
        tails = tails.withColumn(f"values_{kind.name}", F.when(some_tails, _values(kind, F.col(f"tails_{kind.name}"))))
        more = _again(kind, *(F.col(f"{part}_{kind.name}") for part in ("values", "tails", "befores", "starts")))
        known = F.col("iban") if kind.name == "iban" else F.concat(kind.name, "iban", taken)
        tails = tails.withColumn(f"more_{kind.name}", F.when(some_tails, more).otherwise(none))
        both = F.array_sort(F.concat(F.col(kind.name), _apart(F.col(f"more_{kind.name}"), known)))
        tails = tails.withColumn(kind.name, both)
    kept = [F.filter(kind.name, lambda span: span["score"] >= KEPT_FROM) for kind in retried]
    return tails.select("doc_id", "base_spans", F.concat("base_spans", *kept, "plain").alias("spans"))


def listed(spans: Column, score: bool = False) -> Column:
    """kind:start:end of all spans, joined by commas; with the score as a fourth part where asked for."""
    names = ["kind", "start", "end"] + ["score"] * score
    return F.concat_ws(",", F.transform(spans, lambda span: F.concat_ws(":", *(span[name].cast("string") for name in names))))


def counted(spans: Column, kind: str) -> Column:
    """How many spans of a kind there are."""
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("bigint")
