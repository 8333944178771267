"""Measures by hierarchy levels over the fact table.

A query names measures and levels and compiles to ordinary aggregations:

1. numbers to be ranked exactly shrink the facts to one row per combination of the needed
   join keys and number (map-side first), and dimensions are joined to that smaller frame,
2. all else is counted on calls that carry their dates as an array: stops are joined to
   calls, routes and dates are broadcast, and a call becomes a row a date only where a
   level or a member needs the date,
3. levels are grouped, with each counted value still its own row, so a grand
   total never sends all trips to one task,
4. trips and stops are as many as the facts in slices by date.  They are not shuffled as
   rows of a slice: calls that lie together by trip or by stop become a row a date, are made
   distinct and counted in place, a hierarchy's levels in one pass over the sorted rows,
5. the last aggregation counts and ranks what is left.

Facts without a dimension row appear under ``Unknown`` (or -1) in every slice
instead of vanishing from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramloom.errors import TransitError
from tramloom.functions import clock
from tramloom.functions import delay as delays
from tramloom.operators.dimensions import unique_by, with_station_names
from tramloom.schemas import UNKNOWN
from tramloom.session import shared_dir

# --- levels ---------------------------------------------------------------


@dataclass(frozen=True)
class Level:
    name: str
    table: str
    default: object


@dataclass(frozen=True)
class Hierarchy:
    name: str
    dimension: str
    levels: tuple[Level, ...]


HIERARCHIES = {
    h.name: h
    for h in (
        Hierarchy("Geography", "stops", (
            Level("borough", "stops", UNKNOWN), Level("municipality", "stops", UNKNOWN),
            Level("station_name", "stops", UNKNOWN), Level("stop_id", "stops", UNKNOWN),
        )),
        Hierarchy("Network", "Network", (
            Level("agency_id", "routes", UNKNOWN), Level("mode", "routes", UNKNOWN),
            Level("display_name", "routes", UNKNOWN),
        )),
        Hierarchy("Calendar", "calendar", (
            Level("year", "calendar", -1), Level("month", "calendar", -1),
            Level("service_date", "calendar", None),
        )),
        Hierarchy("Day Type", "calendar", (Level("day_type", "calendar", UNKNOWN),)),
        Hierarchy("Service Period", "Time", (Level("service_period", "facts", UNKNOWN),)),
        Hierarchy("Hour of Day", "Time", (Level("local_hour", "facts", -1),)),
        Hierarchy("Direction", "Network", (Level("direction_id", "facts", -1),)),
    )
}
_LEVELS = {level.name: (h, i) for h in HIERARCHIES.values() for i, level in enumerate(h.levels)}
_JOIN_KEY = {"routes": "route_key", "stops": "stop_key", "calendar": "service_date"}


def level(name: str) -> Level:
    if name not in _LEVELS:
        raise TransitError(f"no level {name!r}; levels are {sorted(_LEVELS)}")
    hierarchy, position = _LEVELS[name]
    return hierarchy.levels[position]


def with_ancestors(names: Iterable[str]) -> list[str]:
    """Asking for a level brings the levels above it."""
    wanted: list[str] = []
    for name in names:
        level(name)
        hierarchy, position = _LEVELS[name]
        for above in hierarchy.levels[: position + 1]:
            if above.name not in wanted:
                wanted.append(above.name)
    return wanted


# --- measures -------------------------------------------------------------

#: Values that must be counted once or ranked: name -> expression over a fact row.
#: The text ones are counted, the number ones ranked or squared by frequency.
_TEXT_VALUES: dict[str, Callable[[], Column]] = {
    "trip": lambda: F.col("trip_id"),
    "trip_run": lambda: F.concat_ws(
        "\x1f", "agency_id", F.col("service_date").cast("string"), "trip_id"
    ),
    "route": lambda: F.col("route_key"),
    "stop": lambda: F.col("stop_key"),
    "day": lambda: F.col("service_date").cast("string"),
}


def _measurable() -> Column:
    return delays.measurable(
        F.col("schedule_relationship"), F.col("is_cancelled"), F.col("delay_seconds")
    )


#: Text values of which there are many: the column that facts lie together by to count them.
_LAID_OUT = {"trip": "trip_id", "trip_run": "trip_id", "stop": "stop_key"}

_NUMBER_VALUES: dict[str, Callable[[], Column]] = {
    "delay": lambda: F.when(_measurable(), F.col("delay_seconds")).cast("bigint"),
    "headway": lambda: F.col("headway_seconds").cast("bigint"),
}

#: Plain sums over fact rows.
_SUMS: dict[str, Callable[[], Column]] = {
    "calls": lambda: F.lit(1).cast("bigint"),
    "dwell_total": lambda: F.col("dwell_seconds").cast("bigint"),
    "dwell_calls": lambda: F.col("dwell_seconds").isNotNull().cast("bigint"),
    "overnight_calls": lambda: F.col("overnight").cast("bigint"),
}


#: The same on calls: the columns a sum is made of, and what a call adds on each of its dates.
_SUMMED: dict[str, tuple[str, ...]] = {
    "calls": (), "dwell_total": ("dwell_seconds",), "dwell_calls": ("dwell_seconds",), "overnight_calls": ("overnight",),
}
_SUMMED_AS: dict[str, Callable[[dict[str, Column]], Column]] = {
    "calls": lambda own: F.lit(1).cast("bigint"),
    "dwell_total": lambda own: own["_dwell_seconds"].cast("bigint"),
    "dwell_calls": lambda own: own["_dwell_seconds"].isNotNull().cast("bigint"),
    "overnight_calls": lambda own: own["_overnight"].cast("bigint"),
}


@dataclass(frozen=True)
class Measure:
    """``needs`` names sums and values; ``of`` combines them after aggregation."""

    label: str
    needs: tuple[str, ...]
    of: Callable[[], Column]
    format: str | None = None


def _number(kind: str) -> Column:
    return F.when(F.col("kind") == kind, F.col("number"))


def _count(kind: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("counted"))), F.lit(0)).cast("bigint")


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom)


def _weight(kind: str) -> Column:
    """Facts that have this value; the first kind also keeps rows without one."""
    held = (F.col("kind") == kind) & F.col("number").isNotNull()
    return F.coalesce(F.sum(F.when(held, F.col("weight"))), F.lit(0))


def _weighted(kind: str, expression: Column, cast: str) -> Column:
    held = (F.col("kind") == kind) & F.col("number").isNotNull()
    return F.sum(F.when(held, expression.cast(cast) * F.col("weight")))


def _percentile(share: float) -> Callable[[], Column]:
    # Whole seconds: the frequency map of a group is bounded by the range of delays.
    return lambda: F.percentile(
        _number("delay"), F.lit(share), F.col("weight")
    )


def _headway_deviation() -> Column:
    """Sample standard deviation from exact power sums."""
    n = _weight("headway")
    value = F.col("number").cast("decimal(10,0)")
    total = _weighted("headway", value, "decimal(10,0)").cast("double")
    squares = _weighted("headway", value * value, "decimal(20,0)").cast("double")
    spread = F.greatest(squares - total * total / F.nullif(n, F.lit(0)), F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n - 1)))


MEASURES = {
    "scheduled_stops": Measure("Scheduled Stops", ("calls",), lambda: _sum("calls")),
    # Distinct bare trip ids, as the public cube counts them.
    "scheduled_trips": Measure("Scheduled Trips", ("trip",), lambda: _count("trip")),
    "routes_served": Measure("Routes Served", ("route",), lambda: _count("route")),
    "stops_served": Measure("Stops Served", ("stop",), lambda: _count("stop")),
    "service_days": Measure("Service Days", ("day",), lambda: _count("day")),
    "trips_per_service_day": Measure(
        "Trips per Service Day", ("trip", "day"),
        lambda: _ratio(_count("trip"), _count("day")), "#,##0.0",
    ),
    "stops_per_trip": Measure(
        "Stops per Trip", ("calls", "trip"),
        lambda: _ratio(_sum("calls"), _count("trip")), "#,##0.0",
    ),
    "mean_dwell_seconds": Measure(
        "Mean Dwell Seconds", ("dwell_total", "dwell_calls"),
        lambda: _ratio(_sum("dwell_total"), _sum("dwell_calls")), "#,##0.0",
    ),
    "overnight_stops": Measure(
        "Overnight Stops", ("overnight_calls",), lambda: _sum("overnight_calls")
    ),
    "overnight_share": Measure(
        "Overnight Share", ("overnight_calls", "calls"),
        lambda: _ratio(_sum("overnight_calls"), _sum("calls")), "0.0%",
    ),
    # A trip counts once per agency and date it runs.
    "trip_runs": Measure("Trip Runs", ("trip_run",), lambda: _count("trip_run")),
    "measured_stops": Measure(
        "Measured Stops", ("delay",), lambda: _weight("delay").cast("bigint")
    ),
    "mean_delay_seconds": Measure(
        "Mean Delay Seconds", ("delay",),
        lambda: _ratio(_weighted("delay", F.col("number"), "bigint"), _weight("delay")), "#,##0.0",
    ),
    "p50_delay_seconds": Measure("p50 Delay", ("delay",), _percentile(0.5), "#,##0.0"),
    "p90_delay_seconds": Measure("p90 Delay", ("delay",), _percentile(0.9), "#,##0.0"),
    "p99_delay_seconds": Measure("p99 Delay", ("delay",), _percentile(0.99), "#,##0.0"),
    "on_time_share": Measure(
        "On-time Performance", ("delay",),
        lambda: _ratio(
            _weighted("delay", delays.on_time(F.col("number")), "bigint"), _weight("delay")
        ), "0.0%",
    ),
    "adherence_score": Measure(
        "Schedule Adherence", ("delay",),
        lambda: _ratio(
            _weighted("delay", delays.adherence(F.col("number")), "double"), _weight("delay")
        ), "0.0%",
    ),
    "headway_deviation_seconds": Measure(
        "Headway Regularity", ("headway",), _headway_deviation, "#,##0.0"
    ),
}
SCHEDULE_MEASURES = tuple(list(MEASURES)[:10])


# --- compilation ----------------------------------------------------------


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables of a cube, one row per key and with named stations."""

    routes: DataFrame
    stops: DataFrame
    calendar: DataFrame

    @staticmethod
    def of(routes: DataFrame, stops: DataFrame, calendar: DataFrame) -> Dimensions:
        named = with_station_names(unique_by(stops, "stop_key"))
        return Dimensions(unique_by(routes, "route_key"), named, calendar)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


Members = Mapping[str, Iterable]


@dataclass(frozen=True)
class Spread:
    """Facts, and how to get them with all rows of a column's value in one partition.

    Facts that are expanded from something smaller are better laid out before that: ``spans``
    has them before they become a row a date, with the array ``dates``, to be dealt out in
    ``parts``; ``with_stops`` joins columns by stop_key before that.
    """

    rows: DataFrame
    by: Callable[[str], DataFrame]
    spans: DataFrame | None = None
    parts: int = 0
    with_stops: Callable[[DataFrame], DataFrame] | None = None

    @staticmethod
    def of(facts: DataFrame | Spread) -> Spread:
        return facts if isinstance(facts, Spread) else Spread(facts, lambda column: facts.repartition(column))


def _shrink(
    facts: DataFrame, keys: list[str], needs: list[str], sums: list[str], sign: Column | None = None
) -> DataFrame:
    """Step 1: one row per key combination and counted value, with the plain sums.

    With ``sign`` a fact counts as often as it says: -1 takes one away.
    """
    texts = [n for n in needs if n in _TEXT_VALUES]
    numbers = [n for n in needs if n in _NUMBER_VALUES]
    kinds = texts + numbers
    times = F.lit(1).cast("bigint") if sign is None else sign.cast("bigint")
    inputs = [(_SUMS[s]() * times).alias(s) for s in sums]
    if not kinds:
        return facts.select(*keys, *inputs).groupBy(*keys).agg(
            *[F.sum(s).alias(s) for s in sums]
        ).withColumns({
            "kind": F.lit(None).cast("string"), "text": F.lit(None).cast("string"),
            "number": F.lit(None).cast("bigint"), "weight": F.lit(0).cast("bigint"),
        })

    def entry(kind: str) -> Column:
        text = _TEXT_VALUES[kind]() if kind in _TEXT_VALUES else F.lit(None).cast("string")
        number = _NUMBER_VALUES[kind]() if kind in _NUMBER_VALUES else F.lit(None).cast("bigint")
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), number.alias("number"))

    # The rows of the first kind also carry the sums, so they are added up once.
    carrier = F.col("kind") == kinds[0]
    rows = facts.select(*keys, *inputs, times.alias("times"), F.inline(F.array(*[entry(k) for k in kinds])))
    rows = rows.where(carrier | F.col("text").isNotNull() | F.col("number").isNotNull())
    return rows.groupBy(*keys, "kind", "text", "number").agg(
        F.sum("times").alias("weight"),
        *[F.sum(F.when(carrier, F.col(s))).alias(s) for s in sums],
    )


def _level_columns(names: list[str], tables: set[str]) -> list[Column]:
    columns = []
    for name in names:
        entry = level(name)
        if entry.table == "facts" or name == "service_date":
            value = F.col(f"fact.{name}")
        elif entry.table in tables:
            value = F.col(f"{entry.table}.{name}")
        if entry.default is not None:
            value = F.coalesce(value, F.lit(entry.default))
        columns.append(value.alias(name))
    return columns


def _tables(names: Iterable[str]) -> set[str]:
    return {level(n).table for n in names if n != "service_date"} - {"facts"}


def _members_first(facts: DataFrame, dims: Dimensions, members: Members) -> DataFrame:
    """The facts without those that a fact column or the calendar tells not to be asked for."""
    for name, allowed in members.items():
        allowed = list(allowed)
        entry = level(name)
        if name == "service_date" or entry.table == "facts":
            column = F.col(name)
            if entry.default is not None:
                column = F.coalesce(column, F.lit(entry.default))
            facts = facts.where(column.isin(allowed))
        elif entry.table == "calendar" and entry.default not in allowed:
            # A handful of dates: Spark turns this into partition pruning.
            days = dims.calendar.where(F.col(name).isin(allowed)).select("service_date")
            facts = facts.join(days, "service_date", "left_semi")
    return facts


def _dates_only(name: str) -> bool:
    """Whether the level is the date or a column of the calendar."""
    return name == "service_date" or level(name).table == "calendar"


def _settled(members: Members) -> Members:
    """The members that ``_members_first`` has not told for good."""
    return {n: allowed for n, allowed in members.items() if level(n).table in ("routes", "stops") or (
        n != "service_date" and level(n).table == "calendar" and level(n).default in list(allowed))}


def _with_dimensions(rows: DataFrame, dims: Dimensions, tables: set[str], members: Members) -> DataFrame:
    """``rows`` beside the dimensions, as ``fact``, of the members asked for.

    Routes and dates are few in any network, so they are sent to the rows; stops are not.
    """
    rows = rows.alias("fact")
    for table in sorted(tables, key=lambda t: (t == "stops", t)):
        key = _JOIN_KEY[table]
        other = dims.table(table).alias(table)
        if table != "stops":
            other = F.broadcast(other)
        rows = rows.join(other, F.col(f"fact.{key}") == F.col(f"{table}.{key}"), "left")
    for name, allowed in members.items():
        if level(name).table in tables:
            rows = rows.where(_level_columns([name], tables)[0].isin(list(allowed)))
    return rows


def _needs(measures: list[str]) -> tuple[list[str], list[str]]:
    for name in measures:
        if name not in MEASURES:
            raise TransitError(f"no measure {name!r}; measures are {sorted(MEASURES)}")
    needed = [n for m in measures for n in MEASURES[m].needs]
    return (list(dict.fromkeys(n for n in needed if n in _SUMS)),
            list(dict.fromkeys(n for n in needed if n not in _SUMS)))


def _prepare(
    facts: DataFrame, dims: Dimensions, sums: list[str], values: list[str], levels: list[str],
    members: Members, scenario: list[str], sign: Column | None = None,
) -> DataFrame:
    """Step 1: shrunken facts with a column per requested level.

    Facts that have the levels of a stop already, as ``_stop_`` columns, are not joined with stops.
    """
    facts = _members_first(facts, dims, members)
    members = _settled(members)
    used = list(dict.fromkeys([*levels, *members]))
    tables = _tables(used)
    known = [n for n in used if level(n).table == "stops"] if any(c.startswith("_stop_") for c in facts.columns) else []
    if known:
        tables -= {"stops"}
    keys = list(dict.fromkeys(
        [*scenario, *(_JOIN_KEY[t] for t in sorted(tables)), *(f"_stop_{n}" for n in known),
         *(n for n in used if level(n).table == "facts" or n == "service_date")]
    ))
    small = _shrink(facts, keys, values, sums, sign)
    small = _with_dimensions(small, dims, tables, {n: a for n, a in members.items() if n not in known})
    for name in known:
        small = small.withColumn(name, F.coalesce(F.col(f"fact._stop_{name}"), F.lit(level(name).default)))
        if name in members:
            small = small.where(F.col(name).isin(list(members[name])))
    rest = [F.col(f"fact.{c}") for c in (*scenario, "kind", "text", "number", "weight", *sums)]
    own = [F.col(n) if n in known else _level_columns([n], tables)[0] for n in levels]
    return small.select(*own, *rest)


def _stop_columns(dims: Dimensions, levels: list[str], members: Members) -> DataFrame | None:
    names = [n for n in dict.fromkeys([*levels, *members]) if level(n).table == "stops"]
    return dims.stops.select("stop_key", *[F.col(n).alias(f"_stop_{n}") for n in names]) if names else None


def _fact_rows(facts: Spread, dims: Dimensions, levels: list[str], members: Members) -> DataFrame:
    """The facts, with the stop levels asked for where those can be joined earlier."""
    stops = _stop_columns(dims, levels, members)
    return facts.rows if stops is None or facts.with_stops is None else facts.with_stops(stops)


def _span_rows(
    facts: Spread, dims: Dimensions, taken: dict[str, str], levels: list[str], members: Members, extra: list[str],
    at: str | None = None, words: bool = False, once: bool = False,
) -> DataFrame:
    """Step 2: the ``taken`` columns and the levels that no date decides, of calls with the array ``dates``.

    With ``at`` the rows may come laid out by it; with ``words`` they have their dates as words of bits and
    the dates' number ``n`` instead; ``once`` leaves out the dates and says what is alike once, before any join.
    """
    if facts.spans is not None and not set(extra) - set(facts.spans.columns):
        wide = facts.spans
    else:
        wide = (facts.rows if at is None else facts.by(at)).withColumn("dates", F.array("service_date"))
    if words:
        own = F.col("words") if "words" in wide.columns else clock.day_words(F.col("dates"))
        wide = wide.withColumns({"words": own, "n": F.size("dates")})
    undated = {n: a for n, a in members.items() if not _dates_only(n)}
    names = [n for n in levels if not _dates_only(n)]
    tables = _tables([*names, *undated])
    wide = _members_first(wide, dims, undated)
    if once:
        own = [n for n in [*names, *undated] if level(n).table == "facts"]
        kept = dict.fromkeys([*extra, *taken.values(), *(_JOIN_KEY[t] for t in sorted(tables)), *own])
        wide = wide.select(*kept).distinct().withColumn("dates", F.lit(None).cast("array<date>"))
    wide = _with_dimensions(wide, dims, tables, undated)
    return wide.select(
        *[F.col(f"fact.{c}") for c in extra], *[F.col(f"fact.{c}").alias(name) for name, c in taken.items()],
        *_level_columns(names, tables), *(["fact.words", "fact.n"] if words else ["fact.dates"]))


def _each_date(rows: DataFrame, dims: Dimensions, levels: list[str], members: Members) -> DataFrame:
    """``rows`` for each of their dates, of the members asked for, with the levels that need the
    calendar; those the date itself decides are left to ``_named_dates``."""
    rows = rows.select(*[c for c in rows.columns if c != "dates"], F.explode("dates").alias("service_date"))
    dated = {n: a for n, a in members.items() if _dates_only(n)}
    rows = _members_first(rows, dims, dated)
    tables = _tables(_settled(dated))
    names = [n for n in levels if _dates_only(n)]
    if "service_date" not in levels:
        tables |= _tables(names)
    own = [c for c in rows.columns if c != "service_date"]
    rows = _with_dimensions(rows, dims, tables, _settled(dated))
    added = [] if "service_date" in levels else _level_columns(names, tables)
    return rows.select(*[F.col(f"fact.{c}") for c in (*own, "service_date")], *added)


def _named_dates(rows: DataFrame, dims: Dimensions, levels: list[str]) -> DataFrame:
    """Adds the calendar levels to rows that are grouped by service_date."""
    names = [n for n in levels if _dates_only(n) and n != "service_date"]
    if "service_date" not in levels or not names:
        return rows
    return _with_dimensions(rows, dims, {"calendar"}, {}).select("fact.*", *_level_columns(names, {"calendar"}))


def _by_date(levels: list[str], members: Members) -> bool:
    return any(_dates_only(n) for n in [*levels, *members])


def _grouped(levels: list[str]) -> list[str]:
    """Levels to group rows by: those a date decides follow from it."""
    return [n for n in levels if n == "service_date" or not (_dates_only(n) and "service_date" in levels)]


def _distinct(
    facts: Spread, dims: Dimensions, kind: str, levels: list[str], members: Members, extra: list[str],
    together: bool = False,
) -> DataFrame:
    """The different (extra, levels, value) of a text value, but for the levels that ``_named_dates`` adds.

    Rows of one ``_at`` lie together where the levels go by date, or if they are to lie ``together`` and hardly repeat.
    """
    at = _LAID_OUT[kind]
    taken = {"_at": at, "_agency": "agency_id"} if kind == "trip_run" else {"_at": at}
    by_date = kind == "trip_run" or _by_date(levels, members)
    # Stops are few beside calls, and are joined with by what they are.
    once = kind == "stop" and not by_date and "stops" in _tables(levels)
    rows = _span_rows(facts, dims, taken, levels, members, extra, at, once=once)
    groups = [*extra, *_grouped(levels)]
    # A trip calls once at most stops, so nothing is gained by making its rows distinct before they travel.
    together = together and kind == "trip" and "stops" in _tables(levels)
    if facts.spans is not None and (by_date or together):
        if not by_date:
            rows = rows.drop("dates")
        rows = rows.repartition(facts.parts, "_at")
    if by_date:
        rows = _each_date(rows, dims, levels, members)
    value = F.col("_at")
    if kind == "trip_run":
        value = F.concat_ws("\x1f", "_agency", F.col("service_date").cast("string"), "_at")
        return rows.groupBy("_at", "_agency", *dict.fromkeys([*groups, "service_date"])).agg(
            F.lit(1).alias("_one")).select("_at", *groups, value.alias("value"))
    return rows.groupBy("_at", *groups).agg(F.lit(1).alias("_one")).select("_at", *groups, value.alias("value"))


_ROW = ("kind", "text", "number", "weight", "counted")


def _as_rows(counts: DataFrame, kind: str, groups: list[str], sums: list[str]) -> DataFrame:
    """Counts (groups, counted) in the columns of shrunken facts."""
    nothing = F.lit(None)
    return counts.select(
        *groups, F.lit(kind).alias("kind"), nothing.cast("string").alias("text"), nothing.cast("bigint").alias("number"),
        nothing.cast("bigint").alias("weight"), "counted", *[nothing.cast("bigint").alias(s) for s in sums])


def _counted_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with how many values each is: one, or a word's days."""
    one = F.col("text").isNotNull().cast("bigint")
    return rows.withColumn("counted", F.coalesce(F.bit_count("bits").cast("bigint"), one) if "bits" in rows.columns else one)


def _measure_columns(measures: list[str]) -> list[Column]:
    return [MEASURES[m].of().alias(m) for m in measures]


def _split(values: list[str], sums: list[str]) -> tuple[list[str], list[str]]:
    """The values counted where they lie, and those that shrunken facts have rows of."""
    large = [v for v in values if v in _LAID_OUT]
    return large, [v for v in values if v not in large]


def _few(
    facts: Spread, dims: Dimensions, sums: list[str], values: list[str], levels: list[str], members: Members,
    extra: list[str], repeated: bool = False,
) -> DataFrame:
    """Shrunken facts (extra, levels, kind, text, number, weight, sums) of sums and of few values.

    ``bits`` has the days of a word.  Rows may be ``repeated`` for who groups them again by all of this.
    """
    groups = [*extra, *levels]
    value = ["kind", "text", "number"]
    if any(v in _NUMBER_VALUES for v in values):
        rows = _prepare(_fact_rows(facts, dims, levels, members), dims, sums, values, levels, members, extra)
        return rows.groupBy(*groups, *value).agg(*[F.sum(c).alias(c) for c in ("weight", *sums)])
    wanted = list(dict.fromkeys(c for s in sums for c in _SUMMED[s]))
    taken = {f"_{c}": c for c in wanted} | ({"_route": "route_key"} if "route" in values else {})
    by_date = _by_date(levels, members)
    # Rows that were joined with stops lie by stop: grouped by it as well, they are not shuffled for this.
    beside = ["_beside"] if repeated and "stops" in _tables(levels) and not by_date else []
    taken |= {"_beside": "stop_key"} if beside else {}
    # Days of a cell are words of bits: bits of a word are united where a day a row would be shuffled.
    rows = _span_rows(facts, dims, taken, levels, members, extra, words="day" in values and not by_date)
    dates = F.lit(1) if by_date else F.col("n") if "day" in values else F.size("dates")
    own = {f"_{c}": F.col(f"_{c}") for c in wanted}
    carrier = F.lit(True)
    if by_date:
        rows = _each_date(rows, dims, levels, members)
        if "day" in values:
            date = F.col("service_date")
            rows = rows.withColumns({"_word": clock.day_word(date), "_bits": clock.day_bit(date)})
    elif "day" in values:
        # The first row of a call carries its sums, the others are its dates.
        none = F.struct(F.lit(None).cast("int").alias("word"), F.lit(None).cast("bigint").alias("bits"))
        rows = rows.select(
            *[c for c in rows.columns if c != "words"],
            F.posexplode(F.concat(F.array(none), F.col("words"))).alias("_nth", "_day"))
        rows = rows.withColumns({"_word": F.col("_day.word"), "_bits": F.col("_day.bits")})
        carrier = F.col("_nth") == 0
    inputs = {s: F.when(carrier, _SUMMED_AS[s](own) * dates).cast("bigint") for s in sums}
    keys = [F.col(c) for c in [*extra, *_grouped(levels), *beside]]
    united = []
    if "day" in values:
        keys += [F.col("_word"), F.col("_bits")]
        united = [F.bit_or("_bits").alias("_bits")]
    if "route" in values:
        keys.append(F.when(carrier, F.col("_route")).alias("_route"))
    small = rows.select(*keys, *[c.alias(s) for s, c in inputs.items()]).groupBy(
        *extra, *_grouped(levels), *beside, *(["_word"] if "day" in values else []),
        *(["_route"] if "route" in values else [])).agg(*united, *[F.sum(s).alias(s) for s in sums], F.lit(1).alias("_one"))
    small = _named_dates(small, dims, levels)
    nothing = F.lit(None)
    texts = {"route": "_route", "day": "_word"}
    kept = [v for v in values if v in texts]

    def entry(kind: Column, text: Column, bits: Column, sums: list[Column]) -> Column:
        return F.struct(kind.alias("kind"), text.cast("string").alias("text"), bits.cast("bigint").alias("bits"), *sums)

    entries = [entry(
        F.lit(v), F.col(texts[v]), F.col("_bits") if v == "day" else nothing,
        [(F.col(s) if i == 0 else nothing.cast("bigint")).alias(s) for s in sums])
        for i, v in enumerate(kept)] or [entry(nothing.cast("string"), nothing, nothing, [F.col(s) for s in sums])]
    out = small.select(*groups, F.inline(F.array(*entries)))
    if repeated:
        return out.select(*groups, "kind", "text", "bits", *sums, F.lit(0).cast("bigint").alias("weight"),
                          nothing.cast("bigint").alias("number"))
    return out.groupBy(*groups, "kind", "text").agg(
        F.lit(0).cast("bigint").alias("weight"), F.bit_or("bits").alias("bits"),
        *[F.sum(s).alias(s) for s in sums]).withColumn("number", nothing.cast("bigint"))


def cube_query(
    facts: DataFrame | Spread,
    dims: Dimensions,
    measures: Iterable[str],
    levels: Iterable[str] = (),
    members: Members | None = None,
    by: Iterable[str] = (),
) -> DataFrame:
    """Measures grouped by levels; ``members`` keeps only the named level members.

    ``by`` adds plain fact columns to the grouping, such as a scenario name.
    """
    measures, extra, members = list(measures), list(by), members or {}
    names = with_ancestors(levels)
    sums, values = _needs(measures)
    large, few = _split(values, sums)
    groups, spread = [*extra, *names], Spread.of(facts)
    parts = []
    if few or sums or not large:
        rows = _few(spread, dims, sums, few, names, members, extra)
        parts.append(_counted_rows(rows).select(*groups, *_ROW, *sums))
    for kind in large:
        found = _distinct(spread, dims, kind, names, members, extra)
        found = found.groupBy(*extra, *_grouped(names)).agg(F.count("value").alias("counted"))
        parts.append(_as_rows(_named_dates(found, dims, names), kind, groups, sums))
    return reduce(DataFrame.unionByName, parts).groupBy(*groups).agg(*_measure_columns(measures))


def cube_scenarios(
    facts: DataFrame | Spread,
    dims: Dimensions,
    overrides: DataFrame,
    scenarios: Iterable[str],
    on: list[str],
    measures: Iterable[str],
    levels: Iterable[str] = (),
    members: Members | None = None,
) -> DataFrame:
    """``cube_query`` for the facts as they are (``base``) and for each scenario's changed delays.

    ``overrides`` has (scenario, *on, delay_change).  The facts are aggregated once.  A scenario
    is a difference: of each call it changes, the old value is taken away and the new one added.
    Only the cells so touched are computed anew, from the base cell's frequencies and the
    difference; all others are the base's.
    """
    measures, names, asked = list(measures), with_ancestors(levels), list(scenarios)
    sums, values = _needs(measures)
    members = members or {}
    facts = _fact_rows(Spread.of(facts), dims, names, members)
    value = ["kind", "text", "number"]

    def cells(rows: DataFrame, sums: list[str], *more: str) -> DataFrame:
        return rows.groupBy(*more, *names, *value).agg(*[F.sum(c).alias(c) for c in ("weight", *sums)])

    # One pass over the facts: each as it is, and for each change the old value taken away and the new one added.
    # Which versions there are does not depend on the fact, so they are put together once an override.
    def version(scenario: Column, sign: int, change: Column) -> Column:
        return F.struct(scenario.alias("scenario"), F.lit(sign).alias("sign"), change.cast("bigint").alias("change"))

    unchanged = F.lit(None).cast("bigint")
    as_it_is = F.array(version(F.lit(None).cast("string"), 1, unchanged))
    asked_for = overrides.where(F.col("scenario").isin(asked)).groupBy(*on).agg(
        F.collect_list(F.struct("scenario", "delay_change")).alias("changes"))
    asked_for = asked_for.select(*on, F.concat(as_it_is, F.flatten(F.transform("changes", lambda c: F.array(
        version(c.getField("scenario"), -1, unchanged),
        version(c.getField("scenario"), 1, c.getField("delay_change").cast("bigint")))))).alias("versions"))
    moved = facts.join(asked_for, on, "left").select(
        *[F.col(c) for c in facts.columns], F.inline(F.coalesce("versions", as_it_is)))
    added = (F.col("scenario").isNotNull()) & (F.col("sign") > 0)
    moved = moved.withColumn("delay_seconds", F.when(
        added, (F.col("delay_seconds") + F.col("change")).cast("int")).otherwise(F.col("delay_seconds")))
    both = cells(_prepare(moved, dims, sums, values, names, members, ["scenario"], F.col("sign")), sums, "scenario")
    # Cells are read several times below, the facts once.
    path = f"{shared_dir(both.sparkSession)}/cells-{uuid.uuid4().hex}"
    both.write.parquet(path)
    both = both.sparkSession.read.schema(both.schema).parquet(path)
    base = both.where("scenario is null").drop("scenario")
    difference = both.where("scenario is not null").select("scenario", *base.columns)
    known = _counted_rows(base).groupBy(*names).agg(*_measure_columns(measures))

    touched = difference.select("scenario", *names).distinct()
    level_names = [F.col(n) for n in names]
    if names:
        mine = [F.col(f"b.{n}").eqNullSafe(F.col(f"t.{n}")) for n in names]
        under = base.alias("b").join(touched.alias("t"), mine).select("t.scenario", "b.*")
    else:  # the grand total is one cell: its rows once for each scenario, of which there are a few
        under = base.withColumn("scenario", F.explode(F.array(*[F.lit(s) for s in asked]).cast("array<string>"))).join(
            touched, "scenario", "left_semi").select("scenario", *base.columns)
    renewed = _counted_rows(cells(under.unionByName(difference), sums, "scenario")).groupBy("scenario", *names).agg(
        *_measure_columns(measures))

    def named(scenario: str) -> DataFrame:
        return known.select(F.lit(scenario).alias("scenario"), *level_names, *measures)

    same = [F.col(f"k.{n}").eqNullSafe(F.col(f"t.{n}")) for n in ("scenario", *names)]
    result = named("base")
    for scenario in asked:
        result = result.unionByName(named(scenario).alias("k").join(touched.alias("t"), same, "left_anti"))
    return result.unionByName(renewed.select("scenario", *level_names, *measures))


def rollup_sets(hierarchies: Iterable[str]) -> list[list[str]]:
    """Grouping sets of the product of each hierarchy's totals and levels."""
    prefixes = []
    for name in hierarchies:
        if name not in HIERARCHIES:
            raise TransitError(f"no hierarchy {name!r}; they are {sorted(HIERARCHIES)}")
        levels = [entry.name for entry in HIERARCHIES[name].levels]
        prefixes.append([levels[:depth] for depth in range(len(levels), -1, -1)])
    return [[n for part in combined for n in part] for combined in product(*prefixes)]


def cube_rollup(
    facts: DataFrame | Spread,
    dims: Dimensions,
    measures: Iterable[str],
    hierarchies: Iterable[str],
    members: Members | None = None,
) -> DataFrame:
    """Measures at every level of the hierarchies, totals included.

    Distinct counts are taken anew at each level.  ``level_mask`` has a bit per
    level column, leftmost highest, set where the column is totalled away.
    """
    measures, hierarchies, members = list(measures), list(hierarchies), members or {}
    sets = rollup_sets(hierarchies)
    names = sets[0]
    sums, values = _needs(measures)
    large, few = _split(values, sums)
    spread, parts = Spread.of(facts), []
    if few or sums or not large:
        value = ["kind", "text", "number"]
        # The finest cells, before the grouping sets multiply the rows.
        rows = _few(spread, dims, sums, few, names, members, [], repeated=True)
        mask = reduce(Column.__add__, [
            F.shiftleft(F.grouping(n).cast("int"), len(names) - 1 - i) for i, n in enumerate(names)])
        rows = rows.groupingSets(
            [[F.col(c) for c in (*chosen, *value)] for chosen in sets],
            *[F.col(c) for c in (*names, *value)],
        ).agg(mask.alias("level_mask"), *([F.bit_or("bits").alias("bits")] if "bits" in rows.columns else []),
              *[F.sum(c).alias(c) for c in ("weight", *sums)])
        parts.append(_counted_rows(rows).select(*names, "level_mask", *_ROW, *sums))
    for kind in large:
        found = _named_dates(_distinct(spread, dims, kind, names, members, [], together=True), dims, names)
        found = _rolled_up(found, hierarchies, names)
        parts.append(_as_rows(found, kind, [*names, "level_mask"], sums))
    return reduce(DataFrame.unionByName, parts).groupBy(*names, "level_mask").agg(*_measure_columns(measures))


def _rolled_up(found: DataFrame, hierarchies: list[str], names: list[str]) -> DataFrame:
    """Distinct values counted at every level: names, level_mask and counted.

    Rows of a value lie together.  Sorted by the levels of one hierarchy, a value is new to a
    level where the levels down to it differ from the row before, so all levels of that hierarchy
    are counted in one pass; rows multiply by the totals of the other hierarchies only.
    """
    chain = max(hierarchies, key=lambda h: len(HIERARCHIES[h].levels))
    down = [entry.name for entry in HIERARCHIES[chain].levels]
    others = [n for n in names if n not in down]
    kinds = {n: found.schema[n].dataType for n in names}
    bit = {n: 1 << (len(names) - 1 - i) for i, n in enumerate(names)}

    def cell(kept: list[str], of: list[str], mask: Column, *more: Column) -> Column:
        return F.struct(*[(F.col(n) if n in kept else F.lit(None).cast(kinds[n])).alias(n) for n in of],
                        mask.cast("int").alias("level_mask"), *more)

    totals = [cell(kept, others, F.lit(sum(bit[n] for n in others if n not in kept)))
              for kept in rollup_sets([h for h in hierarchies if h != chain])]
    rows = found.select("_at", "value", *down, F.inline(F.array(*totals)))
    order = W.partitionBy("_at", "value", *others, "level_mask").orderBy(*down)
    before = F.lag(F.struct(F.lit(True).alias("any"), *down)).over(order)
    rows = rows.withColumn("before", before)
    new = F.col("before").isNull()
    firsts = [new]
    for name in down:
        new = new | ~F.col(f"before.{name}").eqNullSafe(F.col(name))
        firsts.append(new)
    there = F.col("value").isNotNull()
    cells = rows.groupBy(*names, "level_mask").agg(
        *[F.count_if(first & there).alias(f"_{depth}") for depth, first in enumerate(firsts)])
    levels = [cell([*others, *down[:depth]], names, F.col("level_mask") + sum(bit[n] for n in down[depth:]),
                   F.col(f"_{depth}").alias("counted")) for depth in range(len(down) + 1)]
    return cells.select(F.inline(F.array(*levels))).groupBy(*names, "level_mask").agg(F.sum("counted").alias("counted"))


def window_service_days(facts: DataFrame) -> DataFrame:
    """Distinct service dates of all loaded facts: the same number for every slice."""
    return facts.agg(F.count_distinct("service_date").alias("window_service_days"))


def formatted(result: DataFrame) -> DataFrame:
    """Measure columns as display text in their declared format."""
    shown = []
    for name in result.columns:
        style = MEASURES[name].format if name in MEASURES else None
        if style == "0.0%":
            text = F.concat(F.format_number(F.col(name) * 100, 1), F.lit("%"))
            shown.append(text.alias(name))
        elif style:
            shown.append(F.format_number(name, style).alias(name))
        else:
            shown.append(F.col(name))
    return result.select(*shown)
