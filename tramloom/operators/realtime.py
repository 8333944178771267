"""Realtime updates against the schedule, and the measures built on them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tramloom import schemas as sc
from tramloom.errors import TransitError
from tramloom.functions import clock, keys
from tramloom.functions import delay as delays
from tramloom.operators import schedule

# --- matching -------------------------------------------------------------

_MATCH = ["agency_id", "service_date", "match_trip", "match_stop"]


def latest_updates(updates: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The newest update per realtime key; ``also`` names columns that the key decides."""
    key = ["agency_id", "service_date", "trip_id", "stop_id", *also]
    rest = [c for c in updates.columns if c not in (*key, "polled_at")]
    newest = F.max(F.struct("polled_at", *rest)).alias("latest")
    return updates.groupBy(*key).agg(newest).select(*key, "latest.*")


def with_match_keys(rows: DataFrame, agencies: DataFrame, realtime: bool) -> DataFrame:
    """Adds ``match_trip`` and ``match_stop``, on which schedule and realtime agree."""
    quirks = agencies.select("agency_id", "trip_id_match", "stop_id_direction_suffix")
    rows = rows.join(quirks, "agency_id")
    stop = F.col("stop_id")
    if realtime:
        stop = keys.match_stop_id(stop, F.col("stop_id_direction_suffix"))
    return rows.withColumns({
        "match_trip": keys.trip_match_key(F.col("trip_id"), F.col("trip_id_match")),
        "match_stop": stop,
    }).drop("trip_id_match", "stop_id_direction_suffix")


def match_updates(
    facts: DataFrame, updates: DataFrame, agencies: DataFrame, carried: tuple[str, ...] = (),
    parts: int | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Each newest update with the one scheduled call it belongs to.

    The trip key is a suffix for some agencies and a trip may call at one stop
    twice, so a key can name several calls.  Such updates are ``ambiguous`` and,
    like ``unmatched`` ones, get no schedule columns: no guess is measured.
    ``carried`` names further columns of the call to bring along.

    With ``parts``, the facts lie together by agency and ``match_trip`` in so many partitions
    and have the match keys; the updates are dealt out alike, and only they are shuffled.
    ``keep`` names match keys to leave in the result.
    """
    brought = ("event_id", "scheduled_arrival", *carried)
    calls = facts if parts else with_match_keys(
        facts.select("agency_id", "service_date", "trip_id", "stop_id", *brought), agencies, realtime=False)
    # Column by column: only of a single call they are used, and who asks for none gets none worked out.
    calls = calls.groupBy(*_MATCH).agg(
        F.count(F.lit(1)).alias("candidates"), *[F.min(c).alias(f"call_{c}") for c in brought])
    keyed = with_match_keys(updates, agencies, realtime=True)
    if parts:
        keyed = keyed.repartition(parts, "agency_id", "match_trip")
    matched = latest_updates(keyed, ("match_trip", "match_stop")).join(calls, _MATCH, "left")
    only = F.col("candidates") == 1
    dropped = [c for c in ("match_trip", "match_stop") if c not in keep]
    return matched.withColumns({
        "match_status": F.when(F.col("candidates").isNull(), "unmatched")
        .when(only, "matched").otherwise("ambiguous"),
        **{name: F.when(only, F.col(f"call_{name}")) for name in brought},
    }).drop("candidates", *[f"call_{c}" for c in brought], *dropped)


def stop_events(
    facts: DataFrame, updates: DataFrame, agencies: DataFrame, parts: int | None = None
) -> DataFrame:
    """The fact table with its realtime columns filled where an update matched.

    Delay and headway belong to matched calls, so they are computed on these alone;
    the facts are joined once, at the end, where they lie.  ``parts`` as for ``match_updates``.
    A call is known by what its event id is made of, so who asks for no headway needs no ids.
    """
    observed = ("polled_at", "actual_arrival", "schedule_relationship", "is_cancelled", "vehicle_id")
    if not parts:
        facts = with_match_keys(facts, agencies, realtime=False)
    numbered = facts.withColumn("call_trip", F.when(F.col("stop_sequence").isNotNull(), F.col("trip_id")))
    own = ("call_trip", "stop_sequence", *HEADWAY_KEY[1:])
    found = match_updates(
        numbered, updates, agencies, own, parts, keep=("match_trip",)) if parts else match_updates(
        numbered.drop("match_trip", "match_stop"), updates, agencies, own, keep=("match_trip",))
    call = ("agency_id", "match_trip", "service_date", "call_trip", "stop_sequence")
    # Two realtime trips may share a suffix: the newest update of the call counts.
    found = found.where(F.col("match_status") == "matched").groupBy(
        *call, *HEADWAY_KEY[1:], "scheduled_arrival").agg(
        F.max(F.struct(*observed)).alias("rt"), F.min("event_id").alias("event_id"))
    found = found.select(*call, *HEADWAY_KEY[1:], "scheduled_arrival", "event_id", "rt.*")
    delay = delays.delay_seconds(F.col("scheduled_arrival"), F.col("actual_arrival"))
    measured = with_headway(found).select(
        *call, delay.alias("delay_seconds"), *[c for c in sc.REALTIME_COLUMNS.names if c != "delay_seconds"])
    joined = numbered.drop(*sc.REALTIME_COLUMNS.names).join(measured, list(call), "left")
    return sc.conform(joined, sc.FACTS, "service_date")


_DAY_MICROS = clock.DAY_SECONDS * 1_000_000


def _laid_messages(updates: DataFrame, agencies: DataFrame, parts: int) -> DataFrame:
    """Messages with their match keys, those of one agency and ``match_trip`` together in ``parts`` partitions.

    Their ``days`` travel as ``dates`` and ``distances``, see ``updates_by_match_key``.
    """
    names = [c for c in updates.columns if c not in ("days", "service_date", "actual_arrival")]
    if "days" not in updates.columns:
        updates = updates.withColumn("days", F.array(F.struct("service_date", "actual_arrival")))
    packed = updates.select(*names, F.col("days.service_date").alias("dates"), F.transform("days", lambda d: (
        F.unix_micros(d.getField("actual_arrival")) - _micros(d.getField("service_date")))).alias("distances"))
    quirks = agencies.select("agency_id", "trip_id_match", "stop_id_direction_suffix")
    laid = packed.join(quirks, "agency_id").withColumn(
        "match_trip", keys.trip_match_key(F.col("trip_id"), F.col("trip_id_match"))).drop("trip_id_match")
    laid = laid.repartition(parts, "agency_id", "match_trip")
    match_stop = keys.match_stop_id(F.col("stop_id"), F.col("stop_id_direction_suffix"))
    return laid.select(*names, "match_trip", match_stop.alias("match_stop"), "dates", "distances")


def _micros(date: Column) -> Column:
    return F.coalesce(F.unix_date(date).cast("bigint"), F.lit(0)) * _DAY_MICROS


def updates_by_match_key(updates: DataFrame, agencies: DataFrame, parts: int) -> DataFrame:
    """Updates with their match keys, those of one agency and ``match_trip`` together in ``parts`` partitions.

    A message that says the same of several dates has the array ``days`` (service_date, actual_arrival)
    in place of these two columns.  It is shuffled as one row and becomes a row a date behind that; times
    travel as distances from their date, which are alike on all dates.
    """
    laid = _laid_messages(updates, agencies, parts)
    names = [c for c in laid.columns if c not in ("match_trip", "match_stop", "dates", "distances")]
    laid = laid.select("*", F.posexplode("dates").alias("nth", "service_date"))
    arrival = F.timestamp_micros(_micros(F.col("service_date")) + F.get("distances", "nth"))
    return laid.select(
        "agency_id", "service_date", "trip_id", "stop_id", "polled_at", arrival.alias("actual_arrival"),
        *[c for c in names if c not in ("agency_id", "trip_id", "stop_id", "polled_at")],
        "match_trip", "match_stop")


# --- updates as arrays ----------------------------------------------------

_UPDATE_KEY = ("agency_id", "match_trip", "match_stop", "trip_id", "stop_id")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _different(dates: Column) -> Column:
    return F.size(F.array_distinct(dates)) == F.size(dates)


def _last_of_each(rows: Column, *by: str) -> Column:
    """Of an array of structs that begin with ``by``, the greatest of each ``by``."""
    def last(ordered: Column) -> Column:
        def differs(row: Column, nth: Column) -> Column:
            after = F.get(ordered, nth + 1)
            same = reduce(Column.__and__, [after.getField(c).eqNullSafe(row.getField(c)) for c in by])
            return (nth + 1 == F.size(ordered)) | ~same
        return F.filter(ordered, differs)

    return _let(F.sort_array(rows), last)


def _at(date: Column, distance: Column) -> Column:
    return F.timestamp_micros(_micros(date) + distance)


def newest_by_key(updates: DataFrame, agencies: DataFrame, parts: int) -> DataFrame:
    """``latest_updates`` as messages: an update key, what was said of it, ``dates`` and ``distances``.

    Only where several messages speak of one key they are compared, date by date.
    """
    laid = _laid_messages(updates, agencies, parts).where(F.size("dates") > 0)
    rest = [c for c in laid.columns if c not in (*_UPDATE_KEY, "polled_at", "dates", "distances")]
    said = ["polled_at", *rest, "dates", "distances"]
    told = laid.groupBy(*_UPDATE_KEY).agg(F.collect_list(F.struct(*said)).alias("told"))

    def days(message: Column) -> Column:
        def day(date: Column, nth: Column) -> Column:
            distance = F.get(message.getField("distances"), nth)
            return F.struct(
                date.alias("service_date"), message.getField("polled_at").alias("polled_at"),
                _at(date, distance).alias("actual_arrival"), *[message.getField(c).alias(c) for c in rest],
                distance.alias("distance"))
        return F.transform(message.getField("dates"), day)

    newest = F.transform(_last_of_each(F.flatten(F.transform("told", days)), "service_date"), lambda d: F.struct(
        *[d.getField(c).alias(c) for c in ("polled_at", *rest)], F.array(d.getField("service_date")).alias("dates"),
        F.array(d.getField("distance")).alias("distances")))
    only = (F.size("told") == 1) & _different(F.get("told", F.lit(0)).getField("dates"))
    return told.select(*_UPDATE_KEY, F.inline(F.when(only, F.col("told")).otherwise(newest)))


def _options(calls: DataFrame, carried: Iterable[str]) -> DataFrame:
    """The calls of each match key, dates and all, as the array ``options``."""
    return calls.groupBy("agency_id", "match_trip", "match_stop").agg(
        F.collect_list(F.struct("dates", "starts", *carried)).alias("options"))


def _candidates(options: Column, day: Column) -> Column:
    """How many calls ``options`` has on a date; a date stated twice names two."""
    return F.aggregate(options, F.lit(0), lambda n, c: n + F.size(F.filter(c.getField("dates"), lambda d: d == day)))


def _lone(options: Column) -> Column:
    """Whether there is one call and it has no date twice, so that no date is ambiguous."""
    return (F.size(options) == 1) & _different(F.get(options, F.lit(0)).getField("dates"))


def _scheduled(day: Column, start: Column, arrival: Column) -> Column:
    return clock.at_clock(F.unix_date(day).cast("bigint") * clock.DAY_SECONDS + start, arrival)


def match_calls(
    calls: DataFrame, updates: DataFrame, agencies: DataFrame, parts: int,
    carried: tuple[str, ...] = (), keep: tuple[str, ...] = (),
) -> DataFrame:
    """``match_updates`` against calls that have their dates as arrays, so no call becomes a row a date.

    ``calls`` are ``schedule.dated`` ones with their match keys and lie together by agency and
    ``match_trip`` in ``parts`` partitions.  ``carried`` names columns of the call.  ``updates`` may be
    messages, see ``updates_by_match_key``.
    """
    own = ("trip_id", "stop_sequence", "arrival", *carried)
    options = calls.groupBy("agency_id", "match_trip", "match_stop").agg(
        F.collect_list(F.struct("dates", "starts", *own)).alias("options"))
    newest = latest_updates(updates_by_match_key(updates, agencies, parts), ("match_trip", "match_stop"))
    matched = newest.join(options, ["agency_id", "match_trip", "match_stop"], "left")
    day = F.col("service_date")
    hits = F.filter("options", lambda c: F.array_contains(c.getField("dates"), day))
    matched = matched.withColumn("hits", hits)
    # A date stated twice names two calls.
    times = F.aggregate("hits", F.lit(0), lambda n, c: n + F.size(F.filter(c.getField("dates"), lambda d: d == day)))
    matched = matched.withColumn("candidates", F.coalesce(times, F.lit(0))).withColumn(
        "call", F.when(F.col("candidates") == 1, F.get("hits", F.lit(0))))
    start = F.get("call.starts", F.array_position("call.dates", day).cast("int") - 1)
    arrival = clock.at_clock(
        F.unix_date(day).cast("bigint") * clock.DAY_SECONDS + start, F.col("call.arrival"))
    dropped = [c for c in ("match_trip", "match_stop") if c not in keep]
    return matched.withColumns({
        "match_status": F.when(F.col("candidates") == 0, "unmatched")
        .when(F.col("candidates") == 1, "matched").otherwise("ambiguous"),
        "scheduled_arrival": arrival,
        **{f"call_{c}" if c in ("trip_id", "arrival") else c: F.col(f"call.{c}") for c in own if c != "arrival"},
    }).drop("options", "hits", "call", "candidates", *dropped)


_CALL = ("agency_id", "match_trip", "call_trip", "stop_sequence")
_PLACE = ("route_key", "stop_key", "direction_id")
_OBSERVED = ("polled_at", "actual_arrival", "schedule_relationship", "is_cancelled", "vehicle_id")
#: What a call was once seen like: the same on all of ``dates`` but for its time.
_SEEN = ("polled_at", "schedule_relationship", "is_cancelled", "vehicle_id", "arrival", "dates", "starts", "distances")


def observed_by_call(
    calls: DataFrame, updates: DataFrame, agencies: DataFrame, parts: int, headways: bool = True,
) -> DataFrame:
    """What was observed of each call: agency_id, match_trip, call_trip, stop_sequence and the array ``seen``,
    with an element for each message that holds, of all dates on which it does.  ``calls`` and ``parts`` as
    for ``match_calls``.

    Without ``headways``, ``with_gaps`` may add them.  A call without a number (call_trip is null) is nobody's
    in the facts, but a vehicle at its stop.
    """
    options = _options(calls, ("trip_id", "stop_sequence", "arrival", "route_id", "direction_id"))
    found = newest_by_key(updates, agencies, parts).drop("trip_id", "stop_id").join(
        options, ["agency_id", "match_trip", "match_stop"])
    found = found.withColumn("lone", _lone(F.col("options"))).select("*", F.explode("options").alias("call"))
    dates = F.col("call.dates")
    whole = F.col("lone") & (F.col("dates") == dates)
    own = F.filter(F.sequence(F.lit(0), F.size("dates") - 1), lambda n: F.array_contains(dates, F.get("dates", n)) & (
        F.col("lone") | (_candidates(F.col("options"), F.get("dates", n)) == 1)))
    found = found.withColumn("own", F.when(~whole, own)).where(F.col("own").isNull() | (F.size("own") > 0))

    def held(column: str) -> Column:
        return F.when(F.col("own").isNull(), F.col(column)).otherwise(F.transform("own", lambda n: F.get(column, n)))

    starts = F.when(F.col("own").isNull(), F.col("call.starts")).otherwise(F.transform("own", lambda n: F.get(
        "call.starts", F.array_position(dates, F.get("dates", n)).cast("int") - 1)))
    found = found.select(
        "agency_id", "match_trip", F.when(F.col("call.stop_sequence").isNotNull(), F.col("call.trip_id")).alias("call_trip"),
        "call.stop_sequence", keys.namespaced(F.col("agency_id"), F.col("call.route_id")).alias("route_key"),
        keys.namespaced(F.col("agency_id"), F.col("match_stop")).alias("stop_key"),
        F.col("call.direction_id").cast("int").alias("direction_id"), F.col("call.trip_id").alias("id_trip"),
        *_SEEN[:4], "call.arrival", held("dates").alias("dates"), starts.alias("starts"), held("distances").alias("distances"))
    # Two realtime trips may share a suffix: the newest update of the call counts.
    found = found.groupBy(*_CALL, *_PLACE).agg(
        F.collect_list(F.struct(*_SEEN)).alias("seen"), F.min("id_trip").alias("id_trip"))

    def day(row: Column) -> Column:
        return F.struct(
            row.getField("service_date").alias("service_date"), row.getField("scheduled_arrival").alias("scheduled_arrival"),
            *[row.getField(c).alias(c) for c in (*_OBSERVED, "arrival", "start", "distance")])

    newest = F.transform(
        _last_of_each(F.transform(F.flatten(F.transform("seen", _days)), day), "service_date", "scheduled_arrival"),
        lambda d: F.struct(*[d.getField(c).alias(c) for c in _SEEN[:5]], F.array(d.getField("service_date")).alias("dates"),
                           F.array(d.getField("start")).alias("starts"), F.array(d.getField("distance")).alias("distances")))
    found = found.withColumn("seen", F.when(F.size("seen") == 1, F.col("seen")).otherwise(newest))
    placed = F.transform("seen", lambda s: F.struct(
        *[F.col(c) for c in (*_PLACE, "id_trip")], *[s.getField(c).alias(c) for c in _SEEN]))
    found = found.select(*_CALL, placed.alias("seen")).groupBy(*_CALL).agg(
        F.sort_array(F.flatten(F.collect_list("seen"))).alias("seen"))
    return with_gaps(found, parts) if headways else found


def _days(seen: Column) -> Column:
    """An element of ``seen`` as an array with a struct for each of its dates."""
    def day(date: Column, nth: Column) -> Column:
        start, distance = F.get(seen.getField("starts"), nth), F.get(seen.getField("distances"), nth)
        return F.struct(
            date.alias("service_date"), _scheduled(date, start, seen.getField("arrival")).alias("scheduled_arrival"),
            _at(date, distance).alias("actual_arrival"), *[seen.getField(c).alias(c) for c in _SEEN[:5]],
            start.alias("start"), distance.alias("distance"))
    return F.transform(seen.getField("dates"), day)


def with_gaps(found: DataFrame, parts: int) -> DataFrame:
    """Adds to each element of ``seen`` its headways, in the order of its dates, as ``gaps``.

    A message's arrivals at a call go to the stop as one row and the headways come back as one: times as
    distances from a date, dates as distances from the first, which are much the same from row to row.
    """
    timed = found.select(*_CALL, F.posexplode("seen").alias("k", "s")).where(F.size(F.array_compact("s.distances")) > 0)
    first = F.get("s.dates", F.lit(0))
    timed = timed.select(
        *_CALL, "k", *[f"s.{c}" for c in _PLACE], F.when(F.col("call_trip").isNull(), F.col("s.id_trip")).alias("id_trip"),
        first.alias("first"), F.transform("s.dates", lambda d: F.date_diff(d, first)).alias("days"),
        F.transform("s.distances", lambda d: F.floor(d / F.lit(1_000_000).cast("decimal(7,0)")).cast("bigint")).alias("seconds"))
    timed = timed.repartition(parts, *_PLACE)
    day = F.date_add("first", F.col("day"))
    timed = timed.select("*", F.posexplode("days").alias("nth", "day")).select(
        *_CALL, "k", "nth", *_PLACE, "id_trip", day.alias("service_date"),
        F.timestamp_seconds(F.unix_date(day).cast("bigint") * clock.DAY_SECONDS + F.get("seconds", "nth")).alias("actual_arrival"))
    timed = timed.where(F.col("actual_arrival").isNotNull())
    # An id only tells which of the vehicles of one second comes first.
    order = W.partitionBy(*HEADWAY_KEY).orderBy("actual_arrival")
    tied = [F.coalesce(near.over(order) == F.col("actual_arrival"), F.lit(False)) for near in (
        F.lag("actual_arrival"), F.lead("actual_arrival"))]
    timed = timed.withColumn("tied", tied[0] | tied[1]).withColumn("id_prefix", F.when(F.col("tied"), keys.plain_id_prefix(
        F.col("agency_id"), F.col("service_date"), F.coalesce("call_trip", "id_trip"))))
    gaps = with_headway(keys.with_event_id(timed, "id_prefix", "stop_sequence"))
    gaps = gaps.where(F.col("call_trip").isNotNull()).groupBy(*_CALL, "k", *_PLACE).agg(
        F.sort_array(F.collect_list(F.struct("nth", "headway_seconds"))).alias("told"))
    gaps = gaps.select(*_CALL, "k", F.col("told.nth").alias("nths"), F.col("told.headway_seconds").alias("gaps"))
    gaps = gaps.repartition(parts, "agency_id", "match_trip").groupBy(*_CALL).agg(
        F.collect_list(F.struct("k", "nths", "gaps")).alias("told"))

    def own(seen: Column, k: Column) -> Column:
        def gap(told: Column) -> Column:
            whole = F.size(told.getField("nths")) == F.size(seen.getField("dates"))
            return F.when(whole, told.getField("gaps")).otherwise(F.transform(seen.getField("dates"), lambda _, n: F.get(
                told.getField("gaps"), F.array_position(told.getField("nths"), n).cast("int") - 1)))
        return _let(F.get(F.filter("told", lambda t: t.getField("k") == k), F.lit(0)), gap)

    names = found.schema["seen"].dataType.elementType.names
    return found.join(gaps, list(_CALL), "left").select(*_CALL, F.transform("seen", lambda s, k: F.struct(
        *[s.getField(c).alias(c) for c in names], own(s, k).alias("gaps"))).alias("seen"))


def filled_calls(
    calls: DataFrame, seen: DataFrame, zones: Iterable[str] = (), carried: tuple[str, ...] = (),
) -> DataFrame:
    """The fact table with the realtime columns of ``observed_by_call``, joined before a call becomes a row a date."""
    headways = "gaps" in seen.schema["seen"].dataType.elementType.names
    own = calls.withColumn("call_trip", F.when(F.col("stop_sequence").isNotNull(), F.col("trip_id")))
    only = F.get("seen", F.lit(0))
    joined = own.join(seen, list(_CALL), "left")
    # Mostly one message speaks of all dates; else each date has what was seen of it, or null.
    even = F.col("seen").isNull() | ((F.size("seen") == 1) & (only.getField("dates") == F.col("dates")))
    more = ("gaps",) if headways else ()

    def seen_days(element: Column) -> Column:
        rows = _days(element)
        return F.transform(rows, lambda r, nth: F.struct(
            r.getField("service_date").alias("service_date"), r.getField("actual_arrival").alias("actual_arrival"),
            r.getField("scheduled_arrival").alias("scheduled_arrival"), *[r.getField(c).alias(c) for c in _SEEN[1:4]],
            *[F.get(element.getField(c), nth).alias(c) for c in more]))

    def rows(all_days: Column) -> Column:
        def row(day: Column, nth: Column) -> Column:
            return _let(F.filter(all_days, lambda s: s.getField("service_date") == day), lambda found: F.when(
                F.size(found) > 0, F.transform(found, lambda s: F.struct(nth.alias("nth"), s.alias("rt")))).otherwise(
                F.array(F.struct(nth.alias("nth"), F.get(found, F.lit(0)).alias("rt")))))
        return F.flatten(F.transform("dates", row))

    joined = joined.withColumn("rows", F.when(~even, _let(F.flatten(F.transform("seen", seen_days)), rows)))

    def each(column: str) -> Column:
        return F.when(F.col("rows").isNull(), F.col(column)).otherwise(
            F.transform("rows", lambda r: F.get(column, r.getField("nth"))))

    lone = F.when(F.col("rows").isNull(), only)
    joined = joined.select(
        *[c for c in joined.columns if c not in ("dates", "starts", "seen", "rows")], each("dates").alias("dates"),
        each("starts").alias("starts"), F.col("rows.rt").alias("rt"), F.col("rows").isNull().alias("even"),
        *[lone.getField(c).alias(f"_{c}") for c in (*_SEEN[1:4], "distances", *more)])
    by_date = ("rt", "_distances", *[f"_{c}" for c in more])
    facts = schedule.fact_rows(
        joined, zones, (*carried, "even", *[f"_{c}" for c in _SEEN[1:4]]), each=by_date)

    def told(plain: Column, name: str) -> Column:
        return F.when(F.col("even"), plain).otherwise(F.col(f"rt.{name}"))

    actual = told(_at(F.col("service_date"), F.col("_distances")), "actual_arrival")
    facts = facts.withColumn("actual_arrival", actual)
    scheduled = told(F.col("scheduled_arrival"), "scheduled_arrival")
    facts = facts.withColumns({
        "delay_seconds": delays.delay_seconds(scheduled, F.col("actual_arrival")),
        **{c: told(F.col(f"_{c}"), c) for c in _SEEN[1:4]},
        **({"headway_seconds": told(F.col("_gaps"), "gaps")} if headways else {})})
    return sc.conform(facts, sc.FACTS, "service_date", *carried)


# --- headway --------------------------------------------------------------

HEADWAY_KEY = ("service_date", "route_key", "stop_key", "direction_id")


def with_headway(events: DataFrame) -> DataFrame:
    """Adds ``headway_seconds``: whole seconds since the previous vehicle.

    Null for the first vehicle of a route, stop and direction on a service date, and
    without an arrival; an unstated direction is a group of its own.  Vehicles of one
    second follow each other in event id order with a headway of 0.

    One window over the arrivals of a stop on a day; rows without an arrival are
    windows of their own and never beside them.
    """
    second = delays.epoch_second(F.col("actual_arrival"))
    timed = events.withColumn("second", second)
    order = W.partitionBy(*HEADWAY_KEY, F.isnull("second")).orderBy("second", "event_id")
    gap = (F.col("second") - F.lag("second").over(order)).cast("int")
    return timed.withColumn("headway_seconds", gap).drop("second")


# --- polls ----------------------------------------------------------------


def changed_between_polls(
    polls: DataFrame, key: list[str], payload: list[str], polled_at: str = "polled_at"
) -> DataFrame:
    """Updates that differ from the previous poll of the same key.

    Only rows equal in key, time and payload are one poll; polls of one instant follow
    each other in payload order.  ``key`` should contain the service date, which bounds
    the window by the polls of one key on one day.
    """
    distinct = polls.select(*key, polled_at, *payload).distinct()
    order = W.partitionBy(*key).orderBy(polled_at, *payload)
    body = F.struct(*payload)
    compared = distinct.withColumns({
        "_rank": F.row_number().over(order), "_same": body.eqNullSafe(F.lag(body).over(order)),
    })
    return compared.where((F.col("_rank") == 1) | ~F.col("_same")).select(*key, polled_at, *payload)


# --- windows over time ----------------------------------------------------

#: Window name -> (length, slide) in seconds.  Fixed lengths; the slides are ours.
ROLLING = {"5m": (300, 300), "1h": (3600, 300), "24h": (86_400, 3600)}

#: Published percentiles.
PERCENTILES = {"p50_delay": 50, "p90_delay": 90, "p99_delay": 99}


def usable(events: DataFrame) -> DataFrame:
    """Adds ``measured``: whether the event's delay may be averaged."""
    return events.withColumn(
        "measured",
        delays.measurable(
            F.col("schedule_relationship"), F.col("is_cancelled"), F.col("delay_seconds")
        ),
    )


def window_columns(prefix: list[str]) -> list[Column]:
    """Published columns of a finished window."""
    measured = F.col("measured_events")
    return [
        *[F.col(c) for c in prefix],
        F.col("window_start"), F.col("window_end"),
        F.col("events"), measured,
        F.try_divide(F.col("delay_total").cast("double"), measured).alias("mean_delay"),
        F.try_divide(F.col("on_time_events").cast("double"), measured).alias("on_time_share"),
        *[F.col(name) for name in PERCENTILES],
    ]


def rolling(
    events: DataFrame,
    key: str | list[str],
    size: str = "1h",
    time: str = "actual_arrival",
    threshold: int = delays.ON_TIME_SECONDS,
    percentiles: bool = True,
) -> DataFrame:
    """Rolling delay statistics per key, with exact discrete percentiles if they are asked for.

    Events are counted once, per pane as long as the slide and per whole second of
    delay.  Only these counts fan out to the windows that contain a pane, so a 24-hour
    window costs no more per event than a five-minute one, and its largest group is
    the number of different delays, whatever the traffic.
    """
    if size not in ROLLING:
        raise TransitError(f"no window {size!r}; windows are {sorted(ROLLING)}")
    length, slide = ROLLING[size]
    keys_ = [key] if isinstance(key, str) else list(key)
    second = delays.epoch_second(F.col(time))
    pane = (F.floor(second / slide) * slide).alias("start")
    delay = F.when(F.col("measured"), F.col("delay_seconds")).cast("bigint").alias("delay")
    counts = usable(events.where(F.col(time).isNotNull())).groupBy(*keys_, pane, delay).agg(
        F.count(F.lit(1)).alias("n"))
    if not percentiles:
        return _plain_rolling(counts, keys_, length, slide, threshold)
    if length > slide:
        starts = F.sequence(F.col("start") - (length - slide), F.col("start"), F.lit(slide))
        counts = counts.withColumn("start", F.explode(starts)).groupBy(*keys_, "start", "delay").agg(
            F.sum("n").alias("n"))
    group = W.partitionBy(*keys_, "start")
    known = F.when(F.col("delay").isNotNull(), F.col("n")).otherwise(0)
    upwards = group.orderBy(F.col("delay").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
    weighed = counts.withColumns({
        "known": known, "reached": F.sum(known).over(upwards), "total": F.sum(known).over(group)})
    windows = weighed.groupBy(*keys_, "start").agg(
        F.sum("n").alias("events"),
        F.sum("known").alias("measured_events"),
        F.sum(F.col("delay") * F.col("n")).alias("delay_total"),
        F.sum(F.when(delays.on_time(F.col("delay"), threshold), F.col("known")).otherwise(0))
        .alias("on_time_events"),
        *[F.min(F.when(100 * F.col("reached") >= share * F.col("total"), F.col("delay"))).alias(name)
          for name, share in PERCENTILES.items()],
    )
    finished = windows.withColumns({
        "window_start": F.timestamp_seconds("start"),
        "window_end": F.timestamp_seconds(F.col("start") + length),
    })
    return finished.select(*window_columns(keys_))


def _plain_rolling(counts: DataFrame, keys_: list[str], length: int, slide: int, threshold: int) -> DataFrame:
    """Rolling statistics without percentiles: a pane's sums fan out, not its counts by delay."""
    known = F.when(F.col("delay").isNotNull(), F.col("n")).otherwise(0)
    parts = {
        "events": F.col("n"), "measured_events": known, "delay_total": F.col("delay") * F.col("n"),
        "on_time_events": F.when(delays.on_time(F.col("delay"), threshold), known).otherwise(0)}
    panes = counts.groupBy(*keys_, "start").agg(*[F.sum(part).alias(name) for name, part in parts.items()])
    if length > slide:
        starts = F.sequence(F.col("start") - (length - slide), F.col("start"), F.lit(slide))
        panes = panes.withColumn("start", F.explode(starts)).groupBy(*keys_, "start").agg(
            *[F.sum(name).alias(name) for name in parts])
    finished = panes.withColumns({
        "window_start": F.timestamp_seconds("start"),
        "window_end": F.timestamp_seconds(F.col("start") + length),
        **{name: F.lit(None).cast("bigint") for name in PERCENTILES},
    })
    return finished.select(*window_columns(keys_)).drop(*PERCENTILES)


def current_stats(windows: DataFrame, key: str) -> DataFrame:
    """The newest window of every key."""
    rest = [c for c in windows.columns if c not in (key, "window_start")]
    newest = F.max_by(F.struct("window_start", *rest), "window_start").alias("latest")
    return windows.groupBy(key).agg(newest).select(key, "latest.*").select(windows.columns)


# --- baselines and anomalies ----------------------------------------------


def _slot(instant: Column, zone: Column | None) -> dict[str, Column]:
    local = instant if zone is None else F.from_utc_timestamp(instant, zone)
    return {"day_of_week": F.weekday(local), "hour": F.hour(local)}


def delay_baseline(
    events: DataFrame, time: str = "actual_arrival", zone: Column | None = None
) -> DataFrame:
    """Mean measured delay per route, day of week and hour."""
    measured = usable(events).where(F.col("measured"))
    slots = measured.withColumns(_slot(F.col(time), zone))
    return slots.groupBy("route_key", "day_of_week", "hour").agg(
        F.avg("delay_seconds").alias("baseline_delay"),
        F.count(F.lit(1)).alias("baseline_events"),
    )


def anomalies(
    windows: DataFrame,
    baseline: DataFrame,
    threshold: int = delays.ANOMALY_SECONDS,
    observations: int = delays.ANOMALY_OBSERVATIONS,
    zone: Column | None = None,
) -> DataFrame:
    """Windows whose mean delay exceeds the baseline of their slot by the threshold."""
    thick = windows.where(F.col("measured_events") >= observations)
    slots = thick.withColumns(_slot(F.col("window_start"), zone))
    compared = slots.join(baseline, ["route_key", "day_of_week", "hour"])
    excess = F.col("mean_delay") - F.col("baseline_delay")
    return compared.where(excess > threshold).select(
        "route_key", "window_start", "window_end", "measured_events", "mean_delay",
        "baseline_delay", excess.alias("excess_delay"),
    )


# --- feed health and scenarios --------------------------------------------


def stale_polls(
    polls: DataFrame, limit: int = delays.STALE_SECONDS,
    polled_at: str = "polled_at", header_at: str = "header_at",
) -> DataFrame:
    """Polls whose feed header is older than the limit, as health events."""
    stale = delays.is_stale(F.col(polled_at), F.col(header_at), limit)
    age = delays.epoch_second(F.col(polled_at)) - delays.epoch_second(F.col(header_at))
    return polls.where(stale).withColumn("age_seconds", age)


def scenario_facts(
    facts: DataFrame, overrides: DataFrame, scenarios: list[str], on: list[str]
) -> DataFrame:
    """The facts once as ``base`` and once per scenario with changed delays.

    ``overrides`` has (scenario, *on, delay_change); calls without an override keep
    their delay.
    """
    names = F.explode(F.array(*[F.lit(n) for n in ("base", *scenarios)]))
    branched = facts.withColumn("scenario", names)
    changed = branched.join(overrides, ["scenario", *on], "left")
    new_delay = (F.col("delay_seconds") + F.coalesce("delay_change", F.lit(0))).cast("int")
    return changed.withColumn("delay_seconds", new_delay).drop("delay_change")
