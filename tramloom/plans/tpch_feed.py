"""Timetable-shaped views over a general order and event schema.

The tables hold no timetable.  These views read them whole and rename their
columns into a feed, realtime updates and stop events, so that every operator of
the package can run on them.  The SQL twins are in ``oracle.py``.

* An agency is a region and owns every fifth order as a trip; bare trip, route and
  stop ids repeat across agencies, as in real feeds.
* A service is an order priority within one week and runs on its order dates.  Two
  agencies state it as a weekly pattern with exceptions, three as plain dates.
* A call is a line item; a small share is untimed, unreadable or dangling.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramloom.functions import keys
from tramloom.functions.clock import DAY_SECONDS, at_clock
from tramloom.sources.feed import Feed

# Fixed values of the fixture: zone, mode and id rule per region key.
AGENCY_SETTINGS = {
    0: ("Africa/Johannesburg", "bus", "exact", False),
    1: ("America/New_York", "subway", "nyct_suffix", True),
    2: ("Asia/Tokyo", "commuter_rail", "exact", False),
    3: ("Europe/Paris", "commuter_rail", "nyct_suffix", True),
    4: ("Asia/Dubai", "tram", "exact", False),
}
ZONES = tuple(setting[0] for setting in AGENCY_SETTINGS.values())
AGENCY_COUNT = len(AGENCY_SETTINGS)
#: Regions whose services come as weekly patterns; they also model stations.
PATTERN_AGENCIES = (0, 1)


_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Its schema is inferred, which is a job, once a session and path."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def _setting(region: Column, position: int) -> Column:
    pairs = [F.lit(v) for k, s in AGENCY_SETTINGS.items() for v in (k, s[position])]
    return F.create_map(*pairs)[region]


def agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("agency_id"),
        F.concat(F.lit("Transit of "), "r_name").alias("agency_name"),
        _setting(key, 1).alias("mode"),
        _setting(key, 0).alias("timezone"),
        _setting(key, 2).alias("trip_id_match"),
        _setting(key, 3).alias("stop_id_direction_suffix"),
    )


def _with_agency(rows: DataFrame, region: Column, spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("region"), F.col("r_name").alias("agency_id")
    )
    return rows.withColumn("region", region.cast("int")).join(names, "region")


def _trip_id(order_key: Column) -> Column:
    """Bare id, unique within an agency; suffix agencies prefix a run number."""
    number = F.floor(order_key / AGENCY_COUNT).cast("string")
    run = (order_key % 10).cast("string")
    return F.when(
        F.col("region").isin(1, 3), F.concat(F.lit("A"), run, F.lit("_"), number)
    ).otherwise(F.concat(F.lit("T"), number))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = _with_agency(orders, F.col("o_orderkey") % AGENCY_COUNT, spark, sf_dir)
    day = F.col("o_orderdate").cast("date")
    week = F.date_trunc("week", "o_orderdate")
    return rows.withColumns({
        "day": day,
        "week": week.cast("date"),
        "service_id": F.concat(
            F.substring("o_orderpriority", 1, 1), F.lit("-"), F.date_format(week, "yyyyMMdd")
        ),
    })


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    rows = _with_agency(nation, F.col("n_regionkey"), spark, sf_dir)
    key = F.col("n_nationkey")
    number = F.floor(key / AGENCY_COUNT).cast("int")
    return rows.select(
        "agency_id",
        F.col("agency_id").alias("stated_agency_id"),
        number.cast("string").alias("route_id"),
        F.when(number == 3, "").otherwise(F.concat(F.lit("R"), number.cast("string")))
        .alias("route_short_name"),
        F.when(number != 4, F.col("n_name")).alias("route_long_name"),
        (number % 4).alias("route_type"),
        F.lit("").alias("route_color"),
    )


def _stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier is a stop of every agency: bare stop ids repeat five times."""
    suppliers = table(spark, sf_dir, "supplier").withColumn(
        "served", F.explode(F.sequence(F.lit(0), F.lit(AGENCY_COUNT - 1)))
    )
    rows = _with_agency(suppliers, F.col("served"), spark, sf_dir)
    key = F.col("s_suppkey")
    balance = F.col("s_acctbal")
    models_stations = F.col("region").isin(*PATTERN_AGENCIES)
    station = key % 10 == 0
    parent = (
        F.when(models_stations & ~station & (balance > 9500),
               F.concat(F.lit("X"), key.cast("string")))
        .when(models_stations & ~station, (key - key % 10).cast("string"))
        .otherwise("")
    )
    # Coordinates spread over the nations' unit squares, see ``boundaries``.
    nation = F.col("s_nationkey")
    return rows.select(
        "agency_id",
        key.cast("string").alias("stop_id"),
        F.when(balance >= 0, F.col("s_name")).alias("stop_name"),
        F.when(balance >= 500, F.floor(nation / 5) + (key % 97 + 1) / 98.0).alias("stop_lat"),
        F.when(balance >= 500, nation % 5 + (key % 89 + 1) / 90.0).alias("stop_lon"),
        F.when(models_stations & station, 1).when(models_stations, None).otherwise(0)
        .cast("int").alias("location_type"),
        parent.alias("parent_station"),
    )


def _trips(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    route = F.floor(F.col("c_nationkey") / AGENCY_COUNT).cast("string")
    price = F.col("o_totalprice")
    return rows.select(
        "agency_id",
        _trip_id(F.col("o_orderkey")).alias("trip_id"),
        F.when(price > 499_000, "9").otherwise(route).alias("route_id"),
        F.when(price < 2_000, "NONE").otherwise(F.col("service_id")).alias("service_id"),
        F.concat(F.lit("to "), "o_orderstatus").alias("trip_headsign"),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
        .cast("int").alias("direction_id"),
    )


def _clock(seconds: Column) -> Column:
    def two(number: Column) -> Column:
        return F.lpad(number.cast("string"), 2, "0")

    hours = F.floor(seconds / 3600)
    minutes = F.floor(seconds / 60) % 60
    return F.concat_ws(":", two(hours), two(minutes), two(seconds % 60))


def _stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_agency(
        table(spark, sf_dir, "lineitem"), F.col("l_orderkey") % AGENCY_COUNT, spark, sf_dir
    )
    col = F.col
    part, supplier, line = col("l_partkey"), col("l_suppkey"), col("l_linenumber")
    cents = F.floor(col("l_extendedprice") * 100 + 0.5)
    # Unique within an order in practice, without numbering its lines.
    mixed = (part * 7919 + supplier * 104_729 + cents) % 100_000_000
    # 04:00 up to 27:59.
    arrival = 14_400 + (part * 37 + line * 600 + supplier * 11) % 86_400
    departure = arrival + col("l_quantity").cast("bigint") - 5
    no_tax = col("l_tax") == 0
    garbled = (col("l_discount") == 0.1) & (col("l_tax") == 0.08)
    gone = (col("l_discount") == 0.1) & (col("l_quantity") == 50)
    void = (col("l_discount") == 0.09) & (col("l_tax") == 0.07) & (col("l_quantity") == 49)
    return rows.select(
        "agency_id",
        F.when(void, F.concat(F.lit("void-"), line.cast("string")))
        .otherwise(_trip_id(col("l_orderkey"))).alias("trip_id"),
        F.when(gone, F.concat(F.lit("gone-"), line.cast("string")))
        .otherwise(supplier.cast("string")).alias("stop_id"),
        (line * 100_000_000 + mixed).cast("int").alias("stop_sequence"),
        F.when(no_tax & col("l_returnflag").isin("A", "N"), "")
        .otherwise(F.substr(_clock(arrival), F.lit(1), F.when(garbled, 5).otherwise(8)))
        .alias("arrival_time"),
        F.when(no_tax & col("l_returnflag").isin("A", "R"), "")
        .otherwise(_clock(departure)).alias("departure_time"),
    )


def _calendars(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weekly patterns and exceptions.

    A date on which a service has only pending orders is removed again; for the
    pattern agencies a Sunday is an exception and not part of the pattern.
    """
    pattern = F.col("region").isin(*PATTERN_AGENCIES)
    weekday = F.weekday("day")
    names = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
    calendar = (
        orders.where(pattern)
        .groupBy("agency_id", "service_id", "week")
        .agg(*[F.max((weekday == i).cast("int")).alias(n) for i, n in enumerate(names)])
        .select(
            "agency_id", "service_id", *names, F.lit(0).alias("sunday"),
            F.date_format("week", "yyyyMMdd").alias("start_date"),
            F.date_format(F.date_add("week", 6), "yyyyMMdd").alias("end_date"),
        )
    )
    days = orders.groupBy("region", "agency_id", "service_id", "day").agg(
        F.min("o_orderstatus").alias("first_status")
    )
    added = F.when(~pattern | (F.weekday("day") == 6), F.lit(1))
    removed = F.when(F.col("first_status") == "P", F.lit(2))
    dates = days.select(
        "agency_id", "service_id", F.date_format("day", "yyyyMMdd").alias("date"),
        F.explode(F.array(added, removed)).alias("exception_type"),
    ).where(F.col("exception_type").isNotNull())
    return calendar, dates


def feed(spark: SparkSession, sf_dir: str) -> Feed:
    orders = _orders(spark, sf_dir)
    calendar, calendar_dates = _calendars(orders)
    agency = agencies(spark, sf_dir).select(
        "agency_id", F.col("agency_id").alias("stated_agency_id"), "agency_name",
        F.col("timezone").alias("agency_timezone"),
    )
    return Feed(
        agency=agency,
        routes=_routes(spark, sf_dir),
        stops=_stops(spark, sf_dir),
        trips=_trips(orders, spark, sf_dir),
        stop_times=_stop_times(spark, sf_dir),
        calendar=calendar,
        calendar_dates=calendar_dates,
    )


def feed_with_duplicates(spark: SparkSession, sf_dir: str) -> Feed:
    """The feed with some keys stated twice: named stops in the south, and route 2."""
    base = feed(spark, sf_dir)
    again = base.stops.where((F.col("stop_lat") < 1) & F.col("stop_name").isNotNull())
    routes = base.routes.unionByName(base.routes.where(F.col("route_id") == "2"))
    tables = dict(vars(base), stops=base.stops.unionByName(again), routes=routes)
    return Feed(**tables)


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A four-cornered, slanted borough inside each nation's unit square."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    x = (F.col("n_nationkey") % 5).cast("double")
    y = F.floor(F.col("n_nationkey") / 5).cast("double")

    def corner(dx: float, dy: float) -> Column:
        return F.struct((x + dx).alias("lon"), (y + dy).alias("lat"))

    ring = F.array(corner(0.05, 0.1), corner(0.9, 0.02), corner(0.97, 0.85), corner(0.2, 0.95))
    return nation.select(
        F.col("n_name").alias("borough"), F.col("r_name").alias("municipality"),
        ring.alias("ring"),
    )


# --- realtime -------------------------------------------------------------

# Fixed values of the fixture: relationship per event type.
RELATIONSHIPS = {
    "click": "SCHEDULED", "view": "SCHEDULED", "purchase": "ADDED", "signup": "CANCELED",
}


def relationship(event_type: Column) -> Column:
    """Event types as relationships; ``error`` is an unstated one."""
    pairs = [F.lit(v) for pair in RELATIONSHIPS.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), event_type)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


def as_events(events: DataFrame) -> DataFrame:
    """Raw events (batch or stream) with an instant and the number in their JSON."""
    number = F.from_json("props", "k int").getField("k")
    return events.withColumns({"instant": F.col("ts").cast("timestamp"), "number": number})


def observed_calls(events: DataFrame, *more: str) -> DataFrame:
    """Stop events straight from the event table (batch or stream).

    The user number picks agency, route and direction, the JSON number the stop and
    the value the delay.  The service date follows the four o'clock rule in UTC.  ``more``
    names columns to carry along.
    """
    from tramloom.functions.clock import service_date_for

    user = F.col("user_id")
    agency = F.concat(F.lit("N"), (user % AGENCY_COUNT).cast("string"))
    route = (F.floor(user / AGENCY_COUNT) % 5).cast("string")
    relation = relationship(F.col("event_type"))
    ran = F.coalesce(relation != "CANCELED", F.lit(True))
    delay = (F.col("value") * 6 - 120).cast("int")
    return events.select(
        F.lpad(F.col("event_id").cast("string"), 16, "0").alias("event_id"),
        service_date_for(F.col("instant")).alias("service_date"),
        agency.alias("agency_id"),
        keys.namespaced(agency, route).alias("route_key"),
        keys.namespaced(agency, (F.col("number") % 20).cast("string")).alias("stop_key"),
        F.when(user % 3 < 2, (user % 3).cast("int")).alias("direction_id"),
        F.col("instant").alias("actual_arrival"),
        F.when(ran, delay).alias("delay_seconds"),
        (~ran).alias("is_cancelled"),
        relation.alias("schedule_relationship"),
        user.cast("string").alias("vehicle_id"),
        *more,
    )


#: The longest way of a message: no event's value reaches 700.
LONGEST_WAY = "2 hours"


def sent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as messages: an event arrives ten seconds a value after its time."""
    way = F.make_dt_interval(secs=(F.col("value") * 10).cast("bigint"))
    return table(spark, sf_dir, "events").withColumn("received_at", F.col("ts").cast("timestamp") + way)


def closing_event(events: DataFrame) -> DataFrame:
    """A heartbeat ten days after the last event: all columns but the time are null."""
    late = F.max("ts") + F.make_dt_interval(days=F.lit(10))
    kinds = {f.name: f.dataType for f in events.schema.fields}
    return events.agg(late.alias("ts")).select(
        *[F.col("ts") if c == "ts" else F.lit(None).cast(kinds[c]).alias(c) for c in events.columns])


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_calls(_events(spark, sf_dir))


def updates(spark: SparkSession, sf_dir: str, calls: DataFrame, services: DataFrame) -> DataFrame:
    """Realtime updates: each event reports one vehicle, and through it a trip's calls.

    A reported trip's calls become a row a date after they have met the events.
    """
    reported = _reported(_events(spark, sf_dir), spark, sf_dir)
    rows = _reported_calls(reported, calls, services, ["agency_id", "trip_id"])
    rows = rows.select("*", F.posexplode_outer("dates").alias("nth", "call_date"))
    start = F.unix_date("call_date").cast("bigint") * DAY_SECONDS + F.get("starts", "nth")
    return _as_updates(rows.withColumn("call_at", at_clock(start, F.col("arrival"))))


def messages(
    spark: SparkSession, sf_dir: str, calls: DataFrame, services: DataFrame, laid: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The same updates, one row for a reported call, with its dates and arrivals as the array ``days``.

    ``laid`` puts the events where ``calls`` lie, by agency and ``match_trip``.
    """
    reported = laid(_reported(_events(spark, sf_dir), spark, sf_dir))
    rows = _reported_calls(reported, calls, services, ["agency_id", "match_trip", "trip_id"])

    def told(date: Column, at: Column) -> Column:
        return F.struct(_told_date(date).alias("service_date"), _told_arrival(at).alias("actual_arrival"))

    def at(date: Column, nth: Column) -> Column:
        return at_clock(F.unix_date(date).cast("bigint") * DAY_SECONDS + F.get("starts", nth), F.col("arrival"))

    days = F.transform("dates", lambda date, nth: told(date, at(date, nth)))
    alone = F.array(told(F.lit(None).cast("date"), F.lit(None).cast("timestamp")))
    rows = rows.withColumn("days", F.when(F.size("dates") > 0, days).otherwise(alone))
    lone = rows.withColumns({"call_date": F.lit(None).cast("date"), "call_at": F.lit(None).cast("timestamp")})
    return _as_updates(lone, "days").drop("service_date", "actual_arrival")


def _reported_calls(reported: DataFrame, calls: DataFrame, services: DataFrame, on: list[str]) -> DataFrame:
    """Reported trips beside their calls (call_stop, arrival) and the dates of these."""
    own = calls.select(*on, F.col("service_id").alias("call_service"), F.col("stop_id").alias("call_stop"), "arrival")
    # A service may be stated for several zones, so it is looked up with its calls.
    days = services.where(F.col("timezone").isNotNull()).select(
        "agency_id", F.col("service_id").alias("call_service"), "dates", "starts")
    return reported.join(own, on, "left").join(F.broadcast(days), ["agency_id", "call_service"], "left")


def updates_of(events: DataFrame, spark: SparkSession, sf_dir: str, facts: DataFrame, *more: str) -> DataFrame:
    """The updates that ``events`` (batch or stream) report; ``more`` names columns to carry along.

    The ids are written the way a realtime feed writes them: another run prefix and a direction
    letter where the agency uses them, and some trips nobody scheduled.  An event whose trip has
    no scheduled call is an update as well, of a trip and a stop of its own on its own date.
    """
    reported = _reported(events, spark, sf_dir)
    calls = facts.select(
        "agency_id", "trip_id", F.col("service_date").alias("call_date"), F.col("stop_id").alias("call_stop"),
        F.col("scheduled_arrival").alias("call_at"))
    return _as_updates(reported.join(calls, ["agency_id", "trip_id"], "left"), *more)


def _reported(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the trip they report."""
    return _with_agency(events, F.col("event_id") % AGENCY_COUNT, spark, sf_dir).withColumn(
        "trip_id", _trip_id(F.col("event_id")))


def _as_updates(rows: DataFrame, *more: str) -> DataFrame:
    """Events beside the calls they report (call_date, call_stop, call_at) as updates."""
    relation = relationship(F.col("event_type"))
    suffixed = F.col("region").isin(1, 3)
    unknown = F.col("value") > 200
    realtime_trip = F.when(suffixed, F.concat(F.lit("RT_x_"), F.element_at(
        F.split("trip_id", "_"), -1))).otherwise(F.col("trip_id"))
    stop = F.coalesce("call_stop", (F.col("number") % 20).cast("string"))
    return rows.select(
        "agency_id", _told_date(F.col("call_date")).alias("service_date"),
        F.when(unknown, F.concat(realtime_trip, F.lit("-extra"))).otherwise(realtime_trip)
        .alias("trip_id"),
        F.when(suffixed, F.concat(stop, F.when(F.col("user_id") % 2 == 0, "N").otherwise("S")))
        .otherwise(stop).alias("stop_id"),
        F.col("instant").alias("polled_at"),
        _told_arrival(F.col("call_at")).alias("actual_arrival"),
        relation.alias("schedule_relationship"),
        (~_ran()).alias("is_cancelled"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        *more,
    )


def _ran() -> Column:
    return F.coalesce(relationship(F.col("event_type")) != "CANCELED", F.lit(True))


def _told_date(call_date: Column) -> Column:
    return F.coalesce(call_date, F.col("instant").cast("date"))


def _told_arrival(call_at: Column) -> Column:
    late = (F.col("value") * 6 - 120).cast("int")
    arrival = F.coalesce(F.unix_seconds(call_at) + late, F.unix_seconds("instant"))
    return F.when(_ran(), F.timestamp_seconds(arrival))


def polls(events: DataFrame) -> DataFrame:
    """Vehicle polls: one vehicle's state (stop zone and relationship) at a time."""
    return events.select(
        F.col("user_id").alias("vehicle"),
        F.col("instant").cast("date").alias("service_date"),
        F.col("instant").alias("polled_at"),
        (F.col("number") % 3).cast("int").alias("zone"),
        relationship(F.col("event_type")).alias("schedule_relationship"),
        F.timestamp_micros(
            F.unix_micros("instant") - (F.col("value") * 10).cast("bigint") * 1_000_000
        ).alias("header_at"),
    )
