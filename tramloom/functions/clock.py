"""Timetable clock values, service dates and local time.

A timetable clock counts seconds from noon minus twelve hours on the service
date and may run past 24 hours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
#: Clock hours run from 0 up to but not including this.
CLOCK_HOURS = 48

_BLANKS = " \t\n\r\x0b\x0c"
# Hours 0..47 and sixty minutes and seconds, signs and leading zeros allowed.
_ZERO = r"[+-]?0+|[+]?0*[1-9]"
_HOUR = rf"({_ZERO}|[+]?0*[1-3][0-9]|[+]?0*4[0-7])"
_SIXTY = rf"({_ZERO}|[+]?0*[1-5][0-9])"
_CLOCK = rf"^\s*{_HOUR}:{_SIXTY}:{_SIXTY}\s*$"
_DAY = r"^[0-9]{8}$"

#: States of a parsed clock text.
OK, ABSENT, MALFORMED = "ok", "absent", "malformed"
ABSENT_CODE, MALFORMED_CODE = -1, -2

# Half-open local-hour bounds; Overnight is what remains.
PERIODS = (
    (6, 10, "AM Peak"),
    (10, 16, "Midday"),
    (16, 20, "PM Peak"),
    (20, 24, "Evening"),
)
OVERNIGHT = "Overnight"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def clock_code(text: Column) -> Column:
    """Seconds of an ``H:MM:SS`` text, or one of the negative codes for the others."""
    hours = F.substring_index(text, ":", 1)
    minutes = F.substring_index(F.substring_index(text, ":", 2), ":", -1)
    seconds = F.substring_index(text, ":", -1)
    total = hours.cast("int") * 3600 + minutes.cast("int") * 60 + seconds.cast("int")
    return (
        F.when(text.rlike(_CLOCK), total)
        .when(F.coalesce(strip(text), F.lit("")) == "", ABSENT_CODE)
        .otherwise(MALFORMED_CODE)
    )


def code_state(code: Column) -> Column:
    """Whether a clock cell was usable, blank, or unreadable."""
    return F.when(code >= 0, OK).when(code == ABSENT_CODE, ABSENT).otherwise(MALFORMED)


def clock_seconds(text: Column) -> Column:
    """Seconds of an ``H:MM:SS`` text; null when blank or malformed."""
    code = clock_code(text)
    return F.when(code >= 0, code)


def rolls_over(seconds: Column) -> Column:
    """On the calendar day after its service date."""
    return seconds >= DAY_SECONDS


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def format_clock(seconds: Column) -> Column:
    """``HH:MM:SS`` with the hours counting past 24."""
    hours = F.floor(seconds / 3600).cast("int")
    minutes = F.floor((seconds % 3600) / 60).cast("int")
    parts = (_two_digits(hours), _two_digits(minutes), _two_digits(seconds % 60))
    return F.when(seconds.isNotNull(), F.concat_ws(":", *parts))


def service_day(text: Column) -> Column:
    """A strict ``YYYYMMDD`` text as a date; null when it is not one."""
    clean = strip(text)
    return F.when(clean.rlike(_DAY), F.try_to_timestamp(clean, F.lit("yyyyMMdd")).cast("date"))


def by_zone(zone: Column, zones: Iterable[str], convert: Callable[[Column], Column]) -> Column:
    """``convert(zone)`` with the usual zones spelled out as literals.

    Spark looks a literal zone up once per task but a zone column on every row, which
    costs more than the conversion.  Zones not listed still convert, only slower.
    """
    branches = None
    for name in sorted(set(zones)):
        value = convert(F.lit(name))
        same = zone == name
        branches = F.when(same, value) if branches is None else branches.when(same, value)
    return convert(zone) if branches is None else branches.otherwise(convert(zone))


def day_start(service_date: Column, zone: Column, zones: Iterable[str] = ()) -> Column:
    """Epoch second a service day counts from: local noon minus twelve hours.

    No zone skips or repeats noon, so days of 23 and 25 hours come out right.  Needs
    the session time zone pinned to UTC.
    """
    noon = service_date.cast("timestamp") + F.expr("INTERVAL 12 HOURS")
    instant = by_zone(zone, zones, lambda z: F.to_utc_timestamp(noon, z))
    return F.unix_seconds(instant) - DAY_SECONDS // 2


#: Dates in a word of a bitmap.
WORD_DAYS = 64


def day_word(date: Column) -> Column:
    """The number of the word that has the date's bit."""
    return F.shiftright(F.unix_date(date), 6)


def day_bit(date: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.unix_date(date).bitwiseAND(F.lit(WORD_DAYS - 1)))


def day_words(dates: Column) -> Column:
    """An array of dates as words of bits: an element for each word that any of them is in."""
    def bits(word: Column) -> Column:
        return F.aggregate(F.filter(dates, lambda d: day_word(d) == word), F.lit(0).cast("bigint"),
                           lambda sum_, d: sum_.bitwiseOR(day_bit(d)))

    return F.transform(F.array_distinct(F.transform(dates, day_word)), lambda w: F.struct(w.alias("word"), bits(w).alias("bits")))


def at_clock(start: Column, seconds: Column) -> Column:
    """The instant a clock value names on the day with that start."""
    return F.timestamp_seconds(start + seconds)


def resolve_instant(service_date: Column, seconds: Column, zone: Column) -> Column:
    """The instant a clock value names on a service date."""
    return at_clock(day_start(service_date, zone), seconds)


def local_time(instant: Column, zone: Column) -> Column:
    return F.from_utc_timestamp(instant, zone)


def local_hour(instant: Column, zone: Column, zones: Iterable[str] = ()) -> Column:
    return F.hour(by_zone(zone, zones, lambda z: local_time(instant, z)))


def quarter_hour(instant: Column, zone: Column) -> Column:
    """Which fifteen-minute part of its local hour, 0 to 3."""
    return F.floor(F.minute(local_time(instant, zone)) / 15).cast("int")


def service_period(hour: Column) -> Column:
    """Named part of the day for a local hour 0..23."""
    label = F
    for start, end, name in PERIODS:
        label = label.when((hour >= start) & (hour < end), name)
    return label.otherwise(OVERNIGHT)


def clock_period(hour: Column) -> Column:
    """The same for timetable hours 0..47; outside that range it is an error."""
    outside = F.raise_error(
        F.concat(F.lit("hour "), hour.cast("string"), F.lit(" is outside 0..47"))
    ).cast("string")
    return F.when(hour.between(0, CLOCK_HOURS - 1), service_period(hour % 24)).when(
        hour.isNotNull(), outside
    )


def service_date_for(local: Column, rollover_hour: int = 4) -> Column:
    """Service date of a local timestamp: the small hours belong to the day before."""
    return (local - F.make_dt_interval(hours=F.lit(rollover_hour))).cast("date")


def day_type(service_date: Column, is_holiday: Column) -> Column:
    """Holiday wins over weekend."""
    return (
        F.when(is_holiday, "Holiday")
        .when(F.weekday(service_date) >= 5, "Weekend")
        .otherwise("Weekday")
    )
