"""Key, label and identifier expressions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def namespaced(agency_id: Column, local_id: Column) -> Column:
    """``agency:id``.  ``concat`` rather than ``concat_ws``: a null id stays null."""
    return F.concat(agency_id, F.lit(":"), local_id)


def non_empty(text: Column) -> Column:
    """An empty cell is absence."""
    return F.nullif(text, F.lit(""))


def display_name(short_name: Column, long_name: Column, route_id: Column) -> Column:
    """What a rider calls the route; never null."""
    return F.coalesce(non_empty(short_name), non_empty(long_name), route_id)


def trip_match_key(trip_id: Column, rule: Column) -> Column:
    """The part of a trip id that schedule and realtime agree on."""
    suffix = F.element_at(F.split(trip_id, "_"), -1)
    return F.when(rule == "nyct_suffix", suffix).otherwise(trip_id)


def match_stop_id(stop_id: Column, has_direction_suffix: Column) -> Column:
    """A realtime stop id without its trailing direction letter, where the agency adds one."""
    stripped = F.regexp_replace(stop_id, "[NS]$", "")
    return F.when(has_direction_suffix, stripped).otherwise(stop_id)


# --- event id -------------------------------------------------------------

# Seed, multiplier (2^44 + 435) and field separator of the stored ids.
ID_SEED = 0xCBF29CE484222325
ID_FACTOR = (1 << 44) + 435
ID_SEPARATOR = "\x1f"

_LOW_FACTOR = 435
_HIGH_SHIFT = 44 - 32
_WORD = (1 << 32) - 1


def _absorbed(texts: pa.Array) -> np.ndarray:
    """Multiply-xor hash states over UTF-8 bytes, as signed numbers, straight from Arrow's buffers."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    begin, length = ends[:-1], np.diff(ends)
    state = np.full(len(texts), ID_SEED, np.uint64)
    factor = np.uint64(ID_FACTOR)
    shortest = int(length.min()) if len(length) else 0
    for position in range(int(length.max()) if len(length) else 0):
        if position < shortest:
            state = (state ^ raw[begin + position]) * factor
        else:
            on = np.nonzero(length > position)[0]
            state[on] = (state[on] ^ raw[begin[on] + position]) * factor
    return state.view(np.int64)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _prefixes(agency: pa.Array, dates: pa.Array, trip: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(dates), 0).to_numpy(zero_copy_only=False)
    row = pa.array(np.repeat(np.arange(len(lengths)), lengths))
    parts = (agency.take(row), dates.flatten().cast(pa.string()), trip.take(row))
    texts = pc.binary_join_element_wise(*parts, "", ID_SEPARATOR, null_handling="replace", null_replacement="")
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_absorbed(texts)))


def id_prefixes(agency_id: Column, dates: Column, trip_id: Column) -> Column:
    """Hash state of everything but the stop sequence, for each of an array of service dates.

    The length of the text varies, so this is an Arrow-batched function; it runs
    once per trip and date and not once per call.
    """
    return _prefixes(agency_id, dates, trip_id)


def id_prefix(agency_id: Column, service_date: Column, trip_id: Column) -> Column:
    """The same for one service date."""
    return F.get(id_prefixes(agency_id, F.array(service_date), trip_id), F.lit(0))


def plain_id_prefix(agency_id: Column, service_date: Column, trip_id: Column) -> Column:
    """``id_prefix`` without a Python worker, byte by byte: for the few rows of which an id is asked at all."""
    none = F.lit("")
    text = F.concat_ws(
        ID_SEPARATOR, *[F.coalesce(c, none) for c in (agency_id, service_date.cast("string"), trip_id)], none)
    digits = F.hex(F.encode(text, "UTF-8"))

    def state(high: Column, low: Column) -> Column:
        return F.struct(high.alias("high"), low.alias("low"))

    def absorb(state_: Column, nth: Column) -> Column:
        byte = F.conv(F.substr(digits, 2 * nth + 1, F.lit(2)), 16, 10).cast("bigint")
        mixed = state_.getField("low").bitwiseXOR(byte)
        spill = F.shiftright(mixed * F.lit(_LOW_FACTOR), 32)
        moved = F.shiftleft(mixed.bitwiseAND(F.lit((1 << (32 - _HIGH_SHIFT)) - 1)), _HIGH_SHIFT)
        high = state_.getField("high") * F.lit(_LOW_FACTOR) + spill + moved
        return state(high.bitwiseAND(F.lit(_WORD)), (mixed * F.lit(_LOW_FACTOR)).bitwiseAND(F.lit(_WORD)))

    seed = state(F.lit(ID_SEED >> 32).cast("bigint"), F.lit(ID_SEED & _WORD).cast("bigint"))
    places = F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1)
    return F.aggregate(places, seed, absorb, lambda s: F.shiftleft(s.getField("high"), 32).bitwiseOR(s.getField("low")))


def with_event_id(df: DataFrame, prefix: str, number: str) -> DataFrame:
    """Adds ``event_id`` from the prefix state and the sequence number.

    The four bytes of the number, lowest first, run once per fact row.  They are a
    chain of plain projections on two 32-bit halves, so no product leaves the signed
    64-bit range and everything compiles to straight-line code.
    """
    state = F.col(prefix)
    df = df.withColumns({"_high": F.shiftrightunsigned(state, 32), "_low": state.bitwiseAND(F.lit(_WORD))})
    for position in range(4):
        byte = F.shiftright(F.col(number).cast("bigint"), 8 * position).bitwiseAND(F.lit(0xFF))
        df = df.withColumn("_mixed", F.col("_low").bitwiseXOR(byte))
        mixed = F.col("_mixed")
        spill = F.shiftright(mixed * F.lit(_LOW_FACTOR), 32)
        moved = F.shiftleft(
            mixed.bitwiseAND(F.lit((1 << (32 - _HIGH_SHIFT)) - 1)), _HIGH_SHIFT
        )
        high = F.col("_high") * F.lit(_LOW_FACTOR) + spill + moved
        df = df.withColumns({
            "_high": high.bitwiseAND(F.lit(_WORD)),
            "_low": (mixed * F.lit(_LOW_FACTOR)).bitwiseAND(F.lit(_WORD)),
        })
    digits = [F.lpad(F.lower(F.hex(half)), 8, "0") for half in ("_high", "_low")]
    return df.withColumn("event_id", F.concat(*digits)).drop("_high", "_low", "_mixed")
