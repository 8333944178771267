"""The agency registry: a small TOML file, read on the driver."""

from __future__ import annotations

import tomllib
from dataclasses import astuple, dataclass, field, fields
from pathlib import Path
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from tramloom import schemas as sc
from tramloom.errors import RegistryError

TRIP_ID_RULES = ("exact", "nyct_suffix")

AGENCIES = sc.struct(
    ("agency_id", sc.S), ("agency_name", sc.S), ("mode", sc.S), ("timezone", sc.S),
    ("trip_id_match", sc.S), ("stop_id_direction_suffix", sc.B),
)


@dataclass(frozen=True)
class Agency:
    id: str
    name: str
    mode: str
    timezone: str
    trip_id_match: str = "exact"
    stop_id_direction_suffix: bool = False


@dataclass(frozen=True)
class Defaults:
    poll_interval_seconds: int = 30
    stale_after_seconds: int = 300
    request_timeout_seconds: int = 20
    on_time_threshold_seconds: int = 300


@dataclass(frozen=True)
class Registry:
    agencies: tuple[Agency, ...]
    defaults: Defaults = field(default_factory=Defaults)

    def __post_init__(self) -> None:
        if not self.agencies:
            raise RegistryError("the registry defines no agencies")
        ids = [a.id for a in self.agencies]
        repeated = sorted({i for i in ids if ids.count(i) > 1})
        if repeated:
            raise RegistryError(f"duplicate agency id {repeated[0]!r}")
        for agency in self.agencies:
            try:
                ZoneInfo(agency.timezone)
            except (KeyError, ValueError, OSError) as error:
                raise RegistryError(
                    f"agency {agency.id} has unknown timezone {agency.timezone!r}"
                ) from error
            if agency.trip_id_match not in TRIP_ID_RULES:
                raise RegistryError(
                    f"agency {agency.id}: trip_id_match must be one of {TRIP_ID_RULES}"
                )

    def agency(self, agency_id: str) -> Agency:
        for agency in self.agencies:
            if agency.id == agency_id:
                return agency
        raise RegistryError(f"the registry defines no agency {agency_id!r}")

    def select(self, agency_id: str | None = None) -> tuple[Agency, ...]:
        """One named agency, or all of them."""
        return self.agencies if agency_id is None else (self.agency(agency_id),)

    @property
    def zones(self) -> tuple[str, ...]:
        return tuple(sorted({a.timezone for a in self.agencies}))

    def frame(self, spark: SparkSession, agency_id: str | None = None) -> DataFrame:
        """The registry as rows.  It is a file a person edits, so it stays small."""
        return spark.createDataFrame([astuple(a) for a in self.select(agency_id)], AGENCIES)


def _known(entry: dict, allowed: set[str], where: str) -> None:
    unknown = sorted(set(entry) - allowed)
    if unknown:
        raise RegistryError(f"{where}: unknown key {unknown[0]!r}")


def load_registry(path: str | Path) -> Registry:
    """Read and check a registry file.  Misspelled keys are errors, not silence."""
    try:
        raw = tomllib.loads(Path(path).read_text(encoding="utf-8"))
    except OSError as error:
        raise RegistryError(f"could not read {path}") from error
    except tomllib.TOMLDecodeError as error:
        raise RegistryError(f"could not parse {path}: {error}") from error

    defaults = raw.get("defaults", {})
    _known(defaults, {f.name for f in fields(Defaults)}, f"{path} [defaults]")

    agencies = []
    for entry in raw.get("agency", []):
        where = f"{path} agency {entry.get('id', '?')}"
        _known(entry, {"id", "name", "mode", "timezone", "realtime", "quirks"}, where)
        missing = [k for k in ("id", "name", "mode", "timezone") if k not in entry]
        if missing:
            raise RegistryError(f"{where}: missing {missing[0]!r}")
        quirks = entry.get("quirks", {})
        _known(quirks, {"trip_id_match", "stop_id_direction_suffix"}, f"{where} quirks")
        agencies.append(
            Agency(entry["id"], entry["name"], entry["mode"], entry["timezone"], **quirks)
        )
    return Registry(tuple(agencies), Defaults(**defaults))
