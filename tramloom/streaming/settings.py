"""Stream settings, checked when they are built."""

from __future__ import annotations

from dataclasses import dataclass, fields

from tramloom.errors import SettingsError
from tramloom.functions import delay as delays


@dataclass(frozen=True)
class Topics:
    # Topic names of the public deployment.
    stop_events: str = "transit.stop_events"
    alerts: str = "transit.alerts"
    ingest_health: str = "transit.ingest_health"

    def __post_init__(self) -> None:
        for field in fields(self):
            if not getattr(self, field.name).strip():
                raise SettingsError(f"topic {field.name} is blank")


@dataclass(frozen=True)
class StreamSettings:
    """Windows, thresholds and watermarks of the live queries."""

    topics: Topics = Topics()
    windows: tuple[str, ...] = ("5m", "1h", "24h")
    on_time_threshold_seconds: int = delays.ON_TIME_SECONDS
    anomaly_threshold_seconds: int = delays.ANOMALY_SECONDS
    anomaly_min_observations: int = delays.ANOMALY_OBSERVATIONS
    #: Events later than this are left out of windows; the raw facts keep them.
    watermark: str = "10 minutes"
    #: The same for windows of more than an hour.
    long_watermark: str = "1 hour"
    flush_every: str = "5 minutes"

    def __post_init__(self) -> None:
        if not self.windows:
            raise SettingsError("no windows")
        for name in ("on_time_threshold_seconds", "anomaly_threshold_seconds",
                     "anomaly_min_observations"):
            if getattr(self, name) <= 0:
                raise SettingsError(f"{name} must be positive")
        for name in ("watermark", "long_watermark", "flush_every"):
            if not getattr(self, name).strip():
                raise SettingsError(f"{name} is blank")
