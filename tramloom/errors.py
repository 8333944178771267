"""Errors raised on the driver before a job is worth starting."""


class TransitError(Exception):
    """Base of every error this package raises itself."""


class RegistryError(TransitError):
    """The agency registry is missing, malformed or names something unusable."""


class FeedError(TransitError):
    """A timetable feed lacks a file, a column or a service definition."""


class WindowError(TransitError):
    """The requested service dates make no usable window."""


class DatasetError(TransitError):
    """The Parquet dataset is missing, empty or disagrees with the registry."""


class IntegrityError(TransitError):
    """A feed has dangling or duplicate keys and was not built."""


class HolidayCoverageError(TransitError):
    """The data runs in a year nobody entered holidays for."""


class SettingsError(TransitError):
    """A stream setting is missing or out of range."""
