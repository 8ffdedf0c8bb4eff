"""Exceptions that replace the process exit codes of a batch job."""


class BatchError(Exception):
    """Base class of every error raised by this package."""


class DataError(BatchError, ValueError):
    """The data or a parameter breaks a stated contract."""


class SchemaError(DataError):
    """Required columns are missing."""


class EmptyResultError(DataError):
    """A result that must hold rows is empty."""


class MissingResultError(DataError):
    """No result was committed at a path."""


class ReconcileError(BatchError, RuntimeError):
    """What was read back differs from what was written."""


class ConfigError(BatchError, RuntimeError):
    """The session lacks a setting the job depends on."""
