"""Errors a caller can act on."""


class ConfigError(ValueError):
    """A step was configured wrongly; raised before any data is read."""


class DataError(RuntimeError):
    """The data does not fit what the configuration promised."""
