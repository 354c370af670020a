"""Ingest, transform and export of data at scale, as PySpark DataFrames."""

from millrace.errors import ConfigError, DataError
from millrace.session import prepare

__all__ = ["ConfigError", "DataError", "prepare"]
