"""Operators on whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.errors import ConfigError, DataError


def strict_concat(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of tables that have the same columns, in the same order and of the same types."""
    if not tables:
        raise ConfigError("nothing to concatenate")
    shape = [(f.name, f.dataType) for f in tables[0].schema.fields]
    for position, table in enumerate(tables):
        if [(f.name, f.dataType) for f in table.schema.fields] != shape:
            raise DataError(f"schema of table {position} was different: {table.schema.simpleString()}")
    return reduce(DataFrame.unionAll, tables)


def partition_guard(df: DataFrame, columns: Sequence[str], max_partitions: int) -> DataFrame:
    """``df`` itself, or an error when the columns have too many different values."""
    if df.select(*columns).distinct().limit(max_partitions + 1).count() > max_partitions:
        raise DataError(f"more than {max_partitions} partitions by {', '.join(columns)}")
    return df


def partition_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per partition value."""
    return df.groupBy(*columns).agg(F.count("*").alias("num_rows"))


def partition_files(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    A rebalance, not a plain repartition: adaptive execution cuts a value that
    holds much of the data into several tasks and joins small ones.
    """
    return df.hint("rebalance", *columns)
