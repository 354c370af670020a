"""Dictionary codes for text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.errors import ConfigError
from millrace.workdir import checkpointed

# A dictionary is collected and broadcast only below both of these bounds.
BROADCAST_VALUES = 100_000
BROADCAST_BYTES = 64 << 20


def dictionary(df: DataFrame, column: str, max_cardinality: int) -> DataFrame | None:
    """Table ``(code, value)`` of the distinct values in value order, or None
    when there are more than ``max_cardinality`` of them."""
    values = df.select(F.col(f"`{column}`").alias("value")).where("value IS NOT NULL").distinct()
    if max_cardinality >= BROADCAST_VALUES:
        values = checkpointed(values)
        return None if values.count() > max_cardinality else _sorted_codes(values)
    values = checkpointed(values.limit(max_cardinality + 1))
    size = values.agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes")).first()
    if size.n > max_cardinality:
        return None
    if (size.bytes or 0) > BROADCAST_BYTES:
        return _sorted_codes(values)
    found = sorted(row.value for row in values.collect())
    return F.broadcast(df.sparkSession.createDataFrame(list(enumerate(found)), "code int, value string"))


def dictionary_encode(df: DataFrame, column: str, max_cardinality: int = 50, code_column: str | None = None) -> DataFrame:
    """Add the dictionary code of a text column as ``<column>_code``.

    Above ``max_cardinality`` distinct values the codes are null.
    """
    codes = dictionary(df, column, max_cardinality)
    name = code_column or f"{column}_code"
    if name.lower() in (other.lower() for other in df.columns):
        raise ConfigError(f"the table has a column {name} already; name the codes' column")
    if codes is None:
        return df.withColumn(name, F.lit(None).cast("int"))
    codes = codes.select(F.col("code").alias(name), F.col("value").alias(f"{name}_value"))
    joined = df.join(codes, F.col(f"`{column}`") == F.col(f"`{name}_value`"), "left")
    return joined.drop(f"{name}_value")


class StoredDictionary:
    """A dictionary that grows with the micro-batches of a stream.

    Values get codes from 0 without gaps, in the order of the batches they first come in and by value within a batch, and
    keep them for good. Each batch writes its new values as one version below ``path``; a batch that is run again writes
    the same version again. Whatever the data, the schema is the same: a value that comes after ``max_cardinality`` others
    has a null code.
    """

    SCHEMA = "code int, value string"

    def __init__(self, spark: SparkSession, path: str, max_cardinality: int = (1 << 31) - 1):
        self.spark, self.path, self.max_cardinality = spark, path.rstrip("/"), max_cardinality

    def values(self, before: int | None = None) -> DataFrame:
        """(code, value) of all versions, or of those before a batch."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
            return self.spark.createDataFrame([], self.SCHEMA)
        found = self.spark.read.schema(f"{self.SCHEMA}, version bigint").parquet(self.path)
        return (found if before is None else found.where(F.col("version") < before)).select("code", "value")

    def encode(self, batch: DataFrame, column: str, number: int, code_column: str | None = None) -> DataFrame:
        """A micro-batch with the codes of a text column; its new values are stored first."""
        name = code_column or f"{column}_code"
        if name.lower() in (other.lower() for other in batch.columns):
            raise ConfigError(f"the table has a column {name} already; name the codes' column")
        known = self.values(number)
        count = known.count()
        values = batch.select(F.col(f"`{column}`").alias("value")).where("value IS NOT NULL").distinct()
        fresh = _sorted_codes(values.join(known.select("value"), "value", "left_anti"))
        fresh = fresh.select((F.col("code") + count).alias("code"), "value").where(F.col("code") < self.max_cardinality)
        fresh.write.mode("overwrite").parquet(f"{self.path}/version={number}")
        codes = self.values(number + 1).select(F.col("code").alias(name), F.col("value").alias(f"{name}_value"))
        joined = batch.join(codes, F.col(f"`{column}`") == F.col(f"`{name}_value`"), "left")
        return joined.drop(f"{name}_value")


def _sorted_codes(values: DataFrame) -> DataFrame:
    """Row numbers of a large distinct column without gathering it: sort over
    all tasks, number inside each partition, add the sizes of earlier ones."""
    part = checkpointed(values.orderBy("value").select("value", F.spark_partition_id().alias("part")))
    inside = part.withColumn("position", F.row_number().over(W.partitionBy("part").orderBy("value")))
    sizes = part.groupBy("part").agg(F.count("*").alias("n"))  # one row per sort partition
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = inside.join(F.broadcast(offsets), "part")
    return numbered.select((F.col("offset") + F.col("position") - 1).cast("int").alias("code"), "value")
