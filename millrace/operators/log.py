"""Operators on message logs: rows with a stream name and an ordered id."""

from __future__ import annotations

from itertools import count as counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.errors import ConfigError
from millrace.workdir import checkpointed

# Up to this many entries, top-k operators give the same rows for less: they keep at most this many per task and group.
TOP_LIMIT = 1_000
# A hot stream's candidates are first reduced in this many groups.
SALTS = 32


def entry_id(text: str | Column) -> Column:
    """``"<milliseconds>-<number>"`` → struct that sorts like the log does."""
    column = F.col(text) if isinstance(text, str) else text
    parts = F.split(column, "-")
    number = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("0"))
    return F.struct(
        F.element_at(parts, 1).cast("bigint").alias("ms"), number.cast("decimal(20,0)").alias("seq")
    )


def log_read(df: DataFrame, after, count: int | None = None, id_column: str | Column = "id") -> DataFrame:
    """Entries with an id above ``after``, the first ``count`` of them by id, then by their other columns."""
    entry = F.col(id_column) if isinstance(id_column, str) else id_column
    rest = df.where(entry > after)
    if count is None or count <= 0:
        return rest
    order = [entry.asc_nulls_last(), *_ties(df)]
    if count <= TOP_LIMIT:
        return rest.orderBy(*order).limit(count)
    return _first(rest, F.lit(0), order, count, exact=True)


def log_trim(
    df: DataFrame, maxlen: int, approximate: bool = False, stream_column: str = "stream", id_column: str | Column = "id"
) -> DataFrame:
    """The newest ``maxlen`` entries of every stream.

    Ids may have any type that sorts; null ids are the oldest, and equal ids are told apart by the other columns.
    ``approximate`` may keep some more, and ranks nothing.
    """
    if maxlen <= 0:
        return df
    stream = F.col(stream_column)
    entry = F.col(id_column) if isinstance(id_column, str) else id_column
    order = [entry.desc_nulls_last(), *_ties(df)]
    if maxlen <= TOP_LIMIT:
        salt, rank = _unused(df, "salt", "rank")
        salted = df.withColumn(salt, F.pmod(F.xxhash64(*_named(df), F.monotonically_increasing_id()), F.lit(SALTS)))
        for keys in ([stream, F.col(salt)], [stream]):
            newest = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
            salted = salted.withColumn(rank, newest).where(F.col(rank) <= maxlen)
        return salted.drop(salt, rank)
    return _first(df, stream, order, maxlen, exact=not approximate)


def trim_stream(
    entries: DataFrame, path: str, checkpoint: str, maxlen: int, stream_column: str = "stream", id_column: str | Column = "id"
) -> StreamingQuery:
    """Keep the newest ``maxlen`` entries of every stream below ``path`` while a streaming table brings more.

    Each micro-batch is trimmed together with what the last one left, so that the state is no larger than its result; a
    version is written per batch, and a batch that is run again starts from the same version and writes the same one.
    The result after any number of batches and restarts is that of :func:`log_trim` over all entries so far.
    """
    if maxlen <= 0:
        raise ConfigError("maxlen must be positive")
    schema = entries.schema

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        versions = sorted(n for n in _versions(spark, path) if n < number)
        if versions:
            rows = spark.read.schema(schema).parquet(_version(path, versions[-1])).unionAll(batch)
        log_trim(rows, maxlen, False, stream_column, id_column).write.mode("overwrite").parquet(_version(path, number))
        for old in versions[:-1]:  # the last one stays, for this batch run again
            folder = spark._jvm.org.apache.hadoop.fs.Path(_version(path, old))
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    writer = entries.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(write).start()


def trimmed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What :func:`trim_stream` has kept so far."""
    versions = _versions(spark, path)
    return spark.read.schema(schema).parquet(_version(path, max(versions))) if versions else spark.createDataFrame([], schema)


def _version(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/batch-{number:012d}"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Batches that were written to their end; there are two at most, and one that was not finished."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = filesystem.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch-*/_SUCCESS")) or []
    return [int(item.getPath().getParent().getName().removeprefix("batch-")) for item in done]


def _unused(df: DataFrame, *wishes: str) -> list[str]:
    """Column names that the table does not have."""
    taken = {name.lower() for name in df.columns}
    return [next(name for k in counter() if (name := f"_{wish}{k or ''}") not in taken) for wish in wishes]


def _named(df: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in df.columns]


def _ties(df: DataFrame) -> list[Column]:
    """All columns that sort: entries equal in them are the same entry for every purpose here."""
    return [F.col(f"`{f.name}`").asc_nulls_last() for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _first(df: DataFrame, key: Column, order: list[Column], count: int, exact: bool) -> DataFrame:
    """The first ``count`` rows of each key.

    Rows are dealt by ranges of key and order, so that a hot key is cut at its order values, and a place in the input
    parts even equal rows. Ranges are counted; all before the cutoff stay whole, and only the range that holds it is
    ranked: one range per key.
    """
    columns = _named(df)
    of_key, place, part = _unused(df, "key", "place", "range")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumns({of_key: key, place: F.monotonically_increasing_id()})
    dealt = checkpointed(rows.repartitionByRange(ranges, F.col(of_key), *order, F.col(place)).withColumn(part, F.spark_partition_id()))
    of, within, need, cut, rank = _unused(df, "of", "in", "need", "cut", "rank")
    counts = dealt.groupBy(F.col(of_key).alias(of), F.col(part).alias(within)).agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(W.partitionBy(of).orderBy(within))  # one row per range
    needed = counts.withColumn("upto", upto).where(F.col("upto") - F.col("rows") < count)
    left = F.lit(count) - F.col("upto") + F.col("rows")
    needed = checkpointed(needed.select(of, within, left.alias(need), (F.col("upto") > count).alias(cut)))
    match = F.col(of_key).eqNullSafe(F.col(of)) & (F.col(part) == F.col(within))
    whole = dealt.join(needed.where(~F.col(cut)) if exact else needed, match, "left_semi").select(*columns)
    if not exact:
        return whole
    place_in = F.row_number().over(W.partitionBy(of_key, part).orderBy(*order))
    last = dealt.join(needed.where(cut), match).withColumn(rank, place_in).where(F.col(rank) <= F.col(need))
    return whole.unionAll(last.select(*columns))


def queue_group(df: DataFrame, members: int, member: int, id_column: str = "id", hashed: bool = True) -> DataFrame:
    """The share of one member of a consumer group: each message has one member."""
    if members <= 0 or not 0 <= member < members:
        raise ConfigError(f"member {member} is not one of {members}")
    value = F.xxhash64(id_column) if hashed else F.col(id_column)
    return df.where(F.pmod(value, F.lit(members)) == member)


def channel_messages(
    df: DataFrame, channel: str, kind: str = "kind", channel_column: str = "channel", body: str = "payload", keys: tuple[str, ...] = ()
) -> DataFrame:
    """Landed channel replies → bodies of the messages on one channel."""
    if not channel:
        raise ConfigError("channel_messages requires channel")
    wanted = (F.col(kind) == "message") & (F.col(channel_column) == channel) & F.col(body).isNotNull()
    return df.where(wanted).select(*keys, F.col(body).alias("payload"))
