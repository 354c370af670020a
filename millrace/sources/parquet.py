"""Parquet files and directories."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema

from millrace.config import non_negative, require, section
from millrace.errors import DataError
from millrace.sources.lines import stream_reader
from millrace.storage import arrow_filesystem, common_section, output_type, use_storage

STEP = "parquet_source"


def parquet_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(STEP, config, {"path": "", "output_type": "TABLE", "batch_size": None, "common": {}})
    require(STEP, cfg, "path")
    cfg["output_type"] = output_type(STEP, cfg)
    non_negative(STEP, cfg, "batch_size")
    cfg["common"] = common_section(STEP, cfg["common"])
    return cfg


def read_parquet(
    spark: SparkSession,
    config: Mapping[str, Any],
    streaming: bool = False,
    schema=None,
    strict: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """One file, or every ``*.parquet`` file below a directory, as one table.

    Directory names add no columns. The files must have the same schema, which
    is checked on their footers, one task per group of files; ``strict=False``
    leaves the check out where all files are known to come from one writer. A
    streaming read takes the schema of the files that are there when none is given.
    """
    cfg = parquet_config(config)
    path = use_storage(spark, cfg["path"], cfg["common"])
    if _is_file(spark, path):
        options = {"pathGlobFilter": "*"}  # one file may have any name
    else:
        options = {} if path.endswith(".parquet") else {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}
    if streaming:
        schema = schema or spark.read.options(**options).parquet(path).schema
        return stream_reader(spark, max_files).schema(schema).options(**options).parquet(path)
    if strict:
        stored = _common_schema(spark, path, options)
        if any(_needs_arrow(field.type) for field in stored):
            return _read_by_arrow(spark, path, options, stored)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.options(**options).parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return filesystem.exists(hadoop_path) and filesystem.getFileStatus(hadoop_path).isFile()


def _files(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    # A path named x.parquet may itself be a folder of part files.
    return spark.read.format("binaryFile").options(**{"pathGlobFilter": "*.parquet", **options}).load(path).select("path")


def _common_schema(spark: SparkSession, path: str, options: Mapping[str, str]) -> pa.Schema:
    """The one schema in the footers of all files."""
    tasks = min(max(spark.sparkContext.defaultParallelism, 1), 1024)
    found = (
        _files(spark, path, options)
        .repartition(tasks)
        .mapInArrow(footer_schemas, "path string, schema binary")
        .groupBy("schema")
        .agg(F.min("path").alias("path"))
        .limit(2)
        .collect()
    )
    if not found:
        raise DataError(f"no .parquet file below {path}")
    if len(found) > 1:
        raise DataError(f"schemas differ: {found[0].path} and {found[1].path}")
    return pa.ipc.read_schema(pa.BufferReader(found[0].schema))


def footer_schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        schemas = []
        for path in paths:
            filesystem, name = arrow_filesystem(path)
            with filesystem.open_input_file(name) as file:
                schema = pq.read_schema(file)
            plain = pa.schema([pa.field(f.name, f.type, True) for f in schema])
            schemas.append(plain.serialize().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(schemas, pa.binary())], ["path", "schema"])


# ------------------------------------------------ types Spark's reader refuses
_UNSIGNED = {"uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(), "uint64": T.DecimalType(20, 0)}


def _needs_arrow(kind: pa.DataType) -> bool:
    return pa.types.is_float16(kind) or pa.types.is_time(kind) or (pa.types.is_timestamp(kind) and kind.unit == "ns")


def _read_by_arrow(spark: SparkSession, path: str, options: Mapping[str, str], stored: pa.Schema) -> DataFrame:
    """Files with half floats, times of day or nanosecond timestamps: one row per
    row group is spread over the tasks, which read and convert those groups."""
    spark.conf.set("spark.sql.timeType.enabled", "true")
    fields = []
    for field in stored:
        if pa.types.is_float16(field.type):
            kind: T.DataType = T.FloatType()
        elif str(field.type) in _UNSIGNED:
            kind = _UNSIGNED[str(field.type)]
        elif pa.types.is_time(field.type):
            kind = T.TimeType(6)
        elif pa.types.is_timestamp(field.type):
            kind = T.TimestampNTZType() if field.type.tz is None else T.TimestampType()
        else:
            kind = from_arrow_type(field.type, prefer_timestamp_ntz=True)
        fields.append(T.StructField(field.name, kind))
    struct = T.StructType(fields)
    target = to_arrow_schema(struct)
    groups = _files(spark, path, options).mapInArrow(row_groups, "path string, number int")
    spread = groups.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                filesystem, name = arrow_filesystem(path)
                with filesystem.open_input_file(name) as file:
                    for part in pq.ParquetFile(file).iter_batches(10_000, row_groups=[number]):
                        columns = [part.column(f.name).cast(f.type, safe=False) for f in target]
                        yield pa.RecordBatch.from_arrays(columns, schema=target)

    return spread.mapInArrow(read, struct)


def row_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, numbers = [], []
        for path in batch.column(0).to_pylist():
            filesystem, name = arrow_filesystem(path)
            with filesystem.open_input_file(name) as file:
                count = pq.read_metadata(file).num_row_groups
            paths += [path] * count
            numbers += range(count)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(numbers, pa.int32())], ["path", "number"])
