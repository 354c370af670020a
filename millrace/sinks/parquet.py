"""Tables → Parquet files, plain or in a Hive directory layout."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.config import enum, non_negative, require, section
from millrace.errors import ConfigError, DataError
from millrace.operators.tables import partition_files, partition_guard
from millrace.storage import CODECS, common_section, parquet_codec, use_storage

STEP = "parquet_sink"
ENCODINGS = (
    "PLAIN", "PLAIN_DICTIONARY", "RLE", "BIT_PACKED", "DELTA_BINARY_PACKED",
    "DELTA_LENGTH_BYTE_ARRAY", "DELTA_BYTE_ARRAY", "RLE_DICTIONARY", "BYTE_STREAM_SPLIT",
)
VERSIONS = ("1_0", "2_6")
PAGE_VERSIONS = ("V1", "V2")
SIZE_LEVELS = ("NONE", "COLUMN_CHUNK", "PAGE_AND_COLUMN_CHUNK")
_DICTIONARY_ENCODINGS = ("PLAIN_DICTIONARY", "RLE_DICTIONARY")
_DELTA_ENCODINGS = ("DELTA_BINARY_PACKED", "DELTA_LENGTH_BYTE_ARRAY", "DELTA_BYTE_ARRAY")
DEFAULT_BASENAME = "part-{i}.parquet"


def parquet_sink_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(
        STEP, config, {"path": "", "row_group_size": None, "common": {}, "write_opts": None, "writer_properties": {}}
    )
    require(STEP, cfg, "path")
    cfg["common"] = common_section(STEP, cfg["common"])
    cfg["writer_properties"] = section(
        f"{STEP}.writer_properties",
        cfg["writer_properties"],
        {"dictionary_page_size_limit": None, "write_batch_size": None, "max_row_group_length": None,
         "data_page_size": None, "max_rows_per_page": None, "data_page_version": None, "version": None,
         "created_by": None, "store_decimal_as_integer": None, "page_checksum_enabled": None,
         "size_statistics_level": None, "dictionary_enabled": None, "statistics_enabled": None,
         "page_index_enabled": None, "encoding": None, "compression": None, "compression_level": None,
         "max_statistics_size": None, "sorting_columns": [], "column_properties": {},
         "content_defined_chunking_enabled": None, "content_defined_chunking_options": None},
    )
    if cfg["write_opts"] is not None:
        cfg["write_opts"] = opts = section(
            f"{STEP}.write_opts",
            cfg["write_opts"],
            {"basename_template": DEFAULT_BASENAME, "max_rows_per_file": 0, "max_rows_per_group": 0,
             "max_partitions": 0, "partition_columns": [], "rebalance": True},
        )
        non_negative(STEP, opts, "max_rows_per_file", "max_rows_per_group", "max_partitions")
        if not opts["partition_columns"]:
            raise ConfigError(f"{STEP}: write_opts.partition_columns is required")
        if "{i}" not in opts["basename_template"]:
            raise ConfigError(f"{STEP}: basename_template must contain {{i}}")
    return cfg


def parquet_options(cfg: Mapping[str, Any]) -> dict[str, str]:
    """Writer options of Spark's Parquet source for a checked configuration."""
    props = cfg["writer_properties"]
    out: dict[str, Any] = {}
    codec = props["compression"] and enum(STEP, props["compression"], "COMPRESSION_", CODECS)
    out["compression"] = parquet_codec(codec or cfg["common"]["compression"])
    if props["compression_level"] is not None:
        level_names = {"zstd": "parquet.compression.codec.zstd.level", "gzip": "zlib.compress.level"}
        if out["compression"] not in level_names:
            raise ConfigError(f"{STEP}: codec {out['compression']} has no level")
        level = props["compression_level"]
        if out["compression"] == "gzip":
            # Level names of the Hadoop zlib codec, levels 0 to 9.
            names = ("NO_COMPRESSION", "BEST_SPEED", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "BEST_COMPRESSION")
            if not 0 <= level < len(names):
                raise ConfigError(f"{STEP}: gzip levels are 0 to 9")
            level = names[level]
        out[level_names[out["compression"]]] = level
    for option, value in (
        ("parquet.enable.dictionary", props["dictionary_enabled"]),
        ("parquet.column.statistics.enabled", props["statistics_enabled"]),
        ("parquet.page.size", props["data_page_size"]),
        ("parquet.page.row.count.limit", props["max_rows_per_page"]),
        ("parquet.dictionary.page.size", props["dictionary_page_size_limit"]),
        ("parquet.page.write-checksum.enabled", props["page_checksum_enabled"]),
        ("parquet.statistics.truncate.length", props["max_statistics_size"]),
    ):
        if value is not None:
            out[option] = value
    if props["size_statistics_level"] is not None:
        level = enum(STEP, props["size_statistics_level"], "SIZE_STATISTICS_LEVEL_", SIZE_LEVELS)
        out["parquet.size.statistics.enabled"] = level != "NONE"
    versions = set()
    if props["data_page_version"] is not None:
        versions.add(enum(STEP, props["data_page_version"], "DATA_PAGE_VERSION_", PAGE_VERSIONS).lower())
    if props["version"] is not None:
        enum(STEP, props["version"], "PARQUET_VERSION_", VERSIONS)
    if props["encoding"] is not None:
        encoding = enum(STEP, props["encoding"], "ENCODING_", ENCODINGS)
        if encoding in _DICTIONARY_ENCODINGS:
            out["parquet.enable.dictionary"] = True
        elif encoding == "PLAIN":
            out["parquet.enable.dictionary"] = False
        elif encoding in _DELTA_ENCODINGS:
            out["parquet.enable.dictionary"] = False
            versions.add("v2")
        else:
            raise ConfigError(f"{STEP}: encoding {encoding.lower()} cannot be chosen in Spark's writer")
    if len(versions) > 1:
        raise ConfigError(f"{STEP}: delta encodings need data page version 2")
    if versions:
        out["parquet.writer.version"] = versions.pop()
    if props["page_index_enabled"] is False and props["statistics_enabled"] is not False:
        raise ConfigError(f"{STEP}: the page index is only left out together with the statistics")
    for name in ("created_by", "content_defined_chunking_options"):
        if props[name] is not None:
            raise ConfigError(f"{STEP}: {name} cannot be set in Spark's writer")
    if props["content_defined_chunking_enabled"]:
        raise ConfigError(f"{STEP}: content-defined chunking is not available in Spark's writer")
    if props["write_batch_size"] is not None:
        warnings.warn(f"{STEP}: write_batch_size has no effect", stacklevel=3)
    for column, values in props["column_properties"].items():
        col = section(
            f"{STEP}.column_properties.{column}",
            values,
            {"dictionary_enabled": None, "statistics_enabled": None, "page_index_enabled": None,
             "encoding": None, "compression": None, "compression_level": None},
        )
        if col["compression"] is not None or col["compression_level"] is not None:
            raise ConfigError(f"{STEP}: column {column}: the codec is the same for all columns in Spark's writer")
        if col["dictionary_enabled"] is not None:
            out[f"parquet.enable.dictionary#{column}"] = col["dictionary_enabled"]
        if col["statistics_enabled"] is not None:
            out[f"parquet.column.statistics.enabled#{column}"] = col["statistics_enabled"]
        if col["page_index_enabled"] is False and col["statistics_enabled"] is not False:
            raise ConfigError(f"{STEP}: column {column}: the page index is only left out together with the statistics")
        if col["encoding"] is not None:
            encoding = enum(STEP, col["encoding"], "ENCODING_", ENCODINGS)
            if encoding not in ("PLAIN", *_DICTIONARY_ENCODINGS):
                raise ConfigError(f"{STEP}: column {column}: encoding {encoding.lower()} cannot be chosen per column")
            out[f"parquet.enable.dictionary#{column}"] = encoding != "PLAIN"
    row_group = cfg["row_group_size"] or props["max_row_group_length"]
    if cfg["write_opts"] is not None and cfg["write_opts"]["max_rows_per_group"]:
        row_group = cfg["write_opts"]["max_rows_per_group"]
    if row_group and row_group > 0:
        out["parquet.block.row.count.limit"] = row_group
    return {name: str(value).lower() if isinstance(value, bool) else str(value) for name, value in out.items()}


def write_parquet(df: DataFrame, config: Mapping[str, Any]) -> None:
    """Write a table as Parquet.

    Without ``write_opts`` the files below ``path`` are replaced. With it, rows
    go to ``column=value/`` directories of a new or empty ``path``. A limit on
    the number of directories is checked before the write, in a pass of its own
    over the partition columns, and only where ``max_partitions`` sets one.
    ``rebalance: false`` leaves out the shuffle that brings the rows of one
    directory together: right for few directories and large input splits.
    """
    cfg = parquet_sink_config(config)
    spark = df.sparkSession
    path = use_storage(spark, cfg["path"], cfg["common"])
    options = parquet_options(cfg)
    legacy = cfg["writer_properties"]["store_decimal_as_integer"] is False
    opts = cfg["write_opts"]
    df = _no_void(df)
    if opts is not None:
        missing = [name for name in opts["partition_columns"] if name not in df.columns]
        if missing:
            raise ConfigError(f"{STEP}: missing partition column: {', '.join(missing)}")
        _require_empty(spark, path)
        if opts["max_partitions"]:
            partition_guard(df, opts["partition_columns"], opts["max_partitions"])
        if opts["rebalance"]:
            df = partition_files(df, opts["partition_columns"])
        basename = opts["basename_template"].split("{i}")[0].rstrip("-_.")
        if basename:
            options["mapreduce.output.basename"] = basename
        if opts["max_rows_per_file"]:
            options["maxRecordsPerFile"] = str(opts["max_rows_per_file"])
    order = _sort_order(df, cfg["writer_properties"]["sorting_columns"])
    if order:
        df = df.sortWithinPartitions(*[F.col(f"`{c}`") for c in (opts or {}).get("partition_columns", [])], *order)
    writer = df.write.mode("append" if opts is not None else "overwrite").options(**options)
    if opts is not None:
        writer = writer.partitionBy(*opts["partition_columns"])
    if legacy:
        spark.conf.set("spark.sql.parquet.writeLegacyFormat", "true")
    try:
        writer.parquet(path)
    finally:
        if legacy:
            spark.conf.unset("spark.sql.parquet.writeLegacyFormat")


def stream_parquet(rows: DataFrame, config: Mapping[str, Any], checkpoint: str) -> StreamingQuery:
    """Write a stream to ``column=value/`` directories, every row once, until it has taken what is there.

    Spark names the files of a stream and writes them as they come; what needs a look at all rows is refused. With a limit
    on the rows of a file, a micro-batch can be very many files, whatever the files it was read from; so its rows are
    dealt to as many tasks as there are cores.
    """
    cfg = parquet_sink_config(config)
    opts = cfg["write_opts"]
    refused = [name for name, given in (
        ("write_opts.max_partitions", opts["max_partitions"]), ("writer_properties.sorting_columns", cfg["writer_properties"]["sorting_columns"]),
        ("write_opts.basename_template", opts["basename_template"].split("{i}")[0].rstrip("-_.") not in ("", "part")),
        ("writer_properties.store_decimal_as_integer", cfg["writer_properties"]["store_decimal_as_integer"] is False),
    ) if given]
    if refused:
        raise ConfigError(f"{STEP}: not for a stream: {', '.join(refused)}")
    missing = [name for name in opts["partition_columns"] if name not in rows.columns]
    if missing:
        raise ConfigError(f"{STEP}: missing partition column: {', '.join(missing)}")
    options = parquet_options(cfg)
    if opts["max_rows_per_file"]:
        options["maxRecordsPerFile"] = str(opts["max_rows_per_file"])
        rows = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    path = use_storage(rows.sparkSession, cfg["path"], cfg["common"])
    writer = _no_void(rows).writeStream.format("parquet").options(**options).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).partitionBy(*opts["partition_columns"]).start(path)


def _sort_order(df: DataFrame, columns) -> list:
    order = []
    for value in columns:
        item = section(f"{STEP}.sorting_columns", value, {"column_index": 0, "descending": False, "nulls_first": False})
        if not 0 <= item["column_index"] < len(df.columns):
            raise ConfigError(f"{STEP}: no column {item['column_index']} to sort by")
        column = F.col(f"`{df.columns[item['column_index']]}`")
        if item["descending"]:
            order.append(column.desc_nulls_first() if item["nulls_first"] else column.desc_nulls_last())
        else:
            order.append(column.asc_nulls_first() if item["nulls_first"] else column.asc_nulls_last())
    return order


def _no_void(df: DataFrame) -> DataFrame:
    """Columns without a type hold only nulls; file formats store them as integers."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("int").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _require_empty(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if filesystem.exists(hadoop_path) and filesystem.listLocatedStatus(hadoop_path).hasNext():
        raise DataError(f"{path} is not empty")
