"""Tables → ORC files."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

from millrace.config import enum, require, section
from millrace.errors import ConfigError
from millrace.sinks.parquet import _no_void
from millrace.storage import CODECS, common_section, orc_codec, use_storage

STEP = "orc_sink"
STRATEGIES = ("SPEED", "COMPRESSION")


def orc_sink_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(STEP, config, {"path": "", "common": {}, "write_options": {}})
    require(STEP, cfg, "path")
    cfg["common"] = common_section(STEP, cfg["common"])
    cfg["write_options"] = opts = section(
        f"{STEP}.write_options",
        cfg["write_options"],
        {"batch_size": 0, "file_version": None, "stripe_size": 0, "compression": "UNCOMPRESSED",
         "compression_block_size": 0, "compression_strategy": "SPEED", "row_index_stride": 0,
         "padding_tolerance": 0.0, "dictionary_key_size_threshold": 0.0, "bloom_filter_columns": [], "bloom_filter_fpp": 0.0},
    )
    opts["compression"] = enum(STEP, opts["compression"], "COMPRESSION_", CODECS)
    opts["compression_strategy"] = enum(STEP, opts["compression_strategy"], "COMPRESSION_STRATEGY_", STRATEGIES)
    return cfg


def orc_options(cfg: Mapping[str, Any], columns: list[str]) -> dict[str, str]:
    """Writer options of Spark's ORC source. Zero means the default."""
    opts = cfg["write_options"]
    out = {
        "compression": orc_codec(opts["compression"]),
        "orc.compression.strategy": opts["compression_strategy"],
    }
    if opts["file_version"] is not None:
        version = section(f"{STEP}.file_version", opts["file_version"], {"major_version": 0, "minor_version": 12})
        text = f"{version['major_version']}.{version['minor_version']}"
        if text not in ("0.11", "0.12"):
            raise ConfigError(f"{STEP}: file version {text} is not 0.11 or 0.12")
        out["orc.write.format"] = text
    for option, value in (
        ("orc.stripe.size", opts["stripe_size"]),
        ("orc.compress.size", opts["compression_block_size"]),
        ("orc.row.index.stride", opts["row_index_stride"]),
        ("orc.block.padding.tolerance", opts["padding_tolerance"]),
        ("orc.dictionary.key.threshold", opts["dictionary_key_size_threshold"]),
        ("orc.bloom.filter.fpp", opts["bloom_filter_fpp"]),
    ):
        if value < 0:
            raise ConfigError(f"{STEP}: {option} must not be negative")
        if value > 0:
            out[option] = str(value)
    names = []
    for index in opts["bloom_filter_columns"]:
        if not 0 <= index < len(columns):
            raise ConfigError(f"{STEP}: no column {index} for a bloom filter")
        names.append(columns[index])
    if names:
        out["orc.bloom.filter.columns"] = ",".join(names)
    return out


def write_orc(df: DataFrame, config: Mapping[str, Any]) -> None:
    """Write a table as ORC, replacing the files below ``path``.

    The codec is the one in ``write_options`` (none by default).
    """
    cfg = orc_sink_config(config)
    spark = df.sparkSession
    path = use_storage(spark, cfg["path"], cfg["common"])
    batch = cfg["write_options"]["batch_size"]
    if batch > 0:
        spark.conf.set("spark.sql.orc.columnarWriterBatchSize", str(batch))
    try:
        _no_void(df).write.mode("overwrite").options(**orc_options(cfg, df.columns)).orc(path)
    finally:
        if batch > 0:
            spark.conf.unset("spark.sql.orc.columnarWriterBatchSize")
