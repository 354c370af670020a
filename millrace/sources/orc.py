"""ORC files."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.config import require, section
from millrace.sources.lines import stream_reader
from millrace.storage import common_section, output_type, use_storage

STEP = "orc_source"


def orc_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(STEP, config, {"path": "", "output_type": "TABLE", "common": {}})
    require(STEP, cfg, "path")
    cfg["output_type"] = output_type(STEP, cfg)
    cfg["common"] = common_section(STEP, cfg["common"])
    return cfg


def read_orc(
    spark: SparkSession, config: Mapping[str, Any], streaming: bool = False, schema=None, max_files: int | None = None
) -> DataFrame:
    """ORC files → table. The files describe themselves; a codec setting is ignored.

    A streaming read takes the schema of the files that are there when none is given.
    """
    cfg = orc_config(config)
    path = use_storage(spark, cfg["path"], cfg["common"])
    if streaming:
        return stream_reader(spark, max_files).schema(schema or spark.read.orc(path).schema).orc(path)
    return (spark.read if schema is None else spark.read.schema(schema)).orc(path)
