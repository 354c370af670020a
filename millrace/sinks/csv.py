"""Tables → CSV files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import enum, one_char, require, section
from millrace.errors import ConfigError
from millrace.sinks.files import save_payloads
from millrace.storage import arrow_store, common_section, resolve_codec, stream_codec, use_storage

STEP = "csv_sink"
QUOTING = ("NEEDED", "ALL_VALID", "NONE")
_TEXT_CODECS = {"UNCOMPRESSED": "none", "GZIP": "gzip", "BZ2": "bzip2"}


def csv_sink_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(STEP, config, {"path": "", "append": False, "write_options": {}, "common": {}})
    require(STEP, cfg, "path")
    cfg["common"] = common_section(STEP, cfg["common"])
    cfg["write_options"] = opts = section(
        f"{STEP}.write_options",
        cfg["write_options"],
        {"include_header": True, "batch_size": None, "delimiter": ",", "null_string": "", "eol": "\n",
         "quoting_style": "NEEDED", "quoting_header": "NEEDED"},
    )
    opts["delimiter"] = one_char(STEP, "delimiter", opts["delimiter"], ",")
    opts["eol"] = opts["eol"] or "\n"
    for name in ("quoting_style", "quoting_header"):
        opts[name] = enum(STEP, opts[name], "QUOTING_STYLE_", QUOTING)
    if '"' in opts["null_string"]:
        raise ConfigError(f"{STEP}: null_string must not contain quotes")
    return cfg


def csv_lines(df: DataFrame, write_options: Mapping[str, Any] | None = None) -> DataFrame:
    """One formatted CSV line per row (column ``line``)."""
    opts = csv_sink_config({"path": "-", "write_options": dict(write_options or {})})["write_options"]
    return df.select(_line(df, opts).alias("line"))


def write_csv(df: DataFrame, config: Mapping[str, Any]) -> None:
    """Write CSV part files below ``path``, each with its own header line.

    Lines are built by column expressions and written by Spark's text writer;
    codecs it does not have go through the payload writer. A table without rows
    gives one file with the header.
    """
    cfg = csv_sink_config(config)
    opts = cfg["write_options"]
    path = use_storage(df.sparkSession, cfg["path"], cfg["common"])
    codec = resolve_codec(path, cfg["common"]["compression"])
    header = csv_header(df.columns, opts)
    line = _line(df, opts)
    if opts["include_header"]:
        # The low bits of the row id count the rows of a task, and a task writes one file.
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        line = F.when(first, F.concat(F.lit(header + opts["eol"]), line)).otherwise(line)
    rows = Observation()
    lines = df.select(line.alias("value")).observe(rows, F.count(F.lit(1)).alias("n"))
    store = arrow_store(cfg["path"], cfg["common"])
    _write_lines(lines, path, codec, opts["eol"], cfg["append"], store)
    if opts["include_header"] and rows.get["n"] == 0:
        _write_lines(df.sparkSession.createDataFrame([(header,)], "value string"), path, codec, opts["eol"], cfg["append"], store)


def _write_lines(lines: DataFrame, path: str, codec: str, eol: str, append: bool, store: dict | None = None) -> None:
    if codec in _TEXT_CODECS:
        lines.write.mode("append" if append else "overwrite").options(
            lineSep=eol, compression=_TEXT_CODECS[codec], maxRecordsPerFile="0"
        ).text(path)
        return
    name = stream_codec(STEP, codec)
    end = eol.encode()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text = b"".join(v.as_buffer().to_pybytes() + end for v in batch.column(0))
                yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([text], pa.binary())], ["path", "payload"])

    if not append:
        lines.sparkSession.createDataFrame([], "value string").write.mode("overwrite").text(path)
    payloads = lines.mapInArrow(join, "path string, payload binary")
    suffix = {"zstd": ".csv.zst", "lz4": ".csv.lz4", "brotli": ".csv.br"}[name]
    save_payloads(payloads, path, "PARTS", name, suffix=suffix, store=store)


def csv_header(columns: list[str], opts: Mapping[str, Any]) -> str:
    if opts["quoting_header"] != "NONE":
        return opts["delimiter"].join('"' + name.replace('"', '""') + '"' for name in columns)
    for name in columns:
        if any(mark in name for mark in ('"', opts["delimiter"], "\r", "\n")):
            raise ConfigError(f"{STEP}: column name {name!r} needs quotes")
    return opts["delimiter"].join(columns)


def _line(df: DataFrame, opts: Mapping[str, Any]) -> Column:
    fields = [_field(f, opts) for f in df.schema.fields]
    separated = fields[:1]
    for field in fields[1:]:
        separated += [F.lit(opts["delimiter"]), field]
    return F.concat(*separated)


def _field(field: T.StructField, opts: Mapping[str, Any]) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise ConfigError(f"{STEP}: column {field.name} is nested")
    is_text = isinstance(field.dataType, (T.StringType, T.BinaryType))
    text = column.cast("string")
    style = opts["quoting_style"]
    if style == "NONE":
        if is_text:
            structural = F.length(F.translate(text, '"' + opts["delimiter"] + "\r\n", "")) != F.length(text)
            message = F.concat(F.lit(f"column {field.name}: value needs quotes: "), text)
            text = F.when(structural, F.raise_error(message).cast("string")).otherwise(text)
    elif is_text:
        text = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    elif style == "ALL_VALID":
        text = F.concat(F.lit('"'), text, F.lit('"'))
    return F.coalesce(text, F.lit(opts["null_string"]))
