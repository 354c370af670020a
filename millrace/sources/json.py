"""Typed JSON reading."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import enum, require, section
from millrace.errors import ConfigError, DataError
from millrace.functions.convert import TextRules, convert, infer_specs, require_ansi
from millrace.schema import ColumnSpec, checked, column_spec, enable_time_type, spark_type
from millrace.sources.lines import decoded_lines, decoded_objects, native_codec, text_lines
from millrace.sources.ranges import Lines, Objects, Opener, file_records
from millrace.storage import arrow_reads, arrow_store, common_section, output_type, use_storage

STEP = "json_source"
UNEXPECTED = ("INFER_TYPE", "IGNORE", "ERROR")

# How the value of each explicit type is written in JSON.
_NUMBERS = {"INT8", "INT16", "INT32", "INT64", "UINT8", "UINT16", "UINT32", "UINT64", "FLOAT32", "FLOAT64"}
_TEXTS = {"STRING", "LARGE_STRING", "BINARY", "LARGE_BINARY", "TIMESTAMP"}
_COUNTS = {"DATE32", "DATE64", "TIME32", "TIME64"}  # days, or units since midnight
_NUMBERS_OR_TEXTS = {"DECIMAL128", "DECIMAL256"}
_SPACE = re.compile(r"\s*")
_LEFT_OVER = re.compile(r"\}\s*$")
_PLAIN_TEXT = TextRules(null_values=())


def json_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(STEP, config, {"path": "", "output_type": "TABLE", "read_options": {}, "parse_options": {}, "common": {}})
    require(STEP, cfg, "path")
    cfg["output_type"] = output_type(STEP, cfg)
    cfg["common"] = common_section(STEP, cfg["common"])
    cfg["read_options"] = section(f"{STEP}.read_options", cfg["read_options"], {"use_threads": True, "block_size": None})
    cfg["parse_options"] = parse = section(
        f"{STEP}.parse_options",
        cfg["parse_options"],
        {"explicit_schema": {}, "newlines_in_values": False, "unexpected_field_behavior": "INFER_TYPE"},
    )
    parse["explicit_schema"] = {name: column_spec(value, name) for name, value in parse["explicit_schema"].items()}
    for name, spec in parse["explicit_schema"].items():
        _read_type(spec, name)
    parse["unexpected_field_behavior"] = enum(
        STEP, parse["unexpected_field_behavior"], "UNEXPECTED_FIELD_BEHAVIOR_", UNEXPECTED
    )
    return cfg


def read_json(
    spark: SparkSession, config: Mapping[str, Any], streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """JSON objects, one per line or pretty-printed one after the other → typed table.

    Columns: the explicit schema in its order, then (behaviour "infer") the
    other fields by name.
    """
    cfg = json_config(config)
    parse = cfg["parse_options"]
    path = use_storage(spark, cfg["path"], cfg["common"])
    explicit, behavior = parse["explicit_schema"], parse["unexpected_field_behavior"]
    codec = cfg["common"]["compression"]
    if streaming and (not explicit or behavior == "INFER_TYPE" or parse["newlines_in_values"]):
        raise ConfigError("a streaming JSON read takes an explicit schema, one object per line, and ignore or error")
    if streaming and codec in ("AUTO", "UNCOMPRESSED"):
        objects = text_lines(spark, path, streaming=True, max_files=max_files)
    elif streaming:
        objects = decoded_lines(spark, path, codec, streaming=True, max_files=max_files)
    elif (native := native_codec(spark, STEP, path, codec)) and not parse["newlines_in_values"]:
        objects = text_lines(spark, path)
    elif arrow_reads(path):
        opener = Opener("AUTO" if native else codec, arrow_store(cfg["path"], cfg["common"]))
        scanner = Objects() if parse["newlines_in_values"] else Lines()
        objects, _ = file_records(spark, path, scanner, opener, range_bytes=cfg["read_options"]["block_size"])
    elif native:
        objects = concatenated_objects(spark, path)
    else:
        objects = (decoded_objects if parse["newlines_in_values"] else decoded_lines)(spark, path, codec)
    objects = objects.where(F.length(F.trim("value")) > 0)
    return parse_objects(objects, explicit, behavior)


def parse_objects(objects: DataFrame, explicit: Mapping[str, ColumnSpec], behavior: str = "INFER_TYPE") -> DataFrame:
    """Column ``value`` of JSON objects → typed table."""
    spark = objects.sparkSession
    require_ansi(spark)
    enable_time_type(spark, explicit.values())
    inferred: dict[str, T.DataType] = {}
    stamps: dict[str, ColumnSpec] = {}
    if behavior == "INFER_TYPE":
        inferred, stamps = _infer(objects, set(explicit))
    read_types = {name: _read_type(spec, name) for name, spec in explicit.items()}
    fields = [T.StructField(name, kind) for name, kind in {**read_types, **inferred}.items()]
    if not fields:
        raise ConfigError(f"{STEP}: no columns; give an explicit schema or let the types be inferred")
    value = F.col("value")
    if behavior == "ERROR":
        value = only_known_fields(value, list(explicit))
    row = F.from_json(value, T.StructType(fields), {"mode": "FAILFAST"})
    table = objects.select(row.alias("row"))
    columns = []
    for name in [*explicit, *inferred]:
        column = F.col("row").getField(name)
        if name in explicit:
            column = _typed(column, explicit[name], name)
        elif name in stamps:
            column = convert(column, stamps[name], TextRules(null_values=("",)), name)
        columns.append(column.alias(name))
    return table.select(*columns)


def _read_type(spec: ColumnSpec, name: str) -> T.DataType:
    if spec.kind in _NUMBERS or spec.kind == "BOOL":
        return spark_type(spec, name)
    if spec.kind in _TEXTS or spec.kind == "NULL":
        return T.VariantType()  # keeps texts and numbers apart
    if spec.kind in _COUNTS:
        return T.LongType()
    if spec.kind in _NUMBERS_OR_TEXTS:
        return T.StringType()
    raise ConfigError(f"column {name}: JSON has no {spec.kind.lower()} values")


def _typed(value: Column, spec: ColumnSpec, name: str) -> Column:
    """The value in its column type; a JSON value of another kind is an error."""
    if spec.kind in _TEXTS or spec.kind == "NULL":
        kind = F.schema_of_variant(value)
        refused = F.raise_error(F.concat(F.lit(f"column {name}: not a {spec.kind.lower()} value but "), kind))
        if spec.kind == "NULL":
            return F.when(value.isNotNull() & (kind != "VOID"), refused)
        text = F.variant_get(value, "$", "string")
        text = F.when(value.isNull() | kind.isin("VOID", "STRING"), text).otherwise(refused.cast("string"))
        return convert(text, spec, _PLAIN_TEXT, name)
    if spec.kind == "DATE32":
        return F.date_from_unix_date(value.cast("int"))
    if spec.kind == "DATE64":
        return F.date_from_unix_date(F.floor(value / 86_400_000).cast("int"))
    if spec.kind in _COUNTS:
        per_second = {"SECOND": 1, "MILLI": 1_000, "MICRO": 1_000_000, "NANO": 1_000_000_000}[spec.unit]
        seconds = (value.cast("decimal(20,0)") / F.lit(per_second)).cast("decimal(18,6)")
        return (F.expr("time'00:00:00'") + F.make_dt_interval(secs=seconds)).cast(spark_type(spec, name))
    if spec.kind in _NUMBERS_OR_TEXTS:
        return convert(value, spec, _PLAIN_TEXT, name)
    return checked(value, spec, name)


def unexpected_fields(value: Column, known: list[str]) -> Column:
    """Names of an object's fields that are not known."""
    return F.array_except(F.json_object_keys(value), F.array(*map(F.lit, known)).cast("array<string>"))


def only_known_fields(value: Column, known: list[str]) -> Column:
    """The object itself, or an error that names its unknown fields."""
    extra = unexpected_fields(value, known)
    message = F.concat(F.lit("unexpected field(s): "), F.array_join(extra, ", "))
    return F.when(F.size(extra) > 0, F.raise_error(message).cast("string")).otherwise(value)


def _infer(objects: DataFrame, known: set[str]) -> tuple[dict[str, T.DataType], dict[str, ColumnSpec]]:
    """Types of all fields over all objects, in one aggregation.

    A field with values of different kinds is an error. Top-level texts that all
    look like dates or times of day become timestamps.
    """
    merged = objects.select(F.schema_of_variant_agg(F.parse_json("value")).alias("schema")).first().schema
    if merged in (None, "VOID"):
        return {}, {}
    if not merged.startswith("OBJECT<"):
        raise DataError(f"JSON lines must be objects, found {merged}")
    fields = T.StructType.fromDDL(_ddl(merged)).fields
    types = {f.name: _storable(f.dataType, f.name) for f in fields if f.name not in known}
    texts = [name for name, kind in types.items() if isinstance(kind, T.StringType)]
    stamps = {}
    if texts:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in texts])
        profile = objects.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")
        for name, spec in infer_specs(profile, texts, TextRules(null_values=("",))).items():
            if spec.kind == "DATE32" or (spec.kind in ("TIMESTAMP", "TIMESTAMP_UTC") and spec.unit == "SECOND"):
                stamps[name] = ColumnSpec("TIMESTAMP", "SECOND")
    return types, stamps


def _ddl(merged: str) -> str:
    """``OBJECT<a: BIGINT>`` → ``a: BIGINT``; nested objects are structs."""
    return merged[len("OBJECT<"):-1].replace("OBJECT<>", "STRUCT<>").replace("OBJECT<", "STRUCT<")


def _storable(kind: T.DataType, name: str) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _storable(f.dataType, f"{name}.{f.name}")) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_storable(kind.elementType, name))
    if isinstance(kind, T.VariantType):
        raise DataError(f"field {name} holds values of different kinds")
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    if isinstance(kind, T.NullType):
        return T.StringType()
    return kind


# ------------------------------------------------- objects over several lines
def concatenated_objects(spark: SparkSession, path: str) -> DataFrame:
    """Pretty-printed objects, one after the other → one row per object, in stores that only Spark opens.

    A line end cannot be part of a JSON text, so ``}``, line end, ``{`` only
    occurs between objects. Hadoop's line reader splits large files there, and
    what other white space separates is taken apart row by row.
    """
    end = _line_end(spark, path)
    cut = text_lines(spark, path, line_sep="}" + end + "{").select(F.trim("value").alias("value"))
    text = F.when(F.col("value").startswith("{"), F.col("value")).otherwise(F.concat(F.lit("{"), "value"))
    text = F.concat(text, F.lit("}"))  # the file's last object has one too many, which is cut off below
    several = text.rlike(r"\}\s*\{|\}\s*\}\s*$")
    pieces = F.when(several, _whole_objects(F.when(several, text))).otherwise(F.array(text))
    return cut.where(F.length("value") > 0).select(F.explode(pieces).alias("value"))


def _line_end(spark: SparkSession, path: str) -> str:
    """Line end of the first file, from its first line."""
    first = spark.read.option("lineSep", "\n").text(path).limit(1).collect()
    return "\r\n" if first and first[0].value.endswith("\r") else "\n"


@F.pandas_udf(T.ArrayType(T.StringType()))
def _whole_objects(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: None if text is None else list(split_objects(text)))


def split_objects(text: str) -> Iterator[str]:
    """Top-level objects of a text; a closing brace left over at its end is dropped."""
    decoder = json.JSONDecoder()
    end = _LEFT_OVER.search(text)
    position = _SPACE.match(text).end()
    while position < len(text) and not (end and position >= end.start()):
        _, stop = decoder.raw_decode(text, position)
        yield text[position:stop]
        position = _SPACE.match(text, stop).end()
