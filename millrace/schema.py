"""Column specifications: 26 flat types, their Spark types and their checks.

A specification is ``{"type": ..., "time_unit": ..., "fixed_size_binary_length":
..., "decimal_precision": ..., "decimal_scale": ...}`` or just a type name.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import enum, section
from millrace.errors import ConfigError

# Names of the column types and of the time units.
KINDS = (
    "NULL", "BOOL", "INT8", "INT16", "INT32", "INT64", "UINT8", "UINT16", "UINT32", "UINT64",
    "FLOAT16", "FLOAT32", "FLOAT64", "STRING", "LARGE_STRING", "BINARY", "LARGE_BINARY",
    "DATE32", "DATE64", "TIMESTAMP", "TIME32", "TIME64", "DURATION",
    "DECIMAL128", "DECIMAL256", "FIXED_SIZE_BINARY",
)
UNITS = ("SECOND", "MILLI", "MICRO", "NANO")

_ALLOWED_UNITS = {
    "TIMESTAMP": UNITS,
    "DURATION": UNITS,
    "TIME32": ("SECOND", "MILLI"),
    "TIME64": ("MICRO", "NANO"),
}
_UNIT_ALIASES = {"S": "SECOND", "MS": "MILLI", "US": "MICRO", "NS": "NANO"}
_PLAIN = {
    "NULL": T.NullType(),
    "BOOL": T.BooleanType(),
    "INT8": T.ByteType(),
    "INT16": T.ShortType(),
    "INT32": T.IntegerType(),
    "INT64": T.LongType(),
    "UINT8": T.ShortType(),
    "UINT16": T.IntegerType(),
    "UINT32": T.LongType(),
    "UINT64": T.DecimalType(20, 0),
    "FLOAT16": T.FloatType(),
    "FLOAT32": T.FloatType(),
    "FLOAT64": T.DoubleType(),
    "STRING": T.StringType(),
    "LARGE_STRING": T.StringType(),
    "BINARY": T.BinaryType(),
    "LARGE_BINARY": T.BinaryType(),
    "DATE32": T.DateType(),
    "DATE64": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP_UTC": T.TimestampType(),  # inferred only: texts that carry a zone
    "DURATION": T.DayTimeIntervalType(),
    "FIXED_SIZE_BINARY": T.BinaryType(),
}
_UNSIGNED_BITS = {"UINT8": 8, "UINT16": 16, "UINT32": 32, "UINT64": 64}
_METADATA_KEY = "column_type"
_FLOAT16_MAX = 65504.0


@dataclass(frozen=True)
class ColumnSpec:
    kind: str
    unit: str | None = None
    length: int | None = None
    precision: int | None = None
    scale: int | None = None

    def to_dict(self) -> dict[str, Any]:
        values = {
            "type": f"DATA_TYPE_{self.kind}",
            "time_unit": f"TIME_UNIT_{self.unit}" if self.unit else None,
            "fixed_size_binary_length": self.length,
            "decimal_precision": self.precision,
            "decimal_scale": self.scale,
        }
        return {name: value for name, value in values.items() if value is not None}

    @property
    def is_text(self) -> bool:
        return self.kind in ("STRING", "LARGE_STRING", "BINARY", "LARGE_BINARY", "FIXED_SIZE_BINARY")


def column_spec(value: str | Mapping[str, Any] | ColumnSpec, name: str = "column") -> ColumnSpec:
    """Validate one column specification."""
    if isinstance(value, ColumnSpec):
        return value
    if isinstance(value, str):
        value = {"type": value}
    fields = section(
        name,
        value,
        {"type": "", "time_unit": "", "fixed_size_binary_length": None, "decimal_precision": None, "decimal_scale": None},
    )
    kind = enum(name, fields["type"], "DATA_TYPE_", KINDS)
    unit = fields["time_unit"].upper().removeprefix("TIME_UNIT_")
    unit = _UNIT_ALIASES.get(unit, unit)
    if kind in _ALLOWED_UNITS:
        if unit not in _ALLOWED_UNITS[kind]:
            allowed = ", ".join(u.lower() for u in _ALLOWED_UNITS[kind])
            raise ConfigError(f"{name}: {kind.lower()} needs a time_unit of {allowed}")
    else:
        unit = None
    length = precision = scale = None
    if kind == "FIXED_SIZE_BINARY":
        length = fields["fixed_size_binary_length"]
        if length is None or length <= 0:
            raise ConfigError(f"{name}: fixed_size_binary needs fixed_size_binary_length")
    if kind in ("DECIMAL128", "DECIMAL256"):
        precision, scale = fields["decimal_precision"], fields["decimal_scale"]
        if precision is None or scale is None:
            raise ConfigError(f"{name}: {kind.lower()} needs decimal_precision and decimal_scale")
        if not 1 <= precision <= (38 if kind == "DECIMAL128" else 76):
            raise ConfigError(f"{name}: precision {precision} is out of range for {kind.lower()}")
    return ColumnSpec(kind, unit, length, precision, scale)


def spark_type(spec: ColumnSpec, name: str = "column") -> T.DataType:
    """The Spark type that holds every value of the specification."""
    if spec.kind in ("DECIMAL128", "DECIMAL256"):
        if spec.precision > 38:
            raise ConfigError(f"{name}: Spark decimals have at most 38 digits, {spec.precision} asked")
        return T.DecimalType(spec.precision, spec.scale)
    if spec.kind in ("TIME32", "TIME64"):
        return T.TimeType({"SECOND": 0, "MILLI": 3}.get(spec.unit, 6))
    return _PLAIN[spec.kind]


def build_schema(columns: Mapping[str, Any]) -> T.StructType:
    """Column specifications → Spark schema. The specification is kept as field
    metadata, so that :func:`describe_schema` returns it unchanged."""
    fields = []
    for name, value in columns.items():
        spec = column_spec(value, name)
        fields.append(T.StructField(name, spark_type(spec, name), True, {_METADATA_KEY: spec.to_dict()}))
    return T.StructType(fields)


def field_spec(field: T.StructField) -> ColumnSpec:
    """One schema field → column specification; nested types are rejected."""
    stored = (field.metadata or {}).get(_METADATA_KEY)
    if stored:
        spec = column_spec(stored, field.name)
        if spark_type(spec, field.name) == field.dataType:
            return spec
    kind = field.dataType
    simple = {
        T.NullType: "NULL", T.BooleanType: "BOOL", T.ByteType: "INT8", T.ShortType: "INT16",
        T.IntegerType: "INT32", T.LongType: "INT64", T.FloatType: "FLOAT32", T.DoubleType: "FLOAT64",
        T.StringType: "STRING", T.BinaryType: "BINARY", T.DateType: "DATE32",
    }
    if type(kind) in simple:
        return ColumnSpec(simple[type(kind)])
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return ColumnSpec("TIMESTAMP", "MICRO")
    if isinstance(kind, T.TimeType):
        return ColumnSpec("TIME64", "MICRO")
    if isinstance(kind, T.DayTimeIntervalType):
        return ColumnSpec("DURATION", "MICRO")
    if isinstance(kind, T.DecimalType):
        return ColumnSpec("DECIMAL128", precision=kind.precision, scale=kind.scale)
    raise ConfigError(f"column {field.name}: {kind.simpleString()} has no flat column type")


def describe_schema(schema: T.StructType) -> dict[str, dict[str, Any]]:
    """Spark schema → column specifications, in column order."""
    return {field.name: field_spec(field).to_dict() for field in schema.fields}


def describe(df: DataFrame) -> DataFrame:
    """The column specifications of ``df`` as rows."""
    rows = [
        (position, field.name, spec.kind.lower(), spec.unit and spec.unit.lower(), spec.length, spec.precision, spec.scale)
        for position, field in enumerate(df.schema.fields)
        for spec in [field_spec(field)]
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "position int, column_name string, type string, time_unit string, "
        "fixed_size_binary_length int, decimal_precision int, decimal_scale int",
    )


def fits(column: Column, spec: ColumnSpec) -> Column:
    """Predicate: the value is null or lies in the range of the specification."""
    if spec.kind in _UNSIGNED_BITS:
        limit = F.lit(2 ** _UNSIGNED_BITS[spec.kind] - 1) if spec.kind != "UINT64" else F.lit("18446744073709551615").cast("decimal(20,0)")
        return column.isNull() | column.between(F.lit(0), limit)
    if spec.kind == "FLOAT16":
        return column.isNull() | F.isnan(column) | (F.abs(column) <= _FLOAT16_MAX) | (F.abs(column) == float("inf"))
    if spec.kind == "FIXED_SIZE_BINARY":
        return column.isNull() | (F.octet_length(column) == spec.length)
    return F.lit(True)


def checked(column: Column, spec: ColumnSpec, name: str) -> Column:
    """The value itself, or an error naming the column when it does not fit."""
    if spec.kind not in _UNSIGNED_BITS and spec.kind not in ("FLOAT16", "FIXED_SIZE_BINARY"):
        return column
    message = F.lit(f"column {name}: value out of range for {spec.kind.lower()}")
    return F.when(fits(column, spec), column).otherwise(F.raise_error(message))


def apply_schema(df: DataFrame, columns: Mapping[str, Any]) -> DataFrame:
    """Cast and check the named columns of ``df``; other columns are kept.

    The session's ANSI casts turn a value that cannot be converted into an error.
    """
    specs = {name: column_spec(value, name) for name, value in columns.items()}
    missing = [name for name in specs if name not in df.columns]
    if missing:
        raise ConfigError(f"no such column: {', '.join(missing)}")
    enable_time_type(df.sparkSession, specs.values())
    selected = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        if name in specs:
            spec = specs[name]
            value = checked(column.cast(spark_type(spec, name)), spec, name)
            column = value.alias(name, metadata={_METADATA_KEY: spec.to_dict()})
        selected.append(column)
    return df.select(*selected)


def enable_time_type(spark: SparkSession, specs) -> None:
    """TIME columns are behind a setting in Spark 4.1; switch it on when used."""
    if any(spec.kind in ("TIME32", "TIME64") for spec in specs):
        spark.conf.set("spark.sql.timeType.enabled", "true")
