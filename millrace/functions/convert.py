"""Text → typed values, as Column expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import ConfigError
from millrace.schema import ColumnSpec, checked, spark_type

# Spellings of null, true and false that are recognised by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)
TRUE_TOKENS = ("1", "True", "TRUE", "true")
FALSE_TOKENS = ("0", "False", "FALSE", "false")


@dataclass(frozen=True)
class TextRules:
    null_values: tuple[str, ...] = NULL_TOKENS
    true_values: tuple[str, ...] = TRUE_TOKENS
    false_values: tuple[str, ...] = FALSE_TOKENS
    strings_can_be_null: bool = False
    quoted_strings_can_be_null: bool = True
    decimal_point: str = "."


def require_ansi(spark: SparkSession) -> None:
    """Without ANSI casts a text that does not fit its type would become null."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ConfigError("typed reads need spark.sql.ansi.enabled=true")


def null_token(text: Column, rules: TextRules, quoted: Column | None = None) -> Column:
    """Predicate: the text spells null."""
    is_null = text.isin(*rules.null_values)
    if quoted is not None and not rules.quoted_strings_can_be_null:
        is_null = is_null & ~quoted
    return is_null


def boolean(text: Column, rules: TextRules, name: str) -> Column:
    """True and false spellings → boolean; anything else is an error."""
    token = F.trim(text)
    return (
        F.when(token.isin(*rules.true_values), True)
        .when(token.isin(*rules.false_values), False)
        .otherwise(F.raise_error(F.concat(F.lit(f"column {name}: not a boolean: "), text)).cast("boolean"))
    )


def decimal_point(text: Column, point: str) -> Column:
    """Texts with another decimal point → texts with a dot. A dot in the input
    changes places with it, so that it is refused as before."""
    if point == ".":
        return text
    return F.translate(text, f"{point}.", f".{point}")


def convert(text: Column, spec: ColumnSpec, rules: TextRules, name: str, quoted: Column | None = None) -> Column:
    """Typed value of a text; texts that do not fit the type are an error (ANSI casts)."""
    target = spark_type(spec, name)
    if spec.kind in ("STRING", "LARGE_STRING"):
        value = text
    elif spec.is_text:
        value = text.cast("binary")
    elif spec.kind == "NULL":
        value = F.raise_error(F.concat(F.lit(f"column {name}: not a null spelling: "), text)).cast(target)
    elif spec.kind == "BOOL":
        value = boolean(text, rules, name)
    elif spec.kind == "DURATION":
        per_second = {"SECOND": 1, "MILLI": 1_000, "MICRO": 1_000_000, "NANO": 1_000_000_000}[spec.unit]
        seconds = (text.cast("decimal(28,0)") / F.lit(per_second)).cast("decimal(18,6)")
        value = F.make_dt_interval(secs=seconds)
    elif spec.kind in ("FLOAT16", "FLOAT32", "FLOAT64", "DECIMAL128", "DECIMAL256"):
        value = decimal_point(text, rules.decimal_point).cast(target)
    elif spec.kind in ("TIME32", "TIME64"):
        value = F.trim(text).cast(target)
    else:
        value = text.cast(target)  # casts to numbers and dates trim by themselves
    value = checked(value, spec, name)
    if spec.is_text and not rules.strings_can_be_null:
        return value
    return F.when(~null_token(text, rules, quoted), value)


# ---------------------------------------------------------------- inference
# One bit per candidate type, in the order in which candidates are preferred.
_CANDIDATES: tuple[ColumnSpec, ...] = (
    ColumnSpec("INT64"),
    ColumnSpec("BOOL"),
    ColumnSpec("DATE32"),
    ColumnSpec("TIME32", "SECOND"),
    ColumnSpec("TIMESTAMP", "SECOND"),
    ColumnSpec("TIMESTAMP_UTC", "SECOND"),
    ColumnSpec("TIMESTAMP", "NANO"),
    ColumnSpec("TIMESTAMP_UTC", "NANO"),
    ColumnSpec("FLOAT64"),
)
_INT, _BOOL, _DATE, _TIME, _TS, _TSZ, _TS_FRACTION, _TSZ_FRACTION, _DOUBLE = (1 << i for i in range(len(_CANDIDATES)))
_DAY = r"\d{4}-\d{2}-\d{2}"
_CLOCK = r"[ T]\d{2}(:\d{2}(:\d{2})?)?"
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)"


def type_mask(text: Column, trimmed: Column, rules: TextRules) -> Column:
    """Bit set of the candidate types one text can be read as.

    Cheap tests on single characters come first and patterns next. A failing
    ``try_cast`` raises inside the JVM and is slow, so casts come last.
    """
    is_bool = trimmed.isin(*rules.true_values, *rules.false_values)
    bool_bit = F.when(is_bool, F.lit(_BOOL)).otherwise(F.lit(0))
    first = F.ascii(trimmed)
    like_number = first.between(ord("+"), ord("9")) | first.isin(*map(ord, "iInN" + rules.decimal_point))
    point = "\\" + rules.decimal_point
    number = trimmed.rlike(rf"^[+-]?([0-9]+{point}?[0-9]*|{point}[0-9]+)([eE][+-]?[0-9]+)?$")
    special = F.lower(trimmed).isin(*[sign + word for sign in ("", "+", "-") for word in ("inf", "infinity", "nan")])
    fits_int = (F.length(trimmed) <= 18) | trimmed.try_cast("bigint").isNotNull()
    dashed = (F.substring(text, 5, 1) == "-") & (F.length(text) >= 10)
    stamp = text.rlike(rf"^{_DAY}{_CLOCK}(\.\d{{1,9}})?{_ZONE}?$")
    zone = F.substring(text, 11, 99).rlike(rf"{_ZONE}$")
    fraction = F.instr(text, ".") > 0
    local = F.substring(text, 1, 19).try_cast("timestamp_ntz").isNotNull()
    zoned = text.try_cast("timestamp").isNotNull()
    return (
        F.when(dashed & (F.length(text) == 10) & text.rlike(rf"^{_DAY}$") & text.try_cast("date").isNotNull(), _DATE | _TS | _TS_FRACTION)
        .when(
            dashed & stamp,
            F.when(zone, F.when(~zoned, 0).when(fraction, _TSZ_FRACTION).otherwise(_TSZ | _TSZ_FRACTION))
            .when(~local, 0).when(fraction, _TS_FRACTION).otherwise(_TS | _TS_FRACTION),
        )
        .when(
            like_number & trimmed.rlike("^-?[0-9]+$"),
            F.when(fits_int, F.lit(_INT | _DOUBLE)).otherwise(F.lit(_DOUBLE)).bitwiseOR(bool_bit),
        )
        .when((F.substring(text, 3, 1) == ":") & text.rlike(r"^([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?$"), _TIME)
        .when(like_number & (number | special), F.lit(_DOUBLE).bitwiseOR(bool_bit))
        .otherwise(bool_bit)
    )


def infer_specs(
    df: DataFrame,
    columns: Sequence[str],
    rules: TextRules,
    latin_bytes: bool = False,
    quoted: Mapping[str, str] | None = None,
) -> dict[str, ColumnSpec]:
    """Types of text columns, from every row: the first candidate all values fit.

    One aggregation over one pass; each task sends one row of bit sets. With
    ``latin_bytes`` the texts hold one character per byte, and a column whose
    bytes are not all valid UTF-8 is binary. ``quoted`` names, per column, the
    boolean column that tells which fields were quoted.
    """
    if not columns:
        return {}
    # One row per field keeps the generated code short enough to be compiled well,
    # however many columns there are.
    fields = [
        F.struct(F.col(f"`{name}`").alias("text"), (F.col(quoted[name]) if quoted else F.lit(False)).alias("quoted"))
        for name in columns
    ]
    single = df.select(F.posexplode(F.array(*fields)).alias("position", "field")).select("position", "field.*")
    single = single.select("*", F.trim("text").alias("trimmed"))
    seen = F.col("text").isNotNull() & ~null_token(F.col("text"), rules, F.col("quoted"))
    masked = single.select("position", "text", F.when(seen, type_mask(F.col("text"), F.col("trimmed"), rules)).alias("mask"))
    valid = F.lit(True)
    if latin_bytes:
        is_utf8 = F.is_valid_utf8(F.encode("text", "ISO-8859-1").cast("string"))
        valid = F.when(F.col("mask") == 0, is_utf8).otherwise(True)
    found = masked.groupBy("position").agg(F.bit_and("mask").alias("mask"), F.bool_and(valid).alias("valid")).collect()
    by_position = {row.position: row for row in found}  # one row per column
    return {
        name: _pick(by_position[i].mask, by_position[i].valid) if i in by_position else ColumnSpec("NULL")
        for i, name in enumerate(columns)
    }


def _pick(mask: int | None, is_text: bool) -> ColumnSpec:
    if mask is None:
        return ColumnSpec("NULL")
    for position, spec in enumerate(_CANDIDATES):
        if mask & (1 << position):
            return spec
    return ColumnSpec("STRING" if is_text else "BINARY")
