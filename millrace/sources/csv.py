"""Typed CSV reading."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import non_negative, one_char, require, section
from millrace.errors import ConfigError
from millrace.functions.convert import FALSE_TOKENS, NULL_TOKENS, TRUE_TOKENS, TextRules, convert, infer_specs, require_ansi
from millrace.operators.dictionary import dictionary_encode
from millrace.schema import ColumnSpec, column_spec, enable_time_type
from millrace.sources.lines import decoded_lines, first_line, native_codec, stream_reader, text_lines, without_leading
from millrace.sources.ranges import Head, Lines, Opener, QuotedLines, file_records
from millrace.storage import arrow_reads, arrow_store, common_section, output_type, use_storage

STEP = "csv_source"

# Fields are handled as Latin-1 text, one character per byte, so that these two
# marks cannot be part of the data. A quoted empty field is read as the first
# (an unquoted one is read as null); the second is put in front of every quoted
# field where quoted and bare fields must be told apart.
_QUOTED_EMPTY = "\ue000"
_QUOTED = "\ue001"
_WRONG = "_wrong"  # the column of a line that does not have the fields it should


def csv_config(config: Mapping[str, Any]) -> dict[str, Any]:
    """Check a CSV source configuration and fill in its defaults."""
    cfg = section(
        STEP,
        config,
        {"path": "", "output_type": "TABLE", "read_options": {}, "parse_options": {}, "convert_options": {}, "common": {}},
    )
    require(STEP, cfg, "path")
    cfg["output_type"] = output_type(STEP, cfg)
    cfg["common"] = common_section(STEP, cfg["common"])
    cfg["read_options"] = read = section(
        f"{STEP}.read_options",
        cfg["read_options"],
        {"use_threads": True, "block_size": None, "skip_rows": 0, "skip_rows_after_names": 0,
         "column_names": [], "autogenerate_column_names": False},
    )
    non_negative(STEP, read, "skip_rows", "skip_rows_after_names", "block_size")
    cfg["parse_options"] = parse = section(
        f"{STEP}.parse_options",
        cfg["parse_options"],
        {"delimiter": ",", "quoting": True, "quote_char": '"', "double_quote": True, "escaping": False,
         "escape_char": "\\", "newlines_in_values": False, "ignore_empty_lines": True},
    )
    parse["delimiter"] = one_char(STEP, "delimiter", parse["delimiter"], ",")
    parse["quote_char"] = one_char(STEP, "quote_char", parse["quote_char"], '"')
    parse["escape_char"] = one_char(STEP, "escape_char", parse["escape_char"], "\\")
    cfg["convert_options"] = conv = section(
        f"{STEP}.convert_options",
        cfg["convert_options"],
        {"check_utf8": True, "column_types": {}, "null_values": [], "true_values": [], "false_values": [],
         "strings_can_be_null": False, "quoted_strings_can_be_null": True, "auto_dict_encode": False,
         "auto_dict_max_cardinality": 50, "decimal_point": ".", "include_columns": [], "include_missing_columns": False},
    )
    conv["column_types"] = {name: column_spec(value, name) for name, value in conv["column_types"].items()}
    conv["decimal_point"] = one_char(STEP, "decimal_point", conv["decimal_point"], ".")
    return cfg


def read_csv(
    spark: SparkSession, config: Mapping[str, Any], streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """CSV files → typed table.

    Every field is first read as text by Spark's own CSV parser, whole rows
    only (a ragged row is an error), and then converted by column expressions.
    A streaming read needs ``column_types`` for every column.
    """
    cfg = csv_config(config)
    require_ansi(spark)
    read, parse, conv = cfg["read_options"], cfg["parse_options"], cfg["convert_options"]
    path = use_storage(spark, cfg["path"], cfg["common"])
    rules = TextRules(
        tuple(conv["null_values"]) or NULL_TOKENS,
        tuple(conv["true_values"]) or TRUE_TOKENS,
        tuple(conv["false_values"]) or FALSE_TOKENS,
        conv["strings_can_be_null"],
        conv["quoted_strings_can_be_null"],
        conv["decimal_point"],
    )
    # Where an empty field spells null, null fields need not be made empty first.
    bare_rules = replace(rules, null_values=(*rules.null_values, _QUOTED_EMPTY))
    types = conv["column_types"]
    codec = cfg["common"]["compression"]
    native = codec in ("AUTO", "UNCOMPRESSED") if streaming else native_codec(spark, STEP, path, codec)
    tell_quoted = parse["quoting"] and not rules.quoted_strings_can_be_null
    by_lines = (
        not native or tell_quoted or read["skip_rows"] or read["skip_rows_after_names"] or not parse["ignore_empty_lines"]
        or (parse["newlines_in_values"] and not streaming and arrow_reads(path))
    )
    if streaming:
        if (by_lines and native) or not types:
            raise ConfigError("a streaming CSV read takes column_types and none of the per-file line options")
        if native:
            raw, names = _scan(stream_reader(spark, max_files), path, read, parse, list(types))
        else:
            raw, names = _parse_lines(spark, path, cfg, False, tell_quoted, list(types), max_files)
    elif by_lines:
        raw, names = _parse_lines(spark, path, cfg, native, tell_quoted)
    else:
        raw, names = _scan(spark.read, path, read, parse, None)
    texts, quoted = [], []
    for position in range(len(names)):
        field = F.col(f"c{position}")
        if tell_quoted:
            quoted.append(F.coalesce(field.startswith(_QUOTED), F.lit(False)))
            bare = F.coalesce(field, F.lit(""))
            texts.append(F.when(quoted[position], F.expr(f"substring(c{position}, 2)")).otherwise(bare))
        else:
            texts.append(F.when(field.isNull() | (field == _QUOTED_EMPTY), "").otherwise(field))
    wanted = _chosen(names, conv["include_columns"], conv["include_missing_columns"])

    untyped = [position for name, position in wanted if position is not None and name not in types]
    if untyped and streaming:
        raise ConfigError("a streaming CSV read needs column_types for every column")
    inferred: dict[int, ColumnSpec] = {}
    if untyped:
        profile = raw.select(
            *[texts[p].alias(f"t{p}") for p in untyped], *[quoted[p].alias(f"q{p}") for p in untyped if quoted]
        )
        flags = {f"t{p}": f"q{p}" for p in untyped} if quoted else None
        found = infer_specs(profile, [f"t{p}" for p in untyped], rules, conv["check_utf8"], flags)
        inferred = dict(zip(untyped, found.values()))
    enable_time_type(spark, [*types.values(), *inferred.values()])

    columns, encoded = [], []
    for name, position in wanted:
        if position is None:
            column = convert(F.lit(None).cast("string"), types[name], rules, name) if name in types else F.lit(None)
        else:
            spec = types.get(name) or inferred[position]
            text, column_rules = texts[position], rules
            if not spec.is_text and not tell_quoted and "" in rules.null_values:
                text, column_rules = F.col(f"c{position}"), bare_rules
            if spec.is_text:
                check = conv["check_utf8"] and name in types and spec.kind in ("STRING", "LARGE_STRING")
                text = _utf8(text, check)
            column = convert(text, spec, column_rules, name, quoted[position] if quoted else None)
            if inferred.get(position) == ColumnSpec("STRING"):
                encoded.append(name)
        columns.append(column.alias(name))
    table = raw.select(*columns)
    if conv["auto_dict_encode"]:
        for name in encoded:
            table = dictionary_encode(table, name, conv["auto_dict_max_cardinality"])
    return table


def _chosen(names: list[str], include: list[str], include_missing: bool) -> list[tuple[str, int | None]]:
    """Names and positions of the columns to read; the position of a missing one is None."""
    if not include:
        return [(name, position) for position, name in enumerate(names)]
    for name in include:
        if names.count(name) > 1:
            raise ConfigError(f"{STEP}: the file has several columns called {name}")
        if name not in names and not include_missing:
            raise ConfigError(f"{STEP}: no such column in the file: {name}")
    return [(name, names.index(name) if name in names else None) for name in include]


def _scan(reader, path, read, parse, stream_names):
    """Spark's CSV scan, split into blocks, every field as text.

    Bytes are read one to one as Latin-1, so that text columns can be checked
    for valid UTF-8 afterwards.
    """
    generated = bool(read["column_names"]) or read["autogenerate_column_names"]
    reader = reader.options(
        **_dialect(parse),
        header=str(not generated).lower(),
        encoding="ISO-8859-1",
        columnPruning="false",
    )
    checked = stream_names is not None
    if stream_names is not None:
        names = list(read["column_names"]) or stream_names
    else:
        found = reader.csv(path).columns
        if not generated and any(name == f"_c{i}" or name.endswith(str(i)) for i, name in enumerate(found)):
            # Spark renames empty and repeated names; look at the header itself.
            first = reader.option("header", "false").csv(path).first()
            found = ["" if name in (None, _QUOTED_EMPTY) else name for name in first]
            reader.option("header", "true")
        found = [name.encode("latin-1").decode("utf-8").removeprefix("\ufeff") for name in found]
        checked = len({name.lower() for name in found}) == len(found) and "" not in found
        names = list(read["column_names"])
        if not names:
            names = [f"f{i}" for i in range(len(found))] if generated else found
        elif len(names) != len(found):
            raise ConfigError(f"{STEP}: {len(names)} column names for {len(found)} columns")
    stored = names if checked and not generated else [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"`{name.encode('utf-8').decode('latin-1').replace('`', '``')}` string" for name in stored)
    # The header of every file is compared with the names where they are plain names.
    reader = reader.option("enforceSchema", str(not (checked and not generated)).lower())
    table = reader.schema(schema).csv(path).toDF(*[f"c{i}" for i in range(len(names))])
    return table, names


def _parse_lines(spark, path, cfg, native, tell_quoted, streamed=None, max_files=None):
    """Line by line: for per-file skips, kept empty lines, told-apart quotes, line ends
    in quotes and codecs the file name does not tell. ``streamed`` names the columns of a stream."""
    read, parse = cfg["read_options"], cfg["parse_options"]
    generated = bool(read["column_names"]) or read["autogenerate_column_names"]
    names = list(read["column_names"] or streamed or [])
    numbered = False
    if streamed is None and arrow_reads(path):
        # Line ends in quotes need the lines before a range to be summed up, which numbers them as well.
        numbered = parse["newlines_in_values"] and parse["quoting"]
        data, first = _file_lines(spark, path, cfg, native, numbered)
    else:
        data, first = _spark_lines(spark, path, cfg, native, streamed, max_files)
    if not names:
        found = _split_fields(spark, first(), parse)
        names = [f"f{i}" for i in range(len(found))] if generated else found
    if parse["ignore_empty_lines"]:
        data = data.where(F.length("value") > 0)
    return _fields(data, parse, len(names), tell_quoted, numbered), names


def _file_lines(spark, path, cfg, native, numbered):
    """Lines of files that tasks open themselves, by byte range, and what gives the line of names."""
    read, parse = cfg["read_options"], cfg["parse_options"]
    generated = bool(read["column_names"]) or read["autogenerate_column_names"]
    codec = cfg["common"]["compression"]
    head = Head(read["skip_rows"], not generated, read["skip_rows_after_names"], parse["ignore_empty_lines"])
    quoted = parse["newlines_in_values"] and parse["quoting"]
    opener = Opener("AUTO" if native else codec, arrow_store(cfg["path"], cfg["common"]))
    if native and not quoted and not head and not numbered:
        data = text_lines(spark, path)
        return data, lambda: first_line(data, parse["ignore_empty_lines"])
    scanner = Lines()
    if quoted:
        escape = parse["escape_char"] if parse["escaping"] else None
        scanner = QuotedLines(parse["delimiter"], parse["quote_char"], parse["double_quote"], escape)
    data, files = file_records(spark, path, scanner, opener, head, numbered, read["block_size"])

    def first() -> str:
        if generated:
            return first_line(data, parse["ignore_empty_lines"])
        found = [row.names.removeprefix("\ufeff") for row in files.select("names").where("names IS NOT NULL").distinct().limit(2).collect()]
        if len(found) != 1:
            raise ConfigError(f"{STEP}: the files differ in their lines of names: {found}" if found else f"{STEP}: no header line found")
        return found[0]

    return data, first


def _spark_lines(spark, path, cfg, native, streamed, max_files):
    """The same for streams, and for stores that only Spark opens."""
    read, parse = cfg["read_options"], cfg["parse_options"]
    skip, after = read["skip_rows"], read["skip_rows_after_names"]
    generated = bool(read["column_names"]) or read["autogenerate_column_names"]
    ignore_empty = parse["ignore_empty_lines"]
    if native and not parse["newlines_in_values"]:
        lines = text_lines(spark, path)
        data = without_leading(lines, skip, not generated, after, ignore_empty) if skip or after or not generated else lines

        def first() -> str:
            one = lines.select(F.col("_metadata.file_path").alias("path")).first()
            start = (F.col("_metadata.file_path") == (one.path if one else "")) & (F.col("_metadata.file_block_start") == 0)
            return first_line(without_leading(lines.where(start), skip, False, 0, ignore_empty), ignore_empty)

    else:
        codec = cfg["common"]["compression"]
        quote = parse["quote_char"] if parse["newlines_in_values"] and parse["quoting"] else None
        escape = parse["escape_char"] if parse["escaping"] else None
        data = decoded_lines(spark, path, codec, quote, escape, skip, not generated, after, ignore_empty, streamed is not None, max_files)

        def first() -> str:
            return first_line(decoded_lines(spark, path, codec, quote, escape, skip), ignore_empty)

    return data, first


def _fields(data, parse, count, tell_quoted, numbered):
    """Lines → one text column for each field."""
    fields = ", ".join(f"c{i} string" for i in range(count))
    value = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    if tell_quoted:
        value = _mark_quoted(value, parse)
    dialect = _dialect(parse) | {"multiLine": "true"}
    if numbered:
        # A line with other fields is reported with its place.
        row = F.from_csv(value, f"{fields}, {_WRONG} string", dialect | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _WRONG})
    else:
        row = F.from_csv(value, fields, dialect)
    if not parse["ignore_empty_lines"]:
        blank = F.struct(*[F.lit("").alias(f"c{i}") for i in range(count)], *[F.lit(None).cast("string").alias(_WRONG)] * numbered)
        row = F.when(F.length("value") == 0, blank).otherwise(row)
    if not numbered:
        return data.select(row.alias("row")).select("row.*")
    place = F.concat(F.lit("malformed CSV record at "), F.col("path"), F.lit(":"), F.col("line"), F.lit(": "), F.left("value", F.lit(200)))
    whole = F.when(F.col("row").getField(_WRONG).isNotNull(), F.raise_error(place).cast("string"))
    rows = data.select(row.alias("row"), "path", "line", "value")
    return rows.select(*[F.coalesce(whole, F.col("row").getField(f"c{i}")).alias(f"c{i}") for i in range(count)])


def malformed_rows(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """(path, line, record, value): the records that :func:`read_csv` would refuse for the number of their fields.

    Lines and records are counted from 1 in each file, skipped ones and the line of names with them.
    """
    cfg = csv_config(config)
    read, parse = cfg["read_options"], cfg["parse_options"]
    path = use_storage(spark, cfg["path"], cfg["common"])
    if not arrow_reads(path):
        raise ConfigError(f"{STEP}: lines are numbered in stores that tasks open themselves only")
    data, first = _file_lines(spark, path, cfg, native_codec(spark, STEP, path, cfg["common"]["compression"]), True)
    names = list(read["column_names"]) or _split_fields(spark, first(), parse)
    data = data.where(F.length("value") > 0)
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    value = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    settings = _dialect(parse) | {"multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _WRONG}
    row = F.from_csv(value, f"{fields}, {_WRONG} string", settings)
    return data.select("path", "line", "record", "value", row.getField(_WRONG).alias(_WRONG)).where(f"{_WRONG} IS NOT NULL").drop(_WRONG)


def _split_fields(spark: SparkSession, line: str, parse: Mapping[str, Any]) -> list[str]:
    sample = spark.createDataFrame([(line,)], "value string")
    schema = sample.select(F.schema_of_csv(F.lit(line), _dialect(parse))).first()[0]
    count = schema.count(":")
    fields = ", ".join(f"c{i} string" for i in range(count))
    row = sample.select(F.from_csv("value", fields, _dialect(parse) | {"multiLine": "true"}).alias("row")).first().row
    return ["" if value in (None, _QUOTED_EMPTY) else value for value in row]


def _dialect(parse: Mapping[str, Any]) -> dict[str, str]:
    quote = parse["quote_char"] if parse["quoting"] else ""
    if parse["escaping"]:
        escape = parse["escape_char"]
    else:
        escape = quote if parse["quoting"] and parse["double_quote"] else "\u0000"
    return {
        "sep": parse["delimiter"],
        "quote": quote,
        "escape": escape,
        "mode": "FAILFAST",
        "multiLine": str(parse["newlines_in_values"]).lower(),
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "emptyValue": _QUOTED_EMPTY,
        "maxCharsPerColumn": "-1",
        "maxColumns": "100000",
    }


def _utf8(text: Column, check: bool) -> Column:
    """Latin-1 text → the text its bytes spell. ASCII, which is the same in both,
    has as many bytes as characters and is left alone."""
    other = F.encode(text, "ISO-8859-1").cast("string")
    if check:
        other = F.validate_utf8(other)
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(other)


def _mark_quoted(line: Column, parse: Mapping[str, Any]) -> Column:
    """Put a mark in front of every quoted field of a line."""
    quote = "\\" + parse["quote_char"]
    inner = f"[^{quote}]"
    if parse["escaping"]:
        escape = "\\" + parse["escape_char"]
        inner = f"[^{quote}{escape}]|{escape}."
    if parse["double_quote"]:
        inner += f"|{quote}{quote}"
    pattern = f"{quote}((?:{inner})*+){quote}"
    return F.regexp_replace(line, pattern, f"{quote}{_QUOTED}$1{quote}")
