from __future__ import annotations

import pytest
from pyspark.sql import types as T

from conftest import rows
from millrace.errors import ConfigError
from millrace.schema import apply_schema, build_schema, column_spec, describe, describe_schema, field_spec, fits

SPECS = {
    "c_null": {"type": "DATA_TYPE_NULL"},
    "c_bool": {"type": "DATA_TYPE_BOOL"},
    "c_int8": {"type": "DATA_TYPE_INT8"},
    "c_int16": {"type": "DATA_TYPE_INT16"},
    "c_int32": {"type": "DATA_TYPE_INT32"},
    "c_int64": {"type": "DATA_TYPE_INT64"},
    "c_uint8": {"type": "DATA_TYPE_UINT8"},
    "c_uint16": {"type": "DATA_TYPE_UINT16"},
    "c_uint32": {"type": "DATA_TYPE_UINT32"},
    "c_uint64": {"type": "DATA_TYPE_UINT64"},
    "c_float16": {"type": "DATA_TYPE_FLOAT16"},
    "c_float32": {"type": "DATA_TYPE_FLOAT32"},
    "c_float64": {"type": "DATA_TYPE_FLOAT64"},
    "c_string": {"type": "DATA_TYPE_STRING"},
    "c_large_string": {"type": "DATA_TYPE_LARGE_STRING"},
    "c_binary": {"type": "DATA_TYPE_BINARY"},
    "c_large_binary": {"type": "DATA_TYPE_LARGE_BINARY"},
    "c_date32": {"type": "DATA_TYPE_DATE32"},
    "c_date64": {"type": "DATA_TYPE_DATE64"},
    "c_timestamp": {"type": "DATA_TYPE_TIMESTAMP", "time_unit": "TIME_UNIT_MILLI"},
    "c_time32": {"type": "DATA_TYPE_TIME32", "time_unit": "TIME_UNIT_SECOND"},
    "c_time64": {"type": "DATA_TYPE_TIME64", "time_unit": "TIME_UNIT_NANO"},
    "c_duration": {"type": "DATA_TYPE_DURATION", "time_unit": "TIME_UNIT_MICRO"},
    "c_decimal128": {"type": "DATA_TYPE_DECIMAL128", "decimal_precision": 12, "decimal_scale": 4},
    "c_decimal256": {"type": "DATA_TYPE_DECIMAL256", "decimal_precision": 28, "decimal_scale": 6},
    "c_fixed": {"type": "DATA_TYPE_FIXED_SIZE_BINARY", "fixed_size_binary_length": 16},
}


def test_all_types_round_trip():
    assert len(SPECS) == 26
    assert describe_schema(build_schema(SPECS)) == SPECS


def test_short_names_mean_the_same():
    assert column_spec("int64") == column_spec({"type": "DATA_TYPE_INT64"})
    assert column_spec({"type": "timestamp", "time_unit": "ms"}) == column_spec(SPECS["c_timestamp"])


@pytest.mark.parametrize(
    "bad",
    [
        {"type": "timestamp"},
        {"type": "time32", "time_unit": "us"},
        {"type": "time64", "time_unit": "s"},
        {"type": "duration"},
        {"type": "decimal128", "decimal_precision": 10},
        {"type": "decimal128", "decimal_precision": 39, "decimal_scale": 0},
        {"type": "fixed_size_binary"},
        {"type": "unspecified"},
        {"type": "list"},
        {"type": "int64", "nullable": True},
    ],
)
def test_bad_specs_are_rejected(bad):
    with pytest.raises(ConfigError):
        column_spec(bad)


def test_nested_and_too_wide_types_are_rejected():
    with pytest.raises(ConfigError):
        field_spec(T.StructField("a", T.ArrayType(T.IntegerType())))
    with pytest.raises(ConfigError):
        build_schema({"a": {"type": "decimal256", "decimal_precision": 50, "decimal_scale": 2}})


def test_ranges(spark):
    df = spark.createDataFrame([(0,), (255,), (256,), (-1,), (None,)], "a int")
    assert [r[0] for r in df.select(fits(df.a, column_spec("uint8"))).collect()] == [True, True, False, False, True]
    with pytest.raises(Exception, match="out of range"):
        apply_schema(df, {"a": "uint8"}).collect()
    fixed = spark.createDataFrame([(bytearray(b"ab"),), (bytearray(b"abc"),)], "a binary")
    spec = {"type": "fixed_size_binary", "fixed_size_binary_length": 2}
    assert [r[0] for r in fixed.select(fits(fixed.a, column_spec(spec))).collect()] == [True, False]


def test_casts_that_fail_are_errors(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply_schema(df, {"a": "int32"}).collect()


def test_describe_gives_rows(spark, sample):
    assert rows(describe(sample).select("position", "column_name", "type")) == [(0, "id", "int64"), (1, "name", "string")]


@pytest.mark.parametrize(
    "path, options, wanted",
    [
        ("s3://b/x", {"s3": {"region": "eu", "connect_timeout": 2.5, "scheme": "http", "endpoint_override": "h:1", "credentials_kind": "ANONYMOUS"}},
         {"kind": "s3", "region": "eu", "connect_timeout": 2.5, "scheme": "http", "endpoint_override": "h:1", "anonymous": True}),
        ("s3://b/x", {"s3": {"credentials_kind": "EXPLICIT", "access_key": "a", "secret_key": "s", "background_writes": False}},
         {"kind": "s3", "access_key": "a", "secret_key": "s", "background_writes": False}),
        ("s3a://b/x", {"s3": {"credentials_kind": "ROLE", "role_arn": "arn", "proxy_options": {"host": "p", "port": 3, "scheme": "http"}}},
         {"kind": "s3", "role_arn": "arn", "proxy_options": {"host": "p", "port": 3, "scheme": "http"}}),
        ("gs://b/x", {"gcs": {"credentials": {"anonymous": True}, "project_id": "p"}}, {"kind": "gcs", "anonymous": True, "project_id": "p"}),
        ("abfss://c@a.dfs.core.windows.net/x", {"azure": {"account_name": "a", "credentials": {"kind": "STORAGE_SHARED_KEY", "storage_shared_key": "k"}}},
         {"kind": "azure", "account_name": "a", "account_key": "k"}),
        ("abfss://c@a.dfs.core.windows.net/x", {"azure": {"account_name": "a", "credentials": {"kind": "SAS_TOKEN", "sas_token": "t"}}},
         {"kind": "azure", "account_name": "a", "sas_token": "t"}),
        ("hdfs://n:8020/x", {"hdfs": {"connection_config": {"host": "n", "port": 8020, "user": "u"}, "replication": 2}},
         {"kind": "hdfs", "host": "n", "port": 8020, "user": "u", "replication": 2}),
        ("/x", {}, None),
    ],
)
def test_store_options_for_tasks(path, options, wanted):
    from millrace.storage import arrow_store, common_section

    assert arrow_store(path, common_section("t", {"filesystem_options": options})) == wanted


@pytest.mark.parametrize(
    "options",
    [
        {"s3": {"smart_defaults": "standard"}}, {"s3": {"allow_bucket_creation": True}}, {"gcs": {"default_bucket_location": "eu"}},
        {"gcs": {"credentials": {"expiration": 5}}}, {"azure": {"account_name": "a", "default_metadata": {"k": "v"}}},
    ],
)
def test_store_options_without_effect_are_refused(options):
    from millrace.storage import arrow_store, common_section

    path = {"s3": "s3://b/x", "gcs": "gs://b/x", "azure": "abfss://c@a.dfs.core.windows.net/x"}[next(iter(options))]
    with pytest.raises(ConfigError, match="no effect"):
        arrow_store(path, common_section("t", {"filesystem_options": options}))


def test_tasks_open_a_store_with_its_options():
    from pyarrow import fs

    from millrace.storage import arrow_filesystem

    found, path = arrow_filesystem("s3a://bucket/a b", {"kind": "s3", "region": "eu-west-1", "anonymous": True})
    assert isinstance(found, fs.S3FileSystem) and found.region == "eu-west-1" and path == "bucket/a b"
