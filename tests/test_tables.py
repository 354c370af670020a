"""Parquet and ORC files, Hive folders, concatenation."""

from __future__ import annotations

import warnings
from datetime import datetime, time
from pathlib import Path

import pyarrow as pa
import pyarrow.orc as po
import pyarrow.parquet as pq
import pytest

from conftest import SMALL, rows
from millrace.errors import ConfigError, DataError
from millrace.operators.tables import partition_guard, strict_concat
from millrace.sinks.orc import orc_options, orc_sink_config, write_orc
from millrace.sinks.parquet import parquet_options, parquet_sink_config, write_parquet
from millrace.sources.orc import read_orc
from millrace.sources.parquet import read_parquet

SAMPLE = pa.table({"id": pa.array([1, 2], pa.int64()), "name": ["alpha", "beta"]})


def parts(folder, suffix=".parquet"):
    return sorted(p for p in Path(folder).rglob(f"*{suffix}") if not p.name.startswith("."))


def test_one_file(spark, tmp_path):
    pq.write_table(SAMPLE, tmp_path / "f.parquet")
    assert rows(read_parquet(spark, {"path": str(tmp_path / "f.parquet")})) == [(1, "alpha"), (2, "beta")]


def test_folders_that_look_like_partitions(spark, tmp_path):
    for value in (1, 2):
        folder = tmp_path / f"id={value + 10}"
        folder.mkdir()
        pq.write_table(SAMPLE.slice(value - 1, 1), folder / f"part-{value}.parquet")
    (tmp_path / "notes.txt").write_text("x")
    assert rows(read_parquet(spark, {"path": str(tmp_path)})) == [(1, "alpha"), (2, "beta")]


def test_schemas_must_be_the_same(spark, tmp_path):
    pq.write_table(SAMPLE, tmp_path / "a.parquet")
    pq.write_table(SAMPLE.select(["id"]), tmp_path / "b.parquet")
    with pytest.raises(DataError, match="schemas differ"):
        read_parquet(spark, {"path": str(tmp_path)})


def test_a_folder_without_files(spark, tmp_path):
    with pytest.raises(Exception):
        read_parquet(spark, {"path": str(tmp_path)})


def test_types_sparks_reader_refuses(spark, tmp_path):
    table = pa.table(
        {
            "half": pa.array([1.5, None], pa.float16()),
            "nanos": pa.array([1_577_836_800_000_000_123, None], pa.timestamp("ns")),
            "clock": pa.array([time(10, 0, 1), None], pa.time32("ms")),
            "micros": pa.array([time(10, 0, 1, 5), None], pa.time64("us")),
            "big": pa.array([2**64 - 1, None], pa.uint64()),
        }
    )
    pq.write_table(table, tmp_path / "a.parquet", row_group_size=1)
    found = read_parquet(spark, {"path": str(tmp_path / "a.parquet")})
    first = found.where("half IS NOT NULL").first()
    assert first.half == 1.5 and first.nanos == datetime(2020, 1, 1) and first.big == 2**64 - 1
    assert first.clock == time(10, 0, 1) and first.micros == time(10, 0, 1, 5)
    assert found.count() == 2


def test_written_parquet_is_equal(spark, sample, tmp_path):
    write_parquet(sample.coalesce(1), {"path": str(tmp_path / "o")})
    write_parquet(sample.coalesce(1), {"path": str(tmp_path / "o")})  # replaces
    (file,) = parts(tmp_path / "o")
    assert pq.read_table(file).equals(SAMPLE)
    assert pq.read_metadata(file).row_group(0).column(0).compression == "UNCOMPRESSED"


def test_columns_without_a_type_are_written(spark, tmp_path):
    write_parquet(spark.sql("SELECT 1 AS a, null AS b"), {"path": str(tmp_path / "o")})
    assert rows(read_parquet(spark, {"path": str(tmp_path / "o")})) == [(1, None)]


def test_hive_folders(spark, sample, tmp_path):
    path = tmp_path / "o"
    path.mkdir()  # an existing empty folder is fine
    config = {"path": str(path), "write_opts": {"partition_columns": ["id"], "basename_template": "data-{i}.parquet"}}
    write_parquet(sample, config)
    assert sorted(p.parent.name for p in parts(path)) == ["id=1", "id=2"]
    assert all(p.name.startswith("data-") for p in parts(path))
    stored = spark.read.schema(sample.schema).parquet(str(path)).select("id", "name")
    assert rows(stored) == [(1, "alpha"), (2, "beta")]
    with pytest.raises(DataError, match="not empty"):
        write_parquet(sample, config)


def test_hive_limits(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 4 AS k")
    opts = {"partition_columns": ["k"], "max_rows_per_file": 100, "max_rows_per_group": 30}
    write_parquet(df, {"path": str(tmp_path / "o"), "write_opts": opts})
    metas = [pq.read_metadata(p) for p in parts(tmp_path / "o")]
    assert sum(m.num_rows for m in metas) == 1000
    assert max(m.num_rows for m in metas) <= 100
    assert max(m.row_group(i).num_rows for m in metas for i in range(m.num_row_groups)) <= 30
    with pytest.raises(DataError, match="more than 3"):
        write_parquet(df, {"path": str(tmp_path / "p"), "write_opts": {"partition_columns": ["k"], "max_partitions": 3}})
    write_parquet(df, {"path": str(tmp_path / "q"), "write_opts": {"partition_columns": ["k"], "max_partitions": 4}})
    for bad in ({}, {"partition_columns": ["zz"]}, {"partition_columns": ["k"], "basename_template": "x.parquet"}):
        with pytest.raises(ConfigError):
            write_parquet(df, {"path": str(tmp_path / "r"), "write_opts": bad})


def test_a_hot_partition_value_is_cut_into_tasks(spark):
    from millrace.operators.tables import partition_files

    plan = partition_files(spark.range(10).selectExpr("id % 2 AS k"), ["k"])._jdf.queryExecution().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_parquet_writer_properties(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "cast(id % 7 AS string) AS s", "cast(id AS decimal(9,2)) AS d").coalesce(1)
    props = {
        "compression": "COMPRESSION_ZSTD", "compression_level": 19, "dictionary_enabled": True, "data_page_size": 4096,
        "max_rows_per_page": 500, "page_checksum_enabled": True, "max_statistics_size": 16,
        "size_statistics_level": "SIZE_STATISTICS_LEVEL_NONE", "data_page_version": "DATA_PAGE_VERSION_V2",
        "version": "PARQUET_VERSION_2_6", "max_row_group_length": 2000, "dictionary_page_size_limit": 1 << 20,
        "sorting_columns": [{"column_index": 0, "descending": True}],
        "column_properties": {"s": {"dictionary_enabled": False, "statistics_enabled": False}},
    }
    write_parquet(df, {"path": str(tmp_path / "o"), "writer_properties": props})
    (file,) = parts(tmp_path / "o")
    meta = pq.read_metadata(file)
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [2000, 2000, 1000]
    group = meta.row_group(0)
    assert group.column(0).compression == "ZSTD"
    assert group.column(1).statistics is None and group.column(0).statistics is not None
    assert "RLE_DICTIONARY" not in group.column(1).encodings
    assert group.column(2).physical_type == "INT32"
    assert pq.read_table(file).column("id").to_pylist() == list(range(4999, -1, -1))


def test_row_group_size_wins(spark, tmp_path):
    config = {"path": str(tmp_path / "o"), "row_group_size": 10, "writer_properties": {"max_row_group_length": 50}}
    write_parquet(spark.range(100).coalesce(1), config)
    assert pq.read_metadata(parts(tmp_path / "o")[0]).num_row_groups == 10


@pytest.mark.parametrize(
    "props",
    [
        {"created_by": "me"},
        {"content_defined_chunking_enabled": True},
        {"encoding": "ENCODING_BYTE_STREAM_SPLIT"},
        {"encoding": "ENCODING_DELTA_BYTE_ARRAY", "data_page_version": "V1"},
        {"compression": "COMPRESSION_BROTLI"},
        {"compression": "COMPRESSION_SNAPPY", "compression_level": 3},
        {"column_properties": {"a": {"compression": "COMPRESSION_ZSTD"}}},
        {"page_index_enabled": False},
        {"nope": 1},
    ],
)
def test_properties_spark_cannot_honour_are_refused(props):
    with pytest.raises(ConfigError):
        parquet_options(parquet_sink_config({"path": "x", "writer_properties": props}))


def test_a_property_without_effect_warns():
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        parquet_options(parquet_sink_config({"path": "x", "writer_properties": {"write_batch_size": 10}}))
    assert "no effect" in str(seen[0].message)


def test_encodings():
    options = parquet_options(parquet_sink_config({"path": "x", "writer_properties": {"encoding": "ENCODING_DELTA_BINARY_PACKED"}}))
    assert options["parquet.writer.version"] == "v2" and options["parquet.enable.dictionary"] == "false"
    options = parquet_options(parquet_sink_config({"path": "x", "writer_properties": {"encoding": "PLAIN"}}))
    assert options["parquet.enable.dictionary"] == "false"


# --------------------------------------------------------------------- ORC
def test_orc(spark, sample, tmp_path):
    write_orc(sample.coalesce(1), {"path": str(tmp_path / "o"), "common": {"compression": "COMPRESSION_ZSTD"}})
    (file,) = parts(tmp_path / "o", ".orc")
    assert po.ORCFile(file).compression == "UNCOMPRESSED"  # the common codec is not used
    assert rows(read_orc(spark, {"path": str(tmp_path / "o")})) == [(1, "alpha"), (2, "beta")]


def test_orc_options(spark, tmp_path):
    options = {
        "compression": "COMPRESSION_GZIP", "stripe_size": 1 << 20, "compression_block_size": 1 << 16, "row_index_stride": 2000,
        "compression_strategy": "COMPRESSION_STRATEGY_COMPRESSION", "padding_tolerance": 0.1, "batch_size": 512,
        "dictionary_key_size_threshold": 0.5, "bloom_filter_columns": [1], "bloom_filter_fpp": 0.02,
        "file_version": {"major_version": 0, "minor_version": 11},
    }
    df = spark.range(5000).selectExpr("id", "cast(id AS string) AS s").coalesce(1)
    write_orc(df, {"path": str(tmp_path / "o"), "write_options": options})
    file = po.ORCFile(parts(tmp_path / "o", ".orc")[0])
    assert file.compression == "ZLIB" and file.row_index_stride == 2000 and str(file.file_version) == "0.11"
    assert read_orc(spark, {"path": str(tmp_path / "o")}).count() == 5000
    found = orc_options(orc_sink_config({"path": "x", "write_options": options}), ["id", "s"])
    assert found["orc.bloom.filter.columns"] == "s"
    for bad in ({"compression": "BROTLI"}, {"bloom_filter_columns": [7]}, {"file_version": {"major_version": 1, "minor_version": 0}}):
        with pytest.raises(ConfigError):
            orc_options(orc_sink_config({"path": "x", "write_options": bad}), ["id"])


# ----------------------------------------------------------- concatenation
def test_concat_needs_equal_schemas(spark, sample):
    assert strict_concat([sample, sample]).count() == 4
    with pytest.raises(DataError, match="table 1"):
        strict_concat([sample, sample.select("name", "id")])
    with pytest.raises(DataError):
        strict_concat([sample, sample.selectExpr("cast(id AS int) AS id", "name")])


def test_partition_guard(spark):
    df = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    assert partition_guard(df, ["l_returnflag"], 3) is df
    with pytest.raises(DataError):
        partition_guard(df, ["l_returnflag"], 2)


def test_reads_prune_and_push_down(spark, tmp_path):
    write_parquet(spark.range(100).selectExpr("id", "id * 2 AS b", "id * 3 AS c"), {"path": str(tmp_path / "o")})
    plan = read_parquet(spark, {"path": str(tmp_path / "o")}).where("id > 5").select("b")._jdf.queryExecution().toString()
    assert "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint,b:bigint>" in plan
