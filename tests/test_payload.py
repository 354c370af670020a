"""Whole files, payload operators and logs."""

from __future__ import annotations

import gzip
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SMALL, rows
from millrace.errors import ConfigError
from millrace.operators import log, payload
from millrace.operators.compress import compress, decompress
from millrace.operators.dictionary import StoredDictionary, dictionary_encode
from millrace.sinks.files import write_files
from millrace.sources.files import read_files
from millrace.sources.lines import split_records


def payloads(spark, *items):
    return spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(items)], "ord bigint, payload binary")


def content(spark, path, **config):
    return [bytes(r.payload) for r in read_files(spark, {"path": str(path), **config}).orderBy("path").collect()]


def test_raw_gzip_and_capped_files(spark, tmp_path):
    (tmp_path / "raw").write_bytes(b"hello world")
    (tmp_path / "packed").write_bytes(gzip.compress(b"compressed-data"))
    (tmp_path / "auto.gz").write_bytes(gzip.compress(b"auto-detect"))
    assert content(spark, tmp_path / "raw") == [b"hello world"]
    assert content(spark, tmp_path / "packed", compression="COMPRESSION_GZIP") == [b"compressed-data"]
    assert content(spark, tmp_path / "auto.gz", compression="COMPRESSION_AUTO") == [b"auto-detect"]
    assert content(spark, tmp_path / "raw", compression="COMPRESSION_AUTO") == [b"hello world"]
    assert content(spark, tmp_path / "raw", max_bytes=4) == [b"hell"]
    assert content(spark, tmp_path / "auto.gz", compression="AUTO", max_bytes=4) == [b"auto"]
    with pytest.raises(ConfigError):
        read_files(spark, {"path": ""})


def test_gzip_members_follow_each_other(spark, tmp_path):
    (tmp_path / "two").write_bytes(gzip.compress(b"one") + gzip.compress(b"two"))
    assert content(spark, tmp_path / "two", compression="GZIP") == [b"onetwo"]


def test_one_payload_one_file(spark, tmp_path):
    write_files(payloads(spark, b"payload"), {"path": str(tmp_path / "o")})
    assert (tmp_path / "o").read_bytes() == b"payload"
    write_files(payloads(spark, b"gzip-payload"), {"path": str(tmp_path / "g"), "compression": "GZIP", "compression_level": 6})
    assert gzip.decompress((tmp_path / "g").read_bytes()) == b"gzip-payload"


def test_replaced_and_appended_files(spark, tmp_path):
    many = payloads(spark, b"a", b"b", b"", b"c").repartition(3)
    write_files(many, {"path": str(tmp_path / "last")}, order_by="ord")
    assert (tmp_path / "last").read_bytes() == b"c"
    config = {"path": str(tmp_path / "all"), "append": True, "layout": "SINGLE"}
    write_files(many, config, order_by="ord")
    write_files(many, config, order_by="ord")
    assert (tmp_path / "all").read_bytes() == b"abcabc"
    packed = {"path": str(tmp_path / "packed"), "append": True, "layout": "SINGLE", "compression": "GZIP"}
    write_files(many, packed, order_by="ord")
    write_files(many, packed, order_by="ord")
    assert gzip.decompress((tmp_path / "packed").read_bytes()) == b"abcabc"
    with pytest.raises(ConfigError, match="order_by"):
        write_files(many, {"path": str(tmp_path / "x")})
    assert sorted(p.name for p in tmp_path.iterdir()) == ["all", "last", "packed"]  # nothing staged is left


def test_a_hot_path_is_written_by_many_tasks(spark, tmp_path):
    many = spark.range(5000).selectExpr("id AS ord", "encode(concat(id, ';'), 'UTF-8') AS payload", "if(id % 3 = 0, 'small', 'hot') AS p")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_files(many.repartition(7), {"path": str(tmp_path / "o"), "append": True}, order_by="ord", path_column="p")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name, wanted in (("hot", [i for i in range(5000) if i % 3]), ("small", list(range(0, 5000, 3)))):
        parts = sorted((tmp_path / "o" / name).iterdir())
        assert b"".join(p.read_bytes() for p in parts) == "".join(f"{i};" for i in wanted).encode()
    assert len(list((tmp_path / "o" / "hot").iterdir())) > 3


@pytest.mark.parametrize("codec", ["GZIP", "ZSTD", "BZ2", "LZ4_FRAME", "BROTLI"])
def test_compressed_columns(spark, codec):
    df = payloads(spark, b"", b"abc" * 1000)
    packed = df.withColumn("packed", compress(F.col("payload"), codec))
    back = packed.select("payload", decompress(F.col("packed"), codec).alias("back"), decompress(F.col("packed"), codec, 5).alias("head"))
    for row in back.collect():
        assert row.back == row.payload and row.head == row.payload[:5]


def test_caps_and_chunks(spark):
    df = payloads(spark, b"12345", b"", b"1234567890")
    assert [bytes(r[0]) for r in df.orderBy("ord").select(payload.byte_cap("payload", 4)).collect()] == [b"1234", b"", b"1234"]
    chunks = payload.byte_chunks(df, ["ord"], size=4)
    assert sorted((r.ord, r.chunk_no, bytes(r.chunk)) for r in chunks.collect()) == [
        (0, 0, b"1234"), (0, 1, b"5"), (2, 0, b"1234"), (2, 1, b"5678"), (2, 2, b"90")
    ]
    assert payload.byte_chunks(payloads(spark, b"x" * 3_000_000), ["ord"], size=1 << 20).count() == 3
    assert payload.byte_chunks(payloads(spark, b"x" * 3_000_000), ["ord"]).count() == 46
    for size in (0, -1, (1 << 20) + 1):
        with pytest.raises(ConfigError):
            payload.byte_chunks(df, ["ord"], size=size)
    with pytest.raises(ConfigError):
        payload.byte_cap("payload", 0)
    plan = chunks._jdf.queryExecution().toString()
    assert "Generate posexplode" in plan and "[ord" in plan


def test_fields(spark):
    df = spark.sql("SELECT 1 AS id, array(struct('a' AS field, 'x' AS value), struct('b' AS field, 'y' AS value)) AS fields "
                   "UNION ALL SELECT 2, array(struct('a', 'z'), struct('a', 'zz')) UNION ALL SELECT 3, array()")
    assert rows(payload.extract_payloads(df, ["id"])) == [(1, "x"), (2, "z")]
    assert rows(payload.extract_payloads(df, ["id"], name="b")) == [(1, "y")]


def test_arrow_payloads(spark, sample):
    df = spark.range(1000, numPartitions=3).selectExpr("id", "cast(id AS string) AS s", "timestamp_ntz'2020-01-01' AS t", "array(id) AS a")
    encoded = payload.arrow_encode(df, 64).cache()
    sizes = [r.num_rows for r in encoded.orderBy("partition", "batch_no").collect()]
    assert sum(sizes) == 1000 and max(sizes) == 64 and sum(s < 64 for s in sizes) <= 3
    assert rows(payload.arrow_decode(encoded, df.schema)) == rows(df)
    assert payload.payload_schema(encoded).simpleString() == df.schema.simpleString()
    whole = payload.arrow_encode(sample.coalesce(1))
    assert whole.count() == 1 and rows(payload.arrow_decode(whole, "id bigint, name string")) == rows(sample)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text('ab"\n', max_size=6), max_size=6), st.integers(1, 5))
def test_records_do_not_depend_on_chunks(fields, size):
    data = "".join('"' + f.replace('"', '""') + '"\n' for f in fields).encode()
    chunks = [data[i:i + size] for i in range(0, len(data), size)]
    found = list(split_records(chunks, '"', None))
    assert [r.decode() for r in found] == ['"' + f.replace('"', '""') + '"' for f in fields]


# -------------------------------------------------------------------- logs
def stream(spark, hot=5000, cold=700, step=1):
    ids = random.Random(7).sample(range(0, 10_000_000, step), hot + cold)
    data = [(("hot" if i < hot else f"s{i % 3}"), n) for i, n in enumerate(ids)]
    return data, spark.createDataFrame(data, "stream string, id bigint").repartition(5)


def newest(data, count):
    found = []
    for name in {s for s, _ in data}:
        found += sorted(((s, i) for s, i in data if s == name), key=lambda e: -e[1])[:count]
    return sorted(found)


@pytest.mark.parametrize("count", [1, 10, 300, 1000, 1001, 3000, 4999, 5000, 9000])
def test_trim(spark, count):
    data, df = stream(spark)
    assert rows(log.log_trim(df, count)) == newest(data, count)


KINDS = {
    "double": "id / 3.0D", "timestamp": "timestamp_millis(id)", "decimal": "cast(id AS decimal(38,0)) * 18446744073709551616",
    "text": "concat(id DIV 10, '-', id % 10)", "ties": "id DIV 7",
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("count", [1000, 1001, 2500])
def test_every_count_means_the_same_for_every_id(spark, kind, count):
    df = spark.range(3000).selectExpr("if(id % 10 = 0, null, 'a') AS stream", f"if(id % 50 = 1, null, {KINDS[kind]}) AS entry", "id AS n").repartition(7)
    entry = log.entry_id("entry") if kind == "text" else F.col("entry")
    found = [r.n for r in log.log_trim(df, count, id_column=entry).where("stream = 'a'").collect()]
    number = {r.n: None if r.e is None else tuple(r.e) if kind == "text" else r.e for r in df.select("n", entry.alias("e")).collect()}
    known = sorted((n for n in number if n % 10), key=lambda n: n)
    newest = sorted((n for n in known if n % 50 != 1), key=lambda n: number[n], reverse=True)
    wanted = (newest + [n for n in known if n % 50 == 1])[:count]
    assert len(found) == len(wanted)
    assert sorted(map(str, (number[n] for n in found))) == sorted(map(str, (number[n] for n in wanted)))
    least = log.entry_id(F.lit("50-0")) if kind == "text" else {r.n: r.e for r in df.select("n", entry.alias("e")).collect()}[500]
    read = log.log_read(df, least, count, entry)
    assert read.count() == min(count, df.where(entry > least).count())


def test_equal_rows_are_cut_to_the_count(spark):
    df = spark.range(6000).selectExpr("'a' AS stream", "1 AS id").repartition(6)
    assert log.log_trim(df, 1500).count() == 1500 and log.log_trim(df, 500).count() == 500
    assert log.log_read(df, 0, 2500).count() == 2500


def test_trim_without_a_limit_and_approximately(spark):
    data, df = stream(spark)
    assert log.log_trim(df, 0) is df
    kept = rows(log.log_trim(df, 2000, approximate=True))
    assert set(newest(data, 2000)) <= set(kept) and len(kept) < len(data)


def test_trim_keeps_other_columns_and_null_streams(spark):
    df = spark.range(3000).selectExpr("if(id % 2 = 0, null, 'a') AS stream", "id", "id * 2 AS extra")
    found = log.log_trim(df, 1200)
    assert found.columns == ["stream", "id", "extra"] and found.count() == 2400
    assert found.agg(F.min("id")).first()[0] == 600


@pytest.mark.parametrize("count", [None, 0, 5, 1000, 2500, 10_000])
def test_read(spark, count):
    data, df = stream(spark)
    after = sorted(i for _, i in data)[1000]
    wanted = sorted(i for _, i in data if i > after)
    wanted = wanted[:count] if count else wanted
    assert sorted(r.id for r in log.log_read(df, after, count).collect()) == wanted


def test_entry_ids_sort_like_the_log(spark):
    df = spark.createDataFrame([("10-2",), ("9-11",), ("10-10",), ("10",)], "id string")
    assert [r.id for r in df.orderBy(log.entry_id("id")).collect()] == ["9-11", "10", "10-2", "10-10"]


def test_members_share_all_messages(spark):
    df = spark.range(1000)
    parts = [rows(log.queue_group(df, 3, m)) for m in range(3)]
    assert sorted(sum(parts, [])) == rows(df) and min(map(len, parts)) > 200
    with pytest.raises(ConfigError):
        log.queue_group(df, 3, 3)


def test_channel(spark):
    df = spark.createDataFrame([("message", "a", "x"), ("subscribe", "a", "y"), ("message", "b", "z"), ("message", "a", None)],
                               "kind string, channel string, payload string")
    assert rows(log.channel_messages(df, "a")) == [("x",)]


def test_trim_plan_limits_before_it_shuffles(spark):
    data, df = stream(spark)
    plan = log.log_trim(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


# -------------------------------------------------------------- dictionary
def test_dictionary_ways_agree(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('v', id % 500)) AS v").union(spark.sql("SELECT -1L, null"))
    values = sorted({r.v for r in df.collect() if r.v is not None})
    wanted = sorted((r.id, values.index(r.v) if r.v is not None else None) for r in df.collect())
    for limit in (1000, 1 << 30):
        found = dictionary_encode(df, "v", limit)
        assert rows(found.select("id", "v_code")) == wanted
    for limit in (400, len(values) - 1):
        assert dictionary_encode(df, "v", limit).where("v_code IS NOT NULL").isEmpty()
    assert not dictionary_encode(df, "v", len(values)).where("v_code IS NOT NULL").isEmpty()
    assert dictionary_encode(df, "v", 400).schema == dictionary_encode(df, "v", len(values)).schema
    with pytest.raises(ConfigError):
        dictionary_encode(df.withColumnRenamed("id", "V_CODE"), "v", 5)


def test_events_payloads(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet").select(F.encode("props", "UTF-8").alias("payload"))
    assert payload.drop_empty(events).count() == events.count()


def test_reads_stop_at_max_bytes(spark, tmp_path, monkeypatch):
    """A sparse file of 3 GiB: no more than asked is read, and in chunks it has no largest size."""
    import os

    path = tmp_path / "large.bin"
    with open(path, "wb") as out:
        out.write(b"0123456789" * 20)
        os.truncate(out.fileno(), 3 << 30)
    head = read_files(spark, {"path": str(path), "max_bytes": 100})
    assert [bytes(r.payload) for r in head.collect()] == [b"0123456789" * 10]
    pieces = read_files(spark, {"path": str(path), "chunk_bytes": 128 << 20})
    assert pieces.rdd.getNumPartitions() == 24
    assert sorted(r[0] for r in pieces.select("offset").collect()) == [k * (128 << 20) for k in range(24)]
    with pytest.raises(Exception, match="too large for one payload"):
        read_files(spark, {"path": str(path)}).collect()


@pytest.mark.parametrize("limit", [0, 25])
def test_chunks_of_files(spark, tmp_path, limit):
    data = bytes(range(97))
    (tmp_path / "a.bin").write_bytes(data)
    (tmp_path / "b.gz").write_bytes(gzip.compress(data[:50]) + gzip.compress(data[50:]))
    (tmp_path / "c.bin").write_bytes(b"")
    found = read_files(spark, {"path": str(tmp_path), "compression": "AUTO", "chunk_bytes": 10, "max_bytes": limit}).collect()
    for name in ("a.bin", "b.gz"):
        parts = sorted((r.offset, bytes(r.payload)) for r in found if r.path.endswith(name))
        assert b"".join(p for _, p in parts) == data[: limit or None]
        assert [o for o, _ in parts] == list(range(0, limit or 97, 10)) and all(len(p) == 10 for _, p in parts[:-1])
    assert not [r for r in found if r.path.endswith("c.bin")]
    whole = {r.path.rpartition("/")[2]: bytes(r.payload) for r in read_files(spark, {"path": str(tmp_path), "compression": "AUTO"}).collect()}
    assert whole == {"a.bin": data, "b.gz": data}  # an empty file has no bytes to send on


# ---------------------------------------------------------- growing results
def test_stored_codes_stay(spark, tmp_path):
    """Batches with new, old and null values; a batch run again changes nothing; another process goes on."""
    batches = [["b", "a", None, "b"], [], ["c", "a"], ["d", "é", "a\"'`", None]]
    frames = [spark.createDataFrame([(v,) for v in values], "v string") for values in batches]
    wanted = {}
    for values in batches:
        for value in sorted({v for v in values if v is not None} - set(wanted), key=lambda v: v.encode()):
            wanted[value] = len(wanted)
    for number, frame in enumerate(frames):
        for _ in range(2):
            found = StoredDictionary(spark, str(tmp_path / "d")).encode(frame, "v", number)
            assert found.columns == ["v", "v_code"]
            assert sorted(map(tuple, found.collect()), key=repr) == sorted(((v, wanted.get(v)) for v in batches[number]), key=repr)
    again = StoredDictionary(spark, str(tmp_path / "d")).encode(frames[0], "v", 4, "code")
    assert {r.code for r in again.collect()} == {wanted["a"], wanted["b"], None}
    with pytest.raises(ConfigError):
        StoredDictionary(spark, str(tmp_path / "d")).encode(spark.createDataFrame([("a", 1)], "v string, V_CODE int"), "v", 5)


def test_trimming_a_stream(spark, tmp_path):
    """Entries out of order, equal ids, null ids, over batches of one file each and two runs."""
    rng = random.Random(2)
    entries = [(rng.choice("ab"), rng.choice([None, *range(60)]), rng.random()) for _ in range(300)]
    schema = "stream string, id int, value double"
    whole = spark.createDataFrame(entries, schema)
    (tmp_path / "in").mkdir()
    for run in range(2):
        for k in range(3):
            part = entries[150 * run + 50 * k : 150 * run + 50 * k + 50]
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
        log.trim_stream(source, str(tmp_path / "out"), str(tmp_path / "check"), 7).awaitTermination()
        sofar = whole.limit(150 * run + 150)
        assert rows(log.trimmed(spark, str(tmp_path / "out"), whole.schema)) == rows(log.log_trim(sofar, 7))


@pytest.mark.parametrize("maxlen", [3, 2000])
def test_columns_with_the_names_trimming_uses(spark, maxlen):
    names = ["_rank", "_salt", "_key", "_place", "_range", "_need", "of", "in"]
    df = spark.range(5000).selectExpr("'s' AS stream", "id", *[f"id + {k} AS `{name}`" for k, name in enumerate(names)])
    found = log.log_trim(df, maxlen)
    assert found.columns == df.columns
    assert rows(found) == rows(df.where(f"id >= {5000 - maxlen}"))


def test_moves_are_finished_by_another_job(spark, tmp_path, monkeypatch):
    """The driver dies between the manifest and the moves, and again amid them."""
    from millrace.sinks import files

    staged = {}
    real = files.finish_moves
    monkeypatch.setattr(files, "finish_moves", lambda spark, staging, store=None: staged.update(at=staging))
    df = spark.range(40).selectExpr("concat('f', id) AS file", "encode(cast(id AS string), 'UTF-8') AS payload")
    write_files(df, {"path": str(tmp_path / "out")}, path_column="file")
    assert not list(tmp_path.glob("out/*"))
    lines = (tmp_path / staged["at"].rpartition("/")[2] / files.MANIFEST).read_text().splitlines()
    assert len(lines) == 40
    import json

    files._move([(m["staged"], m["target"]) for m in map(json.loads, lines[:15])], None)
    monkeypatch.setattr(files, "SMALL_MANIFEST", 1000)
    real(spark, staged["at"])
    assert {p.name: p.read_text() for p in tmp_path.glob("out/*")} == {f"f{k}": str(k) for k in range(40)}
    assert not list(tmp_path.glob(".out*"))


def test_small_files_in_chunks_share_tasks(spark, tmp_path):
    for k in range(400):
        (tmp_path / f"{k}.txt").write_bytes(b"%06d" % k * 5)
    found = read_files(spark, {"path": str(tmp_path), "chunk_bytes": 12})
    assert found.rdd.getNumPartitions() <= 128
    got = sorted((int(r.path.rpartition("/")[2][:-4]), r.offset, bytes(r.payload)) for r in found.collect())
    assert got == [(k, at, (b"%06d" % k * 5)[at : at + 12]) for k in range(400) for at in (0, 12, 24)]
