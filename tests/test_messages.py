"""Stores, brokers, endpoints and logs, without opening a port."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.errors import ConfigError
from millrace.operators.payload import field_extract
from millrace.sinks import messages
from millrace.sources.kafka import kafka_options
from millrace.storage import common_section, orc_codec, parquet_codec, resolve_codec, resolve_path
from millrace.streaming.log_source import LogReader, LogStreamReader, read_log, read_redis_stream
from millrace.streaming.publish import publish, send_with_status

BASE = {"brokers": "b:9092", "topic": "t", "group_id": "g"}


def test_kafka_source_options():
    config = {"fetch.min.bytes": "5", "enable.auto.commit": "true"}
    options = kafka_options({**BASE, "consumer_config": config, "client_id": "me"})
    assert "kafka.enable.auto.commit" not in options
    assert options["subscribe"] == "t" and "assign" not in options and options["startingOffsets"] == "latest"
    assert options["kafka.fetch.min.bytes"] == "5" and options["kafka.client.id"] == "me" and options["kafkaConsumer.pollTimeoutMs"] == "1000"
    assert json.loads(kafka_options({**BASE, "partition": 0})["assign"]) == {"t": [0]}
    assert "subscribe" in kafka_options({**BASE, "partition": -1})
    assert kafka_options({**BASE, "auto_offset_reset": "earliest"})["startingOffsets"] == "earliest"
    for bad in ({}, {**BASE, "group_id": ""}, {**BASE, "auto_offset_reset": "middle"}, {**BASE, "x": 1}):
        with pytest.raises(ConfigError):
            kafka_options(bad)


def stream(spark):
    return spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"")), (3, bytearray(b"c"))], "id int, payload binary")


def test_frames(spark):
    df = stream(spark)
    kafka = messages.kafka_records(df, {"brokers": "b", "topic": "t", "partition": 3}, ("id",))
    assert rows(kafka) == [(1, "t", 3, b"a"), (3, "t", 3, b"c")]
    assert messages.kafka_records(df, {"brokers": "b", "topic": "t"}).first().partition is None
    xadd = messages.redis_xadd(df, {"stream": "s", "maxlen": 5, "id": "7-*", "field_name": "f"}).first()
    assert xadd.command == ["XADD", "s", "MAXLEN", "=", "5", "7-*", "f"] and xadd.payload == b"a"
    assert messages.redis_xadd(df, {"stream": "s"}).first().command == ["XADD", "s", "*", "data"]
    assert messages.redis_publish(df, {"channel": "c"}).first().command == ["PUBLISH", "c"]
    assert messages.nats_publish(df, {"subject": "x"}).count() == 2
    http = messages.http_requests(df, {"url": "http://h/p", "headers": [{"name": "", "value": "v"}, {"name": "A", "value": "b"}]})
    assert http.count() == 3
    first = http.first()
    assert first.method == "POST" and [tuple(h) for h in first.headers] == [("Content-Type", "application/json"), ("A", "b")]


def test_frame_configurations():
    assert messages.http_config({"url": "u"})["settings"] == {"timeout_ms": 5000}
    assert messages.nats_config({"subject": "s"})["settings"] == {"url": "nats://127.0.0.1:4222", "flush_ms": 1000}
    assert messages.redis_stream_config({"stream": "s"})["settings"]["port"] == 6379
    for call, bad in (
        (messages.kafka_sink_config, {"brokers": "b"}),
        (messages.redis_stream_config, {}),
        (messages.redis_stream_config, {"stream": "s", "username": "u"}),
        (messages.redis_pubsub_config, {}),
        (messages.nats_config, {}),
        (messages.http_config, {"url": ""}),
        (messages.http_config, {"url": "u", "method": "METHOD_GET"}),
    ):
        with pytest.raises(ConfigError):
            call(bad)
    options = messages.kafka_writer_options({"brokers": "b", "topic": "t", "producer_config": {"acks": "all"}})
    assert options["kafka.acks"] == "all"


def sent(folder):
    return sorted((r["id"], r["payload"]) for f in folder.iterdir() for r in json.loads(f.read_text()))


def test_publishing(spark, tmp_path):
    frame = messages.nats_publish(stream(spark), {"subject": "x"}, ("id",))
    publish(frame, "fake_clients:Recorder", {"folder": str(tmp_path)})
    assert sent(tmp_path) == [(1, "a"), (3, "c")]


def test_publishing_a_stream(spark, tmp_path):
    for name in ("in", "out"):
        (tmp_path / name).mkdir()
    stream(spark).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("id int, payload binary").parquet(str(tmp_path / "in"))
    frame = messages.nats_publish(source, {"subject": "x"}, ("id",))
    publish(frame, "fake_clients:Recorder", {"folder": str(tmp_path / "out")}, str(tmp_path / "positions")).awaitTermination()
    assert sent(tmp_path / "out") == [(1, "a"), (3, "c")]


def test_a_refused_message_fails_the_batch(spark):
    bad = spark.createDataFrame([(1, bytearray(b"fail"))], "id int, payload binary")
    with pytest.raises(Exception):
        publish(messages.http_requests(bad, {"url": "u"}), "fake_clients:Endpoint", {})


def test_sending_with_status(spark):
    df = spark.createDataFrame([(1, bytearray(b"ok")), (2, bytearray(b"fail")), (3, bytearray(b""))], "id int, payload binary")
    frame = messages.http_requests(df, {"url": "u"}, ("id",))
    assert rows(send_with_status(frame, "id", "fake_clients:Endpoint", {})) == [
        (1, 201, True, None), (2, 503, False, "HTTP status 503"), (3, 201, True, None)
    ]


def test_http_client(monkeypatch):
    from millrace.streaming import clients

    seen = []

    class Connection:
        def __init__(self, host, timeout):
            seen.append((host, timeout))

        def request(self, *args):
            seen.append(args)

        def getresponse(self):
            return type("R", (), {"read": lambda self: b"", "status": 204 if len(seen) < 3 else 404})()

        def close(self):
            seen.append("closed")

    monkeypatch.setattr(clients.http.client, "HTTPConnection", Connection)
    client = clients.HttpClient({"timeout_ms": 1500})
    row = {"method": "PUT", "url": "http://h:1/p?q=1", "headers": [{"name": "A", "value": "b"}], "payload": b"x"}
    assert client.send(row) == 204
    with pytest.raises(clients.HttpStatusError, match="404"):
        client.send(row)
    client.close()
    assert seen == [("h:1", 1.5), ("PUT", "/p?q=1", b"x", {"A": "b"}), ("PUT", "/p?q=1", b"x", {"A": "b"}), "closed"]


def test_missing_broker_libraries_are_named():
    from millrace.streaming import clients

    with pytest.raises(ConfigError, match="redis"):
        clients.RedisClient({})


# -------------------------------------------------------------------- logs
def test_reading_a_log(spark):
    found = read_log(spark, "fake_clients:StreamLog", {}, streaming=False, partitions=3)
    assert rows(found.select("id", F.size("fields"))) == [("1-0", 2), ("1-1", 1), ("5-0", 1)]
    assert [r.id for r in found.orderBy("position").collect()] == ["1-0", "1-1", "5-0"]
    by_name = read_redis_stream(spark, {"stream": "s", "field_name": "b", "start_id": "0"}, False, "fake_clients:StreamLog")
    assert [(r.id, bytes(r.payload)) for r in by_name.orderBy("id").collect()] == [("1-0", b"uno"), ("1-1", b"dos")]
    later = read_redis_stream(spark, {"stream": "s", "start_id": "1-0"}, False, "fake_clients:StreamLog")
    assert [bytes(r.payload) for r in later.orderBy("id").collect()] == [b"dos", b"three"]
    assert read_redis_stream(spark, {"stream": "s"}, False, "fake_clients:StreamLog").count() == 0  # starts at the end


def test_ranges_cover_a_log_once():
    reader = LogReader({"client": "fake_clients:StreamLog", "settings": "{}", "partitions": "4"})
    for start, end in ((0, 0), (0, 1), (5, 8), (0, 10**30)):
        parts = reader.ranges(start, end)
        edges = [start, *[p.end for p in parts]]
        assert [p.start for p in parts] == edges[:-1] and edges[-1] == end


def test_tasks_are_bounded_and_a_batch_is_whole():
    reader = LogStreamReader({"client": "fake_clients:Sequence", "settings": "{}", "maxPositions": "10", "partitions": "2"})
    assert reader.initialOffset() == {"position": "0"} and reader.latestOffset() == {"position": "1100"}
    parts = reader.partitions({"position": "0"}, reader.latestOffset())
    assert [p.start for p in parts] == [999, *[p.end for p in parts][:-1]] and parts[-1].end == 1100
    assert all(p.end - p.start <= 10 for p in parts)


def test_a_run_over_what_is_available_leaves_nothing(spark, tmp_path):
    found = read_log(spark, "fake_clients:Sequence", {}, max_positions=7).select("id")
    writer = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "positions"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted((str(k),) for k in range(1000, 1101))


def test_ranges_of_real_ids_are_of_about_equal_size():
    """Ids of milliseconds and a number lie far from zero: ranges are cut between the first and the last that is there."""
    start = 1_700_000_000_000
    reader = LogReader({"client": "fake_clients:Sequence", "settings": json.dumps({"from": start << 64, "to": (start + 3_600_000) << 64}), "partitions": "8"})
    parts = reader.ranges(0, (start + 3_600_000) << 64)
    spans = [(p.end - p.start) >> 64 for p in parts]
    assert len(parts) == 8 and max(spans) - min(spans) <= 1


def test_command_timeouts_reach_the_client():
    for call, more in ((messages.redis_stream_config, {"stream": "s"}), (messages.redis_pubsub_config, {"channel": "c"})):
        assert call({**more, "command_timeout_ms": 250})["settings"]["command_ms"] == 250
        assert call(more)["settings"]["command_ms"] is None
        with pytest.raises(ConfigError):
            call({**more, "command_timeout_ms": -1})


def test_batch_reads_of_a_topic_start_at_the_beginning():
    from millrace.sources.kafka import kafka_batch_options

    config = {"brokers": "b", "topic": "t", "group_id": "g"}
    for more in ({}, {"auto_offset_reset": "earliest"}, {"consumer_config": {"auto.offset.reset": "beginning"}}):
        assert kafka_batch_options(config | more)["startingOffsets"] == "earliest"
    for more in ({"auto_offset_reset": "latest"}, {"consumer_config": {"auto.offset.reset": "end"}}):
        with pytest.raises(ConfigError, match="batch read"):
            kafka_batch_options(config | more)


def test_streamed_log_resumes(spark, tmp_path):
    def run():
        found = read_log(spark, "fake_clients:StreamLog", {}).select("id", field_extract("fields").alias("payload"))
        query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "positions"))
        query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")).select("id"))

    assert run() == run() == [("1-0",), ("1-1",), ("5-0",)]


# ------------------------------------------------------------------ storage
def common(**fields):
    return common_section("t", fields)


def test_store_selection():
    assert resolve_path("/a", common(filesystem="FILE_SYSTEM_LOCAL", filesystem_options={"s3": {"nope": 1}})) == ("file:///a", {})
    assert resolve_path("data/x", common()) == ("data/x", {})
    assert resolve_path("s3://b/k", common(filesystem="S3")) == ("s3a://b/k", {})
    for path, fields in (("/a", {"filesystem": "S3"}), ("gs://b", {"filesystem": "HDFS"}), ("/a", {"filesystem_options": {"s3": {}}}),
                         ("s3://b", {"filesystem_options": {"s3": {}, "gcs": {}}}), ("s3://b", {"filesystem_options": {"ftp": {}}})):
        with pytest.raises(ConfigError):
            resolve_path(path, common(**fields))


def settings_of(path, kind, **values):
    return resolve_path(path, common(filesystem_options={kind: values}))[1]


def test_s3_options():
    assert settings_of("s3://b/k", "s3") == {}  # unset means default
    found = settings_of("s3://b/k", "s3", region="us-east-1", endpoint_override="localhost:9000", scheme="http", connect_timeout=1.5,
                        credentials_kind="S3_CREDENTIALS_KIND_ANONYMOUS", proxy_options={"host": "p", "port": 1})
    assert found["fs.s3a.endpoint.region"] == "us-east-1" and found["fs.s3a.connection.ssl.enabled"] == "false"
    assert found["fs.s3a.connection.establish.timeout"] == "1500ms" and found["fs.s3a.path.style.access"] == "true"
    assert "Anonymous" in found["fs.s3a.aws.credentials.provider"] and found["fs.s3a.proxy.port"] == "1"
    role = settings_of("s3://b/k", "s3", credentials_kind="ROLE", role_arn="arn", session_name="n")
    assert role["fs.s3a.assumed.role.arn"] == "arn"
    for bad in ({"credentials_kind": "ROLE"}, {"credentials_kind": "EXPLICIT"}, {"tls_verify_certificates": False}, {"x": 1}):
        with pytest.raises(ConfigError):
            settings_of("s3://b/k", "s3", **bad)


def test_gcs_options():
    assert settings_of("gs://b/k", "gcs", credentials={"anonymous": True}, project_id="p") == {
        "fs.gs.auth.type": "UNAUTHENTICATED", "fs.gs.project.id": "p"
    }
    key = json.dumps({"client_email": "e", "private_key_id": "i", "private_key": "k"})
    assert settings_of("gs://b/k", "gcs", credentials={"json_credentials": key})["fs.gs.auth.service.account.email"] == "e"
    with pytest.raises(ConfigError):
        settings_of("gs://b/k", "gcs", credentials={"access_token": "t"})


@pytest.mark.parametrize(
    ("kind", "extra", "setting"),
    [
        ("DEFAULT", {}, "fs.azure.account.auth.type.acc.dfs.core.windows.net"),
        ("STORAGE_SHARED_KEY", {"storage_shared_key": "k"}, "fs.azure.account.key.acc.dfs.core.windows.net"),
        ("SAS_TOKEN", {"sas_token": "t"}, "fs.azure.sas.fixed.token.acc.dfs.core.windows.net"),
        ("CLIENT_SECRET", {"tenant_id": "t", "client_id": "c", "client_secret": "s"},
         "fs.azure.account.oauth2.client.secret.acc.dfs.core.windows.net"),
        ("MANAGED_IDENTITY", {"client_id": "c"}, "fs.azure.account.oauth2.client.id.acc.dfs.core.windows.net"),
        ("WORKLOAD_IDENTITY", {"client_id": "c"}, "fs.azure.account.oauth.provider.type.acc.dfs.core.windows.net"),
    ],
)
def test_azure_options(kind, extra, setting):
    credentials = {"kind": f"AZURE_CREDENTIAL_KIND_{kind}", **extra}
    assert setting in settings_of("abfss://c@acc.dfs.core.windows.net/k", "azure", account_name="acc", credentials=credentials)


@pytest.mark.parametrize("kind", ["ANONYMOUS", "CLI", "ENVIRONMENT", "SAS_TOKEN"])
def test_azure_options_that_cannot_work(kind):
    with pytest.raises(ConfigError):
        settings_of("abfss://c@a/k", "azure", account_name="acc", credentials={"kind": kind})


def test_hdfs_options():
    conn = {"host": "n", "port": 8020, "kerb_ticket": "/t", "extra_conf": {"dfs.x": "1"}}
    assert settings_of("hdfs://n/k", "hdfs", connection_config=conn, replication=2) == {
        "fs.defaultFS": "hdfs://n:8020", "hadoop.security.kerberos.ticket.cache.path": "/t", "dfs.replication": "2", "dfs.x": "1"
    }


def test_codecs():
    assert resolve_codec("a.csv.gz", "AUTO") == "GZIP" and resolve_codec("a.csv", "AUTO") == "UNCOMPRESSED"
    assert resolve_codec("a.gz", "ZSTD") == "ZSTD" and resolve_codec("a.zst", "AUTO") == "ZSTD"
    assert parquet_codec("AUTO") == "uncompressed" and orc_codec("AUTO") == "none" and orc_codec("GZIP") == "zlib"
    for call, bad in ((parquet_codec, "BROTLI"), (parquet_codec, "BZ2"), (orc_codec, "BROTLI")):
        with pytest.raises(ConfigError):
            call(bad)
