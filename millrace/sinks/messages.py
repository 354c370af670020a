"""Payloads → frames of the messages a broker or endpoint is sent.

A frame is an ordinary DataFrame: it is built by column expressions, can be
looked at or stored, and is sent by :func:`millrace.streaming.publish.publish`.
All frames but the HTTP one leave empty payloads out.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import enum, non_negative, require, section
from millrace.errors import ConfigError
from millrace.operators.payload import drop_empty

# Default addresses, timeouts and names.
NATS_URL = "nats://127.0.0.1:4222"
REDIS_HOST, REDIS_PORT, REDIS_CONNECT_MS = "127.0.0.1", 6379, 2000
FLUSH_MS = 1000
HTTP_TIMEOUT_MS = 5000
HTTP_CONTENT_TYPE = "application/json"
HTTP_METHODS = ("UNSPECIFIED", "POST", "PUT")
_REDIS_FIELDS = {"host": "", "port": 0, "username": "", "password": "", "database": 0}


def redis_settings(step: str, cfg: Mapping[str, Any]) -> dict[str, Any]:
    """Connection settings with their defaults; a user name needs a password."""
    if cfg["username"] and not cfg["password"]:
        raise ConfigError(f"{step}: username needs a password")
    return {
        "host": cfg["host"] or REDIS_HOST,
        "port": cfg["port"] or REDIS_PORT,
        "username": cfg["username"],
        "password": cfg["password"],
        "database": cfg["database"],
        "connect_ms": REDIS_CONNECT_MS,
        "command_ms": cfg.get("command_timeout_ms") or None,
    }


# ------------------------------------------------------------------- Kafka
def kafka_sink_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(
        "kafka_sink", config, {"brokers": "", "topic": "", "client_id": "", "partition": None, "producer_config": {}}
    )
    require("kafka_sink", cfg, "brokers", "topic")
    return cfg


def kafka_records(df: DataFrame, config: Mapping[str, Any], keys: tuple[str, ...] = ()) -> DataFrame:
    """``(topic, partition, value)``; a null partition is left to the partitioner.

    An unset or negative partition means the partitioner.
    """
    cfg = kafka_sink_config(config)
    partition = cfg["partition"] if cfg["partition"] is not None and cfg["partition"] >= 0 else None
    return drop_empty(df).select(
        *keys,
        F.lit(cfg["topic"]).alias("topic"),
        F.lit(partition).cast("int").alias("partition"),
        F.col("payload").alias("value"),
    )


def kafka_writer_options(config: Mapping[str, Any]) -> dict[str, str]:
    cfg = kafka_sink_config(config)
    options = {"kafka.bootstrap.servers": cfg["brokers"], "kafka.delivery.timeout.ms": "120000"}
    if cfg["client_id"]:
        options["kafka.client.id"] = cfg["client_id"]
    options |= {f"kafka.{name}": str(value) for name, value in cfg["producer_config"].items()}
    return options


def write_kafka(df: DataFrame, config: Mapping[str, Any], checkpoint: str | None = None):
    """Send payloads with Spark's Kafka writer (its package must be on the class path)."""
    records, options = kafka_records(df, config), kafka_writer_options(config)
    if not df.isStreaming:
        return records.write.format("kafka").options(**options).save()
    require("kafka_sink", {"checkpoint": checkpoint}, "checkpoint")
    writer = records.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


# ------------------------------------------------------------------- Redis
def redis_stream_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(
        "redis_stream_sink",
        config,
        {**_REDIS_FIELDS, "stream": "", "field_name": "", "maxlen": 0, "maxlen_approx": False, "id": "", "command_timeout_ms": 0},
    )
    require("redis_stream_sink", cfg, "stream")
    non_negative("redis_stream_sink", cfg, "command_timeout_ms")
    return cfg | {"settings": redis_settings("redis_stream_sink", cfg)}


def redis_xadd(df: DataFrame, config: Mapping[str, Any], keys: tuple[str, ...] = ()) -> DataFrame:
    """``(command, payload)``: the words of an XADD command; the payload is its last argument."""
    cfg = redis_stream_config(config)
    words = ["XADD", cfg["stream"]]
    if cfg["maxlen"] > 0:
        words += ["MAXLEN", "~" if cfg["maxlen_approx"] else "=", str(cfg["maxlen"])]
    words += [cfg["id"] or "*", cfg["field_name"] or "data"]
    return _command(df, words, keys)


def redis_publish(df: DataFrame, config: Mapping[str, Any], keys: tuple[str, ...] = ()) -> DataFrame:
    """``(command, payload)``: the words of a PUBLISH command."""
    cfg = redis_pubsub_config(config)
    return _command(df, ["PUBLISH", cfg["channel"]], keys)


def redis_pubsub_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section("redis_pubsub_sink", config, {**_REDIS_FIELDS, "channel": "", "command_timeout_ms": 0})
    require("redis_pubsub_sink", cfg, "channel")
    non_negative("redis_pubsub_sink", cfg, "command_timeout_ms")
    return cfg | {"settings": redis_settings("redis_pubsub_sink", cfg)}


def _command(df: DataFrame, words: list[str], keys: tuple[str, ...]) -> DataFrame:
    return drop_empty(df).select(*keys, F.array(*map(F.lit, words)).alias("command"), "payload")


# -------------------------------------------------------------------- NATS
def nats_config(config: Mapping[str, Any], step: str = "nats_sink") -> dict[str, Any]:
    fields = {"url": "", "subject": ""}
    if step == "nats_sink":
        fields["flush_timeout_ms"] = 0
    cfg = section(step, config, fields)
    require(step, cfg, "subject")
    non_negative(step, cfg, *[name for name in ("flush_timeout_ms",) if name in cfg])
    cfg["url"] = cfg["url"] or NATS_URL
    cfg["settings"] = {"url": cfg["url"], "flush_ms": cfg.get("flush_timeout_ms") or FLUSH_MS}
    return cfg


def nats_publish(df: DataFrame, config: Mapping[str, Any], keys: tuple[str, ...] = (), step: str = "nats_sink") -> DataFrame:
    """``(subject, payload)``, for core NATS and for JetStream."""
    cfg = nats_config(config, step)
    return drop_empty(df).select(*keys, F.lit(cfg["subject"]).alias("subject"), "payload")


# -------------------------------------------------------------------- HTTP
def http_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(
        "http_sink", config, {"url": "", "method": "UNSPECIFIED", "content_type": "", "timeout_ms": 0, "headers": []}
    )
    require("http_sink", cfg, "url")
    non_negative("http_sink", cfg, "timeout_ms")
    method = enum("http_sink", cfg["method"], "METHOD_", HTTP_METHODS)
    cfg["method"] = "POST" if method == "UNSPECIFIED" else method
    headers = [{"name": "Content-Type", "value": cfg["content_type"] or HTTP_CONTENT_TYPE}]
    for value in cfg["headers"]:
        header = section("http_sink.headers", value, {"name": "", "value": ""})
        if header["name"]:
            headers.append(header)
    cfg["headers"] = headers
    cfg["settings"] = {"timeout_ms": cfg["timeout_ms"] or HTTP_TIMEOUT_MS}
    return cfg


def http_requests(df: DataFrame, config: Mapping[str, Any], keys: tuple[str, ...] = ()) -> DataFrame:
    """``(method, url, headers, payload)``; empty payloads are sent too."""
    cfg = http_config(config)
    headers = F.array(
        *[F.struct(F.lit(h["name"]).alias("name"), F.lit(h["value"]).alias("value")) for h in cfg["headers"]]
    )
    return df.select(
        *keys, F.lit(cfg["method"]).alias("method"), F.lit(cfg["url"]).alias("url"), headers.alias("headers"), "payload"
    )
