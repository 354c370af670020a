"""Kafka topics as payload streams."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import require, section
from millrace.errors import ConfigError

STEP = "kafka_source"


def kafka_options(config: Mapping[str, Any]) -> dict[str, str]:
    """Options of Spark's Kafka reader for a consumer configuration.

    A partition of zero or more reads that partition only; otherwise the topic
    is subscribed. Offsets live in the query's checkpoint; the group id is
    passed on for access control and monitoring.
    """
    cfg = section(
        STEP,
        config,
        {"brokers": "", "topic": "", "group_id": "", "client_id": "", "partition": None, "auto_offset_reset": "",
         "poll_timeout_ms": 1000, "consumer_config": {}},
    )
    require(STEP, cfg, "brokers", "topic", "group_id")
    options = {"kafka.bootstrap.servers": cfg["brokers"], "kafka.group.id": cfg["group_id"]}
    if cfg["partition"] is not None and cfg["partition"] >= 0:
        options["assign"] = json.dumps({cfg["topic"]: [cfg["partition"]]})
    else:
        options["subscribe"] = cfg["topic"]
    extra = dict(cfg["consumer_config"])
    reset = cfg["auto_offset_reset"] or extra.pop("auto.offset.reset", "") or "latest"
    for name in ("auto.offset.reset", "enable.auto.commit"):  # Spark keeps the offsets
        extra.pop(name, None)
    reset = {"smallest": "earliest", "beginning": "earliest", "largest": "latest", "end": "latest"}.get(reset, reset)
    if reset not in ("earliest", "latest"):
        raise ConfigError(f"{STEP}: auto_offset_reset must be earliest or latest, got {reset}")
    options["startingOffsets"] = reset
    if cfg["poll_timeout_ms"] > 0:
        options["kafkaConsumer.pollTimeoutMs"] = str(cfg["poll_timeout_ms"])
    if cfg["client_id"]:
        options["kafka.client.id"] = cfg["client_id"]
    for name, value in extra.items():
        options[f"kafka.{name}"] = str(value)
    return options


def kafka_batch_options(config: Mapping[str, Any]) -> dict[str, str]:
    """The same for a batch read. Spark has no batch that starts at the end, where nothing would be left to read."""
    named = config.get("auto_offset_reset") or (config.get("consumer_config") or {}).get("auto.offset.reset")
    options = kafka_options(config)
    if named and options["startingOffsets"] == "latest":
        raise ConfigError(f"{STEP}: a batch read from the latest offset has no messages; use earliest, or read a stream")
    return options | {"startingOffsets": "earliest", "endingOffsets": "latest"}


def read_kafka(spark: SparkSession, config: Mapping[str, Any], streaming: bool = True) -> DataFrame:
    """Message values as ``payload``. Needs Spark's Kafka package on the class path.

    A batch read takes what the topic holds, so that it starts with the earliest message; ``latest`` is an error there.
    """
    options = kafka_options(config) if streaming else kafka_batch_options(config)
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load().select(F.col("value").alias("payload"))
