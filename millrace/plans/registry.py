"""The steps a pipeline can name, and how to add one's own."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import ConfigError
from millrace.operators.images import encode_images, read_images, resize_config, resize_images
from millrace.operators.inference import inference_config, infer_images
from millrace.sinks import messages
from millrace.sinks.csv import csv_sink_config, write_csv
from millrace.sinks.files import files_config, write_files
from millrace.sinks.orc import orc_sink_config, write_orc
from millrace.sinks.parquet import parquet_sink_config, write_parquet
from millrace.sources.csv import csv_config, read_csv
from millrace.sources.files import file_config, read_files
from millrace.sources.json import json_config, read_json
from millrace.sources.kafka import kafka_options, read_kafka
from millrace.sources.orc import orc_config, read_orc
from millrace.sources.parquet import parquet_config, read_parquet
from millrace.storage import use_storage
from millrace.streaming.log_source import jetstream_config, read_jetstream, read_redis_stream, redis_stream_source_config
from millrace.streaming.publish import publish

SOURCE, TRANSFORM, SINK = "source", "transform", "sink"
TABLE, PAYLOAD, IMAGE = "table", "payload", "image"


@dataclass(frozen=True)
class Step:
    """A step: what it does, what its rows are before and after, and the check
    of its configuration that runs before anything is read."""

    kind: str
    run: Callable[..., Any]
    takes: str | None = None
    gives: str | None = None
    check: Callable[[Mapping[str, Any]], Any] | None = None


_steps: dict[str, Step] = {}
_aliases: dict[str, str] = {}


def register_source(
    name: str, run: Callable[[SparkSession, Mapping[str, Any], bool], DataFrame], gives: str = TABLE, check=None
) -> None:
    _steps[name] = Step(SOURCE, run, gives=gives, check=check)


def register_transform(
    name: str, run: Callable[[DataFrame, Mapping[str, Any]], DataFrame], takes: str = TABLE, gives: str = TABLE, check=None
) -> None:
    _steps[name] = Step(TRANSFORM, run, takes, gives, check)


def register_sink(name: str, run: Callable[[DataFrame, Mapping[str, Any]], Any], takes: str = TABLE, check=None) -> None:
    _steps[name] = Step(SINK, run, takes, check=check)


def step(name: str) -> Step:
    found = _steps.get(_aliases.get(name, name))
    if found is None:
        raise ConfigError(f"unknown step type {name}" + _UNAVAILABLE.get(name, ""))
    return found


def step_name(name: str) -> str:
    return _aliases.get(name, name)


# Live sockets and subscriptions have no replayable position, so no job can
# recover them after a lost executor; their message operators are in
# millrace.operators instead.
_UNAVAILABLE = {
    "nats_source": ": land the subject in a log and use queue_group on it",
    "redis_pubsub_source": ": land the channel in a log and use channel_messages on it",
    "tcp_source": ": land the bytes in files and use byte_chunks on them",
    "udp_source": ": land the datagrams in files and use byte_cap on them",
    "tcp_sink": ": use file_sink or kafka_sink",
    "udp_sink": ": use file_sink or kafka_sink",
}


FILE_SOURCES = ("csv_source", "json_source", "parquet_source", "orc_source", "file_source")


def _resize(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    return resize_images(df.select("image"), config).where("image IS NOT NULL")


def _infer(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    scored = infer_images(df.select("image"), config)
    return scored.select(F.encode("json", "UTF-8").alias("payload")).where("payload IS NOT NULL")


def image_payloads(df: DataFrame, output_format: str) -> DataFrame:
    return df.select(encode_images("image", output_format).alias("payload")).where("payload IS NOT NULL")


def read_image_files(spark: SparkSession, config: Mapping[str, Any], streaming: bool = False, max_files: int | None = None) -> DataFrame:
    cfg = file_config(config)
    return read_images(spark, use_storage(spark, cfg["path"], cfg["common"]), streaming=streaming, max_files=max_files)


def _sender(frame, configure, client: str):
    def run(df: DataFrame, config: Mapping[str, Any], checkpoint: str | None = None):
        config = dict(config)
        chosen = config.pop("client", client)
        settings = configure(config)["settings"]
        return publish(frame(df, config), chosen, settings, checkpoint)

    def check(config: Mapping[str, Any]):
        return configure({name: value for name, value in config.items() if name != "client"})

    return run, check


def _register_built_in() -> None:
    register_source("csv_source", read_csv, check=csv_config)
    register_source("json_source", read_json, check=json_config)
    register_source("parquet_source", read_parquet, check=parquet_config)
    register_source("orc_source", read_orc, check=orc_config)
    register_source("file_source", read_files, gives=PAYLOAD, check=file_config)
    register_source("kafka_source", read_kafka, gives=PAYLOAD, check=kafka_options)
    register_source("jetstream_source", read_jetstream, gives=PAYLOAD, check=jetstream_config)
    register_source("redis_stream_source", read_redis_stream, gives=PAYLOAD, check=redis_stream_source_config)
    register_transform("resize_letterbox", _resize, takes=IMAGE, gives=IMAGE, check=resize_config)
    register_transform("dnn_inference", _infer, takes=IMAGE, gives=PAYLOAD, check=inference_config)
    register_sink("csv_sink", write_csv, check=csv_sink_config)
    register_sink("parquet_sink", write_parquet, check=parquet_sink_config)
    register_sink("orc_sink", write_orc, check=orc_sink_config)
    register_sink("file_sink", write_files, takes=PAYLOAD, check=files_config)
    register_sink("kafka_sink", messages.write_kafka, takes=PAYLOAD, check=messages.kafka_sink_config)
    clients = "millrace.streaming.clients:"
    for name, frame, configure, client in (
        ("redis_stream_sink", messages.redis_xadd, messages.redis_stream_config, "RedisClient"),
        ("redis_pubsub_sink", messages.redis_publish, messages.redis_pubsub_config, "RedisClient"),
        ("nats_sink", messages.nats_publish, messages.nats_config, "NatsClient"),
        ("jetstream_sink", lambda df, config: messages.nats_publish(df, config, step="nats_jetstream_sink"),
         lambda config: messages.nats_config(config, "nats_jetstream_sink"), "JetStreamClient"),
        ("http_sink", messages.http_requests, messages.http_config, "HttpClient"),
    ):
        run, check = _sender(frame, configure, clients + client)
        register_sink(name, run, takes=PAYLOAD, check=check)
    # Type names that existing flow files use.
    _aliases.update(
        {
            "csv_arrow_source": "csv_source",
            "csv_arrow_sink": "csv_sink",
            "json_arrow_source": "json_source",
            "parquet_arrow_source": "parquet_source",
            "parquet_arrow_sink": "parquet_sink",
            "orc_arrow_source": "orc_source",
            "orc_arrow_sink": "orc_sink",
            "nats_jetstream_source": "jetstream_source",
            "nats_jetstream_sink": "jetstream_sink",
            "opencv_resize_letterbox_transform": "resize_letterbox",
            "opencv_dnn_inference_transform": "dnn_inference",
        }
    )


_register_built_in()
