"""Pipelines described as data: named queues, and steps that read and fill them.

Each queue names a DataFrame. A step that fills a queue defines it, the one step
that reads the queue consumes it, and sinks run the job. Thread counts are
accepted but not used: Spark sizes its tasks by the data. The capacity of a queue
that files are streamed into is the number of files per micro-batch.
"""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.config import require, section
from millrace.errors import ConfigError
from millrace.operators.payload import arrow_decode, arrow_encode, payload_schema
from millrace.operators.tables import strict_concat
from millrace.plans import registry
from millrace.plans.registry import IMAGE, PAYLOAD, SINK, SOURCE, TABLE
from millrace.session import prepare
from millrace.sinks.parquet import stream_parquet


def load_flow(path: str) -> dict[str, Any]:
    """A flow from a YAML or JSON file."""
    import yaml

    return yaml.safe_load(Path(path).read_text())


def check_flow(flow: Mapping[str, Any]) -> list[dict[str, Any]]:
    """Check a whole flow and return its steps, each after the steps it reads from.

    A step that fills a queue carries the queue's ``capacity``.
    """
    flow = section("flow", flow, {"queues": [], "stages": [], "name": ""})
    queues = {}
    for value in flow["queues"]:
        queue = section("queue", value, {"name": "", "capacity": 1, "type": "", "schema": ""})
        require("queue", queue, "name")
        if queue["capacity"] <= 0:
            raise ConfigError(f"queue {queue['name']}: capacity must be positive")
        queues[queue["name"]] = queue["capacity"]
    steps = []
    for value in flow["stages"]:
        item = section(
            "stage", value, {"name": "", "type": "", "threads": 1, "input_queue": "", "output_queue": "", "config": {}}
        )
        require("stage", item, "name", "type")
        if item["threads"] <= 0:
            raise ConfigError(f"stage {item['name']}: threads must be positive")
        kind = registry.step(item["type"])
        for end, needed in (("input_queue", kind.kind != SOURCE), ("output_queue", kind.kind != SINK)):
            if needed != bool(item[end]):
                raise ConfigError(f"stage {item['name']}: a {kind.kind} {'needs an' if needed else 'has no'} {end}")
            if needed and item[end] not in queues:
                raise ConfigError(f"stage {item['name']}: unknown queue {item[end]}")
        if kind.check is not None:
            kind.check(item["config"])
        steps.append({**item, "capacity": queues.get(item["output_queue"])})
    require("flow", {"stages": steps}, "stages")
    return _ordered(steps)


def _ordered(steps: list[dict[str, Any]]) -> list[dict[str, Any]]:
    readers: dict[str, str] = {}
    for item in steps:
        if item["input_queue"]:
            if item["input_queue"] in readers:
                raise ConfigError(f"queue {item['input_queue']} has two readers: {readers[item['input_queue']]}, {item['name']}")
            readers[item["input_queue"]] = item["name"]
    done, ordered, waiting = set(), [], list(steps)
    while waiting:
        unfinished = {item["output_queue"] for item in waiting if item["output_queue"]}
        ready = [item for item in waiting if not item["input_queue"] or item["input_queue"] not in unfinished]
        if not ready:
            raise ConfigError("the stages form a circle: " + ", ".join(item["name"] for item in waiting))
        for item in ready:
            if item["input_queue"] and item["input_queue"] not in done:
                raise ConfigError(f"stage {item['name']}: nothing fills queue {item['input_queue']}")
        ordered += ready
        done |= {item["output_queue"] for item in ready}
        waiting = [item for item in waiting if item not in ready]
    return ordered


def plan_flow(spark: SparkSession, flow: Mapping[str, Any], streaming: bool = False) -> dict[str, DataFrame]:
    """The DataFrame of every queue; nothing is written."""
    prepare(spark)
    queues, _ = _plan(spark, check_flow(flow), streaming)
    return {name: table for name, (_, table) in queues.items()}


def run_flow(
    spark: SparkSession, flow: Mapping[str, Any], streaming: bool = False, checkpoint: str | None = None
) -> list[Any]:
    """Run every sink of a flow.

    Batch: returns when all is written. Streaming: takes what is there, keeps
    positions below ``checkpoint``, and returns the finished queries; sinks that
    write files have one folder per micro-batch, so a repeated batch replaces
    itself. A file sink without ``append`` leaves the last payload of each path.
    """
    prepare(spark)
    steps = check_flow(flow)
    if streaming and not checkpoint:
        raise ConfigError("a streaming flow needs a checkpoint folder")
    queues, sinks = _plan(spark, steps, streaming)
    results = []
    for item in sinks:
        step = registry.step(item["type"])
        kind, table = queues[item["input_queue"]]
        rows = _as(table, kind, step.takes, item)
        if streaming:
            results.append(_stream(rows, item, step, f"{checkpoint}/{item['name']}"))
        else:
            step.run(rows, item["config"])
    for query in results:
        query.awaitTermination()
    return results


def _plan(spark: SparkSession, steps: list[dict[str, Any]], streaming: bool):
    filled: dict[str, list[tuple[str, DataFrame]]] = {}
    readers = {item["input_queue"]: item for item in steps if item["input_queue"]}
    sinks = []

    def queue(name: str) -> tuple[str, DataFrame]:
        parts = filled[name]
        return parts[0][0], strict_concat([table for _, table in parts])

    for item in steps:
        step = registry.step(item["type"])
        if step.kind == SINK:
            sinks.append(item)
            continue
        if step.kind == SOURCE:
            reader = readers.get(item["output_queue"])
            if step.gives == PAYLOAD and registry.step_name(item["type"]) == "file_source" and reader is not None \
                    and registry.step(reader["type"]).takes == IMAGE:
                entry = (IMAGE, registry.read_image_files(spark, item["config"], streaming, item["capacity"] if streaming else None))
            else:
                more = {}
                if streaming and registry.step_name(item["type"]) in registry.FILE_SOURCES:
                    more = {"max_files": item["capacity"]}
                entry = (step.gives, step.run(spark, item["config"], streaming, **more))
                if step.gives == TABLE and reader is not None and registry.step(reader["type"]).takes == PAYLOAD:
                    entry = (PAYLOAD, arrow_encode(entry[1], _batch_rows(item["config"])).select("payload"))
        else:
            kind, table = queue(item["input_queue"])
            entry = (step.gives, step.run(_as(table, kind, step.takes, item), item["config"]))
            if step.gives == IMAGE:
                reader = readers.get(item["output_queue"])
                if reader is not None and registry.step(reader["type"]).takes != IMAGE:
                    entry = (PAYLOAD, registry.image_payloads(entry[1], item["config"].get("output_format", "")))
        filled.setdefault(item["output_queue"], []).append(entry)
    return {name: queue(name) for name in filled}, sinks


def _batch_rows(config: Mapping[str, Any]) -> int | None:
    """Rows per Arrow payload where a source is to give single record batches."""
    if str(config.get("output_type", "")).upper().endswith("RECORD_BATCH"):
        return config.get("batch_size")
    return None


def _as(table: DataFrame, kind: str, wanted: str, item: Mapping[str, Any]) -> DataFrame:
    """Rows in the form the next step takes: tables become Arrow payloads and back."""
    if kind == wanted:
        return table
    if kind == TABLE and wanted == PAYLOAD:
        return arrow_encode(table).select("payload")
    if kind == PAYLOAD and wanted == TABLE:
        return arrow_decode(table, payload_schema(table))
    raise ConfigError(f"stage {item['name']} takes {wanted} rows, its queue has {kind} rows")


def _stream(rows: DataFrame, item: Mapping[str, Any], step, checkpoint: str):
    name, config = registry.step_name(item["type"]), dict(item["config"])
    if name in ("kafka_sink", "redis_stream_sink", "redis_pubsub_sink", "nats_sink", "jetstream_sink", "http_sink"):
        return step.run(rows, config, checkpoint)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name == "parquet_sink" and config.get("write_opts"):
        return stream_parquet(rows, config, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        folder = dict(config)
        # A payload of a file sink replaces the file, whatever batch it comes in.
        if "path" in folder and not (name == "file_sink" and not folder.get("append")):
            folder["path"] = f"{folder['path'].rstrip('/')}/batch-{number:012d}"
        step.run(batch, folder)

    return writer.foreachBatch(write).start()
