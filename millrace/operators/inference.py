"""Scoring tensors with an ONNX model."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import require, section
from millrace.errors import ConfigError
from millrace.operators.images import BATCH_BYTES, blob_bytes, blob_config, image_pixels, map_images, pixels_blob

# A model is sent to every executor; larger ones must be on the executors' disks.
MODEL_BYTES = 1 << 30
TENSORS = "array<struct<name: string, shape: array<int>, data: array<float>>>"
_ARROW_TENSORS = pa.list_(
    pa.struct([("name", pa.string()), ("shape", pa.list_(pa.int32())), ("data", pa.list_(pa.float32()))])
)
_BLOB_FIELDS = ("input_width", "input_height", "scale", "mean_values", "swap_rb", "crop")
_sessions: dict[tuple[int, int], Any] = {}


def load_model(spark: SparkSession, path: str):
    """Broadcast the bytes of a model file, whose size is checked first."""
    files = spark.read.format("binaryFile").load(path)
    size = files.select("length").first()
    if size is None:
        raise ConfigError(f"model does not exist: {path}")
    if size.length > MODEL_BYTES:
        raise ConfigError(f"model of {size.length} bytes is too large to broadcast")
    return spark.sparkContext.broadcast(bytes(files.select("content").first().content))


def score(
    data: Column, shape: Column | Sequence[int], model, input_name: str = "", output_names: Sequence[str] = ()
) -> Column:
    """Float array and its shape → output tensors ``array<struct(name, shape, data)>``.

    ``model`` is a broadcast of the model's bytes; each Python worker loads it
    once. Rows of equal shape are scored together where the model allows it. The
    first dimension of every shape is the batch of one that a single row is.
    """
    if not isinstance(shape, Column):
        shape = F.array(*[F.lit(int(n)) for n in shape])

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        session = _session(model)
        ends = _ends(session, input_name, output_names)
        for values, shapes in batches:
            yield _score_batch(session, *ends, values, shapes)

    return F.arrow_udf(run, TENSORS)(data, shape)


def _ends(session, input_name: str, output_names: Sequence[str]):
    """Input name, output names, their labels, and whether the batch size is free."""
    inputs = {i.name: i for i in session.get_inputs()}
    if input_name and input_name not in inputs:
        raise ConfigError(f"the model has no input {input_name}")
    chosen = inputs[input_name] if input_name else session.get_inputs()[0]
    outputs = list(output_names) or [o.name for o in session.get_outputs()]
    labels = list(output_names) or (["output"] if len(outputs) == 1 else outputs)
    return chosen.name, outputs, labels, not isinstance(chosen.shape[0], int)


def _session(model):
    import onnxruntime

    key = (len(model.value), hash(model.value))
    if key not in _sessions:
        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = 1  # Spark runs one task per core
        _sessions.clear()
        _sessions[key] = onnxruntime.InferenceSession(model.value, options, providers=["CPUExecutionProvider"])
    return _sessions[key]


def _score_batch(session, input_name, outputs, labels, several, values: pa.Array, shapes: pa.Array) -> pa.Array:
    groups: dict[tuple[int, ...], list[int]] = {}
    for row, shape in enumerate(shapes):
        if shape.is_valid and values[row].is_valid:
            groups.setdefault(tuple(shape.as_py()), []).append(row)
    results: list[list[dict[str, Any]] | None] = [None] * len(values)
    for shape, rows in groups.items():
        step = max(1, BATCH_BYTES // (4 * int(np.prod(shape)))) if several else 1
        for start in range(0, len(rows), step):
            members = rows[start:start + step]
            tensors = [values[r].values.to_numpy(zero_copy_only=False).astype(np.float32).reshape(shape) for r in members]
            for row, tensors_out in zip(members, _run(session, input_name, outputs, labels, tensors)):
                results[row] = tensors_out
    return pa.array(results, _ARROW_TENSORS)


def _run(session, input_name, outputs, labels, tensors: list[np.ndarray]) -> Iterator[list[dict[str, Any]]]:
    """Output tensors per input; the inputs have one shape and are scored at once."""
    found = session.run(outputs, {input_name: np.concatenate(tensors)})
    for position in range(len(tensors)):
        yield [
            _tensor(label, value[position:position + 1] if len(tensors) > 1 else value)
            for label, value in zip(labels, found)
        ]


def _tensor(name: str, value: np.ndarray) -> dict[str, Any]:
    value = np.asarray(value)
    return {"name": name, "shape": list(value.shape), "data": value.astype(np.float32).ravel()}


def tensor_json(tensors: str | Column) -> Column:
    """Output tensors → JSON ``{name: {"shape": [...], "data": [...]}}``."""
    column = F.col(tensors) if isinstance(tensors, str) else tensors
    entries = F.transform(
        column, lambda t: F.struct(t["name"], F.struct(t["shape"].alias("shape"), t["data"].alias("data")))
    )
    return F.to_json(F.map_from_entries(entries))


def inference_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(
        "dnn_inference",
        config,
        {"model_path": "", "config_path": "", "framework": "", "input_width": 0, "input_height": 0, "scale": 0.0,
         "mean_values": [], "swap_rb": False, "crop": False, "input_name": "", "output_names": []},
    )
    require("dnn_inference", cfg, "model_path")
    if cfg["config_path"] or cfg["framework"] not in ("", "onnx"):
        raise ConfigError("dnn_inference: models must be ONNX files")
    return cfg


def infer_images(df: DataFrame, config: Mapping[str, Any], image: str = "image", output: str = "json") -> DataFrame:
    """Image structs → JSON of the model's outputs; null for an image that is not valid.

    An image's tensor only lives until it is scored.
    """
    cfg = inference_config(config)
    model = load_model(df.sparkSession, cfg["model_path"])
    blob_cfg = blob_config({name: cfg[name] for name in _BLOB_FIELDS})
    input_name, output_names = cfg["input_name"], list(cfg["output_names"])

    def convert(value) -> list[dict[str, Any]] | None:
        pixels = image_pixels(value)
        if pixels is None:
            return None
        session = _session(model)
        name, outputs, labels, _ = _ends(session, input_name, output_names)
        return next(_run(session, name, outputs, labels, [pixels_blob(pixels, blob_cfg)]))

    scored = map_images(df, image, output, TENSORS, _ARROW_TENSORS, convert, blob_bytes(blob_cfg))
    return scored.withColumn(output, tensor_json(output))
