"""ONNX files of linear models, for scoring without a model of one's own."""

from __future__ import annotations

import numpy as np

# Field numbers and codes of the public ONNX file format.
_FLOAT, _IR_VERSION, _OPSET = 1, 8, 13


def linear_model(weights: np.ndarray, shape: tuple[int, ...] | None = None) -> bytes:
    """Model with input ``input`` of ``[n, inputs]`` and output ``scores`` of ``[n, k]``.

    With ``shape`` the input is ``[n, *shape]`` and is flattened first.
    """
    weights = np.ascontiguousarray(weights, np.float32)
    inputs, outputs = weights.shape
    tensor = (
        b"".join(_number(1, side) for side in weights.shape)
        + _number(2, _FLOAT) + _text(8, "weights") + _bytes(9, weights.tobytes())
    )
    flatten = _node("Flatten", ["input"], "flat") if shape else b""
    graph = (
        flatten + _node("MatMul", ["flat" if shape else "input", "weights"], "scores") + _text(2, "linear")
        + _bytes(5, tensor) + _bytes(11, _value("input", *(shape or (inputs,)))) + _bytes(12, _value("scores", outputs))
    )
    return _number(1, _IR_VERSION) + _bytes(8, _number(2, _OPSET)) + _bytes(7, graph)


def _node(kind: str, inputs: list[str], output: str) -> bytes:
    return _bytes(1, b"".join(_text(1, name) for name in inputs) + _text(2, output) + _text(4, kind))


def _value(name: str, *sizes: int) -> bytes:
    shape = _bytes(1, _text(2, "n")) + b"".join(_bytes(1, _number(1, size)) for size in sizes)
    return _text(1, name) + _bytes(2, _bytes(1, _number(1, _FLOAT) + _bytes(2, shape)))


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _text(field: int, value: str) -> bytes:
    return _bytes(field, value.encode())
