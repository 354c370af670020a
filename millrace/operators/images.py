"""Image operators on Spark's image struct and on plain pixel arrays."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import enum, section
from millrace.errors import ConfigError

STEP = "resize_letterbox"
INTERPOLATIONS = ("UNSPECIFIED", "NEAREST", "LINEAR", "AREA", "CUBIC", "LANCZOS4")
IMAGE = "struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>"
_ARROW_IMAGE = pa.struct(
    [("origin", pa.string()), ("height", pa.int32()), ("width", pa.int32()),
     ("nChannels", pa.int32()), ("mode", pa.int32()), ("data", pa.binary())]
)
BATCH_BYTES = 64 << 20
STACK_NUMBERS = 4 << 20  # numbers, before or after, that are resampled together
_BGR_MODE = 16  # Fixed value: the mode code of three 8-bit channels in Spark's image schema.


# -------------------------------------------------------------- geometry
def letterbox_geometry(width: Column, height: Column, target_width: int, target_height: int) -> Column:
    """``struct(scale, width, height, offset_x, offset_y)`` of an image fitted
    into a target of other proportions. The scale is a 32-bit float."""
    def ratio(target: int, size: Column) -> Column:
        return (F.lit(target).cast("double") / size.cast("double")).cast("float")

    scale = F.least(ratio(target_width, width), ratio(target_height, height))

    def fitted(size: Column) -> Column:
        exact = (size.cast("float").cast("double") * scale.cast("double")).cast("float")
        return F.greatest(F.lit(1), F.floor(exact.cast("double") + 0.5).cast("int"))

    new_width, new_height = fitted(width), fitted(height)
    return F.struct(
        scale.alias("scale"),
        new_width.alias("width"),
        new_height.alias("height"),
        _half(F.lit(target_width) - new_width).alias("offset_x"),
        _half(F.lit(target_height) - new_height).alias("offset_y"),
    )


def _half(value: Column) -> Column:
    return F.floor(value / 2).cast("int")


def fitted_size(width: int, height: int, target_width: int, target_height: int) -> tuple[int, int]:
    """The same rule for one image inside a task."""
    scale = min(np.float32(target_width) / np.float32(width), np.float32(target_height) / np.float32(height))
    size = (float(np.float32(side) * np.float32(scale)) for side in (width, height))
    new_width, new_height = (max(1, int(np.floor(side + 0.5))) for side in size)
    return min(new_width, target_width), min(new_height, target_height)


# ------------------------------------------------------------- resampling
@lru_cache(maxsize=4096)
def taps(source: int, target: int, method: str) -> tuple[np.ndarray, np.ndarray]:
    """For each target position of one axis: source positions and their weights."""
    scale = source / target
    position = np.arange(target)
    if method == "NEAREST":
        return np.minimum((position * scale).astype(np.int64), source - 1)[:, None], np.ones((target, 1))
    if method == "AREA":  # share of each source pixel in the target pixel's span
        low, high = position * scale, np.minimum((position + 1) * scale, source)
        first = np.floor(low).astype(np.int64)
        index = first[:, None] + np.arange(int(np.ceil(scale)) + 1)
        share = np.minimum(high[:, None], index + 1) - np.maximum(low[:, None], index)
        weight = np.clip(share, 0, None)
        return np.minimum(index, source - 1), weight / weight.sum(axis=1, keepdims=True)
    if method == "AREA_UP":  # enlarging by area: sharp steps with a short blend
        base = np.floor(position * scale).astype(np.int64)
        blend = (position + 1) - (base + 1) / scale
        blend = np.where(blend <= 0, 0.0, blend - np.floor(blend))
        index, weight = base[:, None] + np.arange(2), np.stack([1 - blend, blend], axis=1)
        return np.clip(index, 0, source - 1), weight
    center = (position + 0.5) * scale - 0.5
    base = np.floor(center).astype(np.int64)
    offset = center - base
    if method == "LINEAR":
        reach = np.arange(0, 2)
        weight = np.stack([1 - offset, offset], axis=1)
    elif method == "CUBIC":
        reach = np.arange(-1, 3)
        weight = _cubic(np.abs(offset[:, None] - reach))
    else:
        reach = np.arange(-3, 5)
        distance = offset[:, None] - reach
        weight = np.sinc(distance) * np.sinc(distance / 4)
        weight = weight / weight.sum(axis=1, keepdims=True)
    return np.clip(base[:, None] + reach, 0, source - 1), weight


def _cubic(distance: np.ndarray, sharpness: float = -0.75) -> np.ndarray:
    near = ((sharpness + 2) * distance - (sharpness + 3)) * distance**2 + 1
    far = sharpness * (((distance - 5) * distance + 8) * distance - 4)
    return np.where(distance <= 1, near, np.where(distance < 2, far, 0.0))


def resample(pixels: np.ndarray, height: int, width: int, method: str) -> np.ndarray:
    """``(rows, columns, channels)`` pixels, or a stack of them, in another size; bytes stay bytes.

    The weights depend on the two sizes only, so that a stack takes as many array operations as one image.
    """
    rows, columns = pixels.shape[-3:-1]
    if (rows, columns) == (height, width):
        return pixels
    if method == "NEAREST":
        return pixels.take(taps(rows, height, method)[0][:, 0], axis=-3).take(taps(columns, width, method)[0][:, 0], axis=-2)
    if method == "AREA" and (height > rows or width > columns):
        method = "AREA_UP"
    result = _along(_along(pixels.astype(np.float64), -3, height, method), -2, width, method)
    if pixels.dtype == np.uint8:
        return np.clip(np.rint(result), 0, 255).astype(np.uint8)
    return result.astype(pixels.dtype)


def _along(values: np.ndarray, axis: int, target: int, method: str) -> np.ndarray:
    index, weight = taps(values.shape[axis], target, method)
    shape = (-1, 1, 1) if axis == -3 else (-1, 1)
    return sum(values.take(index[:, k], axis=axis) * weight[:, k].reshape(shape) for k in range(index.shape[1]))


# ------------------------------------------------------------- operators
def resize_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(
        STEP,
        config,
        {"output_width": 0, "output_height": 0, "resize_mode": "", "interpolation": "UNSPECIFIED", "pad_color": [],
         "output_format": "", "output_params": []},
    )
    if cfg["output_width"] <= 0 or cfg["output_height"] <= 0:
        raise ConfigError(f"{STEP} requires output_width and output_height")
    method = enum(STEP, cfg["interpolation"], "INTERPOLATION_", INTERPOLATIONS)
    cfg["interpolation"] = "LINEAR" if method == "UNSPECIFIED" else method
    cfg["letterbox"] = cfg["resize_mode"] in ("", "letterbox")
    cfg["pad_color"] = three_values(cfg["pad_color"])
    return cfg


def three_values(values: Sequence[float]) -> list[float]:
    """One value per channel: none is zero, one counts for all, missing ones are zero."""
    if len(values) == 1:
        return [float(values[0])] * 3
    return [float(v) for v in (*values[:3], 0.0, 0.0, 0.0)][:3]


def resize_pixels(pixels: np.ndarray, cfg: Mapping[str, Any]) -> np.ndarray:
    height, width = cfg["output_height"], cfg["output_width"]
    if not cfg["letterbox"]:
        return resample(pixels, height, width, cfg["interpolation"])
    new_width, new_height = fitted_size(pixels.shape[-2], pixels.shape[-3], width, height)
    channels = pixels.shape[-1]
    color = np.array(cfg["pad_color"][:channels])
    if pixels.dtype == np.uint8:
        color = np.clip(np.rint(color), 0, 255)
    canvas = np.empty((*pixels.shape[:-3], height, width, channels), pixels.dtype)
    canvas[:] = color
    left, top = (width - new_width) // 2, (height - new_height) // 2
    canvas[..., top:top + new_height, left:left + new_width, :] = resample(pixels, new_height, new_width, cfg["interpolation"])
    return canvas


def map_images(df: DataFrame, image: str, output: str, kind: str, arrow_kind, convert, row_bytes: int) -> DataFrame:
    """Apply ``convert`` to every image struct, as column ``output``.

    Results can be much larger than what they are made from, so a batch is given
    back in slices of about ``BATCH_BYTES``.
    """
    kept = [name for name in df.columns if name != output]
    needed = df.select(*kept, *([image] if image not in kept else []))
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(output, T.StructType.fromDDL(f"c {kind}")[0].dataType)])
    step = max(1, BATCH_BYTES // max(row_bytes, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                found = pa.array([convert(value) for value in part.column(image)], arrow_kind)
                yield pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), found], [*kept, output])

    return needed.mapInArrow(run, schema)


def map_stacks(df: DataFrame, image: str, output: str, kind: str, arrow_kind, size_of, make) -> DataFrame:
    """Apply ``make`` to stacks of images, as column ``output``; images that are not valid give null.

    Images of equal size are stacked, and ``make`` turns a stack into one flat result per image. ``size_of`` tells the
    numbers of a result from an image's height and width, so that a batch is given back in slices of ``BATCH_BYTES``
    whatever it grows into. ``arrow_kind`` builds a column from the results laid end to end.
    """
    kept = [name for name in df.columns if name != output]
    needed = df.select(*kept, *([image] if image not in kept else []))
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(output, T.StructType.fromDDL(f"c {kind}")[0].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = Images.of(batch.column(image))
            sizes = np.where(images.valid, size_of(images.height, images.width), 0)
            heavy = np.cumsum(np.maximum(sizes * make.width, images.ends - images.starts))
            for low, high in _slices(heavy, BATCH_BYTES):
                found = arrow_kind(images, low, high, sizes[low:high], images.results(low, high, sizes[low:high], make))
                yield pa.RecordBatch.from_arrays([*(batch.column(name).slice(low, high - low) for name in kept), found], [*kept, output])

    return needed.mapInArrow(run, schema)


def _slices(heavy: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows that together have at most so many bytes, one row at least, from the running sum of their bytes."""
    low, before = 0, 0
    while low < len(heavy):
        high = max(low + 1, int(np.searchsorted(heavy, before + most, side="right")))
        yield low, high
        low, before = high, int(heavy[high - 1])


class Images:
    """A column of image structs as arrays."""

    def __init__(self, origin, height, width, channels, valid, flat, starts, ends):
        self.origin, self.height, self.width, self.channels, self.valid = origin, height, width, channels, valid
        self.flat, self.starts, self.ends = flat, starts, ends

    @classmethod
    def of(cls, column: pa.Array) -> Images:
        parts = dict(zip((f.name for f in column.type), column.flatten()))  # a null struct has null fields
        numbers = [pc.fill_null(parts[name], 0).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("height", "width", "nChannels")]
        data = parts["data"]
        edges = np.frombuffer(data.buffers()[1], np.int64 if pa.types.is_large_binary(data.type) else np.int32)
        edges = edges[data.offset : data.offset + len(data) + 1].astype(np.int64) if len(data) else np.zeros(1, np.int64)
        flat = np.frombuffer(data.buffers()[2] or b"", np.uint8)
        height, width, channels = numbers
        valid = data.is_valid().to_numpy(zero_copy_only=False) & (np.minimum(np.minimum(height, width), channels) > 0)
        valid &= np.isin(channels, (1, 3, 4)) & (edges[1:] - edges[:-1] == height * width * channels)
        return cls(parts["origin"], height, width, channels, valid, flat, edges[:-1], edges[1:])

    def results(self, low: int, high: int, sizes: np.ndarray, make) -> np.ndarray:
        """The results of the rows from ``low`` to ``high``, end to end."""
        places = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), make.kind)
        rows = low + np.flatnonzero(self.valid[low:high])
        shapes = np.stack([self.height[rows], self.width[rows], self.channels[rows]], axis=1)
        for shape in np.unique(shapes, axis=0) if len(rows) else ():
            some = rows[(shapes == shape).all(axis=1)]
            height, width, channels = shape.tolist()
            numbers = max(height * width * channels, int(sizes[some[0] - low]))
            for part in np.array_split(some, -(-len(some) * numbers // STACK_NUMBERS)):
                stack = np.empty((len(part), height * width * channels), np.uint8)
                for k, row in enumerate(part.tolist()):
                    stack[k] = self.flat[self.starts[row] : self.ends[row]]
                stack = stack.reshape(-1, height, width, channels)
                stack = np.repeat(stack, 3, axis=3) if channels == 1 else stack[..., :3]
                made = make(stack).reshape(len(part), -1)
                for k, row in enumerate(part.tolist()):
                    out[places[row - low] : places[row - low] + made.shape[1]] = made[k]
        return out


class _Make:
    """What :func:`map_stacks` does with a stack, the type of its numbers and their bytes."""

    def __init__(self, function, kind):
        self.function, self.kind, self.width = function, kind, np.dtype(kind).itemsize

    def __call__(self, stack: np.ndarray) -> np.ndarray:
        return self.function(stack)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())


def resize_images(df: DataFrame, config: Mapping[str, Any], image: str = "image", output: str = "image") -> DataFrame:
    """Image structs → resized image structs. An image that is not valid gives null."""
    cfg = resize_config(config)
    height, width = cfg["output_height"], cfg["output_width"]

    def structs(images: Images, low: int, high: int, sizes: np.ndarray, flat: np.ndarray) -> pa.Array:
        data = pa.Array.from_buffers(pa.binary(), high - low, [None, _offsets(sizes).buffers()[1], pa.py_buffer(flat)])
        fields = [images.origin.slice(low, high - low), *[pa.array(np.full(high - low, n, np.int32)) for n in (height, width, 3, _BGR_MODE)], data]
        return pa.StructArray.from_arrays(fields, fields=list(_ARROW_IMAGE), mask=pa.array(~images.valid[low:high]))

    make = _Make(lambda stack: resize_pixels(stack, cfg), np.uint8)
    return map_stacks(df, image, output, IMAGE, structs, lambda h, w: np.full(len(h), 3 * height * width), make)


def image_pixels(value) -> np.ndarray | None:
    """Pixels of one image struct as three BGR channels, or None if it is not valid."""
    if not value.is_valid or not value["data"].is_valid:
        return None
    height, width, channels = (value[name].as_py() for name in ("height", "width", "nChannels"))
    data = np.frombuffer(value["data"].as_buffer(), np.uint8)
    if min(height, width, channels) <= 0 or data.size != height * width * channels or channels not in (1, 3, 4):
        return None
    pixels = data.reshape(height, width, channels)
    return np.repeat(pixels, 3, axis=2) if channels == 1 else pixels[:, :, :3]


def resize_grid(grid: str | Column, width: int, height: int, config: Mapping[str, Any]) -> Column:
    """One-channel pixel array of a fixed size, row by row → resized array."""
    cfg = resize_config(config)

    def run(grids: pa.Array) -> pa.Array:
        fits = pc.fill_null(pc.equal(pc.list_value_length(grids), width * height), False)
        pixels = grids.filter(fits).flatten().to_numpy(zero_copy_only=False).reshape(-1, height, width, 1)
        numbers = len(pixels) * max(width * height, cfg["output_width"] * cfg["output_height"])
        stacks = np.array_split(pixels, max(1, -(-numbers // STACK_NUMBERS)))
        made = np.concatenate([resize_pixels(stack, cfg) for stack in stacks]).astype(np.float32).ravel()
        valid = fits.to_numpy(zero_copy_only=False)
        sizes = np.where(valid, cfg["output_width"] * cfg["output_height"], 0)
        return pa.ListArray.from_arrays(_offsets(sizes), pa.array(made), mask=pa.array(~valid))

    return F.arrow_udf(run, "array<float>")(grid)


def encode_images(image: str | Column, output_format: str = ".png") -> Column:
    """Image struct → file bytes, as PNG or BMP."""
    suffix = "." + output_format.lstrip(".").lower()
    if suffix not in (".png", ".bmp"):
        raise ConfigError(f"images can be encoded as .png or .bmp, not as {output_format or '.jpg'}")
    encode = png_bytes if suffix == ".png" else bmp_bytes

    def run(images: pa.Array) -> pa.Array:
        found = (image_pixels(value) for value in images)
        return pa.array([None if pixels is None else encode(pixels) for pixels in found], pa.binary())

    return F.arrow_udf(run, "binary")(image)


def png_bytes(pixels: np.ndarray) -> bytes:
    height, width = pixels.shape[:2]
    rows = np.zeros((height, 1 + 3 * width), np.uint8)  # each row starts with filter type 0
    rows[:, 1:] = pixels[:, :, ::-1].reshape(height, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def bmp_bytes(pixels: np.ndarray) -> bytes:
    height, width = pixels.shape[:2]
    line = (3 * width + 3) // 4 * 4
    rows = np.zeros((height, line), np.uint8)
    rows[:, : 3 * width] = pixels[::-1].reshape(height, -1)
    header = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, rows.size, 2835, 2835, 0, 0)
    return b"BM" + struct.pack("<IHHI", 54 + rows.size, 0, 0, 54) + header + rows.tobytes()


def blob_config(config: Mapping[str, Any]) -> dict[str, Any]:
    cfg = section(
        "blob_preprocess",
        config,
        {"input_width": 0, "input_height": 0, "scale": 0.0, "mean_values": [], "swap_rb": False, "crop": False},
    )
    cfg["scale"] = float(cfg["scale"]) or 1.0
    cfg["mean_values"] = three_values(cfg["mean_values"])
    return cfg


def blob_preprocess(df: DataFrame, config: Mapping[str, Any], image: str = "image", output: str = "blob") -> DataFrame:
    """Image structs → ``struct(shape, data)``: float pixels, channel by channel,
    ``(pixel - mean) * scale``; an input size of zero is the image's own."""
    cfg = blob_config(config)
    kind = "struct<shape: array<int>, data: array<float>>"

    def own(given: int, sizes: np.ndarray) -> np.ndarray:
        return np.full(len(sizes), given) if given else sizes

    def structs(images: Images, low: int, high: int, sizes: np.ndarray, flat: np.ndarray) -> pa.Array:
        heights, widths = own(cfg["input_height"], images.height[low:high]), own(cfg["input_width"], images.width[low:high])
        shapes = np.stack([np.ones_like(heights), np.full_like(heights, 3), heights, widths], axis=1).astype(np.int32)
        shape = pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * len(shapes) + 1, 4), pa.int32()), pa.array(shapes.ravel()))
        data = pa.ListArray.from_arrays(_offsets(sizes), pa.array(flat))
        return pa.StructArray.from_arrays([shape, data], names=["shape", "data"], mask=pa.array(~images.valid[low:high]))

    make = _Make(lambda stack: pixels_blob(stack, cfg), np.float32)
    return map_stacks(df, image, output, kind, structs, lambda h, w: 3 * own(cfg["input_height"], h) * own(cfg["input_width"], w), make)


def blob_bytes(cfg: Mapping[str, Any]) -> int:
    """Bytes of one tensor; images of their own size are taken as 512 × 512."""
    return 12 * (cfg["input_width"] or 512) * (cfg["input_height"] or 512)


def pixels_blob(pixels: np.ndarray, cfg: Mapping[str, Any]) -> np.ndarray:
    """Tensors ``(images, channels, rows, columns)`` of one image or of a stack."""
    pixels = pixels if pixels.ndim == 4 else pixels[None]
    rows, columns = pixels.shape[1:3]
    height, width = cfg["input_height"] or rows, cfg["input_width"] or columns
    if cfg["crop"]:
        factor = max(width / columns, height / rows)
        pixels = resample(pixels, max(height, round(rows * factor)), max(width, round(columns * factor)), "LINEAR")
        top, left = (pixels.shape[1] - height) // 2, (pixels.shape[2] - width) // 2
        pixels = pixels[:, top:top + height, left:left + width]
    else:
        pixels = resample(pixels, height, width, "LINEAR")
    if cfg["swap_rb"]:
        pixels = pixels[..., ::-1]
    mean = np.array(cfg["mean_values"], np.float32)
    blob = (pixels.astype(np.float32) - mean) * np.float32(cfg["scale"])
    return np.ascontiguousarray(blob.transpose(0, 3, 1, 2))


def normalize(values: str | Column, mean: float = 0.0, scale: float = 0.0) -> Column:
    """``(value - mean) * scale`` over a float array; a scale of zero is one."""
    factor = float(scale) or 1.0
    return F.transform(values, lambda v: (v.cast("double") - F.lit(float(mean))) * F.lit(factor))


def read_images(spark, path: str, drop_invalid: bool = True, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """Image files → image structs; files that cannot be decoded are left out."""
    reader = spark.read
    if streaming:
        reader = spark.readStream.schema(f"image {IMAGE}")
        reader = reader if max_files is None else reader.option("maxFilesPerTrigger", str(max_files))
    return reader.format("image").option("dropInvalid", str(drop_invalid).lower()).load(path)
