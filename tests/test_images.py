from __future__ import annotations

import json
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.errors import ConfigError
from millrace.functions.linear_model import linear_model
from millrace.operators import images, inference

KIND = "origin string, height int, width int, nChannels int, mode int, data binary"


def frame(spark, *arrays):
    data = [("x", a.shape[0], a.shape[1], a.shape[2], 16, bytearray(a.tobytes())) for a in arrays]
    return spark.createDataFrame(data, KIND).select(F.struct("*").alias("image"))


def pixels(seed, height, width, channels=3):
    return np.random.default_rng(seed).integers(0, 256, (height, width, channels), np.uint8)


def arrays(df, column="image"):
    return [np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels) for (r,) in df.select(column).collect()]


@pytest.mark.parametrize("size", [(100, 50), (50, 100), (3, 1000), (640, 360), (7, 7)])
def test_geometry(spark, size):
    width, height = size
    place = spark.range(1).select(images.letterbox_geometry(F.lit(width), F.lit(height), 64, 48).alias("p")).first().p
    assert (place.width, place.height) == images.fitted_size(width, height, 64, 48)
    assert place.offset_x == (64 - place.width) // 2 and place.offset_y == (48 - place.height) // 2
    scale = min(64 / width, 48 / height)
    assert abs(place.width - max(1, width * scale)) <= 0.5001 or place.width == 1


def brute(source, target, method, position):
    """Weights of one target position, straight from the definitions."""
    scale = source / target
    weight = np.zeros(source)
    if method == "NEAREST":
        weight[min(int(math.floor(position * scale)), source - 1)] = 1
    elif method == "AREA":
        for i in range(source):
            weight[i] = max(0.0, min((position + 1) * scale, i + 1) - max(position * scale, i)) / scale
    else:
        center = (position + 0.5) * scale - 0.5
        reach = {"LINEAR": 1, "CUBIC": 2, "LANCZOS4": 4}[method]
        found = {}
        for i in range(math.floor(center) - reach + 1, math.floor(center) + reach + 1):
            x = abs(center - i)
            if method == "LINEAR":
                w = max(0.0, 1 - x)
            elif method == "CUBIC":
                a = -0.75
                w = (a + 2) * x**3 - (a + 3) * x**2 + 1 if x <= 1 else a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a
            else:
                w = 1.0 if x == 0 else 4 * math.sin(math.pi * x) * math.sin(math.pi * x / 4) / (math.pi * x) ** 2
            found[i] = w
        total = sum(found.values()) if method == "LANCZOS4" else 1.0
        for i, w in found.items():
            weight[min(max(i, 0), source - 1)] += w / total
    return weight


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 20), st.integers(1, 20), st.sampled_from(["NEAREST", "LINEAR", "AREA", "CUBIC", "LANCZOS4"]))
def test_weights(source, target, method):
    if method == "AREA" and target > source:
        return
    index, weight = images.taps(source, target, method)
    dense = np.zeros((target, source))
    for row in range(target):
        np.add.at(dense[row], index[row], weight[row])
    wanted = np.array([brute(source, target, method, p) for p in range(target)])
    assert np.allclose(dense, wanted, atol=1e-9)


@pytest.mark.parametrize("method", ["NEAREST", "LINEAR", "AREA", "CUBIC", "LANCZOS4"])
def test_constant_images_stay_constant(method):
    flat = np.full((5, 9, 3), 77, np.uint8)
    for height, width in ((3, 4), (10, 20), (3, 20)):
        assert (images.resample(flat, height, width, method) == 77).all()


def test_resize_and_letterbox(spark):
    image = pixels(1, 8, 4)
    config = {"output_width": 8, "output_height": 8, "interpolation": "NEAREST"}
    (stretched,) = arrays(images.resize_images(frame(spark, image), {**config, "resize_mode": "stretch"}))
    assert (stretched == image.repeat(2, axis=1)).all()
    (boxed,) = arrays(images.resize_images(frame(spark, image), {**config, "pad_color": [1, 2, 300]}))
    assert (boxed[:, 2:6] == image).all()
    assert (boxed[:, :2] == [1, 2, 255]).all() and (boxed[:, 6:] == [1, 2, 255]).all()


def test_broken_images_give_null(spark):
    good = frame(spark, pixels(1, 2, 2))
    bad = spark.createDataFrame([("x", 5, 5, 3, 16, bytearray(b"abc"))], KIND).select(F.struct("*").alias("image"))
    found = images.resize_images(good.union(bad), {"output_width": 4, "output_height": 4})
    assert sorted(r.image is None for r in found.collect()) == [False, True]


def test_configuration(spark):
    for bad in ({}, {"output_width": 5}, {"output_width": 5, "output_height": 5, "interpolation": "MAGIC"}):
        with pytest.raises(ConfigError):
            images.resize_config(bad)
    assert images.three_values([]) == [0, 0, 0] and images.three_values([5]) == [5, 5, 5] and images.three_values([1, 2]) == [1, 2, 0]


@pytest.mark.parametrize("suffix", [".png", "bmp"])
def test_encoded_images_are_read_back(spark, tmp_path, suffix):
    image = pixels(2, 3, 5)
    data = bytes(frame(spark, image).select(images.encode_images("image", suffix)).first()[0])
    (tmp_path / f"a.{suffix.lstrip('.')}").write_bytes(data)
    (tmp_path / f"broken.{suffix.lstrip('.')}").write_bytes(b"nothing")
    (back,) = arrays(images.read_images(spark, str(tmp_path)))
    assert (back == image).all()
    with pytest.raises(ConfigError):
        images.encode_images("image", "")


def test_blobs(spark):
    image = pixels(3, 4, 6)
    config = {"mean_values": [10, 20, 30], "scale": 0.5, "swap_rb": True}
    blob = images.blob_preprocess(frame(spark, image), config).select("blob").first().blob
    wanted = ((image[:, :, ::-1].astype(np.float32) - [10, 20, 30]) * 0.5).transpose(2, 0, 1)
    assert list(blob.shape) == [1, 3, 4, 6] and np.allclose(np.array(blob.data).reshape(3, 4, 6), wanted)
    cropped = images.blob_preprocess(frame(spark, image), {"input_width": 4, "input_height": 4, "crop": True}).select("blob").first().blob
    assert np.allclose(np.array(cropped.data).reshape(3, 4, 4), image[:, 1:5].transpose(2, 0, 1))


def test_slices_keep_every_row(spark, monkeypatch):
    many = frame(spark, *[pixels(i, 4, 4) for i in range(23)]).withColumn("id", F.monotonically_increasing_id())
    monkeypatch.setattr(images, "BATCH_BYTES", 200)
    found = images.resize_images(many, {"output_width": 8, "output_height": 8})
    assert found.columns == ["id", "image"] and found.select("id").distinct().count() == 23


# --------------------------------------------------------------- inference
WEIGHTS = np.random.default_rng(5).normal(size=(48, 4)).astype(np.float32)


def test_scores(spark):
    values = np.random.default_rng(6).normal(size=(50, 48)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)] + [(99, None)], "id int, v array<float>")
    model = spark.sparkContext.broadcast(linear_model(WEIGHTS))
    scored = df.select("id", inference.score(F.col("v"), [1, 48], model).alias("t"))
    found = {r.id: r.t for r in scored.collect()}
    assert found.pop(99) is None
    for i, tensors in found.items():
        (tensor,) = tensors
        assert tensor.name == "output" and list(tensor.shape) == [1, 4]
        assert np.allclose(tensor.data, values[i] @ WEIGHTS, atol=1e-4)
    named = df.select(inference.score(F.col("v"), [1, 48], model, "input", ["scores"]).alias("t")).where("t IS NOT NULL").first().t
    assert named[0].name == "scores"
    with pytest.raises(Exception, match="no input other"):
        df.select(inference.score(F.col("v"), [1, 48], model, "other")).collect()


def test_tensor_json_escapes_and_keeps_precision(spark):
    df = spark.sql("SELECT array(struct('a\"b' AS name, array(1, 2) AS shape, array(cast(0.123456789 AS float), cast('NaN' AS float)) AS data)) AS t")
    found = json.loads(df.select(inference.tensor_json("t")).first()[0])
    assert found['a"b']["shape"] == [1, 2] and abs(found['a"b']["data"][0] - 0.123456789) < 1e-8


def test_inference_over_image_files(spark, tmp_path):
    # A model over flat vectors does not take image tensors, so the shape is refused by name.
    (tmp_path / "m.onnx").write_bytes(linear_model(WEIGHTS))
    df = frame(spark, pixels(1, 4, 4))
    with pytest.raises(Exception, match="[Ii]nvalid|rank|dimension"):
        inference.infer_images(df, {"model_path": str(tmp_path / "m.onnx")}).collect()
    for bad in ({}, {"model_path": "x", "framework": "caffe"}, {"model_path": "x", "config_path": "y"}):
        with pytest.raises(ConfigError):
            inference.infer_images(df, bad)


@pytest.mark.parametrize("method", ["NEAREST", "LINEAR", "AREA", "CUBIC", "LANCZOS4"])
def test_stacks_are_resampled_like_single_images(method):
    rng = np.random.default_rng(3)
    for kind, shape, target in ((np.uint8, (7, 5, 3), (11, 4)), (np.float32, (8, 8, 1), (3, 16)), (np.uint8, (4, 4, 3), (4, 4))):
        stack = (rng.random((6, *shape)) * 255).astype(kind)
        found = images.resample(stack, *target, method)
        assert found.dtype == kind
        assert (found == np.stack([images.resample(one, *target, method) for one in stack])).all()


def test_images_of_many_sizes_and_invalid_ones(spark, monkeypatch):
    """Mixed sizes and channels, invalid rows between, slices of a few rows: each image as if it were alone."""
    rng = np.random.default_rng(5)
    shapes = [(4, 6, 3), (5, 5, 1), (4, 6, 3), (3, 9, 4), (5, 5, 1)] * 8
    rows = [(k, ("o", h, w, c, 16, bytearray(rng.integers(0, 256, h * w * c, np.uint8).tobytes()))) for k, (h, w, c) in enumerate(shapes)]
    rows += [(100, None), (101, ("o", 2, 2, 3, 16, None)), (102, ("o", 2, 2, 3, 16, bytearray(5))), (103, ("o", None, 2, 3, 16, bytearray(12)))]
    df = spark.createDataFrame(rows, f"id int, image {images.IMAGE}").repartition(2)
    monkeypatch.setattr(images, "BATCH_BYTES", 500)
    cfg = images.resize_config({"output_width": 6, "output_height": 5, "interpolation": "AREA"})
    blob = images.blob_config({"scale": 0.5, "mean_values": [1, 2, 3], "swap_rb": True})
    resized = {r.id: r.image for r in images.resize_images(df, {"output_width": 6, "output_height": 5, "interpolation": "AREA"}).collect()}
    blobs = {r.id: r.blob for r in images.blob_preprocess(df, {"scale": 0.5, "mean_values": [1, 2, 3], "swap_rb": True}).collect()}
    assert len(resized) == len(blobs) == len(rows)
    for k, (_, image) in enumerate(rows[:40]):
        pixels = np.frombuffer(bytes(image[5]), np.uint8).reshape(image[1:4])
        pixels = np.repeat(pixels, 3, axis=2) if pixels.shape[2] == 1 else pixels[:, :, :3]
        assert bytes(resized[k].data) == images.resize_pixels(pixels, cfg).tobytes()
        wanted = images.pixels_blob(pixels, blob)
        assert blobs[k].shape == list(wanted.shape) and blobs[k].data == wanted.ravel().tolist()
    for k in (100, 101, 102, 103):
        assert resized[k] is None and blobs[k] is None
