from __future__ import annotations

import gzip
import io
import json
from datetime import date, datetime, time
from decimal import Decimal

import pyarrow.json as pj
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from millrace.errors import ConfigError, DataError
from millrace.sources.json import read_json, split_objects
from millrace.sources.lines import split_object_stream


def write(tmp_path, data, name="f.json"):
    path = tmp_path / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def read(spark, path, **parse):
    common = parse.pop("common", {})
    return read_json(spark, {"path": path, "parse_options": parse, "common": common})


LINES = '{"id":1,"name":"alpha"}\n{"id":2,"name":"beta"}\n'


def test_lines(spark, tmp_path):
    found = read(spark, write(tmp_path, LINES))
    assert found.schema.simpleString() == "struct<id:bigint,name:string>"
    assert rows(found) == [(1, "alpha"), (2, "beta")]


@pytest.mark.parametrize("codec", ["gzip", "zstd"])
def test_codec_named_but_not_in_the_file_name(spark, tmp_path, codec):
    import pyarrow as pa

    data = gzip.compress(LINES.encode()) if codec == "gzip" else pa.compress(LINES.encode(), codec="zstd", asbytes=True)
    assert rows(read(spark, write(tmp_path, data), common={"compression": codec})) == [(1, "alpha"), (2, "beta")]


@pytest.mark.parametrize(
    "data",
    [
        '{"a":1}\n{"a":2.5}\n',
        '{"a":"2020-01-01"}\n{"a":"2020-01-01T10:00:00"}\n',
        '{"a":"2020-01-01T00:00:00.5"}\n',
        '{"a":"10:00"}\n',
        '{"a":[1,2],"b":{"c":true}}\n{"b":{"d":"x"}}\n',
        '{"a":1}\n\n{"b":null}\n',
    ],
)
def test_inferred_like_arrow(spark, tmp_path, data):
    expected = pj.read_json(io.BytesIO(data.encode())).to_pylist()
    found = read(spark, write(tmp_path, data))
    assert [row.asDict(recursive=True) for row in found.collect()] == expected


def test_values_of_different_kinds_are_an_error(spark, tmp_path):
    with pytest.raises(DataError, match="different kinds"):
        read(spark, write(tmp_path, '{"a":1}\n{"a":"x"}\n'))


def test_explicit_types_and_unexpected_fields(spark, tmp_path):
    path = write(tmp_path, '{"id":1,"name":"alpha"}\n')
    ignored = read(spark, path, explicit_schema={"id": "int32", "z": "float64"}, unexpected_field_behavior="IGNORE")
    assert rows(ignored) == [(1, None)]
    inferred = read(spark, path, explicit_schema={"id": "int16"})
    assert inferred.schema.simpleString() == "struct<id:smallint,name:string>"
    refused = read(spark, path, explicit_schema={"id": "int32"}, unexpected_field_behavior="UNEXPECTED_FIELD_BEHAVIOR_ERROR")
    with pytest.raises(Exception, match="unexpected field.*name"):
        refused.collect()


GOOD = [
    ("string", '"5"', "5"),
    ("binary", '"5"', bytearray(b"5")),
    ("date32", "5", date(1970, 1, 6)),
    ("date64", "86400000", date(1970, 1, 2)),
    ({"type": "time32", "time_unit": "s"}, "5", time(0, 0, 5)),
    ({"type": "time64", "time_unit": "us"}, "5", time(0, 0, 0, 5)),
    ({"type": "timestamp", "time_unit": "ms"}, '"2020-01-01"', datetime(2020, 1, 1)),
    ({"type": "decimal128", "decimal_precision": 6, "decimal_scale": 2}, "5", Decimal("5.00")),
    ({"type": "decimal128", "decimal_precision": 6, "decimal_scale": 2}, '"1.25"', Decimal("1.25")),
    ("bool", "true", True),
    ("uint8", "255", 255),
    ("float64", "5", 5.0),
    ("null", "null", None),
    ("string", "null", None),
]
BAD = [("string", "5"), ("string", "true"), ("binary", "1"), ({"type": "timestamp", "time_unit": "s"}, "5"),
       ("int32", '"5"'), ("int32", "1.25"), ("uint8", "256"), ("bool", "1"), ("float64", '"5"'), ("date32", '"2020-01-01"'), ("null", "1")]


def test_explicit_kinds(spark, tmp_path):
    for number, (kind, text, value) in enumerate(GOOD):
        path = write(tmp_path, f'{{"a":{text}}}\n', f"{number}.json")
        assert read(spark, path, explicit_schema={"a": kind}, unexpected_field_behavior="IGNORE").first().a == value, kind


def test_values_of_another_kind_are_errors(spark, tmp_path):
    for number, (kind, text) in enumerate(BAD):
        path = write(tmp_path, f'{{"a":{text}}}\n', f"{number}.json")
        with pytest.raises(Exception):
            read(spark, path, explicit_schema={"a": kind}, unexpected_field_behavior="IGNORE").collect()


@pytest.mark.parametrize("kind", ["float16", {"type": "duration", "time_unit": "s"}, {"type": "fixed_size_binary", "fixed_size_binary_length": 2}])
def test_kinds_json_does_not_have(spark, kind):
    with pytest.raises(ConfigError):
        read_json(spark, {"path": "x", "parse_options": {"explicit_schema": {"a": kind}}})


SEVERAL = '{\n "id":1,\n "n":{"a":[{"b":"} {"}]}\n}\n{\n "id":2,"n":{"a":[]}\n} {"id":3}\n\n{"id":4,"n":{}}\n'


def test_objects_over_several_lines(spark, tmp_path):
    found = read(spark, write(tmp_path, SEVERAL), newlines_in_values=True)
    assert [(r.id, r.n and r.n.a and [x.b for x in r.n.a]) for r in found.orderBy("id").collect()] == [
        (1, ["} {"]), (2, []), (3, None), (4, None)
    ]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("indent", [None, 2])
def test_objects_over_several_lines_in_many_splits(spark, tmp_path, end, indent):
    objects = [{"id": i, "text": "}\n{" * (i % 3), "deep": {"x": {"y": i}}} for i in range(3_000)]
    path = write(tmp_path, end.join(json.dumps(o, indent=indent).replace("\n", end) for o in objects) + end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = read(spark, path, newlines_in_values=True)
        assert found.rdd.getNumPartitions() > 3
        assert [r.asDict(recursive=True) for r in found.select("id", "text", "deep").orderBy("id").collect()] == objects
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@settings(max_examples=50, deadline=None)
@given(st.lists(st.dictionaries(st.text(max_size=3), st.text(max_size=5) | st.integers() | st.none(), max_size=3), max_size=5),
       st.sampled_from(["", " ", "\n", "\r\n \t"]), st.booleans())
def test_splitting_objects(objects, space, brace):
    text = space.join(json.dumps(o) for o in objects) + space
    pieces = list(split_objects(text + ("}" if brace else "")))
    assert [json.loads(p) for p in pieces] == objects


@settings(max_examples=50, deadline=None)
@given(st.lists(st.dictionaries(st.text(max_size=3), st.text(max_size=5) | st.integers(), max_size=3), max_size=5), st.integers(1, 9))
def test_splitting_an_object_stream(objects, size):
    data = " \n".join(json.dumps(o, ensure_ascii=False) for o in objects).encode("utf-8", "surrogatepass")
    if b"\xed" in data:
        return  # lone surrogates are not UTF-8
    chunks = [data[i:i + size] for i in range(0, len(data), size)]
    assert [json.loads(o) for o in split_object_stream(chunks)] == objects


def test_objects_over_several_lines_in_a_compressed_file(spark, tmp_path):
    path = write(tmp_path, gzip.compress(SEVERAL.encode()))
    found = read(spark, path, newlines_in_values=True, common={"compression": "gzip"})
    assert sorted(r.id for r in found.collect()) == [1, 2, 3, 4]
    broken = write(tmp_path, gzip.compress(b'{"id":1}\n{"id":'), "broken.json")
    with pytest.raises(Exception, match="not a JSON object"):
        read(spark, broken, newlines_in_values=True, common={"compression": "gzip"}).collect()


def test_streaming_read(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    write(path, LINES)
    config = {"path": str(path), "parse_options": {"explicit_schema": {"id": "int64"}, "unexpected_field_behavior": "IGNORE"}}
    query = read_json(spark, config, streaming=True).writeStream.format("memory").queryName("json_stream")
    query.trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.table("json_stream")) == [(1,), (2,)]
    with pytest.raises(ConfigError):
        read_json(spark, {"path": str(path)}, streaming=True)
