"""Records by byte range are the records of the whole file, wherever the ranges are cut."""

from __future__ import annotations

import csv
import gzip
import io
import json
import random

import pytest

from conftest import rows
from millrace.errors import DataError
from millrace.sources import ranges
from millrace.sources.csv import malformed_rows, read_csv
from millrace.sources.json import read_json
from millrace.sources.ranges import OUTSIDE, Lines, Objects, Opener, QuotedLines


def by_ranges(path, data, scanner, size, offset=0):
    """What the tasks of all ranges give, with each range's state composed as the second pass gets it."""
    path.write_bytes(data)
    opener, out, (inside, depth), line, record = Opener(), [], OUTSIDE, 0, 0
    for start in range(offset, len(data), size):
        row = {"path": str(path), "size": len(data), "whole": False, "start": start, "end": min(start + size, len(data)),
               "first": start == offset, "inside": inside, "depth": depth, "line": line, "record": record}
        found = list(ranges._file_records(opener, scanner, row))
        out += [(line + lines, value) for lines, value in found]
        sums = dict(zip(ranges._SUMS, ranges._sums(opener, scanner, row), strict=True))
        assert not found or not isinstance(scanner, Lines) or record + (inside or depth > 0) == len(out) - len(found)
        record += sums[f"records{inside}"]
        line += sums["lines"]
        inside, depth = sums[f"inside{inside}"], depth + sums[f"depth{inside}"]
    return out


def random_csv(rng, rows, escape=None, double=True):
    out = []
    for _ in range(rows):
        fields = []
        for _ in range(rng.randint(1, 4)):
            text = "".join(rng.choice(["a", "b c", "\n", ",", '"', "é", "", "\r\n"]) for _ in range(rng.randint(0, 5)))
            if escape:
                fields.append('"' + text.replace('"', escape + '"' if rng.random() < 0.5 or not double else '""') + '"')
            elif any(c in text for c in '",\n\r'):
                fields.append('"' + text.replace('"', '""') + '"')
            else:
                fields.append(rng.choice([text, f'"{text}"', text + 'x"y' if text else text]))
        out.append(",".join(fields))
    return rng.choice(["\n", "\r\n"]).join(out) + rng.choice(["", "\n"])


def walked(text, escape=None, double=True):
    """Records of a CSV text, one character after the other."""
    out, start, state, k, line, first = [], 0, "start", 0, 0, 0
    while k < len(text):
        c = text[k]
        if escape and c == escape:
            line += text[k + 1 : k + 2] == "\n"
            k += 2
            state = state if state == "quoted" else "plain"
            continue
        if state == "quoted":
            if c == '"':
                if double and text[k + 1 : k + 2] == '"':
                    k += 1
                else:
                    state = "plain"
        elif c == '"' and state == "start":
            state = "quoted"
        elif c == ",":
            state = "start"
        elif c == "\n":
            out.append((first, text[start:k].removesuffix("\r")))
            start, state, first = k + 1, "start", line + 1
        else:
            state = "plain"
        line += c == "\n"
        k += 1
    if start < len(text):
        out.append((first, text[start:].removesuffix("\n").removesuffix("\r")))
    return out


@pytest.mark.parametrize("read", [1, 7, 1 << 20])
@pytest.mark.parametrize("escape, double", [(None, True), (None, False), ("\\", True), ("\\", False)])
def test_quoted_lines(tmp_path, monkeypatch, escape, double, read):
    monkeypatch.setattr(ranges, "READ_BYTES", read)
    rng = random.Random(read)
    for _ in range(20):
        text = random_csv(rng, rng.randint(0, 12), escape, double)
        want = walked(text, escape, double)
        scanner = QuotedLines(",", '"', double, escape)
        for size in (1, 2, 3, 5, 17, 1000):
            got = by_ranges(tmp_path / "f.csv", text.encode(), scanner, size)
            assert [(n, v.decode()) for n, v in got] == want, (text, size)


def test_quoted_lines_agree_with_the_csv_module(tmp_path):
    rng = random.Random(4)
    table = [[("x" * rng.randint(0, 9) + rng.choice(["", '"', "\n", ",", '""\n"'])) for _ in range(3)] for _ in range(500)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(table)
    for size in (40, 999):
        got = by_ranges(tmp_path / "f.csv", out.getvalue().encode(), QuotedLines(",", '"'), size)
        assert [next(csv.reader(io.StringIO(v.decode(), newline=""))) for _, v in got] == table


def test_either_start_is_summed_up_alike():
    """The two starts share work; each gives what walking alone gives."""
    rng = random.Random(9)
    scanner = QuotedLines(",", '"')
    for _ in range(300):
        data = random_csv(rng, 6).encode() + b"\n"
        for start, (state, count) in zip(scanner.starts, scanner.both(data), strict=True):
            alone, ends = scanner._walked(data, ranges.np.frombuffer(data, ranges.np.uint8), start)
            assert (state, count) == ((alone, 0), len(ends))
            assert scanner.scan(data, (start, 0))[1].tolist() == ends.tolist()


@pytest.mark.parametrize("between", ["", "\n", "\r\n", "\n\n", "  \t", "\n \n"])
@pytest.mark.parametrize("indent", [None, 1])
def test_objects(tmp_path, monkeypatch, between, indent):
    rng = random.Random(5)
    texts = ["}{", "\\", '"', '\\"}', "{", "é", "\n", "]", ""]
    objects = [{"id": k, "t": rng.choice(texts) + rng.choice(texts), "n": [{"x": {}}, rng.choice(texts)], rng.choice(texts): {"y": {"z": k}}} for k in range(15)]
    data = between.join(json.dumps(o, indent=indent, ensure_ascii=False) for o in objects).encode() + b"\n"
    for read in (1, 50, 1 << 20):
        monkeypatch.setattr(ranges, "READ_BYTES", read)
        for size in (1, 3, 64, 700, 10**6):
            assert [json.loads(v) for _, v in by_ranges(tmp_path / "f.json", data, Objects(), size)] == objects
    with pytest.raises(DataError):
        by_ranges(tmp_path / "f.json", data + b'{"a": 1', Objects(), 64)


def test_plain_lines(tmp_path):
    data = b"a\n\nb\r\n" + b"x" * 50 + b"\nlast"
    for size in (1, 2, 9, 100):
        assert [v for _, v in by_ranges(tmp_path / "f", data, Lines(), size)] == [b"a", b"", b"b", b"x" * 50, b"last"]
        assert [v for _, v in by_ranges(tmp_path / "f", data, Lines(), size, offset=2)] == [b"", b"b", b"x" * 50, b"last"]


def quoted_file(tmp_path, count=3000):
    table = [(k, f'text "{k}"\nsecond, line\n' * (k % 4)) for k in range(count)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([("id", "text"), *table])
    (tmp_path / "in.csv").write_text(out.getvalue())
    return str(tmp_path / "in.csv"), table


def test_line_ends_in_quotes_are_read_by_many_tasks(spark, tmp_path):
    path, table = quoted_file(tmp_path)
    config = {"path": path, "parse_options": {"newlines_in_values": True}, "read_options": {"block_size": 5000}}
    found = read_csv(spark, config)
    assert found.rdd.getNumPartitions() > 10
    assert rows(found) == table
    whole = spark.read.options(header=True, multiLine=True, escape='"', emptyValue="", inferSchema=True).csv(path).selectExpr("CAST(id AS BIGINT) id", "nvl(text, '') text")
    assert rows(whole) == table
    skipped = read_csv(spark, config | {"read_options": {"block_size": 5000, "skip_rows_after_names": 2500}})
    assert rows(skipped) == table[2500:]


def test_a_quoted_value_longer_than_many_ranges(spark, tmp_path):
    big = "line, with \"\" quotes\n" * 20_000
    (tmp_path / "in.csv").write_text(f'id,text\n1,"{big}"\n2,"b"\n')
    found = read_csv(spark, {"path": str(tmp_path / "in.csv"), "parse_options": {"newlines_in_values": True}, "read_options": {"block_size": 10_000}})
    assert rows(found) == [(1, big.replace('""', '"')), (2, "b")]


def test_malformed_rows_are_named(spark, tmp_path):
    lines = [f"{k},name {k}" for k in range(2000)]
    lines[700], lines[1500] = "700,a,b", "1500"
    (tmp_path / "one.csv").write_text("# made by hand\nid,name\n" + "\n".join(lines) + "\n")
    (tmp_path / "two.csv").write_text('# again\nid,name\n1,"a\nb"\n2\n')
    config = {"path": str(tmp_path), "read_options": {"skip_rows": 1, "block_size": 3000}, "parse_options": {"newlines_in_values": True}}
    found = malformed_rows(spark, config)
    got = sorted((r.path.rpartition("/")[2], r.line, r.record, r.value) for r in found.collect())
    assert got == [("one.csv", 703, 703, "700,a,b"), ("one.csv", 1503, 1503, "1500"), ("two.csv", 5, 4, "2")]
    with pytest.raises(Exception, match=r"malformed CSV record at .*\.csv:\d+"):
        read_csv(spark, config).collect()


def test_heads_longer_than_a_range(spark, tmp_path):
    text = "junk\n" * 5000 + "\n\n\nid,name\n" + "drop\n" * 3000 + "".join(f"{k},n{k}\n" for k in range(900))
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text(text)
    with gzip.open(tmp_path / "c.csv.gz", "wt") as out:
        out.write(text)
    config = {"path": str(tmp_path), "read_options": {"skip_rows": 5000, "skip_rows_after_names": 3000, "block_size": 1000}}
    assert rows(read_csv(spark, config)) == sorted([(k, f"n{k}") for k in range(900)] * 3)
    (tmp_path / "d.csv").write_text(text.replace("id,name", "name,id"))
    with pytest.raises(Exception, match="differ"):
        read_csv(spark, config)


def test_json_without_separators_is_read_by_many_tasks(spark, tmp_path):
    for name, between in (("a", ""), ("b", "\n\n"), ("c", "\r\n")):
        (tmp_path / name).write_bytes(between.join(json.dumps({"id": k, "o": {"t": "}{" * (k % 3)}}, indent=k % 2 or None) for k in range(800)).encode())
    found = read_json(spark, {"path": str(tmp_path), "parse_options": {"newlines_in_values": True}, "read_options": {"block_size": 2000}})
    assert found.rdd.getNumPartitions() > 20
    assert rows(found.selectExpr("id", "o.t")) == sorted([(k, "}{" * (k % 3)) for k in range(800)] * 3)


def test_short_blocks_make_no_more_tasks(spark, tmp_path):
    """A block of ten bytes is not a task of its own; the records and their numbers stay."""
    table = [(k, f"n{k}") for k in range(9000)]
    (tmp_path / "in.csv").write_text("head\n" * 30 + "id,name\n" + "".join(f"{k},{name}\n" for k, name in table) + "1,2,3\n")
    config = {"path": str(tmp_path / "in.csv"), "read_options": {"block_size": 10, "skip_rows": 30}}
    wrong = malformed_rows(spark, config)
    assert wrong.rdd.getNumPartitions() <= ranges.MOST_TASKS
    assert [(r.line, r.record, r.value) for r in wrong.collect()] == [(9032, 9032, "1,2,3")]
    (tmp_path / "in.csv").write_text("head\n" * 30 + "id,name\n" + "".join(f"{k},{name}\n" for k, name in table))
    found = read_csv(spark, config)
    assert 10 < found.rdd.getNumPartitions() <= ranges.MOST_TASKS
    assert rows(found) == table


def test_short_json_blocks_make_no_more_tasks(spark, tmp_path):
    (tmp_path / "in.json").write_bytes(b"".join(json.dumps({"id": k, "t": "}{"}).encode() for k in range(3000)))
    found = read_json(spark, {"path": str(tmp_path), "parse_options": {"newlines_in_values": True}, "read_options": {"block_size": 20}})
    assert 10 < found.rdd.getNumPartitions() <= ranges.MOST_TASKS
    assert rows(found.select("id")) == [(k,) for k in range(3000)]


@pytest.mark.parametrize("scanner", [Lines(), Objects()])
def test_a_range_reads_little_beyond_its_end(tmp_path, scanner):
    class Counted(io.BytesIO):
        def read(self, size):
            done.append(super().read(size))
            return done[-1]

    class Open:
        def open(self, path):
            return Counted(data)

    data, done = b'{"a": 1}\n' * 500_000, []
    row = {"path": "", "size": len(data), "whole": False, "start": 90_000, "end": 99_000, "first": False, "inside": 0, "depth": 0}
    assert len(list(ranges._file_records(Open(), scanner, row))) == 1000
    assert sum(map(len, done)) < 300_000
