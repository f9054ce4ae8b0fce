"""Parallel reading of multi-line CSV against the built-in reader and the csv module."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs

from tessera.sources import csv_ranges as c
from tessera.sources.csv import read_csv, write_csv

LOCAL = fs.LocalFileSystem()
SEP = ord(";")


def cut(name, size, chunk=c.CHUNK):
    """Records of all ranges of ``size`` bytes, states followed as the reader does."""
    total = LOCAL.get_file_info(name).size
    now, out = c.OUTSIDE, []
    for start in range(0, total, size):
        end = min(start + size, total)
        out += list(c.records(LOCAL, name, start, end, now, SEP, chunk))
        now = c.range_states(LOCAL, name, start, end, SEP)[now]
    return out


def expected(data):
    """Records by a plain walk over the characters."""
    out, start, inside, closed = [], 0, False, -1
    for i, b in enumerate(data):
        ahead = data[i - 1: i] if i else b""
        if b == 0x22:
            if inside:
                inside, closed = False, i
            elif closed == i - 1 and i or ahead in (b"", b";", b"\n", b"\r"):
                inside = True
        elif b == 0x0A and not inside:
            out.append(data[start:i])
            start = i + 1
    return out + ([data[start:]] if start < len(data) else [])


TRICKY = ('id;text;n\n1;"a;b";2\n2;"say ""hi""\nthere";3\n"";"";""\n3;plain "quoted" word;4\n\n4;"""";5\n5;"\n\n;""\n";6\n'
          '6;é"ü;7\n7;"x"\n').encode()


def test_every_cut_position(tmp_path):
    name = str(tmp_path / "a.csv")
    for data in (TRICKY, TRICKY[:-1], b'"a\nb"', b"\n\n", b'x;"', b'"";"a"\n"b"'):
        open(name, "wb").write(data)
        for size in range(1, len(data) + 1):
            for chunk in (1, 3, 1 << 20):
                assert cut(name, size, chunk) == expected(data), (data, size, chunk)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='";\na', max_size=40), st.integers(1, 12), st.integers(1, 7))
def test_any_text_any_cut(tmp_path_factory, text, size, chunk):
    name = str(tmp_path_factory.mktemp("cut") / "a.csv")
    open(name, "wb").write(text.encode())
    assert cut(name, size, chunk) == expected(text.encode())


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_equals_built_in_reader(spark, scratch, ends):
    rng = random.Random(4)
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";", lineterminator=ends, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["id", "text", "day", "price"])
    for i in range(400):
        text = "".join(rng.choice(['"', ";", ends, "é", "word ", '""', "x"]) for _ in range(rng.randrange(0, 30)))
        writer.writerow([i, text, f"2024-01-{1 + i % 28:02d}" if i % 5 else "", round(rng.random(), 3) if i % 7 else ""])
    path = scratch + "/one.csv"
    open(path, "w", newline="", encoding="utf-8").write(out.getvalue())
    schema = "id int, text string, day date, price decimal(5,3)"
    want = read_csv(spark, path, schema)
    for size in (997, 4096, 1 << 20):
        got = c.read_csv_ranges(spark, path, schema, range_bytes=size)
        assert got.rdd.getNumPartitions() == -(-len(out.getvalue().encode()) // size)
        assert got.schema == want.schema and rows_of(got) == rows_of(want)
    assert want.count() == 400


def test_written_files_without_schema(spark, scratch):
    rows = [(i, f'line {i}\n"q";é' * (i % 4), None if i % 3 else "z") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, `a text` string, z string").repartition(3)
    write_csv(df, scratch + "/out")
    got = c.read_csv_ranges(spark, scratch + "/out", keep_empty_strings=True, range_bytes=500)
    assert got.columns == ["id", "a text", "z"] and dict(got.dtypes)["id"] == "string"
    assert sorted((int(r[0]), r[1], r[2]) for r in got.collect()) == sorted(rows)


def test_nothing_to_read(spark, scratch):
    open(scratch + "/empty.csv", "w").close()
    assert c.read_csv_ranges(spark, scratch, "a int").collect() == []
    open(scratch + "/head.csv", "w").write("a;b\n")
    assert c.read_csv_ranges(spark, scratch, "a int, b int").collect() == []
    with pytest.raises(ValueError):
        c.read_records(spark, scratch, sep="||")
