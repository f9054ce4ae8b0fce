"""END ends its file, growing files, byte-limited triggers, narrow winners."""

import base64
import os
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators.frames import arrival_number, decode_packets, latest_per_id, parse_packets, until_end
from tessera.sources.packets import read_packet_lines
from tessera.streaming import tail_source
from tessera.streaming.packets import start_frame_file_stream, start_packet_stream


def packet(i, data):
    return f"{i}|{base64.b64encode(data.encode()).decode()}"


def put(path, lines, end="\n", mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, newline="") as f:
        f.write("".join(x + end for x in lines))


def frames_in(folder):
    return {n: open(f"{folder}/{n}", "rb").read().decode() for n in sorted(os.listdir(folder)) if n.startswith("frame_")}


# ------------------------------------------------------------------ END
def sender_files(folder):
    """Expected frames: a ends early, b has no marker, c begins with it, d ends twice."""
    put(f"{folder}/a.txt", [packet(i, f"a{i}") for i in range(300)] + ["END"] + [packet(i, f"late{i}") for i in range(200, 600)])
    put(f"{folder}/b.txt", [packet(i, f"b{i}") for i in range(1000, 1300)])
    put(f"{folder}/c.txt", ["END"] + [packet(i, "c") for i in range(2000, 2100)])
    put(f"{folder}/d.txt", [packet(3000, "d"), "END", packet(3001, "d"), "END", packet(3002, "d")])
    return {**{i: f"a{i}" for i in range(300)}, **{i: f"b{i}" for i in range(1000, 1300)}, 3000: "d"}


@pytest.mark.parametrize("split", ["128m", "700", "64"])
def test_end_ends_its_file_wherever_splits_fall(spark, scratch, split):
    want = sender_files(scratch + "/in")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = until_end(read_packet_lines(spark, scratch + "/in", with_arrival=True))
        got = {r.frame_id: bytes(r.data).decode() for r in decode_packets(parse_packets(lines)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == want


def test_end_in_a_stream(spark, scratch):
    want = sender_files(scratch + "/in")
    q = start_frame_file_stream(spark, scratch + "/in", scratch + "/frames", scratch + "/checkpoint")
    q.awaitTermination()
    assert q.exception() is None
    assert frames_in(scratch + "/frames") == {f"frame_{i:04d}.jpg": v for i, v in want.items()}


# -------------------------------------------------------- latest per id
def test_winners_are_found_on_narrow_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"), F.col("id").cast("string").cast("binary").alias("v"))
    latest = latest_per_id(df, "k", "t", ["v"], unique_order=True)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan
    assert {r.k: int(bytes(r.v)) for r in latest.collect()} == {k: max(i for i in range(1000) if i % 7 == k) for k in range(7)}


def test_ties_and_nulls_keep_their_rule(spark):
    rows = [(1, 5, "a"), (1, 5, "c"), (1, 5, "b"), (1, 4, "z"), (None, 1, "n"), (None, 2, "m"), (2, None, "x")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    assert {r.k: (r.t, r.v) for r in latest_per_id(df, "k", "t", ["v"]).collect()} == {1: (5, "c"), None: (2, "m"), 2: (None, "x")}


def test_arrival_number_orders_like_the_struct(spark, scratch):
    for i, name in enumerate(("b", "a", "c")):
        put(f"{scratch}/in/{name}.txt", [packet(j, f"{name}{j}") for j in range(40)])
        os.utime(f"{scratch}/in/{name}.txt", (1_700_000_000 + i // 2, 1_700_000_000 + i // 2))
    rows = arrival_number(read_packet_lines(spark, scratch + "/in", with_arrival=True)).collect()
    by_struct = sorted(rows, key=lambda r: (r.arrival.mtime, r.arrival.file, r.arrival.block, r.arrival.pos))
    assert by_struct == sorted(rows, key=lambda r: r.arrival_number) and len({r.arrival_number for r in rows}) == 120


def test_last_arrival_wins_across_files(spark, scratch):
    for i, name in enumerate(("b", "a")):  # a is the later file
        put(f"{scratch}/in/{name}.txt", [packet(j % 5, f"{name}{j}") for j in range(20)])
        os.utime(f"{scratch}/in/{name}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    q = start_frame_file_stream(spark, scratch + "/in", scratch + "/frames", scratch + "/checkpoint")
    q.awaitTermination()
    assert frames_in(scratch + "/frames") == {f"frame_{j:04d}.jpg": f"a{15 + j}" for j in range(5)}


# ------------------------------------------------------------- backlog
def test_triggers_are_bounded_by_bytes(spark, scratch):
    sizes = [10, 400, 10, 10, 900, 10, 200, 10]
    for i, n in enumerate(sizes):
        put(f"{scratch}/in/{i}.txt", [packet(1000 * i + j, "x" * 30) for j in range(n)])
        os.utime(f"{scratch}/in/{i}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    limit = 20_000
    q = start_packet_stream(spark, scratch + "/in", scratch + "/out", scratch + "/checkpoint", max_bytes_per_trigger=limit)
    q.awaitTermination()
    line = os.path.getsize(f"{scratch}/in/0.txt") // 10
    rows = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert len(rows) >= 3 and sum(rows) == sum(sizes)  # nothing dropped
    # a batch goes over the limit by its first file at most
    assert all(n * line <= limit + max(sizes) * (line + 4) and (n * line <= limit + 5000 or n >= 400) for n in rows)
    assert spark.read.parquet(scratch + "/out").count() == sum(sizes)


# ------------------------------------------------------- growing files
def follow(spark, scratch):
    q = start_packet_stream(spark, scratch + "/in", scratch + "/out", scratch + "/checkpoint", follow=True, live=True,
                            batch_interval="200 milliseconds")
    return q


def read_frames(spark, scratch):
    if not os.path.isdir(scratch + "/out"):
        return []
    return sorted((r.frame_id, bytes(r.data).decode()) for r in spark.read.schema("frame_id long, data binary").parquet(scratch + "/out").collect())


def wait_for(spark, scratch, want):
    until = time.time() + 60
    while time.time() < until:
        if read_frames(spark, scratch) == want:
            return
        time.sleep(0.3)
    assert read_frames(spark, scratch) == want


def test_appended_lines_are_read_once_and_survive_a_restart(spark, scratch):
    put(scratch + "/in/a.txt", [packet(1, "one"), packet(2, "two")])
    q = follow(spark, scratch)
    try:
        want = [(1, "one"), (2, "two")]
        wait_for(spark, scratch, want)
        half = packet(3, "three")
        put(scratch + "/in/a.txt", [half[:4]], end="", mode="a")  # an unfinished line waits
        put(scratch + "/in/b.txt", [packet(10, "ten")], end="\r\n")
        want = sorted([*want, (10, "ten")])
        wait_for(spark, scratch, want)
        put(scratch + "/in/a.txt", [half[4:], packet(4, "four")], mode="a")
        want = sorted([*want, (3, "three"), (4, "four")])
        wait_for(spark, scratch, want)
    finally:
        q.stop()
    put(scratch + "/in/a.txt", [packet(5, "five")], mode="a")
    q = follow(spark, scratch)
    try:
        wait_for(spark, scratch, sorted([*want, (5, "five")]))
        q.processAllAvailable()
        assert read_frames(spark, scratch) == sorted([*want, (5, "five")])
    finally:
        q.stop()
    assert q.exception() is None


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
@pytest.mark.parametrize("chunk", [1, 4, 1 << 20])
def test_ranges_own_the_lines_that_begin_in_them(tmp_path, monkeypatch, size, chunk):
    monkeypatch.setattr(tail_source, "CHUNK", chunk)
    data = b"ab\n\ncdef\r\n\xc3\xa9\nlong long line\nx\ntail"
    open(tmp_path / "f", "wb").write(data)
    filesystem, root = tail_source._open(str(tmp_path))
    end = tail_source.whole_lines_end(filesystem, f"{root}/f", 0, len(data))
    assert end == data.rfind(b"\n") + 1
    for begin in (0, 3, 4):  # where an earlier batch ended
        got = [x for a in range(begin, end, size)
               for x in tail_source.lines_of(filesystem, f"{root}/f", a, min(a + size, end), a == begin)]
        lines, at, want = data[:end].split(b"\n")[:-1], 0, []
        for line in lines:
            if at >= begin:
                want.append((line.removesuffix(b"\r"), at))
            at += len(line) + 1
        assert got == want
