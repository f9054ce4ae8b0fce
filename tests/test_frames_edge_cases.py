"""Edge cases of the frame-packet pipeline: parsing, decoding, masked
replacement, latest-wins, file sink, streaming vs batch."""

import base64
import os


from tessera.functions.scalars import b64_decode, b64_encode, frame_file_name
from tessera.operators.frames import (
    decode_packets,
    encode_packets,
    frame_counters,
    latest_per_id,
    masked_replace,
    masked_replace_channels,
    parse_packets,
    with_model_mask,
)
from tessera.sources.frame_files import read_frame_files, write_frame_files
from tessera.sources.packets import read_packet_lines
from tessera.streaming.packets import start_frame_file_stream, start_packet_stream

LINES = ["5|aGVsbG8=", "bad", "x|y", "6|%%%", "END", "7|AENDAAAA", "8|a|b"]


def _decoded(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    return {r.frame_id: bytes(r.data) for r in decode_packets(parse_packets(df)).collect()}


def test_packet_parse_and_decode(spark):
    out = _decoded(spark, LINES)
    assert out[5] == b"hello"
    assert out[7] == base64.b64decode("AENDAAAA")  # 'END' inside a payload is data
    assert set(out) == {5, 7}  # bad, x|y, END dropped at parse; 6 empty; 8 bad padding


def test_second_separator_stays_in_payload(spark):
    df = spark.createDataFrame([("8|a|b",)], "value string")
    row = parse_packets(df).first()
    assert (row.frame_id, row.payload) == (8, "a|b")


def test_decode_agrees_with_python(spark):
    cases = ["aGVsbG8=", "%%%", "AENDAAAA", "a|b", "aGVsbG8", "aGVs bG8=", "aGVs\nbG8="]
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    got = [r.d for r in df.select(b64_decode("p").alias("d")).collect()]
    for c, d in zip(cases, got):
        try:
            want = base64.b64decode(c)
        except Exception:
            want = None
        assert (None if d is None else bytes(d)) == want, c


def test_long_payload_single_line_round_trip(spark):
    data = bytes(range(256)) * 3
    df = spark.createDataFrame([(1, bytearray(data))], "id long, b binary")
    enc = encode_packets(df, "id", "b").first()
    assert "\n" not in enc.payload and "\r" not in enc.payload
    assert enc.payload == base64.b64encode(data).decode()
    assert enc.size == len(enc.payload) and enc.packet == f"1|{enc.payload}"
    back = spark.createDataFrame([(enc.payload,)], "p string").select(b64_decode("p").alias("d")).first().d
    assert bytes(back) == data


def test_metadata_struct(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, s string")
    m = encode_packets(df, "id", "s", with_metadata=True).first().metadata
    assert m.frame_id == 1 and m.size == 4 and m.timestamp is not None


def test_mask_threshold(spark):
    df = spark.createDataFrame([(1, [10.0, 20.0, 30.0, 40.0], [0.0, 0.2, 0.3, 1.0])],
                               "frame_id long, pixels array<double>, mask array<double>")
    r = masked_replace(df, "pixels", "mask").first()
    assert r.pixels == [10.0, 20.0, 192.0, 192.0] and r.replaced is True


def test_mask_threshold_in_the_masks_own_type(spark):
    for t in ("float", "double", "decimal(5,2)"):
        df = spark.createDataFrame([(1, [10, 20, 30])], "frame_id long, pixels array<int>").selectExpr(
            "*", f"transform(array('0.2', '0.3', '0.0'), x -> cast(x AS {t})) AS mask")
        assert masked_replace(df, "pixels", "mask").first().pixels == [10, 192, 30]


def test_model_mask_on_integer_pixels(spark):
    from tessera.operators.frames import with_model_mask

    df = spark.createDataFrame([(1, [10, 20, 30])], "frame_id long, pixels array<int>")
    masked = with_model_mask(df, "pixels", lambda p: p / 100.0)
    r = masked_replace(masked, "pixels", "mask").first()
    assert r.pixels == [10, 20, 192] and r.replaced is True


def test_mask_null_or_wrong_length_keeps_original(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 2.0], None), (2, [1.0, 2.0], [1.0])],
        "frame_id long, pixels array<double>, mask array<double>",
    )
    out = {r.frame_id: (r.pixels, r.replaced) for r in masked_replace(df, "pixels", "mask").collect()}
    assert out == {1: ([1.0, 2.0], False), 2: ([1.0, 2.0], False)}


def test_rgb_mask_broadcast_over_channels(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 5, 6], [0.0, 0.9])], "frame_id long, pixels array<int>, mask array<double>")
    r = masked_replace_channels(df, "pixels", "mask").first()
    assert r.pixels == [1, 2, 3, 192, 192, 192] and r.replaced
    cnt = frame_counters(masked_replace_channels(df, "pixels", "mask")).first()
    assert (cnt.frames, cnt.replaced, cnt.kept) == (1, 1, 0)


def test_model_mask_extension_point(spark):
    df = spark.createDataFrame([(1, [0.1, 0.9]), (2, [0.5])], "frame_id long, pixels array<double>")

    def model(px):
        if len(px) == 1:
            raise ValueError("model failure")
        return (px > 0.5).astype(float)

    out = masked_replace(with_model_mask(df, "pixels", model), "pixels", "mask")
    got = {r.frame_id: (r.pixels, r.replaced) for r in out.collect()}
    assert got == {1: ([0.1, 192.0], True), 2: ([0.5], False)}


def test_latest_per_id_later_wins(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "only")], "id long, t long, v string")
    out = {r.id: r.v for r in latest_per_id(df, "id", "t", ["v"]).collect()}
    assert out == {1: "new", 2: "only"}


def test_frame_file_sink_overwrite_and_read_back(spark, scratch):
    path = f"{scratch}/frames"
    first = spark.createDataFrame([(7, bytearray(b"a")), (12345, bytearray(b"bb"))], "id long, content binary")
    write_frame_files(first.select(frame_file_name("id").alias("file_name"), "content"), path)
    second = spark.createDataFrame([(7, bytearray(b"ccc"))], "id long, content binary")
    write_frame_files(second.select(frame_file_name("id").alias("file_name"), "content"), path)
    files = {r.file_name: bytes(r.content) for r in read_frame_files(spark, path).collect()}
    assert files == {"frame_0007.jpg": b"ccc"}  # overwrite emptied the folder first
    write_frame_files(first.select(frame_file_name("id").alias("file_name"), "content"), path, mode="append")
    files = {r.file_name: bytes(r.content) for r in read_frame_files(spark, path).collect()}
    assert files == {"frame_0007.jpg": b"a", "frame_12345.jpg": b"bb"}
    assert not [f for f in os.listdir(path) if f.endswith(".tmp")]


def _packet_files(scratch, batches):
    os.makedirs(f"{scratch}/in", exist_ok=True)
    for i, lines in enumerate(batches):
        with open(f"{scratch}/in/part-{i:03d}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(f"{scratch}/in/part-{i:03d}.txt", (1_000_000 + i, 1_000_000 + i))


def test_stream_equals_batch_and_rerun_adds_nothing(spark, scratch):
    _packet_files(scratch, [LINES, ["9|d29ybGQ=", "END"]])
    q = start_packet_stream(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination()
    streamed = sorted((r.frame_id, bytes(r.data)) for r in spark.read.parquet(f"{scratch}/out").collect())
    batch = sorted(
        (r.frame_id, bytes(r.data)) for r in decode_packets(parse_packets(read_packet_lines(spark, f"{scratch}/in"))).collect()
    )
    assert streamed == batch and len(batch) == 3
    q2 = start_packet_stream(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt")
    q2.awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == 3


def test_frame_file_stream_last_arrival_wins(spark, scratch):
    first = base64.b64encode(b"first").decode()
    second = base64.b64encode(b"second").decode()
    third = base64.b64encode(b"third").decode()
    _packet_files(scratch, [[f"1|{first}", f"2|{first}"], [f"1|{second}", f"1|{third}"]])
    q = start_frame_file_stream(spark, f"{scratch}/in", f"{scratch}/frames", f"{scratch}/ckpt")
    q.awaitTermination()
    files = {r.file_name: bytes(r.content) for r in read_frame_files(spark, f"{scratch}/frames").collect()}
    assert files == {"frame_0001.jpg": b"third", "frame_0002.jpg": b"first"}


def test_arrival_order_within_batch_files(spark, scratch):
    a = base64.b64encode(b"a").decode()
    b = base64.b64encode(b"b").decode()
    _packet_files(scratch, [[f"1|{a}"], [f"1|{b}"]])
    lines = read_packet_lines(spark, f"{scratch}/in", with_arrival=True)
    frames = decode_packets(parse_packets(lines, keep=["arrival"]))
    out = latest_per_id(frames, "frame_id", "arrival", ["data"]).first()
    assert bytes(out.data) == b"b"


def test_b64_encode_of_text_is_utf8(spark):
    df = spark.createDataFrame([("héllo",)], "s string")
    assert df.select(b64_encode("s").alias("e")).first().e == base64.b64encode("héllo".encode()).decode()


def test_packet_counters_one_pass(spark):
    from tessera.operators.frames import packet_counters

    df = spark.createDataFrame([(v,) for v in LINES], "value string")
    c = packet_counters(df).first()
    # received 7; END once; packets: 5, 6, 7, 8 have an integer id; frames: 5 and 7
    assert (c.received, c.end_markers, c.packets, c.frames) == (7, 1, 4, 2)


def test_stream_reports_observed_counters(spark, scratch):
    _packet_files(scratch, [LINES])
    q = start_packet_stream(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination()
    metrics = [p["observedMetrics"] for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics, "no observed metrics in progress"
    m = metrics[0]
    assert int(m["packet_lines"]["received"]) == 7 and int(m["packet_lines"]["end_markers"]) == 1
    assert int(m["decoded_frames"]["frames"]) == 2


def test_live_stream_restart_resumes_from_checkpoint(spark, scratch):
    hello, world = base64.b64encode(b"hello").decode(), base64.b64encode(b"world").decode()
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.txt", "w") as f:
        f.write(f"1|{hello}\nEND\n")
    q = start_packet_stream(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt", live=True,
                            batch_interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.frame_id for r in spark.read.parquet(f"{scratch}/out").collect()) == [1]
    # new data arrives while the query is down; a restart on the same
    # checkpoint picks up only the new file
    with open(f"{scratch}/in/b.txt", "w") as f:
        f.write(f"2|{world}\n")
    q = start_packet_stream(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt", live=True)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.frame_id, bytes(r.data)) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == [(1, b"hello"), (2, b"world")]


def test_replace_in_frames_and_failing_masks(spark):
    from tessera.operators.frames import replace_in_frames

    df = spark.createDataFrame([(1, bytes([0, 50, 52, 255])), (2, b"abc"), (3, b"")], "frame_id long, data binary")

    def mask(pixels):
        return pixels[:1] if len(pixels) == 3 else pixels / 255.0

    got = {r.frame_id: (bytes(r.data), r.replaced) for r in replace_in_frames(df, mask).collect()}
    assert got == {1: (bytes([0, 50, 192, 192]), True), 2: (b"abc", False), 3: (b"", True)}


def test_frame_sink_skips_and_counts_bad_rows(spark, scratch):
    import os

    from tessera.sources.frame_files import read_frame_files, saved_counts, write_frame_files

    rows = [("frame_0001.jpg", b"a"), ("bad/name", b"b"), (None, b"c"), ("frame_0002.jpg", None), ("frame_0003.jpg", b"d")]
    df = spark.createDataFrame(rows, "file_name string, content binary").repartition(3)
    write_frame_files(df, f"{scratch}/frames")
    assert saved_counts(f"{scratch}/frames") == {"saved": 2, "skipped": 3}
    assert sorted(r.file_name for r in read_frame_files(spark, f"{scratch}/frames").collect()) == [
        "frame_0001.jpg", "frame_0003.jpg"]
    assert not [f for f in os.listdir(f"{scratch}/frames") if f.endswith(".tmp")]
