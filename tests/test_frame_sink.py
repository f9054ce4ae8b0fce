"""The frame sink publishes whole sets: failed jobs leave the folder as it was."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import frame_files as ff

SCHEMA = "file_name string, content binary"


def frames(spark, names, content=b"x", partitions=4):
    return spark.createDataFrame([(n, content) for n in names], SCHEMA).repartition(partitions)


def failing(spark, names):
    """Frames whose last partition fails after others have written."""
    df = frames(spark, names, b"new")
    return df.withColumn("file_name", F.when(F.col("file_name") != names[-1], F.col("file_name")).otherwise(
        F.raise_error(F.lit("broken frame")).cast("string")))


def listing(folder):
    return {n: open(f"{folder}/{n}", "rb").read() for n in sorted(os.listdir(folder)) if not n.startswith(".")}


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_failed_job_leaves_the_old_files_whole(spark, scratch, mode):
    out = scratch + "/frames"
    ff.write_frame_files(frames(spark, ["frame_1", "frame_2"], b"old"), out)
    before = listing(out)
    with pytest.raises(Exception, match="broken frame"):
        ff.write_frame_files(failing(spark, [f"frame_{i}" for i in range(40)]), out, mode)
    assert listing(out) == before and before["frame_1"] == b"old"
    assert os.listdir(scratch) == ["frames"]  # nothing staged is left


def test_overwrite_replaces_the_set_and_append_adds(spark, scratch):
    out = scratch + "/frames"
    ff.write_frame_files(frames(spark, ["frame_1", "frame_2"], b"old"), out)
    ff.write_frame_files(frames(spark, ["frame_2", "frame_3"], b"new"), out)
    assert {k: v for k, v in listing(out).items() if k != ff.COUNTS_NAME} == {"frame_2": b"new", "frame_3": b"new"}
    ff.write_frame_files(frames(spark, ["frame_3", "frame_4", None], b"more"), out, "append")
    assert {k: v for k, v in listing(out).items() if k != ff.COUNTS_NAME} == {
        "frame_2": b"new", "frame_3": b"more", "frame_4": b"more"}
    assert ff.saved_counts(out) == {"saved": 2, "skipped": 1}
    ff.write_frame_files(frames(spark, []), out)
    assert list(listing(out)) == [ff.COUNTS_NAME] and os.listdir(scratch) == ["frames"]


def test_half_done_swap_is_finished(spark, scratch):
    out = scratch + "/frames"
    ff.write_frame_files(frames(spark, ["frame_1"], b"old"), out)
    os.rename(out, f"{scratch}/_frames.old-1")  # the driver was lost between the two renames
    ff.recover(out)
    assert ff.read_frame_files(spark, out).count() == 1
    os.mkdir(f"{scratch}/_frames.old-2")  # or before it removed the old set
    ff.write_frame_files(frames(spark, ["frame_2"]), out)
    assert os.listdir(scratch) == ["frames"]


def test_stream_writer_publishes_batches(spark, scratch):
    source, out = scratch + "/in", scratch + "/frames"
    for i in range(3):
        frames(spark, [f"frame_{i}", "frame_last"], str(i).encode(), 1).write.mode("append").parquet(source)
    ff.register(spark)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(source)

    def run():
        q = (stream.writeStream.format(ff.FORMAT_NAME).option("checkpointLocation", scratch + "/checkpoint")
             .trigger(availableNow=True).start(out))
        q.awaitTermination()
        assert q.exception() is None

    run()
    want = {"frame_0": b"0", "frame_1": b"1", "frame_2": b"2"}
    got = listing(out)
    assert {k: got[k] for k in want} == want and set(got) == {*want, "frame_last", ff.COUNTS_NAME}
    run()  # nothing new
    assert listing(out) == got
