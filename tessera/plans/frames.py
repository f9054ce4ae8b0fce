"""Frame-packet questions, on data derived from the tables:

* packets: ``pages`` (page_id, html) as frames of bytes;
* repeated frame ids: ``conversations`` (conv_id as frame id, turn as
  arrival order, text as bytes);
* pixels and masks: ``embeddings`` vectors (pixels = the vector, the mask
  taken from the same vector; a stand-in rule marks some frames as having
  no usable mask, which exercises the keep-original path);
* JSON messages: ``events``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import frame_file_name
from tessera.operators.frames import (
    END_MARKER,
    decode_packets,
    encode_packets,
    frame_counters,
    latest_per_id,
    masked_replace,
    masked_replace_channels,
    packet_counters,
    parse_packets,
    replace_in_frames,
    until_end,
    with_batched_mask,
)
from tessera.operators.join import union_all
from tessera.operators.partitioning import sized_partitions
from tessera.plans.registry import query
from tessera.session import scratch_dir
from tessera.sources import tables as T
from tessera.sources.frame_files import read_frame_files, saved_counts, write_frame_files
from tessera.sources.packets import read_json_lines, read_packet_lines, write_json_lines, write_packet_lines
from tessera.streaming.packets import start_frame_file_stream, start_packet_stream

# Stand-in rules for pixels/masks (fixed values).
RGB_FACTORS = (1, -1, 2)               # three channels of a pixel, from one vector element
ROWS_PER_PARTITION = 1000              # frames per partition ahead of heavy per-frame work
NO_MASK_LABEL = 0                      # frames with this label have no mask
SHORT_MASK_LABEL, SHORT_MASK_LEN = 1, 32  # frames with this label have a mask of the wrong length


BROKEN_BELOW = -0.125                  # the stand-in model fails on frames whose first pixel is below
SENDER_PAGES = 100                     # pages a sender's packet file holds
END_BEHIND = 59                        # place in its file of the last page in front of END (even senders)


# ------------------------------------------------------------------ builders
def page_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_packets(T.read_table(spark, sf_dir, "pages"), "page_id", "html", keep=["url"])


def packet_lines_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page packets plus faulty lines derived from them: a truncated
    payload (bad padding), a non-integer id (the url), and the ``END``
    marker line."""
    enc = page_packets(spark, sf_dir)
    fid = F.col("frame_id").cast("string")
    truncated = F.concat(fid, F.lit("|"), F.col("payload").substr(F.lit(1), F.length("payload") - 1))
    bad_id = F.concat(F.col("url"), F.lit("|"), F.col("payload"))
    # one scan and one encode per page, three lines out of it
    lines = enc.select(F.explode(F.array(F.col("packet"), truncated, bad_id)).alias("value"))
    end = spark.createDataFrame([(END_MARKER,)], "value string")
    return union_all(lines, end)


def decoded_page_frames(lines: DataFrame) -> DataFrame:
    frames = decode_packets(parse_packets(lines))
    return frames.select(
        "frame_id", F.length("data").alias("n_bytes"), F.decode("data", "UTF-8").alias("text")
    )


def conversation_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with repeated ids: parse + decode of conversation packets,
    arrival order = turn."""
    conv = T.read_table(spark, sf_dir, "conversations")
    pk = encode_packets(conv, "conv_id", "text", keep=["turn"])
    return decode_packets(parse_packets(pk.select("turn", F.col("packet").alias("value")), keep=["turn"]))


def latest_conversation_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_per_id(conversation_frames(spark, sf_dir), "frame_id", "turn", ["data"])
    return latest.select(
        "frame_id",
        F.col("turn").alias("arrival"),
        frame_file_name("frame_id").alias("file_name"),
        "data",
    )


def pixel_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.read_table(spark, sf_dir, "embeddings")
    rev = F.reverse("embedding")
    return e.select(
        F.col("vec_id").alias("frame_id"),
        F.col("embedding").alias("pixels"),
        F.when(F.col("label") == SHORT_MASK_LABEL, F.slice(rev, 1, SHORT_MASK_LEN)).otherwise(rev).alias("mask"),
    )


def rgb_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three interleaved channels from every element of the vector, which
    itself is the mask: one value per pixel."""
    e = T.read_table(spark, sf_dir, "embeddings")
    channels = F.transform("embedding", lambda x: F.array(*[(x * float(k)).cast("float") for k in RGB_FACTORS]))
    return e.select(
        F.col("vec_id").alias("frame_id"),
        F.flatten(channels).alias("pixels"),
        F.when(F.col("label") != NO_MASK_LABEL, F.col("embedding")).alias("mask"),
    )


def rgb_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_replace_channels(rgb_frames(spark, sf_dir), "pixels", "mask").select(
        "frame_id", "pixels", "replaced"
    )


def _stand_in_model():
    """Stands in for loading a segmentation model: mask values are the pixels'
    sizes; a call with a broken frame fails as a whole."""

    def model(stack):
        if (stack[:, 0] < BROKEN_BELOW).any():
            raise ValueError("broken frame")
        return np.abs(stack).astype(np.float64)

    return model


def write_sender_files(lines: DataFrame, path: str, order: list[str]) -> None:
    """One text file per sender with its lines in order (columns sender, value)."""
    (lines.repartition("sender").sortWithinPartitions("sender", *order).select("sender", "value")
     .write.partitionBy("sender").text(path))


def write_ended_senders(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Packets of every SENDER_PAGES pages in one file; even senders end early,
    with packets behind the marker."""
    packets = page_packets(spark, sf_dir).withColumn("sender", F.floor(F.col("frame_id") / SENDER_PAGES))
    last = (F.col("sender") % 2 == 0) & (F.col("frame_id") % SENDER_PAGES == END_BEHIND)
    lines = F.when(last, F.array("packet", F.lit(END_MARKER))).otherwise(F.array("packet"))
    write_sender_files(packets.select("sender", "frame_id", F.posexplode(lines).alias("k", "value")), path, ["frame_id", "k"])


# --------------------------------------------------------------------- SQL
SQL_ENC = "SELECT page_id, url, to_base64(encode(html)) AS payload FROM pages"
SQL_LINES = f"""enc AS ({SQL_ENC}),
lines AS (SELECT CAST(page_id AS VARCHAR) || '|' || payload AS value FROM enc
          UNION ALL SELECT CAST(page_id AS VARCHAR) || '|' || substr(payload, 1, length(payload) - 1) FROM enc
          UNION ALL SELECT url || '|' || payload FROM enc
          UNION ALL SELECT '{END_MARKER}'),
parsed AS (SELECT TRY_CAST(split_part(value, '|', 1) AS BIGINT) AS frame_id,
                  regexp_replace(substr(value, strpos(value, '|') + 1), '[^A-Za-z0-9+/=]', '', 'g') AS p
           FROM lines WHERE strpos(value, '|') > 0),
trimmed AS (SELECT frame_id, p, rtrim(p, '=') AS d FROM parsed WHERE frame_id IS NOT NULL),
dec AS (SELECT frame_id,
               CASE WHEN strpos(d, '=') = 0
                     AND (length(d) % 4 = 0 OR (length(d) % 4 = 2 AND length(p) - length(d) >= 2)
                          OR (length(d) % 4 = 3 AND length(p) - length(d) >= 1))
                    THEN from_base64(d || repeat('=', (4 - length(d) % 4) % 4)) END AS data
        FROM trimmed)"""
SQL_DECODED = (
    "SELECT frame_id, CAST(octet_length(data) AS INTEGER) AS n_bytes, decode(data) AS text "
    "FROM dec WHERE data IS NOT NULL AND octet_length(data) > 0"
)
SQL_LATEST = """c AS (SELECT conv_id, turn, text FROM conversations WHERE octet_length(encode(text)) > 0),
latest AS (SELECT conv_id AS frame_id, max(turn) AS arrival, printf('frame_%04d.jpg', conv_id) AS file_name,
                  arg_max(text, turn) AS text FROM c GROUP BY conv_id)"""
SQL_RGB = f"""f AS (SELECT vec_id AS frame_id,
                  flatten(list_transform(embedding, lambda x: [{', '.join(f'CAST(x * {k} AS FLOAT)' for k in RGB_FACTORS)}])) AS px,
                  CASE WHEN label <> {NO_MASK_LABEL} THEN embedding END AS mask
           FROM embeddings),
g AS (SELECT frame_id, px, mask, COALESCE(mask IS NOT NULL AND px IS NOT NULL AND len(px) = len(mask) * 3, false) AS ok FROM f),
out AS (SELECT frame_id,
               CASE WHEN ok THEN list_transform(generate_series(1, len(px)),
                    lambda i: CASE WHEN mask[((i - 1) // 3) + 1] > CAST(0.2 AS FLOAT) THEN CAST(192 AS FLOAT) ELSE px[i] END)
                    ELSE px END AS pixels,
               ok AS replaced FROM g)"""


# ------------------------------------------------------------------ queries
@query(
    "packet_encode",
    f"""WITH enc AS ({SQL_ENC})
SELECT page_id AS frame_id, payload, CAST(length(payload) AS INTEGER) AS size,
       CAST(page_id AS VARCHAR) || '|' || payload AS packet FROM enc""",
    "SCA15 SNK2 SCA17",
)
def packet_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_packets(spark, sf_dir).select("frame_id", "payload", "size", "packet")


@query(
    "packet_metadata",
    f"""WITH enc AS ({SQL_ENC})
SELECT page_id AS frame_id, page_id AS meta_frame_id, CAST(length(payload) AS INTEGER) AS meta_size, true AS stamped,
       CAST(page_id AS VARCHAR) || '|' || payload AS packet FROM enc""",
    "SCA18 STR5",
)
def packet_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets with their metadata struct; of its time only whether it is set."""
    packets = encode_packets(T.read_table(spark, sf_dir, "pages"), "page_id", "html", with_metadata=True)
    meta = F.col("metadata")
    return packets.select("frame_id", meta["frame_id"].alias("meta_frame_id"), meta["size"].alias("meta_size"),
                          meta["timestamp"].isNotNull().alias("stamped"), "packet")


@query(
    "packet_sized_partitions",
    f"""WITH enc AS ({SQL_ENC})
SELECT page_id AS frame_id, payload FROM enc""",
    "SRC4 SCA15",
)
def packet_sized_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets in partitions of a set number of frames."""
    return sized_partitions(page_packets(spark, sf_dir).select("frame_id", "payload"), ROWS_PER_PARTITION)


@query(
    "packet_parse",
    f"WITH {SQL_LINES}\n{SQL_DECODED}",
    "FIL6 FIL7 SCA3 SCA16 FIL5",
)
def packet_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded_page_frames(packet_lines_with_faults(spark, sf_dir))


@query(
    "packet_counters",
    f"""WITH {SQL_LINES}
SELECT (SELECT COUNT(*) FROM lines) AS received,
       (SELECT COUNT(*) FROM lines WHERE value = '{END_MARKER}') AS end_markers,
       (SELECT COUNT(*) FROM parsed WHERE frame_id IS NOT NULL) AS packets,
       (SELECT COUNT(*) FROM dec WHERE data IS NOT NULL AND octet_length(data) > 0) AS frames""",
    "AGG19 FIL6 FIL7 SCA16",
)
def packet_counters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receiver counters over all packet lines in one pass."""
    return packet_counters(packet_lines_with_faults(spark, sf_dir))


@query(
    "packet_batch_files",
    f"WITH {SQL_LINES}\n{SQL_DECODED}",
    "SNK2 SRC5 FIL6 SCA16",
)
def packet_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packet lines written to files, then read back as a batch."""
    path = scratch_dir(spark, "packets")
    write_packet_lines(packet_lines_with_faults(spark, sf_dir), path)
    return decoded_page_frames(read_packet_lines(spark, path))


@query(
    "packet_stream",
    f"WITH {SQL_LINES}\n{SQL_DECODED}",
    "SRC5 STR1 STR2",
)
def packet_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packet files processed by a streaming query (available-now trigger,
    parquet sink with checkpoint), result read back."""
    base = scratch_dir(spark, "packet-stream")
    write_packet_lines(packet_lines_with_faults(spark, sf_dir), f"{base}/in")
    q = start_packet_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"packet stream failed: {q.exception()}")
    out = spark.read.parquet(f"{base}/out")
    return out.select(
        "frame_id", F.length("data").alias("n_bytes"), F.decode("data", "UTF-8").alias("text")
    )


SQL_UNTIL_END = f"""u AS (SELECT page_id, html FROM pages WHERE ((page_id // {SENDER_PAGES}) % 2 = 1
      OR page_id % {SENDER_PAGES} <= {END_BEHIND}) AND octet_length(encode(html)) > 0)"""


@query(
    "packet_until_end",
    f"""WITH {SQL_UNTIL_END}
SELECT page_id AS frame_id, CAST(octet_length(encode(html)) AS INTEGER) AS n_bytes, html AS text FROM u""",
    "FIL7 SRC5",
)
def packet_until_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packet files of several senders, each read up to its END marker."""
    path = scratch_dir(spark, "ended-senders")
    write_ended_senders(spark, sf_dir, path)
    return decoded_page_frames(until_end(read_packet_lines(spark, path, with_arrival=True)))


@query(
    "packet_until_end_stream",
    f"""WITH {SQL_UNTIL_END}
SELECT printf('frame_%04d.jpg', page_id) AS file_name, CAST(octet_length(encode(html)) AS BIGINT) AS length,
       hex(encode(html)) AS content_hex FROM u""",
    "FIL7 SRC5 STR1 SNK3",
)
def packet_until_end_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as a stream, to one file per frame."""
    base = scratch_dir(spark, "ended-senders-stream")
    write_ended_senders(spark, sf_dir, f"{base}/in")
    return _streamed_frames(spark, base)


@query(
    "masked_replace",
    f"""WITH f AS (SELECT vec_id AS frame_id, embedding AS px,
                   CASE WHEN label = {SHORT_MASK_LABEL} THEN list_slice(list_reverse(embedding), 1, {SHORT_MASK_LEN})
                        ELSE list_reverse(embedding) END AS mask FROM embeddings),
g AS (SELECT frame_id, px, mask, COALESCE(mask IS NOT NULL AND px IS NOT NULL AND len(px) = len(mask), false) AS ok FROM f)
SELECT frame_id,
       CASE WHEN ok THEN list_transform(generate_series(1, len(px)),
            lambda i: CASE WHEN mask[i] > CAST(0.2 AS FLOAT) THEN CAST(192 AS FLOAT) ELSE px[i] END)
            ELSE px END AS pixels,
       ok AS replaced
FROM g""",
    "SCA21 STR4 UDF1",
)
def masked_replace_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_replace(pixel_frames(spark, sf_dir), "pixels", "mask").select(
        "frame_id", "pixels", "replaced"
    )


@query(
    "model_mask_replace",
    f"""SELECT vec_id AS frame_id,
       CASE WHEN embedding[1] < {BROKEN_BELOW} THEN embedding ELSE
         list_transform(embedding, lambda x: CASE WHEN CAST(abs(x) AS DOUBLE) > 0.2 THEN CAST(192 AS FLOAT) ELSE x END) END AS pixels,
       embedding[1] >= {BROKEN_BELOW} AS replaced
FROM embeddings""",
    "UDF4 SCA21",
)
def model_mask_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks made by a model that is loaded once per worker and sees many frames
    a call, then replaced pixels; frames it fails on stay as they are."""
    frames = T.read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("frame_id"), F.col("embedding").alias("pixels"))
    return masked_replace(with_batched_mask(frames, "pixels", _stand_in_model), "pixels", "mask").select(
        "frame_id", "pixels", "replaced")


@query(
    "masked_replace_rgb",
    f"WITH {SQL_RGB}\nSELECT frame_id, pixels, replaced FROM out",
    "SCA21 SCA23 STR4",
)
def masked_replace_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rgb_processed(spark, sf_dir)


@query(
    "frame_counters",
    f"""WITH {SQL_RGB}
SELECT COUNT(*) AS frames, COUNT(*) FILTER (WHERE replaced) AS replaced, COUNT(*) FILTER (WHERE NOT replaced) AS kept
FROM out""",
    "AGG19",
)
def frame_counters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_counters(rgb_processed(spark, sf_dir))


@query(
    "latest_frame_per_id",
    f"""WITH {SQL_LATEST}
SELECT frame_id, arrival, file_name, text, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes FROM latest""",
    "STR3 SCA14",
)
def latest_frame_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_conversation_frames(spark, sf_dir)
    return latest.select(
        "frame_id", "arrival", "file_name",
        F.decode("data", "UTF-8").alias("text"), F.length("data").alias("n_bytes"),
    )


@query(
    "frame_files",
    f"""WITH {SQL_LATEST}
SELECT file_name, CAST(octet_length(encode(text)) AS BIGINT) AS length, text FROM latest""",
    "SNK3 STR3 SCA14",
)
def frame_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest frame per id written as one file each (folder emptied first),
    then read back with the binary-file reader."""
    path = scratch_dir(spark, "frame-files")
    latest = latest_conversation_frames(spark, sf_dir)
    write_frame_files(latest.select("file_name", F.col("data").alias("content")), path)
    back = read_frame_files(spark, path)
    return back.select("file_name", "length", F.decode("content", "UTF-8").alias("text"))


@query(
    "latest_frame_stream",
    f"""WITH {SQL_LATEST}
SELECT file_name, CAST(octet_length(encode(text)) AS BIGINT) AS length, hex(encode(text)) AS content_hex FROM latest""",
    "STR3 STR1 SRC5 SNK3",
)
def latest_frame_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated frame ids as a stream: packets of whole conversations in files, in
    order of turns; the last one that arrived is each frame's file."""
    base = scratch_dir(spark, "repeated-frames")
    packets = encode_packets(T.read_table(spark, sf_dir, "conversations"), "conv_id", "text", keep=["turn"])
    lines = packets.select(F.floor(F.col("frame_id") / SENDER_PAGES).alias("sender"), "frame_id", "turn",
                           F.col("packet").alias("value"))
    write_sender_files(lines, f"{base}/in", ["frame_id", "turn"])
    return _streamed_frames(spark, base)


def _byte_mask():
    """Stands in for a segmentation model on raw bytes; it fails on frames of
    an odd number of bytes, which then stay as they are."""

    def mask(pixels):
        if len(pixels) % 2:
            raise ValueError("odd frame")
        return pixels / 255.0

    return mask


def _written_frames(spark: SparkSession, path: str) -> DataFrame:
    return read_frame_files(spark, path).select("file_name", "length", F.hex("content").alias("content_hex"))


def _streamed_frames(spark: SparkSession, base: str, transform=None) -> DataFrame:
    """Frames of the packet files in ``base/in``, through the frame-file stream."""
    q = start_frame_file_stream(spark, f"{base}/in", f"{base}/frames", f"{base}/checkpoint", transform=transform)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"frame stream failed: {q.exception()}")
    return _written_frames(spark, f"{base}/frames")


SQL_PIPELINE = f"""{SQL_LINES},
hexed AS (SELECT frame_id, data, hex(data) AS h FROM dec WHERE data IS NOT NULL AND octet_length(data) > 0),
done AS (SELECT frame_id, octet_length(data) AS n, octet_length(data) % 2 = 0 AS replaced,
                CASE WHEN octet_length(data) % 2 = 1 THEN h ELSE array_to_string(list_transform(
                     generate_series(1, octet_length(data)),
                     lambda i: CASE WHEN substr(h, 2 * i - 1, 2) > '33' THEN 'C0' ELSE substr(h, 2 * i - 1, 2) END), '')
                END AS content_hex FROM hexed)"""
SQL_PIPELINE_FILES = (
    f"WITH {SQL_PIPELINE}\nSELECT printf('frame_%04d.jpg', frame_id) AS file_name, CAST(n AS BIGINT) AS length, content_hex FROM done"
)


@query("frame_pipeline_batch", SQL_PIPELINE_FILES, "FIL6 FIL7 SCA16 FIL5 UDF4 STR4 SNK3 SCA14")
def frame_pipeline_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets to decoded, masked and replaced frames to one file each."""
    path = scratch_dir(spark, "frame-pipeline")
    frames = replace_in_frames(decode_packets(parse_packets(packet_lines_with_faults(spark, sf_dir))), _byte_mask())
    write_frame_files(frames.select(frame_file_name("frame_id").alias("file_name"), F.col("data").alias("content")), path)
    return _written_frames(spark, path)


@query("frame_pipeline_stream", SQL_PIPELINE_FILES, "SRC5 STR1 STR2 STR3 UDF4 STR4 SNK3")
def frame_pipeline_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pipeline as a stream over packet files."""
    base = scratch_dir(spark, "frame-pipeline-stream")
    write_packet_lines(packet_lines_with_faults(spark, sf_dir), f"{base}/in")
    mask = _byte_mask()
    return _streamed_frames(spark, base, lambda frames: replace_in_frames(frames, mask))


@query(
    "frame_pipeline_counters",
    f"""WITH {SQL_PIPELINE}
SELECT (SELECT COUNT(*) FROM lines) AS received, COUNT(*) AS decoded, COUNT(*) FILTER (WHERE replaced) AS replaced,
       COUNT(*) AS saved, CAST(0 AS BIGINT) AS skipped
FROM done""",
    "AGG19 FIL6 SCA16 STR4 SNK3",
)
def frame_pipeline_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines received, frames decoded, replaced and saved as files, all counted
    in the one pass that writes the files."""
    path = scratch_dir(spark, "frame-counters")
    received, made = Observation("packet_lines"), Observation("frames")
    lines = packet_lines_with_faults(spark, sf_dir).observe(received, F.count(F.lit(1)).alias("received"))
    frames = replace_in_frames(decode_packets(parse_packets(lines)), _byte_mask()).observe(
        made, F.count(F.lit(1)).alias("decoded"), F.count_if("replaced").alias("replaced"))
    write_frame_files(frames.select(frame_file_name("frame_id").alias("file_name"), F.col("data").alias("content")), path)
    counts = {**received.get, **made.get, **saved_counts(path)}
    return spark.range(1).select(*[F.lit(counts[c]).cast("bigint").alias(c)
                                   for c in ("received", "decoded", "replaced", "saved", "skipped")])


@query(
    "json_lines_message",
    """SELECT event_id, event_type AS message, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(to_json({'message': event_type}) AS VARCHAR) AS line FROM events""",
    "SRC6 SCA19",
)
def json_lines_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON lines, read back with a declared schema; the
    nested ``props`` JSON text is parsed and a message line is produced."""
    path = scratch_dir(spark, "json-lines")
    ev = T.read_table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("message"), "props"
    )
    write_json_lines(ev, path)
    back = read_json_lines(spark, path, "event_id bigint, message string, props string")
    return back.select(
        "event_id",
        "message",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.to_json(F.struct("message")).alias("line"),
    )
