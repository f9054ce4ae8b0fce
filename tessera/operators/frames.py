"""Frame-packet operators: encode, parse, decode, masked replacement,
latest-per-id, counters.  Batch and streaming queries use the same
functions (they are plain column expressions)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, NumericType, StructField, StructType, TimestampNTZType,
    TimestampType,
)

from tessera.functions.scalars import (
    BACKGROUND_VALUE,
    MASK_THRESHOLD,
    b64_decode,
    b64_encode,
    b64_length,
    split_first,
)

# Fixed values of the packet format: ``<frame_id>|<base64>`` per line; a
# line ``END`` ends a sender's stream and carries no frame.
PACKET_SEPARATOR = "|"
END_MARKER = "END"


def encode_packets(
    df: DataFrame, id_col: str, data_col: str, keep: Sequence[str] = (), with_metadata: bool = False,
) -> DataFrame:
    """(frame_id, payload base64 text, size, packet line).

    ``with_metadata`` adds ``metadata struct(frame_id, size, timestamp)``
    stamped with the query's start time."""
    out = df.select(
        *keep,
        F.col(id_col).cast("bigint").alias("frame_id"),
        b64_encode(data_col).alias("payload"),
    )
    out = out.withColumn("size", F.length("payload")).withColumn(
        "packet", F.concat(F.col("frame_id").cast("string"), F.lit(PACKET_SEPARATOR), F.col("payload"))
    )
    if with_metadata:
        out = out.withColumn(
            "metadata", F.struct("frame_id", "size", F.current_timestamp().alias("timestamp"))
        )
    return out


def parse_packets(lines: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Packet lines -> (frame_id, payload).

    Lines without the separator (including ``END``) are dropped; the id is
    the text before the first separator and must be an integer, the payload
    is everything after it (further separators included)."""
    v = F.col(value_col)
    head, tail = split_first(v, PACKET_SEPARATOR)
    return (
        lines.filter(v.contains(PACKET_SEPARATOR))
        .select(*keep, head.try_cast("bigint").alias("frame_id"), tail.alias("payload"))
        .filter(F.col("frame_id").isNotNull())
    )


def decode_packets(packets: DataFrame, payload_col: str = "payload", out_col: str = "data") -> DataFrame:
    """Decode the base64 payload; rows that do not decode to at least one
    byte are dropped.

    The decode runs in a plain projection (generated code, where its shared
    sub-expressions are computed once); the rows are then kept through
    ``explode`` of a zero-or-one element array.  A ``filter`` on the decoded
    column would be pushed below the projection with the alias substituted,
    decoding twice, and decoding inside the higher-order function itself runs
    without code generation."""
    others = [c for c in packets.columns if c != payload_col]
    decoded = packets.select(*others, b64_decode(payload_col).alias(out_col))
    kept = F.filter(F.array(out_col), lambda d: F.length(d) > 0)
    return decoded.select(*others, F.explode(kept).alias(out_col))


def _element_type(df: DataFrame, col: str) -> DataType:
    t = df.schema[col].dataType
    if not isinstance(t, ArrayType):
        raise TypeError(f"{col} must be an array column, got {t.simpleString()}")
    return t.elementType


def masked_replace(
    df: DataFrame, pixels: str, mask: str, out: str = "pixels", flag: str = "replaced",
    background=BACKGROUND_VALUE, threshold: float = MASK_THRESHOLD,
) -> DataFrame:
    """Where ``mask > threshold`` use the background value, else keep the
    pixel (element-wise, mask and pixels of equal length).

    A missing mask or one of another length keeps the original pixels with
    ``flag = false`` (the per-frame failure path); otherwise ``flag = true``."""
    bg = F.lit(background).cast(_element_type(df, pixels))
    p, m = F.col(pixels), F.col(mask)
    ok = m.isNotNull() & p.isNotNull() & (F.size(m) == F.size(p))
    # compared in the mask's own type: a float 0.2 does not exceed 0.2
    limit = F.lit(threshold).cast(_element_type(df, mask))
    swapped = F.zip_with(p, m, lambda x, y: F.when(y > limit, bg).otherwise(x))
    return df.withColumn(flag, F.coalesce(ok, F.lit(False))).withColumn(
        out, F.when(F.col(flag), swapped).otherwise(p)
    )


def masked_replace_channels(
    df: DataFrame, pixels: str, mask: str, channels: int = 3, out: str = "pixels",
    flag: str = "replaced", background=BACKGROUND_VALUE, threshold: float = MASK_THRESHOLD,
) -> DataFrame:
    """Masked replacement for interleaved colour pixels: one mask value per
    pixel applies to all ``channels`` values of that pixel."""
    bg = F.lit(background).cast(_element_type(df, pixels))
    p, m = F.col(pixels), F.col(mask)
    ok = m.isNotNull() & p.isNotNull() & (F.size(p) == F.size(m) * channels)
    limit = F.lit(threshold).cast(_element_type(df, mask))
    swapped = F.transform(
        p, lambda x, i: F.when(F.get(m, (i / channels).cast("int")) > limit, bg).otherwise(x)
    )
    return df.withColumn(flag, F.coalesce(ok, F.lit(False))).withColumn(
        out, F.when(F.col(flag), swapped).otherwise(p)
    )


def until_end(lines: DataFrame, value_col: str = "value", arrival_col: str = "arrival") -> DataFrame:
    """Lines in front of their file's first ``END`` marker: the marker ends its
    input, so it and what follows in the same file goes; files without a marker,
    and other files, stay whole.

    ``arrival`` is the struct (mtime, file, block, pos) of the packet readers: the
    position of a line is its split's offset, then its place in the split.  The
    markers are few and are joined back per split, so a large file is never
    gathered in one task."""
    file, block, pos = (F.col(f"{arrival_col}.{c}") for c in ("file", "block", "pos"))
    placed = lines.select("*", file.alias("_file"), block.alias("_block"), pos.alias("_pos"))
    ends = placed.where(F.col(value_col) == END_MARKER).groupBy("_file").agg(
        F.min(F.struct("_block", "_pos")).alias("_end"))
    # per split at or behind a marker: the place of the first line that goes
    limits = (placed.select("_file", "_block").distinct().join(ends, "_file")
              .where(F.col("_block") >= F.col("_end._block"))
              .select("_file", "_block", F.when(F.col("_block") == F.col("_end._block"), F.col("_end._pos"))
                      .otherwise(F.lit(-1)).alias("_limit")))
    return (placed.join(limits, ["_file", "_block"], "left")
            .where(F.col("_limit").isNull() | (F.col("_pos") < F.col("_limit")))
            .select(*lines.columns))


#: Types that a hash aggregate can take the maximum of.
_FIXED_WIDTH = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)


def latest_per_id(
    df: DataFrame, id_col: str, order_col: str, value_cols: Sequence[str], unique_order: bool = False,
) -> DataFrame:
    """Keep the last-arriving row per id (largest ``order_col``).

    With an order of fixed width (number, date, time) the winners are found on
    narrow rows, (id, largest order) in a hash aggregate that leaves one row an
    id and task; only they are then fetched with their values, so frames are not
    sorted.  Rows equal in id and order are told apart by their values (the
    largest stay), among winners only; ``unique_order`` says that there are
    none.  Other orders go through ``max(struct(order, values...))``."""
    columns = [id_col, order_col, *value_cols]
    if isinstance(df.schema[order_col].dataType, _FIXED_WIDTH):
        last = df.groupBy(F.col(id_col).alias("_id")).agg(F.max(order_col).alias("_last"))
        won = df.select(*columns).join(last, F.col(id_col).eqNullSafe(F.col("_id")) & F.col(order_col).eqNullSafe(F.col("_last")))
        won = won.select(*columns)
        if unique_order:
            return won
        df = won
    picked = df.groupBy(id_col).agg(F.max(F.struct(order_col, *value_cols)).alias("_latest"))
    return picked.select(id_col, *[F.col(f"_latest.{c}").alias(c) for c in (order_col, *value_cols)])


def arrival_number(df: DataFrame, arrival_col: str = "arrival", out: str = "arrival_number") -> DataFrame:
    """The arrival struct as one 64-bit number of the same order: the rank of the
    line's split (one row a split is ranked), then its place in the split."""
    a = F.col(arrival_col)
    split = [a["mtime"].alias("_m"), a["file"].alias("_f"), a["block"].alias("_b")]
    ranks = df.select(*split).distinct().withColumn("_rank", F.row_number().over(Window.orderBy("_m", "_f", "_b")))
    joined = df.join(ranks, (a["mtime"] == F.col("_m")) & (a["file"] == F.col("_f")) & (a["block"] == F.col("_b")))
    number = F.shiftleft(F.col("_rank").cast("bigint"), 33).bitwiseOR(a["pos"].bitwiseAND(F.lit((1 << 33) - 1)))
    return joined.select(*df.columns, number.alias(out))


def packet_counters(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One pass, one row of pipeline counters: lines received, ``END``
    markers, packets (separator and an integer id) and frames (payload
    decodes to at least one byte, which its characters tell)."""
    v = F.col(value_col)
    head, tail = split_first(v, PACKET_SEPARATOR)
    is_packet = v.contains(PACKET_SEPARATOR) & head.try_cast("bigint").isNotNull()
    staged = lines.select(
        (v == F.lit(END_MARKER)).alias("is_end"),
        is_packet.alias("is_packet"),
        F.when(is_packet, b64_length(tail)).alias("n_bytes"),
    )
    return staged.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if("is_end").alias("end_markers"),
        F.count_if("is_packet").alias("packets"),
        F.count_if(F.col("is_packet") & (F.col("n_bytes") > 0)).alias("frames"),
    )


def frame_counters(processed: DataFrame, flag: str = "replaced") -> DataFrame:
    """One row: frames processed, replaced, kept as they were."""
    return processed.agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if(F.col(flag)).alias("replaced"),
        F.count_if(~F.col(flag)).alias("kept"),
    )


def with_model_mask(
    df: DataFrame, pixels: str, mask_fn: Callable[[np.ndarray], np.ndarray], mask: str = "mask",
    mask_type: DataType = ArrayType(DoubleType()),
) -> DataFrame:
    """Extension point for a segmentation model: ``mask_fn`` maps one
    frame's pixel array to its mask array and runs in Arrow batches on the
    executors (``mapInPandas``).  A frame whose model call raises gets a NULL
    mask, which ``masked_replace`` turns into "kept as is".  The mask has a type
    of its own: whole-number pixels may have a fractional mask."""
    out_schema = StructType(df.schema.fields + [StructField(mask, mask_type, True)])

    def run(batches):
        for pdf in batches:
            masks = []
            for px in pdf[pixels]:
                try:
                    masks.append(None if px is None else np.asarray(mask_fn(np.asarray(px))))
                except Exception:
                    masks.append(None)
            yield pdf.assign(**{mask: pd.Series(masks, index=pdf.index, dtype=object)})

    return df.mapInPandas(run, out_schema)


#: Most frames that one call of a batched model gets.
FRAMES_PER_CALL = 64


def _batched_masks(make_model: Callable, key: str, frames_per_call: int):
    """Function of a list of pixel arrays (or None) that gives their masks (None
    where the model failed).  The model is made once per Python worker, gets
    frames of equal size stacked into one array (frames x pixels) and returns a
    mask row per frame; if a call fails, its frames are tried one by one."""

    def model():
        import sys
        import types

        # outlives the task: workers are reused, closures are not
        held = sys.modules.setdefault("tessera_worker_models", types.ModuleType("tessera_worker_models"))
        if not hasattr(held, key):
            setattr(held, key, make_model())
        return getattr(held, key)

    def call(stack):
        masks = np.asarray(model()(stack))
        if len(masks) != len(stack):
            raise ValueError("one mask per frame is expected")
        return list(masks)

    def masks_of(frames: list) -> list:
        out: list = [None] * len(frames)
        sizes: dict[int, list[int]] = {}
        for i, f in enumerate(frames):
            if f is not None:
                sizes.setdefault(len(f), []).append(i)
        for places in sizes.values():
            for a in range(0, len(places), frames_per_call):
                some = places[a: a + frames_per_call]
                try:
                    found = call(np.stack([frames[i] for i in some]))
                except Exception:
                    found = []
                    for i in some:
                        try:
                            found.append(call(np.stack([frames[i]]))[0])
                        except Exception:
                            found.append(None)
                for i, mask in zip(some, found):
                    out[i] = mask
        return out

    return masks_of


def with_batched_mask(
    df: DataFrame, pixels: str, make_model: Callable[[], Callable[[np.ndarray], np.ndarray]], mask: str = "mask",
    mask_type: DataType = ArrayType(DoubleType()), frames_per_call: int = FRAMES_PER_CALL, profile=None,
) -> DataFrame:
    """``with_model_mask`` for models that are dear to load and faster on many
    frames: ``make_model`` runs once per worker and returns a function from
    stacked frames to stacked masks.  A frame on which the model fails gets a
    NULL mask, the others of its call keep theirs.  ``profile`` (a
    ``ResourceProfile``) asks for executors with, say, an accelerator."""
    out_schema = StructType(df.schema.fields + [StructField(mask, mask_type, True)])
    masks_of = _batched_masks(make_model, f"model_{uuid.uuid4().hex}", frames_per_call)

    def run(batches):
        for pdf in batches:
            masks = masks_of([None if px is None else np.asarray(px) for px in pdf[pixels]])
            yield pdf.assign(**{mask: pd.Series(masks, index=pdf.index, dtype=object)})

    return df.mapInPandas(run, out_schema, profile=profile)


def replace_in_frames(
    frames: DataFrame, mask_fn: Callable[[np.ndarray], np.ndarray], data: str = "data", flag: str = "replaced",
    background: int = BACKGROUND_VALUE, threshold: float = MASK_THRESHOLD,
) -> DataFrame:
    """Masked replacement on decoded frames: the bytes are the pixels (uint8),
    ``mask_fn`` gives one mask value per pixel, pixels above the threshold get
    the background value.  Where the mask fails or has another length the frame
    stays as it is with ``flag = false``.  Runs in Arrow batches on the
    executors; a frame never meets another one."""
    schema = StructType([*frames.schema.fields, StructField(flag, BooleanType(), False)])

    def one(content):
        pixels = np.frombuffer(content, np.uint8)
        try:
            mask = np.asarray(mask_fn(pixels))
            if mask.shape != pixels.shape:
                return content, False
            return np.where(mask > threshold, np.uint8(background), pixels).astype(np.uint8).tobytes(), True
        except Exception:
            return content, False

    def run(batches):
        for pdf in batches:
            made = [one(c) for c in pdf[data]]
            yield pdf.assign(**{data: [m[0] for m in made], flag: [m[1] for m in made]})

    return frames.mapInPandas(run, schema)
