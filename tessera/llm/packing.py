"""Packing (operator 7): hierarchical multi-length packing.

Documents (ids plus end id) are routed to context-size tiers: whole windows of
the longest size fill sequences of their own; what remains belongs to the tier
of the smallest window that holds it.  Within a shard of bounded size, tiers
are packed from long to short: a window opens with the tier's longest piece and
its gap is filled from shorter pieces, longest fitting first; where none fits,
a piece is cut to the gap and its rest goes back to its own tier.  Windows are
thus full; the last tokens of a shard go to ever smaller powers of two, and
only fewer than ``LEAST`` tokens per shard are padded.  Sequences are dealt to
step groups of about ``STEP_TOKENS`` tokens, so steps carry the same load.

Defined results: null text is empty and still has its end id; repeated rows
and null doc_ids are separate documents; ties are packed in landed order; an
empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import land, ship_package
from tessera.llm.tokenizer import encoder

WINDOWS = (2048, 1024, 512, 256)
#: Below the shortest tier, leftovers of a shard are cut at powers of two down to this.
LEAST = 64
#: Tokens of remainders that one shard packs.
SHARD_TOKENS = 1 << 22
STEP_TOKENS = 1 << 17
_PACKED_BASE = 1 << 30  # shards' sequence ids lie above those of whole windows

_PIECES = ("rid bigint, doc_id {id_type}, start bigint, length bigint, doc_tokens bigint, ids binary, "
           "sequence_id bigint, step_id bigint")
_RESULT = ("doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
           "offset bigint, window bigint, step_id bigint")


def _cut_task(path: str, end_id: int, window: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        column_ids, base = encoder(path).column_ids, TaskContext.get().partitionId() << 32
        rid = whole = 0
        per_step = max(STEP_TOKENS // window, 1)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for a, found in column_ids(batch.column("text")):
                rows, source = [], []
                for r, ids in enumerate(found, a):
                    ids = ids.astype("<u4", copy=False).tobytes() + end
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        length = min(window, n - start)
                        full = length == window
                        rows.append((base + rid, start, length, n, ids[4 * start: 4 * (start + length)],
                                     base + whole if full else None,
                                     base + whole // per_step if full else None))
                        source.append(r)
                        rid += 1
                        whole += full
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
                arrays.insert(1, doc_ids.take(pa.array(source)))
                yield pa.RecordBatch.from_arrays(arrays, names=[
                    "rid", "doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "step_id"])

    return run


def plan_shard(lengths: list[int], windows=WINDOWS, least: int = LEAST) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences as (window, [(piece, first token, tokens), ...]); window 0
    marks the padded one.  Every token of every piece is placed once."""
    pool = sorted((n, -i, 0) for i, n in enumerate(lengths) if n)  # (tokens left, piece, first token)
    total = sum(n for n, _, _ in pool)
    sequences = []

    def take(at: int, room: int) -> tuple[int, int, int]:
        n, i, first = pool.pop(at)
        used = min(n, room)
        if used < n:
            insort(pool, (n - used, i, first + used))
        return -i, first, used

    def fill(window: int) -> None:
        nonlocal total
        parts = [take(len(pool) - 1, window)]
        room = window - parts[0][2]
        while room:
            at = bisect_right(pool, (room, 1, 0)) - 1
            parts.append(take(max(at, 0), room))
            room -= parts[-1][2]
        total -= window
        sequences.append((window, parts))

    for k, window in enumerate(windows):
        shorter = windows[k + 1] if k + 1 < len(windows) else 0
        while total >= window and pool[-1][0] > shorter:
            fill(window)
    window = max(windows)
    while window >= least:  # leftovers, at most one of each power of two below the longest window
        while total >= window:
            fill(window)
        window //= 2
    if total:
        sequences.append((0, [(-i, first, n) for n, i, first in reversed(pool)]))
    return sequences


def _steps(sizes: list[int]) -> list[int]:
    """Deal sequences, longest first, back and forth over equal step groups."""
    groups = max(1, -(-sum(sizes) // STEP_TOKENS))
    out = [0] * len(sizes)
    for rank, i in enumerate(sorted(range(len(sizes)), key=lambda i: -sizes[i])):
        turn, at = divmod(rank, groups)
        out[i] = at if turn % 2 == 0 else groups - 1 - at
    return out


def _pack_task(windows, least: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        table = table.sort_by("rid").combine_chunks()
        ids = [b.as_buffer().to_pybytes() for b in table.column("ids").chunk(0)] if table.num_rows else []
        starts = table.column("start").to_pylist()
        plan = plan_shard(table.column("length").to_pylist(), windows, least)
        steps = _steps([sum(p[2] for p in parts) for _, parts in plan])
        source, rows = [], []
        for s, (window, parts) in enumerate(plan):
            offset = 0
            for piece, first, n in parts:
                source.append(piece)
                rows.append((starts[piece] + first, n, ids[piece][4 * first: 4 * (first + n)],
                             ((_PACKED_BASE + shard) << 32) + s, offset, window or max(windows),
                             ((_PACKED_BASE + shard) << 32) + steps[s]))
                offset += n
        at = pa.array(source, pa.int64())
        columns = list(zip(*rows))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        start, length, cut, sequence, offset, window, step = (pa.array(c, t) for c, t in zip(columns, kinds))
        return pa.table([table.column("doc_id").take(at), start, length, cut, table.column("doc_tokens").take(at),
                         sequence, offset, window, step],
                        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window",
                               "step_id"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
         windows: tuple[int, ...] = WINDOWS, least: int = LEAST, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian uint32),
    ``doc_tokens, sequence_id, offset, window`` and ``step_id``."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    longest = max(windows)
    pieces = land(rows.mapInArrow(_cut_task(tokenizer_path, end_id, longest), _PIECES.format(id_type=id_type)), "pieces")
    whole = pieces.where("sequence_id IS NOT NULL").select(
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", F.lit(0).cast("bigint").alias("offset"),
        F.lit(longest).cast("bigint").alias("window"), "step_id")
    rest = pieces.where("sequence_id IS NULL")
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-tokens // shard_tokens))
    packed = (rest.select(F.pmod(F.xxhash64("rid"), F.lit(shards)).alias("shard"), "rid", "doc_id", "start", "length",
                          "doc_tokens", "ids")
              .groupBy("shard").applyInArrow(_pack_task(tuple(windows), least), _RESULT.format(id_type=id_type)))
    return whole.union(packed)
