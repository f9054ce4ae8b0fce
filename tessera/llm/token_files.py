"""Token-id files (operator 5): canonical length-limited Huffman coding.

1. Texts are range-partitioned and sorted by doc_id and tokenized there, so the
   ids land once, already in file order.
2. One pass over the landed ids counts every id; the counts (at most one row
   per vocabulary entry) give one code for the whole data set.
3. Each task codes its stretch of documents into files of about
   ``FILE_TOKENS`` tokens.  A file is cut into blocks of ``BLOCK`` tokens that
   decode independently from bit-offset checkpoints, through one table lookup
   per token, and carries the code lengths, doc_ids and token counts: every
   file can be read on its own.

File layout (little-endian): magic, then the counts of ``_HEADER``, then zlib
streams of code lengths (uint8 per id), doc_id null marks (uint8), doc_ids
(int64), document token counts (int64), block sizes in bits (uint32), each
after its uint32 byte count, then the payload (big-endian bits).

Defined results: null text is empty and still gets its end id; null doc_ids
sort first; repeated rows are separate documents; ties sort by text hash; an
empty table gives no file and an empty result.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import land, ship_package
from tessera.llm.files import write_file
from tessera.llm.huffman import Decoder, canonical_codes, code_lengths, encode_blocks
from tessera.llm.tokenizer import encoder
from tessera.operators.partitioning import input_bytes

MAGIC = b"TOKHUF01"
_HEADER = struct.Struct("<8sqqqqqq")
BLOCK = 512
CODE_LIMIT = 18
FILE_TOKENS = 1 << 22
#: Most input bytes (as Spark's statistics give them) of one range of documents.
PARTITION_BYTES = 128 << 20
#: Ranges whose sums one window adds up; groups of them are one row each in the next.
FAN = 1024
_FILE_SCHEMA = "path string, part bigint, seq bigint, n_docs bigint, n_tokens bigint, n_bytes bigint"


def _tokenize_task(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        column_ids, part, seq = encoder(path).column_ids, TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, found in column_ids(batch.column("text")):
                ids = [x.astype("<u4", copy=False).tobytes() + end for x in found]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(seq, seq + n)),
                     batch.column("doc_id").slice(a, n), pa.array(ids, pa.binary())],
                    names=["part", "seq", "doc_id", "ids"])
                seq += n

    return run


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
              text_col: str = "text", partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(part, seq, doc_id, ids): ids as little-endian uint32, end id last, in
    ascending doc_id order by (part, seq).

    Texts are read once for the range bounds and once for the shuffle.  There
    are as many ranges as the session has shuffle partitions, which Spark may
    merge, or more where the scan's size asks for it.  Null and repeated ids
    are spread by text hash and place."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    wanted = -(-input_bytes(rows) // partition_bytes)
    more = [wanted] if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = rows.repartitionByRange(*more, *order).sortWithinPartitions(*order)
    return ordered.mapInArrow(_tokenize_task(tokenizer_path, end_id),
                              "part bigint, seq bigint, doc_id bigint, ids binary")


def _binary_values(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), "<u4") for b in column]


def _count_task(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            values = _binary_values(batch.column("ids").slice(i, 512))
            found = np.bincount(np.concatenate(values)) if values else total[:0]
            if len(found) > len(total):
                found[: len(total)] += total
                total = found
            else:
                total[: len(found)] += found
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def global_code(ids: DataFrame, limit: int = CODE_LIMIT) -> np.ndarray:
    """Code length of every id, from counts over all documents."""
    rows = ids.select("ids").mapInArrow(_count_task, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:  # at most one row per vocabulary entry
        counts[r["id"]] = r["n"]
    return code_lengths(counts, max(limit, int(len(rows)).bit_length()))


def _packed(values: np.ndarray) -> bytes:
    data = zlib.compress(values.tobytes(), 6)
    return struct.pack("<I", len(data)) + data


def file_bytes(part: int, seq: int, doc_ids: list, values: list[np.ndarray], lengths: np.ndarray,
               codes: np.ndarray, block: int) -> list[bytes]:
    ids = np.concatenate(values)
    payload, starts = encode_blocks(ids, codes, lengths, block)
    header = _HEADER.pack(MAGIC, part, seq, len(values), len(ids), block, len(lengths))
    return [header, _packed(lengths.astype(np.uint8)), _packed(np.array([d is None for d in doc_ids], np.uint8)),
            _packed(np.array([d or 0 for d in doc_ids], "<i8")), _packed(np.array([len(v) for v in values], "<i8")),
            _packed(np.diff(starts, prepend=0).astype("<u4")), payload]


def _write_task(folder: str, lengths: np.ndarray, block: int, file_tokens: int):
    def run(batches):
        codes = canonical_codes(lengths)
        held: dict = {"part": None}

        def flush():
            parts = file_bytes(held["part"], held["seq"], held["docs"], held["values"], lengths, codes, block)
            name = f"ids-{held['part']:08d}-{held['seq']:010d}.huf"
            path = write_file(folder, name, parts)
            return pa.RecordBatch.from_pylist([{
                "path": path, "part": held["part"], "seq": held["seq"], "n_docs": len(held["docs"]),
                "n_tokens": held["tokens"], "n_bytes": sum(map(len, parts))}])

        for batch in batches:
            part, seq = batch.column("part").to_pylist(), batch.column("seq").to_pylist()
            docs, ids = batch.column("doc_id").to_pylist(), batch.column("ids")
            for r in range(batch.num_rows):
                if held["part"] is not None and (
                        held["part"] != part[r] or held["next"] != seq[r] or held["tokens"] >= file_tokens):
                    yield flush()
                    held = {"part": None}
                if held["part"] is None:
                    held = {"part": part[r], "seq": seq[r], "docs": [], "values": [], "tokens": 0}
                held["docs"].append(docs[r])
                held["values"].append(np.frombuffer(ids[r].as_py(), "<u4"))
                held["tokens"] += len(held["values"][-1])
                held["next"] = seq[r] + 1
        if held["part"] is not None:
            yield flush()

    return run


def write_token_files(ids: DataFrame, folder: str, block: int = BLOCK, limit: int = CODE_LIMIT,
                      file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write landed ids as files below ``folder``; one row per file, with
    ``start``, the number of ids before it."""
    lengths = global_code(ids, limit)
    written = land(ids.mapInArrow(_write_task(folder, lengths, block, file_tokens), _FILE_SCHEMA), "token-file-list")
    # ids before a file: before its group of ranges, its range there, and itself there
    parts = written.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("upper", F.floor(F.col("part") / FAN))
    uppers = parts.groupBy("upper").agg(F.sum("n").alias("n"))

    def before(column: str, order: str, *keys: str):
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    places = parts.select("part", "upper", before("n", "part", "upper").alias("in_upper")).join(
        uppers.select("upper", before("n", "upper").alias("base")), "upper").select("part", (F.col("base") + F.col("in_upper")).alias("base"))
    placed = written.withColumn("in_part", before("n_tokens", "seq", "part")).join(places, "part")
    return placed.withColumn("start", F.col("base") + F.col("in_part")).select(*written.columns, "start")


def read_file(content: bytes) -> tuple[int, int, list, np.ndarray, np.ndarray]:
    """(part, seq, doc_ids, token counts, ids) of one file."""
    magic, part, seq, n_docs, n_tokens, block, _ = _HEADER.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at, fields = _HEADER.size, []
    for kind in ("u1", "u1", "<i8", "<i8", "<u4"):
        (size,) = struct.unpack_from("<I", content, at)
        fields.append(np.frombuffer(zlib.decompress(content[at + 4: at + 4 + size]), kind))
        at += 4 + size
    lengths, null, doc_ids, counts, sizes = fields
    ids = Decoder(lengths).blocks(memoryview(content)[at:], np.cumsum(sizes, dtype=np.int64), n_tokens, block)
    return part, seq, [None if n else d for n, d in zip(null.tolist(), doc_ids.tolist())], counts, ids


def _read_task(batches):
    for batch in batches:
        for value in batch.column("content"):
            part, seq, docs, counts, ids = read_file(value.as_buffer().to_pybytes())
            ends = np.cumsum(counts)
            starts = ends - counts
            raw = ids.astype("<u4").tobytes()
            for a in range(0, len(docs), 1024):
                b = min(a + 1024, len(docs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (b - a)), pa.array([seq] * (b - a)), pa.array(docs[a:b], pa.int64()),
                     pa.array(starts[a:b]), pa.array(counts[a:b]),
                     pa.array([raw[4 * starts[i]: 4 * ends[i]] for i in range(a, b)], pa.binary())],
                    names=["part", "seq", "doc_id", "in_file", "n_tokens", "ids"])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of all files below ``folder``: (part, seq) of their file,
    ``doc_id, in_file`` (ids before it there), ``n_tokens, ids``."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.huf").load(folder)
    return files.select("content").mapInArrow(
        _read_task, "part bigint, seq bigint, doc_id bigint, in_file bigint, n_tokens bigint, ids binary")
