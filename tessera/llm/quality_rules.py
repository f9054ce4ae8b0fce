"""Quality rules (operator 10): cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space collapsed) and hashed; per
host, the distinct documents that carry a line are counted.  Lines of at least
``MIN_LINE_WORDS`` words in more than ``limit`` documents of their host, and in
at least ``LINE_PERCENT`` percent of its distinct documents, are removed
everywhere except in the host's first carrier (smallest doc_id), and a document that keeps less than
``min_left`` of its words is depleted and rejected.  Base rules on the
document alone (too short, repeated three-word windows) reject as well.

Copies must not make their own text look like boilerplate: documents are told
apart for the count by the fingerprint of their whole text, so equal texts count
once and every other text counts.

Defined results: null text is empty, has no words and fails the base rules; a
null host is a host of its own; null doc_ids are kept as rows and sort first;
repeated rows get the same verdict each; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import land, ship_package
from tessera.llm.words import (
    LOWER, Texts, line_spans, mix, row_bounds, span_hashes, text_slices,
)

#: Distinct documents of one host that may carry a line, whatever the host's size ...
LINE_LIMIT = 20
#: ... and the percentage of them from which a line is the host's own: text that a
#: twentieth of all documents repeat word for word is a notice, a menu or a licence.
#: The percentage is that of the host, so it is alike at every size.
LINE_PERCENT = 5
#: Chance repeats a line the more often the fewer words it has: shorter lines need
#: proportionally more documents (three words twice the percentage).
FULL_LINE_WORDS = 6
#: Shorter lines recur by chance in any large host.
MIN_LINE_WORDS = 3
#: Share of a document's words that must remain.
MIN_LEFT = 0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

_FEATURES = (
    "doc_id {id_type}, text_key bigint, host_key bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, lines array<struct<h:bigint,w:bigint,n:bigint>>"
)


def _repeat_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a three-word window found twice there."""
    out = np.zeros(len(bounds) - 1, np.int64)
    for r in range(len(out)):
        w = hashes[bounds[r]: bounds[r + 1]]
        n = len(w) - WINDOW + 1
        if n < 2:
            continue
        key = w[:n].copy()
        for j in range(1, WINDOW):
            key = mix(key) + w[j: j + n]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        if not same.any():
            continue
        twice = np.zeros(n, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(w), bool)
        for j in range(WINDOW):
            covered[j: j + n] |= twice
        out[r] = covered.sum()
    return out


def _lines(texts: Texts, starts: np.ndarray, hashes: np.ndarray):
    """Per line with a word: text row, raw hash, normalised hash, words."""
    line_start, line_end = line_spans(texts)
    first = np.searchsorted(starts, line_start)
    last = np.searchsorted(starts, line_end)
    full = last > first
    line_start, line_end, first, last = line_start[full], line_end[full], first[full], last[full]
    raw = span_hashes(texts.buf, line_start, line_end)
    return texts.row_of(line_start), raw, span_hashes(hashes, first, last), last - first


def line_hashes(text: str) -> np.ndarray:
    """Normalised hash of each \\n-split line of one text, as signed 64 bits;
    lines without a word get 0."""
    parts = text.split("\n")
    t = next(text_slices(pa.array([text], pa.large_string()), max_bytes=len(text) * 4 + 1))
    low = Texts(0, LOWER[t.buf], t.offsets)
    starts, ends = low.words()
    hashes = span_hashes(low.buf, starts, ends)
    line_start, line_end = line_spans(low)
    first, last = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
    out = np.zeros(len(parts), np.int64)
    full = last > first
    out[full] = span_hashes(hashes, first[full], last[full]).view(np.int64)
    return out


def _features_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    n = batch.num_rows
    counts = {k: np.zeros(n, np.int64) for k in
              ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    line_h, line_w, line_size, line_n = [], [], [], np.zeros(n, np.int64)
    for texts in text_slices(batch.column("text")):
        rows = slice(texts.first, texts.first + len(texts))
        starts, ends = texts.words()
        row = texts.row_of(starts)
        bounds = row_bounds(row, len(texts))
        counts["n_words"][rows] = np.diff(bounds)
        inside = np.zeros(len(texts.buf) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
        counts["word_chars"][rows] = texts.per_row(in_word & ((texts.buf & 0xC0) != 0x80))
        counts["n_symbols"][rows] = texts.per_row(_SYMBOL[texts.buf])
        counts["n_repeat_words"][rows] = _repeat_words(span_hashes(texts.buf, starts, ends), bounds)
        low = Texts(texts.first, LOWER[texts.buf], texts.offsets)
        l_row, raw, norm, words = _lines(texts, starts, span_hashes(low.buf, starts, ends))
        l_bounds = row_bounds(l_row, len(texts))
        for r in range(len(texts)):
            a, b = l_bounds[r], l_bounds[r + 1]
            if b > a:
                counts["n_dup_lines"][texts.first + r] = (b - a) - len(np.unique(raw[a:b]))
                h, at, index = np.unique(norm[a:b], return_index=True, return_inverse=True)
                line_h.append(h)
                line_w.append(np.bincount(index, weights=words[a:b]).astype(np.int64))
                line_size.append(words[a:b][at])
                line_n[texts.first + r] = len(h)
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(line_n, out=offsets[1:])
    h = np.concatenate(line_h).view(np.int64) if line_h else np.empty(0, np.int64)
    w = np.concatenate(line_w) if line_w else np.empty(0, np.int64)
    size = np.concatenate(line_size) if line_size else np.empty(0, np.int64)
    lines = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
        [pa.array(h), pa.array(w), pa.array(size)], ["h", "w", "n"]))
    columns = [batch.column(c) for c in ("doc_id", "text_key", "host_key")]
    columns += [pa.array(counts[k]) for k in
                ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return pa.RecordBatch.from_arrays([*columns, lines], names=[
        "doc_id", "text_key", "host_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "lines"])


def _features_task(batches):
    for batch in batches:
        yield _features_batch(batch)


def document_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      host_col: str = "source") -> DataFrame:
    """One row per document: base counts and normalised lines."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
        F.xxhash64(F.col(host_col)).alias("host_key"), F.col(text_col).alias("text"))
    schema = _FEATURES.format(id_type=rows.schema["doc_id"].dataType.simpleString())
    return rows.mapInArrow(_features_task, schema)


def removed_lines(features: DataFrame, limit: int = LINE_LIMIT) -> DataFrame:
    """Per document that loses lines: the removed hashes and their words."""
    key = ["doc_id", "text_key", "host_key"]
    lines = features.select(*key, F.explode("lines").alias("line")).select(*key, "line.h", "line.w", "line.n").where(
        F.col("n") >= MIN_LINE_WORDS)
    per_document = lines.groupBy("host_key", "h", "text_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.max("n").alias("n"))
    hosts = features.groupBy("host_key").agg(F.count_distinct("text_key").alias("host_documents"))
    # landed, so that the join can split a very common line, or broadcast by measured size
    frequent = land(per_document.groupBy("host_key", "h")
                    .agg(F.count(F.lit(1)).alias("documents"), F.min("first").alias("first"), F.max("n").alias("n"))
                    .where(F.col("documents") > limit).join(hosts, "host_key")
                    .where(100 * F.col("documents") * F.least("n", F.lit(FULL_LINE_WORDS))
                           >= LINE_PERCENT * FULL_LINE_WORDS * F.col("host_documents"))
                    .drop("documents", "host_documents", "n"), "frequent-lines")
    hit = lines.join(frequent, ["host_key", "h"]).where(
        ~(F.struct("doc_id", "text_key").eqNullSafe(F.col("first"))))
    return (hit.groupBy(*key).agg(F.collect_set(F.struct("h", "w")).alias("gone"))
            .select(*key, F.col("gone.h").alias("removed"),
                    F.aggregate("gone", F.lit(0).cast("bigint"), lambda s, x: s + x["w"]).alias("removed_words")))


def verdicts(features: DataFrame, limit: int = LINE_LIMIT, min_left: float = MIN_LEFT) -> DataFrame:
    """Features with removed lines, ``base_failed`` and ``kept``."""
    lost = removed_lines(features, limit).select(
        F.col("doc_id").alias("lost_id"), F.col("text_key").alias("lost_text"), F.col("host_key").alias("lost_host"),
        "removed", "removed_words")
    joined = features.drop("lines").join(
        lost, F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("text_key") == F.col("lost_text"))
        & (F.col("host_key") == F.col("lost_host")), "left").drop("lost_id", "lost_text", "lost_host")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    return joined.withColumn("base_failed", base_failed).withColumn(
        "kept", ~base_failed & (left >= min_left * F.col("n_words")))


def _drop_lines(text: pd.Series, removed: pd.Series) -> pd.Series:
    def cut(t, gone):
        if t is None or gone is None:
            return t
        keep = ~np.isin(line_hashes(t), np.asarray(gone, np.int64))
        return "\n".join(line for line, k in zip(t.split("\n"), keep) if k)

    return pd.Series([cut(t, g) for t, g in zip(text, removed)], dtype=object)


def apply_quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                        limit: int = LINE_LIMIT, min_left: float = MIN_LEFT) -> DataFrame:
    """The kept documents, without their removed lines, with all their columns
    (``n_chars``, where present, follows the new text)."""
    columns = docs.columns
    features = land(document_features(docs, id_col, text_col, host_col), "quality-features")
    decided = verdicts(features, limit, min_left)
    # the rare outcomes travel: rejected documents and documents that lose lines
    changed = decided.where(~F.col("kept") | F.col("removed").isNotNull()).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"), F.col("host_key").alias("__host"),
        F.col("kept").alias("__kept"), F.col("removed").alias("__removed")).dropDuplicates(["__id", "__text", "__host"])
    keyed = docs.withColumns({"__tk": F.xxhash64(F.col(text_col)), "__hk": F.xxhash64(F.col(host_col))})
    rows = keyed.join(changed, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tk") == F.col("__text"))
                      & (F.col("__hk") == F.col("__host")), "left").where(F.coalesce("__kept", F.lit(True)))
    drop = F.pandas_udf(_drop_lines, "string")
    cut = drop(F.when(F.col("__removed").isNotNull(), F.col(text_col)), F.col("__removed"))
    rows = rows.withColumn("__cut", cut)
    new = {text_col: F.when(F.col("__removed").isNotNull(), F.col("__cut")).otherwise(F.col(text_col))}
    if "n_chars" in columns and text_col != "n_chars":
        new["n_chars"] = F.when(F.col("__removed").isNotNull(), F.length("__cut").cast(docs.schema["n_chars"].dataType)
                                ).otherwise(F.col("n_chars"))
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in columns])
