"""Substring dedup (operator 6): line and passage hashing with original offsets.

Lines are the first units.  Each is normalised (A-Z lower-cased, white space
collapsed), digested to 128 bits and grouped over the whole corpus; the
occurrence of the smallest (doc_id, text hash, offset) stays, the others are
repeats.  A repeat goes when it stands in a run of neighbouring repeats of at
least ``min_words`` words, so a passage is caught whether it is one long line
or several short ones, and a stray license line or a one-word line is not.

Passages that start or end inside a line come next: every window of
``min_words`` words at any position that also stands at an earlier place (and
does not overlap it) is a repeat, and so are all its words.  Words that no
removed line has go as maximal spans.  Windows are compared by 128-bit digests,
but only near anchors that occur twice: of each ``min_words`` words the least
hash of half as many words is an anchor (winnowing), so equal windows have equal
anchors and none is missed.

Defined results: null and wordless texts have no units; repeated rows (same id
and text) are one document; null doc_ids rank first; ties go to the smaller
text hash, then offset; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import land, ship_package
from tessera.llm.words import LOWER, Texts, U, line_spans, mix, row_bounds, span_hashes, text_slices

#: Words that a run of repeated lines needs to be removed.
MIN_WORDS = 50

_UNITS = ("doc_id {id_type}, text_key bigint, line bigint, start bigint, length bigint, n_words bigint, "
          "digest_a bigint, digest_b bigint")


def _units_batch(batch: pa.RecordBatch):
    for texts in text_slices(batch.column("text")):
        low = Texts(texts.first, LOWER[texts.buf], texts.offsets)
        starts, ends = low.words()
        hashes = span_hashes(low.buf, starts, ends)
        line_start, line_end = line_spans(low)
        first, last = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
        full = last > first
        line_start, line_end, first, last = line_start[full], line_end[full], first[full], last[full]
        row = low.row_of(line_start)
        points = np.zeros(len(low.buf) + 1, np.int64)  # code points before each byte
        np.cumsum((low.buf & 0xC0) != 0x80, out=points[1:])
        begin = points[line_start]
        number = np.arange(len(row)) - np.searchsorted(row, row)
        at = pa.array(row + texts.first)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(number),
             pa.array(begin - points[low.offsets[row]]), pa.array(points[line_end] - begin), pa.array(last - first),
             pa.array(span_hashes(hashes, first, last).view(np.int64)),
             pa.array(span_hashes(mix(hashes ^ U(0xA5A5A5A5A5A5A5A5)), first, last).view(np.int64))],
            names=["doc_id", "text_key", "line", "start", "length", "n_words", "digest_a", "digest_b"])


def _units_task(batches):
    for batch in batches:
        yield from _units_batch(batch)


def line_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line that has a word; ``start`` and ``length`` in code points."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(_units_task, _UNITS.format(id_type=rows.schema["doc_id"].dataType.simpleString()))


def _minimum(values: np.ndarray, width: int, least=np.minimum) -> np.ndarray:
    """Least (or largest) of each ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = least(values[:-step], values[step:])
        done += step
    return values


def _words(texts: Texts):
    """Starts, ends, hashes and, per word, the index behind its text's last word."""
    low = Texts(texts.first, LOWER[texts.buf], texts.offsets)
    starts, ends = low.words()
    row = low.row_of(starts)
    return starts, ends, span_hashes(low.buf, starts, ends), row, row_bounds(row, len(texts))


def _points(texts: Texts) -> np.ndarray:
    """Code points before each byte."""
    points = np.zeros(len(texts.buf) + 1, np.int64)
    np.cumsum((texts.buf & 0xC0) != 0x80, out=points[1:])
    return points


def _anchors_task(size: int):
    gram = max(size // 2, 1)
    width = size - gram + 1  # grams in a window

    def run(batches):
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                _, _, hashes, row, bounds = _words(texts)
                n = len(hashes) - size + 1
                if n <= 0:
                    continue
                at = np.arange(len(hashes) - gram + 1)
                grams = span_hashes(hashes, at, at + gram)
                low = _minimum(grams, width)
                low[np.arange(n) + size > bounds[row[:n] + 1]] = 0  # not inside one text
                edge = np.zeros(width - 1, U)
                most = _minimum(np.concatenate([edge, low, edge]), width, np.maximum)
                at = np.flatnonzero((most == grams) & (most > 0))
                source = pa.array(row[at] + texts.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(source), batch.column("text_key").take(source),
                     pa.array(at - bounds[row[at]]), pa.array(grams[at].view(np.int64))],
                    names=["doc_id", "text_key", "at", "anchor"])

    return run


def _windows_task(size: int):
    """Windows that have one of their document's ``anchors``."""
    gram = max(size // 2, 1)

    def run(batches):
        for batch in batches:
            anchors = batch.column("anchors")
            offsets, values = anchors.offsets.to_numpy(), anchors.values.to_numpy(zero_copy_only=False)
            for texts in text_slices(batch.column("text")):
                starts, _, hashes, row, bounds = _words(texts)
                if len(hashes) < size:
                    continue
                first, last = offsets[texts.first], offsets[texts.first + len(texts)]
                owner = np.repeat(np.arange(len(texts)), np.diff(offsets[texts.first: texts.first + len(texts) + 1]))
                near = bounds[owner] + values[first:last]
                marks = np.zeros(len(hashes) + 2, np.int64)
                np.add.at(marks, np.maximum(near + gram - size, bounds[owner]), 1)
                np.add.at(marks, near + 1, -1)
                at = np.flatnonzero(np.cumsum(marks)[: len(hashes)] > 0)
                at = at[at + size <= bounds[row[at] + 1]]
                points = _points(texts)
                source = pa.array(row[at] + texts.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(source), batch.column("text_key").take(source),
                     pa.array(at - bounds[row[at]]), pa.array(points[starts[at]] - points[texts.offsets[row[at]]]),
                     pa.array(span_hashes(hashes, at, at + size).view(np.int64)),
                     pa.array(span_hashes(mix(hashes ^ U(0xA5A5A5A5A5A5A5A5)), at, at + size).view(np.int64))],
                    names=["doc_id", "text_key", "at", "start", "digest_a", "digest_b"])

    return run


def _passages_task(size: int, schema: pa.Schema):
    """Maximal spans of the words of repeated windows that no removed line has."""

    def run(batches):
        for batch in batches:
            windows, lines = batch.column("windows").to_pylist(), batch.column("lines").to_pylist()
            ids, keys, out = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), []
            for texts in text_slices(batch.column("text")):
                starts, ends, _, _, bounds = _words(texts)
                points = _points(texts)
                for r in range(len(texts)):
                    i, zero = texts.first + r, points[texts.offsets[r]]
                    begin = points[starts[bounds[r]: bounds[r + 1]]] - zero
                    end = points[ends[bounds[r]: bounds[r + 1]]] - zero
                    found = sorted(windows[i], key=lambda w: w["at"])
                    at = np.array([w["at"] for w in found], np.int64)
                    marks = np.zeros(len(begin) + 1, np.int64)
                    marks[at] += 1
                    marks[at + size] -= 1
                    gone = np.cumsum(marks) > 0
                    for line in lines[i] or []:
                        gone[np.searchsorted(begin, line["start"]):
                             np.searchsorted(begin, line["start"] + line["length"])] = False
                    change = np.flatnonzero(np.diff(np.concatenate([[False], gone])))
                    for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
                        # the window that starts with the span, or else the first that reaches it
                        w = np.searchsorted(at, a)
                        if w == len(at) or at[w] != a:
                            w = np.searchsorted(at, a - size, "right")
                        out.append((ids[i], keys[i], int(begin[a]), int(end[b - 1] - begin[a]), b - a,
                                    found[w]["kept_doc_id"], found[w]["kept_start"]))
            columns = list(zip(*out)) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def passage_spans(docs: DataFrame, whole_lines: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """Removed passages outside the removed lines ``whole_lines``, in the columns of
    ``removed_spans``; the kept occurrence is that of the span's first window."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    anchors = land(rows.mapInArrow(_anchors_task(min_words), f"doc_id {id_type}, text_key bigint, at bigint, anchor bigint"),
                   "anchors")
    spot = F.struct("text_key", "at")
    repeated = land(anchors.groupBy("anchor").agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
                    .where("first <> last").select("anchor"), "repeated-anchors")
    # of equal texts only the first has own passages: the lines of the others are all repeats
    named = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id")
    near = (anchors.join(repeated, "anchor").groupBy("text_key")
            .agg(F.min(named).alias("first"), F.collect_set("at").alias("anchors"))
            .select(F.col("first.doc_id").alias("near_id"), F.col("text_key").alias("near_text"), "anchors"))
    texts = land(rows.join(near, F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("text_key") == F.col("near_text")))
                 .dropDuplicates(["text_key"]).select("doc_id", "text_key", "text", "anchors"), "anchored-texts")
    windows = land(texts.mapInArrow(
        _windows_task(min_words), f"doc_id {id_type}, text_key bigint, at bigint, start bigint, digest_a bigint, "
                                  "digest_b bigint"), "windows")
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "text_key", "at", "start")
    kept = land(windows.groupBy("digest_a", "digest_b").agg(F.min(place).alias("kept"), F.max(place).alias("last"))
                .where("kept <> last").drop("last"), "repeated-windows")
    again = (F.col("text_key") != F.col("kept.text_key")) | (F.col("at") >= F.col("kept.at") + min_words)
    repeats = (windows.join(kept, ["digest_a", "digest_b"]).where(again).groupBy("text_key").agg(F.collect_list(F.struct(
        "at", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start"))).alias("windows")))
    lines = whole_lines.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "length")).alias("lines")).select(
        F.col("doc_id").alias("line_id"), F.col("text_key").alias("line_text"), "lines")
    found = texts.drop("anchors").join(repeats, "text_key").join(
        lines, F.col("doc_id").eqNullSafe(F.col("line_id")) & (F.col("text_key") == F.col("line_text")), "left").select(
        "doc_id", "text_key", "text", "windows", "lines")
    return found.mapInArrow(_passages_task(min_words, to_arrow_schema(whole_lines.schema)), whole_lines.schema)


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """Every removed line and passage: ``doc_id, text_key, start, length, n_words``
    and the kept occurrence ``kept_doc_id, kept_start``."""
    lines = land(removed_lines(docs, id_col, text_col, min_words), "removed-lines")
    return lines.unionByName(passage_spans(docs, lines, id_col, text_col, min_words))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """Every removed line, in the columns of ``removed_spans``."""
    units = land(line_units(docs, id_col, text_col), "units")
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "text_key", "start")
    # landed, so that the join can split the lines of a very common digest
    repeated = land(units.groupBy("digest_a", "digest_b").agg(F.min(place).alias("kept"), F.max(place).alias("last"))
                    .where("kept <> last").drop("last"), "repeated-units")
    repeats = (units.join(repeated, ["digest_a", "digest_b"]).where(place != F.col("kept"))
               .select("doc_id", "text_key", "line", "start", "length", "n_words",
                       F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start")).distinct())
    document = Window.partitionBy("doc_id", "text_key")
    runs = repeats.withColumn("run", F.col("line") - F.row_number().over(document.orderBy("line")))
    return (runs.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("doc_id", "text_key", "run")))
            .where(F.col("run_words") >= min_words)
            .select("doc_id", "text_key", "start", "length", "n_words", "kept_doc_id", "kept_start"))


def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    def without(t, gone):
        if t is None or gone is None:
            return t
        out, at = [], 0
        for s in sorted(gone, key=lambda s: s["start"]):
            out.append(t[at: s["start"]])
            at = s["start"] + s["length"]
            # with the space behind it, or the line feed if the line goes from its start
            if t[at: at + 1] in (" ", "\t") or (t[at: at + 1] == "\n" and t[s["start"] - 1: s["start"]] in ("", "\n")):
                at += 1
        return "".join([*out, t[at:]])

    return pd.Series([without(t, s) for t, s in zip(text, spans)], dtype=object)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their repeated passages, with all columns;
    ``n_chars``, where present, follows the new text."""
    columns = docs.columns
    spans = removed_spans(docs, id_col, text_col, min_words).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("start", "length")).alias("__spans")).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"), "__spans")
    rows = docs.withColumn("__tk", F.xxhash64(F.col(text_col))).join(
        spans, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tk") == F.col("__text")), "left")
    cut = F.pandas_udf(_cut, "string")(F.when(F.col("__spans").isNotNull(), F.col(text_col)), F.col("__spans"))
    rows = rows.withColumn("__cut", cut)
    touched = F.col("__spans").isNotNull()
    new = {text_col: F.when(touched, F.col("__cut")).otherwise(F.col(text_col))}
    if "n_chars" in columns and text_col != "n_chars":
        new["n_chars"] = F.when(touched, F.length("__cut").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in columns])
