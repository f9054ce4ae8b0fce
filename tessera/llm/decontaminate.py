"""Benchmark decontamination (operator 3): template canonicalisation.

Texts become sequences of lower-cased words in which numbers, names (capitals
inside a sentence) and units (after a number) are typed placeholders.  Windows
of ``WINDOW`` template words are hashed; document windows are looked up in a
bitmap of the benchmark's windows, of a fixed size, and those that pass are
hash-joined with the benchmark's windows.  Each window has a second key, of its
lower-cased words with their values, so verbatim and re-cased text is found
whatever its placeholders; the template key needs ``MIN_LITERALS`` literals.  The slot values behind the
placeholders must map one to one within an occurrence of an item: then a question
with other numbers or names is the same question.  Where they contradict each
other, only windows with no slot or with equal values count.  Occurrences are
the hits at one distance between document and item position, the stretches in
which the item position ascends, and all hits of the document; the best counts.

An item is found in a document when at least ``MIN_SHARE`` of its windows are.

Defined results: null and wordless texts match nothing; placeholder-only texts
match with equal values only; an
item shorter than a window is one window as a whole, and one of fewer than
``SHORT_ITEM`` words must fill whole lines; repeated rows count once;
repeated items are found each; an empty documents or benchmark table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import land, ship_package
from tessera.llm.words import LOWER, Texts, U, mix, row_bounds, span_hashes, text_slices

WINDOW = 8
#: Words of a window that must not be placeholders.
MIN_LITERALS = 4
MIN_SHARE = 0.3
#: Items of fewer words are found only where they fill whole lines, not inside other text.
SHORT_ITEM = 5
#: Words between two hits of an item that end a stretch.
STRETCH_GAP = 64
#: Size of the look-up bitmap; it does not grow with the benchmark.
BITMAP_BITS = 24
UNITS = ("mm cm m km in ft yd mi mile miles meter meters metre metres kilometer kilometers inch inches foot feet "
         "mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ton tons ml l liter liters litre litres "
         "second seconds minute minutes hour hours day days week weeks month months year years "
         "dollar dollars cent cents euro euros usd eur percent degrees degree mph kmh").split()

_NUMBER, _NAME, _UNIT = U(0x1111111111111111), U(0x2222222222222222), U(0x3333333333333333)
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BREAK = ~_ALNUM
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SMALL = np.zeros(256, bool)
_SMALL[[*range(97, 123), *range(128, 256)]] = True


def _word_hashes(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends = Texts(0, raw, np.array([0, len(raw)])).words()
    return span_hashes(raw, starts, ends)


_UNIT_HASHES = np.sort(_word_hashes(UNITS))


def _lower(buf: np.ndarray) -> np.ndarray:
    """A-Z and the Latin-1 capitals in small letters."""
    low = LOWER[buf]
    after = np.flatnonzero(buf[:-1] == 0xC3) + 1
    second = buf[after]
    capital = (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
    low[after[capital]] += 0x20
    return low


def template(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per template word: text row, template hash, slot value (0: literal),
    lower-cased hash, line number."""
    starts, ends = texts.words(_BREAK)
    row = texts.row_of(starts)
    if len(starts) == 0:
        return row, np.empty(0, U), np.empty(0, U), np.empty(0, U), row
    buf = texts.buf
    digits = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_DIGIT[buf], out=digits[1:])
    number = digits[ends] - digits[starts] == ends - starts
    # 1,234.5 is one number: parts after a single point or comma join the first
    near = np.zeros(len(starts), bool)
    gap = buf[np.minimum(ends[:-1], len(buf) - 1)]
    near[1:] = (number[1:] & number[:-1] & (starts[1:] == ends[:-1] + 1) & ((gap == 0x2E) | (gap == 0x2C))
                & (row[1:] == row[:-1]))
    first = np.flatnonzero(~near)
    last = np.append(first[1:], len(starts)) - 1
    starts, ends, row, number = starts[first], ends[last], row[first], number[first]
    value = span_hashes(_lower(buf), starts, ends)
    unit = np.zeros(len(starts), bool)
    unit[1:] = number[:-1] & (row[1:] == row[:-1])
    unit &= np.isin(value, _UNIT_HASHES)
    # a name: a capital, then a small letter, after a space that follows a letter, digit or comma
    back = np.maximum(starts - 2, 0)
    inside = (starts >= texts.offsets[row] + 2) & (buf[np.maximum(starts - 1, 0)] == 0x20) & (
        _ALNUM[buf[back]] | (buf[back] == 0x2C))
    name = inside & _UPPER[buf[starts]] & (ends - starts > 1) & _SMALL[buf[np.minimum(starts + 1, len(buf) - 1)]]
    form = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, value)))
    line = np.cumsum(buf == 0x0A)[starts]
    return row, form, np.where(number | unit | name, value | U(1), U(0)), value, line


def _windows(form: np.ndarray, slot: np.ndarray, value: np.ndarray, bounds: np.ndarray, size: int):
    """(start index, hash, has slots, enough literals) of the windows of ``size``
    words inside one text: each by its words, and by its template where that
    differs and has enough literals."""
    n = len(form) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U), np.empty(0, bool), np.empty(0, bool)
    literal = np.zeros(len(form) + 1, np.int64)
    np.cumsum(slot == 0, out=literal[1:])
    literals = literal[size:] - literal[:-size]
    enough = literals >= min(MIN_LITERALS, size)
    inside = np.arange(n) + size <= bounds[np.searchsorted(bounds, np.arange(n), "right")]
    found = []
    for words, keep in ((value, inside), (form, inside & enough & (literals < size))):
        acc = words[:n].copy()
        for j in range(1, size):
            acc = mix(acc) + words[j: j + n]
        at = np.flatnonzero(keep)
        found.append((at, mix(acc[at] + U(size)), np.full(len(at), words is form), enough[at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _slots(slot: np.ndarray, at: np.ndarray, typed: np.ndarray, size: int) -> pa.Array:
    """Per window, its slot values in order; none where it is hashed by its words."""
    cut = slot[at[:, None] + np.arange(size)]
    used = (cut != 0) & typed[:, None]
    offsets = np.zeros(len(at) + 1, np.int32)
    np.cumsum(used.sum(axis=1), out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array(cut[used].view(np.int64)))


def _benchmark_task(batches):
    for batch in batches:
        for texts in text_slices(batch.column("text")):
            row, form, slot, value, _ = template(texts)
            bounds = row_bounds(row, len(texts))
            sizes = np.diff(bounds)
            for size in np.unique(np.minimum(sizes[sizes > 0], WINDOW)).tolist():
                at, key, typed, enough = _windows(form, slot, value, bounds, size)
                keep = np.minimum(sizes[row[at]], WINDOW) == size
                at, key, typed, enough = at[keep], key[keep], typed[keep], enough[keep]
                r = row[at]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(r + texts.first)), pa.array(at - bounds[r]),
                     pa.array(np.full(len(at), size, np.int64)), pa.array(key.view(np.int64)),
                     _slots(slot, at, typed, size), pa.array(enough)],
                    names=["item_id", "position", "size", "window", "slots", "strong"])


def _lookup_task(bitmap, sizes: list[int], bits: int):
    mask = U((1 << bits) - 1)

    def run(batches):
        marks = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            for texts in text_slices(batch.column("text")):
                row, form, slot, value, line = template(texts)
                bounds = row_bounds(row, len(texts))
                ends = np.ones(len(row) + 1, bool)  # of a line or text, before each word and behind the last
                ends[1:-1] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
                opens, closes = ends[:-1], ends[1:]
                for size in sizes:
                    at, key, typed, _ = _windows(form, slot, value, bounds, size)
                    bit = key & mask
                    hit = (marks[(bit >> U(3)).astype(np.int64)] >> (bit & U(7)).astype(np.uint8)) & 1 > 0
                    if size < SHORT_ITEM:
                        hit &= opens[at] & closes[at + size - 1]
                    at, key, typed = at[hit], key[hit], typed[hit]
                    if not len(at):
                        continue
                    source = pa.array(row[at] + texts.first)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(source), batch.column("text_key").take(source),
                         pa.array(at - bounds[row[at]]), pa.array(key.view(np.int64)), _slots(slot, at, typed, size)],
                        names=["doc_id", "text_key", "place", "window", "found"])

    return run


def _bitmap(windows: DataFrame, bits: int) -> bytes:
    """Bitmap of the windows' low bits; at most 2^bits / 64 rows reach the driver."""
    low = F.col("window").bitwiseAND((1 << bits) - 1)
    words = windows.groupBy(F.shiftright(low, 6).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast((window & {(1 << bits) - 1}) % 64 as int)))").alias("mask")).collect()
    out = np.zeros(1 << bits >> 6, np.int64)
    for r in words:
        out[r["word"]] = r["mask"]
    return out.astype("<i8").tobytes()


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", min_share: float = MIN_SHARE,
                   bits: int = BITMAP_BITS) -> DataFrame:
    """One row per document and found item: ``doc_id, text_key, item_id,
    n_windows, item_windows, verbatim`` (no slot value differs)."""
    spark = docs.sparkSession
    ship_package(spark)
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
    item_type = items.schema["item_id"].dataType.simpleString()
    windows = land(items.mapInArrow(
        _benchmark_task, f"item_id {item_type}, position bigint, size bigint, window bigint, slots array<bigint>, "
                         "strong boolean"),
        "benchmark-windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most WINDOW rows
    bitmap = spark.sparkContext.broadcast(_bitmap(windows, bits))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    seen = rows.mapInArrow(_lookup_task(bitmap, sizes, bits),
                           f"doc_id {id_type}, text_key bigint, place bigint, window bigint, found array<bigint>")
    totals = windows.groupBy("item_id").agg(
        F.countDistinct("position").alias("item_windows"),
        F.countDistinct(F.when(F.col("strong"), F.col("position"))).alias("item_strong"))
    hits = seen.join(windows.select("item_id", "position", "window", "slots", "strong"), "window").where(
        F.size("slots") == F.size("found"))
    pairs = F.arrays_zip(F.col("slots").alias("item"), F.col("found").alias("doc"))
    hits = hits.select("doc_id", "text_key", "place", "item_id", "position", "strong", pairs.alias("pairs"),
                       (F.col("slots") == F.col("found")).alias("same")).distinct()
    in_order = Window.partitionBy("doc_id", "text_key", "item_id").orderBy("place", "position")
    # a window that hits by its words and by its template goes on where it is
    back = F.col("place") - F.lag("place").over(in_order)
    starts_anew = (F.col("position") < F.lag("position").over(in_order)) | (back > STRETCH_GAP) | (
        (F.col("position") == F.lag("position").over(in_order)) & (back > 0))
    hits = hits.withColumn("anew", F.coalesce(starts_anew, F.lit(False)).cast("bigint")).withColumn(
        "stretch", F.sum("anew").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    occurrences = F.array(*[F.struct(F.lit(k).alias("kind"), n.cast("bigint").alias("n")) for k, n in enumerate(
        [F.lit(0), F.col("place") - F.col("position"), F.col("stretch")])])
    # arrays_zip names its fields by the columns it gets
    grouped = hits.withColumn("occurrence", F.explode(occurrences)).groupBy(
        "doc_id", "text_key", "item_id", "occurrence").agg(
        F.collect_set("position").alias("any_place"),
        F.collect_set(F.when(F.col("same"), F.col("position"))).alias("same_place"),
        F.collect_set(F.when(F.col("strong"), F.col("position"))).alias("strong_place"),
        F.collect_set(F.when(F.col("same") & F.col("strong"), F.col("position"))).alias("same_strong"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.bool_and("same").alias("verbatim"))
    one_to_one = ((F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"]))) == F.size("pairs"))
                  & (F.size(F.array_distinct(F.transform("pairs", lambda p: p["doc"]))) == F.size("pairs")))
    counted = grouped.select(
        "doc_id", "text_key", "item_id", "verbatim",
        F.when(one_to_one, F.size("any_place")).otherwise(F.size("same_place")).cast("bigint").alias("n_windows"),
        F.when(one_to_one, F.size("strong_place")).otherwise(F.size("same_strong")).alias("n_strong"))
    # re-parameterised items are judged by the windows whose template counts
    enough = (F.col("n_windows") >= min_share * F.col("item_windows")) | (
        (F.col("n_strong") > 0) & (F.col("n_strong") >= min_share * F.col("item_strong")))
    best = F.max(F.struct("n_windows", "verbatim"))
    return counted.join(totals, "item_id").where(enough).groupBy("doc_id", "text_key", "item_id", "item_windows").agg(
        best.alias("best")).select("doc_id", "text_key", "item_id", "best.n_windows", "item_windows", "best.verbatim")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    columns = docs.columns
    gone = contaminations(docs, benchmark, id_col, text_col, item_col, item_text).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")).distinct()
    return docs.withColumn("__tk", F.xxhash64(F.col(text_col))).join(
        gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tk") == F.col("__text")), "left_anti").select(*columns)
