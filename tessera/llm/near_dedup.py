"""MinHash near-dedup (operator 2): signature-coordinate inverted join.

1. Every document becomes the set of its distinct five-word shingles and a
   signature of ``coordinates`` MinHash values.  Documents with equal sets
   collapse into one node.
2. Nodes are posted under each (coordinate, value).  Two sets at the threshold
   agree on at least ``match_floor`` coordinates (but for a chance below
   ``MISS``), so by pigeonhole they share an entry among their rarest
   ``coordinates - match_floor + 1`` ones: only these prefixes stay posted, and
   entries of a single node, which sort first, are skipped without being moved.
3. While a posting holds many pairs, they are built against one pivot node per
   round; links contract nodes into components, and pairs inside a component
   are skipped from then on, so a posting of g alike nodes costs g pairs, not
   g^2.  When few pairs between different components are left, or pivots stop
   contracting, all of them are looked at: no pair of different components that
   shares a prefix entry goes unchecked.
4. A pair is emitted only if two lossless bounds allow the threshold: the ratio
   of the set sizes, and the odd sketches (1024 parity bits of a set), whose
   difference never exceeds the sets' symmetric difference.  Emitted pairs are
   counted on whole signatures and, above the match floor, confirmed on full
   shingle sets.

Defined results: null or wordless text has no shingles, links with nothing and
is kept; null doc_ids are allowed (they lose against any other id); repeated
rows link with each other; ties go to the smallest doc_id, then text hash; an
empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import land, ship_package
from tessera.llm.components import components
from tessera.llm.words import U, mix, shingle_sets, text_slices

COORDINATES = 48
SHINGLE_WORDS = 5
#: Chance that a pair just at the threshold agrees on fewer coordinates than the floor.
MISS = 1e-8
#: All remaining cross-component pairs are built at once when they are at most
#: this many times the postings.
EXPAND = 64
#: Pivot rounds go on while each contracts at least this share of the postings.
CONTRACT = 0.2
SKETCH_WORDS = 16
_SKETCH = [f"sketch_{i}" for i in range(SKETCH_WORDS)]
_MIXED = np.random.Generator(np.random.PCG64(20240501)).integers(0, 1 << 63, (2, 4096), dtype=np.uint64)


def match_floor(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Largest m with P(fewer than m of the coordinates agree) <= miss."""
    p, below = percent / 100, 0.0
    for m in range(coordinates + 1):
        below += comb(coordinates, m) * p**m * (1 - p) ** (coordinates - m)
        if below > miss:
            return max(m, 1)
    return coordinates


def _signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """One entry per coordinate: a hash of the coordinate and its least value."""
    multiply, add = _MIXED[0, :coordinates] | U(1), _MIXED[1, :coordinates]
    least = np.full(coordinates, np.iinfo(U).max, U)
    for i in range(0, len(shingles), 2048):
        part = shingles[i: i + 2048, None] * multiply + add
        np.minimum(least, part.min(axis=0), out=least)
    return mix(least + np.arange(1, coordinates + 1, dtype=U) * U(0x9E3779B97F4A7C15))


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each of 1024 bits, as 16 words."""
    odd = np.bincount((mix(shingles ^ U(0x5851F42D4C957F2D)) >> U(54)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _node(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit fingerprints of a shingle set: two independent mixed sums."""
    once = mix(shingles)
    sums = np.array([once.sum(dtype=U), mix(once ^ U(0xA0761D6478BD642F)).sum(dtype=U)], U)
    node, check = mix(sums + U(len(shingles))).view(np.int64)
    return int(node), int(check)


def _signature_task(coordinates: int, k: int):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sizes, nodes, checks, entries = np.zeros(n, np.int64), [None] * n, [None] * n, []
            lengths = np.zeros(n + 1, np.int32)
            sketches = np.zeros((n, SKETCH_WORDS), np.int64)
            for texts in text_slices(batch.column("text")):
                for r, shingles in enumerate(shingle_sets(texts, k), texts.first):
                    if len(shingles):
                        sizes[r], lengths[r + 1] = len(shingles), coordinates
                        nodes[r], checks[r] = _node(shingles)
                        entries.append(_signature(shingles, coordinates))
                        sketches[r] = _sketch(shingles)
            flat = np.concatenate(entries).view(np.int64) if entries else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes), pa.array(nodes, pa.int64()),
                 pa.array(checks, pa.int64()),
                 pa.ListArray.from_arrays(np.cumsum(lengths, dtype=np.int32), pa.array(flat)),
                 *[pa.array(sketches[:, i]) for i in range(SKETCH_WORDS)]],
                names=["doc_id", "text_key", "n_shingles", "node", "check", "entries", *_SKETCH])

    return run


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               coordinates: int = COORDINATES, k: int = SHINGLE_WORDS) -> DataFrame:
    """Per document: set size, two set fingerprints (null if empty), posted entries, odd sketch."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _signature_task(coordinates, k),
        f"doc_id {id_type}, text_key bigint, n_shingles bigint, node bigint, check bigint, entries array<bigint>, "
        + ", ".join(f"{c} bigint" for c in _SKETCH))


def _may_link(percent: int, left: str, right: str):
    """Lossless bounds on two nodes' sets: size ratio and symmetric difference."""
    a, b = F.col(f"{left}n_shingles"), F.col(f"{right}n_shingles")
    differ = sum((F.bit_count(F.col(left + c).bitwiseXOR(F.col(right + c))) for c in _SKETCH), F.lit(0))
    return ((100 * F.least(a, b) >= percent * F.greatest(a, b))
            & (differ * (100 + percent) <= (100 - percent) * (a + b)))


def prefix_postings(nodes: DataFrame, floor: int) -> DataFrame:
    """(key, node): the rarest shared entries of every node that shares at
    least ``floor`` entries, as many as the pigeonhole needs."""
    posted = nodes.select("node", F.explode("entries").alias("key"))
    shared = posted.groupBy("key").count().where("count > 1")
    ranked = posted.join(shared, "key").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("count", "key"))).alias("entries"))
    prefix = (ranked.where(F.size("entries") >= floor)
              .select("node", F.explode(F.expr(f"slice(entries, 1, size(entries) - {floor} + 1)")).alias("entry"))
              .select("entry.key", "node"))
    return prefix


def _several(postings: DataFrame) -> DataFrame:
    """Postings of keys that still hold two nodes."""
    full = postings.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    return postings.join(full.select("key"), "key", "left_semi")


def _matching(pairs: DataFrame, nodes: DataFrame, floor: int) -> DataFrame:
    """Pairs whose signatures agree on at least ``floor`` coordinates, with the count."""
    one = nodes.select(F.col("node").alias("a"), F.col("entries").alias("entries_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("entries").alias("entries_b"))
    return (pairs.join(one, "a").join(two, "b")
            .select("a", "b", F.size(F.array_intersect("entries_a", "entries_b")).alias("matches"))
            .where(F.col("matches") >= floor))


def _confirm_task(percent: int, k: int):
    def sets(batch, node_col, text_col):
        node = batch.column(node_col).to_numpy(zero_copy_only=False)
        _, first, inverse = np.unique(node, return_index=True, return_inverse=True)
        found = []
        for texts in text_slices(batch.column(text_col).take(pa.array(first))):
            found += list(shingle_sets(texts, k))
        return found, inverse

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                left, at = sets(batch, "a", "text_a")
                right, bt = sets(batch, "b", "text_b")
                keep = np.zeros(batch.num_rows, bool)
                for r in range(batch.num_rows):
                    x, y = left[at[r]], right[bt[r]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[r] = 100 * both >= percent * (len(x) + len(y) - both)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Links: the pairs whose full sets reach the threshold."""
    both = (pairs.select("a", "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return land(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm_task(percent, k), "a bigint, b bigint"),
                "links")


def _across(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs whose ends lie in different components."""
    if labels is None:
        return pairs
    return (pairs.join(labels.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a", "left")
            .join(labels.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b", "left")
            .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).drop("root_a", "root_b"))


def _contract(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after new links: only the roots that the links join are
    contracted, and the labels follow."""
    if labels is None:
        return land(components([links]), "labels")
    between = (links.join(labels.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a", "left")
               .join(labels.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b", "left")
               .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    merged = land(components([between]), "merged-roots")
    tops = merged.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = labels.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    fresh = merged.join(labels.select("node"), "node", "left_anti")  # nodes that had no link before
    return land(moved.union(fresh.select("node", "root")), "labels")


def link_components(nodes: DataFrame, postings: DataFrame, texts: DataFrame, floor: int, percent: int,
                    k: int = SHINGLE_WORDS) -> DataFrame | None:
    """(node, root) over all confirmed links; None if there are none."""
    pending: list[DataFrame] = []
    labels: DataFrame | None = None
    bounds = ["n_shingles", *_SKETCH]
    # one row a node (at most one key per coordinate) until its keys are needed
    holders = land(postings.groupBy("node").agg(F.collect_list("key").alias("keys")), "holders")
    prefixes = holders
    before, last = None, False
    while not last:
        if labels is None:
            rows = holders.withColumn("root", F.col("node"))
        else:
            rows = holders.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
        rows = rows.select("node", "root", F.explode("keys").alias("key"))
        per_root = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
        per_key = per_root.groupBy("key").agg(
            F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("main"),
            F.count(F.lit(1)).alias("roots")).where("roots > 1")
        # landed with the bounds, so that the joins below are planned by measured sizes
        live = land(rows.join(per_key.select("key", "size", F.col("main.root").alias("main")), "key")
                    .join(nodes.select("node", *bounds), "node"), "postings")
        total = live.agg(F.count(F.lit(1)).alias("rows"), F.sum(
            F.when(F.col("root") != F.col("main"), F.col("size")).otherwise(0)).alias("pairs")).first()
        if not total["rows"]:
            break
        slow = before is not None and total["rows"] > (1 - CONTRACT) * before
        last, before = slow or total["pairs"] <= EXPAND * total["rows"], total["rows"]
        one = live.select("key", "main", *[F.col(c).alias("a_" + c) for c in ("node", "root", *bounds)])
        two = live.select("key", *[F.col(c).alias("b_" + c) for c in ("node", "root", *bounds)])
        apart = (F.col("a_root") != F.col("b_root")) & _may_link(percent, "a_", "b_")
        if last:
            # every pair between different components; the first side is not in the
            # main one.  A pair shows once, at the least key that both prefixes hold:
            # where a pivot has left that key, it has met all of its nodes.
            one = one.where("a_root <> main").join(prefixes.select(F.col("node").alias("a_node"), F.col("keys").alias("a_keys")), "a_node")
            two = two.join(prefixes.select(F.col("node").alias("b_node"), F.col("keys").alias("b_keys")), "b_node")
            found = one.join(two, "key").where(
                apart & ((F.col("b_root") == F.col("main")) | (F.col("a_node") < F.col("b_node")))
                & (F.array_min(F.array_intersect("a_keys", "b_keys")) == F.col("key")))
        else:  # one pivot per posting, against all that are not in its component
            pivot = live.where("root <> main").groupBy("key").agg(F.min("node").alias("pivot"))
            pivots = two.join(pivot, "key").where("b_node = pivot").drop("pivot")
            found = one.join(pivots, "key").where(apart)
            left = live.select("key", "node").join(pivot, "key").where("node <> pivot")
            holders = land(left.groupBy("node").agg(F.collect_list("key").alias("keys")), "holders")
        pairs = found.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
        matched = land(_matching(pairs, nodes, floor), "pairs")
        # first each node's best partner; what that leaves apart comes at the end
        best = matched.groupBy("b").agg(F.max(F.struct("matches", "a")).alias("best")).select(
            F.col("best.a").alias("a"), "b")
        pending.append(matched.select("a", "b").join(best, ["a", "b"], "left_anti"))
        labels = _contract(labels, _confirm(best, texts, percent, k))
    if pending:
        rest = _across(reduce(DataFrame.union, pending).distinct(), labels)
        more = _confirm(rest, texts, percent, k)
        if not more.isEmpty():
            labels = _contract(labels, more)
    return labels


def _renumbered(rows: DataFrame, clash: DataFrame) -> DataFrame:
    node = F.when(F.col("clash").isNotNull(), F.xxhash64("node", "check")).otherwise(F.col("node"))
    return rows.join(clash, F.col("node") == F.col("clash"), "left").withColumn("node", node).drop("clash")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
                    coordinates: int = COORDINATES, k: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_shingles, component_id``
    (smallest doc_id reachable over links of Jaccard >= percent / 100) and
    ``first`` (whether the row is its component's representative)."""
    floor = match_floor(percent, coordinates)
    features = land(signatures(docs, id_col, text_col, coordinates, k), "signatures")
    nodes = land(features.where("node IS NOT NULL").groupBy("node", "check").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("rep"),
        F.count(F.lit(1)).alias("n_rows"), *[F.first(c).alias(c) for c in ("n_shingles", "entries", *_SKETCH)]), "nodes")
    # sets are equal if both fingerprints are; of two sets with one first fingerprint
    # (a chance of 2^-64 a pair) each gets a number from both
    clash = land(nodes.groupBy("node").count().where("count > 1").select(F.col("node").alias("clash")), "clashes")
    if not clash.isEmpty():
        features, nodes = _renumbered(features, clash), _renumbered(nodes, clash)
    postings = land(_several(prefix_postings(nodes, floor)), "postings")
    wanted = nodes.join(postings.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"))
    texts = land(
        docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                    F.col(text_col).alias("text"))
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_key") == F.col("rep_key")))
        .select("node", "text"), "texts")
    labels = link_components(nodes, postings, texts, floor, percent, k)
    members = nodes.select("node", "rep", "n_rows")
    members = (members.withColumn("root", F.lit(None).cast("bigint")) if labels is None
               else members.join(labels, "node", "left"))
    members = members.where("n_rows > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "node"))
    least = members.groupBy("root").agg(F.min("rep").alias("least"))
    found = members.join(least, "root").select(F.col("node").alias("found"), "least")
    joined = features.select("doc_id", "text_key", "n_shingles", "node").join(found, F.col("node") == F.col("found"), "left")
    return joined.select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("least").isNotNull(), F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (F.col("least").isNull() | (F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
                                    & (F.col("text_key") == F.col("least.text_key")))).alias("first"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns; of repeated rows
    (same id and text) one stays."""
    columns = docs.columns
    result = land(near_duplicates(docs, id_col, text_col, percent), "near-duplicates")
    gone = result.where(~F.col("first")).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")).distinct()
    keyed = docs.withColumn("__tk", F.xxhash64(F.col(text_col)))
    kept = keyed.join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tk") == F.col("__text")), "left_anti")
    repeated = result.where("n_shingles > 0").groupBy("doc_id", "text_key").count().where("count > 1").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"))
    if not repeated.isEmpty():
        same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tk") == F.col("__text"))
        kept = kept.join(repeated, same, "left_anti").union(
            kept.join(repeated, same, "left_semi").dropDuplicates([id_col, "__tk"]))
    return kept.select(*columns)


