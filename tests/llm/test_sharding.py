import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import sharding as s

from .helpers import documents, odd_texts


def digest(docs, shards=8):
    return s.shard_digest(docs, shards).collect()


def test_sizes_checksums_slots_and_growth(spark):
    texts = odd_texts() + [f"text {i}" * (i % 7) for i in range(600)]
    rows = digest(documents(spark, texts))
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    slots = {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 8)
        slots.setdefault(r["shard"], []).append((r["slot"], r["doc_id"]))
    assert set(slots) == set(range(8))
    for places in slots.values():
        places.sort()
        assert [p for p, _ in places] == list(range(len(places)))
        assert [d for _, d in places] == sorted(d for _, d in places)
    moved = sum(r["shard"] != r["grown_shard"] for r in rows)
    assert 0.5 < moved / (len(rows) / 9) < 1.6


def test_weights_and_removed_shard(spark):
    ids = spark.range(20_000).withColumn("key", F.col("id").cast("string"))
    weights = [1.0, 2.0, 5.0]
    both = ids.select(s.rendezvous(F.col("key"), weights).alias("a"), s.rendezvous(F.col("key"), weights[:2]).alias("b")).collect()
    counts = Counter(r["a"] for r in both)
    for shard, weight in enumerate(weights):
        assert abs(counts[shard] / 20_000 - weight / 8) < 0.02
    assert all(r["a"] == r["b"] for r in both if r["a"] != 2)  # only the removed shard's records move
    with pytest.raises(ValueError):
        s.rendezvous(F.col("key"), [1.0, 0.0])


def test_repeated_rows_null_keys_and_clashing_columns(spark, scratch):
    texts = ["same"] * 300 + ["a", "a", "b", None, ""]
    ids = [7] * 300 + [None] * 5
    docs = documents(spark, texts, ids=ids)
    rows = digest(docs)
    assert len(rows) == 305 and len({r["shard"] for r in rows if r["doc_id"] == 7}) == 1
    by_crc = {}
    for r in rows:
        by_crc.setdefault((r["doc_id"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(v) == 1 for v in by_crc.values())
    slots = Counter((r["shard"], r["slot"]) for r in rows)
    assert max(slots.values()) == 1
    clash = docs.withColumn("shard", F.lit("x")).withColumn("slot", F.lit(1)).withColumn("size", F.lit(2))
    assert sorted(map(str, digest(clash))) == sorted(map(str, rows))
    name = s.write_shards(clash, scratch + "/out", [1.0] * 3)
    back = s.read_shards(spark, scratch + "/out", clash.schema, name)
    assert name == "shard_" and back.where("shard = 'x'").count() == 305 and set(back.columns) == {*clash.columns, "shard_"}


def test_prefix_sums_over_many_stretches(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").alias("k")).repartition(7)
    got = s.number_rows(rows, "g", ["k"], fan=2).collect()
    assert all(r["slot"] == r["k"] // 3 for r in got) and len(got) == 500


def test_empty_table(spark):
    assert digest(documents(spark, [])) == []
