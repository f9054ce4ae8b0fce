import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import quality_cnn as q

from .helpers import documents, odd_texts, prose


def labelled(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = prose(rng, rng.randrange(20, 200)).split()
        texts.append(" ".join(words) if good else "!! ".join(w.upper() for w in words))
        labels.append(int(good))
    return texts, labels


def direct(net, data, segment):
    """The network by plain loops over positions, chunks and filters."""
    width = len(net.filters)
    n = max(len(data) - width + 1, 1)
    padded = list(data) + [0] * (n + width - 1 - len(data))
    at = np.array([np.maximum(sum(net.filters[j][padded[p + j]] for j in range(width)) + net.bias, 0) for p in range(n)])
    parts = [at[s: s + segment].max(axis=0) for s in range(0, n, segment)]
    chunks = [np.maximum(a, b) for a, b in zip(parts, parts[1:])] or parts
    return np.mean(chunks, axis=0)


def test_document_vector_covers_every_byte(monkeypatch):
    rng = np.random.default_rng(1)
    net = q.Network(rng.standard_normal((4, 256, 5)).astype(np.float32), rng.standard_normal(5).astype(np.float32),
                    rng.standard_normal(5).astype(np.float32), 0.1)
    monkeypatch.setattr(q, "_SLICE", 64)  # long texts go slice by slice
    for n in (0, 1, 3, 4, 31, 32, 33, 64, 65, 500):
        data = rng.integers(0, 256, n).astype(np.uint8)
        np.testing.assert_allclose(net.document(data, 16), direct(net, data.tolist(), 16), rtol=1e-4, atol=1e-5)


def test_held_out_accuracy_and_contract(spark):
    texts, labels = labelled(400, 5)
    docs = documents(spark, texts)
    table = spark.createDataFrame([(i, y, 0) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    net = q.train(docs, table)
    rows = q.score(docs, net).withColumn("held_out", q.held_out(F.col("doc_id"))).collect()
    out = {r["doc_id"]: r for r in rows}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    right = [(r["score"] >= q.THRESHOLD) == bool(labels[i]) for i, r in out.items() if r["held_out"]]
    assert sum(right) / len(right) > 0.95
    again = q.train(docs.repartition(7), table.repartition(5))
    assert (again.filters == net.filters).all()


def test_held_out_labels_never_matter(spark):
    texts, labels = labelled(120, 6)
    docs = documents(spark, texts)
    flipped = [1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y for i, y in enumerate(labels)]
    nets = [q.train(docs, spark.createDataFrame(list(enumerate(y)), "doc_id long, quality int")) for y in (labels, flipped)]
    assert (nets[0].filters == nets[1].filters).all() and nets[0].out_bias == nets[1].out_bias


def test_odd_texts_no_labels_and_empty_table(spark):
    texts = odd_texts()
    docs = documents(spark, texts).selectExpr("*", "1 AS score", "2 AS quality")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    net = q.train(docs, none)
    assert {r["score"] for r in q.score(docs, net).collect()} == {0.5}
    assert q.score(docs.where("false"), net).count() == 0
    net = q.fit([b"aaa bbb", b"###"], [1, 0])
    rows = q.score(docs, net).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
