import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm.queries import ORACLE_SQL, QUERIES

from .helpers import documents, odd_texts, prose


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "packing"]


def test_stages_keep_clean_documents_and_take_effect(spark, scratch):
    rng = random.Random(12)
    clean = [prose(rng, 90, 3000) for _ in range(8)]
    item = prose(rng, 25, 3000)
    texts = [*clean, clean[0], clean[1] + " w1", f"{prose(rng, 60, 3000)} {item} {prose(rng, 30, 3000)}",
             "spam spam spam " * 40, "too short", None, prose(rng, 70, 3000) + " mail me: jo.doe@mail.example.com"]
    documents(spark, texts).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, stage(spark, docs, scratch)
        if name != "packing":
            assert docs.columns == columns
        docs.write.parquet(f"{scratch}/{name}")
        docs = spark.read.parquet(f"{scratch}/{name}")
        left[name] = {r["doc_id"]: r for r in docs.collect()}
    private, leaked = len(texts) - 1, len(clean) + 2
    assert set(left["quality_rules"]) == {*range(len(clean) + 3), private}
    assert set(left["near_dedup"]) == {*range(len(clean)), leaked, private}
    assert set(left["decontamination"]) == {*range(len(clean)), private}
    assert all(left["pii"][i]["text"] == texts[i] for i in range(len(clean)))
    assert "jo.doe" not in left["pii"][private]["text"] and "@mail.example.com" in left["pii"][private]["text"]
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(tokens.encode(r["text"], add_special_tokens=False).ids) + 1 for r in left["pii"].values())
    assert docs.agg({"length": "sum"}).first()[0] == total


def test_pipeline_on_odd_and_empty_tables(spark, scratch):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    documents(spark, odd_texts()).write.parquet(f"{scratch}/documents.parquet")
    assert corpus_pipeline.run(spark, scratch).select("doc_id").distinct().count() >= 1
    documents(spark, ["x"]).where("false").write.mode("overwrite").parquet(f"{scratch}/empty/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{scratch}/empty/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{scratch}/empty").count() == 0
