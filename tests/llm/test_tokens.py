import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing, token_counts, token_files
from tessera.llm.huffman import Decoder, canonical_codes, code_lengths, encode_blocks
from tessera.llm.tokenizer import encoder

from .helpers import documents, odd_texts, prose

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [*"ab éǅİΣ'sre.,!\n\t  1_$　ñ<|>\x1c\x85", "<|endoftext|>", "'re", "'ll", "日本", "  "]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.fixture(scope="module")
def byte_ids():
    t = Tokenizer.from_file(BYTE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_memo_encoder_equals_library(byte_ids):
    texts = random_texts(3000, 1) + [t or "" for t in odd_texts()]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(BYTE).encode(texts)] == [byte_ids(t) for t in texts]


def test_every_prefix_count_equals_library():
    library = Tokenizer.from_file(WORD)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in random_texts(400, 2) + ["Hello we're there 123", "thereafter'll"]:
        table, normal = token_counts.counter(WORD).table(text), token_counts.normalized(text, WORD)
        totals = np.cumsum(np.frombuffer(table, "<i2"), dtype=np.int64).tolist()
        assert len(totals) == len(normal) and (totals[-1] if totals else 0) == count(text)
        assert totals == [count(normal[:n]) for n in range(1, len(normal) + 1)], text


def test_token_counts_and_budgets(spark):
    texts = odd_texts()
    counted = token_counts.prefix_token_counts(documents(spark, texts), WORD)
    library = Tokenizer.from_file(WORD)
    for r in token_counts.with_budgets(counted, [3]).collect():
        text = texts[r["doc_id"]] or ""
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] <= 3 or token_counts.tokens_at(r["prefix"], r["fits_3"]) <= 3
    assert counted.where("false").count() == 0


def test_huffman_round_trip():
    rng = np.random.default_rng(1)
    for n, size in ((1, 1), (2, 2), (513, 700), (100_000, 50_000)):
        ids = np.minimum(rng.pareto(1.0, n) * 5, size - 1).astype(np.uint32)
        counts = np.bincount(ids)
        for limit in (17, 20):
            lengths = code_lengths(counts, limit)
            used = lengths[lengths > 0].astype(int)
            assert used.max() <= limit and sum(2.0 ** -used) <= 1
            payload, starts = encode_blocks(ids, canonical_codes(lengths), lengths, 64)
            assert (Decoder(lengths).blocks(payload, starts, n, 64) == ids).all()
    lengths = code_lengths(np.array([5, 1, 1, 2]), 16)  # plain Huffman where the limit is far
    assert lengths.tolist() == [1, 3, 3, 2]


def test_token_files_round_trip(spark, scratch, byte_ids):
    texts = odd_texts() + random_texts(60, 4)
    ids = [None, *range(len(texts) - 3, 0, -1), 5, 5]
    docs = documents(spark, texts, ids=ids).selectExpr("*", "1 AS part", "2 AS seq", "3 AS ids")
    landed = token_files.token_ids(docs, BYTE, partition_bytes=100_000)
    landed.write.parquet(f"{scratch}/ids")
    landed = spark.read.parquet(f"{scratch}/ids")
    files = token_files.write_token_files(landed, f"{scratch}/files", file_tokens=5000)
    back = token_files.read_token_files(spark, f"{scratch}/files").join(files.select("part", "seq", "start"), ["part", "seq"])
    rows = sorted(back.collect(), key=lambda r: r["start"] + r["in_file"])
    assert files.count() > 2
    place = 0
    for r in rows:
        assert r["start"] + r["in_file"] == place
        place += r["n_tokens"]
    names = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert names == sorted(-1 if i is None else i for i in ids)
    got = sorted((n, bytes(r["ids"])) for n, r in zip(names, rows))
    want = sorted((-1 if i is None else i, np.array([*byte_ids(t), 0], "<u4").tobytes()) for i, t in zip(ids, texts))
    assert got == want


def test_starts_add_up_over_groups_of_ranges(spark, scratch, monkeypatch):
    monkeypatch.setattr(token_files, "FAN", 2)
    texts = random_texts(80, 9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges
    try:
        token_files.token_ids(documents(spark, texts), BYTE).write.parquet(f"{scratch}/ids")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = token_files.write_token_files(spark.read.parquet(f"{scratch}/ids"), f"{scratch}/files", file_tokens=700).collect()
    at = 0
    for r in sorted(files, key=lambda r: (r["part"], r["seq"])):
        assert r["start"] == at
        at += r["n_tokens"]
    assert len({r["part"] for r in files}) > 4


def test_blocks_decode_independently():
    ids = np.arange(1000, dtype=np.uint32) % 37
    lengths = code_lengths(np.bincount(ids), 16)
    payload, starts = encode_blocks(ids, canonical_codes(lengths), lengths, 100)
    one = Decoder(lengths).blocks(payload, starts[4:5], 100, 100)
    assert (one == ids[400:500]).all()


def test_empty_tables(spark, scratch):
    docs = documents(spark, ["x"]).where("false")
    ids = token_files.token_ids(docs, BYTE)
    assert ids.count() == 0
    assert token_files.write_token_files(ids, f"{scratch}/none").count() == 0
    assert packing.pack(docs, BYTE).count() == 0


def check_pieces(rows, want):
    """Each id in exactly one piece; sequences gapless and at most 2048."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        ids = b"".join(bytes(r["ids"]) for r in pieces)
        assert np.frombuffer(ids, "<u4").tolist() == want[doc]
        assert [r["start"] for r in pieces] == list(np.cumsum([0, *[r["length"] for r in pieces]])[:-1])
        assert all(r["doc_tokens"] == len(want[doc]) for r in pieces)
    padded = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        total = 0
        for r in pieces:
            assert r["offset"] == total
            total += r["length"]
        assert total <= r["window"] <= 2048
        padded += total & (total - 1) != 0
    return padded


def test_packing_places_every_token_once(spark, byte_ids):
    rng = random.Random(3)
    texts = odd_texts() + [prose(rng, rng.randrange(1, 1500)) for _ in range(120)]
    docs = documents(spark, texts).selectExpr("*", "1 AS start", "2 AS shard", "3 AS rid", "4 AS offset")
    rows = packing.pack(docs, BYTE, shard_tokens=50_000).collect()
    want = {i: [*byte_ids(t), 1] for i, t in enumerate(texts)}
    assert {r["doc_id"] for r in rows} == set(want)
    padded = check_pieces(rows, want)
    assert padded <= -(-sum(map(len, want.values())) // 50_000)
    steps = {}
    for r in rows:
        steps[r["step_id"]] = steps.get(r["step_id"], 0) + r["length"]
    assert max(steps.values()) <= 2 * packing.STEP_TOKENS


def test_repeated_and_null_rows_are_packed_each(spark):
    docs = documents(spark, ["a b", "a b", None, "c"], ids=[1, 1, None, None])
    rows = packing.pack(docs, BYTE).collect()
    assert sum(r["length"] for r in rows) == 3 + 3 + 1 + 2


def test_plan_covers_every_token():
    rng = random.Random(2)
    for n in (0, 1, 2, 500):
        sizes = [rng.randrange(1, 2048) for _ in range(n)]
        seen = {}
        for window, parts in packing.plan_shard(sizes):
            assert window == 0 or sum(p[2] for p in parts) == window
            for i, first, length in parts:
                seen.setdefault(i, []).append((first, length))
        for i, size in enumerate(sizes):
            at = 0
            for first, length in sorted(seen[i]):
                assert first == at
                at += length
            assert at == size


def test_crc_matches_zlib(spark):
    from pyspark.sql import functions as F

    data = np.array([1, 2, 70000], "<u4").tobytes()
    row = spark.createDataFrame([(data,)], "b binary").select(F.crc32("b").alias("c")).first()
    assert row["c"] == zlib.crc32(data)
