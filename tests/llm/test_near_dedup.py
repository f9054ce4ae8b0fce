import random

import pytest

from tessera.llm import near_dedup
from tessera.llm.components import components as join_components

from .helpers import components, documents, odd_texts, prose, shingles


def perturbed(rng, text, share):
    words = text.split()
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = f"n{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(11)
    base = [prose(rng, rng.randrange(20, 120)) for _ in range(12)]
    texts = list(base)
    for b in base:
        texts += [perturbed(rng, b, s) for s in (0.005, 0.01, 0.02, 0.05)]
        texts += [b] * 2
    chain = prose(rng, 200).split()  # links that only reach on through others
    for step in range(0, 40, 4):
        texts.append(" ".join(chain[step:] + [f"c{step}_{i}" for i in range(step)]))
    texts += ["a b", "A  B", "a b c", None, "", " "]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("percent", [80, 85])
def test_components_match_brute_force(spark, percent):
    texts = corpus()
    ids = list(range(len(texts)))
    rows = near_dedup.near_duplicates(documents(spark, texts), percent=percent).collect()
    found = {r["doc_id"]: r["component_id"] for r in rows}
    assert [found[i] for i in ids] == components(texts, ids, percent)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(shingles(t)) for i, t in zip(ids, texts)}


def test_sets_with_one_fingerprint_stay_apart(spark, monkeypatch):
    whole = near_dedup.signatures

    def clashing(*args, **options):
        return whole(*args, **options).selectExpr("*", "node IS NULL AS none").selectExpr(
            "doc_id", "text_key", "n_shingles", "CASE WHEN NOT none THEN node % 3 END AS node", "`check`", "entries",
            *near_dedup._SKETCH)

    monkeypatch.setattr(near_dedup, "signatures", clashing)
    texts = corpus()
    rows = near_dedup.near_duplicates(documents(spark, texts), percent=80).collect()
    assert [r["component_id"] for r in sorted(rows, key=lambda r: r["doc_id"])] == components(texts, list(range(len(texts))), 80)


def test_large_group_of_near_copies_takes_pivot_rounds(spark, monkeypatch):
    rng = random.Random(5)
    base = prose(rng, 150)
    texts = [perturbed(rng, base, 0.01) for _ in range(120)] + [prose(rng, 50) for _ in range(30)]
    monkeypatch.setattr(near_dedup, "EXPAND", 0)  # no all-at-once step while pivots contract
    monkeypatch.setattr(near_dedup, "CONTRACT", 0.0)
    rows = near_dedup.near_duplicates(documents(spark, texts), percent=80).collect()
    want = components(texts, list(range(len(texts))), 80)
    assert [r["component_id"] for r in sorted(rows, key=lambda r: r["doc_id"])] == want


def test_deduplicate_keeps_one_and_all_columns(spark):
    rng = random.Random(9)
    a, b = prose(rng, 80), prose(rng, 80)
    docs = documents(spark, [a, a, a, b, None, None, ""], ids=[7, 3, 3, 9, 1, 1, None])
    docs = docs.selectExpr("*", "'x' AS node", "1 AS component_id", "true AS first", "0 AS text_key")
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == sorted(
        [(3, a), (9, b), (1, ""), (1, ""), (-1, "")])


def test_odd_texts_and_empty_table(spark):
    texts = odd_texts()
    rows = near_dedup.near_duplicates(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(shingles(t)) for i, t in enumerate(texts)}
    empty = documents(spark, ["x"]).where("false")
    assert near_dedup.near_duplicates(empty).count() == 0
    assert near_dedup.deduplicate(empty).count() == 0


def test_null_ids_lose_against_others(spark):
    text = prose(random.Random(2), 40)
    rows = near_dedup.near_duplicates(documents(spark, [text, text, "q r s t u v"], ids=[None, 5, None])).collect()
    assert sorted(str(r["component_id"]) for r in rows) == ["5", "5", "None"]


def test_match_floor_bounds_the_chance_of_a_miss():
    from math import comb

    for percent in (80, 85):
        m = near_dedup.match_floor(percent)
        p = percent / 100
        miss = sum(comb(48, i) * p**i * (1 - p) ** (48 - i) for i in range(m))
        assert miss <= near_dedup.MISS


def test_long_path_of_links(spark):
    n = 60
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in join_components([links]).collect()}
    assert got == {**{i: 0 for i in range(n)}, 100: 100, 101: 100}
