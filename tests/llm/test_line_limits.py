"""What counts for the limit of a line in its host."""

import random

from tessera.llm import quality_rules as q

from .helpers import documents, prose


def test_documents_that_share_much_text_count_each(spark):
    rng = random.Random(9)
    banner = prose(rng, 200, 5000)
    texts = [f"{banner}\n{prose(rng, 30, 5000)}" for _ in range(60)]
    rows = q.verdicts(q.document_features(documents(spark, texts)), limit=50).collect()
    assert {r["doc_id"] for r in rows if r["kept"]} == {0}  # the first carrier


def test_limit_follows_the_host_and_short_lines_stay(spark):
    rng = random.Random(10)
    lines = {0: "les.", 1: "and ornd.", 2: "in every third document", 3: "in some of them"}
    texts = []
    for i in range(120):
        own = [prose(rng, 60, 5000), lines[0], lines[1]]
        texts.append("\n".join(own + [lines[2]] * (i % 3 == 0) + [lines[3]] * (i % 13 == 0)))
    out = {r["doc_id"]: r["text"] for r in q.apply_quality_rules(documents(spark, texts), limit=10).collect()}
    assert len(out) == 120
    for i, text in enumerate(texts):
        want = text if i == 0 else "\n".join(x for x in text.split("\n") if x != lines[2])
        assert out[i] == want


def test_boilerplate_of_a_large_host_goes_and_clean_texts_stay(spark):
    """Planted lines in 30, 10, 5 and 2 % of a host of 1200, one of them short."""
    rng = random.Random(12)
    planted = {"all rights of this host are reserved now": 30, "please read our terms of use first": 10,
               "made with love by the host team": 5, "a verse that two in a hundred quote": 2, "share this page": 7}
    texts = []
    for i in range(1200):
        texts.append("\n".join([prose(rng, 80, 9000), *[x for x, p in planted.items() if (i * 7919 + len(x) * 31) % 100 < p],
                                prose(rng, 12, 9000)]))
    out = {r["doc_id"]: r["text"] for r in q.apply_quality_rules(documents(spark, texts)).collect()}
    gone = {x for x, p in planted.items() if p in (30, 10, 5)}
    first = {x: min(i for i, t in enumerate(texts) if x in t.split("\n")) for x in gone}
    assert len(out) == 1200
    for i, text in enumerate(texts):
        assert out[i] == "\n".join(x for x in text.split("\n") if x not in gone or first[x] == i)
