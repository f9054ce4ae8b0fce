"""Decontamination and substring dedup against brute force."""

import random

from tessera.llm import decontaminate, substring_dedup

from .helpers import LOWER, WORD, documents, odd_texts, prose

ITEMS = "item_id long, text string"


def found(spark, texts, items, **kw):
    bench = spark.createDataFrame(list(enumerate(items)), ITEMS)
    rows = decontaminate.contaminations(documents(spark, texts), bench, **kw).collect()
    return {(r["doc_id"], r["item_id"]): r["verbatim"] for r in rows}


def test_verbatim_cased_and_embedded_items(spark):
    rng = random.Random(1)
    items = [prose(rng, 30, 5000) for _ in range(20)]
    texts = [prose(rng, 100, 5000) for _ in range(30)]
    want = set()
    for i in range(0, 30, 3):
        item = rng.randrange(20)
        passage = items[item].upper() if i % 2 else items[item]
        texts[i] = f"{prose(rng, 20, 5000)} {passage}, {texts[i]}"
        want.add((i, item))
    assert set(found(spark, texts, items)) == want


def test_new_numbers_names_and_units_are_the_same_question(spark):
    item = "A train leaves the old station at 12 km from here and then Alice walks 30 minutes to meet 12 friends of hers"
    same = "A train leaves the old station at 77 miles from here and then Robert walks 4.5 hours to meet 77 friends of hers"
    torn = "A train leaves the old station at 77 km from here and then Alice walks 30 minutes to meet 78 friends of hers"
    got = found(spark, [item, same, torn, "quite another text " * 10], [item])
    assert got[(0, 0)] is True and got[(1, 0)] is False
    # 12 stands for two numbers at once: only windows without contradiction count, 4 of 16
    assert (2, 0) not in got and (3, 0) not in got
    consistent = torn.replace("78", "77")
    assert (0, 0) in found(spark, [consistent], [item])


def test_short_items_empty_tables_nulls_and_repeats(spark):
    texts = odd_texts() + ["what is the capital of zorbia", "what is the capital of zorbia"]
    items = ["what is the capital of zorbia", "what is the capital of zorbia", None, "", "12 13"]
    n = len(texts)
    assert set(found(spark, texts, items)) == {(n - 2, 0), (n - 2, 1), (n - 1, 0), (n - 1, 1)}
    bench = spark.createDataFrame([(1, "a b c d e f g h i")], ITEMS)
    docs = documents(spark, ["a b c d e f g h i", None], ids=[None, 2]).selectExpr("*", "1 AS window", "2 AS item_id")
    out = decontaminate.remove_contaminated(docs, bench)
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [2]
    assert decontaminate.remove_contaminated(docs.where("false"), bench).count() == 0
    assert decontaminate.remove_contaminated(docs, bench.where("false")).count() == 2


def brute_spans(texts, min_words):
    units, first = [], {}
    for d, t in enumerate(texts):
        at = k = 0
        for line in (t or "").split("\n"):
            words = WORD.findall(line.translate(LOWER))
            if words:
                key = " ".join(words)
                first.setdefault(key, (d, at))
                units.append((d, k, at, len(line), len(words), key))
                k += 1
            at += len(line) + 1
    runs = []
    for u in units:
        if first[u[5]] == (u[0], u[2]):
            continue
        if runs and runs[-1][-1][0] == u[0] and runs[-1][-1][1] + 1 == u[1]:
            runs[-1].append(u)
        else:
            runs.append([u])
    return {(u[0], u[2], u[3], u[4], *first[u[5]]) for r in runs if sum(x[4] for x in r) >= min_words for u in r}


def test_repeated_passages_match_brute_force(spark):
    rng = random.Random(7)
    long, short = [prose(rng, 60) for _ in range(4)], [prose(rng, 12) for _ in range(10)]
    texts = odd_texts() + ["é ü ß\n" + "\n".join(rng.choice([*long, *short, "", " ", prose(rng, 15)]) for _ in range(9))
                           for _ in range(40)]
    texts += ["\n".join(short[:6]), "X\n" + "\n".join(s.upper() + "  " for s in short[:6])]
    rows = substring_dedup.removed_spans(documents(spark, texts)).collect()
    got = {(r["doc_id"], r["start"], r["length"], r["n_words"], r["kept_doc_id"], r["kept_start"]) for r in rows}
    assert got == brute_spans(texts, 50) and len(got) == len(rows)


def test_remove_repeats_keeps_columns_and_first_occurrence(spark):
    passage = prose(random.Random(2), 55)
    docs = documents(spark, [f"a\n{passage}\nb", f"c\n{passage}", passage, None, "x"], ids=[1, 2, None, 4, 5])
    docs = docs.selectExpr("*", "1 AS start", "2 AS line", "3 AS run")
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a\nb", 2: "c\n", None: passage, 4: None, 5: "x"}
    assert substring_dedup.remove_repeats(docs.where("false")).count() == 0
