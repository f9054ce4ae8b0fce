import random

from tessera.llm import quality_rules as q

from .helpers import WORD, documents, odd_texts, prose


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i: i + 3]), []).append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_base_counts_match_brute_force(spark):
    rng = random.Random(1)
    texts = odd_texts() + ["a b c a b c", "The The The The", "x\nx\n\nx y\n x\nx", "a#b *$ <é|>&%"]
    texts += ["\n".join(prose(rng, rng.randrange(0, 9), 6) for _ in range(8)) for _ in range(20)]
    rows = q.verdicts(q.document_features(documents(spark, texts))).collect()
    for r in rows:
        want = base_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in COUNTS) == want, r["doc_id"]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_frequent_lines_per_host_and_depletion(spark):
    rng = random.Random(4)
    banner = prose(rng, 60)
    texts, sources = [], []
    for i in range(12):  # a banner over the limit in host a, below it in host b
        texts += [banner + "\n" + prose(rng, 70), banner.upper() + "  \n" + prose(rng, 5)]
        sources += ["a", "a" if i < 9 else "b"]
    docs = documents(spark, texts, sources=sources)
    rows = {r["doc_id"]: r for r in q.verdicts(q.document_features(docs), limit=10).collect()}
    for i, (text, source) in enumerate(zip(texts, sources)):
        lost = source == "a" and i != 0  # the first carrier keeps its line
        assert (rows[i]["removed_words"] or 0) == (60 if lost else 0)
        assert rows[i]["kept"] == (not (lost and len(text.split()) == 65))
    kept = {r["doc_id"]: r["text"] for r in q.apply_quality_rules(docs, limit=10).collect()}
    assert set(kept) == {i for i in rows if rows[i]["kept"]}
    assert kept[0] == texts[0] and kept[2] == texts[2].split("\n")[1]


def test_copies_do_not_make_their_lines_frequent(spark):
    rng = random.Random(8)
    text = "\n".join(prose(rng, 20) for _ in range(5))
    docs = documents(spark, [text] * 40)
    assert all(r["kept"] for r in q.verdicts(q.document_features(docs), limit=10).collect())


def test_nulls_repeated_rows_clashing_columns_and_empty_table(spark):
    rng = random.Random(6)
    body = prose(rng, 80)
    docs = documents(spark, [body, body, None, body], ids=[None, 1, 2, 1], sources=[None, "a", None, "a"])
    docs = docs.selectExpr("*", "1 AS kept", "2 AS lines", "3 AS removed", "4 AS h")
    out = q.apply_quality_rules(docs)
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "1", "None"]
    assert q.apply_quality_rules(docs.where("false")).count() == 0
