import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import spelling as s

from .helpers import LOWER, documents, odd_texts


def is_near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_force(texts, ids):
    counts = Counter()
    for i, text in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    out = {}
    for w, n in words.items():
        near = [x for x in words if is_near(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = [n, len(near), best if best and words[best] >= 10 * n else None]

    def root(w):
        return root(out[w][2]) if out[w][2] else w

    return {w: (n, k, f, words[f] if f else None, root(w)) for w, (n, k, f) in out.items()}


def small_alphabet(rng, n):
    return ["".join(rng.choice("abnoÉéß") for _ in range(rng.randrange(6, 10))) for _ in range(n)]


def test_matches_brute_force_with_chains(spark):
    rng = random.Random(2)
    words = small_alphabet(rng, 250)
    texts = odd_texts()
    for w in words:
        weight = rng.choice([1, 2, 2, 3, 30, 400])
        texts += [" ".join([w] * weight), w.upper() + "1" + w]
    # a chain of forms: 2 < 20 < 200 < 2000
    for i, n in enumerate((2, 20, 200, 2000)):
        texts.append(".".join(["colouring"[: 9 - i] + "zzzz"] * n))
    ids = [None if i % 17 == 5 else i // 2 for i in range(len(texts))]
    docs = documents(spark, texts, ids=ids).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in s.spelling_variants(docs).collect()}
    want = brute_force(texts, ids)
    assert got == want
    assert any(r != f for _, _, f, _, r in want.values() if f)


@pytest.mark.parametrize("node_words, node_bytes", [(20, 1 << 20), (1, 1 << 20), (1000, 60)])
def test_opened_nodes_find_every_pair_once(spark, node_words, node_bytes):
    rng = random.Random(5)
    words = sorted(set(small_alphabet(rng, 500)) | {"x" * n for n in (7, 8, 50, 51)})
    pairs = s.near_pairs(spark.createDataFrame([(w, 2) for w in words], "word string, n long"),
                         node_words=node_words, node_bytes=node_bytes).collect()
    want = {frozenset(p) for p in itertools.combinations(words, 2) if is_near(*p)}
    assert len(pairs) == len(want) and {frozenset((r["word"], r["near"])) for r in pairs} == want


def test_trie_levels_find_every_pair(monkeypatch):
    """Bundles of one word: the search goes down to full vectors."""
    rng = random.Random(6)
    words = sorted(set(small_alphabet(rng, 400)))
    monkeypatch.setattr(s, "BUNDLE", 1)
    q, t = s.near_in_node(words, words, 0)
    got = Counter(frozenset((words[i], words[j])) for i, j in zip(q, t))
    want = {frozenset(p) for p in itertools.combinations(words, 2) if is_near(*p)}
    assert set(got) == want and max(got.values()) == 1


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(s, "_PIECE", 10)
    text = "abcdefghijkl mnopqrs  tuvwxyzabcdefghijklmnopqrst u v" * 3
    assert "".join(s._pieces(text)) == text
    assert [w for p in s._pieces(text) for w in re.findall("[a-z]+", p)] == re.findall("[a-z]+", text)


def test_empty_and_wordless_tables(spark):
    assert s.spelling_variants(documents(spark, [None, "", "short a b"])).collect() == []
    assert s.spelling_variants(documents(spark, [])).collect() == []
