"""Repeated passages that start or end inside a line, against brute force."""

import random

from tessera.llm import substring_dedup

from .helpers import LOWER, WORD, documents, prose


def brute_words(texts, size):
    """(text, offset) of every word of a window that has an earlier, not overlapping place."""
    first, gone = {}, set()
    for d, t in enumerate(texts):
        words = list(WORD.finditer(t.translate(LOWER)))
        for p in range(len(words) - size + 1):
            key = tuple(w.group() for w in words[p: p + size])
            e, q = first.setdefault(key, (d, p))
            if e != d or p >= q + size:
                gone |= {(d, w.start()) for w in words[p: p + size]}
    return gone


def test_passages_inside_lines_match_brute_force(spark):
    rng = random.Random(5)
    passages = [prose(rng, n, 5000) for n in (50, 51, 75, 140)]
    texts = [f"é {prose(rng, rng.randrange(1, 80), 5000)} {rng.choice(passages)} ü {prose(rng, 30, 5000)}" for _ in range(30)]
    texts[3] = texts[3].upper().replace(" ", " \t")
    texts[4] = texts[4].replace(" ", "\n")  # other lines, same words
    texts += ["a b " * 200, prose(rng, 49, 5000), "x " + " ".join([passages[0]] * 3)]
    rows = substring_dedup.removed_spans(documents(spark, texts)).collect()
    got = {(r["doc_id"], r["start"] + w.start()) for r in rows
           for w in WORD.finditer(texts[r["doc_id"]][r["start"]: r["start"] + r["length"]])}
    assert got == brute_words(texts, 50) and len(got) == sum(r["n_words"] for r in rows)
    for r in rows:  # the kept occurrence has the same first word
        kept = texts[r["kept_doc_id"]][r["kept_start"]:]
        assert kept.split()[0].lower() == texts[r["doc_id"]][r["start"]:].split()[0].lower()


def test_cut_inside_a_line_keeps_own_text(spark):
    passage = prose(random.Random(2), 60)
    docs = documents(spark, [f"own one {passage} tail", f"own two {passage} end\nnext", f"{passage} more\nlast", f"z {passage}\ny"])
    assert {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(docs).collect()} == {
        0: f"own one {passage} tail", 1: "own two end\nnext", 2: "more\nlast", 3: "z \ny"}
