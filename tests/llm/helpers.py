"""Small fixtures and brute-force versions for the training-data operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, texts, ids=None, sources=None, partitions=3):
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def odd_texts():
    """Null, empty, blank, very long, other scripts, odd white space."""
    rng = random.Random(3)
    return [None, "", " \n\t ", prose(rng, 30_000), "x" * 200_000, "日本語 のテキスト é ß\x85 z", "a\x1fb\x00c d",
            "<|endoftext|> it's we'll\r\nb  c", "One.\n\nOne.\n", prose(rng, 60)]


def shingles(text, k=5):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i: i + k]) for i in range(len(words) - k + 1)}


def components(texts, ids, percent):
    """Brute force: smallest id reachable over links of Jaccard >= percent."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(texts)):
        root = find(i)
        if ids[i] is not None:
            least[root] = min(ids[i], least.get(root, ids[i]))
    return [least.get(find(i)) for i in range(len(texts))]
