"""Template decontamination against a plain-Python version over whole tables."""

import re

from tessera.llm import decontaminate as d
from tessera.llm.common import read_table
from tests.conftest import SMOKE_DIR

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
LATIN = {chr(c): chr(c + 32) for c in range(0xC0, 0xDF) if c != 0xD7} | {chr(c): chr(c + 32) for c in range(65, 91)}


def lower(raw):
    return "".join(LATIN.get(c, c) for c in raw.decode("utf-8", "surrogateescape"))


def template(text):
    """(form, slot value or None, lower-cased word, line) of every word."""
    raw, words = text.encode(), []
    for m in WORD.finditer(raw):
        digits = m.group().isdigit()
        if (digits and words and words[-1]["number"] and words[-1]["end"] + 1 == m.start()
                and raw[m.start() - 1: m.start()] in (b".", b",")):
            words[-1]["end"] = m.end()  # 1,234.5 is one number
        else:
            words.append({"start": m.start(), "end": m.end(), "number": digits})
    out = []
    for i, w in enumerate(words):
        a, b = w["start"], w["end"]
        value = lower(raw[a:b])
        unit = i > 0 and words[i - 1]["number"] and value in d.UNITS
        back = raw[a - 2: a - 1] if a >= 2 else b""
        name = (a >= 2 and raw[a - 1: a] == b" " and (WORD.fullmatch(back) or back == b",") and raw[a: a + 1].isalpha()
                and raw[a] < 128 and raw[a: a + 1].isupper() and b - a > 1
                and (97 <= raw[a + 1] <= 122 or raw[a + 1] >= 128))
        kind = "#number" if w["number"] else "#unit" if unit else "#name" if name else None
        out.append((kind or value, value if kind else None, value, raw[:a].count(b"\n")))
    return out


def windows(words, size):
    """(start, key, slots, strong) of every window, by its words and by its template."""
    out = []
    for i in range(len(words) - size + 1):
        part = words[i: i + size]
        literals = sum(w[1] is None for w in part)
        strong = literals >= min(d.MIN_LITERALS, size)
        out.append((i, tuple(w[2] for w in part), (), strong))
        if strong and literals < size:
            out.append((i, tuple(w[0] for w in part), tuple(w[1] for w in part if w[1]), strong))
    return out


def judge(hits, item_windows, item_strong):
    """(windows, verbatim) of one occurrence, None if it is not enough."""
    pairs = {p for h in hits for p in zip(h["slots"], h["found"])}
    clear = len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
    counted = [h for h in hits if clear or h["slots"] == h["found"]]
    n, strong = len({h["position"] for h in counted}), len({h["position"] for h in counted if h["strong"]})
    if n >= d.MIN_SHARE * item_windows or strong and strong >= d.MIN_SHARE * item_strong:
        return n, all(h["slots"] == h["found"] for h in hits)
    return None


def contaminations(docs, items):
    """{(doc_id, item_id): (windows, item windows, verbatim)}"""
    index, totals = {}, {}
    for item_id, text in items:
        words = template(text or "")
        if not words:
            continue
        size = min(len(words), d.WINDOW)
        made = windows(words, size)
        totals[item_id] = (len({w[0] for w in made}), len({w[0] for w in made if w[3]}))
        for at, key, slots, strong in made:
            index.setdefault(key, []).append((item_id, at, slots, strong))
    sizes = {len(k) for k in index}
    out = {}
    for doc_id, text in docs:
        words, hits = template(text or ""), {}
        for size in sizes:
            for place, key, found, _ in windows(words, size):
                if size < d.SHORT_ITEM and not (
                        (place == 0 or words[place - 1][3] != words[place][3])
                        and (place + size == len(words) or words[place + size][3] != words[place + size - 1][3])):
                    continue
                for item_id, at, slots, strong in index.get(key, []):
                    if len(slots) == len(found):
                        hits.setdefault(item_id, set()).add((place, at, strong, slots, found))
        for item_id, some in hits.items():
            some = [dict(zip(("place", "position", "strong", "slots", "found"), h)) for h in sorted(some, key=lambda h: h[:2])]
            groups, stretch = {}, 0
            for before, h in zip([None, *some], some):
                if before and (h["place"], h["position"]) != (before["place"], before["position"]) and (
                        h["position"] <= before["position"] or h["place"] > before["place"] + d.STRETCH_GAP):
                    stretch += 1
                for key in (("all",), ("distance", h["place"] - h["position"]), ("stretch", stretch)):
                    groups.setdefault(key, []).append(h)
            found = [x for x in (judge(g, *totals[item_id]) for g in groups.values()) if x]
            if found:
                n, verbatim = max(found)
                out[doc_id, item_id] = (n, totals[item_id][0], verbatim)
    return out


def test_same_findings_on_whole_tables(spark):
    docs, bench = read_table(spark, SMOKE_DIR, "documents"), read_table(spark, SMOKE_DIR, "benchmark")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    # items with new numbers and names, as templates see them, besides the given ones
    changed = [(1000 + i, re.sub("[0-9]+", lambda m: str(int(m[0]) + 7), t or "")) for i, t in items]
    bench = spark.createDataFrame(items + changed, "item_id long, text string")
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = contaminations(texts, items + changed)
    got = {(r["doc_id"], r["item_id"]): (r["n_windows"], r["item_windows"], r["verbatim"])
           for r in d.contaminations(docs, bench).collect()}
    assert set(got) == set(want) and len(want) > 3
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}


def test_same_findings_on_constructed_texts(spark):
    item = "In the year 1905 a train of 12 cars left Oldtown at 40 km per hour, and Maria counted 12 cars twice before 1905 ended"
    texts = [item, item.replace("12", "31").replace("1905", "1877").replace("Maria", "Rosa"), item.replace("12", "31", 1),
             "x " * 30 + item.lower() + " y" * 30, item.upper(), f"{item}\n{item.replace('12', '9').replace('40', '55')}",
             " ".join(item.split()[:9]), " ".join(item.split()[4:16]), "Solve 3 x + 5 = 20\nand more", "Solve 4 x + 6 = 21", "yes"]
    items = [(0, item), (1, "Solve 3 x + 5 = 20"), (2, "Yes"), (3, "x + 5"), (4, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_windows"], r["item_windows"]) for r in d.contaminations(docs, bench).collect()}
    want = {k: v[:2] for k, v in contaminations(list(enumerate(texts)), items).items()}
    assert got == want and {(0, 0), (1, 0), (3, 0), (4, 0), (5, 0)} <= set(got)
