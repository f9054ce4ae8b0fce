"""Pseudonyms value by value against a plain-Python Feistel, long texts, grouped IBANs, the key."""

import datetime
import hashlib
import hmac
import random
import re
import time

from tessera.llm import pii

from .helpers import documents
from .test_pii import INVALID, VALUES, run

KEY = "a key"
SUB = hmac.new(KEY.encode(), b"format-preserving pseudonyms", hashlib.sha256).digest()


def keyed(*parts):
    return hmac.new(SUB, "|".join(map(str, parts)).encode(), hashlib.sha256).hexdigest()


def feistel(kind, a, b, left, right):
    for turn in range(10):
        if turn % 2 == 0:
            a = (a + int(keyed(kind, turn, b)[:15], 16)) % left
        else:
            b = (b + int(keyed(kind, turn, a)[:15], 16)) % right
    return a, b


def digits(kind, text):
    u = len(text) // 2
    v = len(text) - u
    a, b = feistel(f"{kind}{len(text)}", int(text[:u] or 0), int(text[u:]), 10**u, 10**v)
    return (f"{a:0{u}d}" if u else "") + f"{b:0{v}d}"


def characters(kind, text, letters):
    a, b = text[: len(text) // 2], text[len(text) // 2:]
    for turn in range(10):
        half, other = (a, b) if turn % 2 == 0 else (b, a)
        stream = "".join(keyed(kind, turn, i, other) for i in range(len(text) // 64 + 1))
        out = ""
        for j, c in enumerate(half):
            k = int(stream[2 * j: 2 * j + 2], 16)
            for first, size in (("a", letters), ("A", letters), ("0", 10)):
                if 0 <= ord(c) - ord(first) < size:
                    c = chr(ord(first) + (ord(c) - ord(first) + k) % size)
                    break
            out += c
        a, b = (out, b) if turn % 2 == 0 else (a, out)
    return a + b


def luhn_digit(body):
    total = 0
    for i, d in enumerate(int(c) for c in reversed(body)):
        d = d * 2 if i % 2 == 0 else d
        total += d - 9 if d > 9 else d
    return (10 - total % 10) % 10


def refill(text, new):
    left = iter(new)
    return "".join(next(left) if c.isdigit() else c for c in text)


def number(text):
    d = re.sub(r"\D", "", text)
    gap = (int(d[-1]) - luhn_digit(d[:-1])) % 10
    body = digits("number" if gap else "card", d[:-1])
    return refill(text, body + str((luhn_digit(body) + gap) % 10))


def date(text, form):
    first = datetime.date(1900, 1, 1)
    a, b = feistel("date", *divmod((datetime.datetime.strptime(text, form).date() - first).days, 4297), 17, 4297)
    return (first + datetime.timedelta(days=a * 4297 + b)).strftime(form)


def ip(text):
    o = [int(x) for x in text.split(".")]
    a, b = feistel("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def ssn(text):
    area, group, serial = map(int, text.split("-"))
    a, b = feistel("ssn", area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
    return f"{a + 1 + (a >= 665):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"


def iban(text):
    body = characters("iban", text[4:], 26)
    return f"{text[:2]}{98 - int(''.join(str(int(c, 36)) for c in body + text[:2] + '00')) % 97:02d}{body}"


def phone(text):
    d = re.sub(r"\D", "", text)
    code = re.match(r"\+([0-9]{1,3})[ .\-(]", text)
    stays = len(code[1]) if code else max(len(d) - 10, 1) if text[0] == "+" else len(d) - 10
    return refill(text, d[:stays] + digits("phone", d[stays:]))


def test_every_kind_value_by_value(spark):
    rng = random.Random(7)
    made = []
    for _ in range(40):
        made += [(f"{rng.randrange(10**15, 10**16)}", number), (f"{rng.randrange(256)}.{rng.randrange(256)}.7.{rng.randrange(256)}", ip),
                 (f"{rng.choice([1, 665, 667, 899]):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}", ssn),
                 ((datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(73049))).isoformat(), lambda t: date(t, "%Y-%m-%d")),
                 (f"{rng.randrange(1, 29):02d}.{rng.randrange(1, 13):02d}.{rng.randrange(1900, 2100)}", lambda t: date(t, "%d.%m.%Y")),
                 (f"{rng.randrange(100, 999)}-555-{rng.randrange(10**4):04d}", phone),
                 (f"+49 30 {rng.randrange(10**6):06d}", phone),
                 ("%032x" % rng.randrange(16**32), lambda t: characters("secret", t, 6)),
                 ("%0128X" % rng.randrange(16**128), lambda t: characters("secret", t, 6))]
        name = "".join(rng.choice("ab.C1_") for _ in range(rng.randrange(1, 100)))
        made.append((f"{name}@mail.example.com", lambda t: characters("email", t.split("@")[0], 26) + "@mail.example.com"))
        account = f"{rng.randrange(10**18):018d}"
        check = 98 - int(account + "131400") % 97
        made.append((f"DE{check:02d}{account}", iban))
    cards = [(v, number) for v in ("4111 1111 1111 1111", "3782-822463-10005") if v in VALUES or luhn_digit(re.sub(r"\D", "", v)[:-1]) >= 0]
    made += cards
    got = run(spark, [v for v, _ in made], KEY)
    for i, (value, want) in enumerate(made):
        assert got[i][0] == want(value), value


def test_grouped_ibans_keep_their_link(spark):
    solid = "DE89370400440532013000"
    group = " ".join(solid[i: i + 4] for i in range(0, 22, 4))
    even = "AT611904300234573201"
    texts = [solid, group, f"IBAN {group}.", even, " ".join(even[i: i + 4] for i in range(0, 20, 4)) + " BANK",
             "NO12 4111 1111 1111 1111", "DE00 3704 0044 0532 0130 00", "AB12 WORD MORE text"]
    got = run(spark, texts, KEY)
    new, other = got[0][0], got[3][0]
    assert new == iban(solid) != solid and got[1][0].replace(" ", "") == new and got[1][0].count(" ") == 5
    assert got[2][0] == f"IBAN {got[1][0]}."
    assert got[4][0] == " ".join(other[i: i + 4] for i in range(0, 20, 4)) + " BANK"
    assert got[5][0] == "NO12 " + number("4111 1111 1111 1111")
    assert got[7][0] == texts[7]
    hidden = pii.pseudonymise(documents(spark, texts[:6]).select("doc_id", "text"), KEY)
    assert {r["doc_id"]: r["text"] for r in pii.reveal(hidden, KEY).collect()} == dict(enumerate(texts[:6]))


def test_long_texts_cost_in_proportion(spark):
    texts = ["x@" + "a." * 100_000 + "com", "n" * 1_000_000 + "@example.com", "a@b." * 50_000, "f" * 500_000,
             "1-" * 200_000, "1.2." * 100_000, "AB12 " + "ABCD " * 100_000, "x" * 300 + "@a.b " + "n1@example.com " * 20_000]
    begun = time.time()
    got = run(spark, texts, KEY)
    assert time.time() - begun < 60
    assert got[0][0] == texts[0] and got[1][0] == texts[1] and got[3][0] == texts[3]
    assert got[7][1] == 20_000 and got[7][0].startswith("x" * 300 + "@a.b ")


def test_key_is_not_in_the_plan(spark):
    secret = "correct horse battery staple"
    df = pii.pseudonymise(documents(spark, VALUES + INVALID), secret)
    assert secret not in df._jdf.queryExecution().toString() and secret.encode().hex() not in df._jdf.queryExecution().toString()


def test_no_public_default_key(spark):
    from tessera.llm.queries import PII_KEY, pii_key

    one = pii_key(spark)
    assert len(one) == 64 and pii_key(spark) == one
    spark.conf.set(PII_KEY, "mine")
    try:
        assert pii_key(spark) == "mine"
    finally:
        spark.conf.unset(PII_KEY)
