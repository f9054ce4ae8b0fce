import datetime
import random
import re

import pytest

from tessera.llm import pii

from .helpers import documents, odd_texts

VALUES = ["+1 (136) 555-7479", "97.51.17.173", "die.55@mail4.example.com", "4111 1111 1111 1111", "9807915762804490",
          "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "be10c5d8c2f94b1e9f0a3d7b6c5e4f3a", "1985-02-28", "31.12.1999",
          "12/25/2001", "123-45-6789", "DE89370400440532013000", "GB82WEST12345698765432", "415-555-1234"]
INVALID = ["300.1.1.1", "01.2.3.4", "1985-02-30", "666-12-1234", "DE00370400440532013000", "1.2.3", "12345",
           "1800-01-01", "version 2.0", "a@b", "1.2.3.4.5"]


def shape(text):
    return re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "9", text)))


def luhn(digits):
    total = 0
    for i, d in enumerate(int(c) for c in reversed(digits)):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def run(spark, texts, key="k", **options):
    rows = pii.pseudonymise(documents(spark, texts).select("doc_id", "text"), key, count_col="n", **options).collect()
    return {r["doc_id"]: (r["text"], r["n"]) for r in rows}


def test_valid_values_change_within_their_format_and_stay_linked(spark):
    texts = [f"x {v}, y" for v in VALUES] + [f"<{v}>" for v in VALUES] + VALUES
    got, n = run(spark, texts), len(VALUES)
    for i, v in enumerate(VALUES):
        new = got[i][0][2:-3]
        assert new != v and got[i][1] == 1
        assert got[n + i][0] == f"<{new}>" and got[2 * n + i][0] == new  # the same pseudonym everywhere
        if v not in ("97.51.17.173",):
            assert shape(new) == shape(v)
    assert luhn(re.sub(r"\D", "", got[3][0])) and not luhn(got[4][0][2:-3])
    octets = got[1][0][2:-3].split(".")
    assert len(octets) == 4 and all(int(o) <= 255 and str(int(o)) == o for o in octets)
    datetime.date.fromisoformat(got[7][0][2:-3])
    for i in (11, 12):
        iban = got[i][0][2:-3]
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_invalid_candidates_and_plain_text_stay(spark):
    texts = INVALID + ["no digits at all", "", "é 12 ü"]
    assert {i: t for i, (t, _) in run(spark, texts).items()} == dict(enumerate(texts))


def test_inverse_and_key(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.sample(VALUES, 5)) for _ in range(20)]
    docs = documents(spark, texts).select("doc_id", "text")
    hidden = pii.pseudonymise(docs, "k")
    assert {r["doc_id"]: r["text"] for r in pii.reveal(hidden, "k").collect()} == dict(enumerate(texts))
    assert run(spark, texts[:3], "k") != run(spark, texts[:3], "other")


@pytest.mark.parametrize("kind", ["date", "ssn", "digits"])
def test_permutations_are_one_to_one(spark, kind):
    if kind == "date":
        first = datetime.date(1900, 1, 1)
        values = [(first + datetime.timedelta(days=17 * i)).isoformat() for i in range(4000)]
    elif kind == "ssn":
        values = [f"{1 + i % 665:03d}-{1 + i % 99:02d}-{1 + i:04d}" for i in range(4000)]
    else:
        values = [f"{10**13 + i * 7919}" for i in range(4000)]
    got = run(spark, values)
    assert len({t for t, _ in got.values()}) == len(values)


def test_odd_texts_clashing_columns_and_empty_table(spark):
    texts = odd_texts()
    docs = documents(spark, texts).selectExpr("*", "'x' AS found", "2 AS new")
    out = pii.pseudonymise(docs, "k")
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == dict(enumerate(texts))
    assert pii.pseudonymise(docs.where("false"), "k").count() == 0


def test_n_chars_follows_the_text(spark):
    docs = documents(spark, ["ip 1.2.3.4 and 250.250.250.250", "plain"])
    assert all(r["n_chars"] == len(r["text"]) for r in pii.pseudonymise(docs, "k").collect())


def test_no_python_in_the_plan(spark):
    plan = pii.pseudonymise(documents(spark, VALUES), "k")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
