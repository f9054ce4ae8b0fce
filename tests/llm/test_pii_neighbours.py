"""Values next to other digits, and further formats."""

import re

import pytest

from tessera.llm import pii

from .helpers import documents
from .test_pii import luhn, run

CARD = "4845168114407329"


def test_digits_behind_a_card_stay_out_of_it(spark):
    spaced = "4845 1681 1440 7329"
    texts = [CARD, f"{CARD} 97.51.17.173", f"{CARD} 12/27", f"{CARD} 123", f"123 {CARD}", spaced, f"{spaced} 123",
             f"{spaced} 97.51.17.173", f"12 {spaced}", "97.51.17.173", "3782 822463 10005 1234", "3782 822463 10005"]
    got = [t for _, (t, _) in sorted(run(spark, texts).items())]
    card, ip, grouped = got[0], got[9], got[5]
    assert card != CARD and luhn(card) and luhn(re.sub(" ", "", grouped)) and grouped.replace(" ", "") == card
    assert got[1] == f"{card} {ip}" and "51.17.173" not in got[1]
    assert got[2:5] == [f"{card} 12/27", f"{card} 123", f"123 {card}"]
    assert got[6:9] == [f"{grouped} 123", f"{grouped} {ip}", f"12 {grouped}"]
    assert got[10] == f"{got[11]} 1234" and luhn(re.sub(" ", "", got[11]))


@pytest.mark.parametrize("value", ["+44 20 7946 0958", "+49 30 901820", "555 123 4567", "+33 1 23 45 67 89",
                                   "2024-01-15T10:00:00Z"])
def test_further_formats_change_and_come_back(spark, value):
    text = f"x {value}, y"
    new, n = run(spark, [text])[0]
    assert n == 1 and new != text and re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", text)
    if value.startswith("+"):
        assert new[:5] == text[:5]
    if "T" in value:
        assert new.endswith("T10:00:00Z, y")
    back = pii.reveal(documents(spark, [new]).select("doc_id", "text"), "k").collect()
    assert back[0]["text"] == text
