"""Items dense in numbers and names, items met twice, very short items."""

import random

from .helpers import prose
from .test_corpus_search import found


def test_dense_items_are_found_verbatim_and_re_cased(spark):
    rng = random.Random(3)
    items = ["What is 12 + 15 * 3?", "Solve 3 x + 5 = 20", "Evaluate 7 * 8 - 12 / 4 + 9 * 2", "Who is Barack Obama",
             "Capital of France", " ".join(f"{prose(rng, 1, 9000)} Ada {i} Bob {i + 50}" for i in range(9))]
    texts = [f"{prose(rng, 30, 5000)}\n{t}\n{prose(rng, 30, 5000)}" for i in items for t in (i, i.lower(), i.upper())]
    assert set(found(spark, [*texts, prose(rng, 60, 5000)], items)) == {(d, d // 3) for d in range(3 * len(items))}


def test_two_versions_of_a_question_in_one_text(spark):
    def version(a, b, c):
        return (f"A train leaves the old station at {a} km from here and then {c} walks {b} minutes to meet {a} friends "
                f"of hers")

    item, one, two = version(12, 30, "Alice"), version(77, 45, "Robert"), version(90, 20, "Maria")
    rng = random.Random(6)
    other = prose(rng, 300, 5000)
    # the same, with a word put into each version
    edited = f"{one.replace('and then', 'and only then')}. {two.replace('and then', 'and only then')}."
    got = found(spark, [f"{one}. {two}.", f"{one} {other} {two}", edited, other], [item])
    assert got == {(0, 0): False, (1, 0): False, (2, 0): False}


def test_very_short_items_must_fill_whole_lines(spark):
    texts = ["Yes we can, and the answer is here", "a b\nYes!\nc d", "The answer", "x the answer\ny", "no\n\n the answer.", "yes"]
    assert set(found(spark, texts, ["Yes", "the answer"])) == {(1, 0), (2, 1), (4, 1), (5, 0)}
