"""Copies in another letter case, behind another word, dense in slots or short are found."""

from __future__ import annotations

import pytest

from tests.llm.test_decontaminate import FILLER, QUESTION
from wardscope.llm.decontaminate import contamination

ITEMS = [(1, QUESTION), (2, "Please compute seven times eight now"), (3, "What is the largest of all the rivers in Asia"), (4, "What is 12 + 34 + 56"),
         (5, "Paris 12 14 Rome 15 16 Oslo 17 18 Berne 19 20 Turin 21 22"), (6, "Define entropy"), (7, "Große Fragen des Lebens von 3 Philosophen"),
         (8, "how many apples does Anna eat within 12 days if Berta eats 3 apples a day instead")]


@pytest.mark.parametrize("text, item", [
    (f"*** {QUESTION.upper()}", 1), (QUESTION.upper().replace("120", "300"), 1), (QUESTION.title(), 1),
    ("Q1 Please compute seven times eight now", 2), ("Heading\nWhat is the largest of all the rivers in Asia\n", 3), ("(a) WHAT IS 12 + 34 + 56", 4),
    ("What is 12 + 34 + 57", None), (ITEMS[4][1], 5), (ITEMS[4][1].lower(), 5), (ITEMS[4][1].replace("15", "25"), None),
    (f"{FILLER} define Entropy {FILLER}", 6), ("define the entropy", None), ("GROSSE FRAGEN DES LEBENS VON 3 PHILOSOPHEN", 7),
    (ITEMS[7][1].lower().replace("12", "15"), 8), (ITEMS[7][1].upper().replace("12", "15"), 8), (FILLER, None)])
def test_copies(spark, text, item):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = contamination(docs, items).collect()
    assert row.item_id == item and row.contaminated == (item is not None)


def test_every_item_of_a_template_counts(spark):
    """Items that share each short window, but whose slots far apart are equal in one and different in the other."""
    words = "a shop sells {} boxes of very ripe red apples and then {} more before noon on"
    items = spark.createDataFrame([(1, words.format(7, 7)), (2, words.format(7, 9)), (3, words.format(8, 9))], "item_id long, text string")
    texts = [words.format(3, 5), words.format(3, 3), f"{FILLER} {words.format(3, 5)} {FILLER}", FILLER]
    docs = spark.createDataFrame([(i, t, 0, 0, 0) for i, t in enumerate(texts)], "doc_id long, text string, hit_row int, hit_row_tokens int, hit_item int")

    def found(known):
        return [(r.matched_tokens, r.item_id) for r in sorted(contamination(docs, known).collect())]

    nothing = (0, None)
    assert found(items) == [(17, 2), (17, 1), (17, 2), nothing]
    assert found(items.where("item_id = 1")) == [nothing, (17, 1), nothing, nothing]
    assert found(items.where("item_id > 1")) == [(17, 2), nothing, (17, 2), nothing]
