"""Passages of a benchmark item, at every alignment."""

import random

import pytest

from periodgrid.llm import decontaminate

SCHEMA = "doc_id long, text string"


def prose(rng, size):
    text = ""
    while len(text) < size:
        text += "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) + " "
    return text[:size - 1] + "x"


@pytest.mark.parametrize("size", [233, 401])
def test_a_passage_is_found_wherever_it_starts(spark, size):
    rng = random.Random(size)
    item = prose(rng, size)
    assert decontaminate.STRIDE <= decontaminate.budget(decontaminate.WINDOW)
    least = decontaminate.WINDOW
    cuts = [(at, at + least) for at in range(size - least + 1)] + [(15, 215), (0, 100), (size - 100, size)]
    docs = [(k, f"{prose(rng, 300)} {item[a:b]} {prose(rng, 300)}") for k, (a, b) in enumerate(cuts)] + [(-1, prose(rng, 900)), (-2, item[:30])]
    benchmark = spark.createDataFrame([(7, item), (8, prose(rng, 300))], "item_id long, text string")
    rows = decontaminate.contamination(spark.createDataFrame(docs, SCHEMA), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(k, 7) for k in range(len(cuts))}
    assert all(r.edits <= decontaminate.budget(least) for r in rows)
