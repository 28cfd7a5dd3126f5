"""Test items under ids of any type."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerloom.llm import decontaminate


@pytest.mark.parametrize("kind, one, two", [
    ("smallint", 1, 2), ("string", "a", "b"), ("date", dt.date(2024, 1, 1), dt.date(2024, 1, 2)), ("decimal(5,1)", Decimal("1.5"), Decimal("2.5")), ("bigint", 1, 2),
])
def test_leaks_keep_the_type_of_the_item_id(spark, kind, one, two):
    item = "which of the seven rivers of the north runs through the old town. the long river of the grey stones does so"
    items = spark.createDataFrame([(one, item), (two, "another question that no text of this test holds at all. and its answer")], f"item_id {kind}, text string")
    docs = spark.createDataFrame([(1, f"before it {item} and after it"), (2, "nothing of the sort")], "doc_id long, text string")
    found = decontaminate.find_leaks(docs, items)
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, one)] and found.schema["item_id"].dataType.simpleString() == kind
