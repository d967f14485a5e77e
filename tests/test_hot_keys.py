"""The ordered queries again, with nearly every key treated as hot."""

import pytest

from queries import all_queries
from tests.oracle import compare, connect
from tidelake.operators.split_window import SplitWindow

QUERIES, ORACLES = all_queries()
ORDERED = ["fill_forward", "fill_backward", "fill_interpolate", "product_rank", "consecutive_failures", "scd2_history", "scd2_late_changes"]


@pytest.mark.parametrize("name", ORDERED)
def test_same_result_when_keys_are_split(spark, folder, name):
    spark.conf.set("tidelake.window.hotRows", "40")
    try:
        assert compare(name, QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == ""
    finally:
        spark.conf.unset("tidelake.window.hotRows")


@pytest.mark.parametrize("name", ["product_rank", "scd2_history", "scd2_late_changes"])
def test_same_result_when_most_keys_are_split(spark, folder, name, monkeypatch):
    """With blocks of four rows most keys are cut, which forty rows do not do for these queries at this scale."""
    cut = []
    split = SplitWindow._split
    monkeypatch.setattr(SplitWindow, "_split", lambda self: cut.append(split(self)) or cut[-1])
    spark.conf.set("tidelake.window.hotRows", "4")
    try:
        assert compare(name, QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == ""
    finally:
        spark.conf.unset("tidelake.window.hotRows")
    assert any(rows is not None for rows in cut)
