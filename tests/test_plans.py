"""Physical plans of the core operators: what must not appear, and what must."""

import pytest
from pyspark.sql import functions as F

from queries import all_queries
from queries.registry import Tables
from tidelake.operators import cleaning
from tidelake.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


CORE = ["dedupe_last", "dedupe_fuzzy", "fill_forward", "fill_interpolate", "fill_median", "merge_upsert", "surrogate_keys", "product_rank",
        "consecutive_failures", "scd2_history", "scd2_apply", "scd2_lookup", "demand_grid", "fact_sales", "fact_inventory",
        "remove_outliers_iqr", "fc_croston", "fc_holt_winters", "group_three_cols", "density_noise", "abc_xyz"]


@pytest.mark.parametrize("name", CORE)
def test_no_single_partition_python_or_cross_join(spark, folder, name):
    text = plan(all_queries()[0][name](spark, folder))
    lines = text.splitlines()
    for above, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in above:  # only totals: of the whole table, or one row per block
            assert "Aggregate(keys=[], " in below or "Aggregate(keys=[__block" in below
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_dedupe_prunes_before_the_shuffle(spark, folder):
    text = plan(cleaning.deduplicate(Tables(spark, folder).lineitem, ["l_orderkey", "l_linenumber"], "last", ["l_shipdate"]))
    assert text.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark, folder):
    t = Tables(spark, folder)
    mark = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    text = plan(files.incremental(t.events, "ts", mark).select("event_id"))
    assert "GreaterThan(ts" in text and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    text = plan(cleaning.remove_outliers(t.events, "value").select("event_id"))
    assert "LessThanOrEqual(value" in text


def test_many_rules_are_one_aggregate(spark, folder):
    from tidelake.quality import rules as R
    t = Tables(spark, folder)
    rules = R.RuleSet("x", [R.not_null(c) for c in t.lineitem.columns] + [R.in_range("l_tax", i / 100, 1, name=str(i)) for i in range(20)])
    text = plan(rules.results(t.lineitem))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
