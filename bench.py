"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Every query runs to completion into the ``noop`` sink: one untimed warm-up of the session, then one cold and
``BENCH_RUNS`` warm runs each. ``queries`` holds the best warm time, ``cold`` the first one.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from queries import all_queries
from queries.registry import Tables
from tidelake.operators.cleaning import Cleaner
from tidelake.quality import rules as R
from tidelake.quality.anomalies import AnomalyScan
from tidelake.quality.rules import RuleSet
from tidelake.session import build_session


def filter_select(t: Tables):
    return t.lineitem.filter("l_quantity > 30 AND l_discount < 0.05").select("l_orderkey", "l_extendedprice")


def string_operations(t: Tables):
    text = t.orders.select("o_orderkey", F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit("! ")).alias("a"),
                           F.concat(F.lit(" "), "o_orderstatus", F.lit("# ")).alias("b"))
    return Cleaner(text).standardize(["a", "b"], remove_special=True).clean()


def ten_rules(t: Tables):
    rules = RuleSet("lines").add(
        R.not_null("l_orderkey"), R.not_null("l_partkey"), R.in_range("l_quantity", 1, 50), R.in_range("l_discount", 0, 0.1),
        R.in_range("l_tax", 0, 0.08), R.allowed("l_returnflag", ["A", "N", "R"]), R.matches("l_linestatus", "^[OF]$"),
        R.custom("positive_price", "l_extendedprice > 0"), R.references("l_suppkey", "suppliers"),
        R.unique("l_orderkey", "l_linenumber"))
    return rules.reference("suppliers", t.supplier, "s_suppkey").results(t.lineitem)


def fifty_rules(t: Tables):
    rules = RuleSet("lines")
    for c in t.lineitem.columns:
        rules.add(R.not_null(c))
    for i in range(13):
        rules.add(R.in_range("l_quantity", i, 50 - i, name=f"quantity_{i}"),
                  R.in_range("l_discount", i / 200, 0.1, name=f"discount_{i}"),
                  R.custom(f"price_{i}", f"l_extendedprice > {i * 100}"))
    return rules.results(t.lineitem)


def anomaly_28_checks(t: Tables):
    border = F.lit("1998-04-15").cast("timestamp_ntz")
    now, was = t.lineitem.filter(F.col("l_shipdate") >= border), t.lineitem.filter(F.col("l_shipdate") < border)
    numbers = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    scan = AnomalyScan("lines").require(*t.lineitem.columns).non_negative(*numbers)  # 11 + 4
    for c in numbers:  # 8
        scan.iqr(c).zscore(c)
    for c in numbers[:2]:  # 4
        scan.spike(c).drop(c)
    return scan.volume(1, 10**12).findings(now, was)  # 1


EXTRA = {"filter_select": filter_select, "string_operations": string_operations, "rules_10": ten_rules,
         "rules_50": fifty_rules, "anomaly_28_checks": anomaly_28_checks}
HEADLINE = ("stock_value_top", "group_three_cols", "star_join_agg", "complex_three_joins", "product_rank",
            "daily_category_sales", "group_having", "fact_sales", "silver_transform", "dedupe_last", "merge_upsert",
            "scd2_history", "demand_pattern", "gold_write")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    started = time.time()
    spark = build_session("tidelake-bench", f"local[{cpus}]", {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, folder)
    t.lineitem.count()
    startup = time.time() - started
    registered = all_queries()[0]
    runs = {n: (lambda n=n: registered[n](spark, folder)) for n in HEADLINE}
    runs.update({n: (lambda fn=fn: fn(t)) for n, fn in EXTRA.items()})
    only = os.environ.get("BENCH_ONLY", "").split(",") if os.environ.get("BENCH_ONLY") else list(runs)
    cold, warm = {}, {}
    for name in only:
        times = []
        for _ in range(1 + int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.time()
            runs[name]().write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:]), 3)
    lines = t.lineitem.count()
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold": cold, "startup": round(startup, 3), "lineitem_rows": lines,
                      "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
