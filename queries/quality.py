"""Validation rules, reports and gates."""

import datetime as dt

from pyspark.sql import functions as F

from queries.cleaning import GAPS_SQL, gaps
from queries.registry import query
from tidelake.quality import rules as R
from tidelake.quality.rules import RuleSet, Severity

COLUMNS = ["rule_name", "rule_type", "passed", "total_records", "valid_records", "invalid_records", "invalid_pct"]


def _rule(name, kind, invalid, source, cte="", passed=None):
    return f"""{cte} SELECT '{name}' AS rule_name, '{kind}' AS rule_type, {passed or 'i = 0'} AS passed,
      n AS total_records, n - i AS valid_records, i AS invalid_records, round(i * 100.0 / n, 6) AS invalid_pct
      FROM (SELECT count(*) AS n, CAST({invalid} AS BIGINT) AS i FROM {source})"""


def _shown(results):
    return results.select(*COLUMNS).withColumn("invalid_pct", F.round("invalid_pct", 6))


@query("rule_not_null", _rule("quantity_not_null", "not_null", "count(*) - count(quantity)", "gaps", GAPS_SQL))
def rule_not_null(t):
    return _shown(RuleSet("lines", [R.not_null("quantity")]).results(gaps(t)))


@query("rule_unique", _rule("l_orderkey_l_linenumber_unique", "unique",
                            "count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))",
                            "lineitem"))
def rule_unique(t):
    return _shown(RuleSet("lines", [R.unique("l_orderkey", "l_linenumber")]).results(t.lineitem))


@query("rule_range", _rule("quantity_range", "range", "count(*) FILTER (quantity < 5 OR quantity > 45)", "gaps", GAPS_SQL))
def rule_range(t):
    return _shown(RuleSet("lines", [R.in_range("quantity", 5, 45)]).results(gaps(t)))


@query("rule_pattern", _rule("flag_pattern", "pattern", "count(*) - count(*) FILTER (regexp_matches(flag, '^[AN]$'))",
                             "gaps", GAPS_SQL))
def rule_pattern(t):
    return _shown(RuleSet("lines", [R.matches("flag", "^[AN]$")]).results(gaps(t)))


@query("rule_allowed_values", _rule("flag_allowed", "allowed_values", "count(*) FILTER (flag NOT IN ('A', 'R'))", "gaps",
                                    GAPS_SQL))
def rule_allowed_values(t):
    return _shown(RuleSet("lines", [R.allowed("flag", ["A", "R"])]).results(gaps(t)))


@query("rule_samples", GAPS_SQL + """
SELECT 'flag_allowed' AS rule_name, flag AS sample_invalid FROM (SELECT DISTINCT flag FROM gaps WHERE flag NOT IN ('A', 'R'))
UNION ALL SELECT 'quantity_range', CAST(quantity AS VARCHAR) FROM
  (SELECT DISTINCT quantity FROM gaps WHERE quantity > 40 ORDER BY quantity LIMIT 5)""")
def rule_samples(t):
    return RuleSet("lines", [R.allowed("flag", ["A", "R"]), R.in_range("quantity", None, 40)]).samples(gaps(t))


@query("rule_results_with_samples", GAPS_SQL + """, n AS (SELECT count(*) AS n FROM gaps),
r(rule_name, i, samples) AS (
  SELECT 'flag_allowed', count(*) FILTER (flag NOT IN ('A', 'R')), (SELECT string_agg(flag, '|' ORDER BY flag) FROM (SELECT DISTINCT flag FROM gaps WHERE flag NOT IN ('A', 'R'))) FROM gaps
  UNION ALL SELECT 'quantity_range', count(*) FILTER (quantity > 40), (SELECT string_agg(CAST(quantity AS VARCHAR), '|' ORDER BY quantity) FROM
    (SELECT DISTINCT quantity FROM gaps WHERE quantity > 40 ORDER BY quantity LIMIT 3)) FROM gaps
  UNION ALL SELECT 'l_orderkey_range', count(*) FILTER (l_orderkey < 5 OR l_orderkey > 900), (SELECT string_agg(CAST(l_orderkey AS VARCHAR), '|' ORDER BY l_orderkey) FROM
    (SELECT DISTINCT l_orderkey FROM gaps WHERE l_orderkey < 5 OR l_orderkey > 900 ORDER BY l_orderkey LIMIT 3)) FROM gaps
  UNION ALL SELECT 'quantity_not_null', count(*) - count(quantity), '' FROM gaps)
SELECT rule_name, n AS total_records, i AS invalid_records, coalesce(samples, '') AS sample_invalid FROM r, n""")
def rule_results_with_samples(t):
    """Four rules with their lowest offending values; one scan counts, one finds the samples of all rules."""
    rules = RuleSet("lines", [R.allowed("flag", ["A", "R"]), R.in_range("quantity", None, 40), R.in_range("l_orderkey", 5, 900), R.not_null("quantity")])
    out = rules.results_with_samples(gaps(t), 3)
    return out.select("rule_name", "total_records", "invalid_records", F.array_join("sample_invalid", "|").alias("sample_invalid"))


@query("rule_referential", _rule("l_partkey_in_parts", "referential",
                                 "count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45))", "lineitem"))
def rule_referential(t):
    rules = RuleSet("lines", [R.references("l_partkey", "parts")])
    return _shown(rules.reference("parts", t.part.filter("p_size <= 45"), "p_partkey").results(t.lineitem))


@query("rule_completeness", GAPS_SQL + """, c AS (SELECT count(*) AS n,
  (count(quantity) + count(flag) + count(tax)) / (3.0 * count(*)) AS ratio FROM gaps)
SELECT 'completeness' AS rule_name, 'completeness' AS rule_type, ratio >= 0.95 AS passed, n AS total_records,
  CAST(floor(ratio * n) AS BIGINT) AS valid_records, n - CAST(floor(ratio * n) AS BIGINT) AS invalid_records,
  round((n - floor(ratio * n)) * 100.0 / n, 6) AS invalid_pct FROM c""")
def rule_completeness(t):
    return _shown(RuleSet("lines", [R.complete()]).results(gaps(t).select("quantity", "flag", "tax")))


@query("rule_custom", _rule("price_plausible", "custom", "count(*) FILTER (NOT l_extendedprice >= l_quantity * 900)", "lineitem"))
def rule_custom(t):
    check = R.custom("price_plausible", lambda df: F.col("l_extendedprice") >= F.col("l_quantity") * 900)
    return _shown(RuleSet("lines", [check]).results(t.lineitem))


@query("rule_cross_field", _rule("ship_after_order", "custom", "count(*) FILTER (NOT l_shipdate >= o_orderdate)",
                                 "lineitem JOIN orders ON l_orderkey = o_orderkey"))
def rule_cross_field(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return _shown(RuleSet("lines", [R.custom("ship_after_order", "l_shipdate >= o_orderdate")]).results(joined))


@query("rule_freshness", _rule("ts_fresh", "freshness",
                               "CASE WHEN max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 4 HOUR THEN count(*) ELSE 0 END", "events"))
def rule_freshness(t):
    return _shown(RuleSet("events", [R.fresh("ts", dt.datetime(2024, 1, 31))]).results(t.events))


def _all_rules(t):
    rules = RuleSet("lines").add(
        R.not_null("quantity"), R.unique("l_orderkey", "l_linenumber"), R.in_range("quantity", 5, 45),
        R.matches("flag", "^[AN]$", Severity.WARNING), R.allowed("flag", ["A", "R"], Severity.INFO),
        R.references("l_partkey", "parts"), R.custom("price_positive", "l_extendedprice > 0", Severity.CRITICAL))
    return rules.reference("parts", t.part.filter("p_size <= 45"), "p_partkey")


ALL_SQL = GAPS_SQL + """, n AS (SELECT count(*) AS n FROM gaps),
r(rule_name, severity, weight, i) AS (
  SELECT 'quantity_not_null', 'critical', 10, count(*) - count(quantity) FROM gaps
  UNION ALL SELECT 'l_orderkey_l_linenumber_unique', 'error', 5, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM gaps)) FROM gaps
  UNION ALL SELECT 'quantity_range', 'error', 5, count(*) FILTER (quantity < 5 OR quantity > 45) FROM gaps
  UNION ALL SELECT 'flag_pattern', 'warning', 2, count(*) - count(*) FILTER (regexp_matches(flag, '^[AN]$')) FROM gaps
  UNION ALL SELECT 'flag_allowed', 'info', 1, count(*) FILTER (flag NOT IN ('A', 'R')) FROM gaps
  UNION ALL SELECT 'l_partkey_in_parts', 'error', 5, count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)) FROM gaps
  UNION ALL SELECT 'price_positive', 'critical', 10, count(*) FILTER (NOT l_extendedprice > 0) FROM gaps)
"""


@query("validation_results", ALL_SQL + """
SELECT rule_name, severity, i = 0 AS passed, i AS invalid_records, n - i AS valid_records FROM r, n""")
def validation_results(t):
    return _all_rules(t).results(gaps(t)).select("rule_name", "severity", "passed", "invalid_records", "valid_records")


@query("validation_report", ALL_SQL + """
SELECT count(*) AS total_rules, count(*) FILTER (i = 0) AS passed_rules, count(*) FILTER (i > 0) AS failed_rules,
  count(*) FILTER (i > 0 AND severity = 'critical') AS critical_failures,
  count(*) FILTER (i > 0 AND severity = 'error') AS error_failures,
  count(*) FILTER (i > 0 AND severity = 'warning') AS warning_failures,
  round(sum(weight * (n - i) / n) / sum(weight), 6) AS quality_score FROM r, n""")
def validation_report(t):
    return R.report(_all_rules(t).results(gaps(t))).withColumn("quality_score", F.round("quality_score", 6))


@query("quality_score", ALL_SQL + "SELECT round(sum(weight * (n - i) / n) / sum(weight), 6) AS quality_score FROM r, n")
def quality_score(t):
    return R.report(_all_rules(t).results(gaps(t))).select(F.round("quality_score", 6).alias("quality_score"))


@query("quick_validate", """
SELECT 'o_orderkey_not_null' AS rule_name, true AS passed, 0::BIGINT AS invalid_records
UNION ALL SELECT 'o_custkey_unique', false, (SELECT count(*) - count(DISTINCT o_custkey) FROM orders)
UNION ALL SELECT 'o_totalprice_positive', (SELECT count(*) FILTER (o_totalprice < 0) = 0 FROM orders),
  (SELECT count(*) FILTER (o_totalprice < 0) FROM orders)""")
def quick_validate(t):
    return R.quick_validate(t.orders, ["o_orderkey"], ["o_custkey"], ["o_totalprice"]).select(
        "rule_name", "passed", "invalid_records")


@query("quality_gate", ALL_SQL + """
SELECT CASE WHEN count(*) FILTER (i > 0 AND severity IN ('critical', 'error')) > 0 THEN 'quarantine' WHEN count(*) FILTER (i > 0) > 0 THEN 'warn' ELSE 'pass' END AS decision,
  count(*) FILTER (i > 0) AS failed_rules FROM r, n""")
def quality_gate(t):
    """The decision of a gate that does not raise, and what it rests on."""
    results = _all_rules(t).results(gaps(t))
    decision = R.gate(results, fail_on_critical=False)
    return R.report(results).select(F.lit(decision).alias("decision"), "failed_rules")


@query("component_quality_score", ALL_SQL + """, v AS (SELECT rule_name, (n - i) / n AS s FROM r, n)
SELECT round(avg(s) FILTER (rule_name = 'quantity_not_null'), 6) AS completeness,
  round(avg(s) FILTER (rule_name IN ('quantity_range', 'flag_pattern', 'flag_allowed')), 6) AS validity,
  round(avg(s) FILTER (rule_name LIKE '%_unique'), 6) AS uniqueness,
  round(avg(s) FILTER (rule_name IN ('l_partkey_in_parts', 'price_positive')), 6) AS consistency,
  round(30 * avg(s) FILTER (rule_name = 'quantity_not_null')
    + 30 * avg(s) FILTER (rule_name IN ('quantity_range', 'flag_pattern', 'flag_allowed'))
    + 20 * avg(s) FILTER (rule_name LIKE '%_unique')
    + 20 * avg(s) FILTER (rule_name IN ('l_partkey_in_parts', 'price_positive')), 6) AS score FROM v""")
def component_quality_score(t):
    out = R.component_score(_all_rules(t).results(gaps(t)))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


CONFIG = {"table": "lines", "not_null": ["l_orderkey", "quantity"], "positive": ["l_extendedprice"],
          "unique": [["l_orderkey", "l_linenumber"]], "range": {"tax": [0.0, 0.06]}, "allowed_values": {"flag": ["A", "N", "R"]},
          "referential": {"l_suppkey": "suppliers"}, "sql": {"tax_or_flag": "tax IS NOT NULL OR flag IS NOT NULL"}}


@query("rules_from_config", GAPS_SQL + """
SELECT 'l_orderkey_not_null' AS rule_name, 0::BIGINT AS invalid_records
UNION ALL SELECT 'quantity_not_null', count(*) - count(quantity) FROM gaps
UNION ALL SELECT 'l_extendedprice_positive', count(*) FILTER (l_extendedprice < 0) FROM gaps
UNION ALL SELECT 'l_orderkey_l_linenumber_unique', count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM gaps)) FROM gaps
UNION ALL SELECT 'tax_range', count(*) FILTER (tax > 0.06) FROM gaps
UNION ALL SELECT 'flag_allowed', count(*) FILTER (flag NOT IN ('A', 'N', 'R')) FROM gaps
UNION ALL SELECT 'l_suppkey_in_suppliers', 0
UNION ALL SELECT 'tax_or_flag', count(*) FILTER (tax IS NULL AND flag IS NULL) FROM gaps""")
def rules_from_config(t):
    rules = RuleSet.from_config(CONFIG).reference("suppliers", t.supplier, "s_suppkey")
    return rules.results(gaps(t)).select("rule_name", "invalid_records")


@query("rule_quarantine", GAPS_SQL + """
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN flag IS NULL OR NOT regexp_matches(flag, '^[AN]$') THEN 'flag_pattern' END,
  CASE WHEN quantity IS NULL THEN 'quantity_not_null' END, CASE WHEN quantity > 45 THEN 'quantity_range' END) AS failed_rules
FROM gaps WHERE quantity IS NULL OR quantity > 45 OR flag IS NULL OR NOT regexp_matches(flag, '^[AN]$')""")
def rule_quarantine(t):
    rules = RuleSet("lines", [R.not_null("quantity"), R.in_range("quantity", None, 45), R.matches("flag", "^[AN]$")])
    _, bad = rules.split(gaps(t))
    return bad.select("l_orderkey", "l_linenumber", F.concat_ws(",", "failed_rules").alias("failed_rules"))
