"""Demand patterns, forecasts, backtests, stock parameters."""

import datetime as dt

from pyspark.sql import functions as F

from queries.registry import query
from tidelake.operators.series import daily_totals, filled_series, zero_filled
from tidelake.plans import demand as M
from tidelake.session import materialise

GRID_SQL = """
WITH RECURSIVE daily AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS demand FROM lineitem GROUP BY 1, 2),
days AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM daily),
grid AS (SELECT k.l_suppkey, days.day, coalesce(d.demand, 0) AS demand FROM (SELECT DISTINCT l_suppkey FROM daily) k
  CROSS JOIN days LEFT JOIN daily d ON d.l_suppkey = k.l_suppkey AND d.day = days.day)
"""
KEYS = ["l_suppkey"]


def daily(t):
    return daily_totals(t.lineitem, KEYS, "l_shipdate", "l_quantity", "demand")


def days_seen(t):
    return t.lineitem.select(*KEYS, F.to_date("l_shipdate").alias("day"))


def grid(t):
    return zero_filled(daily(t), KEYS, "demand", rows=days_seen(t))


def all_series(t):
    return filled_series(daily(t), KEYS, "demand", rows=days_seen(t))


@query("demand_pattern", GRID_SQL + """, s AS (SELECT l_suppkey, count(*) AS n, count(*) FILTER (demand > 0) AS nz,
  avg(demand) FILTER (demand > 0) AS m, stddev_samp(demand) FILTER (demand > 0) AS sd FROM grid GROUP BY 1),
c AS (SELECT l_suppkey, n, nz, n / nullif(nz, 0) AS adi, power(sd / nullif(m, 0), 2) AS cv2 FROM s)
SELECT l_suppkey, n AS periods, nz AS nonzero, round(adi, 6) AS adi, round(cv2, 6) AS cv2, CASE WHEN nz = 0 THEN 'lumpy'
  WHEN adi < 1.32 AND NOT coalesce(cv2 >= 0.49, false) THEN 'smooth' WHEN adi < 1.32 THEN 'erratic'
  WHEN NOT coalesce(cv2 >= 0.49, false) THEN 'intermittent' ELSE 'lumpy' END AS pattern FROM c""")
def demand_pattern(t):
    out = M.demand_pattern(grid(t), KEYS, "demand")
    return out.withColumns({"adi": F.round("adi", 6), "cv2": F.round("cv2", 6)})


def _fold_sql(start, step, value):
    """A smoothing recursion over every series, one day per level."""
    return GRID_SQL + f""", n AS (SELECT l_suppkey, CAST(demand AS DOUBLE) AS x, row_number() OVER (PARTITION BY l_suppkey ORDER BY day) AS i FROM grid),
r AS ({start} UNION ALL {step}) SELECT l_suppkey, round({value}, 6) AS forecast FROM r
WHERE i = (SELECT max(i) FROM n)"""


def _forecast(t, method):
    out = M.forecast(all_series(t), KEYS, [method])
    return out.select("l_suppkey", F.round(method, 6).alias("forecast"))


SES_START = "SELECT l_suppkey, i, x AS l FROM n WHERE i = 1"
SES_STEP = "SELECT n.l_suppkey, n.i, 0.3 * n.x + 0.7 * r.l FROM r JOIN n ON n.l_suppkey = r.l_suppkey AND n.i = r.i + 1"


@query("fc_ses", _fold_sql(SES_START, SES_STEP, "l"))
def fc_ses(t):
    return _forecast(t, "ses")


CROSTON_START = "SELECT l_suppkey, i, CASE WHEN x > 0 THEN x END AS z, CASE WHEN x > 0 THEN 1.0::DOUBLE END AS p, CASE WHEN x > 0 THEN 1.0 ELSE 2.0 END::DOUBLE AS q FROM n WHERE i = 1"
CROSTON_STEP = """SELECT n.l_suppkey, n.i, CASE WHEN n.x > 0 THEN CASE WHEN r.z IS NULL THEN n.x ELSE 0.1 * n.x + 0.9 * r.z END ELSE r.z END,
  CASE WHEN n.x > 0 THEN CASE WHEN r.z IS NULL THEN r.q ELSE 0.1 * r.q + 0.9 * r.p END ELSE r.p END,
  CASE WHEN n.x > 0 THEN 1.0 ELSE r.q + 1.0 END FROM r JOIN n ON n.l_suppkey = r.l_suppkey AND n.i = r.i + 1"""


@query("fc_croston", _fold_sql(CROSTON_START, CROSTON_STEP, "coalesce(z / p, 0)"))
def fc_croston(t):
    return _forecast(t, "croston")


@query("fc_sba", _fold_sql(CROSTON_START, CROSTON_STEP, "coalesce(z / p, 0) * 0.95"))
def fc_sba(t):
    return _forecast(t, "sba")


TSB_START = "SELECT l_suppkey, i, CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS p, CASE WHEN x > 0 THEN x END AS z FROM n WHERE i = 1"
TSB_STEP = """SELECT n.l_suppkey, n.i, r.p + 0.1 * (CASE WHEN n.x > 0 THEN 1.0 ELSE 0.0 END - r.p),
  CASE WHEN n.x > 0 THEN CASE WHEN r.z IS NULL THEN n.x ELSE r.z + 0.1 * (n.x - r.z) END ELSE r.z END
  FROM r JOIN n ON n.l_suppkey = r.l_suppkey AND n.i = r.i + 1"""


@query("fc_tsb", _fold_sql(TSB_START, TSB_STEP, "coalesce(p * z, 0)"))
def fc_tsb(t):
    return _forecast(t, "tsb")


HW_START = """SELECT m.l_suppkey, 7::BIGINT AS i, m.m1 AS l, (m.m2 - m.m1) / 7 AS b, m.xs[1] - m.m1 AS s1, m.xs[2] - m.m1 AS s2, m.xs[3] - m.m1 AS s3,
  m.xs[4] - m.m1 AS s4, m.xs[5] - m.m1 AS s5, m.xs[6] - m.m1 AS s6, m.xs[7] - m.m1 AS s7 FROM
  (SELECT l_suppkey, avg(x) FILTER (i <= 7) AS m1, avg(x) FILTER (i BETWEEN 8 AND 14) AS m2, list(x ORDER BY i) FILTER (i <= 7) AS xs FROM n GROUP BY 1) m"""
HW_STEP = """SELECT u.l_suppkey, u.ni, u.nl, 0.05 * (u.nl - u.l) + 0.95 * u.b, u.s2, u.s3, u.s4, u.s5, u.s6, u.s7, 0.1 * (u.x - u.nl) + 0.9 * u.s1 FROM
  (SELECT r.*, n.x, n.i AS ni, 0.2 * (n.x - r.s1) + 0.8 * (r.l + r.b) AS nl FROM r JOIN n ON n.l_suppkey = r.l_suppkey AND n.i = r.i + 1) u"""


@query("fc_holt_winters", _fold_sql(HW_START, HW_STEP, "l + b + s1"))
def fc_holt_winters(t):
    return _forecast(t, "holt_winters")


@query("fc_moving_average", GRID_SQL + """
SELECT l_suppkey, round(avg(demand), 6) AS forecast FROM grid WHERE day > (SELECT max(day) FROM grid) - INTERVAL 28 DAY GROUP BY 1""")
def fc_moving_average(t):
    return _forecast(t, "moving_average")


def dated_series(t):
    return filled_series(daily(t), KEYS, "demand", rows=days_seen(t), first="start")


@query("fc_tree_model")
def fc_tree_model(t):
    features = M.lag_features(materialise(dated_series(t), "series"), KEYS)
    return M.tree_forecast(features, KEYS, F.lit(dt.date(2001, 7, 1)))


@query("fc_gbt_model")
def fc_gbt_model(t):
    return M.tree_forecast(M.lag_features(materialise(dated_series(t), "series"), KEYS), KEYS, F.lit(dt.date(2001, 7, 1)), "gbt")


@query("fc_lag_features", GRID_SQL + """, f AS (SELECT l_suppkey, day, CAST(demand AS DOUBLE) AS label, CAST(dayofweek(day) + 1 AS DOUBLE) AS weekday,
  CAST(month(day) AS DOUBLE) AS month, round(avg(demand) OVER (PARTITION BY l_suppkey ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS mean_7,
  CAST(lag(demand, 1) OVER w AS DOUBLE) AS lag_1, CAST(lag(demand, 7) OVER w AS DOUBLE) AS lag_7, CAST(lag(demand, 14) OVER w AS DOUBLE) AS lag_14
  FROM grid WINDOW w AS (PARTITION BY l_suppkey ORDER BY day)) SELECT * FROM f WHERE lag_14 IS NOT NULL""")
def fc_lag_features(t):
    return M.lag_features(dated_series(t), KEYS).withColumn("mean_7", F.round("mean_7", 6))


# Every smoothing method at every day: the state a day leaves is the forecast of a cut-off behind it.
STATES_SQL = GRID_SQL + f""", n AS (SELECT l_suppkey, CAST(demand AS DOUBLE) AS x, row_number() OVER (PARTITION BY l_suppkey ORDER BY day) AS i FROM grid),
ses AS ({SES_START} UNION ALL {SES_STEP.replace('FROM r', 'FROM ses r')}),
cro AS ({CROSTON_START} UNION ALL {CROSTON_STEP.replace('FROM r', 'FROM cro r')}),
tsb AS ({TSB_START} UNION ALL {TSB_STEP.replace('FROM r', 'FROM tsb r')}),
hw AS ({HW_START} UNION ALL {HW_STEP.replace('FROM r', 'FROM hw r')}),
f AS (SELECT l_suppkey, i, 'ses' AS method, l AS forecast FROM ses
  UNION ALL SELECT l_suppkey, i, 'croston', coalesce(z / p, 0) FROM cro UNION ALL SELECT l_suppkey, i, 'sba', coalesce(z / p, 0) * 0.95 FROM cro
  UNION ALL SELECT l_suppkey, i, 'tsb', coalesce(p * z, 0) FROM tsb UNION ALL SELECT l_suppkey, i, 'holt_winters', l + b + s1 FROM hw
  UNION ALL SELECT l_suppkey, i, 'moving_average', avg(x) OVER (PARTITION BY l_suppkey ORDER BY i ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) FROM n),
size AS (SELECT max(i) AS m FROM n)"""


@query("backtest_scores", STATES_SQL + """, c AS (SELECT l_suppkey, fold, avg(x) AS actual FROM n, size, (SELECT unnest([1, 2, 3]) AS fold)
  WHERE i > m - fold * 30 AND i <= m - fold * 30 + 30 GROUP BY 1, 2)
SELECT f.l_suppkey, method, round(avg(abs(forecast - actual)), 6) AS mae, count(forecast) AS folds FROM f, size, c
WHERE f.l_suppkey = c.l_suppkey AND f.i = m - fold * 30 GROUP BY 1, 2""")
def backtest_scores(t):
    out = M.backtest_scores(all_series(t), KEYS, 30, 3, M.SMOOTHING)
    return out.withColumn("mae", F.round("mae", 6))


@query("conformal_coverage", STATES_SQL + """, e AS (SELECT f.l_suppkey, method, fold, n.i - (m - fold * 30) AS step, abs(x - forecast) AS error
  FROM f, size, (SELECT unnest(range(1, 21)) AS fold), n WHERE f.i = m - fold * 30 AND n.l_suppkey = f.l_suppkey AND n.i > m - fold * 30 AND n.i <= m - fold * 30 + 30),
q AS (SELECT l_suppkey, method, step, quantile_cont(error, 17.0 / 18) AS radius FROM e WHERE fold > 1 GROUP BY ALL)
SELECT method, count(*) AS days, count(*) FILTER (error <= radius + 1e-9) AS covered FROM e JOIN q USING (l_suppkey, method, step) WHERE fold = 1 GROUP BY 1""")
def conformal_coverage(t):
    """How many of the last 30 days lie inside the intervals of each method, learned from the 19 cut-offs before."""
    return M.conformal_coverage(all_series(t), KEYS)


@query("conformal_intervals", STATES_SQL + """, e AS (SELECT f.l_suppkey, method, fold, n.i - (m - fold * 30) AS step, abs(x - forecast) AS error
  FROM f, size, (SELECT unnest(range(1, 20)) AS fold), n WHERE f.i = m - fold * 30 AND n.l_suppkey = f.l_suppkey AND n.i > m - fold * 30 AND n.i <= m - fold * 30 + 30),
q AS (SELECT l_suppkey, method, step::INTEGER AS step, quantile_cont(error, 17.0 / 18) AS radius FROM e GROUP BY ALL)
SELECT l_suppkey, method, step, round(forecast, 4) AS forecast, round(greatest(forecast - radius, 0), 4) AS lower, round(forecast + radius, 4) AS upper
FROM f JOIN size ON i = m JOIN q USING (l_suppkey, method)""")
def conformal_intervals(t):
    """30 days ahead with six methods, each with intervals from its own past errors."""
    out = M.conformal_intervals(all_series(t), KEYS)
    return out.withColumns({c: F.round(c, 4) for c in ("forecast", "lower", "upper")})


DRAW_SQL = "(((({z}) % 2147483647 * 48271 + 1) % 2147483647 * 16807 + 1) % 2147483647 * 69621 + 1) % 2147483647"
DRAW_ON, DRAW_SIZE = (DRAW_SQL.format(z=f"l_suppkey * 7919 + rep * 104729 + (step + 1) * 1299709 + {salt}") for salt in (0, 1))


@query("lead_time_demand", GRID_SQL + f""", n AS (SELECT l_suppkey, CAST(demand AS DOUBLE) AS x, row_number() OVER (PARTITION BY l_suppkey ORDER BY day) AS i FROM grid),
w AS (SELECT l_suppkey, i, x > 0 AS now, lag(x > 0) OVER (PARTITION BY l_suppkey ORDER BY i) AS was, x FROM n),
p AS (SELECT l_suppkey, coalesce(count(*) FILTER (NOT was AND now) / nullif(count(*) FILTER (NOT was), 0), 0) AS off,
  coalesce(count(*) FILTER (was AND now) / nullif(count(*) FILTER (was), 0), 0) AS act, list(x ORDER BY i) FILTER (now) AS sizes, last(now ORDER BY i) AS at_end FROM w GROUP BY 1),
b AS (SELECT l_suppkey, rep, 0::BIGINT AS step, at_end AS act_now, 0.0::DOUBLE AS total FROM p, (SELECT unnest(range(1, 101)) AS rep)
  UNION ALL SELECT l_suppkey, rep, step + 1, hit, total + CASE WHEN hit THEN size ELSE 0 END FROM (
    SELECT b.l_suppkey, rep, step, total, {DRAW_ON} / 2147483647.0 < CASE WHEN act_now THEN act ELSE off END AS hit, sizes[{DRAW_SIZE} % len(sizes) + 1] AS size
    FROM b JOIN p ON b.l_suppkey = p.l_suppkey WHERE step < 14)),
s AS (SELECT l_suppkey, list_sort(list(total)) AS t FROM b WHERE step = 14 GROUP BY 1)
SELECT l_suppkey, round(list_sum(t) / 100, 6) AS mean_demand, t[90] AS cover_90, t[95] AS cover_95, t[99] AS cover_99 FROM s""".replace("l_suppkey * 7919", "b.l_suppkey * 7919"))
def lead_time_demand(t):
    """Demand over 14 days in 100 futures drawn from each supplier's own pattern, and what covers 90, 95 and 99 percent of them."""
    out = M.lead_time_demand(all_series(t), KEYS, F.col("l_suppkey"), 14, (0.90, 0.95, 0.99))
    return out.withColumn("mean_demand", F.round("mean_demand", 6))


@query("model_selection")
def model_selection(t):
    """The best method of each series among those that suit its pattern, bootstrap and forest included. Only those are run on it."""
    days = grid(t)
    patterns = materialise(M.demand_pattern(days, KEYS, "demand"), "patterns")
    series = all_series(t).join(patterns, KEYS)
    scores = M.backtest_scores(series, KEYS, 30, 3, wanted=M.shortlist(F.col("pattern"))).unionByName(M.tree_backtest(days, KEYS, "demand", 30, 3))
    return M.model_selection(scores, patterns, KEYS)


@query("forecast_interval", _fold_sql(
    "SELECT l_suppkey, i, x AS l, 0.0::DOUBLE AS sq FROM n WHERE i = 1",
    "SELECT n.l_suppkey, n.i, r.l + 0.3 * (n.x - r.l), r.sq + (n.x - r.l) * (n.x - r.l) FROM r JOIN n ON n.l_suppkey = r.l_suppkey AND n.i = r.i + 1", "l")
    .replace("SELECT l_suppkey, round(l, 6) AS forecast FROM r\nWHERE i = (SELECT max(i) FROM n)", """
SELECT l_suppkey, CAST(h AS INTEGER) AS step, round(l, 4) AS forecast, round(greatest(l - 1.6449 * sqrt(sq / (i - 1)) * sqrt(h), 0), 4) AS lower,
  round(l + 1.6449 * sqrt(sq / (i - 1)) * sqrt(h), 4) AS upper FROM r, (SELECT unnest(generate_series(1, 30)) AS h) WHERE i = (SELECT max(i) FROM n)"""))
def forecast_interval(t):
    out = M.forecast_interval(all_series(t), KEYS)
    return out.withColumns({c: F.round(c, 4) for c in ("forecast", "lower", "upper")})


@query("replenishment", GRID_SQL + """, s AS (SELECT l_suppkey, avg(demand) AS d, stddev_samp(demand) AS sd FROM grid GROUP BY 1)
SELECT l_suppkey, round(d, 6) AS daily_demand, round(sd, 6) AS demand_std, round(1.6449 * sd * sqrt(14), 6) AS safety_stock,
  round(d * 14 + 1.6449 * sd * sqrt(14), 6) AS reorder_point, round(sqrt(2.0 * d * 365 * 50 / 2), 6) AS eoq FROM s""")
def replenishment(t):
    out = M.replenishment(grid(t), KEYS, "demand", 14)
    return out.select("l_suppkey", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("abc_xyz", """
WITH m AS (SELECT l_partkey, date_trunc('month', l_shipdate) AS mo, sum(l_quantity) AS q, sum(l_extendedprice) AS rev FROM lineitem GROUP BY 1, 2),
i AS (SELECT l_partkey, sum(rev) AS revenue, stddev_samp(q) / nullif(avg(q), 0) AS cv FROM m GROUP BY 1),
c AS (SELECT *, sum(round(revenue, 2)) OVER (ORDER BY round(revenue, 2) DESC, l_partkey) / (SELECT sum(round(revenue, 2)) FROM i) AS share FROM i)
SELECT l_partkey, round(revenue, 2) AS revenue, round(share, 6) AS revenue_share, round(cv, 6) AS cv, CASE WHEN share <= 0.8 THEN 'A' WHEN share <= 0.95 THEN 'B' ELSE 'C' END
  AS abc_class, CASE WHEN cv <= 0.5 THEN 'X' WHEN cv <= 1.0 THEN 'Y' ELSE 'Z' END AS xyz_class FROM c""")
def abc_xyz(t):
    monthly = t.lineitem.groupBy("l_partkey", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m")).agg(
        F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("rev"))
    items = monthly.groupBy("l_partkey").agg(F.round(F.sum("rev"), 2).alias("revenue"),
                                             (F.stddev_samp("q") / F.nullif(F.avg("q"), F.lit(0.0))).alias("cv"))
    out = M.abc_xyz(items, "l_partkey", "revenue", "cv")
    return out.withColumns({"revenue_share": F.round("revenue_share", 6), "cv": F.round("cv", 6)})


# Published normal quantiles of the service levels 0.80, 0.81, ... 0.99.
PUBLISHED_Z = [0.8416, 0.8779, 0.9154, 0.9542, 0.9945, 1.0364, 1.0803, 1.1264, 1.1750, 1.2265, 1.2816, 1.3408, 1.4051, 1.4758, 1.5548, 1.6449, 1.7507,
               1.8808, 2.0537, 2.3263]


@query("service_levels", GRID_SQL + f""", s AS (SELECT l_suppkey, avg(demand) AS d, stddev_samp(demand) AS sd FROM grid GROUP BY 1)
SELECT l_suppkey, round(d, 6) AS daily_demand, CAST(({PUBLISHED_Z})[l_suppkey % 20 + 1] AS DOUBLE) AS z, round(sd * sqrt(14), 6) AS lead_deviation FROM s""")
def service_levels(t):
    """Safety stock with a service level of its own for every item, taken apart into its factor and the deviation over the lead time."""
    level = (F.col("l_suppkey") % 20 + 80) / 100.0
    out = M.replenishment(grid(t), KEYS, "demand", 14, level)
    deviation = F.col("demand_std") * 14 ** 0.5
    return out.select("l_suppkey", F.round("daily_demand", 6).alias("daily_demand"), F.round(F.col("safety_stock") / deviation, 4).alias("z"),
                      F.round(deviation, 6).alias("lead_deviation"))
