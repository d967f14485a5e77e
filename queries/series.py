"""Windowed checks over daily series and raw rows."""

from pyspark.sql import functions as F

from queries.registry import query
from tidelake.operators import series

DAILY_SQL = """
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, round(sum(value), 2) AS total, count(*) AS records
               FROM events GROUP BY 1, 2)
"""
GRID_SQL = DAILY_SQL + """,
span AS (SELECT min(day) AS a, max(day) AS b FROM daily),
days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM span),
grid AS (SELECT k.event_type, days.day, coalesce(d.total, 0) AS total FROM (SELECT DISTINCT event_type FROM daily) k
         CROSS JOIN days LEFT JOIN daily d ON d.event_type = k.event_type AND d.day = days.day)
"""
ORDER = "PARTITION BY event_type ORDER BY day"


def daily(t):
    return series.daily_totals(t.events, ["event_type"], "ts", "value").withColumn("total", F.round("total", 2))


def grid(t):
    return series.zero_filled(daily(t), ["event_type"], "total")


def rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("rolling_deviation", DAILY_SQL + f""", w AS (SELECT event_type, day, total,
  avg(total) OVER f AS m, stddev_samp(total) OVER f AS s, count(total) OVER f AS n FROM daily
  WINDOW f AS ({ORDER} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT event_type, day, total, round(m, 4) AS rolling_mean, round(s, 4) AS rolling_std, n AS in_window,
  coalesce(n >= 7 AND abs(total - m) > 2.0 * s, false) AS is_deviation FROM w""")
def rolling_deviation(t):
    return rounded(series.rolling_deviation(daily(t), ["event_type"], "total"), "rolling_mean", "rolling_std")


@query("rolling_cv", DAILY_SQL + f""", w AS (SELECT event_type, day, total, stddev_samp(total) OVER f / nullif(avg(total) OVER f, 0) AS cv
  FROM daily WINDOW f AS ({ORDER} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT event_type, day, total, round(cv, 6) AS rolling_cv FROM w""")
def rolling_cv(t):
    return rounded(series.rolling_cv(daily(t), ["event_type"], "total"), "rolling_cv", digits=6)


def _change_sql(days, limit):
    return GRID_SQL + f""", c AS (SELECT event_type, day, total, lag(total, {days}) OVER ({ORDER}) AS previous FROM grid),
p AS (SELECT *, (total - previous) * 100.0 / nullif(previous, 0) AS pct FROM c)
SELECT event_type, day, total, previous, round(pct, 4) AS change_pct, coalesce(abs(pct) > {limit}, false) AS is_volatile FROM p"""


@query("day_over_day", _change_sql(1, 50))
def day_over_day(t):
    return rounded(series.change_over(grid(t), ["event_type"], "total", 1, 50.0), "change_pct")


@query("week_over_week", _change_sql(7, 50))
def week_over_week(t):
    return rounded(series.change_over(grid(t), ["event_type"], "total", 7, 50.0), "change_pct")


@query("weekday_zscore", DAILY_SQL + """, s AS (SELECT event_type, day, dayofweek(day) + 1 AS weekday, total FROM daily),
w AS (SELECT *, avg(total) OVER p AS m, stddev_samp(total) OVER p AS sd FROM s WINDOW p AS (PARTITION BY event_type, weekday))
SELECT event_type, day, weekday, total, round(m, 4) AS baseline, round(sd, 4) AS spread,
  round((total - m) / nullif(sd, 0), 4) AS zscore, coalesce(abs((total - m) / nullif(sd, 0)) > 1.5, false) AS is_seasonal_outlier FROM w""")
def weekday_zscore(t):
    out = series.weekday_zscore(daily(t), ["event_type"], "total", 1.5)
    return rounded(out, "baseline", "spread", "zscore").withColumn("weekday", F.col("weekday").cast("long"))


@query("trend_break", DAILY_SQL + f""", w AS (SELECT event_type, day, total,
  avg(total) OVER ({ORDER} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS r,
  avg(total) OVER ({ORDER} ROWS BETWEEN 9 PRECEDING AND 5 PRECEDING) AS e,
  count(total) OVER ({ORDER} ROWS BETWEEN 9 PRECEDING AND 5 PRECEDING) AS n FROM daily)
SELECT event_type, day, total, CASE WHEN n = 5 THEN round((r - e) * 100.0 / nullif(e, 0), 4) END AS trend_pct,
  coalesce(n = 5 AND abs((r - e) * 100.0 / nullif(e, 0)) > 30, false) AS is_break FROM w""")
def trend_break(t):
    return rounded(series.trend_break(daily(t), ["event_type"], "total", 5, 30.0), "trend_pct")


@query("consecutive_failures", """
WITH r AS (SELECT user_id % 5 AS flow, ts, event_id, event_type = 'error' AS failed FROM events),
g AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY flow ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM r)
SELECT flow, count(*) AS run_length, min(ts) AS run_start, max(ts) AS run_end FROM g WHERE failed
GROUP BY flow, island HAVING count(*) >= 3""")
def consecutive_failures(t):
    log = t.events.select((F.col("user_id") % 5).alias("flow"), "ts", "event_id", "event_type")
    return series.consecutive_runs(log, ["flow"], "ts", F.col("event_type") == "error", ["event_id"], 3)


@query("demand_grid", """
WITH daily AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS demand FROM lineitem GROUP BY 1, 2),
days AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM daily)
SELECT k.l_suppkey, days.day, CAST(coalesce(d.demand, 0) AS DOUBLE) AS demand FROM (SELECT DISTINCT l_suppkey FROM daily) k
CROSS JOIN days LEFT JOIN daily d ON d.l_suppkey = k.l_suppkey AND d.day = days.day""")
def demand_grid(t):
    totals = series.daily_totals(t.lineitem, ["l_suppkey"], "l_shipdate", "l_quantity", "demand")
    return series.zero_filled(totals, ["l_suppkey"], "demand")
