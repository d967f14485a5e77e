"""The three anomaly tiers, reports, drift, density."""

import datetime as dt

from pyspark.sql import functions as F

from queries.cleaning import GAPS_SQL, gaps
from queries.registry import query
from queries.series import DAILY_SQL, daily
from tidelake.operators.density import density_noise as noise_points
from tidelake.quality import anomalies, rules
from tidelake.quality.anomalies import AnomalyScan, OutlierCheck, flag_rows

# Events with injected outliers, and the last ten days as "current" against the days before.
SPIKED_SQL = """
WITH spiked AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 997 = 0 THEN value * 100 ELSE value END AS value FROM events)
"""
SPLIT_SQL = """
WITH cur AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-21'), hist AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-21')
"""
SHOWN = ["anomaly_id", "severity", "affected_records"]


def spiked(t):
    return t.events.withColumn("value", F.when(F.col("event_id") % 997 == 0, F.col("value") * 100)
                               .otherwise(F.col("value")))


def halves(t):
    border = F.lit("2024-01-21").cast("timestamp_ntz")
    return t.events.filter(F.col("ts") >= border), t.events.filter(F.col("ts") < border)


# -- tier 1 ------------------------------------------------------------------------------------------------

@query("anom_required", GAPS_SQL + """, c AS (SELECT count(*) AS n, count(*) - count(quantity) AS q, count(*) - count(flag) AS f FROM gaps)
SELECT 'validation_quantity_nulls' AS anomaly_id, CASE WHEN q / n > 0.1 THEN 'critical' WHEN q / n > 0.01 THEN 'high' ELSE 'medium' END
  AS severity, q AS affected_records FROM c WHERE q > 0
UNION ALL SELECT 'validation_flag_nulls', CASE WHEN f / n > 0.1 THEN 'critical' WHEN f / n > 0.01 THEN 'high' ELSE 'medium' END, f FROM c WHERE f > 0
UNION ALL SELECT 'validation_warehouse_missing', 'critical', n FROM c""")
def anom_required(t):
    return AnomalyScan().require("l_orderkey", "quantity", "flag", "warehouse").findings(gaps(t)).select(*SHOWN)


@query("anom_negative", """
SELECT 'validation_c_acctbal_negative' AS anomaly_id, 'high' AS severity, count(*) AS affected_records, min(c_acctbal) AS value
FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0""")
def anom_negative(t):
    return AnomalyScan().non_negative("c_acctbal").findings(t.customer).select(*SHOWN, "value")


@query("anom_future_date", """
SELECT 'validation_l_shipdate_future' AS anomaly_id, 'medium' AS severity, count(*) AS affected_records
FROM lineitem WHERE CAST(l_shipdate AS DATE) > DATE '2001-01-01' HAVING count(*) > 0""")
def anom_future_date(t):
    return AnomalyScan().not_after("l_shipdate", dt.date(2001, 1, 1)).findings(t.lineitem).select(*SHOWN)


@query("anom_business_rule", """
SELECT 'validation_discount_cap' AS anomaly_id, 'medium' AS severity, count(*) AS affected_records
FROM lineitem WHERE NOT (l_discount <= 0.08 OR l_quantity > 25) HAVING count(*) > 0""")
def anom_business_rule(t):
    return AnomalyScan().rule("discount_cap", "l_discount <= 0.08 OR l_quantity > 25").findings(t.lineitem).select(*SHOWN)


# -- tier 2 ------------------------------------------------------------------------------------------------

def _outlier_sql(kind, severity, bounds, score="NULL::DOUBLE"):
    return SPIKED_SQL + f""", b AS ({bounds}), o AS (SELECT value, lo, hi, centre, unit FROM spiked, b WHERE value < lo OR value > hi)
SELECT 'outlier_{kind}_value' AS anomaly_id, '{severity}' AS severity, count(*) AS affected_records,
  round(any_value(lo), 4) AS lower_bound, round(any_value(hi), 4) AS upper_bound, round({score}, 4) AS deviation_score
FROM o HAVING count(*) > 0"""


IQR_SQL = """SELECT a - 1.5 * (c - a) AS lo, c + 1.5 * (c - a) AS hi, 0 AS centre, 1 AS unit FROM
  (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS c FROM spiked)"""
Z_SQL = "SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi, avg(value) AS centre, stddev_samp(value) AS unit FROM spiked"
MAD_SQL = """SELECT m - 3.5 * u AS lo, m + 3.5 * u AS hi, m AS centre, u AS unit FROM (SELECT m, (SELECT median(abs(value - m)) FROM spiked) / 0.6745 AS u
  FROM (SELECT median(value) AS m FROM spiked))"""
PCT_SQL = "SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi, 0 AS centre, 1 AS unit FROM spiked"
SCORE = "max(abs(value - centre) / unit)"


def _outliers(t, scan):
    out = scan.findings(spiked(t)).select(*SHOWN, "lower_bound", "upper_bound", "deviation_score")
    return out.withColumns({c: F.round(c, 4) for c in ("lower_bound", "upper_bound", "deviation_score")})


@query("anom_iqr", _outlier_sql("iqr", "medium", IQR_SQL))
def anom_iqr(t):
    return _outliers(t, AnomalyScan().iqr("value"))


@query("anom_zscore", _outlier_sql("zscore", "medium", Z_SQL, SCORE))
def anom_zscore(t):
    return _outliers(t, AnomalyScan().zscore("value"))


@query("anom_mad", _outlier_sql("mad", "medium", MAD_SQL, SCORE))
def anom_mad(t):
    return _outliers(t, AnomalyScan().mad("value"))


@query("anom_percentile", _outlier_sql("percentile", "low", PCT_SQL))
def anom_percentile(t):
    return _outliers(t, AnomalyScan().percentile("value"))


@query("anom_flagged_rows", SPIKED_SQL + f", b AS ({IQR_SQL}) SELECT event_id, value FROM spiked, b WHERE value < lo OR value > hi")
def anom_flagged_rows(t):
    return flag_rows(spiked(t), OutlierCheck("value", "iqr", 1.5)).select("event_id", "value")


@query("anom_min_samples", """
WITH s AS (SELECT event_type, count(*) AS n, avg(value) AS m, stddev_samp(value) AS sd FROM events WHERE ts < TIMESTAMP '2024-01-02' GROUP BY 1)
SELECT event_id, event_type, value FROM events JOIN s USING (event_type) WHERE ts < TIMESTAMP '2024-01-02' AND n >= 30 AND abs(value - m) > 2 * sd""")
def anom_min_samples(t):
    """No flags for groups below 30 samples. The SQL is of the first day only; ``anom_min_samples_hourly`` has all days."""
    day = t.events.filter(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    return _grouped(day, ["event_type"]).select("event_id", "event_type", "value")


@query("anom_min_samples_hourly", """
WITH e AS (SELECT *, date_trunc('hour', ts) AS hour FROM events),
s AS (SELECT event_type, hour, count(value) AS n, avg(value) AS m, stddev_samp(value) AS sd FROM e GROUP BY 1, 2)
SELECT event_id, event_type, hour, value FROM e JOIN s USING (event_type, hour) WHERE n >= 30 AND abs(value - m) > 2 * sd""")
def anom_min_samples_hourly(t):
    """All events by type and hour; many of these groups are below 30 samples and flag nothing."""
    events = t.events.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return _grouped(events, ["event_type", "hour"]).select("event_id", "event_type", "hour", "value")


@query("anom_min_samples_daily", """
WITH e AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
s AS (SELECT event_type, day, count(value) AS n, avg(value) AS m, stddev_samp(value) AS sd FROM e GROUP BY 1, 2)
SELECT event_id, event_type, day, value FROM e JOIN s USING (event_type, day) WHERE n >= 30 AND abs(value - m) > 2 * sd""")
def anom_min_samples_daily(t):
    """All events by type and day; some days have too few samples of a type and flag nothing."""
    events = t.events.withColumn("day", F.to_date("ts"))
    return _grouped(events, ["event_type", "day"]).select("event_id", "event_type", "day", "value")


def _grouped(events, keys):
    return AnomalyScan(min_samples=anomalies.MIN_SAMPLES).zscore("value", 2.0).grouped_outliers(events, keys)


# -- tier 3 ------------------------------------------------------------------------------------------------

@query("anom_spike", SPLIT_SQL + """, s AS (SELECT (SELECT sum(value * 8) FROM cur) AS now, (SELECT sum(value) FROM hist) AS was)
SELECT 'volatility_spike_value' AS anomaly_id, 'high' AS severity, round(now, 2) AS value, round((now - was) / was * 100, 4) AS deviation_score
FROM s WHERE (now - was) / was * 100 > 200""")
def anom_spike(t):
    now, was = halves(t)
    out = AnomalyScan().spike("value").findings(now.withColumn("value", F.col("value") * 8), was)
    return out.select("anomaly_id", "severity", F.round("value", 2).alias("value"), F.round("deviation_score", 4).alias("deviation_score"))


@query("anom_drop", SPLIT_SQL + """, s AS (SELECT (SELECT sum(value * 0.2) FROM cur) AS now, (SELECT sum(value) FROM hist) AS was)
SELECT 'volatility_drop_value' AS anomaly_id, 'high' AS severity, round(now, 2) AS value, round((was - now) / was * 100, 4) AS deviation_score
FROM s WHERE (was - now) / was * 100 > 100 - 50""")
def anom_drop(t):
    now, was = halves(t)
    out = AnomalyScan().drop("value").findings(now.withColumn("value", F.col("value") * 0.2), was)
    return out.select("anomaly_id", "severity", F.round("value", 2).alias("value"), F.round("deviation_score", 4).alias("deviation_score"))


@query("anom_volume", """
SELECT 'volatility_volume_high' AS anomaly_id, 'volatility' AS anomaly_type, count(*) - 500 AS affected_records FROM events HAVING count(*) > 500
UNION ALL SELECT 'volatility_volume_low', 'missing', 1000000000 - count(*) FROM events HAVING count(*) < 1000000000""")
def anom_volume(t):
    scan = AnomalyScan().volume(100, 500).volume(1_000_000_000, 2_000_000_000)
    return scan.findings(t.events).select("anomaly_id", "anomaly_type", "affected_records")


@query("anom_rolling", """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, sum(value) AS total FROM events GROUP BY 1),
w AS (SELECT total, avg(total) OVER f AS m, stddev_samp(total) OVER f AS s, count(total) OVER f AS n FROM daily
  WINDOW f AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT 'volatility_rolling_value' AS anomaly_id, 'medium' AS severity, count(*) AS affected_records, round(max(abs(total - m) / s), 4) AS deviation_score
FROM w WHERE n >= 7 AND abs(total - m) > 1.5 * s HAVING count(*) > 0""")
def anom_rolling(t):
    out = AnomalyScan().rolling_average("value", "ts", 7, 1.5).findings(t.events)
    return out.select(*SHOWN, F.round("deviation_score", 4).alias("deviation_score"))


FULL_SQL = SPIKED_SQL + f""", cur AS (SELECT * FROM spiked WHERE ts >= TIMESTAMP '2024-01-21'), hist AS (SELECT * FROM spiked WHERE ts < TIMESTAMP '2024-01-21'),
iqr AS ({IQR_SQL.replace('spiked', 'cur')}), z AS ({Z_SQL.replace('spiked', 'cur')}), pct AS ({PCT_SQL.replace('spiked', 'cur')}),
f AS (
  SELECT 'validation_extra_missing' AS anomaly_id, 1 AS tier, 'validation' AS anomaly_type, 'critical' AS severity, count(*) AS affected_records FROM cur
  UNION ALL SELECT 'validation_late_user', 1, 'validation', 'medium', count(*) FILTER (NOT (user_id < 140)) FROM cur
  UNION ALL SELECT 'outlier_iqr_value', 2, 'outlier', 'medium', count(*) FROM cur, iqr WHERE value < lo OR value > hi
  UNION ALL SELECT 'outlier_zscore_value', 2, 'outlier', 'medium', count(*) FROM cur, z WHERE value < lo OR value > hi
  UNION ALL SELECT 'outlier_percentile_value', 2, 'outlier', 'low', count(*) FROM cur, pct WHERE value < lo OR value > hi
  UNION ALL SELECT 'volatility_drop_value', 3, 'volatility', 'high', CASE WHEN ((SELECT sum(value) FROM hist) - sum(value)) / (SELECT sum(value) FROM hist) * 100 > 80 THEN count(*) ELSE 0 END FROM cur
  UNION ALL SELECT 'volatility_volume_high', 3, 'volatility', 'high', greatest(count(*) - 100, 0) FROM cur),
found AS (SELECT * FROM f WHERE affected_records > 0)
"""


def _full(t):
    events = spiked(t)
    border = F.lit("2024-01-21").cast("timestamp_ntz")
    scan = (AnomalyScan("events").require("event_id", "extra").rule("late_user", F.col("user_id") < 140)
            .iqr("value").zscore("value").percentile("value").drop("value", 20.0).volume(10, 100))
    return scan.findings(events.filter(F.col("ts") >= border), events.filter(F.col("ts") < border))


@query("anomaly_findings", FULL_SQL + "SELECT * FROM found")
def anomaly_findings(t):
    return _full(t).select("anomaly_id", "tier", "anomaly_type", "severity", "affected_records")


@query("anomaly_report", FULL_SQL + """
SELECT anomaly_type, severity, count(*) AS anomalies, CAST(sum(affected_records) AS BIGINT) AS affected_records FROM found GROUP BY 1, 2""")
def anomaly_report(t):
    return anomalies.report(_full(t))


@query("health_score", FULL_SQL + """
SELECT count(*) AS total_anomalies, greatest(0, 100 - CAST(sum(CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 5 WHEN 'high' THEN 15 ELSE 50 END) AS BIGINT))
  AS health_score FROM found""")
def health_score(t):
    return anomalies.health_score(_full(t))


@query("quick_anomaly", SPIKED_SQL + f""", b AS ({IQR_SQL})
SELECT 'outlier_iqr_value' AS anomaly_id, 'medium' AS severity, count(*) AS affected_records FROM spiked, b WHERE value < lo OR value > hi HAVING count(*) > 0""")
def quick_anomaly(t):
    return anomalies.quick_scan(spiked(t), ["event_id"], ["value"]).select(*SHOWN)


SAMPLES_SQL = SPIKED_SQL + f""", e AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 501 = 0 THEN -value ELSE value END AS value FROM spiked),
i AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM e),
b(check_id, lo, hi, q1, q3, text) AS (
  SELECT 'outlier_iqr_value', q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1), q1, q3, 'iqr' FROM i
  UNION ALL SELECT 'outlier_iqr_value_2', q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1), q1, q3, 'iqr' FROM i
  UNION ALL SELECT 'outlier_zscore_value', avg(value) - 3 * stddev_samp(value), avg(value) + 3 * stddev_samp(value), NULL, NULL, 'zscore' FROM e
  UNION ALL SELECT 'validation_value_negative', 0, NULL, NULL, NULL, NULL),
hit AS (SELECT check_id, value, event_id, greatest(lo - value, value - hi) AS far, round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr FROM e, b WHERE value < lo OR value > hi),
s AS (SELECT *, row_number() OVER (PARTITION BY check_id ORDER BY far DESC, CAST(value AS VARCHAR)) AS nth FROM hit)
SELECT check_id AS anomaly_id, any_value(q1) AS q1, any_value(q3) AS q3, any_value(iqr) AS iqr, count(*) AS affected_records,
  string_agg(printf('%.2f', value), '|' ORDER BY nth) FILTER (nth <= 10) AS sample_values, least(count(*), 10) AS sample_records
FROM s GROUP BY 1"""


@query("anom_samples", SAMPLES_SQL)
def anom_samples(t):
    """Findings with the most extreme values and what each bound was made of; a method that repeats has ids of its own."""
    events = spiked(t).withColumn("value", F.when(F.col("event_id") % 501 == 0, -F.col("value")).otherwise(F.col("value")))
    scan = AnomalyScan("events").non_negative("value").iqr("value").iqr("value", 3.0, "high").zscore("value")
    out = scan.detailed(events, detected_at=dt.datetime(2024, 2, 1))
    two = F.transform("sample_values", lambda v: F.format_string("%.2f", v.cast("double")))
    return out.select("anomaly_id", *[F.round(F.col("details")[k], 4).alias(k) for k in ("q1", "q3", "iqr")], "affected_records",
                      F.array_join(two, "|").alias("sample_values"), F.size("sample_records").cast("long").alias("sample_records"))


@query("tier_actions", FULL_SQL + """
, p(tier, act) AS (VALUES (1, 'block'), (2, 'flag'), (3, 'alert'))
SELECT p.tier::INTEGER AS tier, count(found.tier) AS findings, coalesce(sum(affected_records), 0)::BIGINT AS affected_records,
  CASE WHEN count(found.tier) > 0 THEN any_value(act) ELSE 'pass' END AS action
FROM p LEFT JOIN found ON p.tier = found.tier GROUP BY p.tier""")
def tier_actions(t):
    """Blocked, flagged or alerted, by the tier of the findings."""
    return rules.tier_actions(_full(t))


# -- documented checks -------------------------------------------------------------------------------------

@query("grubbs", """
SELECT event_type, n, round(greatest(hi - m, m - lo) / sd, 6) AS g FROM
(SELECT event_type, count(value) AS n, avg(value) AS m, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1)""")
def grubbs(t):
    return anomalies.grubbs(t.events, ["event_type"], "value").select("event_type", "n", F.round("g", 6).alias("g"))


@query("grubbs_verdict")
def grubbs_verdict(t):
    return anomalies.grubbs(spiked(t), ["event_type"], "value", critical=True).select("event_type", "g", "critical", "is_outlier")


@query("density_noise", """
WITH p AS (SELECT event_id, epoch(ts) / 3600.0 AS x, value AS y FROM events),
n AS (SELECT a.event_id, count(*) AS c FROM p a JOIN p b ON abs(a.x - b.x) <= 12 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 144 GROUP BY 1),
core AS (SELECT p.* FROM p JOIN n USING (event_id) WHERE c >= 8)
SELECT p.event_id FROM p JOIN n USING (event_id) WHERE c < 8 AND NOT EXISTS (
  SELECT 1 FROM core k WHERE (p.x - k.x) * (p.x - k.x) + (p.y - k.y) * (p.y - k.y) <= 144)""")
def density_noise(t):
    points = t.events.select("event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 3600.0).alias("x"), F.col("value").alias("y"))
    return noise_points(points, "event_id", ["x", "y"], 12.0, 8).select("event_id")


@query("context_threshold", DAILY_SQL + """, s AS (SELECT *, dayofweek(day) + 1 AS weekday FROM daily),
b AS (SELECT weekday, avg(total) AS m, stddev_samp(total) AS sd FROM s GROUP BY 1)
SELECT event_type, day, total, CASE WHEN day = DATE '2024-01-15' THEN 0.5 WHEN weekday IN (1, 7) THEN 1.5 ELSE 1.0::DOUBLE END AS threshold
FROM s JOIN b USING (weekday) WHERE abs(total - m) / nullif(sd, 0) > CASE WHEN day = DATE '2024-01-15' THEN 0.5 WHEN weekday IN (1, 7) THEN 1.5 ELSE 1.0 END""")
def context_threshold(t):
    return anomalies.context_threshold(daily(t), "day", "total", {"2024-01-15": 0.5}, 1.0, 1.5).select(
        "event_type", "day", "total", "threshold")


@query("drift_psi", """
WITH cur AS (SELECT value + 5 AS value FROM events WHERE ts >= TIMESTAMP '2024-01-21'), hist AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-21'),
e AS (SELECT unnest(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS edge FROM hist),
h AS (SELECT (SELECT count(*) FROM e WHERE hist.value > edge) AS bin FROM hist), c AS (SELECT (SELECT count(*) FROM e WHERE cur.value > edge) AS bin FROM cur),
b AS (SELECT unnest(generate_series(0, (SELECT count(*) FROM e))) AS bin),
j AS (SELECT b.bin, (SELECT count(*) FROM h WHERE h.bin = b.bin) AS expected, (SELECT count(*) FROM c WHERE c.bin = b.bin) AS actual FROM b),
p AS (SELECT *, greatest(expected, 0.5) / sum(expected) OVER () AS p, greatest(actual, 0.5) / sum(actual) OVER () AS q FROM j)
SELECT CAST(bin AS INTEGER) AS bin, expected, actual, round((q - p) * ln(q / p), 6) AS psi FROM p""")
def drift_psi(t):
    now, was = halves(t)
    out = anomalies.drift_psi(now.withColumn("value", F.col("value") + 5), was, "value")
    return out.select("bin", "expected", "actual", F.round("psi", 6).alias("psi"))


@query("alert_severity", """
SELECT 'invalid_pct' AS metric, round(count(*) FILTER (c_acctbal < 0) * 100.0 / count(*), 4) AS measure, 'high' AS alert FROM customer
  HAVING count(*) FILTER (c_acctbal < 0) * 100.0 / count(*) > 5
UNION ALL SELECT 'anomaly_count', CAST(count(*) AS DOUBLE), 'medium' FROM events WHERE event_type = 'error' HAVING count(*) > 50
UNION ALL SELECT 'stale_hours', round(epoch(TIMESTAMP '2024-01-31 12:00:00' - max(ts)) / 3600.0, 4), 'high' FROM events
  HAVING epoch(TIMESTAMP '2024-01-31 12:00:00' - max(ts)) / 3600.0 > 4""")
def alert_severity(t):
    def metric(name, df, value):
        return df.agg(value.cast("double").alias("measure")).select(F.lit(name).alias("metric"), "measure")
    end = F.lit("2024-01-31 12:00:00").cast("timestamp")
    stale = (F.unix_micros(end) - F.unix_micros(F.max(F.col("ts").cast("timestamp")))) / 3.6e9
    metrics = (metric("invalid_pct", t.customer, F.count(F.when(F.col("c_acctbal") < 0, 1)) * 100.0 / F.count(F.lit(1)))
               .union(metric("anomaly_count", t.events.filter("event_type = 'error'"), F.count(F.lit(1))))
               .union(metric("stale_hours", t.events, stale))
               .union(metric("quality_score_pct", t.customer, F.lit(100.0) * F.count("c_name") / F.count(F.lit(1)))))
    return anomalies.alert_severity(metrics).withColumn("measure", F.round("measure", 4))


@query("historical_range", SPLIT_SQL + """, r AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM hist GROUP BY 1)
SELECT event_id, cur.user_id, value, lo AS seen_min, hi AS seen_max FROM cur JOIN r ON cur.user_id = r.user_id WHERE value < lo OR value > hi""")
def historical_range(t):
    now, was = halves(t)
    return anomalies.historical_range(now, was, "user_id", "value").select("event_id", "user_id", "value", "seen_min", "seen_max")


# Published two-sided critical values of Grubbs' test at level 0.05, by group size from 3.
GRUBBS_PUBLISHED = [1.1543, 1.4812, 1.7150, 1.8871, 2.0200, 2.1266, 2.2150, 2.2900, 2.3547, 2.4116, 2.4620, 2.5073, 2.5483, 2.5857, 2.6200,
                    2.6516, 2.6809, 2.7082]


@query("grubbs_small_groups", SPIKED_SQL + f""", k AS (SELECT unnest({GRUBBS_PUBLISHED}) AS critical, unnest(range(3, 21)) AS size),
s AS (SELECT user_id, event_type, count(value) AS n, avg(value) AS m, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi FROM spiked GROUP BY 1, 2)
SELECT user_id, event_type, n, greatest(hi - m, m - lo) / sd > critical AS is_outlier FROM s JOIN k ON n = size WHERE sd > 0
  AND abs(greatest(hi - m, m - lo) / sd - critical) > 0.0001""")
def grubbs_small_groups(t):
    """Verdicts for groups of 3 to 20 values against published critical values (but for values that those round away)."""
    out = anomalies.grubbs(spiked(t), ["user_id", "event_type"], "value", critical=True).filter("n BETWEEN 3 AND 20 AND std > 0")
    published = F.element_at(F.array(*[F.lit(v) for v in GRUBBS_PUBLISHED]), F.col("n").cast("int") - 2)
    return out.filter(F.abs(F.col("g") - published) > 0.0001).select("user_id", "event_type", "n", "is_outlier")


@query("velocity_check", SPLIT_SQL + """, a AS (SELECT event_id, user_id, ts, value, 0 AS now FROM hist UNION ALL SELECT event_id, user_id, ts, value * 3, 1 FROM cur),
w AS (SELECT *, lag(ts) OVER o AS t0, lag(value) OVER o AS v0 FROM a WINDOW o AS (PARTITION BY user_id ORDER BY ts, now, event_id)),
r AS (SELECT *, (value - v0) / nullif((epoch_us(ts) - epoch_us(t0)) / 3.6e9, 0) AS rate FROM w WHERE t0 IS NOT NULL),
p AS (SELECT user_id, min(rate) AS lo, max(rate) AS hi FROM r WHERE now = 0 GROUP BY 1)
SELECT event_id, r.user_id, round(rate, 4) AS rate, round(lo, 4) AS min_rate, round(hi, 4) AS max_rate FROM r JOIN p ON r.user_id = p.user_id
WHERE now = 1 AND (rate < lo OR rate > hi)""")
def velocity_check(t):
    """Readings that rise or fall faster than their user's ever did; the first of each user follows the last of the days before."""
    now, was = halves(t)
    out = anomalies.velocity_check(now.withColumn("value", F.col("value") * 3), was, "user_id", "ts", "value", ["event_id"])
    return out.select("event_id", "user_id", *[F.round(c, 4).alias(c) for c in ("rate", "min_rate", "max_rate")])


POLISH = "".join(f""", p{i} AS (SELECT * REPLACE (r - coalesce(median(r) FILTER (usual) OVER (PARTITION BY flag, {g}), 0) AS r) FROM p{i - 1})"""
                 for i, g in enumerate(["weekday", "week"] * 3, 1))


@query("context_season", f"""
WITH d AS (SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS total FROM lineitem GROUP BY 1, 2),
p0 AS (SELECT *, dayofweek(day) AS weekday, weekofyear(day) AS week, NOT (month(day) = 12 AND day(day) = 24) AS usual, CAST(total AS DOUBLE) AS r FROM d){POLISH},
q AS (SELECT * REPLACE (r - median(r) FILTER (usual) OVER (PARTITION BY flag) AS r) FROM p6),
s AS (SELECT *, median(abs(r)) FILTER (usual) OVER (PARTITION BY flag) / 0.6745 AS spread FROM q)
SELECT flag, day, total, round(total - r, 4) AS expected, round(r / spread, 4) AS score, NOT usual AS is_event FROM s WHERE abs(r / spread) > 2.5""")
def context_season(t):
    """Days away from what their weekday and week of the year lead to expect; Christmas Eves shape nothing but are judged."""
    daily_lines = t.lineitem.groupBy(F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("total"))
    eves = [dt.date(y, 12, 24) for y in range(1995, 2003)]
    out = anomalies.context_season(daily_lines, ["flag"], "total", eves, 2.5)
    return out.withColumns({c: F.round(c, 4) for c in ("expected", "score")})
