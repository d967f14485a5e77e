"""Demand analytics per series: patterns, intermittent-demand forecasts, backtests, stock parameters.

A series is one row per key and day, so its length is bounded by the calendar. Smoothing recursions are
``aggregate`` folds over the sorted array of one series: they run inside the JVM, one pass, no Python per row, and
series are spread over the cluster by key.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from itertools import accumulate
from multiprocessing.pool import ThreadPool
from statistics import NormalDist
from typing import Callable, NamedTuple, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.distributions import bound, normal_quantile
from tidelake.operators.series import cumulative_share
from tidelake.session import file_per_task, materialise, small_methods

# Cuts of the demand patterns, ABC/XYZ classes, and normal quantiles of service levels.
ADI_CUT = 1.32
CV2_CUT = 0.49
ABC_CUTS = (0.80, 0.95)
XYZ_CUTS = (0.5, 1.0)
SERVICE_Z = {0.90: 1.2816, 0.95: 1.6449, 0.98: 2.0537, 0.99: 2.3263}

PATTERN_MODELS = {"smooth": ("moving_average", "ses", "holt_winters"), "erratic": ("ses", "moving_average", "random_forest"),
                  "intermittent": ("croston", "sba", "tsb"), "lumpy": ("sba", "tsb", "bootstrap")}

# Draws of the bootstrap: a linear congruence modulo this prime, mixed by three multipliers.
DRAW_PRIME = 2_147_483_647
DRAW_STEPS = (7_919, 104_729, 1_299_709)
DRAW_MIX = (48_271, 16_807, 69_621)

# Bins of a feature that trees see, and parts of an octave whose values are counted together to part them.
BINS = 32
FINE = 1_024
# Trees of a forest over all series.
FOREST_TREES = 20


def demand_pattern(grid: DataFrame, keys: Sequence[str], demand: str, adi_cut: float = ADI_CUT,
                   cv2_cut: float = CV2_CUT) -> DataFrame:
    """ADI, CV² and pattern of each zero-filled series; without any demand a series is lumpy."""
    size = F.when(F.col(demand) > 0, F.col(demand))
    stats = grid.groupBy(*keys).agg(F.count(F.lit(1)).alias("periods"), F.count(size).alias("nonzero"),
                                    F.avg(size).alias("__mean"), F.stddev_samp(size).alias("__std"))
    adi = F.col("periods") / F.nullif(F.col("nonzero"), F.lit(0))
    cv2 = F.pow(F.col("__std") / F.nullif(F.col("__mean"), F.lit(0.0)), 2)
    high_adi, high_cv2 = F.col("adi") >= adi_cut, F.coalesce(F.col("cv2") >= cv2_cut, F.lit(False))
    pattern = (F.when(F.col("nonzero") == 0, "lumpy").when(~high_adi & ~high_cv2, "smooth")
               .when(~high_adi, "erratic").when(~high_cv2, "intermittent").otherwise("lumpy"))
    return stats.withColumns({"adi": adi, "cv2": cv2}).select(*keys, "periods", "nonzero", "adi", "cv2",
                                                             pattern.alias("pattern"))


def as_series(grid: DataFrame, keys: Sequence[str], demand: str, output: str = "series") -> DataFrame:
    """One row per key with its demand in day order; at most one entry per calendar day."""
    entries = F.sort_array(F.collect_list(F.struct("day", F.col(demand).cast("double").alias("v"))))
    return grid.groupBy(*keys).agg(F.transform(entries, lambda e: e["v"]).alias(output))


# -- recursions over Column of array<double>: what they leave behind a day is the forecast of the next period ----

class Recursion(NamedTuple):
    """State after the first ``skip`` values of a series, the step to the next value, and the forecast of a state.

    ``forecast`` also gets the values that led to the state; ``least`` is the fewest values that give a forecast.
    """

    start: Callable[[Column], Column]
    step: Callable[[Column, Column], Column]
    forecast: Callable[[Column, Column], Column]
    skip: int = 0
    least: int = 0


def _run(method: Recursion, series: Column) -> Column:
    """The forecast behind the whole series."""
    rest = F.slice(series, F.lit(method.skip + 1), F.size(series)) if method.skip else series
    out = F.aggregate(rest, method.start(series), method.step, lambda s: method.forecast(s, series))
    return F.when(F.size(series) >= method.least, out) if method.least else out


def _run_at(method: Recursion, series: Column, cuts: Column) -> Column:
    """The forecasts behind the first ``c`` values for every ``c`` of the ascending array ``cuts``, in one pass over the series."""
    def part(s: Column, cut: Column) -> Column:
        state = F.aggregate(F.slice(series, s["at"] + 1, F.greatest(cut - s["at"], F.lit(0))), s["state"], method.step)
        return bound(state, lambda state: F.struct(
            F.greatest(s["at"], cut).alias("at"), state.alias("state"),
            F.concat(s["out"], F.array(F.when(cut >= method.least, method.forecast(state, F.slice(series, F.lit(1), cut))))).alias("out")))

    start = F.struct(F.lit(method.skip).alias("at"), method.start(series).alias("state"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(cuts, start, part, lambda s: s["out"])


def ses_recursion(alpha: float = 0.3) -> Recursion:
    return Recursion(lambda series: F.element_at(series, 1), lambda level, x: alpha * x + (1 - alpha) * level, lambda level, _: level, skip=1)


def croston_recursion(alpha: float = 0.1) -> Recursion:
    none = F.lit(None).cast("double")

    def step(s: Column, x: Column) -> Column:
        first = s["z"].isNull()
        z = F.when(first, x).otherwise(alpha * x + (1 - alpha) * s["z"])
        p = F.when(first, s["q"]).otherwise(alpha * s["q"] + (1 - alpha) * s["p"])
        return F.when(x > 0, F.struct(z.alias("z"), p.alias("p"), F.lit(1.0).alias("q"))).otherwise(
            F.struct(s["z"].alias("z"), s["p"].alias("p"), (s["q"] + 1.0).alias("q")))

    return Recursion(lambda series: F.struct(none.alias("z"), none.alias("p"), F.lit(1.0).alias("q")), step,
                     lambda s, _: F.coalesce(s["z"] / s["p"], F.lit(0.0)))


def tsb_recursion(alpha: float = 0.1, beta: float = 0.1) -> Recursion:
    none = F.lit(None).cast("double")

    def step(s: Column, x: Column) -> Column:
        hit = F.when(x > 0, 1.0).otherwise(0.0)
        p = F.when(s["p"].isNull(), hit).otherwise(s["p"] + beta * (hit - s["p"]))
        z = F.when(x > 0, F.when(s["z"].isNull(), x).otherwise(s["z"] + alpha * (x - s["z"]))).otherwise(s["z"])
        return F.struct(p.alias("p"), z.alias("z"))

    return Recursion(lambda series: F.struct(none.alias("p"), none.alias("z")), step, lambda s, _: F.coalesce(s["p"] * s["z"], F.lit(0.0)))


def holt_winters_recursion(alpha: float = 0.2, beta: float = 0.05, gamma: float = 0.1, season: int = 7) -> Recursion:
    def begin(series: Column) -> Column:
        mean = lambda start: F.aggregate(F.slice(series, start, season), F.lit(0.0), lambda a, x: a + x) / season
        return bound(F.struct(mean(1).alias("a"), mean(season + 1).alias("b")), lambda m: F.struct(
            m["a"].alias("l"), ((m["b"] - m["a"]) / season).alias("b"), F.transform(F.slice(series, 1, season), lambda x: x - m["a"]).alias("s")))

    def step(st: Column, x: Column) -> Column:
        level = alpha * (x - F.element_at(st["s"], 1)) + (1 - alpha) * (st["l"] + st["b"])
        trend = beta * (level - st["l"]) + (1 - beta) * st["b"]
        term = gamma * (x - level) + (1 - gamma) * F.element_at(st["s"], 1)
        queue = F.concat(F.slice(st["s"], 2, season - 1), F.array(term))
        return F.struct(level.alias("l"), trend.alias("b"), queue.alias("s"))

    return Recursion(begin, step, lambda st, _: st["l"] + st["b"] + F.element_at(st["s"], 1), season, 2 * season)


def ses(series: Column, alpha: float = 0.3) -> Column:
    """Simple exponential smoothing, started at the first value."""
    return _run(ses_recursion(alpha), series)


def croston(series: Column, alpha: float = 0.1) -> Column:
    """Croston: smoothed demand size over smoothed interval, updated at demands only; 0 without any demand."""
    return _run(croston_recursion(alpha), series)


def sba(series: Column, alpha: float = 0.1) -> Column:
    """Croston with the Syntetos-Boylan bias correction."""
    return croston(series, alpha) * (1 - alpha / 2)


def tsb(series: Column, alpha: float = 0.1, beta: float = 0.1) -> Column:
    """Teunter-Syntetos-Babai: smoothed demand probability times smoothed size."""
    return _run(tsb_recursion(alpha, beta), series)


def holt_winters(series: Column, alpha: float = 0.2, beta: float = 0.05, gamma: float = 0.1,
                 season: int = 7) -> Column:
    """Additive Holt-Winters; level, trend and season start from the first two seasons.

    The state keeps the last ``season`` seasonal terms in a queue: the oldest one belongs to the current period.
    NULL when there are fewer than two seasons.
    """
    return _run(holt_winters_recursion(alpha, beta, gamma, season), series)


def moving_average(series: Column, window: int = 28) -> Column:
    return _trailing_mean(series, F.size(series), window)


def _trailing_mean(series: Column, cut: Column, window: int) -> Column:
    """Mean of the last ``window`` of the first ``cut`` values."""
    tail = F.slice(series, F.greatest(cut - (window - 1), F.lit(1)), F.least(cut, F.lit(window)))
    return F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(tail), F.lit(0))


def _draw(seed: Column, replicate: Column, step: Column, salt: int) -> Column:
    """A whole number below ``DRAW_PRIME``, the same wherever it is worked out."""
    z = (seed * DRAW_STEPS[0] + replicate * DRAW_STEPS[1] + step * DRAW_STEPS[2] + salt) % DRAW_PRIME
    for factor in DRAW_MIX:
        z = (z * factor + 1) % DRAW_PRIME
    return z


def _transitions() -> Recursion:
    """Days without and with demand, and how many of each were followed by a day with demand."""
    zero = F.lit(0).cast("long")

    def step(s: Column, x: Column) -> Column:
        return F.struct((x > 0).alias("on"), F.when(s["on"], s["off_n"]).otherwise(s["off_n"] + 1).alias("off_n"),
                        F.when(~s["on"] & (x > 0), s["off_on"] + 1).otherwise(s["off_on"]).alias("off_on"),
                        F.when(s["on"], s["on_n"] + 1).otherwise(s["on_n"]).alias("on_n"),
                        F.when(s["on"] & (x > 0), s["on_on"] + 1).otherwise(s["on_on"]).alias("on_on"))

    return Recursion(lambda series: F.struct((F.element_at(series, 1) > 0).alias("on"), zero.alias("off_n"), zero.alias("off_on"),
                                             zero.alias("on_n"), zero.alias("on_on")), step, lambda s, _: s, skip=1)


def _futures(pairs: Column, series: Column, seed: Column, lead: int, replicates: int) -> Column:
    """Total demand over ``lead`` days of each replicate; ``pairs`` is what :func:`_transitions` found in ``series``."""
    one = F.lit(1).cast("long")
    shares = bound(pairs, lambda pairs: F.struct(
        F.coalesce(F.try_divide(pairs["off_on"], pairs["off_n"]), F.lit(0.0)).alias("off"),
        F.coalesce(F.try_divide(pairs["on_on"], pairs["on_n"]), F.lit(0.0)).alias("on"),
        F.filter(series, lambda x: x > 0).alias("sizes"), (F.element_at(series, -1) > 0).alias("last"), seed.alias("seed")))

    def future(p: Column, replicate: Column) -> Column:
        def day(s: Column, at: Column) -> Column:
            chance = F.when(s["on"], p["on"]).otherwise(p["off"])
            hit = _draw(p["seed"], replicate, at, 0) / F.lit(float(DRAW_PRIME)) < chance
            size = F.element_at(p["sizes"], (_draw(p["seed"], replicate, at, 1) % F.size(p["sizes"]) + 1).cast("int"))
            return bound(hit, lambda hit: F.struct(hit.alias("on"), (s["total"] + F.when(hit, size).otherwise(0.0)).alias("total")))

        return F.aggregate(F.sequence(one, F.lit(lead).cast("long")), F.struct(p["last"].alias("on"), F.lit(0.0).alias("total")), day, lambda s: s["total"])

    return bound(shares, lambda p: F.when(F.size(p["sizes"]) == 0, F.transform(F.sequence(F.lit(1), F.lit(replicates)), lambda _: F.lit(0.0)))
                 .otherwise(F.transform(F.sequence(one, F.lit(replicates).cast("long")), lambda r: future(p, r))))


def bootstrap_totals(series: Column, seed: Column, lead: int, replicates: int = 100) -> Column:
    """Demand over ``lead`` days in each of ``replicates`` futures of a series that is mostly zero.

    Whether a day has demand is a chain of two states with the transition shares of the series, started at its last
    day; sizes are drawn from its demands. Draws are hashed from ``seed`` (a whole number below 2^31), replicate and day, so a
    task that runs again draws the same. Without any demand all totals are 0.
    """
    return _futures(_run(_transitions(), series), series, seed, lead, replicates)


def bootstrap_recursion(lead: int = 30, replicates: int = 30) -> Recursion:
    def mean(pairs: Column, series: Column) -> Column:
        seed = F.pmod(F.xxhash64(series), F.lit(DRAW_PRIME))
        return F.aggregate(_futures(pairs, series, seed, lead, replicates), F.lit(0.0), lambda a, x: a + x) / (replicates * lead)

    return _transitions()._replace(forecast=mean)


def bootstrap(series: Column, lead: int = 30, replicates: int = 30) -> Column:
    """Mean daily demand over the futures of :func:`bootstrap_totals`."""
    return _run(bootstrap_recursion(lead, replicates), series)


def lead_time_demand(series: DataFrame, keys: Sequence[str], seed: Column, lead: int, levels: Sequence[float], replicates: int = 100) -> DataFrame:
    """Per series the mean and, for each service level, the smallest bootstrapped total that covers it (a reorder point)."""
    totals = series.select(*keys, F.sort_array(bootstrap_totals(F.col("series"), seed, lead, replicates)).alias("t"))
    cover = [F.element_at("t", F.lit(min(replicates, max(1, math.ceil(round(level * replicates, 9)))))).alias(f"cover_{round(level * 100)}") for level in levels]
    return totals.select(*keys, (F.aggregate("t", F.lit(0.0), lambda a, x: a + x) / replicates).alias("mean_demand"), *cover)


METHODS: dict[str, Callable[[Column], Column]] = {
    "ses": ses, "croston": croston, "sba": sba, "tsb": tsb, "holt_winters": holt_winters,
    "moving_average": moving_average, "bootstrap": bootstrap}
SMOOTHING = ("ses", "croston", "sba", "tsb", "holt_winters", "moving_average")
#: The recursion behind each method and a factor of its forecasts; a moving average looks at its last days only.
RECURSIONS: dict[str, tuple[Callable[[], Recursion], float]] = {
    "ses": (ses_recursion, 1.0), "croston": (croston_recursion, 1.0), "sba": (croston_recursion, 0.95), "tsb": (tsb_recursion, 1.0),
    "holt_winters": (holt_winters_recursion, 1.0), "bootstrap": (bootstrap_recursion, 1.0)}


def forecast(series: DataFrame, keys: Sequence[str], methods: Sequence[str] = SMOOTHING) -> DataFrame:
    """Next-period forecast of each method, one column per method."""
    return series.select(*keys, *[METHODS[m](F.col("series")).alias(m) for m in methods])


def fold_forecasts(series: DataFrame, keys: Sequence[str], horizon: int, folds: int, methods: Sequence[str], wanted: Column | None = None) -> DataFrame:
    """``keys, folds, tail, method, at``: ``at[f]`` is the forecast behind the cut-off ``f * horizon`` days before the end, 0 being the end.

    ``folds`` are the cut-offs that a series is long enough for, ``tail`` the days behind the earliest. One pass over a series
    serves all its cut-offs, and nothing is shuffled. ``wanted`` is a series' list of the methods that are run on it (all unless given).
    """
    size = F.size("series")
    listed = F.array(*[F.lit(m) for m in methods]) if wanted is None else F.array_intersect(wanted, F.array(*[F.lit(m) for m in methods]))
    cut = series.withColumn("folds", F.greatest(F.least((size / horizon).cast("int") - 1, F.lit(folds)), F.lit(0)))
    cuts = F.transform(F.sequence(F.col("folds"), F.lit(0), F.lit(-1)), lambda f: size - f * horizon)
    cut = cut.select(*keys, "series", "folds", cuts.alias("__cuts"), listed.alias("__wanted"))
    runs = {RECURSIONS[m][0]: f"__run_{m}" for m in methods if m in RECURSIONS}
    asked = lambda run: F.arrays_overlap("__wanted", F.array(*[F.lit(m) for m in methods if m in RECURSIONS and RECURSIONS[m][0] is run]))
    done = cut.select(*keys, "folds", "__wanted", F.slice("series", size - F.col("folds") * horizon + 1, F.col("folds") * horizon).alias("tail"),
                      *[F.when(asked(run), F.reverse(_run_at(run(), F.col("series"), F.col("__cuts")))).alias(name) for run, name in runs.items()],
                      F.reverse(F.transform("__cuts", lambda c: _trailing_mean(F.col("series"), c, 28))).alias("__mean"))

    def at(method: str) -> Column:
        if method == "moving_average":
            return F.col("__mean")
        run, factor = RECURSIONS[method]
        return F.col(runs[run]) if factor == 1.0 else F.transform(runs[run], lambda x: x * factor)

    found = F.filter(F.array(*[F.struct(F.lit(m).alias("method"), at(m).alias("at")) for m in methods]), lambda f: F.array_contains("__wanted", f["method"]))
    return done.select(*keys, "folds", "tail", F.inline(found))


def backtest_scores(series: DataFrame, keys: Sequence[str], horizon: int, folds: int,
                    methods: Sequence[str] = tuple(METHODS), wanted: Column | None = None) -> DataFrame:
    """Rolling-origin test: mean absolute error per key and method over ``folds`` cut-offs ``horizon`` days apart.

    Each cut-off forecasts a flat rate and is compared with the mean demand of the following ``horizon`` days. ``wanted`` is that of
    :func:`fold_forecasts`.
    """
    tests = fold_forecasts(series, keys, horizon, folds, methods, wanted).filter("folds > 0")

    def error(fold: Column) -> Column:
        days = F.slice("tail", (F.col("folds") - fold) * horizon + 1, F.lit(horizon))
        return F.abs(F.get("at", fold) - F.aggregate(days, F.lit(0.0), lambda a, x: a + x) / horizon)

    errors = F.array_compact(F.transform(F.sequence(F.lit(1), F.col("folds")), error))
    scored = tests.select(*keys, "method", errors.alias("__errors"), F.size(F.array_compact(F.slice("at", F.lit(2), F.col("folds")))).cast("long").alias("folds"))
    return scored.select(*keys, "method", (F.aggregate("__errors", F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("__errors"), F.lit(0))).alias("mae"), "folds")


def _borders(points: Sequence[float]) -> list[float]:
    """At most ``BINS - 1`` borders between ascending quantiles of a feature: values with more than a share of their own get a bin."""
    return _parted([(v, v, n) for v, n in sorted(Counter(points).items())])


def _parted(groups: Sequence[tuple[float, float, int]]) -> list[float]:
    """:func:`_borders` between ascending groups of values: the least and the largest value of a group and how many it holds."""
    share = sum(n for _, _, n in groups) / BINS
    borders, upto = [], 0
    for (_, value, n), (following, _, more) in zip(groups, groups[1:]):
        upto += n
        target = (len(borders) + 1) * share
        if len(groups) <= BINS or abs(upto - target) < abs(upto + more - target):
            borders.append(value / 2 + following / 2)
    return borders


def _value_groups(known: DataFrame, inputs: Sequence[str]) -> dict[str, list[tuple[float, float, int]]]:
    """Per input the values of all rows in ascending groups, for :func:`_parted`: values that share sign and the first digits go together.

    One aggregate counts every row. A group spans less than ``1 / FINE`` of its values, so there are as many as the orders of magnitude ask for.
    Infinite values and NaN lie in the outer bins whatever the borders.
    """
    v = F.col("v")
    rows = known.select(F.stack(F.lit(len(inputs)), *[x for i, c in enumerate(inputs) for x in (F.lit(i), F.col(c).cast("double"))]).alias("at", "v")).filter(F.abs(v) < math.inf)
    digits = F.floor(F.log2(F.nullif(F.abs(v), F.lit(0.0))) * FINE)
    found = rows.groupBy("at", F.signum(v), digits).agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n")).collect()
    return {c: sorted((r["lo"], r["hi"], r["n"]) for r in found if r["at"] == i) for i, c in enumerate(inputs)}


def _binned(rows: DataFrame, known: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``rows`` with the number of the bin in place of each of ``inputs``; quantiles of all rows of ``known`` part the bins."""
    from pyspark.ml.feature import Bucketizer

    groups = _value_groups(known, inputs)
    splits = [[-math.inf, *(_parted(groups[c]) or [0.0]), math.inf] for c in inputs]
    bins = Bucketizer(splitsArray=splits, inputCols=list(inputs), outputCols=[f"__bin_{c}" for c in inputs], handleInvalid="keep").transform(rows)
    # Without the metadata of the Bucketizer, after which trees would take bins as categories without an order.
    return bins.select(*[c for c in rows.columns if c not in inputs], *[F.col(f"__bin_{c}").alias(c, metadata={}) for c in inputs])


def _drawn(identity: Sequence[str], tree: int, seed: int) -> Column:
    """How often a tree draws a row: Poisson with mean 1, the same wherever it is worked out."""
    share = F.shiftrightunsigned(F.xxhash64(*identity, F.lit(seed * 1000 + tree)), 11) * F.lit(2.0 ** -53)
    cuts = list(accumulate(math.exp(-1) / math.factorial(k) for k in range(12)))
    times = F.when(share < cuts[0], 0.0)
    for k, cut in enumerate(cuts[1:], 1):
        times = times.when(share < cut, float(k))
    return times.otherwise(float(len(cuts)))


def tree_backtest(grid: DataFrame, keys: Sequence[str], demand: str, horizon: int, folds: int, trees: int = 10, depth: int = 5,
                  seed: int = 7) -> DataFrame:
    """The same test for one global random forest per cut-off: ``keys, method, mae, folds`` with method ``random_forest``.

    A row is a series at a day: its mean demand over the last 7, 28 and 91 days, its share of days with demand, the month; the label is the mean
    of the ``horizon`` days behind it. A cut-off learns from rows whose label lies before it and forecasts each series at
    the cut-off. Means are differences of running sums, so a row costs the same however long they reach back. Features are
    written once.

    A tree sees a feature as one of ``BINS`` bins and labels as sums. Every tree of a forest draws every row by itself, and what it draws is added up
    per cell of rows that agree in all bins; all cut-offs share the cells. So one pass over the rows serves all trees, which are then
    fitted one by one on cells with the drawn rows as weight.
    """
    order = Window.partitionBy(*keys).orderBy("day")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    value = F.col(demand).cast("double")
    sums = grid.select(*keys, "day", *[F.coalesce(F.sum(v).over(upto), F.lit(0.0)).alias(c) for c, v in (("__sum", value), ("__hits", (value > 0).cast("double")))],
                       F.count(value).over(upto).alias("__count"))
    back = lambda c, n: F.col(c) - F.coalesce(F.lag(c, n).over(order), F.lit(0))
    rows = sums.select(*keys, "day", *[(back("__sum", n) / n).alias(f"mean_{n}") for n in (7, 28, 91)], (back("__hits", 91) / 91).alias("busy"),
                       F.month("day").cast("double").alias("month"), back("__count", 91).alias("__known"),
                       (F.lead("__count", horizon).over(order) - F.col("__count")).alias("__ahead"),
                       ((F.lead("__sum", horizon).over(order) - F.col("__sum")) / horizon).alias("label"))
    inputs = ["mean_7", "mean_28", "mean_91", "busy", "month"]
    rows = materialise(rows.filter(f"__known = 91 AND __ahead = {horizon}"), "tree-features")
    first, last = rows.agg(F.min("day"), F.max("day")).first()
    folds = min(folds, (last - first).days // horizon) if last else 0
    if not folds:
        return rows.limit(0).select(*keys, F.lit("random_forest").alias("method"), F.col("label").alias("mae"), F.lit(0).cast("long").alias("folds"))
    behind = (F.datediff(F.lit(last), "day") / horizon).cast("int")  # learned from by cut-offs below this number
    with file_per_task(grid.sparkSession):
        binned = _binned(rows, rows.filter(behind >= folds), inputs)
        cells = _drawn_cells(binned.filter(behind > 0).withColumn("behind", F.least(behind, F.lit(folds))), keys, inputs, trees, seed)
    tests = binned.filter((F.datediff(F.lit(last), "day") % horizon == 0) & (behind < folds)).select(*keys, "label", *inputs, behind.alias("fold"))
    models = _bagged(cells, inputs, [(fold, tree) for fold in range(folds) for tree in range(trees)], depth, seed)
    parts = [_averaged(tests.filter(F.col("fold") == fold), inputs, [models[fold, tree] for tree in range(trees)])
             .select(*keys, F.abs(F.col("prediction") - F.col("label")).alias("error")) for fold in range(folds)]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.avg("error").alias("mae"), F.count("error").alias("folds")).select(
        *keys, F.lit("random_forest").alias("method"), "mae", "folds")


def _drawn_cells(known: DataFrame, keys: Sequence[str], inputs: Sequence[str], trees: int, seed: int) -> DataFrame:
    """Per cell of rows that agree in all ``inputs`` and ``behind``, how many rows each tree drew and the sum of their labels; one row per key and day."""
    drawn = known.select(*inputs, "behind", "label", *[_drawn([*keys, "day"], tree, seed).alias(f"n_{tree}") for tree in range(trees)])
    with small_methods(known.sparkSession):
        return materialise(drawn.groupBy(*inputs, "behind").agg(
            *[F.sum(f"n_{tree}").alias(f"n_{tree}") for tree in range(trees)],
            *[(F.sum(F.col(f"n_{tree}") * F.col("label"))).alias(f"sum_{tree}") for tree in range(trees)]), "tree-cells")


def _bagged(cells: DataFrame, inputs: Sequence[str], wanted: Sequence[tuple[int, int]], depth: int, seed: int) -> dict:
    """The tree of each ``(fold, tree)``, a few at a time: it weighs a cell by the rows that it drew there and learns their mean label."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    assembled = VectorAssembler(inputCols=list(inputs), outputCol="features")

    def fit(at: tuple[int, int]):
        fold, tree = at
        known = cells.filter((F.col("behind") > fold) & (F.col(f"n_{tree}") > 0)).select(
            *inputs, F.col(f"n_{tree}").alias("weight"), (F.col(f"sum_{tree}") / F.col(f"n_{tree}")).alias("label"))
        return RandomForestRegressor(numTrees=1, bootstrap=False, featureSubsetStrategy="onethird", maxDepth=depth, seed=seed * 1000 + tree,
                                     weightCol="weight").fit(assembled.transform(known))

    with ThreadPool(4) as pool:
        return dict(zip(wanted, pool.map(inheritable_thread_target(cells.sparkSession)(fit), wanted)))


def _averaged(rows: DataFrame, inputs: Sequence[str], models: Sequence) -> DataFrame:
    """``rows`` with the mean ``prediction`` of ``models``."""
    from pyspark.ml.feature import VectorAssembler

    out = VectorAssembler(inputCols=list(inputs), outputCol="features").transform(rows)
    for i, model in enumerate(models):
        out = model.copy({model.predictionCol: f"__tree_{i}"}).transform(out)
    return out.withColumn("prediction", reduce(lambda a, b: a + b, [F.col(f"__tree_{i}") for i in range(len(models))]) / len(models))


def _error(step: Column, fold: Column, horizon: int) -> Column:
    """Absolute error of a flat forecast ``step`` days behind the cut-off ``fold``, on rows of :func:`fold_forecasts`."""
    return F.abs(F.element_at("tail", (F.col("folds") - fold) * horizon + step) - F.get("at", fold))


def _radii(horizon: int, first: int, folds: int, level: float) -> Column:
    """Per step the conformal quantile of the errors of ``folds`` cut-offs from ``first``: the one of rank ``ceil((folds + 1) * level)``.

    Errors that are unknown, the day's demand being NULL, are left out.
    """
    rank = min(folds, math.ceil(round((folds + 1) * level, 9)))
    cuts = F.sequence(F.lit(first), F.lit(first + folds - 1))

    def quantile(errors: Column) -> Column:
        at = F.lit((rank - 1) / max(folds - 1, 1)) * (F.size(errors) - 1)
        low, high = F.get(errors, F.floor(at).cast("int")), F.get(errors, F.ceil(at).cast("int"))
        return low + (high - low) * (at - F.floor(at))

    return F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda step: bound(
        F.sort_array(F.array_compact(F.transform(cuts, lambda fold: _error(step, fold, horizon)))), quantile))


def _learned(tests: DataFrame, first: int, folds: int) -> DataFrame:
    """Rows of :func:`fold_forecasts` with forecasts behind all of ``folds`` cut-offs from ``first``."""
    enough = tests.filter(F.col("folds") >= first + folds - 1)
    return enough.filter(~F.exists(F.slice("at", F.lit(first + 1), F.lit(folds)), lambda x: x.isNull()))


def conformal_intervals(series: DataFrame, keys: Sequence[str], horizon: int = 30, folds: int = 19, level: float = 0.9,
                        methods: Sequence[str] = SMOOTHING) -> DataFrame:
    """``horizon`` days of each method's flat forecast, with split-conformal intervals.

    The errors of ``folds`` past cut-offs at the same step say how far a forecast errs; no distribution is assumed. Series
    too short for all cut-offs get no interval. All errors of a series and method are in one row, so none is shuffled.
    """
    tests = _learned(fold_forecasts(series, keys, horizon, folds, methods), 1, folds).filter(F.get("at", F.lit(0)).isNotNull())
    out = tests.select(*keys, "method", F.get("at", F.lit(0)).alias("forecast"), F.posexplode(_radii(horizon, 1, folds, level)).alias("__at", "radius"))
    return out.filter("radius IS NOT NULL").select(
        *keys, "method", (F.col("__at") + 1).alias("step"), "forecast", F.greatest(F.col("forecast") - F.col("radius"), F.lit(0.0)).alias("lower"),
        (F.col("forecast") + F.col("radius")).alias("upper"))


def conformal_coverage(series: DataFrame, keys: Sequence[str], horizon: int = 30, folds: int = 19, level: float = 0.9,
                       methods: Sequence[str] = SMOOTHING) -> DataFrame:
    """Per method how many of the last ``horizon`` days of all series lie inside the intervals that the ``folds`` cut-offs before give."""
    tests = _learned(fold_forecasts(series, keys, horizon, folds + 1, methods), 2, folds).filter(F.get("at", F.lit(1)).isNotNull())
    errors = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda step: _error(step, F.lit(1), horizon))
    held = tests.select("method", F.inline(F.arrays_zip(errors.alias("error"), _radii(horizon, 2, folds, level).alias("radius")))).filter("radius IS NOT NULL")
    return held.groupBy("method").agg(F.count(F.lit(1)).alias("days"), F.count_if(F.col("error") <= F.col("radius") + 1e-9).alias("covered"))


def shortlist(pattern: Column) -> Column:
    """The methods that suit a demand pattern."""
    return F.create_map(*[x for p, ms in PATTERN_MODELS.items() for x in (F.lit(p), F.array(*[F.lit(m) for m in ms]))])[pattern]


def model_selection(scores: DataFrame, patterns: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best method of each key within the shortlist of its demand pattern; ties go to the first name."""
    fit = scores.join(patterns.select(*keys, "pattern"), list(keys)).filter(
        F.array_contains(shortlist(F.col("pattern")), F.col("method")) & F.col("mae").isNotNull())
    best = fit.groupBy(*keys, "pattern").agg(F.min(F.struct("mae", "method")).alias("b"))
    return best.select(*keys, "pattern", F.col("b.method").alias("method"), F.col("b.mae").alias("mae"))


def forecast_interval(series: DataFrame, keys: Sequence[str], horizon: int = 30, z: float = SERVICE_Z[0.95],
                      alpha: float = 0.3) -> DataFrame:
    """``horizon`` days of a flat SES forecast with an interval from one-step residuals: ± z · σ · √h."""
    start = F.struct(F.element_at("series", 1).alias("l"), F.lit(0.0).alias("sq"), F.lit(0).alias("n"))

    def step(s: Column, x: Column) -> Column:
        e = x - s["l"]
        return F.struct((s["l"] + alpha * e).alias("l"), (s["sq"] + e * e).alias("sq"), (s["n"] + 1).alias("n"))

    fitted = series.select(*keys, F.aggregate(F.slice("series", F.lit(2), F.size("series")), start, step).alias("s"))
    sigma = F.sqrt(F.col("s.sq") / F.nullif(F.col("s.n"), F.lit(0)))
    days = fitted.select(*keys, F.col("s.l").alias("forecast"), sigma.alias("sigma"),
                         F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    reach = z * F.coalesce("sigma", F.lit(0.0)) * F.sqrt(F.col("step"))
    return days.select(*keys, "step", "forecast", F.greatest(F.col("forecast") - reach, F.lit(0.0)).alias("lower"),
                       (F.col("forecast") + reach).alias("upper"))


def lag_features(series: DataFrame, keys: Sequence[str], start: str = "start", lags: Sequence[int] = (1, 7, 14)) -> DataFrame:
    """Calendar and lag features of each day, for one global model over all series; ``start`` is the first day of a ``series``.

    A day looks its past up in the array of its series, so days are made one by one, neither sorted nor held, and cost no more than reading
    them would. Days with a NULL or NaN among their features are left out.
    """
    back = lambda n: F.get("series", F.col("__at") - n)
    week, day = [back(n) for n in range(7, 0, -1)], F.col("day")
    total = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0.0)) for x in week])
    size = reduce(lambda a, b: a + b, [F.when(x.isNull(), 0.0).otherwise(1.0) for x in week])
    longest, past = F.lit(max(*lags, 7)), {n: f"lag_{n}" for n in lags}
    days = series.select(*keys, "series", start, F.explode(F.when(F.size("series") > longest, F.sequence(longest, F.size("series") - 1))).alias("__at"))
    # The greatest of a week is NULL when no value is known and NaN when one is.
    out = days.filter(F.greatest(*week) <= math.inf).select(*keys, F.date_add(start, F.col("__at")).alias("day"), back(0).alias("label"),
                                                            (total / size).alias("mean_7"), *[back(n).alias(c) for n, c in past.items()])
    return out.select(*keys, "day", "label", F.dayofweek(day).cast("double").alias("weekday"), F.month(day).cast("double").alias("month"), "mean_7",
                      *past.values()).dropna(subset=[*keys, "label", *past.values()])


def tree_forecast(features: DataFrame, keys: Sequence[str], split: Column, kind: str = "random_forest",
                  seed: int = 7) -> DataFrame:
    """One global tree model over all series, trained before ``split`` and scored on the rest.

    Features are gone through three times, for bins, cells and forecasts, and not kept: give them as read from a table, or as :func:`lag_features`
    of written series. A task goes through the rows of one file. A tree sees a feature as one of ``BINS`` bins, parted by quantiles of
    all rows before ``split``, and squared errors through sums only, so rows that agree in all bins are one cell with their mean label and their number
    as weight. Training passes over cells, and their number does not follow that of the rows. Each tree of a forest draws
    every row by itself, as in :func:`tree_backtest`.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    if kind not in ("random_forest", "gbt"):
        raise ValueError(f"unknown model {kind}")
    inputs = [c for c in features.columns if c not in (*keys, "day", "label")]
    before = F.col("day") < split
    with file_per_task(features.sparkSession):
        binned = _binned(features, features.filter(before), inputs)
        known, tests = binned.filter(before), binned.filter(F.col("day") >= split)
        if kind == "random_forest":
            cells = _drawn_cells(known.withColumn("behind", F.lit(1)), keys, inputs, FOREST_TREES, seed)
        else:
            cells = materialise(known.groupBy(*inputs).agg(F.avg("label").alias("label"), F.count("label").cast("double").alias("weight")), "weighted")
    if kind == "random_forest":
        models = _bagged(cells, inputs, [(0, tree) for tree in range(FOREST_TREES)], 5, seed)
        scored = _averaged(tests, inputs, list(models.values()))
    else:
        assembler = VectorAssembler(inputCols=inputs, outputCol="features")
        scored = GBTRegressor(maxIter=20, maxDepth=4, seed=seed, weightCol="weight").fit(assembler.transform(cells)).transform(assembler.transform(tests))
    return scored.select(*keys, "day", "label", "prediction")


# -- stock parameters --------------------------------------------------------------------------------------

def service_factor(level: float | Column) -> Column:
    """Standard deviations that cover a share ``level`` of a normal demand: tabled values, any other level, or one per row."""
    if isinstance(level, Column):
        return normal_quantile(level)
    return F.lit(SERVICE_Z.get(level) or NormalDist().inv_cdf(level))


def replenishment(grid: DataFrame, keys: Sequence[str], demand: str, lead_days: float, service_level: float | Column = 0.95,
                  order_cost: float = 50.0, holding_cost: float = 2.0) -> DataFrame:
    """Safety stock ``z·σ·√L``, reorder point ``d·L + SS`` and EOQ ``√(2·D·K/h)`` with yearly demand D.

    ``service_level`` is any share below 1, or a column of ``keys`` for a level of each item.
    """
    z = service_factor(service_level)
    stats = grid.groupBy(*keys).agg(F.avg(demand).alias("daily_demand"), F.stddev_samp(demand).alias("demand_std"))
    safety = z * F.coalesce("demand_std", F.lit(0.0)) * lead_days ** 0.5
    return stats.select(*keys, "daily_demand", "demand_std", safety.alias("safety_stock"),
                        (F.col("daily_demand") * lead_days + safety).alias("reorder_point"),
                        F.sqrt(F.col("daily_demand") * (2.0 * 365.0 * order_cost / holding_cost)).alias("eoq"))


def abc_xyz(items: DataFrame, key: str, revenue: str, cv: str, abc: tuple[float, float] = ABC_CUTS,
            xyz: tuple[float, float] = XYZ_CUTS) -> DataFrame:
    """ABC by cumulative revenue share, XYZ by the coefficient of variation; one row per item in and out."""
    # Written once: the running share and the total would each work the items out again.
    shared = cumulative_share(materialise(items.select(key, revenue, cv), "items"), revenue, [key], "revenue_share")
    s, v = F.col("revenue_share"), F.col(cv)
    return shared.select(key, revenue, "revenue_share", F.col(cv),
                         F.when(s <= abc[0], "A").when(s <= abc[1], "B").otherwise("C").alias("abc_class"),
                         F.when(v <= xyz[0], "X").when(v <= xyz[1], "Y").otherwise("Z").alias("xyz_class"))
