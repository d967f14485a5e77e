"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Targets: sources share ``total`` times all words by weight; none gets more than ``cap`` times its own words, and what is
over goes to the others by weight until none is above (a filling of levels, solved in one ordered pass over sources).

Rates: among all rates that give a source its target, the closest to equal ones in relative entropy are exponentially
tilted, ``min(cap, exp(lambda * size))``. The dual is convex with one multiplier per source; Newton steps on the logarithm of
the source's tilted total find it, with a bracket against overshooting. Documents are first counted per source and size;
each step is one pass over these counts, adding whole numbers, so reruns agree to the last digit.

Copies: a rate's whole part is taken for certain. Its fraction f competes: documents in the order of u / f, with u
a hash of the id, get one copy more while their words fit the rest of the target (sequential Poisson sampling). The place
where the rest is used up is found from sums per bin, twice. What then remains goes to the documents behind it, in rounds
that about halve it: to the largest that fits, where that leaves at most half; else those that are too large are passed
over and the cut is repeated. When none fits, the one nearest in size is taken if that brings the source nearer to its
target. No source, however large,
is ordered or gathered in one task, and documents meet one row per source, besides groups of a repeated id that were
passed over, if there are any.

A text's size is its number of words. NULL and empty texts have size 0 and take nothing; as rows they stay
(one copy). NULL is a source of its own, the last. Documents with a NULL id take part (their u is the same, so they go
together, as rows of one id and size do). An empty table gives an empty result. Input columns stay as they are, inside ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.session import materialise

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
CAP = 2
STEPS = 40
BINS = 1024
#: Rates become whole numbers of this unit before they are added up.
UNIT = 1_000_000


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` from ``source, size``; one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight)
    # Sources in the order in which they reach their cap; a source is capped if its share of what is left is above it.
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * total - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") > cap * F.col("source_size"))
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), F.col("level")))).over(everything)
    return per.select("source", "source_size",
                      F.when(F.col("capped"), (cap * F.col("source_size")).cast("double"))
                      .otherwise(free.getField("level") * F.col("weight")).alias("target"))


def _rate(tilt: Column, size: Column, scale: Column, cap: int) -> Column:
    """min(cap, exp(tilt * size / scale)); an infinite tilt is the cap itself."""
    power = tilt * size / scale
    return F.when(power >= F.lit(float(cap)), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), F.exp(power)))


def tilts(counts: DataFrame, per_source: DataFrame, cap: int = CAP, steps: int = STEPS) -> DataFrame:
    """``source, source_size, target, scale, tilt`` by Newton steps over ``source, size, n``."""
    mean = counts.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"))
    full = F.col("target") >= cap * F.col("source_size") - 0.5
    state = per_source.join(mean, per_source["source"].eqNullSafe(mean["source"])).select(
        per_source["source"], "source_size", "target", F.greatest("scale", F.lit(1e-9)).alias("scale"),
        F.when(full, F.lit(1e9)).otherwise(F.log(F.greatest(F.col("target") / F.greatest("source_size", F.lit(1)), F.lit(1e-9))))
        .alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), full.alias("done"))
    state = materialise(state, "mix-state")
    for _ in range(steps):
        open_ = state.filter("NOT done")
        if open_.isEmpty():
            break
        x, rate = F.col("size") / F.col("scale"), _rate(F.col("tilt"), F.col("size"), F.col("scale"), cap)
        words = (F.round(rate * UNIT).cast("decimal(19,0)") * (F.col("n") * F.col("size")))
        slope = F.when(rate < cap, F.round(rate * x * UNIT).cast("decimal(19,0)") * (F.col("n") * F.col("size"))).otherwise(0)
        c, o = counts.alias("c"), open_.alias("o")
        sums = (c.join(o, F.col("c.source").eqNullSafe(F.col("o.source")))
                .select(F.col("c.source").alias("source"), words.alias("words"), slope.alias("slope"))
                .groupBy("source").agg((F.sum("words").cast("double") / UNIT).alias("words"),
                                       (F.sum("slope").cast("double") / UNIT).alias("slope")))
        s, m = state.alias("s"), sums.alias("m")
        got = F.greatest(F.col("words"), F.lit(1e-9))
        low = F.when(got < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(got < F.col("target"), F.col("high")).otherwise(F.col("tilt"))
        newton = F.col("tilt") + F.log(F.col("target") / got) * got / F.greatest("slope", F.lit(1e-9))
        close = F.abs(got - F.col("target")) <= F.greatest(F.lit(0.5), 1e-6 * F.col("target"))
        bounded = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        moved = F.col("words").isNotNull()
        state = materialise(
            s.join(m, F.col("s.source").eqNullSafe(F.col("m.source")), "left").select(
                "s.source", "source_size", "target", "scale", F.when(moved & ~close, bounded).otherwise(F.col("tilt")).alias("tilt"),
                F.when(moved, low).otherwise(F.col("low")).alias("low"),
                F.when(moved, high).otherwise(F.col("high")).alias("high"),
                (F.col("done") | F.coalesce(close, F.lit(False))).alias("done")), "mix-state")
    return state.select("source", "source_size", "target", "scale", "tilt")


def _cut(docs: DataFrame, rest: DataFrame, level: Column, name: str) -> DataFrame:
    """Per source the bins of ``level`` that fit ``rest`` from below, the next bin, and what then is left."""
    d, r = docs.alias("d"), rest.alias("r")
    binned = (d.join(r, F.col("d.source").eqNullSafe(F.col("r.source"))).filter(level.isNotNull())
              .groupBy(F.col("d.source").alias("source"), level.alias("bin")).agg(F.sum("size").alias("words")))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    b = binned.withColumn("upto", upto).alias("b")
    fits = F.col("upto") <= F.col("r.rest")
    found = (b.join(r, F.col("b.source").eqNullSafe(F.col("r.source"))).groupBy(F.col("b.source").alias("source")).agg(
        F.min(F.when(~fits, F.col("bin"))).alias(name), F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("used")))
    f = found.alias("f")
    return r.join(f, F.col("r.source").eqNullSafe(F.col("f.source")), "left").select(
        *[F.col(f"r.{c}").alias(c) for c in rest.columns if c != "rest"],
        F.coalesce(F.col(f"f.{name}"), F.lit(BINS)).alias(name),
        (F.col("r.rest") - F.coalesce("f.used", F.lit(0))).alias("rest"))


def _fill(plan: DataFrame, rest: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Use up what ``rest`` has left after the cut at ``coarse`` and ``fine``.

    Rows of one source, id and size are taken together. ``rest`` comes back with what each source takes besides:
    ``filled``, single (id, size), and ``spans`` of ``at``, in which sizes up to ``limit`` are taken. The second frame has
    the (source, id, size) in spans whose rows are too many to fit, None if there is none.
    """
    kind = plan.schema["id"].dataType.simpleString()
    rest = rest.select("*", ((F.col("coarse") * BINS + F.col("fine")) * BINS).alias("start"), F.lit(False).alias("stuck"),
                       F.expr(f"CAST(array() AS array<struct<size: bigint, id: {kind}>>)").alias("filled"),
                       F.expr("CAST(array() AS array<struct<lo: bigint, hi: bigint, limit: bigint>>)").alias("spans"))
    rest = materialise(rest, "mix-rest")

    def behind(rows: DataFrame, rest: DataFrame) -> DataFrame:
        g, r = rows.alias("g"), rest.alias("r")
        return g.join(r, F.col("g.source").eqNullSafe(F.col("r.source"))).filter(
            (F.col("at") >= F.col("start"))
            & ~F.exists("filled", lambda x: x["id"].eqNullSafe(F.col("g.id")) & (x["size"] == F.col("g.size"))))

    open_ = behind(plan, rest).groupBy(*[F.col(f"g.{c}").alias(c) for c in ("source", "id", "size", "at")]).agg(
        F.sum("g.size").alias("words"))
    open_ = materialise(open_, "mix-open")
    repeated = open_.filter("words > size")
    any_repeated, passed = not repeated.isEmpty(), None
    while True:
        gap = F.abs(F.col("rest") - F.col("words"))
        best = behind(open_, rest).filter("words < 2 * rest").groupBy(F.col("g.source").alias("source")).agg(
            F.min(F.struct(gap.alias("gap"), "id", "size", "words")).alias("near"),
            F.max(F.when(F.col("words") <= F.col("rest"), F.struct("words", "id", "size"))).alias("under"))
        r, b = rest.alias("r"), best.alias("b")
        near, under = (F.struct(*[F.col(f"b.{k}.{c}").alias(c) for c in ("id", "size", "words")]) for k in ("near", "under"))
        pick = (F.when((2 * F.col("b.under.words") >= F.col("r.rest")) | (F.col("b.under").isNotNull() & F.col("r.stuck")), under)
                .when(F.col("b.near").isNotNull() & F.col("b.under").isNull(), near))
        moved = materialise(r.join(b, F.col("r.source").eqNullSafe(F.col("b.source")), "left").select(
            *[F.col(f"r.{c}").alias(c) for c in rest.columns], F.col("b.near").isNotNull().alias("found"), pick.alias("pick")), "mix-round")
        found, cutting = moved.agg(F.max("found"), F.max(F.col("found") & F.col("pick").isNull())).first()
        if not found:
            return rest, passed
        taken = moved.filter("pick IS NOT NULL OR NOT found").select(
            *[F.col(c) for c in rest.columns if c not in ("rest", "stuck", "filled")], F.lit(False).alias("stuck"),
            (F.col("rest") - F.coalesce("pick.words", F.lit(0))).alias("rest"),
            F.when(F.col("pick").isNull(), F.col("filled")).otherwise(F.concat("filled", F.array(F.struct(
                F.col("pick.size").alias("size"), F.col("pick.id").alias("id"))))).alias("filled"))
        if cutting:
            todo = moved.filter("found AND pick IS NULL").select(*rest.columns, F.col("rest").alias("limit"))
            fitting = materialise(behind(open_, todo).filter("words <= rest").select("g.source", F.col("words").alias("size"), "at"),
                                  "mix-fitting")
            first, second, third = F.floor(F.col("at") / (BINS * BINS)), F.floor(F.col("at") / BINS) % BINS, F.col("at") % BINS
            cut = materialise(_cut(fitting, todo, first, "first"), "mix-cut")
            cut = materialise(_cut(fitting, cut, F.when(first == F.col("first"), second), "second"), "mix-cut")
            cut = materialise(_cut(fitting, cut, F.when((first == F.col("first")) & (second == F.col("second")), third), "third"), "mix-cut")
            end = (F.col("first") * BINS + F.col("second")) * BINS + F.col("third")
            if any_repeated:
                over = behind(repeated, cut.withColumn("end", end)).filter(
                    "at < end AND size <= limit AND words > limit").select("g.source", "g.id", "g.size")
                passed = materialise(over if passed is None else passed.unionByName(over), "mix-passed")
            span = F.struct(F.col("start").alias("lo"), end.alias("hi"), F.col("limit").alias("limit"))
            taken = taken.unionByName(cut.select(
                *[c for c in rest.columns if c not in ("start", "stuck", "spans")], end.alias("start"),
                (F.col("rest") == F.col("limit")).alias("stuck"), F.concat("spans", F.array(span)).alias("spans")))
        rest = materialise(taken, "mix-rest")


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights=WEIGHTS, total: float = TOTAL, cap: int = CAP) -> DataFrame:
    """``row, size, source_size, target, copies``: every row of ``docs`` and how often the mix takes it."""
    parts = [F.col(id_column).alias("id"), n_words(F.col(text_column)).alias("size"), F.col(source_column).alias("source")]
    sizes = materialise(docs.select(*parts), "mix-sizes")
    counts = materialise(sizes.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    per = tilts(counts, materialise(targets(sizes, weights, total, cap), "mix-targets"), cap)

    def planned(rows: DataFrame, id_: Column, size: Column, source: Column, per: DataFrame) -> DataFrame:
        """``rows`` with base copies and the order of the fractions: ``step`` below ``BINS ** 2``, NULL without one,
        and ``at``, which parts the rows of a step by another hash."""
        p = per.select(*[F.col(c).alias(f"p_{c}") for c in per.columns])
        rate = _rate(F.col("p_tilt"), size, F.col("p_scale"), cap)
        base = F.floor(rate + 1e-9)
        fraction = F.greatest(rate - base, F.lit(0.0))
        u = (F.pmod(F.xxhash64(id_, F.lit("mix")), F.lit(1 << 40)) + 1) / F.lit(float((1 << 40) + 1))
        order = u / (u + fraction)
        step = F.when((fraction > 1e-9) & (size > 0), F.least(F.floor(order * BINS * BINS), F.lit(BINS * BINS - 1)))
        at = step * BINS + F.pmod(F.xxhash64(id_, size, F.lit("tie")), F.lit(BINS))
        return (rows.join(p, source.eqNullSafe(F.col("p_source")))
                .withColumns({"base": F.when(size > 0, base).otherwise(0), "step": step, "at": at}))

    plan = planned(sizes, F.col("id"), F.col("size"), F.col("source"), per).select("id", "size", "source", "base", "step", "at")
    plan = materialise(plan, "mix-plan")
    taken = plan.groupBy("source").agg(F.sum(F.col("base") * F.col("size")).alias("sure"))
    a, t = per.alias("a"), taken.alias("t")
    rest = a.join(t, F.col("a.source").eqNullSafe(F.col("t.source")), "left").select(
        *[F.col(f"a.{c}").alias(c) for c in per.columns],
        F.floor(F.col("target") + 0.5 - F.coalesce("sure", F.lit(0))).alias("rest"))
    coarse, fine = F.floor(F.col("step") / BINS), F.col("step") % BINS
    rest = materialise(_cut(plan, rest, coarse, "coarse"), "mix-rest")
    rest = materialise(_cut(plan, rest, F.when(coarse == F.col("coarse"), fine), "fine"), "mix-rest")
    rest, passed = _fill(plan.filter(F.col("step").isNotNull() & (F.col("base") < cap)), rest)
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).withColumn(
        "size", n_words(F.col(f"row.{text_column}")))
    id_, source = F.col(f"row.{id_column}"), F.col(f"row.{source_column}")
    final = planned(row, id_, F.col("size"), source, rest)
    coarse, fine = F.floor(F.col("step") / BINS), F.col("step") % BINS
    cut = (coarse < F.col("p_coarse")) | ((coarse == F.col("p_coarse")) & (fine < F.col("p_fine")))
    fill = F.exists("p_filled", lambda x: x["id"].eqNullSafe(id_) & (x["size"] == F.col("size")))
    span = F.exists("p_spans", lambda x: (F.col("at") >= x["lo"]) & (F.col("at") < x["hi"]) & (F.col("size") <= x["limit"]))
    if passed is not None:
        x = passed.select(*[F.col(c).alias(f"x_{c}") for c in ("source", "id", "size")], F.lit(True).alias("x_passed"))
        final = final.join(x, source.eqNullSafe(F.col("x_source")) & id_.eqNullSafe(F.col("x_id"))
                           & (F.col("size") == F.col("x_size")), "left")
        span = span & F.col("x_passed").isNull()
    more = F.col("step").isNotNull() & (F.col("base") < cap) & (fill | span)
    extra = F.coalesce(cut | more, F.lit(False)).cast("int")
    return final.select("row", "size", F.col("p_source_size").alias("source_size"), F.col("p_target").alias("target"),
                        F.when(F.col("size") > 0, F.col("base") + extra).otherwise(1).cast("int").alias("copies"))
