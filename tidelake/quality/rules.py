"""Validation rules compiled into few Spark jobs.

A rule is a mask that marks *invalid* rows. All row rules of a rule set become columns of one aggregate, so fifty
rules read the table once and only the columns they name. Uniqueness and referential rules need one grouped count
each. The outcome is a lazy DataFrame with one row per rule; scores and gates are computed from it.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field, replace
from enum import Enum
from functools import reduce
from typing import Any, Callable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.relate import orphan_counts
from tidelake.sinks.tables import quarantine_split


class Kind(str, Enum):
    NOT_NULL = "not_null"
    UNIQUE = "unique"
    RANGE = "range"
    PATTERN = "pattern"
    ALLOWED_VALUES = "allowed_values"
    REFERENTIAL = "referential"
    COMPLETENESS = "completeness"
    CUSTOM = "custom"
    FRESHNESS = "freshness"


class Severity(str, Enum):
    INFO = "info"
    WARNING = "warning"
    ERROR = "error"
    CRITICAL = "critical"


# Severity weights of the quality score, and defaults.
SEVERITY_WEIGHT = {"critical": 10, "error": 5, "warning": 2, "info": 1}
COMPLETENESS_THRESHOLD = 0.95
FRESHNESS_HOURS = 4
SAMPLE_SIZE = 5
COMPONENT_WEIGHT = {"completeness": 30, "validity": 30, "uniqueness": 20, "consistency": 20}

RESULT_SCHEMA = ("rule_name string, rule_type string, column_name string, severity string, passed boolean, "
                 "total_records bigint, valid_records bigint, invalid_records bigint, invalid_pct double, "
                 "message string")

Mask = Callable[[DataFrame], Column]


@dataclass(frozen=True)
class Rule:
    name: str
    kind: Kind
    columns: tuple[str, ...] = ()
    severity: Severity = Severity.ERROR
    params: Mapping[str, Any] = field(default_factory=dict)
    check: Mask | str | None = None
    """For CUSTOM: a function of the frame, or SQL text, that is true for valid rows."""

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(column: str, severity: Severity = Severity.CRITICAL, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_not_null", Kind.NOT_NULL, (column,), severity)


def unique(*columns: str, severity: Severity = Severity.ERROR, name: str | None = None) -> Rule:
    return Rule(name or f"{'_'.join(columns)}_unique", Kind.UNIQUE, columns, severity)


def in_range(column: str, low: Any = None, high: Any = None, severity: Severity = Severity.ERROR,
             name: str | None = None) -> Rule:
    return Rule(name or f"{column}_range", Kind.RANGE, (column,), severity, {"min": low, "max": high})


def matches(column: str, pattern: str, severity: Severity = Severity.ERROR, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_pattern", Kind.PATTERN, (column,), severity, {"pattern": pattern})


def allowed(column: str, values: Sequence[Any], severity: Severity = Severity.ERROR, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_allowed", Kind.ALLOWED_VALUES, (column,), severity, {"values": list(values)})


def references(column: str, reference: str, severity: Severity = Severity.ERROR, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_in_{reference}", Kind.REFERENTIAL, (column,), severity, {"reference": reference})


def complete(threshold: float = COMPLETENESS_THRESHOLD, severity: Severity = Severity.WARNING,
             name: str = "completeness") -> Rule:
    return Rule(name, Kind.COMPLETENESS, (), severity, {"threshold": threshold})


def custom(name: str, check: Mask | str, severity: Severity = Severity.ERROR) -> Rule:
    return Rule(name, Kind.CUSTOM, (), severity, {}, check)


def fresh(column: str, as_of: dt.datetime, hours: float = FRESHNESS_HOURS, severity: Severity = Severity.WARNING,
          name: str | None = None) -> Rule:
    return Rule(name or f"{column}_fresh", Kind.FRESHNESS, (column,), severity, {"as_of": as_of, "hours": hours})


def invalid_mask(rule: Rule, df: DataFrame) -> Column:
    """True for rows that break a row rule; false or NULL for rows that keep it.

    NULLs break NOT_NULL and PATTERN and are accepted by RANGE and ALLOWED_VALUES.
    """
    if rule.kind is Kind.CUSTOM:
        if rule.check is None:
            raise ValueError("a custom rule needs a check")
        valid = F.expr(rule.check) if isinstance(rule.check, str) else rule.check(df)
        return ~F.coalesce(valid, F.lit(False))
    c = F.col(rule.columns[0])
    if rule.kind is Kind.NOT_NULL:
        return c.isNull()
    if rule.kind is Kind.RANGE:
        low, high = rule.params.get("min"), rule.params.get("max")
        if low is not None and high is not None:
            return ~c.between(low, high)
        return c < low if low is not None else c > high if high is not None else F.lit(False)
    if rule.kind is Kind.PATTERN:
        return ~F.coalesce(c.cast("string").rlike(rule.params["pattern"]), F.lit(False))
    if rule.kind is Kind.ALLOWED_VALUES:
        return ~c.isin(rule.params["values"])
    raise ValueError(f"{rule.kind} is not a row rule")


ROW_KINDS = (Kind.NOT_NULL, Kind.RANGE, Kind.PATTERN, Kind.ALLOWED_VALUES, Kind.CUSTOM)


class RuleSet:
    """Rules for one table, and the reference tables its foreign keys point to."""

    def __init__(self, table: str, rules: Sequence[Rule] = ()):
        self.table = table
        self.rules = list(rules)
        self.references: dict[str, tuple[DataFrame, str]] = {}

    def add(self, *rules: Rule) -> "RuleSet":
        self.rules += rules
        return self

    def reference(self, name: str, df: DataFrame, column: str) -> "RuleSet":
        self.references[name] = (df, column)
        return self

    def reference_values(self, name: str, df: DataFrame, values: Sequence[Any]) -> "RuleSet":
        """A short literal list as a reference."""
        frame = df.sparkSession.createDataFrame([(v,) for v in values], ["value"])
        return self.reference(name, frame, "value")

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> "RuleSet":
        """Rules from a mapping (parsed JSON or YAML).

        ``not_null`` and ``positive`` list columns, ``unique`` lists keys, ``referential`` maps columns to
        references, ``range``/``pattern``/``allowed_values`` map columns to arguments and ``sql`` maps names to
        conditions.
        """
        out = cls(config.get("table", "table"))
        out.add(*[not_null(c) for c in config.get("not_null", [])])
        out.add(*[in_range(c, 0, name=f"{c}_positive") for c in config.get("positive", [])])
        for key in config.get("unique", []):
            out.add(unique(*([key] if isinstance(key, str) else key)))
        out.add(*[in_range(c, *bounds) for c, bounds in config.get("range", {}).items()])
        out.add(*[matches(c, p) for c, p in config.get("pattern", {}).items()])
        out.add(*[allowed(c, v) for c, v in config.get("allowed_values", {}).items()])
        out.add(*[references(c, r) for c, r in config.get("referential", {}).items()])
        out.add(*[custom(n, s) for n, s in config.get("sql", {}).items()])
        return out

    def named(self) -> list[Rule]:
        """The rules, those that repeat a name told apart by a number: ``q_range``, ``q_range_2``."""
        taken, out = {r.name for r in self.rules}, []
        seen: set[str] = set()
        for rule in self.rules:
            name, n = rule.name, 1
            while name in seen or (n > 1 and name in taken):
                n += 1
                name = f"{rule.name}_{n}"
            seen.add(name)
            out.append(replace(rule, name=name))
        return out

    # -- evaluation ----------------------------------------------------------------------------------------

    def results(self, df: DataFrame) -> DataFrame:
        """One row per rule. A rule that cannot be analysed fails with its error; the others still run."""
        shared, single, broken = [], [], []
        masks, suspects = self._resolve(df)
        for rule in self.named():
            try:
                if rule.name in suspects:
                    df.select(masks[rule.name])  # raises, and says why
                if rule.kind is Kind.UNIQUE:
                    single.append((rule, self._unique(rule, df)))
                elif rule.kind is Kind.REFERENTIAL:
                    single.append((rule, self._referential(rule, df)))
                else:
                    shared.append((rule, *self._aggregates(rule, df, masks.get(rule.name))))
            except (PySparkException, ValueError, KeyError) as error:
                broken.append((rule, str(error).splitlines()[0]))
        frames = [self._shared(df, shared, broken)] if shared or broken else []
        frames += [_rows([rule], one.select("n", F.lit(0).alias("pos"), "i", F.lit(None).cast("boolean").alias("p")))
                   for rule, one in single]
        if not frames:
            return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
        return reduce(DataFrame.unionByName, frames)

    def _resolve(self, df: DataFrame) -> tuple[dict[str, Column], set[str]]:
        """Masks of the row rules, and the names to look at one by one: none when all can be analysed together."""
        masks = {}
        for rule in self.named():
            if rule.kind in ROW_KINDS:
                try:
                    masks[rule.name] = invalid_mask(rule, df)
                except (PySparkException, ValueError, KeyError):
                    continue
        try:
            df.select(*masks.values())
            return masks, set()
        except PySparkException:
            return masks, set(masks)

    @staticmethod
    def _aggregates(rule: Rule, df: DataFrame, mask: Column | None) -> tuple[Column, Column | None]:
        """(invalid rows, pass test where it is not simply "none invalid") as aggregate expressions."""
        n = F.count(F.lit(1))
        if rule.kind is Kind.COMPLETENESS:
            filled = reduce(lambda a, b: a + b, [F.count(F.col(c)) for c in df.columns])
            ratio = F.coalesce(F.try_divide(filled, n * len(df.columns)), F.lit(0.0))
            return n - F.floor(ratio * n), ratio >= rule.params["threshold"]
        if rule.kind is Kind.FRESHNESS:
            df.select(rule.columns[0])
            limit = rule.params["as_of"] - dt.timedelta(hours=rule.params["hours"])
            newest = F.max(F.col(rule.columns[0]).cast("timestamp_ntz"))
            stale = F.coalesce(newest < F.lit(str(limit)).cast("timestamp_ntz"), F.lit(True))
            return F.when(stale, n).otherwise(0), ~stale
        return F.count_if(mask if mask is not None else invalid_mask(rule, df)), None

    @staticmethod
    def _shared(df: DataFrame, rules: Sequence[tuple], broken: Sequence[tuple]) -> DataFrame:
        exprs, unknown = [F.count(F.lit(1)).alias("n")], "CAST(NULL AS BOOLEAN)"
        for i, (_, invalid, test) in enumerate(rules):
            exprs.append(invalid.cast("long").alias(f"i{i}"))
            if test is not None:
                exprs.append(test.alias(f"p{i}"))
        one = df.agg(*exprs)
        cells = [f"struct(i{i} AS i, {unknown if test is None else f'p{i}'} AS p)" for i, (_, _, test) in enumerate(rules)]
        cells += ["struct(n AS i, false AS p)" for _ in broken]
        flat = one.select("n", F.expr(f"posexplode(array({', '.join(cells)}))").alias("pos", "c")).select("n", "pos", "c.i", "c.p")
        return _rows([r[0] for r in rules] + [b[0] for b in broken], flat, {len(rules) + k: m for k, (_, m) in enumerate(broken)})

    @staticmethod
    def _unique(rule: Rule, df: DataFrame) -> DataFrame:
        counts = df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("c"))
        zero = F.lit(0).cast("long")
        return counts.agg(F.coalesce(F.sum("c"), zero).alias("n"), F.coalesce(F.sum(F.col("c") - 1), zero).alias("i"))

    def _referential(self, rule: Rule, df: DataFrame) -> DataFrame:
        name = rule.params["reference"]
        if name not in self.references:
            raise ValueError(f"unknown reference {name}")
        reference, column = self.references[name]
        return orphan_counts(df, rule.columns[0], reference, column).select(
            F.col("total").alias("n"), F.col("orphans").alias("i"))

    def samples(self, df: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
        """Lowest distinct offending values of the single-column row rules: ``rule_name, sample_invalid``.

        One scan for all rules: violations are stacked as (rule, value), equal ones melt together before the shuffle, and
        each task hands on ``size`` values per rule. Values are ordered as their column orders them.
        """
        ranked, text = self._offending(df, size), F.col("shown")
        return ranked.select("rule_name", text.alias("sample_invalid"))

    def _offending(self, df: DataFrame, size: int) -> DataFrame:
        """``rule_name, nth, shown``: the lowest distinct offending values, NULL left out."""
        rules = [r for r in self.named() if r.kind in (Kind.RANGE, Kind.PATTERN, Kind.ALLOWED_VALUES)]
        if not rules:
            return df.sparkSession.createDataFrame([], "rule_name string, nth int, shown string")
        columns = sorted({r.columns[0] for r in rules})
        # One field per column keeps the type, and so the order, of each value.
        none = {c: F.lit(None).cast(df.schema[c].dataType) for c in columns}
        cells = [F.when(invalid_mask(r, df) & F.col(r.columns[0]).isNotNull(), F.struct(
            F.lit(r.name).alias("rule_name"), *[(F.col(c) if c == r.columns[0] else none[c]).alias(f"v{i}") for i, c in enumerate(columns)]))
            for r in rules]
        stacked = df.select(F.inline(F.array_compact(F.array(*cells)))).distinct()
        places = [f"v{i}" for i in range(len(columns))]
        order = Window.partitionBy("rule_name").orderBy(*places)
        first = stacked.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= size)
        return first.select("rule_name", "nth", F.coalesce(*[F.col(p).cast("string") for p in places]).alias("shown"))

    def results_with_samples(self, df: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
        """The results, with ``sample_invalid``: up to ``size`` offending values of each rule, lowest first."""
        found = self._offending(df, size).groupBy("rule_name").agg(F.sort_array(F.collect_list(F.struct("nth", "shown"))).alias("s"))
        shown = found.select("rule_name", F.transform("s", lambda x: x["shown"]).alias("sample_invalid"))
        return self.results(df).join(shown, "rule_name", "left").withColumn(
            "sample_invalid", F.coalesce("sample_invalid", F.array().cast("array<string>")))

    def masks(self, df: DataFrame) -> dict[str, Column]:
        return {r.name: invalid_mask(r, df) for r in self.named() if r.kind in ROW_KINDS}

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Good rows, and quarantined rows with the names of the row rules they break."""
        return quarantine_split(df, self.masks(df))


def _rows(rules: Sequence[Rule], flat: DataFrame, messages: Mapping[int, str] | None = None) -> DataFrame:
    """Result rows from ``(n, pos, i, p)``: the rule texts are constant arrays indexed by position."""
    messages = messages or {}

    def text(values: Sequence[str | None]) -> Column:
        return F.get(F.from_json(F.lit(json.dumps(list(values))), "array<string>"), F.col("pos"))

    n, invalid = F.col("n"), F.col("i")
    error = text([messages.get(k) for k in range(len(rules))])
    share = F.coalesce(F.try_divide(invalid * 100.0, n), F.when(error.isNull(), 0.0).otherwise(100.0))
    return flat.select(
        text([r.name for r in rules]).alias("rule_name"), text([r.kind.value for r in rules]).alias("rule_type"),
        text([r.label for r in rules]).alias("column_name"), text([r.severity.value for r in rules]).alias("severity"),
        F.coalesce(F.col("p"), invalid == 0).alias("passed"), n.alias("total_records"),
        (n - invalid).alias("valid_records"), invalid.alias("invalid_records"), share.alias("invalid_pct"),
        F.coalesce(error, F.format_string("%d of %d rows invalid", invalid, n)).alias("message"))


# -- reports -----------------------------------------------------------------------------------------------

def _weight(severity: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in SEVERITY_WEIGHT.items() for x in item])
    return table[severity].cast("double")


def report(results: DataFrame) -> DataFrame:
    """Rules passed and failed, failures by severity, and the weighted quality score, as one row.

    An empty table scores 0; a rule set without rules scores 1.
    """
    failed = ~F.col("passed")

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, F.lit(1)))

    weight = _weight(F.col("severity"))
    share = F.coalesce(F.try_divide(F.col("valid_records"), F.col("total_records")), F.lit(0.0))
    score = F.coalesce(F.sum(weight * share) / F.nullif(F.sum(weight), F.lit(0.0)), F.lit(1.0))
    return results.agg(
        F.count(F.lit(1)).alias("total_rules"), count(F.col("passed")).alias("passed_rules"),
        count(failed).alias("failed_rules"),
        count(failed & (F.col("severity") == "critical")).alias("critical_failures"),
        count(failed & (F.col("severity") == "error")).alias("error_failures"),
        count(failed & (F.col("severity") == "warning")).alias("warning_failures"),
        score.alias("quality_score"))


def component_score(results: DataFrame) -> DataFrame:
    """Completeness 30, validity 30, uniqueness 20, consistency 20: mean valid share per part, absent parts full."""
    part = (F.when(F.col("rule_type").isin("not_null", "completeness"), "completeness")
            .when(F.col("rule_type") == "unique", "uniqueness")
            .when(F.col("rule_type").isin("referential", "custom"), "consistency").otherwise("validity"))
    share = F.coalesce(F.try_divide(F.col("valid_records"), F.col("total_records")), F.lit(0.0))
    means = [F.coalesce(F.avg(F.when(part == p, share)), F.lit(1.0)) for p in COMPONENT_WEIGHT]
    total = reduce(lambda a, b: a + b, [m * w for m, w in zip(means, COMPONENT_WEIGHT.values())])
    return results.agg(*[m.alias(p) for m, p in zip(means, COMPONENT_WEIGHT)], total.alias("score"))


def quick_validate(df: DataFrame, not_null_columns: Sequence[str] = (), unique_key: Sequence[str] = (),
                   positive: Sequence[str] = ()) -> DataFrame:
    rules = RuleSet("quick").add(*[not_null(c) for c in not_null_columns])
    if unique_key:
        rules.add(unique(*unique_key))
    return rules.add(*[in_range(c, 0, name=f"{c}_positive") for c in positive]).results(df)


class QualityGateError(RuntimeError):
    """A critical rule failed and the gate blocks."""


def gate(results: DataFrame, fail_on_critical: bool = True) -> str:
    """``raise`` on a critical failure, else ``quarantine`` on errors, ``warn`` on warnings, ``pass`` otherwise.

    Only one aggregated row reaches the driver.
    """
    row = report(results).first()
    if row["critical_failures"]:
        if fail_on_critical:
            raise QualityGateError(f"{row['critical_failures']} critical rules failed, score {row['quality_score']:.3f}")
        return "quarantine"
    if row["error_failures"]:
        return "quarantine"
    return "warn" if row["failed_rules"] else "pass"


# What a failed check does in each tier, in rising order of consequence.
TIER_POLICY = {1: "block", 2: "flag", 3: "alert"}
ACTIONS = ("pass", "alert", "flag", "block")


def tier_actions(findings: DataFrame, policy: Mapping[int, str] = TIER_POLICY) -> DataFrame:
    """What each tier's findings lead to: one row per tier of ``policy`` with its findings, affected records and action."""
    unknown = set(policy.values()) - set(ACTIONS)
    if unknown:
        raise ValueError(f"unknown actions {sorted(unknown)}")
    tiers = findings.sparkSession.createDataFrame([(t, a) for t, a in sorted(policy.items())], "tier int, on_finding string")
    per_tier = findings.groupBy("tier").agg(F.count(F.lit(1)).alias("findings"), F.sum("affected_records").alias("affected_records"))
    zero = F.lit(0).cast("long")
    out = tiers.join(per_tier, "tier", "left").withColumns({c: F.coalesce(c, zero) for c in ("findings", "affected_records")})
    return out.select("tier", "findings", "affected_records", F.when(F.col("findings") > 0, F.col("on_finding")).otherwise("pass").alias("action"))


def gate_tiers(findings: DataFrame, policy: Mapping[int, str] = TIER_POLICY) -> str:
    """The gravest action of all tiers; ``block`` raises. Only one row per tier reaches the driver."""
    rows = tier_actions(findings, policy).collect()
    worst = max((r["action"] for r in rows), key=ACTIONS.index, default="pass")
    if worst == "block":
        raise QualityGateError("; ".join(f"tier {r['tier']}: {r['findings']} findings" for r in rows if r["action"] == "block"))
    return worst


def rules_to_json(rules: RuleSet) -> str:
    return json.dumps([{"name": r.name, "kind": r.kind.value, "columns": list(r.columns),
                        "severity": r.severity.value, "params": dict(r.params)} for r in rules.rules], default=str)
