"""Secret scans: rules are narrowed to candidate documents by an inverted index of trigrams, then verified in full.

1. Each rule's regular expression is read once, and what trigrams a match must contain is derived from it: alternatives, each
   a set of trigrams that must all be there, letters in lower case. Some expressions have none.
2. The index holds a posting ``(trigram, id)`` for every trigram of these queries that a text contains. It is a table.
3. Postings of one alternative are intersected by id: a document that has all of its trigrams is a candidate of the rule.
4. Candidates of a rule are searched for its spans; rules without trigrams search every text.

Only DataFrame functions are used. Positions are code points, ends exclusive; matches of a rule are leftmost and do not
overlap, and are found before short ones are dropped, as the pattern alone says. Whole texts are searched.

NULL and empty texts have no spans. Documents with a NULL id share one posting list entry, as those that repeat an id do;
verification is per row, so none gets another's spans. Only id and text are looked at; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.session import materialise

MAX_EXACT, MAX_ALTERNATIVES = 64, 64


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters. No look-around, no empty match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


_WORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = (
    Rule("assign", rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
ADDED = (
    Rule("forge_token", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("maps_key", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + ADDED

Alternatives = frozenset[frozenset[str]]
ANYTHING: Alternatives = frozenset([frozenset()])


def _of_words(words: frozenset[str]) -> Alternatives:
    return frozenset(frozenset(w[i : i + 3] for i in range(len(w) - 2)) for w in words)


def _both(a: Alternatives, b: Alternatives) -> Alternatives:
    if len(a) * len(b) > MAX_ALTERNATIVES:  # either alone is a weaker, still true condition
        return a if len(a) <= len(b) else b
    return frozenset(x | y for x in a for y in b)


def _read(parsed) -> tuple[frozenset[str] | None, Alternatives]:
    """All words that a parsed sequence can be, if few, else None; and the trigrams it must hold."""
    words, must = frozenset([""]), ANYTHING
    whole = True
    for op, value in parsed:
        exact, need = None, ANYTHING
        name = str(op)
        if name == "LITERAL":
            exact = frozenset([chr(value).lower()])
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            exact = frozenset(chr(c).lower() for _, c in value)
        elif name == "SUBPATTERN":
            exact, need = _read(value[-1])
        elif name == "BRANCH":
            parts = [_read(p) for p in value[1]]
            if all(e is not None for e, _ in parts):
                exact = frozenset().union(*(e for e, _ in parts))
            need = frozenset().union(*(_both(n, _of_words(e)) if e is not None else n for e, n in parts))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = value
            e, n = _read(inner)
            if (least, most) == (0, 1) and e is not None:
                exact = e | {""}
            elif least:
                need = _both(n, _of_words(e)) if e is not None else n
        if exact is not None and len(exact) * len(words) <= MAX_EXACT:
            words = frozenset(a + b for a in words for b in exact)
        else:
            must, words, whole = _both(must, _of_words(words)), frozenset([""]), False
            must = _both(must, need if exact is None else _of_words(exact))
    return (words, must) if whole else (None, _both(must, _of_words(words)))


def trigram_query(pattern: str) -> list[list[str]]:
    """Alternatives of trigrams, one of which every match must hold whole; empty where there is no such condition."""
    words, must = _read(re._parser.parse(pattern))
    must = _both(must, _of_words(words)) if words is not None else must
    least = [a for a in must if not any(b < a for b in must)]
    return [] if frozenset() in must else sorted(sorted(a) for a in least)


def build_index(docs: DataFrame, trigrams: list[str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(trigram, id)`` for every given trigram and document that holds it, in any case of letters."""
    low = F.lower(F.col(text_column))
    held = F.array_compact(F.array(*[F.when(low.contains(t), F.lit(t)) for t in trigrams]))
    return (docs.select(F.col(id_column).alias("id"), F.explode(held).alias("trigram")).select("trigram", "id")
            .sortWithinPartitions("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[list[str]]]) -> DataFrame:
    """``(id, kinds)``: the rules of which a document has all trigrams of some alternative."""
    rows = [(kind, n, t, 1 << i, (1 << len(a)) - 1) for kind, q in queries.items() for n, a in enumerate(q) for i, t in enumerate(a)]
    wanted = index.sparkSession.createDataFrame(rows, "kind string, n int, trigram string, bit bigint, full bigint")
    return (index.join(F.broadcast(wanted), "trigram").groupBy("id", "kind", "n", "full").agg(F.bit_or("bit").alias("has"))
            .filter("has = full").groupBy("id").agg(F.collect_set("kind").alias("kinds")))


def _spans(text: Column, number: int, rule: Rule) -> Column:
    """Every match as ``(start, number, end, kind)``: what lies between matches and the matches themselves, added up."""
    pattern = F.lit(rule.pattern)
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    span = "struct<start: bigint, number: int, end: bigint, kind: string>"
    pieces = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), F.arrays_zip(found.alias("m"), value.alias("v")),
                        lambda g, m: F.struct(F.length(g).cast("bigint").alias("gap"), F.length(m["m"]).cast("bigint").alias("size"),
                                              F.length(m["v"]).alias("chars")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(acc, p):
        begin = acc["at"] + p["gap"]
        end = begin + p["size"]
        one = F.array(F.struct(begin.alias("start"), F.lit(number).alias("number"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(p["chars"] >= rule.least, F.concat(acc["spans"], one)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(pieces, start, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, text, spans`` per row; spans are sorted by start, then in the order of the rules."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    if queries:
        trigrams = sorted({t for q in queries.values() for a in q for t in a})
        index = materialise(build_index(rows, trigrams, "id", "text"), "trigrams")
        found = materialise(candidates(index, queries).withColumnRenamed("id", "c_id"), "candidates")
        rows = rows.join(found, F.col("id").eqNullSafe(F.col("c_id")), "left")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start: bigint, number: int, end: bigint, kind: string>>")
    spans = []
    for i, r in enumerate(rules):
        rule, ask = r, F.lit(True)
        if re.fullmatch(r"\[[^\]]+\]\+", r.pattern):  # a run of one class: a long enough one is always a match of its own
            rule = Rule(r.kind, f"{r.pattern[:-1]}{{{r.least},}}")
            ask = F.rlike("text", F.lit(rule.pattern))
        if r.kind in queries:
            ask = F.coalesce(F.array_contains("kinds", r.kind), F.lit(False))
        spans.append(F.when(ask, _spans(F.col("text"), i, rule)).otherwise(none))
    return rows.select("id", "text", F.array_sort(reduce(lambda a, b: F.concat(a, b), spans)).alias("spans"))
