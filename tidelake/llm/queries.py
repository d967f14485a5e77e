"""The registered queries of this folder: one per operator, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import (bpe, collocations, line_dedup, mixing, near_dup, packing, quality_rules, secrets, token_cache, topk, toxicity,
                          warc, whitening)
from tidelake.session import configure, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            folder = sf_dir.rstrip("/")
            return fn(lambda name: configure(spark).read.parquet(f"{folder}/{name}.parquet"))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op8_quality_rules(table):
    """Counts, the base rules and the likelihood verdict for every document."""
    docs = table("documents")
    verdict = quality_rules.judge(docs, table("labels"))
    return docs.select("doc_id", verdict("text").alias("v")).select(
        "doc_id", *[f"v.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                                       "kept", "score")])


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(f"""
WITH lines AS (
    SELECT doc_id, r, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                         '{UPPER}', '{LOWER}') AS k
    FROM (SELECT doc_id, r, unnest(ls) AS line, unnest(range(len(ls))) AS i
          FROM (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
held AS (SELECT k, min(doc_id) AS keeper FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> l.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR keeper = l.doc_id), '')) AS kept_sha256
FROM lines l LEFT JOIN held h ON l.k = h.k GROUP BY r, l.doc_id""")
def op3_line_dedup(table):
    """Every document without the lines that an earlier one holds."""
    return line_dedup.dedup_lines(table("documents")).select(
        "row.doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


def byte_bpe_50k():
    path = public_tokenizers.path
    return packing.byte_bpe(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def op9_harmonic_packing(table):
    """Every document in sequences of at most 1024 tokens."""
    return packing.pack(table("documents"), byte_bpe_50k())


@query()
def op10_token_counts(table):
    """Tokens of every document. The cache starts empty here, so that every run does the whole work."""
    docs, model = table("documents"), public_tokenizers.path("piece_bpe_32k.model")
    return token_cache.count_tokens(docs, token_cache.counter_of(model), token_cache.file_version(model),
                                    scratch(docs.sparkSession, "token-cache"))


@query()
def op1_mix(table):
    """All documents mixed to 150 percent of their words, sources weighing 3, 1, 2 in turn."""
    return mixing.mix(table("documents")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT payload_digest AS k, max(page_id) AS top FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM d LEFT JOIN g ON k = payload_digest""")
def op4_warc(table):
    """All pages written as WARC files and read back."""
    pages = table("pages")
    path = scratch(pages.sparkSession, "warc")
    warc.write(pages, path)
    return warc.read(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("""
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""")
def op5_top_k(table):
    """The ten nearest vectors, by inner product, of every hundredth one."""
    return topk.top_k(table("embeddings"), F.col("vec_id") % 100 == 0)


def _secrets_sql() -> str:
    """Gaps and matches by the same expressions, positions added up per match."""
    kinds = " UNION ALL ".join(
        f"""SELECT r, {i} AS number, '{x.kind}' AS kind, string_split_regex(text, '{p}') AS gaps,
        regexp_extract_all(text, '{p}', 0) AS found, regexp_extract_all(text, '{p}', {x.group}) AS val, {x.least} AS least FROM d"""
        for i, x in enumerate(secrets.RULES) for p in [x.pattern.replace("'", "''")])
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
m AS (SELECT *, unnest(generate_series(1, len(found))) AS i FROM ({kinds})),
s AS (SELECT r, number, kind, list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0)
             AS s, length(found[i]) AS n FROM m WHERE length(val[i]) >= least),
t AS (SELECT *, kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS span FROM s)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY s, number) FILTER (number < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY s, number), '') AS spans
FROM d LEFT JOIN t USING (r) GROUP BY r, doc_id"""


@query(_secrets_sql())
def op6_secret_scan(table):
    """Places of secrets in every document."""
    found = secrets.scan(table("documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["number"] < len(secrets.BASE))
    return found.select(F.col("id").alias("doc_id"), *[count(r.kind) for r in secrets.BASE],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


@query()
def op2_near_duplicates(table):
    """Every document with the class of near copies that it belongs to."""
    return near_dup.near_duplicates(table("documents"))


@query()
def op7_toxicity(table):
    """A toxicity score of every document, learned from the labels that are not held out."""
    docs = table("documents")
    score = toxicity.scorer(toxicity.fit(docs, table("labels")), docs.sparkSession)
    return docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


@query()
def op11_whitening(table):
    """All embeddings projected on the four leading components of their distinct vectors' covariance."""
    return whitening.whiten(table("embeddings")).withColumnRenamed("id", "vec_id")


@query(f"""
WITH pieces AS (
    SELECT lang, d, unnest(ps) AS piece, unnest(range(len(ps))) AS p
    FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
                 string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents)),
words AS (
    SELECT lang, d, p, unnest(ws) AS w1, unnest(range(len(ws))) AS i
    FROM (SELECT lang, d, p, [w for w in string_split_regex(piece, '[\x20\x09]+') if w <> ''] AS ws FROM pieces)),
runs AS (
    SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY d, p ORDER BY i)),
f AS (
    SELECT lang, 1 AS m, w1 AS phrase, w1, NULL AS w2, NULL AS w3, count(*) AS f FROM runs GROUP BY ALL
    UNION ALL SELECT lang, 2, w1 || ' ' || w2, w1, w2, NULL, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, w1, w2, w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.m, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
           (1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
    JOIN f x ON x.lang = c.lang AND x.phrase = CASE WHEN k = 1 THEN c.w1 ELSE c.w1 || ' ' || c.w2 END AND x.m = k
    JOIN f y ON y.lang = c.lang AND y.m = c.m - k
             AND y.phrase = CASE WHEN c.m = 2 THEN c.w2 WHEN k = 2 THEN c.w3 ELSE c.w2 || ' ' || c.w3 END),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
    SELECT lang, phrase, max(f) AS longer
    FROM (SELECT lang, w1 || ' ' || w2 AS phrase, f FROM c WHERE m = 3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM c WHERE m = 3)
    GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM low LEFT JOIN around USING (lang, phrase) JOIN n USING (lang)
WHERE m = 3 OR longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000""")
def op12_collocations(table):
    """The 2000 best phrases of two and three words of every language."""
    return collocations.collocations(table("documents"))


@query()
def op13_bpe(table):
    """Every document encoded and decoded again."""
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = table("documents").select("doc_id", bpe.encoder(path)("text").alias("ids"))
    return ids.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(bpe.decoder(path)("ids"), 256).alias("decoded_sha256"))
