"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts of the labelled set, whatever their label, are the unlabelled ones. With the
class prior p (the share of toxic rows among those labels) the risk of a scorer g is
``p E+[loss(g)] + max(0, Eu[loss(-g)] - p E+[loss(-g)])`` with the logistic loss: the part in brackets estimates the risk on
clean texts, cannot truly be negative, and where it is on a batch the step goes back on it instead of fitting noise.

``REPLICAS`` numpy classifiers are trained on the executors, each on all positives and its own share of the unlabelled
sample; a score is the logistic function of their mean. The sample is bounded (``max_positive``, ``max_unlabelled`` labelled
rows in the order of a hash of the id), so its ids may be broadcast and a classifier fits one task. Features are the words
of a text and its runs of ``GRAM`` bytes, letters and digits only, hashed into ``2 ** BITS`` buckets, present or not.
Those that positives hold more often than unlabelled texts, by at least ``LEAST_Z`` standard errors, are kept, at
most ``MAX_FEATURES``; a classifier is that small. Scores see the text alone, whole, in one pass.

NULL and empty texts have no features and get the score of the bias. Labels with a NULL id or value are left out; of
several labels of one id the largest counts. Without positives every score is 0. Rows that repeat an id get a row each;
rows with a NULL id are scored, never learned from. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import Texts, slices, windows

BITS = 19
GRAM = 5
MAX_FEATURES, LEAST_Z = 4096, 4.0
REPLICAS = 8
MAX_POSITIVE, MAX_UNLABELLED = 2048, 16384
MIN_POSITIVE = 3
EPOCHS, BATCH, RATE, DECAY = 40, 256, 0.02, 1e-4

# Bytes of words: letters in lower case, digits, everything beyond ASCII; the rest becomes a space.
_FOLD = np.full(256, 32, dtype=np.uint8)
for _b in range(256):
    if chr(_b).isalnum() and _b < 128 or _b >= 128:
        _FOLD[_b] = ord(chr(_b).lower()) if _b < 128 else _b


def features(texts: Texts, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every feature, each once per text, in order; those of ``wanted`` buckets only, if given."""
    folded = Texts(_FOLD[texts.data], texts.offsets)
    starts, ends, first = folded.words()
    words = folded.word_hashes(starts, ends)
    text = np.repeat(np.arange(texts.n), np.diff(first))
    if len(folded.data) >= GRAM:
        runs = windows(folded.data.astype(np.uint64), GRAM)
        at = np.repeat(np.arange(texts.n), np.diff(texts.offsets))
        inside = at[: len(runs)] == at[GRAM - 1 :]
        words, text = np.concatenate([words, runs[inside]]), np.concatenate([text, at[: len(runs)][inside]])
    bucket = (words >> np.uint64(64 - BITS)).astype(np.int64)
    if wanted is not None:
        text, bucket = text[wanted[bucket]], bucket[wanted[bucket]]
    pairs = np.unique((text.astype(np.int64) << BITS) | bucket)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``buckets, weights, bias`` of one linear scorer, from the buckets of each text."""
    buckets = np.unique(np.concatenate([*positive, *unlabelled]))
    place = np.full(1 << BITS, -1)
    place[buckets] = np.arange(len(buckets))

    def table(rows):
        rows = [p[p >= 0] for p in (place[r] for r in rows)]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])

    sides = [table(positive), table(unlabelled)]
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(len(buckets) + 1), len(buckets)
    w[bias] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    m, v, step = np.zeros_like(w), np.zeros_like(w), 0

    def batch(side: int, share: np.ndarray):
        columns, bounds = sides[side]
        sizes = bounds[share + 1] - bounds[share]
        at = np.repeat(bounds[share] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        return columns[at], np.repeat(np.arange(len(share)), sizes), len(share)

    def values(b):
        return np.bincount(b[1], weights=w[b[0]], minlength=b[2]) + w[bias]

    def gradient(b, by_text):
        g = np.bincount(b[0], weights=by_text[b[1]], minlength=len(w)).astype(np.float64)
        g[bias] += by_text.sum()
        return g

    n_steps = max(1, -(-len(unlabelled) // BATCH))
    for _ in range(EPOCHS):
        orders = [rng.permutation(len(positive)), rng.permutation(len(unlabelled))]
        for part_p, part_u in zip(np.array_split(orders[0], n_steps), np.array_split(orders[1], n_steps)):
            if not len(part_p):
                part_p = orders[0][rng.integers(len(positive), size=1)]
            p, u = batch(0, part_p), batch(1, part_u)
            gp, gu = values(p), values(u)
            sp, su = (1 / (1 + np.exp(-np.clip(x, -50, 50))) for x in (gp, gu))
            clean = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            on_clean = gradient(u, su / u[2]) - gradient(p, prior * sp / p[2])
            g = gradient(p, prior * (sp - 1) / p[2]) + on_clean if clean >= 0 else -on_clean
            g[:bias] += DECAY * w[:bias]
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return buckets, w[:bias], float(w[bias])


def select(counts: pd.DataFrame) -> np.ndarray:
    """The buckets worth a weight, from how many positive and unlabelled texts hold each (-1: how many there are)."""
    n = counts[counts["bucket"] == -1].iloc[0]
    n_p, n_u = max(int(n["positive"]), 1), max(int(n["unlabelled"]), 1)
    rest = counts[counts["bucket"] >= 0]
    p, u = rest["positive"].to_numpy() / n_p, rest["unlabelled"].to_numpy() / n_u
    both = (rest["positive"].to_numpy() + rest["unlabelled"].to_numpy() + 1) / (n_p + n_u + 2)
    z = (p - u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    order = np.lexsort((rest["bucket"].to_numpy(), -z))[:MAX_FEATURES]
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[rest["bucket"].to_numpy()[order[z[order] >= LEAST_Z]]] = True
    return wanted


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
        max_unlabelled: int = MAX_UNLABELLED) -> tuple[np.ndarray, float] | None:
    """Weights per bucket and bias, from labelled rows that are not held out; None where none is toxic."""
    usable = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    prior = usable.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return None
    ordered = lambda rows, most: rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    every = F.array(*[F.lit(i) for i in range(REPLICAS)])
    own = F.array(F.pmod(F.xxhash64("doc_id", F.lit("replica")), F.lit(REPLICAS)).cast("int"))
    sample = (ordered(usable.filter("toxic = 1"), max_positive).select("doc_id", F.lit(1).alias("positive"), every.alias("replicas"))
              .unionByName(ordered(usable, max_unlabelled).select("doc_id", F.lit(0).alias("positive"), own.alias("replicas"))))

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "positive", "replicas")

    def count(batches):
        held, rows = np.zeros((2, 1 << BITS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            side = batch.column(1).to_numpy()
            rows += np.bincount(side, minlength=2)
            for row, part in slices(batch.column(0)):
                text, bucket = features(part)
                for y in (0, 1):
                    held[y] += np.bincount(bucket[side[row + text] == y], minlength=1 << BITS)
        hit = np.append(np.flatnonzero(held[1]), -1)  # -1: how many texts there are
        held = np.column_stack([held, rows])
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(held[0][hit]), pa.array(held[1][hit])],
                                         names=["bucket", "unlabelled", "positive"])

    counts = (texts.select("text", "positive").mapInArrow(count, "bucket bigint, unlabelled bigint, positive bigint")
              .groupBy("bucket").agg(F.sum("unlabelled").alias("unlabelled"), F.sum("positive").alias("positive"))
              .filter((F.col("positive") >= MIN_POSITIVE) | (F.col("bucket") == -1)).toPandas())
    if not len(counts):
        return None
    wanted = select(counts)
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def buckets_of(column: pa.Array) -> pa.Array:
        out = []
        for _, part in slices(column):
            text, bucket = features(part, shared.value)
            edges = np.searchsorted(text, np.arange(part.n + 1))
            out += [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(edges[:-1], edges[1:])]
        return pa.array(out, pa.binary())

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["positive", "doc_id", "buckets"])
        sides = [[np.frombuffer(b, dtype=np.int32) for b in rows["buckets"][rows["positive"] == y]] for y in (1, 0)]
        if not sides[0] or not sides[1]:
            return pd.DataFrame({"bucket": [], "weight": [], "bias": []}).astype({"bucket": "int64"})
        bucket, weight, bias = train(*sides, prior, int(rows["replica"].iloc[0]))
        return pd.DataFrame({"bucket": np.append(bucket, -1), "weight": np.append(weight, bias), "bias": bias})

    taught = (texts.select("doc_id", "positive", F.arrow_udf(buckets_of, "binary")("text").alias("buckets"), "replicas")
              .select("doc_id", "positive", "buckets", F.explode("replicas").alias("replica"))
              .groupBy("replica").applyInPandas(learn, "bucket bigint, weight double, bias double"))
    model = taught.toPandas()
    n = int((model["bucket"] == -1).sum())
    if not n:
        return None
    weights, real = np.zeros(1 << BITS), model[model["bucket"] >= 0].sort_values(["bucket", "weight"])
    np.add.at(weights, real["bucket"].to_numpy(), real["weight"].to_numpy() / n)
    return weights, float(np.sort(model["weight"][model["bucket"] == -1]).sum() / n)


def scorer(model: tuple[np.ndarray, float] | None, spark):
    """A function ``text column -> score`` between 0 and 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        if shared.value is None:
            return pa.array(np.zeros(len(column)))
        (weights, bias), out = shared.value, []
        for _, texts in slices(column):
            text, bucket = features(texts, weights != 0)
            out.append(np.bincount(text, weights=weights[bucket], minlength=texts.n) + bias)
        total = np.concatenate(out) if out else np.zeros(0)
        return pa.array(1 / (1 + np.exp(-np.clip(total, -50, 50))))

    return score
