"""The registered queries against their SQL, or against plain Python where SQL cannot say it."""

import collections
import math
import re
import statistics
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidelake.llm import quality_rules
from tidelake.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, folder):
    return {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, folder, name):
    assert compare(name, QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == ""


def test_mix_meets_targets(spark, folder, docs):
    rows = QUERIES["op1_mix"](spark, folder).collect()
    again = QUERIES["op1_mix"](spark, folder).collect()
    assert sorted(rows) == sorted(again) and len(rows) == len(docs)
    size, taken, target = collections.Counter(), collections.Counter(), {}
    biggest = collections.Counter()
    for r in rows:
        source = docs[r.doc_id].source
        assert r["size"] == len(WORD.findall(docs[r.doc_id].text)) and r.taken <= 2 * r["size"]
        size[source] += r["size"]
        taken[source] += r.taken
        biggest[source] = max(biggest[source], r["size"])
        target[source] = r.target
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size))}
    want, free, left = {}, set(size), 1.5 * sum(size.values())
    while True:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * size[s]]
        if not over:
            break
        want.update({s: 2.0 * size[s] for s in over})
        free -= set(over)
        left = 1.5 * sum(size.values()) - sum(want.values())
    want.update({s: left * weight[s] / sum(weight[x] for x in free) for s in free})
    for s in size:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= biggest[s]
    assert sum(taken.values()) == pytest.approx(1.5 * sum(size.values()), rel=0.03)


def test_near_duplicates_equal_brute_force(spark, folder, docs):
    sets = {i: (lambda w: frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))))(WORD.findall(d.text)) for i, d in docs.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    rows = QUERIES["op2_near_duplicates"](spark, folder).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: find(i) for i in sets} and len(rows) == len(docs)


def test_quality_counts_equal_brute_force(spark, folder, docs):
    rows = QUERIES["op8_quality_rules"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id].text
        words, seen, repeated = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            repeated += bool(WORD.search(line)) and line in seen
            seen.add(line)
        held = collections.defaultdict(list)
        for i in range(len(words) - 2):
            held[tuple(words[i : i + 3])].append(i)
        marked = {i + k for at in held.values() if len(at) > 1 for i in at for k in range(3)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(marked))
        assert r.base_failed == (len(words) < 50 or 100 * len(marked) > 50 * len(words)) and not (r.kept and r.base_failed)


def test_packing_is_a_round_trip(spark, folder, docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array(library.encode(d.text, add_special_tokens=False).ids + [0], dtype="<u4") for i, d in docs.items()}
    pieces, filled = collections.defaultdict(list), collections.Counter()
    rows = sorted(QUERIES["op9_harmonic_packing"](spark, folder).collect(), key=lambda r: (r.sequence_id, r.offset))
    for r in rows:
        assert r.offset == filled[r.sequence_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        filled[r.sequence_id] += r.length
        pieces[r.doc_id].append((r.start, r.length))
    for i, all_ids in ids.items():
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == len(all_ids)
    assert max(filled.values()) <= 1024
    assert sum(0 if n & (n - 1) == 0 else 1024 - n for n in filled.values()) < 0.01 * sum(filled.values())


def test_token_counts_equal_the_library(spark, folder, docs):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = QUERIES["op10_token_counts"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text, n = docs[r.doc_id].text, len(model.encode(docs[r.doc_id].text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, folder).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    held = [(r.predicted, labels[i]) for i, r in rows.items() if r.held_out and i in labels]
    caught = sum(p and y for p, y in held)
    assert caught > 0.7 * sum(y for _, y in held) and caught > 0.8 * sum(p for p, _ in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_quality_verdict_follows_the_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(r.kept, labels[r.doc_id]) for r in QUERIES["op8_quality_rules"](spark, folder).collect()
              if r.doc_id in labels and not r.base_failed]
    good = [k for k, y in judged if y == 1]
    assert sum(good) > 0.99 * len(good) and sum(k for k, y in judged if y == 0) < 0.2 * (len(judged) - len(good))


def test_quality_verdict_equals_plain_ratio(spark, folder, docs):
    """Score, threshold and kept again, document by document; only the hashing of n-grams is shared."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    held = {r.doc_id: r.held for r in labels.select("doc_id", F.expr("pmod(xxhash64(doc_id), 5) = 0").alias("held")).collect()}
    grams = {}
    for i, d in docs.items():
        grams[i] = [int(b) for _, texts in quality_rules.slices(pa.array([d.text])) for b in quality_rules._grams(texts)[2]]
    raw, good = collections.Counter(), collections.Counter()
    for i, buckets in grams.items():
        raw.update(buckets)
        if held.get(i) is False:
            good.update(buckets)
    n, prior = sum(raw.values()) + 65_536, 4 * 65_536

    def ratio(b):
        expected = (raw[b] + 1) / n
        return math.log((good[b] + prior * expected) / ((sum(good.values()) + prior) * expected))

    of = {b: ratio(b) for b in raw}
    score = {i: sum(of[b] for b in buckets) / max(len(buckets), 1) for i, buckets in grams.items()}
    rows = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, folder).collect()}
    trusted = [score[i] for i in docs if held.get(i) and not rows[i].base_failed]
    threshold = round(statistics.mean(trusted) - 3 * statistics.stdev(trusted), 6)
    for i, r in rows.items():
        assert r.score == pytest.approx(score[i], abs=1e-9)
        assert r.kept == (not r.base_failed and score[i] >= threshold) or abs(score[i] - threshold) < 1e-6
