"""The five stages, each replayed in plain Python on the very rows it was given, and on rows of every odd kind."""

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

import corpus_pipeline
from tidelake.llm import quality_rules
from tidelake.session import configure, materialise

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\f\r"


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The input of every stage, and what the last one gives."""
    configure(spark)
    rows, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(rows)
        rows = materialise(stage(spark, rows, folder), "replay")
    return [{r.doc_id: r for r in x.collect()} if i < 4 else x.collect() for i, x in enumerate([*out, rows])]


def test_quality_rules(spark, folder, stages):
    before, after = stages[0], stages[1]
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").collect()}
    fold = {r.i: r.f for r in spark.createDataFrame([(i,) for i in before], "i long").select("i", F.expr("pmod(xxhash64(i), 5)").alias("f")).collect()}
    grams = {i: [int(b) for _, texts in quality_rules.slices(pa.array([d.text])) for b in quality_rules._grams(texts)[2]] for i, d in before.items()}
    raw = collections.Counter(b for g in grams.values() for b in g)
    fine = collections.Counter(b for i, g in grams.items() if i in good and fold[i] for b in g)
    n, prior, total = sum(raw.values()) + 65_536, 4 * 65_536, sum(fine.values())
    ratio = {b: math.log((fine[b] + prior * (c + 1) / n) / ((total + prior) * (c + 1) / n)) for b, c in raw.items()}
    score = {i: sum(ratio[b] for b in g) / max(len(g), 1) for i, g in grams.items()}

    def base_failed(text):
        words, held = WORD.findall(text), collections.defaultdict(list)
        for i in range(len(words) - 2):
            held[tuple(words[i : i + 3])].append(i)
        repeated = {i + k for at in held.values() if len(at) > 1 for i in at for k in range(3)}
        return len(words) < 50 or 100 * len(repeated) > 50 * len(words)

    passed = {i for i, d in before.items() if not base_failed(d.text)}
    trusted = [score[i] for i in passed if i in good and not fold[i]]
    threshold = round(statistics.mean(trusted) - 3 * statistics.stdev(trusted), 6)
    sure = {i for i in passed if abs(score[i] - threshold) > 1e-6}
    assert {i for i in after if i in sure} == {i for i in sure if score[i] >= threshold} and set(after) <= passed
    assert all(after[i] == before[i] for i in after) and len(after) > 100


def test_line_dedup(stages):
    before, after = stages[1], stages[2]
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))
    keeper, held = {}, collections.defaultdict(set)
    for i, d in before.items():
        for line in d.text.split("\n"):
            held[key(line)].add(i)
    keeper = {k: min(ids) for k, ids in held.items() if len(k) >= 10 and len(ids) > 1}
    assert keeper
    for i, d in before.items():
        want = "\n".join(line for line in d.text.split("\n") if keeper.get(key(line), i) == i)
        assert after[i].text == want and after[i].n_chars == len(want) and (after[i].lang, after[i].source) == (d.lang, d.source)
    assert len(after) == len(before)


def test_near_duplicates(stages):
    before, after = stages[2], stages[3]
    sets = {i: (lambda w: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))))(WORD.findall(d.text)) for i, d in before.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert set(after) == {i for i in sets if find(i) == i} and len(after) < len(before)
    assert all(after[i] == before[i] for i in after)


def test_mix_and_packing(stages):
    before, mixed, pieces = stages[3], stages[4], stages[5]
    copies = collections.Counter(r.doc_id for r in mixed)
    assert all(r == before[r.doc_id] for r in mixed) and max(copies.values()) <= 2
    words = {i: len(WORD.findall(d.text)) for i, d in before.items()}
    size, taken, biggest = collections.Counter(), collections.Counter(), collections.Counter()
    for i, d in before.items():
        size[d.source] += words[i]
        taken[d.source] += copies[i] * words[i]
        biggest[d.source] = max(biggest[d.source], words[i])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(size))}
    want, free, left = {}, set(size), 1.5 * sum(size.values())
    while over := [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * size[s]]:
        want.update({s: 2.0 * size[s] for s in over})
        free -= set(over)
        left = 1.5 * sum(size.values()) - sum(want.values())
    want.update({s: left * weight[s] / sum(weight[x] for x in free) for s in free})
    assert all(abs(taken[s] - want[s]) <= biggest[s] for s in size)

    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array(library.encode(before[i].text, add_special_tokens=False).ids + [0], dtype="<u4") for i in copies}
    starts, filled = collections.Counter(), collections.Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled[p.sequence_id] and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        filled[p.sequence_id] += p.length
        starts[p.doc_id] += p.length
    assert starts == {i: n * len(ids[i]) for i, n in copies.items()} and max(filled.values()) <= 1024


def odd_rows():
    text = " ".join(f"some{i % 61} word{i % 37} here{i % 13}" for i in range(120))
    return [(None, text, "en", "a", 1), (None, None, None, None, None), (1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, "", "en", "b", 0),
            (3, text + " tail", "en", None, 1), (4, "\n".join(f"line number {i} of many {i * i}" for i in range(60)), "de", "b", 1)]


def test_stages_take_rows_of_every_kind(spark, folder):
    """NULL ids and texts, repeated rows, ties between copies, columns with names of the stages' own."""
    configure(spark)
    rows = spark.createDataFrame(odd_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    rows = rows.select("*", *[F.lit("x").alias(c) for c in ("row", "lines", "node", "v", "size", "copies", "file", "place", "class_key")])
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        got[name] = stage(spark, rows, folder).collect()
        assert stage(spark, rows.limit(0), folder).collect() == []
    assert len(got["line dedup"]) == len(rows.collect()) and {r["file"] for r in got["line dedup"]} == {"x"}
    assert sorted(str(r.doc_id) for r in got["near duplicates"]) == ["1", "2", "4"]  # a tail is near; the NULL text is like the empty one
    assert {r.doc_id for r in got["quality rules"]} <= {None, 1, 3, 4} and len(got["mix"]) >= 4
    assert collections.Counter(p.doc_id for p in got["pack"] if p.start == 0)[1] == 2


def test_an_empty_corpus(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
