"""NULLs in any column, empty and very long texts, ties, repeated rows, empty tables, columns with clashing names."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelake.llm import line_dedup, mixing, near_dup, packing, quality_rules, secrets, token_cache, topk, toxicity, warc
from tidelake.session import configure, scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row", "lines", "node", "size", "copies", "doc", "a", "score", "v", "rank", "shard", "digest", "kept", "spans", "class_key")
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
CLEAN = "the quick brown fox jumps over the lazy dog and then it runs home to eat its supper by the fire " * 1
BODY = " ".join(f"tok{i}" for i in range(80))


def rows():
    return [
        (1, BODY, "en", "a", 1), (2, BODY, "en", "a", 1), (2, BODY, "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0),
        (None, BODY, "en", "b", 5), (None, None, None, None, None), (5, LONG, "en", "b", 9), (6, LONG + " tail", "en", None, 9),
        (7, "  \t\n  \n", "en", "a", 3), (8, "One line that is long\none LINE that is long  \nshort\n\nshort", "en", "c", 2),
        (9, "x\nONE line that is long", "de", "c", 2), (10, "four words only here", "de", "c", 2), (11, "é" * 9 + "\n" + "é" * 10, "fr", "c", 2),
        (12, "é" * 10 + " \n" + "é" * 9, "fr", "c", 2)]


@pytest.fixture(scope="module")
def docs(spark):
    configure(spark)
    frame = spark.createDataFrame(rows(), SCHEMA)
    return frame.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, 1), (5, 0, 0), (None, 1, 1), (9, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")


def test_mix(docs, nothing):
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows()) and all(r["row"]["shard"] == "x-shard" for r in out)
    by_source = {}
    for r in out:
        s = by_source.setdefault(r["row"]["source"], [0, 0, 0])
        s[0] += r["copies"] * r["size"]
        s[1], s[2] = r["target"], max(s[2], r["size"])
        assert 0 <= r["copies"] <= 2 and (r["size"] or r["copies"] == 1)
    assert set(by_source) == {"a", "b", "c", None}
    assert all(abs(taken - target) <= biggest for taken, target, biggest in by_source.values())
    assert mixing.mix(nothing).count() == 0


@pytest.mark.parametrize("large", ["one document", "a repeated id", "no id"])
def test_mix_passes_over_what_is_too_large(spark, large):
    """60,000 words at the cut, with half of the target used up: the 50,000 words of short documents still fit."""
    near = {"one document": (0.04, 0.06), "a repeated id": (0.24, 0.27)}.get(large)
    u = F.pmod(F.xxhash64(F.col("id"), F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    odd = spark.range(10_000, 100_000).filter(u.between(*near)).first()["id"] if near else None
    long = [(odd, "w " * 60_000)] if large == "one document" else [(odd, "w " * 50)] * 1200
    docs = spark.createDataFrame([(i, "w " * 50) for i in range(1000)] + long, "doc_id long, text string").withColumn("source", F.lit("a"))
    rows = mixing.mix(docs, total=0.5).collect()
    taken = sum(r["copies"] * r["size"] for r in rows)
    assert len(rows) == docs.count() and abs(rows[0]["target"] - 0.25 * 110_000 * 2) < 1
    assert abs(taken - rows[0]["target"]) <= 5_000
    assert len({r["copies"] for r in rows if r["row"]["doc_id"] == odd}) == 1


def test_near_duplicates(docs, nothing):
    out = near_dup.near_duplicates(docs).collect()
    assert len(out) == len(rows())
    key = {r.doc_id: r.class_id for r in out if r.doc_id is not None}
    assert key == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 5, 7: 3, 8: 8, 9: 9, 10: 10, 11: 11, 12: 12}
    assert sorted(r.class_id for r in out if r.doc_id is None) == [1, 3]
    kept = near_dup.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 8, 9, 10, 11, 12] and kept.columns == docs.columns
    assert near_dup.near_duplicates(nothing).count() == 0 and near_dup.keep_one(nothing).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    out = {r.node: r.root for r in near_dup.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_alignment():
    a = np.arange(100, dtype=np.uint64)
    assert near_dup.aligned(a, a) == 1 and near_dup.aligned(a, a[:70]) == 0 and near_dup.aligned(a, a[:80]) == 0.8
    moved = np.concatenate([a[50:], a[:50]])  # the same labels, halves swapped
    assert near_dup.aligned(a, moved) == pytest.approx(50 / 150) or near_dup.aligned(a, moved) == 0
    assert near_dup.aligned(a, np.concatenate([a[:40], a[41:]])) == 0.99


def test_stragglers_of_a_large_group_are_found(spark):
    """Near copies of a common text, some nearer to each other than to any leader, are one class; others are not drawn in."""
    import random
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(300)] = f"z{rng.randrange(10**6)}"
        texts.append((i, " ".join(words)))
    texts += [(100 + i, " ".join([f"p{i}_{k}" for k in range(100)] + base[:100])) for i in range(30)]
    out = near_dup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    classes = {r.doc_id: r.class_id for r in out}
    assert all(classes[i] == 0 for i in range(60)) and all(classes[100 + i] == 100 + i for i in range(30))


def test_line_dedup(docs, nothing):
    out = [(r["row"]["doc_id"], r["row"]["lines"], *r["lines"]) for r in line_dedup.dedup_lines(docs).collect()]
    assert len(out) == len(rows()) and all(x[1] == "x-lines" for x in out)
    got = {x[0]: x[2:] for x in out if x[0] is not None}
    assert got[3] == got[4] == (1, 0, "")
    assert got[7] == (3, 0, "  \t\n  \n")
    assert got[8] == (5, 0, "One line that is long\none LINE that is long  \nshort\n\nshort")
    assert got[9] == (2, 1, "x")
    assert got[11] == (2, 0, "é" * 9 + "\n" + "é" * 10) and got[12] == (2, 1, "é" * 9)
    assert got[1] == (1, 0, BODY) and got[2] == (1, 1, "")
    assert sorted(x[2:] for x in out if x[0] is None) == [(1, 0, ""), (1, 1, "")]
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-2**63, 2**63 - 1, (2, 5000))
    a[:2] = 17  # two keys alike in one half
    counts, holders = np.arange(5000), np.arange(5000) * 7
    built = line_dedup.Shard.build(0, a, b, counts, holders)
    shard = line_dedup.Shard(*(built[k] for k in ("sizes", "bits", "prints", "counts", "holders")))
    place = shard.find(a, b)
    assert sorted(place) == list(range(5000)) and (shard.holders[place] == holders).all()
    assert (shard.find(*rng.integers(-2**63, 2**63 - 1, (2, 5000))) == -1).all()
    assert len(line_dedup.Shard(*(line_dedup.Shard.build(0, *[np.zeros(0, np.int64)] * 4)[k] for k in
                                  ("sizes", "bits", "prints", "counts", "holders"))).find(a, b)) == 5000


PAGES = [(1, "http://a", "x" * 2000), (2, None, "x" * 2000), (5, "http://c", "x" * 2000), (5, "http://c", "x" * 2000), (3, "http://d", "small"),
         (4, "http://e", "small"), (6, "u\r\nInjected: yes", None), (None, "n", "x" * 2000), (7, "l", "é\r\n\r\n" * 400_000), (8, "", "")]


def test_warc(spark, tmp_path):
    configure(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("shard", F.lit("x")).withColumn("sha1", F.lit(1))
    path = str(tmp_path / "w")
    manifest = warc.write(pages, path, shard_bytes=3000, roll_bytes=200)
    assert manifest.count() > 3 and manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    first = sorted((r.name, r.bytes, r.sha256) for r in manifest.collect())
    again = warc.write(pages.repartition(7), str(tmp_path / "again"), shard_bytes=3000, roll_bytes=200)
    assert sorted((r.name, r.bytes, r.sha256) for r in again.collect()) == first
    for name, size, digest in first:
        raw = (tmp_path / "w" / name).read_bytes()
        assert len(raw) == size and hashlib.sha256(raw).hexdigest() == digest
    out = warc.read(spark, path).collect()
    assert len(out) == len(PAGES) and all(r.intact for r in out)
    got = sorted([(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in out], key=str)
    assert got == sorted([(1, "revisit", 5, 2000), (2, "revisit", 5, 2000), (5, "response", None, 2000), (5, "response", None, 2000),
                          (3, "response", None, 5), (4, "response", None, 5), (6, "response", None, 0), (None, "revisit", 5, 2000),
                          (7, "response", None, 2_400_000), (8, "response", None, 0)], key=str)
    assert next(r.url for r in out if r.page_id == 6) == "u%0D%0AInjected: yes"
    assert {bytes(r.payload) for r in out if r.page_id == 7} == {("é\r\n\r\n" * 400_000).encode()}
    empty = str(tmp_path / "e")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def test_warc_commit_can_be_repeated(spark, tmp_path):
    """A rename that has happened already, as after a lost executor, is no error; a missing file is."""
    pages = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.write(pages, path)
    warc.write(pages, path)
    assert warc.read(spark, path).count() == 3 and not (tmp_path / "w" / "_temporary").exists()
    next((tmp_path / "w").glob("part-*.warc.gz")).unlink()
    with pytest.raises(Exception):
        warc.read(spark, path).collect()


def test_top_k(spark):
    configure(spark)
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (100, [0.0, -1.0]), (100, [0.0, -1.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [1.0, None]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (8, []), (None, [9.0, 9.0]), (200, None), (9, [-3.0, 2.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x")).withColumn("v", F.lit(1))
    got = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 100 == 0, k=3).collect()))
    assert got == [(0, 1, 1, 2**20), (0, 2, 2, 2**20), (0, 3, 2, 2**20), (100, 1, 0, 0), (100, 2, 1, -2**19), (100, 3, 2, -2**19)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = topk.top_k(frame.filter("vec_id IN (0, 9)"), F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r) for r in few] == [(0, 1, 9, -3 * 2**20)]


def test_products_beyond_double_precision_are_exact(spark):
    """Neighbours whose products differ by less than a double can tell apart, near 2^62."""
    big = 2.0**21  # times 1024: 2^31, which squares to 2^62
    data = [(0, [big, 1.0 / 1024])] + [(i, [big - (i % 3) / 1024.0, (i * 7 % 11) / 1024.0]) for i in range(1, 400)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    whole = {i: [int(1024 * x) for x in v] for i, v in data}
    got = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 100 == 0).collect()))
    want = []
    for q in (0, 100, 200, 300):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    assert got == want and len({s for *_, s in want}) > 3
    with pytest.raises(Exception):
        topk.top_k(spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()


def test_tree_search_equals_brute_force_and_prunes(monkeypatch):
    import pandas as pd
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (40, 8))
    vectors = (centres[rng.integers(0, 40, 3000)] + rng.integers(-40, 40, (3000, 8))).astype(np.float64)
    vectors[:300] = vectors[0]
    ids, norm = np.arange(3000), float((vectors ** 2).sum(axis=1).max())
    pages = topk.build(ids, vectors, norm)
    tree = topk.Tree(pd.DataFrame(pages), norm)
    for q in range(0, 3000, 150):
        scores = (vectors @ vectors[q]).astype(np.int64)
        want = sorted(((-s, i) for i, s in enumerate(scores) if i != q))[:10]
        assert sorted((-s, i) for s, i in tree.search(q, vectors[q], 10, norm)) == want
    visited = []
    monkeypatch.setattr(topk.heapq, "heappop", lambda h, pop=topk.heapq.heappop: visited.append(1) or pop(h))
    tree.search(500, vectors[500], 10, norm)
    assert len(visited) < len(pages) / 2


def test_secrets(docs, nothing, spark):
    key = "A" * 10
    texts = [(1, 'é password = "abcdefgh" SECRET:short token: tokentoken'), (1, "ApI_KeY=x"), (2, "AKIA" + key + "AKIA" + key), (3, "0" * 31 + " " + "f" * 32),
             (4, "ghp_" + "z" * 36), (5, None), (6, ""), (None, "passwd=password=12345678"), (7, "-----BEGIN RSA PRIVATE KEY-----" * 3), (8, "password: token: abcdefghijk")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("kinds", F.lit(1)).withColumn("spans", F.lit("x"))
    got = sorted([(r.id, [(s.kind, s.start, s.end) for s in r.spans]) for r in secrets.scan(frame).collect()], key=str)
    assert got == sorted([
        (1, [("assign", 2, 22), ("assign", 37, 54)]), (1, []), (2, [("access", 0, 28)]), (3, [("hex", 32, 64)]), (4, [("forge_token", 0, 40)]), (5, []), (6, []),
        (None, [("assign", 0, 24)]), (7, [("private_key", 0, 31), ("private_key", 31, 62), ("private_key", 62, 93)]), (8, [])], key=str)
    assert secrets.scan(docs).count() == len(rows()) and secrets.scan(nothing).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("abcd") == [["abc", "bcd"]]
    assert secrets.trigram_query("(abc|[dD]ef?g)x") == [["abc", "bcx"], ["def", "efg", "fgx"], ["deg", "egx"]]
    assert secrets.trigram_query("ab") == [] and secrets.trigram_query("[a-z]+") == [] and secrets.trigram_query("(abc)*d") == []
    assert secrets.trigram_query("abc[0-9]+defg") == [["abc", "def", "efg"]]


def test_toxicity(docs, nothing, labels, spark):
    model = toxicity.fit(docs, labels)
    out = docs.select("doc_id", toxicity.scorer(model, spark)("text").alias("s")).collect()
    assert len(out) == len(rows()) and all(0 <= r.s <= 1 for r in out)
    assert toxicity.fit(docs, labels.limit(0)) is None and toxicity.fit(nothing, labels) is None
    assert all(r.s == 0 for r in docs.select(toxicity.scorer(None, spark)("text").alias("s")).collect())
    assert [r.h for r in spark.createDataFrame([(None,), (0,)], "i long").select(toxicity.held_out(F.col("i")).alias("h")).collect()] == [False, False]


def test_quality(docs, nothing, labels):
    out = docs.select("doc_id", quality_rules.judge(docs, labels)("text").alias("verdict")).collect()
    got = {r.doc_id: r.verdict for r in out}
    assert len(out) == len(rows()) and got[3][:5] == got[4][:5] == (0, 0, 0, 0, 0) and got[3].base_failed and not got[3].kept
    assert got[1].kept and got[5].n_words == 120_000
    assert nothing.select(quality_rules.judge(nothing, labels)("text")).count() == 0
    assert docs.select(quality_rules.judge(docs, labels.limit(0))("text")).count() == len(rows())


def _packer():
    path = public_tokenizers.path
    return packing.byte_bpe(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_packing(docs, nothing):
    out = packing.pack(docs.repartition(3), _packer()).collect()
    used, seen = {}, {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert max(used.values()) <= 1024 and seen[3] == seen[4] == 1 and set(seen) == {r[0] for r in rows()}
    assert packing.pack(nothing, _packer()).count() == 0


def test_special_strings_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a<|endoftext|> b\n\n  c", "<|endoftext|><|endof", "  \t\r\n\x85 x 's'll 12", ""):
        assert _packer()(text).tolist() == library.encode(text, add_special_tokens=False).ids + [0]


def test_token_counts_and_their_cache(docs, nothing, spark):
    model, cache = public_tokenizers.path("piece_bpe_32k.model"), scratch(spark, "cache")
    counter, version = token_cache.counter_of(model), token_cache.file_version(model)
    first = sorted(map(tuple, token_cache.count_tokens(docs, counter, version, cache).collect()), key=str)
    assert len(first) == len(rows()) and (3, 0, 0, False) in first and (4, 0, 0, False) in first
    held = spark.read.parquet(cache)
    assert held.count() == held.select("digest").distinct().count() == len({r[1] or "" for r in rows()})

    def fail(texts):
        raise AssertionError("a text that the cache holds was encoded again")

    assert sorted(map(tuple, token_cache.count_tokens(docs, fail, version, cache).collect()), key=str) == first
    other = token_cache.count_tokens(docs, lambda texts: [7] * len(texts), "other", cache).collect()
    assert {r.n_tokens for r in other} == {7}
    assert token_cache.count_tokens(nothing, counter, version, scratch(spark, "cache")).count() == 0


def test_pipeline_stages(docs, nothing, spark, folder):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
        assert stage(spark, nothing, folder).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "mix", "pack"]


def test_pipeline(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and max(r.offset + r.length for r in out) <= 1024


def test_quality_trusts_every_good_label(spark):
    labels = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    trusted = quality_rules.trusted_ids(labels)
    assert trusted.count() == 60_000 and trusted.filter("held").count() > 11_000


def test_stragglers_are_linked_in_cells_of_any_size(spark, monkeypatch):
    """Chains of near copies, in which many members are just too far from the one they are first aligned with."""
    import random
    draw = random.Random(12)
    rows = []
    for chain in range(3):
        words = [f"c{chain}w{i}" for i in range(60)]
        for step in range(25):
            words[draw.randrange(60)] = f"n{chain}x{step}"
            rows.append((len(rows), " ".join(words)))
    rows += [(1000 + i, rows[5][1]) for i in range(20)]
    sets = {i: frozenset(tuple(t.split()[k : k + 5]) for k in range(56)) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: find(i) for i in sets}
    assert 3 <= len(set(want.values())) < 40
    monkeypatch.setattr(near_dup, "ROUNDS", 0)  # everything is left to the last round
    for size in (4, 1500):
        monkeypatch.setattr(near_dup, "CELL_NODES", size)
        assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs).collect()} == want
