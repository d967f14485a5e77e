"""Collocations by prefix-free parsing against plain counting."""

import collections
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelake.llm import collocations
from tidelake.llm.common import slices


def plain(rows, least=10, share=50, first=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\f\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        longer = [c for (g, q), c in f.items() if g == lang and len(q) == 3 and c >= least and p in (q[:2], q[1:])] if len(p) == 2 else []
        if not any(100 * c >= share * a for c in longer):
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, got in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(got)[:first]))


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def frame(spark, rows):
    schema = "lang string, text string"
    return spark.createDataFrame(rows, schema).select("*", *[F.lit("z").alias(c) for c in ("phrase", "a", "n", "chunk", "words", "part")])


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    vocabulary = ["the", "New", "york", "é", "É", "x y", "a-b", "state", "of", "art", "\x00", "日本"]
    passage = " ".join(draw.choices(vocabulary, k=200))
    out = [(draw.choice(["en", "de", None, "und"]), "".join(w + draw.choice([" ", "  ", "\t", " ", ". ", "\n", ",", " ", ""]) for w in
            draw.choices(vocabulary, k=draw.randrange(60)))) for _ in range(150)]
    return out + [("en", passage)] * 40 + [("en", "start " + passage)] * 3 + [("en", None), ("en", ""), (None, "... ,;\n"), ("fr", "once only")]


@pytest.mark.parametrize("trigger", [1, 3, 16, 1 << 40])
def test_equals_plain_counting(spark, rows, trigger):
    assert got(collocations.collocations(frame(spark, rows), trigger=trigger)) == plain(rows)


def test_first_of_each_language(spark, rows):
    assert got(collocations.collocations(frame(spark, rows), first=5, least=4, share=90)) == plain(rows, 4, 90, 5)


def test_one_very_long_text_and_ties(spark):
    text = " ".join(f"w{i % 7} v{i % 5}" for i in range(40_000))
    rows = [("en", text), ("en", "p q. " * 10), ("en", "a b. " * 10), ("en", "a " * 300)]
    assert got(collocations.collocations(frame(spark, rows))) == plain(rows)


@pytest.mark.parametrize("hot", [1, 50, 10**9])
def test_hot_parts_change_nothing(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(collocations, "HOT", hot)
    assert got(collocations.collocations(frame(spark, rows))) == plain(rows)


def test_chunks_overlap_by_two_words_and_own_every_word_once():
    text = " ".join(f"k{i * i % 97}" for i in range(500))
    for _, texts in slices(pa.array([text, "", "one", text])):
        at, chunks, owned = collocations.parse(texts, 4)
    words = [c.split(" ") for c in chunks.to_pylist()]
    half = [i for i, t in enumerate(at) if t == 0]
    assert [words[i] for i in half] == [words[i] for i, t in enumerate(at) if t == 3] and [words[i] for i, t in enumerate(at) if t == 2] == [["one"]]
    assert len(half) > 60 and sum(owned[i] for i in half) == 500
    assert [w for i in half for w in words[i][: owned[i]]] == text.split(" ")
    assert all(words[i][owned[i]:] == words[j][:2] for i, j in zip(half, half[1:]))


def test_empty(spark, rows):
    assert collocations.collocations(frame(spark, rows).limit(0)).collect() == []
    assert collocations.collocations(frame(spark, [("en", None)])).collect() == []
