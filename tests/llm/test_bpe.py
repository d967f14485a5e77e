"""BPE in merge rounds against the library, for texts of every kind."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelake.llm import bpe
from tidelake.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(texts, library, own=None):
    own = own or bpe.load(PATH)
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text[:80]
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False), text[:80]


def test_query_equals_the_library(spark, folder, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_bpe"](spark, folder).collect()
    assert len(rows) == len(docs)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(decoded.encode()))


def test_ids_are_made_once(spark, folder):
    plan = QUERIES["op13_bpe"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [encode") == 1 and "decode(encode" not in plan


@pytest.mark.parametrize("alphabet", ["ab", "the in", "aAbB'sStTrReEmMlLdD vV01 ?!'", "".join(map(chr, range(300))), "".join(map(chr, range(0x300, 0x400))),
                                      "՘֋ x​ –—…é́İıſKΣσς"])
def test_random_texts(alphabet, library):
    draw = random.Random(alphabet)
    check(["".join(draw.choices(alphabet, k=k)) for k in (0, 1, 2, 3, 5, 20, 200, 2000) for _ in range(15)], library)


def test_every_code_point(library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    check(["a" + " a".join(points[i : i + 5000]) for i in range(0, len(points), 5000)][::7], library)


def test_special_strings_ties_and_long_words(library):
    check(["", " ", "<|endoftext|>", "x<|endoftext|><|startoftext|>y", "<|ENDOFTEXT|>", "<|endoftext", "İI ΑΣ ﬁ ½ ²", "á ́", "'''s's'll'LL",
           *["a" * k for k in range(40)], *["ab" * k for k in range(20)], *["aab" * k for k in range(20)]], library)
    draw = random.Random(5)
    check(["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "a" * 200_000, "é" * 50_000], library)


def test_long_texts_are_cut_at_blanks_only(library, monkeypatch):
    text = " ".join(f"word{i % 977} É{i}́ it's" for i in range(3000)) + "x" * 3000
    parts = [p for run in bpe.runs([text, "", "b c"], 1000) for p in run]
    assert "".join(p for n, p in parts if n == 0) == text and len(parts) > 40 and (1, "") in parts and (2, "b c") in parts
    own = bpe.WordBpe(PATH)
    got = np.concatenate([ids for run in bpe.runs([text], 1000) for ids in own.encode([p for _, p in run])])
    assert got.tolist() == library.encode(text, add_special_tokens=False).ids


def test_known_words_are_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    own = bpe.WordBpe(PATH)
    for i in range(20):
        check([" ".join(f"w{j}" for j in range(i, i + 40)) + " " + "q" * 100], library, own)
        assert len(own.place_of) <= 150 and "q" * 100 not in own.place_of


def test_handling(spark):
    rows = [(1, "Hello"), (1, "Hello"), (None, "Hello"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("x").alias("ids"), F.lit("y").alias("pythonUDF0"))
    out = docs.select("doc_id", bpe.encoder(PATH)("text").alias("e")).select("doc_id", "e", bpe.decoder(PATH)("e").alias("d")).collect()
    assert sorted((str(r.doc_id), len(r.e), r.d) for r in out) == [
        ("1", 4, "hello</w>"), ("1", 4, "hello</w>"), ("2", 0, ""), ("3", 0, ""), ("None", 4, "hello</w>")]
    assert docs.limit(0).select(bpe.encoder(PATH)("text")).collect() == []
    unknown = np.array([49406, 4_000_000, 320], dtype="<u4").tobytes()
    got = spark.createDataFrame([(bytearray(unknown),), (None,)], "e binary").select(bpe.decoder(PATH)("e").alias("d")).collect()
    assert {r.d for r in got} == {"<|startoftext|> a</w>", ""}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))
