"""Phrase collocations by prefix-free parsing.

Texts are lower-cased (A-Z), cut into pieces at ``BREAKS`` and into words. A text is parsed into chunks: a chunk ends with the
next *trigger*, a pair of neighbouring words of one piece whose hash is 0 modulo ``TRIGGER``, and the next chunk begins with that
same pair. So where to cut is decided by content, equal passages give equal chunks wherever they stand, and two
chunks overlap by two words: every phrase of up to three words lies wholly in the chunk that *owns* its first word, which is
all but the last two words of a chunk that another one follows. Words of a chunk have a blank between them, or a line feed
where a piece ends.

1. Parse: every task writes ``(lang, chunk, owned)`` rows; counting equal ones is the dictionary with its parse frequencies.
2. Phrases are counted inside each distinct chunk, from owned first words only, times the frequency. The phrase of no words is
   counted too: it stands once at every word, so its count is the number of words. Tasks add up blocks of chunks and
   shuffle them packed: one row holds the phrases of a block that share hash bucket and language, compressed. A bucket is added
   up by itself; there are as many as the text has times ``BUCKET_BYTES``.
3. Phrases of at least ``LEAST`` are kept; every part of one is one too, so nothing that a score needs is lost.
4. Candidates (two and three words) ask for the counts of the parts of their cuts. Parts that hold more than
   1/``HOT`` of all words (so at most ``2 * HOT`` of them) are broadcast; of the rest none has many candidates.
5. The lowest score over the cuts counts; a pair that mostly stands inside one longer candidate is dropped.

Products are decimals of 38 digits and divide without rounding. NULL and empty texts have no words; a NULL language is ``und`` and
is counted together with texts marked so. Repeated rows count each, ids are not used, other columns are not looked at.
An empty table gives no phrases.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.bpe import ragged
from tidelake.llm.common import Texts, mix, slices
from tidelake.session import materialise, parallelism

BREAKS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"
TRIGGER = 16
LONGEST = 3
LEAST = 10
SHARE = 50
FIRST = 2000
HOT = 4096
#: Bytes of chunks whose phrases are added up at once.
BLOCK_BYTES = 1 << 20
#: Bytes of text for each hash bucket of phrases: a bucket's phrases are added up at once.
BUCKET_BYTES = 4 << 20
#: Phrases of a packed row at most.
LINES = 4096
#: Groups of tasks whose best phrases meet before those of a language do.
GROUPS = 64

_IS_BREAK, _IS_BLANK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_IS_BREAK[list(BREAKS)] = True
_IS_BLANK[list(BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_CODES = np.random.default_rng(61).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes; first byte and end of every word; and its piece, numbered over all texts."""
    data = _LOWER[texts.data]
    breaks = _IS_BREAK[data]
    inside = ~(breaks | _IS_BLANK[data])
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[texts.offsets[:-1]] = True
    first = inside & np.concatenate([[True], ~inside[:-1]])[: len(data)] | inside & begins[:-1]
    starts = np.flatnonzero(first)
    last = inside & (np.concatenate([~inside[1:], [True]])[: len(data)] | np.append(begins[1:-1], True)[: len(data)])
    ends = np.flatnonzero(last) + 1
    # A piece is told by the breaks and the texts before it.
    piece = np.cumsum(breaks)[starts] + np.searchsorted(texts.offsets, starts, side="right") if len(starts) else starts
    return data, starts, ends, piece


def byte_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every byte range; an empty one has hash 0."""
    lengths = ends - starts
    out = np.zeros(len(starts), dtype=np.uint64)
    some = np.flatnonzero(lengths)
    if len(some):
        starts, lengths = starts[some], lengths[some]
        first = np.cumsum(lengths) - lengths
        powers = np.cumprod(np.full(int(lengths.max()), _STEP, dtype=np.uint64))
        terms = _CODES[data[ragged(starts, lengths)]] * powers[ragged(np.zeros(len(some), dtype=np.int64), lengths)]
        out[some] = mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))
    return out


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The given byte ranges as strings."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    taken = data[ragged(starts, lengths)]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(taken)])


def parse(texts: Texts, trigger: int = TRIGGER) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The text of every chunk, the chunk (words with one blank between them), and how many first words it owns."""
    data, starts, ends, piece = words_of(texts)
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.int64), pa.array([], pa.large_string()), np.zeros(0, dtype=np.int64)
    code = byte_codes(data, starts, ends)
    text = np.searchsorted(texts.offsets, starts, side="right") - 1
    with_next = np.append(piece[:-1] == piece[1:], False)
    pair = mix(code * _STEP + np.append(code[1:], np.uint64(0)))
    head = np.concatenate([[True], text[1:] != text[:-1]])
    first = np.flatnonzero(head | (with_next & (pair % np.uint64(trigger) == 0)))
    behind = np.append(first[1:], n)
    # A chunk that another one of its text follows goes on over the two words that the other begins with.
    last = behind + np.append(np.where(head[first[1:]], 0, 2), 0)
    # Words with what is between them behind each, one after the other; a chunk is then one range of bytes.
    lengths = ends - starts + 1
    at = np.cumsum(lengths) - lengths
    spaced = data[np.minimum(ragged(starts, lengths), len(data) - 1)]
    spaced[at + lengths - 1] = np.where(with_next, ord(" "), ord("\n"))
    return text[first], _strings(spaced, at[first], at[last - 1] + lengths[last - 1] - 1), behind - first


def dictionary(docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """``lang, chunk, owned, frequency`` of all distinct chunks of ``lang, text``."""
    def run(batches):
        for batch in batches:
            for row, texts in slices(batch.column(1)):
                text, chunk, owned = parse(texts, trigger)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text + row)), chunk.cast(pa.string()), pa.array(owned)], names=["lang", "chunk", "owned"])

    parsed = docs.mapInArrow(run, "lang string, chunk string, owned bigint")
    return parsed.groupBy("lang", "chunk", "owned").agg(F.count(F.lit(1)).alias("frequency"))


def phrases_of(chunks: pa.Array, owned: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """For 1 to ``longest`` words: all phrases with an owned first word, and the chunk of each."""
    for row, texts in slices(chunks, 1 << 40):
        data = texts.data
        starts_text = np.zeros(len(data) + 1, dtype=bool)
        starts_text[texts.offsets] = True
        gap = (data == ord(" ")) | (data == ord("\n"))
        starts = np.flatnonzero(starts_text[:-1] | np.concatenate([[False], gap[:-1]])[: len(data)])
        over = np.append(starts[1:], len(data))
        # A word ends before the gap that follows it, or where its text does.
        ends = np.where(starts_text[over], over, over - 1)
        chunk = np.searchsorted(texts.offsets, starts, side="right") - 1
        piece = np.cumsum(data == ord("\n"))[starts] + chunk
        first = np.searchsorted(chunk, np.arange(texts.n))
        within = np.arange(len(starts)) - first[chunk] < owned[row + chunk]
        for words in range(1, longest + 1):
            i = np.flatnonzero(within[: max(0, len(starts) - words + 1)])
            i = i[(piece[i] == piece[i + words - 1]) & (chunk[i] == chunk[i + words - 1])]
            yield _strings(data, starts[i], ends[i + words - 1]), row + chunk[i]


def pack(code: np.ndarray, phrase: pa.Array, f: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Rows ``(bucket, code, n, blob)``: up to ``LINES`` phrases that share bucket and code, compressed behind their counts."""
    offsets = np.frombuffer(phrase.buffers()[1], dtype=np.int64)[phrase.offset : phrase.offset + len(phrase) + 1]
    data = np.frombuffer(phrase.buffers()[2], dtype=np.uint8) if offsets[-1] else np.zeros(0, dtype=np.uint8)
    starts, ends = offsets[:-1], offsets[1:]
    key = (byte_codes(data, starts, ends) % np.uint64(buckets)).astype(np.int64) + code * buckets
    order = np.argsort(key, kind="stable")
    key, starts, lengths, f = key[order], starts[order], (ends - starts)[order] + 1, f[order].astype("<i8")
    at = np.cumsum(lengths) - lengths
    lines = np.append(data, np.uint8(0))[ragged(starts, lengths)]
    lines[at + lengths - 1] = ord("\n")
    press = zstandard.ZstdCompressor()
    run = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    for first, over in zip(run.tolist(), [*run[1:].tolist(), len(key)]):
        for i in range(first, over, LINES):
            j = min(over, i + LINES)
            text = lines[at[i] : at[j - 1] + lengths[j - 1]].tobytes()
            yield int(key[first]) % buckets, int(key[first]) // buckets, j - i, press.compress(f[i:j].tobytes() + text)


def unpack(n: np.ndarray, blobs: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The phrases and counts of packed rows, one after the other."""
    press = zstandard.ZstdDecompressor()
    raw = [press.decompress(b) for b in blobs]
    f = np.concatenate([np.frombuffer(r, dtype="<i8", count=k) for r, k in zip(raw, n)])
    data = np.frombuffer(b"".join(r[8 * k :] for r, k in zip(raw, n)), dtype=np.uint8)
    breaks = np.flatnonzero(data == ord("\n"))
    # Line feeds go; what is left are the phrases end to end.
    offsets = np.append(0, breaks - np.arange(len(breaks)))
    return pa.Array.from_buffers(pa.large_string(), len(breaks), [None, pa.py_buffer(offsets), pa.py_buffer(data[data != ord("\n")])]), f


def counts(chunks: DataFrame, buckets: int, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, words, phrase, f`` of phrases that stand at least ``least`` times in the parsed texts; the empty phrase, of no
    words, counts all words. ``buckets`` is how many parts phrases are dealt into, each added up by itself."""
    def run(batches):
        def flush(held):
            block = pa.Table.from_batches(held)
            lang, chunk, owned, frequency = (block.column(c).combine_chunks() for c in ("lang", "chunk", "owned", "frequency"))
            own, times = owned.to_numpy(), frequency.to_numpy()
            langs = lang.dictionary_encode()
            of = langs.indices.to_numpy().astype(np.int64)
            every = pa.array([""] * len(own), pa.large_string()), np.arange(len(own))
            codes, phrases, times_of = [], [], []
            for n, (phrase, at) in enumerate([every, *phrases_of(chunk, own, longest)]):
                found = pa.table({"code": of[at], "phrase": phrase, "f": times[at] * own[at] if n == 0 else times[at]})
                added = found.group_by(["code", "phrase"]).aggregate([("f", "sum")])
                codes.append(added["code"].to_numpy())
                phrases.append(added["phrase"].combine_chunks())
                times_of.append(added["f_sum"].to_numpy())
            rows = list(pack(np.concatenate(codes), pa.concat_arrays(phrases), np.concatenate(times_of), buckets))
            bucket, code, n, blob = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), langs.dictionary.take(pa.array(code)).cast(pa.string()),
                                              pa.array(n, pa.int32()), pa.array(blob, pa.binary())], names=["bucket", "lang", "n", "blob"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("chunk").nbytes
            if size > BLOCK_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    def add(part: pa.Table) -> pa.Table:
        n, langs = part["n"].to_numpy(), part["lang"].combine_chunks().dictionary_encode()
        phrase, f = unpack(n, part["blob"].to_pylist())
        found = pa.table({"code": np.repeat(langs.indices.to_numpy(), n), "phrase": phrase, "f": f})
        added = found.group_by(["code", "phrase"]).aggregate([("f", "sum")])
        kept = added.filter(pc.or_(pc.greater_equal(added["f_sum"], least), pc.equal(added["phrase"], "")))
        words = pc.if_else(pc.equal(kept["phrase"], ""), 0, pc.add(pc.count_substring(kept["phrase"], " "), 1))
        return pa.table({"lang": langs.dictionary.take(kept["code"].combine_chunks()).cast(pa.string()), "words": words.cast(pa.int32()),
                         "phrase": kept["phrase"].cast(pa.string()), "f": kept["f_sum"]})

    packed = chunks.mapInArrow(run, "bucket int, lang string, n int, blob binary")
    return packed.groupBy("bucket").applyInArrow(add, "lang string, words int, phrase string, f bigint")


def collocations(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", least: int = LEAST, share: int = SHARE,
                 first: int = FIRST, trigger: int = TRIGGER) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language."""
    texts = docs.select(F.coalesce(lang_column, F.lit("und")).alias("lang"), F.col(text_column).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(parallelism(docs.sparkSession), -(-size // BUCKET_BYTES))
    frequent = materialise(counts(dictionary(texts, trigger), buckets, least=least), "phrases")
    total = frequent.filter("words = 0").select("lang", F.col("f").alias("n"))
    word = lambda i: F.split("phrase", " ")[i]
    candidates = frequent.filter("words > 1").select(
        "lang", "phrase", "words", F.col("f").alias("a"), word(0).alias("w1"), word(1).alias("w2"), F.get(F.split("phrase", " "), F.lit(2)).alias("w3"))

    # The cuts of every candidate, and the count of each part.
    def part(k, side, text):
        return F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), text.alias("part"))

    pair = F.array(part(1, "l", F.col("w1")), part(1, "r", F.col("w2")))
    triple = F.array(part(1, "l", F.col("w1")), part(1, "r", F.concat_ws(" ", "w2", "w3")),
                     part(2, "l", F.concat_ws(" ", "w1", "w2")), part(2, "r", F.col("w3")))
    asked = candidates.select("lang", "phrase", "words", "a", F.explode(F.when(F.col("words") == 2, pair).otherwise(triple)).alias("p")).select(
        "lang", "phrase", "words", "a", "p.*")
    parts = frequent.filter("words IN (1, 2)").select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    # One word and two words begin at most once at every word, so of either at most HOT parts are hot.
    every = total.agg(F.sum("n")).first()[0] or 0
    hot = F.col("part_f") * HOT > every
    met = asked.join(F.broadcast(parts.filter(hot)), ["lang", "part"], "left")
    cold = met.filter("part_f IS NULL").drop("part_f").join(parts.filter(~hot), ["lang", "part"])
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("part_f"))).alias(side)
    cuts = (met.filter("part_f IS NOT NULL").unionByName(cold).groupBy("lang", "phrase", "words", "a", "k").agg(of("l"), of("r")))
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")), wide("l") * wide("r"))
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "words", "a").agg(lowest)

    # A pair goes if one longer candidate around it has its share.
    pair_of = lambda *w: F.concat_ws(" ", *w)
    around = (candidates.filter("words = 3").select("lang", F.explode(F.array(pair_of("w1", "w2"), pair_of("w2", "w3"))).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        (F.col("words") == LONGEST) | F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    # The best of a group of tasks, then those of the language: no task meets more than GROUPS times ``first`` rows of either.
    by = [F.desc("cut.score"), F.desc("a"), "phrase"]
    grouped = kept.withColumn("group", F.spark_partition_id() % GROUPS)
    some = grouped.withColumn("nth", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*by))).filter(F.col("nth") <= first)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).filter(F.col("rank") <= first)
    return best.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
