"""Quality rules: counts per text, and a log-likelihood ratio of hashed n-grams between trusted and raw text.

Words and pairs of neighbouring words of every text are hashed into ``2 ** BITS`` buckets. Two multinomials over the
buckets are counted, one over all documents and one over the trusted ones. The score of a document is the mean over its
n-grams of ``log p_trusted - log p_raw``. Every fifth trusted document is left out of the counts; a document passes
whose score is at most ``DEVIATIONS`` standard deviations below the mean of those held-out ones, so the threshold
follows the noise that a small trusted set brings.

Both counts cover every document in one pass: each task adds up its buckets and sends at most ``2 ** BITS`` rows. All
ids marked good are trusted. No text is shuffled for that: ids of documents, with file and row they were read from, meet
the trusted ids; the places found are written in parts of at most about ``PART_ROWS``, and a task that reads texts looks up the
places of its own files only. Documents that were not read from files are written once first. The threshold covers
every held-out document; for it, scores and not texts meet the ids. The model is one array of ``2 ** BITS`` numbers,
whatever the corpus.

NULL and empty texts have no words: all counts 0, score 0, base failed. Documents with a NULL id are counted and scored
but never trusted. Repeated rows count each. With fewer than two held-out trusted documents there is no threshold and
only the base rules decide. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import SPACES, Texts, mix, slices, sums, windows
from tidelake.session import materialise, scratch

BITS = 16
#: The trusted counts are drawn towards the raw ones as if this many more n-grams had been seen.
PRIOR = 4 << BITS
DEVIATIONS = 3.0
HELD_OUT = 5
#: Trusted rows in a part of the table of their places.
PART_ROWS = 1 << 20
MIN_WORDS = 50
MAX_REPEATED = 0.5
SYMBOLS = b"#*$%&|<>"
VERDICT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "score double, base_failed boolean, kept boolean")

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _grams(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, hashes of words, and bucket and text of every n-gram."""
    starts, ends, first = texts.words()
    words = texts.word_hashes(starts, ends)
    text = np.repeat(np.arange(texts.n), np.diff(first))
    same = text[1:] == text[:-1]
    hashes = np.concatenate([words, windows(words, 2)[same]]) if len(words) > 1 else words
    return first, words, (hashes >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate([text, text[1:][same]])


def trusted_ids(labels: DataFrame, id_column: str = "doc_id", quality: str = "quality") -> DataFrame:
    """All ids marked good; ``held`` marks every fifth by a hash of the id."""
    return (labels.filter((F.col(quality) == 1) & F.col(id_column).isNotNull()).select(F.col(id_column).alias("doc_id"))
            .distinct().withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0))


def _with_places(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, text`` with the ``file`` (a hash of its path) and ``place`` each row is read from."""
    columns = [F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")]
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")]
    try:
        return docs.select(*columns, *place)
    except AnalysisException:  # not read from files
        return materialise(docs.select(*columns), "documents").select("doc_id", "text", *place)


class Places:
    """Rows of files by number, written in parts that tasks look up: ``file`` is a hash of the path."""

    def __init__(self, rows: DataFrame):
        """``rows`` has ``file`` and ``place``."""
        rows = materialise(rows, "places-found")
        self.parts = max(1, -(-rows.count() // PART_ROWS))
        self.path = scratch(rows.sparkSession, "places")
        (rows.withColumn("part", F.pmod("file", F.lit(self.parts))).repartition("part").write.partitionBy("part").parquet(self.path))
        self.part, self.held = None, {}

    def mark(self, file: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which of the rows are in the table."""
        out = np.zeros(len(file), dtype=bool)
        for one in np.unique(file):
            here = file == one
            known = self._of(int(one))
            if len(known):
                at = np.minimum(np.searchsorted(known, place[here]), len(known) - 1)
                out[here] = known[at] == place[here]
        return out

    def _of(self, file: int) -> np.ndarray:
        """The places of a file; the part read last is kept."""
        if self.part != file % self.parts:
            self.part, self.held = file % self.parts, {}
            fs, root = pafs.FileSystem.from_uri(self.path)
            folder = f"{root}/part={self.part}"
            if fs.get_file_info(folder).type != pafs.FileType.NotFound:
                rows = pq.read_table(folder, columns=["file", "place"], filesystem=fs, partitioning=None)
                files, places = rows["file"].to_numpy(), rows["place"].to_numpy()
                order = np.lexsort((places, files))
                files, places = files[order], places[order]
                names, first = np.unique(files, return_index=True)
                self.held = dict(zip(names.tolist(), np.split(places, first[1:])))
        return self.held.get(file, np.zeros(0, dtype=np.int64))


def fit(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> np.ndarray:
    """Log ratio per bucket from all documents of ``docs``; ``trusted`` has the trusted ids."""
    rows = _with_places(docs, id_column, text_column)
    good = rows.select("doc_id", "file", "place").join(trusted.filter("NOT held").select("doc_id"), "doc_id")
    places = Places(good.select("file", "place"))

    def count(batches):
        raw, good = np.zeros(1 << BITS, dtype=np.int64), np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            is_good = places.mark(batch.column(1).to_numpy(), batch.column(2).to_numpy())
            for row, texts in slices(batch.column(0)):
                _, _, bucket, text = _grams(texts)
                raw += np.bincount(bucket, minlength=1 << BITS)
                good += np.bincount(bucket[is_good[row + text]], minlength=1 << BITS)
        hit = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(raw[hit]), pa.array(good[hit])],
                                         names=["bucket", "raw", "good"])

    counts = (rows.select("text", "file", "place").mapInArrow(count, "bucket bigint, raw bigint, good bigint")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toPandas())
    raw, good = np.ones(1 << BITS), np.zeros(1 << BITS)
    raw[counts["bucket"]] += counts["raw"]
    good[counts["bucket"]] += counts["good"]
    expected = raw / raw.sum()
    return np.log((good + PRIOR * expected) / ((good.sum() + PRIOR) * expected))


def _repeated_words(first: np.ndarray, words: np.ndarray, n_texts: int) -> np.ndarray:
    """Words per text that lie in a three-word window found at least twice in it."""
    text = np.repeat(np.arange(n_texts), np.diff(first))
    marked = np.zeros(len(words), dtype=bool)
    if len(words) >= 3:
        at = np.flatnonzero(text[2:] == text[:-2])
        _, group, size = np.unique(mix(windows(words, 3)[at] + mix(text[at].astype(np.uint64) + np.uint64(1))),
                                   return_inverse=True, return_counts=True)
        hit = at[size[group] > 1]
        for i in range(3):
            marked[hit + i] = True
    return sums(marked, first)


def _duplicate_lines(text: bytes) -> int:
    seen, repeated = set(), 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            repeated += line in seen
            seen.add(line)
    return repeated


def verdict(ratios: np.ndarray, spark, threshold: float, min_words: int = MIN_WORDS, max_repeated: float = MAX_REPEATED):
    """A function ``text column -> struct`` with the fields of ``VERDICT``, for every text as a whole."""
    shared = spark.sparkContext.broadcast(ratios)

    @F.arrow_udf(VERDICT)
    def judge(column: pa.Array) -> pa.Array:
        ratio, out = shared.value, {name: [] for name in ("n", "chars", "symbols", "lines", "repeated", "score")}
        for _, texts in slices(column):
            first, words, bucket, text = _grams(texts)
            data, bounds = texts.data, texts.offsets
            starts, ends, _ = texts.words()
            of = np.diff(first)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            grams = np.bincount(text, minlength=texts.n)
            out["n"].append(of)
            out["chars"].append(sums(points[ends] - points[starts], first))
            out["symbols"].append(sums(_IS_SYMBOL[data], bounds))
            out["lines"].append([_duplicate_lines(data[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])])
            out["repeated"].append(_repeated_words(first, words, texts.n))
            out["score"].append(np.bincount(text, weights=ratio[bucket], minlength=texts.n) / np.maximum(grams, 1))
        got = {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}
        failed = (got["n"] < min_words) | (got["repeated"] > max_repeated * got["n"])
        counts = [pa.array(got[k].astype(np.int64)) for k in ("n", "chars", "symbols", "lines", "repeated")]
        columns = [*counts, pa.array(got["score"]), pa.array(failed), pa.array(~failed & (got["score"] >= threshold))]
        return pa.StructArray.from_arrays(columns, names=[f.split()[0] for f in VERDICT.split(", ")])

    return judge


def calibrate(docs: DataFrame, trusted: DataFrame, ratios: np.ndarray, id_column: str = "doc_id",
              text_column: str = "text") -> float:
    """The lowest score that passes, from the held-out trusted documents that pass the base rules."""
    score = verdict(ratios, docs.sparkSession, -np.inf)
    # Every document is judged before the join, so that no text is shuffled for it.
    held = (docs.select(F.col(id_column).alias("doc_id"), score(text_column).alias("v"))
            .select("doc_id", "v.kept", "v.score").join(trusted.filter("held"), "doc_id"))
    kept = F.when(F.col("kept"), F.col("score"))
    mean, spread = held.agg(F.avg(kept), F.stddev_samp(kept)).first()
    return -np.inf if spread is None else round(mean - DEVIATIONS * spread, 6)


def judge(docs: DataFrame, labels: DataFrame):
    """Fit on ``docs`` and ``labels``; returns the function that judges a text column."""
    trusted = trusted_ids(labels).persist()
    ratios = fit(docs, trusted)
    threshold = calibrate(docs, trusted, ratios)
    trusted.unpersist()
    return verdict(ratios, docs.sparkSession, threshold)
