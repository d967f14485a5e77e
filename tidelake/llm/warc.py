"""WARC archives: a deterministic, sharded writer that survives retries, and a reader.

1. Payloads that repeat (SHA-1 equal, at least ``REVISIT_BYTES``) keep one full record, that of the largest id; the others
   become revisit records that name it. This is worked out on ids and digests alone: digests are grouped map-side first,
   those that more than 1/``HOT`` of all rows share are broadcast (``HOT`` at most), the others joined.
2. Records are dealt into shards by ranges of the id that hold about as many bytes each (1/``SHARD_PARTS`` of all, within
   ``SHARD_BYTES``), from a running total over the sorted ids, so the same rows always give the same shards, unlike sampled ranges. An id that fills more than four shards
   with several rows, or rows without an id that do, are dealt over shards of their own by their place in the input. Borders are one
   number a shard; at most ``SHARDS`` shards are made, larger ones beyond, so the borders that tasks get are 8 MB at most.
   Payloads are shuffled once, to their shard; what they refer to arrives in the same exchange, sorted in front of them.
3. Each shard is sorted and written by one task as gzip members, one a record, rolled to a new file at ``ROLL_BYTES`` of
   compressed size. Headers, record ids and digests are made anew from the content, so files are equal byte by byte
   however often a task runs.
4. A task writes under a temporary name of its own and reports each file with its digest. When all have ended, the files
   of the successful attempts get their names (a rename that may be repeated), then the manifest is written. A reader
   takes the files of the manifest only.

A NULL payload is empty. A NULL id is written as the last shard, record id ``null``; among equal payloads it is a
revisit unless all ids are NULL, then all are responses. Rows that repeat id and payload are written each and are
responses or revisits alike; a number behind the record id tells them apart. A task holds a record about four times while it is
written or read, and up to a batch of rows. A NULL url is left out of the headers. Other columns are not written. An empty table gives a
manifest without files.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.split_window import SplitWindow
from tidelake.session import materialise

REVISIT_BYTES = 1000
#: Shards hold an even part of all bytes, between these limits; files roll at this compressed size.
SHARD_PARTS, SHARD_BYTES = 4096, (32 << 20, 1 << 30)
ROLL_BYTES = 64 << 20
SHARDS = 1 << 20
HOT = 4096
#: Tasks that read an archive at most.
READERS = 10_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id, url, payload, sha1, refers_to, refers_url"
FILE = "shard bigint, number bigint, temporary string, name string, records bigint, bytes bigint, sha256 string"
READ = ("record_id string, page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
        "payload_digest string, refers_to bigint, intact boolean")


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None,
           refers_url: str | None, again: str = "") -> bytes:
    """One record, uncompressed. A revisit has the HTTP head only. ``again`` tells rows of one id and payload apart."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if refers_to is not None else http + payload
    name = lambda i, mark="": f"<urn:page:{'null' if i is None else i}:{sha1}{mark}>"
    clean = lambda u: u.replace("\r", "%0D").replace("\n", "%0A")
    b32 = lambda raw: "sha1:" + base64.b32encode(raw).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id, again)}",
             f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {clean(url)}")
    lines += [f"WARC-Payload-Digest: {b32(bytes.fromhex(sha1))}", f"WARC-Block-Digest: {b32(hashlib.sha1(block).digest())}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
        if refers_url is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {clean(refers_url)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The uncompressed gzip members of a file that arrives in chunks; one member is held at a time."""
    unpacker, parts = zlib.decompressobj(31), []
    for chunk in chunks:
        while chunk:
            parts.append(unpacker.decompress(chunk))
            chunk = b""
            if unpacker.eof:
                yield b"".join(parts)
                chunk, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("a WARC file ends inside a record")


def parse(raw: bytes) -> tuple:
    """A row (``READ``) of a record; ``intact`` says that lengths and digests agree with the content."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(line.split(b": ")[1] for line in http.split(b"\r\n") if line.startswith(b"Content-Length")))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    block_digest = base64.b32decode(fields["WARC-Block-Digest"].removeprefix("sha1:"))
    revisit = fields["WARC-Type"] == "revisit"
    page = lambda name: None if (x := name.split(":")[2]) == "null" else int(x)
    intact = (rest[len(block):] == b"\r\n\r\n" and hashlib.sha1(block).digest() == block_digest
              and (revisit or len(payload) == length and hashlib.sha1(payload).digest() == digest))
    return (fields["WARC-Record-ID"], page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"],
            None if revisit else payload, length, digest.hex(), page(fields["WARC-Refers-To"]) if revisit else None, intact)


class Layout(NamedTuple):
    """Shards by id: the largest id of each range, its first shard, and over how many shards that largest id alone is dealt."""

    upper: np.ndarray
    first: np.ndarray
    dealt: np.ndarray
    null_first: int
    null_dealt: int

    @property
    def shards(self) -> int:
        return self.null_first + self.null_dealt

    def find(self, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """First shard of every id and over how many it is dealt."""
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        known = ids.fill_null(0).to_numpy()
        first, dealt = np.full(len(ids), self.null_first), np.full(len(ids), self.null_dealt)
        at = np.searchsorted(self.upper, known[~missing])
        first[~missing] = self.first[at]
        dealt[~missing] = np.where(self.upper[at] == known[~missing], self.dealt[at], 1)
        return first, dealt


def layout(ids: DataFrame, shard_bytes: int | None) -> Layout:
    """From ``id, size`` per row; whole numbers from exact sums."""
    many = lambda n, size: int(min(n, size // shard_bytes + 1)) if n > 1 and size > 4 * shard_bytes else 1
    total, nulls, null_size = ids.agg(F.sum("size"), F.count_if(F.col("id").isNull()), F.sum(F.when(F.col("id").isNull(), F.col("size")))).first()
    total = total or 0
    shard_bytes = max(shard_bytes or min(max(total // SHARD_PARTS, SHARD_BYTES[0]), SHARD_BYTES[1]), -(-total // SHARDS))
    per_id = ids.filter("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    start = F.floor((F.col("upto") - F.col("size")) / shard_bytes)
    ranges = (SplitWindow(per_id, [], "id").total("upto", F.col("size")).result().groupBy(start.alias("start"))
              .agg(F.max(F.struct("id", "n", "size")).alias("top")).select("top.*").collect())
    upper, first, dealt, at = [], [], [], 0
    for top in sorted(ranges):
        upper.append(top["id"])
        first.append(at)
        dealt.append(many(top["n"], top["size"]))
        at += dealt[-1]
    number = lambda values: np.array(values, dtype=np.int64)
    return Layout(number(upper), number(first), number(dealt), at, many(nulls, null_size or 0))


def _references(ids: DataFrame) -> DataFrame:
    """``id, sha1, refers_to, refers_url`` of all ids whose payload is a revisit."""
    count = ids.count()
    repeated = materialise(
        ids.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("sha1")
        .agg(F.max("id").alias("refers_to"), F.max_by("url", F.struct("id", "url")).alias("refers_url"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL"), "warc-repeated")
    hot = F.col("n") * HOT > count
    rows = ids.filter(F.col("bytes") >= REVISIT_BYTES).select("id", "sha1").join(
        F.broadcast(repeated.filter(hot)), "sha1", "left")  # HOT rows at most
    cold = rows.filter("n IS NULL").select("id", "sha1").join(repeated.filter(~hot), "sha1")
    both = rows.filter("n IS NOT NULL").unionByName(cold.select(*rows.columns))
    return both.filter(~F.col("id").eqNullSafe(F.col("refers_to"))).select("id", "sha1", "refers_to", "refers_url").distinct()


def write(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url",
          payload_column: str = "html", shard_bytes: int | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write a record per row below ``path`` (a folder that all machines share) and return the manifest (``FILE``)."""
    spark = pages.sparkSession
    id_, payload = F.col(id_column).cast("bigint"), F.encode(F.coalesce(F.col(payload_column), F.lit("")), "UTF-8")
    ids = materialise(pages.select(id_.alias("id"), F.col(url_column).alias("url"), F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("bytes")),
                      "warc-ids")
    shards = layout(ids.select("id", (F.col("bytes") + 500).cast("bigint").alias("size")), shard_bytes)
    held = spark.sparkContext.broadcast(shards)

    @F.arrow_udf("first bigint, dealt bigint")
    def place(ids: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(x) for x in held.value.find(ids)], names=["first", "dealt"])

    def store(batches):
        fs, root = pafs.FileSystem.from_uri(path)
        mark = TaskContext.get().taskAttemptId()
        shard, number, out, entry, done = None, 0, None, None, []
        reference, written, times = (None, None), None, 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                entry["sha256"] = entry["sha256"].hexdigest()
                done.append(entry)
                out = None

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    close()
                    shard, number, reference, written = row["shard"], 0, (None, None), None
                this = row["page_id"], row["sha1"]
                if row["payload"] is None:  # what the records behind it refer to
                    reference = this, (row["refers_to"], row["refers_url"])
                    continue
                times = times + 1 if written == this else 0
                written = this
                if reference[0] == this:
                    row["refers_to"], row["refers_url"] = reference[1]
                again = f":{row['part']}-{times}" if times or row["part"] else ""
                packed = gzip_member(record(*(row[c] for c in RECORD.split(", ")), again))
                if out is not None and entry["bytes"] + len(packed) > roll_bytes:
                    close()
                    number += 1
                if out is None:
                    name = f"part-{shard:06d}-{number:04d}.warc.gz"
                    entry = {"shard": shard, "number": number, "temporary": f"_temporary/{name}.{mark}", "name": name,
                             "records": 0, "bytes": 0, "sha256": hashlib.sha256()}
                    fs.create_dir(f"{root}/_temporary", recursive=True)
                    out = fs.open_output_stream(f"{root}/{entry['temporary']}", compression=None)
                out.write(packed)
                entry["sha256"].update(packed)
                entry["records"] += 1
                entry["bytes"] += len(packed)
        close()
        yield pa.RecordBatch.from_pylist(done, schema=_FILES)

    def rename(batches):
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                there = fs.get_file_info(f"{root}/{row['temporary']}")
                if there.type != pafs.FileType.NotFound:
                    fs.move(f"{root}/{row['temporary']}", f"{root}/{row['name']}")
                elif fs.get_file_info(f"{root}/{row['name']}").size != row["bytes"]:
                    raise OSError(f"{row['name']} was neither written nor renamed")
            yield batch

    at = F.pmod(F.monotonically_increasing_id(), F.col("p.dealt"))
    rows = pages.select(id_.alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"), place(id_).alias("p"))
    rows = rows.withColumn("part", at).select("page_id", "url", "payload", "sha1", F.lit(None).cast("bigint").alias("refers_to"),
                                              F.lit(None).cast("string").alias("refers_url"), "part", (F.col("p.first") + F.col("part")).alias("shard"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("p.dealt") - 1)).alias("part")
    references = _references(ids).withColumn("p", place("id")).select(
        F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "sha1", "refers_to", "refers_url",
        "p.first", every).select("page_id", "url", "payload", "sha1", "refers_to", "refers_url", "part", (F.col("first") + F.col("part")).alias("shard"))
    dealt = rows.unionByName(references).repartitionById(shards.shards, F.col("shard").cast("int")).sortWithinPartitions(
        F.col("shard"), F.col("page_id").asc_nulls_last(), "sha1", F.col("refers_to").isNull(), "url")
    written = materialise(dealt.mapInArrow(store, FILE), "warc-written")
    manifest = f"{path}/_manifest"
    written.mapInArrow(rename, FILE).write.mode("overwrite").parquet(manifest)
    fs, root = pafs.FileSystem.from_uri(path)
    if fs.get_file_info(f"{root}/_temporary").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{root}/_temporary")  # what attempts that failed have left
    return spark.read.schema(FILE).parquet(manifest)


_FILES = pa.schema([("shard", pa.int64()), ("number", pa.int64()), ("temporary", pa.string()), ("name", pa.string()),
                    ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
_READ = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                   ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("refers_to", pa.int64()), ("intact", pa.bool_())])


def read(spark: SparkSession, path: str, batch_bytes: int = 4 << 20, chunk_bytes: int = 1 << 20) -> DataFrame:
    """The records of an archive folder (``READ``), streamed from the files of its manifest."""
    def load(batches):
        fs, root = pafs.FileSystem.from_uri(path)
        rows, held = [], 0
        for batch in batches:
            for entry in batch.to_pylist():
                with fs.open_input_stream(f"{root}/{entry['name']}", compression=None) as stream:
                    for raw in members(iter(lambda: stream.read(chunk_bytes), b"")):
                        rows.append(parse(raw))
                        held += len(raw)
                        if held > batch_bytes:
                            yield _batch(rows)
                            rows, held = [], 0
        yield _batch(rows)

    files = spark.read.schema(FILE).parquet(f"{path}/_manifest").select("name", "bytes")
    return files.repartition(min(READERS, max(1, files.count())), "name").mapInArrow(load, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_READ)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READ)], schema=_READ)
