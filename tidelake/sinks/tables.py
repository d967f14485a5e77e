"""Parquet table writers: partitioned writes, layers, keyed upserts, partition-level rewrites."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from typing import Any, Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.split_window import null_safe_join
from tidelake.session import materialise, scratch
from tidelake.sources.files import file_listing, filesystem, path_exists

# Writer presets.
MAX_PARTITIONS = 10_000
ROW_GROUP_ROWS = 100_000
# Partition values up to this number become literals of a scan; beyond it a join finds the partitions.
MAX_LITERALS = 10_000
LAYER_CODEC = {"bronze": "snappy", "silver": "snappy", "gold": "zstd"}
WRITE_MODES = ("overwrite", "append", "error", "errorifexists", "ignore")


class PartitionLimitExceeded(ValueError):
    """A write would create more partitions than allowed."""


def partition_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many partitions a write would create, as one row."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("partitions"))


def check_partitions(df: DataFrame, keys: Sequence[str], max_partitions: int = MAX_PARTITIONS) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"partition columns not in the frame: {missing}")
    found = df.select(*keys).distinct().limit(max_partitions + 1).count()
    if found > max_partitions:
        raise PartitionLimitExceeded(f"more than {max_partitions} partitions over {list(keys)}")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                codec: str = "snappy", max_partitions: int | None = MAX_PARTITIONS, max_records_per_file: int = 0,
                dynamic: bool = False, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write Parquet, Hive-partitioned by ``partition_by``.

    Rows are rebalanced over the partition columns, so that each table partition gets few files, while AQE
    splits a partition that is too large for one task; a plain hash repartition would send a hot one to a
    single writer. ``dynamic`` overwrites only the partitions present in ``df``. The partition limit costs one pass
    over the partition columns; ``max_partitions=None`` skips it where the caller has proven the bound. ``derive`` is applied behind the
    rebalancing, so that columns which follow from others are not moved.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode}")
    if partition_by:
        if max_partitions is not None:
            check_partitions(df, partition_by, max_partitions)
        df = df.hint("rebalance", *partition_by)
    if derive is not None:
        df = derive(df)
    writer = df.write.mode(mode).option("compression", codec)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic and partition_by else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_partitions(df: DataFrame, path: str, partition_by: Sequence[str], **options: Any) -> None:
    """Add files to existing partitions; names never collide. An unpartitioned table is refused."""
    if not partition_by:
        raise ValueError("append needs a partitioned table")
    write_table(df, path, partition_by, "append", **options)


# -- layers ------------------------------------------------------------------------------------------------

def layer_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYER_CODEC:
        raise ValueError(f"unknown layer {layer}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def bronze_append(df: DataFrame, root: str, table: str, day: dt.date) -> str:
    """Append to Bronze, partitioned by ``extract_date`` (added when absent)."""
    path, limit = layer_path(root, "bronze", table), MAX_PARTITIONS
    if "extract_date" not in df.columns:  # one day is one partition
        df, limit = df.withColumn("extract_date", F.lit(day)), None
    append_partitions(df, path, ["extract_date"], max_partitions=limit)
    return path


def bronze_replace_day(df: DataFrame, root: str, table: str, day: dt.date) -> str:
    """Replace one ``extract_date`` and leave the other days alone; running it again changes nothing.

    A day that is delivered empty is emptied.
    """
    path = layer_path(root, "bronze", table)
    rows = df.withColumn("extract_date", F.lit(day))
    # Asked before the write: the rows may come from the very files that it replaces.
    empty = rows.isEmpty()
    write_table(rows, path, ["extract_date"], dynamic=True, max_partitions=None)
    if empty:
        _drop_partitions(df.sparkSession, path, ["extract_date"], [(day.isoformat(),)])
    return path


def write_silver(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = ()) -> str:
    path = layer_path(root, "silver", table)
    write_table(df, path, partition_by, codec=LAYER_CODEC["silver"])
    return path


def write_gold(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = ()) -> str:
    path = layer_path(root, "gold", table)
    write_table(df, path, partition_by, codec=LAYER_CODEC["gold"])
    return path


def with_ymd(df: DataFrame, column: str) -> DataFrame:
    """Date-hierarchy partition columns ``year, month, day``."""
    c = F.col(column)
    return df.withColumns({"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)})


def overwrite_dates(df: DataFrame, path: str, date_column: str, dates: Column) -> None:
    """Rewrite only the table partitions of the affected dates; those that get no rows are emptied.

    ``df`` may be read from the table itself: its dates are looked up before the write, and Spark replaces partitions only
    when all of their new rows are written.
    """
    spark = df.sparkSession
    name = F.col(date_column).cast("string")
    rows = df.filter(dates)
    left = {r[0] for r in rows.select(name).distinct().limit(MAX_PARTITIONS + 1).collect()}
    if len(left) > MAX_PARTITIONS:
        raise PartitionLimitExceeded(f"more than {MAX_PARTITIONS} partitions over {[date_column]}")
    before = set()
    if path_exists(spark, path):
        before = {r[0] for r in spark.read.parquet(path).select(date_column).distinct().filter(dates).select(name).collect()}
    write_table(rows, path, [date_column], dynamic=True, max_partitions=None)
    _drop_partitions(spark, path, [date_column], [(d,) for d in before - left])


def _drop_partitions(spark: SparkSession, path: str, columns: Sequence[str], values: Sequence[Sequence[str | None]]) -> None:
    """Delete partition folders by the text of their values, named as Spark names them."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    fs, _ = filesystem(spark, path)
    for one in values:
        parts = [f"{escape(c)}={'__HIVE_DEFAULT_PARTITION__' if v is None or v == '' else escape(v)}" for c, v in zip(columns, one)]
        target = spark._jvm.org.apache.hadoop.fs.Path(path, "/".join(parts))
        if fs.exists(target):
            fs.delete(target, True)


def retention_keep(df: DataFrame, date_column: str, as_of: dt.date, days: int) -> DataFrame:
    return df.filter(F.col(date_column) >= F.lit(as_of - dt.timedelta(days=days)))


def drop_expired_partitions(spark: SparkSession, path: str, date_column: str, as_of: dt.date, days: int) -> list[str]:
    """Delete whole date partitions past the limit; data files of kept partitions are not touched."""
    fs, root = filesystem(spark, path)
    limit, dropped = (as_of - dt.timedelta(days=days)).isoformat(), []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{date_column}=") and name.split("=", 1)[1] < limit:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)


# -- upsert ------------------------------------------------------------------------------------------------

def _match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    keys = right.select(*on).distinct()
    return null_safe_join(left, keys, on, how) if null_safe else left.join(keys, list(on), how).select(*left.columns)


def merge_upsert(existing: DataFrame, new: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Existing rows without a new version, plus every new row. NULL keys match only when ``null_safe``."""
    return _match(existing, new, on, "left_anti", null_safe).unionByName(new.select(*existing.columns))


def merge_counts(existing: DataFrame, new: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """``unchanged, updated, inserted`` as one row, from key counts only.

    Both sides are counted per key before they meet, so a hot key travels as one row.
    """
    old = existing.groupBy(*on).agg(F.count(F.lit(1)).alias("olds"))
    add = new.groupBy(*on).agg(F.count(F.lit(1)).alias("news"))
    both = old.select(*on, "olds", F.lit(None).cast("long").alias("news")).unionByName(
        add.select(*on, F.lit(None).cast("long").alias("olds"), "news"))
    per_key = both.groupBy(*on).agg(F.sum("olds").alias("olds"), F.sum("news").alias("news"))
    usable = F.lit(True)
    if not null_safe:
        for k in on:
            usable = usable & F.col(k).isNotNull()
    hit = usable & F.col("olds").isNotNull() & F.col("news").isNotNull()
    zero = F.lit(0).cast("long")
    return per_key.agg(F.coalesce(F.sum(F.when(~hit, F.col("olds"))), zero).alias("unchanged"),
                       F.coalesce(F.sum(F.when(hit, F.col("news"))), zero).alias("updated"),
                       F.coalesce(F.sum(F.when(~hit, F.col("news"))), zero).alias("inserted"))


def require_unique(df: DataFrame, on: Sequence[str]) -> None:
    repeated = df.groupBy(*on).count().filter("count > 1").limit(1).count()
    if repeated:
        raise ValueError(f"keys {list(on)} repeat in the rows to merge")


def _within_key_range(existing: DataFrame, new: DataFrame, on: Sequence[str], null_safe: bool) -> DataFrame:
    """Existing rows whose keys lie between the smallest and the largest new key; the bounds reach the scan as literals."""
    bounded = [c for c in on if isinstance(new.schema[c].dataType, (T.IntegralType, T.StringType, T.DateType))]
    if not bounded:
        return existing
    ends = new.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(bounded) for n, f in (("low", F.min), ("high", F.max))]).first()
    for i, c in enumerate(bounded):
        inside = F.col(c).between(ends[f"low_{i}"], ends[f"high_{i}"]) if ends[f"low_{i}"] is not None else F.lit(False)
        existing = existing.filter(inside | F.col(c).isNull() if null_safe else inside)
    return existing


def key_matches(existing: DataFrame, new: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Where stored rows with a key of ``new`` lie: ``on``, ``file`` and their number ``olds``.

    Only key columns are read, within the range of the new keys. ``new`` is broadcast where its size allows, so the
    stored keys are not shuffled, and only matches are grouped.
    """
    keys = _within_key_range(existing, new, on, null_safe).select(*on, F.col("_metadata.file_path").alias("file"))
    return _match(keys, new, on, "left_semi", null_safe).groupBy(*on, "file").agg(F.count(F.lit(1)).alias("olds"))


def merge_into_table(path: str, new: DataFrame, on: Sequence[str], partition_by: Sequence[str] = (),
                     null_safe: bool = False) -> dict[str, int]:
    """Upsert ``new`` into the table at ``path`` and return the counts ``unchanged, updated, inserted``.

    Only files that hold an affected key are rewritten. Their other rows and the new ones are written to a folder inside
    the table that readers do not see; then a list of files to bring in and to delete is written, which decides the
    merge, and carried out. A merge that broke off before that list has changed nothing; one that broke off behind
    it is finished by the next merge. Matches are counted where they are found, all rows in the files' footers. Partition columns keep
    the types of ``new``. On plain Parquet the exchange of files is not atomic for readers; one merge may run at a time.
    """
    spark = new.sparkSession
    new = materialise(new, "merge-rows")  # computed once, and of a known size
    require_unique(new, on)
    _recover(spark, path)
    incoming = new.count()
    if not path_exists(spark, path):
        write_table(new, path, partition_by)
        return {"unchanged": 0, "updated": 0, "inserted": incoming}
    existing = spark.read.parquet(path)
    typed = {f.name: f for f in new.schema if f.name in partition_by}
    schema = T.StructType([typed.get(f.name, f) for f in existing.schema])
    existing = spark.read.schema(schema).parquet(path)
    matches = materialise(key_matches(existing, new, on, null_safe), "merge-matches")
    replaced = matches.agg(F.coalesce(F.sum("olds"), F.lit(0))).first()[0]
    updated = matches.select(*on).distinct().count()
    counts = {"unchanged": existing.count() - replaced, "updated": updated, "inserted": incoming - updated}
    if not incoming:
        return counts

    hit = matches.select("file").distinct()
    files = [unquote(r["file"]) for r in hit.limit(MAX_LITERALS + 1).collect()]
    if len(files) <= MAX_LITERALS:
        reader = spark.read.schema(schema).option("basePath", path)
        affected = reader.parquet(*files) if files else spark.createDataFrame([], schema)
    else:
        marked = existing.select("*", F.col("_metadata.file_path").alias("__file"))
        affected = marked.join(hit.withColumnRenamed("file", "__file"), "__file", "left_semi").select(*existing.columns)
        files = [unquote(r["file"]) for r in hit.toLocalIterator()]
    staged = f"{path.rstrip('/')}/{_STAGED}{uuid.uuid4().hex}"
    write_table(merge_upsert(affected, new, on, null_safe), f"{staged}/data", partition_by, max_partitions=None)
    _decide(spark, staged, files)
    _swap(spark, path)
    return counts


#: Folders with this prefix lie inside a table and hold the files of an unfinished merge.
_STAGED = "_merge-"


def _decide(spark: SparkSession, staged: str, remove: Sequence[str]) -> None:
    """Write down which staged files come into the table and which files go; from here on the merge counts."""
    fs, root = filesystem(spark, staged)
    data = root.suffix("/data")
    base, found, add = fs.makeQualified(data).toUri().getPath(), fs.listFiles(data, True), []
    while found.hasNext():
        name = found.next().getPath()
        if not name.getName().startswith(("_", ".")):
            add.append(name.toUri().getPath()[len(base) + 1 :])
    out = fs.create(root.suffix("/decided.part"))
    out.writeBytes(json.dumps({"add": add, "remove": list(remove)}))
    out.close()
    fs.rename(root.suffix("/decided.part"), root.suffix("/decided"))


def _swap(spark: SparkSession, path: str) -> None:
    """Carry out every decided merge of a table; doing it again after a break changes nothing."""
    fs, root = filesystem(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.listStatus(root):
        staged = status.getPath()
        if not staged.getName().startswith(_STAGED):
            continue
        if fs.exists(staged.suffix("/decided")):
            stream = fs.open(staged.suffix("/decided"))
            plan = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
            for name in plan["add"]:
                source, target = at(staged.suffix("/data"), name), at(root, name)
                if fs.exists(source):
                    fs.mkdirs(target.getParent())
                    if not fs.rename(source, target):
                        raise OSError(f"{name} could not be brought into {path}")
            for name in plan["remove"]:
                gone = at(name)
                fs.delete(gone, False)
                folder = gone.getParent()
                while folder.depth() > root.depth() and fs.exists(folder) and not fs.listStatus(folder):
                    fs.delete(folder, True)
                    folder = folder.getParent()
        fs.delete(staged, True)


def _recover(spark: SparkSession, path: str) -> None:
    """Finish a merge that broke off behind its decision, drop one that broke off before. A whole table that was being
    exchanged by an older version returns."""
    fs, root = filesystem(spark, path)
    old, new = root.suffix(".old"), root.suffix(".next")
    if fs.exists(old):
        if fs.exists(root):
            fs.delete(old, True)
        else:
            fs.rename(old, root)
    if fs.exists(new):
        fs.delete(new, True)
    if fs.exists(root):
        _swap(spark, path)


# -- quarantine, statistics, manifest, export --------------------------------------------------------------

def quarantine_split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split rows on invalid-row masks: good rows, and bad rows with ``failed_rules`` (sorted names)."""
    failed = F.array_compact(F.array(*[F.when(F.coalesce(mask, F.lit(False)), F.lit(name))
                                       for name, mask in sorted(rules.items())]))
    marked = df.withColumn("failed_rules", failed)
    return (marked.filter(F.size("failed_rules") == 0).drop("failed_rules"),
            marked.filter(F.size("failed_rules") > 0))


def file_manifest(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Size, time and MD5 of every data file; each file is hashed where Spark reads it."""
    return file_listing(spark, path, pattern, checksum=True)


def write_with_stats(df: DataFrame, path: str, partition_by: Sequence[str] = (), **options: Any) -> DataFrame:
    """Write, then report records, files, bytes, seconds and status of what this write added, from what is on storage."""
    spark = df.sparkSession
    before = spark.createDataFrame([], "path string")
    if path_exists(spark, path) and options.get("mode") == "append":
        before = materialise(file_listing(spark, path, "*.parquet").select("path"), "files-before")
    started = time.monotonic()
    write_table(df, path, partition_by, **options)
    seconds = round(time.monotonic() - started, 3)
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"))
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    known = before.select(plain("path").alias("path"))
    rows = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).select(
        plain(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))).alias("path"), "n")
    written = rows.join(known, "path", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("records_written"))
    files = file_listing(spark, path, "*.parquet").withColumn("path", plain("path")).join(known, "path", "left_anti").agg(F.count(F.lit(1)).alias("files_written"),
                                                       F.coalesce(F.sum("size_bytes"), F.lit(0).cast("long"))
                                                       .alias("bytes_written"))
    return written.select(F.lit(path).alias("target_path"), "records_written",
                          files.select("files_written").scalar().alias("files_written"),
                          files.select("bytes_written").scalar().alias("bytes_written"),
                          F.lit(",".join(partition_by)).alias("partition_columns"),
                          F.lit(seconds).alias("duration_seconds"), F.lit("SUCCESS").alias("status"))


def export(df: DataFrame, path: str, fmt: str = "parquet", codec: str = "snappy", header: bool = True) -> None:
    if fmt == "parquet":
        df.write.mode("overwrite").option("compression", codec).parquet(path)
    elif fmt == "csv":
        df.write.mode("overwrite").option("header", header).csv(path)
    else:
        raise ValueError(f"cannot export as {fmt}")
