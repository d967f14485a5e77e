"""File, database and JSON-envelope sources, all lazy."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from fnmatch import fnmatch
from typing import Any, Callable, Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.text import row_hash

Parser = Callable[[SparkSession, str], DataFrame]

# Endings of downloads that are still being written.
INCOMPLETE_SUFFIXES = (".crdownload", ".tmp")


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path object for a URI; works on any store the cluster can reach."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def list_directories(spark: SparkSession, path: str) -> list[str]:
    fs, p = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def scan_parquet(spark: SparkSession, path: str, recursive: bool = False,
                 schema: T.StructType | None = None) -> DataFrame:
    """Parquet directory (with partition discovery) or file; a missing path is an error."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("recursiveFileLookup", str(recursive).lower()).parquet(path)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True,
             **options: Any) -> DataFrame:
    """CSV; without a schema the types are inferred, which costs one more pass over the files."""
    reader = spark.read.options(header=header, **options)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False,
              **options: Any) -> DataFrame:
    reader = spark.read.options(multiLine=multiline, **options)
    return reader.schema(schema).json(path) if schema else reader.json(path)


def scan_as_strings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Every column as a string, types to be enforced later."""
    if fmt == "csv":
        return spark.read.options(header=True, inferSchema=False).csv(path)
    if fmt == "json":
        return spark.read.option("primitivesAsString", True).json(path)
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


_BY_SUFFIX: dict[str, Parser] = {
    ".parquet": lambda s, p: scan_parquet(s, p),
    ".csv": lambda s, p: scan_csv(s, p),
    ".json": lambda s, p: scan_json(s, p),
    ".orc": lambda s, p: s.read.orc(p),
}


def scan_by_suffix(spark: SparkSession, path: str, parsers: Mapping[str, Parser] | None = None) -> DataFrame:
    """Choose the format by file ending; ``parsers`` adds endings or replaces built-in ones."""
    known = {**_BY_SUFFIX, **(parsers or {})}
    for suffix in sorted(known, key=len, reverse=True):
        if path.rstrip("/").lower().endswith(suffix):
            return known[suffix](spark, path)
    raise ValueError(f"no parser for {path}")


def file_listing(spark: SparkSession, folder: str, pattern: str = "*", checksum: bool = False) -> DataFrame:
    """``path, size_bytes, modified_at`` (and ``md5``) of the files below a folder, listed by Spark.

    Spark lists files that hold something; contents are pruned from the scan. A checksum streams each file through its task in pieces, whatever its size.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(folder))
    columns = [F.col("path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")]
    listing = files.select(*columns)
    if not checksum:
        return listing
    digest = F.pandas_udf(lambda paths: paths.map(_md5), T.StringType())
    return listing.withColumn("md5", digest("path"))


PIECE_BYTES = 8 << 20


def _located(path: str):
    """File system and name of a path as listings write it, for use inside a task."""
    import pyarrow.fs as pafs
    local = re.sub("^file:/+", "/", path)
    return pafs.FileSystem.from_uri(local if local.startswith("/") else quote(path, safe=":/@"))


def _written(root: str, name: str) -> str:
    """The full path of a file found below ``root``, as Spark's listings write it."""
    scheme, _, rest = root.partition("://")
    if not rest or scheme == "file":
        return f"file:{name}"
    return f"{scheme}://{rest.split('/')[0]}{name}" if name.startswith("/") else f"{scheme}://{name}"


def _opened(path: str):
    """A file of a listing, opened at random places from inside a task."""
    fs, name = _located(path)
    return fs.open_input_file(name)


def _md5(path: str) -> str:
    digest = hashlib.md5()
    with _opened(path) as file:
        while piece := file.read(PIECE_BYTES):
            digest.update(piece)
    return digest.hexdigest()


FOOTER = "path string, size_bytes bigint, readable boolean, row_count bigint, row_groups int, columns array<struct<name:string,type:string>>, error string"


def parquet_footers(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per Parquet file below a folder: rows, row groups and columns by its own footer, or why it cannot be read.

    Tasks read each footer from the end of the file; no data page is touched, and a broken file fails for itself only. Empty files,
    which Spark's own listings leave out, are listed too.
    """
    def listed(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        for batch in batches:
            for root in batch.column(0).to_pylist():
                fs, name = _located(root)
                found = [f for f in fs.get_file_info(pafs.FileSelector(name, recursive=True, allow_not_found=True))
                         if f.type == pafs.FileType.File and fnmatch(f.base_name, pattern) and not f.base_name.startswith((".", "_"))]
                for i in range(0, len(found), 4096):
                    part = found[i : i + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array([_written(root, f.path) for f in part]), pa.array([f.size for f in part], pa.int64())],
                                                     names=["path", "size_bytes"])

    def load(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        for batch in batches:
            rows = []
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    with _opened(path) as file:
                        meta = pq.read_metadata(file)
                    fields = [{"name": f.name, "type": str(f.type)} for f in meta.schema.to_arrow_schema()]
                    rows.append((path, size, True, meta.num_rows, meta.num_row_groups, fields, None))
                except (pa.ArrowException, OSError) as broken:
                    rows.append((path, size, False, None, None, None, str(broken).splitlines()[0]))
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(),
                     pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])), pa.string()]
            names = ["path", "size_bytes", "readable", "row_count", "row_groups", "columns", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names) if rows else \
                pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=names)

    names = spark.createDataFrame([(folder,)], "folder string").mapInArrow(listed, "path string, size_bytes bigint")
    return names.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(load, FOOTER)


def latest_landed_file(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The newest complete file of a drop folder, as one row."""
    unfinished = F.lit(False)
    for suffix in INCOMPLETE_SUFFIXES:
        unfinished = unfinished | F.col("path").endswith(suffix)
    listing = file_listing(spark, folder, pattern).filter(~unfinished)
    newest = listing.agg(F.max(F.struct("modified_at", "path", "size_bytes")).alias("f"))
    return newest.filter("f IS NOT NULL").select("f.path", "f.size_bytes", "f.modified_at")


def incremental(df: DataFrame, column: str, last_value: Any) -> DataFrame:
    """Rows strictly after the stored mark; NULLs are never picked up. The filter is pushed to the source."""
    return df if last_value is None else df.filter(F.col(column) > F.lit(last_value))


def high_watermark(df: DataFrame, column: str) -> Any:
    return df.agg(F.max(column).alias("m")).first()["m"]


# -- databases ---------------------------------------------------------------------------------------------

def build_select(table: str, columns: Sequence[str] | None = None, where: str | None = None) -> str:
    return f"SELECT {', '.join(columns) if columns else '*'} FROM {table}" + (f" WHERE {where}" if where else "")


def scan_database(spark: SparkSession, url: str, driver: str, query: str | None = None, table: str | None = None,
                  columns: Sequence[str] | None = None, where: str | None = None,
                  incremental_column: str | None = None, last_value: Any = None, fetch_size: int = 10_000,
                  partition_column: str | None = None, bounds: tuple[Any, Any] | None = None,
                  partitions: int = 1, **options: Any) -> DataFrame:
    """JDBC scan of a query or table. With ``partition_column`` and ``bounds`` the table is read in parallel."""
    if (query is None) == (table is None):
        raise ValueError("give a query or a table")
    reader = spark.read.format("jdbc").options(url=url, driver=driver, fetchsize=fetch_size, **options)
    source = f"({query}) src" if query else f"({build_select(table, columns, where)}) src"
    reader = reader.option("dbtable", source)
    if partition_column and bounds:
        reader = reader.options(partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
                                numPartitions=partitions)
    df = reader.load()
    return incremental(df, incremental_column, last_value) if incremental_column else df


def table_schema(df: DataFrame) -> DataFrame:
    """Name, type, precision and nullability of each column, as rows."""
    rows = []
    for position, f in enumerate(df.schema.fields, 1):
        precision = f.dataType.precision if isinstance(f.dataType, T.DecimalType) else None
        rows.append((position, f.name, f.dataType.simpleString(), precision, f.nullable))
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, numeric_precision int, is_nullable boolean")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` per table; Parquet counts come from the footers."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# -- JSON envelopes ----------------------------------------------------------------------------------------

def envelope_rows(pages: DataFrame, data_path: str) -> DataFrame:
    """Rows inside JSON pages: an array at the dotted path gives its elements, an object one row, else none."""
    dtype: T.DataType = pages.schema
    for part in data_path.split("."):
        fields = {f.name: f.dataType for f in dtype.fields} if isinstance(dtype, T.StructType) else {}
        if part not in fields:
            return pages.sparkSession.createDataFrame([], T.StructType([]))
        dtype = fields[part]
    at = F.col(data_path)
    if isinstance(dtype, T.ArrayType):
        return pages.select(F.explode(at).alias("r")).select("r.*") if isinstance(
            dtype.elementType, T.StructType) else pages.select(F.explode(at).alias("value"))
    if isinstance(dtype, T.StructType):
        return pages.filter(at.isNotNull()).select(f"{data_path}.*")
    return pages.sparkSession.createDataFrame([], T.StructType([]))


def envelope_rows_typed(pages: DataFrame, text: str, data_path: str, row_type: T.StructType | str) -> DataFrame:
    """The same for pages kept as text whose shape varies from page to page: array, object and absent may mix."""
    row = T.StructType.fromDDL(row_type) if isinstance(row_type, str) else row_type
    at = F.get_json_object(F.col(text), "$." + data_path)
    # A text path keeps the shape visible: '[' starts an array, '{' one object.
    rows = F.when(at.startswith("["), F.from_json(at, T.ArrayType(row))).when(
        at.startswith("{"), F.array(F.from_json(at, row)))
    return pages.select(F.explode(rows).alias("r")).select("r.*")


# -- lineage -----------------------------------------------------------------------------------------------

def with_lineage(df: DataFrame, system: str, extracted_at: dt.datetime, file_name: Column | None = None) -> DataFrame:
    """Add ``_source_system, _extract_timestamp, _extract_date, _file_name``."""
    stamp = F.lit(extracted_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return df.withColumns({"_source_system": F.lit(system), "_extract_timestamp": stamp,
                           "_extract_date": F.lit(extracted_at.strftime("%Y-%m-%d")),
                           "_file_name": file_name if file_name is not None else F.lit(None).cast("string")})


def with_row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``_row_hash``; without a key the first three business columns are used."""
    chosen = list(columns) if columns else [c for c in df.columns if not c.startswith("_")][:3]
    return df.withColumn("_row_hash", row_hash(chosen))
