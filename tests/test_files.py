"""Files judged one by one, checksums in pieces, drift measured in rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidelake.plans import flows
from tidelake.quality import schema as S
from tidelake.sources import files


@pytest.fixture()
def landing(spark, tmp_path):
    def put(name, frame):
        frame.coalesce(1).write.parquet(str(tmp_path / "w" / name))
        (tmp_path / "in" / name).mkdir(parents=True)
        next((tmp_path / "w" / name).glob("part*.parquet")).rename(tmp_path / "in" / name / "x.parquet")

    put("a", spark.range(3).withColumn("v", F.lit(1)))
    put("b b%", spark.range(2).withColumn("v", F.lit(None).cast("int")))
    put("c", spark.range(0).withColumn("w", F.lit(1)))
    for name, data in (("broken", b"not parquet at all"), ("empty", b"")):
        (tmp_path / "in" / name).mkdir()
        (tmp_path / "in" / name / "x.parquet").write_bytes(data)
    return tmp_path / "in"


def by_folder(df, *columns):
    return {r["path"].split("/")[-2]: tuple(r[c] for c in columns) for r in df.collect()}


def test_footers(spark, landing):
    got = by_folder(files.parquet_footers(spark, str(landing)), "readable", "row_count", "size_bytes", "columns")
    assert {k: v[:2] for k, v in got.items()} == {"a": (True, 3), "b b%": (True, 2), "c": (True, 0), "broken": (False, None), "empty": (False, None)}
    assert got["empty"][2] == 0 and [(c["name"], c["type"]) for c in got["a"][3]] == [("id", "int64"), ("v", "int32")] and got["broken"][3] is None
    assert files.parquet_footers(spark, str(landing), "*.none").collect() == []


def test_a_good_file_does_not_hide_a_broken_one_of_its_name(spark, landing):
    assert set(by_folder(S.unreadable_files(spark, str(landing)), "error")) == {"broken", "empty", "c"}


def test_landed_files(spark, landing):
    got = by_folder(flows.landed_file_checks(spark, str(landing), "*.parquet", ["id", "v"], (1, 10)), "row_count", "has_content", "row_count_ok", "columns_ok", "accepted")
    assert got == {"a": (3, True, True, True, True), "b b%": (2, True, True, True, True), "c": (0, True, False, False, False),
                   "broken": (0, True, False, False, False), "empty": (0, False, False, False, False)}


def test_checksums_are_streamed(spark, landing, monkeypatch):
    got = by_folder(files.file_listing(spark, str(landing), "*.parquet", checksum=True), "md5")
    assert got == {p.parent.name: (hashlib.md5(p.read_bytes()).hexdigest(),) for p in landing.rglob("x.parquet") if p.stat().st_size}
    monkeypatch.setattr(files, "PIECE_BYTES", 7)
    path = landing / "a" / "x.parquet"
    assert files._md5(str(path)) == files._md5(f"file:{path}") == hashlib.md5(path.read_bytes()).hexdigest()


def test_drift_in_rows(spark):
    old = spark.range(1000).selectExpr("id", "CAST(id % 50 AS STRING) AS kind", "CAST(id AS INT) AS n", "IF(id < 10, NULL, 'x') AS gone", "id AS other")
    new = old.selectExpr("id", "kind AS sort", "IF(n % 100 = 0, 'bad', CAST(n AS STRING)) AS n", "CAST(-id - 1 AS BIGINT) AS unlike", "IF(id % 4 = 0, 1.5, NULL) AS fresh")
    got = {r["column_name"]: (r["change"], r["renamed_to"], r["affected_rows"], r["lost_values"], r["null_share"]) for r in S.drift_rows(old, new).collect()}
    assert got == {"kind": ("renamed", "sort", 1000, 0, None), "gone": ("dropped", None, 1000, 990, None), "other": ("dropped", None, 1000, 1000, None),
                   "n": ("retyped", None, 1000, 10, None), "unlike": ("added", None, 1000, 0, 0.0), "fresh": ("added", None, 1000, 0, 0.75)}
    assert S.drift_rows(old, old).collect() == []
    empty = S.drift_rows(old.limit(0), new.limit(0)).collect()
    assert {r["affected_rows"] for r in empty} == {0} and {r["change"] for r in empty} == {"dropped", "added", "retyped"}
