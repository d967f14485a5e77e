import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelake.plans import dimensional as D
from tidelake.plans import flows
from tidelake.session import materialise
from tidelake.sinks import tables
from tidelake.sources import files
from tidelake.sources.catalog import Lakehouse, query_lakehouse


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merge_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a", "p"), (2, "b", "p"), (3, "c", "q"), (3, "c2", "q")], "k int, v string, part string")
    new = spark.createDataFrame([(2, "B", "q"), (4, "D", "r")], "k int, v string, part string")
    tables.write_table(old, path, ["part"])
    for _ in range(2):
        tables.merge_into_table(path, new, ["k"], ["part"])
        assert rows(spark.read.parquet(path).select("k", "v", "part")) == [(1, "a", "p"), (2, "B", "q"), (3, "c", "q"), (3, "c2", "q"), (4, "D", "r")]
    tables.merge_into_table(path, spark.createDataFrame([(1, "A", "q")], old.schema), ["k"], ["part"])
    assert files.list_directories(spark, path) == ["part=q", "part=r"]  # the emptied partition is gone
    assert rows(tables.merge_counts(old, new, ["k"])) == [(3, 1, 1)]


def test_merge_unpartitioned_and_two_level(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 1, None)], "k int, v string, p int, q string")
    new = spark.createDataFrame([(2, "B", 1, None), (3, "C", 2, "y")], old.schema)
    want = [(1, "a", 1, "x"), (2, "B", 1, None), (3, "C", 2, "y")]
    for name, parts in (("flat", []), ("deep", ["p", "q"])):
        path = str(tmp_path / name)
        tables.merge_into_table(path, old, ["k"], parts)
        tables.merge_into_table(path, new, ["k"], parts)
        assert rows(spark.read.parquet(path).select("k", "v", "p", "q")) == want


def test_null_keys(spark):
    old = spark.createDataFrame([(None, "a")], "k int, v string")
    new = spark.createDataFrame([(None, "b")], "k int, v string")
    assert rows(tables.merge_upsert(old, new, ["k"])) == [(None, "a"), (None, "b")]
    assert rows(tables.merge_upsert(old, new, ["k"], null_safe=True)) == [(None, "b")]
    assert rows(tables.merge_counts(old, new, ["k"])) == [(1, 0, 1)] and rows(tables.merge_counts(old, new, ["k"], True)) == [(0, 1, 0)]


def test_refusals(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        tables.merge_into_table(str(tmp_path / "x"), df, ["k"])
    with pytest.raises(tables.PartitionLimitExceeded):
        tables.write_table(df, str(tmp_path / "x"), ["v"], max_partitions=1)
    with pytest.raises(ValueError):
        tables.write_table(df, str(tmp_path / "x"), ["absent"])
    with pytest.raises(ValueError):
        tables.append_partitions(df, str(tmp_path / "x"), [])
    with pytest.raises(ValueError):
        tables.write_table(df, str(tmp_path / "x"), mode="replace")
    with pytest.raises(Exception):
        files.scan_parquet(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        files.scan_by_suffix(spark, "a.xyz")
    with pytest.raises(FileNotFoundError):
        query_lakehouse(spark, str(tmp_path), "SELECT 1", ["t"])


def test_bronze_rerun_replaces_one_day(spark, tmp_path):
    root, day = str(tmp_path), dt.date(2024, 1, 1)
    for n in (3, 2):
        path = tables.bronze_replace_day(spark.range(n), root, "t", day)
    tables.bronze_replace_day(spark.range(5), root, "t", dt.date(2024, 1, 2))
    assert {r["extract_date"]: r["count"] for r in spark.read.parquet(path).groupBy("extract_date").count().collect()} == {
        day: 2, dt.date(2024, 1, 2): 5}


def test_latest_landed_skips_unfinished(spark, tmp_path):
    import os
    for i, name in enumerate(["a.csv", "b.csv", "c.csv.crdownload", "d.tmp"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    assert files.latest_landed_file(spark, str(tmp_path)).first()["path"].endswith("b.csv")


def test_envelope_shapes(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": [{"a": 1}, {"a": 2}], "one": {"a": 3}, "n": 5}')
    pages = files.scan_json(spark, str(tmp_path / "p.json"))
    assert rows(files.envelope_rows(pages, "data")) == [(1,), (2,)]
    assert rows(files.envelope_rows(pages, "one")) == [(3,)]
    assert files.envelope_rows(pages, "n").count() == 0 and files.envelope_rows(pages, "x.y").count() == 0


def test_select_text_and_incremental(spark):
    assert files.build_select("t", ["a", "b"], "a > 1") == "SELECT a, b FROM t WHERE a > 1" and files.build_select("t") == "SELECT * FROM t"
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert rows(files.incremental(df, "x", 1)) == [(2,)] and files.incremental(df, "x", None).count() == 3
    with pytest.raises(ValueError):
        files.scan_database(spark, "jdbc:x", "d")


def test_statement_and_parameters(spark):
    lake = Lakehouse(spark).register_frame("nums_t", spark.range(5))
    lake.execute("CREATE OR REPLACE TEMP VIEW nums_v AS SELECT id * 2 AS d FROM nums_t")
    assert lake.query("SELECT count(*) AS n FROM nums_v WHERE d > :low", {"low": 3}).first()["n"] == 3


def history(spark):
    return spark.createDataFrame(
        [("a", "x", dt.date(2024, 1, 1)), ("a", "x", dt.date(2024, 1, 5)), ("a", "y", dt.date(2024, 2, 1)), ("a", "x", dt.date(2024, 3, 1)),
         ("b", None, dt.date(2024, 1, 1)), ("b", "z", dt.date(2024, 1, 9))], "k string, v string, d date")


def test_scd2_history_and_lookup_ways_agree(spark):
    dim = D.scd2_history(history(spark), "k", ["v"], "d")
    assert [(r["v"], r["effective_from"].month, r["is_current"]) for r in dim.filter("k = 'a'").orderBy("effective_from").collect()] == [
        ("x", 1, False), ("y", 2, False), ("x", 3, True)]
    facts = spark.createDataFrame([(i, k, dt.date(2023, 12, 30) + dt.timedelta(days=3 * i)) for i in range(30) for k in ("a", "b", "c", None)],
                                  "id int, k string, day date")
    joined = facts.join(dim.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & (F.col("day") >= F.col("effective_from"))
                        & (F.col("day") < F.coalesce("effective_to", F.lit(dt.date(9999, 1, 1)))), "left").select("id", "k", "day", "v")
    merged = D.scd2_lookup(facts, dim, "k", "day", ["v"])
    assert rows(joined) == rows(merged.select(*joined.columns)) and joined.count() == 120


def test_null_and_separators_are_changes(spark):
    changes = spark.createDataFrame([("a", None, "z", dt.date(2024, 1, 1)), ("a", "", "z", dt.date(2024, 1, 2)), ("a", "x|y", "z", dt.date(2024, 1, 3)),
                                     ("a", "x", "y|z", dt.date(2024, 1, 4))], "k string, v string, w string, d date")
    assert D.scd2_history(changes, "k", ["v", "w"], "d").count() == 4


def test_overlapping_versions_have_one_answer(spark):
    dim = spark.createDataFrame([("a", "old", dt.date(2024, 1, 1), None), ("a", "new", dt.date(2024, 1, 5), dt.date(2024, 1, 8))],
                                "k string, v string, effective_from date, effective_to date")
    facts = spark.createDataFrame([("a", dt.date(2024, 1, d)) for d in (2, 6, 9)], "k string, day date")
    assert [r["v"] for r in D.scd2_lookup(facts, dim, "k", "day", ["v"]).orderBy("day").collect()] == ["old", "new", None]


@pytest.mark.parametrize("moved,to", [("a:b", "c"), (None, "c"), ("x y/z", "ü=%"), ("007", "7")])
def test_merge_moves_keys_between_any_partitions(spark, tmp_path, moved, to):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, moved), (2, "stays")], "k int, p string")
    tables.merge_into_table(path, old, ["k"], ["p"])
    counts = tables.merge_into_table(path, spark.createDataFrame([(1, to)], old.schema), ["k"], ["p"])
    assert rows(spark.read.schema(old.schema).parquet(path)) == [(1, to), (2, "stays")]
    assert counts == {"unchanged": 1, "updated": 1, "inserted": 0}


def test_merge_recovers_from_a_broken_swap(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "B")], "k int, v string")
    tables.merge_into_table(path, old, ["k"])
    swap = tables._swap

    def half(spark, path):
        (tmp_path / "t").rename(tmp_path / "t.old")
        raise OSError("lost")

    monkeypatch.setattr(tables, "_swap", half)
    with pytest.raises(OSError):
        tables.merge_into_table(path, new, ["k"])
    monkeypatch.setattr(tables, "_swap", swap)
    tables.merge_into_table(path, new, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "B")] and sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_emptied_days_are_empty(spark, tmp_path):
    root, day = str(tmp_path), dt.date(2024, 1, 1)
    path = tables.bronze_replace_day(spark.range(3), root, "t", day)
    tables.bronze_replace_day(spark.range(2), root, "t", dt.date(2024, 1, 2))
    tables.bronze_replace_day(spark.range(0), root, "t", day)
    assert spark.read.parquet(path).count() == 2
    days = str(tmp_path / "days")
    frame = spark.createDataFrame([(1, dt.date(2024, 1, d)) for d in (1, 2, 3)], "v int, day date")
    tables.write_table(frame, days, ["day"])
    tables.overwrite_dates(frame.filter("day <> DATE'2024-01-02'"), days, "day", F.col("day") >= F.lit(dt.date(2024, 1, 2)))
    assert sorted(r["day"].day for r in spark.read.parquet(days).collect()) == [1, 3]


def test_statistics_of_an_append(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_with_stats(spark.range(10).withColumn("p", F.lit("a b")), path, ["p"])
    stats = tables.write_with_stats(spark.range(3).withColumn("p", F.lit("a b")), path, ["p"], mode="append").first()
    assert stats["records_written"] == 3 and stats["files_written"] >= 1


def test_files_of_one_name_are_told_apart(spark, tmp_path):
    from tidelake.plans import flows
    spark.range(1).withColumn("v", F.lit(1)).coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "b"))
    for name in "ab":
        next((tmp_path / name).glob("part*.parquet")).rename(tmp_path / name / "x.parquet")
    out = flows.landed_file_checks(spark, str(tmp_path), "x.parquet", ["id", "v"], (0, 10)).orderBy("row_count").collect()
    assert [(r["row_count"], r["columns_ok"], r["accepted"]) for r in out] == [(1, True, True), (2, False, False)]


def test_fuzzy_keeps_rows_without_a_name(spark):
    from tidelake.operators.cleaning import deduplicate_fuzzy
    df = spark.createDataFrame([(1, None), (2, "abc"), (3, None), (4, "abd")], "id int, name string")
    assert [r["id"] for r in deduplicate_fuzzy(df, "id", "name").orderBy("id").collect()] == [1, 2, 3]


def test_scd2_apply_twice_changes_nothing(spark):
    dim = D.scd2_history(history(spark), "k", ["v"], "d")
    snap = spark.createDataFrame([("a", "n"), ("c", "m")], "k string, v string")
    once = D.scd2_apply(dim, snap, "k", ["v"], F.lit(dt.date(2024, 6, 1)))
    twice = D.scd2_apply(once, snap, "k", ["v"], F.lit(dt.date(2024, 7, 1)))
    assert rows(once) == rows(twice) and once.filter("is_current").count() == 3 and once.count() == dim.count() + 2


def test_late_changes_between_known_days_rebuild_history(spark):
    day = lambda n: dt.date(2024, 1, n)
    frame = lambda *r: spark.createDataFrame(list(r), "k string, v string, d date")
    seen = frame(("a", "x", day(1)), ("a", "x", day(4)), ("a", "x", day(6)), ("a", "y", day(8)), ("b", "x", day(1)), (None, "x", day(2)), (None, "x", day(7)))
    late = frame(("a", "z", day(2)), ("a", "z", day(5)), ("c", "x", day(3)), (None, "w", day(3)), ("a", "n", None))
    dim = D.scd2_history(seen, "k", ["v"], "d")
    got = D.scd2_rebuild(dim, late, "k", ["v"], "d", seen)
    assert rows(got) == rows(D.scd2_history(seen.unionByName(late), "k", ["v"], "d")) and got.count() == 12
    # Behind all known days versions are enough, also for the NULL key.
    later = frame(("a", "y", day(9)), (None, "x", day(9)), (None, "q", day(10)))
    assert rows(D.scd2_rebuild(dim, later, "k", ["v"], "d")) == rows(D.scd2_history(seen.unionByName(later), "k", ["v"], "d"))


def test_late_changes_of_the_query_fall_between_known_days(spark, tmp_path, monkeypatch):
    """Some keys are rebuilt from changes inside their history, others pass through, and no row is left out, with NULL keys and days as well."""
    from queries import all_queries
    lines = spark.range(6000).selectExpr("CASE WHEN id % 97 > 0 THEN id % 97 + 97 * (id % 7) END AS l_partkey", "id % 11 / 100 AS l_discount", "id * 7 % 50 + 1.0 AS l_quantity",
                                         "CASE WHEN id % 53 > 0 THEN CAST(date_add(DATE '1995-01-02', CAST(id * 7919 % 2500 AS INT)) AS TIMESTAMP_NTZ) END AS l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    calls, rebuild = [], D.scd2_rebuild
    monkeypatch.setattr(D, "scd2_rebuild", lambda *a: calls.append(a) or rebuild(*a))
    queries = all_queries()[0]
    assert rows(queries["scd2_late_changes"](spark, str(tmp_path))) == rows(queries["scd2_history"](spark, str(tmp_path)))
    (dimension, late, key, _, date, seen), (_, later, *_) = calls
    spans = seen.groupBy(F.col(key).alias("k")).agg(F.min(date).alias("low"), F.max(date).alias("high"))
    inside = late.join(spans, F.col(key).eqNullSafe(F.col("k"))).filter(F.col(date).between(F.col("low"), F.col("high"))).count()
    passed = dimension.join(late, key, "left_anti").select(key).distinct().count()
    assert inside > 100 and passed > 10 and later.count() > 2 * late.count()
    assert seen.count() + late.count() + later.count() == lines.select("l_partkey", "l_shipdate").distinct().count()


def test_unknown_dimension_key(spark):
    dim = D.surrogate_keys(spark.createDataFrame([("x",), ("y",)], "nk string"), "nk", "sk", start=10)
    out = D.with_dimension_key(spark.createDataFrame([("y",), ("q",), (None,)], "f string"), dim, "nk", "f", "sk")
    assert rows(out.select("f", "sk")) == [("q", -1), ("y", 11), (None, -1)]


def test_config_refuses_unknown_mode(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "src"))
    with pytest.raises(ValueError):
        flows.run_configured(spark, {"name": "t", "source": {"path": str(tmp_path / "src")}, "load": {"mode": "odd"}}, str(tmp_path))


def test_landed_file_with_missing_column(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = flows.landed_file_checks(spark, str(tmp_path / "in"), "*.parquet", ["id", "absent"], (1, 2)).first()
    assert (out["row_count"], out["row_count_ok"], out["columns_ok"], out["accepted"]) == (3, False, False, False)


def test_unreadable_files_are_listed(spark, tmp_path):
    from tidelake.quality.schema import unreadable_files
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
    (tmp_path / "in" / "zz-broken.parquet").write_bytes(b"not parquet at all")
    assert [r["file_name"] for r in unreadable_files(spark, str(tmp_path / "in")).collect()] == ["zz-broken.parquet"]


def test_run_log_grows(spark, tmp_path):
    flow = flows.SilverTransform("t", fill={"v": 0}, dedupe_on=["k"])
    df = spark.createDataFrame([(1, None), (1, 2), (2, 3)], "k int, v int")
    for _ in range(2):
        path = flows.append_run_log(flow.run(df, str(tmp_path)), str(tmp_path))
    log = spark.read.parquet(path)
    assert log.count() == 2 and {(r["records_in"], r["records_out"], r["records_filtered"]) for r in log.collect()} == {(3, 2, 1)}


def test_manifest_and_expiry(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 20))], "k int, day date")
    tables.write_table(df, path, ["day"])
    listed = tables.file_manifest(spark, path).collect()
    assert len(listed) == 2 and all(len(r["md5"]) == 32 and r["size_bytes"] > 0 for r in listed)
    assert tables.drop_expired_partitions(spark, path, "day", dt.date(2024, 1, 25), 10) == ["day=2024-01-01"]
    assert spark.read.parquet(path).count() == 1


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_small_merge_rewrites_its_files_only(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(10_000).selectExpr("id AS k", "id % 4 AS p", "'old' AS v").repartitionByRange(8, "k").write.parquet(str(path))
    before = files_of(path)
    new = spark.createDataFrame([(5, 1, "new"), (6, 2, "new"), (10_001, 1, "new")], "k long, p long, v string")
    assert tables.merge_into_table(str(path), new, ["k"]) == {"unchanged": 9_998, "updated": 2, "inserted": 1}
    after = files_of(path)
    assert len(before) == 8 and len(set(before.items()) & set(after.items())) == 7
    out = spark.read.parquet(str(path))
    assert out.count() == 10_001 and {r["k"] for r in out.filter("v = 'new'").collect()} == {5, 6, 10_001}
    stored, known = spark.read.parquet(str(path)), materialise(new, "merge-rows")  # rows of a known size, as in a merge
    text = tables.key_matches(stored, known, ["k"])._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in text.split("+-") if "FileScan" in x)
    assert "GreaterThanOrEqual(k,5)" in scan and "ReadSchema: struct<k:bigint>" in scan
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("broken", ["before the decision", "halfway"])
def test_merge_is_finished_or_undone(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(i, f"p{i % 3}", "old") for i in range(30)], "k int, p string, v string")
    new = spark.createDataFrame([(1, "p9", "new"), (40, "p0", "new")], old.schema)
    tables.merge_into_table(path, old, ["k"], ["p"])

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if broken == "halfway":
            decide = tables._decide

            def then_lost(spark, staged, files):
                decide(spark, staged, files)
                data = next(tmp_path.glob("t/_merge-*/data/p=*/*.parquet"))  # one file has arrived, the rest has not
                target = tmp_path / "t" / data.parent.name
                target.mkdir(exist_ok=True)
                data.rename(target / data.name)
                m.setattr(tables, "_swap", lost)

            m.setattr(tables, "_decide", then_lost)
        else:
            m.setattr(tables, "_decide", lost)
        with pytest.raises(OSError):
            tables.merge_into_table(path, new, ["k"], ["p"])
    if broken == "before the decision":
        assert spark.read.parquet(path).filter("v = 'new'").count() == 0
    third = spark.createDataFrame([(2, "p2", "third")], old.schema)
    tables.merge_into_table(path, third, ["k"], ["p"])
    values = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert values.pop(2) == "third" and not list(tmp_path.glob("t/_merge-*"))
    if broken == "halfway":
        assert values.pop(1) == "new" and values.pop(40) == "new"
    assert set(values.values()) == {"old"} and spark.read.parquet(path).count() == len(values) + (3 if broken == "halfway" else 1)


def test_merge_of_nothing_and_many_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = spark.range(100).selectExpr("id AS k", "id % 10 AS p")
    tables.write_table(old, path, ["p"])
    before = files_of(tmp_path / "t")
    assert tables.merge_into_table(path, old.limit(0), ["k"], ["p"]) == {"unchanged": 100, "updated": 0, "inserted": 0}
    assert files_of(tmp_path / "t") == before
    monkeypatch.setattr(tables, "MAX_LITERALS", 2)  # more files than are named one by one
    assert tables.merge_into_table(path, spark.range(90, 110).selectExpr("id AS k", "7 AS p"), ["k"], ["p"]) == {"unchanged": 90, "updated": 10, "inserted": 10}
    out = spark.read.parquet(path)
    assert out.count() == 110 and out.filter("k >= 90").select("p").distinct().count() == 1


def test_days_rewritten_from_the_table_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n: dt.date(2024, 1, n)
    tables.write_table(spark.createDataFrame([(i, day(i)) for i in (1, 2, 3)], "v int, day date"), path, ["day"])
    stored = spark.read.parquet(path)
    tables.overwrite_dates(stored.filter("v <> 2").withColumn("v", F.col("v") + 10), path, "day", F.col("day") >= F.lit(day(2)))
    assert rows(spark.read.parquet(path)) == [(1, day(1)), (13, day(3))]
    bronze = tables.bronze_replace_day(spark.range(3), str(tmp_path), "b", day(1))
    tables.bronze_replace_day(spark.read.parquet(bronze).drop("extract_date").filter("id > 5"), str(tmp_path), "b", day(1))
    assert spark.read.schema("id long, extract_date date").parquet(bronze).count() == 0
