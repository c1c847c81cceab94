"""Appends, replacements, upserts and what each leaves behind."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaymill.functions.measures import Exact, Measure, additive
from quaymill.sources.files import data_files
from quaymill.sources.lake import Lake
from quaymill.sources import lake as lake_module
from quaymill.sources.paths import partition_dirs


def rows_of(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def trips(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, month string, v double")


def nothing_staged(lake):
    staging = f"{lake.root}/_staging"
    return not os.path.exists(staging) or os.listdir(staging) == []


def test_append_widens_but_never_retypes(spark, lake):
    lake.append("t", trips(spark, (1, "2024-01", 1.0)), "month")
    wider = trips(spark, (2, "2024-01", 2.0)).withColumn("extra", F.lit("x"))
    lake.append("t", wider, "month")
    assert rows_of(lake.read("t", partition_by="month"), "id", "v", "extra", "month") == [
        (1, 1.0, None, "2024-01"),
        (2, 2.0, "x", "2024-01"),
    ]
    with pytest.raises(TypeError, match="t.v is double, not string"):
        lake.append("t", trips(spark, (3, "2024-01", 1.0)).withColumn("v", F.lit("a")), "month")


def test_append_new_skips_batches_already_there(spark, lake):
    lake.append_new("t", trips(spark, (1, "2024-01", 1.0)), "month")
    lake.append_new("t", trips(spark, (9, "2024-01", 9.0), (2, "2024-02", 2.0), (3, None, 3.0)), "month")
    lake.append_new("t", trips(spark, (8, None, 8.0)), "month")
    assert rows_of(lake.read("t", partition_by="month"), "id", "month") == [
        (1, "2024-01"),
        (2, "2024-02"),
        (3, None),
    ]
    assert lake.batches("t", "month") == [None, "2024-01", "2024-02"]
    assert nothing_staged(lake)


def test_replace_touches_only_named_batches_and_can_empty_them(spark, lake):
    lake.append(
        "t", trips(spark, (1, "2024-01", 1.0), (2, "2024-02", 2.0), (3, "2024-03", 3.0)), "month"
    )
    new = trips(spark, (7, "2024-01", 7.0), (8, "2024-03", 8.0))
    lake.replace_batches("t", new, "month", ["2024-01", "2024-02"])
    assert rows_of(lake.read("t", partition_by="month"), "id") == [(3,), (7,)]
    assert set(partition_dirs(spark, lake.path("t"), "month")) == {"2024-01", "2024-03"}
    lake.replace_batches("t", new, "month", ["2024-01", "2024-02"])
    assert rows_of(lake.read("t", partition_by="month"), "id") == [(3,), (7,)]


def test_replace_creates_a_table_and_reads_it_empty(spark, lake):
    schema = StructType.fromDDL("id int, v double, month string")
    lake.replace_batches("t", trips(spark).limit(0), "month", ["2024-01"])
    assert lake.exists("t")
    assert lake.read("t", schema).count() == 0


def test_partition_values_stay_text_and_odd_names_survive(spark, lake):
    frame = trips(spark, (1, "2024", 1.0), (2, "a/b=c d", 2.0))
    lake.append("t", frame, "month")
    assert dict(lake.read("t", partition_by="month").dtypes)["month"] == "string"
    lake.replace_batches("t", frame.where("id = 1"), "month", ["2024", "a/b=c d"])
    assert rows_of(lake.read("t", partition_by="month"), "id", "month") == [(1, "2024")]


def test_failed_write_leaves_the_old_rows(spark, lake):
    lake.append("t", trips(spark, (1, "2024-01", 1.0)), "month")
    bad = trips(spark, (2, "2024-01", 2.0)).withColumn(
        "id", F.when(F.col("v") > 0, F.raise_error(F.lit("broken"))).cast("int")
    )
    with pytest.raises(Exception, match="broken"):
        lake.replace_batches("t", bad, "month", ["2024-01"])
    assert rows_of(lake.read("t", partition_by="month"), "id") == [(1,)]
    assert nothing_staged(lake)


def test_failed_move_puts_the_old_rows_back(spark, lake, monkeypatch):
    lake.append("t", trips(spark, (1, "2024-01", 1.0), (2, "2024-02", 2.0)), "month")
    real = lake_module.move_path

    def broken(session, source, target):
        if "_staging" in source and "-replaced" not in source:
            raise OSError("no move")
        real(session, source, target)

    monkeypatch.setattr(lake_module, "move_path", broken)
    with pytest.raises(OSError, match="no move"):
        lake.replace_batches("t", trips(spark, (9, "2024-01", 9.0)), "month", ["2024-01"])
    assert rows_of(lake.read("t", partition_by="month"), "id") == [(1,), (2,)]


def test_replace_rows_of_an_unpartitioned_table(spark, lake):
    new = daily(spark, ("a", 1.0), ("b", 2.0), (None, 3.0))
    lake.replace_rows("d", new, F.lit(True))
    lake.replace_rows("d", daily(spark, ("b", 9.0)), F.col("pickup_date") == "b")
    assert rows_of(lake.read("d")) == [("a", 1.0), ("b", 9.0), (None, 3.0)]


def test_partition_column_must_be_text(spark, lake):
    with pytest.raises(TypeError, match="must be text"):
        lake.replace_batches("t", trips(spark, (1, "2024-01", 1.0)), "id", ["1"])


def test_overwrite_replaces_rows_and_schema(spark, lake):
    lake.overwrite("z", spark.createDataFrame([(1, "a")], "k int, n string"))
    lake.overwrite("z", spark.createDataFrame([("x",)], "other string"))
    assert rows_of(lake.read("z")) == [("x",)]


def daily(spark, *rows):
    return spark.createDataFrame(list(rows), "pickup_date string, total_revenue double")


def test_upserting_known_keys_again_adds_no_row(spark, lake):
    keys = [f"2021-0{n}-1{n}" for n in range(1, 6)]
    assert tuple(lake.upsert("d", daily(spark, *[(key, 3.5) for key in keys]), ["pickup_date"])) == (5, 0)
    assert tuple(lake.upsert("d", daily(spark, *[(key, -1.25) for key in keys[1:4]]), ["pickup_date"])) == (0, 3)
    want = [(key, -1.25 if key in keys[1:4] else 3.5) for key in keys]
    assert rows_of(lake.read("d")) == want
    log = rows_of(lake.history("d"), "version", "operation", "rows_inserted", "rows_updated")
    assert log == [(0, "MERGE", 5, 0), (1, "MERGE", 0, 3)]


def test_upsert_matches_null_keys_and_deletes_nothing(spark, lake):
    lake.upsert("d", daily(spark, (None, 1.0), ("a", 2.0)), ["pickup_date"])
    counts = lake.upsert("d", daily(spark, (None, 5.0), ("b", 3.0)), ["pickup_date"])
    assert (counts.rows_inserted, counts.rows_updated) == (1, 1)
    assert rows_of(lake.read("d")) == [("a", 2.0), ("b", 3.0), (None, 5.0)]


def test_upsert_refuses_repeated_source_keys(spark, lake):
    with pytest.raises(ValueError, match="not unique"):
        lake.upsert("d", daily(spark, ("a", 1.0), ("a", 2.0)), ["pickup_date"])
    assert not lake.exists("d")


def test_upsert_moves_keys_between_partitions(spark, lake):
    old = trips(spark, (1, "2024-01", 1.0), (2, "2024-02", 2.0), (3, "2024-03", 3.0))
    lake.upsert("t", old, ["id"], "month")
    before = partition_dirs(spark, lake.path("t"), "month")
    counts = lake.upsert("t", trips(spark, (1, "2024-02", 9.0), (4, None, 4.0)), ["id"], "month")
    assert (counts.rows_inserted, counts.rows_updated) == (1, 1)
    assert rows_of(lake.read("t", partition_by="month"), "id", "month", "v") == [
        (1, "2024-02", 9.0),
        (2, "2024-02", 2.0),
        (3, "2024-03", 3.0),
        (4, None, 4.0),
    ]
    assert "2024-01" in before and lake.batches("t", "month") == [None, "2024-02", "2024-03"]
    assert nothing_staged(lake)


def test_upsert_leaves_other_partitions_files_alone(spark, lake):
    lake.upsert("t", trips(spark, (1, "2024-01", 1.0), (2, "2024-02", 2.0)), ["id"], "month")
    files = lambda m: rows_of(
        lake.read("t").where(F.col("month") == m).select("_metadata.file_path")
    )
    old = files("2024-02")
    lake.upsert("t", trips(spark, (1, "2024-01", 5.0)), ["id"], "month")
    assert files("2024-02") == old


def test_fill_nulls_adds_the_column_and_skips_when_nothing_is_null(spark, lake):
    lake.append("t", trips(spark, (1, "2024-01", 1.0)), "month")
    later = trips(spark, (2, "2024-02", 2.0)).withColumn("system", F.lit("json"))
    lake.append("t", later, "month")
    assert lake.fill_nulls("t", "system", "parquet", "month")
    assert rows_of(lake.read("t", partition_by="month"), "id", "system") == [
        (1, "parquet"),
        (2, "json"),
    ]
    assert lake.latest_write("t").first().rows_updated == 1
    assert not lake.fill_nulls("t", "system", "parquet", "month")


def test_history_counts_writes_per_table(spark, lake):
    lake.append("a", trips(spark, (1, "2024-01", 1.0)), "month")
    lake.append("b", trips(spark, (1, "2024-01", 1.0)), "month")
    lake.replace_batches("a", trips(spark, (1, "2024-01", 2.0)), "month", ["2024-01"])
    log = rows_of(lake.history("a"), "version", "operation", "rows_inserted")
    assert log == [(0, "APPEND", 1), (1, "REPLACE", 1)]
    assert lake.history("none").isEmpty()


def test_needs_a_shared_folder(spark):
    from quaymill.sources.workspace import shared_dir

    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert isinstance(Lake(spark, "/x/").path("t"), str)


def test_replacing_with_another_type_is_refused_and_leaves_the_table(spark, lake):
    lake.append_new("typed", spark.createDataFrame([("2024-01", 7)], "month string, v int"), "month")
    text = spark.createDataFrame([("2024-01", "seven")], "month string, v string")
    with pytest.raises(TypeError):
        lake.replace_batches("typed", text, "month", ["2024-01"])
    with pytest.raises(TypeError):
        lake.upsert("typed", text, ["month"], partition_by="month")
    assert lake.read("typed", partition_by="month").collect()[0]["v"] == 7


def test_a_failed_replacement_of_three_months_is_undone_whole(spark, lake, monkeypatch):
    months = ["2024-01", "2024-02", "2024-03"]
    schema = "month string, v int"
    lake.append_new("three", spark.createDataFrame([(m, 1) for m in months], schema), "month")
    calls = []
    plain = lake_module.move_path

    def failing(session, source, target):
        calls.append(target)
        if len(calls) == 4:
            raise OSError("no space")
        plain(session, source, target)

    monkeypatch.setattr(lake_module, "move_path", failing)
    with pytest.raises(OSError):
        lake.replace_batches("three", spark.createDataFrame([(m, 2) for m in months], schema), "month", months)
    monkeypatch.undo()
    spark.catalog.refreshByPath(lake.path("three"))
    rows = lake.read("three", partition_by="month").collect()
    assert sorted((row["month"], row["v"]) for row in rows) == [(m, 1) for m in months]


def test_upsert_counts_source_keys_and_appends_few_files(spark, lake):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3)], "k string, v int")
    lake.overwrite("copies", old)
    counts = lake.upsert("copies", spark.createDataFrame([("a", 9), ("b", 9)], "k string, v int"), ["k"])
    assert (counts["rows_inserted"], counts["rows_updated"]) == (1, 1)
    rows = spark.range(400).selectExpr("concat('2024-0', id % 4 + 1) AS month", "id").repartition(16)
    lake.append_new("files", rows, "month")
    assert data_files(spark, lake.path("files")).count() <= 8


def test_exact_sums_refuse_what_they_cannot_hold(spark):
    rows = spark.createDataFrame([("k", 10.0), ("k", float("nan"))], "k string, v double")
    measure = Measure("v", "v", 100)
    with pytest.raises(Exception, match="CAST"):
        additive(rows, ["k"], [measure], Exact()).collect()


def test_every_write_records_its_rows(spark, lake):
    rows = spark.range(37).selectExpr("cast(id as int) AS id", "concat('m', id % 3) AS month", "cast(1 as double) AS v")
    lake.append("t", rows.repartition(5), "month")
    lake.replace_batches("t", rows.where("id < 9"), "month", ["m0", "m1"])
    lake.replace_batches("t", rows.limit(0), "month", ["m0"])
    lake.overwrite("u", rows)
    lake.replace_rows("u", rows.where("id < 4"), F.col("id") < 30)
    assert [row["rows_inserted"] for row in lake.history("t").orderBy("version").collect()] == [37, 6, 0]
    assert [row["rows_inserted"] for row in lake.history("u").orderBy("version").collect()] == [37, 4]
    assert lake.read("u").count() == 11


def test_unpartitioned_writes_refuse_other_types(spark, lake):
    lake.overwrite("plain", spark.createDataFrame([("a", 7)], "k string, v int"))
    text = spark.createDataFrame([("a", "seven")], "k string, v string")
    for write in (lambda: lake.upsert("plain", text, ["k"]), lambda: lake.replace_rows("plain", text, F.lit(True))):
        with pytest.raises(TypeError, match="plain.v is int"):
            write()
    assert rows_of(lake.read("plain")) == [("a", 7)]


def test_key_bounds_hold_all_keys_and_reach_the_scan(spark, lake):
    nan = float("nan")
    table = [(n, float(n), "k%02d" % n) for n in range(40)] + [(None, nan, None), (7, None, "k07")]
    schema = "n int, v double, t string"
    lake.overwrite("t", spark.createDataFrame(table, schema))
    for picked in ([table[3], table[9]], [table[40]], [table[5], table[40], table[41]], table):
        source = spark.createDataFrame(picked, schema)
        for keys in (["n"], ["v"], ["t"], ["n", "v", "t"]):
            inside = lake.read("t").where(lake_module.key_bounds(source, keys))
            same = [source[key].eqNullSafe(inside[key]) for key in keys]
            assert source.join(inside, same, "left_anti").isEmpty()
    source = spark.createDataFrame(table[3:9], schema)
    plan = lake.read("t").where(lake_module.key_bounds(source, ["n", "t"]))._jdf.queryExecution().executedPlan().toString()
    assert "qual(n,3), LessThanOrEqual(n,8)" in plan and "GreaterThanOrEqual(t," in plan


def test_upsert_far_from_most_keys_keeps_them(spark, lake):
    lake.overwrite("far", spark.range(500).selectExpr("id AS k", "id AS v"))
    counts = lake.upsert("far", spark.range(490, 510).selectExpr("id AS k", "-id AS v"), ["k"])
    assert (counts["rows_inserted"], counts["rows_updated"]) == (10, 10)
    got = {row["k"]: row["v"] for row in lake.read("far").collect()}
    assert got == {k: k if k < 490 else -k for k in range(510)}


def jobs_of(spark, action):
    """The jobs that an action starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        result = action()
        return result, list(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reading_a_table_starts_no_job(spark, lake):
    first = spark.createDataFrame([(1, "x", "2031-04")], "k int, v string, month string")
    wider = spark.createDataFrame([(2, 0.5, "2031-05")], "k int, w double, month string")
    lake.append_new("kept", first, "month")
    lake.append_new("kept", wider, "month")
    lake.append("plain", first)
    lake.append("plain", wider.drop("month"))
    for table, by in (("kept", "month"), ("plain", None)):
        frame, jobs = jobs_of(spark, lambda: lake.read(table, partition_by=by))
        assert jobs == []
        assert sorted(frame.columns) == ["k", "month", "v", "w"]
        assert frame.select("k", "v", "w").orderBy("k").collect() == [(1, "x", None), (2, None, 0.5)]
    footers = spark.read.option("mergeSchema", True).parquet(lake.path("kept")).schema
    assert {f.name: f.dataType for f in lake.kept_schema("kept")} == {f.name: f.dataType for f in footers}


def test_a_rewritten_table_has_the_new_schema_and_foreign_files_their_own(spark, lake):
    rows = spark.createDataFrame([(1, "x")], "k int, v string")
    lake.overwrite("t", rows)
    lake.overwrite("t", rows.selectExpr("k", "2L AS n"))
    assert lake.read("t").columns == ["k", "n"]
    rows.withColumn("extra", F.lit(True)).write.mode("append").parquet(lake.path("t"))
    assert lake.read("t").columns == ["k", "n"]
    lake.forget_schema("t")
    assert set(lake.read("t").columns) == {"k", "n", "v", "extra"}
    rows.write.parquet(lake.path("foreign"))
    lake.append("foreign", rows.withColumn("late", F.lit(1)))
    assert set(lake.read("foreign").columns) == {"k", "v", "late"}
