"""Schema drift, text formats, JDBC options and month bounds."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaymill import trips as taxi
from quaymill.functions.columns import in_month, iso_text, month_key, parse_iso
from quaymill.operators import sample
from quaymill.operators.schema import columns_first, ensure_column, fit_schema, merge_spellings
from quaymill.plans.bronze import inspect
from quaymill.sources.files import (
    read_batches,
    read_json_lines,
    read_text_csv,
    storage_stats,
    write_json_lines,
)
from quaymill.sources.jdbc import JdbcSource, Slices, count_query, read_options


@pytest.mark.parametrize(
    ("names", "values", "want"),
    [
        (["x", "airport_fee"], (1, "1.5"), [("x", 1), ("Airport_fee", 1.5)]),
        (["Airport_fee", "x"], (1.5, 1), [("Airport_fee", 1.5), ("x", 1)]),
        (["airport_fee", "x", "Airport_fee"], (1.5, 1, None), [("Airport_fee", 1.5), ("x", 1)]),
        (["airport_fee", "x", "Airport_fee"], (1.5, 1, 2.5), [("Airport_fee", 2.5), ("x", 1)]),
        (["x"], (1,), [("x", 1), ("Airport_fee", None)]),
    ],
)
def test_fee_spellings(spark, names, values, want):
    types = {int: "int", float: "double", str: "string", type(None): "double"}
    ddl = ", ".join(f"c{i} {types[type(v)]}" for i, v in enumerate(values))
    frame = spark.createDataFrame([values], ddl).toDF(*names)
    merged = merge_spellings(frame, "Airport_fee", "double")
    assert list(zip(merged.columns, merged.first())) == want
    assert dict(merged.dtypes)["Airport_fee"] == "double"


def test_align_casts_what_fits_and_nulls_the_rest(spark):
    frame = spark.createDataFrame(
        [(1.0, "2", 3, 4, 5), (float("nan"), "N/A", 3, 4, 5)],
        "passenger_count double, RatecodeID string, PULocationID bigint, DOLocationID bigint, "
        "payment_type bigint",
    )
    assert [tuple(row) for row in taxi.align(frame).collect()] == [
        (1, 2, 3, 4, 5, None),
        (None, None, 3, 4, 5, None),
    ]


def test_fit_schema_orders_fills_and_drops(spark):
    frame = spark.createDataFrame([("7", 1, "gone")], "b string, a int, c string")
    schema = StructType.fromDDL("a bigint, b int, missing date, batch_id string")
    fitted = fit_schema(frame, schema, skip=("batch_id",))
    assert fitted.dtypes == [("a", "bigint"), ("b", "int"), ("missing", "date")]
    assert tuple(fitted.first()) == (1, 7, None)


def test_iso_text_both_ways_in_any_session_zone(spark):
    texts = ["2024-03-10T02:30:00.000001", "2024-03-01T08:00:00.5", "2024-13-01T00:00:00.0",
             "2024-03-01", "x", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:30 on that day does not exist in New York.
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        parsed = [row[0] for row in frame.select(parse_iso(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert parsed == [
        dt.datetime(2024, 3, 10, 2, 30, 0, 1),
        dt.datetime(2024, 3, 1, 8, 0, 0, 500000),
        None,
        None,
        None,
        None,
    ]
    back = frame.limit(1).select(iso_text(parse_iso(F.col("t")))).first()[0]
    assert back == texts[0]


def test_month_range_is_the_month_key(spark):
    moments = ["2023-12-31 23:59:59.999999", "2024-01-01 00:00:00", "2024-01-31 23:59:59",
               "2024-02-01 00:00:00", None]
    frame = spark.createDataFrame([(m,) for m in moments], "m string")
    ts = F.col("m").cast("timestamp_ntz")
    rows = frame.select(in_month(ts, "2024-01"), month_key(ts) == "2024-01").collect()
    assert all(row[0] == row[1] for row in rows)
    december = frame.select(in_month(ts, "2023-12")).collect()
    assert [row[0] for row in december] == [True, False, False, False, None]


def test_month_range_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp_ntz'2024-01-05 00:00:00' AS ts").write.parquet(path)
    frame = spark.read.parquet(path).where(in_month(F.col("ts"), "2024-01"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_malformed_json_becomes_null_rows(spark, tmp_path):
    path = tmp_path / "j"
    path.mkdir()
    (path / "a.json").write_text(
        '{"VendorID": 1, "tpep_pickup_datetime": "2024-05-01T00:00:00.000000"}\n'
        '{"VendorID": "two", "trip_distance": 1.5}\n'
        "not json\n"
    )
    rows = taxi.parse_times(read_json_lines(spark, str(path), taxi.json_schema()))
    got = rows.select("VendorID", "tpep_pickup_datetime", "trip_distance").collect()
    assert [tuple(row) for row in got] == [
        (1, dt.datetime(2024, 5, 1), None),
        (None, None, 1.5),
        (None, None, None),
    ]


def test_json_export_fails_on_an_existing_path_and_sets_files(spark, tmp_path):
    path = str(tmp_path / "out")
    write_json_lines(spark.range(100), path, files=3)
    assert len(list((tmp_path / "out").glob("part-*"))) == 3
    with pytest.raises(AnalysisException):
        write_json_lines(spark.range(1), path)


def test_csv_is_all_text_with_empty_as_null(spark, tmp_path):
    path = tmp_path / "z.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,"EWR",Newark,EWR\nN/A,,x,\n')
    rows = read_text_csv(spark, str(path), taxi.ZONE_COLUMNS).collect()
    assert [tuple(row) for row in rows] == [
        ("1", "EWR", "Newark", "EWR"),
        ("N/A", None, "x", None),
    ]


def test_batches_with_drifting_schemas_are_one_frame(spark, tmp_path):
    base = spark.range(2).selectExpr(
        "id AS passenger_count", "id AS RatecodeID", "id AS PULocationID", "id AS DOLocationID",
        "id AS payment_type",
    )
    base.withColumn("airport_fee", F.lit(1.0)).write.parquet(str(tmp_path / "a"))
    base.withColumn("passenger_count", F.col("passenger_count").cast("double")).write.parquet(
        str(tmp_path / "b")
    )
    paths = {"2024-01": str(tmp_path / "a"), "2024-02": str(tmp_path / "b")}
    rows = read_batches(spark, paths, "month", taxi.align)
    got = rows.groupBy("month", "Airport_fee").count().orderBy("month").collect()
    assert [tuple(row) for row in got] == [("2024-01", 1.0, 2), ("2024-02", None, 2)]
    assert dict(rows.dtypes)["passenger_count"] == "int"
    assert rows.where("source_file IS NULL").isEmpty()
    only = rows.where(F.col("month") == "2024-02")._jdf.queryExecution().executedPlan().toString()
    assert only.count("FileScan") == 1


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_batches(spark, {"2024-01": str(tmp_path / "none")}, "month", taxi.align)


def test_storage_stats_count_files_not_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).repartition(3).write.parquet(path)
    stats = storage_stats(spark, path).first()
    assert stats.files == 3
    assert stats.size_bytes == sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))


def test_round_trip_of_a_range(spark, tmp_path):
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 5


def test_inspection_shows_audit_columns_first(spark):
    frame = spark.createDataFrame([(1, "f", "m")] * 9, "x int, source_file string, source_month string")
    assert inspect(frame).columns == ["source_file", "source_month", "x"]
    assert inspect(frame).count() == 5
    assert columns_first(frame, ["source_month"]).columns == ["source_month", "x", "source_file"]
    assert ensure_column(frame, "y", "date").dtypes[-1] == ("y", "date")


@pytest.mark.parametrize("splits", [255, 3])
def test_first_rows_are_those_of_the_order(spark, monkeypatch, splits):
    """A hot value, nulls, NaN, repeated rows and text keys, for sizes below and above all of them."""
    monkeypatch.setattr(sample.first_bound, "__defaults__", (splits,))
    rows = [(None if n % 9 == 0 else n % 7 if n % 3 else 2, f"t{n % 5}", n // 4) for n in range(600)]
    hot = spark.createDataFrame(rows, "k int, t string, id int").repartition(6)
    for order in (["k", "id", "t"], ["t", "k", "id"], ["id", "k", "t"]):
        places = [hot.columns.index(name) for name in order]
        key = lambda row: [(row[at] is not None, row[at] or type(rows[1][at])()) for at in places]
        want = sorted(rows, key=key)
        for size in (0, 1, 130, 599, 700):
            got = [tuple(row) for row in sample.first_rows(hot, size, order).collect()]
            assert sorted(got, key=key) == want[:size]


def test_first_rows_filter_before_they_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).selectExpr("id AS k", "id % 7 AS v").repartition(4).write.parquet(path)
    frame = spark.read.parquet(path)
    near = frame.where(sample.first_bound(frame, 100, ["k", "v"]))
    assert 100 <= near.count() < 1_000
    plan = near.repartitionByRange("k")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange rangepartitioning") < plan.index("Filter") < plan.index("FileScan")
    assert "LessThan(k," in plan


def test_jdbc_options_are_complete_and_partitioned():
    source = JdbcSource("jdbc:x:y", user="u", password="secret", driver="d")
    assert read_options(source, "t", Slices("id", "0", "100", 8)) == {
        "url": "jdbc:x:y",
        "dbtable": "t",
        "user": "u",
        "password": "secret",
        "driver": "d",
        "fetchsize": "10000",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "8",
    }
    assert "secret" not in repr(source)
    assert read_options(JdbcSource("jdbc:x:y"), count_query("t"))["dbtable"] == (
        "(SELECT COUNT(*) AS row_count FROM t) AS counts"
    )
