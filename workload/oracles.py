"""DuckDB SQL for the queries, written from the rules and not from the Spark code."""

from __future__ import annotations

_TRIPS = """
WITH base AS (
  SELECT l.*, o.o_orderdate, c.c_nationkey, s.s_nationkey,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS fare_c,
         CAST(round(l.l_discount * 100) AS BIGINT) AS disc_c,
         CAST(round(l.l_tax * 100) AS BIGINT) AS tax_c,
         l.l_orderkey % 24 * 60 + l.l_partkey % 60 AS m,
         CASE WHEN l.l_partkey % 67 = 0 THEN -5
              WHEN l.l_partkey % 71 = 0 THEN 1441
              WHEN l.l_partkey % 73 = 0 THEN 1440
              ELSE CAST(l.l_quantity AS BIGINT) + 3 END AS d
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
doubled AS (
  SELECT * FROM base UNION ALL SELECT * FROM base WHERE l_orderkey % 50 = 0
),
bronze AS (
  SELECT
    CAST(l_suppkey % 2 + 1 AS INTEGER) AS "VendorID",
    CASE WHEN l_partkey % 307 = 0 THEN NULL
         ELSE CAST(o_orderdate AS TIMESTAMP) + to_minutes(m) END AS tpep_pickup_datetime,
    CAST(o_orderdate AS TIMESTAMP) + to_minutes(m + d) AS tpep_dropoff_datetime,
    CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 151 = 0 THEN 10
         ELSE l_linenumber END AS passenger_count,
    CASE WHEN l_partkey % 89 = 0 THEN NULL
         WHEN l_partkey % 83 = 0 THEN CAST(0 AS DOUBLE)
         WHEN l_partkey % 79 = 0 THEN CAST(200.5 AS DOUBLE)
         ELSE l_quantity / CAST(2 AS DOUBLE) END AS trip_distance,
    l_linenumber % 6 + 1 AS "RatecodeID",
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CASE WHEN l_partkey % 211 = 0 THEN 999 WHEN l_partkey % 223 = 0 THEN NULL
         ELSE c_nationkey END AS "PULocationID",
    CASE WHEN l_partkey % 227 = 0 THEN 999 ELSE s_nationkey END AS "DOLocationID",
    l_linenumber % 5 AS payment_type,
    CASE WHEN l_partkey % 97 = 0 THEN -(fare_c / CAST(100 AS DOUBLE))
         WHEN l_partkey % 103 = 0 THEN NULL
         ELSE fare_c / CAST(100 AS DOUBLE) END AS fare_amount,
    CAST(0.5 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    (fare_c * disc_c // 100) / CAST(100 AS DOUBLE) AS tip_amount,
    CAST(0 AS DOUBLE) AS tolls_amount,
    CAST(1 AS DOUBLE) AS improvement_surcharge,
    (fare_c * (100 + tax_c) // 100) / CAST(100 AS DOUBLE) AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge,
    l_linenumber % 3 * CAST(1.25 AS DOUBLE) AS "Airport_fee",
    CASE WHEN l_partkey % 61 = 0
         THEN strftime(CAST(o_orderdate AS TIMESTAMP) + to_days(40), '%Y-%m')
         ELSE strftime(o_orderdate, '%Y-%m') END AS source_month,
    'lineitem.parquet' AS source_file, 'derived' AS batch_id, 'parquet' AS source_system
  FROM doubled
),
zone AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_id, n_name AS zone_name, r_name AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey
)
"""

_CLASSIFIED = (
    _TRIPS
    + """,
classified AS (
  SELECT b.*,
    CASE
      WHEN tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL
        THEN 'null_pickup_or_dropoff'
      WHEN tpep_dropoff_datetime <= tpep_pickup_datetime THEN 'dropoff_not_after_pickup'
      WHEN strftime(tpep_pickup_datetime, '%Y-%m') <> source_month
        THEN 'pickup_outside_source_month'
      WHEN date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) > 86400
        THEN 'duration_over_24h'
      WHEN trip_distance IS NULL OR trip_distance <= 0 OR trip_distance > 200
        THEN 'invalid_distance'
      WHEN fare_amount < 0 OR total_amount < 0 THEN 'negative_fare_or_total'
      WHEN passenger_count < 0 OR passenger_count > 9 THEN 'invalid_passenger_count'
      WHEN "PULocationID" IS NULL OR "PULocationID" NOT IN (SELECT location_id FROM zone)
        THEN 'unknown_pickup_zone'
      WHEN "DOLocationID" IS NULL OR "DOLocationID" NOT IN (SELECT location_id FROM zone)
        THEN 'unknown_dropoff_zone'
    END AS reject_reason
  FROM bronze b
)
"""
)

_SILVER = (
    _CLASSIFIED
    + """,
ranked AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER g AS copies
  FROM classified WHERE reject_reason IS NULL
  WINDOW
    g AS (PARTITION BY "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID",
          "DOLocationID", fare_amount, total_amount),
    w AS (PARTITION BY "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID",
          "DOLocationID", fare_amount, total_amount
          ORDER BY passenger_count, trip_distance, payment_type)
),
silver AS (
  SELECT
    "VendorID" AS vendor_id, tpep_pickup_datetime AS pickup_ts,
    tpep_dropoff_datetime AS dropoff_ts, passenger_count, trip_distance,
    "RatecodeID" AS rate_code_id, store_and_fwd_flag, "PULocationID" AS pu_location_id,
    "DOLocationID" AS do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
    tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
    "Airport_fee" AS airport_fee,
    date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(60 AS DOUBLE)
      AS trip_duration_min,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(extract(hour FROM tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    p.zone_name AS pickup_zone, p.borough AS pickup_borough,
    d.zone_name AS dropoff_zone, d.borough AS dropoff_borough,
    source_month, batch_id, source_system
  FROM ranked
  LEFT JOIN zone p ON p.location_id = "PULocationID"
  LEFT JOIN zone d ON d.location_id = "DOLocationID"
  WHERE place = 1
),
cents AS (
  SELECT *,
    CAST(round(total_amount * 100) AS BIGINT) AS total_c,
    CAST(round(fare_amount * 100) AS BIGINT) AS silver_fare_c,
    CAST(round(tip_amount * 100) AS BIGINT) AS tip_c,
    CAST(round(trip_distance * 100) AS BIGINT) AS distance_c,
    CAST(round(trip_duration_min * 60) AS BIGINT) AS seconds
  FROM silver
)
"""
)


def _sum(column: str, divisor: str = "100") -> str:
    return f"CAST(sum({column}) AS BIGINT) / CAST({divisor} AS DOUBLE)"


def _mean(column: str) -> str:
    return (
        f"round(CAST(CAST(sum({column}) AS BIGINT) AS DOUBLE) / count({column}))"
        " / CAST(100 AS DOUBLE)"
    )


_MEAN_MINUTES = (
    "round(CAST(CAST(sum(seconds) AS BIGINT) * 100 AS DOUBLE) / (count(seconds) * 60))"
    " / CAST(100 AS DOUBLE)"
)

_DAILY = f"""
SELECT pickup_date, count(*) AS trips, {_sum("total_c")} AS total_revenue,
  {_mean("silver_fare_c")} AS avg_fare, {_mean("distance_c")} AS avg_distance,
  CASE WHEN sum(silver_fare_c) <> 0 THEN
    round(CAST(CAST(sum(tip_c) AS BIGINT) AS DOUBLE) * CAST(10000 AS DOUBLE)
          / CAST(CAST(sum(silver_fare_c) AS BIGINT) AS DOUBLE)) / CAST(10000 AS DOUBLE)
  END AS tip_pct,
  source_month
FROM cents GROUP BY source_month, pickup_date
"""

_ZONE_HOUR = f"""
SELECT pickup_date, pickup_hour, pu_location_id, max(pickup_zone) AS pickup_zone,
  max(pickup_borough) AS pickup_borough, count(*) AS trips,
  {_sum("total_c")} AS total_revenue, {_mean("silver_fare_c")} AS avg_fare,
  {_mean("tip_c")} AS avg_tip, {_mean("distance_c")} AS avg_distance,
  {_MEAN_MINUTES} AS avg_duration_min, source_month
FROM cents GROUP BY source_month, pickup_date, pickup_hour, pu_location_id
"""

_PAYMENT = f"""
SELECT source_month, pickup_borough, payment_type, count(*) AS trips,
  {_sum("total_c")} AS total_revenue, {_mean("tip_c")} AS avg_tip
FROM cents GROUP BY source_month, pickup_borough, payment_type
"""

_LEDGER = """
SELECT source_month, count(*) AS bronze_rows,
  count(*) FILTER (WHERE place = 1) AS silver_rows,
  count(*) FILTER (WHERE reject_reason IS NOT NULL) AS quarantined_rows,
  count(*) FILTER (WHERE place > 1) AS duplicates_removed
FROM (
  SELECT source_month, reject_reason, NULL AS place FROM classified
  WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT source_month, NULL, place FROM ranked
) GROUP BY source_month
"""

_QUARANTINE = _CLASSIFIED + "SELECT * FROM classified WHERE reject_reason IS NOT NULL"

_BOROUGH_TOTALS = (
    _SILVER
    + f"SELECT borough, {_sum('total_c')} AS total_amount FROM cents "
    "JOIN zone ON location_id = pu_location_id GROUP BY borough"
)

_SOURCE_COLUMNS = """
"VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
"RatecodeID", store_and_fwd_flag, "PULocationID", "DOLocationID", payment_type, fare_amount,
extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
congestion_surcharge, "Airport_fee"
"""

_BY_ALL_COLUMNS = ", ".join(f"{name} NULLS FIRST" for name in _SOURCE_COLUMNS.split(","))

_MONTH_SAMPLE = (
    _TRIPS
    + f"SELECT {_SOURCE_COLUMNS} FROM bronze "
    "WHERE strftime(tpep_pickup_datetime, '%Y-%m') = '1996-05' "
    f"ORDER BY {_BY_ALL_COLUMNS} LIMIT 100"
)


def oracle_sql() -> dict[str, str]:
    silver = _SILVER
    return {
        # quality
        "reject_reason_counts": _CLASSIFIED
        + "SELECT coalesce(reject_reason, 'valid') AS reject_reason, count(*) AS rows "
        "FROM classified GROUP BY 1",
        "quarantine_rows": _QUARANTINE,
        "quarantine_histogram": _CLASSIFIED
        + "SELECT reject_reason, count(*) AS rows FROM classified "
        "WHERE reject_reason IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1",
        "month_reconciliation": silver + _LEDGER,
        # dedup, enrichment
        "silver_trips": silver + "SELECT * FROM silver",
        "repeated_trips": silver
        + 'SELECT "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID", '
        '"DOLocationID", fare_amount, total_amount, copies FROM ranked '
        "WHERE place = 1 AND copies > 1",
        "zone_dimension": _TRIPS + "SELECT * FROM zone",
        "known_zone_flags": _TRIPS
        + 'SELECT p.location_id IS NOT NULL AS pickup_known, d.location_id IS NOT NULL '
        "AS dropoff_known, count(*) AS rows FROM bronze "
        'LEFT JOIN zone p ON p.location_id = "PULocationID" '
        'LEFT JOIN zone d ON d.location_id = "DOLocationID" GROUP BY 1, 2',
        "zone_pair_counts": silver
        + "SELECT pickup_zone, pickup_borough, dropoff_zone, dropoff_borough, count(*) AS trips "
        "FROM silver GROUP BY 1, 2, 3, 4",
        # marts
        "daily_summary": silver + _DAILY,
        "revenue_by_zone_hour": silver + _ZONE_HOUR,
        "payment_borough": silver + _PAYMENT,
        "top_zone_hours": silver
        + ", revenue AS ("
        + _ZONE_HOUR
        + ") SELECT pickup_date, pickup_hour, pu_location_id, pickup_zone, pickup_borough, trips, "
        "total_revenue FROM revenue "
        "ORDER BY total_revenue DESC, pickup_date, pickup_hour, pu_location_id LIMIT 10",
        "month_counts": _TRIPS
        + "SELECT source_month, count(*) AS rows FROM bronze GROUP BY 1 ORDER BY 1",
        "month_counts_total": _TRIPS
        + "SELECT source_month, count(*) AS rows, "
        "CAST(grouping(source_month) AS TINYINT) AS is_total "
        "FROM bronze GROUP BY ROLLUP (source_month)",
        "months_present": _TRIPS + "SELECT DISTINCT source_month FROM bronze ORDER BY 1",
        "daily_trips_check": silver
        + "SELECT count(*) AS silver_rows, count(*) AS gold_trips FROM silver",
        # layout queries
        "bench_q1": silver
        + f"SELECT pu_location_id, pickup_hour, {_sum('total_c')} AS revenue, count(*) AS trips "
        "FROM cents WHERE source_month = '1995-03' GROUP BY 1, 2",
        "bench_q2": silver
        + f"SELECT {_sum('total_c')} AS total_amount FROM cents WHERE pu_location_id = 7 "
        "AND pickup_date BETWEEN DATE '1995-03-01' AND DATE '1995-03-07'",
        "bench_q3_broadcast": _BOROUGH_TOTALS,
        "bench_q3_merge": _BOROUGH_TOTALS,
        "clustered_copy": silver + "SELECT * FROM silver",
        "refiled_copy": silver
        + f"SELECT source_month, count(*) AS trips, {_sum('total_c')} AS total_amount "
        "FROM cents GROUP BY source_month",
        # schema
        "align_schema": _TRIPS
        + """SELECT CASE payment_type % 4 WHEN 0 THEN 'lower' WHEN 1 THEN 'upper' WHEN 2 THEN 'both'
               ELSE 'neither' END AS spelling,
            "RatecodeID", passenger_count, count(*) AS rows,
            sum(CASE WHEN payment_type % 4 < 3 THEN "Airport_fee" END) AS fees
          FROM bronze GROUP BY 1, 2, 3""",
        "project_to_schema": _TRIPS
        + 'SELECT "VendorID", CAST(NULL AS VARCHAR) AS trip_type, trip_distance, '
        'CAST("PULocationID" AS BIGINT) AS "PULocationID" FROM bronze',
        "json_roundtrip": _TRIPS + f"SELECT {_SOURCE_COLUMNS} FROM bronze",
        "csv_zones": "SELECT CAST(n_nationkey AS VARCHAR) AS \"LocationID\", "
        'r_name AS "Borough", n_name AS "Zone", \'derived\' AS service_zone '
        "FROM nation JOIN region ON n_regionkey = r_regionkey",
        "pickup_month_sample": _MONTH_SAMPLE,
        "exported_month_sample": _MONTH_SAMPLE,
        "first_trips": _TRIPS
        + f"SELECT {_SOURCE_COLUMNS}, source_month FROM bronze "
        f"ORDER BY {_BY_ALL_COLUMNS}, source_month LIMIT 20000",
        # table writes
        "append_new_months": _TRIPS
        + "SELECT source_month, count(*) AS rows FROM bronze GROUP BY 1",
        "replace_month": silver
        + f"SELECT source_month, count(*) AS trips, {_sum('total_c')} AS total_amount FROM cents "
        "WHERE source_month <> '1996-02' AND (source_month <> '1995-03' OR payment_type <> 1) "
        "GROUP BY source_month",
        "backfill_source_system": _TRIPS
        + "SELECT source_month, CASE WHEN source_month < '1998-01' OR payment_type = 0 "
        "THEN 'parquet' ELSE 'json' END AS source_system, count(*) AS rows FROM bronze "
        "GROUP BY 1, 2",
        "upsert_daily": silver + _DAILY,
        "upsert_metrics": silver
        + """, days AS (SELECT DISTINCT source_month, pickup_date FROM silver)
          SELECT CAST(0 AS BIGINT) AS version, 'MERGE' AS operation,
            count(*) FILTER (WHERE source_month <= '1998-06') AS rows_inserted,
            CAST(0 AS BIGINT) AS rows_updated FROM days
          UNION ALL
          SELECT 1, 'MERGE', count(*) FILTER (WHERE source_month > '1998-06'),
            count(*) FILTER (WHERE source_month BETWEEN '1998-01' AND '1998-06') FROM days""",
        "latest_writes": silver
        + """, counts AS (SELECT count(*) FILTER (WHERE source_month <= '1994-06') AS early,
            count(*) FILTER (WHERE source_month <= '1995-06') AS later,
            count(*) FILTER (WHERE source_month = '1995-03') AS bench,
            count(*) FILTER (WHERE source_month IN ('1995-03', '1996-02')) AS two FROM silver)
          SELECT 'appended' AS table_name, CAST(1 AS BIGINT) AS version, 'APPEND' AS operation,
            bench AS rows_inserted, CAST(NULL AS BIGINT) AS rows_updated FROM counts
          UNION ALL SELECT 'renewed', 1, 'APPEND', later - early, NULL FROM counts
          UNION ALL SELECT 'replaced', 0, 'REPLACE', two, NULL FROM counts
          UNION ALL SELECT 'rewritten', 1, 'OVERWRITE', bench, NULL FROM counts""",
        "layout_stats": silver
        + """SELECT 'small_files' AS copy, count(*) AS rows, CAST(32 AS BIGINT) AS files, true AS has_bytes FROM silver
          UNION ALL SELECT 'clustered', count(*), NULL, true FROM silver""",
        "upsert_moved_keys": silver
        + """SELECT DISTINCT pu_location_id, max(source_month) AS source_month,
            count(*) AS trips FROM silver GROUP BY pu_location_id""",
        # whole flow
        "pipeline_marts": silver
        + f""", daily AS ({_DAILY}), hours AS ({_ZONE_HOUR}), payments AS ({_PAYMENT})
          SELECT 'daily' AS mart, source_month, pickup_date, CAST(NULL AS INTEGER) AS pickup_hour,
            CAST(NULL AS INTEGER) AS pu_location_id, CAST(NULL AS VARCHAR) AS pickup_borough,
            CAST(NULL AS INTEGER) AS payment_type, trips, total_revenue, avg_fare,
            CAST(NULL AS DOUBLE) AS avg_tip, avg_distance,
            CAST(NULL AS DOUBLE) AS avg_duration_min, tip_pct FROM daily
          UNION ALL
          SELECT 'zone_hour', source_month, pickup_date, pickup_hour, pu_location_id,
            pickup_borough, NULL, trips, total_revenue, avg_fare, avg_tip, avg_distance,
            avg_duration_min, NULL FROM hours
          UNION ALL
          SELECT 'payment', source_month, NULL, NULL, NULL, pickup_borough, payment_type, trips,
            total_revenue, NULL, avg_tip, NULL, NULL, NULL FROM payments""",
        "marts_by_month": silver
        + f""", settled AS (SELECT * REPLACE (max(CASE WHEN pu_location_id % 7 <> 3 THEN source_month END)
              OVER (PARTITION BY pickup_date) AS source_month) FROM cents),
            daily AS ({_DAILY.replace("FROM cents", "FROM settled")}),
            hours AS ({_ZONE_HOUR.replace("FROM cents", "FROM settled")})
          SELECT 'daily' AS mart, source_month, pickup_date, CAST(NULL AS INTEGER) AS pickup_hour,
            CAST(NULL AS INTEGER) AS pu_location_id, CAST(NULL AS VARCHAR) AS pickup_zone,
            CAST(NULL AS VARCHAR) AS pickup_borough, trips, total_revenue, avg_fare,
            CAST(NULL AS DOUBLE) AS avg_tip, avg_distance,
            CAST(NULL AS DOUBLE) AS avg_duration_min, tip_pct FROM daily
          UNION ALL
          SELECT 'zone_hour', source_month, pickup_date, pickup_hour, pu_location_id, pickup_zone,
            pickup_borough, trips, total_revenue, avg_fare, avg_tip, avg_distance,
            avg_duration_min, NULL FROM hours""",
        "pipeline_ledger": silver + _LEDGER,
        "pipeline_table_rows": silver
        + """SELECT 'gold/revenue_by_zone_hour' AS table_name, count(*) AS rows FROM
            (SELECT DISTINCT source_month, pickup_date, pickup_hour, pu_location_id FROM silver)
          UNION ALL SELECT 'gold/daily_summary', count(*) FROM
            (SELECT DISTINCT source_month, pickup_date FROM silver)
          UNION ALL SELECT 'gold/payment_borough', count(*) FROM
            (SELECT DISTINCT source_month, pickup_borough, payment_type FROM silver)""",
    }
