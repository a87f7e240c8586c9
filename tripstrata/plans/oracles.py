"""The registered queries as plain SQL over the same tables, written for DuckDB.

Independent of the Spark code: only the event payload text, an input, is shared.
"""

from __future__ import annotations

from tripstrata.sources.star_trips import EVENT_PAYLOAD

_TRIPS = """
joined AS (
  SELECT lineitem.*, o_orderdate, date_diff('day', o_orderdate, l_shipdate) AS gap
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
copied AS (
  SELECT *, 0 AS copy FROM joined
  UNION ALL
  SELECT *, 1 AS copy FROM joined WHERE l_orderkey % 50 = 0),
trips AS (
  SELECT
    CASE WHEN l_returnflag = 'R' THEN 'green' ELSE 'yellow' END AS service_type,
    CAST(nullif(l_suppkey % 3, 0) AS INTEGER) AS vendor_id,
    CASE WHEN l_partkey % 97 <> 0
         THEN o_orderdate + to_minutes(CAST(l_partkey % 2880 AS BIGINT)) END AS pickup_datetime,
    CASE WHEN l_partkey % 89 <> 0
         THEN o_orderdate + to_minutes(CAST(l_partkey % 2880 + gap AS BIGINT)) END AS dropoff_datetime,
    CAST(nullif(l_linenumber, 7) AS INTEGER) AS passenger_count,
    CASE WHEN l_partkey % 83 <> 0 THEN l_quantity * 8 - 20 END AS trip_distance,
    CAST(l_linenumber AS INTEGER) AS rate_code_id,
    l_linestatus AS store_and_fwd_flag,
    CAST(nullif(l_partkey % 28, 13) AS INTEGER) AS pu_location_id,
    CAST(nullif(l_partkey % 31, 30) AS INTEGER) AS do_location_id,
    CAST(nullif(l_partkey % 7, 6) AS INTEGER) AS payment_type,
    l_extendedprice + copy AS fare_amount,
    l_discount AS extra,
    l_tax AS mta_tax,
    l_quantity AS tip_amount,
    l_tax AS tolls_amount,
    l_discount AS improvement_surcharge,
    CASE WHEN l_partkey % 79 <> 0
         THEN CAST(floor(l_extendedprice / 100) - 20 AS DOUBLE) END AS total_amount,
    l_quantity AS congestion_surcharge,
    CASE WHEN l_returnflag <> 'R' THEN l_tax END AS airport_fee,
    concat(CASE WHEN l_returnflag = 'R' THEN 'green' ELSE 'yellow' END, '_tripdata_',
           strftime(o_orderdate, '%Y-%m'), '.parquet') AS source_file_name,
    CAST(year(o_orderdate) AS INTEGER) AS pickup_year,
    CAST(month(o_orderdate) AS INTEGER) AS pickup_month
  FROM copied),
standard AS (
  SELECT *, CAST(trunc((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60) AS INTEGER)
            AS trip_duration_minutes
  FROM trips)"""

_HASH = """sha256(concat_ws('||', service_type, CAST(vendor_id AS VARCHAR),
  strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'), strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S'),
  coalesce(CAST(passenger_count AS VARCHAR), ''), coalesce(CAST(trip_distance AS VARCHAR), ''),
  coalesce(CAST(rate_code_id AS VARCHAR), ''), coalesce(CAST(pu_location_id AS VARCHAR), ''),
  coalesce(CAST(do_location_id AS VARCHAR), ''), coalesce(CAST(payment_type AS VARCHAR), ''),
  coalesce(CAST(total_amount AS VARCHAR), '')))"""

_SILVER = f"""{_TRIPS},
kept AS (
  SELECT *, {_HASH} AS record_hash FROM standard
  WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND pickup_datetime <= dropoff_datetime
    AND trip_distance IS NOT NULL AND trip_distance >= 0 AND trip_distance <= 300
    AND total_amount IS NOT NULL AND total_amount > 0 AND total_amount <= 1000
    AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
    AND trip_duration_minutes BETWEEN 1 AND 720),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY service_type, pickup_year, pickup_month, record_hash
    ORDER BY pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST,
      store_and_fwd_flag NULLS FIRST, fare_amount NULLS FIRST, extra NULLS FIRST,
      mta_tax NULLS FIRST, tip_amount NULLS FIRST, tolls_amount NULLS FIRST,
      improvement_surcharge NULLS FIRST, congestion_surcharge NULLS FIRST,
      airport_fee NULLS FIRST, source_file_name NULLS FIRST) AS copy_rank
  FROM kept),
silver AS (SELECT * EXCLUDE (copy_rank, record_hash) FROM ranked WHERE copy_rank = 1)"""

_ZONES = """zones AS (
  SELECT n_nationkey AS location_id,
    CASE WHEN n_nationkey = 24 THEN 'Unknown' ELSE r_name END AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_GOLD = f"""{_SILVER},
{_ZONES},
zone_metrics AS (
  SELECT pickup_year, pickup_month, service_type, pu_location_id,
    coalesce(borough, 'Unknown') AS borough, coalesce(zone, 'Unknown') AS zone,
    count(*) AS trip_count, sum(total_amount) AS total_revenue,
    avg(total_amount) AS avg_trip_revenue, avg(trip_distance) AS avg_trip_distance,
    avg(trip_duration_minutes) AS avg_trip_duration_minutes,
    CAST(sum(coalesce(passenger_count, 0)) AS BIGINT) AS total_passengers
  FROM silver LEFT JOIN zones ON pu_location_id = location_id
  GROUP BY ALL),
payment_metrics AS (
  SELECT pickup_year, pickup_month, service_type, payment_type, count(*) AS trip_count,
    sum(total_amount) AS total_revenue, avg(total_amount) AS avg_trip_revenue
  FROM silver GROUP BY ALL)"""

_VIOLATIONS = {
    "null_pickup_or_dropoff": "pickup_datetime IS NULL OR dropoff_datetime IS NULL",
    "pickup_after_dropoff": "pickup_datetime > dropoff_datetime",
    "negative_trip_distance": "trip_distance < 0",
    "invalid_total_amount": "total_amount <= 0",
    "null_location_ids": "pu_location_id IS NULL OR do_location_id IS NULL",
    "invalid_duration_range": "NOT (trip_duration_minutes BETWEEN 1 AND 720)",
    "distance_over_cap": "trip_distance > 300",
    "amount_over_cap": "total_amount > 1000",
}

_COMPLIANT = """coalesce(pickup_datetime <= dropoff_datetime
  AND trip_distance BETWEEN 0 AND 300 AND total_amount > 0 AND total_amount <= 1000
  AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
  AND trip_duration_minutes BETWEEN 1 AND 720, false)"""

_REASONS = """concat_ws(',',
  CASE WHEN pickup_datetime IS NULL THEN 'pickup_missing' END,
  CASE WHEN dropoff_datetime IS NULL THEN 'dropoff_missing' END,
  CASE WHEN NOT coalesce(pickup_datetime <= dropoff_datetime, false) THEN 'pickup_after_dropoff' END,
  CASE WHEN trip_distance IS NULL THEN 'distance_missing' END,
  CASE WHEN NOT coalesce(trip_distance >= 0, false) THEN 'distance_negative' END,
  CASE WHEN NOT coalesce(trip_distance <= 300, false) THEN 'distance_over_cap' END,
  CASE WHEN total_amount IS NULL THEN 'amount_missing' END,
  CASE WHEN NOT coalesce(total_amount > 0, false) THEN 'amount_not_positive' END,
  CASE WHEN NOT coalesce(total_amount <= 1000, false) THEN 'amount_over_cap' END,
  CASE WHEN pu_location_id IS NULL THEN 'pickup_location_missing' END,
  CASE WHEN do_location_id IS NULL THEN 'dropoff_location_missing' END,
  CASE WHEN NOT coalesce(trip_duration_minutes BETWEEN 1 AND 720, false)
       THEN 'duration_out_of_range' END)"""

_FILES = """names AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate,
    CASE WHEN o_orderkey % 8 <= 2 THEN concat('yellow_tripdata_', strftime(o_orderdate, '%Y-%m'), '.parquet')
         WHEN o_orderkey % 8 <= 4 THEN concat('green_tripdata_', strftime(o_orderdate, '%Y-%m'), '.parquet')
         WHEN o_orderkey % 8 = 5 THEN concat('fhv_tripdata_', strftime(o_orderdate, '%Y-%m'), '.parquet')
         WHEN o_orderkey % 8 = 6 THEN concat('x_', strftime(o_orderdate, '%Y-%m'), '_copy.parquet')
         WHEN o_orderkey % 16 = 7 THEN 'junk.parquet'
         ELSE concat('green_tripdata_', CAST(year(o_orderdate) AS VARCHAR), '-13.parquet') END AS file_name
  FROM orders),
files AS (
  SELECT concat('/landing/', CAST(o_orderkey AS VARCHAR), '/', file_name) AS path, file_name,
    o_orderstatus = 'F' AS published,
    regexp_matches(file_name, '^(yellow|green)_tripdata_\\d{4}-\\d{2}\\.parquet$') AS accepted
  FROM names)"""

_CLASSIFIED = f"""{_FILES},
classified AS (
  SELECT path, file_name, CASE WHEN accepted THEN 'new_raw_file' END AS event_type,
    CASE WHEN accepted THEN split_part(file_name, '_', 1) END AS service_type,
    CASE WHEN accepted THEN CAST(regexp_extract(file_name, '(\\d{{4}})-(\\d{{2}})', 1) AS INTEGER) END AS year,
    CASE WHEN accepted THEN CAST(regexp_extract(file_name, '(\\d{{4}})-(\\d{{2}})', 2) AS INTEGER) END AS month,
    CASE WHEN accepted THEN path END AS file_path
  FROM files),
reasoned AS (
  SELECT *, CASE WHEN event_type IS NULL THEN 'file_name_not_accepted'
                 WHEN month NOT BETWEEN 1 AND 12 THEN 'invalid_month'
                 WHEN year NOT BETWEEN 2000 AND 2100 THEN 'invalid_year' END AS reject_reason
  FROM classified)"""

_EVENTS = f"""messages AS (SELECT event_id, {EVENT_PAYLOAD} AS payload FROM events),
objects AS (
  SELECT event_id, json_valid(payload) AS valid,
    CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS body FROM messages),
fields AS (
  SELECT event_id, valid, json_type(body) AS kind,
    json_extract_string(body, '$.event_type') AS event_type,
    json_extract_string(body, '$.service_type') AS service_type,
    json_extract_string(body, '$.year') AS year_text,
    json_extract_string(body, '$.month') AS month_text,
    json_extract_string(body, '$.file_path') AS file_path FROM objects),
typed AS (
  SELECT *, try_cast(year_text AS INTEGER) AS year, try_cast(month_text AS INTEGER) AS month FROM fields)"""


def _with(tables: str, query: str) -> str:
    return f"WITH {tables}\n{query}"


def _percent(part: str, whole: str) -> str:
    return f"coalesce(round(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, 4), 0.0)"


_VIOLATION_COUNTS = ", ".join(
    f"count(*) FILTER ({test}) AS {name}" for name, test in _VIOLATIONS.items()
)
_VIOLATION_JSON = " || ',' || ".join(
    f"'\"{name}\":' || CAST(count(*) FILTER ({test}) AS VARCHAR)" for name, test in _VIOLATIONS.items()
)

_METRICS = f"""{_GOLD},
metrics AS (
  SELECT 'zone_mapping_completeness' AS metric_name,
    'Percent of records in gold.monthly_zone_metrics where borough and zone are not Unknown.' AS metric_definition,
    {_percent("count(*) FILTER (borough <> 'Unknown' AND zone <> 'Unknown')", "count(*)")} AS current_value,
    '>= 99.5' AS expected_threshold, 'percent' AS unit, NULL AS violations FROM zone_metrics
  UNION ALL
  SELECT 'gold_row_count', 'Total number of records in gold.monthly_zone_metrics.',
    CAST(count(*) AS DOUBLE), '> 0', 'rows', NULL FROM zone_metrics
  UNION ALL
  SELECT 'silver_rule_compliance', 'Percent of silver records compliant with business quality rules.',
    {_percent(f"count(*) FILTER ({_COMPLIANT})", "count(*)")}, '100', 'percent',
    '{{' || {_VIOLATION_JSON} || '}}' FROM silver),
judged AS (
  SELECT *, 'Every pipeline run' AS update_cadence,
    CASE metric_name WHEN 'zone_mapping_completeness' THEN current_value >= 99.5
                     WHEN 'gold_row_count' THEN current_value > 0
                     ELSE current_value = 100.0 END AS meets_threshold FROM metrics)"""

_PARTITION_COUNTS = """SELECT service_type, pickup_year, pickup_month, count(*) AS row_count
FROM {table} GROUP BY ALL"""

_LATER = "SELECT * REPLACE (CAST(pickup_year + 10 AS INTEGER) AS pickup_year) FROM {table}"

_ZONE_METRICS = _with(_GOLD, "SELECT * FROM zone_metrics")
_PAYMENT_METRICS = _with(_GOLD, "SELECT * FROM payment_metrics")


def _contract(dataset: str, table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, count(*) AS total_rows, '{name}' AS column_name,
        '{kind}' AS expected_type, '{kind}' AS actual_type, count({name}) AS filled_rows,
        count(*) > 0 AS ok FROM {table}"""
        for name, kind in columns.items()
    )


_ZONE_CONTRACT = {
    "pickup_year": "int", "pickup_month": "int", "service_type": "string", "pu_location_id": "int",
    "borough": "string", "zone": "string", "trip_count": "bigint", "total_revenue": "double",
    "avg_trip_revenue": "double", "avg_trip_distance": "double",
    "avg_trip_duration_minutes": "double", "total_passengers": "bigint",
}
_PAYMENT_CONTRACT = {
    "pickup_year": "int", "pickup_month": "int", "service_type": "string", "payment_type": "int",
    "trip_count": "bigint", "total_revenue": "double", "avg_trip_revenue": "double",
}

_REASON = """CASE WHEN NOT valid THEN 'not_json' WHEN kind <> 'OBJECT' THEN 'not_an_object'
               WHEN event_type IS NULL THEN 'missing_event_type'
               WHEN service_type IS NULL THEN 'missing_service_type'
               WHEN year_text IS NULL THEN 'missing_year'
               WHEN year IS NULL THEN 'year_not_an_integer'
               WHEN month_text IS NULL THEN 'missing_month'
               WHEN month IS NULL THEN 'month_not_an_integer'
               WHEN file_path IS NULL THEN 'missing_file_path'
               WHEN event_type <> 'new_raw_file' THEN 'unsupported_event_type'
               WHEN service_type NOT IN ('yellow', 'green') THEN 'unsupported_service_type'
               WHEN month NOT BETWEEN 1 AND 12 THEN 'invalid_month'
               WHEN year NOT BETWEEN 2000 AND 2100 THEN 'invalid_year'
               WHEN file_path = '' THEN 'empty_file_path' END"""

_LATER_NAME = """concat(service_type, '_tripdata_', CAST(pickup_year + 10 AS VARCHAR), '-',
                 lpad(CAST(pickup_month AS VARCHAR), 2, '0'), '.parquet')"""

# Green Februaries keep the trips from even zones only.
_CORRECTED = "NOT (service_type = 'green' AND pickup_month = 2 AND coalesce(pu_location_id % 2, 1) <> 0)"

ORACLES: dict[str, str] = {
    "trip_duration": _with(
        _TRIPS,
        "SELECT service_type, trip_duration_minutes, count(*) AS trips FROM standard GROUP BY ALL",
    ),
    "record_hash": _with(
        _TRIPS,
        f"""SELECT service_type, pickup_year, pickup_month, {_HASH} AS record_hash, count(*) AS copies
        FROM standard GROUP BY ALL""",
    ),
    "standardize_yellow": _with(_TRIPS, "SELECT * FROM standard WHERE service_type = 'yellow'"),
    "standardize_green": _with(_TRIPS, "SELECT * FROM standard WHERE service_type = 'green'"),
    "bronze_enriched": _with(
        _TRIPS,
        """SELECT service_type, vendor_id::BIGINT AS VendorID,
          CASE WHEN service_type = 'yellow' THEN pickup_datetime END AS tpep_pickup_datetime,
          CASE WHEN service_type = 'yellow' THEN dropoff_datetime END AS tpep_dropoff_datetime,
          CASE WHEN service_type = 'green' THEN pickup_datetime END AS lpep_pickup_datetime,
          CASE WHEN service_type = 'green' THEN dropoff_datetime END AS lpep_dropoff_datetime,
          passenger_count::DOUBLE AS passenger_count, trip_distance, rate_code_id::DOUBLE AS RatecodeID,
          store_and_fwd_flag, pu_location_id::BIGINT AS PULocationID,
          do_location_id::BIGINT AS DOLocationID, payment_type::DOUBLE AS payment_type, fare_amount,
          extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
          congestion_surcharge, airport_fee AS Airport_fee, source_file_name, pickup_year, pickup_month
        FROM trips""",
    ),
    "silver_trips": _with(_SILVER, "SELECT * FROM silver"),
    "silver_dedup": _with(
        _SILVER,
        """SELECT service_type, pickup_year, pickup_month, CAST(sum(copies) AS BIGINT) AS rows_before,
          count(*) AS rows_after, CAST(sum(copies) - count(*) AS BIGINT) AS copies_removed,
          max(copies) AS most_copies
        FROM (SELECT service_type, pickup_year, pickup_month, record_hash, count(*) AS copies
              FROM kept GROUP BY ALL)
        GROUP BY ALL""",
    ),
    "reject_reasons": _with(
        _TRIPS,
        f"""SELECT service_type, {_REASONS} AS failed_rules, count(*) AS row_count
        FROM standard GROUP BY ALL""",
    ),
    "gold_monthly_zone_metrics": _ZONE_METRICS,
    "gold_payment_type_metrics": _PAYMENT_METRICS,
    "zone_lookup": _with(_ZONES, "SELECT * FROM zones"),
    "unmatched_trip_pct": _with(
        f"{_SILVER},\n{_ZONES}",
        f"""SELECT count(*) AS total_trips, count(*) FILTER (zone IS NULL) AS unmatched_trips,
          {_percent("count(*) FILTER (zone IS NULL)", "count(*)")} AS unmatched_pct
        FROM silver LEFT JOIN zones ON pu_location_id = location_id""",
    ),
    "scope_grid": _with(
        _TRIPS,
        """SELECT service_type, year, month
        FROM (SELECT DISTINCT service_type FROM trips), (SELECT DISTINCT pickup_year AS year FROM trips),
             (SELECT DISTINCT pickup_month AS month FROM trips)""",
    ),
    "filename_period": _with(
        _FILES,
        """SELECT path, file_name AS source_file_name,
          coalesce(try_cast(regexp_extract(file_name, '(\\d{4})-(\\d{2})', 1) AS INTEGER), 1995) AS pickup_year,
          coalesce(try_cast(regexp_extract(file_name, '(\\d{4})-(\\d{2})', 2) AS INTEGER), 1) AS pickup_month
        FROM files""",
    ),
    "bronze_scan_scope": _with(
        _TRIPS,
        """SELECT service_type, pickup_year IN (1995, 1996, 1997) AND pickup_month <= 6 AS scanned,
          count(DISTINCT source_file_name) AS file_count, count(*) AS row_count
        FROM trips GROUP BY ALL""",
    ),
    "touched_partitions": _with(
        _TRIPS,
        "SELECT DISTINCT service_type, pickup_year, pickup_month FROM trips ORDER BY ALL",
    ),
    "touched_months": _with(
        _TRIPS, "SELECT DISTINCT pickup_year, pickup_month FROM trips ORDER BY ALL"
    ),
    "missing_input_services": _with(
        _CLASSIFIED,
        """SELECT service_type FROM (VALUES ('fhv'), ('green'), ('yellow')) AS requested(service_type)
        WHERE NOT EXISTS (SELECT 1 FROM reasoned
          WHERE reject_reason IS NULL AND reasoned.service_type = requested.service_type)""",
    ),
    "incoming_files_classified": _with(_CLASSIFIED, "SELECT * FROM reasoned"),
    "new_files_anti_join": _with(
        _FILES,
        "SELECT path FROM files WHERE path NOT IN (SELECT path FROM files WHERE published)",
    ),
    "event_validation": _with(
        _EVENTS,
        f"""SELECT event_id, event_type, service_type, year, month, file_path,
          {_REASON} AS reject_reason
        FROM typed""",
    ),
    "silver_rule_violations": _with(
        _TRIPS,
        " UNION ALL ".join(
            f"SELECT '{name}' AS violation, count(*) FILTER ({test}) AS violating_rows FROM standard"
            for name, test in _VIOLATIONS.items()
        ),
    ),
    "silver_rule_compliance": _with(
        _TRIPS,
        f"""SELECT {_percent(f"count(*) FILTER ({_COMPLIANT})", "count(*)")} AS silver_rule_compliance,
          count(*) FILTER ({_COMPLIANT}) AS compliant_rows,
          count(*) FILTER (NOT {_COMPLIANT}) AS non_compliant_rows FROM standard""",
    ),
    "zone_mapping_completeness": _with(
        _GOLD,
        f"""SELECT {_percent("mapped_rows", "total_rows")} AS zone_mapping_completeness,
          mapped_rows, total_rows
        FROM (SELECT count(*) FILTER (borough <> 'Unknown' AND zone <> 'Unknown') AS mapped_rows,
                     count(*) AS total_rows FROM zone_metrics)""",
    ),
    "gold_unmatched_zone_rows": _with(
        _GOLD, "SELECT count(*) FILTER (zone = 'Unknown') AS unmatched_zone_rows FROM zone_metrics"
    ),
    "layer_row_counts": _with(
        _GOLD,
        """SELECT 'bronze_rows' AS layer, count(*) AS row_count FROM trips
        UNION ALL SELECT 'bronze_zone_rows', count(*) FROM zones
        UNION ALL SELECT 'silver_rows', count(*) FROM silver
        UNION ALL SELECT 'gold_monthly_rows', count(*) FROM zone_metrics
        UNION ALL SELECT 'gold_payment_rows', count(*) FROM payment_metrics""",
    ),
    "quality_metrics": _with(_METRICS, "SELECT * FROM judged"),
    "quality_status": _with(
        _METRICS,
        """SELECT CASE metric_name WHEN 'zone_mapping_completeness' THEN 'Zone Mapping Completeness'
                  WHEN 'gold_row_count' THEN 'Gold Row Count' ELSE 'Silver Rule Compliance' END AS metric_title,
          CASE WHEN meets_threshold THEN 'PASS' ELSE 'FAIL' END AS status,
          concat(CASE WHEN unit = 'rows' THEN CAST(CAST(current_value AS BIGINT) AS VARCHAR)
                      ELSE CAST(current_value AS VARCHAR) END, ' ', unit) AS value_text,
          expected_threshold AS threshold_text FROM judged""",
    ),
    "quality_overall": _with(
        _METRICS,
        """SELECT bool_and(meets_threshold) AS all_metrics_pass,
          CASE WHEN bool_and(meets_threshold) THEN 'ALL METRICS PASS'
               ELSE 'SOME METRICS NEED ATTENTION' END AS overall_status FROM judged""",
    ),
    "critical_checks": _with(
        _GOLD,
        f"""SELECT 'silver_non_empty' AS check_name, count(*) > 0 AS passed FROM silver
        UNION ALL SELECT 'gold_monthly_non_empty', count(*) > 0 FROM zone_metrics
        UNION ALL SELECT 'silver_rules_no_violations', {' + '.join(_VIOLATIONS)} = 0
        FROM (SELECT {_VIOLATION_COUNTS} FROM silver)""",
    ),
    "top5_zones_by_revenue": _with(
        _GOLD,
        """SELECT zone, sum(total_revenue) AS zone_revenue FROM zone_metrics
        GROUP BY zone ORDER BY zone_revenue DESC, zone LIMIT 5""",
    ),
    "top10_month_zones_by_revenue": _with(
        _GOLD,
        """SELECT pickup_year, pickup_month, zone, sum(total_revenue) AS total_revenue FROM zone_metrics
        GROUP BY ALL ORDER BY sum(total_revenue) DESC, pickup_year, pickup_month, zone LIMIT 10""",
    ),
    "top_zones_by_trips": _with(
        _GOLD,
        """SELECT pickup_year, pickup_month, zone, CAST(sum(trip_count) AS BIGINT) AS trip_count
        FROM zone_metrics GROUP BY pickup_year, pickup_month, zone
        ORDER BY sum(trip_count) DESC, pickup_year, pickup_month, zone LIMIT 10""",
    ),
    "payment_type_share": _with(
        _GOLD,
        """SELECT pickup_year, pickup_month, service_type, payment_type, trip_count,
          round(CAST(trip_count AS DOUBLE)
            / sum(trip_count) OVER (PARTITION BY pickup_year, pickup_month, service_type), 6) AS trip_share
        FROM payment_metrics""",
    ),
    "monthly_trip_trend": _with(
        _GOLD,
        """SELECT service_type, pickup_year, pickup_month, trip_count,
          trip_count - lag(trip_count) OVER (
            PARTITION BY service_type ORDER BY pickup_year, pickup_month) AS change
        FROM (SELECT service_type, pickup_year, pickup_month, CAST(sum(trip_count) AS BIGINT) AS trip_count
              FROM zone_metrics GROUP BY ALL)""",
    ),
    "service_by_borough": _with(
        _GOLD,
        """SELECT borough,
          CAST(sum(trip_count) FILTER (service_type = 'green') AS BIGINT) AS green_trips,
          sum(total_revenue) FILTER (service_type = 'green') AS green_revenue,
          CAST(sum(trip_count) FILTER (service_type = 'yellow') AS BIGINT) AS yellow_trips,
          sum(total_revenue) FILTER (service_type = 'yellow') AS yellow_revenue
        FROM zone_metrics GROUP BY borough""",
    ),
    "hourly_demand": _with(
        _SILVER,
        """SELECT service_type, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
          count(*) AS trip_count, sum(total_amount) AS total_revenue FROM silver GROUP BY ALL""",
    ),
    "contract_check": _with(
        _GOLD,
        _contract("monthly_zone_metrics", "zone_metrics", _ZONE_CONTRACT)
        + " UNION ALL "
        + _contract("payment_type_metrics", "payment_metrics", _PAYMENT_CONTRACT),
    ),
    "bronze_overwrite_partitions": _with(
        _TRIPS,
        """SELECT service_type, pickup_year, pickup_month,
          CASE WHEN again > 0 THEN again ELSE all_rows END AS row_count,
          CASE WHEN again > 0 THEN again ELSE had END AS changed_rows
        FROM (SELECT service_type, pickup_year, pickup_month, count(*) AS all_rows,
                count(*) FILTER (pickup_year = 1997 AND pu_location_id % 2 = 0) AS again,
                count(*) FILTER (total_amount = 0.25) AS had FROM trips GROUP BY ALL)""",
    ),
    "silver_overwrite_partitions": _with(
        _SILVER, _PARTITION_COUNTS.format(table="(SELECT * FROM silver WHERE pickup_month <> 1)")
    ),
    "rejected_trips": _with(
        _TRIPS,
        f"""SELECT service_type, pickup_year, pickup_month, failed_rules, count(*) AS row_count
        FROM (SELECT service_type, pickup_year, pickup_month, {_REASONS} AS failed_rules FROM standard)
        WHERE failed_rules <> '' GROUP BY ALL""",
    ),
    "gold_overwrite_months": _with(
        _GOLD, "SELECT * FROM zone_metrics WHERE pickup_month <> 2 OR pu_location_id % 2 = 0"
    ),
    "data_freshness": """SELECT round(date_diff('microsecond', max(modified), TIMESTAMP '2030-01-01 00:00:00') / 3.6e9, 4)
          AS data_freshness_hours
        FROM (SELECT o_orderdate AS modified FROM orders UNION ALL SELECT ts FROM events)""",
    "run_stats": _with(
        _GOLD,
        """SELECT 'processed_files' AS stat, count(DISTINCT source_file_name) AS stat_value
          FROM trips WHERE pickup_year <= 2000
        UNION ALL SELECT 'skipped_files', count(DISTINCT source_file_name) FROM trips WHERE pickup_year > 2000
        UNION ALL SELECT 'touched_partitions', count(DISTINCT (service_type, pickup_year, pickup_month))
          FROM trips WHERE pickup_year <= 2000
        UNION ALL SELECT 'touched_months', count(DISTINCT (pickup_year, pickup_month))
          FROM trips WHERE pickup_year <= 2000
        UNION ALL SELECT 'silver_rows', count(*) FROM silver WHERE pickup_year <= 2000
        UNION ALL SELECT 'gold_rows', (SELECT count(*) FROM zone_metrics WHERE pickup_year <= 2000)
          + (SELECT count(*) FROM payment_metrics WHERE pickup_year <= 2000)""",
    ),
    "schema_drift_union": _with(
        _TRIPS,
        """SELECT service_type, pickup_year, pickup_month, count(*) AS row_count,
          CAST(sum(passenger_count) AS BIGINT) AS passengers,
          count(CASE WHEN pickup_month % 4 <> 2 THEN congestion_surcharge END) AS with_congestion,
          count(airport_fee) AS with_airport_fee
        FROM trips GROUP BY ALL""",
    ),
    # The streamed files are named ten years later than the trips they hold.
    "stream_ingest_bronze": _with(
        _TRIPS,
        """SELECT service_type, CAST(pickup_year + 10 AS INTEGER) AS pickup_year, pickup_month,
          concat(service_type, '_tripdata_', CAST(pickup_year + 10 AS VARCHAR), '-',
                 lpad(CAST(pickup_month AS VARCHAR), 2, '0'), '.parquet') AS source_file_name,
          count(*) AS row_count, sum(total_amount) AS total_amount FROM trips GROUP BY ALL""",
    ),
    "stream_medallion_equals_batch": _with(_GOLD, _LATER.format(table="zone_metrics")),
    "stream_redelivery": _with(
        _TRIPS,
        """SELECT service_type, CAST(pickup_year + 10 AS INTEGER) AS pickup_year, pickup_month, count(*) AS row_count,
          sum(CASE WHEN pickup_month = 1 THEN total_amount * 2 ELSE total_amount END) AS total_amount
        FROM trips GROUP BY ALL""",
    ),
    "stream_failed_files": _with(
        _TRIPS,
        """SELECT DISTINCT concat(service_type, '_tripdata_', CAST(pickup_year + 10 AS VARCHAR), '-',
                 lpad(CAST(pickup_month AS VARCHAR), 2, '0'), '.parquet') AS source_file_name,
          CASE WHEN pickup_month = 1 THEN 'missing column trip_distance' ELSE 'handled' END AS outcome FROM trips""",
    ),
    "stream_event_payloads": _with(
        f"{_EVENTS}, judged AS (SELECT *, {_REASON} AS reject_reason FROM typed JOIN messages USING (event_id))",
        """SELECT DISTINCT event_type, service_type, year, month, file_path, CAST(NULL AS VARCHAR) AS payload, reject_reason
        FROM judged WHERE reject_reason IS NULL
        UNION ALL SELECT DISTINCT NULL, NULL, NULL, NULL, NULL, payload, reject_reason FROM judged WHERE reject_reason IS NOT NULL""",
    ),
    "stream_missing_file": _with(
        _TRIPS,
        f"""SELECT {_LATER_NAME} AS source_file_name, CASE WHEN pickup_month = 1 THEN 'missing' ELSE 'handled' END AS outcome,
          count(*) FILTER (pickup_month > 1) AS row_count FROM trips GROUP BY service_type, pickup_year, pickup_month""",
    ),
    "stream_file_order": _with(
        _TRIPS,
        f"""SELECT {_LATER_NAME} AS file_name, CAST(row_number() OVER (ORDER BY pickup_year, pickup_month) - 1 AS INTEGER) AS batch
        FROM (SELECT DISTINCT service_type, pickup_year, pickup_month FROM trips WHERE service_type = 'green')""",
    ),
    "stream_crash_recovery": _with(_GOLD, _LATER.format(table="zone_metrics")),
    "stream_three_batches": _with(
        f"""{_SILVER}, {_ZONES},
        good AS (SELECT * FROM silver LEFT JOIN zones ON pu_location_id = location_id WHERE {_CORRECTED})""",
        f"""SELECT 'bronze_rows' AS name, count(*) AS counted FROM trips WHERE {_CORRECTED}
        UNION ALL SELECT 'bronze_zone_rows', count(*) FROM zones
        UNION ALL SELECT 'silver_rows', count(*) FROM good WHERE pickup_month <> 1
        UNION ALL SELECT 'gold_monthly_rows', count(DISTINCT (pickup_year, pickup_month, service_type, pu_location_id)) FROM good
        UNION ALL SELECT 'gold_payment_rows', count(DISTINCT (pickup_year, pickup_month, service_type, coalesce(payment_type, -1))) FROM good
        UNION ALL SELECT 'gold_unmatched_zone_rows',
          count(DISTINCT (pickup_year, pickup_month, service_type, pu_location_id)) FILTER (zone IS NULL) FROM good
        """ + " ".join(f"UNION ALL SELECT '{name}', 0" for name in _VIOLATIONS),
    ),
    "file_catalog": _with(
        _TRIPS,
        """SELECT CAST(run AS INTEGER) AS run, source_file_name FROM (SELECT DISTINCT source_file_name, pickup_month FROM trips),
          (VALUES (0), (1), (3)) AS runs(run) WHERE run < 3 OR pickup_month = 1""",
    ),
    "product_freshness": _with(
        f"{_SILVER}, months AS (SELECT DISTINCT pickup_year, make_date(pickup_year, pickup_month, 1)::TIMESTAMP AS dated FROM silver)",
        """SELECT part, round(date_diff('microsecond', (SELECT max(dated) FROM months
            WHERE part = 'table' OR part = CAST(pickup_year AS VARCHAR)), TIMESTAMP '2030-01-01 00:00:00') / 3.6e9, 4) AS data_freshness_hours
        FROM (VALUES ('table'), ('1996'), ('nothing')) AS parts(part)""",
    ),
    "stored_report_status": _with(
        _METRICS,
        """SELECT CASE metric_name WHEN 'zone_mapping_completeness' THEN 'Zone Mapping Completeness'
                  WHEN 'gold_row_count' THEN 'Gold Row Count' ELSE 'Silver Rule Compliance' END AS metric_title,
          CASE WHEN meets_threshold THEN 'PASS' ELSE 'FAIL' END AS status,
          concat(CASE WHEN unit = 'rows' THEN CAST(CAST(current_value AS BIGINT) AS VARCHAR)
                      ELSE CAST(current_value AS VARCHAR) END, ' ', unit) AS value_text,
          expected_threshold AS threshold_text,
          CASE WHEN bool_and(meets_threshold) OVER () THEN 'ALL METRICS PASS'
               ELSE 'SOME METRICS NEED ATTENTION' END AS overall_status FROM judged
        UNION ALL SELECT 'Data Freshness Hours', 'PASS', NULL, '< 168',
          CASE WHEN bool_and(meets_threshold) THEN 'ALL METRICS PASS' ELSE 'SOME METRICS NEED ATTENTION' END FROM judged""",
    ),
    "stored_contract": _with(
        _GOLD,
        """SELECT DISTINCT pickup_year, pickup_month, 'type' AS problem, 'trip_count' AS column_name, 'bigint' AS expected_type,
          'string' AS actual_type, CAST(1 AS BIGINT) AS row_count FROM zone_metrics WHERE pickup_year = 1996 AND pickup_month = 3
        UNION ALL SELECT DISTINCT pickup_year, pickup_month, 'missing', 'total_revenue', 'double', NULL, 1
          FROM zone_metrics WHERE pickup_year = 1996 AND pickup_month = 3
        UNION ALL SELECT pickup_year, pickup_month, 'repeated', NULL, NULL, NULL, count(*)
          FROM zone_metrics WHERE pickup_year = 1997 AND pickup_month = 5 GROUP BY ALL""",
    ),
    "gold_from_rollups": _with(
        _GOLD.replace(
            "FROM trips)",
            "FROM (SELECT * REPLACE (CASE WHEN service_type = 'yellow' AND pickup_month <= 6 THEN 7.5 ELSE total_amount END"
            " AS total_amount) FROM trips))",
        ),
        "SELECT * FROM zone_metrics",
    ),
    "stream_idempotent_replay": _with(_GOLD, _LATER.format(table="payment_metrics")),
}
