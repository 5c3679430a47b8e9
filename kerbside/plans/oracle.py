"""The same results as plain SQL, written independently of the operators.

Every query starts from the order tables themselves and derives the trips anew.
"""

from kerbside.plans.published import KEYS, published_sql

_TRIPS = """
keyed AS (
  SELECT l.*, o_orderpriority,
         l_orderkey*7 + l_partkey*13 + l_suppkey*17 + l_linenumber*19
           + CAST(l_quantity AS BIGINT)*23 AS h
  FROM lineitem l LEFT JOIN orders ON l_orderkey = o_orderkey
),
parts AS (
  SELECT *,
    (CASE WHEN h%1009=0 THEN TIMESTAMP '2007-12-05 00:00:00'
          ELSE TIMESTAMP '2025-03-01 00:00:00' END) + to_seconds((h*7919) % 2678400) AS pick,
    CASE WHEN h%97=0 THEN 0 WHEN h%101=0 THEN -60 WHEN h%211=0 THEN 20000
         WHEN h%223=0 THEN 12000 WHEN h%227=0 THEN 30 ELSE 60 + (h*31)%5400 END AS dur,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1 AS ptype,
    CAST(least(h%27, h%31) AS INTEGER) AS pu,
    CASE WHEN h%503=0 THEN 250.0
         ELSE 3.0 + l_quantity*0.5 + floor(l_extendedprice/10000)*0.5 END AS f
  FROM keyed
),
amounts AS (
  SELECT
    CAST(1 + l_linenumber%2 AS INTEGER) AS VendorID,
    pick AS tpep_pickup_datetime,
    pick + to_seconds(dur) AS tpep_dropoff_datetime,
    CASE WHEN h%11=0 THEN NULL ELSE CAST(l_linenumber%7 AS BIGINT) END AS passenger_count,
    CAST(CASE WHEN h%89=0 THEN 0 WHEN h%401=0 THEN l_quantity*2
              ELSE l_quantity*0.25 END AS DOUBLE) AS trip_distance,
    CASE WHEN h%11=0 THEN NULL ELSE 1 + h%6 END AS RatecodeID,
    CASE WHEN h%11=0 THEN NULL WHEN l_linestatus='F' THEN 'N' ELSE 'Y' END AS store_and_fwd_flag,
    pu AS PULocationID,
    CAST(l_partkey%27 AS INTEGER) AS DOLocationID,
    ptype AS payment_type,
    CAST((CASE WHEN h%53=0 THEN -1 WHEN h%59=0 THEN 0 ELSE 1 END) * f AS DOUBLE) AS fare_amount,
    CAST(1.0 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(CASE WHEN ptype=1 THEN round(l_discount*100)*0.25 ELSE 0 END AS DOUBLE) AS tip_amount,
    CAST(CASE WHEN h%17=0 THEN 6.5 ELSE 0 END AS DOUBLE) AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    CAST(CASE WHEN h%11=0 THEN NULL ELSE 2.5 END AS DOUBLE) AS congestion_surcharge,
    CAST(CASE WHEN h%11=0 THEN NULL WHEN pu=3 THEN 1.75 ELSE 0 END AS DOUBLE) AS Airport_fee,
    CAST(0.75 AS DOUBLE) AS cbd_congestion_fee
  FROM parts
),
trips AS (
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount,
         extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
         fare_amount + extra + mta_tax + tip_amount + tolls_amount + improvement_surcharge
           + coalesce(congestion_surcharge, 0) + coalesce(Airport_fee, 0) + cbd_congestion_fee
           AS total_amount,
         congestion_surcharge, Airport_fee, cbd_congestion_fee
  FROM amounts
),
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
timing AS (
  SELECT *, secs / 60.0 AS trip_duration,
         trip_distance / nullif(CAST(secs AS DOUBLE) / 60 / 60, 0) AS average_speed
  FROM (
    SELECT *,
      CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
      strftime(tpep_pickup_datetime, '%a') AS day_of_week,
      CAST(floor(epoch(tpep_dropoff_datetime)) AS BIGINT)
        - CAST(floor(epoch(tpep_pickup_datetime)) AS BIGINT) AS secs
    FROM trips
  )
)"""

_TIMED = "tpep_pickup_datetime IS NOT NULL"
_BOTH_TIMES = f"{_TIMED} AND tpep_dropoff_datetime IS NOT NULL"
_DURATION = "secs / 60.0 > 0 AND secs / 60.0 < 300"

_RULES = {
    "raw": "TRUE",
    "timed": _TIMED,
    "quality": f"{_BOTH_TIMES} AND trip_distance > 0 AND fare_amount >= 0 AND passenger_count > 0 "
    f"AND tpep_dropoff_datetime > tpep_pickup_datetime AND {_DURATION}",
    "payment": f"{_BOTH_TIMES} AND fare_amount > 0 AND total_amount >= 0 AND trip_distance > 0 "
    f"AND {_DURATION}",
    "carpool": f"{_BOTH_TIMES} AND trip_distance > 0 AND fare_amount > 0 AND {_DURATION}",
    "feature": f"{_BOTH_TIMES} AND trip_distance > 0 AND fare_amount >= 0 AND {_DURATION}",
    "model": "total_amount > 0 AND total_amount < 200 AND trip_distance > 0 AND trip_distance < 50",
}


def _sql(rules: str, body: str, more: str = "") -> str:
    return f"WITH {_TRIPS.strip()},\nt AS (SELECT * FROM timing WHERE {_RULES[rules]}){more}\n{body}"


def _round2(value: str) -> str:
    """Half up on the decimal digits of a double."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), 2) AS DOUBLE)"


_SURVIVORS = (
    "SELECT count(*) AS n, sum(trip_distance) AS sum_distance, sum(fare_amount) AS sum_fare, "
    "CAST(sum(secs) AS BIGINT) AS sum_seconds FROM t"
)

_HEAT = ",\nheat AS (SELECT PULocationID, hour, count(*) AS n FROM t GROUP BY 1, 2)"

_GROUPS = """,
slots AS (
  SELECT PULocationID, time_bucket(INTERVAL '10 minutes', tpep_pickup_datetime) AS slot_start,
         count(*) AS trips_in_group, sum(trip_distance) AS total_distance,
         sum(fare_amount) AS total_fare, CAST(sum(secs) AS BIGINT) AS total_seconds
  FROM t WHERE trip_distance < 5 GROUP BY 1, 2
),
pools AS (SELECT * FROM slots WHERE trips_in_group >= 2)"""


def _saved(total: str, rate: str, unit: str = "") -> str:
    share = f"CAST({total} AS DECIMAL(28,6)) * CAST({rate} AS DECIMAL(3,2)){unit}"
    return f"CAST(round(CAST({share} AS DECIMAL(28,6)), 2) AS DOUBLE)"


def _top_zones(key: str) -> str:
    return (
        f"SELECT {key}, Zone, Borough, n FROM "
        f"(SELECT {key}, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, {key} LIMIT 10) "
        f"LEFT JOIN zones ON {key} = LocationID"
    )


def _stat(label: str, call: str, cut: bool = False) -> str:
    def figure(column: str) -> str:
        value = f"CAST({call}({column}) AS DOUBLE)"
        return f"round({value}, 6)" if cut else value

    return (
        f"SELECT '{label}' AS summary, {figure('trip_distance')} AS trip_distance, "
        f"{figure('trip_duration')} AS trip_duration FROM t"
    )


def _cells(key: str, prefix: str, values: range) -> str:
    return ", ".join(
        f"CAST(sum(CASE WHEN {key} = {v} THEN n ELSE 0 END) AS BIGINT) AS {prefix}{v}" for v in values
    )


_TRIP_NAMES = (
    "VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance RatecodeID "
    "store_and_fwd_flag PULocationID DOLocationID payment_type fare_amount extra mta_tax tip_amount "
    "tolls_amount improvement_surcharge total_amount congestion_surcharge Airport_fee "
    "cbd_congestion_fee"
).split()

_ML = (
    "SELECT PULocationID, DOLocationID, trip_distance, hour, day_of_week, total_amount FROM t "
    "WHERE PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND hour IS NOT NULL"
)

ORACLE: dict[str, str] = {
    "scan_trips": _sql(
        "raw",
        f"SELECT {', '.join(_TRIP_NAMES)} FROM (SELECT * REPLACE "
        "(CAST(passenger_count AS DOUBLE) AS passenger_count, "
        "CAST(RatecodeID AS DOUBLE) AS RatecodeID) FROM t)",
    ),
    "zone_lookup": _sql("raw", "SELECT LocationID, Borough, Zone FROM zones"),
    "heatmap_csv_roundtrip": _sql("timed", "SELECT * FROM heat", _HEAT),
    "enrich_trips": _sql(
        "quality",
        "SELECT tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts, "
        "trip_distance, fare_amount, passenger_count, trip_duration, average_speed, hour, "
        "day_of_week, CASE WHEN trip_distance < 10 THEN 'short_trip' ELSE 'long_trip' END "
        "AS trip_category FROM t",
    ),
    "tip_ratios": _sql(
        "payment",
        "SELECT payment_type, fare_amount, tip_amount, tip_amount / fare_amount AS tip_ratio FROM t",
    ),
    "feature_table": _sql(
        "feature",
        "SELECT tpep_pickup_datetime AS pickup_ts, PULocationID, DOLocationID, trip_distance, "
        "fare_amount, trip_duration, average_speed, "
        "CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0 END AS tip_percentage, "
        "hour, day_of_week, "
        "CAST(CASE WHEN hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS INTEGER) "
        "AS is_peak_hour, "
        "CASE WHEN trip_distance < 2 THEN 'short' WHEN trip_distance < 10 THEN 'medium' "
        "ELSE 'long' END AS trip_category, "
        "count(*) OVER (PARTITION BY PULocationID) AS zone_trip_frequency FROM t",
    ),
    "clean_quality": _sql("quality", _SURVIVORS),
    "clean_payment": _sql("payment", _SURVIVORS),
    "clean_carpool": _sql("carpool", _SURVIVORS),
    "clean_feature": _sql("feature", _SURVIVORS),
    "clean_model": _sql("model", _SURVIVORS),
    "profile_summary": _sql(
        "raw",
        "SELECT count(*) AS n, min(tpep_pickup_datetime) AS period_start, "
        "max(tpep_pickup_datetime) AS period_end FROM t",
    ),
    "null_profile": _sql(
        "raw",
        " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS null_count "
            "FROM t"
            for name in _TRIP_NAMES
        ),
    ),
    "outlier_counts": _sql(
        "raw",
        "SELECT count(*) FILTER (WHERE trip_distance <= 0) AS invalid_distance, "
        "count(*) FILTER (WHERE fare_amount < 0) AS negative_fare, "
        "count(*) FILTER (WHERE passenger_count <= 0) AS invalid_passengers, "
        "count(*) FILTER (WHERE tpep_dropoff_datetime <= tpep_pickup_datetime) AS invalid_dates "
        "FROM t",
    ),
    "trip_category_dist": _sql(
        "quality",
        "SELECT CASE WHEN trip_distance < 10 THEN 'short_trip' ELSE 'long_trip' END "
        "AS trip_category, count(*) AS n FROM t GROUP BY 1",
    ),
    "speed_by_hour": _sql(
        "quality",
        f"SELECT hour, {_round2('avg(average_speed)')} AS avg_speed_kmh FROM t GROUP BY hour",
    ),
    "speed_by_day": _sql(
        "quality",
        f"SELECT day_of_week, {_round2('avg(average_speed)')} AS avg_speed_kmh FROM t "
        "GROUP BY day_of_week",
    ),
    "distance_duration_stats": _sql(
        "quality",
        " UNION ALL ".join(
            [
                _stat("count", "count"),
                _stat("mean", "avg", cut=True),
                _stat("stddev", "stddev_samp", cut=True),
                _stat("min", "min"),
                _stat("max", "max"),
            ]
        ),
    ),
    "top_pickup_zones": _sql("timed", _top_zones("PULocationID")),
    "top_dropoff_zones": _sql("timed", _top_zones("DOLocationID")),
    "trips_by_hour": _sql("timed", "SELECT hour, count(*) AS n FROM t GROUP BY hour"),
    "trips_by_day": _sql("timed", "SELECT day_of_week, count(*) AS n FROM t GROUP BY day_of_week"),
    "hotspots": _sql(
        "timed",
        "SELECT hour, PULocationID, Zone, Borough, n FROM "
        "(SELECT * FROM heat ORDER BY n DESC, hour, PULocationID LIMIT 10) "
        "LEFT JOIN zones ON PULocationID = LocationID",
        _HEAT,
    ),
    "od_flows": _sql(
        "timed",
        "SELECT PULocationID, DOLocationID, n, p.Borough AS PU_Borough, p.Zone AS PU_Zone, "
        "d.Borough AS DO_Borough, d.Zone AS DO_Zone FROM "
        "(SELECT PULocationID, DOLocationID, count(*) AS n FROM t GROUP BY 1, 2 "
        "ORDER BY n DESC, 1, 2 LIMIT 10) "
        "LEFT JOIN zones p ON PULocationID = p.LocationID "
        "LEFT JOIN zones d ON DOLocationID = d.LocationID",
    ),
    "payment_distribution": _sql(
        "payment", "SELECT payment_type, count(*) AS n FROM t GROUP BY payment_type"
    ),
    "tip_stats": _sql(
        "payment",
        f"SELECT payment_type, {_round2('avg(tip_amount)')} AS avg_tip, "
        f"{_round2('avg(tip_amount / fare_amount) * 100')} AS avg_tip_percent, "
        f"{_round2('sum(tip_amount)')} AS total_tips FROM t GROUP BY payment_type",
    ),
    "tips_by_hour": _sql(
        "payment", f"SELECT hour, {_round2('avg(tip_amount)')} AS avg_tip FROM t GROUP BY hour"
    ),
    "tips_by_day": _sql(
        "payment",
        f"SELECT day_of_week, {_round2('avg(tip_amount)')} AS avg_tip FROM t GROUP BY day_of_week",
    ),
    "payment_comparison": _sql(
        "payment",
        f"SELECT payment_type, {_round2('avg(total_amount)')} AS avg_total_amount, "
        f"{_round2('avg(trip_distance)')} AS avg_distance, "
        f"{_round2('avg(average_speed)')} AS avg_speed FROM t GROUP BY payment_type",
    ),
    "carpool_groups": _sql(
        "carpool",
        "SELECT PULocationID, slot_start, slot_start + INTERVAL '10 minutes' AS slot_end, "
        "trips_in_group, total_distance, total_fare, total_seconds, "
        "total_seconds / 60.0 AS total_duration FROM pools",
        _GROUPS,
    ),
    "carpool_summary": _sql(
        "carpool",
        "SELECT CAST((SELECT count(*) FROM t WHERE trip_distance < 5) AS BIGINT) AS short_trips, "
        "(SELECT count(*) FROM pools) AS carpool_groups",
        _GROUPS,
    ),
    "carpool_gains": _sql(
        "carpool",
        f"SELECT {_saved('sum(total_distance)', '0.20')} AS distance_saved, "
        f"{_saved('sum(total_fare)', '0.15')} AS fare_saved, "
        f"{_saved('sum(total_seconds)', '0.10', ' / 60')} AS time_saved FROM pools",
        _GROUPS,
    ),
    "feature_trips_by_hour": _sql("feature", "SELECT hour, count(*) AS n FROM t GROUP BY hour"),
    "revenue_by_hour": _sql(
        "feature", f"SELECT hour, {_round2('sum(total_amount)')} AS revenue FROM t GROUP BY hour"
    ),
    "anomaly_counts": _sql(
        "feature",
        "SELECT count(*) FILTER (WHERE trip_distance <= 0.5) AS very_short, "
        "count(*) FILTER (WHERE trip_distance >= 50) AS very_long, "
        "count(*) FILTER (WHERE average_speed > 120) AS too_fast, "
        "count(*) FILTER (WHERE trip_duration > 180) AS too_lengthy FROM t",
    ),
    "zone_frequency": _sql(
        "feature",
        "SELECT PULocationID, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10",
    ),
    "heatmap": _sql("timed", "SELECT * FROM heat", _HEAT),
    "heatmap_kpis": _sql(
        "timed",
        "SELECT count(*) AS cells, CAST(sum(n) AS BIGINT) AS trips, count(DISTINCT hour) AS hours, "
        "count(DISTINCT PULocationID) AS zones FROM heat",
        _HEAT,
    ),
    "heatmap_hourly": _sql(
        "timed", "SELECT hour, CAST(sum(n) AS BIGINT) AS n FROM heat GROUP BY hour", _HEAT
    ),
    "heatmap_top_zones": _sql(
        "timed",
        "SELECT PULocationID, CAST(sum(n) AS BIGINT) AS n FROM heat WHERE PULocationID IS NOT NULL "
        "GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15",
        _HEAT,
    ),
    "heatmap_by_hour": _sql(
        "timed",
        f"SELECT hour, {_cells('PULocationID', 'z', range(27))} FROM heat GROUP BY hour",
        _HEAT,
    ),
    "heatmap_top_n": _sql(
        "timed",
        f"SELECT PULocationID, {_cells('hour', 'h', range(24))} FROM heat WHERE PULocationID IN "
        "(SELECT PULocationID FROM heat GROUP BY 1 ORDER BY sum(n) DESC, 1 LIMIT 15) GROUP BY 1",
        _HEAT,
    ),
    "ml_dataset": _sql("model", _ML),
    "day_index": _sql(
        "model",
        "SELECT day_of_week, n, CAST(row_number() OVER (ORDER BY n DESC, day_of_week) - 1 AS DOUBLE) "
        "AS day_index FROM days",
        f",\ndays AS (SELECT day_of_week, count(*) AS n FROM ({_ML}) GROUP BY day_of_week)",
    ),
}

# Which rows of the model's input are test rows: an MD5 of the seed and all columns, fractions as
# whole millionths.
_PART = (
    f",\nml AS ({_ML}),\nparts_of AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|', 1234, "
    "PULocationID, DOLocationID, CAST(round(trip_distance * 1000000) AS BIGINT), hour, "
    "day_of_week, CAST(round(total_amount * 1000000) AS BIGINT))), 1, 8) AS BIGINT) % 10000 < 2000 "
    "AS is_test FROM ml)"
)

ORACLE |= {
    "split_counts": _sql(
        "model",
        "SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, count(*) AS n "
        "FROM parts_of GROUP BY 1",
        _PART,
    ),
    "fare_test_rows": _sql("model", "SELECT * EXCLUDE (is_test) FROM parts_of WHERE is_test", _PART),
    "fare_model_checks": _sql(
        "model",
        "SELECT count(*) FILTER (WHERE NOT is_test) AS train_rows, "
        "count(*) FILTER (WHERE is_test) AS test_rows, TRUE AS within_labels, "
        "TRUE AS all_predicted, TRUE AS better_than_mean, TRUE AS explains_some FROM parts_of",
        _PART,
    ),
    "fare_sample_rows": _sql(
        "model",
        "SELECT trip_distance, total_amount FROM parts_of WHERE is_test ORDER BY trip_distance, "
        "total_amount, PULocationID, DOLocationID, hour, day_of_week LIMIT 10",
        _PART,
    ),
}

# Value columns of the results that reports publish.
_VALUES = {
    "profile_summary": ["n"],
    "null_profile": ["null_count"],
    "outlier_counts": ["invalid_distance", "negative_fare", "invalid_passengers", "invalid_dates"],
    "speed_by_hour": ["avg_speed_kmh"],
    "speed_by_day": ["avg_speed_kmh"],
    "distance_duration_stats": ["trip_distance", "trip_duration"],
    "tip_stats": ["avg_tip", "avg_tip_percent", "total_tips"],
    "tips_by_hour": ["avg_tip"],
    "tips_by_day": ["avg_tip"],
    "payment_comparison": ["avg_total_amount", "avg_distance", "avg_speed"],
    "carpool_summary": ["short_trips", "carpool_groups"],
    "carpool_gains": ["distance_saved", "fare_saved", "time_saved"],
    "revenue_by_hour": ["revenue"],
    "anomaly_counts": ["very_short", "very_long", "too_fast", "too_lengthy"],
    "heatmap_kpis": ["cells", "trips", "hours", "zones"],
    "heatmap_by_hour": [f"z{zone}" for zone in range(27)],
    "heatmap_top_n": [f"h{hour}" for hour in range(24)],
    "fare_model_metrics": ["train_rows", "test_rows"],
    "fare_model_checks": [
        "train_rows", "test_rows", "within_labels", "all_predicted", "better_than_mean", "explains_some",
    ],
    "fare_prediction_sample": ["trip_distance", "total_amount"],
}
# Published tables whose figures another result's SQL states.
_SAME = {"fare_model_metrics": "fare_model_checks", "fare_prediction_sample": "fare_sample_rows"}
_TOTALS = {"quality": "quality", "spatial": "timed", "features": "feature"}


def _published(report: str) -> str:
    def sql(result: str) -> tuple[str, list[str]]:
        if result in ("trips", "clean_trips"):
            return _sql(_TOTALS[report], "SELECT count(*) AS n FROM t"), ["n"]
        return ORACLE[_SAME.get(result, result)], _VALUES.get(result, ["n"])

    return published_sql(report, sql)


ORACLE |= {f"published_{report}": _published(report) for report in KEYS}
