"""The registered queries in SQL, for an independent engine on the same tables."""

from __future__ import annotations

from tripweave.schemas import TRIP_KEY, TRIP_TIE_BREAK, TRIPS


def _rounded(value: str, digits: int = 2) -> str:
    """Half-up rounding of the shortest decimal form, which is what Spark rounds."""
    exact = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({exact}, {digits}) AS DOUBLE)"


def _ratio(part: str, whole: str, digits: int = 2) -> str:
    return _rounded(f"(({part})::DOUBLE / nullif({whole}, 0))", digits)


def _percent(part: str, whole: str) -> str:
    return _rounded(f"((({part})::DOUBLE / nullif({whole}, 0)) * 100)")


def _change(value: str, order: str) -> str:
    before = f"lag({value}) OVER (ORDER BY {order})"
    return _percent(f"({value}) - ({before})", before)


_HELPERS = """helpers AS (
    SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS sup, l_linenumber AS ln,
        l_quantity AS q, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS e,
        l_shipdate AS d, dup,
        ((l_orderkey * 7 + l_linenumber * 5) % 24) * 3600 + (l_partkey % 60) * 60 AS pick_s,
        CASE WHEN l_partkey % 83 = 0 THEN 0 WHEN l_partkey % 79 = 0 THEN -300
            WHEN l_partkey % 73 = 0 AND l_orderkey % 2 = 0 THEN 10800
            WHEN l_partkey % 73 = 0 THEN 12000
            ELSE (5 + (l_orderkey + l_partkey) % 60) * 60 + (l_orderkey % 4) * 15 END AS dur_s
    FROM lineitem, (VALUES (0), (1)) AS copies(dup)
    WHERE dup = 0 OR l_partkey % 29 = 0
)"""
_BASE = """base AS (
    SELECT
        CAST(CASE WHEN p % 97 <> 0 THEN sup % 2 + 1 END AS INTEGER) AS VendorID,
        CASE WHEN p % 89 <> 0 THEN d + to_seconds(pick_s) END AS tpep_pickup_datetime,
        CASE WHEN p % 71 <> 0 THEN d + to_seconds(pick_s + dur_s) END AS tpep_dropoff_datetime,
        CAST(CASE WHEN p % 41 = 0 THEN NULL WHEN p % 37 = 0 THEN 0 WHEN p % 31 = 0 THEN 7
            ELSE ln % 6 + 1 END AS INTEGER) AS passenger_count,
        CAST(CASE WHEN p % 67 = 0 THEN 0 WHEN p % 61 = 0 AND k % 2 = 0 THEN 100
            WHEN p % 61 = 0 THEN 150 WHEN p % 59 = 0 THEN NULL WHEN sup % 4 = 0 THEN q / 16
            WHEN sup % 4 = 1 THEN q / 8 WHEN sup % 4 = 2 THEN q / 4
            ELSE q / 2 END AS DOUBLE) AS trip_distance,
        CAST(sup % 8 AS INTEGER) AS RatecodeID,
        CASE WHEN k % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
        CAST(sup % 20 + 1 AS INTEGER) AS PULocationID,
        CAST(CASE WHEN p = 7 THEN 264 ELSE p % 20 + 1 END AS INTEGER) AS DOLocationID,
        CAST(k % 6 AS INTEGER) AS payment_type,
        CAST(dup + CASE WHEN p % 53 = 0 THEN 600 WHEN p % 47 = 0 THEN 0
            WHEN p % 43 = 0 THEN -5 WHEN k % 6 = 4 THEN 3 + (e % 8) * 0.5
            WHEN k % 6 = 3 THEN 4 + (e % 40) * 0.5 ELSE 2.5 + e * 0.5 END AS DOUBLE)
            AS fare_amount,
        CAST((ln % 3) * 0.5 AS DOUBLE) AS extra,
        CAST(0.5 AS DOUBLE) AS mta_tax,
        CAST(CASE WHEN sup % 10 = 0 THEN 5.75 ELSE 0 END AS DOUBLE) AS tolls_amount,
        CAST(0.25 AS DOUBLE) AS improvement_surcharge
    FROM helpers
)"""
_TIPPED = """tipped AS (
    SELECT *, CASE payment_type WHEN 1 THEN fare_amount * CAST(0.25 AS DOUBLE)
        WHEN 2 THEN fare_amount * CAST(0.125 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tip_amount
    FROM base
)"""
_TRIPS = f"""trips AS (
    SELECT {", ".join(TRIPS.names)} FROM (
        SELECT *, fare_amount + extra + mta_tax + tip_amount + tolls_amount
            + improvement_surcharge AS total_amount
        FROM tipped)
)"""
_RAW = """raw AS (
    SELECT * FROM trips WHERE VendorID IS NOT NULL AND tpep_pickup_datetime IS NOT NULL
        AND tpep_dropoff_datetime IS NOT NULL
)"""
_TIMED = """timed AS (
    SELECT *, (epoch_us(tpep_dropoff_datetime) // 1000000
            - epoch_us(tpep_pickup_datetime) // 1000000)::DOUBLE / 60 AS trip_duration_minutes
    FROM raw
)"""
_CLOCKED = """clocked AS (
    SELECT *, CASE WHEN trip_duration_minutes > 0
            THEN trip_distance / (trip_duration_minutes / 60)
            ELSE CAST(0 AS DOUBLE) END AS avg_speed_mph,
        CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
        CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
        CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week
    FROM timed
)"""
_ENRICHED = """enriched AS (
    SELECT *, coalesce(trip_distance > 100 OR trip_duration_minutes > 180
        OR avg_speed_mph > 100 OR passenger_count > 6, false) AS is_suspicious
    FROM clocked
)"""
_UNIQUE = f"""uniq AS (
    SELECT * FROM enriched WHERE NOT is_suspicious
    QUALIFY row_number() OVER (PARTITION BY {", ".join(TRIP_KEY)}
        ORDER BY {", ".join(f"{name} ASC NULLS LAST" for name in TRIP_TIE_BREAK)}) = 1
)"""
_REFINED = f"""refined AS (
    SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, pickup_date, pickup_hour,
        pickup_day_of_week, coalesce(pickup_day_of_week IN (1, 7), false) AS is_weekend,
        CASE WHEN pickup_hour >= 6 AND pickup_hour < 12 THEN 'Morning'
            WHEN pickup_hour >= 12 AND pickup_hour < 18 THEN 'Afternoon'
            WHEN pickup_hour >= 18 AND pickup_hour < 22 THEN 'Evening'
            ELSE 'Night' END AS time_of_day,
        passenger_count, trip_distance, trip_duration_minutes, avg_speed_mph, PULocationID,
        DOLocationID, RatecodeID,
        CASE RatecodeID WHEN 1 THEN 'Standard' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
            WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated'
            WHEN 6 THEN 'Group Ride' ELSE 'Unknown' END AS rate_code_name,
        payment_type,
        CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
            WHEN 4 THEN 'Dispute' ELSE 'Unknown' END AS payment_type_name,
        fare_amount, extra, mta_tax, tip_amount,
        {_percent("tip_amount", "fare_amount")} AS tip_percentage,
        tolls_amount, improvement_surcharge, total_amount,
        {_ratio("fare_amount", "trip_distance")} AS fare_per_mile
    FROM uniq
)"""
_SILVER = """silver AS (
    SELECT * FROM refined
    WHERE trip_distance > 0 AND trip_distance < 100
        AND passenger_count > 0 AND passenger_count <= 6
        AND fare_amount > 0 AND fare_amount < 500
        AND trip_duration_minutes > 0 AND trip_duration_minutes < 180
        AND avg_speed_mph > 0 AND avg_speed_mph < 80
        AND tpep_pickup_datetime < tpep_dropoff_datetime
)"""
_CHAIN = (
    _HELPERS, _BASE, _TIPPED, _TRIPS, _RAW, _TIMED, _CLOCKED, _ENRICHED, _UNIQUE, _REFINED,
    _SILVER,
)


def _with(last: str, *more: str) -> str:
    """The steps up to the one named ``last``, followed by ``more``."""
    names = [step.split(" AS ", 1)[0] for step in _CHAIN]
    return "WITH " + ",\n".join((*_CHAIN[: names.index(last) + 1], *more)) + "\n"


_DAILY = f"""daily AS (
    SELECT *, {_ratio("total_fare_amount", "total_trip_distance")} AS avg_fare_per_mile,
        {_percent("credit_card_trips", "total_trips")} AS credit_card_percentage
    FROM (SELECT pickup_date, count(*) AS total_trips,
            count(DISTINCT VendorID) AS unique_vendors,
            avg(trip_distance) AS avg_trip_distance, sum(trip_distance) AS total_trip_distance,
            min(trip_distance) AS min_trip_distance, max(trip_distance) AS max_trip_distance,
            avg(trip_duration_minutes) AS avg_trip_duration,
            min(trip_duration_minutes) AS min_trip_duration,
            max(trip_duration_minutes) AS max_trip_duration,
            avg(fare_amount) AS avg_fare_amount, sum(fare_amount) AS total_fare_amount,
            avg(tip_amount) AS avg_tip_amount, avg(tip_percentage) AS avg_tip_percentage,
            sum(total_amount) AS total_revenue, avg(passenger_count) AS avg_passengers,
            CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
            {_rounded("avg(avg_speed_mph)", 6)} AS avg_speed,
            count(*) FILTER (WHERE payment_type = 1) AS credit_card_trips,
            count(*) FILTER (WHERE payment_type = 2) AS cash_trips,
            count(*) FILTER (WHERE is_weekend) AS weekend_trips
        FROM silver GROUP BY pickup_date)
)"""
_KPIS = f"""kpis AS (
    SELECT pickup_date, total_trips, {_change("total_trips", "pickup_date")} AS trips_change_pct,
        total_passengers, total_miles, total_revenue,
        {_change("total_revenue", "pickup_date")} AS revenue_change_pct,
        total_fare_revenue, total_tip_revenue, avg_revenue_per_trip,
        {_ratio("total_revenue", "total_miles")} AS revenue_per_mile,
        avg_trip_duration, avg_trip_distance, avg_speed, avg_tip_percentage,
        avg_passengers_per_trip,
        {_percent("total_miles", "(total_trips * 10)")} AS utilization_rate,
        24 AS data_freshness_hours
    FROM (SELECT pickup_date, count(*) AS total_trips,
            CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
            sum(trip_distance) AS total_miles, sum(total_amount) AS total_revenue,
            sum(fare_amount) AS total_fare_revenue, sum(tip_amount) AS total_tip_revenue,
            avg(total_amount) AS avg_revenue_per_trip,
            avg(trip_duration_minutes) AS avg_trip_duration,
            avg(trip_distance) AS avg_trip_distance,
            {_rounded("avg(avg_speed_mph)", 6)} AS avg_speed,
            avg(tip_percentage) AS avg_tip_percentage,
            avg(passenger_count) AS avg_passengers_per_trip
        FROM silver GROUP BY pickup_date)
)"""
_PASS_RATE = f"""
    SELECT bronze_records, silver_records,
        coalesce({_percent("silver_records", "bronze_records")}, 0) AS pass_rate_percentage,
        bronze_records - silver_records AS records_dropped
    FROM (SELECT count(*) AS bronze_records FROM enriched),
        (SELECT count(*) AS silver_records FROM silver)"""
_ROUTES = f"""
    SELECT *, CAST(dense_rank() OVER (ORDER BY revenue_per_minute DESC NULLS LAST) AS INTEGER)
            AS profitability_rank,
        CASE WHEN avg_distance < 2 THEN 'Short Distance'
            WHEN avg_distance < 5 THEN 'Medium Distance'
            WHEN avg_distance < 10 THEN 'Long Distance'
            ELSE 'Extra Long Distance' END AS route_type
    FROM (SELECT *, {_ratio("total_revenue", "(avg_distance * trip_count)")} AS revenue_per_mile,
            {_ratio("total_revenue", "(avg_duration * trip_count)")} AS revenue_per_minute
        FROM (SELECT PULocationID, DOLocationID, count(*) AS trip_count,
                avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
                avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip,
                avg(total_amount) AS avg_total_revenue, sum(total_amount) AS total_revenue,
                {_rounded("avg(avg_speed_mph)", 6)} AS avg_speed
            FROM silver GROUP BY PULocationID, DOLocationID HAVING count(*) >= 10))"""

_SUMMARY = f"""
    SELECT *, {_percent("trips_today - avg_trips_7d", "avg_trips_7d")}
            AS trips_vs_7d_avg_pct,
        {_percent("revenue_today - avg_revenue_7d", "avg_revenue_7d")}
            AS revenue_vs_7d_avg_pct,
        'Good' AS data_quality_status
    FROM (SELECT max(pickup_date) AS report_date, count(*) AS trips_today,
            sum(total_amount) AS revenue_today,
            avg(total_amount) AS avg_revenue_per_trip_today
        FROM silver WHERE pickup_date = (SELECT max(pickup_date) FROM silver)),
        (SELECT avg(total_trips) AS avg_trips_7d, avg(total_revenue) AS avg_revenue_7d
        FROM daily WHERE pickup_date >= (SELECT max(pickup_date) FROM silver) - 7),
        (SELECT avg(total_trips) AS avg_trips_30d, avg(total_revenue) AS avg_revenue_30d
        FROM daily WHERE pickup_date >= (SELECT max(pickup_date) FROM silver) - 30)"""

_SEGMENTS = f"""
        SELECT *, {_percent("total_revenue", "(sum(total_revenue) OVER ())")}
                AS revenue_contribution_pct,
            CASE WHEN avg_spend > 30 AND avg_tip_pct > 15 THEN 'Premium'
                WHEN avg_spend > 20 AND trip_count > 100 THEN 'High Value'
                WHEN avg_spend < 10 THEN 'Budget' ELSE 'Standard' END AS customer_segment
        FROM (SELECT payment_type_name, time_of_day, is_weekend, count(*) AS trip_count,
                avg(trip_distance) AS avg_distance, avg(total_amount) AS avg_spend,
                avg(tip_percentage) AS avg_tip_pct, sum(total_amount) AS total_revenue,
                avg(passenger_count) AS avg_passengers
            FROM silver GROUP BY payment_type_name, time_of_day, is_weekend)"""


def _rules_sql(source: str, dataset: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, '{rule}' AS rule,"
        f" count(*) FILTER (WHERE {test}) AS passed,"
        f" count(*) FILTER (WHERE NOT coalesce({test}, false)) AS failed FROM {source}"
        for rule, test in rules.items()
    )


def _expectations_sql() -> str:
    enriched = {
        "positive_trip_distance": "trip_distance > 0",
        "positive_passenger_count": "passenger_count > 0",
        "valid_fare": "fare_amount >= 0",
        "valid_trip_duration": "trip_duration_minutes > 0",
    }
    refined = {
        "valid_trip_distance": "(trip_distance > 0 AND trip_distance < 100)",
        "valid_passenger_count": "(passenger_count > 0 AND passenger_count <= 6)",
        "valid_fare": "(fare_amount > 0 AND fare_amount < 500)",
        "valid_duration": "(trip_duration_minutes > 0 AND trip_duration_minutes < 180)",
        "valid_speed": "(avg_speed_mph > 0 AND avg_speed_mph < 80)",
        "logical_timestamps": "tpep_pickup_datetime < tpep_dropoff_datetime",
    }
    parts = (
        _rules_sql("trips", "bronze_taxi_raw", _RAW_RULES),
        _rules_sql("enriched", "bronze_taxi_enriched", enriched),
        _rules_sql("refined", "silver_taxi_trips", refined),
    )
    return "\nUNION ALL\n".join(parts)


def _null_pct(name: str) -> str:
    return (
        f"coalesce(count(*) FILTER (WHERE {name} IS NULL)::DOUBLE / nullif(count(*), 0) * 100, 0)"
    )


def _table_quality(table: str, critical: list[str], non_negative: list[str]) -> str:
    metrics = {f"{c}_null_percentage": _null_pct(c) for c in critical}
    metrics |= {
        f"{c}_negative_count": f"(count(*) FILTER (WHERE {c} < 0))::DOUBLE" for c in non_negative
    }
    score = "CAST(100 AS DOUBLE)" + "".join(f" - {_null_pct(c)} * 2" for c in critical)
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{metric}' AS metric, {value} AS value,"
        f" count(*) AS total_records, {score} AS quality_score FROM {table}"
        for metric, value in metrics.items()
    )


def _text_of(name: str) -> str:
    kind = TRIPS[name].dataType.typeName()
    text = f"strftime({name}, '%Y-%m-%d %H:%M:%S')" if kind == "timestamp" else f"CAST({name} AS VARCHAR)"
    if name == "tpep_pickup_datetime":
        text = f"CASE WHEN PULocationID = 7 AND {name} IS NOT NULL THEN 'not a time' ELSE {text} END"
    if name == "passenger_count":
        text = f"CASE WHEN PULocationID = 10 THEN 'two' ELSE {text} END"
    return f"coalesce({text}, '')"


def _damaged_sql() -> str:
    """Trips whose lines are damaged for some pickup zones: what is read of them, and the lines."""
    texts = [_text_of(name) for name in TRIPS.names]
    read = []
    for at, name in enumerate(TRIPS.names):
        lost = "PULocationID = 9" if at >= 5 else ""
        lost = {"tpep_pickup_datetime": "PULocationID = 7", "passenger_count": "PULocationID = 10"}.get(name, lost)
        read.append(f"CASE WHEN NOT ({lost}) THEN {name} END AS {name}" if lost else name)
    return f"""damaged AS (
    SELECT {", ".join(read)},
        CASE WHEN PULocationID = 7 AND tpep_pickup_datetime IS NOT NULL
                OR PULocationID IN (8, 9, 10) THEN
            CASE PULocationID WHEN 9 THEN {" || ',' || ".join(texts[:5])}
                ELSE {" || ',' || ".join(texts)} END
            || CASE PULocationID WHEN 8 THEN ',surplus' ELSE '' END END AS raw_line
    FROM trips
),
judged AS (
    SELECT *, VendorID IS NOT NULL AND tpep_pickup_datetime IS NOT NULL
            AND tpep_dropoff_datetime IS NOT NULL AS kept,
        concat_ws(',', CASE WHEN VendorID IS NULL THEN 'valid_vendor' END,
            CASE WHEN tpep_pickup_datetime IS NULL THEN 'valid_pickup_time' END,
            CASE WHEN tpep_dropoff_datetime IS NULL THEN 'valid_dropoff_time' END,
            CASE WHEN raw_line IS NOT NULL THEN 'fits_layout' END) AS failed_rules
    FROM damaged
)"""


_RAW_RULES = {
    "valid_vendor": "VendorID IS NOT NULL",
    "valid_pickup_time": "tpep_pickup_datetime IS NOT NULL",
    "valid_dropoff_time": "tpep_dropoff_datetime IS NOT NULL",
}


def _stored_sql() -> dict[str, str]:
    """Twins of the queries that store, stream or bring up to date."""
    trips = _with("trips") + "SELECT * FROM trips"
    changed = """changed AS (
    SELECT * REPLACE (CASE WHEN RatecodeID = 5 THEN fare_amount + 1 ELSE fare_amount END AS fare_amount)
    FROM silver WHERE RatecodeID <> 7
)"""
    daily, kpis = (step.replace("FROM silver", "FROM changed") for step in (_DAILY, _KPIS))
    damaged = _with("trips", _damaged_sql())
    columns = ", ".join(TRIPS.names)
    return {
        "rejected_lines": damaged
        + f"SELECT {columns}, raw_line, failed_rules, kept FROM judged WHERE failed_rules <> ''",
        "damaged_lines_report": damaged
        + "SELECT *, CASE rule WHEN 'fits_layout' THEN 'warn' ELSE 'drop' END AS mode FROM ("
        + _rules_sql("judged", "bronze_taxi_raw", _RAW_RULES | {"fits_layout": "raw_line IS NULL"})
        + ")",
        "daily_stats_from_changes": _with("silver", changed, daily) + "SELECT * FROM daily",
        "daily_kpis_from_changes": _with("silver", changed, kpis) + "SELECT * FROM kpis",
        "streamed_silver": _with("silver") + "SELECT * FROM silver",
        "stream_expectations": _with("trips") + _rules_sql("trips", "bronze_taxi_raw", _RAW_RULES),
        "stream_on_an_interval": trips,
        "stream_with_archive": trips,
        "touched_dates": _with("silver")
        + """SELECT pickup_date, PULocationID, total_amount,
            CASE WHEN year(pickup_date) = 1997 THEN fare_amount * 2 ELSE fare_amount END AS fare_amount
        FROM silver WHERE NOT (year(pickup_date) = 1997 AND month(pickup_date) = 5)""",
        "described_table": _with("silver")
        + f"""SELECT *, 'gold' AS quality, 'marketing_team' AS business_owner,
            'Spending segments' AS comment FROM ({_SEGMENTS})""",
        "job_metadata": _with("trips")
        + """SELECT PULocationID, DOLocationID, total_amount, 'lineitem' AS data_source,
            'bronze' AS pipeline_stage, 'public' AS data_classification,
            'transportation' AS business_domain, 'bronze_taxi_ingestion' AS ingestion_job,
            DATE '2022-02-02' AS processing_date
        FROM trips""",
        "geo_layout": _with("trips")
        + """SELECT CAST(VendorID AS VARCHAR) AS VendorID,
            strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
            strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime,
            passenger_count::DOUBLE AS passenger_count, trip_distance,
            PULocationID / 4 - 74 AS pickup_longitude, PULocationID / 8 + 40 AS pickup_latitude,
            CAST(RatecodeID AS VARCHAR) AS RatecodeID, store_and_fwd_flag,
            DOLocationID / 4 - 74 AS dropoff_longitude, DOLocationID / 8 + 40 AS dropoff_latitude,
            CAST(payment_type AS VARCHAR) AS payment_type, fare_amount, extra, mta_tax, tip_amount,
            tolls_amount, total_amount, tpep_pickup_datetime AS pickup_datetime,
            CASE WHEN passenger_count > 0 THEN passenger_count ELSE 1 END::DOUBLE
                AS passenger_count_clean,
            CASE WHEN trip_distance <= 0 OR total_amount <= 0 OR tpep_pickup_datetime IS NULL
                THEN 'SUSPICIOUS' ELSE 'CLEAN' END AS data_quality_flag
        FROM trips""",
    }


def oracle_sql() -> dict[str, str]:
    return _report_sql() | _stored_sql()


def _report_sql() -> dict[str, str]:
    trips = _with("trips") + "SELECT * FROM trips"
    return {
        "trips_source": trips,
        "csv_roundtrip": trips,
        "stream_ingest": trips,
        "bronze_raw": _with("raw") + "SELECT *, '' AS environment FROM raw",
        "bronze_enriched": _with("enriched") + "SELECT *, '' AS environment FROM enriched",
        "bronze_quality": _with("enriched")
        + f"""SELECT *, {_rounded("((1 - suspicious_records::DOUBLE / total_records) * 100)")}
            AS data_quality_score
        FROM (SELECT pickup_date, count(*) AS total_records,
                count(*) FILTER (WHERE is_suspicious) AS suspicious_records,
                avg(trip_distance) AS avg_trip_distance,
                avg(trip_duration_minutes) AS avg_trip_duration,
                avg(fare_amount) AS avg_fare_amount,
                min(tpep_pickup_datetime) AS earliest_pickup,
                max(tpep_pickup_datetime) AS latest_pickup
            FROM enriched GROUP BY pickup_date)""",
        "silver_trips": _with("silver") + "SELECT * FROM silver",
        "daily_stats": _with("silver", _DAILY) + "SELECT * FROM daily",
        "partitioned_sink": _with("silver", _DAILY) + "SELECT * FROM daily",
        "hourly_location_stats": _with("silver")
        + """SELECT *, CAST(dense_rank() OVER (PARTITION BY pickup_date, pickup_hour
                ORDER BY trip_count DESC) AS INTEGER) AS trips_rank
        FROM (SELECT pickup_date, pickup_hour, PULocationID, count(*) AS trip_count,
                avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
                avg(fare_amount) AS avg_fare, avg(passenger_count) AS avg_passengers,
                count(DISTINCT DOLocationID) AS unique_destinations
            FROM silver GROUP BY pickup_date, pickup_hour, PULocationID)""",
        "payment_analysis": _with("silver")
        + f"""SELECT *, {_percent("total_revenue",
                "(sum(total_revenue) OVER (PARTITION BY pickup_date))")} AS revenue_percentage
        FROM (SELECT pickup_date, payment_type_name, time_of_day, count(*) AS trip_count,
                avg(tip_amount) AS avg_tip_amount, avg(tip_percentage) AS avg_tip_percentage,
                avg(fare_amount) AS avg_fare_amount, avg(total_amount) AS avg_total_amount,
                sum(total_amount) AS total_revenue
            FROM silver GROUP BY pickup_date, payment_type_name, time_of_day)""",
        "silver_quality": _with("silver") + _PASS_RATE,
        "quality_trend": _with("silver")
        + f"SELECT pass_rate_percentage, records_dropped FROM ({_PASS_RATE})",
        "daily_kpis": _with("silver", _KPIS) + "SELECT * FROM kpis",
        "latest_kpis_topk": _with("silver", _KPIS)
        + "SELECT * FROM kpis ORDER BY pickup_date DESC LIMIT 7",
        "peak_hours": _with("silver")
        + f"""SELECT *, CAST(dense_rank() OVER (PARTITION BY is_weekend
                ORDER BY avg_trips_per_day DESC) AS INTEGER) AS demand_rank
        FROM (SELECT *, {_ratio("total_trips", "days_observed", 0)} AS avg_trips_per_day,
                {_ratio("total_revenue", "days_observed")} AS avg_revenue_per_hour
            FROM (SELECT pickup_hour, is_weekend, time_of_day, count(*) AS total_trips,
                    avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance,
                    avg(trip_duration_minutes) AS avg_duration,
                    avg(passenger_count) AS avg_passengers, sum(total_amount) AS total_revenue,
                    count(DISTINCT pickup_date) AS days_observed
                FROM silver GROUP BY pickup_hour, is_weekend, time_of_day))""",
        "route_performance": _with("silver") + _ROUTES,
        "route_performance_open_zones": _with("silver") + _ROUTES,
        "customer_segments": _with("silver") + _SEGMENTS,
        "weekly_trends": _with("silver")
        + f"""SELECT *, {_change("total_trips", "week_start")} AS trips_wow_change_pct,
            {_change("total_revenue", "week_start")} AS revenue_wow_change_pct,
            {_rounded("avg(total_trips) OVER recent", 0)} AS trips_4week_avg,
            {_rounded("avg(total_revenue) OVER recent")} AS revenue_4week_avg
        FROM (SELECT CAST(date_trunc('week', pickup_date) AS TIMESTAMP) AS week_start,
                count(*) AS total_trips, sum(total_amount) AS total_revenue,
                avg(total_amount) AS avg_revenue_per_trip, sum(trip_distance) AS total_miles,
                avg(trip_distance) AS avg_miles_per_trip, avg(tip_percentage) AS avg_tip_pct,
                count(DISTINCT pickup_date) AS active_days
            FROM silver GROUP BY 1)
        WINDOW recent AS (ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
        "revenue_breakdown": _with("silver")
        + f"""SELECT *, {_percent("base_fare_revenue", "total_revenue")} AS base_fare_pct,
            {_percent("tip_revenue", "total_revenue")} AS tip_pct,
            {_ratio("total_revenue", "trip_count")} AS avg_revenue_per_trip,
            {_ratio("total_revenue", "total_miles")} AS avg_revenue_per_mile
        FROM (SELECT pickup_date, time_of_day, payment_type_name,
                sum(fare_amount) AS base_fare_revenue, sum(extra) AS extra_charges_revenue,
                sum(mta_tax) AS mta_tax_revenue, sum(tip_amount) AS tip_revenue,
                sum(tolls_amount) AS tolls_revenue,
                sum(improvement_surcharge) AS surcharge_revenue,
                sum(total_amount) AS total_revenue, count(*) AS trip_count,
                sum(trip_distance) AS total_miles
            FROM silver GROUP BY pickup_date, time_of_day, payment_type_name)""",
        "executive_summary": _with("silver", _DAILY) + _SUMMARY,
        "executive_summary_from_daily_stats": _with("silver", _DAILY) + _SUMMARY,
        "expectation_report": _with("silver") + _expectations_sql(),
        "expectation_report_stored": _with("silver")
        + "SELECT *, CASE dataset WHEN 'bronze_taxi_enriched' THEN 'warn' ELSE 'drop' END AS mode"
        + f" FROM ({_expectations_sql()})",
        "job_clean": _with("trips")
        + """SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
            CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
            CAST(day(pickup_datetime) AS INTEGER) AS pickup_day,
            CASE WHEN passenger_count > 0 THEN passenger_count ELSE 1 END
                AS passenger_count_clean,
            CASE WHEN trip_distance <= 0 OR total_amount <= 0 OR pickup_datetime IS NULL
                THEN 'SUSPICIOUS' ELSE 'CLEAN' END AS data_quality_flag
        FROM (SELECT * REPLACE (
                    CASE PULocationID WHEN 7 THEN 'not a time'
                        WHEN 8 THEN strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') || ' PM'
                        ELSE strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S')
                        END AS tpep_pickup_datetime,
                    strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S')
                        AS tpep_dropoff_datetime),
                CASE WHEN PULocationID NOT IN (7, 8) THEN tpep_pickup_datetime END
                    AS pickup_datetime,
                tpep_dropoff_datetime AS dropoff_datetime
            FROM trips)""",
        "job_quality": _with("trips")
        + f"""SELECT count(*) AS total_records,
            {_null_pct("tpep_pickup_datetime")} AS tpep_pickup_datetime_null_percentage,
            {_null_pct("total_amount")} AS total_amount_null_percentage,
            count(*) FILTER (WHERE total_amount < 0) AS total_amount_negative_count,
            CAST(100 AS DOUBLE) - {_null_pct("tpep_pickup_datetime")} * 2
                - {_null_pct("total_amount")} * 2 AS quality_score
        FROM trips""",
        "ingest_job": _with("trips")
        + f"""SELECT 'success' AS status, count(*) AS records_processed,
            count(*) AS records_written,
            CAST(100 AS DOUBLE) - {_null_pct("tpep_pickup_datetime")} * 2
                - {_null_pct("total_amount")} * 2 AS quality_score
        FROM trips""",
        "multi_table_quality": "\nUNION ALL\n".join(
            (
                _table_quality("orders", ["o_orderdate"], ["o_totalprice"]),
                _table_quality("customer", ["c_custkey"], ["c_acctbal"]),
                _table_quality("events", ["ts", "value"], ["value"]),
            )
        ),
        "snapshot_changes": _with("silver")
        + f"""SELECT {", ".join(TRIP_KEY)}, VendorID, RatecodeID,
            CASE WHEN kind = 'update_postimage' THEN fare_amount + 1 ELSE fare_amount END
                AS fare_amount,
            total_amount, kind AS _change_type, CAST(1 AS BIGINT) AS _row_count
        FROM (SELECT *, unnest(CASE RatecodeID WHEN 5 THEN ['update_preimage', 'update_postimage']
                    WHEN 6 THEN ['insert'] ELSE ['delete'] END) AS kind
            FROM silver WHERE RatecodeID IN (5, 6, 7))""",
    }
