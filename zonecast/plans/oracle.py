"""DuckDB SQL for the fixture views, used to build each query's oracle.

Each oracle string is standalone: ``with_views("rides", ...)`` emits the CTEs a
query needs (and their dependencies) over the pre-registered base tables. The
arithmetic mirrors the Spark side in integers (cents, hundredths, tenths) so
doubles agree bit for bit; only the fixed values are shared with the Spark code.
"""

from __future__ import annotations

from zonecast.functions import constants as K


def _case(expr: str, values: list) -> str:
    arms = " ".join(f"WHEN {i} THEN {v!r}" if isinstance(v, str) else f"WHEN {i} THEN {v}"
                    for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def _zone_name(zi: str) -> str:
    return _case(zi, [z[0] for z in K.ZONES])


def _zone_centre(zi: str, which: int) -> str:
    return _case(zi, [int(round(z[which] * 10000)) for z in K.ZONES])


def _tenths_case(expr: str, mapping: dict[str, float]) -> str:
    arms = " ".join(f"WHEN {expr} = '{k}' THEN {K.tenths(v)}" for k, v in mapping.items())
    return f"CASE {arms} END"


def surge_rule_sql(zone: str, hour: str, weather: str) -> str:
    """Surge in hundredths: (demand x weather x zone tenths + 10) // 20, clamped to [100, 350]."""
    m_lo, m_hi = K.PEAK_HOURS_MORNING
    e_lo, e_hi = K.PEAK_HOURS_EVENING
    n_lo, n_hi = K.NIGHT_HOURS
    demand = (f"CASE WHEN {hour} BETWEEN {m_lo} AND {m_hi} OR {hour} BETWEEN {e_lo} AND {e_hi} "
              f"THEN {K.tenths(K.PEAK_DEMAND)} WHEN {hour} BETWEEN {n_lo} AND {n_hi} "
              f"THEN {K.tenths(K.NIGHT_DEMAND)} WHEN {hour} IS NOT NULL THEN {K.tenths(K.NORMAL_DEMAND)} END")
    weather_t = _tenths_case(weather, K.WEATHER_DEMAND)
    zone_t = _tenths_case(zone, {z[0]: z[3] for z in K.ZONES})
    prod = f"(({demand}) * ({weather_t}) * ({zone_t}))"
    return f"(CASE WHEN {prod} IS NOT NULL THEN least(350, greatest(100, ({prod} + 10) // 20)) END)"


def iso_sql(ts: str) -> str:
    return f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')"


def parse_sql(text: str) -> str:
    return f"try_strptime({text}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def cents_sql(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def money_times_sql(a: str, b: str) -> str:
    """round(amount x factor, 2), rounded once: amounts of up to 6 and factors of up to 8 places."""
    return f"CAST(round(CAST({a} AS DECIMAL(20,6)) * CAST({b} AS DECIMAL(16,8)), 2) AS DOUBLE)"


def half_up_sql(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))) END)"


def units_sql(x: str) -> str:
    return f"CAST(round({x} * 10000) AS BIGINT)"


def mean2_sql(c: str) -> str:
    return f"({half_up_sql(f'sum({units_sql(c)})', f'100 * count({c})')} / 100.0)"


def mean3_sql(c: str) -> str:
    return f"({half_up_sql(f'sum({units_sql(c)})', f'10 * count({c})')} / 1000.0)"


def money_sum_sql(c: str) -> str:
    return f"({half_up_sql(f'sum({units_sql(c)})', '100')} / 100.0)"


def count_if_sql(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


_WEATHER = ("CASE WHEN _hour BETWEEN 6 AND 11 THEN 'clear' WHEN _hour BETWEEN 12 AND 17 THEN 'cloudy' "
            f"ELSE {_case('event_id % 3', K.WEATHER_STATES)} END")

RIDE_COLS = ("ride_id, event_timestamp, driver_id, user_id, status, pickup_lat, pickup_lon, dropoff_lat, "
             "dropoff_lon, city_zone, distance_km, vehicle_type, fare_base_inr, surge_multiplier, weather, "
             "event_delay_ms, schema_version")
DRIVER_COLS = "driver_id, event_timestamp, status, current_zone, lat, lon, rating, schema_version"
PAYMENT_COLS = ("payment_id, ride_id, event_timestamp, payment_method, amount_inr, currency, status, "
                "schema_version")

_SILVER_RIDE_EXTRA = (
    "CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INTEGER) AS event_hour, "
    "status = 'completed' AS is_completed, "
    f"{money_times_sql('fare_base_inr', 'surge_multiplier')} AS gross_fare_inr")


def _dedup_sql(src: str, keys: str, cols: str) -> str:
    """Survivor: earliest parseable time, then lowest remaining columns with nulls first."""
    order = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in cols.split(",")
                      if c.strip() not in [k.strip() for k in keys.split(",")])
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY "
            f"{parse_sql('event_timestamp')} IS NULL, {parse_sql('event_timestamp')} ASC NULLS FIRST, {order}"
            f") AS _rn FROM {src}) WHERE _rn = 1")


VIEWS: dict[str, tuple[list[str], str]] = {
    "ev": ([], """
        SELECT event_id, user_id, event_type, value, ts,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(hour(ts) AS INTEGER) AS _hour, user_id % 5 AS _zi
        FROM events"""),
    "rides_f": (["ev"], f"""
        SELECT event_id, k, _hour,
               CAST(event_id AS VARCHAR) AS ride_id,
               {iso_sql('ts')} AS event_timestamp,
               CAST(user_id % 50 AS VARCHAR) AS driver_id,
               CAST(user_id AS VARCHAR) AS user_id,
               CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'cancelled'
                    ELSE 'requested' END AS status,
               CAST({_zone_centre('_zi', 1)} + k AS DOUBLE) / 10000.0 AS pickup_lat,
               CAST({_zone_centre('_zi', 2)} + k AS DOUBLE) / 10000.0 AS pickup_lon,
               CAST({_zone_centre('_zi', 1)} - k AS DOUBLE) / 10000.0 AS dropoff_lat,
               CAST({_zone_centre('_zi', 2)} - k AS DOUBLE) / 10000.0 AS dropoff_lon,
               {_zone_name('_zi')} AS city_zone,
               CAST(15 + k AS DOUBLE) / 10.0 AS distance_km,
               {_case('event_id % 4', K.VEHICLE_TYPES)} AS vehicle_type,
               value AS fare_base_inr,
               CAST({surge_rule_sql(_zone_name('_zi'), '_hour', _WEATHER)} AS DOUBLE) / 100.0
                   AS surge_multiplier,
               {_WEATHER} AS weather,
               CAST(0 AS INTEGER) AS event_delay_ms,
               '1.0' AS schema_version
        FROM ev"""),
    "rides_raw": (["rides_f"], f"SELECT {RIDE_COLS} FROM rides_f"),
    "rides_bronze": (["rides_f"], f"""
        SELECT {RIDE_COLS} FROM rides_f
        UNION ALL SELECT {RIDE_COLS} FROM rides_f WHERE event_id % 10 = 0"""),
    "rides_dirty": (["rides_f"], """
        SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE ride_id END AS ride_id,
               CASE WHEN event_id % 97 = 0 THEN 'junk' ELSE event_timestamp END AS event_timestamp,
               driver_id, user_id, status, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon,
               CASE WHEN event_id % 89 = 0 THEN NULL ELSE city_zone END AS city_zone,
               distance_km, vehicle_type, fare_base_inr,
               CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 0.9::DOUBLE
                    WHEN event_id % 59 = 0 THEN 4.0::DOUBLE ELSE surge_multiplier END AS surge_multiplier,
               weather, event_delay_ms, schema_version
        FROM rides_f"""),
    # surges of four places
    "rides_fine": (["rides_dirty"], f"""
        SELECT * REPLACE (CAST({units_sql('surge_multiplier')} + CAST(user_id AS BIGINT) % 97 AS DOUBLE) / 10000.0 AS surge_multiplier)
        FROM rides_dirty"""),
    "silver_fine": (["rides_fine"], f"""
        SELECT *, {_SILVER_RIDE_EXTRA}
        FROM (SELECT *, {parse_sql('event_timestamp')} AS event_ts
              FROM ({_dedup_sql('rides_fine', 'ride_id', RIDE_COLS)}))"""),
    "rides": (["rides_raw"], f"""
        SELECT *, {_SILVER_RIDE_EXTRA}
        FROM (SELECT *, {parse_sql('event_timestamp')} AS event_ts FROM rides_raw)"""),
    "silver_rides": (["rides_bronze"], f"""
        SELECT *, {_SILVER_RIDE_EXTRA}
        FROM (SELECT *, {parse_sql('event_timestamp')} AS event_ts
              FROM ({_dedup_sql('rides_bronze', 'ride_id', RIDE_COLS)}))"""),
    "silver_dirty": (["rides_dirty"], f"""
        SELECT *, {_SILVER_RIDE_EXTRA}
        FROM (SELECT *, {parse_sql('event_timestamp')} AS event_ts
              FROM ({_dedup_sql('rides_dirty', 'ride_id', RIDE_COLS)}))"""),
    "gold": (["rides"], f"""
        SELECT event_date, event_hour, city_zone,
               count(ride_id) AS ride_count,
               {count_if_sql('is_completed')} AS completed_rides,
               {count_if_sql("status = 'cancelled'")} AS cancelled_rides,
               {money_sum_sql('gross_fare_inr')} AS gross_revenue_inr,
               {mean2_sql('surge_multiplier')} AS avg_surge_multiplier
        FROM rides GROUP BY event_date, event_hour, city_zone"""),
    "drivers_f": (["ev"], f"""
        SELECT event_id,
               CAST(user_id AS VARCHAR) AS driver_id,
               {iso_sql('ts')} AS event_timestamp,
               {_case('event_id % 3', K.DRIVER_STATUSES)} AS status,
               CASE WHEN event_id % 2 = 1 THEN '  ' || upper({_zone_name('_zi')}) || '  '
                    ELSE {_zone_name('_zi')} END AS current_zone,
               CAST({_zone_centre('_zi', 1)} + k AS DOUBLE) / 10000.0 AS lat,
               CAST({_zone_centre('_zi', 2)} - k AS DOUBLE) / 10000.0 AS lon,
               CAST(36 + k % 15 AS DOUBLE) / 10.0 AS rating,
               '1.0' AS schema_version
        FROM ev"""),
    "drivers_bronze": (["drivers_f"], f"""
        SELECT {DRIVER_COLS} FROM drivers_f
        UNION ALL SELECT {DRIVER_COLS} FROM drivers_f WHERE event_id % 10 = 0"""),
    "payments_f": (["ev"], f"""
        SELECT event_id,
               'pay-' || CAST(event_id AS VARCHAR) AS payment_id,
               CAST(event_id AS VARCHAR) AS ride_id,
               {iso_sql('ts')} AS event_timestamp,
               CASE WHEN event_id % 2 = 1 THEN '  ' || upper({_case('k % 4', K.PAYMENT_METHODS)}) || '  '
                    ELSE {_case('k % 4', K.PAYMENT_METHODS)} END AS payment_method,
               value AS amount_inr, 'INR' AS currency,
               CASE k % 50 WHEN 0 THEN 'failed' WHEN 1 THEN 'refunded' ELSE 'success' END AS status,
               '1.0' AS schema_version
        FROM ev WHERE event_type = 'purchase'"""),
    "payments_bronze": (["payments_f"], f"""
        SELECT {PAYMENT_COLS} FROM payments_f
        UNION ALL SELECT {PAYMENT_COLS} FROM payments_f WHERE event_id % 10 = 0"""),
    "trips": ([], """
        SELECT l_shipdate + (l_partkey % 24) * INTERVAL 1 HOUR AS tpep_pickup_datetime,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey % 266 END AS PULocationID,
               l_quantity AS trip_distance,
               l_extendedprice / 1000 AS fare_amount,
               (l_extendedprice / 1000) * l_discount AS tip_amount,
               CAST(l_linenumber % 5 AS BIGINT) AS payment_type
        FROM lineitem"""),
    "zone_dim": ([], "SELECT * FROM (VALUES " + ", ".join(
        f"('{n}', {lat}::DOUBLE, {lon}::DOUBLE, {f}::DOUBLE)" for n, lat, lon, f in K.ZONES)
        + ") AS t(city_zone, lat_center, lon_center, demand_multiplier)"),
    "versions": ([], """
        SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice,
               CAST(o_orderkey % 5 AS INTEGER) AS commit_version,
               TIMESTAMP '2024-01-01 00:00:00' + CAST(o_orderkey % 5 AS INTEGER) * INTERVAL 1 DAY
                   AS committed_at
        FROM orders"""),
    "scored": (["rides_f"], f"""
        SELECT ride_id, city_zone, {parse_sql('event_timestamp')} AS event_ts,
               surge_multiplier AS label,
               CAST(least(350, greatest(100, {cents_sql('surge_multiplier')} + k - 50)) AS DOUBLE) / 100.0
                   + (k % 13) * 0.00037::DOUBLE AS prediction,
               CAST(least(350, greatest(100, {cents_sql('surge_multiplier')} + (k % 11) * 4 - 20)) AS DOUBLE)
                   / 100.0 - (k % 7) * 0.00053::DOUBLE AS prediction_alt
        FROM rides_f"""),
}


def with_views(*names: str) -> str:
    """WITH clause holding the named views and everything they depend on, in order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered) + "\n"


def add_view(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (deps, sql)
