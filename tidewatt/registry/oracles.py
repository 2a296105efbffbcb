"""SQL with the meaning of each registered query, for an independent engine.

Shared relations are common table expressions; ``_with`` adds those a statement needs.
"""

from __future__ import annotations

import re

from tidewatt.contracts import REGION_BY_STATE, REGIONS, STATES
from tidewatt.functions.calendar import GRAINS
from tidewatt.operators.checks import Check
from tidewatt.plans import quality

_D = "CAST({} AS DOUBLE)"


def _dbl(*names: str, prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{name} AS DOUBLE) AS {name}" for name in names)


def _text(column: str) -> str:
    return f"nullif(trim(CAST({column} AS VARCHAR)), '')"


def _hash(columns: list[str], upper: bool) -> str:
    parts = [f"upper({_text(c)})" if upper else _text(c) for c in columns]
    joined = " || '||' || ".join(f"coalesce({part}, '^^')" for part in parts)
    return f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN md5({joined}) END"


def _key(*columns: str) -> str:
    return _hash(list(columns), True)


def _diff(*columns: str) -> str:
    return _hash(list(columns), False)


def _ratio_digits(revenue: str, energy: str, digits: int) -> str:
    """Exact half-up quotient of a scale-4 by a scale-5 decimal, as a double."""
    r = f"CAST(CAST({revenue} AS DECIMAL(18,4)) * 10000 AS HUGEINT)"
    k = f"nullif(CAST(CAST({energy} AS DECIMAL(18,5)) * 100000 AS HUGEINT), 0)"
    scaled = f"({r} * 10 * {10 ** digits})"
    whole = f"((2 * {scaled} + {k}) // (2 * {k}))"
    return f"CAST({whole} AS DOUBLE) / {10 ** digits}"


def _fact_sql(source: str) -> str:
    return f"""
    SELECT md5(meter_id) AS meter_key,
           CAST(strftime(reading_hour, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(extract(hour FROM reading_hour) AS INTEGER) AS time_key,
           md5(state_code) AS pricing_zone_key, reading_hour, energy_kwh, usage_revenue,
           reading_count
    FROM (SELECT meter_id, state_code, date_trunc('hour', event_time) AS reading_hour,
                 sum(energy_kwh) AS energy_kwh, sum(usage_revenue) AS usage_revenue,
                 CAST(count(*) AS BIGINT) AS reading_count
          FROM {source} GROUP BY ALL)"""


def _meters_sql(source: str) -> str:
    return f"""
    SELECT md5(meter_id) AS meter_key, meter_id, us_region, state_code,
           min(event_time) AS first_reading_at, max(event_time) AS latest_reading_at
    FROM {source} GROUP BY meter_id, us_region, state_code"""


def _zones_sql(source: str) -> str:
    return f"""
    SELECT md5(state_code) AS pricing_zone_key, min(us_region) AS us_region, state_code,
           min(currency_code) AS currency_code
    FROM {source} GROUP BY state_code"""


def _billing_sql(fact: str, meters: str, zones: str) -> str:
    """The five grains as five statements, as a reader would write them down."""
    parts = [
        f"""SELECT '{name}' AS period_grain, {order} AS period_grain_order,
                   greatest(date_trunc('{name.lower()}', f.reading_hour), b.data_start)
                       AS period_start,
                   m.meter_id, m.us_region, m.state_code, z.currency_code,
                   sum(f.energy_kwh) AS kwh, sum(f.usage_revenue) AS net
            FROM {fact} f JOIN {meters} m USING (meter_key)
            JOIN {zones} z USING (pricing_zone_key)
            CROSS JOIN (SELECT min(reading_hour) AS data_start FROM {fact}) b
            GROUP BY ALL"""
        for name, order in GRAINS
    ]
    exact = "CAST(net AS DECIMAL(18,4))"
    return f"""
    SELECT period_grain, period_grain_order, period_start, meter_id, us_region, state_code,
           currency_code, CAST(kwh AS DOUBLE) AS energy_kwh, CAST(net AS DOUBLE) AS net_revenue,
           CAST(round({exact} * CAST(0.05 AS DECIMAL(3,2)), 4) AS DOUBLE) AS tax_amount,
           CAST(round({exact} * CAST(1.05 AS DECIMAL(3,2)), 4) AS DOUBLE) AS gross_billed,
           {_ratio_digits('net', 'kwh', 4)} AS realized_price_per_kwh,
           CAST(net AS DOUBLE) AS revenue_per_meter, kwh, net,
           round({exact} * CAST(1.05 AS DECIMAL(3,2)), 4) AS gross
    FROM ({' UNION ALL '.join(parts)})"""


def _operations_sql() -> str:
    parts = [
        f"""SELECT '{name}' AS period_grain, {order} AS period_grain_order,
                   greatest(date_trunc('{name.lower()}', f.event_time), b.data_start)
                       AS period_start,
                   m.meter_id, m.us_region, m.state_code, sum(f.energy_kwh) AS energy_kwh,
                   sum(f.voltage_v) AS voltage_sum, sum(f.power_factor) AS power_factor_sum,
                   CAST(count(*) AS BIGINT) AS reading_count
            FROM fact_meter_reading f JOIN dim_meter m USING (meter_key)
            CROSS JOIN (SELECT min(event_time) AS data_start FROM fact_meter_reading) b
            GROUP BY ALL"""
        for name, order in GRAINS
    ]
    return " UNION ALL ".join(parts)


def _hub_sql(source: str, key: str, business_key: str) -> str:
    return f"""
    SELECT {key}, {business_key}, ldts, rsrc FROM {source} WHERE {key} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ldts, rsrc, {business_key}) = 1"""


def _link_sql(source: str, key: str, foreign: tuple[str, str]) -> str:
    a, b = foreign
    return f"""
    SELECT {key}, {a}, {b}, ldts, rsrc FROM {source}
    WHERE {key} IS NOT NULL AND {a} IS NOT NULL AND {b} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ldts, rsrc, {a}, {b}) = 1"""


def _sat_sql(source: str, key: str, diff: str, payload: str, last_by: str) -> str:
    return f"""
    SELECT {key}, {diff}, ldts, rsrc, {payload} FROM (
        SELECT * FROM {source} WHERE {key} IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY {key}, ldts ORDER BY {last_by} DESC, {diff} DESC) = 1)
    QUALIFY {diff} IS DISTINCT FROM lag({diff}) OVER (PARTITION BY {key} ORDER BY ldts)"""


def _pit_sql(owner: str, key: str, sat: str, trigger: str, dimension: str) -> str:
    return f"""
    SELECT md5(h.{key} || CAST(h.sdts AS VARCHAR)) AS {dimension}, h.{key}, h.sdts,
           s.{key} AS hk_{sat}, s.ldts AS ldts_{sat}
    FROM (SELECT {key}, sdts FROM {owner} CROSS JOIN
              (SELECT sdts FROM control_snap_v1 WHERE {trigger})) h
    ASOF LEFT JOIN {sat} s ON h.{key} = s.{key} AND h.sdts >= s.ldts"""


_STATES = ", ".join(f"({n}, '{s}', '{REGION_BY_STATE[s]}')" for n, s in enumerate(STATES))
_READING_COLUMNS = (
    "event_id, meter_id, us_region, state_code, event_time, "
    "{energy_kwh}, {voltage_v}, {current_a}, {power_factor}, schema_version, load_datetime"
)

CTES: dict[str, str] = {
    "zones": """
    SELECT CAST(n_nationkey AS BIGINT) AS zone_id, n_name AS state_code, r_name AS us_region
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "ev": """
    SELECT e.*, 'meter-' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS meter_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, z.state_code, z.us_region,
           date_trunc('day', ts) + INTERVAL 1 DAY AS load_datetime
    FROM events e JOIN zones z ON e.user_id % 25 = z.zone_id""",
    "readings": """
    SELECT CAST(event_id AS VARCHAR) AS event_id, '1.0' AS schema_version, meter_id, us_region,
           state_code, ts AS event_time, CAST(value AS DECIMAL(12,5)) AS energy_kwh,
           CAST(CAST(2000 + k * 5 AS DECIMAL(12,0)) * CAST(0.1 AS DECIMAL(4,3))
               AS DECIMAL(8,2)) AS voltage_v,
           CAST(CAST(event_id % 5000 AS DECIMAL(12,0)) * CAST(0.001 AS DECIMAL(4,3))
               AS DECIMAL(8,3)) AS current_a,
           CAST(CAST(85 + k % 16 AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(4,3))
               AS DECIMAL(5,3)) AS power_factor,
           'events/' || event_type AS record_source, load_datetime
    FROM ev WHERE event_type <> 'purchase'""",
    "prices": """
    SELECT CAST(event_id AS VARCHAR) AS price_id, '1.0' AS schema_version, us_region, state_code,
           'USD' AS currency_code, ts AS effective_from,
           CAST(round(CAST(value AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)), 4)
               AS DECIMAL(10,4)) AS price_per_kwh,
           'events/purchase' AS source_system, load_datetime
    FROM ev WHERE event_type = 'purchase'""",
    "intervals": """
    SELECT *, lead(effective_from) OVER (PARTITION BY state_code ORDER BY effective_from)
        AS effective_to
    FROM prices""",
    "priced": """
    SELECT r.event_id, r.meter_id, r.us_region, r.state_code, r.event_time, r.energy_kwh,
           r.voltage_v, r.current_a, r.power_factor, r.schema_version, p.price_id,
           p.currency_code, p.effective_from AS price_effective_from, p.price_per_kwh,
           round(r.energy_kwh * p.price_per_kwh, 4) AS usage_revenue,
           greatest(r.load_datetime, p.load_datetime) AS load_datetime
    FROM readings r JOIN intervals p
      ON p.state_code = r.state_code AND p.us_region = r.us_region
     AND r.event_time >= p.effective_from
     AND (r.event_time < p.effective_to OR p.effective_to IS NULL)""",
    "stg_readings": f"""
    SELECT *, load_datetime AS ldts, record_source AS rsrc, {_key('meter_id')} AS hk_meter_h,
           {_key('event_id')} AS hk_reading_h, {_key('state_code')} AS hk_pricing_zone_h,
           {_key('meter_id', 'event_id')} AS hk_meter_reading_l,
           {_key('meter_id', 'state_code')} AS hk_meter_pricing_zone_l,
           {_diff('schema_version', 'us_region', 'state_code')} AS hd_meter_details_s,
           {_diff('event_time', 'energy_kwh', 'voltage_v', 'current_a', 'power_factor')}
               AS hd_reading_metrics_s
    FROM readings""",
    "stg_prices": f"""
    SELECT *, load_datetime AS ldts, source_system AS rsrc,
           {_key('state_code')} AS hk_pricing_zone_h, {_key('price_id')} AS hk_price_h,
           {_key('state_code', 'price_id')} AS hk_pricing_zone_price_l,
           {_diff('schema_version', 'effective_from', 'price_per_kwh')} AS hd_price_details_s,
           {_diff('us_region', 'currency_code')} AS hd_pricing_zone_details_s
    FROM prices""",
    "hub_meter": _hub_sql("stg_readings", "hk_meter_h", "meter_id"),
    "hub_reading": _hub_sql("stg_readings", "hk_reading_h", "event_id"),
    "hub_pricing_zone": _hub_sql("stg_prices", "hk_pricing_zone_h", "state_code"),
    "hub_price": _hub_sql("stg_prices", "hk_price_h", "price_id"),
    "link_meter_reading": _link_sql(
        "stg_readings", "hk_meter_reading_l", ("hk_meter_h", "hk_reading_h")
    ),
    "link_meter_pricing_zone": _link_sql(
        "stg_readings", "hk_meter_pricing_zone_l", ("hk_meter_h", "hk_pricing_zone_h")
    ),
    "link_pricing_zone_price": _link_sql(
        "stg_prices", "hk_pricing_zone_price_l", ("hk_pricing_zone_h", "hk_price_h")
    ),
    "sat_meter_details": _sat_sql(
        "stg_readings", "hk_meter_h", "hd_meter_details_s",
        "schema_version, us_region, state_code", "event_time",
    ),
    "sat_reading_metrics": _sat_sql(
        "stg_readings", "hk_reading_h", "hd_reading_metrics_s",
        "event_time, energy_kwh, voltage_v, current_a, power_factor", "event_time",
    ),
    "sat_price_details": _sat_sql(
        "stg_prices", "hk_price_h", "hd_price_details_s",
        "schema_version, effective_from, price_per_kwh", "effective_from",
    ),
    "sat_pricing_zone_details": _sat_sql(
        "stg_prices", "hk_pricing_zone_h", "hd_pricing_zone_details_s",
        "us_region, currency_code", "effective_from",
    ),
    "as_of": "SELECT max(ts) + INTERVAL 2 DAY AS reached FROM events",
    "control_snap_v0": """
    SELECT unnest(generate_series(TIMESTAMP '2020-01-01 06:00:00',
               date_trunc('day', reached) + INTERVAL 6 HOUR, INTERVAL 1 DAY)) AS sdts
    FROM as_of""",
    "control_snap_v1": """
    SELECT sdts,
           sdts <= reached AND (
               CAST(sdts AS DATE) >= CAST(reached AS DATE) - INTERVAL 30 DAY
            OR (isodow(sdts) = 1 AND CAST(sdts AS DATE) >= CAST(reached AS DATE) - INTERVAL 6 MONTH)
            OR (day(sdts) = 1 AND CAST(sdts AS DATE) >= CAST(reached AS DATE) - INTERVAL 3 YEAR)
            OR (day(sdts) = 1 AND month(sdts) = 1)) AS is_active,
           sdts = (SELECT max(sdts) FROM control_snap_v0, as_of WHERE sdts <= reached) AS is_latest
    FROM control_snap_v0 CROSS JOIN as_of""",
    "customers": f"""
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS order_status,
           o_orderpriority AS order_priority, o_orderkey, o_orderdate AS ldts, 'orders' AS rsrc,
           {_key('o_custkey')} AS hk_customer_h,
           {_diff('o_orderstatus', 'o_orderpriority')} AS hd_customer_s
    FROM orders""",
    "sat_customer": _sat_sql(
        "customers", "hk_customer_h", "hd_customer_s", "order_status, order_priority", "o_orderkey"
    ),
    "quarters": "SELECT DISTINCT date_trunc('quarter', ldts) AS sdts FROM customers",
    "pit_customer": """
    SELECT md5(h.hk_customer_h || CAST(h.sdts AS VARCHAR)) AS hk_customer_d, h.hk_customer_h,
           h.sdts, s.hk_customer_h AS hk_sat_customer, s.ldts AS ldts_sat_customer,
           s.order_status, s.order_priority
    FROM (SELECT DISTINCT c.hk_customer_h, q.sdts FROM customers c CROSS JOIN quarters q) h
    ASOF LEFT JOIN sat_customer s ON h.hk_customer_h = s.hk_customer_h AND h.sdts >= s.ldts""",
    "pit_meter": _pit_sql(
        "hub_meter", "hk_meter_h", "sat_meter_details", "is_active", "hk_meter_d"
    ),
    "pit_pricing_zone": _pit_sql(
        "hub_pricing_zone", "hk_pricing_zone_h", "sat_pricing_zone_details", "is_active",
        "hk_pricing_zone_d",
    ),
    "pit_reading": _pit_sql(
        "hub_reading", "hk_reading_h", "sat_reading_metrics", "is_latest", "hk_reading_d"
    ),
    "pit_price": _pit_sql(
        "hub_price", "hk_price_h", "sat_price_details", "is_latest", "hk_price_d"
    ),
    "dim_meter": _meters_sql("readings"),
    "dim_pricing_zone": _zones_sql("prices"),
    "fact_meter_reading": """
    SELECT md5(event_id) AS reading_key, event_id, md5(meter_id) AS meter_key,
           CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(extract(hour FROM event_time) AS INTEGER) AS time_key,
           md5(state_code) AS pricing_zone_key, event_time, energy_kwh, voltage_v, current_a,
           power_factor, load_datetime
    FROM readings""",
    "fact_hourly_energy_billing": _fact_sql("priced"),
    "dim_date": """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS calendar_date,
           CAST(year(d) AS INTEGER) AS calendar_year,
           CAST(quarter(d) AS INTEGER) AS calendar_quarter,
           CAST(month(d) AS INTEGER) AS calendar_month, monthname(d) AS month_name,
           CAST(isodow(d) AS INTEGER) AS iso_day_of_week, isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT unnest(generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2035-12-31',
              INTERVAL 1 DAY)) AS d)""",
    "dim_time": """
    SELECT h AS time_key, lpad(CAST(h AS VARCHAR), 2, '0') || ':00:00' AS hour_start,
           lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hour_label,
           CASE WHEN h <= 5 THEN 'Overnight' WHEN h <= 11 THEN 'Morning'
                WHEN h <= 17 THEN 'Afternoon' ELSE 'Evening' END AS day_part
    FROM (SELECT CAST(unnest(range(24)) AS INTEGER) AS h)""",
    "mart_meter_operations_periodic": _operations_sql(),
    "mart_executive_billing_periodic": _billing_sql(
        "fact_hourly_energy_billing", "dim_meter", "dim_pricing_zone"
    ),
    "shipped": """
    SELECT 'meter-' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS meter_id, us_region,
           state_code, 'USD' AS currency_code, l_shipdate AS event_time,
           CAST(l_quantity AS DECIMAL(12,5)) AS energy_kwh,
           round(CAST(l_extendedprice AS DECIMAL(12,2))
                 * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2))), 4)
               AS usage_revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN zones ON c_nationkey = zone_id""",
    "shipped_fact": _fact_sql("shipped"),
    "shipped_meters": _meters_sql("shipped"),
    "shipped_zones": _zones_sql("shipped"),
    "shipped_mart": _billing_sql("shipped_fact", "shipped_meters", "shipped_zones"),
    "checked_events": """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS kind, ts AS event_time, value,
           CASE WHEN json_extract_string(props, '$.k') < '80'
                THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
    FROM events""",
    "event_reasons": """
    SELECT *, list_filter([
        CASE WHEN event_id IS NULL THEN 'required:event_id' END,
        CASE WHEN kind IS NULL THEN 'required:kind' END,
        CASE WHEN event_time IS NULL THEN 'required:event_time' END,
        CASE WHEN value IS NULL THEN 'required:value' END,
        CASE WHEN k IS NULL THEN 'required:k' END,
        CASE WHEN NOT coalesce(kind IN ('click', 'view', 'purchase'), false)
             THEN 'domain:kind' END,
        CASE WHEN NOT coalesce(value >= 5, false) THEN 'range:value' END,
        CASE WHEN NOT coalesce(k BETWEEN 10 AND 90, false) THEN 'range:k' END,
        CASE WHEN NOT coalesce((kind = 'click' AND k % 3 IN (0, 1))
                  OR (kind = 'view' AND k % 3 IN (1, 2))
                  OR (kind = 'purchase' AND k % 3 IN (0, 2)), false)
             THEN 'domain:alignment' END
        ], lambda x: x IS NOT NULL) AS reasons
    FROM checked_events""",
    "raw_records": f"""
    SELECT md5(CAST(event_id AS VARCHAR)) AS digest, ts, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           'meter-' || CAST(user_id AS VARCHAR) AS meter_id, s.state_code,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) = 3 THEN 'West'
                ELSE s.region END AS us_region, s.region
    FROM events JOIN (VALUES {_STATES}) s(n, state_code, region) ON user_id % {len(STATES)} = s.n""",
    "raw_reasons": """
    SELECT *, CASE WHEN k = 6 THEN ['malformed'] ELSE list_filter([
        CASE WHEN k = 4 THEN 'required:energy_kwh' END,
        CASE WHEN k = 1 THEN 'format:event_id_uuid' END,
        CASE WHEN k = 2 THEN 'schema:supported_version' END,
        CASE WHEN k = 3 AND region <> 'West' THEN 'domain:state_region_alignment' END,
        CASE WHEN k = 4 THEN 'range:energy_kwh' END,
        CASE WHEN k = 5 THEN 'range:current_a' END,
        CASE WHEN k > 95 THEN 'range:power_factor' END
        ], lambda x: x IS NOT NULL) END AS reasons
    FROM raw_records""",
    "final_rows": """
    SELECT meter_id, state_code, event_time AS old_time,
           CASE WHEN early AND n % 35 = 0 THEN event_time + INTERVAL 30 HOUR ELSE event_time END AS event_time,
           energy_kwh + CASE WHEN early AND n % 7 = 0 THEN 1 ELSE 0 END AS energy_kwh, usage_revenue,
           early AND n % 10 <> 0 AS in_first, NOT early OR n % 10 = 0 OR n % 7 = 0 AS in_second
    FROM (SELECT *, CAST(event_id AS BIGINT) AS n, event_time < TIMESTAMP '2024-01-20' AS early FROM priced)""",
    "load_grains": "SELECT unnest(['day', 'week', 'month', 'year']) AS n",
    "second_hours": """
    SELECT DISTINCT meter_id, state_code, date_trunc('hour', event_time) AS hour FROM final_rows WHERE in_second
    UNION
    SELECT DISTINCT meter_id, state_code, date_trunc('hour', old_time) FROM final_rows WHERE in_second AND in_first""",
    "mixed_intervals": """
    SELECT *, lead(valid_from) OVER (PARTITION BY holder ORDER BY valid_from) AS valid_to
    FROM (SELECT holder, valid_from, min(tariff_id) AS tariff_id
          FROM (SELECT o_custkey AS holder, CAST(o_orderdate AS TIMESTAMP) + to_minutes(o_orderkey % 1440) AS valid_from,
                       o_orderkey AS tariff_id FROM orders
                UNION ALL
                SELECT user_id, ts, -event_id FROM events WHERE event_type = 'purchase')
          GROUP BY 1, 2)""",
    "price_records": f"""
    SELECT b.n AS batch, md5(event_id || ':' || b.n) AS digest, s.state_code, s.region,
           date_trunc('second', ts) AS effective_from,
           CAST(value AS DECIMAL(12,2)) + b.n - 1 AS price_per_kwh, k,
           k = 6 AS is_malformed,
           k IN (1, 2, 4, 5) OR (k = 3 AND s.region <> 'West') AS is_rejected
    FROM ev JOIN (VALUES (1), (2)) b(n) ON b.n = 1 OR event_id % 3 = 0
    JOIN (VALUES {_STATES}) s(n, state_code, region) ON s.n = user_id % {len(STATES)}
    WHERE event_type = 'purchase'""",
    "price_loads": """
    SELECT *, substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-4' || substr(digest, 14, 3)
               || '-a' || substr(digest, 18, 3) || '-' || substr(digest, 21, 12) AS price_id
    FROM price_records WHERE NOT is_malformed AND NOT is_rejected
    QUALIFY row_number() OVER (PARTITION BY batch, state_code, effective_from ORDER BY price_id DESC) = 1""",
}


def _with(body: str) -> str:
    """Prefix the common table expressions a statement uses, dependencies first."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b{name}\b", sql) and CTES[name] is not sql:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + body


# Checks -------------------------------------------------------------------------------------

_RANGES = {
    "energy_kwh": "{} < 0", "voltage_v": "{} <= 0", "current_a": "{} < 0",
    "power_factor": "{0} < 0 OR {0} > 1", "price_per_kwh": "{} < 0",
}
_VALUES = {
    "us_region": REGIONS,
    "period_grain": tuple(name for name, _ in GRAINS),
    "is_active": ("true", "false"),
    "is_latest": ("true", "false"),
}
_TABLES = {
    "smart_meter_events": "readings",
    "electricity_prices": "prices",
    "stg_meter_readings": "stg_readings",
    "stg_electricity_prices": "stg_prices",
    "int_electricity_prices": "intervals",
    "int_meter_readings": "readings",
    "int_meter_readings_priced": "priced",
}


def _check_sql(check: Check) -> str:
    table = _TABLES.get(check.table, check.table)
    kind, _, rest = check.name.partition(":")
    if kind == "not_null":
        rows = f"SELECT 1 FROM {table} WHERE {rest} IS NULL"
    elif kind == "not_empty":
        rows = f"SELECT 1 FROM {table} WHERE trim({rest}) = ''"
    elif kind == "unique":
        keys = rest.replace("+", ", ")
        skip = f"WHERE {rest} IS NOT NULL" if "+" not in rest else ""
        rows = f"SELECT {keys} FROM {table} {skip} GROUP BY {keys} HAVING count(*) > 1"
    elif kind == "accepted_values":
        allowed = ", ".join(f"'{value}'" for value in _VALUES[rest])
        rows = f"SELECT 1 FROM {table} WHERE CAST({rest} AS VARCHAR) NOT IN ({allowed})"
    elif kind == "accepted_range":
        rows = f"SELECT 1 FROM {table} WHERE {_RANGES[rest].format(rest)}"
    elif kind == "relationship":
        column, _, parent = rest.partition("->")
        rows = (
            f"SELECT DISTINCT {column} FROM {table} WHERE {column} IS NOT NULL"
            f" AND {column} NOT IN (SELECT {column} FROM {parent})"
        )
    elif kind == "no_ghost_records":
        tables = (
            "hub_meter", "hub_reading", "link_meter_reading", "sat_meter_details",
            "sat_reading_metrics",
        )
        rows = " UNION ALL ".join(
            f"SELECT 1 FROM {name} WHERE rsrc IN ('SYSTEM', 'ERROR')" for name in tables
        )
    elif kind == "meter_readings_have_effective_price":
        rows = f"SELECT 1 FROM {table} WHERE event_id NOT IN (SELECT event_id FROM priced)"
    else:
        raise ValueError(check.name)
    return (
        f"SELECT '{check.table}' AS table_name, '{check.name}' AS check_name,"
        f" CAST(count(*) AS BIGINT) AS violations FROM ({rows})"
    )


def _suite(checks: list[Check]) -> str:
    return " UNION ALL ".join(_check_sql(check) for check in checks)


def _counted(table: str, name: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name,"
        f" CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS violations FROM {table}"
    )


# Statements ---------------------------------------------------------------------------------

_LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,"
    " l_returnflag, l_linestatus"
)
_FIRST_LINE = f"row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1"
_LAST_LINE = "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY " + ", ".join(
    f"{name.strip()} DESC" for name in _LINE_ORDER.split(",")
) + ") = 1"
_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _merged_line(name: str) -> str:
    if name in ("l_orderkey", "l_linenumber"):
        return f"coalesce(t.{name}, s.{name}) AS {name}"
    if name in ("l_extendedprice", "l_shipdate"):
        return f"CASE WHEN s.l_orderkey IS NULL THEN t.{name} ELSE s.{name} END AS {name}"
    return f"CASE WHEN t.l_orderkey IS NULL THEN s.{name} ELSE t.{name} END AS {name}"


_ASOF = f"""SELECT event_id, meter_id, state_code, event_time, {_dbl('energy_kwh')}, price_id,
    price_effective_from, {_dbl('price_per_kwh', 'usage_revenue')}, load_datetime FROM priced"""
_METRICS_OF_READINGS = """
    CAST(sum(energy_kwh) AS DOUBLE) AS total_energy_consumed_kwh,
    CAST(count(event_id) AS BIGINT) AS total_readings"""
_AVERAGES = """
    CAST(sum(voltage_v) AS DOUBLE) / CAST(count(voltage_v) AS DOUBLE) AS avg_voltage_v,
    CAST(sum(power_factor) AS DOUBLE) / CAST(count(power_factor) AS DOUBLE) AS avg_power_factor"""
_REVENUE_RATIO = (
    "CAST(sum(usage_revenue) AS DOUBLE) / nullif(CAST(sum(energy_kwh) AS DOUBLE), 0)"
    " AS realized_usage_price_per_kwh"
)


def _spine_sql(grain: str) -> str:
    return f"""
    SELECT period, CAST(coalesce(c.n, 0) AS BIGINT) AS n_readings
    FROM (SELECT unnest(generate_series(TIMESTAMP '2020-01-01',
              TIMESTAMP '2036-01-01' - INTERVAL 1 {grain}, INTERVAL 1 {grain})) AS period) s
    FULL JOIN (SELECT date_trunc('{grain}', event_time) AS period, count(*) AS n
               FROM readings GROUP BY 1) c USING (period)"""


def _hourly_stream(columns: str, keys: str, source: str, moment: str, bound: str) -> str:
    return f"""
    SELECT * FROM (
        SELECT date_trunc('hour', {moment}) AS reading_hour, {keys}, {columns},
               CAST(count(*) AS BIGINT) AS reading_count
        FROM {source} GROUP BY ALL)
    WHERE reading_hour + INTERVAL 1 HOUR <= (SELECT max({moment}) - INTERVAL 1 HOUR FROM {bound})"""


_SELECT_ALL = {
    name: f"SELECT * FROM {name}"
    for name in (
        "hub_meter", "hub_reading", "hub_pricing_zone", "hub_price", "link_meter_reading",
        "link_meter_pricing_zone", "link_pricing_zone_price", "sat_meter_details",
        "sat_pricing_zone_details", "pit_meter", "pit_pricing_zone", "pit_reading", "pit_price",
        "dim_meter", "dim_pricing_zone",
    )
}

STATEMENTS: dict[str, str] = {
    "validate_valid": """
    SELECT event_id, kind, event_time, value, k FROM event_reasons WHERE len(reasons) = 0""",
    "validate_rejected_reasons": """
    SELECT event_id, array_to_string(reasons, ',') AS error_reasons, 'quality' AS error_type,
           'events' AS error_stage
    FROM event_reasons WHERE len(reasons) > 0""",
    "validate_reason_counts": """
    SELECT reason, CAST(count(*) AS BIGINT) AS n_records
    FROM (SELECT unnest(reasons) AS reason FROM event_reasons) GROUP BY reason""",
    "dedupe_first": f"SELECT * FROM lineitem QUALIFY {_FIRST_LINE}",
    "latest_by_key": """
    SELECT * FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "merge_insert_only": f"""
    WITH target AS (SELECT * FROM lineitem WHERE l_returnflag = 'N' QUALIFY {_FIRST_LINE}),
    source AS (SELECT * FROM lineitem WHERE l_returnflag <> 'N' QUALIFY {_FIRST_LINE})
    SELECT * FROM target UNION ALL
    SELECT * FROM source s WHERE NOT EXISTS (
        SELECT 1 FROM target t
        WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)""",
    "merge_upsert": f"""
    WITH target AS (SELECT * FROM lineitem WHERE l_linestatus = 'F' QUALIFY {_FIRST_LINE}),
    source AS (SELECT * FROM lineitem WHERE l_linestatus <> 'F' QUALIFY {_LAST_LINE})
    SELECT {', '.join(_merged_line(name) for name in _LINE_COLUMNS)},
           CASE WHEN t.l_orderkey IS NULL THEN 'inserted' WHEN s.l_orderkey IS NOT NULL
                THEN 'updated' ELSE 'kept' END AS merge_action
    FROM target t FULL JOIN source s
      ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber""",
    "backfill_window_filter": """
    SELECT event_id, event_time, CAST(energy_kwh AS DOUBLE) AS energy_kwh FROM readings
    WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-24'""",
    "backfill_week_batches": """
    SELECT strftime(greatest(w, TIMESTAMP '2024-01-10'), '%Y-%m-%d') AS batch_start,
           strftime(least(w + INTERVAL 7 DAY, TIMESTAMP '2024-01-24'), '%Y-%m-%d') AS batch_end,
           CAST(count(*) AS BIGINT) AS n_records, CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh
    FROM (SELECT date_trunc('week', event_time) AS w, energy_kwh FROM readings
          WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-24')
    GROUP BY w""",
    "incremental_unseen": """
    SELECT 'lake/orders/' || strftime(o_orderdate, '%Y/%m/%d/') || CAST(o_orderkey AS VARCHAR)
        AS object_uri
    FROM orders WHERE o_orderstatus <> 'F'""",
    "effective_intervals": """
    SELECT price_id, state_code, effective_from, effective_to,
           CAST(price_per_kwh AS DOUBLE) AS price_per_kwh
    FROM intervals""",
    "asof_priced": _ASOF,
    "asof_priced_broadcast": _ASOF,
    "asof_priced_shuffle": _ASOF,
    "asof_priced_carry": _ASOF,
    "asof_priced_dyadic": _ASOF,
    "asof_dyadic": """
    SELECT r.row_id, r.holder, r.moment, m.valid_from, m.tariff_id, m.valid_to
    FROM (SELECT l_orderkey * 10 + l_linenumber AS row_id, o_custkey AS holder,
                 CAST(l_shipdate AS TIMESTAMP) + to_minutes(l_partkey % 1440) AS moment
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          UNION ALL
          SELECT -event_id - 1, user_id, ts FROM events WHERE event_type <> 'purchase') r
    ASOF LEFT JOIN mixed_intervals m ON r.holder = m.holder AND r.moment >= m.valid_from""",
    "asof_dyadic_blocks": """
    SELECT level, CAST(count(*) AS BIGINT) AS n_intervals,
           CAST(sum(date_diff('hour', date_trunc('hour', valid_from), date_trunc('hour', valid_to - INTERVAL 1 MICROSECOND)) + 1)
               AS BIGINT) AS n_hours,
           CAST(sum(((epoch_us(valid_to) - 1) >> level) - (epoch_us(valid_from) >> level) + 1) AS BIGINT) AS n_blocks
    FROM (SELECT *, CAST(floor(log2(epoch_us(valid_to) - epoch_us(valid_from)) / 3) * 3 AS INTEGER) AS level
          FROM mixed_intervals WHERE valid_to IS NOT NULL)
    GROUP BY 1""",
    "asof_left": """
    WITH tariffs AS (
        SELECT user_id, ts AS valid_from, event_id AS price_id,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
        FROM events WHERE event_type = 'purchase')
    SELECT e.event_id, e.user_id, e.ts AS moment, t.valid_from, t.price_id, t.valid_to
    FROM (SELECT * FROM events WHERE event_type <> 'purchase') e
    ASOF LEFT JOIN tariffs t ON e.user_id = t.user_id AND e.ts >= t.valid_from""",
    "asof_unpriced": """
    SELECT event_id, state_code, event_time FROM readings
    WHERE event_id NOT IN (SELECT event_id FROM priced)""",
    "stage_readings": """
    SELECT event_id, hk_meter_h, hk_reading_h, hk_pricing_zone_h, hk_meter_reading_l,
           hk_meter_pricing_zone_l, hd_meter_details_s, hd_reading_metrics_s, ldts, rsrc
    FROM stg_readings""",
    "stage_prices": """
    SELECT price_id, hk_pricing_zone_h, hk_price_h, hk_pricing_zone_price_l,
           hd_price_details_s, hd_pricing_zone_details_s, ldts, rsrc
    FROM stg_prices""",
    **_SELECT_ALL,
    "sat_reading_metrics": f"""
    SELECT hk_reading_h, hd_reading_metrics_s, ldts, rsrc, event_time,
           {_dbl('energy_kwh', 'voltage_v', 'current_a', 'power_factor')}
    FROM sat_reading_metrics""",
    "sat_price_details": f"""
    SELECT hk_price_h, hd_price_details_s, ldts, rsrc, schema_version, effective_from,
           {_dbl('price_per_kwh')}
    FROM sat_price_details""",
    "hub_incremental": """
    SELECT hk_customer_h, customer_id, min(ldts) AS ldts, 'orders' AS rsrc FROM customers
    GROUP BY hk_customer_h, customer_id HAVING min(ldts) >= TIMESTAMP '1995-03-01'""",
    "sat_history": "SELECT * FROM sat_customer",
    "sat_null_payload": """
    WITH kept AS (
        SELECT CAST(user_id AS VARCHAR) AS hk_user, CAST(ts AS TIMESTAMP) AS ldts,
               CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1
    ), before AS (
        SELECT *, lag(kind) OVER w AS previous, row_number() OVER w AS place
        FROM kept WINDOW w AS (PARTITION BY hk_user ORDER BY ldts)
    )
    SELECT hk_user, ldts, kind FROM before
    WHERE CASE WHEN place = 1 THEN kind IS NOT NULL ELSE kind IS DISTINCT FROM previous END""",
    "asof_after_last": """
    WITH latest AS (
        SELECT o_custkey % 25 AS zone, min(o_orderkey) AS tariff_id, o_orderdate
        FROM orders GROUP BY 1, 3
        QUALIFY row_number() OVER (PARTITION BY o_custkey % 25 ORDER BY o_orderdate DESC) = 1
    )
    SELECT event_id, user_id % 25 AS zone, tariff_id, CAST(NULL AS TIMESTAMP) AS valid_to
    FROM events LEFT JOIN latest ON latest.zone = user_id % 25""",
    "chart_billing_trend_hour": """
    SELECT period_start, us_region, CAST(sum(gross) AS DOUBLE) AS gross_billed_usd,
           CAST(sum(net) AS DOUBLE) AS net_revenue_usd
    FROM shipped_mart WHERE period_grain = 'Hour' GROUP BY 1, 2 ORDER BY 1, 2""",
    "sat_incremental": "SELECT * FROM sat_customer WHERE ldts >= TIMESTAMP '1998-01-01'",
    "snapshot_calendar": "SELECT sdts FROM control_snap_v0",
    "snapshot_flags": "SELECT sdts, is_active, is_latest FROM control_snap_v1",
    "pit_incremental": """
    SELECT md5(h.hk_customer_h || CAST(h.sdts AS VARCHAR)) AS hk_customer_d, h.hk_customer_h, h.sdts,
           s.hk_customer_h AS hk_sat_customer, s.ldts AS ldts_sat_customer
    FROM (SELECT DISTINCT c.hk_customer_h, q.sdts FROM customers c
          JOIN quarters q ON q.sdts BETWEEN TIMESTAMP '1997-05-01' AND TIMESTAMP '1999-05-01'
          WHERE c.ldts < TIMESTAMP '1999-05-01') h
    ASOF LEFT JOIN sat_customer s ON h.hk_customer_h = s.hk_customer_h AND h.sdts >= s.ldts""",
    "pit_history": """
    SELECT hk_customer_d, hk_customer_h, sdts, hk_sat_customer, ldts_sat_customer
    FROM pit_customer""",
    "pit_asof_read": """
    SELECT hk_customer_h, sdts, order_status, order_priority FROM pit_customer""",
    "int_readings": f"""
    SELECT event_id, meter_id, us_region, state_code, event_time,
           {_dbl('energy_kwh', 'voltage_v', 'current_a', 'power_factor')}, schema_version,
           load_datetime
    FROM readings""",
    "int_prices": f"""
    SELECT price_id, state_code, us_region, currency_code, effective_from, effective_to,
           {_dbl('price_per_kwh')},
           greatest(load_datetime, (SELECT max(s.ldts) FROM sat_pricing_zone_details s
               WHERE s.hk_pricing_zone_h = {_key('intervals.state_code')})) AS load_datetime
    FROM intervals""",
    "int_priced": f"""
    SELECT event_id, meter_id, us_region, state_code, event_time,
           {_dbl('energy_kwh', 'voltage_v', 'current_a', 'power_factor')}, schema_version,
           price_id, currency_code, price_effective_from,
           {_dbl('price_per_kwh', 'usage_revenue')},
           load_datetime
    FROM priced""",
    "dim_date": """
    SELECT date_key, strftime(calendar_date, '%Y-%m-%d') AS calendar_date, calendar_year,
           calendar_quarter, calendar_month, month_name, iso_day_of_week, is_weekend,
           CAST(count(*) AS BIGINT) AS n_readings, CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh
    FROM fact_meter_reading LEFT JOIN dim_date USING (date_key) GROUP BY ALL""",
    "dim_date_orders": """
    SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(count(*) AS BIGINT) AS n_orders,
           CASE WHEN inside THEN strftime(o_orderdate, '%Y-%m-%d') END AS calendar_date,
           CASE WHEN inside THEN CAST(year(o_orderdate) AS INTEGER) END AS calendar_year,
           CASE WHEN inside THEN CAST(quarter(o_orderdate) AS INTEGER) END AS calendar_quarter,
           CASE WHEN inside THEN CAST(month(o_orderdate) AS INTEGER) END AS calendar_month,
           CASE WHEN inside THEN monthname(o_orderdate) END AS month_name,
           CASE WHEN inside THEN CAST(isodow(o_orderdate) AS INTEGER) END AS iso_day_of_week,
           CASE WHEN inside THEN isodow(o_orderdate) IN (6, 7) END AS is_weekend
    FROM (SELECT *, year(o_orderdate) BETWEEN 1996 AND 1998 AS inside FROM orders) GROUP BY ALL""",
    "dim_time": """
    SELECT time_key, hour_start, hour_label, day_part, CAST(count(*) AS BIGINT) AS n_readings,
           CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh
    FROM fact_meter_reading JOIN dim_time USING (time_key) GROUP BY ALL""",
    "spine_hour": _spine_sql("hour"),
    "spine_day": _spine_sql("day"),
    "spine_month": _spine_sql("month"),
    "spine_year": _spine_sql("year"),
    "fact_meter_reading": f"""
    SELECT reading_key, event_id, meter_key, date_key, time_key, pricing_zone_key, event_time,
           {_dbl('energy_kwh', 'voltage_v', 'current_a', 'power_factor')}, load_datetime
    FROM fact_meter_reading""",
    "fact_hourly_billing": f"""
    SELECT meter_key, date_key, time_key, pricing_zone_key, reading_hour,
           {_dbl('energy_kwh', 'usage_revenue')}, reading_count,
           {_ratio_digits('usage_revenue', 'energy_kwh', 6)} AS price_per_kwh
    FROM fact_hourly_energy_billing""",
    "mart_operations": f"""
    SELECT period_grain, period_grain_order, period_start, meter_id, us_region, state_code,
           {_dbl('energy_kwh', 'voltage_sum', 'power_factor_sum')}, reading_count
    FROM mart_meter_operations_periodic""",
    "mart_billing": "SELECT * EXCLUDE (kwh, net, gross) FROM mart_executive_billing_periodic",
    "mart_billing_shipped": "SELECT * EXCLUDE (kwh, net, gross) FROM shipped_mart",
    "metric_daily_meter_kpis": f"""
    SELECT us_region AS reading__region, state_code AS reading__state_code,
           date_trunc('day', event_time) AS metric_time__day, {_METRICS_OF_READINGS},
           CAST(count(DISTINCT meter_id) AS BIGINT) AS reporting_meters, {_AVERAGES}
    FROM readings GROUP BY 1, 2, 3""",
    "metric_meter_electrical_kpis": f"""
    SELECT meter_id AS meter, CAST(date_trunc('day', event_time) AS TIMESTAMP)
               AS metric_time__day,
           {_METRICS_OF_READINGS}, {_AVERAGES}
    FROM readings GROUP BY 1, 2""",
    "metric_daily_regional_billing": f"""
    SELECT m.us_region AS meter__region, m.state_code AS meter__state_code,
           date_trunc('day', reading_hour) AS metric_time__day,
           CAST(sum(energy_kwh) AS DOUBLE) AS billed_energy_kwh,
           CAST(sum(usage_revenue) AS DOUBLE) AS usage_revenue,
           CAST(count(DISTINCT f.meter_key) AS BIGINT) AS billed_meters, {_REVENUE_RATIO}
    FROM fact_hourly_energy_billing f LEFT JOIN dim_meter m ON f.meter_key = m.meter_key
    GROUP BY 1, 2, 3""",
    "metric_energy_per_meter": """
    SELECT us_region AS reading__region,
           CAST(sum(energy_kwh) AS DOUBLE) / CAST(count(DISTINCT meter_id) AS DOUBLE)
               AS energy_per_reporting_meter_kwh,
           CAST(count(DISTINCT meter_id) AS BIGINT) AS reporting_meters
    FROM readings GROUP BY 1""",
    "metric_totals": f"""
    SELECT r.*, b.* FROM
      (SELECT {_METRICS_OF_READINGS}, CAST(count(DISTINCT meter_id) AS BIGINT)
                  AS reporting_meters, {_AVERAGES},
              CAST(sum(current_a) AS DOUBLE) / CAST(count(current_a) AS DOUBLE) AS avg_current_a
       FROM readings) r,
      (SELECT CAST(sum(energy_kwh) AS DOUBLE) AS billed_energy_kwh,
              CAST(sum(usage_revenue) AS DOUBLE) AS usage_revenue,
              CAST(count(DISTINCT meter_key) AS BIGINT) AS billed_meters, {_REVENUE_RATIO}
       FROM fact_hourly_energy_billing) b""",
    "metric_filtered_weeks": """
    SELECT coalesce(r.w, b.w) AS metric_time__week, r.e AS total_energy_consumed_kwh,
           b.e AS billed_energy_kwh
    FROM (SELECT date_trunc('week', event_time) AS w, CAST(sum(energy_kwh) AS DOUBLE) AS e
          FROM readings WHERE event_time >= TIMESTAMP '2024-01-05' GROUP BY 1) r
    FULL JOIN (SELECT date_trunc('week', reading_hour) AS w,
                      CAST(sum(energy_kwh) AS DOUBLE) AS e
               FROM fact_hourly_energy_billing
               WHERE reading_hour >= TIMESTAMP '2024-01-05' GROUP BY 1) b ON r.w = b.w""",
    "metric_zone_revenue": """
    SELECT z.currency_code AS pricing_zone__currency_code, m.us_region AS meter__region,
           CAST(sum(usage_revenue) AS DOUBLE) AS usage_revenue,
           CAST(count(DISTINCT f.meter_key) AS BIGINT) AS billed_meters
    FROM fact_hourly_energy_billing f LEFT JOIN dim_meter m ON f.meter_key = m.meter_key
    LEFT JOIN dim_pricing_zone z ON f.pricing_zone_key = z.pricing_zone_key GROUP BY 1, 2""",
    "metric_active_meters": """
    SELECT us_region AS activity__region, date_trunc('day', event_time) AS metric_time__day,
           CAST(count(DISTINCT meter_id) AS BIGINT) AS active_meters
    FROM readings GROUP BY 1, 2""",
    "distinct_meters_hour": """
    SELECT date_trunc('hour', event_time) AS period_start, us_region, state_code,
           CAST(count(DISTINCT meter_id) AS BIGINT) AS n_meters
    FROM readings GROUP BY 1, 2, 3""",
    "distinct_meters_grains": " UNION ALL ".join(
        [
            f"""SELECT date_trunc('{name.lower()}', event_time) AS period_start, us_region,
                   CAST(count(DISTINCT meter_id) AS BIGINT) AS n_meters, '{name}' AS period_grain
            FROM readings GROUP BY 1, 2"""
            for name, _ in GRAINS
        ]
        + [
            """SELECT CAST(NULL AS TIMESTAMP), us_region, CAST(count(DISTINCT meter_id) AS BIGINT), 'All'
            FROM readings GROUP BY 2"""
        ]
    ),
    "distinct_meters_loads": """
    SELECT date_trunc('week', event_time) AS period_start, state_code,
           CAST(count(DISTINCT meter_id) AS BIGINT) AS n_meters
    FROM readings GROUP BY 1, 2""",
    "distinct_meters_range": """
    SELECT date_trunc('day', event_time) AS period_start,
           CAST(count(DISTINCT meter_id) AS BIGINT) AS n_meters
    FROM readings WHERE date_trunc('hour', event_time) >= TIMESTAMP '2024-01-05 07:00:00'
      AND date_trunc('hour', event_time) < TIMESTAMP '2024-01-15 03:00:00' GROUP BY 1""",
    "distinct_shipped_orders": """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag,
           CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_orders
    FROM lineitem GROUP BY 1, 2""",
    "chart_totals_billing": """
    SELECT CAST(sum(gross) AS DOUBLE) AS gross_billed_usd,
           CAST(sum(net) AS DOUBLE) AS net_revenue_usd,
           CAST(sum(kwh) AS DOUBLE) AS billed_energy_kwh,
           CAST(count(DISTINCT meter_id) AS BIGINT) AS billed_meters
    FROM mart_executive_billing_periodic WHERE period_grain = 'Year'""",
    "chart_billing_trend": """
    SELECT period_start, us_region, CAST(sum(gross) AS DOUBLE) AS gross_billed_usd,
           CAST(sum(net) AS DOUBLE) AS net_revenue_usd
    FROM shipped_mart WHERE period_grain = 'Month' GROUP BY 1, 2 ORDER BY 1, 2""",
    "chart_revenue_region": """
    SELECT us_region, CAST(sum(net) AS DOUBLE) AS net_revenue_usd
    FROM shipped_mart WHERE period_grain = 'Year' GROUP BY 1""",
    "chart_revenue_state": """
    SELECT state_code, CAST(sum(net) AS DOUBLE) AS net_revenue_usd
    FROM shipped_mart WHERE period_grain = 'Year' GROUP BY 1""",
    "chart_realized_price": """
    SELECT period_start, us_region,
           CAST(sum(net) AS DOUBLE) / nullif(CAST(sum(kwh) AS DOUBLE), 0)
               AS realized_usd_per_kwh
    FROM shipped_mart WHERE period_grain = 'Week' GROUP BY 1, 2 ORDER BY 1, 2""",
    "chart_totals_operations": """
    SELECT CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh,
           CAST(sum(reading_count) AS BIGINT) AS readings,
           CAST(count(DISTINCT meter_id) AS BIGINT) AS meters,
           CAST(sum(voltage_sum) AS DOUBLE) / CAST(sum(reading_count) AS DOUBLE)
               AS average_voltage_v,
           CAST(sum(power_factor_sum) AS DOUBLE) / CAST(sum(reading_count) AS DOUBLE)
               AS average_power_factor
    FROM mart_meter_operations_periodic WHERE period_grain = 'Year'""",
    "chart_energy_trend": """
    SELECT period_start, CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh
    FROM mart_meter_operations_periodic WHERE period_grain = 'Day'
    GROUP BY 1 ORDER BY 1""",
    "chart_energy_trend_range": """
    SELECT period_start, CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh
    FROM mart_meter_operations_periodic
    WHERE period_grain = 'Hour' AND period_start >= TIMESTAMP '2024-01-10'
      AND period_start <= TIMESTAMP '2024-01-12'
    GROUP BY 1 ORDER BY 1""",
    "chart_top_meters": """
    SELECT meter_id, CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh
    FROM mart_meter_operations_periodic WHERE period_grain = 'Year'
    GROUP BY 1 ORDER BY sum(energy_kwh) DESC, meter_id LIMIT 10""",
    "chart_health_trend": """
    SELECT period_start,
           CAST(sum(voltage_sum) AS DOUBLE) / CAST(sum(reading_count) AS DOUBLE)
               AS average_voltage_v,
           CAST(sum(power_factor_sum) AS DOUBLE) / CAST(sum(reading_count) AS DOUBLE)
               AS average_power_factor
    FROM mart_meter_operations_periodic WHERE period_grain = 'Day'
    GROUP BY 1 ORDER BY 1""",
    "chart_grain_order": """
    SELECT period_grain, min(period_grain_order) AS period_grain_order,
           CAST(count(*) AS BIGINT) AS n_periods
    FROM mart_meter_operations_periodic GROUP BY 1""",
    "check_rows": " UNION ALL ".join(
        [
            _counted("events", "not_null:value", "value IS NULL"),
            _counted("events", "not_empty:event_type", "trim(event_type) = ''"),
            _counted(
                "events", "accepted_values:event_type",
                "event_type NOT IN ('click', 'view', 'purchase')",
            ),
            _counted("events", "accepted_range:value", "value < 5 OR value > 20"),
            _counted(
                "lineitem", "accepted_range:l_discount", "l_discount < 0 OR l_discount > 0.05"
            ),
            _counted("lineitem", "accepted_range:l_tax", "l_tax <= 0 OR l_tax >= 0.08"),
        ]
    ),
    "check_unique": """
    SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_records FROM lineitem
    GROUP BY 1 HAVING count(*) > 1""",
    "check_combo": """
    SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_records FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_relationship": """
    SELECT o_orderkey, CAST(count(*) AS BIGINT) AS n_records FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""",
    "check_core": _suite(quality.core_checks()),
    "check_vault": _suite(quality.vault_checks()),
    "check_business_vault": _suite(quality.business_vault_checks()),
    "check_information": _suite(quality.information_checks()),
    "check_presentation": _suite(quality.presentation_checks()),
    "stream_hourly": _hourly_stream(
        "CAST(sum(CAST(value AS DECIMAL(12,5))) AS DOUBLE) AS amount", "event_type", "events",
        "ts", "events",
    ),
    "stream_dedupe": "SELECT event_id, ts AS moment, event_type, value FROM events",
    "stream_priced": _hourly_stream(
        "CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh,"
        " CAST(sum(usage_revenue) AS DOUBLE) AS usage_revenue",
        "CAST(substr(meter_id, 7) AS BIGINT) AS user_id, state_code", "priced", "event_time",
        "priced",
    ),
    "stream_hourly_all": """
    SELECT date_trunc('hour', ts) AS reading_hour, event_type,
           CAST(sum(CAST(value AS DECIMAL(12,5))) AS DOUBLE) AS amount,
           CAST(count(*) AS BIGINT) AS reading_count
    FROM events GROUP BY ALL""",
    "stream_priced_all": """
    SELECT date_trunc('hour', event_time) AS reading_hour,
           CAST(substr(meter_id, 7) AS BIGINT) AS user_id, state_code,
           CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh,
           CAST(sum(usage_revenue) AS DOUBLE) AS usage_revenue,
           CAST(count(*) AS BIGINT) AS reading_count
    FROM priced GROUP BY ALL""",
    "stream_hourly_merged": """
    SELECT date_trunc('hour', ts) AS reading_hour, event_type,
           CAST(sum(CAST(value AS DECIMAL(12,5))) AS DOUBLE) AS amount,
           CAST(count(*) AS BIGINT) AS reading_count
    FROM events GROUP BY ALL""",
    "stream_repriced": """
    SELECT date_trunc('hour', event_time) AS reading_hour, meter_id, state_code,
           CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh,
           CAST(sum(usage_revenue) AS DOUBLE) AS usage_revenue,
           CAST(count(*) AS BIGINT) AS reading_count
    FROM priced GROUP BY ALL""",
    "incremental_billing": " UNION ALL ".join(
        f"""SELECT '{name}' AS period_grain, {order} AS period_grain_order,
                   greatest(date_trunc('{name.lower()}', event_time),
                            (SELECT date_trunc('hour', min(event_time)) FROM final_rows)) AS period_start,
                   meter_id, state_code, CAST(sum(energy_kwh) AS DOUBLE) AS energy_kwh,
                   CAST(sum(usage_revenue) AS DOUBLE) AS usage_revenue, CAST(count(*) AS BIGINT) AS n_rows
            FROM final_rows GROUP BY ALL"""
        for name, order in GRAINS
    ),
    "incremental_loads": """
    SELECT 1 AS load,
           CAST(count(DISTINCT (meter_id, state_code, date_trunc('hour', old_time))) AS BIGINT) AS touched_hours,
           CAST(count(*) AS BIGINT) AS rows_summed,
           (SELECT CAST(count(*) AS BIGINT) FROM (
               SELECT DISTINCT meter_id, state_code, g.n, date_trunc(g.n, old_time) FROM final_rows, load_grains g
               WHERE in_first)) AS touched_periods
    FROM final_rows WHERE in_first
    UNION ALL
    SELECT 2, CAST(count(*) AS BIGINT),
           (SELECT CAST(count(*) AS BIGINT) FROM final_rows f
            WHERE (meter_id, state_code, date_trunc('hour', event_time)) IN (SELECT (meter_id, state_code, hour) FROM second_hours)),
           (SELECT CAST(count(*) AS BIGINT) FROM (
               SELECT DISTINCT meter_id, state_code, g.n, date_trunc(g.n, hour) FROM second_hours, load_grains g))
    FROM second_hours""",
    "job_backfill_readings": """
    SELECT substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-4' || substr(digest, 14, 3)
               || '-a' || substr(digest, 18, 3) || '-' || substr(digest, 21, 12) AS event_id,
           '1.0' AS schema_version, meter_id, us_region, state_code,
           date_trunc('second', ts) AS event_time, value AS energy_kwh,
           CAST(230 AS DOUBLE) AS voltage_v, CAST(4.5 AS DOUBLE) AS current_a,
           CAST(0.95 AS DOUBLE) AS power_factor
    FROM raw_reasons WHERE len(reasons) = 0
      AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-19'""",
    "job_warehouse_readings": """
    SELECT substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-4' || substr(digest, 14, 3)
               || '-a' || substr(digest, 18, 3) || '-' || substr(digest, 21, 12) AS event_id,
           '1.0' AS schema_version, meter_id, us_region, state_code,
           date_trunc('second', ts) AS event_time, value AS energy_kwh,
           CAST(230 AS DOUBLE) AS voltage_v, CAST(4.5 AS DOUBLE) AS current_a,
           CAST(0.95 AS DOUBLE) AS power_factor
    FROM raw_reasons WHERE len(reasons) = 0""",
    "job_warehouse_prices": """
    SELECT a.price_id, '1.0' AS schema_version, a.region AS us_region, a.state_code,
           'USD' AS currency_code, a.effective_from,
           CAST(coalesce(b.price_per_kwh, a.price_per_kwh) AS DOUBLE) AS price_per_kwh,
           CASE WHEN b.price_id IS NULL THEN 'feed-1' ELSE 'feed-2' END AS source_system
    FROM price_loads a LEFT JOIN price_loads b
      ON b.batch = 2 AND a.state_code = b.state_code AND a.effective_from = b.effective_from
    WHERE a.batch = 1""",
    "job_price_counts": """
    SELECT batch, 'raw' AS stage, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE is_malformed) AS BIGINT) AS n_malformed,
           CAST(count(*) FILTER (WHERE is_rejected) AS BIGINT) AS n_rejected,
           CAST(0 AS BIGINT) AS n_inserted, CAST(0 AS BIGINT) AS n_updated
    FROM price_records GROUP BY 1
    UNION ALL
    SELECT r.batch, 'curated', CAST(r.n AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
           CAST(CASE WHEN r.batch = 1 THEN l.n ELSE 0 END AS BIGINT),
           CAST(CASE WHEN r.batch = 2 THEN l.n ELSE 0 END AS BIGINT)
    FROM (SELECT batch, count(*) AS n FROM price_records
          WHERE NOT is_malformed AND NOT is_rejected GROUP BY 1) r
    JOIN (SELECT batch, count(*) AS n FROM price_loads GROUP BY 1) l ON r.batch = l.batch""",
    "job_quarantine_reasons": """
    SELECT CASE WHEN k = 6 THEN 'dynamic_frame' ELSE 'quality' END AS error_type,
           'smart_meter_raw_to_curated' AS error_stage, reason,
           CAST(count(*) AS BIGINT) AS n_records
    FROM (SELECT k, unnest(reasons) AS reason FROM raw_reasons) GROUP BY ALL""",
    "job_summaries": """
    SELECT 'smart_meter_raw_to_curated' AS job, 'run-1' AS run_id, 'incremental' AS processing_mode,
           CAST(1 AS BIGINT) AS processed_batches, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE k = 6) AS BIGINT) AS malformed,
           CAST(count(*) FILTER (WHERE k <> 6 AND len(reasons) > 0) AS BIGINT) AS rejected
    FROM raw_reasons
    UNION ALL SELECT 'smart_meter_raw_to_curated', 'run-2', 'incremental', 0, 0, 0, 0""",
    "job_ledger": """
    SELECT 'raw' AS stage, 'run-' || batch AS job_run_id, TIMESTAMP '2024-02-01' AS completed_at,
           CAST(count(DISTINCT date_trunc('day', effective_from)) AS BIGINT) AS n_files,
           CAST(count(DISTINCT date_trunc('day', effective_from)) AS BIGINT) AS n_distinct
    FROM price_records GROUP BY batch""",
    "job_source_files": """
    SELECT strftime(ts, '%Y-%m-%d') AS source_day, CAST(count(*) AS BIGINT) AS n_records,
           CAST(0 AS BIGINT) AS max_line
    FROM raw_reasons WHERE len(reasons) = 0 GROUP BY 1""",
    "stream_landing": """
    SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
           CAST(hour(ts) AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS n_records,
           CAST(count(DISTINCT meter_id) AS BIGINT) AS n_meters
    FROM raw_records WHERE k <> 6 GROUP BY ALL""",
    "stream_error_landing": """
    SELECT 'processing-failed' AS error_type, 2024 AS year, 2 AS month, 1 AS day, 13 AS hour,
           CAST(count(*) AS BIGINT) AS n_records, CAST(count(*) AS BIGINT) AS n_whole
    FROM raw_records WHERE k = 6""",
    "source_readings": f"""
    SELECT event_id, schema_version, meter_id, us_region, state_code, event_time,
           {_dbl('energy_kwh', 'voltage_v', 'current_a', 'power_factor')}, 'events' AS bucket_name,
           substr(record_source, 8) AS object_key, CAST(0 AS INTEGER) AS source_line_number, record_source, load_datetime
    FROM readings""",
    "job_partition_inventory": """
    SELECT DISTINCT 'meter-readings/' || strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H')
        AS partition
    FROM events""",
}


def _needs_ctes(sql: str) -> str:
    """Statements that open with their own WITH keep it; they use supplied tables only."""
    return sql if sql.lstrip().startswith("WITH") else _with(sql)


def oracle_statements() -> dict[str, str]:
    return {name: _needs_ctes(sql).strip() for name, sql in STATEMENTS.items()}
