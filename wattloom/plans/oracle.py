"""The bound tables as DuckDB SQL, for comparing results."""

from __future__ import annotations

from wattloom import schemas
from wattloom.plans.bindings import _END_USE, _REQUEST_JSON, _WAVES, NESTED, UNMAPPED_FROM


def xsum(expr: str, digits: int = 6) -> str:
    return f"(sum(cast(round_even(({expr}) * 1e{digits}, 0) AS BIGINT)) / 1e{digits})"


def xavg(expr: str, digits: int = 9) -> str:
    return f"({xsum(expr, digits)} / nullif(count({expr}), 0))"


def _columns(names, form) -> str:
    return ", ".join(form(n) for n in names)


MEASURES = list(schemas.READING_MEASURES)
_TOTALS = ["electricity_kwh", "net_electricity_kwh", *schemas.END_USES]
# Columns of nested days and months as rows.
NESTED_DAY = f"'day' AS level, usage_date AS period, hours_present AS present, {', '.join(NESTED)}"
NESTED_MONTH = f"'month', cast(usage_month AS DATE), days_present, {', '.join(NESTED)}"
PLACE_KEYS = "building_id, state, county_code, weather_city"
HOUR_END = "date_trunc('hour', {ts} - INTERVAL 1 SECOND) + INTERVAL 1 HOUR"
USAGE_DATE = "cast({ts} - INTERVAL 1 SECOND AS DATE)"


def _hourly(source: str) -> str:
    return f"""
      SELECT building_id, {HOUR_END.format(ts='source_timestamp')} AS source_hour_end,
             count(*) AS interval_count,
             {_columns(MEASURES, lambda m: f"{xsum(m)} AS {m}")},
             max(electricity_kwh * 4.0::DOUBLE) AS peak_15min_average_kw
      FROM {source} GROUP BY ALL"""


def _enriched(hours: str, weather: str) -> str:
    return f"""
      SELECT c.building_id, b.state, b.county_code, b.weather_city,
             c.source_hour_end AS hour_end,
             {USAGE_DATE.format(ts='c.source_hour_end')} AS usage_date,
             c.interval_count, c.electricity_kwh, c.net_electricity_kwh,
             c.cooling_kwh, c.cooling_fans_pumps_kwh,
             c.cooling_kwh + c.cooling_fans_pumps_kwh AS cooling_system_kwh,
             c.heating_kwh, c.heating_backup_kwh, c.heating_fans_pumps_kwh,
             c.heating_kwh + c.heating_backup_kwh + c.heating_fans_pumps_kwh AS heating_system_kwh,
             c.hot_water_kwh, c.peak_15min_average_kw, w.temperature_c,
             w.temperature_c * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE AS temperature_f,
             {_columns(schemas.WEATHER_MEASURES, lambda m: f"w.{m}")},
             w.source_file AS weather_source_file
      FROM {hours} c JOIN buildings b USING (building_id)
      JOIN {weather} w ON b.county_code = w.county_code AND c.source_hour_end = w.weather_timestamp"""


def _degree_days(source: str) -> str:
    return f"""
      SELECT *, greatest(average_temperature_f - 65.0::DOUBLE, 0.0::DOUBLE) AS cooling_degree_days_65,
             greatest(65.0::DOUBLE - average_temperature_f, 0.0::DOUBLE) AS heating_degree_days_65
      FROM ({source})"""


def _daily(source: str) -> str:
    return _degree_days(f"""
      SELECT {PLACE_KEYS}, usage_date, count(*) AS hours_present,
             {_columns(_TOTALS, lambda m: f"{xsum(m)} AS {m}")},
             max(peak_15min_average_kw) AS peak_15min_average_kw,
             {xavg('temperature_f')} AS average_temperature_f,
             min(temperature_f) AS minimum_temperature_f,
             max(temperature_f) AS maximum_temperature_f,
             {xavg('relative_humidity_pct')} AS average_relative_humidity_pct,
             {xavg('wind_speed_mps')} AS average_wind_speed_mps
      FROM {source} GROUP BY ALL""")


def _monthly(source: str, digits: int) -> str:
    return f"""
      SELECT {PLACE_KEYS}, cast(date_trunc('month', usage_date) AS TIMESTAMP) AS usage_month,
             count(*) AS days_present,
             {xavg('electricity_kwh', digits)} AS average_daily_kwh,
             {_columns(_TOTALS, lambda m: f"{xsum(m, digits)} AS {m}")},
             max(peak_15min_average_kw) AS peak_15min_average_kw,
             {xavg('average_temperature_f')} AS average_temperature_f,
             min(minimum_temperature_f) AS minimum_temperature_f,
             max(maximum_temperature_f) AS maximum_temperature_f,
             {xsum('cooling_degree_days_65', 9)} AS cooling_degree_days_65,
             {xsum('heating_degree_days_65', 9)} AS heating_degree_days_65,
             {xavg('average_relative_humidity_pct')} AS average_relative_humidity_pct,
             {xavg('average_wind_speed_mps')} AS average_wind_speed_mps
      FROM {source} GROUP BY ALL"""


def _lagged(source: str) -> str:
    return f"""
      SELECT *, lag(usage_month) OVER w AS previous_month,
             {_columns(schemas.LAGGED, lambda m: f"lag({m}) OVER w AS previous_{m}")}
      FROM {source} WINDOW w AS (PARTITION BY building_id ORDER BY usage_month)"""


def _investigation(source: str) -> str:
    return f"""
      SELECT {", ".join(schemas.INVESTIGATION_COLUMNS)} FROM (
        SELECT *,
          CASE WHEN previous_average_daily_kwh IS NULL OR previous_average_daily_kwh = 0 THEN NULL
               ELSE (average_daily_kwh - previous_average_daily_kwh)
                    / previous_average_daily_kwh * 100.0::DOUBLE END AS daily_usage_change_pct,
          electricity_change_kwh - cooling_change_kwh - heating_change_kwh - hot_water_change_kwh
            AS other_electricity_change_kwh,
          CASE WHEN electricity_change_kwh IS NULL OR electricity_change_kwh = 0 THEN NULL
               ELSE cooling_change_kwh / electricity_change_kwh * 100.0::DOUBLE END
            AS cooling_share_of_net_change_pct
        FROM (SELECT *, {_columns(schemas.CHANGES.items(), lambda p: f"{p[1]} - previous_{p[1]} AS {p[0]}")}
              FROM {source}))"""


def _wave(spec) -> str:
    a, b, cycle, scale, shift = spec
    return f"(({a} * nk + {b} * h) % {cycle})::DOUBLE / {scale}::DOUBLE + ({shift})::DOUBLE"


def _sparse_case(measure: str) -> str:
    return f"CASE WHEN {_END_USE[measure]} THEN value ELSE 0.0::DOUBLE END"


def _long_use(condition: str) -> str:
    return xsum(f"CASE WHEN {condition} THEN l_extendedprice ELSE 0.0::DOUBLE END", 2)


# name -> (SQL, names of the tables it reads besides the given ones)
_TABLES: dict[str, tuple[str, list[str]]] = {
    # Readings under their short names.
    "sparse": (
        f"""SELECT user_id AS building_id, ts AS source_timestamp,
              {_columns(MEASURES, lambda m: f"{_sparse_case(m)} AS {m}")},
              cast(ts AS DATE) AS ingest_date
            FROM (SELECT *, cast(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
        [],
    ),
    "bounds": (
        """SELECT cast(min(cast(ts AS DATE)) AS TIMESTAMP) AS first_midnight,
                  cast(max(cast(ts AS DATE)) AS TIMESTAMP) + INTERVAL 1 DAY AS last_midnight
           FROM events""",
        [],
    ),
    "dense": (
        f"""SELECT g.building_id, g.source_timestamp,
              {_columns(MEASURES, lambda m: f"coalesce(u.{m}, 0.0::DOUBLE) AS {m}")},
              cast(g.source_timestamp AS DATE) AS ingest_date
            FROM (SELECT building_id,
                         unnest(generate_series(
                           (SELECT first_midnight FROM bounds) + INTERVAL 15 MINUTE,
                           (SELECT last_midnight FROM bounds), INTERVAL 15 MINUTE)) AS source_timestamp
                  FROM (SELECT DISTINCT building_id FROM sparse)) g
            LEFT JOIN (SELECT building_id,
                              make_timestamp(((epoch_us(source_timestamp) + 899999999) // 900000000)
                                             * 900000000) AS source_timestamp,
                              {_columns(MEASURES, lambda m: f"{xsum(m, 2)} AS {m}")}
                       FROM sparse GROUP BY ALL) u
              USING (building_id, source_timestamp)""",
        ["sparse", "bounds"],
    ),
    "metadata": (
        """SELECT c_custkey AS building_id, u.upgrade, r_name AS state, n_name AS county_code,
                  c_mktsegment AS building_type,
                  CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal END AS floor_area_sqft,
                  cast(1940 + c_custkey % 80 AS VARCHAR) AS construction_vintage,
                  CASE WHEN c_custkey % 3 = 0 THEN 'Natural Gas' ELSE 'Electricity' END AS heating_fuel,
                  CASE WHEN c_custkey % 2 = 0 THEN 'Furnace' ELSE 'Heat pump' END AS heating_system,
                  'Central AC' AS cooling_system,
                  (c_custkey * 100)::DOUBLE AS reference_annual_electricity_kwh
           FROM customer JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey, (VALUES (0), (1)) u(upgrade)""",
        [],
    ),
    "locations": (
        "SELECT n_name AS county_code, 'Station ' || n_nationkey AS weather_city FROM nation",
        [],
    ),
    "partial_locations": (
        f"""SELECT 'NATION_' || k AS county_code, 'Station ' || k AS weather_city
            FROM range({UNMAPPED_FROM}) t(k)""",
        [],
    ),
    "buildings": (
        """SELECT m.* EXCLUDE (upgrade), l.weather_city
           FROM (SELECT DISTINCT user_id AS building_id FROM events)
           LEFT JOIN (SELECT * FROM metadata WHERE upgrade = 0) m USING (building_id)
           LEFT JOIN locations l USING (county_code)""",
        ["metadata", "locations"],
    ),
    "candidates": (
        """SELECT e.building_id, m.* EXCLUDE (upgrade, building_id), l.weather_city
           FROM (SELECT DISTINCT user_id AS building_id FROM events) e
           LEFT JOIN (SELECT * FROM metadata WHERE upgrade = 0) m USING (building_id)
           LEFT JOIN partial_locations l USING (county_code)""",
        ["metadata", "partial_locations"],
    ),
    "weather": (
        f"""SELECT n_name AS county_code, first_midnight + h * INTERVAL 1 HOUR AS weather_timestamp,
              {_columns(_WAVES.items(), lambda w: f"{_wave(w[1])} AS {w[0]}")},
              'weather_' || nk || '.csv' AS source_file
            FROM (SELECT n_name, n_nationkey::BIGINT AS nk, first_midnight,
                         unnest(generate_series(1::BIGINT, 24::BIGINT * date_diff('day', first_midnight, last_midnight))) AS h
                  FROM nation, bounds)""",
        ["bounds"],
    ),
    "gappy_weather": (
        """SELECT * FROM weather
           WHERE NOT (county_code IN ('NATION_3', 'NATION_11') AND hour(weather_timestamp) < 4)
           UNION ALL SELECT * FROM weather WHERE county_code = 'NATION_7'""",
        ["weather"],
    ),
    "sparse_hours": (_hourly("sparse"), ["sparse"]),
    "dense_hours": (_hourly("dense"), ["dense"]),
    "enriched": (_enriched("dense_hours", "weather"), ["dense_hours", "buildings", "weather"]),
    "enriched_sparse": (
        _enriched("sparse_hours", "weather"),
        ["sparse_hours", "buildings", "weather"],
    ),
    "daily": (_daily("enriched"), ["enriched"]),
    "daily_sparse": (_daily("enriched_sparse"), ["enriched_sparse"]),
    "monthly": (_monthly("daily", 6), ["daily"]),
    "investigation": (_investigation("lagged_meter"), ["lagged_meter"]),
    "lagged_meter": (_lagged("monthly"), ["monthly"]),
    "daily_long": (
        _degree_days(f"""
            SELECT l_suppkey AS building_id, r_name AS state, n_name AS county_code,
                   'Station ' || s_nationkey AS weather_city, usage_date, 24::BIGINT AS hours_present,
                   electricity_kwh, net_electricity_kwh, cooling_system_kwh, heating_system_kwh,
                   hot_water_kwh, peak_15min_average_kw,
                   ((13 * nk + 7 * n) % 1000)::DOUBLE / 10.0::DOUBLE AS average_temperature_f,
                   ((13 * nk + 7 * n) % 1000 - 85)::DOUBLE / 10.0::DOUBLE AS minimum_temperature_f,
                   ((13 * nk + 7 * n) % 1000 + 97)::DOUBLE / 10.0::DOUBLE AS maximum_temperature_f,
                   ((5 * nk + 11 * n) % 700)::DOUBLE / 10.0::DOUBLE AS average_relative_humidity_pct,
                   ((nk + 3 * n) % 200)::DOUBLE / 10.0::DOUBLE AS average_wind_speed_mps
            FROM (SELECT l_suppkey, cast(l_shipdate AS DATE) AS usage_date,
                         {_long_use("TRUE")} AS electricity_kwh,
                         {_long_use("NOT (l_returnflag = 'N' AND l_linestatus = 'F')")} AS net_electricity_kwh,
                         {_long_use("l_returnflag = 'R'")} AS cooling_system_kwh,
                         {_long_use("l_returnflag = 'A'")} AS heating_system_kwh,
                         {_long_use("l_returnflag = 'N' AND l_linestatus = 'O'")} AS hot_water_kwh,
                         max(l_quantity) AS peak_15min_average_kw,
                         date_diff('day', DATE '1995-01-01', cast(l_shipdate AS DATE)) AS n
                  FROM lineitem GROUP BY l_suppkey, cast(l_shipdate AS DATE))
            JOIN (SELECT *, s_nationkey::BIGINT AS nk FROM supplier) ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
        [],
    ),
    "monthly_long": (_monthly("daily_long", 2), ["daily_long"]),
    "lagged": (_lagged("monthly_long"), ["monthly_long"]),
    "investigation_long": (_investigation("lagged"), ["lagged"]),
    "supplier_buildings": (
        """SELECT s_suppkey AS building_id, r_name AS state, n_name AS county_code,
                  CASE WHEN s_suppkey % 9 <> 0 THEN 'Type ' || (s_suppkey % 4) END AS building_type,
                  CASE WHEN s_suppkey % 10 = 0 THEN 0.0::DOUBLE
                       WHEN s_suppkey % 4 = 0 THEN s_suppkey::DOUBLE
                       ELSE s_acctbal END AS floor_area_sqft,
                  CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE cast(1950 + s_suppkey % 70 AS VARCHAR) END
                    AS construction_vintage,
                  CASE WHEN s_suppkey % 3 = 0 THEN 'Natural Gas' ELSE 'Electricity' END AS heating_fuel,
                  'Furnace' AS heating_system,
                  CASE WHEN s_suppkey % 5 <> 0 THEN 'Central AC' END AS cooling_system,
                  'Station ' || s_nationkey AS weather_city,
                  s_suppkey::DOUBLE * 10.5::DOUBLE AS reference_annual_electricity_kwh
           FROM supplier JOIN nation ON s_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey""",
        [],
    ),
    "metrics": (
        f"""SELECT building_id, count(DISTINCT usage_date) AS days_present,
                   {xsum('electricity_kwh', 2)} AS annual_electricity_kwh,
                   {xavg('electricity_kwh', 2)} AS average_daily_kwh,
                   max(peak_15min_average_kw) AS peak_15min_average_kw
            FROM daily_long GROUP BY building_id""",
        ["daily_long"],
    ),
    "summary": (
        """SELECT b.building_id, 'DEMO-' || b.building_id AS account_id, b.state, b.county_code,
                  b.building_type, b.floor_area_sqft, b.construction_vintage, b.heating_fuel,
                  b.heating_system, b.cooling_system, m.days_present, m.annual_electricity_kwh,
                  m.average_daily_kwh, m.peak_15min_average_kw,
                  'Modeled ResStock building; not a real customer account' AS data_description
           FROM supplier_buildings b JOIN metrics m USING (building_id)""",
        ["supplier_buildings", "metrics"],
    ),
    "accounts": (
        """SELECT s.*, b.weather_city, b.reference_annual_electricity_kwh
           FROM summary s JOIN supplier_buildings b USING (building_id)""",
        ["summary", "supplier_buildings"],
    ),
    "requests": (
        "SELECT o_orderkey AS request_id, "
        + _REQUEST_JSON.format(month="strftime(o_orderdate, '%Y-%m')", div="//")
        + " AS request_json FROM orders",
        [],
    ),
    "parsed": (
        """SELECT *, coalesce(json_type(j) = 'OBJECT', false) AS is_object,
                  CASE WHEN json_type(j, '$.operation') = 'VARCHAR'
                       THEN json_extract_string(j, '$.operation') END AS operation,
                  CASE WHEN json_type(j, '$.account_id') = 'VARCHAR'
                       THEN json_extract_string(j, '$.account_id') END AS account_id,
                  CASE WHEN json_type(j, '$.month') = 'VARCHAR'
                       THEN json_extract_string(j, '$.month') END AS month
           FROM (SELECT *, try_cast(request_json AS JSON) AS j FROM requests)""",
        ["requests"],
    ),
    "validated": (
        r"""SELECT request_id, operation, account_id, month,
              CASE WHEN NOT is_object THEN 'MALFORMED_REQUEST'
                   WHEN operation IS NULL OR operation NOT IN ('list_accounts', 'account_details',
                        'investigate_usage', 'explain_usage') THEN 'UNSUPPORTED_OPERATION'
                   WHEN operation <> 'list_accounts'
                        AND (account_id IS NULL OR NOT regexp_matches(account_id, '\S'))
                        THEN 'MISSING_FIELD'
                   WHEN operation IN ('investigate_usage', 'explain_usage')
                        AND (month IS NULL OR NOT regexp_matches(month, '^\d{4}-(0[1-9]|1[0-2])$'))
                        THEN 'INVALID_MONTH_FORMAT' END AS code
            FROM parsed""",
        ["parsed"],
    ),
    "located": (
        """SELECT v.request_id, v.operation, v.account_id, v.month, a.building_id,
                  i.building_id IS NOT NULL AS has_row, i.previous_month,
                  CASE WHEN v.code IS NOT NULL THEN v.code
                       WHEN v.operation = 'list_accounts' THEN NULL
                       WHEN a.building_id IS NULL THEN 'INVALID_REQUEST'
                       WHEN v.operation <> 'account_details' AND i.building_id IS NULL
                            THEN 'INVALID_REQUEST' END AS code
           FROM validated v LEFT JOIN summary a ON v.account_id = a.account_id
           LEFT JOIN investigation_long i
             ON v.account_id = 'DEMO-' || i.building_id AND v.month = strftime(i.usage_month, '%Y-%m')""",
        ["validated", "summary", "investigation_long"],
    ),
    "records": (
        """SELECT cast(o_orderdate AS DATE) AS run_date,
                  CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'NO_DATA'
                       ELSE 'FAILED' END AS status,
                  CASE WHEN o_orderstatus = 'F' THEN cast(round(o_totalprice) AS BIGINT) END AS size,
                  CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS moved
           FROM orders""",
        [],
    ),
    "incoming": (
        """SELECT 'meter-' || o_orderkey || '.parquet' AS file_name,
                  cast(round(o_totalprice) AS BIGINT) AS size_bytes
           FROM orders WHERE o_orderkey % 3 <> 0""",
        [],
    ),
    "landing": (
        """SELECT 'meter-' || o_orderkey || '.parquet' AS file_name,
                  cast(round(o_totalprice) AS BIGINT) AS size_bytes
           FROM orders WHERE o_orderkey % 5 <> 0""",
        [],
    ),
    "archive": (
        """SELECT 'meter-' || o_orderkey || '.parquet' AS file_name,
                  cast(round(o_totalprice) AS BIGINT)
                    + CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END AS size_bytes
           FROM orders WHERE o_orderkey % 7 <> 0""",
        [],
    ),
}


def with_tables(body: str, *names: str) -> str:
    """``body`` preceded by the tables it reads, each after those it needs itself."""
    ordered: list[str] = []

    def add(name: str) -> None:
        sql, needs = _TABLES[name]
        for other in needs:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    head = ",\n".join(f"{n} AS ({_TABLES[n][0]})" for n in ordered)
    return f"WITH {head}\n{body}"
