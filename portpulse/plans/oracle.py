"""The registered queries as SQL for a second engine, written independently.

The shared part follows the plain definition rather than the library's design:
``lag`` for the lower bound, an anti join for outages, the statuses of a port laid
out on the full grid of buckets, residuals by window. ``status_durations`` even
counts on a 30-second grid.
"""

from __future__ import annotations

STATUSES = [
    "Charging",
    "Finishing",
    "Reserved",
    "Available",
    "Unavailable",
    "Out of order",
    "Unknown",
    "Inoperative",
    "Blocked",
    "Missing",
]
METRICS = ["Utilisation", "Uptime", "Unavailability"]
LO = "TIMESTAMP '2024-01-01 13:00:00'"
HI = "TIMESTAMP '2024-01-28 13:00:00'"
FROM, TO = "TIMESTAMP '2024-01-03'", "TIMESTAMP '2024-01-27'"
PORT = "evse_id, evse_port_id"

STATE = """CASE WHEN postcode BETWEEN 2000 AND 2599 OR postcode BETWEEN 2619 AND 2899
        OR postcode BETWEEN 2921 AND 2999 THEN 'NSW'
      WHEN postcode BETWEEN 2600 AND 2618 OR postcode BETWEEN 2900 AND 2920 THEN 'ACT'
      WHEN postcode BETWEEN 3000 AND 3996 THEN 'VIC'
      WHEN postcode BETWEEN 4000 AND 4999 THEN 'QLD'
      WHEN postcode BETWEEN 5000 AND 5799 THEN 'SA'
      WHEN postcode BETWEEN 6000 AND 6797 THEN 'WA'
      WHEN postcode BETWEEN 7000 AND 7799 THEN 'TAS'
      WHEN postcode BETWEEN 800 AND 899 THEN 'NT' END"""

STATUS = """CASE WHEN event_type = 'view' THEN 'Available'
      WHEN event_type = 'click' THEN 'Charging'
      WHEN event_type = 'purchase' THEN 'Finishing'
      WHEN event_type = 'signup' AND value < 5 THEN 'Unknown'
      WHEN event_type = 'signup' THEN 'Reserved'
      WHEN event_type = 'error' AND value < 20 THEN 'Unavailable'
      WHEN event_type = 'error' AND value < 30 THEN 'Inoperative'
      WHEN event_type = 'error' AND value < 40 THEN 'Blocked'
      ELSE 'Out of order' END"""

# --- tables ----------------------------------------------------------------
TABLES = f"""
site AS (
  SELECT c_custkey AS site, c_mktsegment AS cpo_name, c_name AS address,
         'Suburb ' || n_regionkey AS suburb,
         CAST(CASE n_regionkey WHEN 0 THEN 2000 WHEN 1 THEN 2605 WHEN 2 THEN 3000
              WHEN 3 THEN 4000 ELSE 5900 END + c_nationkey % 3 AS INTEGER) AS postcode,
         'LGA ' || (c_nationkey % 8) AS lga_name,
         -35.0::DOUBLE + (c_custkey % 97)::DOUBLE / 97.0::DOUBLE AS latitude,
         149.0::DOUBLE + (c_custkey % 89)::DOUBLE / 89.0::DOUBLE AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
loc0 AS (
  SELECT 'E' || (user_id // 3) AS evse_id, 'P' || user_id AS evse_port_id, cpo_name, address,
         suburb, postcode, lga_name, {STATE} AS state,
         latitude + ((user_id // 3) % 2)::DOUBLE * 0.0005::DOUBLE AS latitude, longitude,
         (7 + 15 * ((user_id // 3) % 4))::DOUBLE AS power, user_id, site
  FROM (SELECT DISTINCT user_id FROM events) JOIN site ON site = user_id // 6),
loc1 AS (SELECT * FROM loc0 WHERE state IN ('NSW', 'ACT', 'VIC', 'QLD')),
log AS (
  SELECT 'E' || (user_id // 3) AS evse_id, 'P' || user_id AS evse_port_id, cpo_name,
         {STATUS} AS status, ts AS update_time
  FROM events JOIN site ON site = user_id // 6),
win AS (
  SELECT cpo_name, ts AS offline_timestamp,
         ts + to_minutes(CAST(60 + event_id % 400 AS INTEGER)) AS online_timestamp
  FROM events JOIN site ON site = user_id // 6
  WHERE event_type = 'error' AND value >= 300 AND ts > {LO} AND ts < {HI})"""

FUNDED = f"""
grants AS (
  SELECT cpo_name, CASE WHEN site % 2 = 0 THEN 'Grant ' || address ELSE 'Unlisted' END AS f_address,
         suburb, postcode, 'Shire ' || site AS f_lga, {STATE} AS state,
         latitude + 0.0002::DOUBLE AS f_lat, longitude AS f_lon,
         'Destination Charging ' || (1 + site % 2) AS label
  FROM site WHERE site % 3 = 0 AND site IN (SELECT user_id // 6 FROM events)),
grant1 AS (
  SELECT * FROM grants
  QUALIFY row_number() OVER (PARTITION BY state, postcode, cpo_name, suburb
                             ORDER BY f_address, f_lga, f_lat, f_lon) = 1),
nearest AS (
  SELECT l.*, f_address, f_lga, label FROM loc1 l JOIN grant1 g USING (state, postcode, cpo_name, suburb)
  QUALIFY row_number() OVER (PARTITION BY state, postcode, cpo_name, suburb
      ORDER BY sqrt(pow(radians(latitude) - radians(f_lat), 2)
                  + pow(radians(longitude) - radians(f_lon), 2)) * 6371,
               evse_id, evse_port_id) <= 2),
matched AS (
  SELECT {PORT}, label FROM nearest
  WHERE len(list_intersect(string_split(lower(lga_name), ' '), string_split(lower(f_lga), ' '))) > 0
     OR len(list_intersect(string_split(lower(address), ' '), string_split(lower(f_address), ' '))) > 0),
loc AS (
  SELECT loc1.*, coalesce(label, 'not_funded') AS government_funded
  FROM loc1 LEFT JOIN matched USING ({PORT}))"""

HISTORY = f"""
ranked AS (
  SELECT log.*, lag(update_time) OVER (PARTITION BY {PORT} ORDER BY update_time) AS prev
  FROM log SEMI JOIN loc1 USING ({PORT})),
lower_bound AS (
  SELECT {PORT}, min(prev) AS since FROM ranked
  WHERE update_time > {LO} AND update_time < {HI} GROUP BY ALL),
hist AS (
  SELECT {PORT}, cpo_name, status, update_time FROM ranked JOIN lower_bound USING ({PORT})
  WHERE update_time BETWEEN since AND {HI}),
kept AS (
  SELECT * FROM hist h WHERE NOT EXISTS (
    SELECT 1 FROM win w WHERE w.cpo_name = h.cpo_name
      AND h.update_time > w.offline_timestamp AND h.update_time < w.online_timestamp)),
pw AS (
  SELECT DISTINCT {PORT}, cpo_name, offline_timestamp, online_timestamp
  FROM kept JOIN win USING (cpo_name)),
back AS (
  SELECT pw.evse_id, pw.evse_port_id, pw.cpo_name, k.status, pw.online_timestamp AS update_time
  FROM pw ASOF LEFT JOIN kept k ON pw.evse_id = k.evse_id AND pw.evse_port_id = k.evse_port_id
       AND pw.online_timestamp >= k.update_time),
gone AS (SELECT {PORT}, cpo_name, 'Missing' AS status, offline_timestamp AS update_time FROM pw)"""

TIMELINE = f"""
moments AS (
  SELECT *, 0 AS kind FROM kept UNION ALL SELECT *, 1 FROM back UNION ALL SELECT *, 2 FROM gone),
bounded AS (
  SELECT *, min(update_time) OVER (PARTITION BY {PORT}) AS first_time
  FROM moments WHERE status IS NOT NULL),
cut AS (
  SELECT *, first_time > {LO} AS is_new,
         CASE WHEN first_time <= {LO} AND update_time = first_time THEN {LO}
              ELSE date_trunc('minute', update_time) END AS t0
  FROM bounded),
tl AS (
  SELECT {PORT}, cpo_name, status, is_new, t0,
         coalesce(lead(t0) OVER (PARTITION BY {PORT} ORDER BY t0), {HI}) AS t1
  FROM (SELECT * FROM cut WHERE t0 < {HI}
        QUALIFY row_number() OVER (PARTITION BY {PORT}, t0 ORDER BY update_time DESC, kind DESC) = 1))"""

DENSE = f"""
piece AS (
  SELECT {PORT}, status, b,
         epoch(least(t1, b + INTERVAL 30 MINUTE)) - epoch(greatest(t0, b)) AS seconds
  FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL 30 MINUTE, t0),
                 t1 - INTERVAL 1 SECOND, INTERVAL 30 MINUTE)) AS b FROM tl)),
dur AS (
  SELECT {PORT}, b AS update_time, status, CAST(sum(seconds) AS BIGINT) AS status_duration
  FROM piece GROUP BY ALL),
mins AS (SELECT {PORT}, min(update_time) AS first_bucket FROM dur GROUP BY ALL),
dense0 AS (
  SELECT m.*, t.update_time, s.status,
         CASE WHEN s.status = 'Missing' AND t.update_time < first_bucket THEN 1800
              ELSE coalesce(status_duration, 0) END AS d
  FROM mins m CROSS JOIN (SELECT DISTINCT update_time FROM dur) t
  CROSS JOIN (SELECT status FROM dur UNION SELECT 'Unknown') s
  LEFT JOIN dur USING ({PORT}, update_time, status)),
dense1 AS (
  SELECT * REPLACE (
    CASE WHEN status = 'Missing' AND update_time = first_bucket AND update_time > {LO}
         THEN d + 1800 - coalesce(sum(CASE WHEN status <> 'Missing' THEN d END)
              OVER (PARTITION BY {PORT}, update_time), 0)
         ELSE d END AS d)
  FROM dense0),
dense2 AS (
  SELECT {PORT}, update_time, status, CAST(
    CASE WHEN status = 'Unknown'
         THEN d + 1800 - sum(CASE WHEN status <> 'Unknown' THEN d END)
              OVER (PARTITION BY {PORT}, update_time)
         ELSE d END AS BIGINT) AS status_duration
  FROM dense1),
dense AS (
  SELECT * FROM dense2
  UNION ALL SELECT DISTINCT {PORT}, update_time, 'Total', 1800::BIGINT FROM dense2)"""


def _sums(value: str, variable: str, names: list[str], absent: str = "NULL") -> str:
    return ",\n         ".join(
        f"CAST(coalesce(sum({value}) FILTER ({variable} = '{n}'), {absent}) AS BIGINT) AS \"{n}\""
        for n in names
    )


WIDE = [*STATUSES, "Total"]
def fact_of(wide: list[str]) -> str:
    return f"""
fact AS (
  SELECT {PORT}, update_time AS interval, cpo_name, address, suburb, postcode, lga_name, state,
         latitude, longitude, power, government_funded, w.* EXCLUDE ({PORT}, update_time)
  FROM (SELECT {PORT}, update_time, {_sums('status_duration', 'status', wide, absent='0')}
        FROM dense GROUP BY ALL) w
  JOIN loc USING ({PORT}))"""


FACT = fact_of(WIDE)

LOADED = f"""
local_fact AS (
  SELECT * REPLACE (
    CASE state WHEN 'NSW' THEN (interval AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Sydney'
               WHEN 'ACT' THEN (interval AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Sydney'
               WHEN 'VIC' THEN (interval AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Melbourne'
               WHEN 'QLD' THEN (interval AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Brisbane'
               ELSE interval END AS interval)
  FROM fact),
ranged AS (SELECT * FROM local_fact WHERE interval BETWEEN {FROM} AND {TO}),
shared AS (
  SELECT lga_name FROM ranged WHERE government_funded = 'not_funded'
  GROUP BY lga_name HAVING count(DISTINCT cpo_name) > 1),
loaded AS (
  SELECT * FROM ranged
  WHERE lga_name IN (SELECT lga_name FROM shared) OR government_funded <> 'not_funded')"""

EVSE_KEYS = (
    "cpo_name, address, suburb, postcode, lga_name, latitude, longitude, power, "
    "government_funded, evse_id, interval"
)
_wide_sums = ", ".join(f'CAST(sum("{n}") AS BIGINT) AS "{n}"' for n in WIDE)
EVSE = f"""
evse AS (
  SELECT {EVSE_KEYS}, {_wide_sums}, count(DISTINCT evse_port_id) AS evse_port_count
  FROM loaded GROUP BY {EVSE_KEYS})"""

SITE_KEYS = "cpo_name, address, suburb, postcode, lga_name, state, government_funded"
SITES = f"""
sites AS (
  SELECT {SITE_KEYS}, interval, {_wide_sums},
         count(DISTINCT (evse_id, evse_port_id)) AS evse_port_site_count
  FROM fact GROUP BY {SITE_KEYS}, interval)"""

TO_HISTORY = [TABLES, HISTORY]
TO_TIMELINE = [TABLES, HISTORY, TIMELINE]
TO_DENSE = [*TO_TIMELINE, DENSE]
TO_FACT = [*TO_DENSE, FUNDED, FACT]
TO_LOADED = [*TO_FACT, LOADED]
TO_EVSE = [*TO_LOADED, EVSE]
TO_SITES = [*TO_FACT, SITES]


def text(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip() if parts else select.strip()


# --- pieces used by several queries ----------------------------------------
UNAVAILABLE = '"Unavailable" + "Out of order"'
METRIC_SQL = {
    "Utilisation": '"Charging" + "Finishing" + "Reserved"',
    "Uptime": '"Available" + "Charging" + "Finishing" + "Reserved"',
    "Unavailability": UNAVAILABLE + ' + "Inoperative" + "Blocked"',
}
REPORT_SQL = {**METRIC_SQL, "Unavailability": UNAVAILABLE}


def _rates(scale: str, naming, digits: int | None = 6, metrics: dict[str, str] = METRIC_SQL) -> str:
    """Rates of the summed columns, each null over 0."""
    out = []
    for name in [*METRICS, *STATUSES]:
        top = metrics.get(name, f'"{name}"')
        below = '"Total" - "Missing" - "Unknown"' if name in METRICS else '"Total"'
        value = f"(({top}) * {scale}::DOUBLE) / nullif({below}, 0)"
        if digits is not None:
            value = f"round({value}, {digits})"
        out.append(f'{value} AS "{naming(name)}"')
    return ",\n  ".join(out)


_BINS = {
    "30min": ("time_bucket(INTERVAL 30 MINUTE, interval)", "INTERVAL 30 MINUTE", "b"),
    "60min": ("date_trunc('hour', interval)", "INTERVAL 1 HOUR", "b"),
    "1440min": ("date_trunc('day', interval)", "INTERVAL 1 DAY", "b"),
    "10080min": (
        "first_day + to_days(CAST(7 * (date_diff('day', first_day, date_trunc('day', interval)) // 7) AS INTEGER))",
        "INTERVAL 7 DAY",
        "b",
    ),
    "ME": ("date_trunc('month', interval)", "INTERVAL 1 MONTH", "last_day(b)"),
    "Q": ("date_trunc('quarter', interval)", "INTERVAL 3 MONTH", "last_day(b + INTERVAL 2 MONTH)"),
    "Y": ("date_trunc('year', interval)", "INTERVAL 1 YEAR", "last_day(b + INTERVAL 11 MONTH)"),
}


def _rolled(keys: list[str], interval: str, source: str = "evse", name: str = "rolled", digits: int | None = 6) -> str:
    """CTEs of a calendar roll-up with an explicit list of bins per series."""
    bin_sql, step, label = _BINS[interval]
    k = "".join(f"{c}, " for c in keys)
    series = f"{k}evse_port_count"
    sums = ", ".join(f'CAST(sum("{n}") AS BIGINT) AS "{n}"' for n in WIDE)
    zeros = ", ".join(f'coalesce("{n}", 0) AS "{n}"' for n in WIDE)
    return f"""
agg_{name} AS (
  SELECT {k}interval, {sums}, CAST(sum(evse_port_count) AS BIGINT) AS evse_port_count
  FROM {source} GROUP BY {k}interval),
day_{name} AS (
  SELECT *, min(date_trunc('day', interval)) OVER (PARTITION BY {series}) AS first_day FROM agg_{name}),
bin_{name} AS (SELECT {series}, CAST({bin_sql} AS TIMESTAMP) AS b, {sums} FROM day_{name} GROUP BY {series}, b),
all_{name} AS (
  SELECT {series}, unnest(generate_series(min(b), max(b), {step})) AS b
  FROM bin_{name} GROUP BY {series}),
full_{name} AS (
  SELECT {series}, b, {zeros} FROM all_{name} LEFT JOIN bin_{name} USING ({series}, b)),
{name} AS (
  SELECT {series}, CAST({label} AS TIMESTAMP) AS interval,
  {_rates('100', lambda n: n, digits)}
  FROM full_{name})"""


def _prop(name: str) -> str:
    return "out_of_order_prop" if name == "Out of order" else f"{name}_prop"


def _snapshot(groups: list[str], source: str = "sites", name: str = "snap", digits: int | None = None) -> str:
    g = ", ".join(groups)
    others = [c for c in groups if c != "cpo_name"]
    o = ", ".join(others)
    sums = ", ".join(f'CAST(sum("{n}") AS BIGINT) AS "{n}"' for n in [*WIDE, "evse_port_site_count"])
    group_o = f"GROUP BY {o}" if others else ""
    latest = f"interval = (SELECT max(interval) FROM {source})"
    value = "CAST(sum(evse_port_site_count) AS BIGINT) AS value"
    select_o = f"{o}, " if others else ""
    using = ", ".join([*others, "cpo_name"])
    return f"""
sum_{name} AS (
  SELECT {select_o}cpo_name, {sums} FROM {source} GROUP BY {g}
  UNION ALL
  SELECT {select_o}'Overall', {sums} FROM {source} {group_o}),
cnt_{name} AS (
  SELECT {select_o}cpo_name, {value} FROM {source} WHERE {latest} GROUP BY {g}
  UNION ALL
  SELECT {select_o}'Overall', {value} FROM {source} WHERE {latest} {group_o}),
{name} AS (
  SELECT {g}, evse_port_site_count,
  {_rates('1', _prop, digits, REPORT_SQL)}, value
  FROM sum_{name} JOIN cnt_{name} USING ({using}) WHERE value IS NOT NULL)"""


AREA_SNAP = [*TO_SITES, _snapshot(["lga_name", "cpo_name"])]
CPO_SNAP = [*TO_SITES, _snapshot(["cpo_name"])]
ALL_PROPS = [_prop(n) for n in [*METRICS, *STATUSES]]
ROUNDED_PROPS = ", ".join(f'round("{p}", 6) AS "{p}"' for p in ALL_PROPS)

LABELLED = [
    "Utilisation",
    "Uptime",
    "Unavailability",
    "Charging",
    "Finishing",
    "Reserved",
    "Available",
    "Unavailable",
    "Out of order",
    "Unknown",
    "Missing",
]

ORACLE: dict[str, str] = {}

ORACLE["location_dim"] = text(
    [TABLES],
    f"""SELECT {PORT}, cpo_name, address, suburb, postcode, lga_name, state,
    round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(power, 6) AS power
    FROM loc1""",
)
ORACLE["status_history_window"] = text(TO_HISTORY, "SELECT * FROM hist")
ORACLE["offline_windows"] = text([TABLES], "SELECT * FROM win")
ORACLE["outage_anti_join"] = text(
    [TABLES],
    """SELECT log.* FROM log WHERE NOT EXISTS (SELECT 1 FROM win WHERE win.cpo_name = log.cpo_name
    AND update_time > offline_timestamp AND update_time < online_timestamp)""",
)
ORACLE["outage_synthetic_events"] = text(
    TO_HISTORY, "SELECT * FROM kept UNION ALL SELECT * FROM back UNION ALL SELECT * FROM gone"
)
ORACLE["period_amended_events"] = text(
    TO_TIMELINE,
    f"""SELECT {PORT}, cpo_name, status, t0 AS update_time, CAST(is_new AS INTEGER) AS new_evse FROM tl
    UNION ALL
    SELECT {PORT}, cpo_name, status, {HI}, CAST(is_new AS INTEGER) FROM tl WHERE t1 = {HI}""",
)
ORACLE["period_amended_events_all"] = text(
    [
        *TO_HISTORY,
        f"""
whole AS (
  SELECT *, min(update_time) OVER (PARTITION BY {PORT}) AS first_time,
         max(update_time) OVER (PARTITION BY {PORT}) AS last_time
  FROM (SELECT * FROM kept UNION ALL SELECT * FROM back UNION ALL SELECT * FROM gone)
  WHERE status IS NOT NULL)""",
    ],
    f"""SELECT {PORT}, cpo_name, status, CAST(first_time > {LO} AS INTEGER) AS new_evse,
    date_trunc('minute', CASE WHEN first_time <= {LO} AND update_time = first_time THEN {LO}
                         ELSE update_time END) AS update_time FROM whole
    UNION ALL
    SELECT {PORT}, cpo_name, status, CAST(first_time > {LO} AS INTEGER), {HI} FROM whole
    WHERE update_time = last_time""",
)
ORACLE["status_durations"] = text(
    [
        *TO_TIMELINE,
        f"""
span AS (SELECT {PORT}, min(t0) AS a FROM tl GROUP BY ALL),
grid AS (
  SELECT {PORT}, unnest(generate_series(a, {HI} - INTERVAL 30 SECOND, INTERVAL 30 SECOND)) AS g
  FROM span),
filled AS (
  SELECT {PORT}, g, last_value(status IGNORE NULLS) OVER (PARTITION BY {PORT} ORDER BY g) AS status
  FROM grid LEFT JOIN (SELECT {PORT}, t0 AS g, status FROM tl) USING ({PORT}, g))""",
    ],
    f"""SELECT {PORT}, time_bucket(INTERVAL 30 MINUTE, g) AS update_time, status,
    CAST(count(*) * 30 AS BIGINT) AS status_duration FROM filled GROUP BY ALL""",
)
ORACLE["status_durations_dense_daily"] = text(
    TO_DENSE,
    f"""SELECT {PORT}, date_trunc('day', update_time)::TIMESTAMP AS day, status,
    CAST(sum(status_duration) AS BIGINT) AS status_duration, count(DISTINCT update_time) AS buckets
    FROM dense GROUP BY ALL""",
)
ORACLE["residual_unknown_total"] = text(
    [
        *TO_TIMELINE,
        DENSE.split("mins AS")[0].rstrip().rstrip(","),
        f"""
complete AS (
  SELECT {PORT}, update_time, status, sum(d) AS d FROM (
    SELECT {PORT}, update_time, status, status_duration AS d FROM dur
    UNION ALL SELECT DISTINCT {PORT}, update_time, 'Unknown', 0 FROM dur
    UNION ALL SELECT DISTINCT {PORT}, update_time, 'Total', 1800 FROM dur)
  GROUP BY ALL),
done AS (
  SELECT {PORT}, status, CASE WHEN status = 'Unknown' THEN d + 1800 - sum(
      CASE WHEN status NOT IN ('Unknown', 'Total') THEN d END) OVER (PARTITION BY {PORT}, update_time)
    ELSE d END AS d FROM complete)""",
    ],
    f"SELECT {PORT}, status, CAST(sum(d) AS BIGINT) AS seconds FROM done GROUP BY ALL",
)
ORACLE["operator_status_hours"] = text(
    TO_FACT,
    "SELECT cpo_name, status, seconds, round(seconds / 3600.0::DOUBLE, 6) AS hours FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT cpo_name, '{n}' AS status, CAST(sum(\"{n}\") AS BIGINT) AS seconds FROM fact GROUP BY cpo_name"
        for n in WIDE
    )
    + ")",
)
ORACLE["cpo_cleaning"] = text(
    [TABLES],
    """SELECT CASE WHEN cpo_name IN ('BUILDING', 'HOUSEHOLD') THEN evse_id
      ELSE evse_id || ' - ' || suburb END AS evse_id, evse_port_id, cpo_name,
      CASE WHEN user_id % 4 <> 0 THEN CAST(postcode AS VARCHAR) END AS postcode
    FROM loc0 WHERE user_id % 10 <> 0 AND (cpo_name <> 'MACHINERY' OR user_id % 4 <> 0)""",
)
ORACLE["funded_site_match"] = text(
    [TABLES, FUNDED],
    f"SELECT {PORT}, cpo_name, state, postcode, suburb, government_funded FROM loc",
)
GEO = f"""
geo AS (
  SELECT DISTINCT latitude, longitude,
    CASE WHEN n % 7 = 6 THEN NULL WHEN n % 4 <> 0 THEN 'Area ' || lga_name
         WHEN n % 3 = 0 THEN 'Unincorporated ACT' END AS geo_lga,
    CASE WHEN n % 7 = 6 THEN NULL ELSE coalesce(state, 'OT') END AS geo_state,
    CASE WHEN n % 7 = 6 THEN NULL ELSE 'Geo ' || address END AS geo_address
  FROM (SELECT *, user_id // 3 AS n FROM loc0))"""
ORACLE["geocode_parts"] = text(
    [TABLES, GEO],
    "SELECT round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, geo_lga, geo_state, geo_address FROM geo",
)
ORACLE["fill_missing_location"] = text(
    [TABLES, GEO],
    f"""SELECT {PORT},
    CASE WHEN user_id % 5 <> 0 THEN lga_name
         WHEN geo_lga = 'Unincorporated ACT' OR geo_lga = 'Area LGA 3' THEN NULL
         ELSE replace(geo_lga, 'Area ', '') || ' canonical' END AS lga_name,
    CASE WHEN user_id % 7 <> 0 THEN address ELSE geo_address END AS address,
    geo_state AS state
    FROM loc0 LEFT JOIN geo USING (latitude, longitude)""",
)
GAPS = TABLES.replace(
    "evse_port_id, cpo_name, address,\n         suburb, postcode, lga_name, ",
    "evse_port_id, cpo_name,\n         CASE WHEN user_id % 7 <> 0 THEN address END AS address, suburb,"
    " postcode,\n         CASE WHEN user_id % 5 <> 0 THEN lga_name END AS lga_name, ",
    1,
)
assert GAPS != TABLES
FILLED = f"""
loc_full AS (
  SELECT 'E' || (user_id // 3) AS evse_id, 'P' || user_id AS evse_port_id, user_id, address,
         lga_name, {STATE} AS state,
         latitude + ((user_id // 3) % 2)::DOUBLE * 0.0005::DOUBLE AS latitude, longitude
  FROM (SELECT DISTINCT user_id FROM events) JOIN site ON site = user_id // 6),
{GEO.strip().replace("FROM loc0", "FROM loc_full")},
filled AS (
  SELECT loc.* EXCLUDE (lga_name, address, state), geo_state AS state,
    coalesce(lga_name, CASE WHEN geo_lga <> 'Unincorporated ACT' AND geo_lga <> 'Area LGA 3'
             THEN replace(geo_lga, 'Area ', '') || ' canonical' END) AS lga_name,
    coalesce(address, geo_address) AS address
  FROM loc LEFT JOIN geo USING (latitude, longitude))"""
ORACLE["fact_with_filled_areas"] = text(
    [GAPS, HISTORY, TIMELINE, DENSE, FUNDED, FILLED, FACT.replace("JOIN loc USING", "JOIN filled USING")],
    f"""SELECT state, lga_name, address, government_funded, count(*) AS n, {_wide_sums}
    FROM fact GROUP BY ALL""",
)
ORACLE["local_time_rollup"] = text(
    TO_LOADED,
    """SELECT state, date_trunc('day', interval)::TIMESTAMP AS local_day, count(*) AS buckets,
    CAST(sum("Charging") AS BIGINT) AS charging, CAST(sum("Available") AS BIGINT) AS available
    FROM ranged GROUP BY ALL""",
)
ORACLE["funding_area_filter"] = text(
    TO_EVSE,
    """SELECT lga_name, cpo_name, government_funded, CAST(postcode AS VARCHAR) AS postcode,
    coalesce(suburb_name, 'Unknown Suburb') AS suburb_name, intervals, charging
    FROM (SELECT lga_name, cpo_name, government_funded, postcode, count(*) AS intervals,
                 CAST(sum("Charging") AS BIGINT) AS charging
          FROM evse WHERE lga_name IN ('LGA 0', 'LGA 1', 'LGA 2', 'LGA 3', 'LGA 4')
            AND cpo_name IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
            AND government_funded = 'not_funded'
          GROUP BY ALL)
    LEFT JOIN (SELECT postcode, max(suburb) AS suburb_name FROM loc1 GROUP BY postcode) USING (postcode)""",
)
ORACLE["data_span"] = text(
    [],
    """SELECT CAST(date_diff('month', min(ts), max(ts)) AS BIGINT) AS months,
    date_diff('month', min(ts), max(ts)) >= 3 AS long_bins FROM events""",
)
ORACLE["privacy_area_filter"] = text(
    TO_LOADED,
    """SELECT lga_name, cpo_name, government_funded, count(*) AS rows_kept,
    CAST(sum("Charging") AS BIGINT) AS charging FROM loaded GROUP BY ALL""",
)
PUBLIC = """
open_areas AS (
  SELECT lga_name FROM fact WHERE government_funded = 'not_funded'
  GROUP BY lga_name HAVING count(DISTINCT cpo_name) > 1),
reported AS (
  SELECT DISTINCT lga_name FROM fact
  WHERE lga_name IN (SELECT lga_name FROM open_areas) OR government_funded <> 'not_funded'),
secret AS (SELECT lga_name FROM fact EXCEPT SELECT lga_name FROM reported)"""
ORACLE["coverage_stats"] = text(
    [*TO_FACT, PUBLIC],
    """SELECT r AS reporting_areas, h AS hidden_areas, round(r::DOUBLE / nullif(h, 0), 6) AS reporting_ratio,
    round(a::DOUBLE / p, 6) AS coverage_ratio
    FROM (SELECT (SELECT count(*) FROM reported) AS r, (SELECT count(*) FROM secret) AS h,
                 (SELECT count(DISTINCT lga_name) FROM fact) AS a,
                 (SELECT count(DISTINCT lga_name) FROM site) AS p)""",
)
ORACLE["hidden_areas"] = text([*TO_FACT, PUBLIC], "SELECT lga_name FROM secret")
_long_evse = "\nUNION ALL\n".join(
    f"SELECT {EVSE_KEYS}, '{n}' AS variable, \"{n}\" AS value FROM evse"
    for n in [*WIDE, "evse_port_count"]
)
ORACLE["evse_level"] = text(
    TO_EVSE,
    f"""SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude)
    FROM ({_long_evse})""",
)
ORACLE["metric_pivot"] = text(
    [
        *TO_DENSE,
        f"wide AS (SELECT {PORT}, {_sums('status_duration', 'status', WIDE)} FROM dense GROUP BY ALL)",
    ],
    f"SELECT {PORT}, "
    + ", ".join(f'{METRIC_SQL[m]} AS "{m}_seconds"' for m in METRICS)
    + f", {_rates('1', lambda n: n + '_share')} FROM wide",
)
for _name, _interval in {
    "half_hour": "30min",
    "hour": "60min",
    "day": "1440min",
    "week": "10080min",
    "month": "ME",
    "quarter": "Q",
    "year": "Y",
}.items():
    ORACLE[f"resample_{_name}"] = text(
        [*TO_EVSE, _rolled(["cpo_name"], _interval)], "SELECT * FROM rolled"
    )
ORACLE["rollup_all_operators"] = text(
    [*TO_EVSE, _rolled([], "1440min")], "SELECT *, 'All CPOs' AS cpo_name FROM rolled"
)
ORACLE["rollup_by_cpo"] = text(
    [
        *TO_EVSE,
        "evse_funded AS (SELECT * FROM evse WHERE government_funded <> 'not_funded')",
        _rolled(["cpo_name"], "1440min", "evse_funded"),
    ],
    "SELECT * FROM rolled",
)
ORACLE["rollup_of_areas"] = text(
    [
        *TO_EVSE,
        """
chosen AS (
  SELECT * FROM evse WHERE lga_name IN ('LGA 0', 'LGA 1', 'LGA 2', 'LGA 3', 'LGA 4')
    AND cpo_name IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
    AND government_funded = 'not_funded')""",
        _rolled([], "10080min", "chosen"),
    ],
    "SELECT * FROM rolled",
)
SITE_ROLLUP = ["cpo_name", "address", "suburb", "postcode", "latitude", "longitude"]
ORACLE["rollup_by_site"] = text(
    [*TO_EVSE, _rolled(SITE_ROLLUP, "1440min")],
    "SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude) FROM rolled",
)
ORACLE["rollup_by_postcode"] = text(
    [*TO_EVSE, _rolled(["postcode"], "10080min")],
    """SELECT rolled.* REPLACE (CAST(rolled.postcode AS VARCHAR) AS postcode), zone
    FROM rolled JOIN (SELECT postcode, 'Zone ' || max(suburb) AS zone FROM site
                      WHERE postcode % 3 <> 0 GROUP BY postcode) z USING (postcode)""",
)


def _labels() -> str:
    parts = []
    for v in LABELLED:
        se = f'stddev_samp("{v}") / sqrt(count(*))'
        parts.append(f'round(avg("{v}"), 6) AS "{v}"')
        parts.append(
            f"coalesce(CAST(round_even(avg(\"{v}\"), 2) AS VARCHAR), 'nan') || ' ± ' || "
            f"coalesce(CAST(round_even({se}, 2) AS VARCHAR), 'nan') AS \"{v}_label\""
        )
    return ",\n".join(parts)


_complete = " AND ".join(f'"{n}" IS NOT NULL' for n in [*METRICS, *STATUSES])
ORACLE["mean_se_labels"] = text(
    [*TO_EVSE, _rolled(["postcode"], "1440min", digits=None)],
    f"SELECT postcode, evse_port_count, {_labels()} FROM rolled WHERE {_complete} GROUP BY postcode, evse_port_count",
)
ORACLE["interval_snapshot"] = text(
    [*TO_EVSE, _rolled(SITE_ROLLUP, "1440min", digits=None)],
    f"""SELECT {', '.join(c for c in SITE_ROLLUP if c not in ('latitude', 'longitude'))},
    round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, evse_port_count, interval,
    {', '.join(f'round_even("{n}", 2) AS "{n}"' if n in LABELLED else f'round("{n}", 6) AS "{n}"' for n in [*METRICS, *STATUSES])}
    FROM rolled WHERE interval = TIMESTAMP '2024-01-15'""",
)
_POSITION = {
    "30min": "hour(interval)",
    "60min": "hour(interval) + 1",
    "1440min": "isodow(interval)",
    "10080min": "(day(interval) - 1) // 7 + 1",
    "ME": "month(interval)",
    "Q": "quarter(interval)",
    "Y": "year(interval)",
}
ORACLE["period_profile"] = text(
    [*TO_EVSE, _rolled(["cpo_name"], "1440min", digits=None)],
    "\nUNION ALL\n".join(
        f"""SELECT cpo_name, CAST({sql} AS INTEGER) AS period_number,
    round_even(avg("Utilisation"), 2) AS mean_status,
    round(stddev_samp("Utilisation"), 6) AS std_status, count("Utilisation") AS count_status,
    round_even(stddev_samp("Utilisation") / sqrt(count("Utilisation")), 2) AS std_err, '{kind}' AS kind
    FROM rolled WHERE {_complete} GROUP BY ALL"""
        for kind, sql in _POSITION.items()
    ),
)


def _cpo_statistics(interval: str) -> str:
    return text(
        [
            *TO_EVSE,
            _rolled(["cpo_name"], interval, digits=None),
            """
gaps AS (
  SELECT *, epoch(interval - lag(interval) OVER w) / 60 AS back_gap,
         epoch(lead(interval) OVER w - interval) / 60 AS next_gap
  FROM rolled WINDOW w AS (PARTITION BY cpo_name ORDER BY evse_port_count, interval))""",
        ],
        """SELECT cpo_name, round(avg("Uptime"), 6) AS average_uptime, round(min("Uptime"), 6) AS minimum_uptime,
    round(avg("Utilisation"), 6) AS average_utilisation, round(max("Utilisation"), 6) AS max_utilisation,
    round(max("Unavailability"), 6) AS maximum_unavailability,
    round(avg("Unavailability"), 6) AS average_unavailability,
    max(evse_port_count) AS charge_station_count, 24::BIGINT AS period_duration,
    CASE WHEN count(*) = 1 THEN (day(last_day(max(interval))) * 1440)::DOUBLE
         ELSE epoch(max(interval) - min(interval)) / 60 END AS total_observed_time,
    round(CASE WHEN count(*) = 1 THEN max("Missing")
         ELSE sum("Missing" / 100 * coalesce(back_gap, next_gap))
              / nullif(epoch(max(interval) - min(interval)) / 60, 0) * 100 END, 6) AS missing_duration
    FROM gaps GROUP BY cpo_name""",
    )


ORACLE["cpo_statistics"] = _cpo_statistics("1440min")
ORACLE["cpo_statistics_single_month"] = _cpo_statistics("ME")

SESSION_KEYS = "cpo_name, location, evse_id, evse_port_id"
SESSIONS = f"""
charging AS (
  SELECT cpo_name, address || ', ' || suburb || ', ' || postcode AS location, {PORT}, power,
         government_funded, interval, "Charging" AS value
  FROM loaded WHERE government_funded <> 'not_funded' AND "Charging" > 0),
numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY {SESSION_KEYS} ORDER BY interval) AS session
  FROM (SELECT *, CASE WHEN interval - lag(interval) OVER (PARTITION BY {SESSION_KEYS} ORDER BY interval)
                            > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM charging)),
sess AS (
  SELECT {SESSION_KEYS}, CAST(session AS BIGINT) AS session, power, government_funded,
         min(interval) AS session_start_interval, CAST(sum(value) AS BIGINT) AS charge_duration
  FROM numbered GROUP BY ALL)"""
ORACLE["charging_sessions"] = text([*TO_LOADED, SESSIONS], "SELECT * FROM sess")
ORACLE["session_csv_roundtrip"] = ORACLE["charging_sessions"]
ORACLE["session_preview"] = text(
    [*TO_LOADED, SESSIONS],
    f"SELECT * FROM sess ORDER BY {SESSION_KEYS}, session_start_interval LIMIT 3",
)
ORACLE["session_labels"] = text(
    [
        *TO_LOADED,
        SESSIONS,
        """
lab AS (
  SELECT *,
    dense_rank() OVER (PARTITION BY cpo_name ORDER BY location) AS ln,
    dense_rank() OVER (PARTITION BY cpo_name, location ORDER BY evse_id) AS sn,
    dense_rank() OVER (PARTITION BY cpo_name, location, evse_id ORDER BY evse_port_id) AS pn
  FROM sess)""",
    ],
    """SELECT strftime(session_start_interval, '%H:%M:%S') AS start_interval,
    strftime(session_start_interval, '%Y-%m-%d') AS date,
    CASE cpo_name WHEN 'BUILDING' THEN 'CPO 1' WHEN 'AUTOMOBILE' THEN 'CPO 2' ELSE cpo_name END AS cpo_name,
    CASE WHEN cpo_name IN ('BUILDING', 'AUTOMOBILE') THEN 'Location ' || ln ELSE location END AS location,
    CASE WHEN cpo_name <> 'FURNITURE' THEN 'station ' || sn END AS charge_station,
    CASE WHEN cpo_name <> 'FURNITURE' THEN 'Port ' || pn END AS connector,
    government_funded, round_even(power * (charge_duration / 3600.0::DOUBLE), 0) AS max_usage_kwh,
    round_even(charge_duration / 60.0::DOUBLE, 1) AS charge_duration_min
    FROM lab""",
)

ORACLE["sessions_two_periods"] = ORACLE["charging_sessions"]
_BEFORE = "interval < TIMESTAMP '2024-01-12 09:30:00' AND power IS NOT NULL"
ORACLE["session_labels_two_loads"] = ORACLE["session_labels"].replace(
    """
lab AS (
  SELECT *,
    dense_rank() OVER (PARTITION BY cpo_name ORDER BY location) AS ln,
    dense_rank() OVER (PARTITION BY cpo_name, location ORDER BY evse_id) AS sn,
    dense_rank() OVER (PARTITION BY cpo_name, location, evse_id ORDER BY evse_port_id) AS pn
  FROM sess)""",
    f"""
early AS (SELECT DISTINCT {SESSION_KEYS} FROM charging WHERE {_BEFORE}),
marked AS (
  SELECT sess.*,
    (cpo_name, location) NOT IN (SELECT (cpo_name, location) FROM early) AS new_l,
    (cpo_name, location, evse_id) NOT IN (SELECT (cpo_name, location, evse_id) FROM early) AS new_s,
    ({SESSION_KEYS}) NOT IN (SELECT ({SESSION_KEYS}) FROM early) AS new_p
  FROM sess),
lab AS (
  SELECT * EXCLUDE (new_l, new_s, new_p),
    dense_rank() OVER (PARTITION BY cpo_name ORDER BY new_l, location) AS ln,
    dense_rank() OVER (PARTITION BY cpo_name, location ORDER BY new_s, evse_id) AS sn,
    dense_rank() OVER (PARTITION BY cpo_name, location, evse_id ORDER BY new_p, evse_port_id) AS pn
  FROM marked)""",
)
ORACLE["report_cpo_snapshot"] = text(
    CPO_SNAP, f"SELECT cpo_name, evse_port_site_count, {ROUNDED_PROPS}, value FROM snap"
)
ORACLE["report_area_snapshot"] = text(
    AREA_SNAP, f"SELECT lga_name, cpo_name, evse_port_site_count, {ROUNDED_PROPS}, value FROM snap"
)


def _percent_rates() -> str:
    out = []
    for name in [*METRICS, *STATUSES]:
        top = REPORT_SQL.get(name, f'"{name}"')
        below = '"Total" - "Missing" - "Unknown"' if name in METRICS else '"Total"'
        out.append(
            f'round_even((({top})::DOUBLE / nullif({below}, 0)) * 100, 1) AS "{_prop(name)}"'
        )
    return ", ".join(out)


ORACLE["report_site"] = text(
    [
        *TO_SITES,
        f"""
per_site AS (
  SELECT {SITE_KEYS}, {_wide_sums}, CAST(sum(evse_port_site_count) AS BIGINT) AS n
  FROM sites GROUP BY {SITE_KEYS})""",
    ],
    f"""SELECT {SITE_KEYS}, {_percent_rates()},
    round(n::DOUBLE / (SELECT count(DISTINCT interval) FROM sites), 6) AS evse_port_site_count FROM per_site""",
)
FUNDED_SITES = "funded_sites AS (SELECT * FROM sites WHERE government_funded <> 'not_funded')"
ORACLE["funded_snapshot"] = text(
    [*TO_SITES, FUNDED_SITES, _snapshot(["cpo_name", "government_funded"], "funded_sites")],
    f"SELECT cpo_name, government_funded, evse_port_site_count, {ROUNDED_PROPS}, value FROM snap",
)
ORACLE["funded_area_tables"] = text(
    [
        *TO_SITES,
        FUNDED_SITES,
        _snapshot(["cpo_name", "lga_name", "government_funded"], "funded_sites"),
    ],
    """SELECT government_funded, lga_name, cpo_name, round("Utilisation_prop", 6) AS "Utilisation_prop",
    round("Uptime_prop", 6) AS "Uptime_prop", value, round("Unavailability_prop", 6) AS "Unavailability_prop"
    FROM snap WHERE cpo_name <> 'Overall'""",
)


def _numbered(by: list[str], columns: list[str]) -> str:
    order = ", ".join(f'"{b}" DESC NULLS LAST' for b in by)
    cols = ", ".join(f'round("{c}", 6) AS "{c}"' if c.endswith("_prop") else c for c in columns)
    return text(
        [
            *TO_SITES,
            FUNDED_SITES,
            _snapshot(["cpo_name", "lga_name", "government_funded"], "funded_sites"),
        ],
        f"""SELECT row_number() OVER (ORDER BY {order}, lga_name, cpo_name, government_funded) AS rank,
    {cols} FROM snap WHERE cpo_name <> 'Overall'""",
    )


ORACLE["funded_uptime_ranked"] = _numbered(
    ["Uptime_prop", "Utilisation_prop"],
    ["government_funded", "lga_name", "cpo_name", "Utilisation_prop", "Uptime_prop", "value"],
)
ORACLE["funded_unavailability_ranked"] = _numbered(
    ["Unavailability_prop"],
    ["government_funded", "lga_name", "cpo_name", "Unavailability_prop", "value"],
)
_AREA_COMPANIONS = ", ".join(
    f'round("{c}", 6) AS "{c}"' for c in ["Utilisation_prop", "Uptime_prop", "Unavailability_prop"]
)
ORACLE["best_worst_area"] = text(
    AREA_SNAP,
    "\nUNION ALL\n".join(
        f"""(SELECT '{s}' AS share_name, '{which}' AS which, round({sql}, 6) AS share, lga_name, cpo_name,
    {_AREA_COMPANIONS}, value
    FROM snap WHERE cpo_name <> 'Overall' AND {sql} IS NOT NULL ORDER BY {sql} {order}, lga_name, cpo_name LIMIT 1)"""
        for s, sql in [
            ("Utilisation_prop", '"Utilisation_prop"'),
            ("Unavailability_prop", '"Unavailability_prop"'),
            ("size", "CAST(value AS DOUBLE)"),
        ]
        for which, order in (("max", "DESC"), ("min", "ASC"))
    ),
)


def _top(by: list[str], columns: list[str], n: int) -> str:
    order = ", ".join(f'"{b}" DESC NULLS LAST' for b in by)
    cols = ", ".join(f'round("{c}", 6) AS "{c}"' if c.endswith("_prop") else c for c in columns)
    return text(
        AREA_SNAP,
        f"""SELECT {cols} FROM (SELECT * FROM snap WHERE cpo_name <> 'Overall'
    ORDER BY {order}, lga_name, cpo_name LIMIT {n})""",
    )


ORACLE["top_areas_utilisation"] = _top(
    ["Utilisation_prop", "Uptime_prop"],
    ["lga_name", "cpo_name", "Utilisation_prop", "Uptime_prop", "value"],
    10,
)
ORACLE["top_areas_unavailability"] = _top(
    ["Unavailability_prop"], ["lga_name", "cpo_name", "Unavailability_prop", "value"], 10
)
ORACLE["top_areas_utilisation_breakdown"] = _top(
    ["Utilisation_prop"],
    ["lga_name", "cpo_name", "Charging_prop", "Finishing_prop", "Reserved_prop", "Available_prop"],
    10,
)
ORACLE["top_areas_unavailability_breakdown"] = _top(
    ["Unavailability_prop"],
    ["lga_name", "cpo_name", "Unavailable_prop", "out_of_order_prop", "Unknown_prop", "Missing_prop"],
    10,
)
ORACLE["top3_finishing"] = _top(
    ["Finishing_prop"], ["lga_name", "cpo_name", "value", "Finishing_prop"], 3
)
ORACLE["top3_charging"] = _top(
    ["Charging_prop"], ["lga_name", "cpo_name", "value", "Charging_prop"], 3
)
ORACLE["charging_summary"] = text(
    [
        *AREA_SNAP,
        """
best AS (SELECT * FROM snap WHERE cpo_name <> 'Overall'
         ORDER BY "Charging_prop" DESC NULLS LAST, lga_name, cpo_name LIMIT 3)""",
    ],
    """SELECT (SELECT cpo_name FROM best GROUP BY cpo_name ORDER BY count(*) DESC, cpo_name LIMIT 1) AS most_frequent_cpo,
    CAST(sum(value) AS BIGINT) AS ports_charging_most,
    round_even(min("Charging_prop") * 100, 1) AS lowest_percent,
    round_even(max("Charging_prop") * 100, 1) AS highest_percent,
    (SELECT CAST(coalesce(sum(value), 0) AS BIGINT) FROM snap
     WHERE cpo_name <> 'Overall' AND "Unavailable_prop" > 0.5) AS ports_mostly_unavailable
    FROM best""",
)
ORACLE["mostly_unavailable"] = text(
    AREA_SNAP,
    """SELECT lga_name, cpo_name, value, round("Unavailable_prop", 6) AS "Unavailable_prop"
    FROM snap WHERE cpo_name <> 'Overall' AND "Unavailable_prop" > 0.06""",
)
ORACLE["best_worst_cpo"] = text(
    CPO_SNAP,
    "\nUNION ALL\n".join(
        f"""(SELECT '{s}' AS share_name, '{which}' AS which, round("{s}", 6) AS share, cpo_name, value
    FROM snap ORDER BY "{s}" {order}, cpo_name LIMIT 1)"""
        for s in ["Utilisation_prop", "Unavailability_prop", "Charging_prop", "Available_prop"]
        for which, order in (("max", "DESC"), ("min", "ASC"))
    ),
)
ORACLE["composition_share"] = text(
    CPO_SNAP,
    """SELECT cpo_name,
    CASE greatest("Charging_prop", "Finishing_prop", "Reserved_prop")
      WHEN "Charging_prop" THEN 'Charging_prop' WHEN "Finishing_prop" THEN 'Finishing_prop'
      ELSE 'Reserved_prop' END AS largest_part,
    round_even(greatest("Charging_prop", "Finishing_prop", "Reserved_prop")
      / ("Charging_prop" + "Finishing_prop" + "Reserved_prop") * 100, 1) AS largest_percent
    FROM snap ORDER BY "Utilisation_prop" DESC, cpo_name LIMIT 1""",
)
ORACLE["available_ratio"] = text(
    CPO_SNAP,
    """SELECT round_even(max("Available_prop") / min("Available_prop"), 1) AS ratio,
    round_even(arg_min("Unavailable_prop", "Available_prop") * 100, 1) AS worst_unavailable_percent
    FROM snap""",
)
ORACLE["area_distribution"] = text(
    [
        *AREA_SNAP,
        """
shown AS (SELECT cpo_name, round_even("Utilisation_prop" * 100, 1) AS v FROM snap WHERE cpo_name <> 'Overall')""",
    ],
    """SELECT cpo_name, count(*) AS areas, count(*) >= 5 AS shown_as_box, min(v) AS lowest,
    round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
    round(quantile_cont(v, 0.75), 6) AS q3, max(v) AS highest FROM shown GROUP BY cpo_name""",
)
_SEGMENTS = {
    "Charging_prop": "Charging",
    "Finishing_prop": "Finishing",
    "Reserved_prop": "Reserved",
    "Available_prop": "Available",
    "Unavailable_prop": "Unavailable",
    "out_of_order_prop": "Out of Order",
    "Unknown_prop": "Unknown",
    "Missing_prop": "Missing",
}
ORACLE["rates_long"] = text(
    CPO_SNAP,
    "\nUNION ALL\n".join(
        f"SELECT cpo_name, '{n}' AS variable, round_even(\"{c}\" * 100, 1) AS value FROM snap"
        for c, n in _SEGMENTS.items()
    ),
)
ORACLE["month_calendar"] = text(
    [],
    """SELECT CAST(unnest(generate_series(make_date(min(year(o_orderdate))::INTEGER, 1, 1)::TIMESTAMP,
      make_date(max(year(o_orderdate))::INTEGER + 1, 1, 1)::TIMESTAMP, INTERVAL 1 MONTH)) AS TIMESTAMP) AS month_start
    FROM orders""",
)
ORACLE["clean_labels"] = text(
    [],
    """SELECT c_custkey, CASE WHEN c_custkey % 13 <> 0 THEN
      regexp_replace(c_name || ' / é-' || c_mktsegment, '[^a-zA-Z0-9_]', '', 'g') ELSE 'unknown' END AS label
    FROM customer""",
)
ORACLE["area_operator_list"] = text(
    [TABLES],
    """SELECT DISTINCT 'area' AS kind, lga_name AS name FROM loc1
    UNION SELECT DISTINCT 'operator', cpo_name FROM loc1""",
)
ORACLE["partitioned_roundtrip"] = text(
    TO_FACT,
    "\nUNION ALL\n".join(
        f"""SELECT state, CAST(year(interval) AS INTEGER) AS year, CAST(month(interval) AS INTEGER) AS month,
    '{n}' AS status, count(*) AS n, CAST(sum("{n}") AS BIGINT) AS seconds
    FROM fact WHERE state = 'VIC' GROUP BY ALL"""
        for n in WIDE
    ),
)


def _two_periods() -> str:
    """The fact of each period over the moved log, under the month it starts in."""
    moved = "FROM (SELECT * REPLACE (ts + INTERVAL 15 DAY AS ts) FROM events)"
    parts = []
    for month, lo, hi in (
        (1, "2024-01-16 13:00:00", "2024-01-31 13:00:00"),
        (2, "2024-01-31 13:00:00", "2024-02-12 13:00:00"),
    ):
        sums = ", ".join(f'CAST(sum("{n}") AS BIGINT) AS "{n}"' for n in WIDE)
        sql = text(
            TO_FACT,
            f"""SELECT state, 2024 AS year, {month} AS month, count(*) AS n, {sums}
            FROM fact GROUP BY state""",
        )
        sql = sql.replace("FROM events", moved)
        parts.append(sql.replace(LO, f"TIMESTAMP '{lo}'").replace(HI, f"TIMESTAMP '{hi}'"))
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


ORACLE["fact_two_periods"] = _two_periods()
MORE = [*STATUSES, "Servicing"]
_more_sums = ", ".join(f'CAST(sum("{n}") AS BIGINT) AS "{n}"' for n in [*MORE, "Total"])
_observable = 'nullif("Total" - "Missing" - "Unknown", 0)'
ORACLE["fact_of_feed"] = text(
    [
        *[
            part.replace("CASE WHEN event_type", "CASE WHEN event_type = 'error' AND value >= 200 THEN 'Servicing' WHEN event_type")
            for part in [*TO_DENSE, FUNDED]
        ],
        fact_of([*MORE, "Total"]),
        f"""
summed AS (SELECT state, cpo_name, count(*) AS n, {_more_sums} FROM fact GROUP BY state, cpo_name)""",
    ],
    "SELECT *, "
    + ", ".join(f'round(({sql})::DOUBLE / {_observable}, 6) AS "{m}_share"' for m, sql in METRIC_SQL.items())
    + " FROM summed",
)
ORACLE["status_history_two_months"] = text(
    [
        TABLES,
        f"""
moved AS (SELECT * REPLACE (update_time + INTERVAL 15 DAY AS update_time) FROM log),
periods AS (
  SELECT * FROM (VALUES ('2024-01-17', TIMESTAMP '2024-01-16 13:00:00', TIMESTAMP '2024-01-31 13:00:00'),
                        ('2024-02-01', TIMESTAMP '2024-01-31 13:00:00', TIMESTAMP '2024-02-12 13:00:00')) p(period, lo, hi)),
before AS (
  SELECT *, lag(update_time) OVER (PARTITION BY {PORT} ORDER BY update_time) AS prev FROM moved),
since AS (
  SELECT period, {PORT}, hi, min(prev) AS since
  FROM before JOIN periods ON update_time > lo AND update_time < hi GROUP BY ALL)""",
    ],
    f"""SELECT {PORT}, cpo_name, status, update_time, period FROM moved JOIN since USING ({PORT})
    WHERE update_time BETWEEN since AND hi""",
)


def _after_rerun() -> str:
    """The facts of two periods, the second without some ports, then the usual steps."""
    moved = "FROM (SELECT * REPLACE (ts + INTERVAL 15 DAY AS ts) FROM events)"
    parts = []
    fewer = "FROM (SELECT * FROM log WHERE CAST(substr(evse_port_id, 2) AS INTEGER) % 3 <> 0) AS log SEMI JOIN"
    for lo, hi, log in (
        ("2024-01-16 13:00:00", "2024-01-31 13:00:00", "FROM log SEMI JOIN"),
        ("2024-01-31 13:00:00", "2024-02-12 13:00:00", fewer),
    ):
        sql = text(TO_FACT, "SELECT * FROM fact").replace("FROM log SEMI JOIN", log)
        sql = sql.replace("FROM events", moved)
        parts.append(sql.replace(LO, f"TIMESTAMP '{lo}'").replace(HI, f"TIMESTAMP '{hi}'"))
    whole = "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)
    loaded = LOADED.replace(FROM, "TIMESTAMP '2024-01-17'").replace(TO, "TIMESTAMP '2024-02-12'")
    return text([f"fact AS ({whole})", loaded, EVSE, _rolled(["cpo_name"], "10080min")], "SELECT * FROM rolled")


ORACLE["rollup_after_rerun"] = _after_rerun()
_COUNTED = 'count(DISTINCT (evse_id, evse_port_id)) AS ports, count(DISTINCT cpo_name) AS operators'
ORACLE["distinct_counts"] = text(
    [*TO_FACT, LOADED.split("ranged AS")[0].rstrip().rstrip(",")],
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS choice, {area} AS lga_name, {_COUNTED} FROM local_fact "
        f"WHERE interval >= DATE '{first}' AND interval < DATE '{last}' + INTERVAL 1 DAY AND {where} {group}"
        for name, area, first, last, where, group in (
            ("all", "NULL", "2024-01-03", "2024-01-27", "true", ""),
            (
                "areas", "NULL", "2024-01-05", "2024-01-06",
                "government_funded = 'not_funded' AND lga_name IN ('LGA 0', 'LGA 1', 'LGA 2', 'LGA 3', 'LGA 4')", "",
            ),
            ("state", "NULL", "2024-01-10", "2024-01-10", "state = 'VIC'", ""),
            ("by area", "lga_name", "2024-01-20", "2024-01-27", "true", "GROUP BY lga_name"),
        )
    ),
)
ORACLE["dashboard_state"] = text(
    [
        *TO_FACT,
        LOADED.replace("FROM fact)", "FROM fact WHERE state = 'VIC')"),
    ],
    f"""SELECT state, cpo_name, lga_name, count(*) AS n, {_wide_sums}
    FROM loaded GROUP BY state, cpo_name, lga_name""",
)
ORACLE["boundary_read"] = text(
    [TABLES], "SELECT address AS area_name, postcode, true AS drawn FROM site"
)
ORACLE["ports_in_boundary"] = text(
    [
        TABLES,
        """
extent AS (
  SELECT lga_name AS area, min(longitude) AS w, max(longitude) AS e, min(latitude) AS s, max(latitude) AS n
  FROM site GROUP BY lga_name),
cut AS (
  SELECT *, w + (e - w) * 1.0::DOUBLE / 3.0::DOUBLE AS hw, w + (e - w) * 2.0::DOUBLE / 3.0::DOUBLE AS he,
         s + (n - s) * 1.0::DOUBLE / 3.0::DOUBLE AS hs, s + (n - s) * 2.0::DOUBLE / 3.0::DOUBLE AS hn
  FROM extent)""",
    ],
    """SELECT area, cpo_name, count(*) AS ports FROM loc1 JOIN cut
    ON latitude BETWEEN s AND n AND (
      longitude BETWEEN w AND e AND NOT (longitude > hw AND longitude < he AND latitude > hs AND latitude < hn)
      OR longitude BETWEEN e + 0.01::DOUBLE AND e + 0.25::DOUBLE)
    GROUP BY ALL""",
)
LATEST = f"""
latest AS (SELECT * FROM log
  QUALIFY row_number() OVER (PARTITION BY {PORT} ORDER BY update_time DESC) = 1)"""
ORACLE["live_latest_status"] = text([TABLES, LATEST], "SELECT * FROM latest")
ORACLE["live_availability"] = text(
    [TABLES, LATEST],
    f"""SELECT loc1.cpo_name, lga_name, count(*) AS ports,
    count(*) FILTER (status = 'Available') AS available_ports
    FROM latest JOIN loc1 USING ({PORT}) GROUP BY ALL""",
)
ORACLE["live_availability_outages"] = text(
    [
        TABLES,
        f"""
allwin AS (
  SELECT cpo_name, ts AS offline_timestamp,
         ts + to_minutes(CAST(60 + event_id % 400 AS INTEGER)) AS online_timestamp
  FROM events JOIN site ON site = user_id // 6 WHERE event_type = 'error' AND value >= 300),
held AS (
  SELECT * FROM log l WHERE NOT EXISTS (
    SELECT 1 FROM allwin w WHERE w.cpo_name = l.cpo_name
      AND l.update_time > w.offline_timestamp AND l.update_time < w.online_timestamp)),
heard AS (
  SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY {PORT} ORDER BY update_time DESC) = 1),
edges AS (
  SELECT cpo_name, offline_timestamp AS since, 2 AS kind FROM allwin
  UNION ALL SELECT cpo_name, online_timestamp, 1 FROM allwin),
moment AS (
  SELECT {PORT}, cpo_name, status, update_time AS since, 0 AS kind FROM heard
  UNION ALL
  SELECT {PORT}, cpo_name, CASE WHEN kind = 2 THEN 'Missing' ELSE status END, e.since, kind
  FROM heard JOIN edges e USING (cpo_name)
  WHERE e.since >= update_time AND e.since <= (SELECT max(update_time) FROM log)),
latest AS (
  SELECT * FROM moment QUALIFY row_number() OVER (PARTITION BY {PORT} ORDER BY since DESC, kind DESC) = 1),
gone AS (
  SELECT cpo_name, count(*) FILTER (status = 'Missing') AS missing_ports FROM latest GROUP BY cpo_name)""",
    ],
    f"""SELECT loc1.cpo_name, loc1.lga_name, count(*) AS ports,
    count(*) FILTER (status = 'Available') AS available_ports, any_value(missing_ports) AS missing_ports
    FROM latest JOIN loc1 USING ({PORT}) JOIN gone ON gone.cpo_name = loc1.cpo_name GROUP BY ALL""",
)
ORACLE["incremental_durations"] = text(
    [
        TABLES,
        f"""
span AS (
  SELECT date_trunc('day', min(update_time))::TIMESTAMP AS lo,
         date_trunc('day', max(update_time))::TIMESTAMP + INTERVAL 1 DAY AS hi FROM log),
allwin AS (
  SELECT cpo_name, ts AS offline_timestamp,
         ts + to_minutes(CAST(60 + event_id % 400 AS INTEGER)) AS online_timestamp
  FROM events JOIN site ON site = user_id // 6
  WHERE event_type = 'error' AND value >= 300
    AND ts > (SELECT lo FROM span) AND ts < (SELECT hi FROM span)),
held AS (
  SELECT * FROM log l WHERE NOT EXISTS (
    SELECT 1 FROM allwin w WHERE w.cpo_name = l.cpo_name
      AND l.update_time > w.offline_timestamp AND l.update_time < w.online_timestamp)),
edges AS (
  SELECT DISTINCT {PORT}, cpo_name, offline_timestamp, online_timestamp
  FROM held JOIN allwin USING (cpo_name)),
moment AS (
  SELECT {PORT}, status, update_time, 0 AS kind FROM held
  UNION ALL
  SELECT e.evse_id, e.evse_port_id, k.status, e.online_timestamp, 1
  FROM edges e ASOF LEFT JOIN held k ON e.evse_id = k.evse_id AND e.evse_port_id = k.evse_port_id
       AND e.online_timestamp >= k.update_time
  UNION ALL
  SELECT {PORT}, 'Missing', offline_timestamp, 2 FROM edges),
minutes AS (
  SELECT {PORT}, status, date_trunc('minute', update_time) AS t0 FROM moment
  WHERE status IS NOT NULL AND update_time < (SELECT hi FROM span)
  QUALIFY row_number() OVER (PARTITION BY {PORT}, date_trunc('minute', update_time)
                             ORDER BY update_time DESC, kind DESC) = 1),
stretch AS (
  SELECT *, coalesce(lead(t0) OVER (PARTITION BY {PORT} ORDER BY t0), (SELECT hi FROM span)) AS t1
  FROM minutes),
by_day AS (
  SELECT *, unnest(generate_series(date_trunc('day', t0)::TIMESTAMP, t1 - INTERVAL 1 SECOND, INTERVAL 1 DAY)) AS day
  FROM stretch)""",
    ],
    f"""SELECT {PORT}, day, status,
    CAST(sum(epoch(least(t1, day + INTERVAL 1 DAY)) - epoch(greatest(t0, day))) AS BIGINT) AS seconds
    FROM by_day GROUP BY ALL""",
)
