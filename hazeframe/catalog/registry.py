"""Query registry: name, Spark callable, and the SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Views for the oracle, in dependency order.
VIEWS = {
    "ev": """SELECT event_id AS ord, ts, user_id // 6 AS station, user_id % 6 AS sensor, event_type, value,
  CAST(props->>'$.k' AS INTEGER) AS k FROM events""",
    "air": """SELECT ord, ts, station,
  CASE WHEN ord % 11 = 0 THEN NULL WHEN ord % 13 = 0 THEN -value ELSE value END AS pm25,
  value * CAST(1.5 AS DOUBLE) AS pm10, CAST((ord * 37) % 2000 AS DOUBLE) / 10 AS no2,
  CAST((ord * 53) % 1800 AS DOUBLE) / 10 AS o3, CAST((ord * 71) % 6000 AS DOUBLE) / 10 AS so2,
  CAST(k AS DOUBLE) / 25 AS co, value * CAST(0.3 AS DOUBLE) AS nh3
  FROM ev WHERE event_type IN ('view', 'click', 'signup')""",
    "air_long": """SELECT ord, ts, station,
  CASE sensor WHEN 0 THEN 'pm25' WHEN 1 THEN 'pm10' WHEN 2 THEN 'no2' WHEN 3 THEN 'o3' WHEN 4 THEN 'so2' ELSE 'co' END AS pollutant,
  CASE WHEN sensor = 5 THEN value / 10 ELSE value END AS conc FROM ev""",
    "wx": """SELECT ord, ts, station, value / 10 - 5 AS temperature, CAST(k AS DOUBLE) AS humidity,
  value / 50 AS windspeed, CASE WHEN k % 10 = 0 THEN value / 20 ELSE CAST(0 AS DOUBLE) END AS precipitation,
  value * 40 AS visibility FROM ev WHERE event_type = 'purchase'""",
    "traffic": """SELECT ord, ts, station, CAST(k AS BIGINT) AS currentSpeed, k + ord % 30 AS freeFlowSpeed,
  value * 2 AS vehicle_count, 1 - CAST(k AS DOUBLE) / 1000 AS confidence, ord % 50 = 0 AS roadClosure
  FROM ev WHERE event_type = 'error'""",
    "dirty": """SELECT ord, station, CASE ord % 12 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'NULL'
  WHEN 3 THEN ' 1,' || lpad(CAST(k AS VARCHAR), 3, '0') || '.5 ' WHEN 4 THEN 'abc'
  WHEN 5 THEN CAST(-value AS VARCHAR) WHEN 6 THEN '1d' WHEN 7 THEN '1_0' ELSE CAST(value AS VARCHAR) END AS raw FROM ev""",
    "dirty_ts": """SELECT ord, station, ts, CASE ord % 10 WHEN 0 THEN 'not a time'
  WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' WHEN 2 THEN strftime(ts, '%Y-%m-%d')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw_ts FROM ev""",
    "dups0": "SELECT 0 AS batch, ord, ts, station, pm25, pm10 FROM air",
    "dups": """SELECT * FROM dups0 UNION ALL SELECT * FROM dups0 WHERE ord % 7 = 0
  UNION ALL SELECT 1, ord, ts, station, pm25 + 1, pm10 + 1 FROM dups0 WHERE ord % 5 = 0""",
    "hour_mean": "SELECT station, date_trunc('hour', ts) AS ts, avg(pm25) AS pm25 FROM air GROUP BY ALL",
    "hour_grid": """SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
  FROM (SELECT station, min(ts) AS lo, max(ts) AS hi FROM hour_mean GROUP BY station)""",
    "hourly_station": "SELECT g.station, g.ts, m.pm25 FROM hour_grid g LEFT JOIN hour_mean m USING (station, ts)",
    "null_rows": """SELECT ord, ts, station, CASE WHEN ord % 9 <> 0 THEN temperature END AS temperature,
  CASE WHEN ord % 9 <> 0 THEN humidity END AS humidity, CASE WHEN ord % 9 <> 0 THEN windspeed END AS windspeed,
  CAST(NULL AS DOUBLE) AS pressure FROM wx""",
}
NEEDS = {
    "ev": [], "air": ["ev"], "air_long": ["ev"], "wx": ["ev"], "traffic": ["ev"], "dirty": ["ev"],
    "dirty_ts": ["ev"], "dups0": ["air"], "dups": ["dups0"], "hour_mean": ["air"], "hour_grid": ["hour_mean"],
    "hourly_station": ["hour_mean", "hour_grid"], "null_rows": ["wx"],
}
NUMBER_GUARD = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def sql(views: str, body: str, **ctes: str) -> str:
    """Oracle text: the named views, extra CTEs in order, then the final select."""
    wanted: list[str] = []

    def add(v):
        for n in NEEDS[v]:
            add(n)
        if v not in wanted:
            wanted.append(v)

    for v in views.split():
        add(v)
    parts = [f"{v} AS ({VIEWS[v]})" for v in wanted] + [f"{n} AS ({t})" for n, t in ctes.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def query(name: str, oracle: str | None = None):
    """Register a Spark query, with its oracle where SQL can express it."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add
