"""Pick-catalog views over the relational test tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATION_ID = "concat('N', CAST(user_id % 6 AS STRING), '.S', lpad(CAST(user_id AS STRING), 4, '0'), '.')"

VIEWS = {
    "fx_picks": f"""SELECT event_id AS pick_id, concat('N', CAST(user_id % 6 AS STRING)) AS network, {STATION_ID} AS tid,
  CASE user_id % 4 WHEN 0 THEN 'HH' WHEN 1 THEN 'EH' WHEN 2 THEN 'BH' ELSE 'HN' END AS cha,
  CASE event_type WHEN 'click' THEN 'P' ELSE 'S' END AS pha,
  ts - INTERVAL '1' SECOND AS start_ts, ts AS peak, ts + INTERVAL '2' SECOND AS end_ts, value / 500e0 AS conf,
  CASE WHEN event_id % 50 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value * 1e-6 END AS amp, value * 10e0 AS amp_raw,
  concat('r', CAST(event_id % 4 AS STRING)) AS rid
FROM events WHERE event_type IN ('click', 'view')""",
    "fx_analyst": f"""SELECT event_id AS arrival_id, {STATION_ID} AS tid, CASE event_type WHEN 'signup' THEN 'P' ELSE 'S' END AS pha,
  ts AS time, CASE WHEN event_id % 20 = 0 THEN 'automatic' ELSE 'manual' END AS evaluation_mode
FROM events WHERE event_type IN ('signup', 'purchase')""",
    "fx_origins": """SELECT event_id AS origin_id, ts AS time, 32e0 + (event_id * 29 % 1000) / 100e0 AS latitude,
  -125e0 + (event_id * 31 % 1000) / 100e0 AS longitude, CAST(event_id % 20 AS DOUBLE) AS depth_km, 1e0 + value / 100e0 AS mag,
  CASE WHEN event_id % 7 = 0 THEN 'automatic' ELSE 'reviewed' END AS status
FROM events WHERE event_type = 'error' AND value >= 100""",
    "fx_stations": f"""SELECT {STATION_ID} AS id, concat('N', CAST(user_id % 6 AS STRING)) AS network_code,
  32e0 + (user_id * 37 % 1000) / 100e0 AS latitude, -125e0 + (user_id * 53 % 1000) / 100e0 AS longitude,
  CAST(user_id * 71 % 4000 - 2000 AS DOUBLE) AS elevation,
  concat('2024.', lpad(CAST(1 + user_id % 10 AS STRING), 3, '0')) AS start_date,
  CASE WHEN user_id % 25 = 0 THEN 'unknown' ELSE concat('2024.', lpad(CAST(11 + user_id % 20 AS STRING), 3, '0')) END AS end_date,
  CASE user_id % 5 WHEN 0 THEN 'HH,BH,LH' WHEN 1 THEN 'BH,HN' WHEN 2 THEN 'DP' WHEN 3 THEN 'LH,VH' ELSE 'EH,HN' END AS channels
FROM (SELECT DISTINCT user_id FROM events) u""",
    "fx_runs": """SELECT concat('r', CAST(n_nationkey AS STRING)) AS rid, CASE WHEN n_nationkey % 2 = 0 THEN 'weight_a' ELSE 'weight_b' END AS weight,
  0.2e0 AS p_threshold, 0.2e0 AS s_threshold FROM nation WHERE n_nationkey < 4""",
    "fx_traces": """SELECT vec_id AS trace_id, CAST(vec_id % 50 AS INT) AS station_no, CASE vec_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN 'N' ELSE 'E' END AS component,
  1e0 AS rate_hz, embedding AS samples, label FROM embeddings""",
}
SOURCES = {"fx_picks": "events", "fx_analyst": "events", "fx_origins": "events", "fx_stations": "events", "fx_runs": "nation", "fx_traces": "embeddings"}


class Views:
    """The views as DataFrames of one directory of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        source = SOURCES[name]
        return self.spark.sql(VIEWS[name].replace(f"FROM {source}", "FROM {src}"), src=self.table(source))

    picks = property(lambda self: self.view("fx_picks"))
    analyst = property(lambda self: self.view("fx_analyst"))
    origins = property(lambda self: self.view("fx_origins"))
    stations = property(lambda self: self.view("fx_stations"))
    runs = property(lambda self: self.view("fx_runs"))
    traces = property(lambda self: self.view("fx_traces"))


def with_views(sql: str) -> str:
    """``sql`` with the views it names put before it."""
    used = [f"{n} AS ({v})" for n, v in VIEWS.items() if n in sql]
    if not used:
        return sql
    body = sql.strip()
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(head):
            return f"{head}{', '.join(used)}, {body[len(head):]}"
    return f"WITH {', '.join(used)} {body}"
