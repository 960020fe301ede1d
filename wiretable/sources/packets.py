"""Packet view over the driver's ``events`` table (FIXTURES.md §2).

One portable statement turns ``events`` into a dirty, extracted-shaped packet
table: text fields, injected junk (bad addresses, ports, times, protocols) and
exact duplicates.  The same text runs in Spark and in DuckDB; only the epoch
offset and the frame-time rendering differ.  The Spark fragments use
TIMESTAMP_NTZ arithmetic, so the view does not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_utc

PACKET_VIEW_TEMPLATE = """
WITH e AS (
  SELECT event_id, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         1684320272000000 + {OFFSET} AS t_us
  FROM {EVENTS}),
p AS (
  SELECT event_id AS packet_id, t_us,
    CASE WHEN event_id % 113 = 0 THEN 'not a time' ELSE concat({FRAME}, '000 CEST') END AS frame_time,
    CASE WHEN event_id % 101 = 0 THEN '999.1.2.3'
         WHEN event_id % 103 = 0 THEN CAST(NULL AS VARCHAR(40))
         WHEN event_id % 89 = 0 THEN '2001:db8::1'
         ELSE concat('10.0.2.', CAST(user_id % 150 AS VARCHAR(20))) END AS src_ip,
    CASE WHEN event_type IN ('click', 'view') THEN '192.168.1.1'
         WHEN event_type = 'purchase' THEN '93.184.216.34'
         WHEN event_type = 'signup' AND k % 3 = 0 THEN '10.0.2.3'
         ELSE concat('203.0.113.', CAST(k % 20 AS VARCHAR(20))) END AS dst_ip,
    CASE WHEN event_type = 'click' THEN '17' WHEN event_id % 97 = 0 THEN '1'
         WHEN event_id % 109 = 0 THEN '47' ELSE '6' END AS ip_proto,
    CASE WHEN event_id % 107 = 0 THEN '70000' WHEN event_id % 139 = 0 THEN ''
         WHEN event_id % 2 = 0 THEN '50000.0' ELSE '1234' END AS src_port,
    CASE event_type WHEN 'click' THEN '53' WHEN 'view' THEN '443' WHEN 'purchase' THEN '80'
         WHEN 'error' THEN CASE WHEN user_id % 10 = 0 THEN CAST(40000 + k AS VARCHAR(20)) ELSE '22' END
         ELSE CASE k % 4 WHEN 0 THEN '5353' WHEN 1 THEN '3389' WHEN 2 THEN '4444' ELSE '8443' END END AS dst_port,
    CASE WHEN event_id % 131 = 0 THEN '9100'
         ELSE CAST(30 + CAST(floor(value * 3) AS INT) AS VARCHAR(20)) END AS length,
    CASE WHEN event_type = 'click' THEN
      CASE WHEN k % 10 = 0 THEN 'c2.duckdns.org'
           ELSE concat('host', CAST(k % 25 AS VARCHAR(20)), '.example.com') END END AS dns_query,
    CASE WHEN event_type = 'purchase' THEN concat('shop', CAST(k % 5 AS VARCHAR(20)), '.example.org')
         WHEN event_type = 'signup' AND k % 12 = 6 AND event_id % 2 = 0 THEN 'intranet.local'
         WHEN event_id % 127 = 0 THEN '' END AS http_host,
    CASE WHEN event_type = 'purchase' THEN
      CASE WHEN k % 7 = 0 THEN '/wp-admin/login' ELSE '/index.html' END END AS http_path,
    CASE WHEN event_type = 'purchase' AND k % 3 = 0 THEN 'agent/1.0' END AS user_agent
  FROM e)
SELECT * FROM p UNION ALL
SELECT packet_id + 100000000000 AS packet_id, t_us, frame_time, src_ip, dst_ip, ip_proto, src_port, dst_port,
       length, dns_query, http_host, http_path, user_agent
FROM p WHERE packet_id % 10 = 0
"""

SPARK_FRAGMENTS = {
    "OFFSET": "(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) "
              "- 1704067200000000) div 3600",
    "FRAME": "date_format(timestampadd(MICROSECOND, t_us, TIMESTAMP_NTZ'1970-01-01 00:00:00'), "
             "'MMM dd, yyyy HH:mm:ss.SSSSSS')",
}
DUCKDB_FRAGMENTS = {
    "OFFSET": "(epoch_us(ts) - 1704067200000000) // 3600",
    "FRAME": "strftime(make_timestamp(t_us), '%b %d, %Y %H:%M:%S.%f')",
}

# The modulo conditions above are the fixture's junk and duplicate injection
# rules (which rows get a bad address, port, time, ...); every event is used.
PACKET_COLUMNS = ["packet_id", "t_us", "frame_time", "src_ip", "dst_ip", "ip_proto",
                  "src_port", "dst_port", "length", "dns_query", "http_host",
                  "http_path", "user_agent"]


def packet_view_sql(dialect: str, events: str = "events") -> str:
    frags = SPARK_FRAGMENTS if dialect == "spark" else DUCKDB_FRAGMENTS
    sql = PACKET_VIEW_TEMPLATE
    for key, value in frags.items():
        sql = sql.replace("{" + key + "}", value)
    return sql.replace("{EVENTS}", events)


def spread(df: DataFrame) -> DataFrame:
    """Spreads the fixture's few input splits over the cluster (a round-robin shuffle).

    Only for fixtures: a table of one file would run every narrow stage in one task.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty packet table (13 columns, text fields) built from ``events``."""
    ensure_utc(spark)
    events = spread(read_events(spark, sf_dir))
    # `{events}` is bound to the DataFrame by spark.sql; Catalyst sees one plan.
    return spark.sql(packet_view_sql("spark", "{events}"), events=events)
