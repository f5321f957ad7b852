"""Access-log analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.text import log_day
from tidewell.operators import aggregate, parse
from tidewell.plans import lines
from tidewell.plans.registry import register
from tidewell.sources import files


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return parse.parse_access_log(lines.access_lines(files.read_table(spark, folder, "events")))


def _counts_sql(key: str, alias: str, tail: str) -> str:
    return f"""
SELECT {key} AS {alias}, count(*) AS count FROM events WHERE {lines.GOOD_EVENT}
GROUP BY 1 ORDER BY 2 DESC, 1 {tail}
"""


@register(
    "access_log_records",
    f"""
SELECT {lines.ACCESS_IP} AS remote_ip,
  concat(strftime(ts, '%d/'), ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep',
    'Oct', 'Nov', 'Dec'][month(ts)], strftime(ts, '/%Y:%H:%M:%S')) AS request_time,
  {lines.ACCESS_METHOD} AS method, {lines.ACCESS_PATH} AS path, 'HTTP/1.1' AS version,
  {lines.ACCESS_STATUS} AS status, CAST({lines.ACCESS_SIZE} AS VARCHAR) AS size,
  'shop.example.org' AS agent,
  'Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36' AS user_agent
FROM events WHERE {lines.GOOD_EVENT}
""",
)
def access_log_records(spark, folder):
    log = lines.access_lines(files.read_table(spark, folder, "events"))
    return parse.parse_access_log(log, user_agent=True)


@register("log_top_ip", _counts_sql(lines.ACCESS_IP, "remote_ip", "LIMIT 10"))
def log_top_ip(spark, folder):
    return aggregate.top_counts(_records(spark, folder), "remote_ip")


@register("log_top_day", _counts_sql(lines.ACCESS_DAY, "day", "LIMIT 10"))
def log_top_day(spark, folder):
    days = _records(spark, folder).select(log_day("request_time").alias("day"))
    return aggregate.top_counts(days, "day")


@register("log_top_path", _counts_sql(lines.ACCESS_PATH, "path", "LIMIT 10"))
def log_top_path(spark, folder):
    return aggregate.top_counts(_records(spark, folder), "path")


@register("log_top_method", _counts_sql(lines.ACCESS_METHOD, "method", "LIMIT 10"))
def log_top_method(spark, folder):
    return aggregate.top_counts(_records(spark, folder), "method")


@register("log_status_counts", _counts_sql(lines.ACCESS_STATUS, "status", ""))
def log_status_counts(spark, folder):
    return aggregate.counts_descending(_records(spark, folder), "status")


@register(
    "log_total_bytes",
    f"""
SELECT CAST(coalesce(sum({lines.ACCESS_SIZE}), 0) AS BIGINT) AS total_bytes
FROM events WHERE {lines.GOOD_EVENT}
""",
)
def log_total_bytes(spark, folder):
    return aggregate.total_bytes(_records(spark, folder))


_REPORT = {
    "remote_ip": lines.ACCESS_IP,
    "day": lines.ACCESS_DAY,
    "path": lines.ACCESS_PATH,
    "method": lines.ACCESS_METHOD,
    "status": lines.ACCESS_STATUS,
}


@register(
    "log_report",
    "WITH pairs AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {key} AS key FROM events WHERE {lines.GOOD_EVENT}"
        for name, key in _REPORT.items()
    )
    + """), counts AS (SELECT metric, key, count(*) AS count FROM pairs GROUP BY metric, key)
SELECT metric, key, count FROM counts
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY count DESC, key) <= 10
""",
)
def log_report(spark, folder):
    """All five rankings from one reading and one parse of the log."""
    keys = {name: name for name in _REPORT} | {"day": log_day("request_time")}
    return aggregate.top_counts_each(_records(spark, folder), keys)
