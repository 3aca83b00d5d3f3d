"""Sources and sinks: each sink query writes to the shared folder and reads back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerloom import sinks
from ledgerloom.operators.unions import union_all
from ledgerloom.plans import daily
from ledgerloom.session import scratch_dir
from ledgerloom.sources import scan_documents, scan_table
from registry.core import Tables, query

DAY = date(2024, 1, 30)


@query(
    "scan_table",
    "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 AND s_nationkey <> 3",
)
def _(t: Tables):
    kept = (F.col("s_acctbal") > 0) & (F.col("s_nationkey") != 3)
    return scan_table(t.spark, t.directory, "supplier", ["s_suppkey", "s_name"], kept)


@query(
    "scan_documents",
    "SELECT cast(page_id AS VARCHAR) AS id, url, strlen(html) AS bytes, md5(html) AS digest, cast(NULL AS VARCHAR) AS lang FROM pages",
)
def _(t: Tables):
    target = scratch_dir(t.spark, "landed-pages")
    source = F.struct("url", "html").alias("_source")
    landed = t.pages.select(F.col("page_id").cast("string").alias("_id"), source)
    sinks.write_folder(landed, target, "json")
    schema = "_id string, _source struct<url string, html string, lang string>"
    return scan_documents(t.spark, target, schema).select(
        F.col("_id").alias("id"),
        "_source.url",
        F.octet_length("_source.html").cast("long").alias("bytes"),
        F.md5("_source.html").alias("digest"),
        "_source.lang",
    )


@query(
    "scan_documents_many",
    """
    SELECT 'desk_nomen_nation' AS index_name, cast(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation
    UNION ALL SELECT 'desk_nomen_region', cast(r_regionkey AS VARCHAR), r_name FROM region
    """,
)
def _(t: Tables):
    base = scratch_dir(t.spark, "landed-indices")
    for table, key, name in (("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name")):
        landed = getattr(t, table).select(
            F.col(key).cast("string").alias("_id"), F.struct(F.col(name).alias("name")).alias("_source")
        )
        sinks.write_folder(landed, f"{base}/desk_nomen_{table}", "json")
    schema = "_id string, _source struct<name string>"
    documents = scan_documents(t.spark, f"{base}/desk_nomen_*", schema, origin="file")
    return documents.select(
        F.regexp_extract("file", r"(desk_nomen_\w+)/", 1).alias("index_name"),
        F.col("_id").alias("id"),
        F.col("_source.name").alias("name"),
    )


@query("sink_full_refresh", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(t: Tables):
    target = scratch_dir(t.spark, "full-refresh")
    sinks.write_full_refresh(t.nation, target)
    sinks.write_full_refresh(t.nation, target)
    return sinks.read_table(t.spark, target)


@query("sink_append", "SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey, r_name FROM region")
def _(t: Tables):
    target = scratch_dir(t.spark, "append")
    sinks.write_append(t.region, target)
    sinks.write_append(t.region, target)
    return sinks.read_table(t.spark, target)


@query(
    "append_once",
    "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def _(t: Tables):
    """Events landed week by week; each batch is delivered twice, the second time without effect."""
    target = scratch_dir(t.spark, "append-once")
    rows = t.events.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.weekofyear("ts").alias("week"))
    weeks = sorted(r.week for r in rows.select("week").distinct().collect())
    for week in weeks:
        for _run in range(2):
            sinks.write_append(rows.where(F.col("week") == week).drop("week"), target, batch=f"week-{week}")
    return sinks.read_table(t.spark, target)


@query(
    "sink_fan_out",
    """
    SELECT copy, s_suppkey, s_name, s_nationkey, round(s_acctbal, 2) AS s_acctbal
    FROM supplier, (VALUES (1), (2)) AS copies(copy)
    """,
)
def _(t: Tables):
    targets = [scratch_dir(t.spark, f"fan-out-{i}") for i in (1, 2)]
    sinks.write_fan_out(t.spark, t.supplier.withColumn("s_acctbal", F.round("s_acctbal", 2)), targets)
    return union_all(
        [sinks.read_table(t.spark, path).withColumn("copy", F.lit(i)) for i, path in enumerate(targets, 1)]
    )


@query("copy_table", "SELECT cast(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation")
def _(t: Tables):
    target = scratch_dir(t.spark, "copy")
    sinks.copy_table(t.spark, f"{t.directory}/nation.parquet", target, "parquet", "json", ["n_nationkey", "n_name"])
    return sinks.read_table(t.spark, target).withColumn("n_nationkey", F.col("n_nationkey").cast("long"))


@query(
    "report_headers",
    """
    SELECT cast(c_custkey AS VARCHAR) AS "№ клиента", c_name AS "ФИО клиента", c_mktsegment AS "Сегмент" FROM customer
    """,
)
def _(t: Tables):
    target = scratch_dir(t.spark, "report")
    headers = ["№ клиента", "ФИО клиента", "Сегмент"]
    sinks.write_report(t.customer.select("c_custkey", "c_name", "c_mktsegment"), headers, target)
    names = ", ".join(f"`{h}` string" for h in headers)
    back = t.spark.read.schema(names).option("escape", '"').csv(target)
    return back.where(F.col(headers[0]) != headers[0])


@query(
    "alert_rows",
    """
    SELECT event_id, concat('event: ', event_id, ', user: ', user_id, ', reason: ',
        CASE event_type WHEN 'error' THEN 'failed' ELSE 'none' END) AS message
    FROM events WHERE event_type IN ('error', 'signup')
    """,
)
def _(t: Tables):
    rows = t.events.where(F.col("event_type").isin("error", "signup"))
    reason = F.when(F.col("event_type") == "error", "failed")
    alerts = sinks.alert_rows(rows, {"event": "event_id", "user": "user_id", "reason": reason})
    return alerts.select("event_id", "message")


def _sessions(t: Tables):
    """Landed analytics rows: compact day and a count as text."""
    day = F.date_format("ts", "yyyyMMdd")
    return t.events.groupBy(day.alias("date")).agg(F.countDistinct("user_id").cast("string").alias("sessions"))


@query(
    "date_slice_replace",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS dates, count(DISTINCT user_id) + CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-30' THEN 5 ELSE 0 END AS sessions
    FROM events GROUP BY strftime(ts, '%Y-%m-%d')
    """,
)
def _(t: Tables):
    history = daily.daily_sessions(_sessions(t))
    today = history.where(F.col("dates") == F.lit(DAY)).select((F.col("sessions") + 5).alias("sessions"))
    return daily.with_slice_replaced(history, today, "dates", DAY)


@query(
    "sink_date_slice",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS dates, count(DISTINCT user_id) + CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-30' THEN 5 ELSE 0 END AS sessions
    FROM events GROUP BY strftime(ts, '%Y-%m-%d')
    """,
)
def _(t: Tables):
    target = scratch_dir(t.spark, "date-slice")
    history = daily.daily_sessions(_sessions(t))
    sinks.replace_dates(history, target, "dates")
    today = history.where(F.col("dates") == F.lit(DAY)).select((F.col("sessions") + 5).alias("sessions"))
    for _run in range(2):
        sinks.write_date_slice(today, target, "dates", DAY)
    return sinks.read_table(t.spark, target)
