"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import rules, text, times
from ledgerloom.functions.nested import json_text
from ledgerloom.functions.status import Lender, cancel_reason, stage_number, stage_of
from ledgerloom.functions import fixed_values as fv
from ledgerloom.operators.aggregates import having
from registry.core import Tables, query
from registry.fragments import KINDS, REASON, STAGE

EVENTS_AS_OF = "2024-01-31"
ORDERS_AS_OF = "1998-08-02"


@query(
    "typed_constants",
    """
    SELECT o_orderkey, cast(NULL AS VARCHAR) AS filial, 0 AS commission,
        cast(NULL AS DOUBLE) AS fee, '' AS invoice_type
    FROM orders
    """,
)
def _(t: Tables):
    return t.orders.select(
        "o_orderkey",
        rules.typed_null("string").alias("filial"),
        F.lit(0).alias("commission"),
        rules.typed_null("double").alias("fee"),
        F.lit("").alias("invoice_type"),
    )


@query(
    "value_map_stage",
    f"""
    WITH {KINDS}
    SELECT row_id, stage, cast(list_position(
        ['создано', 'оформлено', 'принято', 'завершено', 'возврат', 'отменено'], stage) AS INT) AS stage_num
    FROM (SELECT row_id, {STAGE} AS stage FROM order_history LEFT JOIN kinds ON kind = status)
    """,
)
def _(t: Tables):
    stage = stage_of(F.col("status"), F.col("paid"), F.col("pay_types"))
    return t.order_history.select("row_id", stage.alias("stage")).withColumn(
        "stage_num", stage_number(F.col("stage"))
    )


@query(
    "value_map_short",
    """
    SELECT DISTINCT p_type AS category,
        coalesce(m.short, p_type) AS category_short
    FROM part LEFT JOIN (VALUES ('STANDARD', 'Std.'), ('ECONOMY', 'Econ.')) AS m(long, short) ON p_type = m.long
    """,
)
def _(t: Tables):
    kind = F.col("p_type")
    short = rules.value_map(kind, {"Std.": ("STANDARD",), "Econ.": ("ECONOMY",)}, kind)
    return t.part.select(kind.alias("category"), short.alias("category_short")).distinct()


@query(
    "pattern_map_first_match",
    """
    SELECT p_partkey, CASE
        WHEN regexp_matches(p_name, '^small') THEN 'small' WHEN contains(p_name, 'ring') THEN 'ring'
        WHEN regexp_matches(p_name, 't$') THEN 'ends in t' WHEN contains(p_name, 'hot') THEN 'hot' END AS kind
    FROM part
    """,
)
def _(t: Tables):
    patterns = [("small%", "small"), ("%ring%", "ring"), ("%t", "ends in t"), ("%hot%", "hot")]
    return t.part.select("p_partkey", rules.pattern_map(F.col("p_name"), patterns).alias("kind"))


@query(
    "city_names",
    """
    SELECT row_id, list_extract(list_filter(
        ['Алматы', 'Нур-Султан', 'Караганда'],
        lambda c, i: contains(city_id, list_extract(['KZ-ALA', 'KZ-AST', 'KZ-KAR-351010000'], i))), 1) AS city_ru
    FROM order_history
    """,
)
def _(t: Tables):
    return t.order_history.select(
        "row_id", rules.pattern_map(F.col("city_id"), fv.CITY_PATTERNS).alias("city_ru")
    )


@query(
    "multi_col_rules",
    f"SELECT row_id, CASE WHEN contains(status, 'cancel') THEN {REASON} END AS reason FROM order_history",
)
def _(t: Tables):
    stage = stage_of(F.col("status"), F.col("paid"), F.col("pay_types"))
    return t.order_history.select(
        "row_id",
        cancel_reason(stage, F.col("status"), F.col("cancelled_reason"), F.col("bank_status")).alias("reason"),
    )


@query(
    "bucketize_upper",
    """
    SELECT c_custkey, (
        SELECT label FROM (VALUES (1, 0.0, 'to 0'), (2, 2500.0, 'to 2500'), (3, 5000.0, 'to 5000')) AS b(n, bound, label)
        WHERE c_acctbal <= bound ORDER BY n LIMIT 1) AS segment,
        CASE WHEN c_acctbal > 5000 THEN 'above' ELSE 'within' END AS side
    FROM customer
    """,
)
def _(t: Tables):
    segments = [(0.0, "to 0"), (2500.0, "to 2500"), (5000.0, "to 5000")]
    closed = [(5000.0, "within")]
    return t.customer.select(
        "c_custkey",
        rules.bucketize(F.col("c_acctbal"), segments).alias("segment"),
        rules.bucketize(F.col("c_acctbal"), closed, "above").alias("side"),
    )


@query(
    "rate_by_payment_type",
    """
    SELECT o_orderkey, cast(list_extract(
        [1.0 * (o_orderkey % 7), 2.0 * (o_orderkey % 7), 3.0 * (o_orderkey % 7)],
        list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority)) AS DOUBLE) AS rate
    FROM orders
    """,
)
def _(t: Tables):
    base = F.col("o_orderkey") % 7
    rated = t.orders.select(
        "o_orderkey", "o_orderpriority", *[(base * F.lit(k * 1.0)).alias(f"r{k}") for k in (1, 2, 3)]
    )
    columns = {"1-URGENT": "r1", "2-HIGH": "r2", "3-MEDIUM": "r3"}
    return rated.select(
        "o_orderkey", rules.pick_column_by_value(F.col("o_orderpriority"), columns).alias("rate")
    )


@query(
    "indicator_flags",
    """
    SELECT o_orderkey, nullif(cast(o_orderstatus <> 'O' AS INT), 0) AS closed,
        nullif(cast(o_orderstatus = 'P' AS INT), 0) AS pending
    FROM orders
    """,
)
def _(t: Tables):
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        rules.flag(status.isin("F", "P")).alias("closed"),
        rules.flag(status == "P").alias("pending"),
    )


@query(
    "conditional_value",
    """
    SELECT o_orderkey, CASE WHEN c.c_custkey IS NOT NULL THEN round(o_totalprice, 2) END AS rich_total
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey
    """,
)
def _(t: Tables):
    rich = t.customer.where(F.col("c_acctbal") > 0).select("c_custkey")
    joined = t.orders.join(rich, F.col("o_custkey") == F.col("c_custkey"), "left")
    total = F.round("o_totalprice", 2)
    return joined.select(
        "o_orderkey", rules.keep_if(F.col("c_custkey").isNotNull(), total).alias("rich_total")
    )


@query(
    "line_total",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        round(l_extendedprice * l_quantity, 2) AS total,
        round(l_extendedprice * l_quantity - l_extendedprice, 2) AS rest
    FROM lineitem
    """,
)
def _(t: Tables):
    price = F.col("l_extendedprice")
    total = rules.line_total(price, F.col("l_quantity"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(total, 2).alias("total"),
        F.round(total - price, 2).alias("rest"),
    )


@query(
    "discounted_price",
    """
    SELECT row_id, cast(common_price + coalesce(cast(common_discount_size AS BIGINT), 0) AS DOUBLE) AS price
    FROM order_history
    """,
)
def _(t: Tables):
    price = rules.with_discount(F.col("common_price"), F.col("common_discount_size"))
    return t.order_history.select("row_id", price.alias("price"))


@query(
    "composite_label",
    """
    SELECT row_id, concat_ws('/', status, CASE WHEN paid THEN 'true' ELSE 'false' END) AS stat,
        CASE WHEN bank_status IS NOT NULL THEN concat_ws(',', status, bank_status) END AS strict_label,
        concat_ws(',', status, coalesce(bank_status, '')) AS safe_label
    FROM order_history
    """,
)
def _(t: Tables):
    status, bank = F.col("status"), F.col("bank_status")
    return t.order_history.select(
        "row_id",
        rules.composite_label(status, F.col("paid")).alias("stat"),
        rules.composite_label(status, bank, sep=",").alias("strict_label"),
        rules.composite_label(status, bank, sep=",", null_safe=True).alias("safe_label"),
    )


@query("filter_active", "SELECT doc_id, quality FROM labels WHERE (quality = 1) IS TRUE AND (toxic = 1) IS FALSE")
def _(t: Tables):
    good = (F.col("quality") == 1).eqNullSafe(F.lit(True))
    toxic = (F.col("toxic") == 1).eqNullSafe(F.lit(False))
    return t.labels.where(good & toxic).select("doc_id", "quality")


@query(
    "filter_in_not_in",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE list_contains(['F', 'P'], o_orderstatus) AND NOT list_contains(['5-LOW', '2-HIGH'], o_orderpriority)
    """,
)
def _(t: Tables):
    kept = F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("5-LOW", "2-HIGH")
    return t.orders.where(kept).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "filter_like",
    """
    SELECT p_partkey, p_name, p_type FROM part
    WHERE regexp_matches(lower(p_type), '^s') AND position('red' IN p_name) = 0
    """,
)
def _(t: Tables):
    kept = text.contains_like(F.col("p_type"), "s%") & ~F.col("p_name").like("%red%")
    return t.part.where(kept).select("p_partkey", "p_name", "p_type")


@query(
    "filter_not_null",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def _(t: Tables):
    joined = t.documents.join(t.labels, "doc_id", "left")
    return joined.where(F.col("quality").isNull()).select("doc_id", "lang")


@query(
    "filter_month_of_as_of",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') = strftime(DATE '1998-08-02' - 1, '%Y-%m')
    """,
)
def _(t: Tables):
    day = F.col("o_orderdate")
    kept = t.orders.where(times.in_month_of_previous_day(day, ORDERS_AS_OF))
    return kept.select("o_orderkey", times.month_text(day).alias("month"))


@query(
    "filter_previous_day",
    "SELECT event_id FROM events WHERE cast(ts AS DATE) = DATE '2024-01-31' - 1",
)
def _(t: Tables):
    return t.events.where(times.on_previous_day(F.col("ts"), EVENTS_AS_OF)).select("event_id")


@query(
    "filter_hour_window",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 16 HOUR AND TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 1 HOUR
        AND ts <> TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 1 HOUR
    """,
)
def _(t: Tables):
    recent = times.hours_before(F.col("ts"), "2024-01-30 20:00:00", 16, 1)
    return t.events.where(recent).select("event_id", "ts")


@query("filter_since", "SELECT o_orderkey FROM orders WHERE cast(o_orderdate AS DATE) >= DATE '1997-01-01'")
def _(t: Tables):
    return t.orders.where(F.col("o_orderdate") >= times.timestamp_literal("1997-01-01")).select("o_orderkey")


@query("filter_length", "SELECT page_id, url FROM pages WHERE strlen(url) > 40")
def _(t: Tables):
    return t.pages.where(F.length("url") > 40).select("page_id", "url")


@query(
    "filter_exclude_key",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_suppkey NOT IN (7)",
)
def _(t: Tables):
    kept = t.lineitem.where(F.col("l_suppkey") != F.lit(7))
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(
    "having_filter",
    """
    SELECT l_partkey, count(*) AS n, cast(sum(l_quantity) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY l_partkey HAVING sum(l_quantity) > 900
    """,
)
def _(t: Tables):
    totals = t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )
    return having(totals, F.col("quantity") > 900)


@query(
    "phone_normalise",
    """
    SELECT row_id, CASE
        WHEN d[1] = '8' THEN '7' || d[2:]
        WHEN strlen(d) = 10 THEN '7' || d
        WHEN strlen(d) > 11 THEN d[-11:]
        ELSE d END AS phone, d AS digits
    FROM (SELECT row_id, regexp_replace(user_mobile, '[+ -]', '', 'g') AS d FROM order_history)
    """,
)
def _(t: Tables):
    phone = F.col("user_mobile")
    return t.order_history.select(
        "row_id", text.normalise_phone(phone).alias("phone"), text.phone_digits(phone).alias("digits")
    )


@query(
    "string_slices",
    """
    SELECT c_custkey, c_name[1:8] AS head, c_name[10:] AS number, c_name[-4:] AS tail,
        strlen(c_name) AS size, replace(replace(c_name, '#', ''), 'Customer', 'C') AS short
    FROM customer
    """,
)
def _(t: Tables):
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey",
        F.substring(name, 1, 8).alias("head"),
        F.substring(name, 10, 100).alias("number"),
        F.right(name, F.lit(4)).alias("tail"),
        F.length(name).alias("size"),
        F.replace(F.replace(name, F.lit("#"), F.lit("")), F.lit("Customer"), F.lit("C")).alias("short"),
    )


@query(
    "url_last_segment",
    "SELECT page_id, list_extract(string_split(url, '/'), -1) AS segment FROM pages",
)
def _(t: Tables):
    return t.pages.select("page_id", text.last_segment(F.col("url")).alias("segment"))


@query(
    "extract_between",
    """
    SELECT event_id, nullif(regexp_extract(props, '"k": (\\d+)\\}', 1), '') AS k,
        cast(strpos(props, '"k"') AS INT) AS found_at
    FROM events
    """,
)
def _(t: Tables):
    props = F.col("props")
    return t.events.select(
        "event_id",
        text.extract_between(props, '"k": ', "}").alias("k"),
        F.locate('"k"', props).alias("found_at"),
    )


@query(
    "split_part_first",
    "SELECT p_partkey, regexp_extract(p_name, '^([^ ]*)', 1) AS word FROM part",
)
def _(t: Tables):
    return t.part.select("p_partkey", text.first_part(F.col("p_name"), " ").alias("word"))


@query(
    "path_levels",
    """
    SELECT page_id, parts[3] AS host, parts[4] AS level_1, parts[5] AS level_2, parts[9] AS level_6
    FROM (SELECT page_id, string_split(url, '/') AS parts FROM pages)
    """,
)
def _(t: Tables):
    parts = text.path_levels(F.col("url"))
    return t.pages.select(
        "page_id",
        text.level(parts, 3).alias("host"),
        text.level(parts, 4).alias("level_1"),
        text.level(parts, 5).alias("level_2"),
        text.level(parts, 9).alias("level_6"),
    )


@query(
    "case_functions",
    """
    SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, trim('  ' || p_name || ' ') AS trimmed,
        list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])),
            'string_agg', ' ') || '-' || upper(p_type[1]) || lower(p_type[2:]) AS capitalised
    FROM part
    """,
)
def _(t: Tables):
    name, kind = F.col("p_name"), F.col("p_type")
    return t.part.select(
        "p_partkey",
        F.upper(name).alias("up"),
        F.lower(kind).alias("low"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        text.initcap_words(F.concat(name, F.lit("-"), kind)).alias("capitalised"),
    )


@query(
    "strip_whitespace",
    """
    SELECT doc_id, strlen(stripped) AS bytes, md5(stripped) AS digest
    FROM (SELECT doc_id, regexp_replace(regexp_replace(text,
        '^[\\s\\p{Z}\\x{1c}-\\x{1f}\\x{85}\\x0b]+', ''), '[\\s\\p{Z}\\x{1c}-\\x{1f}\\x{85}\\x0b]+$', '') AS stripped
        FROM documents)
    """,
)
def _(t: Tables):
    stripped = t.documents.select("doc_id", text.strip_whitespace(F.col("text")).alias("s"))
    return stripped.select("doc_id", F.octet_length("s").cast("long").alias("bytes"), F.md5("s").alias("digest"))


@query(
    "commission_amount",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        cast(round(cast(l_extendedprice AS DECIMAL(18,4)) * cast(l_discount * 100 AS DECIMAL(10,4)) * 0.01, 3) AS DOUBLE)
            AS commission
    FROM lineitem
    """,
)
def _(t: Tables):
    amount = rules.percentage(F.col("l_extendedprice"), F.col("l_discount") * 100)
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", amount.alias("commission")
    )


@query(
    "casts",
    """
    SELECT event_id, cast(regexp_extract(props, '[0-9]+') AS INT) AS k_int,
        cast(cast(value AS DECIMAL(12,2)) AS DOUBLE) AS value_decimal, strftime(ts, '%Y-%m-%d') AS day,
        cast(event_id AS VARCHAR) AS id_text, cast(NULL AS INT) AS skipped
    FROM events
    """,
)
def _(t: Tables):
    return t.events.select(
        "event_id",
        json_text(F.col("props"), "$.k").cast("int").alias("k_int"),
        F.col("value").cast("decimal(12,2)").alias("value_decimal"),
        F.col("ts").cast("date").alias("day"),
        F.col("event_id").cast("string").alias("id_text"),
        F.col("event_type").try_cast("int").alias("skipped"),
    )


@query(
    "date_formats",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS to_second, strftime(ts, '%Y-%m') AS month,
        strftime(ts, '%d-%m-%Y %H:%M') AS minute
    FROM events
    """,
)
def _(t: Tables):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        times.to_second(ts).alias("to_second"),
        times.month_text(ts).alias("month"),
        times.minute_text(ts).alias("minute"),
    )


@query(
    "age_years",
    "SELECT o_orderkey, cast(date_diff('day', o_orderdate, DATE '2001-08-02') // 365 AS INT) AS age FROM orders",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", times.age_years(F.to_date("o_orderdate"), "2001-08-02").alias("age"))


@query(
    "business_day_cutoff",
    """
    SELECT event_id, strftime(ts + to_days(cast(extract(hour FROM ts) >= 8 AS INT)), '%Y-%m-%d %H:%M:%S') AS booked
    FROM events
    """,
)
def _(t: Tables):
    return t.events.select("event_id", times.business_day(F.col("ts")).alias("booked"))


@query(
    "local_time",
    """
    SELECT event_id, strftime(timezone('Asia/Almaty', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') AS almaty
    FROM events
    """,
)
def _(t: Tables):
    return t.events.select("event_id", times.local_time(F.col("ts")).alias("almaty"))


@query(
    "mixed_timestamp_parse",
    """
    SELECT step_id, CASE WHEN contains(date_end_t, '-') THEN date_end_t
        ELSE strftime(make_timestamp_ms(try_cast(date_end_t AS BIGINT)), '%Y-%m-%d %H:%M:%S') END AS ended
    FROM task_history
    """,
)
def _(t: Tables):
    return t.task_history.select("step_id", times.mixed_timestamp(F.col("date_end_t")).alias("ended"))


@query(
    "compact_date",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def _(t: Tables):
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.select("o_orderkey", times.compact_date(compact).alias("day"))


@query(
    "title_number",
    """
    SELECT row_id, try_cast(nullif(regexp_extract(pay_title, '^\\S+\\s+\\S+\\s+(\\S+)', 1), '') AS INT) AS months
    FROM order_history
    """,
)
def _(t: Tables):
    return t.order_history.select("row_id", text.title_number(F.col("pay_title")).alias("months"))


@query(
    "payment_product",
    """
    WITH codes AS (
        SELECT order_id, 1 AS src, product_sub_code AS code FROM saved_requests
    )
    SELECT row_id, coalesce(
        CASE pay_types_code WHEN 'ACQUIRING_0_4' THEN 'Кредитная карта на 4 месяца' END,
        CASE WHEN pay_title = 'В рассрочку' THEN 'Кредитная карта'
            WHEN starts_with(pay_title, 'Кредитная карта на') THEN pay_title END,
        CASE pay_types_code WHEN 'EXPRESS_0_12' THEN 'Рассрочка на 12 месяцев'
            WHEN 'EXPRESS_18_6' THEN 'Кредит на 6 месяцев' END,
        list_extract(['Рассрочка на 4 месяца', 'Кредит на 12 месяцев', 'Рассрочка на 24 месяца'],
            list_position(['FM 4-1', 'FM 12-01', 'FM 24-1-1'], code)),
        CASE WHEN starts_with(pay_title, 'Кредит на') OR starts_with(pay_title, 'Рассрочка на') THEN pay_title END,
        CASE WHEN contains(pay_types, 'EXPRESS') THEN 'Экспресс кредит' END,
        pay_title) AS product
    FROM order_history LEFT JOIN codes ON order_id = uid
    """,
)
def _(t: Tables):
    codes = t.saved_requests.select(F.col("order_id").alias("uid"), "product_sub_code")
    loan = rules.value_map(F.col("product_sub_code"), fv.LOAN_PRODUCTS)
    product = Lender().payment_product(F.col("pay_types"), F.col("pay_types_code"), F.col("pay_title"), loan)
    return t.order_history.join(codes, "uid", "left").select("row_id", product.alias("product"))
