"""Joins, aggregations, latest rows, ordering, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.text import braced_list, level
from ledgerloom.functions.times import local_time
from ledgerloom.operators import aggregates, incremental, joins, latest, ordering, unions
from ledgerloom.session import scratch_dir
from registry.core import Tables, query

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "inner_dim",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, s_name
    FROM lineitem, supplier WHERE l_suppkey = s_suppkey AND s_acctbal > 0
    """,
)
def _(t: Tables):
    active = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    repeated = unions.union_all([active, active])
    return joins.inner_dim(t.lineitem.select(*LINE), repeated, "l_suppkey").select(*LINE, "s_name")


@query(
    "inner_amount_match",
    """
    SELECT DISTINCT h.row_id, p.product_merchant_id AS merchant, p.sku_price * p.sku_amount AS total
    FROM order_history h JOIN packages p ON p.uid = h.uid
    WHERE p.sku_price * p.sku_amount = CASE WHEN h.common_old_price IS NULL THEN h.common_price ELSE h.common_old_price END
    """,
)
def _(t: Tables):
    lines = t.packages.select(
        "uid",
        F.col("product_merchant_id").alias("merchant"),
        (F.col("sku_price") * F.col("sku_amount")).alias("line_total"),
    ).distinct()
    orders = t.order_history.select(
        "row_id", "uid", F.coalesce("common_old_price", "common_price").alias("total")
    )
    return joins.inner_on_measure(orders, lines, ["uid"], "total", "line_total").select(
        "row_id", "merchant", "total"
    )


@query(
    "left_dim",
    """
    SELECT doc_id, lang, (SELECT quality FROM labels l WHERE l.doc_id = d.doc_id) AS quality FROM documents d
    """,
)
def _(t: Tables):
    return joins.left_dim(t.documents.select("doc_id", "lang"), t.labels.select("doc_id", "quality"), "doc_id")


@query(
    "multi_level_lookup",
    """
    WITH levels AS (
        SELECT id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS token
        FROM (SELECT id, string_split(trim(categories_array, '{}'), ',') AS parts FROM nomenclature)
    ), titled AS (
        SELECT l.id, pos, title FROM levels l JOIN categories c ON c.id = l.token
    )
    SELECT n.id, cat1, cat2, cat3, cat4 FROM nomenclature n LEFT JOIN (
        SELECT id, max(title) FILTER (pos = 1) AS cat1, max(title) FILTER (pos = 2) AS cat2,
            max(title) FILTER (pos = 3) AS cat3, max(title) FILTER (pos = 4) AS cat4
        FROM titled GROUP BY id) t ON t.id = n.id
    """,
)
def _(t: Tables):
    """Levels are looked up once per distinct path; items take the titles of theirs."""
    parts = braced_list(F.col("categories_array"))
    paths = t.nomenclature.select("categories_array").distinct()
    paths = paths.select("categories_array", *[level(parts, k).alias(f"k{k}") for k in range(1, 5)])
    dim = t.categories.withColumnRenamed("id", "category_id")
    levels = {f"k{k}": f"cat{k}" for k in range(1, 5)}
    titles = joins.lookup_levels(paths, levels, dim, "category_id", "title", row_key="categories_array")
    items = t.nomenclature.select("id", "categories_array")
    return items.join(titles, "categories_array", "left").select("id", *levels.values())


@query(
    "latest_completed_step",
    """
    WITH steps AS (
        SELECT user_id, event_type, CASE WHEN event_type = 'signup' THEN date_trunc('day', ts) ELSE date_trunc('hour', ts) END AS ended,
            event_type IN ('purchase', 'signup') AS completed FROM events
    )
    SELECT s.user_id, s.event_type, strftime(s.ended, '%Y-%m-%d %H:%M:%S') AS ended FROM steps s
    WHERE s.ended = (SELECT max(c.ended) FROM steps c WHERE c.completed AND c.user_id = s.user_id)
    """,
)
def _(t: Tables):
    ended = F.when(F.col("event_type") == "signup", F.date_trunc("day", "ts")).otherwise(
        F.date_trunc("hour", "ts")
    )
    steps = t.events.select("user_id", "event_type", ended.alias("ended"))
    completed = F.col("event_type").isin("purchase", "signup")
    return joins.at_latest_completed(steps, "user_id", "ended", completed, ["event_type", "ended"])


@query(
    "rows_at_latest",
    """
    SELECT user_id, event_id FROM events e
    WHERE (user_id, date_trunc('day', ts)) IN (SELECT user_id, max(date_trunc('day', ts)) FROM events GROUP BY user_id)
    """,
)
def _(t: Tables):
    return latest.rows_at_latest(t.events, ["user_id"], F.date_trunc("day", "ts")).select("user_id", "event_id")


@query(
    "full_outer",
    """
    SELECT c_custkey, round(c_acctbal, 2) AS balance, o_orderkey
    FROM (SELECT * FROM customer WHERE c_acctbal > 0) c
    FULL OUTER JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON o_custkey = c_custkey
    """,
)
def _(t: Tables):
    rich = t.customer.where("c_acctbal > 0").select("c_custkey", F.round("c_acctbal", 2).alias("balance"))
    pending = t.orders.where("o_orderstatus = 'P'").select("o_custkey", "o_orderkey")
    return joins.full_join_by_parts(rich, pending, "c_custkey", "o_custkey").drop("o_custkey")


@query(
    "left_outer_by_parts",
    """
    SELECT c_custkey, o_orderkey FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON o_custkey = c_custkey
    """,
)
def _(t: Tables):
    pending = t.orders.where("o_orderstatus = 'P'").select("o_custkey", "o_orderkey")
    joined = joins.left_join_by_parts(t.customer.select("c_custkey"), pending, "c_custkey", "o_custkey")
    return joined.drop("o_custkey")


@query(
    "incident_lookup",
    "SELECT n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey",
)
def _(t: Tables):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query(
    "computed_key_join",
    """
    SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = cast(split_part(c_name, '#', 2) AS BIGINT)
    """,
)
def _(t: Tables):
    named = t.customer.select("c_name", F.substring("c_name", 10, 20).cast("long").alias("o_custkey"))
    return t.orders.join(named, "o_custkey").select("o_orderkey", "c_name")


@query(
    "default_key_join",
    """
    SELECT i.item_id, i.merch_id, i.invoice_id, cast(t.EXPRESS_0_12 AS DOUBLE) AS rate
    FROM (SELECT v.*, coalesce(split_part(ltrim(n.categories_array, '{'), ',', 1), 'root') AS cat
          FROM invoices v LEFT JOIN nomenclature n ON n.id = v.item_id) i
    LEFT JOIN tariffs t ON t.merchant_id = i.merch_id AND t.cat_id = i.cat
    """,
)
def _(t: Tables):
    categories = t.nomenclature.select(
        F.col("id").alias("item_id"), level(braced_list(F.col("categories_array")), 1).alias("cat_id")
    )
    items = (
        t.invoices.select("item_id", "merch_id", "invoice_id")
        .join(categories, "item_id", "left")
        .withColumn("cat_id", F.coalesce("cat_id", F.lit("root")))
    )
    rates = t.tariffs.select(
        F.col("merchant_id").alias("merch_id"), "cat_id", F.col("EXPRESS_0_12").cast("double").alias("rate")
    )
    return items.join(rates, ["merch_id", "cat_id"], "left").drop("cat_id")


@query(
    "anti_later_event",
    """
    SELECT event_id, user_id FROM events a WHERE event_type = 'signup' AND NOT EXISTS (
        SELECT 1 FROM events b WHERE b.user_id = a.user_id AND b.ts > a.ts AND b.event_type <> 'signup')
    """,
)
def _(t: Tables):
    rows = t.events.where("event_type = 'signup'")
    left = joins.anti_later_event(rows, t.events, "user_id", "ts", "event_type", "signup")
    return left.select("event_id", "user_id")


@query(
    "mismatch_join",
    """
    SELECT event_id, c_custkey, nullif(event_id % 5, 4) AS a, c_nationkey % 5 AS b
    FROM events JOIN customer ON c_custkey = user_id
    WHERE nullif(event_id % 5, 4) IS DISTINCT FROM c_nationkey % 5
    """,
)
def _(t: Tables):
    people = t.customer.select(
        F.col("c_custkey").alias("user_id"), "c_custkey", (F.col("c_nationkey") % 5).cast("int").alias("b")
    )
    a = F.nullif(F.col("event_id") % 5, F.lit(4))
    rows = t.events.select("event_id", "user_id", a.alias("a"))
    return joins.mismatch_join(rows, people, "user_id", "a", "b").drop("user_id")


@query(
    "null_rejecting_left",
    "SELECT d.doc_id, d.lang, l.quality FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE l.quality >= 0",
)
def _(t: Tables):
    joined = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return joined.where(F.col("quality") >= 0)


@query(
    "composite_key_left",
    """
    SELECT a.l_partkey, a.l_suppkey, round(a.top, 2) AS top, b.n
    FROM (SELECT l_partkey, l_suppkey, max(l_extendedprice) AS top FROM lineitem GROUP BY ALL) a
    LEFT JOIN (SELECT l_partkey, l_suppkey, l_extendedprice, count(*) AS n FROM lineitem
               WHERE l_returnflag = 'N' GROUP BY ALL) b
        ON (a.l_partkey, a.l_suppkey, a.top) = (b.l_partkey, b.l_suppkey, b.l_extendedprice)
    """,
)
def _(t: Tables):
    keys = ["l_partkey", "l_suppkey"]
    tops = t.lineitem.groupBy(*keys).agg(F.max("l_extendedprice").alias("l_extendedprice"))
    counts = (
        t.lineitem.where("l_returnflag = 'N'")
        .groupBy(*keys, "l_extendedprice")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joined = joins.left_dim(tops, counts, [*keys, "l_extendedprice"])
    return joined.select(*keys, F.round("l_extendedprice", 2).alias("top"), "n")


@query(
    "fanout_dedup",
    """
    SELECT c_custkey, c_name, c_mktsegment FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY c_custkey, c_name, c_mktsegment
    """,
)
def _(t: Tables):
    return t.customer.select("c_custkey", "c_name", "c_mktsegment").distinct()


@query(
    "semi_lookup",
    "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)",
)
def _(t: Tables):
    rich = t.customer.where("c_acctbal > 9900")
    return joins.semi_lookup(t.nation, rich, "n_nationkey", "c_nationkey").select("n_nationkey", "n_name")


@query(
    "pivot_sum_fixed",
    """
    SELECT user_id, cast(count(*) FILTER (event_type = 'view') AS BIGINT) AS views,
        cast(count(*) FILTER (event_type = 'click') AS BIGINT) AS clicks,
        cast(count(*) FILTER (event_type = 'refund') AS BIGINT) AS refunds
    FROM events GROUP BY user_id
    """,
)
def _(t: Tables):
    counted = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    labels = {"view": "views", "click": "clicks", "refund": "refunds"}
    return aggregates.pivot_sum(counted, ["user_id"], "event_type", "n", labels)


@query(
    "status_pivot",
    """
    WITH first AS (
        SELECT uid, list(status ORDER BY updated_on, row_id)[1:7] AS s FROM order_history GROUP BY uid
    )
    SELECT uid, s[1] AS status_1, s[2] AS status_2, s[3] AS status_3, s[4] AS status_4, s[5] AS status_5,
        s[6] AS status_6, s[7] AS status_7 FROM first
    """,
)
def _(t: Tables):
    order = [F.col("updated_on").asc(), F.col("row_id").asc()]
    first = latest.first_per_key(t.order_history.select("uid", "status", "updated_on", "row_id"), ["uid"], order, 7, "n")
    return aggregates.pivot_max(first, ["uid"], "n", "status", 7, "status_")


@query(
    "min_max_by",
    """
    SELECT l_partkey, round(min(l_extendedprice), 2) AS least, round(max(l_extendedprice), 2) AS most,
        max(l_returnflag) AS last_flag
    FROM lineitem GROUP BY l_partkey
    """,
)
def _(t: Tables):
    rows = t.lineitem.withColumn("price", F.round("l_extendedprice", 2))
    measures = {"least": ("min", "price"), "most": ("max", "price"), "last_flag": ("max", "l_returnflag")}
    return aggregates.min_max_by(rows, ["l_partkey"], measures)


@query(
    "group_as_distinct",
    "SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem GROUP BY ALL",
)
def _(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").dropDuplicates()


@query(
    "two_level_counts",
    """
    SELECT p_brand, cast(sum(n) AS BIGINT) AS parts FROM (
        SELECT l_suppkey, p_brand, count(DISTINCT l_partkey) AS n FROM lineitem JOIN part ON p_partkey = l_partkey
        GROUP BY l_suppkey, p_brand) GROUP BY p_brand
    """,
)
def _(t: Tables):
    rows = t.lineitem.select("l_suppkey", "l_partkey").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"
    )
    return aggregates.two_level_sum(rows, ["l_suppkey", "p_brand"], ["p_brand"], "l_partkey", "parts")


@query("distinct_rows", "SELECT user_id, event_type FROM events GROUP BY 1, 2")
def _(t: Tables):
    return t.events.select("user_id", "event_type").distinct()


@query(
    "group_finer",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag, l_suppkey",
)
def _(t: Tables):
    return aggregates.grouped_finer_than_shown(t.lineitem, ["l_returnflag"], ["l_suppkey"], "l_partkey", "parts")


@query(
    "max_as_any",
    "SELECT source, max(lang) AS lang, max(text) AS text FROM documents GROUP BY source",
)
def _(t: Tables):
    return aggregates.min_max_by(t.documents, ["source"], {"lang": ("max", "lang"), "text": ("max", "text")})


@query(
    "conditional_distinct_counts",
    """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS all_parts,
        count(DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_partkey END) AS kept,
        count(DISTINCT CASE WHEN l_returnflag <> 'R' AND l_linestatus = 'O' THEN l_partkey END) AS open_parts
    FROM lineitem GROUP BY l_suppkey
    """,
)
def _(t: Tables):
    kept = F.col("l_returnflag") != "R"
    conditions = {"all_parts": F.lit(True), "kept": kept, "open_parts": kept & (F.col("l_linestatus") == "O")}
    return aggregates.conditional_distinct_counts(t.lineitem, ["l_suppkey"], "l_partkey", conditions)


@query(
    "event_sequence",
    """
    SELECT event_id, user_id, cast(1 + (SELECT count(*) FROM events b
        WHERE b.user_id = a.user_id AND (b.ts, b.event_id) < (a.ts, a.event_id)) AS INT) AS num
    FROM events a
    """,
)
def _(t: Tables):
    numbered = latest.sequence_number(
        t.events.select("event_id", "user_id", "ts"),
        ["user_id"],
        [F.col("ts").asc(), F.col("event_id").asc()],
        "num",
    )
    return numbered.select("event_id", "user_id", "num")


@query(
    "latest_per_key",
    """
    SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type
    FROM events GROUP BY user_id
    """,
)
def _(t: Tables):
    last = latest.latest_per_key(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return last.select("user_id", "event_id", "event_type")


@query(
    "latest_per_composite_key",
    """
    SELECT o_custkey, o_orderstatus, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey
    FROM orders GROUP BY o_custkey, o_orderstatus
    """,
)
def _(t: Tables):
    last = latest.latest_per_key(
        t.orders, ["o_custkey", "o_orderstatus"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    )
    return last.select("o_custkey", "o_orderstatus", "o_orderkey")


@query(
    "order_output",
    """
    SELECT c.c_custkey, c.c_nationkey, o.last_day FROM customer c LEFT JOIN (
        SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders GROUP BY 1) o
        ON o.o_custkey = c.c_custkey
    ORDER BY last_day DESC NULLS FIRST, c_custkey ASC
    """,
)
def _(t: Tables):
    days = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.to_date("o_orderdate")).cast("string").alias("last_day")
    )
    joined = t.customer.select("c_custkey", "c_nationkey").join(days, "c_custkey", "left")
    return ordering.order_output(joined, [("last_day", "desc"), ("c_custkey", "asc")])


@query(
    "union_distinct",
    "SELECT s_nationkey AS nationkey FROM supplier UNION SELECT c_nationkey FROM customer",
)
def _(t: Tables):
    return unions.union_distinct(
        [
            t.supplier.select(F.col("s_nationkey").alias("nationkey")),
            t.customer.select(F.col("c_nationkey").alias("nationkey")),
        ]
    )


@query(
    "labelled_union",
    """
    SELECT 'all' AS base, l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_suppkey
    UNION ALL SELECT 'kept', l_suppkey, count(DISTINCT l_partkey) FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_suppkey
    UNION ALL SELECT 'open', l_suppkey, count(DISTINCT l_partkey) FROM lineitem
        WHERE l_returnflag <> 'R' AND l_linestatus = 'O' GROUP BY l_suppkey
    """,
)
def _(t: Tables):
    kept = F.col("l_returnflag") != "R"
    segments = {"all": F.lit(True), "kept": kept, "open": kept & (F.col("l_linestatus") == "O")}
    rows = unions.labelled_segments(t.lineitem, segments, "base")
    return aggregates.count_distinct_by(rows, ["base", "l_suppkey"], "l_partkey", "n")


@query(
    "labelled_tables",
    """
    SELECT 'customer' AS base, c_nationkey AS nationkey, count(*) AS n FROM customer GROUP BY ALL
    UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY ALL
    """,
)
def _(t: Tables):
    parts = {
        "customer": t.customer.select(F.col("c_nationkey").alias("nationkey")),
        "supplier": t.supplier.select(F.col("s_nationkey").alias("nationkey")),
    }
    tagged = unions.labelled_union(parts, "base")
    return tagged.groupBy("base", "nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "union_all_segments",
    """
    SELECT o_orderkey, 'any' AS segment FROM orders
    UNION ALL SELECT o_orderkey, 'urgent' FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT o_orderkey, 'pending' FROM orders WHERE o_orderstatus = 'P'
    """,
)
def _(t: Tables):
    segments = {
        "any": F.lit(True),
        "urgent": F.col("o_orderpriority") == "1-URGENT",
        "pending": F.col("o_orderstatus") == "P",
    }
    return unions.labelled_segments(t.orders, segments, "segment").select("o_orderkey", "segment")


@query(
    "local_days",
    "SELECT strftime(timezone('Asia/Almaty', timezone('UTC', ts)), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1",
)
def _(t: Tables):
    day = F.to_date(local_time(F.col("ts")))
    return t.events.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "latest_incremental",
    """
    SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
        strftime(max(ts) FILTER (event_type <> 'purchase'), '%Y-%m-%d %H:%M:%S') AS last_other
    FROM events GROUP BY user_id
    """,
)
def _(t: Tables):
    """Latest event and last other status per user from a state that took three batches, the
    middle days last; each batch is delivered twice."""
    state = incremental.LatestState(
        t.spark, scratch_dir(t.spark, "latest-state"), ["user_id"], "event_type", [F.col("ts").desc(), F.col("event_id").desc()], buckets=16
    )
    rows = t.events.select("user_id", "event_type", "ts", "event_id")
    days = F.dayofmonth("ts")
    for name, part in (("first", days <= 10), ("last", days > 20), ("late", (days > 10) & (days <= 20))):
        for _run in range(2):
            state.merge(rows.where(part), name)
    others = state.last_other("ts", "purchase")
    joined = state.latest().join(others, "user_id", "left")
    return joined.select("user_id", "event_id", "event_type", "last_other")
