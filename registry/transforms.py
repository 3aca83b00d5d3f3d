"""Status timelines and taxonomy repair on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.status import (
    Lender,
    cancel_reason,
    progress_description,
    progress_label,
    return_description,
    stage_of,
    terminal_description,
)
from ledgerloom.functions.text import level
from ledgerloom.operators import timeline
from ledgerloom.operators.taxonomy import (
    CATALOGUE_STEPS,
    Collapse,
    Override,
    apply_steps,
    close_gaps,
    repair_taxonomy,
)
from ledgerloom.plans.orders import category_titles
from registry.core import Tables, query
from registry.fragments import KINDS, PLACE, REASON, STAGE, WHEREABOUTS

# Oracle side: first seven statuses numbered, the gap found by comparing
# numbers, later rows renumbered.
NUMBERED = """
    numbered AS (
        SELECT uid, status, row_number() OVER (PARTITION BY uid ORDER BY updated_on, row_id) AS n
        FROM order_history QUALIFY n <= 7
    ), spans AS (
        SELECT uid, max(n) AS size, min(status) FILTER (n = 1) AS opened,
            string_agg(status, '>' ORDER BY n) AS path
        FROM numbered GROUP BY uid
    )
"""
SEVEN = ", ".join(f"max(status) FILTER (m = {k}) AS s{k}" for k in range(1, 6))


def _sequences(t: Tables):
    history = t.order_history.select("uid", "status", "updated_on", "row_id")
    order = [F.col("updated_on").asc(), F.col("row_id").asc()]
    return timeline.status_sequence(history, ["uid"], order, "status", timeline.SLOTS)


@query(
    "status_gap_removed",
    f"""
    WITH {NUMBERED}, gaps AS (
        SELECT s.uid, min(n.n) AS gap FROM spans s JOIN numbered n ON n.uid = s.uid
        WHERE n.n BETWEEN 2 AND 5 AND n.n < s.size AND contains(n.status, 'cancel') GROUP BY s.uid
    ), closed AS (
        SELECT n.uid, n.status, CASE WHEN n.n > g.gap THEN n.n - 1 ELSE n.n END AS m
        FROM numbered n LEFT JOIN gaps g ON g.uid = n.uid WHERE n.n IS DISTINCT FROM g.gap
    )
    SELECT uid, {SEVEN} FROM closed GROUP BY uid
    """,
)
def _(t: Tables):
    closed = _sequences(t).select(
        "uid", timeline.drop_first_resumed_cancel(F.col("statuses")).alias("closed")
    )
    return closed.select("uid", *timeline.slots(F.col("closed"), "s", 5))


@query(
    "status_gap_removed_created",
    f"""
    WITH {NUMBERED}, gaps AS (
        SELECT s.uid, min(n.n) AS gap FROM spans s JOIN numbered n ON n.uid = s.uid
        WHERE n.n BETWEEN 2 AND CASE s.opened WHEN 'pending_approve' THEN 4 ELSE 5 END
            AND n.n < s.size AND contains(n.status, 'cancel') GROUP BY s.uid
    ), closed AS (
        SELECT n.uid, n.status, n.n - cast(coalesce(n.n > g.gap, false) AS INT)
            + cast(s.opened = 'pending_approve' AS INT) AS m
        FROM numbered n JOIN spans s ON s.uid = n.uid LEFT JOIN gaps g ON g.uid = n.uid
        WHERE n.n IS DISTINCT FROM g.gap
        UNION ALL SELECT uid, 'new', 1 FROM spans WHERE opened = 'pending_approve'
    )
    SELECT uid, {SEVEN} FROM closed GROUP BY uid
    """,
)
def _(t: Tables):
    closed = _sequences(t).select("uid", timeline.with_created_first(F.col("statuses")).alias("closed"))
    return closed.select("uid", *timeline.slots(F.col("closed"), "s", 5))


@query(
    "funnel_exclusion",
    f"""
    WITH {NUMBERED}
    SELECT uid, CASE WHEN size = 1
            OR regexp_matches(path, '^[^>]+>(cancelled|cancelledbyclient|cancelledbytimeout)$')
            OR regexp_matches(path, '^[^>]+>[^>]*cancel[^>]*>(cancelled|cancelledbyclient|cancelledbytimeout)(>|$)')
        THEN 1 END AS exclude_approve
    FROM spans
    """,
)
def _(t: Tables):
    statuses = F.col("statuses")
    closed = timeline.drop_first_resumed_cancel(statuses)
    return _sequences(t).select("uid", timeline.excluded_from_funnel(statuses, closed).alias("exclude_approve"))


@query(
    "stage_ladder",
    f"""
    WITH {KINDS}, {NUMBERED}, gaps AS (
        SELECT s.uid, min(n.n) AS gap FROM spans s JOIN numbered n ON n.uid = s.uid
        WHERE n.n BETWEEN 2 AND 5 AND n.n < s.size AND contains(n.status, 'cancel') GROUP BY s.uid
    ), labelled AS (
        SELECT n.uid, CASE WHEN n.n > g.gap THEN n.n - 1 ELSE n.n END AS m, coalesce(funnel, 'отменен') AS label
        FROM numbered n LEFT JOIN gaps g ON g.uid = n.uid LEFT JOIN kinds ON kind = status
        WHERE n.n IS DISTINCT FROM g.gap
    ), five AS (
        SELECT uid, list_resize(list(label ORDER BY m)[1:5], 5, NULL) AS l FROM labelled GROUP BY uid
    ), laddered AS (
        SELECT uid, CASE WHEN l[3] = 'договор подписан' THEN list_concat([l[1], 'анкета заполнена'], l[3:5])
            WHEN l[3] = 'завершен' THEN list_concat(l[1:2], ['договор подписан', 'завершен', l[4]]) ELSE l END AS l FROM five
    )
    SELECT uid, l[1] AS status_1, l[2] AS status_2, l[3] AS status_3, l[4] AS status_4, l[5] AS status_5 FROM laddered
    """,
)
def _(t: Tables):
    closed = _sequences(t).withColumn("closed", timeline.drop_first_resumed_cancel(F.col("statuses")))
    labels = [timeline.funnel_label(level(F.col("closed"), k)) for k in range(1, 6)]
    ladder = timeline.credit_ladder(labels)
    return closed.select("uid", *[label.alias(f"status_{k}") for k, label in enumerate(ladder, 1)])


def _staged_history(t: Tables):
    status = F.col("status")
    stage = stage_of(status, F.col("paid"), F.col("pay_types"))
    return t.order_history.withColumns(
        {
            "stage": stage,
            "reason": cancel_reason(stage, status, F.col("cancelled_reason"), F.col("bank_status")),
            "day": F.to_date("updated_on"),
        }
    )


@query(
    "stage_durations",
    f"""
    WITH {KINDS}, staged AS (
        SELECT uid, updated_on, row_id, status, cast(updated_on AS DATE) AS day, {STAGE} AS stage
        FROM order_history LEFT JOIN kinds ON kind = status
    ), days AS (
        SELECT uid, arg_min(status, (updated_on, row_id)) AS opened,
            max(day) FILTER (stage = 'создано') AS created, max(day) FILTER (stage = 'оформлено') AS received,
            max(day) FILTER (stage = 'принято') AS accepted, max(day) FILTER (stage = 'завершено') AS completed,
            max(day) FILTER (stage = 'отменено') AS cancelled
        FROM staged GROUP BY uid
    ), filled AS (
        SELECT uid, CASE WHEN received IS NULL AND accepted IS NOT NULL THEN accepted
                WHEN received IS NULL AND opened = 'pending_approve' THEN created
                WHEN accepted IS NULL THEN coalesce(completed, received) ELSE received END AS received,
            coalesce(accepted, completed) AS accepted, completed,
            CASE WHEN cancelled IS NULL THEN DATE '2024-01-31' END AS open_end
        FROM days
    )
    SELECT uid, strftime(received, '%Y-%m-%d') AS received_day, strftime(accepted, '%Y-%m-%d') AS accepted_day,
        cast(date_diff('day', received, coalesce(accepted, open_end)) AS INT) AS accept_days,
        cast(date_diff('day', coalesce(accepted, open_end), coalesce(completed, open_end)) AS INT) AS complete_days
    FROM filled
    """,
)
def _(t: Tables):
    rows = _staged_history(t)
    days = rows.groupBy("uid").agg(
        F.min(F.struct("updated_on", "row_id", "status")).alias("first"),
        *timeline.latest_date_per_label(F.col("stage"), F.col("day"), timeline.STAGE_DATES),
    )
    filled = timeline.fill_stage_dates(days, F.col("first.status"))
    return timeline.stage_durations(filled, "2024-01-31").select(
        "uid", "received_day", "accepted_day", "accept_days", "complete_days"
    )


@query(
    "terminal_description",
    f"""
    WITH {KINDS}, {WHEREABOUTS}, {NUMBERED}, reasons AS (
        SELECT uid, max({REASON}) FILTER (contains(status, 'cancel')) AS reason FROM order_history GROUP BY uid
    ), slots AS (
        SELECT p.uid, r.reason, s[2] AS s2, s[3] AS s3, s[4] AS s4, s[5] AS s5, k.progress AS label3
        FROM (SELECT uid, string_split(path, '>') AS s FROM spans) p JOIN reasons r ON r.uid = p.uid
        LEFT JOIN kinds k ON k.kind = s[3]
    )
    SELECT uid,
        coalesce({PLACE}, CASE WHEN s2 = 'pending_approve' THEN 'одобрено' END) AS state_1,
        CASE WHEN contains(s4, 'cancel') THEN reason WHEN s4 = 'taken' OR s3 = 'taken' THEN 'выдан'
            WHEN s4 = 'delivered' OR s3 = 'delivered' THEN 'доставлен' END AS state_2,
        CASE WHEN s4 = 'returned' OR s5 = 'returned' THEN 'возвращен' END AS state_3
    FROM slots
    """,
)
def _(t: Tables):
    lender = Lender()
    reasons = _staged_history(t).groupBy("uid").agg(F.max("reason").alias("reason"))
    rows = _sequences(t).join(reasons, "uid").select(
        "uid", "reason", *timeline.slots(F.col("statuses"), "s", 5)
    )
    label3 = progress_label(F.col("s3"))
    s2, s3, s4, s5, reason = (F.col(c) for c in ("s2", "s3", "s4", "s5", "reason"))
    return rows.select(
        "uid",
        progress_description(s2, s3, s4, label3, reason, F.lit(lender.title), lender).alias("state_1"),
        terminal_description(s3, s4, label3, reason).alias("state_2"),
        return_description(s4, s5).alias("state_3"),
    )


ANALOG_STEPS = (
    Override({2: "Бытовая техника", 3: "Холодильники"}, {1: "Бытовая техника", 2: "Крупная бытовая техника"}),
    Override({2: "Бытовая техника"}, {1: "Бытовая техника", 2: None}),
    Collapse(3),
    Collapse(4),
    Override({3: "Мониторы"}, {2: "Периферия"}),
)
PATHS = """
    paths AS (
        SELECT DISTINCT categories_array, string_split(trim(categories_array, '{}'), ',') AS ids FROM nomenclature
    ), titles AS (
        SELECT categories_array, t1.title AS t1, t2.title AS t2, t3.title AS t3, t4.title AS t4, t5.title AS t5
        FROM paths
        LEFT JOIN categories t1 ON t1.id = ids[1] LEFT JOIN categories t2 ON t2.id = ids[2]
        LEFT JOIN categories t3 ON t3.id = ids[3] LEFT JOIN categories t4 ON t4.id = ids[4]
        LEFT JOIN categories t5 ON t5.id = ids[5]
    )
"""


@query(
    "repair_taxonomy",
    f"""
    WITH {PATHS}, typed AS (
        SELECT *, CASE WHEN t1 IS NULL AND t2 IS NOT NULL THEN 'headless'
            WHEN t2 = 'Бытовая техника' AND t3 = 'Холодильники' THEN 'fridge'
            WHEN t2 = 'Бытовая техника' THEN 'appliance' ELSE 'plain' END AS kind,
            coalesce(t2 = t3, false) AS same23, coalesce(t3 = t4, false) AS same34 FROM titles
    ), repaired AS (
        SELECT categories_array, CASE kind
            WHEN 'headless' THEN [t2, t3, t4, t5, NULL]
            ELSE list_concat(
                CASE kind WHEN 'fridge' THEN ['Бытовая техника', 'Крупная бытовая техника']
                    WHEN 'appliance' THEN ['Бытовая техника', NULL]
                    ELSE [t1, CASE WHEN t3 = 'Мониторы' THEN 'Периферия' ELSE t2 END] END,
                CASE WHEN same23 THEN [t4, t5, NULL] WHEN same34 THEN [t3, t5, NULL] ELSE [t3, t4, t5] END) END AS c
        FROM typed
    ), closed AS (
        SELECT categories_array, CASE
            WHEN c[2] = c[3] OR (c[3] IS NULL AND c[4] IS NOT NULL) THEN [c[1], c[2], c[4], c[5], NULL]
            WHEN c[4] IS NULL AND c[5] IS NOT NULL THEN [c[1], c[2], c[3], c[5], NULL] ELSE c END AS c
        FROM repaired
    )
    SELECT categories_array, c[1] AS cat1, c[2] AS cat2, c[3] AS cat3, c[4] AS cat4, c[5] AS cat5 FROM closed
    """,
)
def _(t: Tables):
    titles = category_titles(t.nomenclature, t.categories, 5)
    return repair_taxonomy(titles, [f"cat{k}" for k in range(1, 6)], ANALOG_STEPS)


@query(
    "taxonomy_gaps",
    f"""
    WITH {PATHS}
    SELECT categories_array, t1 AS cat1, t2 AS cat2, c[1] AS cat3, c[2] AS cat4, c[3] AS cat5 FROM (
        SELECT *, CASE WHEN t2 = t3 OR (t3 IS NULL AND t4 IS NOT NULL) THEN [t4, t5, NULL]
            WHEN t4 IS NULL AND t5 IS NOT NULL THEN [t3, t5, NULL] ELSE [t3, t4, t5] END AS c FROM titles)
    """,
)
def _(t: Tables):
    return close_gaps(category_titles(t.nomenclature, t.categories, 5), [f"cat{k}" for k in range(1, 6)])


@query(
    "taxonomy_catalogue_steps",
    f"""
    WITH {PATHS}, first_hit AS (
        SELECT *, t1 IS NULL AND t2 IS NOT NULL AS headless, coalesce(t2 = t3, false) AS same23,
            coalesce(t3 = t4, false) AS same34,
            coalesce(t2, '') AS b, coalesce(t3, '') AS c, coalesce(t4, '') AS d FROM titles
    )
    SELECT categories_array,
        CASE WHEN headless THEN t2 WHEN b = 'Бытовая техника' THEN b WHEN b = 'Музыкальные инструменты' THEN 'Досуг'
            WHEN d = 'Видеорегистраторы' THEN 'Автотовары' WHEN c = 'Мониторы' THEN 'Ноутбуки и компьютеры' ELSE t1 END AS cat1,
        CASE WHEN headless THEN t3
            WHEN b = 'Бытовая техника' THEN CASE WHEN c = 'Холодильники' THEN 'Крупная бытовая техника' END
            WHEN d = 'Видеорегистраторы' THEN 'Автоэлектроника' WHEN c = 'Мониторы' THEN 'Периферия' ELSE t2 END AS cat2,
        CASE WHEN headless OR same23 THEN t4 WHEN d = 'Видеорегистраторы' THEN d ELSE t3 END AS cat3,
        CASE WHEN headless OR same23 THEN t5 WHEN d = 'Видеорегистраторы' THEN NULL WHEN same34 THEN t5 ELSE t4 END AS cat4,
        CASE WHEN headless OR same23 OR same34 THEN NULL ELSE t5 END AS cat5
    FROM first_hit
    """,
)
def _(t: Tables):
    titles = category_titles(t.nomenclature, t.categories, 5)
    return apply_steps(titles, [f"cat{k}" for k in range(1, 6)], CATALOGUE_STEPS)
