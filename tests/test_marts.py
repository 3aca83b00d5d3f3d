"""Marts on hand-made rows: the cases the derived tables do not reach."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.operators.taxonomy import repair_taxonomy
from ledgerloom.plans import orders, processes
from ledgerloom.plans.market import Market

LEVELS = [f"cat{k}" for k in range(1, 6)]


@pytest.mark.parametrize(
    "given, repaired",
    [
        ([None, "a", "b", "c", "d"], ["a", "b", "c", "d", None]),
        (["a", "b", "b", "c", "d"], ["a", "b", "c", "d", None]),
        (["a", "b", "c", "c", "d"], ["a", "b", "c", "d", None]),
        (["a", "b", None, "c", "d"], ["a", "b", "c", "d", None]),
        (["a", "b", "c", None, "d"], ["a", "b", "c", "d", None]),
        (["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e"]),
        (["a", "b", None, None, None], ["a", "b", None, None, None]),
        (
            [" Товары для дома и сада", "x", "Смесители", "y", None],
            ["Сантехника", "Смесители", "y", None, None],
        ),
        (
            ["x", "Бытовая техника", "Холодильники", "y", None],
            ["Бытовая техника", "Крупная бытовая техника", "Холодильники", "y", None],
        ),
        (
            ["x", "Бытовая техника", "Техника по уходу за собой", None, None],
            ["Бытовая техника", "Техника по уходу за собой", None, None, None],
        ),
        (["x", "Бытовая техника", "z", None, None], ["Бытовая техника", None, "z", None, None]),
        (
            ["x", "y", "z", "Видеорегистраторы", "w"],
            ["Автотовары", "Автоэлектроника", "Видеорегистраторы", "w", None],
        ),
        (["x", "y", "Мониторы", None, None], ["Ноутбуки и компьютеры", "Периферия", "Мониторы", None, None]),
    ],
)
def test_taxonomy(spark, given, repaired):
    df = spark.createDataFrame([given], ", ".join(f"{c} string" for c in LEVELS))
    assert list(repair_taxonomy(df, LEVELS).first()) == repaired


HISTORY = """
    row_id int, uid string, scope string, status string, paid boolean, pay_types string, pay_title string,
    pay_types_code string, common_price int, common_old_price int, updated_on timestamp_ntz,
    created_on timestamp_ntz, cancelled_reason string, bank_status string, user_mobile string, user_name string,
    promocode_name string, common_discount_size string, user_city string
"""


def history(spark, *statuses, uid="1", title="Кредит на 6 месяцев", kind="EXPRESS"):
    rows = [
        (
            i,
            uid,
            "market",
            status,
            status != "new",
            kind,
            title,
            None,
            100,
            None,
            datetime(2024, 1, 1 + i, 10),
            datetime(2024, 1, 1, 9),
            "CLIENT.DECLINE",
            None,
            "8 701 1112233",
            "Client",
            None,
            None,
            "city",
        )
        for i, status in enumerate(statuses)
    ]
    return spark.createDataFrame(rows, HISTORY)


def packages(spark, *lines):
    return spark.createDataFrame(
        lines or [("1", "m", "shop", "p", "s", 100, 1, "item")],
        "uid string, product_merchant_id string, sender_title string, product_id string, sku_id string, "
        "sku_price int, sku_amount int, product_name string",
    )


def test_several_matching_lines_keep_one_timeline(spark):
    lines = [("1", "m", "shop", p, "s", 50, 2, "item") for p in ("p1", "p2")]
    lines.append(("1", "m2", "shop2", "p3", "s", 100, 1, "item"))
    lines.append(("1", "m3", "shop3", "p4", "s", 99, 1, "item"))
    funnel = orders.credit_orders(
        history(spark, "new", "pending_approve", "delivered"), packages(spark, *lines), Market(), "row_id"
    )
    found = sorted(tuple(r)[2:4] + (r["status_1"], r["status_2"], r["status_3"]) for r in funnel.collect())
    slots = ("new", "pending_approve", "delivered")
    assert found == [("shop", "m", *slots), ("shop2", "m2", *slots)]


def repriced(spark, *rows):
    """One order: (status, paid, price) in order of time; every price has a line."""
    df = history(spark, *[status for status, _, _ in rows])
    price = F.element_at(F.array(*[F.lit(p) for _, _, p in rows]), F.col("row_id") + 1)
    paid = F.element_at(F.array(*[F.lit(p) for _, p, _ in rows]), F.col("row_id") + 1)
    return df.withColumns({"common_price": price, "paid": paid})


def lines_of(spark, *prices):
    schema = "uid string, product_merchant_id string, sender_title string, sku_price int, sku_amount int"
    return spark.createDataFrame([("1", "m", "s", p, 1) for p in prices], schema)


def test_statuses_are_numbered_over_all_prices(spark):
    given = repriced(spark, ("new", False, 100), ("on_delivery", True, 90), ("delivered", True, 100))
    funnel = orders.credit_orders(given, lines_of(spark, 100, 90), Market(), "row_id").collect()
    assert [(r.total, r.status_1, r.status_2, r.status_3, r.exclude_approve) for r in funnel] == [
        (100, "new", None, "delivered", 1)
    ]


def test_a_price_without_the_first_status_goes(spark):
    given = repriced(spark, ("new", False, 100), ("new", True, 90))
    market, lines = Market(), lines_of(spark, 100, 90)
    assert [r.total for r in orders.credit_orders(given, lines, market, "row_id").collect()] == [100]
    both = orders.passed_orders(given, lines, market, "2024-01-31", "row_id").collect()
    assert [r.total for r in both] in ([], [100])


def test_passed_order_that_was_cancelled(spark):
    mart = orders.passed_orders(
        history(spark, "new", "pending_approve", "cancelledbyclient"), packages(spark), Market(), "2024-01-31", "row_id"
    )
    row = mart.first()
    assert (row["status_2_ru"], row["status_3_ru"], row["cancelled_reason"]) == (
        fv.SUBMITTED,
        fv.REASON_CLIENT,
        fv.REASON_CLIENT,
    )
    assert row["state_1"] == fv.REASON_CLIENT
    assert row["accept_days"] is None and row["completed_total"] is None


def test_passed_order_that_went_on_after_a_cancel(spark):
    mart = orders.passed_orders(
        history(spark, "new", "cancelled", "pending_approve", "on_delivery", "delivered"),
        packages(spark),
        Market(),
        "2024-01-31",
        "row_id",
    )
    row = mart.first()
    assert (row["status_3_ru"], row["status_4_ru"]) == (fv.ACCEPTED, fv.COMPLETED)
    assert row["cancelled_reason"] is None and row["cancelled_day"] is None
    assert (row["accept_days"], row["complete_days"], row["completed_total"]) == (1, 1, 100)


def test_order_never_received_is_left_out(spark):
    mart = orders.passed_orders(history(spark, "new"), packages(spark), Market(), "2024-01-31", "row_id")
    assert mart.count() == 0


def test_abandoned_order_latest_by_time_not_by_text(spark):
    older = history(spark, "new", uid="1").withColumn("updated_on", F.lit(datetime(2024, 1, 30, 8)))
    newer = history(spark, "new", uid="2").withColumns(
        {"updated_on": F.lit(datetime(2024, 2, 1, 8)), "created_on": F.lit(datetime(2024, 2, 1, 7))}
    )
    lines = packages(
        spark, ("1", "m", "shop", "p", "s", 1, 1, "old"), ("2", "m", "shop", "p", "s", 1, 1, "new item")
    )
    both = older.unionByName(newer)
    found = orders.abandoned_orders(both, lines, Market(), datetime(2024, 2, 1, 12), "row_id").collect()
    assert [(r["uid"], r["phone"], r["product_name"]) for r in found] == [("2", "77011112233", "new item")]
    late = orders.abandoned_orders(both, lines, Market(), datetime(2024, 2, 1, 8), "row_id")
    assert late.count() == 0


def test_period_mismatch(spark):
    now = datetime(2024, 1, 1, 12)
    requests = spark.createDataFrame(
        [
            ("p", "1", datetime(2024, 1, 1, 11), '{"person_info": {"financing_info": {"period": 12}}}'),
            ("p", "1", datetime(2024, 1, 1, 11), '{"person_info": {"financing_info": {"period": 6}}}'),
            ("p", "1", datetime(2024, 1, 1, 11), '{"person_info": {"financing_info": {}}}'),
            ("p", "1", datetime(2023, 12, 31), '{"person_info": {"financing_info": {"period": 12}}}'),
        ],
        "profile_id string, order_id string, created_on timestamp_ntz, loan_request string",
    )
    alerts = orders.period_mismatch_alerts(requests, history(spark, "new"), now).collect()
    assert sorted((r["asked"] or 0, r["shown"]) for r in alerts) == [(0, 6), (12, 6)]
    assert "months in request: 12, months in orders: 6" in {r["message"].split("profile_id: p, ")[1] for r in alerts}


def test_process_rows_without_partner(spark):
    tasks = spark.createDataFrame(
        [
            ("s1", "check", "A", "true", "2024-01-02 00:00:00", "P1"),
            ("s2", "sign", "A", "true", "1704240000000", "P1"),
            ("s3", "wait", "A", "false", None, "P1"),
            ("s4", "lost", "B", "false", None, "P9"),
            ("s5", "lost", "B", "false", None, "P8"),
        ],
        "step_id string, all_step string, application_num string, completed string, date_end_t string, proc_def_id_ string",
    ).selectExpr(
        "*", "'due' AS due_dtime", "'made' AS create_dtime", "'bob' AS user_state", "step_id AS activity_inst_id"
    )
    instances = spark.sql(
        """SELECT * FROM VALUES ('A', '2024-01-01', 'p', 'P1', 'd', 'e', 'ann', 'true'),
        ('C', '2024-01-03', 'p', 'P2', 'd', 'e', 'ann', 'false')
        AS v(application_num, start_dtime, process_name, proc_inst_id_, proc_def_id_, end_dtime, init_username, state)"""
    )
    people = spark.sql(
        """SELECT username, username AS fullname, 'n' AS employeenumber, 'x' AS position_code, 'x' AS position_name,
        'x' AS specialization_code, 'x' AS specialization_name, 'x' AS department_code, 'x' AS department_name,
        'x' AS branch_code, 'x' AS branch_name FROM VALUES ('ann'), ('bob') AS v(username)"""
    )
    incidents = spark.createDataFrame([], "proc_inst_id_ string, incident_msg_ string, incident_timestamp_ string")
    executions = spark.createDataFrame([], "id_ string, root_proc_inst_id_ string")
    flow = processes.process_flow(tasks, instances, people, incidents, executions)
    flow = processes.newest_first(flow).collect()
    shown = [(r["proc_inst_id_"], r["task_name"], r["state"], r["completed_state"], r["curr_fullname"]) for r in flow]
    # No start date comes first, then newest first; the two lost tasks look alike and show once.
    assert shown == [
        (None, "lost", None, None, "bob"),
        ("P2", None, "ACTIVE", None, None),
        ("P1", "wait", "COMPLETED", "sign", "bob"),
    ]
    steps = processes.process_steps(tasks, instances, people, incidents, executions).collect()
    assert sorted((r["proc_inst_id_"] or "", r["step_id"] or "") for r in steps) == [
        ("", ""),
        ("P1", "s1"),
        ("P1", "s2"),
        ("P1", "s3"),
        ("P2", ""),
    ]
