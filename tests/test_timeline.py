"""Timeline rules over every short sequence, against the rule said in Python."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.functions.text import level
from ledgerloom.operators import timeline

CLASSES = ["new", "pending_approve", "on_delivery", "delivered", "cancelled"]


def close_gap(statuses, last):
    """Drop the first cancel in places 2..last that is not the final status."""
    for place in range(2, last + 1):
        if place < len(statuses) and "cancel" in statuses[place - 1]:
            return statuses[: place - 1] + statuses[place:]
    return statuses


@pytest.fixture(scope="module")
def sequences(spark):
    every = [list(s) for n in range(1, 7) for s in product(CLASSES, repeat=n)]
    extra = [list(s) for s in product(CLASSES[1:3] + CLASSES[4:], repeat=7)]
    return spark.createDataFrame([(s,) for s in every + extra], "statuses array<string>")


def test_gap_of_a_new_order(sequences, rows):
    closed = timeline.drop_first_resumed_cancel(F.col("statuses"))
    for statuses, result in rows(sequences.select("statuses", closed)):
        assert result == close_gap(statuses, 5)


def test_gap_of_an_order_without_created_row(sequences, rows):
    closed = timeline.with_created_first(F.col("statuses"))
    for statuses, result in rows(sequences.select("statuses", closed)):
        if statuses[0] == "pending_approve":
            assert result == ["new"] + close_gap(statuses, 4)
        else:
            assert result == close_gap(statuses, 5)


def test_no_resumed_cancel_is_left_when_there_was_one(sequences, rows):
    closed = timeline.drop_first_resumed_cancel(F.col("statuses"))
    for statuses, result in rows(sequences.select("statuses", closed)):
        if statuses[1:].count("cancelled") <= 1:
            assert "cancelled" not in result[1 : min(5, len(result) - 1)]


def test_exclusion(sequences, rows):
    statuses = F.col("statuses")
    flag = timeline.excluded_from_funnel(statuses, timeline.drop_first_resumed_cancel(statuses))
    for given, result in rows(sequences.select("statuses", flag)):
        left = close_gap(given, 5)
        expected = len(given) == 1 or left[1] == "cancelled"
        assert result == (1 if expected else None)


@pytest.mark.parametrize(
    "statuses, labels",
    [
        (["new"], ["создано", None, None, None, None]),
        (["new", "cancelled"], ["создано", "отменен", None, None, None]),
        (
            ["new", "pending_approve", "delivered"],
            ["создано", "анкета не заполнена", "договор подписан", "завершен", None],
        ),
        (
            ["new", "pending_approve", "delivered", "returned"],
            ["создано", "анкета не заполнена", "договор подписан", "завершен", "возврат"],
        ),
        (
            ["new", "pending_approve", "on_delivery", "taken"],
            ["создано", "анкета заполнена", "договор подписан", "завершен", None],
        ),
    ],
)
def test_credit_ladder(spark, statuses, labels):
    df = spark.createDataFrame([(statuses,)], "s array<string>")
    raw = [timeline.funnel_label(level(F.col("s"), k)) for k in range(1, 6)]
    assert list(df.select(*timeline.credit_ladder(raw)).first()) == labels


@pytest.mark.parametrize(
    "statuses, labels",
    [
        (["new", "on_delivery", "delivered"], ["создано", "оформлено", "принято", "завершено", None]),
        (["new", "pending_approve", "delivered"], ["создано", "оформлено", "принято", "завершено", None]),
        (["new", "pending_approve", "cancelled"], ["создано", "оформлено", "why", None, None]),
        (
            ["new", "pending_approve", "on_delivery", "delivered", "returned"],
            ["создано", "оформлено", "принято", "завершено", "возврат"],
        ),
    ],
)
def test_order_ladder(spark, statuses, labels):
    df = spark.createDataFrame([(statuses,)], "s array<string>")
    raw = timeline.stage_labels(F.col("s"), F.lit("why"))
    assert list(df.select(*timeline.order_ladder(raw)).first()) == labels


@pytest.mark.parametrize(
    "opened, days, received, accepted",
    [
        ("new", (None, None, "05", None), "05", "05"),
        ("pending_approve", ("01", None, None, None), "01", None),
        ("new", (None, "02", None, "09"), "09", "09"),
        ("new", (None, "02", "04", "09"), "02", "04"),
        ("new", (None, None, None, None), None, None),
    ],
)
def test_stage_dates(spark, opened, days, received, accepted):
    names = ["created_day", "received_day", "accepted_day", "completed_day"]
    df = spark.createDataFrame(
        [(opened, *[d and f"2024-01-{d}" for d in days])], "opened string, " + ", ".join(f"{n} string" for n in names)
    ).withColumns({n: F.to_date(n) for n in names})
    row = timeline.fill_stage_dates(df, F.col("opened")).first()
    shown = [row[n] and f"{row[n].day:02d}" for n in ("received_day", "accepted_day")]
    assert shown == [received, accepted]


def test_open_stages_end_at_as_of_unless_cancelled(spark, rows):
    df = spark.sql(
        """SELECT date'2024-01-10' AS received_day, cast(NULL AS date) AS accepted_day,
        cast(NULL AS date) AS completed_day, c AS cancelled_day
        FROM VALUES (cast(NULL AS date)), (date'2024-01-12') AS v(c)"""
    )
    timed = timeline.stage_durations(df, "2024-01-31").select("accept_days", "complete_days")
    assert rows(timed) == [(21, 0), (None, None)]


def test_statuses_past_the_seventh_are_ignored(spark):
    df = spark.createDataFrame([("o", i, f"s{i}") for i in range(1, 11)], "k string, t int, s string")
    found = timeline.status_sequence(df, ["k"], [F.col("t").asc()], "s", 7).first()
    assert found["statuses"] == [f"s{i}" for i in range(1, 8)]
    assert fv.SUBMITTED_STATUSES[0] == "new"


def test_long_timelines_keep_all_statuses(spark):
    statuses = ["new", "cancelled"] + [f"s{i}" for i in range(38)]
    df = spark.createDataFrame([(statuses,)], "statuses array<string>")
    closed = df.select(timeline.drop_first_resumed_cancel(F.col("statuses")).alias("c")).first()["c"]
    assert closed == ["new"] + statuses[2:]
