"""Status timelines: ordered statuses per key, cancels that were resumed,
funnel ladders, stage dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.functions.rules import multi_col_rules, value_map
from ledgerloom.functions.status import is_cancel, progress_label
from ledgerloom.functions.text import level
from ledgerloom.functions.times import Moment, date_literal, days_between
from ledgerloom.operators.latest import first_per_key

SLOTS = 7


def ordered_statuses(number: Column, status: Column) -> Column:
    """Aggregate: statuses of a group as an array ordered by their number."""
    pairs = F.array_sort(F.collect_list(F.struct(number.alias("n"), status.alias("s"))))
    return F.transform(pairs, lambda pair: pair["s"])


def numbered_statuses(number: Column, status: Column) -> Column:
    """Aggregate: statuses of a group in the places of their numbers, from 1 to
    the greatest; numbers that are not in the group leave a NULL. Of equal
    numbers the greatest status counts."""
    pairs = F.collect_set(F.struct(number.alias("n"), status.alias("s")))
    named = lambda i: F.filter(pairs, lambda pair: pair["n"] == i)
    return F.transform(F.sequence(F.lit(1), F.max(number)), lambda i: F.array_max(F.transform(named(i), lambda p: p["s"])))


def status_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    status: str,
    count: int,
    into: str = "statuses",
) -> DataFrame:
    """First ``count`` statuses of each key, in order, as an array."""
    first = first_per_key(df, keys, order, count, "_n")
    return first.groupBy(*keys).agg(ordered_statuses(F.col("_n"), F.col(status)).alias(into))


def drop_first_resumed_cancel(statuses: Column, last_position: Column | int = 5) -> Column:
    """Remove the first cancel in positions 2..last whose next position holds a status."""
    resumed = F.filter(
        F.sequence(F.lit(2), F.lit(last_position) if isinstance(last_position, int) else last_position),
        lambda i: F.get(statuses, i).isNotNull() & is_cancel(F.get(statuses, i - 1)),
    )
    gap = F.get(resumed, F.lit(0))
    closed = F.filter(statuses, lambda _, i: i != gap - 1)
    return F.when(gap.isNull(), statuses).otherwise(closed)


def with_created_first(statuses: Column) -> Column:
    """Timelines that open with an approval get the missing ``new`` in front."""
    opened = F.get(statuses, F.lit(0)) == "pending_approve"
    closed = drop_first_resumed_cancel(statuses, F.when(opened, F.lit(4)).otherwise(F.lit(5)))
    return F.when(opened, F.concat(F.array(F.lit("new")), closed)).otherwise(closed)


def slots(array: Column, prefix: str, count: int) -> list[Column]:
    """Array elements 1..count as columns ``prefix1..prefixN``."""
    return [level(array, k).alias(f"{prefix}{k}") for k in range(1, count + 1)]


def excluded_from_funnel(statuses: Column, closed: Column) -> Column:
    """1 when there is no second status, or the second one left is a plain,
    timeout or client cancel; bank and merchant cancels stay in."""
    second = level(closed, 2)
    return F.when(
        level(statuses, 2).isNull() | second.isin(*fv.EXCLUDED_SECOND_STATUSES), F.lit(1)
    )


def funnel_label(status: Column) -> Column:
    return F.when(is_cancel(status), fv.FUNNEL_CANCELLED).otherwise(
        value_map(status, fv.FUNNEL_STATUSES)
    )


def credit_ladder(labels: Sequence[Column]) -> list[Column]:
    """Five funnel labels with the skipped steps put back: a signed contract in
    third place means the form was filled, a completion there means the
    contract was signed and everything after moves down one place."""
    one, two, three, four, five = labels
    done = F.coalesce(three == fv.FUNNEL_COMPLETED, F.lit(False))
    return [
        one,
        F.when(three == fv.FUNNEL_SIGNED, fv.FUNNEL_FORM_FILLED).otherwise(two),
        F.when(done, fv.FUNNEL_SIGNED).otherwise(three),
        F.when(done, fv.FUNNEL_COMPLETED).otherwise(four),
        F.when(done, four).otherwise(five),
    ]


def stage_labels(closed: Column, reason: Column, count: int = 5) -> list[Column]:
    """Stage label of slots 1..count: the first is always "created", a cancel in
    last place shows its reason, any other cancel has no label."""
    labels = [F.lit(fv.CREATED)]
    for k in range(2, count + 1):
        status = level(closed, k)
        last = F.size(closed) == k
        labels.append(F.when(is_cancel(status), F.when(last, reason)).otherwise(progress_label(status)))
    return labels


def order_ladder(labels: Sequence[Column]) -> list[Column]:
    """Five stage labels with "submitted" fixed in second place: an acceptance
    found there moves the rest down, a completion in third place gets the
    acceptance it implies in front of it."""
    one, two, three, four, five = labels
    early = F.coalesce(two == fv.ACCEPTED, F.lit(False))
    skipped = F.coalesce(three == fv.COMPLETED, F.lit(False))
    return [
        one,
        F.lit(fv.SUBMITTED),
        F.when(early, two).when(skipped, fv.ACCEPTED).otherwise(three),
        F.when(early | skipped, three).otherwise(four),
        F.when(early | skipped, four).otherwise(five),
    ]


def latest_date_per_label(
    label: Column, day: Column, names: Mapping[str, str]
) -> list[Column]:
    """Aggregates: latest day seen under each label, ``{label: column}``."""
    return [F.max(F.when(label == text, day)).alias(name) for text, name in names.items()]


STAGE_DATES = {
    fv.CREATED: "created_day",
    fv.SUBMITTED: "received_day",
    fv.ACCEPTED: "accepted_day",
    fv.COMPLETED: "completed_day",
    fv.RETURNED: "returned_day",
    fv.CANCELLED: "cancelled_day",
}


def fill_stage_dates(df: DataFrame, first_status: Column) -> DataFrame:
    """Back-fill received and accepted days from the stages after them."""
    received, accepted = F.col("received_day"), F.col("accepted_day")
    created, completed = F.col("created_day"), F.col("completed_day")
    opened = first_status == "pending_approve"
    return df.withColumns(
        {
            "received_day": multi_col_rules(
                [
                    (received.isNull() & accepted.isNotNull(), accepted),
                    (opened & received.isNull(), created),
                    (accepted.isNull() & completed.isNotNull(), completed),
                ],
                received,
            ),
            "accepted_day": F.coalesce(accepted, completed),
        }
    )


def stage_durations(df: DataFrame, as_of: Moment) -> DataFrame:
    """Days from received to accepted and from accepted to completed. A stage
    still open ends at ``as_of``, unless the order was cancelled."""
    open_end = F.when(F.col("cancelled_day").isNull(), date_literal(as_of))
    accepted = F.coalesce(F.col("accepted_day"), open_end)
    completed = F.coalesce(F.col("completed_day"), open_end)
    return df.withColumns(
        {
            "accept_days": days_between(accepted, F.col("received_day")),
            "complete_days": days_between(completed, accepted),
        }
    )
