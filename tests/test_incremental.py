"""State tables kept up by batches, against results over the whole history."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import incremental
from ledgerloom.operators.incremental import DistinctDays, LatestState
from ledgerloom.operators.joins import anti_later_event
from ledgerloom.operators.latest import latest_per_key
from ledgerloom.sinks import snapshots


def order():
    return [F.col("at").desc(), F.col("id").desc()]



@pytest.fixture(scope="module")
def history(spark):
    """Orders with a hot one, null keys and times, late rows."""
    return spark.range(0, 3000, 1, 6).select(
        "id",
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 17 == 0, None).otherwise(F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 13 > 0, F.col("id") * 7919 % 1000).alias("at"),
        F.element_at(F.array(*[F.lit(s) for s in ("new", "seen", "done")]), (F.col("id") % 7 % 3 + 1).cast("int")).alias("status"),
    )


def state_of(spark, path, buckets=8):
    return LatestState(spark, str(path / "state"), ["k"], "status", order(), buckets)


def batches(history):
    """Three batches by time, the middle one last; rows without a time come first."""
    at = F.coalesce("at", F.lit(-1))
    return {"early": history.where(at < 300), "new": history.where(at >= 700), "late": history.where((at >= 300) & (at < 700))}


def test_three_batches_equal_the_whole_history(spark, history, tmp_path, bag):
    state = state_of(spark, tmp_path)
    for name, rows in batches(history).items():
        state.merge(rows, name)
    assert bag(state.latest().select(*history.columns)) == bag(latest_per_key(history, ["k"], order()))
    assert bag(state.rows().select(*history.columns)) == bag(latest_per_key(history, ["k", "status"], order()))
    last = history.where("status <> 'new'").groupBy("k").agg(F.max("at"))
    assert bag(state.last_other("at", "new")) == bag(last)
    asked = history.where("status = 'new' AND id % 5 = 0")
    assert bag(state.without_later(asked, "at", "new")) == bag(anti_later_event(asked, history, "k", "at", "status", "new"))


def test_a_batch_counts_once_and_rewrites_its_buckets_only(spark, history, tmp_path):
    state = state_of(spark, tmp_path)
    assert state.merge(history.where("k <> 5"), "a") == 1
    before = {e["slice"]: e["folder"] for e in snapshots.manifest(spark, state.target)["entries"]}
    assert state.merge(history, "a") == 1
    one = history.where("k = 5")
    assert state.merge(one, "b") == state.merge(one, "b") == 2
    after = {e["slice"]: e["folder"] for e in snapshots.manifest(spark, state.target)["entries"]}
    assert sum(after[s] != before.get(s) for s in after) == 1


def test_writers_at_once_lose_nothing(spark, history, tmp_path, monkeypatch, bag):
    """Another batch is merged into the same buckets between the first one's read and its commit."""
    state, parts = state_of(spark, tmp_path, 2), batches(history)
    state.merge(parts["early"], "early")
    replace, raced = snapshots.replace_slices, []

    def late(*a, **b):
        if not raced:
            raced.append(1)
            state_of(spark, tmp_path, 2).merge(parts["late"], "late")
        return replace(*a, **b)

    monkeypatch.setattr(incremental.snapshots, "replace_slices", late)
    state.merge(parts["new"], "new")
    assert bag(state.latest().select(*history.columns)) == bag(latest_per_key(history, ["k"], order()))


def test_a_failing_batch_leaves_the_state(spark, history, tmp_path, bag):
    state = state_of(spark, tmp_path)
    state.merge(history.where("at < 500"), "a")
    before = bag(state.rows())
    bad = history.withColumn("id", F.when(F.col("id") > 2000, F.raise_error(F.lit("no good")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no good"):
        state.merge(bad, "b")
    assert bag(state.rows()) == before
    state.merge(history.where("at >= 500"), "b")
    assert bag(state.latest().select(*history.columns)) == bag(latest_per_key(history.where("at IS NOT NULL"), ["k"], order()))


DAY = date(2024, 1, 1)


@pytest.fixture(scope="module")
def visits(spark):
    day = F.date_add(F.lit(DAY), (F.col("id") % 10).cast("int"))
    who = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 19 > 0, F.concat(F.lit("u"), (F.col("id") * 31 % 400).cast("string")))
    return spark.range(4000).select(day.alias("day"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g"), who.alias("who"))


def plain(visits, first, last):
    return visits.where(F.col("day").between(first, last)).where("who IS NOT NULL").groupBy("g").agg(F.count_distinct("who").alias("n"))


def test_ranges_of_days(spark, visits, tmp_path, bag):
    days = DistinctDays(spark, str(tmp_path / "d"), ["g"], "who")
    days.put(visits.where(F.col("day") < DAY + timedelta(4)), "day")
    days.put(visits.where(F.col("day") >= DAY + timedelta(3)), "day")
    for first, last in ((0, 9), (2, 5), (7, 7), (20, 30)):
        span = DAY + timedelta(first), DAY + timedelta(last)
        assert bag(days.counts(*span, "n")) == bag(plain(visits, *span))
    # Days that come again with other rows are replaced; numbers stay.
    again = visits.where((F.col("day") == DAY) & (F.col("g") == 2)).withColumn("who", F.concat(F.lit("x"), "who"))
    days.put(again, "day")
    both = visits.where(F.col("day") > DAY).unionByName(again)
    assert bag(days.counts(DAY, DAY + timedelta(9), "n")) == bag(plain(both, DAY, DAY + timedelta(9)))
    days.put(again.where("false"), "day", [DAY])
    assert days.counts(DAY, DAY, "n").count() == 0


def test_numbers_are_given_once(spark, visits, tmp_path, monkeypatch):
    """Two deliveries number new values at the same time: one of them starts again."""
    days = DistinctDays(spark, str(tmp_path / "d"), ["g"], "who")
    append, raced = snapshots.append, []

    def late(*a, **b):
        if not raced:
            raced.append(1)
            DistinctDays(spark, str(tmp_path / "d"), ["g"], "who").put(visits.where("g = 2"), "day")
        return append(*a, **b)

    monkeypatch.setattr(incremental.snapshots, "append", late)
    days.put(visits, "day")
    numbers = snapshots.read_table(spark, days.numbers).collect()
    assert len({r.value for r in numbers}) == len({r.number for r in numbers}) == len(numbers) == visits.select("who").distinct().count() - 1
