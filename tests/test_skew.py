"""Hot keys: a third of all rows share one key. Results against the plain forms."""

import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.operators.aggregates import conditional_distinct_counts, count_distinct_by
from ledgerloom.operators.joins import (
    anti_later_event,
    at_latest_completed,
    full_join_by_parts,
    left_join_by_parts,
)
from ledgerloom.operators.latest import latest_per_key, numbered_rows, sequence_number
from ledgerloom.operators.timeline import status_sequence


@pytest.fixture(scope="module")
def hot(spark):
    """Events with a hot user, NULL users, equal times."""
    user = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50)
    return spark.range(0, 6000, 1, 8).select(
        F.col("id").alias("event_id"),
        user.cast("long").alias("user_id"),
        (F.col("id") * 7919 % 1000).alias("minute"),
        F.element_at(F.array(*[F.lit(s) for s in ("new", "seen", "done")]), (F.col("id") % 7 % 3 + 1).cast("int")).alias(
            "status"
        ),
    )


def test_sequence_number_in_slices(hot, bag):
    order = [F.col("minute").asc(), F.col("event_id").asc()]
    plain = sequence_number(hot, ["user_id"], order, "n")
    sliced = sequence_number(hot, ["user_id"], order, "n", split_by=F.floor(F.col("minute") / 100))
    assert bag(sliced) == bag(plain)


def test_one_key_on_one_day_is_numbered_by_several_tasks(spark):
    """Slices are hours, so a user's day spreads over the tasks of the exchange."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        day = spark.range(0, 24 * 60, 1, 4).select(
            F.col("id").alias("event_id"), F.lit(7).alias("user_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts")
        )
        order = [F.col("ts").asc(), F.col("event_id").asc()]
        numbered = sequence_number(day, ["user_id"], order, "n", split_by=F.date_trunc("hour", "ts"))
        rows = numbered.withColumn("task", F.spark_partition_id()).collect()
        assert all(r.n == r.event_id + 1 for r in rows)
        assert len({r.task for r in rows}) >= 6
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_latest_per_key_gives_one_row_per_key(hot, bag):
    order = [F.col("minute").desc(), F.col("event_id").desc()]
    latest = latest_per_key(hot, ["user_id"], order)
    best = hot.groupBy("user_id").agg(F.max(F.struct("minute", "event_id", "status")).alias("m"))
    assert bag(latest) == bag(best.select("m.event_id", "user_id", "m.minute", "m.status"))
    assert latest.count() == hot.select("user_id").distinct().count()


def test_joins_by_parts(spark, hot, bag):
    users = spark.range(0, 80).select(F.col("id").alias("uid")).unionByName(
        spark.range(1).select(F.lit(None).cast("long").alias("uid"))
    )
    same = F.col("uid") == F.col("user_id")
    # Every user is copied, so that the left side has equal rows too.
    users = users.unionByName(users.where("uid % 2 = 0")).withColumn("name", F.concat(F.lit("u"), F.col("uid").cast("string")))
    for part_rows in (1 << 20, 1000, 30, 1):
        left = left_join_by_parts(users, hot, "uid", "user_id", part_rows)
        assert bag(left) == bag(users.join(hot, same, "left"))
        full = full_join_by_parts(users, hot, "uid", "user_id", part_rows)
        assert bag(full) == bag(users.join(hot, same, "full_outer"))
        # Hot on the other side, and on both.
        full = full_join_by_parts(hot, users, "user_id", "uid", part_rows)
        assert bag(full) == bag(hot.join(users, same, "full_outer"))
    other = hot.where("event_id < 400").select(F.col("event_id").alias("e2"), F.col("user_id").alias("u2"), F.lit(1).alias("_"))
    some = hot.where("event_id < 300").select("event_id", "user_id")
    both = full_join_by_parts(some, other, "user_id", "u2", 20)
    assert bag(both) == bag(some.join(other, F.col("user_id") == F.col("u2"), "full_outer"))


def test_left_join_by_parts_with_a_second_side(spark, hot, bag):
    """The second side meets each part of a hot key, and rows without a key or partner stay."""
    users = spark.range(0, 80).select(F.col("id").alias("uid")).unionByName(
        spark.range(1).select(F.lit(None).cast("long").alias("uid"))
    )
    notes = spark.range(0, 240).select((F.col("id") % 90).alias("noted"), F.col("id").alias("note"))
    notes = notes.where("noted % 5 > 0").unionByName(spark.range(1).select(F.lit(None).cast("long").alias("noted"), F.lit(-1).cast("long").alias("note")))
    plain = users.join(hot, F.col("uid") == F.col("user_id"), "left").join(notes, F.col("uid") == F.col("noted"), "left")
    for part_rows in (1 << 20, 1000, 30):
        joined = left_join_by_parts(users, hot, "uid", "user_id", part_rows, beside=(notes, "noted"))
        assert bag(joined) == bag(plain)


def test_hot_keys_of_outer_joins_spread_over_tasks(spark, hot):
    """With parts, no task gets more than a few parts of the hot user or of the rows without a user."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    users = spark.range(0, 80).select(F.col("id").alias("uid"))
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for joined in (left_join_by_parts(users, hot, "uid", "user_id", 100), full_join_by_parts(users, hot, "uid", "user_id", 100)):
            hottest = joined.where("user_id = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
            assert hottest[0] < 700 and hottest[1] >= 10
        alone = joined.where("uid IS NULL AND user_id IS NULL").groupBy(F.spark_partition_id()).count()
        assert alone.count() >= 20
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_numbers_of_one_key_in_one_hour_come_from_several_tasks(spark):
    """A third of the rows share a key and an hour, and even the second."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        rows = spark.range(0, 9000, 1, 4).select(
            F.col("id").alias("event_id"),
            F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 40).alias("user_id"),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("at"),
        )
        order = [F.col("at").desc(), F.col("event_id").asc()]
        numbered = numbered_rows(rows, ["user_id"], order, "n")
        plain = rows.withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy(*order)))
        assert sorted(map(repr, numbered.collect())) == sorted(map(repr, plain.collect()))
        whole = numbered_rows(rows, [], [F.col("event_id").desc()], "n").collect()
        assert {(r.event_id, r.n) for r in whole} == {(i, 9000 - i) for i in range(9000)}
        # Where the hot key's rows lie in the stored table: five partitions of sixteen, at least.
        dealt = rows.repartitionByRange(F.col("user_id"), *order).withColumn("task", F.spark_partition_id())
        assert dealt.where("user_id = 7").select("task").distinct().count() >= 5
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_conditional_counts(hot, bag):
    late = F.col("minute") > 500
    ours = conditional_distinct_counts(hot, ["status"], "user_id", {"all": F.lit(True), "late": late})
    plain = hot.groupBy("status").agg(
        F.countDistinct("user_id").alias("all"), F.countDistinct(F.when(late, F.col("user_id"))).alias("late")
    )
    assert bag(ours) == bag(plain)
    assert bag(count_distinct_by(hot, ["status"], "user_id", "all")) == bag(plain.select("status", "all"))


def test_anti_later_event(hot, bag):
    rows = hot.where("status = 'new'")
    a, b = rows.alias("a"), hot.where("status <> 'new'").alias("b")
    later = (F.col("a.user_id") == F.col("b.user_id")) & (F.col("b.minute") > F.col("a.minute"))
    plain = a.join(b, later, "left_anti")
    ours = anti_later_event(rows, hot, "user_id", "minute", "status", "new")
    assert bag(ours) == bag(plain)


def test_anti_later_event_without_a_time(spark, bag):
    """A row without a time has no later row, so it stays."""
    history = spark.createDataFrame([(1, None, "new"), (1, 5, "done"), (2, 1, "new"), (2, 5, "done")], "k int, t int, s string")
    left = anti_later_event(history.where("s = 'new'"), history, "k", "t", "s", "new")
    assert bag(left) == [(1, None, "new")]


def test_latest_completed_keeps_ties_and_open_rows(spark, bag):
    steps = spark.createDataFrame(
        [
            (1, 10, True, "a"),
            (1, 20, True, "b"),
            (1, 20, True, "c"),
            (1, 20, False, "open at the same time"),
            (1, 30, False, "open later"),
            (2, 5, False, "never completed"),
            (3, None, True, "no time"),
        ],
        "k int, t int, done boolean, step string",
    )
    found = at_latest_completed(steps, "k", "t", F.col("done"), ["step"])
    assert bag(found) == [(1, "b"), (1, "c"), (1, "open at the same time")]


def test_sequences_are_bounded(hot, rows):
    order = [F.col("minute").asc(), F.col("event_id").asc()]
    sequences = status_sequence(hot, ["user_id"], order, "status", 7)
    assert max(len(r[1]) for r in rows(sequences)) == 7
    window = Window.partitionBy("user_id").orderBy(*order)
    first = hot.withColumn("n", F.row_number().over(window)).where("n = 1").select("user_id", "status")
    assert sorted(map(repr, rows(first))) == sorted(repr((u, s[0])) for u, s in rows(sequences))
