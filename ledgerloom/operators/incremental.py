"""State tables: results over a growing history, kept up with its new rows only.

Both tables here are snapshots (``ledgerloom.sinks.snapshots``): a batch is merged in
one atomic step, once, however often its job is run; a batch whose job fails leaves
the state as it was; two writers at once do not lose each other's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.operators.latest import latest_per_key, numbered_rows
from ledgerloom.sinks import snapshots

BUCKET = "bucket_"
RETRIES = 5


def _until_undisturbed(attempt: Callable[[], int]) -> int:
    """The result of ``attempt``, made again from the newer state if another writer was faster."""
    for _ in range(RETRIES):
        try:
            return attempt()
        except snapshots.Conflict as error:
            last = error
    raise last


class LatestState:
    """The latest row of every key and status of a history.

    From these few rows per key follow the key's latest row and the last time at
    which it showed any other status, without reading the history again. Late rows
    may come in any batch, because the greatest row is the same in any order.
    ``order`` must begin with the moment, descending, and end in a unique column.
    Keys are dealt to ``buckets`` by hash; a batch rewrites the buckets that its keys
    are in.
    """

    def __init__(self, spark: SparkSession, target: str, keys: Sequence[str], status: str, order: Sequence[Column], buckets: int = 64):
        self.spark, self.target, self.keys, self.status = spark, target, list(keys), status
        self.order, self.buckets = list(order), buckets

    def merge(self, rows: DataFrame, batch: str) -> int:
        """Take a batch of history in; the version of the state. A batch that is in stays as it is."""
        if batch in (snapshots.manifest(self.spark, self.target) or {"batches": []})["batches"]:
            return snapshots.versions(self.spark, self.target)[-1]
        grain = [*self.keys, self.status]
        fresh = latest_per_key(rows, grain, self.order).withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

        def attempt() -> int:
            now = snapshots.manifest(self.spark, self.target)
            touched, merged = None, fresh
            if now:
                # At most as many numbers as there are buckets.
                touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
                old = snapshots.read_table(self.spark, self.target, now["version"], touched)
                merged = latest_per_key(old.unionByName(fresh), [BUCKET, *grain], self.order)
            base = now["version"] if now else 0
            return snapshots.replace_slices(merged, self.target, BUCKET, touched, batch=batch, base=base)

        return _until_undisturbed(attempt)

    def rows(self) -> DataFrame:
        """The latest row of every key and status."""
        return snapshots.read_table(self.spark, self.target).drop(BUCKET)

    def latest(self) -> DataFrame:
        """The latest row of every key."""
        return latest_per_key(self.rows(), self.keys, self.order)

    def last_other(self, moment: str, value: str) -> DataFrame:
        """Keys and ``last_other``, the last time at which each showed another status than ``value``."""
        others = self.rows().where(F.col(self.status) != value)
        return others.groupBy(*self.keys).agg(F.max(moment).alias("last_other"))

    def without_later(self, rows: DataFrame, moment: str, value: str) -> DataFrame:
        """Those rows after which their key shows no other status than ``value``."""
        last = self.last_other(moment, value).select(*[F.col(k).alias(f"_s_{k}") for k in self.keys], "last_other")
        same = F.lit(True)
        for k in self.keys:
            same = same & (F.col(k) == F.col(f"_s_{k}"))
        later = F.coalesce(F.col("last_other") > F.col(moment), F.lit(False))
        return rows.join(last, same, "left").where(~later).select(*rows.columns)


class DistinctDays:
    """Exact distinct counts per group over any range of days, from stored bitmaps.

    Values are numbered once, in a table of their own. Per day and group the numbers
    that occur are kept as bitmaps of 32,768 numbers each; a range of days merges
    them, which reads bits instead of the rows and their values.
    """

    def __init__(self, spark: SparkSession, target: str, groups: Sequence[str], value: str):
        self.spark, self.groups, self.value = spark, list(groups), value
        self.numbers, self.bitmaps = f"{target}/numbers", f"{target}/bitmaps"

    def _numbered(self, rows: DataFrame) -> DataFrame:
        """All numbers given so far, after the new values among ``rows`` got theirs."""

        def attempt() -> int:
            now = snapshots.manifest(self.spark, self.numbers)
            values = rows.select(F.col(self.value).alias("value")).where("value IS NOT NULL").distinct()
            given = 0
            if now:
                known = snapshots.read_table(self.spark, self.numbers, now["version"])
                values = values.join(known, "value", "left_anti")
                given = known.agg(F.max("number")).first()[0] or 0
            fresh = numbered_rows(values, [], [F.col("value")], "number").select("value", (F.col("number") + given).alias("number"))
            return snapshots.append(fresh, self.numbers, base=now["version"] if now else 0)

        _until_undisturbed(attempt)
        return snapshots.read_table(self.spark, self.numbers)

    def put(self, rows: DataFrame, day_col: str, days: Sequence[date] | None = None) -> int:
        """Store the given days (those that occur in ``rows``), replacing what is stored of them; the version."""
        numbers = self._numbered(rows)
        pairs = rows.select(day_col, *self.groups, F.col(self.value).alias("value")).distinct().join(numbers, "value")
        part, place = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
        bits = pairs.groupBy(F.col(day_col).alias("day"), *self.groups, part.alias("part_")).agg(F.bitmap_construct_agg(place).alias("bits_"))
        return snapshots.replace_slices(bits, self.bitmaps, "day", days)

    def counts(self, first: date, last: date, into: str) -> DataFrame:
        """Distinct values per group from ``first`` to ``last``; only these days are read."""
        days = [first + timedelta(d) for d in range((last - first).days + 1)]
        held = snapshots.read_table(self.spark, self.bitmaps, slices=days)
        merged = held.groupBy(*self.groups, "part_").agg(F.bitmap_or_agg("bits_").alias("bits_"))
        return merged.groupBy(*self.groups).agg(F.sum(F.bitmap_count("bits_")).alias(into))
