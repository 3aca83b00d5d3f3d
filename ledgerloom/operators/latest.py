"""Latest row per key, first rows per key, numbering within a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.session import scratch_dir


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], count: int, number: str
) -> DataFrame:
    """The first ``count`` rows of each key, numbered from 1.

    Spark limits each key before the shuffle (WindowGroupLimit), so at most
    ``count`` rows per key and input partition travel, however large the key.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(number, F.row_number().over(window)).where(F.col(number) <= count)


def latest_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]
) -> DataFrame:
    """One row per key: the first in ``order``, which must end in a unique column."""
    return first_per_key(df, keys, order, 1, "_rank").drop("_rank")


def rows_at_latest(df: DataFrame, keys: Sequence[str], moment: Column) -> DataFrame:
    """All rows of each key that share its greatest ``moment`` (ties kept).

    The greatest moment is one row per key and task before the shuffle; the join
    back is one that Spark splits, so a key's last day need not fit a task. A
    key without any moment keeps all its rows.
    """
    dated = df.withColumn("_moment", moment)
    last = dated.groupBy(*[F.col(k).alias(f"_l_{k}") for k in keys]).agg(F.max("_moment").alias("_last"))
    same = F.col("_moment").eqNullSafe(F.col("_last"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_l_{k}"))
    return dated.join(last, same).select(*df.columns)


_ROW_IN_PARTITION = (1 << 33) - 1


def numbered_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], number: str) -> DataFrame:
    """Number the rows of each key from 1 in ``order``, however large a key is.

    Rows are dealt to partitions by ranges of key and order, so a key may span many
    tasks, and stored; a row's number is its place in its partition, less the rows of
    earlier keys there, plus the rows that its key has in earlier partitions (one
    count per key and partition). ``order`` must be total; with no ``keys`` all rows
    are numbered.
    """
    spark = df.sparkSession
    where = scratch_dir(spark, "numbered")
    ranges = [*[F.col(k).asc() for k in keys], *order]
    dealt = df.repartitionByRange(*ranges).sortWithinPartitions(*ranges)
    # The identifier counts the rows of each partition in their order.
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(where)
    stored = spark.read.parquet(where).withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(_ROW_IN_PARTITION))
    parts = stored.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col("_part").alias("_o_part"),
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_part") == F.col("_o_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return stored.join(offsets, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(number))


def sequence_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    number: str,
    split_by: Column | None = None,
) -> DataFrame:
    """Number the rows of each key from 1 in ``order``.

    Without ``split_by`` rows are numbered by ``numbered_rows``, which splits any
    key but stores the rows once. ``split_by``, a coarse value that never decreases
    along ``order`` (the hour of a timestamp), avoids that: rows are numbered within
    (key, slice) and shifted by the size of the key's earlier slices. Choose it so
    fine that the rows of the largest key fit a task per slice; the slices of one
    key, a row each, are summed up in one task.
    """
    if split_by is None:
        return numbered_rows(df, keys, order, number).withColumn(number, F.col(number).cast("int"))
    sliced = df.withColumn("_slice", split_by)
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col("_slice").alias("_o_slice"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
    )
    local = sliced.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    )
    same = F.col("_slice").eqNullSafe(F.col("_o_slice"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return local.join(offsets, same).select(
        *df.columns, (F.col("_before") + F.col("_local")).cast("int").alias(number)
    )
