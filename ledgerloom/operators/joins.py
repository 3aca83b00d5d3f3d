"""Joins. No hints: Spark broadcasts only a side whose size it has checked,
sorts and merges otherwise, and splits skewed partitions of inner joins on
either side and of outer joins on the preserved side. The ``*_by_parts`` forms
cut hot keys that Spark cannot split into parts of their own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def inner_dim(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Inner join to a dimension whose repeated rows count once."""
    return fact.join(dim.distinct(), on, "inner")


def left_dim(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return fact.join(dim, on, "left")


def inner_on_measure(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_amount: str, right_amount: str
) -> DataFrame:
    """Join on keys and on two amounts being equal; the right amount is dropped."""
    renamed = right.withColumnRenamed(right_amount, "_amount")
    same = F.col(left_amount) == F.col("_amount")
    for key in on:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
        same = same & (F.col(key) == F.col(f"_r_{key}"))
    return left.join(renamed, same, "inner").drop("_amount", *[f"_r_{k}" for k in on])


def lookup_levels(
    df: DataFrame, levels: Mapping[str, str], dim: DataFrame, key: str, value: str, row_key: str
) -> DataFrame:
    """Look several columns up in one dimension: ``{key column: value column}``.

    The keys of a row become rows of their own, meet the dimension in one join and
    are put back by position. ``row_key`` must be unique in ``df``; rows dealt by it
    already are not dealt again. A key that the dimension has several times gives
    several rows, one without a match gives NULL.
    """
    others = [c for c in df.columns if c != row_key and c not in levels]
    asked = df.select(
        row_key,
        *[c for c in df.columns if c != row_key],
        F.posexplode(F.array(*[F.col(c) for c in levels])).alias("_pos", "_key"),
    )
    side = dim.select(F.col(key).alias("_k"), F.struct(F.col(value).alias("v")).alias("_found"))
    found = asked.join(side, F.col("_key") == F.col("_k"), "left")
    carried = [F.first(F.struct(*others, *levels)).alias("_row")]
    # A few values per position: as many as the dimension has of one key.
    values = [F.collect_list(F.when(F.col("_pos") == i, F.col("_found"))).alias(f"_v{i}") for i in range(len(levels))]
    out = found.groupBy(row_key).agg(*carried, *values)
    for i, target in enumerate(levels.values()):
        out = out.withColumn(target, F.explode_outer(f"_v{i}")).withColumn(target, F.col(target)["v"])
    row = {c: F.col(row_key) if c == row_key else F.col("_row")[c].alias(c) for c in df.columns}
    return out.select(*row.values(), *levels.values())


def at_latest_completed(
    steps: DataFrame, key: str, moment: str, completed: Column, keep: Sequence[str]
) -> DataFrame:
    """Rows whose time equals the latest completed time of their key, ties kept.

    Only the maximum is taken over completed rows; an open row that ends at the
    same time is returned too. The maximum is aggregated first and the join uses
    key and time, so a hot key spreads over its times.
    """
    latest = (
        steps.where(completed & F.col(key).isNotNull() & F.col(moment).isNotNull())
        .groupBy(F.col(key).alias("_k"))
        .agg(F.max(moment).alias("_m"))
    )
    return steps.join(latest, (F.col(key) == F.col("_k")) & (F.col(moment) == F.col("_m"))).select(
        key, *keep
    )


#: Rows of one key that one task may hold in the ``*_by_parts`` joins.
PART_ROWS = 1 << 20


def _parts(keys: DataFrame, key: str, part_rows: int, into: str) -> DataFrame:
    """Keys with more rows than a part holds, and how many parts they need.

    There are at most (rows / ``part_rows``) of them, a million among 10^12 rows,
    so they are sent to all tasks instead of moving the rows of a side once more.
    """
    counted = keys.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"{into}_key")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > part_rows).select(f"{into}_key", F.ceil(F.col("n") / part_rows).cast("int").alias(into))


def _spread(df: DataFrame, parts: Column) -> Column:
    """The part of a row: a hash of its columns (maps cannot be hashed)."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*plain), parts).cast("int")


def _joined_by_parts(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str, part_rows: int, left_keys: DataFrame, right_keys: DataFrame,
    beside: tuple[DataFrame, str] | None = None,
) -> DataFrame:
    """Outer join on key and part.

    Rows of a hot key are dealt to its parts, and the other side's rows of that key
    are repeated for each of them. A repeated row may find its part empty; since the
    key has rows, it matches elsewhere, and that lone copy is dropped. Rows without a
    key match nothing and are dealt out evenly. The rows of ``beside`` are repeated for
    each part of the right side, where the joined rows meet them (left joins only).
    """
    even = F.lit(1024)
    a, b = left.withColumn("_l", F.lit(True)), right.withColumn("_r", F.lit(True))
    hot_right = F.broadcast(_parts(right_keys, right_key, part_rows, "_b"))
    b = b.join(hot_right, F.col(right_key) == F.col("_b_key"), "left").drop("_b_key")
    a = a.join(hot_right, F.col(left_key) == F.col("_b_key"), "left").drop("_b_key")
    b_parts, a_parts = F.coalesce("_b", F.lit(1)), F.lit(1)
    if how == "full_outer":
        # Only here a hot key of the left side needs parts as well: in a left join Spark splits it.
        hot_left = F.broadcast(_parts(left_keys, left_key, part_rows, "_a"))
        a = a.join(hot_left, F.col(left_key) == F.col("_a_key"), "left").drop("_a_key")
        b = b.join(hot_left, F.col(right_key) == F.col("_a_key"), "left").drop("_a_key")
        a_parts = F.coalesce("_a", F.lit(1))
    no_key = lambda key, whole: F.when(F.col(key).isNull(), even).otherwise(whole)
    a = a.withColumns({"_n": b_parts, "_own": _spread(left, no_key(left_key, a_parts))})
    a = a.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    a = a.select(*left.columns, "_l", F.col("_n").alias("_n_right"), F.col("_own").alias("_pa"), F.col("_other").alias("_pb"))
    b = b.withColumns({"_n": a_parts, "_own": _spread(right, no_key(right_key, b_parts))})
    b = b.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    b = b.select(*right.columns, "_r", F.col("_n").alias("_n_left"), F.col("_own").alias("_qb"), F.col("_other").alias("_qa"))
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_pb") == F.col("_qb")) & (F.col("_pa") == F.col("_qa"))
    joined = a.join(b, same, how)
    lone_left = F.col("_r").isNull() & (F.col("_n_right") > 1)
    lone_right = F.col("_l").isNull() & (F.col("_n_left") > 1)
    kept = joined.where(~F.coalesce(lone_left, F.lit(False)) & ~F.coalesce(lone_right, F.lit(False)))
    if beside is None:
        return kept.select(*left.columns, *right.columns)
    other, other_key = beside
    c = other.join(hot_right, F.col(other_key) == F.col("_b_key"), "left").drop("_b_key")
    c = c.withColumn("_n", F.coalesce("_b", F.lit(1))).drop("_b")
    # Left rows that have a key are in part 0 of their own side; the whole key of the first join is met again.
    c = c.withColumn("_cb", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).withColumn("_ca", F.explode(F.sequence(F.lit(0), F.lit(0))))
    there = (F.col(left_key) == F.col(other_key)) & (F.col("_pb") == F.col("_cb")) & (F.col("_pa") == F.col("_ca"))
    return kept.join(c.drop("_n"), there, "left").select(*left.columns, *right.columns, *other.columns)


def left_join_by_parts(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, part_rows: int = PART_ROWS, right_keys: DataFrame | None = None,
    beside: tuple[DataFrame, str] | None = None,
) -> DataFrame:
    """Left outer join for a right side that may hold hot keys, which Spark cannot split there.

    Keys with more than ``part_rows`` right rows are cut into parts. They are counted
    in ``right_keys``, anything with the right key's column and exactly the keys of
    ``right`` (itself by default): a narrow scan where ``right`` is dear to compute.
    Equal rows lie in one part. ``beside``, a side and its key, is left joined on the
    same key: the joined rows meet it where they are and are not dealt out once more.
    Column names of the sides must differ.
    """
    keys = right if right_keys is None else right_keys
    return _joined_by_parts(left, right, left_key, right_key, "left", part_rows, left, keys, beside)


def full_join_by_parts(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, part_rows: int = PART_ROWS,
    left_keys: DataFrame | None = None, right_keys: DataFrame | None = None,
) -> DataFrame:
    """Full outer join whose hot keys, on either side or both, are cut into parts (see above)."""
    keys = left if left_keys is None else left_keys, right if right_keys is None else right_keys
    return _joined_by_parts(left, right, left_key, right_key, "full_outer", part_rows, *keys)


def anti_later_event(
    rows: DataFrame, history: DataFrame, key: str, moment: str, status: str, value: str
) -> DataFrame:
    """Rows of status ``value`` after which their key shows no other status.

    Asking for a later row is the same as comparing with the latest one, so the
    history is cut down to the keys that are asked about and reduced to one time
    per key before it is joined.
    """
    later = (
        semi_lookup(history.where(F.col(status) != value), rows, key, key)
        .groupBy(F.col(key).alias("_k"))
        .agg(F.max(moment).alias("_last"))
    )
    return (
        rows.join(later, F.col(key) == F.col("_k"), "left")
        .where(~F.coalesce(F.col("_last") > F.col(moment), F.lit(False)))
        .drop("_k", "_last")
    )


def mismatch_join(left: DataFrame, right: DataFrame, on: str, a: str, b: str) -> DataFrame:
    """Matching rows whose two attributes disagree; a missing one disagrees too."""
    return left.join(right, on, "inner").where(~F.col(a).eqNullSafe(F.col(b)))


def semi_lookup(documents: DataFrame, ids: DataFrame, key: str, id_col: str) -> DataFrame:
    """The documents whose key occurs among the ids."""
    wanted = ids.select(F.col(id_col).alias("_id")).distinct()
    return documents.join(wanted, F.col(key) == F.col("_id"), "left_semi")
