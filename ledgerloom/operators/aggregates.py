"""Grouped counts, conditional distinct counts, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def count_distinct_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact distinct count per key; Spark de-duplicates by (key, value) first,
    so one hot key is counted by many tasks."""
    return df.groupBy(*keys).agg(F.countDistinct(value).alias(name))


def conditional_distinct_counts(
    df: DataFrame, keys: Sequence[str], value: str, conditions: Mapping[str, Column]
) -> DataFrame:
    """Distinct ``value`` per key under several conditions at once.

    Each (key, value) pair is reduced to one row of flags, then the flags are
    summed: one pass over the data and no row multiplication per condition.
    """
    flags = {name: F.max(F.coalesce(cond, F.lit(False)).cast("int")) for name, cond in conditions.items()}
    pairs = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[expr.alias(name) for name, expr in flags.items()])
    )
    return pairs.groupBy(*keys).agg(
        *[F.sum(F.col(name).cast("long")).alias(name) for name in conditions]
    )


def pivot_sum(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    measure: str,
    labels: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """Sum per label in its own column, zero where there is none.

    ``labels`` is the fixed set: a list, or ``{label: column}``.
    """
    names = labels if isinstance(labels, Mapping) else {text: text for text in labels}
    zero = F.lit(0)
    return df.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col(label) == text, F.col(measure)).otherwise(zero)).alias(name)
            for text, name in names.items()
        ]
    )


def pivot_max(
    df: DataFrame, keys: Sequence[str], position: str, value: str, count: int, prefix: str
) -> DataFrame:
    """Rows numbered 1..count to columns ``prefix1..prefixN``."""
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(position) == k, F.col(value))).alias(f"{prefix}{k}")
            for k in range(1, count + 1)
        ]
    )


def min_max_by(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """``{column: (min|max, source)}`` per key."""
    functions = {"min": F.min, "max": F.max}
    return df.groupBy(*keys).agg(
        *[functions[kind](source).alias(name) for name, (kind, source) in measures.items()]
    )


def grouped_finer_than_shown(
    df: DataFrame, shown: Sequence[str], hidden: Sequence[str], value: str, name: str
) -> DataFrame:
    """Distinct counts at (shown, hidden) grain with the hidden keys left out."""
    return count_distinct_by(df, [*shown, *hidden], value, name).select(*shown, name)


def two_level_sum(
    df: DataFrame, inner: Sequence[str], outer: Sequence[str], value: str, name: str
) -> DataFrame:
    """Distinct counts per inner key, summed per outer key."""
    return count_distinct_by(df, inner, value, "_n").groupBy(*outer).agg(F.sum("_n").alias(name))


def having(df: DataFrame, condition: Column | str) -> DataFrame:
    """Filter on aggregate output."""
    return df.where(condition)
