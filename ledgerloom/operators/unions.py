"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    return union_all(parts).distinct()


def labelled_segments(
    df: DataFrame, segments: Mapping[str, Column], label: str
) -> DataFrame:
    """Union of overlapping filters of one table, each row tagged with its
    segment: the table is read once and a row repeats per segment it meets."""
    tags = F.array(*[F.when(condition, F.lit(name)) for name, condition in segments.items()])
    return df.withColumn(label, F.explode(F.array_compact(tags)))


def labelled_union(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL of different tables, each tagged with its label."""
    return union_all([df.withColumn(label, F.lit(name)) for name, df in parts.items()])
