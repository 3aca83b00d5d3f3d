"""Final ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def order_output(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    """Sort by ``(column, "asc"|"desc")``; NULL counts as greatest, so it comes
    last ascending and first descending."""
    kinds = {"asc": F.asc_nulls_last, "desc": F.desc_nulls_first}
    return df.orderBy(*[kinds[kind](name) for name, kind in order])
