"""Daily snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.times import compact_date


def daily_sessions(rows: DataFrame) -> DataFrame:
    """Landed analytics rows (compact date, count as text) to a typed table."""
    return rows.select(
        compact_date(F.col("date")).alias("dates"), F.col("sessions").cast("long").alias("sessions")
    )


def with_slice_replaced(history: DataFrame, today: DataFrame, date_col: str, as_of: date) -> DataFrame:
    """History without the rows of ``as_of`` plus today's rows: what the target
    holds after ``write_date_slice``, as a DataFrame."""
    kept = history.where(F.col(date_col) != F.lit(as_of))
    return kept.unionByName(today.withColumn(date_col, F.lit(as_of)))
