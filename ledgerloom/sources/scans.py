"""Reads: tables, landed documents, wide rows with a JSON payload, records.

Every scan keeps projection and predicate as plain expressions so that they
reach the file or database reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.nested import parsed_once


def scan_table(
    spark: SparkSession,
    directory: str,
    name: str,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """Read a database table; ``split`` = (column, lower, upper, partitions)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split:
        column, lower, upper, partitions = split
        options = {
            **options,
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    df = reader.options(**options).load()
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_documents(
    spark: SparkSession, path: str | Sequence[str], schema: str, origin: str | None = None
) -> DataFrame:
    """Read landed search documents (JSON lines) under a declared schema.

    ``path`` may hold wildcards (many indices); ``origin`` names a column that
    receives the file each row came from.
    """
    df = spark.read.schema(schema).json(path)
    return df.withColumn(origin, F.col("_metadata.file_path")) if origin else df


def scan_wide_rows(
    df: DataFrame,
    payload: str,
    schema: str,
    where: Column | str | None = None,
    into: str = "doc",
) -> DataFrame:
    """Parse the JSON payload column of wide-column rows into a struct, once per row."""
    if where is not None:
        df = df.where(where)
    return df.withColumn(into, parsed_once(F.from_json(F.col(payload), schema))).drop(payload)


def scan_records(df: DataFrame, bins: Sequence[str], record: str = "doc") -> DataFrame:
    """Take the named bins of a record struct; a missing bin reads as NULL."""
    return df.select(*[F.col(f"{record}.{name}").alias(name) for name in bins])
