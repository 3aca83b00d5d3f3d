"""How a query is registered: its Spark form, its oracle, the inputs of both.

Marts expect marketplace tables. ``registry.analogs`` derives such tables from
the given ones in SQL that both Spark and DuckDB read; the Spark side runs that
SQL over the Parquet files, the oracle gets it as common table expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.session import configure
from registry.analogs import ANALOGS, for_duckdb, for_spark

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one data folder, given and derived, by attribute."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = configure(spark)
        self.directory = directory

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            df = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        elif name in ANALOGS:
            sql = for_spark(ANALOGS[name])
            used = set(re.findall(r"\{(\w+)\}", sql.replace("{{", "").replace("}}", "")))
            df = self.spark.sql(sql, **{table: getattr(self, table) for table in used})
        else:
            raise AttributeError(name)
        setattr(self, name, df)
        return df


def plain_types(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as doubles: the same in any client."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        out.append(col.alias(f.name))
    return df.select(*out)


def with_inputs(oracle: str) -> str:
    """Put the derived tables an oracle mentions in front of it."""
    words = set(re.findall(r"\w+", oracle))
    needed = [name for name in ANALOGS if name in words]
    body = oracle.strip()
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({for_duckdb(ANALOGS[name]).strip()})" for name in needed)
    if re.match(r"(?i)with\s", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def query(name: str, oracle: str | None = None):
    """Register ``f(tables) -> DataFrame`` under ``name``."""

    def register(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, directory: plain_types(f(Tables(spark, directory)))
        if oracle is not None:
            ORACLES[name] = with_inputs(oracle)
        return f

    return register
