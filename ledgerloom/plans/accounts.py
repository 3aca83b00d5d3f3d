"""Account marts: users and user counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.text import contains_like
from ledgerloom.operators.aggregates import count_distinct_by, min_max_by
from ledgerloom.plans.market import Market


def active_mobile_accounts(accounts: DataFrame, market: Market) -> DataFrame:
    return accounts.where(
        contains_like(F.col("state"), "%active%")
        & (F.lower("brand") == market.account_brand)
        & contains_like(F.col("id_space"), "%mobile%")
    )


def users(accounts: DataFrame, market: Market) -> DataFrame:
    """First creation day and greatest e-mail per active mobile account."""
    rows = active_mobile_accounts(accounts, market).select(
        "profile_id",
        F.upper("brand").alias("brand"),
        F.lit("MOBILE").alias("id_space"),
        F.lit("ACTIVE").alias("state"),
        "identifier_id",
        "email",
        F.to_date("created").alias("created"),
    )
    return min_max_by(
        rows,
        ["profile_id", "brand", "id_space", "state", "identifier_id"],
        {"created": ("min", "created"), "email": ("max", "email")},
    )


def user_counts(accounts: DataFrame, market: Market, as_of: date) -> DataFrame:
    """Distinct identifiers per brand and identifier space, stamped with the day."""
    rows = active_mobile_accounts(accounts, market).withColumn("brand", F.upper("brand"))
    counts = count_distinct_by(rows, ["brand", "id_space"], "identifier_id", "users")
    return counts.select("brand", "id_space", F.lit(as_of).alias("date_"), "users")
