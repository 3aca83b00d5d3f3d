"""What the marts need to know about one marketplace."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.fixed_values import SKIPPED_PAY_TITLES
from ledgerloom.functions.status import Lender


@dataclass(frozen=True)
class Market:
    scope: str = "market"
    catalogue_scope: str = "{catalogue}"
    terminal_type: str = "{DESK}"
    account_brand: str = "market"
    test_merchant: str | None = None
    hidden_sender: str | None = None
    hidden_legal_name: str | None = None
    skipped_pay_titles: Sequence[str] = SKIPPED_PAY_TITLES
    lender: Lender = field(default_factory=Lender)


def listed(nomenclature: DataFrame, market: Market) -> DataFrame:
    """Items sold through the marketplace channel."""
    return nomenclature.where(F.col("sale_channels") == market.scope)


def is_available() -> Column:
    return F.col("available").eqNullSafe(F.lit(True))


def is_active() -> Column:
    return is_available() & F.col("is_visible").eqNullSafe(F.lit(True))


def active_merchants(merchants: DataFrame, market: Market | None = None) -> DataFrame:
    """Distinct (id, brand) of active merchants, the test merchant left out if a market is given."""
    kept = merchants.where(F.col("state") == "ACTIVE")
    if market is not None and market.test_merchant is not None:
        kept = kept.where(F.col("id") != market.test_merchant)
    return kept.select(F.col("id").alias("merchant_id"), "brand").distinct()
