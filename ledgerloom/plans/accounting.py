"""Accounting marts: bank statement, ledger extract, terminals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.functions.nested import json_fragment
from ledgerloom.functions.rules import percentage, pick_column_by_value, typed_null, with_discount
from ledgerloom.functions.text import first_part
from ledgerloom.functions.times import (
    Moment,
    business_day,
    on_day,
    on_previous_day,
    timestamp_literal,
)
from ledgerloom.operators.joins import semi_lookup
from ledgerloom.operators.latest import latest_per_key
from ledgerloom.operators.unions import union_all
from ledgerloom.plans.market import Market

# Columns of the statement, in order.
TERMINAL_ROW = [
    "commersant",
    "filial",
    "terminal_id",
    "auth_code",
    "card_num",
]
STATEMENT = [
    "dtime",
    "order_id",
    *TERMINAL_ROW,
    "tran_amount",
    "comm_bank",
    "total_amount",
    "currency",
    "ret_account",
    "emit_card",
    "invoice_id",
    "orders",
    "invoice_type",
    "item_id",
    "item_name",
    "item_price",
    "item_quantity",
    "items_count",
    "legal_name",
    "merchant_iban",
    "merchant_bik",
    "merchant_bin",
    "operation_id",
    "bank_status",
    "status",
    "promocode",
    "common_discount_size",
    "pay_types",
    "pay_title",
    "comm_comp",
]
BANK_ROW = STATEMENT[: STATEMENT.index("invoice_id")]
MONEY = "decimal(18,2)"


def _order_state(
    history: DataFrame, tie_break: str, invoices: DataFrame | None = None
) -> DataFrame:
    """Latest status row of each order, the columns the statement shows.

    With ``invoices`` given (a short period), only their orders are looked at.
    """
    shown = ["bank_status", "status", "promocode", "common_discount_size", "pay_types", "pay_title"]
    rows = history.select("uid", "updated_on", F.col(tie_break).alias("_tie"), *shown)
    if invoices is not None:
        rows = semi_lookup(rows, invoices, "uid", "order_id")
    return latest_per_key(rows, ["uid"], [F.col("updated_on").desc(), F.col("_tie").desc()]).select(
        "uid", *shown
    )


def _merchant_details(merchants: DataFrame, requisites: DataFrame) -> DataFrame:
    """Legal name, state and requisites, one row per merchant."""
    owners = merchants.select(F.col("id").alias("merch_id"), "legal_name", "state")
    details = requisites.select(
        F.col("merchant_id").alias("merch_id"),
        F.col("iban").alias("merchant_iban"),
        F.col("bik").alias("merchant_bik"),
        F.col("legal_id").alias("merchant_bin"),
    )
    order = ["merchant_bin", "merchant_iban", "merchant_bik", "legal_name", "state"]
    joined = owners.join(details, "merch_id", "left")
    return latest_per_key(joined, ["merch_id"], [F.col(name).asc() for name in order])


def _one_invoice_per_order(
    invoices: DataFrame, orders: DataFrame, compat: bool = False
) -> DataFrame:
    """Invoice rows with the state of their order, one row per order: lowest
    invoice, item and merchant first.

    The choice is made per order number straight from the scan, so that only one
    row per order is joined, and invoices whose order is unknown keep one row
    per order number as well. ``compat=True`` keeps a single row for all of
    them, as the old statement did.
    """
    order = ["invoice_id", "item_id", "merch_id", "bank_trans_id", "item_price", "item_qnt"]
    lowest = [F.col(name).asc() for name in order]
    chosen = latest_per_key(invoices, ["order_id"], lowest)
    joined = chosen.join(orders, F.col("order_id") == F.col("uid"), "left")
    return latest_per_key(joined, ["uid"], lowest) if compat else joined


def _invoice_columns(market: Market) -> list[Column]:
    rate = pick_column_by_value(F.col("pay_title"), market.lender.rate_columns())
    return [
        "invoice_id",
        F.col("order_id").alias("orders"),
        "item_id",
        "item_name",
        with_discount(F.col("item_price").cast(MONEY), F.col("common_discount_size")).alias("item_price"),
        F.col("item_qnt").alias("item_quantity"),
        F.col("item_qnt").alias("items_count"),
        "legal_name",
        "merchant_iban",
        "merchant_bik",
        "merchant_bin",
        F.col("bank_trans_id").alias("operation_id"),
        "bank_status",
        "status",
        "promocode",
        "common_discount_size",
        "pay_types",
        "pay_title",
        rate.alias("comm_comp"),
    ]


def sales_rows(
    invoices: DataFrame,
    merchants: DataFrame,
    requisites: DataFrame,
    history: DataFrame,
    nomenclature: DataFrame,
    tariffs: DataFrame,
    created: Column,
    market: Market,
    tie_break: str,
    active_only: bool = False,
    short_period: bool = False,
    compat: bool = False,
) -> DataFrame:
    """Express-loan invoices in the period, at the tariff of the item's category.

    For a ``short_period`` the order history and the catalogue are first cut
    down to the orders and items invoiced in it.
    """
    details = _merchant_details(merchants, requisites)
    if market.hidden_legal_name is not None:
        details = details.where(F.col("legal_name") != market.hidden_legal_name)
    if active_only:
        details = details.where(F.col("state") == "ACTIVE")
    express = invoices.where((F.col("bank_trans_code") == market.lender.code) & created)
    sold = semi_lookup(express, details, "merch_id", "merch_id")
    states = _order_state(history, tie_break, express if short_period else None)
    chosen = _one_invoice_per_order(sold, states, compat).join(details, "merch_id")
    items = semi_lookup(nomenclature, express, "id", "item_id") if short_period else nomenclature
    categories = items.select(
        F.col("id").alias("item_id"),
        F.translate(first_part(F.col("categories_array")), "{", "").alias("_cat"),
    )
    rates = tariffs.withColumnsRenamed({"merchant_id": "merch_id", "cat_id": "_cat"})
    priced = (
        chosen.join(categories, "item_id", "left")
        .withColumn("_cat", F.coalesce("_cat", F.lit(fv.ROOT_CATEGORY)))
        .join(rates, ["merch_id", "_cat"], "left")
    )
    empty = [typed_null("string").alias(name) for name in ["order_id", *TERMINAL_ROW]]
    price = F.col("item_price").cast(MONEY)
    return priced.select(
        F.col("created_on").alias("dtime"),
        *empty,
        price.alias("tran_amount"),
        F.lit(0).cast(MONEY).alias("comm_bank"),
        price.alias("total_amount"),
        *[typed_null("string").alias(n) for n in ("currency", "ret_account", "emit_card")],
        F.lit("").alias("invoice_type"),
        *_invoice_columns(market),
    ).select(*STATEMENT)


def bank_rows(
    bank: DataFrame,
    invoices: DataFrame,
    merchants: DataFrame,
    requisites: DataFrame,
    history: DataFrame,
    tariffs: DataFrame,
    booked: Column,
    market: Market,
    tie_break: str,
    short_period: bool = False,
    compat: bool = False,
) -> DataFrame:
    """Uploaded bank rows of the period with the invoice they pay.

    The tariff is taken per merchant without a category; of several categories
    the greatest rate counts. For a ``short_period`` invoices and order history are
    first cut down to the orders paid in it; a long one keeps nearly all of them.
    """
    codes = list(market.lender.rate_columns().values())
    rates = tariffs.groupBy(F.col("merchant_id").alias("merch_id")).agg(
        *[F.max(code).alias(code) for code in codes]
    )
    uploaded = bank.where(F.col("upload").isNotNull())
    day = uploaded.withColumn("_booked", business_day(F.col("upload"))).where(booked)
    known = invoices
    if short_period and not compat:
        # The choice is made per order, over all its invoices, if one of them is paid.
        paid = semi_lookup(
            invoices.withColumn("_paid_by", F.concat("bank_trans_id", F.lit("9"))), day, "_paid_by", "order_id"
        )
        known = semi_lookup(invoices, paid, "order_id", "order_id")
    states = _order_state(history, tie_break, known if short_period and not compat else None)
    invoiced = (
        _one_invoice_per_order(known, states, compat)
        .join(_merchant_details(merchants, requisites), "merch_id", "left")
        .join(rates, "merch_id", "left")
        .select(*_invoice_columns(market))
        .withColumn("_key", F.concat("operation_id", F.lit("9")))
    )
    # A row uploaded again is the same row: the time of upload only chooses the day.
    once = day.select(*BANK_ROW).distinct()
    return (
        once.join(invoiced, F.col("order_id") == F.col("_key"), "left")
        .withColumn("invoice_type", typed_null("string"))
        .select(*STATEMENT)
        .distinct()
    )


def bank_statement(
    invoices: DataFrame,
    bank: DataFrame,
    merchants: DataFrame,
    requisites: DataFrame,
    history: DataFrame,
    nomenclature: DataFrame,
    tariffs: DataFrame,
    market: Market,
    as_of: Moment,
    tie_break: str,
    compat: bool = False,
) -> DataFrame:
    """Yesterday's express-loan sales and the bank rows booked today."""
    sales = sales_rows(
        invoices,
        merchants,
        requisites,
        history,
        nomenclature,
        tariffs,
        on_previous_day(F.col("created_on"), as_of),
        market,
        tie_break,
        short_period=True,
        compat=compat,
    )
    booked = on_day(F.col("_booked"), as_of)
    rows = bank_rows(
        bank, invoices, merchants, requisites, history, tariffs, booked, market, tie_break, True, compat
    )
    return union_all([sales, rows])


def ledger_extract(
    invoices: DataFrame,
    bank: DataFrame,
    merchants: DataFrame,
    requisites: DataFrame,
    history: DataFrame,
    nomenclature: DataFrame,
    tariffs: DataFrame,
    market: Market,
    tie_break: str,
    since: Moment = fv.LEDGER_SINCE,
) -> DataFrame:
    """The statement since a start date, sales of active merchants only, with the commission."""
    start = timestamp_literal(since)
    sales = sales_rows(
        invoices,
        merchants,
        requisites,
        history,
        nomenclature,
        tariffs,
        F.col("created_on") >= start,
        market,
        tie_break,
        active_only=True,
    )
    rows = bank_rows(
        bank,
        invoices,
        merchants,
        requisites,
        history,
        tariffs,
        F.col("_booked") >= start,
        market,
        tie_break,
    )
    return union_all([sales, rows]).select(
        "dtime",
        F.col("order_id").alias("orderid"),
        *TERMINAL_ROW,
        F.col("tran_amount").alias("amount"),
        F.col("comm_bank").alias("bank_commission"),
        F.col("item_price").alias("paid_amount"),
        "currency",
        "ret_account",
        F.col("emit_card").alias("card"),
        "legal_name",
        "merchant_iban",
        F.col("merchant_bik").alias("merchant_bic"),
        "merchant_bin",
        "bank_status",
        "status",
        percentage(F.col("tran_amount"), F.col("comm_comp")).alias("commission"),
        F.col("orders").alias("orderuid"),
        "promocode",
        F.col("common_discount_size").alias("promocode_sum"),
        "pay_types",
        "pay_title",
        "comm_comp",
        "item_quantity",
    )


def terminals_report(
    terminals: DataFrame, merchants: DataFrame, requisites: DataFrame, market: Market
) -> DataFrame:
    """Terminals of the terminal business with requisites and address fields.

    Address parts stay JSON, text in quotes. Stock rows would only repeat
    terminals that are then made distinct again, so they are not joined.
    """
    address = {
        "bank_region": "$.regionId",
        "region_id": "$.regionId",
        "street": "$.street",
        "street_num": "$.streetNum",
        "apt_num": "$.aptNum",
    }
    owners = merchants.where(F.col("merchant_type") == market.terminal_type).select(
        F.col("id").alias("merchant_id"),
        "legal_name",
        "telephone",
        "biz_categories",
        *[json_fragment(F.col("address"), path).alias(name) for name, path in address.items()],
    )
    details = requisites.select(
        "merchant_id",
        "legal_id",
        "director_name",
        "tariff_plan",
        "tariff_price",
        "client_type",
        "pos_term_type",
    )
    return (
        terminals.join(owners.distinct(), "merchant_id")
        .join(details.distinct(), "merchant_id", "left")
        .select(
            "id",
            "terminal_id",
            "bank_region",
            "legal_name",
            "legal_id",
            "director_name",
            "region_id",
            "street",
            "street_num",
            "apt_num",
            "telephone",
            "tariff_plan",
            "tariff_price",
            "status",
            "client_type",
            "pos_term_type",
            "created_date",
            "biz_categories",
            "store_id",
        )
        .distinct()
    )
