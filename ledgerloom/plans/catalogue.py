"""Catalogue marts: unidentified items, sellers, prices, counts, publish log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.functions.nested import explode_text_array
from ledgerloom.functions.rules import multi_col_rules, value_map
from ledgerloom.functions.text import (
    braced_list,
    initcap_words,
    last_segment,
    level,
    path_levels,
)
from ledgerloom.functions.times import local_time
from ledgerloom.operators.aggregates import (
    conditional_distinct_counts,
    count_distinct_by,
    grouped_finer_than_shown,
    having,
    min_max_by,
)
from ledgerloom.operators.taxonomy import CATALOGUE_STEPS, Step, repair_taxonomy
from ledgerloom.operators.unions import union_all
from ledgerloom.plans.market import Market, active_merchants, is_active, is_available, listed
from ledgerloom.plans.orders import category_titles, with_category_titles

ITEM = [
    "merchant_id",
    "uid",
    "bar_code",
    "articul",
    "name",
    "created_on",
    "updated_on",
    "price",
]
LEVELS = [f"cat{k}" for k in range(1, 6)]
COUNTS = ["sku_ebt", "sku_nomenclature", "sku_available", "sku_active"]


def _first_category():
    return level(braced_list(F.col("categories_array")), 1)


def _titles(categories: DataFrame, key: str, title: str) -> DataFrame:
    return categories.select(F.col("id").alias(key), F.col("title").alias(title))


def unidentified_products(
    nomenclature: DataFrame, merchants: DataFrame, categories: DataFrame, market: Market
) -> DataFrame:
    """Created, available items of active merchants with their first category."""
    items = listed(nomenclature, market).where((F.col("status") == "created") & is_available())
    return (
        items.select(*ITEM, _first_category().alias("category_id"))
        .distinct()
        .join(active_merchants(merchants), "merchant_id")
        .join(_titles(categories, "category_id", "cat1"), "category_id", "left")
        .select("brand", *ITEM, "category_id", "cat1")
    )


def unrecognized_report(nomenclature: DataFrame, merchants: DataFrame, market: Market) -> DataFrame:
    """Created, available items with the merchant's brand if it is known."""
    items = listed(nomenclature, market).where((F.col("status") == "created") & is_available())
    brands = merchants.select(F.col("id").alias("merchant_id"), "brand")
    return items.select(*ITEM).distinct().join(brands, "merchant_id", "left").select("brand", *ITEM)


def sellers_per_sku(nomenclature: DataFrame, merchants: DataFrame, market: Market) -> DataFrame:
    """Active sellers of each active item."""
    offers = listed(nomenclature, market).where(is_active() & F.col("sku_id").isNotNull())
    sellers = active_merchants(merchants).select("merchant_id").distinct()
    return count_distinct_by(
        offers.select("sku_id", "merchant_id").join(sellers, "merchant_id"),
        ["sku_id"],
        "merchant_id",
        "sellers",
    )


def sellers(merchants: DataFrame) -> DataFrame:
    return merchants.select("id", "brand").distinct()


def catalogue_products(products: DataFrame, market: Market) -> DataFrame:
    return products.where(
        (F.col("scope_") == market.catalogue_scope)
        & (F.col("created_on") >= F.lit(fv.CATALOGUE_SINCE).cast("timestamp_ntz"))
    )


def products_count(
    nomenclature: DataFrame, products: DataFrame, merchants: DataFrame, market: Market, as_of: date
) -> DataFrame:
    """Active, available, catalogue and all items per brand and state."""
    items = conditional_distinct_counts(
        listed(nomenclature, market),
        ["merchant_id"],
        "uid",
        {"active": is_active(), "available": is_available(), "nomenclature": F.lit(True)},
    )
    listed_products = count_distinct_by(
        catalogue_products(products, market), ["merchant_id"], "id", "ebt"
    )
    zero = F.lit(0).cast("long")
    counts = union_all(
        [
            items.withColumn("ebt", zero),
            listed_products.select(
                "merchant_id",
                zero.alias("active"),
                zero.alias("available"),
                zero.alias("nomenclature"),
                "ebt",
            ),
        ]
    )
    known = (
        merchants.where(F.col("brand").isNotNull())
        .select(F.col("id").alias("merchant_id"), "brand", "state")
        .distinct()
    )
    active = F.when(F.col("state") == "ACTIVE", F.col("active")).otherwise(0)
    return (
        counts.join(known, "merchant_id")
        .groupBy("brand", "state")
        .agg(
            F.sum(active).alias("active"),
            *[F.sum(name).alias(name) for name in ("available", "ebt", "nomenclature")],
        )
        .select(
            initcap_words(F.trim("brand")).alias("brand"),
            F.lit(as_of).alias("date"),
            "state",
            "active",
            "available",
            "ebt",
            "nomenclature",
        )
    )


def publish_events(log: DataFrame, label: str = "base") -> DataFrame:
    """Publish log to one row per product, enabled and disabled lists in one pass."""
    return explode_text_array(
        log.select("event_dtime", "merchant_id", "enabled_products", "disabled_products"),
        {"enabled_products": fv.ENABLED, "disabled_products": fv.DISABLED},
        "product_id",
        label,
    )


def enabled_disabled(
    log: DataFrame, nomenclature: DataFrame, merchants: DataFrame, market: Market
) -> DataFrame:
    """Publish and unpublish events per local day with product name and brand."""
    days = (
        publish_events(log)
        .select(
            "base",
            F.to_date(local_time(F.col("event_dtime"))).alias("day"),
            "merchant_id",
            "product_id",
        )
        .distinct()
    )
    names = nomenclature.select(
        "merchant_id", "product_id", F.col("name_ebt").alias("product")
    ).distinct()
    brands = merchants.select(
        F.col("id").alias("merchant_id"), initcap_words(F.trim("brand")).alias("brand")
    ).distinct()
    return (
        days.join(names, ["merchant_id", "product_id"], "left")
        .join(brands, "merchant_id", "left")
        .select("base", "day", "merchant_id", "product_id", "product", "brand")
    )


def _offers(nomenclature: DataFrame, market: Market) -> DataFrame:
    """Offers of active items; repeated ones are left to the aggregation that follows."""
    active = listed(nomenclature, market).where(is_active())
    return active.select(
        "sku_id", "name_ebt", "merchant_id", "price", _first_category().alias("category_id")
    )


def _not_test(offers: DataFrame, market: Market) -> DataFrame:
    if market.test_merchant is None:
        return offers
    return offers.where(F.col("merchant_id") != market.test_merchant)


def price_list(
    nomenclature: DataFrame, merchants: DataFrame, categories: DataFrame, market: Market
) -> DataFrame:
    """Price per seller with the least and greatest price of the item."""
    offers = _offers(nomenclature, market)
    spread = min_max_by(
        _not_test(offers, market),
        ["sku_id"],
        {"minprice": ("min", "price"), "maxprice": ("max", "price")},
    )
    return (
        offers.join(active_merchants(merchants, market), "merchant_id")
        .join(_titles(categories, "category_id", "cat1"), "category_id", "left")
        .select("sku_id", "price", "cat1", "merchant_id", "brand", "name_ebt")
        .distinct()
        .join(spread, "sku_id", "left")
        .withColumn("sameprice", F.col("minprice") == F.col("maxprice"))
    )


def product_prices(
    nomenclature: DataFrame, merchants: DataFrame, categories: DataFrame, market: Market
) -> DataFrame:
    """Price spread per item, sellers at the greatest price, and who they are.

    Sellers and brand are first counted per (item, name, price); the item's
    greatest price then joins to exactly one of these rows. The spread is over
    active merchants, the seller count over all; brands are known of active ones.
    """
    active = active_merchants(merchants, market).withColumn("is_active", F.lit(True))
    offers = _not_test(_offers(nomenclature, market), market).join(active, "merchant_id", "left")
    spread = (
        offers.where("is_active")
        .groupBy("sku_id", "category_id", "name_ebt")
        .agg(
            F.min("price").alias("minprice"),
            F.max("price").alias("maxprice"),
            F.countDistinct("merchant_id").alias("sellers"),
        )
        .join(_titles(categories, "category_id", "cat1"), "category_id", "left")
    )
    item = ["sku_id", "name_ebt", "price"]
    at_price = offers.groupBy(*item).agg(
        F.countDistinct("merchant_id").alias("sellers_maxprice"), F.max("brand").alias("brand")
    )
    same = F.col("minprice") == F.col("maxprice")
    at_top = spread.withColumn("price", F.col("maxprice")).join(at_price, item, "left")
    sellers_at_top = F.coalesce("sellers_maxprice", F.lit(0))
    return at_top.select(
        "sku_id",
        "cat1",
        "category_id",
        "name_ebt",
        "minprice",
        "maxprice",
        "sellers",
        (F.col("maxprice") - F.col("minprice")).alias("diffprice"),
        same.alias("sameprice"),
        sellers_at_top.alias("sellers_maxprice"),
        multi_col_rules(
            [(~same & (sellers_at_top == 1), F.col("brand")), (same, fv.SAME_PRICES)],
            fv.SEVERAL_SELLERS,
        ).alias("brand_maxprice"),
    )


def short_categories(categories: DataFrame, column: str = "cat1") -> DataFrame:
    """Distinct category titles with their short form."""
    title = F.col(column)
    return categories.select(
        title.alias("category"), value_map(title, fv.SHORT_CATEGORIES, title).alias("category_short")
    ).distinct()


def category_ids(products: DataFrame, path: str = "default_category", longer_than: int = 11) -> DataFrame:
    """Distinct identifiers found last in the path or at levels 3 to 5, in one scan."""
    parts = path_levels(F.col(path))
    found = F.array(last_segment(F.col(path)), *[level(parts, k) for k in (3, 4, 5)])
    return (
        products.select(F.explode(found).alias("category_id"))
        .where(F.length("category_id") > longer_than)
        .distinct()
    )


def _path_counts(
    products: DataFrame, nomenclature: DataFrame, market: Market, grain: Sequence[str]
) -> DataFrame:
    """Distinct items per category path (and ``grain``) under the four measures.

    Items and products are flagged and put under each other, so that both are
    counted together. With a ``grain``, whose groups are small, rows are dealt once
    by path and grain, which serves the distinct identifiers, their counts and the
    sums; a path alone may hold a third of all items, so there each (path,
    identifier) is reduced to one row first.
    """
    keys = ["categories_array", *grain]
    flags = {"sku_nomenclature": F.lit(True), "sku_available": is_available(), "sku_active": is_active()}
    no = F.lit(False)
    items = listed(nomenclature, market).withColumn("product_name", F.col("name_ebt"))
    items = items.select(
        *keys, F.struct(F.lit(1).alias("kind"), F.col("product_id").cast("string").alias("id")).alias("item"),
        *[F.coalesce(cond, no).alias(name) for name, cond in flags.items()], no.alias("sku_ebt"),
    ).where("item.id IS NOT NULL")
    catalogue = catalogue_products(products, market).withColumn("product_name", F.col("name_"))
    catalogue = catalogue.select(
        *keys, F.struct(F.lit(2).alias("kind"), F.col("id").cast("string").alias("id")).alias("item"),
        *[no.alias(name) for name in flags], F.lit(True).alias("sku_ebt"),
    ).where("item.id IS NOT NULL")
    rows = union_all([items, catalogue])
    if grain:
        rows = rows.repartition(*keys)
    return conditional_distinct_counts(rows, keys, "item", {name: F.col(name) for name in COUNTS})


def catalog_counts(
    products: DataFrame,
    nomenclature: DataFrame,
    categories: DataFrame,
    market: Market,
    as_of: date,
    steps: Sequence[Step] = CATALOGUE_STEPS,
    grain: Sequence[str] = (),
    compat: bool = False,
) -> DataFrame:
    """Items per repaired five-level category in four measures.

    Counts come first, per distinct path, so the category lookups and the
    repair run on paths, not on items. ``compat`` merges equal (measure, count,
    category) rows before summing, which undercounts paths that repair to the
    same category with the same count; without it all paths are summed.
    """
    counted = _path_counts(products, nomenclature, market, grain)
    if grain:
        # Many rows per path: titles once per distinct path of the inputs, joined back.
        inputs = [listed(nomenclature, market), catalogue_products(products, market)]
        paths = union_all([df.select("categories_array") for df in inputs])
        repaired = repair_taxonomy(category_titles(paths, categories, 5), LEVELS, steps)
        titled = counted.join(repaired, "categories_array")
    else:
        titled = repair_taxonomy(with_category_titles(counted, categories, 5), LEVELS, steps)
    rows = titled.where(F.col("cat1").isNotNull())
    keys = [*LEVELS, *grain]
    if compat:
        measures = F.array(
            *[F.struct(F.lit(n).alias("base"), F.col(n).alias("n")) for n in COUNTS]
        )
        listed_once = (
            rows.select(*keys, F.explode(measures).alias("_m"))
            .where("_m.n > 0")
            .select(*keys, "_m.base", "_m.n")
            .distinct()
        )
        rows = listed_once.select(
            *keys, *[F.when(F.col("base") == n, F.col("n")).otherwise(0).alias(n) for n in COUNTS]
        )
    summed = rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in COUNTS])
    totals = summed.withColumn("sku_all", sum((F.col(n) for n in COUNTS[1:]), F.col(COUNTS[0])))
    shown = having(totals, (F.col("sku_all") > 0) & (F.col("cat1") != fv.ARCHIVE)).select(
        F.lit(as_of).alias("date"),
        *[F.trim(name).alias(name) for name in LEVELS],
        *COUNTS,
        "sku_all",
        *grain,
    )
    return shown.distinct() if compat else shown


DETAIL_GRAIN = ("merchant_id", "product_name", "updated_on")


def catalog_counts_by_merchant(
    products: DataFrame,
    nomenclature: DataFrame,
    categories: DataFrame,
    merchants: DataFrame,
    market: Market,
    as_of: date,
    steps: Sequence[Step] = CATALOGUE_STEPS,
) -> DataFrame:
    """The same counts per merchant, product and update, with merchant attributes."""
    counts = catalog_counts(
        products, nomenclature, categories, market, as_of, steps, grain=DETAIL_GRAIN
    )
    attributes = merchants.select(F.col("id").alias("merchant_id"), "brand", "state").distinct()
    joined = counts.join(attributes, "merchant_id", "left")
    return joined.select(*counts.columns, "brand", "state")


def active_products_by_category(
    showcase: DataFrame, categories: DataFrame, market: Market, as_of: date
) -> DataFrame:
    """Visible products per category title and merchant, the merchant not shown."""
    shown = showcase.where(
        (F.col("is_visible") == "true") & (F.col("scope_") == market.catalogue_scope)
    ).withColumn("category_id", F.substring("default_category", 7, 36))
    titles = _titles(categories, "category_id", "category").where(F.col("category") != fv.ARCHIVE)
    counts = grouped_finer_than_shown(
        shown.join(titles, "category_id"), ["category"], ["merchant_id"], "id", "products"
    )
    return counts.select(F.lit(as_of).alias("date_"), "category", "products")
