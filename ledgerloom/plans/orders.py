"""Order marts: status rows, credit funnel, passed orders, profiles, purchases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.functions.nested import json_text
from ledgerloom.functions.rules import (
    bucketize,
    composite_label,
    flag,
    keep_if,
    line_total,
    pattern_map,
    value_map,
)
from ledgerloom.functions.status import (
    cancel_reason,
    delivery_label,
    is_cancel,
    progress_description,
    return_description,
    stage_number,
    stage_of,
    terminal_description,
)
from ledgerloom.functions.text import (
    braced_list,
    extract_between,
    level,
    normalise_phone,
    phone_digits,
    title_number,
)
from ledgerloom.functions.times import (
    Moment,
    age_years,
    hours_before,
    in_month_of_previous_day,
    minute_text,
    since_hours,
    to_second,
)
from ledgerloom.operators.joins import (
    anti_later_event,
    inner_on_measure,
    lookup_levels,
    mismatch_join,
    semi_lookup,
)
from ledgerloom.operators.latest import latest_per_key
from ledgerloom.operators.timeline import (
    SLOTS,
    STAGE_DATES,
    credit_ladder,
    drop_first_resumed_cancel,
    excluded_from_funnel,
    fill_stage_dates,
    funnel_label,
    latest_date_per_label,
    numbered_statuses,
    order_ladder,
    slots,
    stage_durations,
    stage_labels,
    with_created_first,
)
from ledgerloom.operators.unions import union_all
from ledgerloom.plans.accounts import active_mobile_accounts
from ledgerloom.plans.market import Market, listed
from ledgerloom.sinks import alert_rows

ORDER_LINE = ["uid", "product_merchant_id", "sender_title"]


def package_lines(packages: DataFrame, market: Market, *extra: str) -> DataFrame:
    """Distinct order lines with their total, the test merchant left out."""
    kept = packages
    if market.test_merchant is not None:
        kept = kept.where(F.col("product_merchant_id") != market.test_merchant)
    total = line_total(F.col("sku_price"), F.col("sku_amount")).alias("line_total")
    return kept.select(*ORDER_LINE, *extra, total).distinct()


def stage_rows(history: DataFrame, market: Market, kept: Column, tie_break: str) -> DataFrame:
    """Status history reduced to the latest row per order, payment and stage.

    An order has at most seven of these rows per payment, so everything
    downstream groups over small keys, whatever the length of the history.
    """
    rows = history.where((F.col("scope") == market.scope) & kept)
    staged = rows.withColumns(
        {
            "stage": stage_of(F.col("status"), F.col("paid"), F.col("pay_types")),
            "pay": market.lender.pay_group(F.col("pay_types"), F.col("pay_title")),
            "amount": F.coalesce("common_old_price", "common_price"),
            "updated_second": to_second(F.col("updated_on")),
        }
    )
    latest = latest_per_key(
        staged, ["uid", "pay", "stage"], [F.col("updated_second").desc(), F.col(tie_break).desc()]
    )
    return latest.withColumn(
        "reason",
        cancel_reason(
            F.col("stage"), F.col("status"), F.col("cancelled_reason"), F.col("bank_status")
        ),
    )


def marketable(market: Market) -> Column:
    """Orders of the order marts: a payment type other than plain credit, a real wording."""
    return (
        F.col("pay_types").isNotNull()
        & (F.col("pay_types") != fv.SKIPPED_PAY_TYPE)
        & ~F.col("pay_title").isin(*market.skipped_pay_titles)
    )


def _item_titles(nomenclature: DataFrame, categories: DataFrame, market: Market) -> DataFrame:
    """Greatest name and first-level title per product and merchant."""
    items = listed(nomenclature, market).where(F.col("product_id").isNotNull())
    keyed = items.select(
        "product_id",
        F.col("merchant_id").alias("product_merchant_id"),
        level(braced_list(F.col("categories_array")), 1).alias("cat"),
        "name_ebt",
    )
    titled = keyed.join(
        categories.where(F.col("title").isNotNull()).select(F.col("id").alias("cat"), "title"), "cat"
    )
    return titled.groupBy("product_id", "product_merchant_id").agg(
        F.max("name_ebt").alias("name_ebt"), F.max("title").alias("category_1")
    )


def _loan_products(saved: DataFrame, sent: DataFrame) -> DataFrame:
    """Canonical loan products per order; at most one entry per known product."""
    codes = union_all(
        [
            saved.select("order_id", F.col("product_sub_code").alias("code")),
            sent.select("order_id", F.col("productcode").alias("code")),
        ]
    ).where(F.col("code").isNotNull())
    label = F.coalesce(value_map(F.col("code"), fv.LOAN_PRODUCTS), F.lit(""))
    return codes.groupBy(F.col("order_id").alias("uid")).agg(F.collect_set(label).alias("loan_products"))


def orders_mart(
    history: DataFrame,
    packages: DataFrame,
    saved_requests: DataFrame,
    sent_requests: DataFrame,
    nomenclature: DataFrame,
    categories: DataFrame,
    accounts: DataFrame,
    market: Market,
    tie_break: str,
) -> DataFrame:
    """Latest row per order, payment and stage with package, product, city and user."""
    lines = (
        package_lines(packages, market, "product_id")
        .join(
            _item_titles(nomenclature, categories, market), ["product_id", "product_merchant_id"], "left"
        )
        .groupBy(*ORDER_LINE, "line_total")
        .agg(F.max("name_ebt").alias("name_ebt"), F.max("category_1").alias("category_1"))
    )
    rows = stage_rows(history, market, marketable(market), tie_break)
    known = F.coalesce(F.col("loan_products"), F.array(F.lit("")))
    products = F.array_distinct(
        F.transform(
            known,
            lambda loan: market.lender.payment_product(
                F.col("pay_types"), F.col("pay_types_code"), F.col("pay_title"), F.nullif(loan, F.lit(""))
            ),
        )
    )
    users = active_mobile_accounts(accounts, market).select("identifier_id").distinct()
    joined = (
        inner_on_measure(rows, lines, ["uid"], "amount", "line_total")
        .join(_loan_products(saved_requests, sent_requests), "uid", "left")
        .withColumn("pay_title2", F.explode(products))
        .withColumn("mobile", phone_digits(F.col("user_mobile")))
        .join(users, F.col("mobile") == F.col("identifier_id"), "left")
    )
    registered = F.col("identifier_id").isNotNull()
    city_id = F.translate(F.col("city_id"), '"', "")
    return joined.select(
        "uid",
        "status",
        F.col("stage").alias("status_ru"),
        stage_number(F.col("stage")).cast("string").alias("status_ru_num"),
        delivery_label(F.col("status"), F.col("delivery_types")).alias("delivery_type"),
        F.col("reason").alias("cancelled_reason"),
        flag(F.col("status").isin(*fv.MERCHANT_APPROVED_STATUSES)).alias("merchant_approve"),
        flag(F.col("status").isin(*fv.CONTRACT_SIGNED_STATUSES)).alias("contract_signed"),
        to_second(F.col("created_on")).alias("created_second"),
        F.to_date("created_on").alias("created_on"),
        F.col("updated_second"),
        F.to_date("updated_on").alias("updated_on"),
        F.col("pay").alias("pay_title"),
        "pay_title2",
        F.col("common_price").alias("total"),
        "mobile",
        "user_email",
        "promocode_name",
        "promocode",
        "is_promocode_applied",
        F.col("common_discount_size").cast("decimal(18,2)").alias("common_discount_size"),
        city_id.alias("city_id"),
        "delivery_types",
        "weight",
        "product_merchant_id",
        "sender_title",
        "name_ebt",
        "category_1",
        F.col("amount").alias("common_old_price"),
        F.col("identifier_id").alias("reg_user"),
        keep_if(registered, F.col("uid")).alias("uid_reg_user"),
        keep_if(registered, F.col("common_price")).alias("total_reg_user"),
        pattern_map(city_id, fv.CITY_PATTERNS).alias("city_ru"),
    )


def _timelines(
    rows: DataFrame, packages: DataFrame, market: Market, tie_break: str
) -> DataFrame:
    """Ordered statuses, reason and stage days per order, payment, line and price.

    Statuses are numbered once per order and payment, over the rows that have a
    line of their amount, before lines are attached: an order with several
    matching lines keeps one timeline, and where the price changed, each price
    shows its statuses in their places and NULL in the others.
    """
    lines = package_lines(packages, market)
    totals = lines.select(F.col("uid").alias("_uid"), "line_total").distinct()
    matched = rows.join(
        totals, (F.col("uid") == F.col("_uid")) & (F.col("amount") == F.col("line_total")), "left_semi"
    )
    # One row per stage of an order and payment, so seven at most are numbered.
    number = Window.partitionBy("uid", "pay").orderBy("updated_second", tie_break)
    numbered = matched.withColumn("_n", F.row_number().over(number))
    day = F.to_date("updated_on")
    attached = inner_on_measure(numbered, lines, ["uid"], "amount", "line_total")
    return attached.groupBy(
        "uid", "pay", "sender_title", "product_merchant_id", F.col("common_price").alias("total")
    ).agg(
        numbered_statuses(F.col("_n"), F.col("status")).alias("statuses"),
        F.max("reason").alias("reason"),
        F.min(day).alias("first_day"),
        *latest_date_per_label(F.col("stage"), day, STAGE_DATES),
    )


def credit_orders(
    history: DataFrame, packages: DataFrame, market: Market, tie_break: str
) -> DataFrame:
    """Funnel of express-loan orders that opened as new."""
    rows = stage_rows(history, market, F.col("pay_types").like(market.lender.pattern), tie_break)
    timelines = _timelines(rows, packages, market, tie_break).where(F.get("statuses", F.lit(0)) == "new")
    closed = timelines.withColumn("closed", drop_first_resumed_cancel(F.col("statuses")))
    five = closed.select(
        "*",
        *slots(F.col("closed"), "status_", 5),
        level(F.col("statuses"), 6).alias("status_6"),
        level(F.col("statuses"), 7).alias("status_7"),
    )
    labelled = five.withColumns({f"label_{k}": funnel_label(F.col(f"status_{k}")) for k in range(1, 6)})
    names = [f"status_{k}" for k in range(1, SLOTS + 1)]
    any_cancel = is_cancel(F.concat_ws(",", *names))
    orders = labelled.withColumns(
        {
            "exclude_approve": excluded_from_funnel(F.col("statuses"), F.col("closed")),
            "cancelled_reason": keep_if(any_cancel, F.col("reason")),
        }
    )
    ladder = credit_ladder([F.col(f"label_{k}") for k in range(1, 6)])
    return orders.select(
        "uid",
        F.col("pay").alias("pay_title"),
        "sender_title",
        "product_merchant_id",
        "total",
        "cancelled_reason",
        F.col("first_day").alias("updated_on"),
        *names,
        "exclude_approve",
        *[label.alias(f"status_{k}_ru") for k, label in enumerate(ladder, 1)],
    )


def passed_orders(
    history: DataFrame, packages: DataFrame, market: Market, as_of: Moment, tie_break: str
) -> DataFrame:
    """Orders that reached the merchant: stage ladder, stage days, durations, final state."""
    rows = stage_rows(history, market, marketable(market), tie_break)
    first = F.get("statuses", F.lit(0))
    timelines = _timelines(rows, packages, market, tie_break).where(first.isin("new", "pending_approve"))
    closed = timelines.withColumn("closed", with_created_first(F.col("statuses")))
    labels = stage_labels(F.col("closed"), F.col("reason"))
    staged = closed.select(
        "*",
        *slots(F.col("closed"), "s", 5),
        *[label.alias(f"raw_{k}") for k, label in enumerate(labels, 1)],
    )
    seen = F.concat_ws(",", *[f"raw_{k}" for k in range(1, 6)])
    really_cancelled = F.lit(False)
    for pattern in fv.KEPT_REASON_PATTERNS:
        really_cancelled = really_cancelled | seen.like(pattern)
    ladder = order_ladder([F.col(f"raw_{k}") for k in range(1, 6)])
    dated = fill_stage_dates(staged, F.get("statuses", F.lit(0))).select(
        "*",
        *[label.alias(f"label_{k}") for k, label in enumerate(ladder, 1)],
        keep_if(really_cancelled, F.col("reason")).alias("cancelled_reason"),
        keep_if(really_cancelled, F.col("cancelled_day")).alias("_cancelled"),
    )
    received = dated.where(F.col("received_day").isNotNull()).withColumn(
        "cancelled_day", F.col("_cancelled")
    )
    timed = stage_durations(received, as_of)
    s2, s3, s4, s5 = (F.col(f"s{k}") for k in range(2, 6))
    label3, reason = F.col("label_3"), F.col("cancelled_reason")
    return timed.select(
        "uid",
        F.col("pay").alias("pay_title"),
        "sender_title",
        "product_merchant_id",
        "total",
        "cancelled_reason",
        *[F.col(f"label_{k}").alias(f"status_{k}_ru") for k in range(1, 5)],
        "received_day",
        "cancelled_day",
        keep_if(F.col("completed_day").isNotNull(), F.col("total")).alias("completed_total"),
        progress_description(s2, s3, s4, label3, reason, F.col("pay"), market.lender).alias("state_1"),
        terminal_description(s3, s4, label3, reason).alias("state_2"),
        return_description(s4, s5).alias("state_3"),
        "accept_days",
        "complete_days",
    )


def customer_profile(
    saved_requests: DataFrame,
    sent_requests: DataFrame,
    history: DataFrame,
    market: Market,
    as_of: Moment,
    unknown_income: str | None = None,
) -> DataFrame:
    """Borrower demographics and income, bucketed, for delivered orders."""
    temp = F.col("temp")
    born = F.regexp_extract(temp, r'birthdate_str": "(\d{2}.\d{2}.\d{4})', 1)
    born = F.make_date(
        F.substring(born, 7, 4).try_cast("int"),
        F.substring(born, 4, 2).try_cast("int"),
        F.substring(born, 1, 2).try_cast("int"),
    )
    people = saved_requests.select(
        "order_id",
        F.when(temp.like('%"sex": 1%'), "male").when(temp.like('%"sex": 2%'), "female").alias("gender"),
        age_years(born, as_of).alias("age"),
        extract_between(temp, '"price": ', ', "description":').cast("decimal(18,2)").alias("price"),
        "mobile_phone",
        "product_sub_code",
        F.col("period_").cast("int").alias("period_"),
        "loan_type",
        "sum_",
    ).distinct()
    income_text = json_text(F.col("temp"), "$.body.bank_req.application[11].value")
    incomes = sent_requests.where(F.col("temp").like('%"key": "Income"%')).select(
        "order_id", income_text.alias("income")
    )
    if unknown_income is not None:
        incomes = incomes.where(F.col("income") != unknown_income)
    incomes = (
        incomes.where(F.col("income").isNotNull())
        .select("order_id", F.col("income").cast("decimal(18,2)").alias("income"))
        .distinct()
    )
    delivered = (
        history.where(
            (F.col("scope") == market.scope)
            & F.col("status").isin("delivered", "taken")
            & F.col("updated_on").isNotNull()
        )
        .select(
            F.col("uid").alias("order_id"),
            composite_label(F.col("status"), F.col("paid")).alias("status"),
            F.to_date("updated_on").alias("updated_on"),
        )
        .distinct()
    )
    # The result is made distinct as a whole, so prices need not be.
    prices = history.select(F.col("uid").alias("order_id"), "common_price")
    income, price, age = F.col("income"), F.col("price"), F.col("age")
    return (
        people.join(incomes, "order_id")
        .join(delivered, "order_id")
        .join(prices, "order_id", "left")
        .select(
            *people.columns,
            "income",
            bucketize(income, fv.INCOME_SEGMENTS, fv.INCOME_ABOVE).alias("income_segment"),
            bucketize(price, fv.PRICE_SEGMENTS).alias("price_segment"),
            bucketize(age, fv.AGE_SEGMENTS, fv.AGE_ABOVE).alias("age_segment"),
            value_map(F.col("loan_type"), fv.LOAN_TYPES).alias("loan_type_ru"),
            "status",
            "updated_on",
            F.col("common_price").cast("int").alias("common_price"),
        )
        .distinct()
    )


def abandoned_orders(
    history: DataFrame,
    packages: DataFrame,
    market: Market,
    as_of: Moment,
    tie_break: str,
    start_hours: int = 16,
    end_hours: int = 1,
) -> DataFrame:
    """Latest new order per phone, created 16 to 1 hours ago, that went no further.

    One order per phone is chosen before any package is attached; orders
    without a shown package do not compete.
    """
    shown = packages
    if market.hidden_sender is not None:
        shown = shown.where(~F.col("sender_title").like(f"%{market.hidden_sender}%"))
    new = history.where(F.col("status") == "new").withColumn(
        "phone", normalise_phone(F.col("user_mobile"))
    )
    wanted = hours_before(F.col("created_on"), as_of, start_hours, end_hours) & ~F.lower("user_name").isin(*fv.TEST_NAMES)
    # Only phones with an order in these hours can be listed; the others are not ranked.
    phones = new.where(wanted).select("phone").distinct()
    asked = new.join(phones.withColumnRenamed("phone", "_phone"), F.col("phone").eqNullSafe(F.col("_phone")), "left_semi")
    orders = latest_per_key(
        semi_lookup(asked, shown, "uid", "uid"),
        ["phone"],
        [F.col("updated_on").desc(), F.col(tie_break).desc()],
    )
    recent = orders.where(wanted)
    open_orders = anti_later_event(recent, history, "uid", "updated_on", "status", "new")
    lines = shown.select(
        "uid",
        "product_id",
        "sku_id",
        "product_merchant_id",
        line_total(F.col("sku_price"), F.col("sku_amount")).alias("total"),
        "sender_title",
        "product_name",
    )
    line_order = ["product_id", "sku_id", "product_merchant_id", "total", "sender_title", "product_name"]
    one_line = latest_per_key(
        open_orders.join(lines, "uid"), ["phone"], [F.col(name).asc() for name in line_order]
    )
    return one_line.select(
        "user_name",
        "phone",
        "uid",
        "pay_title",
        minute_text(F.col("updated_on")).alias("ordered_at"),
        "promocode_name",
        "common_discount_size",
        "user_city",
        "sender_title",
        "product_name",
        "total",
    )


def purchases_report(
    history: DataFrame,
    packages: DataFrame,
    nomenclature: DataFrame,
    categories: DataFrame,
    loans: DataFrame,
    market: Market,
    as_of: Moment,
    tie_break: str,
    hidden_senders: tuple[str, ...] = (),
) -> DataFrame:
    """Order status rows of the month in four overlapping payment segments.

    Items are cut down to those of the month's lines before their titles are looked
    up, and meet the lines, which are narrow. All else is joined by the order, so the
    wide rows are not moved again; they are put into segments, several each, last.
    """
    carried = [
        "pay_title",
        "created_on",
        "updated_on",
        "user_city",
        "user_name",
        "user_mobile",
        "user_address",
        "user_flat_number",
        "user_house_number",
        "user_surname",
        "delivery_price",
        "promocode_name",
        "promocode",
        "is_promocode_applied",
        "common_discount_size",
    ]
    in_scope = history.where(F.col("scope") == market.scope)
    month = in_scope.where(in_month_of_previous_day(F.col("updated_on"), as_of))
    stat = composite_label(F.col("status"), F.col("paid")).alias("stat")
    rows = month.select("uid", stat, *carried).distinct()
    # Only this month's orders matter: their lines are picked before they are made distinct.
    lines = semi_lookup(packages, month, "uid", "uid").select(
        "uid",
        "sender_title",
        line_total(F.col("sku_price"), F.col("sku_amount")).alias("total_price"),
        "product_name",
        "product_merchant_id",
        "sku_id",
        "product_id",
    ).distinct()
    if hidden_senders:
        lines = lines.where(~F.col("sender_title").isin(*hidden_senders))
    pay, label = F.col("pay_title"), F.col("stat")
    segments = [
        (F.lit(True), fv.PURCHASES_ANY),
        (pay == fv.BUY_IN_PARTS, fv.PURCHASES_PREPAID),
        (pay == fv.BANK_CARD, fv.PURCHASES_PREPAID),
        (pay == fv.CASH, fv.PURCHASES_CASH),
    ]
    tagged = F.filter(
        F.array(*[F.struct(c.alias("hit"), value_map(label, m).alias("ttt")) for c, m in segments]),
        lambda s: s["hit"],
    )
    commented = latest_per_key(
        semi_lookup(in_scope.where(F.col("user_mobile").isNotNull()), month, "uid", "uid"),
        ["uid"],
        [F.col("updated_on").desc(), F.col(tie_break).desc()],
    ).select("uid", json_text(F.col("temp"), "$.body.canceled_comments").alias("comment2"))
    item = ["product_merchant_id", "sku_id", "product_id"]
    paths = listed(nomenclature, market).where(F.col("categories_array").isNotNull()).select(
        "categories_array",
        F.col("merchant_id").alias("product_merchant_id"),
        "sku_id",
        "product_id",
    )
    sold = paths.join(lines.select(*item).distinct(), item, "left_semi")
    titled = category_titles(sold, categories, 4).where(F.col("cat1").isNotNull())
    items = sold.join(titled, "categories_array").drop("categories_array")
    return (
        rows.join(lines.join(items, item, "left"), "uid")
        .join(commented, "uid", "left")
        .join(
            loans.select(F.col("order_id").alias("uid"), "iin", "status1", "status2"), "uid", "left"
        )
        .withColumn("_s", F.explode(tagged))
        .withColumn("ttt", F.col("_s.ttt"))
        .select(
            "uid",
            "stat",
            "pay_title",
            "created_on",
            "updated_on",
            "user_name",
            "user_surname",
            "user_mobile",
            "user_city",
            "user_address",
            "user_house_number",
            "user_flat_number",
            "sender_title",
            "product_name",
            "total_price",
            "delivery_price",
            "ttt",
            "comment2",
            "cat1",
            "cat2",
            "cat3",
            "cat4",
            "iin",
            "status1",
            "status2",
            "promocode_name",
            "promocode",
            "is_promocode_applied",
            "common_discount_size",
        )
    )


def with_category_titles(rows: DataFrame, categories: DataFrame, depth: int) -> DataFrame:
    """Add ``cat1..catN``, the titles along ``categories_array``, which must be unique in ``rows``."""
    path = braced_list(F.col("categories_array"))
    keys = {f"_id{k}": level(path, k) for k in range(1, depth + 1)}
    targets = {key: f"cat{k}" for k, key in enumerate(keys, 1)}
    looked_up = lookup_levels(rows.withColumns(keys), targets, categories, "id", "title", row_key="categories_array")
    return looked_up.drop(*keys)


def category_titles(paths: DataFrame, categories: DataFrame, depth: int) -> DataFrame:
    """Titles ``cat1..catN`` of each distinct ``categories_array``.

    Paths repeat over very many items, so the lookups run on distinct paths.
    """
    distinct = paths.select("categories_array").distinct()
    return with_category_titles(distinct, categories, depth)


def period_mismatch_alerts(
    requests: DataFrame, history: DataFrame, as_of: Moment, request_hours: int = 12, order_hours: int = 24
) -> DataFrame:
    """Loan requests whose period differs from the number in the order's wording."""
    doc = "struct<person_info:struct<financing_info:struct<period:int>>>"
    asked = requests.where(since_hours(F.col("created_on"), as_of, request_hours)).select(
        "profile_id",
        "order_id",
        "created_on",
        F.from_json("loan_request", doc)["person_info"]["financing_info"]["period"].alias("asked"),
    )
    titles = (
        history.where(since_hours(F.col("created_on"), as_of, order_hours))
        .select(F.col("uid").alias("order_id"), title_number(F.col("pay_title")).alias("shown"))
        .where(F.col("shown").isNotNull())
        .distinct()
    )
    return alert_rows(
        mismatch_join(asked, titles, "order_id", "asked", "shown"),
        {
            "Error in order_id": "order_id",
            "created at": F.date_format("created_on", "yyyy-MM-dd HH:mm:ss"),
            "profile_id": "profile_id",
            "months in request": "asked",
            "months in orders": "shown",
        },
    )
