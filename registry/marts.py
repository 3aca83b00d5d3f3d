"""Composite marts over the derived marketplace tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.operators.incremental import DistinctDays
from ledgerloom.operators.unions import union_all
from ledgerloom.plans import accounting, accounts, catalogue, orders, processes
from ledgerloom.plans.market import Market
from ledgerloom.session import scratch_dir
from ledgerloom.sinks import with_headers
from registry.core import Tables, query
from registry.fragments import KINDS, PLACE, REASON, STAGE, WHEREABOUTS
from registry.transforms import ANALOG_STEPS, PATHS

AS_OF = date(2024, 1, 31)
NOW = "2024-01-30 20:00:00"
TIE = "row_id"


def market() -> Market:
    return Market(test_merchant="M9", hidden_sender="Family", hidden_legal_name="LLC 5")


# Oracle side: the latest row per order, payment and stage, with its reason.
LATEST = f"""
    {KINDS}, staged AS (
        SELECT *, coalesce(common_old_price, common_price) AS amount, {STAGE} AS stage,
            CASE pay_types WHEN 'ACQUIRING' THEN 'Кредитная карта' WHEN 'EXPRESS' THEN 'Экспресс кредит'
                ELSE pay_title END AS pay
        FROM order_history LEFT JOIN kinds ON kind = status WHERE scope = 'market'
    ), latest AS (
        SELECT *, CASE WHEN stage = 'отменено' THEN {REASON} END AS reason
        FROM staged
        WHERE row_id IN (SELECT arg_max(row_id, (date_trunc('second', updated_on), row_id)) FROM staged GROUP BY uid, pay, stage)
    ), lines AS (
        SELECT DISTINCT uid, product_merchant_id, sender_title, sku_price * sku_amount AS line_total
        FROM packages WHERE product_merchant_id <> 'M9'
    )
"""
# Statuses numbered per order and payment.
NUMBERED = """
    placed AS (
        SELECT uid, pay, amount, common_price AS total, status, progress, funnel, reason, stage, cast(updated_on AS DATE) AS day,
            row_number() OVER (PARTITION BY uid, pay ORDER BY date_trunc('second', updated_on), row_id) AS n
        FROM chosen c WHERE EXISTS (SELECT 1 FROM lines s WHERE s.uid = c.uid AND s.line_total = c.amount)
    ), numbered AS (
        SELECT p.*, sender_title, product_merchant_id, concat_ws('|', p.uid, pay, sender_title, product_merchant_id, total) AS k,
            max(n) OVER (PARTITION BY p.uid, pay, sender_title, product_merchant_id, total) AS size
        FROM placed p JOIN lines s ON s.uid = p.uid AND s.line_total = p.amount
    ), heads AS (SELECT DISTINCT k, status AS opened FROM numbered WHERE n = 1),
    resumed AS (
        SELECT DISTINCT a.k, a.n FROM numbered a JOIN numbered b ON b.k = a.k AND b.n = a.n + 1
        WHERE a.n BETWEEN 2 AND 5 AND contains(a.status, 'cancel')
    )
"""


@query(
    "sellers_per_sku",
    """
    SELECT sku_id, count(DISTINCT n.merchant_id) AS sellers FROM nomenclature n, merchants m
    WHERE m.id = n.merchant_id AND m.state = 'ACTIVE' AND n.sale_channels = 'market' AND n.is_visible AND n.available
        AND n.sku_id IS NOT NULL
    GROUP BY sku_id
    """,
)
def _(t: Tables):
    return catalogue.sellers_per_sku(t.nomenclature, t.merchants, market())


@query("mart_sellers", "SELECT id, brand FROM merchants GROUP BY id, brand")
def _(t: Tables):
    return catalogue.sellers(t.merchants)


@query(
    "mart_unidentified",
    """
    SELECT DISTINCT m.brand, n.merchant_id, n.uid, n.bar_code, n.articul, n.name,
        strftime(n.created_on, '%Y-%m-%d %H:%M:%S') AS created_on, strftime(n.updated_on, '%Y-%m-%d %H:%M:%S') AS updated_on,
        n.price, regexp_extract(n.categories_array, '[^{},]+') AS category_id, c.title AS cat1
    FROM nomenclature n JOIN merchants m ON m.id = n.merchant_id AND m.state = 'ACTIVE'
    LEFT JOIN categories c ON c.id = regexp_extract(n.categories_array, '[^{},]+')
    WHERE n.sale_channels = 'market' AND n.status = 'created' AND n.available
    """,
)
def _(t: Tables):
    return catalogue.unidentified_products(t.nomenclature, t.merchants, t.categories, market())


@query(
    "mart_unrecognized",
    """
    SELECT m.brand, n.* FROM (
        SELECT DISTINCT merchant_id, uid, bar_code, articul, name, strftime(created_on, '%Y-%m-%d %H:%M:%S') AS created_on,
            strftime(updated_on, '%Y-%m-%d %H:%M:%S') AS updated_on, price
        FROM nomenclature WHERE sale_channels = 'market' AND status = 'created' AND available) n
    LEFT JOIN merchants m ON m.id = n.merchant_id
    """,
)
def _(t: Tables):
    return catalogue.unrecognized_report(t.nomenclature, t.merchants, market())


@query(
    "mart_products_count",
    """
    WITH items AS (
        SELECT merchant_id, count(DISTINCT uid) AS nomenclature,
            count(DISTINCT CASE WHEN available THEN uid END) AS available,
            count(DISTINCT CASE WHEN available AND is_visible THEN uid END) AS active
        FROM nomenclature WHERE sale_channels = 'market' GROUP BY merchant_id
    ), documents_per_merchant AS (
        SELECT merchant_id, count(DISTINCT id) AS ebt FROM products
        WHERE scope_ = '{catalogue}' AND created_on >= DATE '2018-10-01' GROUP BY merchant_id
    ), known AS (
        SELECT *, CASE WHEN starts_with(brand, ' ') THEN 'Shop-' || regexp_extract(brand, '[0-9]+') || ' East'
            ELSE 'Shop ' || regexp_extract(brand, '[0-9]+') END AS shown FROM merchants WHERE brand IS NOT NULL
    )
    SELECT shown AS brand, '2024-01-31' AS date, state,
        cast(coalesce(sum(active) FILTER (state = 'ACTIVE'), 0) AS BIGINT) AS active,
        cast(coalesce(sum(available), 0) AS BIGINT) AS available, cast(coalesce(sum(ebt), 0) AS BIGINT) AS ebt,
        cast(coalesce(sum(nomenclature), 0) AS BIGINT) AS nomenclature
    FROM known LEFT JOIN items i ON i.merchant_id = id LEFT JOIN documents_per_merchant d ON d.merchant_id = id
    WHERE i.merchant_id IS NOT NULL OR d.merchant_id IS NOT NULL
    GROUP BY brand, shown, state
    """,
)
def _(t: Tables):
    return catalogue.products_count(t.nomenclature, t.products, t.merchants, market(), AS_OF)


@query(
    "mart_enabled_disabled",
    """
    WITH listed AS (
        SELECT event_dtime, merchant_id, 'опубликовано' AS base, enabled_products AS items FROM publish_log
        UNION ALL SELECT event_dtime, merchant_id, 'снято', disabled_products FROM publish_log
    ), days AS (
        SELECT DISTINCT base, merchant_id, unnest(regexp_extract_all(items, 'P[0-9]+')) AS product_id,
            strftime(timezone('Asia/Almaty', timezone('UTC', event_dtime)), '%Y-%m-%d') AS day FROM listed
    )
    SELECT DISTINCT base, day, d.merchant_id, d.product_id, n.name_ebt AS product,
        CASE WHEN starts_with(brand, ' ') THEN 'Shop-' || regexp_extract(brand, '[0-9]+') || ' East'
            WHEN brand IS NOT NULL THEN 'Shop ' || regexp_extract(brand, '[0-9]+') END AS brand
    FROM days d LEFT JOIN nomenclature n ON n.merchant_id = d.merchant_id AND n.product_id = d.product_id
    LEFT JOIN merchants m ON m.id = d.merchant_id
    """,
)
def _(t: Tables):
    return catalogue.enabled_disabled(t.publish_log, t.nomenclature, t.merchants, market())


OFFERS = """
    offers AS (
        SELECT DISTINCT sku_id, name_ebt, merchant_id, price, regexp_extract(categories_array, '[^{},]+') AS category_id
        FROM nomenclature WHERE sale_channels = 'market' AND available AND is_visible
    ), sold AS (
        SELECT o.*, m.brand FROM offers o JOIN merchants m ON m.id = o.merchant_id
        WHERE m.state = 'ACTIVE' AND m.id <> 'M9'
    )
"""


@query(
    "mart_pricelist",
    f"""
    WITH {OFFERS}
    SELECT DISTINCT s.sku_id, s.price, c.title AS cat1, s.merchant_id, s.brand, s.name_ebt,
        p.minprice, p.maxprice, p.minprice = p.maxprice AS sameprice
    FROM sold s LEFT JOIN categories c ON c.id = s.category_id
    LEFT JOIN (SELECT sku_id, min(price) AS minprice, max(price) AS maxprice FROM offers
               WHERE merchant_id <> 'M9' GROUP BY sku_id) p ON p.sku_id = s.sku_id
    """,
)
def _(t: Tables):
    return catalogue.price_list(t.nomenclature, t.merchants, t.categories, market())


@query(
    "price_spread",
    f"""
    WITH {OFFERS}, spread AS (
        SELECT sku_id, category_id, name_ebt, min(price) AS minprice, max(price) AS maxprice,
            count(DISTINCT merchant_id) AS sellers FROM sold GROUP BY ALL
    ), quoted AS (
        SELECT s.*, c.title AS cat1,
            (SELECT count(DISTINCT o.merchant_id) FROM offers o WHERE o.merchant_id <> 'M9' AND o.sku_id = s.sku_id
                AND o.name_ebt = s.name_ebt AND o.price = s.maxprice) AS sellers_maxprice,
            (SELECT max(b.brand) FROM sold b WHERE b.sku_id = s.sku_id AND b.name_ebt = s.name_ebt
                AND b.price = s.maxprice) AS top_brand
        FROM spread s LEFT JOIN categories c ON c.id = s.category_id
    )
    SELECT sku_id, cat1, category_id, name_ebt, minprice, maxprice, sellers, maxprice - minprice AS diffprice,
        minprice = maxprice AS sameprice, sellers_maxprice, CASE WHEN minprice = maxprice THEN 'Цены одинаковые'
            WHEN sellers_maxprice = 1 THEN top_brand ELSE 'Несколько партнеров, см. реестр' END AS brand_maxprice
    FROM quoted
    """,
)
def _(t: Tables):
    return catalogue.product_prices(t.nomenclature, t.merchants, t.categories, market())


@query(
    "mart_categories_short",
    """
    SELECT DISTINCT title AS category, CASE WHEN starts_with(title, ' Товары') THEN 'Товары для дома' ELSE title END AS category_short
    FROM categories
    """,
)
def _(t: Tables):
    return catalogue.short_categories(t.categories, "title")


@query(
    "category_ids",
    """
    SELECT DISTINCT part AS category_id FROM (
        SELECT unnest([parts[len(parts)], parts[3], parts[4], parts[5]]) AS part
        FROM (SELECT string_split(url, '/') AS parts FROM pages))
    WHERE strlen(part) > 11
    """,
)
def _(t: Tables):
    return catalogue.category_ids(t.pages, "url")


COUNTED = """
    measured AS (
        SELECT 'sku_nomenclature' AS base, categories_array, {grain_n} count(DISTINCT product_id) AS n
        FROM nomenclature WHERE sale_channels = 'market' GROUP BY ALL
        UNION ALL SELECT 'sku_available', categories_array, {grain_n} count(DISTINCT product_id)
        FROM nomenclature WHERE sale_channels = 'market' AND available GROUP BY ALL
        UNION ALL SELECT 'sku_active', categories_array, {grain_n} count(DISTINCT product_id)
        FROM nomenclature WHERE sale_channels = 'market' AND available AND is_visible GROUP BY ALL
        UNION ALL SELECT 'sku_ebt', categories_array, {grain_p} count(DISTINCT id)
        FROM products WHERE scope_ = '{{catalogue}}' AND created_on >= DATE '2018-10-01' GROUP BY ALL
    ), paths AS (
        SELECT DISTINCT categories_array, string_split(trim(categories_array, '{{}}'), ',') AS ids FROM measured
    ), titles AS (
        SELECT categories_array, t1.title AS t1, t2.title AS t2, t3.title AS t3, t4.title AS t4, t5.title AS t5
        FROM paths
        LEFT JOIN categories t1 ON t1.id = ids[1] LEFT JOIN categories t2 ON t2.id = ids[2]
        LEFT JOIN categories t3 ON t3.id = ids[3] LEFT JOIN categories t4 ON t4.id = ids[4]
        LEFT JOIN categories t5 ON t5.id = ids[5]
    ), typed AS (
        SELECT *, CASE WHEN t1 IS NULL AND t2 IS NOT NULL THEN 'headless'
            WHEN t2 = 'Бытовая техника' AND t3 = 'Холодильники' THEN 'fridge'
            WHEN t2 = 'Бытовая техника' THEN 'appliance' ELSE 'plain' END AS kind,
            coalesce(t2 = t3, false) AS same23, coalesce(t3 = t4, false) AS same34 FROM titles
    ), repaired AS (
        SELECT categories_array, CASE kind
            WHEN 'headless' THEN [t2, t3, t4, t5, NULL]
            ELSE list_concat(
                CASE kind WHEN 'fridge' THEN ['Бытовая техника', 'Крупная бытовая техника']
                    WHEN 'appliance' THEN ['Бытовая техника', NULL]
                    ELSE [t1, CASE WHEN t3 = 'Мониторы' THEN 'Периферия' ELSE t2 END] END,
                CASE WHEN same23 THEN [t4, t5, NULL] WHEN same34 THEN [t3, t5, NULL] ELSE [t3, t4, t5] END) END AS c
        FROM typed
    ), closed AS (
        SELECT categories_array, CASE
            WHEN c[2] = c[3] OR (c[3] IS NULL AND c[4] IS NOT NULL) THEN [c[1], c[2], c[4], c[5], NULL]
            WHEN c[4] IS NULL AND c[5] IS NOT NULL THEN [c[1], c[2], c[3], c[5], NULL] ELSE c END AS c
        FROM repaired
    )
"""
SHOWN_COUNTS = """
        trim(c[1], ' ') AS cat1, trim(c[2], ' ') AS cat2, trim(c[3], ' ') AS cat3, trim(c[4], ' ') AS cat4, trim(c[5], ' ') AS cat5,
        cast(coalesce(sum(n) FILTER (base = 'sku_ebt'), 0) AS BIGINT) AS sku_ebt,
        cast(coalesce(sum(n) FILTER (base = 'sku_nomenclature'), 0) AS BIGINT) AS sku_nomenclature,
        cast(coalesce(sum(n) FILTER (base = 'sku_available'), 0) AS BIGINT) AS sku_available,
        cast(coalesce(sum(n) FILTER (base = 'sku_active'), 0) AS BIGINT) AS sku_active,
        cast(sum(n) AS BIGINT) AS sku_all
"""
NO_GRAIN = COUNTED.format(grain_n="", grain_p="")
DETAIL = COUNTED.format(
    grain_n="merchant_id, name_ebt AS product_name, updated_on,",
    grain_p="merchant_id, name_ AS product_name, updated_on,",
)


@query(
    "mart_catalog_counts",
    f"""
    WITH {NO_GRAIN}
    SELECT '2024-01-31' AS date, {SHOWN_COUNTS} FROM measured JOIN closed USING (categories_array)
    WHERE c[1] IS NOT NULL AND c[1] <> 'Архив' GROUP BY c HAVING sum(n) > 0
    """,
)
def _(t: Tables):
    return catalogue.catalog_counts(
        t.products, t.nomenclature, t.categories, market(), AS_OF, ANALOG_STEPS
    )


@query(
    "mart_catalog_counts_compat",
    f"""
    WITH {NO_GRAIN}, merged AS (SELECT DISTINCT base, n, c FROM measured JOIN closed USING (categories_array) WHERE n > 0)
    SELECT DISTINCT '2024-01-31' AS date, {SHOWN_COUNTS} FROM merged
    WHERE c[1] IS NOT NULL AND c[1] <> 'Архив' GROUP BY c HAVING sum(n) > 0
    """,
)
def _(t: Tables):
    return catalogue.catalog_counts(
        t.products, t.nomenclature, t.categories, market(), AS_OF, ANALOG_STEPS, compat=True
    )


@query(
    "mart_catalog_counts_detail",
    f"""
    WITH {DETAIL}
    SELECT '2024-01-31' AS date, {SHOWN_COUNTS}, merchant_id, product_name,
        strftime(updated_on, '%Y-%m-%d %H:%M:%S') AS updated_on, brand, state
    FROM measured JOIN closed USING (categories_array) LEFT JOIN merchants m ON m.id = merchant_id
    WHERE c[1] IS NOT NULL AND c[1] <> 'Архив' GROUP BY c, merchant_id, product_name, updated_on, brand, state
    HAVING sum(n) > 0
    """,
)
def _(t: Tables):
    return catalogue.catalog_counts_by_merchant(
        t.products, t.nomenclature, t.categories, t.merchants, market(), AS_OF, ANALOG_STEPS
    )


@query(
    "mart_active_by_category",
    """
    SELECT '2024-01-31' AS date_, c.title AS category, count(DISTINCT p.id) AS products
    FROM products p JOIN categories c ON c.id = split_part(p.default_category, '/', 3)
    WHERE p.is_visible = 'true' AND p.scope_ = '{catalogue}' AND c.title <> 'Архив'
    GROUP BY c.title, p.merchant_id
    """,
)
def _(t: Tables):
    showcase = t.products.withColumn(
        "default_category", F.concat(F.lit("/root/"), F.split_part("default_category", F.lit("/"), F.lit(3)))
    )
    return catalogue.active_products_by_category(showcase, t.categories, market(), AS_OF)


@query(
    "mart_users",
    """
    SELECT profile_id, upper(brand) AS brand, 'MOBILE' AS id_space, 'ACTIVE' AS state, identifier_id,
        strftime(min(created), '%Y-%m-%d') AS created, max(email) AS email
    FROM accounts WHERE state ILIKE '%active%' AND brand ILIKE 'market' AND id_space ILIKE '%mobile%'
    GROUP BY profile_id, upper(brand), identifier_id
    """,
)
def _(t: Tables):
    return accounts.users(t.accounts, market())


@query(
    "user_counts",
    """
    SELECT upper(brand) AS brand, id_space, '2024-01-31' AS date_, count(DISTINCT identifier_id) AS users
    FROM accounts WHERE state ILIKE '%active%' AND brand ILIKE 'market' AND id_space ILIKE '%mobile%'
    GROUP BY upper(brand), id_space
    """,
)
def _(t: Tables):
    return accounts.user_counts(t.accounts, market(), AS_OF)


RANGES = {"month": (date(2020, 1, 1), date(2020, 1, 31)), "day": (date(2020, 2, 29), date(2020, 2, 29)), "quarters": (date(2020, 1, 15), date(2020, 9, 30))}


@query(
    "user_counts_range",
    f"""
    WITH ranges(label, first_, last_) AS (VALUES
        {", ".join(f"('{k}', DATE '{a}', DATE '{b}')" for k, (a, b) in RANGES.items())})
    SELECT label, upper(brand) AS brand, id_space, count(DISTINCT profile_id) AS profiles
    FROM accounts JOIN ranges ON cast(created AS DATE) BETWEEN first_ AND last_
    WHERE state ILIKE '%active%' AND brand ILIKE 'market' AND id_space ILIKE '%mobile%'
    GROUP BY label, upper(brand), id_space
    """,
)
def _(t: Tables):
    """Distinct profiles over three ranges of days, from bitmaps stored in two deliveries; the
    second one brings part of the days again."""
    days = DistinctDays(t.spark, scratch_dir(t.spark, "profile-days"), ["brand", "id_space"], "profile_id")
    rows = accounts.active_mobile_accounts(t.accounts, market()).select(
        F.upper("brand").alias("brand"), "id_space", "profile_id", F.to_date("created").alias("day")
    )
    days.put(rows.where("day < '2020-06-01'"), "day")
    days.put(rows.where("day >= '2020-05-01'"), "day")
    counted = [days.counts(*span, "profiles").withColumn("label", F.lit(label)) for label, span in RANGES.items()]
    return union_all(counted)


@query(
    "mart_orders",
    f"""
    WITH {LATEST}, titled AS (
        SELECT n.product_id, n.merchant_id, n.name_ebt, c.title FROM nomenclature n
        JOIN categories c ON c.id = regexp_extract(n.categories_array, '[^{{}},]+')
        WHERE n.sale_channels = 'market' AND n.product_id IS NOT NULL AND c.title IS NOT NULL
    ), described AS (
        SELECT p.uid, p.product_merchant_id, p.sender_title, p.sku_price * p.sku_amount AS line_total,
            max(t.name_ebt) AS name_ebt, max(t.title) AS category_1
        FROM packages p LEFT JOIN titled t ON t.product_id = p.product_id AND t.merchant_id = p.product_merchant_id
        WHERE p.product_merchant_id <> 'M9' GROUP BY ALL
    ), loan_codes AS (
        SELECT order_id, product_sub_code AS code FROM saved_requests WHERE product_sub_code IS NOT NULL
        UNION SELECT order_id, productcode FROM sent_requests WHERE productcode IS NOT NULL
    ), registered AS (
        SELECT DISTINCT identifier_id FROM accounts
        WHERE state ILIKE '%active%' AND brand ILIKE 'market' AND id_space ILIKE '%mobile%'
    )
    SELECT DISTINCT l.uid, l.status, l.stage AS status_ru,
        cast(list_position(['создано', 'оформлено', 'принято', 'завершено', 'возврат', 'отменено'], l.stage) AS VARCHAR) AS status_ru_num,
        CASE l.status WHEN 'delivered' THEN CASE l.delivery_types WHEN 'delivery' THEN 'доставка' WHEN 'kazpost' THEN 'казпочта' END
            WHEN 'taken' THEN 'самовывоз' END AS delivery_type,
        l.reason AS cancelled_reason,
        CASE WHEN l.progress IN ('принято', 'завершено', 'возврат') OR l.status IN ('approved_not_filled', 'awaiting_loan_approve')
            THEN 1 END AS merchant_approve,
        CASE WHEN l.progress IN ('завершено', 'возврат') OR l.status IN ('on_delivery', 'pending_pickup') THEN 1 END AS contract_signed,
        strftime(l.created_on, '%Y-%m-%d %H:%M:%S') AS created_second, strftime(l.created_on, '%Y-%m-%d') AS created_on,
        strftime(l.updated_on, '%Y-%m-%d %H:%M:%S') AS updated_second, strftime(l.updated_on, '%Y-%m-%d') AS updated_on,
        l.pay AS pay_title,
        coalesce(
            CASE l.pay_types_code WHEN 'ACQUIRING_0_4' THEN 'Кредитная карта на 4 месяца' END,
            CASE WHEN l.pay_title = 'В рассрочку' THEN 'Кредитная карта'
                WHEN starts_with(l.pay_title, 'Кредитная карта на') THEN l.pay_title END,
            CASE l.pay_types_code WHEN 'EXPRESS_0_12' THEN 'Рассрочка на 12 месяцев' WHEN 'EXPRESS_18_6' THEN 'Кредит на 6 месяцев' END,
            CASE k.code WHEN 'FM 4-1' THEN 'Рассрочка на 4 месяца' WHEN 'FM 12-01' THEN 'Кредит на 12 месяцев'
                WHEN 'FM 24-1-1' THEN 'Рассрочка на 24 месяца' WHEN 'FM 6-01' THEN 'Кредит на 6 месяцев'
                WHEN 'FM 12-1-1' THEN 'Рассрочка на 12 месяцев' END,
            CASE WHEN starts_with(l.pay_title, 'Кредит на') OR starts_with(l.pay_title, 'Рассрочка на') THEN l.pay_title END,
            CASE WHEN l.pay_types = 'EXPRESS' THEN 'Экспресс кредит' END, l.pay_title) AS pay_title2,
        l.common_price AS total, regexp_replace(l.user_mobile, '[+ -]', '', 'g') AS mobile, l.user_email,
        l.promocode_name, l.promocode, l.is_promocode_applied, cast(l.common_discount_size AS DOUBLE) AS common_discount_size,
        replace(l.city_id, '"', '') AS city_id, l.delivery_types, l.weight, d.product_merchant_id, d.sender_title,
        d.name_ebt, d.category_1, l.amount AS common_old_price, r.identifier_id AS reg_user,
        CASE WHEN r.identifier_id IS NOT NULL THEN l.uid END AS uid_reg_user,
        CASE WHEN r.identifier_id IS NOT NULL THEN l.common_price END AS total_reg_user,
        CASE regexp_extract(l.city_id, 'KZ-([A-Z]+)', 1) WHEN 'ALA' THEN 'Алматы' WHEN 'AST' THEN 'Нур-Султан'
            WHEN 'KAR' THEN 'Караганда' END AS city_ru
    FROM latest l JOIN described d ON d.uid = l.uid AND d.line_total = l.amount
    LEFT JOIN loan_codes k ON k.order_id = l.uid
    LEFT JOIN registered r ON r.identifier_id = regexp_replace(l.user_mobile, '[+ -]', '', 'g')
    WHERE l.pay_title <> 'Оплата онлайн'
    """,
)
def _(t: Tables):
    return orders.orders_mart(
        t.order_history,
        t.packages,
        t.saved_requests,
        t.sent_requests,
        t.nomenclature,
        t.categories,
        t.accounts,
        market(),
        TIE,
    )


@query(
    "mart_credit_funnel",
    f"""
    WITH {LATEST}, chosen AS (SELECT * FROM latest WHERE pay_types = 'EXPRESS'), {NUMBERED}, gaps AS (
        SELECT k, min(n) AS gap FROM resumed GROUP BY k
    ), moved AS (
        SELECT n.*, g.gap, CASE WHEN n.n = g.gap THEN NULL WHEN n.n > g.gap THEN n.n - 1 ELSE n.n END AS m,
            coalesce(funnel, 'отменен') AS label
        FROM numbered n LEFT JOIN gaps g USING (k) JOIN heads h USING (k) WHERE h.opened = 'new'
    ), wide AS (
        SELECT uid, pay, sender_title, product_merchant_id, total, max(reason) AS reason, min(day) AS first_day,
            max(status) FILTER (n = 2) AS second,
            max(status) FILTER (m = 1) AS status_1, max(status) FILTER (m = 2) AS status_2, max(status) FILTER (m = 3) AS status_3,
            max(status) FILTER (m = 4) AS status_4, max(status) FILTER (m = 5) AS status_5,
            max(status) FILTER (n = 6) AS status_6, max(status) FILTER (n = 7) AS status_7,
            [max(label) FILTER (m = 1), max(label) FILTER (m = 2), max(label) FILTER (m = 3), max(label) FILTER (m = 4),
                max(label) FILTER (m = 5)] AS l
        FROM moved GROUP BY uid, pay, sender_title, product_merchant_id, total
    ), laddered AS (
        SELECT *, CASE WHEN l[3] = 'договор подписан' THEN list_concat([l[1], 'анкета заполнена'], l[3:5])
            WHEN l[3] = 'завершен' THEN list_concat(l[1:2], ['договор подписан', 'завершен', l[4]]) ELSE l END AS r FROM wide
    )
    SELECT uid, pay AS pay_title, sender_title, product_merchant_id, total,
        CASE WHEN contains(concat_ws(',', status_1, status_2, status_3, status_4, status_5, status_6, status_7), 'cancel') THEN reason END
            AS cancelled_reason,
        strftime(first_day, '%Y-%m-%d') AS updated_on, status_1, status_2, status_3, status_4, status_5, status_6, status_7,
        CASE WHEN second IS NULL OR list_contains(['cancelled', 'cancelledbytimeout', 'cancelledbyclient'], status_2) THEN 1 END AS exclude_approve,
        r[1] AS status_1_ru, r[2] AS status_2_ru, r[3] AS status_3_ru, r[4] AS status_4_ru, r[5] AS status_5_ru
    FROM laddered
    """,
)
def _(t: Tables):
    return orders.credit_orders(t.order_history, t.packages, market(), TIE)


@query(
    "mart_passed_orders",
    f"""
    WITH {WHEREABOUTS}, {LATEST}, chosen AS (SELECT * FROM latest WHERE pay_title <> 'Оплата онлайн'), {NUMBERED}, gaps AS (
        SELECT k, min(n) AS gap FROM resumed JOIN heads USING (k)
        WHERE n <= CASE opened WHEN 'pending_approve' THEN 4 ELSE 5 END GROUP BY k
    ), moved AS (
        SELECT n.k, n.status, n.progress, n.n - cast(coalesce(n.n > g.gap, false) AS INT) + cast(h.opened = 'pending_approve' AS INT) AS m,
            n.n = n.size AS is_last
        FROM numbered n JOIN heads h USING (k) LEFT JOIN gaps g USING (k) WHERE n.n IS DISTINCT FROM g.gap
    ), grouped AS (
        SELECT k, uid, pay, sender_title, product_merchant_id, total, max(reason) AS reason,
            max(day) FILTER (stage = 'создано') AS created, max(day) FILTER (stage = 'оформлено') AS received,
            max(day) FILTER (stage = 'принято') AS accepted, max(day) FILTER (stage = 'завершено') AS completed,
            max(day) FILTER (stage = 'отменено') AS cancelled
        FROM numbered GROUP BY k, uid, pay, sender_title, product_merchant_id, total
    ), labelled AS (
        SELECT m.k, m.m, m.status,
            coalesce(m.progress, CASE WHEN is_last THEN g.reason END) AS label
        FROM moved m JOIN grouped g USING (k)
    ), slots AS (
        SELECT k, max(status) FILTER (m = 2) AS s2, max(status) FILTER (m = 3) AS s3, max(status) FILTER (m = 4) AS s4,
            max(status) FILTER (m = 5) AS s5, max(label) FILTER (m = 2) AS l2, max(label) FILTER (m = 3) AS l3, max(label) FILTER (m = 4) AS l4,
            string_agg(label, ',') FILTER (m BETWEEN 2 AND 5) AS seen
        FROM labelled GROUP BY k
    ), filled AS (
        SELECT g.uid, g.pay, g.sender_title, g.product_merchant_id, g.total, s2, s3, s4, s5, completed,
            CASE WHEN regexp_matches(coalesce(seen, ''), 'отменено|отказ|общие ошибки|активная заявка') THEN g.reason END AS reason,
            CASE WHEN regexp_matches(coalesce(seen, ''), 'отменено|отказ|общие ошибки|активная заявка') THEN cancelled END AS cancelled,
            CASE WHEN received IS NULL AND accepted IS NOT NULL THEN accepted
                WHEN received IS NULL AND opened = 'pending_approve' THEN created
                WHEN accepted IS NULL THEN coalesce(completed, received) ELSE received END AS received,
            coalesce(accepted, completed) AS accepted,
            CASE WHEN l2 = 'принято' THEN [l2, l3] WHEN l3 = 'завершено' THEN ['принято', l3] ELSE [l3, l4] END AS l
        FROM grouped g JOIN heads USING (k) JOIN slots USING (k)
        WHERE opened IN ('new', 'pending_approve')
    ), ended AS (
        SELECT *, CASE WHEN cancelled IS NULL THEN DATE '2024-01-31' END AS open_end FROM filled WHERE received IS NOT NULL
    )
    SELECT e.uid, pay AS pay_title, sender_title, product_merchant_id, total, reason AS cancelled_reason,
        'создано' AS status_1_ru, 'оформлено' AS status_2_ru, l[1] AS status_3_ru, l[2] AS status_4_ru,
        strftime(received, '%Y-%m-%d') AS received_day, strftime(cancelled, '%Y-%m-%d') AS cancelled_day,
        CASE WHEN completed IS NOT NULL THEN total END AS completed_total,
        CASE WHEN contains(s3, 'cancel') AND l[1] <> 'принято' THEN reason
            ELSE coalesce({PLACE}, CASE WHEN s2 = 'pending_approve' THEN
                CASE pay WHEN 'Экспресс кредит' THEN 'одобрено' ELSE 'на партнере' END END) END AS state_1,
        CASE WHEN contains(s3, 'cancel') AND l[1] = 'принято' THEN reason WHEN contains(s4, 'cancel') THEN reason
            WHEN s4 = 'taken' OR s3 = 'taken' THEN 'выдан' WHEN s4 = 'delivered' OR s3 = 'delivered' THEN 'доставлен' END AS state_2,
        CASE WHEN s4 = 'returned' OR s5 = 'returned' THEN 'возвращен' END AS state_3,
        cast(date_diff('day', received, coalesce(accepted, open_end)) AS INT) AS accept_days,
        cast(date_diff('day', coalesce(accepted, open_end), coalesce(completed, open_end)) AS INT) AS complete_days
    FROM ended e
    """,
)
def _(t: Tables):
    return orders.passed_orders(t.order_history, t.packages, market(), AS_OF, TIE)


@query(
    "mart_customer_profile",
    """
    WITH people AS (
        SELECT DISTINCT order_id, list_extract(['male', 'female'], cast(temp ->> '$.sex' AS INT)) AS gender,
            cast(date_diff('day', strptime(temp ->> '$.birthdate_str', '%d.%m.%Y'), DATE '2024-01-31') // 365 AS INT) AS age,
            cast(temp ->> '$.price' AS DOUBLE) AS price, mobile_phone, product_sub_code, cast(period_ AS INT) AS period_,
            loan_type, sum_ FROM saved_requests
    ), incomes AS (
        SELECT order_id, cast(temp ->> '$.body.bank_req.application[11].value' AS DOUBLE) AS income FROM sent_requests
        WHERE contains(temp, '"key": "Income"')
    ), done AS (
        SELECT DISTINCT uid, status || '/' || paid AS status, strftime(updated_on, '%Y-%m-%d') AS updated_on
        FROM order_history WHERE scope = 'market' AND status IN ('delivered', 'taken')
    )
    SELECT DISTINCT p.*, income,
        CASE WHEN income > 600000 THEN 'более 600 000' WHEN income > 400000 THEN 'до 600 000' WHEN income > 200000 THEN 'до 400 000' ELSE 'до 200 000' END AS income_segment,
        CASE WHEN price > 600000 THEN NULL WHEN price > 500000 THEN 'до 600 000' WHEN price > 200000 THEN 'до 500 000' WHEN price > 50000 THEN 'до 200 000' ELSE 'до 50 000' END AS price_segment,
        CASE WHEN age > 55 THEN 'старше 55' WHEN age > 45 THEN 'до 55' WHEN age > 35 THEN 'до 45' WHEN age > 25 THEN 'до 35' ELSE 'до 25' END AS age_segment,
        CASE loan_type WHEN 'credit' THEN 'Кредит' ELSE 'Рассрочка' END AS loan_type_ru,
        d.status, d.updated_on, cast(h.common_price AS INT) AS common_price
    FROM people p JOIN incomes i ON i.order_id = p.order_id JOIN done d ON d.uid = p.order_id
    JOIN order_history h ON h.uid = p.order_id
    """,
)
def _(t: Tables):
    return orders.customer_profile(
        t.saved_requests, t.sent_requests, t.order_history, market(), AS_OF
    )


PHONE = """CASE WHEN d[1] = '8' THEN '7' || d[2:] WHEN strlen(d) = 10 THEN '7' || d WHEN strlen(d) > 11 THEN d[-11:] ELSE d END"""


ABANDONED = f"""
    WITH shown AS (SELECT * FROM packages WHERE NOT contains(sender_title, 'Family')), phones AS (
        SELECT *, {PHONE} AS phone FROM (
            SELECT *, regexp_replace(user_mobile, '[+ -]', '', 'g') AS d FROM order_history WHERE status = 'new')
        WHERE uid IN (SELECT uid FROM shown)
    ), last_new AS (
        SELECT * FROM phones WHERE row_id IN (SELECT arg_max(row_id, (updated_on, row_id)) FROM phones GROUP BY phone)
    ), open_rows AS (
        SELECT * FROM last_new a WHERE created_on >= TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 400 HOUR
            AND created_on < TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 1 HOUR AND lower(user_name) <> 'test'
            AND NOT EXISTS (SELECT 1 FROM order_history b WHERE b.uid = a.uid AND b.status <> 'new' AND b.updated_on > a.updated_on)
    )
    SELECT o.user_name, o.phone, o.uid, o.pay_title, strftime(o.updated_on, '%d-%m-%Y %H:%M') AS ordered_at,
        o.promocode_name, o.common_discount_size, o.user_city, s.sender_title, s.product_name, s.sku_price * s.sku_amount AS total
    FROM open_rows o JOIN shown s ON s.uid = o.uid
    QUALIFY row_number() OVER (PARTITION BY o.phone ORDER BY s.product_id, s.sku_id, s.product_merchant_id, s.sku_price * s.sku_amount) = 1
"""


def _abandoned(t: Tables):
    return orders.abandoned_orders(
        t.order_history, t.packages, market(), NOW, TIE, start_hours=400, end_hours=1
    )


@query("abandoned_events", ABANDONED)
def _(t: Tables):
    return _abandoned(t)


@query(
    "abandoned_report",
    f"""
    SELECT user_name AS "ФИО клиента", phone AS "Номер телефона", uid AS "Номер заказа", pay_title AS "Способ оплаты",
        ordered_at AS "Дата заказа", promocode_name AS "Использованный промокод",
        common_discount_size AS "Сумма скидки по промокоду", user_city AS "Город", sender_title AS "Продавец",
        product_name AS "Товар", total AS "Цена товара (без промокода)"
    FROM ({ABANDONED})
    """,
)
def _(t: Tables):
    return with_headers(_abandoned(t), fv.ABANDONED_HEADERS)


SEGMENTS = """
    segments(segment, pay, stat, ttt) AS (VALUES
        ('any', NULL, 'new/false', 'oformleno'), ('any', NULL, 'pending_approve/false', 'postupilo'),
        ('any', NULL, 'on_delivery/false', 'priniyat'), ('any', NULL, 'pending_pickup/false', 'priniyat'),
        ('parts', 'В рассрочку', 'new/false', 'oformleno'), ('parts', 'В рассрочку', 'new/true', 'postupilo'),
        ('parts', 'В рассрочку', 'pending_approve/true', 'postupilo'), ('parts', 'В рассрочку', 'on_delivery/true', 'priniyat'),
        ('parts', 'В рассрочку', 'pending_pickup/true', 'priniyat'), ('card', 'Банковская карта', 'pending_pickup/true', 'priniyat'),
        ('cash', 'Оплата наличными', 'pending_pickup/false', 'priniyat'),
        ('card', 'Банковская карта', 'new/false', 'oformleno'), ('card', 'Банковская карта', 'new/true', 'postupilo'),
        ('card', 'Банковская карта', 'pending_approve/true', 'postupilo'), ('card', 'Банковская карта', 'on_delivery/true', 'priniyat'),
        ('cash', 'Оплата наличными', 'new/false', 'oformleno'), ('cash', 'Оплата наличными', 'pending_approve/false', 'oformleno'),
        ('cash', 'Оплата наличными', 'on_delivery/false', 'priniyat'))
"""


PURCHASES = f"""
    WITH {SEGMENTS}, rows AS (
        SELECT DISTINCT uid, status || '/' || paid AS stat, pay_title, created_on, updated_on, user_city, user_name, user_mobile,
            user_address, user_flat_number, user_house_number, user_surname, delivery_price, promocode_name, promocode,
            is_promocode_applied, common_discount_size
        FROM order_history WHERE scope = 'market' AND strftime(updated_on, '%Y-%m') = strftime(DATE '2024-01-31' - 1, '%Y-%m')
    ), lines AS (
        SELECT DISTINCT uid, sender_title, sku_price * sku_amount AS total_price, product_name, product_merchant_id, sku_id, product_id
        FROM packages WHERE sender_title <> '"Family" shop'
    ), chosen AS (SELECT DISTINCT segment, pay FROM segments), tagged AS (
        SELECT r.*, coalesce(CASE r.stat WHEN 'delivered/true' THEN 'zaverweno' WHEN 'taken/true' THEN 'zaverweno' WHEN 'returned/true' THEN 'vozvrat' WHEN 'cancelled/true' THEN 'otmeneno'
            WHEN 'cancelled/false' THEN 'otmeneno' END, s.ttt) AS ttt
        FROM rows r JOIN chosen c ON c.pay IS NULL OR c.pay = r.pay_title
        LEFT JOIN segments s ON s.segment = c.segment AND s.stat = r.stat
    ), comments AS (
        SELECT uid, arg_max(coalesce(temp ->> '$.body.canceled_comments', ''), (updated_on, row_id)) AS comment2
        FROM order_history WHERE scope = 'market' AND user_mobile IS NOT NULL GROUP BY uid
    ), items AS (
        SELECT n.merchant_id, n.sku_id, n.product_id, c1.title AS cat1, c2.title AS cat2, c3.title AS cat3, c4.title AS cat4
        FROM (SELECT *, string_split(trim(categories_array, '{{}}'), ',') AS ids FROM nomenclature WHERE sale_channels = 'market') n
        JOIN categories c1 ON c1.id = ids[1] LEFT JOIN categories c2 ON c2.id = ids[2]
        LEFT JOIN categories c3 ON c3.id = ids[3] LEFT JOIN categories c4 ON c4.id = ids[4]
    )
    SELECT t.uid, t.stat, t.pay_title, strftime(t.created_on, '%Y-%m-%d %H:%M:%S') AS created_on,
        strftime(t.updated_on, '%Y-%m-%d %H:%M:%S') AS updated_on, t.user_name, t.user_surname, t.user_mobile, t.user_city,
        t.user_address, t.user_house_number, t.user_flat_number, l.sender_title, l.product_name, l.total_price, t.delivery_price,
        t.ttt, nullif(m.comment2, '') AS comment2, i.cat1, i.cat2, i.cat3, i.cat4, o.iin, o.status1, o.status2,
        t.promocode_name, t.promocode, t.is_promocode_applied, t.common_discount_size
    FROM tagged t JOIN lines l ON l.uid = t.uid LEFT JOIN comments m ON m.uid = t.uid
    LEFT JOIN items i ON i.merchant_id = l.product_merchant_id AND i.sku_id = l.sku_id AND i.product_id = l.product_id
    LEFT JOIN loans o ON o.order_id = t.uid
"""


@query("mart_purchases", PURCHASES)
def _purchases(t: Tables):
    return orders.purchases_report(
        t.order_history,
        t.packages,
        t.nomenclature,
        t.categories,
        t.loans,
        market(),
        AS_OF,
        TIE,
        hidden_senders=('"Family" shop',),
    )


PURCHASE_COLUMNS = (
    "uid stat pay_title created_on updated_on user_name user_surname user_mobile user_city user_address "
    "user_house_number user_flat_number sender_title product_name total_price delivery_price ttt comment2 "
    "cat1 cat2 cat3 cat4 iin status1 status2 promocode_name promocode is_promocode_applied common_discount_size"
).split()
PURCHASES_SHOWN = ", ".join(f'{c} AS "{h}"' for c, h in zip(PURCHASE_COLUMNS, fv.PURCHASES_HEADERS, strict=True))


@query("purchases_report", f"SELECT {PURCHASES_SHOWN} FROM ({PURCHASES})")
def _(t: Tables):
    return with_headers(_purchases(t).select(*PURCHASE_COLUMNS), fv.PURCHASES_HEADERS)


@query(
    "period_mismatch_alerts",
    """
    WITH asked AS (
        SELECT profile_id, order_id, created_on, cast(loan_request ->> '$.person_info.financing_info.period' AS INT) AS asked
        FROM loan_rows WHERE created_on >= TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 12 HOUR
    ), shown AS (
        SELECT DISTINCT uid, cast(regexp_extract(pay_title, '[0-9]+') AS INT) AS shown FROM order_history
        WHERE created_on >= TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 24 HOUR AND regexp_matches(pay_title, '[0-9]')
    )
    SELECT order_id, profile_id, strftime(created_on, '%Y-%m-%d %H:%M:%S') AS created_on, asked, shown,
        'Error in order_id: ' || order_id || ', created at: ' || strftime(created_on, '%Y-%m-%d %H:%M:%S') || ', profile_id: ' || profile_id
        || ', months in request: ' || coalesce(cast(asked AS VARCHAR), 'none') || ', months in orders: ' || shown AS message
    FROM asked JOIN (
        SELECT uid, CASE WHEN starts_with(pay, 'Кредитная') THEN NULL ELSE shown END AS shown
        FROM (SELECT DISTINCT h.uid, s.shown, h.pay_title AS pay FROM shown s JOIN order_history h ON h.uid = s.uid)) s ON s.uid = order_id
    WHERE shown IS NOT NULL AND asked IS DISTINCT FROM shown
    """,
)
def _(t: Tables):
    return orders.period_mismatch_alerts(t.loan_rows, t.order_history, NOW)


STATES = """
    ends AS (
        SELECT *, CASE WHEN contains(date_end_t, '-') THEN cast(date_end_t AS TIMESTAMP)
            ELSE make_timestamp_ms(cast(date_end_t AS BIGINT)) END AS ended FROM task_history
    ), last_ends AS (
        SELECT proc_def_id_, max(ended) AS ended FROM ends
        WHERE completed = 'true' AND application_num IS NOT NULL AND ended IS NOT NULL GROUP BY proc_def_id_
    ), reached AS (
        SELECT DISTINCT e.proc_def_id_, e.all_step AS completed_state FROM ends e JOIN last_ends USING (proc_def_id_, ended)
    ), open_tasks AS (
        SELECT DISTINCT proc_def_id_ AS proc, all_step AS task_name, due_dtime, create_dtime, user_state AS curr_username
        FROM task_history WHERE completed = 'false' AND application_num IS NOT NULL
    ), errors AS (
        SELECT DISTINCT root_proc_inst_id_ AS root, incident_msg_, incident_timestamp_ AS error_dtime
        FROM incidents i JOIN executions e ON e.id_ = i.proc_inst_id_
    )
"""
FLOW = """
        p.application_num, p.start_dtime, p.process_name, p.proc_inst_id_, o.task_name, o.due_dtime, o.create_dtime, p.end_dtime,
        c.employeenumber AS curr_employeenumber, o.curr_username, c.fullname AS curr_fullname,
        c.position_code AS curr_position_code, c.position_name AS curr_position_name,
        c.specialization_code AS curr_specialization_code, c.specialization_name AS curr_specialization_name,
        c.department_code AS curr_department_code, c.department_name AS curr_department_name,
        i.employeenumber AS init_employeenumber, p.init_username, i.fullname AS init_fullname,
        i.position_code AS init_position_code, i.position_name AS init_position_name,
        i.specialization_code AS init_specialization_code, i.specialization_name AS init_specialization_name,
        i.department_code AS init_department_code, i.department_name AS init_department_name,
        i.branch_code AS init_branch_code, i.branch_name AS init_branch_name,
        coalesce(m.shown, p.state) AS state, CASE WHEN p.state = 'true' THEN r.completed_state END AS completed_state,
        x.incident_msg_, x.error_dtime
"""
FLOW_JOINS = """
    FROM processes p FULL JOIN open_tasks o ON o.proc = p.proc_inst_id_
    LEFT JOIN employees c ON c.username = o.curr_username LEFT JOIN employees i ON i.username = p.init_username
    LEFT JOIN errors x ON x.root = p.proc_inst_id_ LEFT JOIN reached r ON r.proc_def_id_ = p.proc_inst_id_
    LEFT JOIN (VALUES ('true', 'COMPLETED'), ('false', 'ACTIVE')) AS m(raw, shown) ON m.raw = p.state
"""


@query("mart_process_flow", f"WITH {STATES} SELECT DISTINCT {FLOW} {FLOW_JOINS}")
def _(t: Tables):
    return processes.process_flow(t.task_history, t.processes, t.employees, t.incidents, t.executions)


@query(
    "mart_process_steps",
    f"""
    WITH {STATES}
    SELECT DISTINCT {FLOW}, p.proc_def_id_, e.step_id, e.activity_inst_id, e.all_step, e.create_dtime AS date_start_t,
        strftime(e.ended, '%Y-%m-%d %H:%M:%S') AS date_end_t, e.user_state
    {FLOW_JOINS} LEFT JOIN ends e ON e.proc_def_id_ = p.proc_inst_id_
    """,
)
def _(t: Tables):
    return processes.process_steps(t.task_history, t.processes, t.employees, t.incidents, t.executions)


@query(
    "process_flow_report",
    f"""
    WITH {STATES}, flow AS (SELECT DISTINCT {FLOW} {FLOW_JOINS})
    SELECT {", ".join(f'flow.{c} AS "{h}"' for c, h in zip(
        "application_num start_dtime process_name proc_inst_id_ task_name due_dtime create_dtime end_dtime "
        "curr_employeenumber curr_username curr_fullname curr_position_code curr_position_name "
        "curr_specialization_code curr_specialization_name curr_department_code curr_department_name "
        "init_employeenumber init_username init_fullname init_position_code init_position_name "
        "init_specialization_code init_specialization_name init_department_code init_department_name "
        "init_branch_code init_branch_name state completed_state incident_msg_ error_dtime".split(),
        fv.PROCESS_FLOW_HEADERS))} FROM flow
    """,
)
def _(t: Tables):
    flow = processes.process_flow(t.task_history, t.processes, t.employees, t.incidents, t.executions)
    return with_headers(processes.newest_first(flow), fv.PROCESS_FLOW_HEADERS)


DETAILS = """
    details AS (
        SELECT m.id AS merch, m.legal_name, m.state, q.iban AS merchant_iban, q.bik AS merchant_bik, q.legal_id AS merchant_bin
        FROM merchants m LEFT JOIN requisites q ON q.merchant_id = m.id
    ), states AS (
        SELECT uid, arg_max(row_id, (updated_on, row_id)) AS row_id FROM order_history GROUP BY uid
    ), order_state AS (
        SELECT h.uid, h.bank_status, h.status, h.promocode, h.common_discount_size, h.pay_types, h.pay_title
        FROM order_history h JOIN states USING (row_id)
    ), rates AS (
        SELECT merchant_id, cat_id, product, rate FROM (
            SELECT merchant_id, cat_id, unnest([
                {'product': 'Кредит на 24 месяца', 'rate': cast(EXPRESS_18_24 AS DOUBLE)},
                {'product': 'Кредит на 12 месяцев', 'rate': cast(EXPRESS_18_12 AS DOUBLE)},
                {'product': 'Кредит на 6 месяцев', 'rate': cast(EXPRESS_18_6 AS DOUBLE)},
                {'product': 'Рассрочка на 24 месяца', 'rate': cast(EXPRESS_0_24 AS DOUBLE)},
                {'product': 'Рассрочка на 12 месяцев', 'rate': cast(EXPRESS_0_12 AS DOUBLE)},
                {'product': 'Рассрочка на 4 месяца', 'rate': cast(EXPRESS_0_4 AS DOUBLE)},
                {'product': 'Кредитная карта на 12 месяцев', 'rate': cast(ACQUIRING_0_12 AS DOUBLE)},
                {'product': 'Кредитная карта на 6 месяцев', 'rate': cast(ACQUIRING_0_6 AS DOUBLE)},
                {'product': 'Кредитная карта на 4 месяца', 'rate': cast(ACQUIRING_0_4 AS DOUBLE)},
                {'product': 'Банковская карта', 'rate': cast(CARD_0_0 AS DOUBLE)}], recursive := true)
            FROM tariffs)
    ), invoiced AS (
        SELECT v.*, d.*, s.* FROM invoices v LEFT JOIN details d ON d.merch = v.merch_id LEFT JOIN order_state s ON s.uid = v.order_id
    )
"""
# ``{0}`` keeps the sales of the period, ``{1}`` the bank rows.
STATEMENT = """
    sales AS (
        SELECT * FROM invoiced WHERE bank_trans_code = 'EXPRESS' AND legal_name <> 'LLC 5' AND {0}
        QUALIFY row_number() OVER (PARTITION BY {2} ORDER BY invoice_id, item_id, merch_id, bank_trans_id, item_price, item_qnt) = 1
    ), per_order AS (
        SELECT * FROM invoiced
        QUALIFY row_number() OVER (PARTITION BY {2} ORDER BY invoice_id, item_id, merch_id, bank_trans_id, item_price, item_qnt) = 1
    ), best AS (SELECT merchant_id, product, max(rate) AS rate FROM rates GROUP BY ALL), statement AS (
        SELECT s.created_on AS dtime, NULL AS order_id, NULL AS commersant, NULL AS filial, NULL AS terminal_id, NULL AS auth_code,
            NULL AS card_num, cast(s.item_price AS DOUBLE) AS tran_amount, 0.0 AS comm_bank, cast(s.item_price AS DOUBLE) AS total_amount,
            NULL AS currency, NULL AS ret_account, NULL AS emit_card, s.invoice_id, s.order_id AS orders, '' AS invoice_type,
            s.item_id, s.item_name, s.item_price + coalesce(cast(s.common_discount_size AS DOUBLE), 0) AS item_price,
            s.item_qnt AS item_quantity, s.item_qnt AS items_count, s.legal_name, s.merchant_iban, s.merchant_bik, s.merchant_bin,
            s.bank_trans_id AS operation_id, s.bank_status, s.status, s.promocode, s.common_discount_size, s.pay_types, s.pay_title,
            r.rate AS comm_comp
        FROM sales s LEFT JOIN nomenclature n ON n.id = s.item_id
        LEFT JOIN rates r ON r.merchant_id = s.merch_id AND r.product = s.pay_title
            AND r.cat_id = coalesce(regexp_extract(n.categories_array, '[^{{}},]+'), 'root')
        UNION ALL
        SELECT DISTINCT b.dtime, b.order_id, b.commersant, b.filial, b.terminal_id, b.auth_code, b.card_num, b.tran_amount, b.comm_bank,
            b.total_amount, b.currency, b.ret_account, b.emit_card, s.invoice_id, s.order_id, NULL, s.item_id, s.item_name,
            s.item_price + coalesce(cast(s.common_discount_size AS DOUBLE), 0), s.item_qnt, s.item_qnt, s.legal_name,
            s.merchant_iban, s.merchant_bik, s.merchant_bin, s.bank_trans_id, s.bank_status, s.status, s.promocode,
            s.common_discount_size, s.pay_types, s.pay_title, r.rate
        FROM (SELECT DISTINCT *, upload + to_days(cast(extract(hour FROM upload) >= 8 AS INT)) AS booked FROM bank) b
        LEFT JOIN per_order s ON s.bank_trans_id || '9' = b.order_id
        LEFT JOIN best r ON r.merchant_id = s.merch_id AND r.product = s.pay_title
        WHERE {1}
    )
"""


STATEMENT_COLUMNS = """
    SELECT strftime(dtime, '%Y-%m-%d %H:%M:%S') AS dtime, cast(order_id AS VARCHAR) AS order_id, commersant, filial, terminal_id,
        auth_code, card_num, tran_amount, cast(comm_bank AS DOUBLE) AS comm_bank, total_amount, currency, ret_account, emit_card,
        invoice_id, orders, invoice_type, item_id, item_name, item_price, item_quantity, items_count, legal_name, merchant_iban,
        merchant_bik, merchant_bin, operation_id, bank_status, status, promocode, common_discount_size, pay_types, pay_title, comm_comp
    FROM statement
"""


@query(
    "mart_statement",
    f"WITH {DETAILS}, "
    + STATEMENT.format(
        "cast(created_on AS DATE) = DATE '2024-01-17' - 1", "cast(booked AS DATE) = DATE '2024-01-17'", "order_id"
    )
    + STATEMENT_COLUMNS,
)
def _(t: Tables):
    return accounting.bank_statement(
        t.invoices,
        t.bank,
        t.merchants,
        t.requisites,
        t.order_history,
        t.nomenclature,
        t.tariffs,
        market(),
        date(2024, 1, 17),
        TIE,
    )


@query(
    "mart_statement_compat",
    f"WITH {DETAILS}, "
    + STATEMENT.format(
        "cast(created_on AS DATE) = DATE '2024-01-17' - 1", "cast(booked AS DATE) = DATE '2024-01-17'", "uid"
    )
    + STATEMENT_COLUMNS,
)
def _(t: Tables):
    return accounting.bank_statement(
        t.invoices,
        t.bank,
        t.merchants,
        t.requisites,
        t.order_history,
        t.nomenclature,
        t.tariffs,
        market(),
        date(2024, 1, 17),
        TIE,
        compat=True,
    )


@query(
    "mart_ledger",
    f"WITH {DETAILS}, "
    + STATEMENT.format("state = 'ACTIVE' AND created_on >= DATE '2024-01-10'", "booked >= DATE '2024-01-10'", "order_id")
    + """
    SELECT strftime(dtime, '%Y-%m-%d %H:%M:%S') AS dtime, order_id AS orderid, commersant, filial, terminal_id, auth_code, card_num,
        tran_amount AS amount, cast(comm_bank AS DOUBLE) AS bank_commission, item_price AS paid_amount, currency, ret_account,
        emit_card AS card, legal_name, merchant_iban, merchant_bik AS merchant_bic, merchant_bin, bank_status, status,
        cast(round(coalesce(cast(tran_amount AS DECIMAL(18,4)) * cast(comm_comp AS DECIMAL(10,4)) * 0.01, 0), 3) AS DOUBLE) AS commission,
        orders AS orderuid, promocode, common_discount_size AS promocode_sum, pay_types, pay_title, comm_comp, item_quantity
    FROM statement
    """,
)
def _(t: Tables):
    return accounting.ledger_extract(
        t.invoices,
        t.bank,
        t.merchants,
        t.requisites,
        t.order_history,
        t.nomenclature,
        t.tariffs,
        market(),
        TIE,
        since="2024-01-10",
    )


@query(
    "mart_terminals",
    """
    SELECT DISTINCT k.id, k.terminal_id, cast(m.address -> '$.regionId' AS VARCHAR) AS bank_region, m.legal_name, q.legal_id,
        q.director_name, cast(m.address -> '$.regionId' AS VARCHAR) AS region_id, cast(m.address -> '$.street' AS VARCHAR) AS street,
        cast(m.address -> '$.streetNum' AS VARCHAR) AS street_num, cast(m.address -> '$.aptNum' AS VARCHAR) AS apt_num, m.telephone,
        q.tariff_plan, q.tariff_price, k.status, q.client_type, q.pos_term_type,
        strftime(k.created_date, '%Y-%m-%d %H:%M:%S') AS created_date, m.biz_categories, k.store_id
    FROM terminals k JOIN merchants m ON m.id = k.merchant_id LEFT JOIN requisites q ON q.merchant_id = k.merchant_id
    WHERE m.merchant_type = '{DESK}'
    """,
)
def _(t: Tables):
    return accounting.terminals_report(t.terminals, t.merchants, t.requisites, market())


@query(
    "process_incidents",
    """
    SELECT p.proc_inst_id_, i.incident_msg_, i.incident_timestamp_ AS error_dtime
    FROM processes p, incidents i, executions e
    WHERE i.proc_inst_id_ = e.id_ AND e.root_proc_inst_id_ = p.proc_inst_id_
    """,
)
def _(t: Tables):
    found = processes.incident_lookup(t.incidents, t.executions)
    return t.processes.join(found, F.col("proc_inst_id_") == F.col("_root")).select(
        "proc_inst_id_", "incident_msg_", "error_dtime"
    )


@query(
    "category_titles",
    f"WITH {PATHS} SELECT categories_array, t1 AS cat1, t2 AS cat2, t3 AS cat3, t4 AS cat4, t5 AS cat5 FROM titles",
)
def _(t: Tables):
    return orders.category_titles(t.nomenclature, t.categories, 5)
