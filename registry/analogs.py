"""Marketplace tables derived from the given ones.

Each statement is one text for both engines: ``{table}`` marks an input,
doubled braces are literal, and the few functions spelled differently are
replaced per engine. Every row of the input is kept; gaps (missing partners,
NULLs, empty lists) are made by the values.
"""

from __future__ import annotations

# Text in both engines -> text in Spark.
_SPARK_SPELLING = {"epoch_ms(": "unix_millis("}


def for_spark(sql: str) -> str:
    for ours, theirs in _SPARK_SPELLING.items():
        sql = sql.replace(ours, theirs)
    return sql


def for_duckdb(sql: str) -> str:
    from string import Formatter

    names = {field for _, field, _, _ in Formatter().parse(sql) if field}
    return sql.format(**{name: name for name in names})


# An order is a user and a three-day block; uid stays below the order keys, so
# that lineitem and orders rows belong to it.
_UID = "user_id * 10 + cast(floor((extract(day from ts) - 1) / 3) as bigint)"

ANALOGS = {
    # One row per status change.
    "order_history": f"""
        SELECT
            event_id AS row_id,
            cast({_UID} as string) AS uid,
            'U' || cast(user_id as string) AS owner,
            CASE WHEN user_id % 13 = 12 THEN 'desk' ELSE 'market' END AS scope,
            CASE event_type WHEN 'signup' THEN 'new'
                WHEN 'view' THEN CASE event_id % 8 WHEN 0 THEN 'awaiting_loan_approve'
                    WHEN 1 THEN 'filled_not_approved' WHEN 2 THEN 'approved_not_filled' ELSE 'pending_approve' END
                WHEN 'click' THEN CASE event_id % 7 WHEN 0 THEN 'pending_pickup' WHEN 1 THEN 'courier_delivery'
                    WHEN 2 THEN 'awaiting_parcel_ready' WHEN 3 THEN 'sync_with_delivery'
                    WHEN 4 THEN 'awaiting_courier_pickup' ELSE 'on_delivery' END
                WHEN 'purchase' THEN CASE event_id % 5 WHEN 0 THEN 'taken' WHEN 1 THEN 'returned' ELSE 'delivered' END
                ELSE CASE event_id % 6 WHEN 0 THEN 'cancelledbyclient' WHEN 1 THEN 'cancelledbybank'
                    WHEN 2 THEN 'cancelledbymerchant' WHEN 3 THEN 'cancelledbytimeout' ELSE 'cancelled' END END AS status,
            value > 25 AS paid,
            CASE user_id % 5 WHEN 0 THEN 'EXPRESS' WHEN 1 THEN 'ACQUIRING' WHEN 2 THEN 'COD'
                WHEN 3 THEN 'EXPRESS' ELSE 'CARD' END AS pay_types,
            CASE user_id % 10 WHEN 0 THEN 'EXPRESS_0_12' WHEN 1 THEN 'ACQUIRING_0_4'
                WHEN 3 THEN 'EXPRESS_18_6' END AS pay_types_code,
            CASE user_id % 10 WHEN 0 THEN 'Рассрочка на 12 месяцев'
                WHEN 1 THEN 'Кредитная карта на 4 месяца' WHEN 2 THEN 'Оплата наличными'
                WHEN 3 THEN 'Кредит на 6 месяцев' WHEN 4 THEN 'Банковская карта'
                WHEN 5 THEN 'Кредит на 24 месяца' WHEN 6 THEN 'В рассрочку'
                WHEN 7 THEN 'Оплата онлайн' WHEN 8 THEN 'Кредит на 12 месяцев'
                ELSE 'Банковская карта' END AS pay_title,
            ts - (event_id % 7) * interval '1' hour AS created_on,
            ts AS updated_on,
            (100 + ({_UID}) % 97 * 10) * 2 - CASE WHEN event_id % 9 = 0 THEN 10 ELSE 0 END AS common_price,
            CASE WHEN user_id % 3 = 0 THEN (100 + ({_UID}) % 97 * 10) * 3 END AS common_old_price,
            CASE WHEN event_id % 4 > 0 THEN cast(event_id % 4 * 5 as string) END
                AS common_discount_size,
            CASE event_id % 7 WHEN 0 THEN 'active' WHEN 1 THEN 'CLIENT.DECLINE'
                WHEN 2 THEN 'error' WHEN 3 THEN 'Таймаут на решении клиента' END AS cancelled_reason,
            CASE event_id % 5 WHEN 0 THEN 'cancel' WHEN 1 THEN 'rejected' END AS bank_status,
            CASE event_id % 3 WHEN 0 THEN 'delivery' WHEN 1 THEN 'kazpost' ELSE 'pickup' END
                AS delivery_types,
            value AS weight,
            CASE WHEN user_id % 29 = 0 THEN 'Test' ELSE 'Client ' || cast(user_id as string) END
                AS user_name,
            'S' || cast(user_id as string) AS user_surname,
            CASE user_id % 4
                WHEN 0 THEN '+7 701-' || cast(1000000 + user_id as string)
                WHEN 1 THEN '8701' || cast(1000000 + user_id as string)
                WHEN 2 THEN '701' || cast(1000000 + user_id as string)
                ELSE '007701' || cast(1000000 + user_id as string) END AS user_mobile,
            'u' || cast(user_id as string) || '@example.com' AS user_email,
            CASE user_id % 3 WHEN 0 THEN 'Almaty' ELSE 'Astana' END AS user_city,
            'Street ' || cast(user_id % 50 as string) AS user_address,
            cast(user_id % 90 as string) AS user_house_number,
            cast(user_id % 120 as string) AS user_flat_number,
            event_id % 3 * 500 AS delivery_price,
            CASE WHEN user_id % 6 = 0 THEN 'SPRING' END AS promocode,
            CASE WHEN user_id % 6 = 0 THEN 'Spring sale' END AS promocode_name,
            user_id % 6 = 0 AS is_promocode_applied,
            CASE user_id % 5 WHEN 0 THEN '"KZ-ALA"' WHEN 1 THEN '"KZ-AST"'
                WHEN 2 THEN 'KZ-KAR-351010000' WHEN 3 THEN 'KZ-XXX' END AS city_id,
            CASE WHEN event_id % 2 = 0
                THEN '{{{{"body": {{{{"canceled_comments": "c' || cast(event_id % 9 as string) || '"}}}}}}}}'
                ELSE '{{{{"body": {{{{}}}}}}}}' END AS temp
        FROM {{events}}
    """,
    "packages": """
        SELECT
            cast(l_orderkey as string) AS uid,
            'P' || cast(l_partkey as string) AS product_id,
            'S' || cast(l_partkey % 700 as string) AS sku_id,
            'M' || cast(l_suppkey as string) AS product_merchant_id,
            CASE WHEN l_suppkey % 17 = 0 THEN '"Family" shop' ELSE 'Shop ' || cast(l_suppkey as string) END
                AS sender_title,
            'Item ' || cast(l_partkey as string) AS product_name,
            100 + l_orderkey % 97 * 10 AS sku_price,
            l_linenumber AS sku_amount
        FROM {lineitem}
    """,
    "nomenclature": """
        SELECT
            'I' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-'
                || cast(l_partkey as string) || '-' || cast(l_suppkey as string) AS id,
            'N' || cast(l_orderkey * 10 + l_linenumber as string) AS uid,
            'M' || cast(l_suppkey as string) AS merchant_id,
            'Item ' || cast(l_partkey as string) AS name,
            p_name AS name_ebt,
            '{{' || p_type || ',' || split_part(p_name, ' ', 1) || ',' || split_part(p_name, ' ', 2)
                || CASE p_size % 4 WHEN 0 THEN ',' || p_brand
                    WHEN 1 THEN ',' || split_part(p_name, ' ', 2) || ',' || p_brand
                    WHEN 2 THEN ',none,' || p_brand ELSE '' END || '}}' AS categories_array,
            cast(100 * ceil(l_quantity / 10) as bigint) AS price,
            CASE WHEN l_returnflag = 'N' THEN 'created' ELSE 'accepted' END AS status,
            'B' || cast(l_partkey as string) AS bar_code,
            CASE WHEN l_partkey % 5 > 0 THEN 'A' || cast(l_partkey as string) END AS articul,
            l_shipdate AS created_on,
            l_shipdate AS updated_on,
            l_linestatus = 'O' AS is_visible,
            CASE WHEN l_returnflag = 'R' THEN false WHEN l_returnflag = 'N' THEN true
                ELSE l_tax < 0.05 END AS available,
            CASE WHEN l_partkey % 19 > 0 THEN 'P' || cast(l_partkey as string) END AS product_id,
            CASE WHEN l_partkey % 23 > 0 THEN 'S' || cast(l_partkey % 700 as string) END AS sku_id,
            CASE WHEN l_linenumber = 7 THEN 'desk' ELSE 'market' END AS sale_channels
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
    """,
    # Catalogue documents: products and showcase share this shape.
    "products": """
        SELECT
            'D' || cast(p_partkey as string) AS id,
            'M' || cast(p_partkey % 100 as string) AS merchant_id,
            p_name AS name_,
            '/root/' || p_type || '/' || split_part(p_name, ' ', 1) || '/'
                || split_part(p_name, ' ', 2) || CASE WHEN p_size % 2 = 0 THEN '/' || p_brand ELSE '' END
                AS default_category,
            '{{' || p_type || ',' || split_part(p_name, ' ', 1) || ',' || split_part(p_name, ' ', 2)
                || '}}' AS categories_array,
            cast(date '2018-01-01' + cast(p_size * 30 as int) as timestamp) AS created_on,
            cast(date '2023-01-01' + cast(p_size as int) as timestamp) AS updated_on,
            CASE WHEN p_size % 3 > 0 THEN 'true' ELSE 'false' END AS is_visible,
            CASE WHEN p_size % 5 > 0 THEN '{{catalogue}}' ELSE '{{other}}' END AS scope_
        FROM {part}
    """,
    # One level-1 token has no entry under its own id.
    "categories": """
        SELECT DISTINCT
            CASE WHEN token = 'SMALL' THEN 'x-' || token ELSE token END AS id,
            CASE token WHEN 'small' THEN 'Мониторы' WHEN 'red' THEN 'Бытовая техника'
                WHEN 'hot' THEN 'Музыкальные инструменты' WHEN 'bolt' THEN 'Холодильники'
                WHEN 'ring' THEN 'Мониторы' WHEN 'gear' THEN 'Видеорегистраторы'
                WHEN 'PROMO' THEN ' Товары для дома и сада' WHEN 'LARGE' THEN 'Архив'
                WHEN 'Brand#3' THEN 'Видеорегистраторы'
                ELSE token END AS title
        FROM (
            SELECT p_type AS token FROM {part}
            UNION ALL SELECT split_part(p_name, ' ', 1) FROM {part}
            UNION ALL SELECT split_part(p_name, ' ', 2) FROM {part}
            UNION ALL SELECT p_brand FROM {part}
        ) AS tokens
    """,
    "merchants": """
        SELECT
            CASE WHEN s_nationkey = 3 THEN 'X' ELSE 'M' END || cast(s_suppkey as string) AS id,
            CASE WHEN s_suppkey % 11 = 0 THEN NULL
                WHEN s_suppkey % 3 = 0 THEN ' shop-' || cast(s_suppkey % 40 as string) || ' east '
                ELSE 'SHOP ' || cast(s_suppkey % 40 as string) END AS brand,
            CASE WHEN s_acctbal > 1000 THEN 'ACTIVE' ELSE 'BLOCKED' END AS state,
            CASE WHEN s_suppkey % 4 = 0 THEN '{{DESK}}' ELSE '{{MARKET}}' END AS merchant_type,
            'LLC ' || cast(s_suppkey as string) AS legal_name,
            '7701' || cast(s_suppkey as string) AS telephone,
            '{{food,home}}' AS biz_categories,
            CASE s_suppkey % 3
                WHEN 0 THEN '{{"regionId": "' || cast(s_nationkey as string) || '", "street": "Main"}}'
                WHEN 1 THEN '{{"regionId": ' || cast(s_nationkey as string)
                    || ', "streetNum": "5a", "aptNum": 7}}'
                ELSE '{{"street": "Long é", "aptNum": null}}' END AS address
        FROM {supplier}
    """,
    "accounts": """
        SELECT
            'PR' || cast(c_custkey % 1000 as string) AS profile_id,
            CASE WHEN c_custkey % 4 = 0 THEN 'market' WHEN c_custkey % 4 = 1 THEN 'Market'
                WHEN c_custkey % 4 = 2 THEN 'MARKET' ELSE 'other' END AS brand,
            CASE c_custkey % 3 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'mobile_app' ELSE 'EMAIL' END AS id_space,
            CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'blocked' END AS state,
            CASE c_custkey % 4
                WHEN 0 THEN '7701' || cast(1000000 + c_custkey as string)
                WHEN 1 THEN '8701' || cast(1000000 + c_custkey as string)
                WHEN 2 THEN '701' || cast(1000000 + c_custkey as string)
                ELSE '007701' || cast(1000000 + c_custkey as string) END AS identifier_id,
            CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment || cast(c_custkey as string) || '@example.com' END
                AS email,
            cast(date '2020-01-01' + cast(c_custkey % 365 as int) as timestamp) AS created
        FROM {customer}
    """,
    "saved_requests": """
        SELECT
            cast(o_orderkey as string) AS order_id,
            CASE o_orderkey % 6 WHEN 0 THEN 'FM 4-1' WHEN 1 THEN 'FM 12-01' WHEN 2 THEN 'FM 24-1-1'
                WHEN 3 THEN 'XX 1' END AS product_sub_code,
            '{{"sex": ' || cast(1 + o_custkey % 2 as string) || ', "birthdate_str": "'
                || lpad(cast(1 + o_custkey % 28 as string), 2, '0') || '.'
                || lpad(cast(1 + o_custkey % 12 as string), 2, '0') || '.'
                || cast(1950 + o_custkey % 55 as string) || '", "price": '
                || cast(cast(floor(o_totalprice) as bigint) as string)
                || ', "description": "goods"}}' AS temp,
            '7701' || cast(1000000 + o_custkey as string) AS mobile_phone,
            cast(4 + o_orderkey % 3 * 8 as string) AS period_,
            CASE WHEN o_orderkey % 3 = 0 THEN 'credit' ELSE 'installment' END AS loan_type,
            o_orderkey % 900 * 100 AS sum_
        FROM {orders}
    """,
    "sent_requests": """
        SELECT
            cast(o_orderkey as string) AS order_id,
            CASE o_orderkey % 5 WHEN 0 THEN 'FM 6-01' WHEN 1 THEN 'FM 12-1-1' END AS productcode,
            '{{"body": {{"bank_req": {{"application": [0,1,2,3,4,5,6,7,8,9,10,'
                || CASE WHEN o_orderkey % 7 > 0 THEN '{{"key": "Income", "value": "' ELSE '{{"key": "Other", "value": "' END
                || cast(100000 + o_custkey % 700 * 1000 as string) || '"}}]}}}}}}' AS temp
        FROM {orders}
    """,
    "invoices": """
        SELECT
            'V' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) AS invoice_id,
            CASE WHEN l_orderkey % 13 = 0 THEN 'lost-' ELSE '' END || cast(l_orderkey as string) AS order_id,
            'I' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-'
                || cast(l_partkey as string) || '-'
                || CASE WHEN l_linenumber % 3 = 0 THEN 'none' ELSE cast(l_suppkey as string) END AS item_id,
            'Item ' || cast(l_partkey as string) AS item_name,
            cast(floor(l_extendedprice) as bigint) AS item_price,
            cast(l_quantity as bigint) AS item_qnt,
            'M' || cast(l_suppkey as string) AS merch_id,
            cast(date '2024-01-01' + cast(l_orderkey % 31 as int) as timestamp) AS created_on,
            'T' || cast(l_orderkey as string) || '-' || cast(l_linenumber % 2 as string) AS bank_trans_id,
            CASE WHEN l_linenumber % 4 = 0 THEN 'CARD' ELSE 'EXPRESS' END AS bank_trans_code
        FROM {lineitem}
    """,
    "bank": """
        SELECT
            o_orderdate AS dtime,
            'T' || cast(o_orderkey as string) || '-' || cast(o_custkey % 2 as string) || '9' AS order_id,
            'C' || cast(o_custkey as string) AS commersant,
            'F1' AS filial,
            'TERM' || cast(o_custkey % 50 as string) AS terminal_id,
            cast(o_orderkey % 9999 as string) AS auth_code,
            '440000' AS card_num,
            cast(floor(o_totalprice) as bigint) AS tran_amount,
            o_orderkey % 100 AS comm_bank,
            cast(floor(o_totalprice) as bigint) - o_orderkey % 100 AS total_amount,
            'KZT' AS currency,
            'R' AS ret_account,
            'E' AS emit_card,
            CASE WHEN o_orderkey % 11 > 0 THEN cast(date '2024-01-01' + cast(o_orderkey % 31 as int) as timestamp)
                + (o_orderkey % 24) * interval '1' hour END AS upload
        FROM {orders}
        UNION ALL
        SELECT
            o_orderdate,
            'T' || cast(o_orderkey as string) || '-' || cast(o_custkey % 2 as string) || '9',
            'C' || cast(o_custkey as string), 'F1', 'TERM' || cast(o_custkey % 50 as string),
            cast(o_orderkey % 9999 as string), '440000', cast(floor(o_totalprice) as bigint), o_orderkey % 100,
            cast(floor(o_totalprice) as bigint) - o_orderkey % 100, 'KZT', 'R', 'E',
            CASE WHEN o_orderkey % 11 > 0 THEN cast(date '2024-01-01' + cast(o_orderkey % 31 as int) as timestamp)
                + (o_orderkey % 24) * interval '1' hour + interval '1' minute END
        FROM {orders} WHERE o_orderkey % 7 = 0
    """,
    "requisites": """
        SELECT
            CASE WHEN s_suppkey % 9 = 0 THEN 'Y' ELSE 'M' END || cast(s_suppkey as string) AS merchant_id,
            cast(100000 + s_suppkey as string) AS legal_id,
            'KZ00' || cast(s_suppkey as string) AS iban,
            'BIK' || cast(s_suppkey % 7 as string) AS bik,
            'Director ' || cast(s_suppkey as string) AS director_name,
            CASE WHEN s_suppkey % 2 = 0 THEN 'base' ELSE 'plus' END AS tariff_plan,
            s_suppkey % 2 * 1000 AS tariff_price,
            'TOO' AS client_type,
            'POS' AS pos_term_type
        FROM {supplier}
    """,
    # Text as a client prints a nested map: single quotes; some malformed, some empty.
    "tariff_records": """
        SELECT
            'M' || cast(s_suppkey as string) AS merchant_id,
            CASE WHEN s_suppkey % 10 = 7 THEN '{{}}' WHEN s_suppkey % 10 = 8 THEN 'broken {{'
                ELSE '{{''root'': {{''EXPRESS_0_12'': ' || cast(s_suppkey % 9 + 1 as string)
                    || '.5, ''EXPRESS_18_6'': 4, ''CARD_0_0'': 1.25, ''UNKNOWN'': 3}}, ''ECONOMY'': {{''EXPRESS_0_12'': '
                    || cast(s_suppkey % 5 as string) || ', ''ACQUIRING_0_4'': 2}}, ''PROMO'': {{}}}}' END AS tariffs
        FROM {supplier}
    """,
    # The same tariffs already flat.
    "tariffs": """
        SELECT
            'M' || cast(s_suppkey as string) AS merchant_id,
            cat_id,
            CASE WHEN cat_id <> 'PROMO' THEN 1.5 + s_suppkey % 4 END AS EXPRESS_0_4,
            CASE WHEN cat_id = 'root' THEN s_suppkey % 9 + 1.5 WHEN cat_id = 'ECONOMY' THEN s_suppkey % 5 + 0.0 END
                AS EXPRESS_0_12,
            s_suppkey % 3 + 2.25 AS EXPRESS_0_24,
            CASE WHEN s_suppkey % 6 > 0 THEN s_suppkey % 6 + 0.5 END AS EXPRESS_18_6,
            7.5 AS EXPRESS_18_12,
            9.125 AS EXPRESS_18_24,
            1.25 AS CARD_0_0,
            CASE WHEN cat_id = 'ECONOMY' THEN 2.0 ELSE 2.5 END AS ACQUIRING_0_4,
            3.0 AS ACQUIRING_0_6,
            4.0 AS ACQUIRING_0_12
        FROM (
            SELECT DISTINCT l_suppkey AS s_suppkey,
                CASE p_type WHEN 'STANDARD' THEN 'root' ELSE p_type END AS cat_id
            FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        ) AS sold
    """,
    "terminals": """
        SELECT
            'FK' || cast(c_custkey as string) AS id,
            'TERM' || cast(c_custkey as string) AS terminal_id,
            'M' || cast(c_custkey % 120 as string) AS merchant_id,
            CASE WHEN c_acctbal > 0 THEN 'open' ELSE 'closed' END AS status,
            cast(date '2021-01-01' + cast(c_custkey % 365 as int) as timestamp) AS created_date,
            'ST' || cast(c_nationkey as string) AS store_id
        FROM {customer}
    """,
    "publish_log": """
        SELECT
            ts AS event_dtime,
            'M' || cast(user_id % 100 as string) AS merchant_id,
            CASE WHEN event_type = 'error' THEN NULL
                WHEN event_type = 'click' THEN '{{""}}'
                ELSE '{{P' || cast(event_id % 2000 as string) || ',"",P' || cast(user_id as string) || '}}' END
                AS enabled_products,
            CASE WHEN event_type = 'purchase' THEN '{{P' || cast(event_id % 1700 as string) || '}}'
                WHEN event_type = 'view' THEN '{{"",P' || cast(user_id + 7 as string) || ',P'
                    || cast(event_id % 900 as string) || '}}' END AS disabled_products
        FROM {events}
    """,
    # Loan requests as wide rows with a JSON payload.
    "loan_rows": f"""
        SELECT
            'U' || cast(user_id as string) AS profile_id,
            cast({_UID} as string) AS order_id,
            ts AS created_on,
            event_type AS status,
            '{{{{"profile_id": "U' || cast(user_id as string) || '"'
                || CASE WHEN event_id % 3 = 0 THEN ', "status": "ok"' ELSE '' END
                || ', "person_info": {{{{"surname": "S' || cast(user_id as string) || '", "iin": "'
                || cast(900000 + user_id as string) || '"'
                || CASE WHEN event_id % 2 = 0 THEN ', "sex": "1", "birthdate": "1990-01-02"' ELSE '' END
                || ', "financing_info": {{{{'
                || CASE WHEN event_id % 9 > 0 THEN '"period": ' || cast(6 + event_id % 2 * 6 as string) ELSE '' END
                || '}}}}}}}}}}}}' AS loan_request
        FROM {{events}}
    """,
    "loans": f"""
        SELECT DISTINCT
            cast({_UID} as string) AS order_id,
            cast(900000 + user_id as string) AS iin,
            CASE WHEN user_id % 2 = 0 THEN 'approved' ELSE 'refused' END AS status1,
            CASE WHEN user_id % 3 = 0 THEN 'ok' END AS status2
        FROM {{events}}
    """,
    # Process analogs: an instance per uid, a task per event, end times in two notations.
    "task_history": f"""
        SELECT
            cast(event_id as string) AS step_id,
            'step ' || event_type AS all_step,
            substring(cast(ts + interval '2' day as string), 1, 19) AS due_dtime,
            substring(cast(ts as string), 1, 19) AS create_dtime,
            CASE WHEN event_type = 'signup' THEN NULL
                WHEN event_id % 2 = 0 THEN cast(epoch_ms(date_trunc('second', ts)) as string)
                ELSE substring(cast(ts as string), 1, 19) END AS date_end_t,
            'user' || cast(event_id % 1700 as string) AS user_state,
            CASE WHEN event_id % 31 = 0 THEN 'GONE' || cast(event_id as string)
                ELSE 'PI' || cast({_UID} as string) END AS proc_def_id_,
            CASE WHEN event_id % 17 > 0 THEN 'APP' || cast({_UID} as string) END AS application_num,
            'process' AS process_name,
            'ACT' || cast(event_id as string) AS activity_inst_id,
            'user' || cast(user_id as string) AS initiator,
            substring(cast(ts as string), 1, 10) AS proc_start_date,
            CASE WHEN event_type IN ('purchase', 'click') THEN 'true' ELSE 'false' END AS completed
        FROM {{events}}
    """,
    "processes": f"""
        SELECT
            'H' || cast(min(event_id) as string) AS id,
            'APP' || cast({_UID} as string) AS application_num,
            substring(cast(min(ts) as string), 1, 19) AS start_dtime,
            'process ' || cast(user_id % 4 as string) AS process_name,
            'user' || cast(user_id as string) AS init_username,
            CASE WHEN user_id % 5 = 0 THEN 'SUSPENDED' WHEN max(event_id) % 2 = 0 THEN 'true' ELSE 'false' END
                AS state,
            CASE WHEN max(event_id) % 2 = 0 THEN substring(cast(max(ts) as string), 1, 19) END AS end_dtime,
            'PI' || cast({_UID} as string) AS proc_inst_id_,
            'DEF' || cast(user_id % 4 as string) AS proc_def_id_
        FROM {{events}}
        GROUP BY user_id, {_UID}
    """,
    "employees": """
        SELECT
            'user' || cast(c_custkey as string) AS username,
            c_name AS fullname,
            cast(c_custkey as string) AS employeenumber,
            'P' || cast(c_nationkey as string) AS position_code,
            'Position ' || cast(c_nationkey as string) AS position_name,
            'SP' || cast(c_custkey % 9 as string) AS specialization_code,
            'Specialization ' || cast(c_custkey % 9 as string) AS specialization_name,
            'D' || c_mktsegment AS department_code,
            c_mktsegment AS department_name,
            CASE WHEN c_custkey % 8 > 0 THEN 'BR' || cast(c_custkey % 8 as string) END AS branch_code,
            CASE WHEN c_custkey % 8 > 0 THEN 'Branch ' || cast(c_custkey % 8 as string) END AS branch_name
        FROM {customer}
    """,
    "incidents": """
        SELECT
            'EX' || cast(n_nationkey as string) AS proc_inst_id_,
            'failed in ' || n_name AS incident_msg_,
            'T' || cast(n_regionkey as string) AS incident_timestamp_
        FROM {nation}
    """,
    "executions": """
        SELECT
            'EX' || cast(c_nationkey as string) AS id_,
            'PI' || cast(c_custkey as string) AS root_proc_inst_id_
        FROM {customer}
    """,
}
