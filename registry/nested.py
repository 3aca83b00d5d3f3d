"""JSON, arrays, maps; document and record tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

from ledgerloom import sinks
from ledgerloom.functions import nested
from ledgerloom.functions.status import Lender
from ledgerloom.plans import catalogue, records
from ledgerloom.session import scratch_dir
from ledgerloom.sources import scan_records, scan_wide_rows
from registry.core import Tables, query


def as_document(identifier: Column, source: Column, spec: nested.FlattenSpec) -> list[Column]:
    """``_id`` and ``_source`` as a landed document has them: through JSON text,
    so that keys a row lacks are absent."""
    parsed = F.from_json(F.to_json(source), StructType.fromDDL(spec.schema)["_source"].dataType)
    return [identifier.alias("_id"), nested.parsed_once(parsed).alias("_source")]


@query(
    "json_path",
    """
    SELECT order_id, json_extract_string(temp, '$.body.bank_req.application[11].value') AS income,
        json_extract_string(temp, '$.body.bank_req.application[3]') AS third,
        json_extract_string(temp, '$.body.none') AS missing
    FROM sent_requests
    """,
)
def _(t: Tables):
    doc, base = F.col("temp"), "$.body.bank_req.application"
    return t.sent_requests.select(
        "order_id",
        nested.json_text(doc, f"{base}[11].value").alias("income"),
        nested.json_text(doc, f"{base}[3]").alias("third"),
        nested.json_text(doc, "$.body.none").alias("missing"),
    )


@query(
    "json_fragment",
    """
    SELECT id, cast(address -> '$.regionId' AS VARCHAR) AS region, cast(address -> '$.street' AS VARCHAR) AS street,
        cast(address -> '$.aptNum' AS VARCHAR) AS apt
    FROM merchants
    """,
)
def _(t: Tables):
    address = F.col("address")
    return t.merchants.select(
        "id",
        nested.json_fragment(address, "$.regionId").alias("region"),
        nested.json_fragment(address, "$.street").alias("street"),
        nested.json_fragment(address, "$.aptNum").alias("apt"),
    )


@query(
    "json_payload_flatten",
    """
    SELECT profile_id, order_id, strftime(created_on, '%Y-%m-%d %H:%M:%S') AS created_on,
        j ->> '$.person_info.surname' AS surname, j ->> '$.person_info.name' AS name,
        j ->> '$.person_info.patronymic' AS patronymic, j ->> '$.person_info.birthdate' AS birthdate,
        j ->> '$.person_info.sex' AS sex, j ->> '$.person_info.iin' AS iin,
        j ->> '$.person_info.mobile_phone' AS mobile_phone, status AS status1, j ->> '$.status' AS status2
    FROM (SELECT *, cast(loan_request AS JSON) AS j FROM loan_rows)
    """,
)
def _(t: Tables):
    return records.loans(t.loan_rows.drop("profile_id"))


@query(
    "optional_fields",
    """
    SELECT event_id, cast(props ->> '$.k' AS INT) AS k, cast(NULL AS VARCHAR) AS campaign FROM events
    """,
)
def _(t: Tables):
    rows = scan_wide_rows(t.events.select("event_id", "props"), "props", "k int, campaign string, unused string")
    return rows.select("event_id", "doc.k", "doc.campaign")


@query(
    "record_bins",
    "SELECT cast(props ->> '$.k' AS INT) AS k, cast(NULL AS VARCHAR) AS campaign FROM events",
)
def _(t: Tables):
    rows = scan_wide_rows(t.events.select("props"), "props", "k int, campaign string, unused string")
    return scan_records(rows, ["k", "campaign"])


PERIOD = nested.FlattenSpec(
    schema="person_info struct<iin string, financing_info struct<period int>>",
    columns={
        "order_id": "order_id",
        "iin": "doc.person_info.iin",
        "period": "doc.person_info.financing_info.period",
    },
    required=("doc.person_info.financing_info.period is not null",),
)


@query(
    "required_fields_drop",
    """
    SELECT order_id, iin, cast(period AS INT) AS period FROM (
        SELECT order_id, loan_request ->> '$.person_info.iin' AS iin,
            loan_request ->> '$.person_info.financing_info.period' AS period FROM loan_rows)
    WHERE period IS NOT NULL
    """,
)
def _(t: Tables):
    return nested.flatten(scan_wide_rows(t.loan_rows, "loan_request", PERIOD.schema), PERIOD)


@query(
    "required_fields_rejected",
    """
    SELECT order_id, loan_request ->> '$.person_info.iin' AS iin FROM loan_rows
    WHERE json_extract(loan_request, '$.person_info.financing_info.period') IS NULL
    """,
)
def _(t: Tables):
    left = nested.rejected(scan_wide_rows(t.loan_rows, "loan_request", PERIOD.schema), PERIOD)
    return left.select("order_id", F.col("doc.person_info.iin").alias("iin"))


LOAN = nested.FlattenSpec(
    schema=PERIOD.schema,
    columns=PERIOD.columns,
    required=(
        "doc.person_info.iin is not null",
        "doc.person_info.financing_info.period is not null",
        "doc.person_info.financing_info.period > 6",
    ),
)


@query(
    "required_fields_counts",
    """
    SELECT CASE WHEN iin IS NULL THEN 'doc.person_info.iin is not null'
            WHEN period IS NULL THEN 'doc.person_info.financing_info.period is not null'
            WHEN period <= 6 THEN 'doc.person_info.financing_info.period > 6' ELSE 'accepted' END AS outcome,
        count(*) AS documents, count(DISTINCT order_id) AS orders
    FROM (SELECT order_id, loan_request ->> '$.person_info.iin' AS iin,
        cast(loan_request ->> '$.person_info.financing_info.period' AS INT) AS period FROM loan_rows)
    GROUP BY 1
    """,
)
def _(t: Tables):
    """Documents routed in one pass: counts of the observation beside those of the stored slices."""
    target = scratch_dir(t.spark, "routed")
    seen = sinks.write_routed(scan_wide_rows(t.loan_rows, "loan_request", LOAN.schema), LOAN, target)
    accepted, rejects = sinks.read_routed(t.spark, LOAN, target)
    stored = accepted.select("order_id", F.lit(nested.ACCEPTED).alias("outcome")).unionByName(rejects.select("order_id", "outcome"))
    orders = stored.groupBy("outcome").agg(F.count_distinct("order_id").alias("orders"))
    counts = t.spark.createDataFrame([(k, n) for k, n in seen.items() if n], "outcome string, documents long")
    return counts.join(orders, "outcome")


@query(
    "nested_flatten",
    """
    SELECT cast(c_custkey AS VARCHAR) AS id, c_name AS username, c_name AS fullname,
        cast(NULL AS VARCHAR) AS birthday, cast(c_custkey AS VARCHAR) AS employeenumber,
        cast(NULL AS VARCHAR) AS employeeheadnumber, cast(NULL AS VARCHAR) AS employeecontractnumber,
        cast(NULL AS VARCHAR) AS employeecontractdate, cast(NULL AS VARCHAR) AS hiredate,
        cast(NULL AS VARCHAR) AS iin, cast(NULL AS VARCHAR) AS mobilephonenumber,
        'P' || c_nationkey AS position_code, n_name AS position_name,
        CASE WHEN c_acctbal > 0 THEN 'S1' END AS specialization_code,
        CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS specialization_name,
        cast(NULL AS VARCHAR) AS specialization_parentcode, 'D' || n_regionkey AS department_code,
        r_name AS department_name, 'ROOT' AS department_parentcode,
        cast(NULL AS VARCHAR) AS department_curatoremployeenumber,
        cast(NULL AS VARCHAR) AS department_manageremployeenumber,
        'Branch ' || c_nationkey AS branch_name, cast(NULL AS VARCHAR) AS branch_code
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    """,
)
def _(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("c_custkey").cast("string")
    skill = F.struct(F.lit("S1").alias("code"), F.col("c_mktsegment").alias("name"))
    source = F.struct(
        F.col("c_name").alias("username"),
        F.col("c_name").alias("fullName"),
        key.alias("employeeNumber"),
        F.struct(
            F.concat(F.lit("P"), F.col("c_nationkey")).alias("code"), F.col("n_name").alias("name")
        ).alias("position"),
        F.when(F.col("c_acctbal") > 0, skill).alias("specialization"),
        F.struct(
            F.concat(F.lit("D"), F.col("n_regionkey")).alias("code"),
            F.col("r_name").alias("name"),
            F.lit("ROOT").alias("parentCode"),
        ).alias("department"),
        F.struct(F.concat(F.lit("Branch "), F.col("c_nationkey")).alias("name")).alias("branch"),
    )
    return records.document_table(joined.select(*as_document(key, source, records.EMPLOYEE)), "employee")


@query(
    "first_element",
    "SELECT vec_id, cast(embedding[1] AS DOUBLE) AS first, len(embedding) AS size FROM embeddings",
)
def _(t: Tables):
    vector = F.col("embedding")
    return t.embeddings.select(
        "vec_id", nested.first_element(vector).cast("double").alias("first"), F.size(vector).cast("long").alias("size")
    )


@query(
    "explode_text_array",
    """
    SELECT strftime(event_dtime, '%Y-%m-%d %H:%M:%S') AS event_dtime, merchant_id, base, product_id
    FROM (
        SELECT event_dtime, merchant_id, 'опубликовано' AS base, unnest(regexp_extract_all(enabled_products, '[^{},]+')) AS product_id
        FROM publish_log
        UNION ALL
        SELECT event_dtime, merchant_id, 'снято', unnest(regexp_extract_all(disabled_products, '[^{},]+')) FROM publish_log
    ) WHERE product_id <> '""'
    """,
)
def _(t: Tables):
    return catalogue.publish_events(t.publish_log)


@query(
    "explode_text_words",
    """
    SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ',')) AS word FROM (
        SELECT doc_id, replace(replace(text, '{', ''), '}', '') AS text FROM documents))
    GROUP BY doc_id, word
    """,
)
def _(t: Tables):
    parts = nested.explode_text_array(t.documents.select("doc_id", "text"), "text", "word")
    return parts.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "explode_struct_array",
    """
    SELECT 'Q' || p_partkey AS id, p_type AS category_uid, p_brand AS title, w AS uid_values, upper(w) AS values_,
        cast(strlen(w) AS VARCHAR) AS sort_values
    FROM (SELECT *, unnest(string_split(p_name, ' ')) AS w FROM part)
    """,
)
def _(t: Tables):
    values = F.transform(
        F.split("p_name", " "),
        lambda w: F.struct(
            w.alias("uid_values"), F.upper(w).alias("values"), F.length(w).cast("string").alias("sort_values")
        ),
    )
    documents = t.part.select(
        F.concat(F.lit("Q"), "p_partkey").alias("_id"),
        F.struct(
            F.col("p_type").alias("category_uid"), F.col("p_brand").alias("title"), values.alias("params_values")
        ).alias("_source"),
    )
    return records.parameters(documents)


@query(
    "explode_schedule",
    """
    SELECT 'M' || s_suppkey AS merchant_id, s_name AS brand_name,
        CASE WHEN s_suppkey % 4 > 0 THEN cast(s_nationkey AS VARCHAR) END AS street_num,
        CASE WHEN s_suppkey % 4 > 0 THEN 'Main' END AS street,
        CASE WHEN s_suppkey % 4 > 0 THEN 'R1' END AS region_id, cast(NULL AS VARCHAR) AS apt_num,
        'day ' || d AS day, d < 6 AS isopen, CASE WHEN d < 6 THEN '09:00' END AS opentime,
        CASE WHEN d < 6 THEN '1' || (d + 2) || ':00' END AS closetime
    FROM supplier, range(1, 8) AS days(d) WHERE s_suppkey % 5 NOT IN (0, 1)
    """,
)
def _(t: Tables):
    days = F.transform(
        F.sequence(F.lit(1), F.lit(7)),
        lambda d: F.struct(
            F.concat(F.lit("day "), d).alias("day"),
            (d < 6).alias("isOpen"),
            F.when(d < 6, "09:00").alias("openTime"),
            F.when(d < 6, F.concat(F.lit("1"), d + 2, F.lit(":00"))).alias("closeTime"),
        ),
    )
    key = F.col("s_suppkey")
    address = F.struct(
        F.col("s_nationkey").cast("string").alias("street_num"),
        F.lit("Main").alias("street"),
        F.lit("R1").alias("region_id"),
    )
    record = F.struct(
        F.concat(F.lit("M"), key).alias("merchant_id"),
        F.col("s_name").alias("brand_name"),
        F.when(key % 5 == 0, "").when(key % 5 > 1, F.to_json(days)).alias("schedule"),
        F.when(key % 4 > 0, address).alias("address"),
    )
    parsed = F.from_json(F.to_json(F.struct(record.alias("doc"))), records.STORES.schema)
    return records.stores(t.supplier.select(parsed["doc"].alias("doc")))


@query(
    "explode_map_pick",
    """
    WITH parsed AS (
        SELECT merchant_id, json_keys(j) AS cats, j FROM (
            SELECT merchant_id, cast(replace(tariffs, '''', '"') AS JSON) AS j FROM tariff_records
            WHERE json_valid(replace(tariffs, '''', '"')))
    ), rows AS (SELECT merchant_id, unnest(cats) AS cat_id, j FROM parsed)
    SELECT merchant_id, cat_id, r['EXPRESS_0_4'] AS EXPRESS_0_4, r['EXPRESS_0_12'] AS EXPRESS_0_12,
        r['EXPRESS_0_24'] AS EXPRESS_0_24, r['EXPRESS_18_6'] AS EXPRESS_18_6, r['EXPRESS_18_12'] AS EXPRESS_18_12,
        r['EXPRESS_18_24'] AS EXPRESS_18_24, r['CARD_0_0'] AS CARD_0_0, r['ACQUIRING_0_4'] AS ACQUIRING_0_4,
        r['ACQUIRING_0_6'] AS ACQUIRING_0_6, r['ACQUIRING_0_12'] AS ACQUIRING_0_12
    FROM (SELECT merchant_id, cat_id, cast(j -> cat_id AS MAP(VARCHAR, DOUBLE)) AS r FROM rows)
    """,
)
def _(t: Tables):
    return records.tariffs(t.tariff_records, Lender())


@query(
    "to_json_text",
    """
    SELECT p_partkey, cast(to_json({'name': p_name, 'size': p_size, 'tags': [p_brand, p_type]}) AS VARCHAR) AS doc
    FROM part
    """,
)
def _(t: Tables):
    doc = F.struct(
        F.col("p_name").alias("name"),
        F.col("p_size").alias("size"),
        F.array("p_brand", "p_type").alias("tags"),
    )
    return t.part.select("p_partkey", nested.to_json_text(doc).alias("doc"))


@query(
    "flatten_spec",
    """
    SELECT 'D' || p_partkey AS id, 'M' || p_size AS merchant_id, cast(NULL AS VARCHAR) AS description,
        p_name AS name_, '/root/' || p_type AS default_category, '2020-01-01' AS created_on,
        cast(NULL AS VARCHAR) AS updated_on, p_size > 10 AS is_visible, cast(NULL AS VARCHAR) AS label_,
        '{' || p_type || ',' || p_brand || '}' AS categories_array, '{catalogue}' AS scope_,
        'U' || p_partkey AS uid, p_retailprice AS price, cast(NULL AS DOUBLE) AS amount,
        cast(NULL AS VARCHAR) AS nomenclature, '{"color":"' || p_brand || '"}' AS product_param,
        CASE WHEN p_size % 2 = 0 THEN 'S' || p_partkey END AS sku
    FROM part WHERE p_size % 7 > 0
    """,
)
def _(t: Tables):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    sku = F.struct(
        F.concat(F.lit("U"), key).alias("uid"),
        F.col("p_retailprice").alias("price"),
        F.struct(F.col("p_brand").alias("color")).alias("product_param"),
        F.when(size % 2 == 0, F.concat(F.lit("S"), key)).alias("sku"),
    )
    skus = F.when(size % 7 > 0, F.array(sku, sku)).otherwise(F.array().cast(_array_of(t, sku)))
    source = F.struct(
        F.concat(F.lit("M"), size).alias("merchant_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("/root/"), F.col("p_type")).alias("default_category"),
        F.array("p_type", "p_brand").alias("categories_array"),
        F.lit("2020-01-01").alias("created_on"),
        (size > 10).alias("is_visible"),
        F.array(F.lit("catalogue")).alias("scope"),
        skus.alias("skus"),
    )
    documents = t.part.select(*as_document(F.concat(F.lit("D"), key), source, records.PRODUCTS))
    return records.document_table(documents, "products")


def _array_of(t: Tables, element: Column) -> str:
    return f"array<{t.part.select(element.alias('e')).schema['e'].dataType.simpleString()}>"


@query(
    "flatten_nomenclature",
    """
    SELECT id, uid, merchant_id, name, cast(NULL AS DOUBLE) AS amount, cast(price AS DOUBLE) AS price, articul, status,
        '2020-01-01' AS created_on, cast(NULL AS VARCHAR) AS updated_on, is_visible, available, product_id, name_ebt,
        sku_id, cast(NULL AS VARCHAR) AS group_id, cast(NULL AS VARCHAR) AS vendor, categories_array,
        '{market}' AS scope, CASE WHEN articul IS NOT NULL THEN bar_code END AS bar_code, sale_channels
    FROM nomenclature WHERE price <> 300
    """,
)
def _(t: Tables):
    codes = F.when(F.col("price") == 300, F.array().cast("array<string>")).when(
        F.col("articul").isNotNull(), F.array("bar_code", F.lit("other"))
    )
    source = F.struct(
        *"uid merchant_id name price articul status is_visible available product_id name_ebt sku_id".split(),
        F.split(F.translate("categories_array", "{}", ""), ",").alias("categories_array"),
        codes.alias("bar_code"),
        F.array("sale_channels").alias("sale_channels"),
        F.array(F.lit("market")).alias("scope"),
        F.lit("2020-01-01").alias("created_on"),
    )
    documents = t.nomenclature.select(*as_document(F.col("id"), source, records.NOMENCLATURE))
    return records.document_table(documents, "nomenclature")


@query(
    "flatten_tasks",
    """
    SELECT step_id, all_step, due_dtime, create_dtime, date_end_t, user_state, proc_def_id_, application_num,
        process_name, activity_inst_id, initiator, proc_start_date, completed
    FROM task_history
    """,
)
def _(t: Tables):
    keys = {
        "taskName": "all_step",
        "dueDate": "due_dtime",
        "taskStartDate": "create_dtime",
        "taskEndDate": "date_end_t",
        "assignee": "user_state",
        "rootProcessInstanceId": "proc_def_id_",
        "applicationNumber": "application_num",
        "processDefinitionName": "process_name",
        "activityInstanceId": "activity_inst_id",
        "initiator": "initiator",
        "processStartDate": "proc_start_date",
        "completed": "completed",
    }
    source = F.struct(*[F.col(column).alias(key) for key, column in keys.items()])
    documents = t.task_history.select(*as_document(F.col("step_id"), source, records.TASK_HISTORY))
    return records.document_table(documents, "task_history")


@query(
    "flatten_records",
    """
    SELECT 'M' || s_suppkey AS id, '7701' || s_suppkey AS telephone, cast(NULL AS VARCHAR) AS email, s_name AS brand,
        cast(NULL AS VARCHAR) AS old_id_code, cast(s_suppkey AS VARCHAR) AS merchant_id, 'ACTIVE' AS state,
        cast(NULL AS VARCHAR) AS code, cast(NULL AS VARCHAR) AS description, 'LLC ' || s_suppkey AS legal_name,
        'logo' || s_suppkey AS logo_token, cast(NULL AS VARCHAR) AS surl, cast(NULL AS VARCHAR) AS smap,
        cast(NULL AS VARCHAR) AS avatar_token, cast(NULL AS VARCHAR) AS banner_token, cast(NULL AS VARCHAR) AS contacts,
        '{"regionId":"' || s_nationkey || '"}' AS address, cast(NULL AS VARCHAR) AS website,
        '{MARKET}' AS merchant_type, CASE WHEN s_suppkey % 2 = 0 THEN '{food,home}' END AS biz_categories,
        cast(NULL AS VARCHAR) AS kassa_types,
        CASE WHEN s_suppkey % 3 > 0 THEN strftime(make_timestamp_ms(1577836800000 + s_suppkey * 86400123), '%Y-%m-%d %H:%M:%S') END
            AS created_date,
        strftime(make_timestamp_ms(1609459200000 + s_suppkey * 1000), '%Y-%m-%d %H:%M:%S') AS updated_date
    FROM supplier
    """,
)
def _(t: Tables):
    key = F.col("s_suppkey")
    record = F.struct(
        F.concat(F.lit("M"), key).alias("id"),
        F.concat(F.lit("7701"), key).alias("telephone"),
        F.col("s_name").alias("brand"),
        key.cast("string").alias("merchant_id"),
        F.lit("ACTIVE").alias("state"),
        F.concat(F.lit("LLC "), key).alias("legal_name"),
        F.concat(F.lit("logo"), key).alias("logo_token"),
        F.struct(F.col("s_nationkey").cast("string").alias("regionId")).alias("address"),
        F.array(F.lit("MARKET")).alias("merchant_type"),
        F.when(key % 2 == 0, F.array(F.lit("food"), F.lit("home"))).alias("biz_categories"),
        F.when(key % 3 > 0, F.lit(1577836800000) + key * 86400123).alias("created_date"),
        (F.lit(1609459200000) + key * 1000).alias("updated_date"),
    )
    parsed = F.from_json(F.to_json(F.struct(record.alias("doc"))), records.MERCHANTS.schema)
    return records.merchants(t.supplier.select(nested.parsed_once(parsed["doc"]).alias("doc")))


@query(
    "digital_orders",
    """
    SELECT cast(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS order_type, '2020-05-01' AS created_dtime,
        o_orderstatus = 'F' AS is_gift_cert, floor(o_totalprice) AS cert_amount, o_orderstatus <> 'P' AS is_paid,
        CASE WHEN o_orderstatus = 'O' THEN true END AS is_activated, '2020-05-02' AS delivery_dtime,
        CASE WHEN o_orderstatus = 'O' THEN '2021-05-02' END AS expiry_dtime, 'Gift card' AS cert_title,
        'Card for ' || o_custkey AS cert_name, 'A' || o_orderkey AS activation_code, 'CARD' AS pay_type,
        'Customer ' || o_custkey AS gift_receiver, 'c@example.com' AS gift_receiver_mail, '7701' AS gift_receiver_mobile
    FROM orders
    """,
)
def _(t: Tables):
    key, customer, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    opened = status == "O"
    payload = F.struct(
        key.cast("string").alias("uid"),
        F.floor("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("order_type"),
        (status == "F").alias("is_gift_cert"),
        F.lit("  Gift card\t").alias("cert_title"),
        F.struct(
            F.concat(F.lit(" Customer "), customer, F.lit("\n")).alias("name"),
            F.lit(" c@example.com").alias("email"),
            F.lit("7701 ").alias("mobile"),
        ).alias("gift_receiver"),
        F.concat(F.lit(" A"), key).alias("activation_code"),
        (status != "P").alias("paid"),
        F.lit("CARD").alias("pay_type"),
        F.concat(F.lit("Card for "), customer).alias("pay_title"),
        F.lit("2020-05-01").alias("created_on"),
        F.lit("2020-05-02").alias("delivery_date"),
        F.when(opened, "2021-05-02").alias("expiring_date"),
        F.when(opened, F.lit(True)).alias("is_activated"),
    )
    return records.digital_orders(t.orders.select(F.to_json(payload).alias("order_data")))
