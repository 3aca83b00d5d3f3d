"""Document and record specifications on hand-made rows."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions.nested import explode_rate_map, explode_text_array, flatten, rejected
from ledgerloom.functions.status import Lender
from ledgerloom.plans import records


def land(spark, tmp_path, documents, schema):
    path = tmp_path / "landed.json"
    path.write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in documents))
    return spark.read.schema(schema).json(str(path))


ITEM = {"uid": "u", "merchant_id": "m"}


def test_items_keep_optional_and_drop_incomplete(spark, tmp_path):
    documents = [
        {"_id": "1", "_source": {**ITEM, "bar_code": ["b", "c"], "categories_array": ["x", "y"], "price": 5}},
        {"_id": "2", "_source": ITEM},
        {"_id": "3", "_source": {"uid": "u"}},
        {"_id": "4", "_source": {**ITEM, "bar_code": []}},
        {"_id": "5", "_source": {**ITEM, "sale_channels": []}},
    ]
    spec = records.NOMENCLATURE
    df = land(spark, tmp_path, documents, spec.schema)
    found = {r["id"]: r for r in flatten(df, spec).collect()}
    assert sorted(found) == ["1", "2"]
    assert found["1"]["bar_code"] == "b"
    assert found["1"]["categories_array"] == "{x,y}"
    assert found["2"]["bar_code"] is None and found["2"]["price"] is None
    assert sorted(r["_id"] for r in rejected(df, spec).collect()) == ["3", "4", "5"]
    desk = {r["id"] for r in flatten(df, records.DESK_NOMENCLATURE).collect()}
    assert desk == {"1", "2", "5"}


@pytest.mark.parametrize("name", ["products", "showcase"])
def test_products_read_their_first_sku(spark, tmp_path, name):
    documents = [
        {
            "_id": "1",
            "_source": {
                "merchant_id": "m",
                "scope": ["a"],
                "skus": [
                    {"uid": "u", "price": 3, "sku": "s", "min_nomen_id": "n", "product_param": {"k": [1]}},
                    {"uid": "v"},
                ],
            },
        },
        {"_id": "2", "_source": {"skus": [{}]}},
        {"_id": "3", "_source": {"merchant_id": "m", "skus": []}},
        {"_id": "4", "_source": {"merchant_id": "m"}},
    ]
    spec = records.DOCUMENT_SPECS[name]
    found = {r["id"]: r for r in flatten(land(spark, tmp_path, documents, spec.schema), spec).collect()}
    assert sorted(found) == (["1"] if name == "products" else ["1", "2"])
    assert found["1"]["uid"] == "u" and found["1"]["scope_"] == "{a}"
    assert json.loads(found["1"]["product_param"]) == {"k": [1]}
    assert found["1"]["sku"] == ("s" if name == "products" else "n")


def test_employee_without_sub_documents(spark, tmp_path):
    documents = [
        {"_id": "1", "_source": {"username": "a", "position": {"code": "p"}, "department": {"parentCode": "d"}}},
        {"_id": "2", "_source": {"username": "b"}},
    ]
    spec = records.EMPLOYEE
    found = {r["id"]: r for r in flatten(land(spark, tmp_path, documents, spec.schema), spec).collect()}
    assert found["1"]["position_code"] == "p" and found["1"]["department_parentcode"] == "d"
    assert found["2"]["position_code"] is None and found["2"]["branch_name"] is None


SIMPLE = {
    "categories": ({"title": "t", "seoTitle": "s", "dscr": "d"}, {"title": "t", "seo_title": "s", "description": "d"}),
    "task_history": (
        {"taskName": "n", "rootProcessInstanceId": "p", "taskEndDate": 1700000000000, "completed": True},
        {"all_step": "n", "proc_def_id_": "p", "date_end_t": "1700000000000", "completed": "true"},
    ),
    "process_history": (
        {"applicationNumber": "a", "completed": False, "processInstanceId": "p"},
        {"application_num": "a", "state": "false", "proc_inst_id_": "p"},
    ),
    "department": ({"code": "c", "isHq": True, "nameKz": "k"}, {"code": "c", "is_hq": True, "name_kz": "k"}),
    "position": ({"code": "c", "level": 3}, {"code": "c", "level": "3"}),
    "specialization": ({"code": "c", "isOnlyForOrganigram": False}, {"code": "c", "is_only_for_organigram": False}),
}


@pytest.mark.parametrize("name", sorted(SIMPLE))
def test_simple_documents(spark, tmp_path, name):
    source, expected = SIMPLE[name]
    spec = records.DOCUMENT_SPECS[name]
    df = land(spark, tmp_path, [{"_id": "1", "_source": source}], spec.schema)
    row = flatten(df, spec).first().asDict()
    assert list(row) == list(records.columns_of(name))
    given = {"id": "1", "step_id": "1", **expected}
    assert row == {column: given.get(column) for column in row}


def test_merchants(spark, tmp_path):
    documents = [
        {"doc": {"id": "1", "created_date": 1577836800000, "merchant_type": ["A", "B"]}},
        {"doc": {"id": "2"}},
        {"doc": {"brand": "no id"}},
    ]
    df = land(spark, tmp_path, documents, records.MERCHANTS.schema)
    found = {r["id"]: r for r in records.merchants(df).collect()}
    assert sorted(found) == ["1", "2"]
    assert str(found["1"]["created_date"]) == "2020-01-01 00:00:00"
    assert found["1"]["merchant_type"] == "{A,B}"
    assert found["2"]["created_date"] is None


def test_stores(spark, tmp_path):
    week = json.dumps([{"day": f"d{i}", "isOpen": i < 6, "openTime": "09:00"} for i in range(7)])
    documents = [
        {"doc": {"merchant_id": "1", "schedule": week, "address": {"street": "s"}}},
        {"doc": {"merchant_id": "2", "schedule": week}},
        {"doc": {"merchant_id": "3", "schedule": ""}},
        {"doc": {"merchant_id": "4"}},
    ]
    found = records.stores(land(spark, tmp_path, documents, records.STORES.schema)).collect()
    assert sorted(r["merchant_id"] for r in found) == ["1"] * 7 + ["2"] * 7
    assert {r["street"] for r in found if r["merchant_id"] == "2"} == {None}
    assert {r["closetime"] for r in found} == {None}


def test_tariffs(spark):
    texts = [
        ("1", "{'root': {'EXPRESS_0_4': 1.5, 'ODD': 9}, 'c': {'CARD_0_0': 2}}"),
        ("2", "{}"),
        ("3", "not a map"),
        ("4", None),
    ]
    df = spark.createDataFrame(texts, "merchant_id string, tariffs string")
    found = {(r["merchant_id"], r["cat_id"]): r for r in records.tariffs(df, Lender()).collect()}
    assert sorted(found) == [("1", "c"), ("1", "root")]
    assert found["1", "root"]["EXPRESS_0_4"] == 1.5 and found["1", "root"]["CARD_0_0"] is None
    assert found["1", "c"]["CARD_0_0"] == 2.0
    assert "ODD" not in found["1", "c"].asDict()
    assert explode_rate_map(df, "tariffs", ["ODD"]).where("ODD IS NOT NULL").count() == 1


def test_parameters_leave_out_incomplete_values(spark, tmp_path):
    documents = [
        {
            "_id": "1",
            "_source": {
                "category_uid": "c",
                "title": "t",
                "params_values": [
                    {"uid_values": "u", "values": "v", "sort_values": "1"},
                    {"uid_values": "u2", "values": "v2"},
                ],
            },
        },
        {"_id": "2", "_source": {"category_uid": "c", "title": "t"}},
    ]
    df = land(spark, tmp_path, documents, records.PARAMETER_SCHEMA)
    assert [tuple(r) for r in records.parameters(df).collect()] == [("1", "c", "t", "u", "v", "1")]


GIFT = {
    "uid": "1",
    "price": 10,
    "order_type": "t",
    "is_gift_cert": True,
    "cert_title": " a ",
    "gift_receiver": {"name": "n\n", "email": "e", "mobile": "m"},
    "activation_code": "c",
    "paid": True,
    "pay_type": "p",
    "pay_title": "q",
    "created_on": "2020-01-01",
    "delivery_date": "2020-01-02",
}


def test_digital_orders_are_strict(spark):
    whole = spark.createDataFrame([(json.dumps(GIFT),)], "order_data string")
    row = records.digital_orders(whole).first()
    assert (row["cert_title"], row["gift_receiver"], row["is_activated"]) == ("a", "n", None)
    lacking = {k: v for k, v in GIFT.items() if k != "paid"}
    broken = spark.createDataFrame([(json.dumps(lacking),)], "order_data string")
    with pytest.raises(PySparkException, match="required key missing"):
        records.digital_orders(broken).collect()


def test_loans(spark):
    payload = {"profile_id": "p", "person_info": {"name": "n"}, "status": "inner"}
    df = spark.createDataFrame(
        [("o", "2024-01-01", "outer", json.dumps(payload)), ("o2", "2024-01-01", "outer", "{}")],
        "order_id string, created_on string, status string, loan_request string",
    )
    found = records.loans(df).collect()
    assert [(r["order_id"], r["status1"], r["status2"], r["name"], r["iin"]) for r in found] == [
        ("o", "outer", "inner", "n", None)
    ]


def test_publish_lists(spark, bag):
    df = spark.createDataFrame(
        [(1, '{a,"",b}', "{c}"), (2, '{""}', None), (3, None, '{"",d}')], "i int, e string, d string"
    )
    both = explode_text_array(df, {"e": "on", "d": "off"}, "item", "label")
    assert bag(both) == [(1, "off", "c"), (1, "on", "a"), (1, "on", "b"), (3, "off", "d")]
    assert bag(explode_text_array(df.select("i", "e"), "e", "item")) == [(1, "a"), (1, "b")]
    assert df.where(F.col("i") == 2).count() == 1
