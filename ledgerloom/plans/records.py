"""Specifications of the document and record tables, and the tables themselves.

Fixed values: key names of the landed documents and the columns they fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.nested import (
    FlattenSpec,
    explode_rate_map,
    explode_schedule,
    explode_struct_array,
    flatten,
    flatten_strict,
)
from ledgerloom.functions.status import Lender
from ledgerloom.functions.text import WHITESPACE
from ledgerloom.sources import scan_wide_rows


def _plain(names: str, prefix: str = "_source.") -> dict[str, str]:
    """``column`` or ``column=key`` words to SQL expressions."""
    out = {}
    for word in names.split():
        column, _, key = word.partition("=")
        out[column] = f"{prefix}{key or column}"
    return out


def _braced(path: str) -> str:
    """A list as ``{a,b}`` text, the form the marts split again."""
    return f"concat('{{', array_join({path}, ','), '}}')"


_ITEM_FIELDS = """
    uid string, merchant_id string, name string, categories_array array<string>,
    amount double, price double, articul string, status string,
    bar_code array<string>, created_on string, updated_on string,
    is_visible boolean, available boolean, product_id string, scope array<string>,
    sale_channels array<string>, name_ebt string, sku_id string,
    group_id string, vendor string
"""
# A first element is read only where the key is present; an empty array has none.
_ITEM_REQUIRED = (
    "_id is not null",
    "_source.uid is not null",
    "_source.merchant_id is not null",
    "_source.bar_code is null or size(_source.bar_code) > 0",
)

NOMENCLATURE = FlattenSpec(
    schema=f"_id string, _source struct<{_ITEM_FIELDS}>",
    columns={
        "id": "_id",
        **_plain(
            "uid merchant_id name amount price articul status created_on updated_on is_visible "
            "available product_id name_ebt sku_id group_id vendor"
        ),
        "categories_array": _braced("_source.categories_array"),
        "scope": _braced("_source.scope"),
        "bar_code": "get(_source.bar_code, 0)",
        "sale_channels": "get(_source.sale_channels, 0)",
    },
    required=(
        *_ITEM_REQUIRED,
        "_source.sale_channels is null or size(_source.sale_channels) > 0",
    ),
)

DESK_NOMENCLATURE = FlattenSpec(
    schema=NOMENCLATURE.schema,
    columns={
        "id": "_id",
        **_plain(
            "uid merchant_id name amount price articul status created_on updated_on "
            "is_visible available group_id"
        ),
        "scope": _braced("_source.scope"),
        "bar_code": "get(_source.bar_code, 0)",
    },
    required=_ITEM_REQUIRED,
)

_PRODUCT_SCHEMA = """
    _id string,
    _source struct<
        merchant_id string, description string, name string, default_category string,
        categories_array array<string>, created_on string, updated_on string,
        is_visible boolean, label string, scope array<string>,
        skus array<struct<
            uid string, price double, amount double, product_param string, nomenclature string, sku string, min_nomen_id string>>>
"""
_PRODUCT_COLUMNS = {
    "id": "_id",
    **_plain(
        "merchant_id description name_=name default_category created_on updated_on is_visible "
        "label_=label"
    ),
    "categories_array": _braced("_source.categories_array"),
    "scope_": _braced("_source.scope"),
    # product_param is declared as text, so any JSON below it is kept as it is.
    **_plain("uid price amount nomenclature product_param", prefix="get(_source.skus, 0)."),
}

PRODUCTS = FlattenSpec(
    schema=_PRODUCT_SCHEMA,
    columns={**_PRODUCT_COLUMNS, "sku": "get(_source.skus, 0).sku"},
    required=("_source.merchant_id is not null", "size(_source.skus) > 0"),
)

SHOWCASE = FlattenSpec(
    schema=_PRODUCT_SCHEMA,
    columns={**_PRODUCT_COLUMNS, "sku": "get(_source.skus, 0).min_nomen_id"},
    required=("size(_source.skus) > 0",),
)

CATEGORIES = FlattenSpec(
    schema="_id string, _source struct<title string, seoTitle string, seoKeywords string, dscr string>",
    columns={
        "id": "_id",
        **_plain("title seo_keywords=seoKeywords description=dscr seo_title=seoTitle"),
    },
    required=("_id is not null", "_source is not null"),
)

TASK_HISTORY = FlattenSpec(
    schema="""
        _id string,
        _source struct<taskName string, dueDate string, taskStartDate string,
            taskEndDate string, assignee string, rootProcessInstanceId string,
            applicationNumber string, processDefinitionName string,
            activityInstanceId string, initiator string, processStartDate string,
            completed string>
    """,
    columns={
        "step_id": "_id",
        **_plain(
            "all_step=taskName due_dtime=dueDate create_dtime=taskStartDate date_end_t=taskEndDate "
            "user_state=assignee proc_def_id_=rootProcessInstanceId application_num=applicationNumber "
            "process_name=processDefinitionName activity_inst_id=activityInstanceId initiator "
            "proc_start_date=processStartDate completed"
        ),
    },
)

PROCESS_HISTORY = FlattenSpec(
    schema="""
        _id string,
        _source struct<applicationNumber string, startTime string,
            processDefinitionName string, startUserId string, completed string,
            endTime string, processInstanceId string, processDefinitionId string,
            assignmentList string, deleteReason string>
    """,
    columns={
        "id": "_id",
        **_plain(
            "application_num=applicationNumber start_dtime=startTime process_name=processDefinitionName "
            "init_username=startUserId state=completed end_dtime=endTime "
            "proc_inst_id_=processInstanceId proc_def_id_=processDefinitionId "
            "assignment_list=assignmentList delete_reason_=deleteReason"
        ),
    },
)

EMPLOYEE = FlattenSpec(
    schema="""
        _id string,
        _source struct<username string, fullName string, birthday string,
            employeeNumber string, employeeHeadNumber string, employeeContractNumber string,
            employeeContractDate string, hireDate string, iin string, mobilePhoneNumber string,
            position struct<code string, name string>,
            specialization struct<code string, name string, parentCode string>,
            department struct<code string, name string, parentCode string,
                curatorEmployeeNumber string, managerEmployeeNumber string>,
            branch struct<code string, name string>>
    """,
    columns={
        "id": "_id",
        **_plain(
            "username fullname=fullName birthday employeenumber=employeeNumber "
            "employeeheadnumber=employeeHeadNumber employeecontractnumber=employeeContractNumber "
            "employeecontractdate=employeeContractDate hiredate=hireDate iin "
            "mobilephonenumber=mobilePhoneNumber position_code=position.code "
            "position_name=position.name specialization_code=specialization.code "
            "specialization_name=specialization.name "
            "specialization_parentcode=specialization.parentCode department_code=department.code "
            "department_name=department.name department_parentcode=department.parentCode "
            "department_curatoremployeenumber=department.curatorEmployeeNumber "
            "department_manageremployeenumber=department.managerEmployeeNumber "
            "branch_name=branch.name branch_code=branch.code"
        ),
    },
)

DEPARTMENT = FlattenSpec(
    schema="""
        _id string,
        _source struct<code string, name string, nameKz string, parentCode string,
            description string, state string, isArchive boolean, isHq boolean,
            curatorEmployeeNumber string, managerEmployeeNumber string>
    """,
    columns={
        "id": "_id",
        **_plain(
            "code name name_kz=nameKz parent_code=parentCode description state is_archive=isArchive "
            "is_hq=isHq curator_employee_number=curatorEmployeeNumber "
            "manager_employee_number=managerEmployeeNumber"
        ),
    },
)

POSITION = FlattenSpec(
    schema="_id string, _source struct<code string, name string, nameKz string, isArchive boolean, level string>",
    columns={"id": "_id", **_plain("code name name_kz=nameKz is_archive=isArchive level")},
)

SPECIALIZATION = FlattenSpec(
    schema="""
        _id string,
        _source struct<code string, name string, nameKz string, parentCode string,
            curatorCode string, isActive boolean, isOnlyForOrganigram boolean>
    """,
    columns={
        "id": "_id",
        **_plain(
            "code name name_kz=nameKz parent_code=parentCode curator_code=curatorCode "
            "is_active=isActive is_only_for_organigram=isOnlyForOrganigram"
        ),
    },
)

MERCHANTS = FlattenSpec(
    schema="""
        doc struct<id string, telephone string, email string, brand string,
            old_id_code string, merchant_id string, state string, merchant_type array<string>,
            code string, description string, legal_name string, logo_token string,
            surl string, smap string, avatar_token string, banner_token string,
            contacts string, created_date string, updated_date string,
            biz_categories array<string>, address string, kassa_types array<string>,
            website string>
    """,
    columns={
        **_plain(
            "id telephone email brand old_id_code merchant_id state code description legal_name "
            "logo_token surl smap avatar_token banner_token contacts address website",
            prefix="doc.",
        ),
        "merchant_type": _braced("doc.merchant_type"),
        "biz_categories": _braced("doc.biz_categories"),
        "kassa_types": _braced("doc.kassa_types"),
        "created_date": "timestamp_millis(cast(doc.created_date as bigint))",
        "updated_date": "timestamp_millis(cast(doc.updated_date as bigint))",
    },
    required=("doc.id is not null",),
)

STORES = FlattenSpec(
    schema="""
        doc struct<merchant_id string, brand_name string, schedule string,
            address struct<street_num string, street string, region_id string, apt_num string>>
    """,
    columns={
        **_plain("merchant_id brand_name schedule", prefix="doc."),
        **_plain("street_num street region_id apt_num", prefix="doc.address."),
    },
    required=("doc.schedule <> ''",),
)

LOANS = FlattenSpec(
    schema="""
        profile_id string, status string,
        person_info struct<surname string, name string, patronymic string,
            birthdate string, sex string, iin string, mobile_phone string>
    """,
    columns={
        **_plain("profile_id", prefix="doc."),
        **_plain("order_id created_on", prefix=""),
        **_plain("surname name patronymic birthdate sex iin mobile_phone", prefix="doc.person_info."),
        "status1": "status",
        "status2": "doc.status",
    },
    required=("doc.person_info is not null",),
)


def _stripped(path: str) -> str:
    """SQL text of ``strip_whitespace``, as a specification holds text."""
    space = WHITESPACE.replace("\\", "\\\\")
    return f"regexp_replace({path}, '^{space}|{space}$', '')"


DIGITAL_ORDERS = FlattenSpec(
    schema="""
        uid string, price double, order_type string, is_gift_cert boolean,
        cert_title string,
        gift_receiver struct<name string, email string, mobile string>,
        activation_code string, paid boolean, pay_type string, pay_title string,
        created_on string, delivery_date string, expiring_date string,
        is_activated boolean
    """,
    columns={
        **_plain(
            "order_id=uid order_type created_dtime=created_on is_gift_cert cert_amount=price "
            "is_paid=paid is_activated delivery_dtime=delivery_date expiry_dtime=expiring_date",
            prefix="doc.",
        ),
        "cert_title": _stripped("doc.cert_title"),
        "cert_name": _stripped("doc.pay_title"),
        "activation_code": _stripped("doc.activation_code"),
        "pay_type": _stripped("doc.pay_type"),
        "gift_receiver": _stripped("doc.gift_receiver.name"),
        "gift_receiver_mail": _stripped("doc.gift_receiver.email"),
        "gift_receiver_mobile": _stripped("doc.gift_receiver.mobile"),
    },
    required=(
        "doc.uid is not null",
        "doc.price is not null",
        "doc.order_type is not null",
        "doc.is_gift_cert is not null",
        "doc.cert_title is not null",
        "doc.gift_receiver.name is not null",
        "doc.gift_receiver.email is not null",
        "doc.gift_receiver.mobile is not null",
        "doc.activation_code is not null",
        "doc.paid is not null",
        "doc.pay_type is not null",
        "doc.pay_title is not null",
        "doc.created_on is not null",
        "doc.delivery_date is not null",
    ),
)

DOCUMENT_SPECS = {
    "nomenclature": NOMENCLATURE,
    "desk_nomenclature": DESK_NOMENCLATURE,
    "products": PRODUCTS,
    "showcase": SHOWCASE,
    "categories": CATEGORIES,
    "task_history": TASK_HISTORY,
    "process_history": PROCESS_HISTORY,
    "employee": EMPLOYEE,
    "department": DEPARTMENT,
    "position": POSITION,
    "specialization": SPECIALIZATION,
}


def document_table(documents: DataFrame, name: str) -> DataFrame:
    """Flat table of landed documents, by specification name."""
    return flatten(documents, DOCUMENT_SPECS[name])


def merchants(records: DataFrame) -> DataFrame:
    return flatten(records, MERCHANTS)


def stores(records: DataFrame) -> DataFrame:
    """One row per store and weekday; a store without an address has none."""
    days = explode_schedule(flatten(records, STORES), "schedule")
    return days.withColumnsRenamed(
        {"isOpen": "isopen", "openTime": "opentime", "closeTime": "closetime"}
    )


def tariffs(records: DataFrame, lender: Lender) -> DataFrame:
    """One row per merchant and category with a column per rate code."""
    return explode_rate_map(records.select("merchant_id", "tariffs"), "tariffs", lender.rate_codes())


def parameters(documents: DataFrame) -> DataFrame:
    """One row per value of each catalogue parameter; values lacking a key are left out."""
    fields = {"uid_values": "uid_values", "values_": "values", "sort_values": "sort_values"}
    flat = documents.select(
        F.col("_id").alias("id"),
        F.col("_source.category_uid").alias("category_uid"),
        F.col("_source.title").alias("title"),
        F.col("_source.params_values").alias("params_values"),
    )
    return explode_struct_array(flat, "params_values", fields).dropna()


PARAMETER_SCHEMA = """
    _id string,
    _source struct<category_uid string, title string,
        params_values array<struct<uid_values string, values string, sort_values string>>>
"""


def loans(rows: DataFrame) -> DataFrame:
    """Loan requests from wide rows whose payload sits in ``loan_request``."""
    return flatten(scan_wide_rows(rows, "loan_request", LOANS.schema), LOANS)


def digital_orders(rows: DataFrame) -> DataFrame:
    """Gift certificates from wide rows; a payload without a required key fails the job."""
    return flatten_strict(scan_wide_rows(rows, "order_data", DIGITAL_ORDERS.schema), DIGITAL_ORDERS)


def columns_of(name: str) -> Sequence[str]:
    return list(DOCUMENT_SPECS[name].columns)
