"""Column functions on hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.functions import rules, text, times
from ledgerloom.functions.status import Lender, stage_of


def values(spark, inputs, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_phones(spark):
    given = ["+7 701 222-33-44", "8 701 2223344", "7012223344", "0077012223344", "77012223344", None, " - "]
    assert values(spark, given, "string", text.normalise_phone) == [
        "77012223344",
        "77012223344",
        "77012223344",
        "77012223344",
        "77012223344",
        None,
        "",
    ]


def test_buckets_include_their_upper_bound(spark):
    build = lambda v: rules.bucketize(v, fv.INCOME_SEGMENTS, fv.INCOME_ABOVE)
    assert values(spark, [200000, 200001, 400000, 600000, 600001, None], "int", build) == [
        "до 200 000",
        "до 400 000",
        "до 400 000",
        "до 600 000",
        "более 600 000",
        None,
    ]
    above_last = values(spark, [600000, 600001], "int", lambda v: rules.bucketize(v, fv.PRICE_SEGMENTS))
    assert above_last == ["до 600 000", None]


def test_a_value_under_two_labels_is_rejected(spark):
    with pytest.raises(ValueError):
        rules.value_map(F.col("x"), {"a": ("1", "2"), "b": ("2",)})


def test_business_day(spark):
    given = [datetime(2024, 1, 1, 7, 59, 59), datetime(2024, 1, 1, 8, 0, 0), None]
    assert values(spark, given, "timestamp_ntz", times.business_day) == [
        datetime(2024, 1, 1, 7, 59, 59),
        datetime(2024, 1, 2, 8, 0, 0),
        None,
    ]


def test_local_time_around_the_change_of_offset(spark):
    given = [datetime(2024, 2, 29, 12), datetime(2024, 3, 1, 12)]
    assert values(spark, given, "timestamp_ntz", times.local_time) == [
        datetime(2024, 2, 29, 18),
        datetime(2024, 3, 1, 17),
    ]


def test_mixed_timestamps(spark):
    given = ["1704067200123", "2024-01-01 05:06:07", "2024-01-01T05:06:07", "soon", None]
    assert values(spark, given, "string", times.mixed_timestamp) == [
        datetime(2024, 1, 1, 0, 0, 0, 123000),
        datetime(2024, 1, 1, 5, 6, 7),
        datetime(2024, 1, 1, 5, 6, 7),
        None,
        None,
    ]


def test_ages_and_compact_dates(spark):
    given = [date(2000, 1, 1), date(2023, 1, 2), None]
    assert values(spark, given, "date", lambda v: times.age_years(v, "2024-01-01")) == [24, 0, None]
    assert values(spark, ["20240229"], "string", times.compact_date) == [date(2024, 2, 29)]


def test_words_paths_and_slices(spark):
    assert values(spark, ["ab-cd EF", "тОО «аБ»", None], "string", text.initcap_words) == [
        "Ab-Cd Ef",
        "Тоо «Аб»",
        None,
    ]
    assert values(spark, ["a/b/c", "a/", "a"], "string", text.last_segment) == ["c", "", "a"]
    assert values(spark, ["{a,b}"], "string", lambda v: text.level(text.braced_list(v), 3)) == [None]
    assert values(spark, ["\t a b \n", "  "], "string", text.strip_whitespace) == ["a b", ""]
    assert values(spark, ["Рассрочка на 12 месяцев", "без числа тут", "на"], "string", text.title_number) == [
        12,
        None,
        None,
    ]
    between = lambda v: text.extract_between(v, '"price": ', ", ")
    assert values(spark, ['{"price": 5, "x": 1}', '{"price": 5}', "{}"], "string", between) == ["5", None, None]


def test_labels_and_null(spark):
    df = spark.sql("SELECT 'a' AS x, cast(NULL AS string) AS y, true AS z")
    row = df.select(
        rules.composite_label(F.col("x"), F.col("z")),
        rules.composite_label(F.col("x"), F.col("y")),
        rules.composite_label(F.col("x"), F.col("y"), null_safe=True),
    ).first()
    assert tuple(row) == ("a/true", None, "a/")


def test_percentage_rounds_half_up(spark):
    df = spark.sql("SELECT cast(1.0005 AS decimal(10,4)) AS a, cast(100 AS decimal(5,2)) AS r")
    assert df.select(rules.percentage(F.col("a"), F.col("r"))).first()[0] == Decimal("1.001")
    assert df.select(rules.percentage(F.col("a"), F.lit(None))).first()[0] == Decimal("0.000")


@pytest.mark.parametrize(
    "status, paid, kind, label",
    [
        ("new", False, "CARD", fv.CREATED),
        ("new", True, "CARD", fv.SUBMITTED),
        ("new", None, "CARD", fv.SUBMITTED),
        ("pending_approve", False, "COD", fv.CREATED),
        ("pending_approve", False, "CARD", fv.SUBMITTED),
        ("courier_delivery", False, "CARD", fv.ACCEPTED),
        ("taken", True, None, fv.COMPLETED),
        ("returned", True, None, fv.RETURNED),
        ("cancelledbyanyone", False, None, fv.CANCELLED),
        ("unheard of", False, None, None),
    ],
)
def test_stages(spark, status, paid, kind, label):
    df = spark.createDataFrame([(status, paid, kind)], "s string, p boolean, k string")
    assert df.select(stage_of(F.col("s"), F.col("p"), F.col("k"))).first()[0] == label


@pytest.mark.parametrize(
    "kind, code, title, loan, label",
    [
        ("ACQUIRING", "ACQUIRING_0_6", "x", None, fv.CARD_6),
        ("X", "EXPRESS_18_24", "В рассрочку", None, fv.CREDIT_CARD),
        ("X", "EXPRESS_18_24", "other", fv.CREDIT_6, fv.CREDIT_24),
        ("X", None, "other", fv.CREDIT_6, fv.CREDIT_6),
        ("X", None, "В рассрочку на 4 месяцев", None, fv.INSTALMENT_4),
        ("AN_EXPRESS_KIND", None, "other", None, "Экспресс кредит"),
        ("X", None, "other", None, "other"),
        (None, None, None, None, None),
    ],
)
def test_payment_products(spark, kind, code, title, loan, label):
    df = spark.createDataFrame([(kind, code, title, loan)], "k string, c string, t string, l string")
    product = Lender().payment_product(*[F.col(name) for name in "kctl"])
    assert df.select(product).first()[0] == label


def test_lender_names_are_parameters(spark):
    lender = Lender(code="ACME", title="Acme loan")
    df = spark.createDataFrame([("ACME_LOAN", "x")], "k string, t string")
    assert df.select(lender.pay_group(F.col("k"), F.col("t"))).first()[0] == "Acme loan"
    assert lender.rate_columns()[fv.CREDIT_24] == "ACME_18_24"
