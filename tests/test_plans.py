"""Physical plans: what must and must not appear in them."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from conftest import SF_DIR
from ledgerloom.operators.joins import left_join_by_parts, lookup_levels
from ledgerloom.operators.latest import latest_per_key
from ledgerloom.sources import scan_table
from registry.core import Tables

QUERIES = spark_entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_and_pushes(spark):
    kept = (F.col("s_acctbal") > 0) & (F.col("s_nationkey") != 3)
    text = plan(scan_table(spark, SF_DIR, "supplier", ["s_suppkey"], kept))
    assert "GreaterThan(s_acctbal,0.0)" in text
    assert "ReadSchema: struct<s_suppkey:bigint,s_nationkey:int,s_acctbal:double>" in text


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_hour_window", "GreaterThanOrEqual(ts,2024-01-30T04:00)"),
        ("filter_previous_day", "LessThan(ts,2024-01-31T00:00)"),
        ("filter_month_of_as_of", "GreaterThanOrEqual(o_orderdate,1998-08-01T00:00)"),
    ],
)
def test_relative_dates_reach_the_scan(spark, name, pushed):
    assert pushed in plan(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize(
    "name",
    [
        "latest_per_key",
        "status_gap_removed",
        "mart_orders",
        "mart_passed_orders",
        "mart_credit_funnel",
        "mart_statement",
        "mart_purchases",
        "abandoned_events",
    ],
)
def test_rows_are_limited_per_key_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    partial = [line for line in text.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    final = [line for line in text.splitlines() if "WindowGroupLimit" in line and "Final" in line]
    assert partial and len(partial) == len(final)


def test_small_dimension_is_broadcast_and_large_one_is_not(spark):
    t = Tables(spark, SF_DIR)
    items = t.part.select("p_partkey", F.col("p_brand").alias("k1"), F.col("p_type").alias("k2"))
    dim = t.part.select(F.col("p_brand").alias("id"), F.col("p_type").alias("title")).distinct()
    build = lambda: lookup_levels(items, {"k1": "c1", "k2": "c2"}, dim, "id", "title", "p_partkey")
    assert plan(build()).count("BroadcastHashJoin") == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(build())
        assert "BroadcastHashJoin" not in text
        assert text.count("SortMergeJoin") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def tight_skew_limits(spark):
    """Limits small enough for test data to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_hot_right_side_is_cut_into_parts(spark, tight_skew_limits):
    """A third of the steps belong to one process: the join by parts deals them to
    several tasks, the plain left join cannot."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    steps = spark.range(0, 60000, 1, 8).select(
        key.alias("proc"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    processes = spark.range(0, 6000, 1, 4).select(F.col("id").alias("pid"))

    def most_in_a_task(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    joined = left_join_by_parts(processes, steps, "pid", "proc", part_rows=2000)
    plain = processes.join(steps, F.col("pid") == F.col("proc"), "left")
    assert most_in_a_task(joined) < 16000 < 20000 <= most_in_a_task(plain)
    assert joined.count() == plain.count()


def test_outer_join_reads_each_wide_input_once(spark):
    """The keys are counted by a scan of the key column alone."""
    t = Tables(spark, SF_DIR)
    text = plan(left_join_by_parts(t.customer, t.orders, "c_custkey", "o_custkey"))
    wide = [line for line in text.splitlines() if "FileScan" in line and line.count("#") > 3]
    assert len(wide) == 2


def exchanges(spark, name):
    return plan(QUERIES[name](spark, SF_DIR)).count("Exchange hashpartitioning")


def test_level_lookups_are_one_join(spark):
    """Five levels; the paths are dealt once, to make them distinct."""
    text = plan(QUERIES["category_titles"](spark, SF_DIR))
    assert sum("Join" in line and "LeftOuter" in line for line in text.splitlines()) == 1
    assert text.count("Exchange hashpartitioning(categories_array") == 1


def below(text: str, head: str) -> list[str]:
    """The lines of the subtree under each line that has ``head`` in it, one text per subtree."""
    lines = text.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if head in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            found.append("\n".join(lines[i + 1 : end]))
    return found


@pytest.mark.parametrize("name", ["mart_process_steps", "mart_process_flow"])
def test_employees_are_looked_up_before_rows_multiply(spark, name):
    """Open tasks alone are dealt by their employee, and processes alone by theirs."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    open_tasks = below(text, "Exchange hashpartitioning(curr_username")
    started = below(text, "Exchange hashpartitioning(init_username")
    assert open_tasks and started
    assert "Join" not in "".join(started) and all(part.count("Join") <= part.count("LeftAnti") for part in open_tasks)


@pytest.mark.parametrize("name", ["mart_purchases", "purchases_report"])
def test_purchases_move_no_wide_rows_for_lookups(spark, name):
    """Nothing that is dealt has been put into segments, and items meet lines before orders."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = below(text, "Exchange ")
    assert dealt and not any("Generate explode(filter(" in part for part in dealt)
    by_item = below(text, "Exchange hashpartitioning(product_merchant_id")
    assert by_item and not any("user_surname" in part for part in by_item)
    for part in below(text, "Exchange hashpartitioning(categories_array"):
        assert "LeftSemi" in part


@pytest.mark.parametrize("name", ["flatten_nomenclature", "flatten_spec", "flatten_records", "nested_flatten", "required_fields_drop"])
def test_documents_are_parsed_once(spark, name):
    """Predicates read the parsed document; none repeats the parse."""
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_detail_counts_are_dealt_once(spark):
    """Of the six exchanges, one belongs to the derived categories table."""
    assert exchanges(spark, "mart_catalog_counts_detail") <= 6


def test_rejects_are_stored_in_the_pass_that_stores_rows(spark, tmp_path):
    """One job reads the input: the counts come from its observation."""
    from ledgerloom import sinks
    from ledgerloom.functions import nested
    from registry.nested import LOAN

    rows = Tables(spark, SF_DIR).loan_rows.withColumn("doc", F.from_json("loan_request", LOAN.schema)).drop("loan_request")
    routed = nested.route(rows, LOAN)
    assert plan(routed).count("FileScan") == 1
    seen = sinks.write_routed(rows, LOAN, str(tmp_path / "t"))
    accepted, rejects = sinks.read_routed(spark, LOAN, str(tmp_path / "t"))
    assert set(seen) == {"accepted", *LOAN.required}
    assert accepted.count() == seen["accepted"] == nested.flatten(rows, LOAN).count() > 0
    assert rejects.count() == sum(seen.values()) - seen["accepted"] == nested.rejected(rows, LOAN).count() > 0
    first = rejects.first()
    assert "person_info" in first.rejected_document and first.outcome in LOAN.required


def test_latest_rows_travel_once_per_key_and_partition(spark):
    """With one key for all rows the limit stands below the exchange too."""
    df = spark.range(0, 10000, 1, 8).select((F.col("id") % 1).alias("k"), F.col("id"))
    latest = latest_per_key(df, ["k"], [F.col("id").desc()])
    assert [r["id"] for r in latest.collect()] == [9999]
    text = plan(latest)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
