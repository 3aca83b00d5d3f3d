"""Targets and thresholds of the mix."""

from pyspark.sql import functions as F

from ledgerloom.llm import mixing


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_targets_are_met_and_nest(spark):
    rows = [(i, "w " * (i % 37), ["a", "B", None, "é"][i % 7 % 4], "x") for i in range(3000)] + [(None, None, "empty", "x"), (None, "a b", None, "x")]
    docs = docs_of(spark, rows)
    found = mixing.mixed_documents(docs).collect()
    assert len(found) == len(rows) and all(0 <= r.taken <= 2 * r["size"] for r in found)
    by = {}
    for r in found:
        by.setdefault(r.source, []).append(r)
    total = sum(r["size"] for r in found)
    targets = {s: g[0].target for s, g in by.items()}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    for group in by.values():
        assert group[0].source_size == sum(r["size"] for r in group) and group[0].target <= 2 * group[0].source_size
        assert 2 * abs(group[0].target - sum(r.taken for r in group)) <= max(r["size"] for r in group)
    less = {r.doc_id: r.taken for r in mixing.mixed_documents(docs, share=0.9).collect()}
    equal = [s for s in by if s != "empty"]
    assert all(less[r.doc_id] <= r.taken for s in equal for r in by[s] if r.doc_id is not None and targets[s] < 2 * r.source_size)


def test_weights_cycle_by_code_point(spark):
    sizes = spark.createDataFrame([("B", 10**6), ("a", 10**6), ("é", 10**6), (None, 10**6)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes, share=0.9).collect()}
    assert got == {"B": 1.2e6, "a": 0.4e6, "é": 0.8e6, None: 1.2e6}


def test_one_source_and_none(spark):
    assert mixing.mixed_documents(docs_of(spark, [])).count() == 0
    got = mixing.mixed_documents(docs_of(spark, [(1, "a b", "s", ""), (1, "a b", "s", "")])).agg(F.sum("taken"), F.max("target")).first()
    assert tuple(got) == (4, 6.0)
