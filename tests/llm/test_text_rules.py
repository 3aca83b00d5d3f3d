"""Quality ledger: bits, policies, ablations."""

from ledgerloom.llm import rules

SCHEMA = "doc_id long, text string, n_words string, failed string"


def test_edges_and_policies(spark):
    long_ = " ".join(f"word{i}" for i in range(60))
    docs = [(1, long_), (2, None), (None, ""), (4, "a b c " * 40), (5, long_ + "\n" + " ".join(["##"] * 20)), (6, "same line\n" * 3)]
    entries = rules.ledger(spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA))
    assert "Python" not in entries._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: r for r in entries.collect()}
    names = list(rules.RULES)
    failed = {k: {n for i, n in enumerate(names) if r.failed >> i & 1} for k, r in got.items()}
    assert failed[1] == set() and failed[2] == failed[None] == {"few_words"}
    assert failed[4] == {"repeated_words", "short_words"} and got[4].n_repeat_words == 120
    assert failed[5] == {"symbols"} and got[5].n_symbols == 40
    assert failed[6] == {"few_words", "repeated_words", "duplicate_lines"} and (got[6].n_lines, got[6].n_dup_lines) == (3, 2)
    freed = {r.rule: (r.failing, r.freed) for r in rules.ablations(entries, rules.POLICY).collect()}
    assert freed["symbols"] == (1, 1) and freed["few_words"] == (3, 2) and freed["repeated_words"] == (2, 0)
    base = {r.rule: r.freed for r in rules.ablations(entries, rules.BASE).collect()}
    assert base == {"few_words": 2, "repeated_words": 1}


def test_empty(spark):
    assert rules.ledger(spark.createDataFrame([], SCHEMA)).count() == 0
