"""The whole pipeline against plain versions of its stages, one after the other."""

import random

import duckdb
import test_decontam
import test_minmax
import test_phrases

import corpus_pipeline
from ledgerloom.llm.queries import ORACLES

WORDS = [f"w{i}" for i in range(500)]


def made():
    """Documents with copies, near copies, shared passages, benchmark items and texts without a letter."""
    rng = random.Random(11)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passages, items = [prose(n) for n in (35, 40, 80)], [(i, prose(20)) for i in range(6)]
    texts = []
    for _ in range(60):
        parts = [prose(rng.randrange(20, 90))]
        if rng.random() < 0.3:
            parts.append(rng.choice(passages))
        if rng.random() < 0.15:
            parts.append(rng.choice(items)[1])
        texts.append(" ".join(parts + [prose(rng.randrange(10))]))
    for text in rng.sample(texts, 12):
        words = text.split(" ")
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    texts += texts[:4] + [None, "", "12 -- 34", " "]
    rows = [(i, t, rng.choice(["en", "de"]), rng.choice(["a", "b", "c", None])) for i, t in enumerate(texts)]
    return rows, items


def test_whole_pipeline_against_plain_stages(spark, tmp_path):
    rows, items = made()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.text, r.copies_, r.taken_) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    left = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    groups = test_minmax.brute([r[:2] for r in left], 5, 80)
    unique = [r for r in left if groups[r[0]][1] == r[0]]
    cut = test_phrases.brute([r[1] for r in unique], 35)
    texts = [r[1] if n == 0 else kept for r, (_, n, kept) in zip(unique, cut, strict=True)]
    leaks = {d for d, _ in test_decontam.plain([(r[0], t) for r, t in zip(unique, texts, strict=True)], items)}
    clean = [(r[0], t, r[3]) for r, t in zip(unique, texts, strict=True) if r[0] not in leaks]
    assert len(rows) > len(left) > len(unique) > len(clean) and any(n for _, n, _ in cut)

    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?)", clean)
    taken = {doc: (size, n) for doc, size, n in duck.sql(f"SELECT doc_id, size, taken FROM ({ORACLES['op8_mixture']})").fetchall()}
    text_of = {d: t for d, t, _ in clean}
    wanted = {d: (text_of[d], n // size, n) for d, (size, n) in taken.items() if n}
    assert {d: v for d, v in got.items() if v[2]} == wanted and set(got) <= set(text_of)
