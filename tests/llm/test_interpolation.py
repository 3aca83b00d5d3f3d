"""Deleted interpolation against a plain version with the same histogram steps."""

import math
import re
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from ledgerloom.llm import interpolation, queries


def plain(rows, order):
    """Scores of (id, text, part) rows."""
    def tokens(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return ["<s>"] * (order - 1) + words + ["</s>"]

    def counts(parts):
        out = Counter()
        for _, text, part in rows:
            if part in parts:
                t = tokens(text)
                for i in range(len(t)):
                    for k in range(1, order + 1):
                        if i + 1 >= k:
                            out[tuple(t[i + 1 - k : i + 1])] += 1
        return out

    def estimates(c, total, distinct, t, i):
        p = [1 / (distinct + 1), c[(t[i],)] / max(1, total)]
        for k in range(2, order + 1):
            context = c[tuple(t[i + 1 - k : i])]
            p.append(c[tuple(t[i + 1 - k : i + 1])] / context if context else 0.0)
        seen = c[tuple(t[i + 1 - order : i])] if order > 1 else 0
        return p, math.ceil(math.log2(seen + 1))

    def sizes(c):
        words = {k: n for k, n in c.items() if len(k) == 1 and k != ("<s>",)}
        return sum(words.values()), len(words)

    kept, full = counts((0,)), counts((0, 1))
    histogram = {}
    for _, text, part in rows:
        if part == 1:
            t = tokens(text)
            for i in range(order - 1, len(t)):
                p, bucket = estimates(kept, *sizes_kept, t, i) if (sizes_kept := sizes(kept)) else None
                steps = tuple(2.0 ** (-round(-math.log2(x) * 8) / 8) if x else 0.0 for x in p)
                histogram.setdefault(bucket, Counter())[steps] += 1
    weights, everywhere, n_all = {}, [0.0] * (order + 1), 0
    for bucket, cells in histogram.items():
        w, n = [1 / (order + 1)] * (order + 1), sum(cells.values())
        for _ in range(interpolation.ROUNDS):
            gained = [0.0] * (order + 1)
            for p, m in cells.items():
                total = sum(a * b for a, b in zip(p, w))
                for k in range(order + 1):
                    gained[k] += m * p[k] * w[k] / total
            w = [g / n for g in gained]
        weights[bucket] = w
        everywhere = [e + n * x for e, x in zip(everywhere, w)]
        n_all += n
    lift = lambda w: [max(x, 1e-6) / sum(max(y, 1e-6) for y in w) for x in w]
    out, total = {}, sizes(full)
    for key, text, _ in rows:
        t, score, base = tokens(text), 0.0, 0.0
        for i in range(order - 1, len(t)):
            p, bucket = estimates(full, *total, t, i)
            w = lift(weights.get(bucket, [e / n_all for e in everywhere]))
            score += math.log10(sum(a * b for a, b in zip(p, w)))
            base += math.log10((full[(t[i],)] + 0.5) / (total[0] + 0.5 * (total[1] + 1)))
        out[key] = (len(t) - order + 1, total[0], base, score)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_plain_version(spark, order):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60").collect()
    rows = [(r.doc_id, r.text[:1500], (0, 1, 2, 0)[r.doc_id % 4]) for r in docs] + [(900, None, 0), (901, "", 1), (902, " A a A \n", 2)]
    table = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, part int, score double").repartition(3)
    got = {r.doc_id: r for r in interpolation.scored_documents(table, "part", order).collect()}
    for key, (n, total, base, score) in plain(rows, order).items():
        r = got[key]
        assert (r.n_tokens, r.train_tokens) == (n, total)
        assert abs(r.base_score - base) < 1e-6 and abs(r.score - score) < 1e-6 * max(1, abs(score))


def test_query_folds_and_fit(spark):
    found = queries.QUERIES["op4_deleted_interpolation"](spark, SF_DIR)
    rows = found.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    held = found.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_nothing_learned(spark):
    table = spark.createDataFrame([(1, "a b", 2), (None, None, None)], "doc_id long, text string, part int")
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, round(abs(r.score), 4)) for r in interpolation.scored_documents(table, "part").collect())
    assert got == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert interpolation.scored_documents(table.where("false"), "part").count() == 0


def test_base_columns_against_sql(spark):
    """Token counts and base scores of the whole table in SQL (folds come from the client, which has crc32)."""
    duck = duckdb.connect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    folds = pa.table({"doc_id": [r.doc_id for r in docs], "fold": [zlib.crc32(str(r.doc_id).encode()) % 5 for r in docs]})
    duck.register("folds", folds)
    rows = duck.sql(
        rf"""
        WITH t AS (
            SELECT d.doc_id, fold <> 1 AS trained, unnest(list_append(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ')) AS w
            FROM '{SF_DIR}/documents.parquet' d JOIN folds ON folds.doc_id = d.doc_id
        ), c AS (SELECT w, count(*) AS c FROM t WHERE trained GROUP BY w),
        s AS (SELECT sum(c) AS n, count(*) AS v FROM c)
        SELECT doc_id, bool_or(NOT trained) AS held_out, count(*) AS n_tokens, count(c) AS n_known, cast(any_value(n) AS BIGINT) AS train_tokens,
            sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))) AS base_score
        FROM t LEFT JOIN c ON c.w = t.w, s GROUP BY doc_id
        """
    ).fetchall()
    got = {r.doc_id: r for r in queries.QUERIES["op4_deleted_interpolation"](spark, SF_DIR).collect()}
    assert len(rows) == len(got) == len(docs)
    for doc_id, held_out, n_tokens, n_known, train_tokens, base in rows:
        r = got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n_tokens, n_known, train_tokens)
        assert abs(r.base_score - base) < 1e-9 * abs(base)
