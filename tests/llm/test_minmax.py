"""Near-duplicates against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import minmax
from ledgerloom.llm.components import component_labels, hub_join


def brute(rows, size, percent):
    sets = {}
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    keys = sorted(sets)
    label = {k: k for k in keys}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {k: (len(sets[k]), top(k)) for k in keys}


@pytest.mark.parametrize("size,edits", [(2, 4), (2, 9), (5, 3)])
def test_against_all_pairs(spark, size, edits):
    """Copies with edits around the threshold: many pairs are close, few are links."""
    rng = random.Random(size * 10 + edits)
    rows, key = [], 0
    for group in range(4):
        base = [f"w{rng.randrange(5000)}" for _ in range(100)]
        for _ in range(250 if group == 0 else 20):
            copy = list(base)
            for _ in range(rng.randrange(edits * 2)):
                copy[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
            rows.append((key, " ".join(copy)))
            key += 1
    rows += [(key, "A b"), (key + 1, "a  B"), (key + 2, "one"), (key + 3, "ONE"), (key + 4, ""), (key + 5, None), (key + 6, "  ")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, component_id long, kept boolean")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minmax.near_duplicates(docs, size, 80).collect()}
    assert got == brute(rows, size, 80)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (None, text), (3, text), (4, None), (None, None)]
    got = sorted(map(tuple, minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(5, 46, 3, False)] * 2 + [(None, 46, None, True), (3, 46, 3, True), (4, 0, 4, True), (None, 0, None, True)], key=repr)
    assert minmax.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_banding_finds_links():
    assert minmax.banding_for(80) == (43, 5)
    for percent in range(25, 101):
        banding = minmax.banding_for(percent)
        assert 1 - banding.found(percent / 100) < 1e-7 and banding.bands * banding.rows <= minmax.SIGNATURE
    with pytest.raises(ValueError, match="too low"):
        minmax.banding_for(3)


@pytest.mark.parametrize("percent", [50, 65, 95, 100])
def test_other_thresholds_against_all_pairs(spark, percent):
    """Copies whose similarity lies around the threshold, of several sizes."""
    rng = random.Random(percent)
    rows = []
    for _ in range(12):
        n = rng.choice([12, 40, 100])
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for _ in range(15):
            copy = list(base)
            for _ in range(rng.randrange(max(1, round(n * (1 - percent / 100) * 0.7)) + 1)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy[: rng.choice([n, n, n - n // 5])])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minmax.near_duplicates(docs, 2, percent).collect()}
    assert got == brute(rows, 2, percent)


def test_tiles_hold_neighbouring_sizes_only(spark):
    """Members of all sizes with one centre: only pairs of like sizes meet, every such pair does."""
    rows = [(1, i, i, 2 + i, i % 3 > 0) for i in range(1, 900)]
    members = spark.createDataFrame(rows, "centre long, rep long, label long, n long, other boolean")
    tiles = [r.asDict() for r in minmax._tiles(members, 80).collect()]
    met, dealt = set(), {}
    for t in tiles:
        dealt.setdefault((t["grade"], t["i"], t["j"]), ([], []))[0 if t["left"] else 1].append(t["rep"])
    for left, right in dealt.values():
        met |= {(a, b) for a in left for b in right}
    size = {r[1]: r[3] for r in rows}
    wanted = {(a, b) for a in size if a % 3 for b in size if a != b and 100 * min(size[a], size[b]) >= 80 * max(size[a], size[b])}
    assert wanted <= met and len(met) < 0.6 * len(rows) * sum(r[4] for r in rows)


def test_hubs_are_joined_where_their_rows_are(spark):
    links = spark.range(5000).select(F.col("id").alias("a"), F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") - 1).alias("b"))
    labels = {r.node: r.label for r in component_labels(links).collect()}
    assert set(labels.values()) == {-1} and len(labels) == 5001
    keyed = links.groupBy("b").agg(F.count("*").alias("n"), F.min("a").alias("m"))
    joined = hub_join(links, keyed, "b", "n", 5000)
    assert joined.count() == 5000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_components_of_chains_and_rings(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000 + (i + 1) % 50) for i in range(50)] + [(2000, 2000), (3001, 3000)]
    rng.shuffle(pairs)
    labels = {r.node: r.label for r in component_labels(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert labels == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(50)}, 3000: 3000, 3001: 3000}
