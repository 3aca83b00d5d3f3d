"""The manifest against a plain tree, in blocks of few leaves so that several levels are used."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Root, and for each leaf its siblings by level (None: goes up alone), with the side."""
    level, at, ways = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for way, i in zip(ways, at, strict=True):
            beside = i ^ 1
            way.append((level[beside], i & 1) if beside < len(level) else None)
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], ways


def folded(leaf, way):
    for step in way:
        leaf = h(leaf) if step is None else h(step[0], leaf) if step[1] else h(leaf, step[0])
    return leaf


@pytest.mark.parametrize("n", [*range(1, 34), 63, 64, 65])
@pytest.mark.parametrize("height", [None, 7])
def test_appends_make_the_tree(n, height):
    leaves = [h(str(i)) for i in range(n)]
    tree = merkle.Appended()
    for leaf in leaves:
        tree.append(leaf.encode())
    root = tree.close(height).decode()
    expected, ways = plain_tree(leaves)
    for _ in range((height or 0) - len(ways[0])):
        expected, ways = h(expected), [[*w, None] for w in ways]
    assert root == expected
    assert [[w.decode() for w in x] for x in tree.witness] == [["" if s is None else s[0] for s in w] for w in ways]


def test_open_subtrees_hold_partial_witnesses():
    tree = merkle.Appended()
    for i in range(6):
        tree.append(h(str(i)).encode())
    assert [x[0] for x in tree.open] == [2, 1]
    assert [len(w) for w in tree.witness] == [2, 2, 2, 2, 1, 1]


def plain(rows):
    """rows: run, key, leaf, shown leaf."""
    runs = {}
    for run in sorted({r[0] for r in rows}, key=lambda x: (x is not None, (x or "").encode())):
        mine = sorted((r for r in rows if r[0] == run), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        runs[run] = (mine, *plain_tree([r[2] for r in mine]))
    root, tops = plain_tree([t[1] for t in runs.values()])
    out = []
    for (mine, subroot, ways), top in zip(runs.values(), tops, strict=True):
        for (_, key, leaf, shown), way in zip(mine, ways, strict=True):
            whole = [*way, *top]
            proof = h(*[s[0] for s in whole if s is not None])
            now = folded(folded(shown, way), top)
            out.append((key, leaf, subroot, root, proof, now, now == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [1, 2, 5])
def test_as_plain(spark, height):
    random.seed(height)
    rows = [("de", i) for i in random.sample(range(500), 70)] + [("é", 1)] + [("a", i) for i in range(17)] + [(None, i) for i in range(3)] + [("", 5), ("a", None), ("a", None), ("a", 3)]
    rows += [(f"l{i}", i) for i in range(9)]
    random.shuffle(rows)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "lang string, doc_id long, digest string").repartition(6)
    leaf = merkle.leaf_digest(F.col("doc_id"), F.col("lang"))
    shown = merkle.leaf_digest(F.when(F.col("doc_id") % 7 == 0, F.col("doc_id") + 1).otherwise(F.col("doc_id")), F.col("lang"))
    got = merkle.manifest(docs, F.col("lang"), ["doc_id"], leaf, shown, height=height)

    def enc(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    told = [(r, i, h(enc(i) + enc(r)), h(enc(i + 1 if i is not None and i % 7 == 0 else i) + enc(r))) for r, i in rows]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(told)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([("de", 1)], "lang string, doc_id long")
    leaf = merkle.leaf_digest(F.col("doc_id"))
    row = merkle.manifest(docs, F.col("lang"), ["doc_id"], leaf, leaf).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == h("1:1") and row.proof_sha256 == h("") and row.verified
    assert merkle.manifest(docs.limit(0), F.col("lang"), ["doc_id"], leaf, leaf).count() == 0


def test_numbers_of_a_hot_run(spark):
    """One run of nearly all rows lies in many partitions and is numbered without gaps."""
    rows = spark.range(3000).select(F.when(F.col("id") < 2900, "hot").otherwise(F.col("id").cast("string")).alias("run"), ((F.col("id") * 7919) % 3001).alias("key"))
    got = merkle.numbered(rows, "run", ["key"], "t")
    hot = got.where("run = 'hot'").orderBy("key").collect()
    assert [r.place for r in hot] == list(range(2900)) and {r.size for r in hot} == {2900}
