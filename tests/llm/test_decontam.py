"""Template windows against a plain version on whole tables, and reworded items."""

import random
import re
from collections import Counter

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from ledgerloom.llm import decontam

ITEM = "A train leaves the old station near Boston and travels 60 miles in 2 hours, then Alice drives 60 miles more. How far did Alice travel in all on that day?"


def plain_tokens(text, anywhere):
    """(template, value) of each token of a text, by one of the two readings."""
    out, fresh, before, last, end = [], True, None, None, 0
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or ""):
        raw = word = m[0]
        if anywhere and last is not None:
            fresh = fresh or bool(re.match(r"[!-/:-@\[-`{-~]", last[-1]) and last[-1] != "%") or bool(re.search(r"[\r\n]", text[end : m.start()]))
        while len(word.encode()) > 1 and re.match(r"[!-$&-/:-@\[-`{-~]", word[0]):
            word = word[1:]
        while len(word.encode()) > 1 and re.match(r"[!-$&-/:-@\[-`{-~]", word[-1]):
            word = word[:-1]
        low = word.lower()
        kind = "word"
        if re.match("[0-9]", word):
            kind = "number"
        elif before == "number" and low in decontam.UNITS:
            kind = "unit"
        elif re.match("[A-ZÀ-ÖØ-Þ]", word) and (anywhere or not fresh) and len(word) > 1 and not re.match(".[A-ZÀ-ÖØ-Þ]", word):
            kind = "name"
        if not (kind == "name" and before == "name" and not fresh):
            out.append((low if kind == "word" else "<" + kind, low))
        before, fresh, last, end = kind, raw[-1] in ".!?:;", raw, m.end()
    return out


def plain(docs, items, size=8, percent=80):
    """Every window of every text against every window of every item, windows judged one by one."""

    def windows(text, width, anywhere):
        t = plain_tokens(text, anywhere)
        for i in range(len(t) - width + 1):
            w = t[i : i + width]
            literal = sum(not x.startswith("<") or x == v for x, v in w)
            key = tuple(x for x, _ in w) if literal >= min(4, width) else ("exact", *[v for _, v in w])
            yield i, key, tuple(v for x, v in w if x.startswith("<") and x != v)

    out = set()
    for anywhere in (False, True):
        index, length = {}, {}
        for item, text in items:
            length[item] = len(plain_tokens(text, anywhere))
            width = min(size, length[item])
            for i, key, slots in windows(text, width, anywhere) if width else ():
                index.setdefault((width, key), []).append((item, i, slots))
        for doc, text in docs:
            along = {}
            for width in {w for w, _ in index}:
                for at, key, slots in windows(text, width, anywhere):
                    for item, i, theirs in index.get((width, key), ()):
                        if len(slots) == len(theirs):
                            along.setdefault((item, at - i), set()).add((i, width, theirs, slots))
            covered = {}
            for (item, _), found in along.items():
                votes = {}
                for _, _, theirs, slots in found:
                    for a, b in set(zip(theirs, slots)):
                        votes.setdefault(a, Counter())[b] += 1
                for i, width, theirs, slots in found:
                    # What a value stands for in most windows; the driver's hashes only break ties.
                    if all(votes[a][b] == max(votes[a].values()) and (votes[a][a] < max(votes[a].values()) or a == b) for a, b in zip(theirs, slots)):
                        covered.setdefault(item, set()).update(range(i, i + width))
            out |= {(doc, i) for i, tokens in covered.items() if 100 * len(tokens) >= percent * length[i]}
    return out


def test_against_plain_version(spark):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontam.contaminated(docs, items).collect()
    expected = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert len(got) == len(expected) and {(r.doc_id, r.item_id) for r in got} == expected and expected


def test_reworded_and_inconsistent(spark):
    other = ITEM.replace("60", "75").replace("2 hours", "3 days").replace("Alice", "Bob").replace("Boston", "Oslo")
    mixed = ITEM.replace("near Boston and travels 60 miles", "near Boston and travels 75 miles").replace("did Alice", "did Carol")
    unlike = "A plane crosses the wide sea toward Boston and lands 60 miles off in 2 hours, while Alice reads 60 pages. Who did Alice meet in the end of it all?"
    docs = [(1, "Intro. " + ITEM + " Outro."), (2, other), (3, mixed), (4, unlike), (5, ITEM.lower()), (6, None), (7, ""), (None, ITEM), (8, (other + " ") * 3), (8, other)]
    docs = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, n_tokens int")
    items = spark.createDataFrame([(9, ITEM), (10, None), (11, ""), (None, ITEM), (12, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.reworded for r in decontam.contaminated(docs, items).collect()}
    assert got.pop((5, 9), None) in (None, False)
    shout = spark.createDataFrame([(1, "AND. " + ITEM.upper() + "!! ÉA")], "doc_id long, text string")
    assert decontam.contaminated(shout, items.withColumn("text", F.lower("text"))).count() == 1
    assert got == {(1, 9): False, (2, 9): True, (8, 9): True}
    assert decontam.contaminated(docs.where("false"), items).count() == 0
    assert decontam.contaminated(docs, items.where("false")).count() == 0


def test_one_altered_value_and_rows_of_one_id(spark):
    long = (
        "A farmer keeps 12 brown hens near the old mill and sells their eggs at the weekly market in town for a fair price, "
        "while a second farmer keeps 12 white geese beside the river and never sells any eggs at all to anybody who asks for them."
    )
    altered, twice = long.replace("12 white", "21 white"), long.replace("12 brown", "4 brown").replace("12 white", "7 white")
    other = ITEM.replace("60", "75").replace("2 hours", "3 hours").replace("Alice", "Bob")
    docs = [(1, altered), (2, twice), (3, ITEM), (3, other), (4, "A farmer keeps 12 brown hens near the old mill and sells none.")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(8, long), (9, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_tokens, r.n_covered, r.reworded) for r in decontam.contaminated(docs, items).collect()}
    # The second number is in eight windows, the first in four: those of the first, and four words, are left out.
    assert got == {(1, 8): (48, 44, True), (2, 8): (48, 44, True), (3, 9): (31, 31, True)}


def test_names_at_the_start_of_sentences(spark):
    tom = "Tom has 5 apples. Tom buys 3 more apples. Tom eats 2 apples. How many apples does Tom have?"
    short = "Trains pass the bridge near Boston every hour"
    heads = ["Heading\n", "- ", "7 ", "He said, ", 'He said "no." ', "so "]
    docs = [(0, tom.replace("Tom", "Ana")), (1, "Ann has 5 apples. Bea buys 3 more apples. Cid eats 2 apples. How many apples does Dan have?")]
    docs += [(10 + i, head + short) for i, head in enumerate(heads)] + [(20 + i, head + tom) for i, head in enumerate(heads)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(8, tom), (9, short)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.reworded for r in decontam.contaminated(docs, items).collect()}
    n = len(heads)
    assert got == {(0, 8): True} | {(10 + i, 9): False for i in range(n)} | {(20 + i, 8): False for i in range(n)}


WORDS = [f"w{i}" for i in range(400)]


def made(seed):
    """Items that share sentences, and documents that hold some of them altered in known ways."""
    rng = random.Random(seed)
    common = " ".join(rng.choice(WORDS) for _ in range(12))
    items = []
    for i in range(40):
        own = [rng.choice(WORDS) for _ in range(rng.randrange(6, 40))]
        own[2:2] = [str(rng.randrange(100)), "miles", "and", rng.choice(["Alice", "Bob", "Eve"])]
        items.append((i, rng.choice([f"{common} ", ""]) + " ".join(own)))
    items += [(100, items[0][1]), (101, items[1][1]), (102, common)]
    docs = []
    for d in range(150):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            held = rng.choice(items)[1]
            kind = rng.randrange(5)
            if kind == 1:
                held = re.sub(r"\b\d+\b", lambda m: str(int(m[0]) + 7), held).replace("Alice", "Carol")
            elif kind == 2:
                held = held.split()
                held[rng.randrange(len(held))] = "changed"
                held = " ".join(held)
            elif kind == 3:
                held = held[: rng.randrange(len(held))]
            elif kind == 4:
                held = common
            words[rng.randrange(len(words) + 1) :][:0] = held.split()
            words = words + held.split()
        docs.append((d, " ".join(words)))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_shared_sentences_and_edits_against_plain_version(spark, seed):
    docs, items = made(seed)
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain(docs, items)
    assert len({r.item_id for r in got}) > 20 and any(r.reworded for r in got)


def test_a_sentence_of_all_items_makes_no_pairs(spark):
    """300 items and 300 documents share a sentence: candidates are those whose own words match."""
    rng = random.Random(1)
    common = "answer the multiple choice question below with one letter of the four that are given"
    own = [" ".join(rng.choice(WORDS) for _ in range(14)) for _ in range(300)]
    items = spark.createDataFrame([(i, f"{common} {x}") for i, x in enumerate(own)], "item_id long, text string")
    keyed = items.withColumn("item", F.col("item_id").cast("string"))
    cut = decontam._items(keyed, 8, "item", "text")
    anchors = decontam._anchors(cut, 80)
    held = anchors.groupBy("hash", "size", "anywhere").agg(F.count_distinct("item_id").alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 2 and anchors.select("item_id").distinct().count() == 300
    docs = [(i, f"{common} {'x ' * 30}") for i in range(300)] + [(1000 + i, f"so {common} {own[i]}") for i in range(20)]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1000 + i, i) for i in range(20)}


def test_items_of_equal_text_are_all_named(spark):
    items = spark.createDataFrame([(i, ITEM) for i in range(50)] + [(50, ITEM + " More words stand here than in the other one")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so " + ITEM)], "doc_id long, text string")
    got = decontam.contaminated(docs, items).collect()
    assert sorted(r.item_id for r in got) == list(range(50))
