"""Repeated passages against a count of all windows."""

import random
import re
from collections import Counter

import pytest

from ledgerloom.llm.phrases import without_repeats


def brute(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("window,phrase", [(35, 8), (10, 3)])
def test_against_all_windows(spark, window, phrase):
    rng = random.Random(window)
    word = lambda: rng.choice(["ab", "Cd", "é", "longer-word-of-text", "x"] + [f"w{i}" for i in range(40)])
    passages = [[word() for _ in range(n)] for n in (9, 10, 12, 34, 35, 36, 80)]
    texts = [None, "", " \n ", "é " * 50, "é " * 36 + "x", "a b c"]
    for _ in range(60):
        parts = [[word() for _ in range(rng.randrange(30))] + rng.choice(passages) for _ in range(rng.randrange(1, 4))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(w for p in parts for w in p))
    texts += texts[-2:] + [" ".join(word() for _ in range(3000))] * 2
    docs = spark.createDataFrame([(i, t, "kept", None) for i, t in enumerate(texts)], "doc_id long, text string, kept_ids string, block string")
    found = {r.doc_id: (r.n_words_, r.n_removed_, r.kept_) for r in without_repeats(docs.repartition(3), window, phrase).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts, window)


def test_columns_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b", 1.5, ["x"])], "doc_id long, text string, payload double, n array<string>")
    assert [tuple(r) for r in without_repeats(docs).collect()] == [(None, "a b", 1.5, ["x"], 2, 0, "a b")]
    assert without_repeats(docs.where("false")).count() == 0
