"""Counts against the tokenizer's library itself."""

import sys

import pytest
from conftest import SF_DIR
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from ledgerloom.llm import token_counts  # noqa: E402
from ledgerloom.llm.queries import QUERIES, TOKENIZER  # noqa: E402

FILE = public_tokenizers.path(TOKENIZER)
with open(FILE, encoding="utf-8") as f:
    DEFINITION = f.read()
LIBRARY = Tokenizer.from_str(DEFINITION)
PRE = token_counts.PreTokens(DEFINITION)
LENGTHS = token_counts.Lengths(PRE, token_counts.packed({" the": 1, " und": PRE.length(" und")}))


def by_library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op13_token_counts"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        k: (len((t or "").encode()), by_library(t), by_library(t) > 512) for k, t in texts.items()
    }


PARTS = st.sampled_from([*"ab1²½_ .'s\n\t\r", "<|endoftext|>", "<|endof", "　", " ", "\x1c", "\x1f", "\x85", "é", "ß", "中", "😀", "ก", "'ll", "́", "ǅ", "٣", "​", "  "])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=40).map("".join) | st.text(max_size=60))
def test_any_text(text):
    assert LENGTHS.count(text) == by_library(text)


def test_every_character_is_cut_as_the_library_does():
    """Where the fast pattern is used, every character has the class that the tokenizer gives it."""
    wrong = []
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or token_counts._ELSEWHERE.search(c):
            continue
        text = f"a{c}a 1{c}1 .{c}. {c} {c}{c}"
        if [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)] != token_counts._SPLIT.findall(text):
            wrong.append(hex(code))
    assert not wrong


@pytest.mark.parametrize("cut", [1, 7, 64])
def test_long_texts_are_cut_where_a_pre_token_begins(monkeypatch, cut):
    monkeypatch.setattr(token_counts, "CUT", cut)
    for text in ("one two  three\n four 5 six   ", "x" * 500, " " * 300 + "a b", "a b\n c'll d 日本 e", "中 文 " * 50):
        assert LENGTHS.count(text) == by_library(text)


def test_cache_is_bounded():
    lengths = token_counts.Lengths(PRE, token_counts.packed({}), cache=10)
    text = " ".join(f"zq{i}x" for i in range(500)) + " " + "q" * 1000
    assert lengths.count(text) == by_library(text) and len(lengths.cache) <= 10


def test_odd_rows_and_merged_summaries(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "FAN_IN", 2)
    rows = [(1, "a b"), (1, "a b"), (None, "x"), (2, None), (3, ""), (4, "<|endoftext|>")] * 3
    docs = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id int, text string, n_tokens int, id string").repartition(9)
    got = sorted((tuple(r) for r in token_counts.token_counts(docs, FILE).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), by_library(t)) for i, t in rows), key=repr)
    more = docs.select("text").union(docs.select(F.lit("a a a a\nb")))
    common = token_counts.frequent(more, DEFINITION, size=2)
    assert set(common) <= {" a", " b", " x", " "} and " a" in common
    assert token_counts.token_counts(docs.limit(0), FILE).count() == 0


def test_frequent_pre_tokens_stay_within_bounds():
    counts = token_counts.Counter({f"w{i}": 1 for i in range(1000)} | {"the": 500, "of": 400})
    left = token_counts.reduced(counts, 5)
    assert left["the"] == 499 and left["of"] == 399 and len(left) <= 5


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError, match="independent"):
        token_counts.PreTokens(f.read())
