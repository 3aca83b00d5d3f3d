"""Tokens of texts, counted by pre-token in two tiers.

A byte-level tokenizer cuts a text into pre-tokens and encodes each by itself, so
a text has as many tokens as its pre-tokens have together. The lengths of frequent
pre-tokens are broadcast as a compact table; others are encoded where they occur
and remembered by the worker. No pre-token is ever shuffled: tasks summarise what
they see within a fixed size (Misra-Gries: counts are lowered together when there
are too many, so any pre-token with a share above one in ``SUMMARY`` stays), and
summaries are merged 64 at a time. What the table holds changes the speed only.

The file of the tokenizer is read at the driver and sent along.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from ledgerloom.llm.words import slices, widened
from ledgerloom.session import scratch_dir

TABLE = 1 << 16
SUMMARY = 1 << 14
CACHE = 1 << 17
FAN_IN = 64
#: Longer pre-tokens are neither tabled nor remembered.
LONGEST = 64
#: Longer texts are cut where a pre-token must begin, at a single space.
CUT = 1 << 20

# How byte-level tokenizers cut a text into pre-tokens.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Letters, digits and white space of other characters may differ between libraries
# and Unicode versions; texts that hold them are cut by the tokenizer's own splitter.
# Among these characters all digits are decimal, so the pattern can be written for ``re``.
_ELSEWHERE = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏЀ-џ‐-‧€]")
_SPLIT = re.compile(SPLIT.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d"))
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def _byte_characters() -> dict[int, int]:
    """The character by which byte-level models know each byte: itself if it shows, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


_AS_CHARACTERS = _byte_characters()


class PreTokens:
    """Pre-tokens of texts and the number of tokens in each, for one tokenizer file."""

    def __init__(self, definition: str):
        told = json.loads(definition)
        self.library = Tokenizer.from_str(definition)
        self.model = self.library.model
        cutter = told.get("pre_tokenizer") or {}
        plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        added = told.get("added_tokens") or []
        if not plain or told.get("normalizer") or any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
            raise ValueError("not a byte-level tokenizer whose pre-tokens are independent")
        names = sorted((x["content"] for x in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None

    def cut(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Pre-tokens of a text, part by part, each with the number of special strings beside it."""
        parts, special = [text], 0
        if self.special and (found := self.special.findall(text)):
            parts, special = self.special.split(text), len(found)
        for part in parts:
            begin = 0
            while begin < len(part):
                at = _SINGLE_SPACE.search(part, begin + CUT) if len(part) - begin > CUT else None
                end = at.start() if at else len(part)
                piece = part if end - begin == len(part) else part[begin:end]
                if _ELSEWHERE.search(piece):
                    yield [piece[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(piece)], 0
                else:
                    yield _SPLIT.findall(piece), 0
                begin = end
        if special:
            yield [], special

    def length(self, piece: str) -> int:
        """Tokens of one pre-token, by the model alone: its bytes as the model's characters."""
        return len(self.model.tokenize(piece.encode().decode("latin-1").translate(_AS_CHARACTERS)))


class Lengths(dict):
    """Tokens by pre-token: the table, what the worker remembers, and the tokenizer for the rest."""

    def __init__(self, pre: PreTokens, table: tuple[bytes, bytes, bytes], cache: int = CACHE):
        super().__init__(unpacked(table))
        self.pre, self.cache, self.most = pre, {}, cache

    def __missing__(self, piece: str) -> int:
        got = self.cache.get(piece)
        if got is None:
            got = self.pre.length(piece)
            if len(piece) <= LONGEST:
                if len(self.cache) >= self.most:
                    self.cache.clear()
                self.cache[piece] = got
        return got

    def count(self, text: str | None) -> int:
        """Tokens of a whole text (null: 0)."""
        return sum(sum(map(self.__getitem__, pieces)) + special for pieces, special in self.pre.cut(text or ""))


def packed(lengths: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """Pre-tokens in a row, the bytes of each, and the tokens of each."""
    held = [(k.encode(), n) for k, n in lengths.items() if n < 256 and len(k.encode()) < 256]
    return b"".join(k for k, _ in held), bytes(len(k) for k, _ in held), bytes(n for _, n in held)


def unpacked(table: tuple[bytes, bytes, bytes]) -> Iterator[tuple[str, int]]:
    pool, sizes, counts = table
    at = 0
    for size, n in zip(sizes, counts, strict=True):
        yield pool[at : at + size].decode(), n
        at += size


def reduced(counts: Counter, most: int) -> Counter:
    """The ``most`` largest counts, each less what the next one has (Misra-Gries)."""
    if len(counts) <= most:
        return counts
    ranked = counts.most_common(most + 1)
    floor = ranked[-1][1]
    return Counter({k: n - floor for k, n in ranked if n > floor})


def _kept(key: str, make):
    """Something that a worker process keeps from task to task (one at a time)."""
    store = sys.modules.setdefault("ledgerloom_worker_store", types.ModuleType("ledgerloom_worker_store"))
    if getattr(store, "key", None) != key:
        store.key, store.held = key, make()
    return store.held


SUMMARY_ROW = "pieces array<string>, counts array<long>"
_SUMMARY_SCHEMA = pa.schema([("pieces", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _summary(counts: Counter) -> dict:
    ranked = counts.most_common()
    return {"pieces": [k for k, _ in ranked], "counts": [n for _, n in ranked]}


def frequent(docs: DataFrame, definition: str, text_col: str = "text", size: int = TABLE, summary: int = SUMMARY) -> Counter:
    """The most frequent pre-tokens of all texts, ``size`` at most, with lower bounds of their counts.

    Words are counted first, and the frequent ones cut as they are after a space, so
    that one at the start of a line counts with the others.
    """
    spark = docs.sparkSession

    def seen(batches):
        words, counts, pre = Counter(), Counter(), PreTokens(definition)
        for batch in batches:
            for part in slices(batch, "text"):
                every = pc.ascii_split_whitespace(pc.fill_null(part.column("text"), "")).flatten()
                held = pc.value_counts(every)
                # What is too rare in a slice cannot add up to a frequent word.
                often = pc.greater_equal(held.field("counts"), len(every) // (8 * summary))
                held = held.filter(pc.and_(often, pc.less_equal(pc.utf8_length(held.field("values")), LONGEST)))
                words.update(dict(zip(held.field("values").to_pylist(), held.field("counts").to_pylist(), strict=True)))
                if len(words) > 8 * summary:
                    words = reduced(words, 4 * summary)
        for word, n in words.items():
            for pieces, _ in pre.cut(f" {word}"):
                for piece in pieces:
                    counts[piece] += n
        yield pa.RecordBatch.from_pylist([_summary(reduced(counts, summary))], _SUMMARY_SCHEMA)

    def added(rows: Iterable[dict], most: int) -> Counter:
        total = Counter()
        for row in rows:
            total.update(dict(zip(row["pieces"], row["counts"], strict=True)))
            if len(total) > 4 * most:
                total = reduced(total, 2 * most)
        return reduced(total, most)

    def merged(table):
        return pa.Table.from_pylist([_summary(added((table.slice(i, 1).to_pylist()[0] for i in range(table.num_rows)), size))], _SUMMARY_SCHEMA)

    def stored(df):
        where = scratch_dir(spark, "pretokens")
        df.write.parquet(where)
        return spark.read.parquet(where)

    summaries = stored(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(seen, SUMMARY_ROW))
    while (n := summaries.count()) > FAN_IN:
        groups = -(-n // FAN_IN)
        numbered = summaries.withColumn("group", F.monotonically_increasing_id() % groups)
        summaries = stored(numbered.groupBy("group").applyInArrow(lambda t: merged(t.select(["pieces", "counts"])), SUMMARY_ROW))
    return added((row.asDict() for row in summaries.toLocalIterator()), size)


def token_counts(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", size: int = TABLE) -> DataFrame:
    """``id_col``, ``n_bytes`` and ``n_tokens`` of every row, in whole texts.

    Tokens are those of the library for the file, without begin, end or other
    added tokens; special strings in a text are single tokens, as is its default.
    Null and empty texts have none; null ids and repeated rows are passed on;
    other columns are ignored; an empty table gives none. Long texts are read in
    parts of about a million characters, cut where a pre-token must begin.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    pre = PreTokens(definition)
    table = packed({piece: pre.length(piece) for piece in frequent(picked, definition, size=size)})
    key = hashlib.sha256(definition.encode() + b"".join(table)).hexdigest()
    sent = spark.sparkContext.broadcast((definition, table))

    def counted(batches):
        lengths = _kept(key, lambda: Lengths(PreTokens(sent.value[0]), sent.value[1]))
        for batch in batches:
            for part in slices(batch, "text"):
                n = pa.array([lengths.count(text) for text in part.column("text").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("n_bytes"), n], ["id", "n_bytes", "n_tokens"])

    sized = picked.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    out = sized.mapInArrow(counted, widened(picked.select("id").schema, "n_bytes long, n_tokens long"))
    return out.withColumnRenamed("id", id_col)
