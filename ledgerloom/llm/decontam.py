"""Benchmark decontamination by template canonicalisation.

Words become tokens: numbers, names and units are typed placeholders, other
words are lower-cased and lose outer punctuation. Windows of tokens are matched
by hash between documents and benchmark items. Windows that lie along one
alignment of document and item count if their slots are consistent: each value
of the item's slots stands for one value in the document, the one it stands for
in most windows. So an item with other numbers, names or units is found as well
as a copy, a value that was altered in one place costs only the windows that
hold it, and two texts that merely have the same shape are not found if
shuffled values leave too little.

Capitals at the start of a sentence tell no names, and what starts a sentence
hangs on what stands before a text. So all texts are read twice: with names
within sentences only, and with each capitalised word as a name.

Documents are only read once: a bitmap of fixed size with the hashes of all
benchmark windows lets through the windows that can match. Items share sentences
("answer the multiple choice question"), and a document that holds such a sentence
is no candidate for all of them: an item's rarest windows, without which too little
of it is left, name the candidates, and only for these are all windows matched.
Items of equal text are one item until the end.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.words import Words, slices, split_words, widened, window_hashes, word_hashes
from ledgerloom.session import scratch_dir

WINDOW = 8
#: A template window with fewer literal words is matched with its values.
LITERALS = 4
BITMAP_BITS = 23
NUMBER, NAME, UNIT = (np.uint64(x) for x in (1, 2, 3))

# Units, as they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams lb lbs oz pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years % percent degree degrees celsius fahrenheit dollar dollars euro euros cent cents usd eur "
    "kb mb gb tb hz khz mhz ghz w kw v a mph kmh"
).split()

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "%"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;"]] = True


def _unit_hashes() -> np.ndarray:
    return np.sort(word_hashes(split_words(pa.array([" ".join(UNITS)]))))


def _trimmed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words without outer punctuation (one character stays)."""
    start, end = words.start.copy(), words.end.copy()
    rows = np.arange(len(start))
    while len(rows := rows[(end[rows] - start[rows] > 1) & _PUNCTUATION[words.data[start[rows]]]]):
        start[rows] += 1
    rows = np.arange(len(start))
    while len(rows := rows[(end[rows] - start[rows] > 1) & _PUNCTUATION[words.data[end[rows] - 1]]]):
        end[rows] -= 1
    return start, end


def _capital(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a capital of Latin-1 stands at these bytes."""
    first, then = data[at], data[at + 1]
    return ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (then >= 0x80) & (then <= 0x9E) & (then != 0x97))


def canonical(column, anywhere: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of texts: template hash, value hash, literal flag, and where each text begins.

    A token that starts with a digit is a number, a unit word after a number a
    unit, a capitalised word within a sentence, or ``anywhere``, a name (neighbouring
    names are one token, if punctuation or a line break parts them only without
    ``anywhere``; words in capitals are literal).
    """
    words, low = split_words(column), split_words(pc.utf8_lower(column))
    data, (start, end) = words.data, _trimmed(words)
    # Lower-casing adds and removes no white space, so words keep their numbers.
    value = word_hashes(Words(low.data, *_trimmed(low), low.first))
    n = len(start)
    number = (data[start] >= 48) & (data[start] <= 57)
    fresh = np.zeros(n, bool)
    fresh[words.first[:-1][words.first[:-1] < n]] = True
    fresh[1:] |= _STOP[data[words.end[:-1] - 1]]
    second = start + np.where(data[start] == 0xC3, 2, 1)
    name = _capital(data, start) & (end > second) & ~_capital(data, second)
    if anywhere:
        lines = np.concatenate([[0], np.cumsum((data == 10) | (data == 13))])
        fresh[1:] |= _PUNCTUATION[data[words.end[:-1] - 1]] | (lines[words.start[1:]] > lines[words.end[:-1]])
    else:
        name &= ~fresh
    unit = np.zeros(n, bool)
    unit[1:] = number[:-1] & np.isin(value[1:], _unit_hashes())
    unit[words.first[:-1][words.first[:-1] < n]] = False
    template = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
    keep = np.ones(n, bool)
    keep[1:] = ~(name[1:] & name[:-1] & ~fresh[1:])
    text = words.text_of()[keep]
    cuts = np.searchsorted(text, np.arange(len(words.first)))
    return template[keep], value[keep], ~(number | name | unit)[keep], cuts


def windows(column, size: int, anywhere: bool = False):
    """Windows of ``size`` tokens inside one text: hash, place in its text, text, and the tokens."""
    template, value, literal, cuts = canonical(column, anywhere)
    n = len(template)
    if n < size:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, (template, value, literal, cuts)
    h, exact = window_hashes(template, size), window_hashes(value, size)
    total = np.concatenate([[0], np.cumsum(literal)])
    plain = total[size:] - total[:-size] >= min(LITERALS, size)
    h = np.where(plain, h, exact ^ np.uint64(size))
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    at = np.flatnonzero(text[: n - size + 1] == text[size - 1 :])
    return h[at], at - cuts[text[at]], text[at], (template, value, literal, cuts)


def _slots(tokens, at: np.ndarray, size: int) -> pa.ListArray:
    """Values in the placeholders of each window that begins at token ``at``."""
    _, value, literal, _ = tokens
    where = at[:, None] + np.arange(size)
    slot = ~literal[where]
    count = slot.sum(axis=1)
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(count)]).astype(np.int32), pa.array(value[where][slot].view(np.int64)))


def _items(benchmark: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Windows of benchmark items; an item shorter than a window is one window of its length."""
    picked = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    schema = widened(picked.select("item_id").schema, "anywhere boolean, n_tokens int, size int, item_at int, hash long, item_slots array<bigint>")

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                for anywhere in (False, True):
                    length = np.diff(canonical(part.column(1), anywhere)[3])
                    for width in np.unique(np.minimum(length[length > 0], size)):
                        rows = np.flatnonzero(length >= size if width == size else length == width)
                        texts = part.column(1).take(pa.array(rows))
                        h, at, text, tokens = windows(texts, int(width), anywhere)
                        n = len(h)
                        columns = [
                            part.column(0).take(pa.array(rows[text])),
                            pa.array(np.full(n, anywhere)),
                            pa.array(length[rows[text]], pa.int32()),
                            pa.array(np.full(n, width), pa.int32()),
                            pa.array(at, pa.int32()),
                            pa.array(h.view(np.int64)),
                            _slots(tokens, at + tokens[3][text], int(width)),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return picked.mapInArrow(cut, schema)


def _anchors(items: DataFrame, percent: int) -> DataFrame:
    """The windows of each item and reading that name its candidates.

    Windows are ranked by the number of items that hold them. The common ones at the
    end stay out as long as they cover less than ``percent`` of the item's tokens
    together: who matches no other window does not hold the item.
    """
    held = items.groupBy("hash", "size", "anywhere").agg(F.count_distinct("item_id").alias("items"))
    ranked = items.select("hash", "size", "anywhere", "item_id", "n_tokens", "item_at").join(held, ["hash", "size", "anywhere"])

    def choose(table):
        """Windows of one item and reading."""
        rows = table.sort_by([("items", "ascending"), ("item_at", "ascending")]).to_pylist()
        left: set[int] = set()
        keep = 0
        for i in range(len(rows) - 1, -1, -1):
            left |= set(range(rows[i]["item_at"], rows[i]["item_at"] + rows[i]["size"]))
            if 100 * len(left) >= percent * rows[i]["n_tokens"]:
                keep = i + 1
                break
        return pa.Table.from_pylist([{c: r[c] for c in anchor.names} for r in rows[:keep]], table.select(anchor.names).schema)

    anchor = items.select("hash", "size", "anywhere", "item_id").schema
    return ranked.groupBy("item_id", "anywhere").applyInArrow(choose, anchor)


def hash_bitmap(items: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """One bit per value of ``hash`` modulo the bitmap's size; at most 2 ** (bits - 6) rows reach the driver."""
    bit = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    one = F.expr("shiftleft(1L, cast(hash & 63 as int))")
    rows = items.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toPandas()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows["word"]] = rows["bits"]
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)


def consistent(windows: list[dict]) -> list[dict]:
    """Windows of an alignment (``item``, ``doc``: values of their slots) in which
    each value stands for what it stands for in most windows (of several, for
    itself, else the least)."""
    votes: dict[int, Counter] = {}
    for w in windows:
        for i, d in set(zip(w["item"], w["doc"], strict=True)):
            votes.setdefault(i, Counter())[d] += 1
    stands = {i: min(c, key=lambda d: (-c[d], d != i, d)) for i, c in votes.items()}
    return [w for w in windows if all(stands[i] == d for i, d in zip(w["item"], w["doc"], strict=True))]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of document and benchmark item where the document holds the item.

    Returns ``doc_id``, ``item_id``, ``n_tokens`` of the item, ``n_covered`` (tokens
    of the item in matched windows) and ``reworded`` (some slot has another value
    in the document), for pairs with 100 * covered >= ``percent`` * tokens. A
    document that holds an item several times, or repeated rows, give one row;
    rows of one id are aligned each for itself, and what they cover is put together.
    Null and empty texts hold nothing, items without words are in nothing; rows
    with a null id are left out; an item id with several texts is held with any of them. Other columns are ignored; empty tables give none.
    """
    spark = docs.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        where = scratch_dir(spark, name)
        df.write.parquet(where)
        return spark.read.parquet(where)

    named = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    named = named.where("item_id IS NOT NULL AND text IS NOT NULL").withColumn("item", F.md5(F.col("text").cast("binary")))
    alike = stored(named.select("item", "item_id").distinct(), "alike")
    items = stored(_items(named.groupBy("item").agg(F.any_value("text").alias("text")), size, "item", "text"), "items")
    held = spark.sparkContext.broadcast(hash_bitmap(items))
    readings = [tuple(r) for r in items.select("size", "anywhere").distinct().collect()]
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL")
    # Rows of an id are told apart by their text.
    picked = picked.withColumn("row", F.xxhash64("text"))
    schema = widened(picked.select("id", "row").schema, "anywhere boolean, size int, doc_at int, hash long, doc_slots array<bigint>")

    def find(batches):
        for batch in batches:
            for part in slices(batch, "text", limit=2 << 20):
                for width, anywhere in readings:
                    h, at, text, tokens = windows(part.column(1), width, anywhere)
                    hit = np.flatnonzero(held.value[h & np.uint64((1 << BITMAP_BITS) - 1)])
                    if len(hit):
                        h, at, text = h[hit], at[hit], text[hit]
                        columns = [
                            part.column("id").take(pa.array(text)),
                            part.column("row").take(pa.array(text)),
                            pa.array(np.full(len(h), anywhere)),
                            pa.array(np.full(len(h), width), pa.int32()),
                            pa.array(at, pa.int32()),
                            pa.array(h.view(np.int64)),
                            _slots(tokens, at + tokens[3][text], width),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    found = stored(picked.mapInArrow(find, schema), "found")
    keys = ["hash", "size", "anywhere"]
    asked = found.select("id", *keys).join(_anchors(items, percent), keys).select("id", "anywhere", "size", "item_id").distinct()
    hits = found.join(asked, ["id", "anywhere", "size"]).join(items, [*keys, "item_id"])
    hits = hits.where(F.size("doc_slots") == F.size("item_slots"))
    along = hits.groupBy("id", "row", "item_id", "anywhere", "n_tokens", "size", (F.col("doc_at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set(F.struct(F.col("item_at").alias("at"), F.col("item_slots").alias("item"), F.col("doc_slots").alias("doc"))).alias("windows")
    )
    kinds = along.select("id", "item_id", "anywhere", "n_tokens").schema

    def judge(batches):
        for batch in batches:
            held, changed, tokens = [], [], []
            for i, (size_, found) in enumerate(zip(batch.column("size").to_pylist(), batch.column("windows").to_pylist(), strict=True)):
                if left := consistent(found):
                    held.append(i)
                    changed.append(any(w["item"] != w["doc"] for w in left))
                    tokens.append(sorted({w["at"] + k for w in left for k in range(size_)}))
            at = pa.array(held, pa.int64())
            columns = [*(batch.column(c).take(at) for c in kinds.names), pa.array(changed, pa.bool_()), pa.array(tokens, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*kinds.names, "changed", "tokens"])

    pairs = along.select(*kinds.names, "size", "windows").mapInArrow(judge, widened(kinds, "changed boolean, tokens array<int>"))
    covered = F.size(F.array_distinct(F.flatten(F.collect_set("tokens"))))
    out = pairs.groupBy("id", "item_id", "anywhere", "n_tokens").agg(covered.alias("n_covered"), F.max("changed").alias("reworded"))
    # Of both readings that which covers more counts.
    order = [(F.col("n_covered") / F.col("n_tokens")).alias("share"), (~F.col("anywhere")).alias("within")]
    best = F.max(F.struct(*order, "n_tokens", "n_covered", "reworded")).alias("best")
    out = out.where(100 * F.col("n_covered") >= percent * F.col("n_tokens"))
    out = out.withColumnRenamed("item_id", "item").join(alike, "item").groupBy("id", "item_id").agg(best)
    return out.select(
        F.col("id").alias(id_col),
        F.col("item_id").alias(item_col),
        F.col("best.n_tokens").cast("long").alias("n_tokens"),
        F.col("best.n_covered").cast("long").alias("n_covered"),
        F.col("best.reworded").alias("reworded"),
    )
