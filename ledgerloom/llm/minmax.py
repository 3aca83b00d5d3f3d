"""Near-duplicates by min-max hashing.

A document is its set of word shingles. Under each of a number of random
permutations both the least and the greatest value of the set are kept: either
agrees between two sets with the probability of their Jaccard similarity, so
half as many permutations give a signature of the same length. Values are
grouped into bands, as many as the wanted similarity needs; sets that agree on a
whole band are candidates, and a candidate is a link only if the full sets are
similar enough.

Equal sets are one class from the start. In a band's bucket each class is
compared with the bucket's least one, its centre, which connects groups of copies with one
comparison per member. Two classes of a bucket have the same centre, so what is
left are pairs of members of one centre that are still in different components.
Sets that are alike differ little in size, so a centre's members are parted by
size classes of that ratio, and only neighbouring classes meet. Members outside
the centre's component are dealt into tiles, all members into others, and a tile
meets a tile: pairs are compared by their full sets in arrays, and only links
come out.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.components import component_labels, hub_join
from ledgerloom.llm.words import joined, mixed, slices, split_words, widened, window_hashes, word_hashes
from ledgerloom.session import scratch_dir


class Banding(NamedTuple):
    """``bands`` bands of ``rows`` values, two values per permutation."""

    bands: int
    rows: int

    def found(self, similarity: float) -> float:
        """Probability that two sets of this similarity meet in a band."""
        return 1 - (1 - similarity**self.rows) ** self.bands


#: The chance that a link of just the wanted similarity has no common band.
MISSED = 5e-8
#: Values of a signature, at most.
SIGNATURE = 256
#: Members of a tile; one with many shingles counts as several.
TILE = 128
TILE_SHINGLES = 4096


def banding_for(percent: int) -> Banding:
    """The bands that find links of this similarity: the widest whose signature is not too long.

    For 80 these are 43 bands of 5: links meet with probability 1 - 4e-8, sets of
    similarity 0.3 with 0.10. Low similarities need narrow bands, in which most pairs meet.
    """
    found = [Banding(1, 1)]
    for rows in range(1, 33):
        agree = (percent / 100) ** rows
        bands = 1 if agree >= 1 else math.ceil(math.log(MISSED) / math.log1p(-agree))
        found += [Banding(bands, rows)] if bands * rows <= SIGNATURE else []
    if found[-1].found(percent / 100) < 1 - 2 * MISSED:
        raise ValueError(f"a similarity of {percent} % is too low to be found by bands")
    return found[-1]


def shingles(column, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text and where each text's begin.

    A text with fewer words is one shingle, one without words has none. A to Z
    are lower-cased.
    """
    words = split_words(column, lower=True)
    h = word_hashes(words)
    wide = window_hashes(h, size)
    first = words.first
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    cuts = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(count)), n)
    place = np.arange(cuts[-1]) - cuts[text] + first[text]
    values = np.empty(len(place), np.uint64)
    full = count[text] >= size
    values[full] = wide[place[full]]
    for at in np.flatnonzero(~full):
        values[at] = window_hashes(h[place[at] : place[at] + count[text[at]]], int(count[text[at]]))[0] ^ np.uint64(1)
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[keep], text[keep]
    return values, np.searchsorted(text, np.arange(len(count) + 1))


def signatures(values: np.ndarray, cuts: np.ndarray, banding: Banding) -> np.ndarray:
    """Band keys of each non-empty text, one row per text (empty texts: zeros)."""
    n = len(cuts) - 1
    filled = np.flatnonzero(np.diff(cuts))
    need = banding.bands * banding.rows
    signs = np.zeros((len(filled), need), np.uint64)
    seeds = mixed(np.arange(1, (need + 1) // 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = cuts[:-1][filled]
    for p, seed in enumerate(seeds if len(filled) else ()):
        under = (values ^ seed) * np.uint64(0x9E3779B97F4A7C15)
        under ^= under >> np.uint64(32)
        under *= np.uint64(0xD6E8FEB86659FD93)
        signs[:, 2 * p] = np.minimum.reduceat(under, first)
        if 2 * p + 1 < need:
            signs[:, 2 * p + 1] = np.maximum.reduceat(under, first)
    # A band takes values half a signature apart, so it never holds both ends of one permutation.
    order = np.arange(need).reshape(banding.rows, banding.bands).T
    keys = np.zeros((n, banding.bands), np.uint64)
    for r in range(banding.rows):
        keys[filled] = joined(keys[filled], signs[:, order[:, r]])
    keys[filled] = mixed(keys[filled] + np.arange(banding.bands, dtype=np.uint64))
    return keys


def set_classes(docs: DataFrame, size: int, banding: Banding, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``id``, ``n`` (set size), ``s1`` and ``s2`` (together the identity of
    the set) and ``bands``."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def sign(batches):
        for batch in batches:
            for part in slices(batch, "text", limit=2 << 20):
                values, cuts = shingles(part.column(1), size)
                keys = signatures(values, cuts, banding).view(np.int64)
                n = np.diff(cuts)
                sums = []
                for seed in (1, 2):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values + np.uint64(seed)), dtype=np.uint64)])
                    sums.append((total[cuts[1:]] - total[cuts[:-1]]).view(np.int64))
                bands = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, banding.bands, dtype=np.int32), pa.array(keys.reshape(-1)))
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]), bands]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "s1", "s2", "bands"])

    schema = widened(picked.select("id").schema, "n long, s1 long, s2 long, bands array<bigint>")
    return picked.mapInArrow(sign, schema)


def _compatible(a: str, b: str, percent: int):
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets satisfy 100 * shared >= percent * union."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def compare(batches):
        for batch in batches:
            for part in slices(batch, "text_a", "text_b", limit=2 << 20):
                one, cut1 = shingles(part.column(2), size)
                two, cut2 = shingles(part.column(3), size)
                n = part.num_rows
                pair = np.concatenate([np.repeat(np.arange(n), np.diff(cut1)), np.repeat(np.arange(n), np.diff(cut2))])
                values = np.concatenate([one, two])
                order = np.lexsort((values, pair))
                values, pair = values[order], pair[order]
                equal = (values[1:] == values[:-1]) & (pair[1:] == pair[:-1])
                shared = np.bincount(pair[1:][equal], minlength=n)
                union = np.diff(cut1) + np.diff(cut2) - shared
                good = np.flatnonzero((100 * shared >= percent * union) & (shared > 0))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(good)), part.column(1).take(pa.array(good))], ["a", "b"])

    return both.mapInArrow(compare, both.select("a", "b").schema).distinct()


def _tiles(members: DataFrame, percent: int) -> DataFrame:
    """Members of a centre dealt to the tiles in which they are compared: ``centre``, ``grade``,
    ``i``, ``j``, ``left``, ``rep``, ``label``.

    ``members`` has ``centre``, ``rep``, ``label``, ``n`` (set size) and ``other`` (not in
    the centre's component). Rows of tiles are others of one size class (``grade``),
    columns are members of this class and its neighbours.
    """
    # A little wider than the ratio, so that rounding never parts sets by two classes.
    grade = F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / percent) * (1 + 1e-9))).cast("int") if percent < 100 else F.col("n").cast("int")
    graded = members.withColumns({"grade": grade, "weight": 1 + F.floor(F.col("n") / TILE_SHINGLES)})
    left = graded.where("other")
    right = graded.withColumn("grade", F.explode(F.array(*[F.col("grade") + d for d in ((-1, 0, 1) if percent < 100 else (0,))])))
    tiles = F.ceil(F.sum("weight") / TILE).cast("int")
    rows = left.groupBy("centre", "grade").agg(tiles.alias("rows"), F.count("*").alias("n_left"))
    columns = right.groupBy("centre", "grade").agg(tiles.alias("columns"), F.count("*").alias("n_right"))
    counts = rows.join(columns, ["centre", "grade"]).where("n_right > 1")
    key = F.struct("centre", "grade")
    counts = counts.select(key.alias("at"), "rows", "columns", (F.col("n_left") + F.col("n_right")).alias("members"))
    where = scratch_dir(members.sparkSession, "tiles")
    counts.write.parquet(where)
    counts = members.sparkSession.read.parquet(where)
    total = counts.agg(F.sum("members")).first()[0] or 0
    tile = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    known = lambda side: hub_join(side.withColumn("at", key).select("at", "rep", "label"), counts, "at", "members", total)
    dealt = known(left).select("at", tile("rows").alias("i"), each("columns").alias("j"), F.lit(True).alias("left"), "rep", "label")
    others = known(right).select("at", each("rows").alias("i"), tile("columns").alias("j"), F.lit(False).alias("left"), "rep", "label")
    return dealt.union(others).select("at.centre", "at.grade", "i", "j", "left", "rep", "label")


def _across(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between members of one centre that are in different components (``_tiles``)."""
    dealt = _tiles(members, percent).join(texts.withColumnRenamed("id", "rep"), "rep")

    def compare(table):
        reps, labels = table["rep"].combine_chunks(), table["label"].to_numpy()
        values, cuts = shingles(table["text"], size)
        n = np.diff(cuts)
        kinds, place = np.unique(values, return_inverse=True)
        one = table["left"].to_numpy().astype(bool) & (n > 0)
        many = np.flatnonzero(~table["left"].to_numpy().astype(bool) & (n > 0))
        theirs = np.concatenate([place[cuts[r] : cuts[r + 1]] for r in many]) if len(many) else place[:0]
        begin = np.cumsum(n[many]) - n[many]
        root = {x: x for x in labels.tolist()}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        found = []
        for left in np.flatnonzero(one) if len(many) else ():
            mark = np.zeros(len(kinds), np.int64)
            mark[place[cuts[left] : cuts[left + 1]]] = 1
            shared = np.add.reduceat(mark[theirs], begin)
            for right in many[100 * shared >= percent * (n[left] + n[many] - shared)].tolist():
                a, b = top(labels[left]), top(labels[right])
                if a != b:
                    root[a] = b
                    found.append((left, right))
        rows = np.array(found, np.int64).reshape(-1, 2)
        return pa.table([reps.take(pa.array(rows[:, 0])), reps.take(pa.array(rows[:, 1]))], names=["a", "b"])

    pair = members.select(F.col("rep").alias("a"), F.col("rep").alias("b")).schema
    return dealt.groupBy("centre", "grade", "i", "j").applyInArrow(compare, pair).distinct()


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    banding: Banding | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if their sets of ``size``-word shingles (of whole texts,
    A to Z lower-cased) satisfy 100 * shared >= ``percent`` * union;
    ``component_id`` is the least id reachable, ``kept`` marks the document with
    that id. Null and empty texts are linked with nothing. Repeated ids are one
    document with several texts: they share a component, and all rows of a kept
    id are kept. A row with a null id takes part in no link, is its own
    component (null) and is kept. Other columns are ignored; an empty table
    gives none. Candidates meet with the probability ``banding.found``, by default
    that of ``banding_for(percent)``; links are confirmed on full sets.
    """
    spark = docs.sparkSession
    banding = banding_for(percent) if banding is None else banding

    def stored(df: DataFrame, name: str) -> DataFrame:
        where = scratch_dir(spark, name)
        df.write.parquet(where)
        return spark.read.parquet(where)

    signed = stored(set_classes(docs, size, banding, id_col, text_col), "sets")
    named = signed.where("id IS NOT NULL AND n > 0")
    classes = named.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.any_value("bands").alias("bands"))
    keyed = classes.select("rep", "n", F.explode("bands").alias("key"))
    least = F.min(F.struct("rep", F.col("n").alias("centre_n"))).alias("least")
    centre = keyed.groupBy("key").agg(least, F.count("*").alias("many")).where("many > 1").select("key", F.col("least.rep").alias("centre"), "least.centre_n")
    star = keyed.join(centre, "key").where("rep <> centre").select("centre", "centre_n", "rep", "n").distinct()
    star = stored(star, "candidates")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL")
    pairs = star.where(_compatible("n", "centre_n", percent)).select(F.col("centre").alias("a"), F.col("rep").alias("b"))
    links = stored(_confirmed(pairs, texts, size, percent), "links")

    # Copies of a set, and rows of one id with several sets, are links already.
    members = named.select("id", "n", "s1", "s2").distinct()
    same = members.join(classes.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"]).where("id <> rep")
    same = stored(same.select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct(), "copies")

    labels = component_labels(links.union(same))
    own = labels.select(F.col("node").alias("rep"), "label")
    its = labels.select(F.col("node").alias("centre"), F.col("label").alias("centre_label"))
    members = star.select("centre", "rep", "n").union(star.select("centre", F.col("centre").alias("rep"), F.col("centre_n").alias("n")).distinct())
    members = members.join(own, "rep", "left").join(its, "centre", "left")
    label, centre_label = F.coalesce("label", "rep"), F.coalesce("centre_label", "centre")
    members = stored(members.select("centre", "rep", "n", label.alias("label"), (label != centre_label).alias("other")), "members")
    more = stored(_across(members, texts, size, percent), "links")
    if more.take(1):
        labels = component_labels(links.union(same).union(more))
    component = F.coalesce("label", "id")
    return (
        signed.join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            component.eqNullSafe(F.col("id")).alias("kept"),
        )
    )
