"""Merkle manifest of a table: a root, and for every row a witness that leads to it.

Rows are leaves, in order within runs. Over a run, and then over the subroots of
all runs, every two consecutive nodes become one until one remains; the last node
of an odd level becomes the digest of itself alone.

Leaves are numbered within their run by a range sort and the row counts of its
partitions, so a run of any size is many tasks. Aligned blocks of 4096 consecutive
leaves are grown by appends: a leaf opens a subtree, two open subtrees of one
height close into one, and each closing extends the partial witnesses of the leaves
on both sides by the other side's digest. Roots of blocks are appended to the next
level in the same way, and their witnesses extend those of their leaves.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.words import widened
from ledgerloom.session import scratch_dir

#: Height of a block.
HEIGHT = 12
_ROW = (1 << 33) - 1


def digest(*parts: bytes) -> bytes:
    """SHA-256 of digests as hexadecimal text, as such text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256))


class Appended:
    """A tree that grows by appends, and the witness of each node appended so far.

    ``open`` has the open subtrees, highest first: height, digest, and the range of
    their leaves. A witness is a list by height: the sibling's digest, or nothing
    where a node went up alone.
    """

    def __init__(self):
        self.open: list[tuple[int, bytes, int, int]] = []
        self.witness: list[list[bytes]] = []

    def append(self, leaf: bytes) -> None:
        n = len(self.witness)
        self.witness.append([])
        self._settle((0, leaf, n, n + 1))

    def _settle(self, node: tuple[int, bytes, int, int]) -> None:
        while self.open and self.open[-1][0] == node[0]:
            height, left, first, middle = self.open.pop()
            _, right, _, last = node
            for w in self.witness[first:middle]:
                w.append(right)
            for w in self.witness[middle:last]:
                w.append(left)
            node = height + 1, digest(left, right), first, last
        self.open.append(node)

    def close(self, height: int | None = None) -> bytes:
        """The root, once no more nodes come: at this height, or where one node remains."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            at, alone, first, last = self.open.pop()
            for w in self.witness[first:last]:
                w.append(b"")
            self._settle((at + 1, digest(alone), first, last))
        return self.open[0][1]


def numbered(rows: DataFrame, run: str, order: list[str], name: str) -> DataFrame:
    """Stored rows with ``place``, their number in the order within their run, and ``size``, the run's rows."""
    spark = rows.sparkSession
    where = scratch_dir(spark, name)
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(run, *order, "_row")
    dealt.sortWithinPartitions(run, *order, "_row").withColumn("_row", F.monotonically_increasing_id()).write.parquet(where)
    stored = spark.read.parquet(where).withColumns({"_part": F.shiftright("_row", 33), "_row": F.col("_row").bitwiseAND(_ROW)})
    parts = stored.groupBy(run, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    upto = Window.partitionBy(run).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        run, "_part", "_first", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(run)).alias("size")
    )
    placed = stored.join(parts, [run, "_part"])
    return placed.withColumn("place", F.col("_row") - F.col("_first") + F.col("_before")).drop("_row", "_part", "_first", "_before")


_BLOCK = "run string, block long, size long, root binary, places array<long>, witnesses array<struct<siblings: binary, mask: long, levels: int>>"
_BLOCK_SCHEMA = [
    ("run", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("root", pa.binary()), ("places", pa.list_(pa.int64())),
    ("witnesses", pa.list_(pa.struct([("siblings", pa.binary()), ("mask", pa.int64()), ("levels", pa.int32())]))),
]


def blocks(nodes: DataFrame, keep: list[str], height: int, name: str) -> DataFrame:
    """Stored aligned blocks of nodes (``run``, ``place``, ``size``, ``digest``): their root and,
    by leaf in order, the witness within the block and the columns ``keep`` as arrays."""
    spark = nodes.sparkSession
    kinds = dict(nodes.select(*keep).dtypes)

    def grown(table):
        table = table.sort_by("place")
        run, block, size = table["run"][0].as_py(), table["block"][0].as_py(), table["size"][0].as_py()
        tree = Appended()
        for node in table["digest"].to_pylist():
            tree.append(node.hex().encode())
        root = tree.close(height if size > 1 << height else None)
        told = [
            {"siblings": bytes.fromhex(b"".join(w).decode()), "mask": sum(1 << h for h, s in enumerate(w) if s), "levels": len(w)}
            for w in tree.witness
        ]
        row = [run, block, -(-size >> height) if size > 1 << height else 1, bytes.fromhex(root.decode()), table["place"].to_pylist(), told]
        columns = [pa.array([v], k) for v, (_, k) in zip(row, _BLOCK_SCHEMA, strict=True)]
        held = [pa.array([table[c].to_pylist()], pa.list_(table.schema.field(c).type)) for c in keep]
        return pa.table(columns + held, names=[n for n, _ in _BLOCK_SCHEMA] + keep)

    where = scratch_dir(spark, name)
    asked = nodes.select("run", F.shiftright("place", height).alias("block"), "size", "place", "digest", *[c for c in keep if c != "digest"])
    schema = ", ".join([_BLOCK, *[f"`{c}` array<{k}>" for c, k in kinds.items()]])
    asked.groupBy("run", "block").applyInArrow(grown, schema).write.parquet(where)
    return spark.read.parquet(where)


def _extended(lower: DataFrame, upper: DataFrame, keys: list[str]) -> DataFrame:
    """Witnesses of ``lower`` (column ``w``) extended by those that ``upper`` has of their roots."""
    both = lower.join(upper.withColumnRenamed("w", "_above"), keys)
    low, high = F.col("w"), F.col("_above")
    longer = F.struct(
        F.concat(low["siblings"], high["siblings"]).alias("siblings"),
        low["mask"].bitwiseOR(F.call_function("shiftleft", high["mask"], low["levels"])).alias("mask"),
        (low["levels"] + high["levels"]).alias("levels"),
    )
    return both.withColumn("w", longer).drop("_above")


def trees(nodes: DataFrame, keep: list[str], height: int, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Blocks of the nodes; ``run``, ``block``, ``w`` (the way from each block's root to its run's);
    and ``run``, ``root`` of every run."""
    bottom = now = blocks(nodes, keep, height, name)
    ways = []
    while (now.agg(F.max("size")).first()[0] or 1) > 1:
        above = now.select("run", F.col("block").alias("place"), "size", F.col("root").alias("digest"))
        now = blocks(above, [], height, name)
        pairs = now.select("run", F.col("block").alias("_parent"), F.explode(F.arrays_zip("places", "witnesses")).alias("_x"))
        ways.append(pairs.select("run", "_parent", F.col("_x.places").alias("block"), F.col("_x.witnesses").alias("w")))
    none = F.struct(F.lit(b"").alias("siblings"), F.lit(0).cast("long").alias("mask"), F.lit(0).alias("levels"))
    way = now.select("run", "block", none.alias("w"))
    for step in reversed(ways):
        way = _extended(step, way.withColumnRenamed("block", "_parent"), ["run", "_parent"]).drop("_parent")
    return bottom, way, now.select("run", "root")


def folded(leaf: bytes, siblings: list[bytes], mask: int, levels: int, place: int) -> bytes:
    """The root that a leaf and its siblings lead to."""
    rest = iter(siblings)
    for h in range(levels):
        if mask >> h & 1:
            beside = next(rest)
            leaf = digest(beside, leaf) if place >> h & 1 else digest(leaf, beside)
        else:
            leaf = digest(leaf)
    return leaf


def manifest(docs: DataFrame, run: Column, order: list[str], leaf: Column, shown: Column, height: int = HEIGHT) -> DataFrame:
    """Columns ``order``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified`` of every row.

    Rows of a run are in the order of the columns ``order`` (nulls first), then of
    their digest. ``leaf`` is a row's digest; ``shown`` that of the row as it is
    presented for verification. A null run is a run of its own, before all others.
    Equal rows are leaves of their own; an empty table gives no rows. Digests are
    lower-case hexadecimal.
    """
    spark = docs.sparkSession
    names = [f"_order{i}" for i in range(len(order))]
    where = scratch_dir(spark, "leaves")
    # "-" sorts before "=", so a null run comes first.
    run_key = F.coalesce(F.concat(F.lit("="), run.cast("string")), F.lit("-"))
    docs.select(run_key.alias("run"), *[F.col(c).alias(n) for c, n in zip(order, names, strict=True)], leaf.alias("digest"), shown.alias("_shown")).write.parquet(where)
    leaves = numbered(spark.read.parquet(where), "run", [*names, "digest"], "numbered")
    bottom, way, subroots = trees(leaves, [*names, "digest", "_shown"], height, "blocks")

    runs = numbered(subroots.select(F.lit("").alias("all"), "run", F.col("root").alias("digest")), "all", ["run"], "runs")
    top, top_way, top_root = trees(runs.withColumnRenamed("run", "lang_run").withColumnRenamed("all", "run"), ["lang_run", "digest"], height, "top")
    zipped = top.select("run", "block", F.explode(F.arrays_zip("places", "witnesses", "lang_run", "digest")).alias("_x"))
    each = zipped.select("run", "block", *[F.col(f"_x.{a}").alias(b) for a, b in (("places", "_rank"), ("witnesses", "w"), ("lang_run", "_run"), ("digest", "_subroot"))])
    ends = _extended(each, top_way, ["run", "block"]).select(F.col("_run").alias("run"), "_rank", F.col("w").alias("_end"), "_subroot")
    found = top_root.first()
    root = found["root"].hex() if found else ""

    ready = bottom.join(way, ["run", "block"]).join(ends, "run")
    kinds = docs.select(*[F.col(c).alias(n) for c, n in zip(order, names, strict=True)]).schema
    out_names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def read(batches):
        for batch in batches:
            rows = []
            columns = ("digest", "_shown", "_rank", "_subroot", "_place", "_low", "w", "_end")
            for own, other, rank, subroot, place, low, up, end in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                held = low["siblings"] + up["siblings"]
                beside = [held[k : k + 32].hex().encode() for k in range(0, len(held), 32)]
                above = [end["siblings"][k : k + 32].hex().encode() for k in range(0, len(end["siblings"]), 32)]
                mask, levels = low["mask"] | up["mask"] << low["levels"], low["levels"] + up["levels"]
                sub = folded(other.hex().encode(), beside, mask, levels, place)
                got = folded(sub, above, end["mask"], end["levels"], rank).decode()
                rows.append((own.hex(), subroot.hex(), root, digest(*beside, *above).decode(), got, got == root))
            told = list(zip(*rows, strict=True)) if rows else [()] * 6
            arrays = [pa.array(c, pa.string()) for c in told[:5]] + [pa.array(told[5], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + arrays, names + out_names)

    each = F.arrays_zip("places", "witnesses", "digest", "_shown", *names)
    leaf_rows = ready.select("w", "_end", "_rank", "_subroot", F.explode(each).alias("_x")).select(
        *[F.col(f"_x.{n}").alias(n) for n in [*names, "digest", "_shown"]], F.col("_x.places").alias("_place"), F.col("_x.witnesses").alias("_low"), "w", "_end", "_rank", "_subroot"
    )
    out = leaf_rows.mapInArrow(
        read, widened(kinds, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    )
    return out.withColumnsRenamed(dict(zip(names, order, strict=True)))
