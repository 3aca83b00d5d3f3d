"""Lloyd's clustering with heap-ordered bounds, exact in integers.

Every vector has a gap: its distance to the second nearest centroid less that to
its own. While a cluster's accumulated drift (how far its centroid moved, and how
far the fastest of the others did) is less than the gap, the vector cannot change
its cluster. Each cluster keeps a heap of gaps, offset by the drift at the time of
entry, so that one number of the cluster ages all its gaps at once; a round pops
those that have expired and compares only these vectors with all centroids again.

Vectors are stored once, in blocks of some thousands, in a table bucketed by block;
the heaps of the blocks are a second, narrow table of the same buckets, written by
each round and read by the next, so no round shuffles vectors. Centroids follow
from the sums of the vectors that moved.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import remove_dir, scratch_dir

#: Distances between vectors whose components are in this range fit a long.
LARGEST = 1 << 27
#: Up to this size, products and their sums are exact in doubles.
EXACT = 1 << 22
BUCKET_BYTES = 64 << 20


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller one in a tie), squared distance to it, and to the next nearest."""
    n, k = len(vectors), len(centroids)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if max(np.abs(vectors).max(), np.abs(centroids).max()) <= EXACT:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        squares = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", c, c) - 2 * (x @ c.T)
    else:
        x, c = vectors.astype(np.int64), centroids.astype(np.int64)
        squares = np.stack([((x - c[j]) ** 2).sum(axis=1) for j in range(k)], axis=1)
    which = squares.argmin(axis=1)
    rows = np.arange(n)
    first = squares[rows, which].astype(np.int64)
    if k == 1:
        return which, first, np.full(n, np.inf)
    return which, first, np.partition(squares, 1, axis=1)[:, 1].astype(np.float64)


class Heaps:
    """One heap of (gap and drift at entry, row) for each cluster."""

    def __init__(self, heaps: list[list[tuple[float, int]]]):
        self.heaps = heaps

    def popped(self, drift: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose gap is used up (or may be, within rounding), and their clusters."""
        rows, of = [], []
        for j, heap in enumerate(self.heaps):
            limit = drift[j] + slack
            while heap and heap[0][0] <= limit:
                rows.append(heapq.heappop(heap)[1])
                of.append(j)
        return np.array(rows, np.int64), np.array(of, np.int64)

    def push(self, rows: np.ndarray, which: np.ndarray, keys: np.ndarray) -> None:
        for row, j, key in zip(rows.tolist(), which.tolist(), keys.tolist(), strict=True):
            heapq.heappush(self.heaps[j], (key, row))

    def clusters(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for j, heap in enumerate(self.heaps):
            out[[row for _, row in heap]] = j
        return out

    def packed(self) -> list[bytes]:
        flat = [x for heap in self.heaps for x in heap]
        sizes = np.array([len(h) for h in self.heaps], np.int32)
        return [np.array([k for k, _ in flat], np.float64).tobytes(), np.array([r for _, r in flat], np.int32).tobytes(), sizes.tobytes()]

    @classmethod
    def unpacked(cls, keys: bytes, rows: bytes, sizes: bytes) -> Heaps:
        flat = list(zip(np.frombuffer(keys, np.float64).tolist(), np.frombuffer(rows, np.int32).tolist(), strict=True))
        ends = np.cumsum(np.frombuffer(sizes, np.int32)).tolist()
        return cls([flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)])


def updated(heaps: Heaps | None, vectors: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[Heaps, np.ndarray, int]:
    """Heaps after one assignment; what it changes in each cluster's sums (last column: count); rows compared.

    Without heaps all vectors are compared.
    """
    k, width = centroids.shape
    scale = 16.0 * (float(np.abs(vectors).max(initial=0)) + float(np.abs(centroids).max(initial=0)))
    change = np.zeros((k, width + 1), np.int64)
    if heaps is None:
        heaps = Heaps([[] for _ in range(k)])
        rows, before = np.arange(len(vectors)), None
    else:
        rows, before = heaps.popped(drift, 1e-12 * (scale + float(drift.max(initial=0))))
    taken = vectors[rows].astype(np.int64)
    which, first, second = nearest(taken, centroids)
    heaps.push(rows, which, np.sqrt(second) - np.sqrt(first.astype(np.float64)) + drift[which])
    counted = np.concatenate([taken, np.ones((len(rows), 1), np.int64)], axis=1)
    moved = slice(None) if before is None else np.flatnonzero(before != which)
    np.add.at(change, which[moved], counted[moved])
    if before is not None:
        np.subtract.at(change, before[moved], counted[moved])
    return heaps, change, len(rows)


class _Bucketed:
    """Tables bucketed by block, so that joins by block need no exchange.

    They are in the session's catalog while the run lasts; leaving drops them.
    """

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.tables = spark, buckets, {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        table, where = f"{name}_{uuid.uuid4().hex}", scratch_dir(self.spark, name)
        df.write.bucketBy(self.buckets, "block").sortBy("block").option("path", where).saveAsTable(table)
        self.tables[name] = (table, where)
        return self.spark.table(table)

    def __enter__(self) -> _Bucketed:
        return self

    def __exit__(self, *_) -> None:
        for name in list(self.tables):
            self.drop(name)

    def drop(self, name: str) -> None:
        table, where = self.tables.pop(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_dir(self.spark, where)


_STATE = "block long, keys binary, rows binary, sizes binary, change binary, compared long"


def clustered(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, width: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
    report: list | None = None,
) -> DataFrame:
    """``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256`` of kept vectors.

    Kept are vectors with exactly ``width`` components, all of them finite numbers;
    others (null vectors too) give no row. Components become floor(scale * x), held to
    2^27 either way. Centroids start as the ``k`` vectors with the least SHA-256 of
    ``2:<id>`` (null id: ``2:``; ties by components); each round assigns all vectors,
    a tie to the smaller number, and takes the floors of exact means; an empty cluster
    keeps its centroid. Repeated ids and rows are vectors of their own. With fewer than
    ``k`` vectors, all are centroids; an empty table gives no rows. Sums beyond a long
    are held to the largest one. ``report`` gets the number of vectors compared by round.
    """
    spark = vectors.sparkSession
    values = F.col(vector_col).cast("array<double>")
    picked = vectors.select(F.col(id_col).alias("id"), values.alias("v")).where(
        (F.size("v") == width) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    # floor(scale * x) in doubles, held to the range in which distances fit a long.
    kept = picked.withColumn("v", F.transform("v", lambda x: F.least(F.greatest(F.floor(x * F.lit(float(scale))), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int")))
    first = kept.withColumn("h", F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256))
    centroids = np.array([r.v for r in first.orderBy("h", "v").limit(k).select("v").collect()], np.int64).reshape(-1, width)
    kind = vectors.schema[id_col].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame([], f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string").withColumnRenamed("id", id_col)
    k = len(centroids)

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            x = x.astype(np.int16) if np.abs(x).max() < 1 << 15 else x
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary()), pa.array([x.itemsize], pa.int32())], ["ids", "payload", "bytes"])

    def unpacked(payload: bytes, size: int) -> np.ndarray:
        return np.frombuffer(payload, np.int16 if size == 2 else np.int32).reshape(-1, width)

    base = scratch_dir(spark, "vectors")
    kept.mapInArrow(pack, f"ids array<{kind}>, payload binary, bytes int").withColumn("block", F.monotonically_increasing_id()).write.parquet(base)
    loose = spark.read.parquet(base)
    held = loose.agg(F.sum(F.octet_length("payload"))).first()[0]
    tables = _Bucketed(spark, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // BUCKET_BYTES)))
    where = scratch_dir(spark, "clusters")
    with tables:
        blocks = tables.stored(loose.repartition(tables.buckets, "block"), "blocks")
        remove_dir(spark, base)

        def step(centroids, drift, states=None):
            fresh = states is None

            def assign(batches):
                for batch in batches:
                    out = []
                    for i in range(batch.num_rows):
                        block, payload, size = (batch.column(c)[i].as_py() for c in ("block", "payload", "bytes"))
                        old = None if fresh else Heaps.unpacked(*[batch.column(c)[i].as_py() for c in ("keys", "rows", "sizes")])
                        heaps, change, compared = updated(old, unpacked(payload, size), centroids, drift)
                        out.append((block, *heaps.packed(), change.tobytes(), compared))
                    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
                    columns = zip(*out, strict=True) if out else [()] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["block", "keys", "rows", "sizes", "change", "compared"])

            rows = blocks.select("block", "payload", "bytes")
            if not fresh:
                rows = rows.join(states.select("block", "keys", "rows", "sizes"), "block")
            return rows.mapInArrow(assign, _STATE)

        def changes(states) -> np.ndarray:
            """Sums of the blocks' changes: as many numbers as the centroids have, and a count each."""

            def added(batches):
                total = np.zeros(k * (width + 1), np.int64)
                for batch in batches:
                    for change in batch.column("change"):
                        total += np.frombuffer(change.as_py(), np.int64)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["place", "n"])

            out = np.zeros(k * (width + 1), object)
            for place, n in states.select("change").mapInArrow(added, "place int, n long").groupBy("place").agg(F.sum(F.col("n").cast("decimal(38,0)"))).collect():
                out[place] = int(n)
            return out.reshape(k, width + 1)

        drift, sums, states = np.zeros(k), np.zeros((k, width + 1), object), None
        for number in range(rounds + 1):
            states = tables.stored(step(centroids, drift, states), f"heaps{number}")
            if number:
                tables.drop(f"heaps{number - 1}")
            if report is not None:
                report.append(states.agg(F.sum("compared")).first()[0])
            if number == rounds:
                break
            sums = sums + changes(states)
            means = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old.tolist() for row, old in zip(sums.tolist(), centroids, strict=True)], np.int64)
            moved = np.sqrt(((means - centroids) ** 2).sum(axis=1).astype(np.float64))
            if not moved.any():
                break
            others = [np.delete(moved, j).max(initial=0) for j in range(k)]
            # A little more than the moves, so that rounding never keeps a gap alive.
            drift, centroids = drift + (moved + np.array(others)) * (1 + 1e-12), means

        def shown(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, payload, size, *heaps = (batch.column(c)[i].as_py() if c != "ids" else batch.column(c)[i].values for c in ("ids", "payload", "bytes", "keys", "rows", "sizes"))
                    x = unpacked(payload, size).astype(np.int64)
                    which = Heaps.unpacked(*heaps).clusters(len(x))
                    far = ((x - centroids[which]) ** 2).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(which.astype(np.int32)), pa.array(far)], ["id", "cluster", "distance"])

        blocks.join(states.select("block", "keys", "rows", "sizes"), "block").select("ids", "payload", "bytes", "keys", "rows", "sizes").mapInArrow(
            shown, f"id {kind}, cluster int, distance long"
        ).write.parquet(where)

    found = spark.read.parquet(where)
    totals = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    most = (1 << 63) - 1
    told = [
        (j, min(totals.get(j, 0), most), min(sum(totals.values()), most), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
        for j, c in enumerate(centroids)
    ]
    # One row per centroid.
    each = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(each), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return out.withColumnRenamed("id", id_col)
