"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import remove_dir, scratch_dir

#: Rows of one key that may meet in a task, and how many keys with more are sent to all tasks.
HUB_ROWS = 1000
MOST_HUBS = 100_000


def hub_join(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``keyed``, which has one row per key and the number of its rows.

    The rows of a key with very many do not meet: such keys are sent to all tasks,
    ``MOST_HUBS`` at most, because a key counts as one only from ``total`` divided by
    that number of rows on. ``keyed`` should be stored, as it is read twice.
    """
    limit = max(HUB_ROWS, total // MOST_HUBS)
    hubs = keyed.where(F.col(count) > limit).withColumn("hub_", F.lit(True))
    marked = rows.join(F.broadcast(hubs), key, "left")
    others = marked.where("hub_ IS NULL").select(*rows.columns).join(keyed.where(F.col(count) <= limit), key)
    return marked.where("hub_").drop("hub_").unionByName(others)


class _Rounds:
    """Tables of the rounds, each deleted when the next one of its name is stored."""

    def __init__(self, spark):
        self.spark, self.places = spark, {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        where = scratch_dir(self.spark, name)
        df.write.parquet(where)
        self.places.setdefault(name, []).append(where)
        return self.spark.read.parquet(where)

    def forget(self, name: str, keep: int = 1) -> None:
        held = self.places.get(name, [])
        while len(held) > keep:
            remove_dir(self.spark, held.pop(0))


def component_labels(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the least node reachable, for nodes that have links.

    Alternates two steps until links form stars: every node's larger neighbours
    are linked to its least neighbour, then its smaller ones and itself are. A
    round halves paths at least, so the number of rounds grows with the
    logarithm of the longest path. Nodes' neighbours are reduced to a minimum
    by aggregation, never collected, and links of a hub are not gathered.
    """
    rounds = _Rounds(links.sparkSession)
    edges = rounds.stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    mark = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        least = rounds.stored(least, "least")
        large = hub_join(both, least, "u", "n", edges.count()).where("v > u")
        edges = rounds.stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "links")
        least = rounds.stored(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        small = hub_join(edges, least, "u", "n", edges.count()).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = rounds.stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        rounds.forget("links")
        rounds.forget("least", 0)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
