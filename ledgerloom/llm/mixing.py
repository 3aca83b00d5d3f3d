"""Mixing sources to target weights by hash-threshold histograms.

Each document has a hash of its id. A source that should contribute a fraction
of its words takes the documents whose hash lies below a threshold. The
threshold is found without sorting: words are summed by source and by the
leading bits of the hash, the bucket in which the budget runs out is the
boundary bucket, and only that bucket is summed again by the next bits. The
thresholds of smaller budgets lie below those of larger ones, so a smaller mix
is part of a larger one, and reruns agree because the hash is that of the id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.words import GAP
from ledgerloom.session import scratch_dir

HASH_BITS = 40
STEP_BITS = 10


def word_count(text: str):
    """Number of words of a text column (null: 0)."""
    words = F.array_remove(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), GAP), "")
    return F.size(words).cast("long")


def id_hash(key: str):
    """The first 40 bits of the MD5 of an id as text (null: of the empty text)."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Targets of sources: ``sizes`` has ``source`` (null is a source) and ``source_size``.

    Sources by code point, null last, weigh ``weights``, repeating. Together
    they get ``share`` times all sizes; a target stops at ``limit`` times its
    source's size, and the excess is shared again by weight until none is
    above. One row per source passes through one task here; documents do not.
    """
    spark = sizes.sparkSession
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    turn = ((F.row_number().over(order) - 1) % len(weights)).cast("int")
    where = scratch_dir(spark, "mix-sources")
    sizes.select("source", "source_size", F.get(cycle, turn).alias("weight")).write.parquet(where)
    table = spark.read.parquet(where)
    top = F.col("source_size") * F.lit(float(limit))
    rate, full = None, -1
    while True:
        above = F.lit(False) if rate is None else F.col("weight") * F.lit(rate) > top
        row = table.agg(
            F.sum("source_size").alias("size"),
            F.sum(F.when(above, top).otherwise(0.0)).alias("held"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(above, 1).otherwise(0)).alias("full"),
        ).first()
        if row.full == full or not row.size:
            break
        full = row.full
        if row.weight:
            rate = (share * row.size - row.held) / row.weight
    target = F.least(F.col("weight") * F.lit(rate or 0.0), top)
    return table.select("source", "source_size", target.alias("target"))


def hash_thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``copies`` that every document gives and the hash ``threshold``
    below which a document gives one more.

    ``sized`` has source, size and hash. The words below the threshold come as
    near as whole hash values can to what the copies leave of the target: the
    value in which it runs out is taken if that misses by less (at a tie not).
    """
    spark = sized.sparkSession
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.select(
        "source", "source_size", "target", copies.cast("long").alias("copies")
    ).select(
        "*",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("threshold"),
    )
    below = Window.partitionBy("source", "budget").orderBy("bucket")
    for level in range(HASH_BITS // STEP_BITS):
        shift = HASH_BITS - STEP_BITS * (level + 1)
        lead = F.shiftright("hash", shift + STEP_BITS)
        part = F.shiftright("hash", shift) % (1 << STEP_BITS)
        sums = sized.groupBy("source", lead.alias("lead"), part.alias("bucket")) if level == 0 else None
        if sums is None:
            edge = state.select(F.col("source").alias("s"), F.col("threshold").alias("t"))
            inside = sized.join(edge, F.col("source").eqNullSafe(F.col("s")) & (lead == F.col("t")), "left_semi")
            sums = inside.groupBy("source", lead.alias("lead"), part.alias("bucket"))
        sums = sums.agg(F.sum("size").alias("words")).withColumnRenamed("source", "s")
        known = state.select("source", "budget", "threshold")
        meets = F.col("source").eqNullSafe(F.col("s")) & (F.col("lead") == F.col("threshold"))
        running = known.join(sums, meets).select("source", "bucket", "words", "budget").withColumn(
            "upto", F.sum("words").over(below)
        )
        edge = (
            running.where(F.col("upto") > F.col("budget"))
            .groupBy(F.col("source").alias("s"))
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "upto")).alias("edge"))
        )
        beyond = (1 << STEP_BITS) if level == 0 else 0
        bucket = F.coalesce(F.col("edge.bucket"), F.lit(beyond))
        if not shift:
            nearer = F.col("edge.upto") - F.col("budget") < F.col("budget") - F.col("edge.before")
            bucket = bucket + F.coalesce(nearer, F.lit(False)).cast("long")
        state = state.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "copies",
            (F.col("budget") - F.coalesce(F.col("edge.before"), F.lit(0))).alias("budget"),
            (F.col("threshold") * (1 << STEP_BITS) + bucket).alias("threshold"),
        )
        where = scratch_dir(spark, "mix-thresholds")
        state.write.parquet(where)
        state = spark.read.parquet(where)
    return state.drop("budget")


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id``, ``source``, ``size`` (words; null text: 0) and ``hash`` of each document."""
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), id_hash(id_col).alias("hash")
    )


def mixture_limits(sized: DataFrame, weights=(3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Per source of ``sized_documents``: size, target, copies and hash threshold."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return hash_thresholds(sized, source_targets(sizes, weights, share, limit))


def times_taken(limits: DataFrame, rows: DataFrame, source: str = "source", hashed: str = "hash") -> DataFrame:
    """``rows`` with ``source_size_``, ``target_`` and ``times_``, how often each is taken."""
    known = limits.select(
        F.col("source").alias("s_"), F.col("source_size").alias("source_size_"), F.col("target").alias("target_"), "copies", "threshold"
    )
    times = F.col("copies") + (F.col(hashed) < F.col("threshold")).cast("long")
    both = rows.join(known, F.col(source).eqNullSafe(F.col("s_")))
    return both.withColumn("times_", times).select(*[rows[c] for c in rows.columns], "source_size_", "target_", "times_")


def mixed_documents(
    docs: DataFrame,
    weights=(3, 1, 2),
    share: float = 1.5,
    limit: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns one row per row of ``docs``: the id, ``source``, ``size`` (words;
    null text: 0), ``source_size`` and ``target`` of its source, ``taken`` (its
    size times the times it is taken, ``limit`` at most). Taken words of a
    source miss its target by half the documents of one hash value at most.
    Repeated ids are taken together. A null id hashes as the empty text, a null
    source is a source, an empty text has size 0 and is neither here nor there,
    an empty table gives none. Other columns are ignored.
    """
    spark = docs.sparkSession
    where = scratch_dir(spark, "mix-sizes")
    sized_documents(docs, id_col, text_col, source_col).write.parquet(where)
    sized = spark.read.parquet(where)
    taken = times_taken(mixture_limits(sized, weights, share, limit), sized)
    return taken.select(
        F.col("id").alias(id_col),
        "source",
        "size",
        F.col("source_size_").alias("source_size"),
        F.col("target_").alias("target"),
        (F.col("size") * F.col("times_")).alias("taken"),
    )
