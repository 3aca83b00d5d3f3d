"""A corpus pipeline: languages, near-duplicates, repeated passages, benchmark leaks, mix.

Each stage is written to the shared folder before the next one reads it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm import decontam, langmix, minmax, mixing, phrases
from ledgerloom.llm.queries import fold
from ledgerloom.session import scratch_dir


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Those whose language is undetermined go: null
    texts and texts without a letter (all, if no document names its language)."""
    langs, model = langmix.train(docs.where(fold("doc_id", 3) != 1))
    names = [f"column_{i}_" for i in range(len(docs.columns))]
    plain, text = docs.toDF(*names), names[docs.columns.index("text")]
    found = langmix.predicted_languages(plain, langs, model, id_cols=tuple(names), text_col=text)
    return found.where("lang_pred <> 'und'").select(*names).toDF(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the least id.

    Of repeated rows of an id one stays; rows with a null id all stay. Repeated
    rows are reduced before they are shuffled, and null ids are never shuffled.
    """
    gone = minmax.near_duplicates(docs, size=5, percent=80).where("NOT kept").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL")
    # Few ids are repeated; only their rows are put in order.
    repeated = named.groupBy("doc_id").agg(F.count("*").alias("rows_")).where("rows_ > 1").select("doc_id")
    once = named.join(gone.union(repeated).distinct(), "doc_id", "left_anti")
    again = named.join(repeated.join(gone, "doc_id", "left_anti"), "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy("text", F.to_json(F.struct(*[F.col(c) for c in docs.columns])))
    first = again.withColumn("place_in_id_", F.row_number().over(order)).where("place_in_id_ = 1")
    parts = [once, first, docs.where("doc_id IS NULL")]
    return reduce(DataFrame.union, [part.select(*docs.columns) for part in parts])


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a text with passages that repeat anywhere loses their words
    (the others are joined by one space), any other text stays as it is."""
    cut = phrases.without_repeats(docs)
    changed = F.col("n_removed_") > 0
    out = {"text": F.when(changed, F.col("kept_")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length("kept_")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumns(out).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither as it is nor with other values
    (rows with a null id are told apart by their text)."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = F.concat(F.lit("text "), F.sha2(F.col("text").cast("binary"), 256))
    keyed = docs.withColumn("leak_key_", F.coalesce(F.concat(F.lit("id "), F.col("doc_id").cast("string")), own))
    leaks = decontam.contaminated(keyed.select("leak_key_", "text"), benchmark, id_col="leak_key_").select("leak_key_").distinct()
    return keyed.join(leaks, "leak_key_", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix with ``copies_``, the times each is taken, and ``taken_``, its words."""
    where = scratch_dir(spark, "sizes")
    mixing.sized_documents(docs).write.parquet(where)
    limits = mixing.mixture_limits(spark.read.parquet(where))
    rows = docs.withColumns({"hash_": mixing.id_hash("doc_id"), "size_": mixing.word_count("text")})
    taken = mixing.times_taken(limits, rows, hashed="hash_").where("times_ > 0")
    return taken.select(*docs.columns, F.col("times_").alias("copies_"), (F.col("size_") * F.col("times_")).alias("taken_"))


STAGES = [
    ("language_id", identified),
    ("minhash_near_dedup", deduplicated),
    ("substring_dedup", without_passages),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
]

#: Language inference and the confirmation of links are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        where = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(where)
        docs = spark.read.parquet(where)
    return docs
