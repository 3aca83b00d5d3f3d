"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one bit per failed rule; policies (versioned sets of rules) and ablations
are bitwise operations on that column, so that changing a policy reads no text
again. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.words import GAP

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Rule names in order of their bits, each with the failing condition.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "2 * word_chars < 3 * n_words",
    "long_words": "word_chars > 40 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A version of the set of rules that a kept document must pass."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(name) for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
POLICY = Policy("2", tuple(RULES))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements of whole texts, one row per row of ``docs``.

    ``word_chars`` counts code points in words, ``n_symbols`` characters of
    ``#*$%&|<>``, ``n_lines`` lines with a word, ``n_dup_lines`` those equal to
    an earlier one, ``n_repeat_words`` words inside a window of three that the
    text holds twice or more. A null text measures as an empty one; a null id
    stays null. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        F.array_remove(F.split("t", GAP), "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("lines"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    following = lambda i, by: F.get(F.col("words"), i + by)
    windows = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda word, i: F.concat_ws(" ", word, following(i, 1), following(i, 2)),
    )
    split = split.select(
        "id", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # Only a text with an equal pair of windows needs them in order.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    split = split.select("*", F.when(repeats, F.array_sort(placed)).alias("placed")).drop("windows")
    at = lambda i: F.get(F.col("placed"), i)["w"]
    equal = lambda x, i: F.coalesce(x["w"] == at(i - 1), F.lit(False)) | F.coalesce(x["w"] == at(i + 1), F.lit(False))
    places = F.array_sort(F.transform(F.filter("placed", equal), lambda x: x["i"]))
    split = split.select("*", places.alias("places")).drop("placed")
    covered = F.aggregate(
        F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("places"), i + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return split.select(
        F.col("id").alias(id_col),
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``measured`` and ``failed``: bit ``i`` is set if rule ``i`` of ``RULES`` fails."""
    bits = F.lit(0).cast("long")
    for place, condition in enumerate(RULES.values()):
        bits = bits + F.when(F.expr(condition), F.lit(1 << place)).otherwise(0).cast("long")
    return measured(docs, id_col, text_col).withColumn("failed", bits)


def fails(policy: Policy, failed: str = "failed") -> Column:
    """Whether a document fails a rule of the policy."""
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that the policy
    would keep without it.

    Reads the ledger's bits only; their distinct combinations (two to the number
    of rules at most) are counted once.
    """
    masked = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long"))
    counts = entries.groupBy(masked.alias("bits")).agg(F.count("*").alias("n"))
    names = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit")) for r in policy.rules])
    pairs = counts.select("bits", "n", F.explode(names).alias("r")).select("bits", "n", "r.rule", "r.bit")
    return pairs.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("freed"),
    ).withColumn("version", F.lit(policy.version))
