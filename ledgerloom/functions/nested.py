"""JSON, struct, array and map columns; documents and records to flat tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ledgerloom.functions.text import braced_list


def json_text(col: Column, path: str) -> Column:
    """Value at a JSON path as bare text."""
    return F.get_json_object(col, path)


def json_fragment(col: Column, path: str) -> Column:
    """Value at a JSON path as JSON: text keeps its quotes."""
    return F.to_json(F.variant_get(F.try_parse_json(col), path, "variant"))


def first_element(array: Column) -> Column:
    """First element; NULL for an empty or missing array."""
    return F.get(array, F.lit(0))


def to_json_text(col: Column) -> Column:
    return F.to_json(col)


def parsed_once(document: Column) -> Column:
    """A parsed document as a column of its own, for ``select`` or ``withColumn``.

    Spark moves a filter below a projection and repeats the projected expression in
    it, so that each predicate on a field of ``from_json`` parses the text again. It
    does not move it below a generator: the document is parsed once per row.
    """
    return F.explode(F.array(document))


def explode_text_array(
    df: DataFrame, lists: str | Mapping[str, str], into: str, label: str | None = None
) -> DataFrame:
    """One row per item of a ``{a,b}`` text column; empty ``""`` items drop out.

    Several columns can be given as ``{column: label}``; they are read in one
    pass and each row carries its label. Stateless, so a streaming DataFrame
    is fine too.
    """
    lists = {lists: None} if isinstance(lists, str) else dict(lists)

    def items(name: str) -> Column:
        kept = F.filter(braced_list(F.col(name), drop='"",'), lambda x: x != '""')
        return F.coalesce(kept, F.array().cast("array<string>"))

    if label is None:
        (name,) = lists
        return df.withColumn(into, F.explode(items(name))).drop(*lists)

    def tagged_with(text: str):
        return lambda x: F.struct(F.lit(text).alias("label"), x.alias("item"))

    tagged = [F.transform(items(name), tagged_with(text)) for name, text in lists.items()]
    kept = [c for c in df.columns if c not in lists]
    return df.select(*kept, F.explode(F.concat(*tagged)).alias("_item")).select(
        *kept, F.col("_item.label").alias(label), F.col("_item.item").alias(into)
    )


def explode_struct_array(df: DataFrame, array: str, fields: Mapping[str, str]) -> DataFrame:
    """One row per array element, its fields renamed to ``{column: field}``."""
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, F.explode(array).alias("_e")).select(
        *kept, *[F.col(f"_e.{source}").alias(name) for name, source in fields.items()]
    )


SCHEDULE = "array<struct<day:string,isOpen:boolean,openTime:string,closeTime:string>>"


def explode_schedule(df: DataFrame, schedule: str, schema: str = SCHEDULE) -> DataFrame:
    """JSON array held as text to one row per entry; empty or missing text gives none."""
    kept = [c for c in df.columns if c != schedule]
    return df.select(*kept, F.explode(F.from_json(schedule, schema)).alias("_e")).select(
        *kept, "_e.*"
    )


def explode_rate_map(
    df: DataFrame, rates: str, codes: Sequence[str], key: str = "cat_id"
) -> DataFrame:
    """Text of ``{category: {code: rate}}`` to one row per category and one
    column per code. Single quotes are accepted; malformed text and empty maps
    give no row, an unknown code is ignored, an absent one is NULL."""
    kept = [c for c in df.columns if c != rates]
    parsed = F.from_json(
        F.replace(F.col(rates), F.lit("'"), F.lit('"')), "map<string,map<string,double>>"
    )
    return df.select(*kept, F.explode(parsed).alias(key, "_r")).select(
        *kept, key, *[F.try_element_at("_r", F.lit(code)).alias(code) for code in codes]
    )


@dataclass(frozen=True)
class FlattenSpec:
    """How a document or record becomes a flat row.

    ``schema`` declares the nested input, ``columns`` maps each output column
    to a SQL expression over it (an absent key reads as NULL), ``required``
    lists predicates a row must meet to be stored.
    """

    schema: str
    columns: Mapping[str, str]
    required: Sequence[str] = field(default_factory=tuple)

    def accepts(self) -> Column:
        ok = F.lit(True)
        for predicate in self.required:
            ok = ok & F.coalesce(F.expr(predicate), F.lit(False))
        return ok


def flatten(df: DataFrame, spec: FlattenSpec) -> DataFrame:
    """Flat rows of the documents that hold every required key."""
    return df.where(spec.accepts()).selectExpr(
        *[f"{expression} AS `{name}`" for name, expression in spec.columns.items()]
    )


def rejected(df: DataFrame, spec: FlattenSpec) -> DataFrame:
    """The documents ``flatten`` leaves out, whole, for inspection."""
    return df.where(~spec.accepts())


#: The outcome of a document that holds every required key.
ACCEPTED = "accepted"


def route(df: DataFrame, spec: FlattenSpec, into: str = "outcome") -> DataFrame:
    """Every document with its flat columns and its outcome, in one pass: ``accepted``,
    or the first required predicate that it fails."""
    outcome = F.lit(ACCEPTED)
    for predicate in reversed(spec.required):
        outcome = F.when(F.coalesce(F.expr(predicate), F.lit(False)), outcome).otherwise(F.lit(predicate))
    return df.withColumn(into, outcome)


def counted_outcomes(df: DataFrame, spec: FlattenSpec, outcome: str = "outcome") -> tuple[DataFrame, Observation]:
    """The routed rows, and an observation that counts each outcome while they are
    written or read for the first time (one number per predicate, and the accepted)."""
    seen = Observation()
    counts = [F.count_if(F.col(outcome) == text).alias(text) for text in (ACCEPTED, *spec.required)]
    return df.observe(seen, *counts), seen


def flatten_strict(df: DataFrame, spec: FlattenSpec) -> DataFrame:
    """Like ``flatten``, but a row without a required key fails the job."""
    checked = [
        f"CASE WHEN {' AND '.join(f'coalesce({p}, false)' for p in spec.required) or 'true'} "
        f"THEN {expression} ELSE raise_error('required key missing') END AS `{name}`"
        for name, expression in spec.columns.items()
    ]
    return df.selectExpr(*checked)
