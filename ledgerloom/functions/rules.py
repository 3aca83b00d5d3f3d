"""Column builders: value maps, pattern maps, ranges, column picks, labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def multi_col_rules(rules: Iterable[tuple[Column, object]], default=None) -> Column:
    """First rule whose predicate holds gives the label; predicates may mix columns."""
    chain = None
    for predicate, label in rules:
        label = _column(label)
        chain = F.when(predicate, label) if chain is None else chain.when(predicate, label)
    if chain is None:
        return _column(default)
    return chain if default is None else chain.otherwise(_column(default))


def value_map(col: Column, labels: Mapping[object, Sequence], default=None) -> Column:
    """Map exact values to labels: ``{label: values}``.

    A value listed under two labels is a mistake in the table and rejected.
    """
    seen: set = set()
    for values in labels.values():
        repeated = seen.intersection(values)
        if repeated:
            raise ValueError(f"values listed twice: {sorted(repeated)}")
        seen.update(values)
    return multi_col_rules([(col.isin(*v), label) for label, v in labels.items()], default)


def pattern_map(col: Column, patterns: Iterable[tuple[str, object]], default=None) -> Column:
    """Ordered LIKE patterns; the first match wins."""
    return multi_col_rules([(col.like(p), label) for p, label in patterns], default)


def bucketize(col: Column, segments: Iterable[tuple[object, str]], above: str | None = None) -> Column:
    """Upper-inclusive ranges to labels; NULL and what lies above stay NULL
    unless ``above`` names a last label."""
    segments = list(segments)
    rules = [(col <= F.lit(bound), label) for bound, label in segments]
    if above is not None:
        rules.append((col > F.lit(segments[-1][0]), above))
    return multi_col_rules(rules)


def pick_column_by_value(key: Column, columns: Mapping[str, str | Column]) -> Column:
    """The row's value of ``key`` chooses which column to return."""
    return F.coalesce(
        *[
            F.when(key == F.lit(value), F.col(c) if isinstance(c, str) else c)
            for value, c in columns.items()
        ]
    )


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else NULL."""
    return F.when(condition, F.lit(1))


def keep_if(condition: Column, value: Column) -> Column:
    """The value where the condition holds, else NULL."""
    return F.when(condition, value)


def line_total(price: Column, quantity: Column) -> Column:
    return price * quantity


def with_discount(price: Column, discount: Column, data_type: str = "decimal(18,2)") -> Column:
    """Price plus a discount held as text; no discount counts as zero."""
    return price + F.coalesce(discount.cast(data_type), F.lit(0).cast(data_type))


def composite_label(*cols: Column, sep: str = "/", null_safe: bool = False) -> Column:
    """Join columns as text. NULL in any part gives NULL, unless ``null_safe``."""
    parts: list[Column] = []
    for col in cols:
        text = col.cast("string")
        parts += [F.lit(sep), F.coalesce(text, F.lit("")) if null_safe else text]
    return F.concat(*parts[1:])


def percentage(amount: Column, rate: Column, scale: int = 3) -> Column:
    """``amount * rate / 100`` rounded half up; a missing rate counts as zero."""
    exact = amount.cast("decimal(18,4)") * rate.cast("decimal(10,4)") / F.lit(100).cast("decimal(3,0)")
    return F.round(F.coalesce(exact, F.lit(0).cast("decimal(18,4)")), scale)
