"""Repair of category paths by an ordered table of steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Override:
    """Where the titles at ``when`` levels hold, put ``then`` at its levels."""

    when: Mapping[int, str]
    then: Mapping[int, str | None]


@dataclass(frozen=True)
class Collapse:
    """A level equal to its parent disappears; deeper levels move up."""

    level: int


Step = Override | Collapse

# Overrides of the marketplace catalogue, in order.
CATALOGUE_STEPS: tuple[Step, ...] = (
    Override(
        {1: " Товары для дома и сада", 3: "Смесители"}, {1: "Сантехника", 2: "Смесители", 3: None}
    ),
    Override(
        {2: "Бытовая техника", 3: "Весы кухонные"},
        {1: "Бытовая техника", 2: "Мелкая бытовая техника для кухни"},
    ),
    Override(
        {2: "Бытовая техника", 3: "Весы напольные"},
        {1: "Бытовая техника", 2: "Мелкая бытовая техника для дома"},
    ),
    Override(
        {2: "Бытовая техника", 3: "Холодильники"},
        {1: "Бытовая техника", 2: "Крупная бытовая техника"},
    ),
    Override(
        {2: "Бытовая техника", 3: "Техника по уходу за собой"},
        {1: "Бытовая техника", 2: "Техника по уходу за собой", 3: None},
    ),
    Override({2: "Бытовая техника"}, {1: "Бытовая техника", 2: None}),
    Override({2: "Музыкальные инструменты"}, {1: "Досуг"}),
    Override({2: "Аксессуары для компьютеров"}, {1: "Ноутбуки и компьютеры"}),
    Override({3: "Пневматический инструмент"}, {2: "Пневматический инструмент", 3: None}),
    Collapse(3),
    Override(
        {4: "Видеорегистраторы"},
        {1: "Автотовары", 2: "Автоэлектроника", 3: "Видеорегистраторы", 4: None},
    ),
    Collapse(4),
    Override({3: "Мангалы и грили"}, {1: "Активный отдых и спорт ", 2: "Кемпинг и туризм "}),
    Override({3: "Блоки бесперебойного питания"}, {2: "Периферия"}),
    Override({3: "Компьютерные мыши"}, {2: "Периферия"}),
    Override({3: "Мониторы"}, {1: "Ноутбуки и компьютеры", 2: "Периферия"}),
    Override({3: "Ноутбуки и нетбуки"}, {2: "Компьютеры"}),
    Override({3: "Палки для ходьбы"}, {2: "Летний спорт"}),
)


def _first(rules: list[tuple[Column, Column]], default: Column) -> Column:
    if not rules:
        return default
    chain = F.when(*rules[0])
    for condition, value in rules[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def apply_steps(df: DataFrame, levels: Sequence[str], steps: Sequence[Step]) -> DataFrame:
    """For each level the first step that speaks about it decides. A path whose
    top title is missing moves up by one before anything else."""
    n = len(levels)
    title = {k: F.col(name) for k, name in enumerate(levels, 1)}
    below = {k: title.get(k + 1, F.lit(None).cast("string")) for k in range(1, n + 1)}
    headless = title[1].isNull() & title[2].isNotNull()
    out = {}
    for k, name in enumerate(levels, 1):
        rules = [(headless, below[k])]
        for step in steps:
            if isinstance(step, Collapse):
                if k >= step.level:
                    rules.append((title[step.level - 1] == title[step.level], below[k]))
            elif k in step.then:
                condition = F.lit(True)
                for at, text in step.when.items():
                    condition = condition & (title[at] == text)
                rules.append((condition, F.lit(step.then[k]).cast("string")))
        out[name] = _first(rules, title[k])
    return df.withColumns(out)


def close_gaps(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Third level equal to its parent or missing above a fourth: move up by one;
    else a missing fourth level above a fifth: move up by one from there."""
    title = {k: F.col(name) for k, name in enumerate(levels, 1)}
    below = {k: title.get(k + 1, F.lit(None).cast("string")) for k in title}
    third = (title[2] == title[3]) | (title[3].isNull() & title[4].isNotNull())
    fourth = title[4].isNull() & title[5].isNotNull()
    out = {levels[2]: _first([(third, below[3])], title[3])}
    for k in (4, 5):
        out[levels[k - 1]] = _first([(third, below[k]), (fourth, below[k])], title[k])
    return df.withColumns(out)


def repair_taxonomy(
    df: DataFrame, levels: Sequence[str], steps: Sequence[Step] = CATALOGUE_STEPS
) -> DataFrame:
    """Five title columns: shift, overrides and collapses, then gaps."""
    return close_gaps(apply_steps(df, levels, steps), levels)
