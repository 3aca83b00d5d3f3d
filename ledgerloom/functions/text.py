"""Text columns: paths, slices, phones, case, whitespace."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def braced_list(col: Column, drop: str | None = None) -> Column:
    """``'{a,b,c}'`` to an array; ``drop`` is removed from the text first."""
    text = F.translate(col, "{}", "")
    if drop:
        text = F.replace(text, F.lit(drop), F.lit(""))
    return F.split(text, ",")


def level(array: Column, position: int) -> Column:
    """1-based element; NULL when out of range."""
    return F.get(array, F.lit(position - 1))


def path_levels(col: Column, sep: str = "/") -> Column:
    return F.split(col, sep)


def last_segment(col: Column, sep: str = "/") -> Column:
    """What follows the last separator; empty when the text ends in one."""
    return F.regexp_extract(col, f"[^{sep}]*$", 0)


def first_part(col: Column, sep: str = ",") -> Column:
    return F.split_part(col, F.lit(sep), F.lit(1))


#: All kinds of whitespace.
WHITESPACE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]+"


def strip_whitespace(col: Column) -> Column:
    """Remove all kinds of whitespace at both ends."""
    return F.regexp_replace(F.regexp_replace(col, f"^{WHITESPACE}", ""), f"{WHITESPACE}$", "")


def initcap_words(col: Column) -> Column:
    """Capitalise every run of letters and digits, lower-case its rest."""
    runs = F.regexp_extract_all(col, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def extract_between(col: Column, start: str, end: str) -> Column:
    """Text between the first ``start`` and the first ``end`` after it; NULL if either is missing."""
    after = F.locate(start, col) + len(start)
    stop = F.locate(end, F.substr(col, after))
    found = (F.locate(start, col) > 0) & (stop > 0)
    return F.when(found, F.substr(col, after, stop - 1))


def contains_like(col: Column, pattern: str) -> Column:
    """Case-folded LIKE."""
    return F.lower(col).like(pattern)


def phone_digits(col: Column) -> Column:
    """Drop plus signs, blanks and dashes."""
    return F.translate(col, "+ -", "")


def normalise_phone(col: Column) -> Column:
    """Bare digits with the country prefix 7, at most 11 of them."""
    digits = phone_digits(col)
    size = F.length(digits)
    return (
        F.when(digits.startswith("8"), F.concat(F.lit("7"), F.substring(digits, F.lit(2), F.length(digits))))
        .when(size == 10, F.concat(F.lit("7"), digits))
        .when(size > 11, F.right(digits, F.lit(11)))
        .otherwise(digits)
    )


def title_number(col: Column, word: int = 3) -> Column:
    """The given word of a title as a number; NULL when it is not one."""
    words = F.split(strip_whitespace(col), r"\s+")
    return F.get(words, F.lit(word - 1)).try_cast("int")
