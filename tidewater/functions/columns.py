"""Column expressions shared by the operators and workloads. All stay inside code generation."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp patterns tried in this order.
TIMESTAMP_PATTERNS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "M/d/yyyy h:mm:ss a")
KM_PER_MILE = 1.60934


def least_length(pattern: str) -> int:
    """Code points that a text needs at least to be read by a timestamp pattern: numbers have all their letters' digits, AM and
    PM two, anything not known here one; optional and quoted parts are not counted."""
    if set(pattern) & set("[]'"):
        return 0
    runs = [m.group() for m in re.finditer(r"([A-Za-z])\1*|.", pattern, re.DOTALL)]
    return sum(2 if r == "a" else len(r) if r == "yyyy" or r in ("MM", "dd", "HH", "hh", "mm", "ss") else 1 for r in runs)


def parse_timestamp_multi(text: Column, patterns: tuple[str, ...] = TIMESTAMP_PATTERNS) -> Column:
    """The time by the first of the patterns that reads the text, in the given order; else NULL.

    A failed parse is slow, so a pattern is tried only on text that is long enough for it and holds its date separator.
    """
    def tried(pattern: str) -> Column:
        separator = next((ch for ch in pattern if not ch.isalpha()), None)
        parsed = F.try_to_timestamp(text, F.lit(pattern))
        fits = F.length(text) >= least_length(pattern)
        return F.when(fits if separator is None else fits & F.contains(text, F.lit(separator)), parsed)

    return F.coalesce(*[tried(p) for p in patterns])


def parse_number_grouped(text: Column) -> Column:
    """``1,234.50`` to 1234.5; text that is no number becomes NULL."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def parse_integer(text: Column) -> Column:
    """``2`` and ``2.0`` to 2; text that is no whole number in range becomes NULL."""
    number = text.try_cast("double")
    return F.coalesce(text.try_cast("int"), F.when(number == F.floor(number), number.try_cast("int")))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def amount_with_fallback(price: Column, amount: Column) -> Column:
    """Price, else amount, else 0; a price of 0 stays 0."""
    return F.coalesce(price, amount, F.lit(0.0))


def month_key_text(ts: Column) -> Column:
    """First seven characters of the raw text; NULL for a missing or empty text."""
    return F.substring(F.nullif(ts, F.lit("")), 1, 7)


def floor_div(left: Column, right: Column) -> Column:
    """Integer division that truncates; both sides integers, result bigint."""
    return F.call_function("div", left, right)


def miles_to_thousand_km(miles: Column) -> Column:
    return miles * KM_PER_MILE / 1000


def capitalise(text: Column) -> Column:
    """First letter upper, the rest lower (``initcap`` would act on every word)."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substring(text, 2, 2**31 - 1)))


def composite_code(name: Column, year: Column, prefix: str = "ID-") -> Column:
    """``ID-`` + upper-case name with blanks as underscores + ``-`` + year."""
    return F.concat(F.lit(prefix), F.replace(F.upper(name), F.lit(" "), F.lit("_")), F.lit("-"), year.cast("string"))


def split_literal(text: Column, sep: str, limit: int = -1) -> Column:
    """Pieces between literal separators."""
    if len(sep) == 1 and sep not in ".$|()[{^?*+\\":  # Java splits at one plain character without a pattern
        return F.split(text, sep, limit)
    return F.split(text, "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E", limit)


def split_columns(text: Column, sep: str, width: int, names: list[str], limit: int = -1) -> list[Column]:
    """Pieces as ``width`` columns, short rows padded with NULL; ``limit`` bounds the pieces as in ``split``.

    ``sep`` is literal text. Pieces beyond ``width`` have no column: give a ``limit``, or let ``split_expand`` find the width.
    """
    pieces = split_literal(text, sep, limit)
    return [F.get(pieces, F.lit(i)).alias(names[i]) for i in range(width)]


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
