"""Parsers of the dates and numbers that raw tables carry as text.

A parser says which texts it takes, by a pattern of the whole text, and what they mean. It
takes none in part and rounds nothing, unless it is asked to. Profiles name chains of parsers.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, functions as F, types as T

#: Decimal digits that a double holds whatever they are.
DOUBLE_DIGITS = 15
#: A blank text is a missing value, not a wrong one.
BLANK = r"^[\s ]*\z"


class Parser(NamedTuple):
    """``parse`` gives the typed value of a text without outer white space, NULL if it is none."""

    name: str
    parse: Callable[[Column], Column]


def is_blank(text: Column) -> Column:
    return text.rlike(BLANK)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s ]+|[\s ]+\z", F.lit(""))


def date_as(pattern: str) -> Parser:
    """Whole dates of a pattern out of yyyy, MM, dd and what parts them; days that exist only."""
    digits = {"yyyy": r"\d{4}", "MM": r"\d{2}", "dd": r"\d{2}"}
    parts = re.split("(yyyy|MM|dd)", pattern)
    if sorted(p for p in parts if p in digits) != sorted(digits):
        raise ValueError(f"a date pattern has yyyy, MM and dd once each, not {pattern!r}")
    whole = "^" + "".join(digits.get(p) or re.escape(p) for p in parts) + r"\z"

    def parse(text: Column) -> Column:
        return F.when(text.rlike(whole), F.try_to_timestamp(text, F.lit(pattern)).cast("date"))

    return Parser(f"date {pattern}", parse)


def _plain_number(text: Column, mark: str, grouping: str) -> Column:
    """The number with a point as its mark and no grouping, NULL if the text is none."""
    m, g = re.escape(mark), re.escape(grouping)
    grouped = rf"|\d{{1,3}}({g}\d{{3}})+({m}\d+)?" if grouping else ""
    shape = rf"^[+-]?(\d+({m}\d*)?|{m}\d+{grouped})([eE][+-]?\d{{1,3}})?\z"
    bare = F.regexp_replace(text, g, F.lit("")) if grouping else text
    return F.when(text.rlike(shape), bare if mark == "." else F.translate(bare, mark, "."))


def _digits(number: Column) -> Column:
    """Decimal digits of a plain number that count: none in front or, before an exponent, behind."""
    mantissa = F.regexp_replace(number, r"[eE].*|[+.-]", F.lit(""))
    return F.char_length(F.regexp_replace(mantissa, r"^0+|0+\z", F.lit("")))


def number_as(mark: str = ".", grouping: str = "", rounded: bool = False) -> Parser:
    """Numbers with a decimal mark and, in groups of three, a grouping mark, as doubles.

    Numbers of more digits than a double holds whatever they are (DOUBLE_DIGITS), and those
    out of its range, are not taken unless they may be ``rounded``.
    """
    if not mark or mark == grouping or any(c in "0123456789+-eE" for c in mark + grouping):
        raise ValueError(f"marks {mark!r} and {grouping!r} cannot be told from digits or each other")

    def parse(text: Column) -> Column:
        number = _plain_number(text, mark, grouping)
        value = number.try_cast("double")
        fits = F.abs(value) < F.lit(float("inf"))
        if not rounded:
            # a short text needs no count of its digits
            short = F.char_length(number) <= DOUBLE_DIGITS
            fits = fits & (short | (_digits(number) <= DOUBLE_DIGITS)) & ((value != 0) | (_digits(number) == 0))
        return F.when(fits, value)

    return Parser(f"number {mark}{grouping}" + (" rounded" if rounded else ""), parse)


def decimal_as(precision: int, scale: int, mark: str = ".", grouping: str = "") -> Parser:
    """Numbers as exact decimals; those of more places on either side are not taken."""
    kind = T.DecimalType(precision, scale)

    def parse(text: Column) -> Column:
        number = _plain_number(text, mark, grouping)
        wide = number.try_cast(T.DecimalType(38, min(38, scale + 9)))
        return F.when(wide == wide.try_cast(kind), wide.try_cast(kind))

    return Parser(f"decimal {mark}{grouping} ({precision},{scale})", parse)


def whole_as(grouping: str = "") -> Parser:
    """Whole numbers within the range of an integer."""
    g = re.escape(grouping)
    shape = r"^[+-]?(\d+" + (rf"|\d{{1,3}}({g}\d{{3}})+" if grouping else "") + r")\z"

    def parse(text: Column) -> Column:
        bare = F.regexp_replace(text, g, F.lit("")) if grouping else text
        return F.when(text.rlike(shape), bare.try_cast("int"))

    return Parser(f"whole {grouping}".strip(), parse)


#: What a profile reads where it names no parsers, by the kind of a field.
DEFAULT_PARSERS: Mapping[str, tuple[Parser, ...]] = {
    "date": (date_as("yyyy-MM-dd"),),
    "float": (number_as("."),),
    "short": (whole_as(),),
    "integer": (whole_as(),),
}


def parsed(text: Column, parsers: Sequence[Parser]) -> tuple[Column, Column]:
    """What the first parser that takes the text makes of it, and that parser's name."""
    bare = trimmed(text)
    return first_read([p.parse(bare) for p in parsers], parsers)


def first_read(values: Sequence[Column], parsers: Sequence[Parser]) -> tuple[Column, Column]:
    """Of what each of the parsers makes of a text the first that is a value, and that parser's name."""
    names = [F.when(v.isNotNull(), F.lit(p.name)) for v, p in zip(values, parsers)]
    return F.coalesce(*values), F.coalesce(*names)
