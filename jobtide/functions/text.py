"""Text normalisation, pattern matching and code handling."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(c: Column) -> Column:
    return F.trim(c)


def norm(c: Column) -> Column:
    """The form in which all free text is compared: trimmed, lower case."""
    return F.lower(F.trim(c))


def not_blank(c: Column) -> Column:
    """TRUE or FALSE, never NULL, so it can be negated."""
    return c.isNotNull() & (F.trim(c) != "")


def yes_no(c: Column) -> Column:
    """'Y' / 'N' to boolean; anything else is unknown."""
    return F.when(c == "Y", True).when(c == "N", False)


def split_part(c: Column, sep: str, index: int) -> Column:
    """Zero-based piece of a delimited string, NULL past the end."""
    return F.get(F.split(c, re.escape(sep)), index)


def place_part(c: Column, index: int) -> Column:
    """One piece of a 'city, region' string without quotes and outer blanks."""
    return F.trim(F.replace(split_part(c, ",", index), F.lit('"'), F.lit("")))


def soc_code(c: Column) -> Column:
    """Standard occupation code: the detailed code without its two-digit suffix."""
    return F.left(c, F.lit(7))


def soc_prefix(c: Column) -> Column:
    """Major occupation group."""
    return F.left(c, F.lit(2))


def pad_month(c: Column) -> Column:
    """'M3' or 'M03' to '03'."""
    return F.lpad(F.replace(c, F.lit("M"), F.lit("")), 2, "0")


def like_regex(patterns: Iterable[str]) -> str:
    """One regular expression that matches where any of the LIKE patterns does.

    Only ``%`` is a wildcard here. A pattern that starts (ends) with ``%`` needs no anchor on
    that side because ``rlike`` searches. Patterns that begin alike share their beginning, so at
    each position of the text only a few letters are compared instead of every pattern.
    """
    branches = []
    for pattern in patterns:
        body = pattern.strip("%")
        tokens = [".*" if char == "%" else re.escape(char) for char in body]
        branches.append([
            *([] if pattern.startswith("%") else ["^"]),
            *tokens,
            *([] if pattern.endswith("%") else [r"\z"]),
        ])
    return "(?is)" + _merged(branches)


def _merged(branches: list[list[str]]) -> str:
    if not all(branches):
        return ""  # one pattern ends here and matches whatever follows
    by_first: dict[str, list[list[str]]] = {}
    for first, *rest in branches:
        by_first.setdefault(first, []).append(rest)
    parts = [first + _merged(rest) for first, rest in by_first.items()]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def ilike_any(c: Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive LIKE against a whole list in one pass over the string."""
    return c.rlike(like_regex(patterns))
