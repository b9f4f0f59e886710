"""Scalar column helpers: blank tests, lenient number parsing, splitting.

All of them build Catalyst expressions (no Python UDFs), so they stay inside
whole-stage codegen and can be pushed or pruned like any built-in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlumen.functions.util import as_col

# Java's Character.isWhitespace, the definition of "blank" in the log format.
_BLANK_RE = r"\A\p{javaWhitespace}*\z"  # not $: it also matches before a line end
_INT_RE = r"\A[+-]?[0-9]+\z"
# Lower/odd-case inf/nan parse in Spark but are not valid numbers in the log
# format; only the exact spellings NaN / Infinity are numbers there.
_BAD_SPECIAL_RE = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"
_GOOD_SPECIAL_RE = r"^\s*([+-]?Infinity|NaN)\s*$"


def is_blank(c) -> Column:
    """True for null, empty or whitespace-only strings.

    The equality test comes first so that the common empty value is decided
    without running the regular expression (generated code short-circuits).
    """
    c = as_col(c)
    return c.isNull() | (c == F.lit("")) | c.rlike(_BLANK_RE)


def not_blank(c) -> Column:
    c = as_col(c)
    return c.isNotNull() & (c != F.lit("")) & ~c.rlike(_BLANK_RE)


def to_int_or_zero(c) -> Column:
    """Parse a decimal int; anything else (spaces, fractions, overflow) -> 0."""
    c = as_col(c)
    parsed = F.when(c.rlike(_INT_RE), c.try_cast("int"))
    return F.coalesce(parsed, F.lit(0))


def to_double_or_zero(c) -> Column:
    """Parse a double; unparsable text -> 0.0."""
    c = as_col(c)
    # every special spelling contains an "n"; plain numbers skip both regexes
    maybe_special = c.contains("n") | c.contains("N")
    blocked = maybe_special & c.rlike(_BAD_SPECIAL_RE) & ~c.rlike(_GOOD_SPECIAL_RE)
    parsed = F.when(~blocked, c.try_cast("double"))
    return F.coalesce(parsed, F.lit(0.0))


def split_keep_trailing(c, delimiter: str) -> Column:
    """Split on a literal delimiter keeping trailing empty fields."""
    return F.split(as_col(c), _quote(delimiter), -1)


def split_drop_trailing(c, delimiter: str) -> Column:
    """Split like java's String.split(regex): trailing empty fields dropped.

    The delimiter here is a regular expression.
    """
    c = as_col(c)
    stripped = F.regexp_replace(c, "(" + delimiter + ")+$", "")
    return F.split(stripped, delimiter, -1)


def _quote(s: str) -> str:
    specials = set(r".^$|?*+()[]{}\\")
    return "".join("\\" + ch if ch in specials else ch for ch in s)
