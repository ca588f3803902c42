"""Text and number expressions used by the cleaner."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every character that Unicode counts as white space.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip_ends(c: Column) -> Column:
    """Cut every kind of white space at both ends (plain ``trim`` cuts spaces only).

    Texts that begin and end with a visible ASCII character, nearly all of them, skip the character search.
    """
    text = c.cast("string")
    visible = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    return F.when(visible, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def strip_all(c: Column) -> Column:
    """Remove every white-space character."""
    return F.translate(c.cast("string"), WHITESPACE, "")


def junk_to_null(c: Column, junk: Iterable[str]) -> Column:
    """Null for texts on the junk list, whatever their case."""
    words = list(junk)
    return F.when(~F.lower(c).isin(words), c) if words else c


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


# What counts as a number in a text; Java's spellings ``1d`` and ``1f`` and ``nan`` do not.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*$"


def to_num(c: Column) -> Column:
    """Lenient text-to-double: null for anything that is not a number, and for NaN.

    A failing cast costs an exception inside the JVM, so only texts that spell a number reach it.
    """
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text).try_cast("double")


def cap_to_null(c: Column, cap: float) -> Column:
    """Null for values strictly above the cap."""
    return F.when(c <= F.lit(float(cap)), c)


def invert_binary(c: Column) -> Column:
    """1 becomes 0, everything else becomes 1."""
    return F.when(c == 1, F.lit(0)).otherwise(F.lit(1)).cast("int")


def tokens(c: Column) -> Column:
    """Lower-case alphanumeric tokens of a text, in order."""
    return F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda t: t != "")


def safe_name(c: Column) -> Column:
    """File- and registry-safe spelling: ``a + b c`` becomes ``a-b-c``."""
    dashed = F.regexp_replace(F.regexp_replace(c, r"\s*\+\s*", "-"), " ", "-")
    return F.regexp_replace(dashed, r"[^A-Za-z0-9_\-]", "")
