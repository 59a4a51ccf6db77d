"""Text expressions: Unicode strip, whitespace keys, token lists, guarded numbers, precedence, status strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that a CSV reader takes for missing, matched exactly.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
#: Whitespace as of Python's str.strip(): Unicode whitespace and the four separators U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"
#: What a number may look like; Spark's cast would also take suffixes and hexadecimal forms.
NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"


def strip(c: Column) -> Column:
    """c without whitespace at its ends, tabs, line breaks and Unicode spaces included."""
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column) -> Column:
    """c with each run of whitespace as one space, none at its ends: a key that ignores layout."""
    return strip(F.regexp_replace(c, f"(?U){SPACE}+", " "))


def blank_to_null(c: Column) -> Column:
    """c stripped; null where nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def na_to_null(c: Column) -> Column:
    """Null for the tokens that stand for a missing value."""
    return F.when(~c.isin(*NA_TOKENS), c)


def clean(c: Column) -> Column:
    """c stripped as text; empty for null and for the words none and nan in any case."""
    s = strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(F.lower(s).isin("none", "nan"), F.lit("")).otherwise(s)


def tokens(c: Column, separator: str = ",") -> Column:
    """The stripped, non-empty parts of a cell, in order; none for null."""
    parts = F.transform(F.split(c, separator), lambda x: strip(x))
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def distinct_join(values: Column, separator: str = "|") -> Column:
    """The non-empty values of an array, each once, in the order of their first places, joined."""
    return F.array_join(F.array_distinct(F.filter(values, lambda x: x != "")), separator)


def number(c: Column) -> Column:
    """A finite or infinite double where c reads as a number, else null; overflow, NaN and other text are null."""
    value = F.when(c.rlike(NUMBER), c.try_cast("double"))
    overflow = F.abs(value) == float("inf")
    return F.when(~F.isnan(value) & (~overflow | c.rlike("(?i)inf")), value)


def precedence(fields: Sequence[tuple[str, Column]], none: str = "unresolved") -> tuple[Column, Column]:
    """The first non-empty field's value and name, in the given order; empty and `none` if all are empty."""
    value = F.coalesce(*[F.nullif(c, F.lit("")) for _, c in fields], F.lit(""))
    name = F.coalesce(*[F.when(c != "", F.lit(n)) for n, c in fields], F.lit(none))
    return value, name


def status_join(columns: Sequence[Column], separator: str = ";") -> Column:
    """The columns' texts joined, without nulls, empty ones and the word nan."""
    return F.concat_ws(separator, *[F.when(~c.isin("", "nan"), c) for c in columns])


def utc_stamp(c: Column | None = None) -> Column:
    """A timestamp as text such as 2024-01-31T08:00:00Z (the session's time zone is UTC)."""
    return F.date_format(F.current_timestamp() if c is None else c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def preview(c: Column, length: int) -> Column:
    """The first characters of c."""
    return F.substring(c, 1, length)


def prompt(mode: Column, protocol: Column, protein: Column, assay: Column) -> Column:
    """A generator's user message; mode `validation` asks for JSON, any other for text."""
    kind = F.when(mode == "validation", F.lit("JSON")).otherwise(F.lit("TEXT"))
    return F.concat(
        F.lit("Output mode: "), kind, F.lit("\n\nexperimental_protocol:\n"), protocol,
        F.lit("\n\nprotein_name: "), protein, F.lit("\nassay_name: "), assay,
    )
