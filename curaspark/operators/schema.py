"""Column names and schemas: cleaning, resolution, required columns, fixed output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions import text

#: Characters that are taken out of column names.
INVISIBLE = ("\ufeff", "\u200b", "\xa0")


def clean_name(name: str) -> str:
    """A name stripped, without invisible characters (a no-break space within it goes, too)."""
    name = str(name).strip()
    for c in INVISIBLE:
        name = name.replace(c, "")
    return name


def clean_names(df: DataFrame) -> DataFrame:
    """df with cleaned column names."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def resolve(df: DataFrame, candidates: Sequence[str], requested: str | None = None) -> str:
    """The requested column (its name cleaned first), which must exist, or the first candidate that does."""
    if requested:
        if (name := clean_name(requested)) in df.columns:
            return name
        raise ValueError(f"column {requested!r} was not found; available: {df.columns}")
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of the columns {list(candidates)} was found; available: {df.columns}")


def loose(name: str) -> str:
    """A name without case, spaces and underscores."""
    return str(name).lower().replace(" ", "").replace("_", "")


def resolve_loosely(df: DataFrame, candidates: Sequence[str], requested: str | None = None) -> str:
    """The requested column, matched exactly, or the first candidate that a column's loose name equals; of several such columns
    the last."""
    if requested:
        if requested in df.columns:
            return requested
        raise ValueError(f"column {requested!r} was not found; available: {df.columns}")
    by_name = {loose(c): c for c in df.columns}
    for c in candidates:
        if loose(c) in by_name:
            return by_name[loose(c)]
    raise ValueError(f"no column is named like any of {list(candidates)}; available: {df.columns}")


def require(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """df, if it has all the columns named; an error that lists the missing ones otherwise."""
    if missing := [c for c in names if c not in df.columns]:
        raise ValueError(f"missing required columns: {', '.join(missing)}; available: {', '.join(df.columns)}")
    return df


def quoted(name: str) -> Column:
    """A column by its exact name, dots and signs included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fixed(df: DataFrame, schema: Sequence[tuple[str, str]]) -> DataFrame:
    """Exactly the columns of schema (name, type) in its order; null where df lacks one; others go."""
    return df.select(*[(quoted(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in schema])


def typed(df: DataFrame, *, numbers: Sequence[str] = (), integers: Sequence[str] = ()) -> DataFrame:
    """Text columns as read from CSV: missing-value tokens become null, the named columns numbers (null where they don't read as
    such) or whole numbers."""

    def one(name: str) -> Column:
        c = quoted(name)
        if dict(df.dtypes)[name] != "string":
            return c
        c = text.na_to_null(c)
        if name in numbers:
            c = text.number(c)
        elif name in integers:
            c = text.number(c).try_cast("long")
        return c.alias(name)

    return df.select(*[one(n) for n in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """df with null for NaN in floating-point columns: medians skip nulls, not NaN."""
    return df.select(*[F.nanvl(quoted(n), F.lit(None).cast(t)).alias(n) if t in ("double", "float") else quoted(n) for n, t in df.dtypes])


def renamed_in_place(df: DataFrame, old: str, new: str, value: Column | None = None) -> DataFrame:
    """df with a column under a new name (and with a new value), where it stood."""
    return df.select(*[((value if value is not None else quoted(c)).alias(new) if c == old else quoted(c)) for c in df.columns])
