"""Medians of several columns for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions import text

from .schema import quoted, require


def group_medians(df: DataFrame, key: str, columns: Sequence[str], *, order: Column | None = None, count: str = "n_source_rows") -> DataFrame:
    """key, count and the exact median of each column, nulls and NaN skipped column by column, null where nothing is left.

    Text columns are read as numbers (null where they are none). A text key is stripped; rows whose key is null or empty go. With
    `order` (such as a row position), groups come in the order of their first rows.
    """
    kinds = dict(require(df, [key, *columns]).dtypes)
    k = text.strip(quoted(key)) if kinds[key] == "string" else quoted(key)
    values = []
    for c in columns:
        v = text.number(quoted(c)) if kinds[c] == "string" else quoted(c).cast("double")
        values.append(F.nanvl(v, F.lit(None).cast("double")).alias(c))
    rows = df.select(k.alias(key), *values, *([order.alias("__order")] if order is not None else []))
    usable = quoted(key).isNotNull() & (quoted(key) != "") if kinds[key] == "string" else quoted(key).isNotNull()
    rows = rows.where(usable)
    first = [F.min("__order").alias("__order")] if order is not None else []
    out = rows.groupBy(quoted(key)).agg(F.count("*").alias(count), *[F.median(quoted(c)).alias(c) for c in columns], *first)
    return out.orderBy("__order").drop("__order") if order is not None else out
