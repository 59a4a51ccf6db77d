"""Distinct keys before expensive work, results mapped back to every row, and checks that nothing was lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import quoted

#: Dimension tables up to so many rows are broadcast; larger ones are joined by shuffle.
FEW_ROWS = 100_000


def sized(dim: DataFrame, limit: int = FEW_ROWS) -> DataFrame:
    """dim with a broadcast hint if a count shows it to be small, else as it is."""
    return F.broadcast(dim) if dim.limit(limit + 1).count() <= limit else dim


def first_seen(df: DataFrame, keys: Sequence[str], order: Column, firsts: Sequence[str] = ()) -> DataFrame:
    """Each distinct key with first_at (its smallest order) and the named columns of the row there; by partial aggregates."""
    aggs = [F.min(order).alias("first_at")]
    if firsts:
        aggs.append(F.min_by(F.struct(*[quoted(c) for c in firsts]), order).alias("__f"))
    out = df.groupBy(*[quoted(k) for k in keys]).agg(*aggs)
    return out.select(*[quoted(k) for k in keys], "first_at", *[F.col(f"__f.`{c}`").alias(c) for c in firsts])


def map_back(df: DataFrame, results: DataFrame, keys: Sequence[str], *, defaults: dict[str, object] | None = None, limit: int = FEW_ROWS) -> DataFrame:
    """df with the columns of results on null-safe equal keys; as many rows as before, defaults where there is no result.

    results is made unique on its keys first, so no row is multiplied.
    """
    values = [c for c in results.columns if c not in keys]
    one = results.dropDuplicates(list(keys)).select(*[quoted(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[quoted(c).alias(f"__v{i}") for i, c in enumerate(values)], F.lit(True).alias("__hit"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & quoted(k).eqNullSafe(F.col(f"__k{i}"))
    joined = df.join(sized(one, limit), on, "left")
    defaults = defaults or {}

    def value(i: int, c: str) -> Column:
        v = F.col(f"__v{i}")
        return (F.when(F.col("__hit"), v).otherwise(F.lit(defaults[c])) if c in defaults else v).alias(c)

    return joined.select(*[quoted(c) for c in df.columns if c not in values], *[value(i, c) for i, c in enumerate(values)])


def unmatched(requested: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    """The requested keys that nothing was returned for."""
    return requested.select(quoted(key)).distinct().join(returned.select(quoted(key)), key, "left_anti")


def inconsistent(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Groups with more than one distinct value, and how many (n_values); rows with a null key don't count, nor null values."""
    there = F.lit(True)
    for k in keys:
        there = there & quoted(k).isNotNull()
    return df.where(there).groupBy(*[quoted(k) for k in keys]).agg(F.count_distinct(quoted(value)).alias("n_values")).where("n_values > 1")


def duplication(df: DataFrame, keys: Sequence[str], digits: int = 3) -> DataFrame:
    """One row: n_rows, n_keys and rows_per_key, rounded; 0 keys count as 1."""
    distinct = df.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("n"))
    out = distinct.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"))
    return out.withColumn("rows_per_key", F.round(F.col("n_rows") / F.greatest("n_keys", F.lit(1)), digits))


class InvariantError(AssertionError):
    """A check on a finished table failed."""


def check_annotated(before: DataFrame, after: DataFrame, *, row: str, filled: str | None = None, same: Sequence[str] = ()) -> None:
    """Raise unless after has the rows of before, each once (by the position column `row`), with equal `same` columns, and no null or
    empty value in `filled`. One pass over the join of positions; nothing but counts reaches the driver."""
    b = before.select(F.col(row).alias("__row"), *[quoted(c).alias(f"__{i}") for i, c in enumerate(same)])
    j = b.join(after, F.col("__row") == F.col(row), "full_outer")
    bad = [F.count_if(F.col("__row").isNull()).alias("added"), F.count_if(F.col(row).isNull()).alias("lost")]
    bad += [F.count_if(~F.col(f"__{i}").eqNullSafe(quoted(c)) & F.col(row).isNotNull() & F.col("__row").isNotNull()).alias(f"changed in {c}") for i, c in enumerate(same)]
    if filled:
        bad.append(F.count_if(F.col(row).isNotNull() & (quoted(filled).isNull() | (quoted(filled) == ""))).alias(f"empty in {filled}"))
    found = {k: v for k, v in j.agg(*bad, (F.count(row) - F.count_distinct(row)).alias("repeated")).first().asDict().items() if v}
    if found:
        raise InvariantError(f"rows {found}")


def check_consistent(df: DataFrame, keys: Sequence[str], value: str) -> None:
    """Raise if rows of one key have different values, with up to three of the keys."""
    if some := inconsistent(df, keys, value).limit(3).collect():
        raise InvariantError(f"keys with several values of {value}: {[r.asDict() for r in some]}")
