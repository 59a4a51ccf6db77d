"""One existing row for each group: the one nearest to the group's median, by one or two paths."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .schema import quoted


@dataclass(frozen=True)
class Path:
    """Rows that take part (a predicate; null counts as false) and the value whose median counts."""

    name: str
    rows: Column
    value: Column

    @property
    def member(self) -> Column:
        return F.coalesce(self.rows & self.value.isNotNull(), F.lit(False))


def _keys(keys: Sequence[str]) -> list[Column]:
    return [quoted(k) for k in keys]


def medoids(df: DataFrame, keys: Sequence[str], value: Column, ties: Sequence[Column], *, strategy: str = "window") -> DataFrame:
    """The row of each group whose value is nearest to the group's median, with group_rows and group_median.

    Null keys form groups; rows with a null value are left out. Of rows equally near the first by `ties` (give an order with
    nulls last, ending in a position) stays. strategy `window` shuffles once and holds a group in one task; `aggregate` counts by
    partial aggregates and joins medians back, which AQE can split, for groups that are a large part of the rows.
    """
    rows = df.where(value.isNotNull()).withColumn("__x", value.cast("double"))
    if strategy == "aggregate":
        m = rows.groupBy(*_keys(keys)).agg(F.median("__x").alias("group_median"), F.count("*").alias("group_rows"))
        m = m.select(*[quoted(k).alias(f"__k{i}") for i, k in enumerate(keys)], "group_median", "group_rows")
        on = F.lit(True)
        for i, k in enumerate(keys):
            on = on & quoted(k).eqNullSafe(F.col(f"__k{i}"))
        joined = rows.join(m, on)
        order = F.struct(F.abs(F.col("__x") - F.col("group_median")), *_order_struct(ties))
        best = joined.groupBy(*_keys(keys)).agg(F.min_by(F.struct(*df.columns, "group_rows", "group_median"), order).alias("r"))
        return best.select("r.*")
    w = Window.partitionBy(*_keys(keys))
    rows = rows.withColumn("group_median", F.median("__x").over(w)).withColumn("group_rows", F.count("*").over(w))
    first = F.row_number().over(w.orderBy(F.abs(F.col("__x") - F.col("group_median")), *ties))
    return rows.withColumn("__n", first).where("__n = 1").select(*_keys(df.columns), "group_rows", "group_median")


def _order_struct(ties: Sequence[Column]) -> list[Column]:
    """The order of ascending columns, nulls last, as struct fields."""
    out = []
    for i, c in enumerate(ties):
        out += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    return out


#: Rows of a group from which strategy `auto` takes partial aggregates instead of a window.
LARGE_GROUP = 1_000_000


def _joined(df: DataFrame, keys: Sequence[str], groups: DataFrame) -> DataFrame:
    """df with the columns of groups (one row for each value of keys, nulls among them)."""
    values = [c for c in groups.columns if c not in keys]
    named = groups.select(*[quoted(k).alias(f"__k{i}") for i, k in enumerate(keys)], *values)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & quoted(k).eqNullSafe(F.col(f"__k{i}"))
    return df.join(named, on).drop(*[f"__k{i}" for i in range(len(keys))])


def chosen(df: DataFrame, keys: Sequence[str], strategy: str) -> str:
    """The strategy itself, or for `auto` the one that fits the largest group, as counted."""
    if strategy != "auto":
        return strategy
    largest = df.groupBy(*_keys(keys)).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    return "aggregate" if largest >= LARGE_GROUP else "window"


def two_paths(df: DataFrame, keys: Sequence[str], paths: Sequence[Path], ties: Sequence[Column], *, keep: str = "keep", strategy: str = "window") -> DataFrame:
    """df with member and kept flags of each path (`<name>_member`, `<name>_kept`) and keep.

    Within each path, one row of each group is kept as of medoids(). A row stays if any path keeps it, or if it is on none. All
    paths share the grouping, so there is one exchange with strategy `window`, which holds a group in one task. `aggregate` takes
    medians and nearest rows by partial aggregates and joins both back, for groups that are a large part of the rows; `auto` counts
    the largest group and chooses. With those two, ties are plain columns, ascending with nulls last, that end in a position.
    """
    for p in paths:
        df = df.withColumn(f"{p.name}_member", p.member).withColumn(f"__{p.name}", F.when(p.member, p.value.cast("double")))
    off = {p.name: F.abs(F.col(f"__{p.name}") - F.col(f"__{p.name}_m")) for p in paths}
    if chosen(df, keys, strategy) == "aggregate":
        df = _joined(df, keys, df.groupBy(*_keys(keys)).agg(*[F.median(f"__{p.name}").alias(f"__{p.name}_m") for p in paths]))
        for p in paths:
            df = df.withColumn(f"__{p.name}_o", F.when(F.col(f"{p.name}_member"), F.struct(off[p.name].alias("off"), *_order_struct(ties))))
        df = _joined(df, keys, df.groupBy(*_keys(keys)).agg(*[F.min(f"__{p.name}_o").alias(f"__{p.name}_b") for p in paths]))
        for p in paths:
            df = df.withColumn(f"{p.name}_kept", F.col(f"{p.name}_member") & F.col(f"__{p.name}_o").eqNullSafe(F.col(f"__{p.name}_b")))
    else:
        w = Window.partitionBy(*_keys(keys))
        ties = ties if strategy == "window" else [t.asc_nulls_last() for t in ties]
        for p in paths:
            df = df.withColumn(f"__{p.name}_m", F.median(f"__{p.name}").over(w))
        for p in paths:
            first = F.row_number().over(w.orderBy(~F.col(f"{p.name}_member"), off[p.name], *ties))
            df = df.withColumn(f"{p.name}_kept", F.col(f"{p.name}_member") & (first == 1))
    member, kept = F.lit(False), F.lit(False)
    for p in paths:
        member, kept = member | F.col(f"{p.name}_member"), kept | F.col(f"{p.name}_kept")
    return df.withColumn(keep, ~member | kept).drop(*[f"__{p.name}{s}" for p in paths for s in ("", "_m", "_o", "_b")])


def counts(flagged: DataFrame, paths: Sequence[Path], *, keep: str = "keep") -> DataFrame:
    """One row of counts over two_paths(): original_rows, removed_rows, remaining_rows, <path>_removed, on_no_path, and
    on_no_path_by_sums, which takes off rows on several paths more than once."""
    member, sums = F.lit(False), F.lit(0)
    for p in paths:
        member = member | F.col(f"{p.name}_member")
    per_path = [F.count_if(F.col(f"{p.name}_member") & ~F.col(f"{p.name}_kept")).alias(f"{p.name}_removed") for p in paths]
    for p in paths:
        sums = sums + F.count_if(f"{p.name}_member")
    return flagged.agg(
        F.count("*").alias("original_rows"),
        F.count_if(~F.col(keep)).alias("removed_rows"),
        F.count_if(keep).alias("remaining_rows"),
        *per_path,
        F.count_if(~member).alias("on_no_path"),
        (F.count("*") - sums).alias("on_no_path_by_sums"),
    )


def summary(one_row: DataFrame, lines: Sequence[tuple[str, Column]]) -> DataFrame:
    """A Metric/Value table of a one-row aggregate, in the order of lines, values as text."""
    table = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(m).alias("Metric"), v.cast("string").alias("Value")) for i, (m, v) in enumerate(lines)])
    return one_row.select(F.explode(table).alias("l")).orderBy("l.n").select("l.Metric", "l.Value")


def first_hit(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group of a ranked result list."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
