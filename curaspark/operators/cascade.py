"""One primary identifier for each row, from records looked up by one or several keys in a cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.functions import text

from .dedup import FEW_ROWS, sized
from .schema import quoted

#: The identifiers by precedence, and fields that come along for context.
ORDER = ("doi", "pubmed_id", "patent_id")
CONTEXT = ("journal", "year", "title", "doc_type")


def requested_ids(df: DataFrame, column: str, row: str | None = None) -> DataFrame:
    """The distinct ids in a column of comma-separated lists; with a position column, first_at for the order of first places."""
    ids = df.select(F.explode(text.tokens(quoted(column).cast("string"))).alias("id"), *([F.col(row).alias("__row")] if row else []))
    return ids.groupBy("id").agg(F.min("__row").alias("first_at")) if row else ids.distinct()


def lookup_lists(df: DataFrame, column: str, records: DataFrame, key: str, fields: Sequence[str], row: str, *, separator: str = "|", limit: int = FEW_ROWS) -> DataFrame:
    """df with a text column for each field: the cleaned values of the records that the row's ids name, in the order of the ids, each
    value once, joined by the separator; empty without one. A repeated record counts once, the first by its values."""
    one = records.select(quoted(key).cast("string").alias("__id"), *[text.clean(quoted(f)).alias(f"__{i}") for i, f in enumerate(fields)])
    one = sized(one.where("__id IS NOT NULL").groupBy("__id").agg(*[F.min(f"__{i}").alias(f"__{i}") for i in range(len(fields))]), limit)
    ids = df.select(F.col(row).alias("__row"), F.posexplode(text.tokens(quoted(column).cast("string"))).alias("__at", "__id"))
    found = ids.join(one, "__id").groupBy("__row")
    values = [F.array_sort(F.collect_list(F.struct("__at", F.col(f"__{i}").alias("v")))).alias(f"__{i}") for i in range(len(fields))]
    found = found.agg(*values)
    joined = df.join(found, F.col(row) == F.col("__row"), "left")
    texts = [F.coalesce(text.distinct_join(F.transform(f"__{i}", lambda x: x["v"]), separator), F.lit("")).alias(f) for i, f in enumerate(fields)]
    return joined.select(*[quoted(c) for c in df.columns if c not in fields], *texts)


def select_reference(df: DataFrame, order: Sequence[str] = ORDER, *, value: str = "reference_id", kind: str = "reference_type") -> DataFrame:
    """df with the first non-empty field by precedence and its name; empty and `unresolved` without one."""
    v, k = text.precedence([(f, quoted(f)) for f in order])
    return df.withColumn(value, v).withColumn(kind, k)


def breakdown(df: DataFrame, column: str, categories: Sequence[str], digits: int = 1) -> DataFrame:
    """How many rows and what percentage have each category, 0 for those without rows, in the given order; of no rows 0 percent."""
    counts = df.groupBy(quoted(column).alias("__c")).agg(F.count("*").alias("n"))
    # The whole is the sum of a few group counts, those of other categories included.
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    listed = df.sparkSession.createDataFrame(list(enumerate(categories)), "at int, category string")
    out = listed.join(counts, F.col("category") == F.col("__c"), "left").join(F.broadcast(total))
    n = F.coalesce("n", F.lit(0))
    percent = F.when(F.col("total") > 0, F.round(100 * n / F.col("total"), digits)).otherwise(F.lit(0.0))
    return out.select("at", "category", n.alias("n"), percent.alias("percent")).orderBy("at").drop("at")
