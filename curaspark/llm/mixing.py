"""Mixing sources to target weights by Efraimidis-Spirakis keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import few, materialize, spread, without

#: Characters that mark junk; they lower a document's quality weight.
JUNK = "#%*$&!@^~|{}[]<>\\=_+"
#: Weights of the sources in the order of their names, again and again.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source is taken more than so many times.
MOST_EPOCHS = 3
#: Ranges into which a source's keys are dealt at once, and rows of a source that are sorted together at most (but for equal keys,
#: which are counted first).
RANGES, SORTED_ROWS = 1_000, 2_000
#: Source tables up to this many rows are broadcast.
FEW_SOURCES = 10_000


def size_of(text: Column) -> Column:
    """Number of words: runs of characters other than space, tab, line feed, vertical tab, form feed, carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """Quality weight of a document from its text: 1 without junk characters, 0.25 with nothing else; empty or null: 1."""
    n = F.length(text)
    clean = F.length(F.translate(text, JUNK, ""))
    return F.when(n > 0, F.lit(0.25) + F.lit(0.75) * clean / n).otherwise(F.lit(1.0))


def key_of(doc_id: Column, text: Column, weight: Column, seed: int) -> Column:
    """The exponential key -ln(u) / weight, u in (0, 1) from the MD5 of seed and id (where that is null: of the text's MD5); the weight
    is held between 1e-9 and 1e9, a null or NaN counts as 1e-9."""
    name = F.coalesce(doc_id.cast("string"), F.md5(F.encode(text, "UTF-8")), F.lit(""))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 12), 16, 10)
    u = (bits.cast("long").cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))
    return -F.log(u) / F.least(F.greatest(F.nanvl(F.coalesce(weight.cast("double"), F.lit(1e-9)), F.lit(1e-9)), F.lit(1e-9)), F.lit(1e9))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Targets of sources: (source, source_size, ..., target) from (source, source_size, ...).

    Sources in the order of their code points, null last, get `weights` in turn and share the sum of all sizes by them; a
    target stops at `most` times its source's size, and the excess is shared again by weight until none is above. Solved
    exactly: ordered by size over weight, the sources that stop come first. A row per source, so the windows over all of
    them see no more rows than there are sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("*", weight.alias("w")).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    s = (
        s.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("capped", F.sum("cap").over(by_ratio) - F.col("cap"))
        .withColumn("open_w", F.sum("w").over(whole) - F.sum("w").over(by_ratio) + F.col("w"))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_w"))
        .withColumn("open", F.col("level") <= F.col("cap") / F.col("w"))
    )
    # The first source that does not stop sets the level for itself and all after it.
    level = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    target = F.when(level.isNull(), F.col("cap").cast("double")).otherwise(F.least(level * F.col("w"), F.col("cap").cast("double")))
    return s.select(*sizes.columns, target.alias("target"))


def _edges(base: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, low, high, n, rest, before) for each source with a rest: the range of log keys in which its rest is reached, and the words
    before it. A source's range is dealt into RANGES parts of equal width, of which the one that reaches the rest is dealt again,
    until it has few rows or a single key; all by sums, so keys of any distribution will do, and no task sees a source's rows."""
    state = sources.where("rest > 0").select("source", "low", "high", "n", "rest", F.lit(0).cast("long").alias("before"))
    sorted_by = Window.partitionBy("source").orderBy("range")
    while state.where((F.col("n") > SORTED_ROWS) & (F.col("low") < F.col("high"))).limit(1).count():
        now = few(state, FEW_SOURCES).withColumnRenamed("source", "__s")
        part = F.floor((F.col("log_key") - F.col("low")) / (F.col("high") - F.col("low")) * RANGES)
        part = F.when(F.col("low") < F.col("high"), F.least(part, F.lit(RANGES - 1))).otherwise(0).cast("int")
        inside = base.select("source", "size", "log_key").join(now, F.col("source").eqNullSafe(F.col("__s"))).where(F.col("log_key").between(F.col("low"), F.col("high")))
        sums = inside.groupBy("source", part.alias("range")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.min("log_key").alias("low"), F.max("log_key").alias("high"),
            F.first("rest").alias("rest"), F.first("before").alias("before"),
        )
        sums = sums.withColumn("upto", F.col("before") + F.sum("words").over(sorted_by))
        reached = sums.where(F.col("upto") > F.col("rest")).withColumn("k", F.row_number().over(sorted_by)).where("k = 1")
        state = materialize(reached.select("source", "low", "high", "n", "rest", (F.col("upto") - F.col("words")).alias("before")))
    return state


def _cuts(base: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, log_key, key, tie, rid) of the last row that each source's rest takes, in the order of key, tie, row id.

    Rows of one key and tie are the same text, so they are counted, not sorted; of the group in which the rest ends, the rows are
    told by counts of the base's parts and then by their row ids in one of these.
    """
    now = few(edges, FEW_SOURCES).withColumnRenamed("source", "__s")
    inside = base.join(now, F.col("source").eqNullSafe(F.col("__s"))).where(F.col("log_key").between(F.col("low"), F.col("high")))
    groups = inside.groupBy("source", "key", "tie").agg(F.max("size").alias("size"), F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    running = Window.partitionBy("source").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = F.col("before") + F.sum(F.col("size") * F.col("n")).over(running) - F.col("size") * F.col("n")
    left = F.col("rest") - so_far
    # A row is taken as long as that brings the words nearer to the rest: if its middle is not beyond it.
    fit = F.when(F.col("size") > 0, F.floor(left / F.col("size") + 0.5)).otherwise(F.when(left >= 0, F.col("n")).otherwise(0))
    taken = groups.withColumn("take", F.least(F.greatest(fit, F.lit(0)), F.col("n"))).where("take > 0")
    last = taken.groupBy("source").agg(F.max(F.struct("key", "tie", "take", "n")).alias("last")).select("source", "last.*")
    last = materialize(last)
    own = few(last, FEW_SOURCES).select(F.col("source").alias("__s"), F.col("key").alias("__key"), F.col("tie").alias("__tie"), "take")
    rows = base.join(own, F.col("source").eqNullSafe(F.col("__s")) & (F.col("key") == F.col("__key")) & (F.col("tie") == F.col("__tie")))
    part = F.shiftright("rid", 33)
    counts = rows.groupBy("source", part.alias("part")).agg(F.count("*").alias("rows"), F.first("take").alias("take"))
    by_part = Window.partitionBy("source").orderBy("part")
    ends = counts.withColumn("upto", F.sum("rows").over(by_part)).where(F.col("upto") >= F.col("take")).withColumn("k", F.row_number().over(by_part)).where("k = 1")
    ends = ends.select(F.col("source").alias("__e"), F.col("part").alias("__part"), (F.col("take") - F.col("upto") + F.col("rows")).alias("nth"))
    there = rows.join(few(materialize(ends), FEW_SOURCES), F.col("source").eqNullSafe(F.col("__e")) & (part == F.col("__part")))
    nth = there.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("rid"))).where(F.col("k") == F.col("nth"))
    return nth.select("source", "key", "tie", "rid")


def mixture(
    docs: DataFrame,
    *,
    weight: Column | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: int = 0,
    keep_text: bool = True,
) -> DataFrame:
    """The mix as a table: every column of docs (but text, if keep_text is false), and size, source_size, target, copies (how often
    the mix takes the document).

    A source's whole epochs come first (target over size, rounded down); the rest of its target is filled with documents in
    the order of their exponential keys as long as that brings the sum nearer to it. A document's key is scaled by its
    quality weight (`weight`, from the text by default), so better documents come earlier, and depends only on doc_id, weight
    and seed: reruns agree.

    The texts are read once: sizes and keys are written with the rows, and later passes read those columns alone. Where a source's
    rest ends is found by sums over ranges of its keys (see _edges()); only the range in which it ends is sorted, and rows of
    equal keys are counted before (see _cuts()). Documents are not shuffled.

    Nulls: a null text has size 0; null sources are one source, last in order; a null doc_id has a key from its text. Rows that
    repeat (same doc_id and text) are cut like others, so a source comes within half a document of its target; which of them are
    taken is told by their place in the input. Empty input gives an empty result. Input columns named like those added are
    replaced.
    """
    docs = without(docs, ["size", "source_size", "target", "copies"])
    columns = [c for c in docs.columns if keep_text or c.lower() != "text"]
    key = key_of(F.col("doc_id"), F.col("text"), quality_of(F.col("text")) if weight is None else weight, seed)
    keyed = spread(docs).select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        "source",
        size_of(F.col("text")).alias("size"),
        key.alias("key"),
        F.xxhash64("doc_id", "text").alias("tie"),
    )
    whole = materialize(keyed.select("*", F.log("key").alias("log_key"), F.monotonically_increasing_id().alias("rid")))
    base = whole.drop("row")
    per_source = base.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.min("log_key").alias("low"), F.max("log_key").alias("high"), F.count("*").alias("n")
    )
    sources = source_targets(per_source, weights, most_epochs)
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(most_epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int")
    sources = sources.withColumn("epochs", epochs)
    rest = F.when(F.col("epochs") < most_epochs, F.col("target") - F.col("epochs") * F.col("source_size")).otherwise(0.0)
    sources = materialize(sources.withColumn("rest", rest))
    edges = _edges(base, sources)
    cuts = _cuts(base, edges).select(F.col("source").alias("__s"), F.struct("key", "tie", "rid").alias("last"))
    lows = edges.select(F.col("source").alias("__e"), "low")
    plan = sources.drop("low").join(lows, F.col("source").eqNullSafe(F.col("__e")), "left").join(cuts, F.col("source").eqNullSafe(F.col("__s")), "left")
    plan = materialize(plan.select(F.col("source").alias("__source"), "source_size", "target", "epochs", "low", "last"))
    # A document's part follows from its key and its source's row alone: no shuffle of documents.
    extra = F.coalesce(F.col("log_key") < F.col("low"), F.lit(False)) | F.coalesce(F.struct("key", "tie", "rid") <= F.col("last"), F.lit(False))
    out = whole.join(few(plan, FEW_SOURCES), F.col("source").eqNullSafe(F.col("__source")))
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in columns],
        "size",
        "source_size",
        "target",
        (F.col("epochs") + F.when(extra, 1).otherwise(0)).cast("int").alias("copies"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: each document of docs as often as mixture() takes it, with its copy number from 0."""
    m = mixture(docs, **options).where(F.col("copies") > 0)
    m = without(m, ["copy"]) if "copy" in docs.columns else m
    return m.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("size", "source_size", "target", "copies")
