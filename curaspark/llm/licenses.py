"""License scans by an exact set-similarity join, in DataFrame functions only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, ascii_lower, materialize, repeatable, spread, with_rid, without
from .license_texts import TEXTS

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}

#: A block begins every STRIDE words and has twice as many, so that any STRIDE + 1 words in a row lie in one; longer templates
#: have larger blocks of their own.
STRIDE = 32


@dataclass(frozen=True)
class Template:
    """Words to look for in a block. threshold: the share of its distinct words that the block must hold. phrase: only places
    where the words stand one after another count."""

    label: str
    text: str
    threshold: float = 0.8
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.translate(_LOWER))

    @property
    def tokens(self) -> list[str]:
        return sorted(set(self.words))

    @property
    def stride(self) -> int:
        """Words from one block to the next, of twice as many: STRIDE, doubled until the template lies in one wherever it begins."""
        n = STRIDE
        while len(self.words) > n + 1:
            n *= 2
        return n

    @property
    def need(self) -> int:
        return max(1, math.ceil(self.threshold * len(self.tokens) - 1e-9))


#: Phrases that count only where their words stand together.
PHRASES = (
    Template("gpl", "gnu general public license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("cc-by", "cc by", 1.0, True),
    Template("mit", "mit license", 1.0, True),
)
#: Notices that count wherever a block holds enough of their words.
NOTICES = (
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("mit-notice", "released under the mit license"),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("all-rights-reserved", "all rights reserved"),
)
#: Whole licences, found wherever a block of twice their length or more holds 80% of their distinct words.
LICENSES = tuple(Template(label, text) for label, text in TEXTS)


def _literal(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def scan(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES + LICENSES) -> DataFrame:
    """Every column of docs, and n_words, n_base, first_word, last_word, base_labels, labels, score (as of the templates).

    Text blocks (64 words, one every 32; for templates of more than 33 words, blocks of 128 every 64, and so on) are joined with the templates: tokens are ordered by the number of documents that
    hold them, the rarest first; a template is indexed by the prefix that any block with enough of its tokens must meet; a
    block of too few template tokens (length filter) or a match too near the end of either side (positional filter) is no
    candidate; the overlap of the others is counted exactly. Tokens outside all templates match nothing, so blocks are
    compared by their template tokens alone. For phrases, the places in the candidate blocks where the words stand together
    are counted, each in the block whose first half it begins in.

    labels: base_labels (of phrases) and those of the other templates found, distinct, sorted, comma-joined; score: the
    largest share of a template's tokens in a block that reaches its threshold, 0 without one.
    A null text is empty: 0 words, no places, empty labels. Templates are a parameter of at most a few hundred tokens; only their index is broadcast. Rows that repeat are scanned each by itself. Columns named
    like those added are replaced. Empty input: no rows.
    """
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    docs = with_rid(without(repeatable(docs), added))
    vocabulary = sorted({w for t in templates for w in t.tokens})
    # One pass over the texts: their words, the template tokens among them, and the words themselves of documents that could match.
    found = spread(docs.select("__rid", "text")).select("__rid", F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0)).alias("words")).select(
        "__rid", "words", F.array_intersect("words", _literal(vocabulary)).alias("present")
    )
    strides = sorted({t.stride for t in templates})

    def could(stride: int) -> Column:
        """Whether the whole document has enough words of a template with blocks of that size."""
        fit = F.lit(False)
        for t in templates:
            if t.stride == stride:
                fit = fit | (F.size(F.array_intersect("present", _literal(t.tokens))) >= t.need)
        return fit

    found = found.withColumn("strides", F.array_compact(F.array(*[F.when(could(n), F.lit(n)) for n in strides])))
    passed = materialize(found.select("__rid", F.size("words").cast("long").alias("n_words"), "present", "strides", F.when(F.size("strides") > 0, F.col("words")).alias("words")))
    counts = dict(passed.select(F.explode("present").alias("token")).groupBy("token").count().collect())  # at most the vocabulary
    ranked = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    order = {w: i for i, w in enumerate(ranked)}
    starts = F.flatten(
        F.transform("strides", lambda n: F.transform(F.sequence(F.lit(0), F.size("words") - 1, n), lambda at: F.struct(at.alias("start"), n.alias("stride"))))
    )
    blocks = (
        passed.where(F.size("words") > 0)
        .select("__rid", "words", F.explode(starts).alias("at"))
        .select("__rid", "at.start", "at.stride", F.expr("slice(words, at.start + 1, 2 * at.stride)").alias("block"))
        .withColumn("tokens", F.array_intersect(_literal(ranked), "block"))  # in the order of the first, the rarest first
    )
    index, sets = [], []
    for k, t in enumerate(templates):
        own = sorted(t.tokens, key=order.get)
        sets.append((k, own))
        index += [(r, t.stride, k, at, len(own), t.need) for at, r in enumerate(own[: len(own) - t.need + 1])]
    spark = docs.sparkSession
    index = F.broadcast(spark.createDataFrame(index, "token string, stride int, template int, at int, n int, need int"))
    least = min(t.need for t in templates)
    candidates = (
        blocks.where(F.size("tokens") >= least)
        .select("*", F.posexplode(F.expr(f"slice(tokens, 1, size(tokens) - {least - 1})")).alias("pos", "token"))
        .join(index, ["token", "stride"])
        .where(F.size("tokens") >= F.col("need"))
        .where(1 + F.least(F.col("n") - 1 - F.col("at"), F.size("tokens") - 1 - F.col("pos")) >= F.col("need"))
        .groupBy("__rid", "start", "template")  # a template has one stride
        .agg(F.first("block").alias("block"), F.first("tokens").alias("tokens"), F.first("n").alias("n"), F.first("need").alias("need"))
    )
    of = F.create_map(*[x for k, own in sets for x in (F.lit(k), _literal(own))])
    overlap = F.size(F.array_intersect("tokens", of[F.col("template")]))
    met = candidates.withColumn("overlap", overlap).where(F.col("overlap") >= F.col("need"))

    def places(phrase: list[str], stride: int) -> Column:
        """Where in the first half of the block the words stand together."""
        last = F.least(F.lit(stride), F.size("block") - len(phrase) + 1)
        at = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))

        def here(i: Column) -> Column:
            ok = F.lit(True)
            for j, w in enumerate(phrase):
                ok = ok & (F.get("block", i + j) == w)
            return ok

        return F.filter(at, here)

    stand = F.lit(None).cast("array<int>")
    for k, t in enumerate(templates):
        if t.phrase:
            stand = F.when(F.col("template") == k, places(t.words, t.stride)).otherwise(stand)
    labels = F.element_at(_literal([t.label for t in templates]), F.col("template") + 1)
    met = met.select(
        "__rid",
        "start",
        stand.alias("at"),
        F.when(stand.isNull(), F.lit(False)).otherwise(F.lit(True)).alias("phrase"),
        labels.alias("label"),
        (F.col("overlap") / F.col("n")).alias("share"),
    )
    met = met.where(~F.col("phrase") | (F.size("at") > 0))
    hits = met.groupBy("__rid").agg(
        F.sum(F.when(F.col("phrase"), F.size("at")).otherwise(0)).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("start") + F.array_min("at"))).alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("start") + F.array_max("at"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    # The counts of all rows are in the same order of row ids as docs; both sides are narrow but for what docs itself carries.
    return (
        docs.join(passed.select("__rid", "n_words"), "__rid")
        .join(hits, "__rid", "left")
        .select(
            *[F.col(f"`{c}`") for c in docs.columns if c != "__rid"],
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            F.col("first_word").cast("long").alias("first_word"),
            F.col("last_word").cast("long").alias("last_word"),
            F.coalesce("base_labels", F.lit("")).alias("base_labels"),
            F.coalesce("labels", F.lit("")).alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )
