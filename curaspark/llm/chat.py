"""Chat formatting by rotating perspectives, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Messages of a part: a very long dialogue is not one row.
PART_MESSAGES = 256
#: Speakers that set the scene; they are rendered as they are and are no participants.
SCENE = ("system",)
#: The markup of a rendered message.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _escaped(text: Column) -> Column:
    """Text in which the markup cannot be forged."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _name(role: Column) -> Column:
    return F.regexp_replace(role, r"[\x00-\x20<>|]", "_")


def _label(role: Column, own: Column, scene: tuple[str, ...]) -> Column:
    return F.when(own, F.lit("assistant")).when(role.isin(*scene), _name(role)).otherwise(F.concat(F.lit("user name="), _name(role)))


def _head(label: Column) -> Column:
    return F.concat(F.lit(OPEN), label, F.lit("\n"))


def _body(text: Column) -> Column:
    return F.concat(_escaped(text), F.lit(CLOSE))


def numbered(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with place, their number from 0 in their dialogue, in the order of turn, then role, then text,
    nulls first.

    The whole table is sorted by ranges, in which also rows that repeat have distinct keys, so neither a dialogue with very many
    of the rows nor one turn of it meets in one task; numbers follow from counts of the ranges.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(*order).withColumn("salt", F.monotonically_increasing_id()).orderBy(*order, "salt").drop("salt")
    rows = materialize(rows.withColumn("rid", F.monotonically_increasing_id()))
    part = F.shiftright("rid", 33)
    ranges = rows.groupBy("conv_id", part.alias("range")).agg(F.min("rid").alias("first"), F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("conv_id").orderBy("range"))
    ranges = ranges.select(F.col("conv_id").alias("__conv"), "range", (upto - F.col("n") - F.col("first")).alias("shift"))
    out = rows.join(ranges, F.col("conv_id").eqNullSafe(F.col("__conv")) & (part == F.col("range")))
    return out.select(*order, (F.col("rid") + F.col("shift")).alias("place"))


def perspectives(turns: DataFrame, *, scene: tuple[str, ...] = SCENE, part_messages: int = PART_MESSAGES) -> DataFrame:
    """Every dialogue once for each participant: (conv_id, perspective, part, start, n_messages, n_spans, text, mask).

    turns: (conv_id, turn, role, text). In a participant's rendering their own turns are the assistant's, the others' are those
    of named users, scene setters stay as they are. mask: code point ranges start:end (end exclusive), comma-joined, of what
    the participant says with its end mark; only there a loss is to be taken. A part has `part_messages` messages, the last of a
    dialogue the rest; ranges count from the start of a part's text, and start is where that begins in the whole rendering: the parts'
    texts in order are the whole text, and their ranges moved by start the whole mask.

    Turns come in the order of turn, then role, then text, nulls first; rows that repeat are all rendered. A null conv_id is
    one dialogue of its own, a null role the participant `unknown`, a null text empty, a null turn comes first.
    A dialogue of scene setters alone has no participant and no rows. Other columns are not used. Empty input: no rows.

    Each part is grouped by itself; participants and lengths come from pre-aggregated tables, so a dialogue that holds
    very many of the rows is spread over its parts.
    """
    t = numbered(turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), "text"))
    t = t.withColumn("part", F.floor(F.col("place") / part_messages))
    messages = F.sort_array(F.collect_list(F.struct("place", "role", "text")))
    parts = t.groupBy("conv_id", "part").agg(messages.alias("messages"))
    # What a part's text is long: all messages as others see them, and what changes for those of the participant.
    none = F.lit(False)
    length = F.length(_head(_label(F.col("role"), none, scene))) + F.length(_body(F.col("text")))
    told = t.groupBy("conv_id", "part", "role").agg(F.sum(length).alias("length"), F.count("*").alias("n"))
    whole = told.groupBy("conv_id", "part").agg(F.sum("length").alias("length"), F.map_from_entries(F.collect_list(F.struct("role", "n"))).alias("own"))
    who = told.where(~F.col("role").isin(*scene)).select(F.col("conv_id").alias("__conv"), F.col("role").alias("perspective")).distinct()
    sizes = whole.join(who, F.col("conv_id").eqNullSafe(F.col("__conv")))
    less = F.length(_label(F.col("perspective"), none, scene)) - F.length(F.lit("assistant"))
    size = F.col("length") - F.coalesce(F.col("own")[F.col("perspective")], F.lit(0)) * less
    before = F.sum(size).over(Window.partitionBy("conv_id", "perspective").orderBy("part")) - size
    sizes = sizes.select(F.col("conv_id").alias("__conv"), F.col("part").alias("__part"), "perspective", before.alias("start"))
    seen = parts.join(sizes, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("part") == F.col("__part")))

    def own(m: Column) -> Column:
        return m["role"] == F.col("perspective")

    seen = seen.select(
        "conv_id",
        "perspective",
        "part",
        "start",
        F.transform("messages", lambda m: F.struct(_head(_label(m["role"], own(m), scene)).alias("head"), _body(m["text"]).alias("body"), own(m).alias("own"))).alias("r"),
    )
    # One walk over the messages: where each begins, and the ranges of those that are the participant's.
    walked = F.aggregate(
        "r",
        F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<string>").alias("spans")),
        lambda acc, m: F.struct(
            (acc["at"] + F.length(m["head"]) + F.length(m["body"])).alias("at"),
            F.when(
                m["own"],
                F.concat(
                    F.coalesce(acc["spans"], F.array().cast("array<string>")),
                    F.array(F.concat_ws(":", (acc["at"] + F.length(m["head"])).cast("string"), (acc["at"] + F.length(m["head"]) + F.length(m["body"])).cast("string"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: F.coalesce(acc["spans"], F.array().cast("array<string>")),
    )
    return seen.select(
        "conv_id",
        "perspective",
        "part",
        "start",
        F.size("r").cast("long").alias("n_messages"),
        F.size(F.filter("r", lambda m: m["own"])).cast("long").alias("n_spans"),
        F.array_join(F.transform("r", lambda m: F.concat(m["head"], m["body"])), "").alias("text"),
        F.array_join(walked, ",").alias("mask"),
    )
