"""Unicode to ASCII for assay texts: units, Greek letters, degrees, punctuation; and what is left over."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SPACE

# Fixed values, in natural order: letters, unit suffixes, digits and signs, punctuation.
GREEK = {
    "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "μ": "mu", "κ": "kappa",
    "Α": "Alpha", "Β": "Beta", "Γ": "Gamma", "Δ": "Delta", "Μ": "Mu", "Κ": "Kappa",
}
UNITS = (("mol", "umol"), ("M", "uM"), ("L", "uL"), ("l", "uL"), ("g", "ug"), ("m", "um"), ("s", "us"))
SUPERSCRIPTS = ("⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾", "0123456789+-=()")
SUBSCRIPTS = ("₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎", "0123456789+-=()")
PUNCTUATION = {
    "\u2013": "-", "\u2014": "-", "\u2212": "-", "\u00a0": " ", "\u201c": '"', "\u201d": '"', "\u2018": "'",
    "\u2019": "'", "\u2026": "...", "\u00d7": "x", "\u2265": ">=", "\u2264": "<=", "\u2260": "!=", "\u00b1": "+/-",
}


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition; Spark has no built-in for it."""
    return s.str.normalize("NFKC")


def greek(c: Column) -> Column:
    """A Greek letter with a unit suffix and a word's end becomes the unit in micro-, any other its name."""
    letters = "".join(GREEK)
    for suffix, unit in UNITS:
        c = F.regexp_replace(c, f"(?U)[{letters}]{suffix}\\b", unit)
    for letter, name in GREEK.items():
        c = F.replace(c, F.lit(letter), F.lit(name))
    return c


def scripts(c: Column) -> Column:
    """Superscript and subscript digits and signs as plain ones."""
    return F.translate(c, SUPERSCRIPTS[0] + SUBSCRIPTS[0], SUPERSCRIPTS[1] + SUBSCRIPTS[1])


def degrees(c: Column) -> Column:
    """A degree sign before C, F or K as ` deg X`, any other as ` deg`; then runs of spaces as one, in the whole text."""
    c = F.regexp_replace(c, f"(?U){SPACE}*°{SPACE}*([CFK])\\b", " deg $1")
    c = F.replace(c, F.lit("°"), F.lit(" deg"))
    return F.regexp_replace(c, "  +", " ")


def punctuation(c: Column) -> Column:
    """Dashes, quotes and a few signs in ASCII."""
    single = {k: v for k, v in PUNCTUATION.items() if len(v) == 1}
    c = F.translate(c, "".join(single), "".join(single.values()))
    for sign, text in PUNCTUATION.items():
        if len(text) > 1:
            c = F.replace(c, F.lit(sign), F.lit(text))
    return c


def _let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c evaluated once, however often f names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def beyond_ascii(c: Column) -> Column:
    """Whether c has a character of more than one byte."""
    return F.octet_length(c) > F.length(c)


def _single_spaced(c: Column) -> Column:
    return F.when(c.contains("  "), F.regexp_replace(c, "  +", " ")).otherwise(c)


def rules(c: Column) -> Column:
    """The native part of normalisation, for text that is NFKC already. Steps that can change nothing are left out, row by row: in pure
    ASCII only runs of spaces change, and letters and degrees cost their patterns only where there are any."""

    def letters(x: Column) -> Column:
        return F.when(x.rlike(f"[{''.join(GREEK)}]"), greek(x)).otherwise(x)

    def degreed(x: Column) -> Column:
        return F.when(x.contains("°"), degrees(x)).otherwise(_single_spaced(x))

    def whole(x: Column) -> Column:
        return F.when(beyond_ascii(x), punctuation(_let(scripts(letters(x)), degreed))).otherwise(_single_spaced(x))

    return _let(c, whole)


def normalise(c: Column) -> Column:
    """NFKC, then the rules; null stays null. Other characters beyond ASCII stay and are reported by residual(). Only texts that have
    any go to Python for NFKC."""
    return rules(F.coalesce(nfkc(F.when(beyond_ascii(c), c)), c))


def residual(df: DataFrame, column: str) -> DataFrame:
    """A row of df for each character beyond ASCII in column: its columns, position (from 0, in code points) and character."""
    c = F.col(column)
    # Nothing but such characters is left of an array of single characters; most rows are filtered out before it is made.
    hit = df.where(c.rlike(r"[^\x00-\x7F]"))
    at = F.filter(F.transform(F.split(c, ""), lambda x, i: F.struct(i.alias("position"), x.alias("character"))), lambda x: x["character"].rlike(r"[^\x00-\x7F]"))
    return hit.withColumn("__r", F.explode(at)).select(*df.columns, F.col("__r.position").cast("long").alias("position"), F.col("__r.character").alias("character"))


def changed(before: Column, after: Column) -> Column:
    """How many texts differ, of those that are there on both sides."""
    return F.count_if(before != after)
