"""JSON in generated texts: recovery of an object, and its fields as columns."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The fields of a description's metadata, in order, but for the description itself.
METADATA = (
    "assay_class", "template_used", "target", "target_resolution", "biological_system", "platform",
    "stimulating_agent", "labeled_ligand", "readout", "incubation_retained", "route_of_administration",
    "stimulus_parameters", "mode_handling", "reference_agonist", "response_phrase",
)
DESCRIPTION = "assay_description"


def unfenced(c: Column) -> Column:
    """c without Markdown fences around it."""
    space = r"[\s\x1c-\x1f]*"
    c = F.regexp_replace(c, f"(?U)^{space}(```(json)?{space})?", "")
    return F.regexp_replace(c, f"(?U)({space}```)?{space}$", "")


def balanced(text: str) -> str | None:
    """The first object in text whose braces balance (braces in strings don't count); null without one."""
    start = text.find("{")
    depth, at = 0, start
    while 0 <= at < len(text):
        char = text[at]
        if char == '"':
            # To the quote that ends the string, over escaped characters.
            at += 1
            while at < len(text) and text[at] != '"':
                at += 2 if text[at] == "\\" else 1
        elif char in "{}":
            depth += 1 if char == "{" else -1
            if depth == 0:
                return text[start : at + 1]
        at += 1
    return None


def _parses(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


@F.pandas_udf(T.StringType())
def recovered(s: pd.Series) -> pd.Series:
    """Each text if it is JSON, else its first balanced object if that is, else null."""

    def one(text: str | None) -> str | None:
        if text is None or _parses(text):
            return text
        found = balanced(text)
        return found if found is not None and _parses(found) else None

    return s.map(one, na_action="ignore").astype(object)


def fields(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """df with the named fields of its JSON column as text, null where missing; an object or array as its JSON."""
    kind = ", ".join(f"`{n}` STRING" for n in names)
    parsed = df.withColumn("__json", F.from_json(F.col(column), kind))
    return parsed.select(*df.columns, *[F.col(f"__json.`{n}`").alias(n) for n in names])


def metadata(df: DataFrame, raw: str) -> DataFrame:
    """df with the description and its metadata from a generator's raw output."""
    return fields(df.withColumn("__clean", recovered(unfenced(F.col(raw)))), "__clean", [DESCRIPTION, *METADATA]).drop("__clean")
