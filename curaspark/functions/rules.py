"""Rule checks of generated descriptions and the correction of response phrases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that a description must not have, and words that tell an experiment on animals.
BANNED = (
    r"\bIC50\b", r"\bEC50\b", r"\bKi\b", r"\bKd\b", r"\bEmax\b", r"\bpIC50\b", r"\bpEC50\b", r"\bpKi\b",
    r"\bMPE\b", r"\bAD50\b", r"\bED50\b", r"according to", r"published procedure",
)
IN_VIVO = (
    "mice", "mouse", "rat", "rats", "swiss webster", "c57", "sprague", "wistar",
    "subcutaneous", r"s\.c\.", "intraperitoneal", r"i\.p\.", "intravenous", r"i\.v\.",
    "oral(ly)?", r"p\.o\.", "intrathecal", r"i\.c\.v\.",
    "tail[- ]withdrawal", "tail[- ]flick", "tail[- ]immersion", "hot[- ]plate",
    "formalin test", "antinociception", "antinociceptive", "locomotor",
)


def alternation(words: Sequence[str], whole: bool = False) -> str:
    """One case-insensitive pattern for several, between word boundaries if whole."""
    joined = "|".join(words)
    return f"(?iuU)\\b({joined})\\b" if whole else f"(?iuU){joined}"


#: What a text with a banned token has once its case is folded: parts that are words of their own there, and parts that need not be.
_BANNED_PARTS = ("c50", "emax", "mpe", "d50", "according to", "published procedure")
_BANNED_SHORT = r"(?U)\bp?k[id]\b"


def banned_token(c: Column) -> Column:
    """The first banned token in c, as written there; null without one. The full pattern is tried only on texts that can have one."""

    def could(low: Column) -> Column:
        hit = low.rlike(_BANNED_SHORT)
        for part in _BANNED_PARTS:
            hit = hit | low.contains(part)
        return hit

    # Upper, then lower case: the folding of case-insensitive patterns.
    hit = F.get(F.transform(F.array(F.lower(F.upper(c))), could), F.lit(0))
    return F.when(hit, F.nullif(F.regexp_extract(c, alternation(BANNED), 0), F.lit("")))


def in_vivo(c: Column) -> Column:
    """Whether c has a word that tells an experiment on animals."""
    return c.rlike(alternation(IN_VIVO, whole=True))


def _has(c: Column, word: str) -> Column:
    low = F.lower(c)
    return low.contains(f"{word}-response") | low.contains(f"{word}–response")


def quoted(c: Column) -> Column:
    """c in quotes as Python's repr writes a word."""
    q = F.when(c.contains("'") & ~c.contains('"'), F.lit('"')).otherwise(F.lit("'"))
    return F.concat(q, F.when(q == "'", F.replace(c, F.lit("'"), F.lit("\\'"))).otherwise(c), q)


def violation(c: Column) -> Column:
    """The message of the first rule that c breaks, else null: empty, banned token, markup, response phrase."""
    token, vivo, dose, conc = banned_token(c), in_vivo(c), _has(c, "dose"), _has(c, "concentration")
    head = F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+", "")
    # The messages.
    return (
        F.when(c.isNull() | (head == ""), F.lit("empty description"))
        .when(token.isNotNull(), F.concat(F.lit("banned token present: "), quoted(token)))
        .when(c.contains("```") | head.startswith("{"), F.lit("looks like JSON or Markdown fence in production output"))
        .when(vivo & conc & ~dose, F.lit("in vivo description uses 'concentration-response' instead of 'dose-response'"))
        .when(~vivo & dose & ~conc, F.lit("in vitro description uses 'dose-response' instead of 'concentration-response'"))
    )


def fix_response_phrase(c: Column) -> Column:
    """c with the response phrase that fits the experiment, in lower case, whatever case it had; nulls stay."""
    vivo = F.regexp_replace(c, "(?iu)concentration([-–])response", "dose$1response")
    vitro = F.regexp_replace(c, "(?iu)dose([-–])response", "concentration$1response")
    return F.when(in_vivo(c), vivo).otherwise(vitro)
