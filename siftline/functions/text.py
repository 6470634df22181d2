"""Text as Python's str sees it, in Spark SQL expressions.

Spark's trim removes U+0020 only, and Java's classes are ASCII unless told otherwise; these functions use Unicode's white space and, as Python
does, the separators U+001C to U+001F. A null gives null.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, one by one: what trims take, and a class whose members below U+0100 Java looks up in a table; above it, a range is asked first.
_LOW, _HIGH = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0", "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _among(low: str, high: str) -> str:
    return f"[{low}[\u1680-\u3000&&[{high}]]]"


SPACE = _among(_LOW, _HIGH)
LINE_END = _among("\n\r\x0b\x0c\x1c\x1d\x1e\x85", "\u2028\u2029") + r"(?:(?<=\r)\n)?"
#: White space that isn't a single blank.
_UNEVEN = f"{_among(_LOW.replace(' ', ''), _HIGH)}{SPACE}*| {SPACE}+"


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value worked out once for a row, though f uses it within lambdas."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(_LOW + _HIGH))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(_LOW + _HIGH))


def squeeze(c: Column) -> Column:
    """Stripped, and every run of white space a single space."""
    return F.regexp_replace(strip(c), _UNEVEN, " ")


def newlines(c: Column) -> Column:
    """CR LF and CR become LF."""
    return F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, r"\r\n?", "\n")).otherwise(c)


def words(c: Column) -> Column:
    """Runs of other than white space; an empty text has none."""
    return F.array_remove(F.split(c, f"{SPACE}+"), "")


def lines(c: Column) -> Column:
    """Pieces between line ends; a line end at the end adds an empty piece."""
    return F.split(c, LINE_END)


@cache
def _folding() -> tuple[str, str]:
    """Characters that fold to one other, or to none, and what they fold to; those that fold to none come last."""
    pairs, gone = [], []
    for i in range(128, sys.maxunicode + 1):
        ch = chr(i)
        if unicodedata.combining(ch):
            gone.append(ch)
        elif unicodedata.decomposition(ch) and ch.lower() == ch:
            to = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
            if len(to) == 1 and to != ch:
                pairs.append((ch, to))
            elif not to:
                gone.append(ch)
    return "".join(p[0] for p in pairs) + "".join(gone), "".join(p[1] for p in pairs)


def fold(c: Column) -> Column:
    """Lower case without accents: compatibility decomposition, then no combining marks.

    Characters that decompose to several base characters (ligatures, fractions, Hangul syllables) stay as they are; ``fold_exact`` splits them.
    """
    old, new = _folding()
    # nearly all texts have few such characters: a text without any isn't looked up
    return F.when(c.rlike(r"\A\p{ASCII}*\z"), F.lower(c)).otherwise(F.translate(F.lower(c), old, new))


@cache
def _fold_udf():
    import pandas as pd

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else "".join(x for x in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(x)))

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")


def fold_exact(c: Column) -> Column:
    """As ``fold``, for every character, in Python."""
    return _fold_udf()(c)


def content_hash(c: Column) -> Column:
    """SHA-1 (hex) of the squeezed text; case counts."""
    return F.sha1(squeeze(c).cast("binary"))


def preview(c: Column, size: int = 500) -> Column:
    """The beginning of a text, on one line."""
    return F.regexp_replace(F.left(c, F.lit(size)), "\n", " ")


def snippet(c: Column, size: int = 320) -> Column:
    """The beginning of a text; an ellipsis shows that more follows."""
    return F.when(F.length(c) > size, F.concat(F.left(c, F.lit(size)), F.lit("…"))).otherwise(c)
