"""Cleaning of markup, line by line and as a whole."""

from __future__ import annotations

import html
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.text import bind, lines, newlines, rstrip, strip

# Tags and comments that go, the site line, and the bounds of the index block.
MATH_TAG = r"(?i)</?math>"
INLINE_TAG = r"(?i)</?(sup|sub|span|b|i|u|em|strong)>"
COMMENT = r"(?s)<!--.*?-->"
SITE_LINE = r"(?iU)\A\s*(DIRECCIÓN EN INTERNET:|DIRECCION EN INTERNET:)?\s*www\.eluniverso\.com\s*\z"
INDEX_START = r"(?iU)\A\s*##\s*INDICE\s*\z"
INDEX_END = r"(?iU)\A\s*##\s*(Ayuda a|EDC|Se incrementó|Bancomex|Mas provisiones|Recaudaciones|out clausuro)\b"
#: Entities that the decoder in the JVM knows, the ampersand last, so that a decoded one begins no other.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", "\u00a0"), ("&#39;", "'"))
#: An ampersand that may begin any other entity, or one without its semicolon.
OTHER_ENTITY = "&(?!(?:" + "|".join(name[1:-1] for name, _ in ENTITIES) + "|amp);)[#0-9A-Za-z]"


@dataclass(frozen=True)
class Rules:
    """Which whole lines go, and between which lines the index block lies (the line that ends it stays; without one, the rest goes)."""

    drop_line: str = SITE_LINE
    index_start: str = INDEX_START
    index_end: str = INDEX_END


@cache
def _decoder():
    import pandas as pd

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else html.unescape(t))

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")


def decode_entities(c: Column, every: bool = True) -> Column:
    """One pass over entities: the common ones in the JVM. ``every``: texts that may have others go to Python, in Arrow batches, and no other text."""
    found = c
    for name, sign in ENTITIES:
        found = F.replace(found, F.lit(name), F.lit(sign))
    found = F.regexp_replace(found, "&amp;?", "&")
    return F.coalesce(_decoder()(F.when(c.rlike(OTHER_ENTITY), c)), found) if every else found


def strip_markup(c: Column, every_entity: bool = True) -> Column:
    """Newlines made equal, entities decoded, then math tags, simple inline tags and comments removed, in this order."""
    c = decode_entities(newlines(c), every_entity)
    for pattern in (MATH_TAG, INLINE_TAG, COMMENT):
        c = F.regexp_replace(c, pattern, "")
    return c


def keep_lines(found: Column, rules: Rules = Rules()) -> Column:
    """An array of lines without the lines that go and without index blocks.

    Each line is marked by itself; whether it lies in a block is told by the last opening and the last ending before it. No array grows step by
    step, so the work grows with the lines (times the openings and endings of a text, which are few), and there is no shuffle.
    """

    def marked(line: Column) -> Column:
        bare = strip(line)
        goes, opens = bare.rlike(rules.drop_line), bare.rlike(rules.index_start)
        return F.struct(rstrip(line).alias("text"), goes.alias("goes"), (~goes & opens).alias("opens"), (~goes & ~opens & bare.rlike(rules.index_end)).alias("ends"))

    def places(lines: Column, which: str) -> Column:
        return F.filter(F.transform(lines, lambda x, i: F.when(x[which], i)), lambda i: i.isNotNull())

    def without(lines: Column, opened: Column, ended: Column) -> Column:
        last = lambda of, i: F.coalesce(F.array_max(F.filter(of, lambda k: k < i)), F.lit(-1))
        shown = F.filter(lines, lambda x, i: ~x["goes"] & ~x["opens"] & (x["ends"] | (last(opened, i) <= last(ended, i))))
        return F.transform(shown, lambda x: x["text"])

    return bind(F.transform(found, marked), lambda m: bind(F.struct(places(m, "opens").alias("o"), places(m, "ends").alias("e")), lambda p: without(m, p["o"], p["e"])))


def tidy(c: Column) -> Column:
    """Four and more newlines become three; stripped, with one newline at the end."""
    return F.concat(strip(F.regexp_replace(c, "\n{4,}", "\n\n\n")), F.lit("\n"))


def clean(c: Column, rules: Rules = Rules(), every_entity: bool = True) -> Column:
    """Raw markdown to clean text."""
    return tidy(F.array_join(keep_lines(lines(strip_markup(c, every_entity)), rules), "\n"))


def processed(raw: DataFrame, text: str = "raw_md") -> DataFrame:
    """One row: how many documents were cleaned, and of how many; one without a text isn't."""
    return raw.agg(F.count(text).alias("processed"), F.count("*").alias("total"))


def clean_documents(raw: DataFrame, key: str = "doc", text: str = "raw_md", rules: Rules = Rules(), every_entity: bool = True) -> DataFrame:
    """(doc, raw_md) to (source_path, text): the key gets the suffix of cleaned files. A null text counts as empty."""
    return raw.select(F.concat(F.col(key).cast("string"), F.lit("_rawclean.md")).alias("source_path"), clean(F.coalesce(F.col(text), F.lit("")), rules, every_entity).alias("text"))
