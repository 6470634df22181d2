from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """(id, text) rows to a documents table, with columns whose names the operators use inside."""

    def make(rows):
        wide = [(i, t, "en", "src0", len(t or ""), "x", 1, None) for i, t in rows]
        return spark.createDataFrame(wide, DOCS + ", id string, key int, component string").repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """A maker of invented texts: n words, from a seed."""
    syllables = ["ka", "lo", "mi", "ren", "tu", "sa", "vel", "or", "in", "esh", "dra", "po"]
    base = random.Random(5)
    lexicon = ["".join(base.choices(syllables, k=base.randint(1, 4))) for _ in range(3000)]

    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choices(lexicon, k=n))

    return make


#: Texts that any operator must stand: null, empty, white, one word, signs, other scripts, characters outside the BMP, very long words and texts.
HARD = [None, "", " ", "\n\t \r\n", "a", "A a A", "…—„“", "日本語のテキスト", "𝔘𝔫𝔦𝔠𝔬𝔡𝔢 😀😀", "x" * 20_000, "word " * 20_000, "a b c\u0085d", "\u0000\u0001", "İıßẞ ſ", "%%% $$$ ###"]


@pytest.fixture(scope="session")
def hard():
    return list(enumerate(HARD))
