"""Statistics of a chunk's text, its heuristic score, and the reasons against it."""

from __future__ import annotations

from string import ascii_letters

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.text import SPACE, bind, lines, strip

# The letters that count, the patterns, bounds and weights of the score.
LETTERS = f"[{ascii_letters}ÁÉÍÓÚÜÑáéíóúüñ]"
# Five of -_= or three bars in a row; Tel, Telf, PBX or Fax as a word. The first character is a class, so that Java passes over others at once.
SEPARATORS = r"[-_=|](?:(?<=[-_=])[-_=]{4}|(?<=[|])[|]{2})"
PHONE = r"(?U)[TtPpFf](?:(?<=\b[Tt])[Ee][Ll][Ff]?|(?<=\b[Pp])[Bb][Xx]|(?<=\b[Ff])[Aa][Xx])\b"
MONEY = r"(?iU)[$€]|USD|US\$"
SHORT_LINE = 20
ALPHA_WEIGHT, ALPHA_MOST = 1.6, 0.85
DIGITS_MOST, DIGITS_WEIGHT = 0.18, 1.8
SHORT_MOST, SHORT_WEIGHT, SHORT_LINES = 0.55, 1.2, 6
SEPARATORS_COST, PHONE_COST = 0.15, 0.10
PERCENT_DIGITS, PERCENT_COST = 0.12, 0.08
MONEY_DIGITS, MONEY_COST = 0.10, 0.06
KEEP_SCORE, KEEP_LENGTH = 0.55, 80

STATS = ("n", "alpha", "digit", "space", "alpha_ratio", "digit_ratio", "space_ratio", "lines", "avg_line_len", "short_lines_ratio")


def stats(text: Column) -> Column:
    """A struct of the ten statistics of the stripped text; an empty text has zeros and a ratio of short lines of 1.

    Letters are taken out in runs, and digits and white space are counted in what is left; each step is worked out once for a row.
    """
    without = lambda c, pattern: F.regexp_replace(c, f"{pattern}+", "")

    def counted(t: Column) -> Column:
        full = F.array_remove(F.transform(lines(t), strip), "")
        rest = bind(without(t, LETTERS), lambda r: bind(without(r, r"(?U)\d"), lambda q: F.struct(F.length(r).alias("r"), F.length(q).alias("q"), F.length(without(q, SPACE)).alias("o"))))
        return F.struct(F.length(t).alias("n"), rest.alias("rest"), F.transform(full, F.length).alias("full"))

    def every(c: Column) -> Column:
        n, rest, full = c["n"].cast("long"), c["rest"], c["full"]
        counts = {"alpha": c["n"] - rest["r"], "digit": rest["r"] - rest["q"], "space": rest["q"] - rest["o"]}
        several = F.greatest(F.size(full), F.lit(1))
        total = F.aggregate(full, F.lit(0), lambda s, x: s + x)
        short = F.size(F.filter(full, lambda x: x <= SHORT_LINE))
        least = F.greatest(n, F.lit(1)).cast("double")
        found = {"n": n, **{k: v.cast("long") for k, v in counts.items()}, **{f"{k}_ratio": v / least for k, v in counts.items()}, "lines": F.size(full).cast("long")}
        found |= {"avg_line_len": total / several, "short_lines_ratio": F.when(n == 0, 1.0).otherwise(short / several)}
        return F.struct(*(found[k].alias(k) for k in STATS))

    return bind(bind(strip(F.coalesce(text, F.lit(""))), counted), every)


def _costs(s: Column, text: Column) -> list[tuple[str, Column, Column]]:
    """(reason, condition, cost), in the order in which they are taken off."""
    digits, short = s["digit_ratio"], s["short_lines_ratio"]
    return [
        ("digit_heavy", digits > DIGITS_MOST, (digits - DIGITS_MOST) * DIGITS_WEIGHT),
        ("many_short_lines", (short > SHORT_MOST) & (s["lines"] >= SHORT_LINES), (short - SHORT_MOST) * SHORT_WEIGHT),
        ("many_separators", text.rlike(SEPARATORS), F.lit(SEPARATORS_COST)),
        ("phoneish", text.rlike(PHONE), F.lit(PHONE_COST)),
        ("percent+digits", (digits > PERCENT_DIGITS) & F.contains(text, F.lit("%")), F.lit(PERCENT_COST)),
        ("money+digits", (digits > MONEY_DIGITS) & text.rlike(MONEY), F.lit(MONEY_COST)),
    ]


def met(s: Column, text: Column) -> Column:
    """Which of the costs apply, for ``score`` and ``reasons``: an array of booleans, worked out once."""
    return bind(F.array(*(condition for _, condition, _ in _costs(s, F.coalesce(text, F.lit(""))))), lambda m: m)


def score(s: Column, text: Column, applies: Column | None = None) -> Column:
    """0 to 1 (0.85 at most): many letters are good; digits, short lines, rules, phone numbers, percentages and prices are not."""
    found = F.least(F.lit(ALPHA_MOST), s["alpha_ratio"] * ALPHA_WEIGHT)
    applies = met(s, text) if applies is None else applies
    for i, (_, _, cost) in enumerate(_costs(s, text)):
        found = found - F.when(applies[i], cost).otherwise(0.0)
    return F.when(s["n"] == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), found)))


def reasons(s: Column, text: Column, applies: Column | None = None) -> Column:
    """The names of the costs that apply, in order; ``empty`` alone for an empty text."""
    applies = met(s, text) if applies is None else applies
    each = F.array(*(F.when(applies[i], F.lit(name)) for i, (name, _, _) in enumerate(_costs(s, text))))
    return F.when(s["n"] == 0, F.array(F.lit("empty"))).otherwise(F.array_compact(each))
