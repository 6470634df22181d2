"""Toxic passages as maximum-scoring segments.

Every word scores its own log-odds between toxic and clean labelled text (Monroe, Colaresi and Quinn, "Fightin' Words"), positive or negative,
less DRIFT. The Dirichlet prior of a word weighs as much as WORD rows and is informative: its mean is the share of toxic rows, as far as the
other words of the same beginning don't tell otherwise (they weigh against STEM words of that share). One linear scan finds all maximal scoring
segments (Ruzzo and Tompa). A segment's chance is that of Karlin and Altschul: in clean text of n words, segments of score s or more are
expected K n exp(-lambda s) times. A text's evidence is the sum of its segments' -ln of that, calibrated to a probability on labelled rows.
What is learned from labelled rows is applied to each of them as if that row hadn't been counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import arrow_rows, drop_written, spread, text_of, written
from siftline.llm.fitting import labelled, logistic, probability

#: Labelled rows that are learned from, and words (the commonest) and beginnings that have odds of their own, at most. Other words have those of
#: their beginning.
ROWS, LEXICON = 40_000, 200_000
#: What every word scores less than its log-odds; weights of the priors; letters of a beginning.
DRIFT, WORD, STEM, LETTERS = 1.0, 10.0, 30.0, 4
#: Words outside the lexicon that a worker remembers.
KEPT = 100_000
_LETTERS = bytes(i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


def stem(word: bytes) -> bytes | None:
    """The beginning of a longer word."""
    t = word.decode("utf-8", "replace")
    return t[:LETTERS].encode() if len(t) > LETTERS else None


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), from the left.

    Each candidate keeps the sum before it, the sum at its end, and a link to the last candidate before it with a smaller sum before it, so that
    candidates in between are never looked at again.
    """
    sums = np.cumsum(scores)
    places = np.flatnonzero(scores > 0)
    first: list[int] = []
    last: list[int] = []
    low: list[float] = []
    high: list[float] = []
    link: list[int] = []
    for at, left, right in zip(places.tolist(), np.where(places > 0, sums[places - 1], 0.0).tolist(), sums[places].tolist(), strict=True):
        start, j = at, len(low) - 1
        while True:
            while j >= 0 and low[j] >= left:
                j = link[j]
            if j < 0 or high[j] >= right:
                break
            start, left, before = first[j], low[j], link[j]
            del first[j:], last[j:], low[j:], high[j:], link[j:]
            j = before
        first.append(start)
        last.append(at)
        low.append(left)
        high.append(right)
        link.append(j)
    return [(a, b, r - x) for a, b, x, r in zip(first, last, low, high, strict=True)]


class Scores(dict):
    """Words to scores. A word outside the lexicon has the score of its beginning, or that of no odds, and is remembered while there is room."""

    def __init__(self, known: dict[bytes, float], stems: dict[bytes, float]):
        super().__init__(known)
        self.stems, self.room = stems, len(known) + KEPT

    def __missing__(self, word: bytes) -> float:
        s = self.stems.get(stem(word), -DRIFT)
        if len(self) < self.room:
            self[word] = s
        return s


@dataclass
class Toxicity:
    """terms and stems: bytes of words, a newline between them. scores: of the terms, in all learning rows, in all but a clean one with it, and in
    all but a toxic one with it."""

    terms: bytes = b""
    scores: np.ndarray = field(default_factory=lambda: np.zeros((3, 0)))
    stems: bytes = b""
    stem_scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 1.0
    k: float = 1.0
    weights: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "tables"}

    def table(self, label: int | None = None) -> Scores:
        """The scores of all words, to a learning row of a label as if it weren't one."""
        which = 0 if label is None else 1 + label
        tables = self.__dict__.setdefault("tables", {})
        if which not in tables:
            split = lambda x: x.split(b"\n") if x else []
            tables[which] = Scores(dict(zip(split(self.terms), self.scores[which].tolist(), strict=True)), dict(zip(split(self.stems), self.stem_scores.tolist(), strict=True)))
        return tables[which]

    def passages(self, text: str, label: int | None = None) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
        """The words' scores, and the maximal segments."""
        found = words(text)
        s = np.fromiter(map(self.table(label).__getitem__, found), float, len(found))
        return s, segments(s)

    def surprise(self, n: int, score: float) -> float:
        """-ln of the times a segment like it is expected in n words of clean text, 0 at least."""
        return max(0.0, self.rate * score - np.log(max(self.k * n, 1e-12)))

    def features(self, n: int, found: list[tuple[int, int, float]]) -> list[float]:
        each = [self.surprise(n, s) for *_, s in found]
        return [float(np.log1p(sum(sorted(each)))), float(np.log1p(max(each, default=0.0)))]

    def score(self, x: list[list[float]]) -> np.ndarray:
        if self.weights is None or not x:
            return np.full(len(x), 0.5)
        return probability(np.column_stack([np.ones(len(x)), np.array(x)]), self.weights)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in arrow_rows(batches, 500):
        both = (Counter(), Counter())
        for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            both[y].update(set(words(text)))
        terms = list(both[0].keys() | both[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array([t.decode("utf-8", "replace") for t in terms], pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in both)], names=["term", "clean", "toxic"])


def _clean(model: Toxicity):
    """Sums over clean rows by task: of words with each score (to two places), and at no score of rows, words and the highest segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 500):
            seen: Counter = Counter()
            rows, n, top = 0, 0, 0.0
            for text in b.column(1).to_pylist():
                s, found = model.passages(text, 0)
                seen.update(np.round(s, 2).tolist())
                rows, n, top = rows + 1, n + len(s), top + max((x for *_, x in found), default=0.0)
            yield pa.RecordBatch.from_arrays([pa.array([*seen, None], pa.float64()), pa.array([*seen.values(), rows], pa.int64()), pa.array([0] * len(seen) + [n], pa.int64()), pa.array([0.0] * len(seen) + [top], pa.float64())], names=["s", "c", "n", "top"])

    return run


def _features(model: Toxicity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 500):
            x = [model.features(len(s), found) for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for s, found in [model.passages(t, y)]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    return run


def odds(clean: np.ndarray, toxic: np.ndarray, mean: np.ndarray, share: float) -> np.ndarray:
    """Log-odds of words in so many clean and toxic rows, under a prior of this mean, over those of ``share``."""
    return np.log((toxic + WORD * mean) / (clean + WORD * (1 - mean))) - np.log(share / (1 - share))


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Toxicity:
    """A model of at most ROWS labelled rows, whose words are counted where they lie. Without rows of both labels, every score is 0.5.

    Labels other than 0 and 1, null ids and texts, and ids with contrary labels are left out; rows of documents that repeat count as often.
    A row counts a word once.
    """
    rows = written(spread(labelled(docs, labels, "toxic", learn, ROWS).select(F.col("y").cast("long").alias("y"), "text")), "labelled")
    terms = written(rows.mapInArrow(_counts, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "terms")
    sums = terms.agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).first()
    if not sums["c"] or not sums["t"]:
        return Toxicity()
    share = sums["t"] / (sums["c"] + sums["t"])
    # of the words of a beginning, each counts as toxic as its rows are
    stems = terms.where(f"length(term) > {LETTERS}").groupBy(F.left("term", F.lit(LETTERS)).alias("stem")).agg(F.count("*").alias("types"), F.sum(F.expr("toxic / (clean + toxic)")).alias("toxic"))
    stems = stems.orderBy(F.desc("types"), "stem").limit(LEXICON).collect()
    common = terms.where("clean + toxic > 1").orderBy(F.desc(F.expr("clean + toxic")), "term").limit(LEXICON).collect()
    own = {r["stem"]: (r["types"], r["toxic"]) for r in stems}
    c, t = (np.array([r[n] for r in common], float) for n in ("clean", "toxic"))
    others = [own.get(r["term"][:LETTERS]) if len(r["term"]) > LETTERS else None for r in common]
    n, u = np.array([x[0] - 1 if x else 0 for x in others], float), np.array([x[1] if x else 0 for x in others], float)
    mean = (np.maximum(u - np.where(n > 0, t / (c + t), u), 0) + STEM * share) / (n + STEM)
    scores = np.stack([odds(c, t, mean, share), odds(np.maximum(c - 1, 0), t, mean, share), odds(c, np.maximum(t - 1, 0), mean, share)]) - DRIFT
    prior = np.array([(x + STEM * share) / (k + STEM) for k, x in own.values()])
    model = Toxicity("\n".join(r["term"] for r in common).encode(), scores, "\n".join(own).encode(), odds(np.zeros(len(prior)), np.zeros(len(prior)), prior, share) - DRIFT)
    model.rate, model.k = _extreme(rows.where("y = 0").mapInArrow(_clean(model), "s double, c long, n long, top double").groupBy("s").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.sum("top").alias("top")).collect())
    seen = rows.mapInArrow(_features(model), "y long, x array<double>").collect()
    drop_written(docs.sparkSession, rows, terms)
    x, y = np.array([r["x"] for r in seen]), np.array([r["y"] for r in seen], float)
    order = np.lexsort((*x.T, y))  # the same sums however the rows came
    x, y = x[order], y[order]
    model.weights = logistic(np.column_stack([np.ones(len(x)), x]), y)
    return model


def _extreme(clean: list) -> tuple[float, float]:
    """lambda, for which the mean of exp(lambda * score) over words of clean text is 1, and K, from the mean of the highest segment in it."""
    total = next(r for r in clean if r["s"] is None)
    seen = sorted((r["s"], r["c"]) for r in clean if r["s"] is not None)
    if not seen or seen[-1][0] <= 0:
        return 1.0, 1.0
    s, p = np.array([x for x, _ in seen]), np.array([c for _, c in seen], float) / total["n"]
    low, high = 1e-3, 20.0
    if p @ s < 0:
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if p @ np.exp(np.minimum(mid * s, 600)) < 1 else (low, mid)
    rate = max(low, 0.05)
    # a Gumbel maximum over n words has the mean (ln(K n) + 0.5772) / lambda
    return rate, float(np.exp(rate * total["top"] / total["c"] - 0.5772) / max(total["n"] / total["c"], 1))


def scored(docs: DataFrame, model: Toxicity) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, score, passages), one row for each row of ``docs``.

    passages: first and last word (from 0) and score of every significant segment, one expected less than once in a hundred such clean texts.
    Null counts as empty; a text without words has the score of one without toxic words. Texts of any length are read whole, in a time that
    grows with their words. Equal texts have equal scores; repeated rows and null ids stay. Only doc_id and text are read. An empty table gives
    no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))
        for b in arrow_rows(batches, 500):
            xs, spans = [], []
            for text in b.column(1).to_pylist():
                s, found = model.passages(text)
                xs.append(model.features(len(s), found))
                spans.append([{"first": a, "last": z, "score": x} for a, z, x in found if model.surprise(len(s), x) > 4.6])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(xs), pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "passages"])

    source = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    return source.mapInArrow(run, "doc_id long, score double, passages array<struct<first int, last int, score double>>")
