"""Text quality by compression: how much better good labelled text helps zstandard than bad labelled text does.

A text is compressed with a dictionary of good and with one of bad labelled text; the difference of the two sizes, over their sum, is the
evidence, and nothing else is. It is taken in three views: the text itself, its shape (letters, capitals and digits as classes, signs as they
are), and the shape with each run of a class as one; in the two shapes from each window, too, as a text may be bad in one place only. A
logistic calibration over labelled rows makes a probability of the differences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm.common import arrow_rows, drop_written, mix, spread, text_of, written
from siftline.llm.fitting import labelled, logistic, probability

#: Labelled rows that are learned from, at most, and bytes of a dictionary, at most. The views of all these rows' whole texts are cut into pieces
#: of PIECE bytes, from which a dictionary's are drawn by the hash of row and place, each row weighing alike.
ROWS, PIECE, DICTIONARY, LEVEL = 8000, 600, 65_536, 3
#: Of the calibration.
RIDGE = 1e-4
_SHAPE = bytes(65 if 65 <= i <= 90 else 97 if 97 <= i <= 122 or i >= 128 else 48 if 48 <= i <= 57 else i for i in range(256))
_RUN = re.compile(b"a+|A+|0+")
#: Bytes of a view's windows; none for views that are compared as a whole only.
WINDOWS = (None, 200, 100)


def views(text: str) -> tuple[bytes, bytes, bytes]:
    raw = text.encode("utf-8", "replace")
    shape = raw.translate(_SHAPE)
    return raw, shape, _RUN.sub(lambda m: m[0][:1], shape)


def cut(view: bytes, size: int) -> list[bytes]:
    """Pieces of ``size`` bytes; a rest of under half of that isn't one, unless it is all."""
    return [view[i : i + size] for i in range(0, max(1, len(view) - size // 2), size)]


@dataclass
class Quality:
    """good, bad: dictionaries of the views. mean, scale, weights: of the calibration."""

    good: tuple[bytes, ...] = ()
    bad: tuple[bytes, ...] = ()
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def ready(self) -> Quality:
        import zstandard

        def one(raw: bytes):
            told = {"dict_data": zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if raw else {}
            return zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False, **told).compress

        self.squeeze = [(one(g), one(b)) for g, b in zip(self.good, self.bad, strict=True)]
        return self

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "squeeze"}

    def features(self, text: str) -> list[float]:
        """Of each view the difference, and where it has windows the least, the largest and the mean of theirs."""
        found = []
        for (good, bad), view, window in zip(self.squeeze, views(text), WINDOWS, strict=True):
            for size in (None, window)[: 1 + (window is not None)]:
                each = []
                for part in cut(view, size) if size else (view,):
                    g, b = len(good(part)), len(bad(part))
                    each.append((b - g) / (b + g))
                found += [min(each), max(each), sum(each) / len(each)] if size else each
        return found

    def expanded(self, x: np.ndarray) -> np.ndarray:
        """A constant, the differences, and their products."""
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        k = z.shape[1]
        return np.column_stack([np.ones(len(z)), z, *(z[:, i] * z[:, j] for i in range(k) for j in range(i, k))])

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None or not len(texts):
            return np.full(len(texts), 0.5)
        return probability(self.expanded(np.array([self.features(t or "") for t in texts])), self.weights)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pieces of labelled rows; the n pieces of a row have n-fold exponential keys, so that the smallest keys draw from all rows alike."""
    for b in arrow_rows(batches, 200):
        ys, which, keys, parts = [], [], [], []
        for i, y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            for v, view in enumerate(views(text)):
                own = cut(view, PIECE)
                u = (mix(mix(np.full(len(own), i, np.int64).view(np.uint64)) + np.arange(len(own), dtype=np.uint64)) >> np.uint64(11)).astype(float) / 2**53
                ys += [y] * len(own)
                which += [v] * len(own)
                keys.append(-np.log(np.maximum(u, 1e-300)) * len(own))
                parts += own
        yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int64()), pa.array(which, pa.int32()), pa.array(np.concatenate(keys) if keys else [], pa.float64()), pa.array(parts, pa.binary())], names=["y", "view", "key", "piece"])


def _features(model: Quality):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.ready()
        for b in arrow_rows(batches, 500):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.features(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))], names=["y", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Quality:
    """A model of at most ROWS labelled rows. Without rows of both labels, every score is 0.5.

    Labels other than 0 and 1, null ids and texts, and ids with contrary labels are left out; rows of documents that repeat count as often.
    """
    rows = written(spread(labelled(docs, labels, "quality", learn, ROWS).select("doc_id", F.col("y").cast("long").alias("y"), "text")), "labelled")
    ranked = rows.mapInArrow(_pieces, "y long, view int, key double, piece binary").withColumn("rank", F.row_number().over(Window.partitionBy("y", "view").orderBy("key", "piece")))
    drawn: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
    for r in ranked.where(f"rank <= {2 * DICTIONARY // PIECE}").collect():  # twice a dictionary of full pieces, whatever the rows
        drawn.setdefault((r["y"], r["view"]), []).append((r["rank"], bytes(r["piece"])))
    if {y for y, _ in drawn} != {0, 1}:
        return Quality()
    model = Quality(*(tuple(b"\n".join(p for _, p in sorted(drawn[y, v]))[:DICTIONARY] for v in range(len(WINDOWS))) for y in (1, 0)))
    seen = rows.select("y", "text").mapInArrow(_features(model), "y long, x array<double>").collect()
    drop_written(docs.sparkSession, rows)
    x, y = np.array([r["x"] for r in seen]), np.array([r["y"] for r in seen], float)
    order = np.lexsort((*x.T, y))  # the same sums however the rows came
    x, y = x[order], y[order]
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    model.weights = logistic(model.expanded(x), y, RIDGE)
    return model


def scored(docs: DataFrame, model: Quality) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, score), one row for each row of ``docs``: the probability of label 1.

    Null counts as empty; an empty text has a score, too. Texts of any length are compressed whole. Equal texts have equal scores; repeated rows
    and null ids stay. Only doc_id and text are read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.ready()
        for b in arrow_rows(batches, 500):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.score(b.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    source = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    return source.mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Quality, least: float) -> DataFrame:
    """The rows of ``docs``, whole, whose column text scores ``least`` or more. Null counts as empty."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.ready()
        for b in arrow_rows(batches, 500):
            yield b.filter(pa.array(m.score(b.column(at).to_pylist()) >= least, pa.bool_()))

    return spread(docs).mapInArrow(run, docs.schema)
