"""Benchmark decontamination by a distributed positional inverted index.

The index is cut by document: a segment holds the postings of some documents in Parquet, its term dictionary sorted by hash, with positions that
run on through the segment. Between documents the positions have a gap, so no phrase reaches over it. A phrase is searched in a segment from its
rarest term there: that term's positions, less its place in the phrase, are intersected with the other terms' in order of rarity. Building and
searching need no shuffle, and no task holds more than a segment's postings, whatever words or passages are frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm.common import SIGNS, WordHashes, arrow_rows, spread, text_of, written

WINDOW = 10
#: Tokens after which a segment is closed (a longer document is a segment of its own), and the positions left free between documents.
SEGMENT, GAP = 100_000, 64
#: Segments in an Arrow batch.
SEGMENTS = 4
#: Words of test items that are searched in one pass; more are searched in further passes.
BLOCK_WORDS = 500_000
#: ASCII letters in lower case, digits and everything outside ASCII make words.
WORDS = WordHashes(SIGNS)
INDEX = "segment long, docs array<struct<doc_id: long, start: int, n: int>>, terms binary, offsets binary, positions binary"
HITS = "segment long, no int, spans array<struct<start: int, end: int>>, items array<string>"


def _segment(number: int, ids: list, hashes: list[np.ndarray]) -> pa.RecordBatch:
    starts, at = [], 0
    for h in hashes:
        starts.append(at)
        at += len(h) + GAP
    flat = np.concatenate(hashes)
    places = np.concatenate([np.arange(s, s + len(h), dtype=np.int32) for s, h in zip(starts, hashes, strict=True)])
    order = np.argsort(flat, kind="stable")
    terms, first = np.unique(flat[order], return_index=True)
    docs = [{"doc_id": i, "start": s, "n": len(h)} for i, s, h in zip(ids, starts, hashes, strict=True)]
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([docs], kind), pa.array([terms.tobytes()], pa.binary()), pa.array([np.append(first, len(flat)).astype(np.int32).tobytes()], pa.binary()), pa.array([places[order].tobytes()], pa.binary())],
        names=["segment", "docs", "terms", "offsets", "positions"],
    )


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, ids, hashes, size = TaskContext.get().partitionId() << 32, [], [], 0
    for b in arrow_rows(batches, 500):
        for i, h in zip(b.column(0).to_pylist(), WORDS.each(b.column(1).to_pylist()), strict=True):
            if ids and size + len(h) > SEGMENT:
                yield _segment(number, ids, hashes)
                number, ids, hashes, size = number + 1, [], [], 0
            ids.append(i)
            hashes.append(h)
            size += len(h) + GAP
    if ids:
        yield _segment(number, ids, hashes)


def build_index(docs: DataFrame) -> DataFrame:
    """The index of (doc_id, text, ...), written to the shared folder. Null texts have no words; each row is a document of its own."""
    source = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    return written(source.mapInArrow(_build, INDEX), "index", wide=True)


@dataclass
class Phrases:
    """Phrases of one length. terms: a row each, as places in ``vocabulary``; items: the item of each; places in the item are of no account."""

    terms: np.ndarray
    items: np.ndarray


@dataclass
class Block:
    vocabulary: np.ndarray
    phrases: list[Phrases]
    names: list[str | None]


def block_of(items: list[tuple[str | None, str]], window: int = WINDOW) -> Block:
    """All windows of the items; an item of fewer words, but not none, is one window."""
    by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
    for k, h in enumerate(WORDS.each([text for _, text in items])):
        if len(h) >= window:
            by_length.setdefault(window, []).extend((w, k) for w in np.lib.stride_tricks.sliding_window_view(h, window))
        elif len(h):
            by_length.setdefault(len(h), []).append((h, k))
    vocabulary = np.unique(np.concatenate([w for rows in by_length.values() for w, _ in rows])) if by_length else np.empty(0, np.uint64)
    phrases = [Phrases(np.searchsorted(vocabulary, np.stack([w for w, _ in rows])), np.array([k for _, k in rows])) for rows in by_length.values()]
    return Block(vocabulary, phrases, [n for n, _ in items])


class Segment:
    """The postings of one segment, ready to be searched for the terms of a vocabulary."""

    def __init__(self, terms: bytes, offsets: bytes, positions: bytes, vocabulary: np.ndarray):
        terms, offsets, positions = np.frombuffer(terms, np.uint64), np.frombuffer(offsets, np.int32).astype(np.int64), np.frombuffer(positions, np.int32)
        at = np.searchsorted(terms, vocabulary)
        here = np.zeros(len(vocabulary), bool) if not len(terms) else terms[np.minimum(at, len(terms) - 1)] == vocabulary
        at = np.where(here, at, 0)
        self.first = np.where(here, offsets[at] if len(terms) else 0, 0)
        self.count = np.where(here, (offsets[at + 1] - offsets[at]) if len(terms) else 0, 0)
        self.positions = positions
        # (term, position) in order, of the vocabulary's terms only
        which = np.repeat(np.arange(len(vocabulary)), self.count)
        begin = np.cumsum(self.count) - self.count
        self.keys = which.astype(np.int64) << 32 | positions[np.arange(len(which)) - np.repeat(begin - self.first, self.count)].astype(np.int64)

    def postings(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of the terms all its positions: (index into ``term``, position)."""
        n = self.count[term]
        row = np.repeat(np.arange(len(term)), n)
        return row, self.positions[np.arange(len(row)) - np.repeat(np.cumsum(n) - n - self.first[term], n)].astype(np.int64)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        keys = term.astype(np.int64) << 32 | position
        at = np.searchsorted(self.keys, keys)
        ok = (at < len(self.keys)) & (position >= 0)
        ok[ok] = self.keys[at[ok]] == keys[ok]
        return ok

    def exact(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of every exact occurrence."""
        df = self.count[phrases]
        alive = np.flatnonzero((df > 0).all(axis=1))
        if not len(alive):
            return alive, alive
        order = np.argsort(df[alive], axis=1, kind="stable")
        rarest = order[:, 0]
        row, start = self.postings(phrases[alive, rarest])
        start = start - rarest[row]
        for k in range(1, phrases.shape[1]):
            if not len(row):
                break
            j = order[row, k]
            ok = self.has(phrases[alive[row], j], start + j)
            row, start = row[ok], start[ok]
        return alive[row], start

    def near(self, phrase: np.ndarray, slop: int, starts: np.ndarray) -> list[tuple[int, int]]:
        """(first, last) position of every stretch of one document (``starts`` of them) that has all terms of a phrase, as often as the phrase
        has them, within len(phrase) + slop words, and no shorter one in it."""
        terms, times = np.unique(phrase, return_counts=True)
        if (self.count[terms] < times).any():
            return []
        row, at = self.postings(terms)
        order = np.argsort(at, kind="stable")
        row, at = row[order].tolist(), at[order]
        doc, at = (np.searchsorted(starts, at, "right") - 1).tolist(), at.tolist()
        out: list[tuple[int, int]] = []
        seen, lacking, low = [0] * len(terms), len(terms), 0
        for k, t in enumerate(row):
            while low < k and (doc[low] != doc[k] or at[k] - at[low] >= len(phrase) + slop):
                lacking += seen[row[low]] == times[row[low]]
                seen[row[low]] -= 1
                low += 1
            seen[t] += 1
            lacking -= seen[t] == times[t]
            if lacking == 0:
                while seen[row[low]] > times[row[low]]:
                    seen[row[low]] -= 1
                    low += 1
                if out and out[-1][0] == at[low]:
                    continue
                out.append((at[low], at[k]))
        return out


def _search(block: Block, slop: int | None):
    kind = [pa.int64(), pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                starts = np.array(b.column("docs")[i].values.field("start"), dtype=np.int64)
                s = Segment(b.column("terms")[i].as_py(), b.column("offsets")[i].as_py(), b.column("positions")[i].as_py(), block.vocabulary)
                lows, highs, owners = [], [], []
                for p in block.phrases:
                    if slop is None:
                        which, start = s.exact(p.terms)
                        lows.append(start)
                        highs.append(start + p.terms.shape[1])
                        owners.append(p.items[which])
                    else:
                        for k, phrase in enumerate(p.terms):
                            found = s.near(phrase, slop, starts)
                            lows.append(np.array([x for x, _ in found], np.int64))
                            highs.append(np.array([y + 1 for _, y in found], np.int64))
                            owners.append(np.full(len(found), p.items[k]))
                low = np.concatenate(lows) if lows else np.empty(0, np.int64)
                if not len(low):
                    continue
                high, owner = np.concatenate(highs), np.concatenate(owners)
                doc = np.searchsorted(starts, low, "right") - 1
                order = np.lexsort((low, doc))
                low, high, owner, doc = low[order], high[order], owner[order], doc[order]
                rows = ([], [], [], [])
                edges = np.flatnonzero(np.diff(doc, prepend=-1))
                for x, y in zip(edges, [*edges[1:], len(doc)], strict=True):
                    top = np.maximum.accumulate(high[x:y])
                    cut = np.flatnonzero(np.append(True, low[x + 1 : y] > top[:-1]))
                    base = starts[doc[x]]
                    rows[0].append(b.column("segment")[i].as_py())
                    rows[1].append(int(doc[x]))
                    rows[2].append([{"start": int(u - base), "end": int(v - base)} for u, v in zip(low[x:y][cut], top[np.append(cut[1:], y - x) - 1], strict=True)])
                    rows[3].append([block.names[k] for k in np.unique(owner[x:y]) if block.names[k] is not None])
                yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kind, strict=True)], names=["segment", "no", "spans", "items"])

    return run


def blocks(items: DataFrame, words_at_once: int = BLOCK_WORDS) -> Iterator[list[tuple[str | None, str]]]:
    """Test items in blocks of bounded size, one at a time."""
    block, size = [], 0
    for r in items.select(F.col("item_id").cast("string").alias("i"), text_of().alias("t")).toLocalIterator():
        block.append((r["i"], r["t"]))
        size += len(r["t"]) // 2 + 1
        if size >= words_at_once:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int | None = None) -> DataFrame:
    """Documents with hits: segment, no (place in the segment), spans (words, end exclusive, apart), items (ids, each once, in order as strings).

    Exact phrases, or with ``slop`` windows all of whose words, a repeated one as often, stand within window + slop words of a document in any
    order (proximity).
    """
    passes = []
    for block in blocks(items):
        found = index.mapInArrow(_search(block_of(block, window), slop), HITS)
        passes.append(written(found, "hits", SEGMENTS))
    spark = index.sparkSession
    if not passes:
        return spark.createDataFrame([], HITS)
    if len(passes) == 1:
        return passes[0].withColumn("items", F.array_sort(F.array_distinct("items")))
    every = passes[0]
    for p in passes[1:]:
        every = every.union(p)
    both = every.groupBy("segment", "no").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = "aggregate(spans, cast(array() as array<struct<start:int,end:int>>), (a, s) -> if(size(a) > 0 and element_at(a, -1).end >= s.start, concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end)))), concat(a, array(s))))"
    return both.withColumn("spans", F.expr(merged))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, ...) and (item_id, text, ...) to one row for each row of ``docs``: doc_id, n_words, n_hit, spans, items, contaminated.

    Null and wordless texts are neither hit nor hit others. Items with a null id hit words but aren't listed; items of the same id are one.
    Without items nothing is hit. Texts of any length are taken whole, a long one as a segment of its own. Words are compared by 64-bit hashes.
    Other columns of either table aren't read.
    """
    index = build_index(docs)
    hits = search(index, items, window)
    each = index.select("segment", F.posexplode("docs").alias("no", "d")).select("segment", "no", "d.doc_id", F.col("d.n").cast("long").alias("n_words"))
    out = each.join(hits, ["segment", "no"], "left")
    n_hit = F.expr("coalesce(aggregate(spans, 0L, (s, x) -> s + x.end - x.start), 0L)")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def session_index(spark: SparkSession, path: str) -> DataFrame:
    """An index that ``build_index`` wrote."""
    return spark.read.schema(INDEX).parquet(path)
