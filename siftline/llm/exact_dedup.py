"""Exact duplicates: static binary fuse filters (Graf and Lemire) screen new digests against immutable snapshots.

A snapshot is a table of digests in buckets of bounded size with one filter a bucket. Rows of a new batch that share a digest are grouped
first, by a partial aggregate, so a text with any number of copies is one row from then on. Only groups that a filter lets pass, about
one in 256 strangers among them, are joined with the snapshot's exact bucket. Groups of more than one row are then compared byte by byte:
their texts, and no others, are grouped by the text itself, again partially before the shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import mix, text_of, written

#: Digests in a bucket, on average: bounds the memory of a filter's construction and of a screening task.
BUCKET = 1 << 14
#: Repeated digests up to which their table is broadcast to the scan (40 bytes each); beyond it, texts are shuffled to them.
BROADCAST_DIGESTS = 200_000


class BinaryFuse8:
    """A three-wise binary fuse filter of 8-bit fingerprints over distinct 64-bit keys; no false negatives."""

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(seed))
        mask = np.uint64(segment - 1)
        first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64), ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse8:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 4 if n < 2 else min(1 << 18, 1 << int(math.log(n) / math.log(3.33) + 2.25))
        factor = 2.0 if n < 2 else max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        segments = max(1, math.ceil(n * factor / segment) - 2)
        for attempt in range(1, 200):
            seed = attempt * 0x9E3779B97F4A7C15 & (1 << 64) - 1
            at, prints = cls._places(keys, seed, segment, segments)
            if (rounds := cls._peel(at, (segments + 2) * segment)) is not None:
                cells = np.zeros((segments + 2) * segment, np.uint8)
                for which, slot in reversed(rounds):
                    own = at[:, which]
                    cells[slot] = 0
                    cells[slot] = prints[which] ^ cells[own[0]] ^ cells[own[1]] ^ cells[own[2]]
                return cls(seed, segment, segments, cells)
            if attempt % 10 == 0:
                segments += max(1, segments // 20)
        raise RuntimeError("no binary fuse filter was found")

    @staticmethod
    def _peel(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, each key's cell that no key left has), or None if some keys can't be peeled."""
        n = at.shape[1]
        count, owners = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for row in at:
            np.add.at(count, row, 1)
            np.bitwise_xor.at(owners, row, np.arange(n))
        rounds, left, touched = [], n, np.arange(size)
        while left:
            alone = touched[count[touched] == 1]
            which, first = np.unique(owners[alone], return_index=True)
            if not len(which):
                return None
            rounds.append((which, alone[first]))
            for row in at[:, which]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owners, row, which)
            touched, left = np.unique(at[:, which]), left - len(which)
        return rounds

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        at, prints = self._places(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        return (self.cells[at[0]] ^ self.cells[at[1]] ^ self.cells[at[2]]) == prints


@dataclass
class Snapshot:
    """groups: bucket, digest, keep_id, size. filters: bucket, seed, segment, segments, cells. Neither is changed once written."""

    groups: DataFrame
    filters: DataFrame
    buckets: int


def _keys(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in rows.column("digest").to_pylist()), np.uint64)


def _filter(rows: pa.Table) -> pa.Table:
    f = BinaryFuse8.build(_keys(rows))
    return pa.table({"bucket": rows.column("bucket")[:1], "seed": pa.array([np.uint64(f.seed).astype(np.int64)]), "segment": pa.array([f.segment], pa.int32()), "segments": pa.array([f.segments], pa.int32()), "cells": pa.array([f.cells.tobytes()], pa.binary())})


def _screen(batch: pa.Table, filters: pa.Table) -> pa.Table:
    if not len(batch) or not len(filters):
        return batch[:0]
    f = filters.to_pylist()[0]
    found = BinaryFuse8(int(np.int64(f["seed"]).astype(np.uint64)), f["segment"], f["segments"], np.frombuffer(f["cells"], np.uint8)).may_have(_keys(batch))
    return batch.filter(pa.array(found))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def grouped(rows: DataFrame) -> DataFrame:
    """doc_id, digest to one row a digest: keep_id (the largest doc_id) and size."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("size"))


def snapshot(groups: DataFrame) -> Snapshot:
    """An immutable snapshot of digest groups, and a filter for each of its buckets."""
    groups = written(groups, "digests")
    n = max(1, math.ceil(groups.count() / BUCKET))
    groups = written(groups.select(F.expr(f"cast(pmod(xxhash64(digest), {n}) as int)").alias("bucket"), "digest", "keep_id", "size").repartition("bucket"), "snapshot")
    filters = written(groups.select("bucket", "digest").groupBy("bucket").applyInArrow(_filter, "bucket int, seed long, segment int, segments int, cells binary"), "filters")
    return Snapshot(groups, filters, n)


def known(batch: DataFrame, old: Snapshot) -> DataFrame:
    """The digest groups of a batch that the snapshot has too: digest, keep_id, size over both."""
    rows = batch.select(F.expr(f"cast(pmod(xxhash64(digest), {old.buckets}) as int)").alias("bucket"), "digest", "keep_id", "size")
    passed = rows.groupBy("bucket").cogroup(old.filters.groupBy("bucket")).applyInArrow(_screen, "bucket int, digest binary, keep_id long, size long")
    theirs = old.groups.select("digest", F.col("keep_id").alias("old_id"), F.col("size").alias("old_size"))
    return passed.join(theirs, "digest").select("digest", F.greatest("keep_id", "old_id").alias("keep_id"), (F.col("size") + F.col("old_size")).alias("size"))


def exact_duplicates(docs: DataFrame, earlier: Column | None = None) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``.

    ``earlier`` marks the rows that form the snapshot; the others are the new batch that is screened against it (by default, odd ids).
    Equal texts are one group, null counts as empty, and of a group the row with the largest doc_id stays. Rows that repeat that doc_id with
    the same text are all kept, as they are the same document. A null doc_id is smaller than all others; a group of only such rows has
    a null keep_id and is kept. Two texts with one SHA-256 would stop the job. Only doc_id and text are read. An empty table gives no rows.
    """
    earlier = F.coalesce(F.expr("pmod(doc_id, 2) = 0"), F.lit(True)) if earlier is None else earlier
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    prints = written(source.select("doc_id", digest(F.col("text")).alias("digest"), earlier.alias("earlier")), "prints")
    old = snapshot(grouped(prints.where("earlier")))
    new = written(grouped(prints.where("not earlier")), "batch")
    repeated = written(old.groups.where("size > 1").select("digest").union(new.where("size > 1").select("digest")).union(known(new, old).select("digest")).distinct(), "repeated")
    small = repeated.count() <= BROADCAST_DIGESTS
    texts = source.withColumn("digest", digest(F.col("text"))).join(F.broadcast(repeated) if small else repeated, "digest", "left_semi")
    same = texts.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("size")).drop("text")
    groups = same.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.max("size").alias("size"), F.count("*").alias("texts"))
    groups = groups.select("digest", "keep_id", F.when(F.col("texts") == 1, F.col("size")).otherwise(F.raise_error(F.lit("two texts have one SHA-256"))).alias("size"), F.lit(True).alias("met"))
    # a table of its own: the rows of a hot digest can only be split among tasks where both sides of the join are read from a shuffle
    out = prints.join(written(groups, "groups"), "digest", "left")
    keep = F.when(F.col("met"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
