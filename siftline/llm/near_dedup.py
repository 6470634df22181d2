"""Near-duplicate documents by circulant MinHash.

Two permutations make the whole signature (Li and Li, "C-MinHash"): the first scatters shingles over a circle of 2**20 places,
the second, shifted by k places, gives coordinate k. Coordinates are banded, candidates are confirmed on full sets.

What makes the links whole and the work bounded:

* equal sets (by 128 bits of hashes, and size) are one class before any banding, so exact copies cost one small row each;
* bands of 4 of 128 coordinates: a pair at similarity 0.8 shares none of 32 bands with probability (1 - 0.8**4)**32 < 5e-8;
* within a bucket, members are first compared with the bucket's smallest document (a star, linear in the bucket). Only members that
  are still in another component than most of the bucket are then compared with all its members of like size, in tiles of bounded size:
  first by signatures (a linked pair agrees in fewer coordinates than ``least_alike`` tells with a probability under 1e-7), then the few
  members that are alike to any by their full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import WHITE, WordHashes, arrow_rows, drop_written, grams, mix, short_gram, spread, text_of, written
from siftline.llm.components import components

CIRCLE_BITS = 20
BANDS, ROWS = 32, 4
#: Documents that share a bucket, up to which their ids are broadcast to the scan (8 bytes each); beyond it, texts are shuffled to them.
BROADCAST_IDS = 1_000_000
#: Members in a block of a tile that compares signatures; shingles in one that compares full sets.
BLOCK, BLOCK_SHINGLES = 512, 100_000
#: Tiles, and pairs of full sets, in an Arrow batch.
TILES, PAIRS = 16, 200
WORDS = WordHashes(WHITE)
_SHIFTED: dict[int, np.ndarray] = {}


def shifted(n: int) -> np.ndarray:
    """Row p: the second permutation at places p, p + 1, ... p + n - 1 of the circle; a view, no copy."""
    if n not in _SHIFTED:
        second = np.random.default_rng(20_240_229).permutation(1 << CIRCLE_BITS).astype(np.uint32)
        _SHIFTED[n] = np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[:n]]), n)
    return _SHIFTED[n]


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its k-word shingles; fewer words than k are one shingle, no words none."""
    return [np.unique(grams(h, k) if len(h) >= k else short_gram(h)) for h in WORDS.each(texts)]


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """n coordinates of a set that isn't empty. The first permutation is the top bits of a mixed hash."""
    places, rows = (mix(shingles) >> np.uint64(64 - CIRCLE_BITS)).astype(np.int64), shifted(n)
    parts = [rows[places[i : i + 4096]].min(axis=0) for i in range(0, len(places), 4096)]
    return parts[0] if len(parts) == 1 else np.min(parts, axis=0)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A row of keys for each row of coordinates."""
    b = signatures.reshape(-1, bands, rows).astype(np.uint64)
    h = np.tile(np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(b), 1))
    for i in range(rows):
        h = mix(h ^ b[:, :, i]) + np.uint64(i)
    return h.view(np.int64)


def _sketch(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 500):
            sets = shingle_sets(b.column(1).to_pylist(), k)
            n = np.array([len(s) for s in sets], np.int64)
            full, every = np.flatnonzero(n), np.concatenate([*sets, np.empty(0, np.uint64)])
            at = np.cumsum(n[full]) - n[full]
            h = np.zeros((2, len(n)), np.uint64)
            found = np.empty((len(full), bands * rows), np.uint32)
            if len(full):
                h[0, full] = np.bitwise_xor.reduceat(mix(every ^ np.uint64(0x5851F42D4C957F2D)), at)
                h[1, full] = np.add.reduceat(mix(every + np.uint64(0x14057B7EF767814F)), at)
                for i, j in enumerate(full.tolist()):
                    found[i] = signature(sets[j], bands * rows)
            keys = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum((n > 0) * bands)), pa.int32()), pa.array(band_keys(found, bands, rows).ravel()))
            own = iter(found.astype(np.uint8))
            signs = pa.array([next(own).tobytes() if x else b"" for x in n.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(h[0].view(np.int64)), pa.array(h[1].view(np.int64)), signs, keys], names=["id", "n", "h1", "h2", "signature", "bands"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 500):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1).to_pylist(), k)], pa.binary())], names=["id", "shingles"])

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct hashes."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 200):
            ok = pa.array([linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(b.column(2), b.column(3), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose full sets are similar enough. Each side's set is joined by id; a hot id is split by the skew join."""
    left, right = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a long, b long")


def least_alike(coordinates: int, percent: int) -> int:
    """In how many coordinates the signatures of linked sets agree at least: 5.4 standard deviations below the mean at the limit."""
    p = percent / 100
    return max(1, int(coordinates * p - 5.4 * (coordinates * p * (1 - p)) ** 0.5))


def alike(need: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Which of the other members' signatures agree with one in ``need`` coordinates."""

    def run(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        return (np.stack(others) == own).sum(axis=1) >= need

    return run


def similar(percent: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Which of the other members' full sets are linked with one."""

    def run(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        own = own.view(np.uint64)
        return np.array([linked(own, x.view(np.uint64), percent) for x in others])

    return run


def _tile(compare, whole: bool):
    """Compares the odd members of each tile with its other members of another component. Gives the ids of all that are linked with any, with
    ``whole``, the links; one link to each other component joins as much as all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 64):
            found: set[tuple[int, int, int]] = set()
            for key, members in zip(b.column("key").to_pylist(), b.column("members"), strict=True):
                m = members.values
                odd, ids, comps = m.field("odd").to_numpy(zero_copy_only=False), m.field("id").to_numpy(), m.field("component").to_numpy()
                left, right = np.flatnonzero(odd), np.flatnonzero(~odd)
                if not len(left) or not len(right):
                    continue
                bodies = [np.frombuffer(x.as_buffer(), np.uint8) for x in m.field("body")]
                others, other_ids, other_comps = [bodies[j] for j in right], ids[right], comps[right]
                for i in left.tolist():
                    far = np.flatnonzero(other_comps != comps[i])
                    if not len(far):
                        continue
                    ok = far[compare(bodies[i], others if len(far) == len(others) else [others[j] for j in far])]
                    if whole:
                        ok = ok[np.unique(other_comps[ok], return_index=True)[1]]
                    found.update((key, int(ids[i]), int(other_ids[j])) for j in ok)
            if whole:
                rows = sorted({(a, c) for _, a, c in found})
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=["a", "b"])
            else:
                rows = sorted({(k, x) for k, a, c in found for x in (a, c)})
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=["key", "id"])

    return run


def tiled(members: DataFrame, bodies: DataFrame, percent: int, weight: str, compare, whole: bool) -> DataFrame:
    """Compares members of different components that meet in a bucket. members: key, id, component, n. bodies: id, body.

    In each bucket all members that aren't in its commonest component are compared with every member of like size: sizes are in classes of
    which only neighbours can be linked. Both sides of a class are dealt to blocks of a ``weight`` of about 1, and each pair of blocks is a tile
    of its own, so no task gets a whole bucket and only what is linked comes out.
    """
    base = 100 / percent + 0.01
    counts = members.groupBy("key", "component").agg(F.count("*").alias("c"))
    top = written(counts.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top")).select("key", F.col("top.component").alias("main")), "top")
    m = written(members.join(top, "key").select("key", "id", "component", (F.col("component") != F.col("main")).alias("odd"), F.expr(f"cast(floor(ln(n) / ln({base})) as int)").alias("size"), F.expr(weight).alias("w")), "sized")
    odd = m.where("odd").withColumn("size", F.explode(F.expr("array(size - 1, size, size + 1)")))
    blocks = m.groupBy("key", "size").agg(F.ceil(F.sum("w")).cast("int").alias("nb")).join(odd.groupBy("key", "size").agg(F.ceil(F.sum("w")).cast("int").alias("ob")), ["key", "size"])
    blocks = written(blocks, "blocks")
    at = F.xxhash64("id")
    left = odd.join(blocks, ["key", "size"]).withColumn("at", at).select("key", "size", "id", "component", F.expr("cast(pmod(at, ob) as int)").alias("o"), F.explode(F.expr("sequence(0, nb - 1)")).alias("b"), F.lit(True).alias("odd"))
    right = m.join(blocks, ["key", "size"]).withColumn("at", at).select("key", "size", "id", "component", F.explode(F.expr("sequence(0, ob - 1)")).alias("o"), F.expr("cast(pmod(at, nb) as int)").alias("b"), F.lit(False).alias("odd"))
    rows = left.unionByName(right).join(bodies, "id")
    tiles = rows.groupBy("key", "size", "o", "b").agg(F.collect_list(F.struct("id", "component", "odd", "body")).alias("members"))
    return tiles.select("key", "members").mapInArrow(_tile(compare, whole), "a long, b long" if whole else "key long, id long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, n_shingles, component_id, class_id, kept), one row for each row of ``docs``.

    Words are ASCII-lower-cased runs between ASCII white space; a set is the distinct k-word shingles, or the whole sequence if it is shorter.
    Documents are linked at 100 * intersection >= percent * union; component_id is the smallest doc_id reachable, class_id the smallest with
    the same set. Null or wordless texts have no shingles and no links. Rows with the same doc_id are one document with as many rows, which
    have all links of each of their texts. A null doc_id is never linked: its component_id and class_id are null and it is kept. Texts of any
    length are taken whole; a task needs about thirty bytes for each byte of its longest text. Only doc_id and text are read, so other columns
    may have any name. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = spread(docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text")))
    sketch = written(base.mapInArrow(_sketch(k, bands, rows), "id long, n long, h1 long, h2 long, signature binary, bands array<long>"), "sketch")
    whole = sketch.where("n > 0 and id is not null")
    # a table of its own, here and below: a hot key's rows can only be split among tasks where both sides of the join are read from a shuffle
    classes = written(whole.groupBy("h1", "h2", "n").agg(F.min("id").alias("class")), "classes")
    firsts = whole.join(classes.select(F.col("class").alias("id"), "h1", "h2", "n"), ["id", "h1", "h2", "n"]).select("id", "n", F.explode("bands").alias("key"))
    shared = written(firsts.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("key", "first"), "shared")
    members = written(firsts.join(shared, "key").select("key", "id", "n", "first"), "members")
    placed = whole.join(classes, ["h1", "h2", "n"]).select("id", "class")
    several = placed.groupBy("id").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x < y")
    same = written(placed.join(several, "id").select(F.col("class").alias("a"), F.col("x").alias("b")).distinct(), "same")  # of a doc_id with several texts
    ids = written(members.select("id").distinct(), "ids")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = written(base.join(few, "id", "left_semi").mapInArrow(_sets(k), "id long, shingles binary").distinct(), "sets")
    signatures = whole.join(few, "id", "left_semi").select("id", F.col("signature").alias("body"))
    pairs = members.groupBy("id").agg(F.min("first").alias("b")).where("id <> b").select(F.col("id").alias("a"), "b")
    links = written(confirmed(pairs, sets, percent), "links", PAIRS)
    reach = components(links)
    for step in ("stars", "tiles"):
        placed = members.join(reach, "id", "left").select("key", "id", "n", "first", F.coalesce("component", "id").alias("component"))
        mixed = written(placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key"), "mixed")
        if mixed.isEmpty():
            break
        placed = written(placed.join(mixed, "key"), "placed")
        if step == "stars":
            heads = placed.where("id = first").select(F.col("id").alias("b"), F.col("component").alias("other")).distinct()
            more = placed.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"), "component").distinct().join(heads, "b").where("component <> other").select("a", "b")
            more = written(confirmed(more, sets, percent), "links", PAIRS)
        else:
            near = written(tiled(placed.select("key", "id", "component", "n"), signatures, percent, f"1 / {BLOCK}D", alike(least_alike(bands * rows, percent)), False), "near", TILES)
            left = placed.join(near, ["key", "id"]).select("key", "id", "component", "n")
            more = written(tiled(left, sets.withColumnRenamed("shingles", "body"), percent, f"n / {BLOCK_SHINGLES}D", similar(percent), True), "links", TILES)
        if not more.isEmpty():
            links = links.union(more)
            reach = components(links)
    if not same.isEmpty():
        reach = components(links.union(same))
    drop_written(spark, sets, members)
    ends = classes.join(reach.select(F.col("id").alias("class"), "component"), "class", "left").select("h1", "h2", "n", "class", F.coalesce("component", "class").alias("component"))
    ends = written(ends, "ends")
    found = whole.select("id", "n", "h1", "h2").join(ends, ["h1", "h2", "n"], "left").select("id", "n", "class", "component")
    alone = sketch.where("n = 0 or id is null").select("id", "n", F.col("id").alias("class"), F.col("id").alias("component"))
    return found.union(alone).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("class").alias("class_id"), (F.col("component").isNull() | (F.col("id") == F.col("component"))).alias("kept"))
