"""A content-addressed store of token ids.

A rolling hash over the last ids cuts each document's ids where the content says so, hence copies and shared passages fall into equal chunks.
A store is a folder of three Parquet tables:

* ``chunks``: digest (BLAKE2b-128 of the ids as little-endian 32-bit integers), ids (binary, little-endian, 16 or 32 bits). Each chunk once.
* ``recipes``: doc_id, start, n_tokens, root, part, rank, chunks (binary: a record of digest and length for each chunk, in order), in ascending
  doc_id order over the files, too.
* ``manifest``: one row for each part of the recipes: start, ids, rows, and the root of a hash tree over its documents' roots.

A document's root is the Merkle root over its chunk digests. Reading recomputes each chunk's digest from its ids, each root from the recipe, and
each part's root, rows and ids from the recipes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.llm.common import arrow_rows, drop_written, mix, spread, text_of, writing, written
from siftline.llm.pieces import encoder

WINDOW, MEAN, LEAST, MOST = 8, 256, 64, 2048
#: A chunk in a recipe.
RECORD = np.dtype([("digest", "V16"), ("n", "<i4")])
#: Digests of stored chunks that a task remembers.
_SEEN = 100_000
#: Digests that several tasks have met, up to which their table is broadcast (24 bytes each).
BROADCAST_DIGESTS = 200_000


_FACTOR = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []
_MIXED = mix(np.arange(1 << 16, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_FACTOR to the powers 0, 1, ... and to their negatives, modulo 2**64; kept for as long inputs as there were."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, n.bit_length())
        _POWERS[:] = [np.cumprod(np.append(np.uint64(1), np.full(size - 1, f, np.uint64))) for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def marks(ids: np.ndarray, window: int = WINDOW, mean: int = MEAN) -> np.ndarray:
    """Ends of the windows whose rolling hash has zero high bits, one of ``mean`` (a power of 2), in ids of any documents one after the other.

    The hash is a polynomial of the window's ids modulo 2**64; differences of running sums give it for all windows at once."""
    if len(ids) < window:
        return np.empty(0, np.int64)
    up, down = powers(len(ids))
    total = np.cumsum(_MIXED[ids] * down if ids.dtype.itemsize == 2 else mix(ids.astype(np.uint64)) * down)
    rolled = total[window - 1 :].copy()
    rolled[1:] -= total[:-window]
    rolled *= up[: len(rolled)]
    return np.flatnonzero(rolled >> np.uint64(65 - mean.bit_length()) == 0) + window


def cuts(size: int, marks: list[int], least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of a document of ``size`` ids with marks at these places. No chunk but a last one is shorter than ``least``, which is
    more than a window, so windows that began in another document don't count."""
    out, last = [], 0
    for at in [*marks, size]:
        while at - last > most:
            last += most
            out.append(last)
        if at > last and (at - last >= least or at == size):
            out.append(at)
            last = at
    return out


def merkle(leaves: list[bytes]) -> bytes:
    """The root over ordered leaves; an odd one at the end of a level goes up as it is."""
    level = [hashlib.blake2b(b"\0" + x, digest_size=16).digest() for x in leaves] or [bytes(16)]
    while len(level) > 1:
        level = [hashlib.blake2b(b"\1" + b"".join(level[i : i + 2]), digest_size=16).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _shift_tables() -> np.ndarray:
    """[k, i, b]: what 2**k zero bytes make of a CRC-32 whose byte i is b and whose other bytes are 0."""
    one = np.zeros(32, np.uint64)
    for bit in range(32):  # a zero byte
        c = 1 << bit
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        one[bit] = c
    out, values = np.zeros((40, 4, 256), np.uint32), np.arange(256, dtype=np.uint64)
    for k in range(40):
        for i in range(4):
            acc = np.zeros(256, np.uint64)
            for bit in range(8):
                acc ^= np.where(values >> np.uint64(bit) & np.uint64(1), one[8 * i + bit], np.uint64(0))
            out[k, i] = acc
        t = out[k].astype(np.uint64)
        one = t[0][one & np.uint64(255)] ^ t[1][one >> np.uint64(8) & np.uint64(255)] ^ t[2][one >> np.uint64(16) & np.uint64(255)] ^ t[3][one >> np.uint64(24)]
    return out


_SHIFT = _shift_tables()


def crc_shift(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """What each CRC-32 adds to that of a longer string in which ``n_bytes`` follow: crc(a + b) = crc_shift(crc(a), len(b)) ^ crc(b)."""
    crc, n_bytes, k = crc.astype(np.uint32), n_bytes.astype(np.int64), 0
    while (n_bytes >> k).any():
        on = (n_bytes >> k & 1).astype(bool)
        c, t = crc[on], _SHIFT[k]
        crc[on] = t[0][c & 255] ^ t[1][c >> 8 & 255] ^ t[2][c >> 16 & 255] ^ t[3][c >> 24]
        k += 1
    return crc


STAGED = "doc_id long, n_tokens long, root binary, chunks binary, digest binary, place long, ids binary"


def _encode(path: str, end: int):
    """Rows of documents (to ``chunks``), and rows of chunks that the task hasn't met before (from ``digest``)."""
    kinds = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("root", pa.binary()), ("chunks", pa.binary()), ("digest", pa.binary()), ("place", pa.int64()), ("ids", pa.binary())])

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in kinds], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen, task, number = encoder(path), set(), TaskContext.get().partitionId() << 40, 0
        tail = np.array([end], enc.dtype).tobytes()
        for b in arrow_rows(batches, 500):
            each = [enc.raw(t) + tail for t in b.column(1).to_pylist()]
            joined = np.frombuffer(b"".join(each), enc.dtype)
            wide, sizes = joined.astype("<u4"), np.array([len(x) // enc.dtype.itemsize for x in each], np.int64)
            ends, all_marks = np.cumsum(sizes), marks(joined)
            bounds = np.searchsorted(all_marks, np.append(0, ends), "right").tolist()
            roots, recipes, fresh, places, raw, start = [], [], [], [], [], 0
            for i, size in enumerate(sizes.tolist()):
                at, own, lengths = start, [], cuts(size, (all_marks[bounds[i] : bounds[i + 1]] - start).tolist())
                for to in lengths:
                    to += start
                    digest = hashlib.blake2b(wide[at:to], digest_size=16).digest()
                    own.append(digest)
                    if digest not in seen:
                        if len(seen) >= _SEEN:
                            seen.clear()
                        seen.add(digest)
                        fresh.append(digest)
                        places.append(task + number)
                        raw.append(joined[at:to].tobytes())
                        number += 1
                    at = to
                start += size
                recipe = np.empty(len(own), RECORD)
                recipe["digest"], recipe["n"] = np.frombuffer(b"".join(own), "V16"), np.diff(lengths, prepend=0)
                recipes.append(recipe.tobytes())
                roots.append(merkle(own))
            yield rows(len(each), doc_id=b.column(0), n_tokens=sizes, root=roots, chunks=recipes)
            if fresh:
                yield rows(len(fresh), digest=fresh, place=places, ids=raw)

    return run


def _leaf(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 5000):
            raw = [np.frombuffer(x, dtype).astype("<u4").tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in raw], pa.binary()), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array([len(x) // 4 for x in raw], pa.int32())], names=["digest", "crc", "len"])

    return run


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of a recipe: the number of ids that follow it in its document, and of the document whether its root is that of the
    recipe."""
    for b in arrow_rows(batches, 2000):
        recipes = [np.frombuffer(x, RECORD) for x in b.column("chunks").to_pylist()]
        each = [[x.tobytes() for x in r["digest"]] for r in recipes]
        sound = np.array([merkle(own) == root for own, root in zip(each, b.column("root").to_pylist(), strict=True)], bool)
        after = [r["n"][::-1].cumsum()[::-1] - r["n"] for r in recipes]
        owner = np.repeat(np.arange(len(recipes)), [len(r) for r in recipes])
        docs = [b.column(c).take(pa.array(owner)) for c in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*docs, pa.array(sound[owner]), pa.array([x for own in each for x in own], pa.binary()), pa.array(np.concatenate([*after, np.empty(0, np.int64)]), pa.int64())], names=["doc_id", "start", "n_tokens", "sound", "digest", "after"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        moved = crc_shift(b.column("crc").to_numpy(), 4 * b.column("after").to_numpy())
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "n_tokens", "sound", "len")), pa.array(moved.astype(np.int64))], names=["doc_id", "start", "n_tokens", "sound", "len", "part"])


def _part_roots(recipes: DataFrame, fan: int = 1024) -> DataFrame:
    """part, root: the hash tree over a part's document roots in order. No node has more than ``fan`` children, so no group is large."""
    level, most = recipes.select("part", F.col("rank").alias("at"), F.hex("root").alias("root")), recipes.agg(F.max("rank")).first()[0] or 0
    while True:
        below = F.transform(F.array_sort(F.collect_list(F.struct("at", "root"))), lambda x: x["root"])
        level = level.withColumn("at", F.expr(f"cast(at div {fan} as long)")).groupBy("part", "at").agg(F.sha2(F.array_join(below, ""), 256).alias("root"))
        most //= fan
        if not most:
            return level.select("part", "root")


def verify_manifest(spark: SparkSession, path: str) -> bool:
    """Do the recipes give the roots, starts, rows and ids of the manifest, part by part?"""
    manifest = spark.read.parquet(f"{path}/manifest").select("part", "start", "ids", "rows", F.col("root").alias("expected"))
    recipes = spark.read.parquet(f"{path}/recipes")
    sums = recipes.groupBy("part").agg(F.min("start").alias("own_start"), F.sum("n_tokens").alias("own_ids"), F.count("*").alias("own_rows"))
    found = sums.join(_part_roots(recipes), "part")
    same = "root <=> expected and start <=> own_start and ids <=> own_ids and rows <=> own_rows"
    return manifest.join(found, "part", "full").where(f"not ({same})").isEmpty()


def _unique(staged: DataFrame) -> DataFrame:
    """Each chunk once: digest, ids. Tasks have left out what they had met before; of the chunks that several tasks met, the first place stays.
    Only digests are shuffled, unless the copies to leave out are too many for a broadcast."""
    chunks = staged.where("digest is not null").select("digest", "place", "ids")
    first = chunks.select("digest", "place").groupBy("digest").agg(F.min("place").alias("place"), F.count("*").alias("c"))
    many = written(first.where("c > 1").select("digest", "place"), "many")
    if many.count() <= BROADCAST_DIGESTS:
        kept = chunks.join(F.broadcast(many.withColumnRenamed("place", "first")), "digest", "left").where("first is null or first = place")
        return kept.select("digest", "ids")
    return chunks.select("digest", "ids").dropDuplicates(["digest"])


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Writes a store of (doc_id, text, ...) to a new folder ``path``.

    Null texts are empty: such a document is its end id. Null doc_ids come first, rows of the same doc_id one after the other by their roots.
    An empty table makes a store without rows. Only doc_id and text are read. Texts of any length are read whole; only ids and recipes, not
    texts, are shuffled.
    """
    spark = docs.sparkSession
    source = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    staged = written(source.mapInArrow(_encode(tokenizer, end_id), STAGED), "staged")
    order = ["doc_id", "root"]
    recipes = staged.where("root is not null").select("doc_id", "n_tokens", "root", "chunks")
    parts = written(recipes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "ordered")
    with writing(spark):
        _unique(staged).write.parquet(f"{path}/chunks")
    drop_written(spark, staged)
    #: a row for each partition, so a few thousand at most; its running sum needs one task
    totals = parts.groupBy("part").agg(F.sum("n_tokens").alias("ids"), F.count("*").alias("rows"))
    bases = totals.withColumn("base", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = Window.partitionBy("part").orderBy(*order)
    placed = parts.withColumn("before", F.coalesce(F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("rank", F.row_number().over(within) - 1)
    placed = placed.join(F.broadcast(bases.select("part", "base")), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "root", "part", "rank", "chunks")
    with writing(spark):
        placed.repartitionByRange("start").sortWithinPartitions("start").write.parquet(f"{path}/recipes")
    drop_written(spark, parts)
    bases = spark.read.parquet(f"{path}/recipes").groupBy("part").agg(F.min("start").alias("base"), F.sum("n_tokens").alias("ids"), F.count("*").alias("rows"))
    bases.select("part", F.col("base").alias("start"), "ids", "rows").join(_part_roots(spark.read.parquet(f"{path}/recipes")), "part").write.parquet(f"{path}/manifest")


def read_store(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Each document from the files of a store: doc_id, start, n_tokens, ids_crc32, sound (the manifest and all the document's digests, and its
    root, are right). A store without rows gives none."""
    whole = verify_manifest(spark, path)
    dtype = encoder(tokenizer).dtype.str
    chunks = spark.read.parquet(f"{path}/chunks").select("digest", "ids").mapInArrow(_leaf(dtype), "digest binary, crc long, len int")
    links = spark.read.parquet(f"{path}/recipes").mapInArrow(_links, "doc_id long, start long, n_tokens long, sound boolean, digest binary, after long")
    each = links.join(chunks, "digest", "left").withColumns({"crc": F.coalesce("crc", F.lit(0)), "len": F.coalesce("len", F.lit(0))})
    found = each.mapInArrow(_placed, "doc_id long, start long, n_tokens long, sound boolean, len int, part long").groupBy("start")
    out = found.agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.bit_xor("part").alias("ids_crc32"), F.sum("len").alias("got"), F.bool_and("sound").alias("sound"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", (F.lit(whole) & F.col("sound") & (F.col("got") == F.col("n_tokens"))).alias("sound"))


def restore(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Each document's ids (array<int>) put together again from its chunks."""
    digests = F.expr("transform(sequence(0, octet_length(chunks) div 20 - 1), i -> substring(chunks, cast(20 * i + 1 as int), 16))")
    links = spark.read.parquet(f"{path}/recipes").select("doc_id", "start", F.posexplode(digests).alias("at", "digest"))
    whole = links.join(spark.read.parquet(f"{path}/chunks"), "digest").groupBy("doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    dtype = encoder(tokenizer).dtype.str

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 500):
            found = [np.frombuffer(b"".join(p["ids"] for p in parts), dtype).astype(np.int32).tolist() for parts in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])

    return whole.select("doc_id", "start", "parts").mapInArrow(ids, "doc_id long, start long, ids array<int>")
