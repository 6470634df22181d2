"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir. Where that is unset, a local one if the driver is the
    only process (as in tests), and an error on a cluster."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="siftline-")
        spark.conf.set("spark.checkpoint.dir", root)
        atexit.register(__import__("shutil").rmtree, root, True)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/siftline/{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch of texts.
BATCH = 1000


@contextmanager
def writing(spark: SparkSession, batch: int = BATCH) -> Iterator[None]:
    """While a table is written: shuffle files go when the table is there, not when the driver happens to collect its garbage, and Arrow batches
    have ``batch`` rows. Then the session's settings are as before."""
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Of tables whose rows take a megabyte or so: pages of few rows (elsewhere Parquet looks at a page's size after a hundred rows only, and a reader's
#: native buffers are as large as the largest page), and no compression of what are mostly hashes.
WIDE = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "2", "compression": "uncompressed"}


def written(df: DataFrame, name: str, batch: int = BATCH, wide: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors and is computed once. wide: has it rows of a megabyte?"""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with writing(spark, batch):
        df.write.options(**(WIDE if wide else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes the files of tables made by ``written`` once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for df in tables for f in df.inputFiles()}:
        if "/siftline/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(name: str = "text") -> Column:
    """Null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def spread(df: DataFrame) -> DataFrame:
    """Deals a small input to all cores, as it may be one row group; a large one has splits enough and isn't moved. Texts may be long, so from here
    on the session's Arrow batches have BATCH rows at most."""
    if int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH:
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < 64 << 20 else df


def arrow_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3, 0x4CF5AD432745937F, 0x2545F4914F6CDD1D, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xB564EF22EC7AECE5], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_FACTOR = 0x9E3779B97F4A7C15


def powers(factor: int, n: int) -> np.ndarray:
    """factor ** 0, 1, ... n - 1 modulo 2**64."""
    out, done = np.ones(n, np.uint64), 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(factor, done, 1 << 64))
        done += more
    return out


class WordHashes:
    """64-bit hashes of the words of many texts at once. Words are runs of other bytes than ``gaps``; A-Z count as a-z.

    A word's hash is a polynomial of its bytes' values modulo 2**64, mixed. Sums over the words' bytes give all of them without a word of its
    own in Python, so nothing is remembered. Texts are worked through in pieces of CHUNK bytes, cut between words.
    """

    CHUNK = 1 << 18

    def __init__(self, gaps: bytes):
        self.gap = np.zeros(256, bool)
        self.gap[list(gaps)] = True
        self.value = mix(np.arange(1, 257, dtype=np.uint64))
        self.value[65:91] = self.value[97:123]
        self.value[self.gap] = 0
        self.up, self.down = self.powers(self.CHUNK)

    @staticmethod
    def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        return powers(_FACTOR, n), powers(pow(_FACTOR, -1, 1 << 64), n)

    def piece(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, places of the first bytes) of the words of a piece, which ends with a gap."""
        b = np.frombuffer(raw, np.uint8)
        up, down = (self.up, self.down) if len(b) <= self.CHUNK else self.powers(len(b))
        gap = self.gap[b]
        first = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        if not gap[0]:
            first = np.append(0, first)
        if not len(first):
            return np.empty(0, np.uint64), first
        h = self.value[b]
        h *= up[: len(b)]
        return mix(np.add.reduceat(h, first) * down[first]), first

    def long(self, raw: bytes) -> np.ndarray:
        """Hashes of the words of one text of any length."""
        out, at = [], 0
        while at < len(raw):
            end = at + self.CHUNK - 1
            if end < len(raw):
                gaps = np.flatnonzero(self.gap[np.frombuffer(raw, np.uint8, end - at, at)])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:  # a word of more than a piece
                    while end < len(raw) and not self.gap[raw[end]]:
                        end += 1
            out.append(self.piece(raw[at:end] + b" ")[0])
            at = end
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words, text after text; number of words of each text)."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        out, counts, i = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
        while i < len(raw):
            j, size = i, 0
            while j < len(raw) and size + len(raw[j]) < self.CHUNK:
                size += len(raw[j]) + 1
                j += 1
            if j == i:
                out.append(self.long(raw[i]))
                counts.append(np.array([len(out[-1])]))
                i += 1
                continue
            h, first = self.piece(b" ".join(raw[i:j]) + b" ")
            out.append(h)
            counts.append(np.diff(np.searchsorted(first, np.cumsum([len(x) + 1 for x in raw[i:j]])), prepend=0))
            i = j
        return np.concatenate(out), np.concatenate(counts)

    def each(self, texts: list[str]) -> list[np.ndarray]:
        """The hashes of each text's words."""
        h, n = self.of(texts)
        return np.split(h, np.cumsum(n)[:-1]) if len(n) else []


#: Between words: white space of ASCII, and in item texts everything in ASCII but letters and digits.
WHITE = bytes([*range(9, 14), 32])
SIGNS = bytes(i for i in range(128) if not chr(i).isalnum())


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` word hashes, in order; empty if there are fewer words."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += (h[i : i + n] ^ _MUL[(i + 7) % 16]) * _MUL[i % 16]
        out = (out << np.uint64(13)) | (out >> np.uint64(51))
    return mix(out)


def short_gram(h: np.ndarray) -> np.ndarray:
    """The whole sequence as one gram; never equal to a gram of another length."""
    return mix(grams(h, len(h)) ^ _MUL[len(h) % 16]) if len(h) else h
