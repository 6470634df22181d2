"""Files: images, markdown, chunk records, reports and indexes. All are read and written by Spark, so any store that it reaches will do. Where a
folder is a mounted one (file:), which the driver and all executors share, tasks read and write the small files in it themselves."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.text import strip

CHUNK = "source_path string, chunk_index int, text string"
FILTERED = "source_path string, chunk_index int, quality_score double, text string"
META = "id string, source_path string, chunk_index int, quality_score double, text string"
INDEX = META + ", embedding array<double>"


#: Names that a task gets, and bytes of contents that it gives on at once.
NAMES, HELD_BYTES = 500, 8 << 20


def _mounted(spark: SparkSession, folder: str) -> str | None:
    """The path of a folder in the mounted file system; None in any other store."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _small_files(spark: SparkSession, root: str, below: Callable[[str], Iterable[str]]) -> DataFrame:
    """(path, content) of the files ``below`` finds for each name in a mounted folder. The driver lists the names only; tasks do the rest."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        given = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["path", "content"])
        held, size = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for path in below(f"{root}/{name}"):
                    with open(path, "rb") as f:
                        held.append((path, f.read()))
                    size += len(held[-1][1]) + len(path)
                    if size >= HELD_BYTES:
                        yield given(held)
                        held, size = [], 0
        yield given(held)

    names = sorted(os.listdir(root))
    slices = max(1, min(len(names), max(spark.sparkContext.defaultParallelism, -(-len(names) // NAMES))))
    return spark.createDataFrame(spark.sparkContext.parallelize([(n,) for n in names], slices), "name string").mapInArrow(run, "path string, content binary")


def _image(path: str) -> bool:
    return path.endswith((".jpg", ".JPG")) and not _hidden(path) and os.path.isfile(path)


def _hidden(path: str) -> bool:
    """Names that Spark's readers skip."""
    name = path.rsplit("/", 1)[-1]
    return name.startswith(".") or name.startswith("_") and "=" not in name


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """doc (the name without its ending), path, content of the .jpg and .JPG files in a folder, not below it. A folder's name may be a pattern."""
    each = folder.endswith("/*")
    top = folder[:-2] if each else folder.rstrip("/")
    root = None if set(top) & set("*?[]{}\\") else _mounted(spark, top)
    if root is None:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,JPG}").load(folder)
    else:
        inside = lambda p: [f"{p}/{x}" for x in sorted(os.listdir(p))]
        found = _small_files(spark, root, lambda p: filter(_image, inside(p) if each and os.path.isdir(p) else [p]))
        found = found.select(F.concat(F.lit("file:"), "path").alias("path"), "content")
    return found.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("doc"), "path", "content")


def read_raw_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """doc (the folder's name), raw_md of raw.md in each folder one level down; folders without one give no row."""
    doc = lambda path: F.regexp_extract(path, r"([^/]+)/raw\.md$", 1).alias("doc")
    root = _mounted(spark, folder.rstrip("/"))
    if root is not None:
        found = _small_files(spark, root, lambda p: filter(os.path.isfile, [f"{p}/raw.md"]))
        return found.select(doc(F.col("path")), F.col("content").cast("string").alias("raw_md"))
    found = spark.read.text(f"{folder.rstrip('/')}/*/raw.md", wholetext=True)
    return found.select(doc(F.url_decode(F.col("_metadata.file_path"))), F.col("value").alias("raw_md"))


def _markdown_below(top: str) -> Iterator[str]:
    if not _hidden(top):
        if os.path.isfile(top):
            yield from [top] if top.endswith(".md") else []
        elif os.path.isdir(top):
            for name in sorted(os.listdir(top)):
                yield from _markdown_below(f"{top}/{name}")


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """source_path (below the folder), text of all .md files at any depth. Bytes that aren't UTF-8 become U+FFFD."""
    path, root = F.col("path"), _mounted(spark, folder.rstrip("/"))
    text = F.make_valid_utf8(F.col("content").cast("string")).alias("text")
    if root is not None:
        return _small_files(spark, root, _markdown_below).select(F.substring(path, F.lit(len(root) + 2), F.length(path)).alias("source_path"), text)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split(F.lit(folder.rstrip("/")), "/"), -1)
    return found.select(F.substring(path, F.instr(path, F.concat(F.lit("/"), name, F.lit("/"))) + F.length(name) + 2, F.length(path)).alias("source_path"), text)


def write_markdown(df: DataFrame, path: str, key: str = "source_path", text: str = "text") -> None:
    """One row a document, in Parquet; a file for each document is ``write_documents_as_files``."""
    df.select(F.col(key), F.col(text)).write.mode("overwrite").parquet(path)


def write_documents_as_files(df: DataFrame, path: str, key: str = "source_path", text: str = "text") -> None:
    """A folder named after each document, with its text in it; for the few thousand documents that people look at."""
    df.select(F.col(key).alias("document"), F.col(text).alias("value")).repartition("document").write.mode("overwrite").partitionBy("document").text(path)


def _put(path: str, name: str, values: list[bytes]) -> None:
    """A file that is there as a whole or not at all, whichever attempt of a task writes it."""
    from uuid import uuid4

    os.makedirs(path, exist_ok=True)
    part = f"{path}/.{name}.{uuid4().hex}"
    with open(part, "wb") as f:
        for v in values:
            f.write(v + b"\n")
    if os.path.exists(crc := f"{path}/.{name}.crc"):  # the checksum of a file that was here before
        os.unlink(crc)
    os.replace(part, f"{path}/{name}")


def write_named_files(df: DataFrame, path: str, name: str, key: str = "source_path", text: str = "text") -> None:
    """The text of each document in a file ``name`` in a folder of the document's name (raw.md, a layout's JSON, ERROR.txt), a line end added; null
    texts have none, and texts of one document follow each other. In a mounted folder the tasks write the files. In other stores Spark does, and they
    get their names on the driver, several at a time."""
    spark = df.sparkSession
    docs = df.where(F.col(text).isNotNull()).select(F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("document"), F.col(text).cast("string").alias("value")).repartition("document")
    root = _mounted(spark, path.rstrip("/"))
    if root is None:
        return _named_on_driver(docs, path, name)

    def run(batches: Iterator) -> Iterator:
        rows = ((d.as_py(), v.as_py()) for batch in batches for d, v in zip(batch.column(0), batch.column(1), strict=True))
        for document, same in groupby(rows, lambda r: r[0]):
            _put(f"{root}/{document}", name, [v for _, v in same])
        yield from ()

    os.makedirs(root, exist_ok=True)
    docs.sortWithinPartitions("document").select("document", F.col("value").cast("binary").alias("value")).mapInArrow(run, "document string").write.format("noop").mode("overwrite").save()


def _named_on_driver(docs: DataFrame, path: str, name: str) -> None:
    from concurrent.futures import ThreadPoolExecutor
    from urllib.parse import unquote

    spark, parts = docs.sparkSession, f"{path.rstrip('/')}/_parts"
    docs.write.mode("overwrite").partitionBy("document").text(parts)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(parts).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def named(folder) -> None:
        kind, _, document = folder.getName().partition("=")
        if kind == "document":
            to = hadoop.Path(f"{path.rstrip('/')}/{unquote(document)}")
            fs.mkdirs(to)
            for file in fs.listStatus(folder):
                fs.rename(file.getPath(), hadoop.Path(to, name))

    with ThreadPoolExecutor(32) as pool:
        list(pool.map(named, [x.getPath() for x in fs.listStatus(hadoop.Path(parts))]))
    fs.delete(hadoop.Path(parts), True)


def write_layouts(parsed: DataFrame, path: str, key: str = "doc") -> None:
    """The layout of each document as layout.json in its folder."""
    write_named_files(parsed, path, "layout.json", key, "layout_json")


def read_chunk_lines(spark: SparkSession, path: str) -> DataFrame:
    """Chunk records, with is_blank for lines that hold none; these count as dropped. A missing text is empty, a missing key stops the job."""
    raw = spark.read.text(path).select(F.col("value"), (strip(F.col("value")) == "").alias("is_blank"))
    parsed = raw.select("is_blank", F.from_json("value", CHUNK, {"mode": "FAILFAST"}).alias("c"))
    missing = ~F.col("is_blank") & (F.col("c.source_path").isNull() | F.col("c.chunk_index").isNull())
    path_col = F.when(missing, F.raise_error(F.lit("a chunk record has no source_path or chunk_index"))).otherwise(F.col("c.source_path"))
    return parsed.select("is_blank", path_col.cast("string").alias("source_path"), F.col("c.chunk_index").alias("chunk_index"), F.coalesce("c.text", F.lit("")).alias("text"))


def read_chunks(spark: SparkSession, path: str, schema: str = CHUNK) -> DataFrame:
    """Chunk records without blank lines."""
    return spark.read.schema(schema).json(path).where("source_path is not null")


def write_records(df: DataFrame, path: str) -> None:
    """JSON lines; texts as they are in UTF-8."""
    df.write.mode("overwrite").json(path)


def write_chunk_texts(chunks: DataFrame, path: str) -> None:
    """A folder for each document and chunk, named after the document's path without its ending and chunk_NNNN, with the text in it."""
    stem = F.regexp_replace("source_path", r"\.[^./]+$", "")
    named = chunks.select(F.concat(stem, F.lit("/chunk_"), F.lpad(F.col("chunk_index").cast("string"), 4, "0")).alias("chunk"), F.concat("text", F.lit("\n")).alias("value"))
    named.repartition("chunk").write.mode("overwrite").partitionBy("chunk").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """The one row of a report, as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """A report, or None if there is none that can be read."""
    from pyspark.errors import PySparkException

    try:
        found = spark.read.json(path)
        return found if "kept" in found.columns else None
    except PySparkException:
        return None


def write_index(index: DataFrame, path: str) -> None:
    """Metadata and vectors in one table, so a vector's row is its metadata."""
    index.select("id", "source_path", "chunk_index", F.col("quality_score").cast("double").alias("quality_score"), "text", F.col("embedding").cast("array<double>").alias("embedding")).write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(path)


_HELD: dict[tuple[str, str], DataFrame] = {}


def held_index(spark: SparkSession, path: str) -> DataFrame:
    """An index that stays in the executors' memory, spilled to disk where it is too large, for further searches of the session."""
    at = (spark.sparkContext.applicationId, path)
    if at not in _HELD:
        _HELD[at] = read_index(spark, path).persist()
    return _HELD[at]


def release_index(spark: SparkSession, path: str) -> None:
    """Ends what ``held_index`` began."""
    held = _HELD.pop((spark.sparkContext.applicationId, path), None)
    if held is not None:
        held.unpersist()
