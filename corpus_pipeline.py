"""A corpus from raw documents to checked tokens, stage by stage.

Every stage takes what its predecessor kept, whole, and what it decides takes effect: rows that it drops are gone for all later stages. All stages
but the last return the columns of documents as they came. Null ids and texts, repeated rows and empty tables are as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import quality
from siftline.llm.common import drop_written, table, text_of, written
from siftline.llm.decontamination import contamination
from siftline.llm.exact_dedup import digest, exact_duplicates
from siftline.llm.near_dedup import near_duplicates
from siftline.llm.pieces import vocabulary
from siftline.llm.sentencepieces import encoded

#: Documents scored lower are rejected.
GOOD = 0.3


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Good documents, by a classifier of the labelled ones that aren't held out. Each row is scored by its whole text, null as the empty one;
    a score of just GOOD is accepted. Without labels of both kinds every score is 0.5, and all rows stay. Null ids and repeated rows are rows
    like others; an empty table gives none."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    return quality.accepted(docs, model, GOOD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, null as the empty one, the document of the largest id. A null id is smaller than all others; rows that repeat the id that
    stays are the same document and stay, too. Whole texts are compared; an empty table gives no rows."""
    found = exact_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (digest(text_of()) == F.col("_digest"))
    return docs.join(written(found, "copies"), same, "left_anti")


def _same(ids: str, digests: str):
    return F.col("doc_id").eqNullSafe(F.col(ids)) & (digest(text_of()) == F.col(digests))


def _without(spark: SparkSession, docs: DataFrame, dropped, name: str) -> DataFrame:
    """The rows that ``dropped`` (documents to the doc_id of those that go) doesn't name.

    A doc_id is a row where none is null or has several texts. Elsewhere each pair of doc_id and text gets a number, by doc_id and nulls last,
    that stands for its doc_id.
    """
    rows = docs.select("doc_id", digest(text_of()).alias("_digest")).distinct()
    if rows.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        gone = written(dropped(docs).select(F.col("doc_id").alias("_id")).distinct(), name)
        return docs.join(gone, F.col("doc_id") == F.col("_id"), "left_anti")
    numbers = written(rows.select(F.col("doc_id").alias("_id"), "_digest").sort(F.col("_id").asc_nulls_last(), "_digest").withColumn("_row", F.monotonically_increasing_id()), "rows")
    numbered = written(docs.join(numbers, _same("_id", "_digest")).select(F.col("_row").alias("doc_id"), "text"), "numbered")
    gone = dropped(numbered).select(F.col("doc_id").alias("_row")).distinct()
    return docs.join(written(numbers.join(gone, "_row").select("_id", "_digest"), name), _same("_id", "_digest"), "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, a similarity of 0.8 or more) the document of the smallest id, a null id after all
    others. Texts without words, null ones too, are like none and stay. An empty table gives no rows."""
    return _without(spark, docs, lambda d: near_duplicates(d, k=5, percent=80).where("not kept"), "near")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item, each row by its own whole text. Texts without words, null ones too, stay; without items all
    do. An empty table gives no rows."""
    return _without(spark, docs, lambda d: contamination(d, table(spark, sf_dir, "benchmark")).where("contaminated"), "leaks")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded of each row, null ids and repeated rows too; a null text is the end id alone."""
    return encoded(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding and decoding", tokenize),
]
#: No stage but exact dedup can be told in SQL; tests/llm/test_pipeline.py holds the rows against a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        after = written(stage(spark, docs, sf_dir), "stage")
        if k:
            drop_written(spark, docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
