"""The chunk filter over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.quality import KEEP_LENGTH, KEEP_SCORE
from siftline.functions.text import content_hash
from siftline.operators.filtering import scored


def kept_stream(chunks: DataFrame, time: str, delay: str = "1 hour", threshold: float = KEEP_SCORE, least: int = KEEP_LENGTH) -> DataFrame:
    """Chunks with a time column to those that are kept. Of equal texts within ``delay`` the one that arrives first counts; the watermark
    bounds the state. Duplicates go before the score is looked at, as in the batch filter."""
    found = scored(chunks).withColumn("content_hash", content_hash(F.coalesce(F.col("text"), F.lit(""))))
    first = found.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"])
    return first.where((F.col("quality_score") >= threshold) & (F.col("n") >= least)).select(time, "source_path", "chunk_index", F.round("quality_score", 4).alias("quality_score"), "text")
