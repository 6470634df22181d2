"""Scoring of chunks, keep-first duplicates, the keep decision, and reports on what was dropped and why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions.numbers import rounded
from siftline.functions.quality import KEEP_LENGTH, KEEP_SCORE, STATS, met, reasons, score, stats
from siftline.functions.text import content_hash
from siftline.plans.stored import stored

ORDER = ("source_path", "chunk_index")
TOP_REASONS, CHART_REASONS = 15, 12


def scored(chunks: DataFrame) -> DataFrame:
    """Adds the ten statistics, quality_score and score_reasons. Null texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    s, applies = F.col("stats"), F.col("_met")
    found = chunks.withColumn("stats", stats(text)).withColumn("_met", met(s, text))
    return found.select(*chunks.columns, *(s[k].alias(k) for k in STATS), score(s, text, applies).alias("quality_score"), reasons(s, text, applies).alias("score_reasons"))


def with_duplicates(chunks: DataFrame, texts: bool = True) -> DataFrame:
    """Adds content_hash and is_duplicate: true but for the first chunk, by source_path and chunk_index, of those with a hash. Without ``texts``
    the text goes, and isn't written.

    Chunks and hashes are worked out once, into a table. The first of each repeated hash comes from a partial aggregate and is joined back from
    a table, too, so a text with any number of copies is never gathered in one task, as a window over the hash would: Spark broadcasts the repeated
    hashes where they are few, and splits the rows of hot ones where they are many.
    """
    hashed = chunks.withColumn("content_hash", content_hash(F.coalesce(F.col("text"), F.lit(""))))
    hashed = stored(hashed if texts else hashed.drop("text"), "hashed")
    place = F.struct(*ORDER)
    first = stored(hashed.groupBy("content_hash").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"), "first")
    return hashed.join(first, "content_hash", "left").withColumn("is_duplicate", F.coalesce(place != F.col("first"), F.lit(False))).drop("first")


def judged(chunks: DataFrame, threshold: float = KEEP_SCORE, least: int = KEEP_LENGTH, texts: bool = True) -> DataFrame:
    """Adds keep and drop_reasons. A chunk that is itself dropped still makes its later copies duplicates. Reports need no ``texts``."""
    found = with_duplicates(scored(chunks), texts)
    low, short = F.col("quality_score") < threshold, F.col("n") < least
    extra = F.array(F.when(F.col("is_duplicate"), "duplicate"), F.when(short, "too_short"))
    why = F.concat(F.array_compact(extra), F.col("score_reasons"), F.array_compact(F.array(F.when(low, "below_threshold"))))
    keep = ~low & ~short & ~F.col("is_duplicate")
    return found.withColumn("keep", keep).withColumn("drop_reasons", F.when(keep, F.array().cast("array<string>")).otherwise(why))


def kept(judgements: DataFrame) -> DataFrame:
    """The filtered chunks: the text as it came, the score to four places."""
    return judgements.where("keep").select("source_path", "chunk_index", rounded("quality_score", 4).alias("quality_score"), "text")


def drop_reasons(judgements: DataFrame, blank_lines: int = 0) -> DataFrame:
    """reason, count over dropped chunks, each of which may have several; ``blank_lines`` of the input count as ``empty_line``."""
    found = judgements.where("not keep").select(F.explode("drop_reasons").alias("reason"))
    if blank_lines:
        found = found.union(found.sparkSession.range(blank_lines).select(F.lit("empty_line")))
    return found.groupBy("reason").agg(F.count("*").alias("count"))


def top_reasons(counted: DataFrame, most: int = TOP_REASONS) -> DataFrame:
    """The commonest reasons; ties by name."""
    return counted.orderBy(F.desc("count"), "reason").limit(most)


def report(judgements: DataFrame, threshold: float = KEEP_SCORE, blank_lines: int = 0) -> DataFrame:
    """One row: threshold, kept, dropped, kept_unique_docs, docs_with_zero_kept_chunks, and count, min, max and mean of the kept scores."""
    docs = judgements.groupBy("source_path").agg(F.count_if("keep").alias("k"), F.count_if(~F.col("keep")).alias("d"), *(f(F.when(F.col("keep"), F.col("quality_score"))).alias(n) for n, f in (("lo", F.min), ("hi", F.max), ("total", F.sum))))
    kept_rows = F.coalesce(F.sum("k"), F.lit(0))
    return docs.agg(
        F.lit(float(threshold)).alias("threshold"), kept_rows.alias("kept"), (F.coalesce(F.sum("d"), F.lit(0)) + F.lit(blank_lines)).alias("dropped"), F.count_if(F.col("k") > 0).alias("kept_unique_docs"),
        F.count_if(F.col("k") == 0).alias("docs_with_zero_kept_chunks"), kept_rows.alias("score_count"), F.min("lo").alias("score_min"), F.max("hi").alias("score_max"), (F.sum("total") / F.nullif(F.sum("k"), F.lit(0))).alias("score_avg"),
    )


def per_document(judgements: DataFrame) -> DataFrame:
    """Kept and dropped chunks of each document."""
    return judgements.groupBy("source_path").agg(F.count_if("keep").alias("kept"), F.count_if(~F.col("keep")).alias("dropped"))


def full_report(judgements: DataFrame, threshold: float = KEEP_SCORE, blank_lines: int = 0) -> DataFrame:
    """The report's one row with the commonest reasons as an array of (reason, count)."""
    tops = top_reasons(drop_reasons(judgements, blank_lines)).agg(F.expr("array_sort(collect_list(struct(`count`, reason)), (x, y) -> case when x.`count` <> y.`count` then cast(sign(y.`count` - x.`count`) as int) when x.reason < y.reason then -1 else 1 end)").alias("r"))
    return report(judgements, threshold, blank_lines).crossJoin(F.broadcast(tops.select(F.expr("transform(r, x -> struct(x.reason, x.`count`))").alias("drop_reasons_top"))))
