"""The interactive search: linear rerank, then near-duplicates out and a cap for each document, in order of rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftline.functions.text import bind, snippet, words
from siftline.operators.search import hits as count_hits
from siftline.operators.search import nearest

# What a query word is, the bonus for each hit, and the defaults and ranges of the search.
WORD = "[A-Za-zÁÉÍÓÚÜÑáéíóúüñ0-9]{3,}"
HIT_BONUS = 0.08
TOP, TOP_RANGE = 25, (5, 80)
SIMILAR, SIMILAR_RANGE = 0.85, (0.60, 0.98)
PER_DOC, PER_DOC_RANGE = 2, (1, 6)
SHINGLE = 5


def query_words(query: Column) -> Column:
    """All words of three or more letters and digits, repeated ones too; accents stay."""
    return F.regexp_extract_all(F.lower(query), F.lit(WORD), F.lit(0))


def hits(text: Column, found: Column) -> Column:
    """How many of the words, repeated ones counted again, are in the lower-cased text."""
    return count_hits(F.lower(text), found)


def shingles(text: Column, k: int = SHINGLE) -> Column:
    """Different runs of k words; none where there are fewer words."""

    def cut(w: Column) -> Column:
        starts = F.when(F.size(w) >= k, F.sequence(F.lit(1), F.size(w) - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(k)), " ")))

    return bind(words(F.lower(text)), cut)


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all, of arrays that hold each member once; 0 where either is empty."""
    both = lambda n: n / (F.size(a) + F.size(b) - n)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(bind(F.size(F.array_intersect(a, b)), both))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty, else the empty text: field names of metadata differ."""
    return F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in columns), F.lit(""))


def linear_rerank(found: DataFrame, bonus: float = HIT_BONUS) -> DataFrame:
    """Adds rerank: score + bonus * hits."""
    return found.withColumn("rerank", F.col("score") + F.lit(bonus) * F.col("hits"))


def _in(name: str, value: float, bounds: tuple[float, float]) -> None:
    if not bounds[0] <= value <= bounds[1]:
        raise ValueError(f"{name} must be from {bounds[0]} to {bounds[1]}")


def greedy(found: DataFrame, order: list[Column], similar: float = SIMILAR, per_doc: int = PER_DOC, group: str | None = None, doc: str = "doc_path", text: str = "text") -> DataFrame:
    """In rank order, each row is kept unless its document has ``per_doc`` kept rows or it is as similar as ``similar`` to a kept row.

    A row that isn't kept keeps out no other. ``found`` is the result of a search, tens of rows for each ``group``, so one fold over an array of
    them decides. Adds position, the rank among the kept.
    """
    names = found.columns
    by = W.partitionBy(*([group] if group else [])).orderBy(*order)
    row = F.struct(F.col("rank"), F.coalesce(F.col(doc), F.lit("")).alias("doc"), shingles(F.coalesce(F.col(text), F.lit(""))).alias("sh"), F.struct(*names).alias("row"))
    each = found.withColumn("rank", F.row_number().over(by)).groupBy(*([group] if group else [])).agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def step(kept: Column, x: Column) -> Column:
        full = F.size(F.filter(kept, lambda y: y["doc"] == x["doc"])) >= per_doc
        near = F.exists(kept, lambda y: jaccard(y["sh"], x["sh"]) >= similar)
        return F.when(full | near, kept).otherwise(F.concat(kept, F.array(x)))

    chosen = each.select(F.aggregate("rows", F.filter("rows", lambda x: F.lit(False)), step).alias("kept")).select(F.posexplode("kept").alias("position", "k"))
    return chosen.select(*(F.col("k")["row"][n].alias(n) for n in names), (F.col("position") + 1).alias("position"))


def interactive_search(index: DataFrame, query: str, query_vector: Column | DataFrame, top: int = TOP, rerank: bool = True, dedup: bool = True, similar: float = SIMILAR, per_doc: int = PER_DOC, key: str = "id") -> DataFrame:
    """score, doc_path, chunk_id, id, quality_score, hits, snippet, rerank, position of the hits shown. Without hits, no rows."""
    _in("top", top, TOP_RANGE)
    _in("similar", similar, SIMILAR_RANGE)
    _in("per_doc", per_doc, PER_DOC_RANGE)
    text = F.coalesce(F.col("text"), F.lit(""))
    found = nearest(index, query_vector, top, key=key).select(
        F.col("base_score").alias("score"), F.col("source_path").alias("doc_path"), F.col("chunk_index").cast("string").alias("chunk_id"), F.col(key).alias("id"), "quality_score",
        hits(text, query_words(F.lit(query))).cast("long").alias("hits"), snippet(text).alias("snippet"), text.alias("text"),
    )
    found = linear_rerank(found, HIT_BONUS if rerank else 0.0)
    order = [F.desc("rerank"), F.desc("score"), F.asc("id")]
    shown = greedy(found, order, similar, per_doc) if dedup else found.withColumn("position", F.row_number().over(W.orderBy(*order)))
    return shown.drop("text")
