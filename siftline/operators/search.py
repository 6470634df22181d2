"""Exact vector search, keyword-aware reranking, and the best documents with their best chunks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftline.functions import vectors
from siftline.functions.text import fold, strip
from siftline.plans.stored import stored

# Words that say nothing about a query, signs of official templates, weights of the rerank, sizes of the searches.
STOP = (
    "ecuador quito guayaquil enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre "
    "lunes martes miercoles jueves viernes sabado domingo ano anos del de la el los las para por con una un y o en al se su sus "
    "1999 2000 2001 2002 2003 2004 2005"
).split()
OFFICIAL = r"(?iU)\b(ing\.|ministro|ministra|ministerio|obras publicas|comunicaciones|republica|presidente constitucional)\b"
HIT_BONUS, FEW_HITS_COST, NO_HITS_COST, OFFICIAL_COST = 0.03, 0.20, 0.10, 0.05
TOPIC_WORD, TOPIC_STEM, TOPIC_COST = "politica", "politic", 0.35
BEST_CHUNKS, ALL_CHUNKS, DOCS, PER_DOC, WEAK = 400, 700, 5, 2, 0.45


@dataclass(frozen=True)
class Topic:
    """A query word that asks for a stem, and what a text without the stem loses."""

    word: str = TOPIC_WORD
    stem: str = TOPIC_STEM
    cost: float = TOPIC_COST


def query_words(query: Column, stop: list[str] | tuple[str, ...] = tuple(STOP)) -> Column:
    """Different words of four or more characters of the folded query, in order, without stop words."""
    found = F.regexp_extract_all(fold(query), F.lit(r"(?U)\w+"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) >= 4) & ~w.isin(list(stop))))


def hits(folded: Column, words: Column) -> Column:
    """How many of the words are in the text, also inside other words."""
    return F.size(F.filter(words, lambda w: F.contains(folded, w)))


def rerank(base: Column, folded: Column, words: Column, topic: Topic = Topic()) -> tuple[Column, Column]:
    """(score, hits) of a hit from its vector score and its folded text. The costs of few and of no hits add up."""
    n = hits(folded, words)
    found = base + F.lit(HIT_BONUS) * n
    found = found - F.when(F.array_contains(words, topic.word) & ~F.contains(folded, F.lit(topic.stem)), topic.cost).otherwise(0.0)
    found = found - F.when((F.size(words) >= 2) & (n < 2), FEW_HITS_COST).otherwise(0.0)
    found = found - F.when((F.size(words) > 0) & (n == 0), NO_HITS_COST).otherwise(0.0)
    return found - F.when(folded.rlike(OFFICIAL), OFFICIAL_COST).otherwise(0.0), n


def build_index(chunks: DataFrame, embeddings: DataFrame, normalized: bool = True) -> DataFrame:
    """(source_path, chunk_index, text[, quality_score]) and (id, embedding) to the index table: id, source_path, chunk_index, quality_score,
    text, embedding. The id is ``source_path::#chunk_index``. Chunks without a vector are left out; all vectors must have one length.
    """
    score = F.col("quality_score").cast("double") if "quality_score" in chunks.columns else F.lit(None).cast("double")
    named = chunks.select(F.concat_ws("::#", "source_path", F.col("chunk_index").cast("string")).alias("id"), "source_path", "chunk_index", score.alias("quality_score"), "text")
    vector = vectors.normalize(F.col("embedding")) if normalized else F.col("embedding").cast("array<double>")
    return named.join(embeddings.select("id", vector.alias("embedding")), "id")


def dimensions(index: DataFrame) -> DataFrame:
    """The lengths of the vectors, with how many have each: an index has one row here."""
    return index.groupBy(F.size("embedding").alias("dimension")).agg(F.count("*").alias("vectors"))


def nearest(index: DataFrame, query: Column | DataFrame, k: int, metric: str = "ip", key: str = "id", vector: str = "embedding") -> DataFrame:
    """The k rows of the highest score, with base_score: the inner product, or with metric ``l2`` the negated squared distance. Ties by key.

    ``query``: a literal vector, or a table of one row with the column ``query_vector``, which is broadcast. Only key and score are sorted, each
    task keeping its own best k (TakeOrderedAndProject); the other columns are then joined back to k rows.
    """
    measure = {"ip": vectors.dot, "l2": lambda a, b: F.lit(0.0) - vectors.squared_distance(a, b)}[metric]
    if isinstance(query, DataFrame):
        pairs = index.select(key, vector).crossJoin(F.broadcast(query.select("query_vector").limit(1)))
        found = pairs.select(key, measure(F.col(vector), F.col("query_vector")).alias("base_score"))
    else:
        found = index.select(key, measure(F.col(vector), query).alias("base_score"))
    best = found.where("base_score is not null").orderBy(F.desc("base_score"), key).limit(k)
    return index.join(F.broadcast(best), key)


def reranked(found: DataFrame, query: str, topic: Topic = Topic(), stop: list[str] | tuple[str, ...] = tuple(STOP)) -> DataFrame:
    """Adds query_words, hits and score to hits with base_score and text."""
    words = query_words(F.lit(query), stop)
    with_words = found.withColumn("query_words", words).withColumn("folded", fold(F.coalesce(F.col("text"), F.lit(""))))
    score, n = rerank(F.col("base_score"), F.col("folded"), F.col("query_words"), topic)
    return with_words.withColumn("score", score).withColumn("hits", n).drop("folded")


def best_documents(found: DataFrame, docs: int = DOCS, per_doc: int = PER_DOC, key: str = "id") -> DataFrame:
    """Of reranked hits the best ``docs`` documents, each with its best ``per_doc`` chunks: rows with doc_rank, doc_score, chunk_rank.

    In each document only the hits with all query words count, or if it has none, those with all but one, or else all. doc_score is the best
    score among those that count. Ties by base score, then key; documents of one score by source_path. A search's hits are few hundred rows.
    """
    need = F.size("query_words")
    tier = F.when((need > 0) & (F.col("hits") >= need), 0).when((need > 0) & (F.col("hits") == need - 1), 1).otherwise(2)
    own = W.partitionBy("source_path")
    in_tier = found.withColumn("tier", tier).withColumn("best_tier", F.min("tier").over(own)).where("tier = best_tier").drop("best_tier")
    ranked = in_tier.withColumn("doc_score", F.max("score").over(own)).withColumn("chunk_rank", F.row_number().over(own.orderBy(F.desc("score"), F.desc("base_score"), key))).where(F.col("chunk_rank") <= per_doc)
    tops = ranked.where("chunk_rank = 1").orderBy(F.desc("doc_score"), "source_path").limit(docs).select("source_path", F.row_number().over(W.orderBy(F.desc("doc_score"), "source_path")).alias("doc_rank"))
    return ranked.join(F.broadcast(tops), "source_path")


def search_documents(index: DataFrame, query: str, query_vector: Column | DataFrame, oversample: int = BEST_CHUNKS, docs: int = DOCS, per_doc: int = PER_DOC, topic: Topic = Topic(), key: str = "id") -> DataFrame:
    """Nearest chunks, reranked, by document."""
    return best_documents(reranked(nearest(index, query_vector, oversample, key=key), query, topic), docs, per_doc, key)


def search_with_fallback(best: DataFrame, every: DataFrame, query: str, query_vector: Column | DataFrame, docs: int = DOCS, per_doc: int = PER_DOC, weak: float = WEAK, topic: Topic = Topic(), key: str = "id") -> DataFrame:
    """The search in the high-quality chunks; where its best document scores under ``weak`` or there is none, that in all chunks. Adds label.

    The few rows of the first search are written, and their best score decides whether the second is run at all.
    """
    high = stored(search_documents(best, query, query_vector, BEST_CHUNKS, docs, per_doc, topic, key), "high")
    top = high.agg(F.max("doc_score")).first()[0]
    if top is not None and top >= weak:
        return high.withColumn("label", F.lit("HQ"))
    return search_documents(every, query, query_vector, ALL_CHUNKS, docs, per_doc, topic, key).withColumn("label", F.lit("ALL"))


def full_text(found: DataFrame, docs: DataFrame, size: int = 6000) -> DataFrame:
    """Adds full_text, the beginning of each hit's document; null where the document isn't there."""
    texts = docs.select("source_path", F.left("text", F.lit(size)).alias("full_text"))
    return found.join(texts, "source_path", "left")


def is_blank(c: Column) -> Column:
    return strip(c) == ""
