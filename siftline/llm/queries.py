"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import quality, toxicity
from siftline.llm.common import scratch_path, table
from siftline.llm.decontamination import contamination
from siftline.llm.exact_dedup import exact_duplicates
from siftline.llm.near_dedup import near_duplicates
from siftline.llm.pieces import vocabulary
from siftline.llm.pii import KINDS, personal_data
from siftline.llm.sentencepieces import digests
from siftline.llm.substring_dedup import repeated_passages
from siftline.llm.token_counts import token_counts
from siftline.llm.token_store import read_store, write_store


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles of whole texts, links at 80 % or more, in components."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80).drop("class_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal whole texts; the row of the largest id stays."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a store, verifies its manifest, reads it back and stops at a wrong digest or root."""
    path, tokenizer = scratch_path(spark, "store"), vocabulary("byte_bpe_50k.json")
    write_store(table(spark, sf_dir, "documents"), path, tokenizer, end_id=0)
    found = read_store(spark, path, tokenizer)
    return found.select("doc_id", "start", "n_tokens", F.when(F.col("sound"), F.col("ids_crc32")).otherwise(F.raise_error(F.lit("a digest or root is wrong"))).cast("long").alias("ids_crc32"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and disguised personal data of whole texts; the counts and base_sha256 are of the plain ones."""
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(found, x -> x.plain and x.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, "base_sha256", "spans", F.size("found").cast("long").alias("n_spans"))


def pii_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op4_pii that SQL can tell: the plain spans."""
    return op4_pii(spark, sf_dir).drop("spans", "n_spans")


def _remainder(parts: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of all items in whole texts."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of whole texts by a model of the labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), _remainder(5) != 0)
    return quality.scored(docs, model).select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of whole texts by a model of the labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), _remainder(3) != 1)
    return toxicity.scored(docs, model).select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more of whole texts that fuzzily repeat across documents."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with the end id, and what they decode to, of whole texts, as digests."""
    return digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of whole texts, and the characters that a budget of 1024 tokens allows."""
    found = token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=1024)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "n_chars_within")


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_store": op3_token_store,
    "op4_pii": op4_pii,
    "pii_plain": pii_plain,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_token_counts": op10_token_counts,
}
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _spans(no: int, kind: str, pattern: str, ok: str) -> str:
    """Matches m of a pattern that pass a check, with their places; signs of no text stand around them first."""
    return f"""SELECT doc_id, {no} AS no, '{kind}' AS kind, list_sum(list_transform(parts[1 : k - 1], lambda p: len(p)))::BIGINT AS b, m FROM
        (SELECT doc_id, parts, unnest(range(2, len(parts) + 1, 2)) AS k, parts[k] AS m, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM
            (SELECT doc_id, regexp_split_to_array(regexp_replace(coalesce(text, ''), '({pattern})', chr(57344) || '\\1' || chr(57344), 'g'), chr(57344)) AS parts FROM documents)) WHERE {ok}"""


_LUHN = "list_sum(list_transform(range(0, len(d)), lambda i: CASE WHEN i % 2 = 0 THEN reverse(d)[i + 1]::INTEGER ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][reverse(d)[i + 1]::INTEGER + 1] END)) % 10 = 0"
ORACLE_SQL: dict[str, str] = {
    "op1_minhash": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        sets AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
        each AS (SELECT doc_id, unnest(s) AS g FROM sets),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM each x JOIN each y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
        edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT DISTINCT a AS doc_id, a AS c FROM edges UNION SELECT e.b, r.c FROM reach r JOIN edges e ON e.a = r.doc_id AND e.b > r.c),
        least AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY 1)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(l.c, s.doc_id) AS component_id, coalesce(l.c, s.doc_id) = s.doc_id AS kept FROM sets s LEFT JOIN least l ON l.doc_id = s.doc_id""",
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
    "pii_plain": f"""
        WITH spans AS ({_spans(1, "email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+", "true")}
            UNION ALL {_spans(2, "ip", "[0-9]+(?:\\.[0-9]+)(?:\\.[0-9]+)(?:\\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda p: coalesce(TRY_CAST(p AS HUGEINT) <= 255, false))) = 4")}
            UNION ALL {_spans(3, "card", "[0-9](?:[\\x20-]?[0-9])+", f"len(d) BETWEEN 12 AND 19 AND {_LUHN}")}
            UNION ALL {_spans(4, "phone", "\\+[0-9][\\x20().0-9-]+[0-9]", "len(d) BETWEEN 9 AND 15")})
        SELECT d.doc_id, count(*) FILTER (no = 1) AS n_email, count(*) FILTER (no = 2) AS n_ip, count(*) FILTER (no = 3) AS n_card, count(*) FILTER (no = 4) AS n_phone,
               sha256(coalesce(string_agg(kind || ':' || b || ':' || (b + len(m)), ',' ORDER BY b, no), '')) AS base_sha256
        FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op5_decontamination": f"""
        WITH words AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
        items AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
        windows AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i : i + n - 1], ' '))) AS g FROM items),
        places AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, array_to_string(ws[i : i + n - 1], ' ') AS g FROM words, (SELECT DISTINCT n FROM items) WHERE len(ws) >= n),
        hits AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN windows w ON p.n = w.n AND p.g = w.g),
        covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
        named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS names FROM hits GROUP BY 1)
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words w LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
}
