"""Raw documents to an index and a report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.operators.chunking import MAX_TOKENS, OVERLAP, chunk_documents
from siftline.operators.cleaning import Rules, clean_documents
from siftline.operators.filtering import full_report, judged, kept
from siftline.operators.search import build_index
from siftline.sources.plugins import Embedder, embed


@dataclass(frozen=True)
class Corpus:
    """cleaned: source_path, text. chunks: with chunk_index. judgements: chunks with statistics, score, duplicates and reasons."""

    cleaned: DataFrame
    chunks: DataFrame
    judgements: DataFrame

    @property
    def kept(self) -> DataFrame:
        return kept(self.judgements)

    @property
    def report(self) -> DataFrame:
        return full_report(self.judgements)

    def index(self, embedder: Embedder, best: bool = True, normalized: bool = True) -> DataFrame:
        """The index of the kept chunks, or of all."""
        chunks = self.kept if best else self.chunks
        named = chunks.select(F.concat_ws("::#", "source_path", F.col("chunk_index").cast("string")).alias("id"), "text")
        return build_index(chunks, embed(named, embedder), normalized)


def build(raw: DataFrame, key: str = "doc", text: str = "raw_md", rules: Rules = Rules(), max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP) -> Corpus:
    """One lazy lineage from raw markdown to judged chunks; its only shuffle is that of repeated hashes."""
    cleaned = clean_documents(raw, key, text, rules)
    chunks = chunk_documents(cleaned, max_tokens=max_tokens, overlap=overlap)
    return Corpus(cleaned, chunks, judged(chunks))
