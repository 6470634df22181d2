"""What needs a model from outside: text from images, and vectors of texts. Both are parameters; failures are rows, not the end of a job."""

from __future__ import annotations

import html
import json
import re
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Extractor = Callable[[bytes], tuple[str, dict]]
Embedder = Callable[[list[str]], list[list[float]]]
PARSED = "doc string, raw_md string, layout_json string, error string"
BATCH, TIMEOUT = 16, 120


def html_extractor(content: bytes) -> tuple[str, dict]:
    """Markup to plain markdown: no scripts and styles, a blank line between blocks, headings marked; the layout lists the blocks."""
    text = content.decode("utf-8", "replace")
    text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>", "", text)
    text = re.sub(r"(?i)<h([1-6])\b[^>]*>", lambda m: "\n\n" + "#" * int(m[1]) + " ", text)
    text = re.sub(r"(?i)</?(p|div|section|article|header|footer|ul|ol|li|table|tr|h[1-6]|br|body|html|head|title)\b[^>]*>", "\n\n", text)
    blocks = [b for b in (html.unescape(re.sub(r"(?s)<!--.*?-->|<[^>]*>", "", x)).strip() for x in text.split("\n\n")) if b]
    return "\n\n".join(blocks), {"blocks": [{"text": b} for b in blocks]}


def parse(files: DataFrame, extractor: Extractor = html_extractor, key: str = "doc", content: str = "content") -> DataFrame:
    """(doc, content) to (doc, raw_md, layout_json, error). A document that fails has its error and no text; a layout that can't be written as
    JSON doesn't cost the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, raw in zip(pdf["doc"], pdf["content"], strict=True):
                try:
                    text, layout = extractor(bytes(raw or b""))
                except Exception as e:  # whatever an extractor raises is that document's error
                    rows.append((doc, None, None, repr(e)))
                    continue
                try:
                    rows.append((doc, text, json.dumps(layout, ensure_ascii=False), None))
                except (TypeError, ValueError) as e:
                    rows.append((doc, text, None, repr(e)))
            yield pd.DataFrame(rows, columns=["doc", "raw_md", "layout_json", "error"], dtype="object")

    return files.select(F.col(key).cast("string").alias("doc"), F.col(content).cast("binary").alias("content")).mapInPandas(run, PARSED)


def failed(parsed: DataFrame) -> DataFrame:
    """The dead letters: doc, error."""
    return parsed.where("error is not null").select("doc", "error")


def http_embedder(host: str, model: str, timeout: float = TIMEOUT) -> Embedder:
    """Asks a service for one vector a text; any failure is raised."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            body = json.dumps({"model": model, "prompt": t}).encode()
            asked = urllib.request.Request(host.rstrip("/") + "/api/embeddings", body, {"Content-Type": "application/json"})
            with urllib.request.urlopen(asked, timeout=timeout) as said:
                out.append(json.load(said)["embedding"])
        return out

    return embed


def embed(rows: DataFrame, embedder: Embedder, key: str = "id", text: str = "text", batch: int = BATCH) -> DataFrame:
    """(id, text) to (id, embedding), ``batch`` texts at a time in each task. Null texts are empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            found = [v for i in range(0, len(texts), batch) for v in embedder(texts[i : i + batch])]
            yield pd.DataFrame({"id": pdf["id"], "embedding": [[float(x) for x in v] for v in found]})

    return rows.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(run, "id string, embedding array<float>")
