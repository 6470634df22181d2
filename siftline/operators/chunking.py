"""Documents to overlapping chunks, by paragraphs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions.text import SPACE, bind, newlines, strip, words

MAX_TOKENS, OVERLAP = 500, 80
#: Documents that a worker cuts at once.
ROWS = 200
CHUNKS = "source_path string, chunk_index int, text string"


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...

    def decode(self, ids: list[int]) -> str: ...


def resolve_tokenizer(name: str) -> Callable[[], Tokenizer] | None:
    """A maker of the named tiktoken encoding, or None, which means words, where the library or the encoding's file can't be had."""

    def make() -> Tokenizer:
        import tiktoken

        return tiktoken.get_encoding(name)

    try:
        make()
    except Exception:  # whatever goes wrong, words are counted instead
        return None
    return make


def count_words(c: Column) -> Column:
    return F.size(words(c))


def split_paragraphs(c: Column) -> Column:
    """Stripped paragraphs between blank lines; a text without any is one paragraph."""

    def cut(bare: Column) -> Column:
        # what is split is stripped, so only a blank text has no paragraph
        return F.when(bare == "", F.array(bare)).otherwise(F.array_remove(F.transform(F.split(bare, rf"\n{SPACE}*\n+"), strip), ""))

    return bind(strip(newlines(c)), cut)


def word_windows(w: Column, size: int = MAX_TOKENS, overlap: int = OVERLAP) -> Column:
    """Texts of ``size`` words, each beginning ``overlap`` words before the last one's end; the last may lie within the one before."""
    step = max(size - overlap, 1)

    def cut(w: Column) -> Column:
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i + 1, F.lit(size)), " "))

    return bind(w, cut)


def pack(paragraphs: Column, size: int = MAX_TOKENS, overlap: int = OVERLAP) -> Column:
    """Paragraphs to chunks of at most ``size`` words: whole paragraphs as long as they fit, windows of those that alone are too long."""
    start = F.from_json(F.lit('{"done":[],"open":[],"n":0}'), "struct<done:array<string>,open:array<string>,n:int>")

    def flushed(s: Column) -> Column:
        return F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(strip(F.array_join(s["open"], "\n\n"))))).otherwise(s["done"])

    def step(s: Column, p: Column) -> Column:
        n, nothing = F.size(p["w"]), F.array().cast("array<string>")
        long, full = n > size, s["n"] + n > size
        done = F.when(long, F.concat(flushed(s), word_windows(p["w"], size, overlap))).when(full, flushed(s)).otherwise(s["done"])
        opened = F.when(long, nothing).when(full, F.array(p["p"])).otherwise(F.concat(s["open"], F.array(p["p"])))
        return F.struct(done.alias("done"), opened.alias("open"), F.when(long, 0).when(full, n).otherwise(s["n"] + n).alias("n"))

    counted = F.transform(paragraphs, lambda p: F.struct(p.alias("p"), words(p).alias("w")))
    return F.filter(F.aggregate(counted, start, step, flushed), lambda c: strip(c) != "")


def pack_tokens(paragraphs: list[str], tokenizer: Tokenizer, size: int, overlap: int) -> list[str]:
    """As ``pack``, counted in a tokenizer's tokens; each chunk then gets the last ``overlap`` tokens of the one before it.

    Windows of a long paragraph end where the paragraph does.
    """
    done: list[str] = []
    held: list[str] = []
    n = 0
    for p in paragraphs:
        ids = tokenizer.encode(p)
        if len(ids) > size or n + len(ids) > size:
            if held:
                done.append("\n\n".join(held).strip())
            held, n = [], 0
        if len(ids) > size:
            at = range(0, max(len(ids) - overlap, 1), max(size - overlap, 1))
            done += [tokenizer.decode(ids[i : i + size]).strip() for i in at]
        else:
            held.append(p)
            n += len(ids)
    if held:
        done.append("\n\n".join(held).strip())
    if overlap > 0:
        tails = [""] + [tokenizer.decode(tokenizer.encode(c)[-overlap:]).strip() for c in done[:-1]]
        done = [f"{t}\n{c}".strip() if t else c for t, c in zip(tails, done, strict=True)] if done else done
    return [c for c in done if c.strip()]


def chunk_documents(docs: DataFrame, key: str = "source_path", text: str = "text", max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, tokenizer: Callable[[], Tokenizer] | None = None) -> DataFrame:
    """(source_path, text) to (source_path, chunk_index, text), from 0 in each document. Null and blank texts have no chunks.

    Tokens are words, in the JVM; ``tokenizer`` makes another one in each worker.
    """
    paragraphs = split_paragraphs(F.coalesce(F.col(text), F.lit("")))
    named = docs.select(F.col(key).cast("string").alias("source_path"), paragraphs.alias("p"))
    if tokenizer is None:
        return named.select("source_path", F.posexplode(pack(F.col("p"), max_tokens, overlap)).alias("chunk_index", "text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = tokenizer()
        for batch in batches:
            # few documents at a time are Python's, whatever an Arrow batch has
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                cut = [pack_tokens(p, own, max_tokens, overlap) for p in part.column("p").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("source_path"), pa.array(cut, pa.list_(pa.string()))], ["source_path", "c"])

    return named.mapInArrow(run, "source_path string, c array<string>").select("source_path", F.posexplode("c").alias("chunk_index", "text"))
