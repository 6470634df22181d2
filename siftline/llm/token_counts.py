"""Exact token counts at every prefix of a text, by dynamic programming over byte-level BPE.

The encoding of a run of bytes ends with the one token t for which the encoding of what precedes it, followed by t, is stable: the last
token before t and t don't merge otherwise when encoded together. So the last token and the count at each place follow from earlier places,
and one pass gives the counts of all prefixes. Truncation ("how long a prefix has at most n tokens?") and budgets are look-ups in them.
Texts are cut into pieces whose tokens don't depend on their surroundings; the counts of each new piece are kept in the worker's memory. The
library is only asked to which class (letter, number, white space, other) each character outside the common ones belongs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import arrow_rows, spread, text_of
from siftline.llm.pieces import BYTE_CHARACTERS, LIMIT, Classes, Memory, cut, lines, parts


class PrefixCounts:
    """tokens: pre-token to the counts of its prefixes, one for each character, the last is the total. first, spaced: piece at a line's start,
    and after a space, to its total."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        if model["type"] != "BPE" or told.get("normalizer") or told["pre_tokenizer"].get("type") != "ByteLevel" or told["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("only byte-level BPE without normaliser and added spaces is supported")
        to_byte = {c: b for b, c in BYTE_CHARACTERS.items()}
        raw = lambda t: bytes(to_byte[c] for c in t)
        self.specials = [t["content"] for t in told["added_tokens"]]
        vocabulary = {raw(t) for t in model["vocab"] if t not in self.specials}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # tokens by the order in which merges make them, single bytes first; halves of a single byte are itself
        self.order: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.left, self.right, self.joined = list(range(256)), list(range(256)), {}
        for a, b in merges:
            a, b = raw(a), raw(b)
            if a + b in self.order or a + b not in vocabulary:
                raise ValueError("a token that two merges make, or none, has no unique halves")
            x, y = self.order[a], self.order[b]
            self.joined[x << 32 | y] = self.order[a + b] = len(self.left)
            self.left.append(x)
            self.right.append(y)
        # only tokens that their own bytes are encoded to can stand in an encoding
        self.ending = ahocorasick.Automaton()
        for t, o in self.order.items():
            if self.merged(t) == [o]:
                self.ending.add_word(t.decode("latin-1"), (len(t), o))
        self.ending.make_automaton()
        self.stable: dict[int, bool] = {}
        self.tokens, self.first, self.spaced = Memory(self.pretoken, LIMIT // 3), Memory(self.total, LIMIT // 6), Memory(self.after_space, 2 * LIMIT)
        self.classes = Classes(Tokenizer.from_file(path))

    def merged(self, text: bytes) -> list[int]:
        """The tokens of a short run by its merges in order; only to prove that tokens are what their own bytes are encoded to."""
        parts = list(text)
        while len(parts) > 1:
            made, i = min((self.joined.get(parts[i] << 32 | parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
            if made == 1 << 62:
                break
            parts[i : i + 2] = [made]
        return parts

    def is_stable(self, a: int, b: int) -> bool:
        """Do tokens a and b stay apart, as they are, when encoded together? Undoes the later of their merges, one after the other, and looks
        whether a merge over the border would have come before it."""
        joined, left, right, limit = self.joined, self.left, self.right, 1 << 62
        while True:
            if joined.get(a << 32 | b, 1 << 62) < limit:
                return False
            if a > b:
                limit, a = a, right[a]
                if a == limit:
                    limit, b = b + 1, left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, left[b]
                if b + 1 == limit:
                    limit, a = a, right[a]
                    if a == limit:
                        return True

    def run(self, text: bytes) -> list[int]:
        """Counts after 1, 2, ... len(text) bytes of one pre-token. The automaton tells the tokens that end at each place, place by place."""
        last, counts, stable = [0] * (len(text) + 1), [0] * (len(text) + 1), self.stable
        for end, (size, o) in self.ending.iter(text.decode("latin-1")):
            i = end + 1
            if counts[i]:
                continue
            at = i - size
            if at:
                pair = last[at] << 32 | o
                ok = stable.get(pair)
                if ok is None:
                    if len(stable) >= LIMIT:
                        stable.clear()
                    ok = stable[pair] = self.is_stable(last[at], o)
                if not ok:
                    continue
            last[i], counts[i] = o, counts[at] + 1
        return counts[1:]

    def pretoken(self, t: str) -> tuple[int, ...]:
        counts = self.run(t.encode())
        return tuple(counts) if t.isascii() else tuple(counts[at - 1] for at in np.cumsum([len(c.encode()) for c in t]))

    def total(self, piece: str) -> int:
        """Tokens of a piece, without its prefixes'."""
        return sum([self.spaced[t[1:]] if t[0] == " " and self.classes.plain(t[1:]) else self.tokens[t][-1] for t in self.classes.pretokens(piece)])

    def after_space(self, rest: str) -> int:
        return self.run(f" {rest}".encode())[-1] if self.classes.plain(rest) else self.total(" " + rest)

    def prefixes(self, piece: str) -> list[int]:
        """Counts of all prefixes of a piece that begins a text or stands after a cut."""
        out: list[int] = []
        done = 0
        for t in self.classes.pretokens(piece):
            counts = self.tokens[t]
            if t[0] == "'" and t[1:].isascii() and t[1:].isalpha():  # until it is whole, an apostrophe's ending is the apostrophe and a word
                out += [done + self.tokens["'"][-1] + (self.tokens[t[1:i]][-1] if i > 1 else 0) for i in range(1, len(t))] + [done + counts[-1]]
            else:
                out += [done + c for c in counts]
            done += counts[-1]
        for m in self.classes.blanks(piece):  # a prefix that ends in white space ends in one pre-token of all of it
            a, b = m.span()
            base = out[a - 1] if a else 0
            out[a:b] = [base + c for c in self.tokens[piece[a:b]]]
        return out

    def longest(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens. Counts may fall as a prefix grows, but not over a cut."""
        if any(s in text for s in self.specials):
            ok = np.flatnonzero(self.every(text) <= limit)
            return int(ok[-1]) + 1 if len(ok) else 0
        best = done = 0
        for k, line in enumerate(lines(text)):
            if k:  # the newline before it
                if done == limit:
                    return best
                best, done = best + 1, done + 1
            head, rest = parts(line)
            for x in ([head] if head else []) + [" " + x for x in rest]:
                n = self.first[x] if x is head else self.spaced[x[1:]]
                if done + n > limit:
                    return max([best, *(best + i + 1 for i, c in enumerate(self.prefixes(x)) if done + c <= limit)])
                best, done = best + len(x), done + n
        return best

    def _split(self, text: str) -> list[str]:
        """A text at its special strings: odd members are special."""
        import re

        return re.split("(" + "|".join(map(re.escape, self.specials)) + ")", text) if self.specials else [text]

    def count(self, text: str) -> int:
        if any(s in text for s in self.specials):
            return sum(1 if i % 2 else self.count(x) for i, x in enumerate(self._split(text)) if x)
        if not text:
            return 0
        spaced, first, found = self.spaced.__getitem__, self.first, lines(text)
        total = len(found) - 1  # a newline between lines is a token
        for line in found:
            head, rest = parts(line)
            total += (first[head] if head else 0) + sum(map(spaced, rest))
        return total

    def every(self, text: str) -> np.ndarray:
        """The count of text[: i + 1] at i, for each character."""
        if any(s in text for s in self.specials):
            out, base, before = [], 0, ""
            for i, x in enumerate(self._split(text)):
                if i % 2:  # until it is whole, a special string is ordinary text after what precedes it
                    plain = self.every(before + x[:-1])[len(before) :] if len(x) > 1 else np.empty(0, np.int64)
                    base_before = base - self.count(before)
                    out += [base_before + plain, np.array([base + 1])]
                    base, before = base + 1, ""
                elif x:
                    out.append(base + self.every(x))
                    base, before = base + self.count(x), x
            return np.concatenate(out) if out else np.empty(0, np.int64)
        head, rest = cut(text)
        found, done = ([np.array(self.prefixes(head))] if head else []), self.total(head) if head else 0
        for x in rest:
            own = self.prefixes(" " + x)
            found.append(np.array(own) + done)
            done += own[-1]
        return np.concatenate(found) if found else np.empty(0, np.int64)


_COUNTS: dict[str, PrefixCounts] = {}


def prefix_counts(path: str) -> PrefixCounts:
    """One for each file and worker process."""
    if path not in _COUNTS:
        _COUNTS[path] = PrefixCounts(path)
    return _COUNTS[path]


def _source(docs: DataFrame) -> DataFrame:
    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))


def token_counts(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, n_bytes, n_tokens, n_chars_within), one row for each row of ``docs``: the last of each text's prefix counts,
    and the characters of its longest prefix of at most ``limit`` tokens.

    Null and empty texts have no bytes, tokens and characters. Special strings in texts count as one token, the library's default. Texts of any
    length are counted whole. Repeated rows and null ids stay. Only doc_id and text are read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = prefix_counts(tokenizer)
        for b in arrow_rows(batches, 500):
            texts = b.column(1).to_pylist()
            n = [counts.count(t) for t in texts]
            within = [len(t) if k <= limit else counts.longest(t, limit) for t, k in zip(texts, n, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(within, pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "n_chars_within"])

    return _source(docs).withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, n_chars_within long")


def prefix_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, counts array<int>): the exact token count of the first 1, 2, ... characters. Stored, it answers
    truncation (``longest_prefix``) and budget questions without encoding again. Null and empty texts have no counts; texts of any length are
    counted whole; repeated rows and null ids stay; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = prefix_counts(tokenizer)
        for b in arrow_rows(batches, 200):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([counts.every(t).astype(np.int32) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "counts"])

    return _source(docs).mapInArrow(run, "doc_id long, counts array<int>")


def longest_prefix(table: DataFrame, limit: int) -> DataFrame:
    """(doc_id, counts) to (doc_id, n_chars): the longest prefix of at most ``limit`` tokens. Counts may fall as a prefix grows, so all are read."""
    return table.select("doc_id", F.expr(f"aggregate(transform(counts, (c, i) -> if(c <= {int(limit)}, i + 1, 0)), 0, (a, x) -> greatest(a, x))").alias("n_chars"))
