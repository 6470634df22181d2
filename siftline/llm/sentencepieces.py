"""SentencePiece encoding and decoding for vocabularies of merges.

Encoding keeps an agenda of adjacent symbol pairs that are pieces, ordered by score, then by place, and merges the first until none is left.
Where no piece has a word sign after another character, merges never cross a word's start, so texts are cut there; each new word is encoded
by the agenda and decoded, then kept in the worker's memory. What was new in an Arrow batch is checked against the sentencepiece library
before the batch is passed on.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import arrow_rows, spread, text_of
from siftline.llm.pieces import Memory

SIGN = "▁"
#: Characters of a part up to which its agenda is a row of a table, worked through together with the rows of the batch's other new parts; a
#: longer one has a heap of its own. Rows of such a table at most.
SHORT, ROWS = 32, 5_000
#: Words and parts that a worker remembers, and texts of a batch: where ids go out with texts, and where only digests do.
KNOWN, TEXTS = (150_000, 600_000), (500, 1000)
_NONE, _GONE = np.int32(2**31 - 1), -(2**31)
_RUNS = re.compile(f"{SIGN}+[^{SIGN}]*")
Word = tuple[bytes, int, str]


class Pieces:
    """Words to (decimal ids, each after a space; their number; decoded text)."""

    def __init__(self, path: str, known: int = KNOWN[0]):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, trained = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if trained.model_type != 2 or spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not trained.byte_fallback or trained.treat_whitespace_as_suffix or kinds & {4, 5}:
            raise ValueError("only merge-type vocabularies with byte fallback, a word sign before each text and no normalisation are supported")
        scores = sorted({-p.score for p in model.pieces if p.type == 1})
        place = {s: i for i, s in enumerate(scores)}
        self.rank = {p.piece: place[-p.score] for p in model.pieces if p.type == 1}
        #: characters that stand side by side in some piece; between others nothing is ever merged
        self.side = {p.piece[i : i + 2] for p in model.pieces if p.type == 1 for i in range(len(p.piece) - 1)}
        #: words and their parts; a part is encoded as the word of the same text
        self.known = Memory(limit=known)
        self.known.met = bytearray(1 << 20)  # kept from the second time on
        self.new: list[tuple[str, list[int], str]] = []
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.text = [p.piece if p.type == 1 else "" for p in model.pieces]
        self.decimal = [b" %d" % i for i in range(len(self.text))]
        made = sorted((x * len(self.text) + y, self.rank[p], i) for p, i in self.id.items() for at in range(1, len(p)) if (x := self.id.get(p[:at])) is not None and (y := self.id.get(p[at:])) is not None)
        self.pairs, self.pair_rank, self.pair_id = np.array([m[0] for m in made], np.int64), np.array([m[1] for m in made], np.int32), np.array([m[2] for m in made], np.int32)
        single = {ord(p): i for p, i in self.id.items() if len(p) == 1}
        self.of_point = np.full(max(single) + 2, -1, np.int32)
        self.of_point[list(single)] = list(single.values())
        self.end = trained.eos_id
        self.last_byte = max(self.byte_of)
        self.by_word = not any(SIGN in p.lstrip(SIGN) for p in self.id)
        self.by_line = self.by_word and not any("\n" in p for p in self.id)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def agenda(self, text: str) -> list[int]:
        """Ids of a text whose spaces are signs already. An entry is one number: its pair's rank, then the two places, then the pair's length."""
        symbols, rank, push, pop = list(text), self.rank, heapq.heappush, heapq.heappop
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [r << 72 | i << 42 | (i + 1) << 12 | 2 for i in range(n - 1) if (r := rank.get(text[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            top = pop(heap)
            a, b = top >> 42 & 0x3FFFFFFF, top >> 12 & 0x3FFFFFFF
            x, y = symbols[a], symbols[b]
            if not x or not y or len(x) + len(y) != top & 0xFFF:
                continue  # one of them has been merged meanwhile
            x = symbols[a] = x + y
            symbols[b] = ""
            c = right[a] = right[b]
            if c < n:
                left[c] = a
                if (r := rank.get(x + symbols[c])) is not None:
                    push(heap, r << 72 | a << 42 | c << 12 | len(x) + len(symbols[c]))
            c = left[a]
            if c >= 0 and (r := rank.get(symbols[c] + x)) is not None:
                push(heap, r << 72 | c << 42 | a << 12 | len(x) + len(symbols[c]))
        ids, out = self.id, []
        for x in symbols:
            if x:
                i = ids.get(x)
                if i is None:
                    out += [self.byte_id[b] for b in x.encode()]
                else:
                    out.append(i)
        return out

    def pair(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, id) of what two symbols make together; the rank is _NONE where that is no piece."""
        key = np.where((x >= 0) & (y >= 0), x.astype(np.int64) * len(self.text) + y, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], _NONE), self.pair_id[at]

    def table(self, texts: list[str]) -> list[list[int]]:
        """``agenda`` of texts of one length, all at once: of each row the first pair of the best rank is merged, round by round."""
        n = len(texts[0])
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int32).reshape(-1, n)
        symbols = self.of_point[np.minimum(points, len(self.of_point) - 1)]
        symbols = np.where(symbols < 0, -1 - points, symbols)
        after, before = np.tile(np.arange(1, n + 1), (len(texts), 1)), np.tile(np.arange(-1, n - 1), (len(texts), 1))
        ranks, made = np.full(symbols.shape, _NONE), np.zeros(symbols.shape, np.int32)
        ranks[:, :-1], made[:, :-1] = self.pair(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(texts))
        while len(rows):
            own = ranks[rows]
            i = own.argmin(axis=1)
            more = own[np.arange(len(rows)), i] < _NONE
            rows, i = rows[more], i[more]
            j = after[rows, i]
            symbols[rows, i], symbols[rows, j] = made[rows, i], _GONE
            k, h = after[rows, j], before[rows, i]
            after[rows, i], ranks[rows, i], ranks[rows, j] = k, _NONE, _NONE
            on = k < n
            before[rows[on], k[on]] = i[on]
            for ok, left, right in ((on, i, k), (h >= 0, h, i)):
                r, u, v = rows[ok], left[ok], right[ok]
                ranks[r, u], made[r, u] = self.pair(symbols[r, u], symbols[r, v])
        alive = symbols != _GONE
        flat, ends = symbols[alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()
        found = [flat[a:b] for a, b in zip([0, *ends], ends)]
        for r in np.flatnonzero((alive & (symbols < 0)).any(axis=1)).tolist():
            found[r] = [x for i in found[r] for x in ((i,) if i >= 0 else [self.byte_id[b] for b in chr(-1 - i).encode()])]
        return found

    def decode(self, ids: list[int]) -> str:
        """Pieces and runs of bytes to text, signs still in it; control ids give nothing."""
        if ids and min(ids) > self.last_byte:
            return "".join(map(self.text.__getitem__, ids))
        parts, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
            else:
                if raw:
                    parts.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                parts.append(self.text[i])
        return "".join([*parts, raw.decode("utf-8", "replace")])

    def learn(self, parts: set[str]) -> dict[str, Word]:
        """New parts, each with a character before it that it never merges with, or where it begins a text, none."""
        out: dict[str, Word] = {}
        decimal = self.decimal.__getitem__
        for n, group in groupby(sorted(parts, key=len), len):
            same = list(group)
            for at in range(0, len(same), ROWS):
                some = same[at : at + ROWS]
                for text, ids in zip(some, self.table(some) if n <= SHORT else map(self.agenda, some), strict=True):
                    decoded = self.decode(ids)
                    if decoded == text:
                        decoded = text  # one string for both
                    self.new.append((text, ids, decoded))
                    out[text] = (b"".join(map(decimal, ids)), len(ids), decoded)
        return out

    def check(self) -> None:
        """Holds what was new since the last check against the library, both ways, as lines of one text; where these differ, one by one. Before a part
        stands what it never merges with."""
        if not self.new:
            return
        texts, ids, decoded = zip(*self.new, strict=True)
        if self.by_line:
            newline, begin = self.agenda("\n"), self.agenda(SIGN)
            for at in range(0, len(texts), ROWS):
                own = [*begin, *chain.from_iterable(x for i in ids[at : at + ROWS] for x in (newline, i))]
                text = "\n".join(["", *texts[at : at + ROWS]]).replace(SIGN, " ")
                if self.library.encode(text, num_threads=1) != own or self.library.decode(own) != "\n".join(["", *decoded[at : at + ROWS]]).replace(SIGN, " "):
                    break
            else:
                self.new.clear()
                return
        before = "a" if self.by_word else ""
        told = self.library.encode([("\n" + t if t[0] != SIGN else before + t if before else t[1:]).replace(SIGN, " ") for t in texts], num_threads=1)
        back = self.library.decode(list(ids), num_threads=1)
        for text, own, theirs, mine, said in zip(texts, ids, told, decoded, back, strict=True):
            if theirs[-len(own) :] != own or said != (mine[1:] if text[0] == SIGN else mine).replace(SIGN, " "):
                raise AssertionError(f"the agenda and the sentencepiece library differ on {text!r}")
        self.new.clear()

    def cut(self, word: str) -> list[str]:
        """Parts of a word between which no piece goes across, as before most punctuation marks."""
        if word[1:].isalpha():
            return [word]
        side = self.side
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in side), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def words_of(self, text: str) -> list[str]:
        """The words with their signs; a text without a word sign inside is one."""
        signed = SIGN + text.replace(" ", SIGN)
        if not self.by_word:
            return [signed]
        out: list[str] = []
        for k, line in enumerate(signed.split("\n") if self.by_line else [signed]):
            first, *rest = line.split(SIGN)
            if k:
                out.append("\n")
            if first:
                out.append(first)
            out += _RUNS.findall(line) if "" in rest else [SIGN + w for w in rest]
        return out

    def encode_batch(self, texts: list[str]) -> list[list[Word]]:
        """The words of each text. New ones of all texts are worked out together; then they are checked."""
        words = [self.words_of(t) if t else [] for t in texts]
        every = set().union(*words)
        fresh = {w: self.cut(w) for w in every.difference(self.known)}
        got = self.learn({p for ps in fresh.values() for p in ps}.difference(self.known))
        self.check()
        known = self.known
        for w, ps in fresh.items():
            if w not in got and len(ps) > 1:
                found = [got.get(p) or known[p] for p in ps]
                decoded = "".join([f[2] for f in found])
                got[w] = (b"".join([f[0] for f in found]), sum([f[1] for f in found]), w if decoded == w else decoded)
        out = [[got.get(w) or known[w] for w in ws] for ws in words] if got else [list(map(known.__getitem__, ws)) for ws in words]
        if len(known) + len(got) > known.limit:  # what this batch has is what is common
            common = {w: known[w] for w in every.intersection(known)}
            known.clear()
            known.update(common)
        for k, v in got.items():
            known.keep(k, v)
        return out


_MODELS: dict[str, Pieces] = {}


def pieces(path: str, known: int = KNOWN[0]) -> Pieces:
    """One for each file and worker process."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    _MODELS[path].known.limit = known
    return _MODELS[path]


def _run(path: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, KNOWN[not keep_ids])
        tail = b" %d" % model.end
        for b in arrow_rows(batches, TEXTS[not keep_ids]):
            n, shas, texts, all_ids = [], [], [], []
            for words in model.encode_batch(b.column(1).to_pylist()):
                raw = (b"".join([w[0] for w in words]) + tail)[1:]
                n.append(sum([w[1] for w in words]) + 1)
                shas.append(hashlib.sha256(raw).hexdigest())
                texts.append("".join([w[2] for w in words])[1:].replace(SIGN, " "))
                if keep_ids:
                    all_ids.append(list(map(int, raw.split())))
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(shas)]
            if keep_ids:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string()), pa.array(all_ids, pa.list_(pa.int32()))], names=["doc_id", "n_tokens", "ids_sha256", "decoded", "ids"])
            else:
                yield pa.RecordBatch.from_arrays([*cols, pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _source(docs: DataFrame) -> DataFrame:
    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, n_tokens, ids_sha256, decoded, ids), one row for each row of ``docs``.

    Ids end with the end id. Null and empty texts are that id alone and decode to the empty text. Characters outside the vocabulary are
    bytes; a word sign in a text decodes to a space, as in the library. Repeated rows and null ids stay. Only doc_id and text are read.
    """
    return _source(docs).mapInArrow(_run(model, True), "doc_id long, n_tokens long, ids_sha256 string, decoded string, ids array<int>")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """As ``encoded``, with decoded_sha256 in place of decoded and ids."""
    return _source(docs).mapInArrow(_run(model, False), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids array<int>, ...) to (doc_id, text). Null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for b in arrow_rows(batches, 1000):
            out = []
            for ids in b.column(1).to_pylist():
                t = m.decode(ids or [])
                out.append((t[1:] if t.startswith(SIGN) else t).replace(SIGN, " "))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
