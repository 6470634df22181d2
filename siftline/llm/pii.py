"""Personal data, plain and disguised, with its place in the source text.

Plain identifiers are found in the text as it is. Then transducers rewrite disguises to plain characters and keep, for each character they
write, the span of source characters it stands for: look-alike letters and digits of other scripts, "at" and "dot" in brackets or between
spaces, and digits spelled out in words. Identifiers found in the rewritten text are mapped back; those that overlap a plain one of their
kind are the same find and are left out.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import arrow_rows, spread, text_of

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match at the first digit of a run is one at any of its digits, so others needn't be tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")

#: Letters of other scripts that look like Latin ones; wide, superscript and styled forms come from Unicode's own tables.
_LOOKALIKES = dict(zip("аеорсухіјѕһԁԛԝɡԍкмтвнАЕОРСУХІЈЅВНКМТαορνικυτχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijshdqwgkkmtbhAEOPCYXIJSBHKMTaopvikutxABEZHIKMNOPTYX", strict=False))
_SIGNS = {"＠": "@", "﹫": "@", "．": ".", "。": ".", "․": ".", "｡": ".", "﹒": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "－": "-", "﹣": "-", "＋": "+", "﹢": "+", "＿": "_", " ": " ", " ": " ", " ": " ", " ": " ", " ": " ", "　": " "}
_UNSEEN = frozenset("­​‌‍⁠﻿")
_DIGIT_WORDS = {w: str(d) for words in ("zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun", "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve") for d, w in enumerate(words.split())} | {"oh": "0"}
_WORDS = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_SEP = r"[\x20,.\-]{1,2}"
#: Four or more spelled digits in a row, or spelled digits beside written ones.
_SPELLED = re.compile(rf"(?<![^\W_])(?:(?:{_WORDS})(?![^\W_])|[0-9])(?:{_SEP}(?:(?:{_WORDS})(?![^\W_])|[0-9]++(?![^\W_]))){{3,}}", re.IGNORECASE)
_SPELLED_ITEM = re.compile(rf"({_WORDS})(?![^\W_])", re.IGNORECASE)
_SPELLED_PLUS = re.compile(r"(?<![^\W_])plus(?=\x20[0-9])", re.IGNORECASE)
_SPELLED_SET = frozenset(_DIGIT_WORDS)
_AT = r"(?:\x20?[\[({<]\x20?(?:at|@|arroba|arobase|chez)\x20?[\])}>]\x20?|\x20(?:at|arroba|arobase)\x20|\x20@\x20)"
_DOT = r"(?:\x20?[\[({<]\x20?(?:dot|\.|punto|punkt|point)\x20?[\])}>]\x20?|\x20(?:dot|punto|punkt|point)\x20|\x20\.\x20)"
#: Of a disguised address: an "at" of some form, the domain after it, of which one part at least follows a "dot" of some form, and a "dot" right
#: before its local part's last word.
_SIGN = re.compile(rf"{_AT}|@", re.IGNORECASE)
_HOST = re.compile(rf"[A-Za-z0-9-]++(?:(?:{_DOT}|\.)[A-Za-z0-9-]++)++", re.IGNORECASE)
_DOT_LAST = re.compile(rf"(?:{_DOT})\Z", re.IGNORECASE)
_AT_ONE, _DOT_ONE = re.compile(_AT, re.IGNORECASE), re.compile(_DOT, re.IGNORECASE)
_BRACKET_AT = re.compile(r"[\[({<]\x20?(?:at|@|arroba|arobase|chez)\x20?[\])}>]", re.IGNORECASE)
_HINTS = ("@", " at ", "[at", "(at", "{at", "<at", "[ at", "( at", "{ at", "< at", "arroba", "arobase", "chez", " dot ", "dot]", "dot)", "dot}", "dot>", "dot ]", "dot )", "punto", "punkt", "point", " . ", "[.", "(.", "{.", "<.", "[ .", "( .", "{ .", "< .")
#: Ends of host names that go on after a full stop between spaces.
_ENDINGS = frozenset("com org net edu gov mil int info biz name io dev app ai co me tv example test local invalid de fr es it nl be at ch uk us eu ca au nz in jp cn kr br mx ar cl pe ec pt pl se no dk fi ie ru cz gr tr za".split())
#: Words that aren't names: neither a person's, a host's nor (unless listed above) the end of a host's.
_FUNCTION = frozenset("the a an this that these those each every some any all one my your his her its our their i you he she it we they me him us them who which what and or but if so as of on in to for from by with at is are was were be been do did then there here not no up down out over home least last first once noon night".split())
#: A word after which a name is an address.
_CONTACT = re.compile(r"(?:e-?mail|mailto|mail|contact|write|reach|address|correo|courriel|kontakt)(?:\x20(?:to|me|us|is))?[\x20:,=(]{1,3}$", re.IGNORECASE)
_FULL_STOP = "\x20.\x20"
_DOT_IP = re.compile(rf"(?<![0-9])[0-9]++(?:(?:{_DOT}|\.)[0-9]++){{3}}", re.IGNORECASE)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches that don't overlap; looks around each @ only, as a local part has none."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), "email"))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def plain(text: str) -> list[Span]:
    """The base patterns: by kind, matches that fail their check are dropped without another try."""
    out = emails(text)
    if _DIGIT.search(text):
        out += [(*m.span(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = _NOT_DIGITS.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
        if "+" in text:
            out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15]
    return out


@cache
def _look(ch: str) -> str:
    """What a character outside ASCII stands for, itself where it is what it seems."""
    if ch in _UNSEEN:
        return ""
    if (found := _LOOKALIKES.get(ch) or _SIGNS.get(ch)) is not None:
        return found
    if (d := unicodedata.decimal(ch, None)) is not None:
        return str(int(d))
    folded = unicodedata.normalize("NFKC", ch)
    return folded if len(folded) == 1 and folded.isascii() and folded.isalnum() else ch


class Rewritten:
    """A text and, for each of its characters, the source span it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, None, None  # None: the source itself

    def edit(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces spans (ordered, apart) of the present text."""
        if not edits:
            return
        start = self.start if self.start is not None else array("i", range(len(self.text)))
        end = self.end if self.end is not None else array("i", range(1, len(self.text) + 1))
        parts, s, e, at = [], array("i"), array("i"), 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            s += start[at:a] + start[a : a + 1] * len(new)
            e += end[at:a] + end[b - 1 : b] * len(new)
            at = b
        self.text, self.start, self.end = "".join([*parts, self.text[at:]]), s + start[at:], e + end[at:]

    def back(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (self.start[a], self.end[b - 1])


_FOREIGN = re.compile(r"[^\x00-\x7f]")
_MIXED = re.compile(r"[^\x00-\x7fÀ-ɏ]")


def _spelled(lower: str) -> bool:
    """Does a spelled digit stand beside another digit, spelled or not?"""
    words = lower.replace("-", " ").replace(",", " ").replace(".", " ").split()
    if _SPELLED_SET.isdisjoint(words):
        return False
    is_digit = [w in _SPELLED_SET or w[-1].isdecimal() for w in words]
    return any(map(bool.__and__, is_digit, is_digit[1:]))


def _local(text: str, at: int, low: int) -> int:
    """Where the local part that ends at a place begins, not before ``low``: words, and disguised dots between them."""
    start = at
    while True:
        end = start
        while start > low and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start == end:
            return at if end == at else dotted
        dotted = start
        m = _DOT_LAST.search(text, max(low, start - 11), start)
        if not m:
            return start
        start = m.start()


def _disguised(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(start, start of the "at", its end, end) of disguised addresses, from the left and apart, by looking around each "at" only. Sends back
    where the next may begin."""
    low, m = 0, _SIGN.search(text)
    while m:
        at, to = m.span()
        host = _HOST.match(text, to)
        start = _local(text, at, low) if host and at >= low else at
        if start < at:
            low = yield start, at, to, host.end()
        m = _SIGN.search(text, max(at + 1, low))


def _address(text: str, start: int, at: int, to: int, stop: int) -> tuple[int, list[tuple[int, int, str]]]:
    """Where a disguised address ends, and its edits; none if it is ordinary prose.

    "at" between spaces needs a local part with a dot or digit, a contact word before it, or a disguised dot; a host of a name, not of a word like
    "the"; and two letters at least after the last dot. A full stop between spaces ends a host that is whole, unless a known ending follows.
    """
    sign, labels, ends = text[at:to], [], []  # of the host: labels, and their ends
    for x in re.finditer(rf"({_DOT}|\.)?([A-Za-z0-9-]+?)(?={_DOT}|\.|$)", text[to:stop], re.IGNORECASE):
        if x[1] == _FULL_STOP and len(labels) > 1 and x[2].lower() not in _ENDINGS:
            break
        labels.append(x[2].lower())
        ends.append(to + x.end())
    if "@" not in sign and not _BRACKET_AT.search(sign):
        while len(labels) > 1 and not (re.fullmatch("[a-z]{2,}", labels[-1]) and (labels[-1] in _ENDINGS or labels[-1] not in _FUNCTION)):
            labels.pop()
            ends.pop()
        local = text[start:at].rpartition(_FULL_STOP)[2]
        shaped = re.search("[A-Za-z]", local) and not local.endswith(".") and (re.search("[.0-9]", local) or _DOT_ONE.search(local) or _CONTACT.search(text[max(start - 20, 0) : start]))
        dotted = bool(_DOT_ONE.search(text, to, ends[-1])) if ends else False
        if len(labels) < 2 or labels[0] in _FUNCTION or local.lower() in _FUNCTION or not (shaped or dotted):
            return stop, []
    end = ends[-1] if len(labels) > 1 else stop
    dots = [(*x.span(), ".") for side in ((start, at), (to, end)) for x in _DOT_ONE.finditer(text, *side)]
    return end, sorted([*dots, *([(at, to, "@")] if sign != "@" else [])])


def deobfuscated(text: str) -> Rewritten | None:
    """The text without disguises, or None if it has none."""
    r = Rewritten(text)
    if not text.isascii() and _MIXED.search(text) or any(c in text for c in " ­·²³¹"):
        r.edit([(m.start(), m.end(), new) for m in _FOREIGN.finditer(text) if (new := _look(m[0])) != m[0]])
    lower = r.text.lower()
    if _spelled(lower):
        edits = []
        for run in _SPELLED.finditer(r.text):
            edits += [(*m.span(), _DIGIT_WORDS[m[0].lower()]) for m in _SPELLED_ITEM.finditer(r.text, run.start(), run.end())]
        r.edit(edits)
        r.edit([(*m.span(), "+") for m in _SPELLED_PLUS.finditer(r.text)])
        r.edit([(m.start() + 1, m.end(), "") for m in re.finditer(r"\+\x20(?=[0-9])", r.text)])
        r.edit([(m.start(), m.end(), "") for m in re.finditer(r"(?<=[0-9]),\x20?(?=[0-9])", r.text)])
    if any(x in lower for x in _HINTS):
        edits, every = [], _disguised(r.text)
        found = next(every, None)
        while found:
            end, own = _address(r.text, *found)
            edits += own
            try:
                found = every.send(end)
            except StopIteration:
                break
        r.edit(edits)
        edits = []
        for m in _DOT_IP.finditer(r.text):
            edits += [(m.start() + x.start(), m.start() + x.end(), ".") for x in _DOT_ONE.finditer(m[0])]
        r.edit(edits)
    return None if r.start is None else r


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans and all spans, each by start, then kind as listed, then end."""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(plain(text), key=order)
    more, r = [], deobfuscated(text)
    if r is not None:
        starts, ends = ({k: [s[i] for s in base if s[2] == k] for k in KINDS} for i in (0, 1))  # plain spans of a kind are apart
        for a, b, kind in plain(r.text):
            start, end = r.back(a, b)
            i = bisect_left(starts[kind], end) - 1
            if i < 0 or ends[kind][i] <= start:
                more.append((start, end, kind))
    return base, sorted({*base, *more}, key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("plain", pa.bool_())]))
    for b in arrow_rows(batches, 1000):
        shas, joins, rows = [], [], []
        for text in b.column(1).to_pylist():
            base, spans = find(text)
            shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
            joins.append(joined(spans))
            known = set(base)
            rows.append([{"kind": k, "start": x, "end": y, "value": text[x:y], "plain": (x, y, k) in known} for x, y, k in spans])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind), pa.array(shas), pa.array(joins)], names=["doc_id", "found", "base_sha256", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, found, base_sha256, spans), one row for each row of ``docs``.

    found: kind, start and end (code points, end exclusive), value as it stands in the source, plain (no disguise). Null and empty texts
    have no spans. Texts are searched whole, in a time that grows with their length. Repeated rows and ids give as many rows; null ids stay
    null. Only doc_id and text are read. An empty table gives no rows.
    """
    source = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    return source.mapInArrow(_run, "doc_id long, found array<struct<kind string, start int, end int, value string, plain boolean>>, base_sha256 string, spans string")


def redacted(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) to (doc_id, text) with every span replaced by its kind in brackets; overlapping spans become one, of the first's kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 1000):
            out = []
            for text in b.column(1).to_pylist():
                parts, at = [], 0
                for x, y, k in find(text)[1]:
                    if x >= at:
                        parts += [text[at:x], f"[{k}]"]
                    at = max(at, y)
                out.append("".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    source = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    return source.mapInArrow(run, "doc_id long, text string")
