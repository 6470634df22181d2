"""Byte-level BPE by pieces whose tokens don't depend on what stands around them."""

from __future__ import annotations

import gc
import json
import re
import sys
from array import array

import numpy as np
import public_tokenizers
import regex

#: A space that nothing white precedes or follows always begins a pre-token, so text may be cut before it.
_WIDE = re.compile(r"\s |\s\Z| \s|\A ")
LIMIT, LONG = 300_000, 64
#: Characters whose class may not be the same in all regex libraries, as their tables are of different years.
_ODD = re.compile(r"[^\x00-\x1b\x20-\x7f]")
_PRETOKENS, _BLANK = regex.compile(public_tokenizers.PATTERN), regex.compile(r"\s+")
#: A character of each class: a letter that ends no contraction, a digit, white space other than a space, anything else.
_LETTER, _NUMBER, _WHITE, _OTHER = "q0\x0b#"


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}


BYTE_CHARACTERS = byte_characters()
SPACE = BYTE_CHARACTERS[32]


def odd(piece: str) -> bool:
    return _ODD.search(piece) is not None


class Classes(dict):
    """Code points to a character of the class that a tokenizer's own pre-tokenizer takes them for; asked once each outside ASCII."""

    def __init__(self, tokenizer):
        super().__init__()
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str

    def __missing__(self, point: int) -> str:
        ch = chr(point)
        if not odd(ch):
            found = ch
        elif len(self.split(f"q{ch}")) == 1:
            found = _LETTER
        elif len(self.split(f"0{ch}")) == 1:
            found = _NUMBER
        elif len(self.split(f"#{ch}")) == 1:
            found = _OTHER
        else:
            found = _WHITE
        self[point] = found
        return found

    def pretokens(self, piece: str) -> list[str]:
        """What the tokenizer's pre-tokenizer makes of any piece."""
        if not odd(piece):
            return _PRETOKENS.findall(piece)
        return [piece[m.start() : m.end()] for m in _PRETOKENS.finditer(piece.translate(self))]

    def plain(self, word: str) -> bool:
        """Letters alone, one pre-token after a space."""
        return (word if word.isascii() else word.translate(self)).isalpha()

    def blanks(self, piece: str):
        """The matches of its runs of white space."""
        return _BLANK.finditer(piece.translate(self) if odd(piece) else piece)


def cut(text: str) -> tuple[str, list[str]]:
    """The head, and what follows each cut without its space: text == head + "".join(" " + x for x in rest)."""
    parts = text.split(" ")
    if not _WIDE.search(text):
        return parts[0], parts[1:]
    out = [parts[0]]
    for x in parts[1:]:
        last = out[-1]
        if not x or x[0].isspace() or not last or last[-1].isspace():
            out[-1] = f"{last} {x}"
        else:
            out.append(x)
    return out[0], out[1:]


def lines(text: str) -> list[str]:
    """A text without the newlines between other than white characters: each of these is a pre-token of its own, and so no token crosses it."""
    found = text.split("\n")
    if len(found) > 1 and not all(x and not x[0].isspace() and not x[-1].isspace() for x in found):
        out = [found[0]]
        for x in found[1:]:
            last = out[-1]
            if not x or x[0].isspace() or not last or last[-1].isspace():
                out[-1] = f"{last}\n{x}"
            else:
                out.append(x)
        return out
    return found


def parts(line: str) -> tuple[str, list[str]]:
    """``cut``, by a quick way where no other white space than single spaces is in a line."""
    found = line.split(" ")
    return (found[0], found[1:]) if found == line.split() else cut(line)


class Memory(dict):
    """What ``make`` gives for a short key, remembered. When half of ``limit`` is reached, what is remembered becomes the older half, from which
    keys that are asked for come back; so memory is bounded and common keys stay. From then on a key is remembered from the second time, as most
    different words of a large corpus occur once."""

    def __init__(self, make=None, limit: int | None = None):
        super().__init__()
        gc.set_threshold(500_000, 20, 20)  # what is remembered has no cycles; looking for some in it takes a tenth of the time
        self.make, self.limit, self.met, self.old = make, limit, None, {}

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            return self.keep(key, self.make(key))
        self[key] = found
        return found

    def keep(self, key: str, found):
        if len(key) <= LONG:
            limit = self.limit or LIMIT
            if len(self) >= (limit // 2 if self.make else limit):
                self.old = self.copy() if self.make else {}
                self.clear()
                self.met = bytearray(1 << 22 if self.make else 1 << 20)
            if self.met is None or self.met[at := hash(key) & len(self.met) - 1]:
                self[key] = found
            else:
                self.met[at] = 1
        return found


#: Characters outside those whose class has been the same in Unicode for long, so that all libraries split texts of the others alike.
_LATE = re.compile("[^\x00-\x1b\x20-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")


def fast_encoder(tokenizer):
    """tiktoken's encoder with the vocabulary and merges of a byte-level BPE tokenizer, or None if these aren't in order of the ids."""
    import tiktoken

    told = json.loads(tokenizer.to_str())
    model, to_byte = told["model"], {c: b for b, c in BYTE_CHARACTERS.items()}
    specials = {t["content"] for t in told["added_tokens"]}
    if model["type"] != "BPE" or told.get("normalizer") or told["pre_tokenizer"]["type"] != "ByteLevel" or told["pre_tokenizer"]["add_prefix_space"]:
        return None
    raw = lambda t: bytes(to_byte[c] for c in t)
    ranks = {raw(t): i for t, i in model["vocab"].items() if t not in specials}
    made = [ranks.get(raw("".join(m if isinstance(m, list) else m.split(" "))), -1) for m in model["merges"]]
    if made != sorted(set(made)) or made[:1] == [-1] or len(ranks) != len(made) + 256:
        return None
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Texts to ids. Texts of long-known characters are encoded by tiktoken with the tokenizer's own vocabulary, which gives the same ids several times
    faster. In others, what pieces and pre-tokens become is remembered; new ones are encoded by the library's model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize, self.classes = self.tokenizer.model.tokenize, Classes(self.tokenizer)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokens, self.first, self.spaced = Memory(self.pretoken, LIMIT // 6), Memory(self.piece, LIMIT // 6), Memory(self.word, LIMIT // 3)
        self.fast = fast_encoder(self.tokenizer)
        self.newline = self.pretoken("\n")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def ids(self, t: str) -> bytes:
        """Of one pre-token, its bytes written as characters of the vocabulary."""
        return array(self.code, [x.id for x in self.tokenize(t)]).tobytes()

    def pretoken(self, t: str) -> bytes:
        return self.ids(t.encode().decode("latin-1").translate(BYTE_CHARACTERS))

    def word(self, rest: str) -> bytes:
        """A piece after a space. Letters alone are one pre-token."""
        if self.classes.plain(rest):
            return self.ids(SPACE + rest) if rest.isascii() else self.pretoken(" " + rest)
        return self.piece(" " + rest)

    def piece(self, piece: str) -> bytes:
        return b"".join([self.spaced[t[1:]] if t[0] == " " and self.classes.plain(t[1:]) else self.tokens[t] for t in self.classes.pretokens(piece)])

    def raw(self, text: str) -> bytes:
        """Exactly the ids of the library, as bytes; a text with a special string goes to it whole."""
        if any(s in text for s in self.specials):
            return self.whole(text)
        if self.fast and not _LATE.search(text):
            return array(self.code, self.fast(text)).tobytes()
        spaced, out = self.spaced.__getitem__, []
        for line in lines(text):
            head, rest = parts(line)
            out.append(b"".join([self.first[head], *map(spaced, rest)]))
        return self.newline.join(out)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), self.dtype)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each file and worker process."""
    if path not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


assert sys.byteorder == "little"
