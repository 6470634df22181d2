from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pandas as pd
import pytest

from siftline.llm import pieces, sentencepieces, token_counts, token_store
from siftline.llm.pieces import vocabulary

SF = "/root/testdata/sf0.001"
TRICKY = [
    "", " ", "  ", "\n", "\n\n", " a", "a ", "a  b", "a\nb", "a\n b", "a \nb", "a\n\nb", "\na", "it's I'll\n's 'S x's", "tab\there", "nb sp", "\u0085x", "x\r\ny", "12 345", "a1b2", "<|endoftext|>", "x<|endoftext|> y", "<s> </s> <unk>",
    "naïve façade", "ñ é ß", "日本語 テスト", "😀😀 a😀", "é a​b", "▁a ▁", "a▁b", "\u0000", "…—", "ﬁ", "İ", " z", "word." * 50, "x" * 300, "%%% $$$", "²³ ½ Ⅷ", "﻿x",
]


def mixed(n):
    r = random.Random(6)
    alphabet = ["a", "b", "re", "the", " ", " ", "\n", ".", ",", "'s", "1", "é", "日", "\t", "😀", "Q", " ", "▁", "\r\n"]
    return ["".join(r.choices(alphabet, k=r.randrange(40))) for _ in range(n)]


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


def test_encoder_is_the_library(bpe):
    enc = pieces.Encoder(vocabulary("byte_bpe_50k.json"))
    for t in [*TRICKY, *mixed(3000)]:
        assert enc.encode(t).tolist() == bpe.encode(t, add_special_tokens=False).ids, t


def test_both_ways_of_the_encoder_are_the_library(bpe):
    both = [pieces.Encoder(vocabulary("byte_bpe_50k.json")) for _ in range(2)]
    assert both[0].fast
    both[1].fast = None
    known = [c for c in map(chr, range(0x2100)) if not pieces._LATE.search(c)]
    assert len(known) > 600
    texts = [t for c in known for t in (f"a{c}b 1{c}2 {c}{c} {c}x, {c}, '{c}s 's{c}", f"{c}'s {c}'ll\n{c} \n{c}{c}\n 0{c} #{c}! {c}#", f" {c} a {c}  {c} b{c}\t{c}")]
    r = random.Random(8)
    texts += ["".join(r.choice([r.choice(known), " ", "\n", "a", "the", "1", "'s", "é"]) for _ in range(30)) for _ in range(2000)] + ["a" * 5000, " " * 5000, "x y" * 3000]
    for t in texts:
        want = bpe.encode(t, add_special_tokens=False).ids
        assert all(e.encode(t).tolist() == want for e in both), t


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "LIMIT", 10)
    m = pieces.Memory(len)
    assert [m["x" * (i % 30)] for i in range(300)] == [i % 30 for i in range(300)] and len(m) <= 10
    assert m["y" * 100] == 100 and "y" * 100 not in m


def test_prefix_counts_are_the_library(bpe):
    counts = token_counts.PrefixCounts(vocabulary("byte_bpe_50k.json"))
    for t in [*TRICKY[:-4], *mixed(150)]:
        want = [len(bpe.encode(t[: i + 1], add_special_tokens=False).ids) for i in range(len(t))]
        assert counts.every(t).tolist() == want, t
        assert counts.count(t) == (want[-1] if want else 0), t
    for t in mixed(2000):
        assert counts.count(t) == len(bpe.encode(t, add_special_tokens=False).ids), t


def test_longest_prefix_of_a_text(bpe):
    counts = token_counts.PrefixCounts(vocabulary("byte_bpe_50k.json"))
    for t in [*TRICKY, *mixed(150), "say “it's” — or… not 😀", "a  b  \n c"]:
        every = [len(bpe.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        for limit in (0, 1, 2, 5, 9):
            assert counts.longest(t, limit) == max(i for i, n in enumerate(every) if n <= limit), (t, limit)


def test_characters_of_other_classes(bpe):
    """Each of a wide range of characters beside letters, digits, signs and white space, in counts, prefixes and ids."""
    enc, counts, r = pieces.Encoder(vocabulary("byte_bpe_50k.json")), token_counts.PrefixCounts(vocabulary("byte_bpe_50k.json")), random.Random(7)
    points = [*range(0x80, 0x600), *range(0x2000, 0x2100), 0x3000, 0x1680, 0x180E, 0xFEFF, 0xE000, 0x1F600, 0x1D7D8, 0x10FFFD, 0x378, 0x1CCF0, 0x105C0]
    for p in points:
        c = chr(p)
        t = f"a{c}b 1{c}2 {c}{c} {c}x, {c}, '{c}s 's{c}"
        want = bpe.encode(t, add_special_tokens=False).ids
        assert enc.encode(t).tolist() == want and counts.count(t) == len(want), hex(p)
    for _ in range(150):
        t = "".join(r.choice([chr(r.choice(points)), " ", "a", "'s", "\n"]) for _ in range(12))
        assert counts.every(t).tolist() == [len(bpe.encode(t[: i + 1], add_special_tokens=False).ids) for i in range(len(t))], t


def test_prefixes_of_long_texts_take_seconds():
    counts = token_counts.PrefixCounts(vocabulary("byte_bpe_50k.json"))
    for t in (" " * 300_000, "…" * 300_000, "a" * 300_000, "\n \t" * 100_000, "it's " * 60_000, "“" + "x" * 300_000, "a'" * 100_000):
        began = time.perf_counter()
        assert counts.every(t)[-1] == counts.count(t)
        assert time.perf_counter() - began < 8, t[:5]


def test_prefix_table(frame, bpe):
    rows = [(1, "one two three four"), (2, None), (3, "")]
    table = token_counts.prefix_table(frame(rows), vocabulary("byte_bpe_50k.json"))
    got = {r["doc_id"]: r["n_chars"] for r in token_counts.longest_prefix(table, 2).collect()}
    text = rows[0][1]
    assert got == {1: max(i for i in range(len(text) + 1) if len(bpe.encode(text[:i]).ids) <= 2), 2: 0, 3: 0}


def test_sentencepieces_are_the_library():
    model = sentencepieces.Pieces(vocabulary("piece_bpe_32k.model"))
    texts = [*TRICKY, *mixed(3000)]
    for text, words in zip(texts, model.encode_batch(texts)):
        ids = model.library.encode(text)
        assert b"".join(w[0] for w in words).split() == [b"%d" % i for i in ids], text
        assert "".join(w[2] for w in words)[1:].replace(sentencepieces.SIGN, " ") == model.library.decode(ids), text
    for text in ("", "▁ab", "▁the.word", "▁" + "abc" * 30):  # table and heap agree
        if text and len(text) <= sentencepieces.SHORT:
            assert model.table([text]) == [model.agenda(text)]


def test_agenda_by_trying(monkeypatch):
    """The heap and the table against merging the best pair of the whole text again and again."""
    model = sentencepieces.Pieces(vocabulary("piece_bpe_32k.model"))
    r = random.Random(2)
    for _ in range(300):
        text = "▁" + "".join(r.choices("theranisoéq日", k=r.randrange(1, 12)))
        s = list(text)
        while pairs := [(model.rank[a + b], i) for i, (a, b) in enumerate(zip(s, s[1:])) if a + b in model.rank]:
            i = min(pairs)[1]
            s[i : i + 2] = [s[i] + s[i + 1]]
        want = [x for p in s for x in ([model.id[p]] if p in model.id else [model.byte_id[b] for b in p.encode()])]
        assert model.agenda(text) == want and model.table([text]) == [want]


def test_a_wrong_code_is_noticed(monkeypatch):
    model = sentencepieces.Pieces(vocabulary("piece_bpe_32k.model"))
    model.table = lambda texts: [[5] for _ in texts]
    with pytest.raises(AssertionError, match="differ"):
        model.encode_batch(["some words"])


def test_sentencepiece_rows(frame, hard):
    rows = [*hard, (3, "again"), (None, "null id")]
    path = vocabulary("piece_bpe_32k.model")
    found = sentencepieces.encoded(frame(rows), path)
    library = sentencepieces.pieces(path).library
    got = sorted(((r["doc_id"], r["n_tokens"], r["decoded"], tuple(r["ids"])) for r in found.collect()), key=str)
    assert got == sorted(((i, len(ids), library.decode(ids), tuple(ids)) for i, t in rows for ids in [[*library.encode(t or ""), library.eos_id()]]), key=str)
    assert sorted(r["text"] for r in sentencepieces.decoded(found.where("doc_id is not null"), path).collect()) == sorted(library.decode(library.encode(t or "")) for i, t in rows if i is not None)
    assert found.limit(0).count() == 0


# --- the store ---


def store_model(rows, bpe):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*bpe.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    return out


def test_store_round_trip(spark, frame, hard, prose, bpe, tmp_path):
    shared = prose("shared", 900)
    rows = [*hard, *((20 + i, f"{prose(i, 40)} {shared} {prose(-i, 30)}") for i in range(12)), (40, prose(1, 3000)), (41, prose(1, 3000))]
    path, tokenizer = f"{tmp_path}/store", vocabulary("byte_bpe_50k.json")
    token_store.write_store(frame(rows), path, tokenizer)
    want = store_model(rows, bpe)
    got = token_store.read_store(spark, path, tokenizer).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], r["sound"]) for r in got] == [(*w[:4], True) for w in want]
    assert {r["doc_id"]: list(r["ids"]) for r in token_store.restore(spark, path, tokenizer).collect()} == {w[0]: w[4] for w in want}
    assert token_store.verify_manifest(spark, path)
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    stored = chunks.selectExpr("sum(octet_length(ids)) div 2 as n").first()["n"]
    assert stored < 0.75 * sum(w[2] for w in want)  # shared passages and copies are stored once
    bad = spark.read.parquet(f"{path}/recipes").withColumn("root", __import__("pyspark.sql.functions", fromlist=["x"]).expr("cast('x' as binary)"))
    bad.write.parquet(f"{tmp_path}/bad/recipes")
    spark.read.parquet(f"{path}/manifest").write.parquet(f"{tmp_path}/bad/manifest")
    chunks.write.parquet(f"{tmp_path}/bad/chunks")
    assert not token_store.verify_manifest(spark, f"{tmp_path}/bad")
    assert token_store.read_store(spark, f"{tmp_path}/bad", tokenizer).where("sound").count() == 0


def test_store_notices_lost_and_added_rows(spark, frame, prose, tmp_path):
    tokenizer = vocabulary("byte_bpe_50k.json")
    token_store.write_store(frame([(i, prose(i, 600)) for i in range(8)]), f"{tmp_path}/s", tokenizer)
    tables = {t: spark.read.parquet(f"{tmp_path}/s/{t}") for t in ("chunks", "recipes", "manifest")}
    digest = tables["chunks"].first()["digest"]
    changed = {
        "lost": {"recipes": tables["recipes"].where("doc_id <> 3")},
        "added": {"recipes": tables["recipes"].union(tables["recipes"].where("doc_id = 3"))},
        "part": {"manifest": tables["manifest"].limit(0)},
        "chunk": {"chunks": tables["chunks"].where(tables["chunks"]["digest"] != digest)},
    }
    for name, own in changed.items():
        for t, df in (tables | own).items():
            df.write.parquet(f"{tmp_path}/{name}/{t}")
        rows = token_store.read_store(spark, f"{tmp_path}/{name}", tokenizer).collect()
        assert any(not r["sound"] for r in rows), name
        assert name == "chunk" or not any(r["sound"] for r in rows), name
    assert all(r["sound"] for r in token_store.read_store(spark, f"{tmp_path}/s", tokenizer).collect())


def test_store_of_repeated_ids_and_nothing(spark, frame, tmp_path):
    tokenizer = vocabulary("byte_bpe_50k.json")
    token_store.write_store(frame([(1, "a"), (1, "a"), (1, "b c"), (None, "x")]), f"{tmp_path}/s", tokenizer)
    got = token_store.read_store(spark, f"{tmp_path}/s", tokenizer).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 1, 1] and all(r["sound"] for r in got)
    token_store.write_store(frame([(1, "a")]).limit(0), f"{tmp_path}/empty", tokenizer)
    assert token_store.read_store(spark, f"{tmp_path}/empty", tokenizer).count() == 0


def test_crc_of_parts_and_rolling_marks():
    r = random.Random(4)
    for _ in range(50):
        a, b = r.randbytes(r.randrange(50)), r.randbytes(4 * r.randrange(3000))
        assert int(token_store.crc_shift(np.array([zlib.crc32(a)]), np.array([len(b)]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)
    ids = np.random.default_rng(3).integers(0, 50_000, 60_000).astype("<u2")
    marks = token_store.marks(ids)
    assert 120 < len(marks) < 360
    again = token_store.marks(np.concatenate([ids[:777], ids]))  # where the content is the same, so are the marks
    assert (again[again >= 777 + token_store.WINDOW] - 777).tolist() == marks[marks >= token_store.WINDOW].tolist()
    assert (token_store.marks(ids.astype("<u4")) == marks).all()
    for size, at in ((1, []), (5000, []), (3000, [10, 70, 100, 2999])):
        ends = token_store.cuts(size, at)
        assert ends[-1] == size and all(0 < y - x <= token_store.MOST for x, y in zip([0, *ends], ends))


@pytest.mark.parametrize("name", ["op3_token_store", "op9_sentencepiece", "op10_token_counts"])
def test_queries(spark, bpe, name):
    from siftline.llm import queries

    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows = list(zip(docs["doc_id"].tolist(), docs["text"].fillna("")))
    got = sorted(tuple(r)[:4] for r in queries.QUERIES[name](spark, SF).collect())
    if name == "op3_token_store":
        want = [w[:4] for w in store_model(rows, bpe)]
    elif name == "op10_token_counts":
        want = [(i, len(t.encode()), n, n > 1024) for i, t in rows for n in [len(bpe.encode(t, add_special_tokens=False).ids)]]
    else:
        library = sentencepieces.pieces(vocabulary("piece_bpe_32k.model")).library
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want = [(i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))) for i, t in rows for ids in [[*library.encode(t), library.eos_id()]]]
    assert got == sorted(want)
