from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from siftline.llm import exact_dedup as ed
from siftline.llm import near_dedup as nd
from siftline.llm.components import components

SF = "/root/testdata/sf0.001"


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def reachable(links, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_model(docs, k=4, percent=80):
    sets, ids = {i: shingles(t, k) for i, t in docs.items()}, sorted(docs)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in reachable(links, ids).items()}


def near(found):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}


def test_near_groups_that_only_hang_together(frame, prose):
    """Copies of copies: many are linked with the first by others only, and one bucket holds several groups."""
    r = random.Random(3)
    docs, i = {}, 0
    for g in range(6):
        base = prose(f"g{g}", 60).split()
        pool = [base]
        for _ in range(40):
            w = list(r.choice(pool))
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = f"new{r.randrange(50)}"
            pool.append(w)
            docs[i] = " ".join(w)
            i += 1
    for n in (1, 2, 3, 4, 5, 90):
        for _ in range(3):
            docs[i] = prose(n, n) if n < 5 else prose(i, n)
            i += 1
    assert near(nd.near_duplicates(frame(list(docs.items())), k=4)) == near_model(docs)


def test_near_query(spark):
    from siftline.llm.queries import op1_minhash

    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")["text"].to_dict()
    found = op1_minhash(spark, SF)
    assert near(found) == near_model(docs)
    assert found.where("kept <> (doc_id = component_id)").count() == 0


def test_near_hard_rows(frame, hard, prose):
    rows = [*hard, (100, prose("x", 50)), (100, prose("x", 50)), (100, prose("y", 50)), (101, prose("y", 50)), (None, prose("x", 50)), (102, prose("x", 50).upper() + "\n")]
    found = nd.near_duplicates(frame(rows)).collect()
    assert len(found) == len(rows)
    assert {r["component_id"] for r in found if r["doc_id"] in (100, 101, 102)} == {100}
    assert [(r["component_id"], r["kept"]) for r in found if r["doc_id"] is None] == [(None, True)]
    assert {r["n_shingles"] for r in found if r["doc_id"] in (0, 1, 2, 3)} == {0}
    assert nd.near_duplicates(frame(rows).limit(0)).count() == 0


def test_tiles_join_what_stars_leave(spark, frame, prose):
    docs = {i: prose(i // 5, 40) for i in range(40)}
    found = {i: nd.shingle_sets([t], 5)[0] for i, t in docs.items()}
    sets = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in found.items()], "id long, body binary")
    signatures = spark.createDataFrame([(i, bytearray(nd.signature(s, 128).astype(np.uint8).tobytes())) for i, s in found.items()], "id long, body binary")
    members = spark.createDataFrame([(7, i, i, len(s)) for i, s in found.items()], "key long, id long, component long, n long")
    near = nd.tiled(members, signatures, 80, "1 / 8D", nd.alike(nd.least_alike(128, 80)), False).collect()
    assert sorted((r["key"], r["id"]) for r in near) == [(7, i) for i in docs]
    links = nd.tiled(members, sets, 80, "n / 100D", nd.similar(80), True).collect()
    assert reachable([(r["a"], r["b"]) for r in links], docs) == {i: i - i % 5 for i in docs}


def test_sizes_of_linked_sets_are_in_neighbouring_classes():
    base = 100 / 80 + 0.01
    for a in range(1, 3000):
        assert int(np.log(a * 5 // 4) / np.log(base)) - int(np.log(a) / np.log(base)) <= 1


def test_hot_copies_and_empty_texts(frame, prose):
    """Nine of ten rows are equal or empty."""
    rows = [(i, prose("hot", 60)) for i in range(300)] + [(300 + i, None if i % 2 else " ") for i in range(300)] + [(600 + i, prose(i, 40)) for i in range(60)]
    found = {r["doc_id"]: (r["component_id"], r["kept"]) for r in nd.near_duplicates(frame(rows)).collect()}
    assert found == {i: (0, i == 0) if i < 300 else (i, True) for i, _ in rows}
    assert sum(r["kept"] for r in ed.exact_duplicates(frame(rows)).collect()) == 1 + 2 + 60


def test_word_hashes():
    """Equal words have equal hashes wherever they stand, others don't; long texts and long words are cut between words only."""
    r, h = random.Random(4), nd.WordHashes(nd.WHITE)
    h.CHUNK = 64
    h.up, h.down = h.powers(64)
    texts = ["", " ", "x", "X y\tx", "é É", "a" * 300 + " b", " ".join(r.choice(["ab", "ba", "b", "a" * 70, "日本"]) for _ in range(200))]
    texts += ["".join(r.choice("ab \n") for _ in range(r.randrange(150))) for _ in range(300)]
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    known = {}
    for t, own in zip(texts, h.each(texts)):
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        assert len(words) == len(own)
        assert all(known.setdefault(w, x) == x for w, x in zip(words, own.tolist()))
    assert len(set(known.values())) == len(known)


def test_circulant_signature_estimates_similarity():
    r = np.random.default_rng(0)
    a = r.integers(0, 2**63, 2000).astype(np.uint64)
    b = np.concatenate([a[:1600], r.integers(0, 2**63, 400).astype(np.uint64)])
    same = (nd.signature(np.unique(a), 1024) == nd.signature(np.unique(b), 1024)).mean()
    assert abs(same - 1600 / 2400) < 0.06


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(100)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert {r["id"]: r["component"] for r in components(df).collect()} == reachable(real, {x for e in real for x in e})
    assert components(df.limit(0)).count() == 0


def exact_model(docs):
    last, size = {}, {}
    for i, t in docs:
        t = t or ""
        size[t] = size.get(t, 0) + 1
        if t not in last or last[t] is None or (i is not None and i > last[t]):
            last[t] = i
    return sorted(((i, last[t or ""], size[t or ""], i == last[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in docs), key=str)


def exact(found):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in found.collect()), key=str)


def test_exact(spark, frame, hard, prose):
    rows = [*hard, (50, "A a A"), (51, "A a A"), (52, "A a a"), (None, "n"), (None, "n"), (53, "m"), (None, "m"), (54, "d"), (54, "d"), (54, "e"), (55, " "), *((100 + i, prose(i % 7, 30)) for i in range(60))]
    assert exact(ed.exact_duplicates(frame(rows))) == exact_model(rows)
    for share in ("true", "false", "doc_id < 30"):  # however the rows are dealt to snapshot and batch
        from pyspark.sql import functions as F

        assert exact(ed.exact_duplicates(frame(rows), F.coalesce(F.expr(share), F.lit(True)))) == exact_model(rows)
    assert exact(ed.exact_duplicates(frame(rows).limit(0))) == []


def test_exact_query(spark):
    from siftline.llm.queries import op2_exact_dedup

    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert exact(op2_exact_dedup(spark, SF)) == exact_model(list(zip(docs["doc_id"].tolist(), docs["text"])))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 20_000])
def test_filter_has_no_false_negatives(n):
    r = np.random.default_rng(n)
    keys = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
    f = ed.BinaryFuse8.build(keys)
    assert f.may_have(keys).all()
    assert f.may_have(r.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64)).mean() < 0.01
    if n == 20_000:
        assert len(f.cells) < 1.4 * n
