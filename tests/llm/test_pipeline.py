from __future__ import annotations

import re
import zlib

import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
sp = pytest.importorskip("sentencepiece")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def components(docs, k, percent):
    """Links by comparing all pairs; each document's smallest reachable id."""
    sets = {i: shingles(t, k) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def leaks(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))

    def runs(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    own = words(text)
    return any(runs(own, min(10, len(w))) & runs(w, min(10, len(w))) for w in map(words, items) if w)


def test_stages_against_brute_force(spark):
    import corpus_pipeline as cp
    from siftline.llm import quality
    from siftline.llm.pieces import vocabulary

    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")["text"].fillna("").to_dict()
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), __import__("pyspark.sql.functions", fromlist=["x"]).expr("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")).ready()
    left = {i: t for i, t in docs.items() if model.score([t])[0] >= cp.GOOD}
    assert len(docs) * 0.5 < len(left) < len(docs)
    last = {t: max(i for i, u in left.items() if u == t) for t in left.values()}
    left = {i: t for i, t in left.items() if last[t] == i}
    comp = components(left, 5, 80)
    left = {i: t for i, t in left.items() if comp[i] == i}
    items = pd.read_parquet(f"{SF}/benchmark.parquet")["text"].fillna("").tolist()
    left = {i: t for i, t in left.items() if not leaks(t, items)}
    library = sp.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    found = cp.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(left)
    for r in found:
        ids = [*library.encode(left[r["doc_id"]]), library.eos_id()]
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids) and r["decoded"] == library.decode(ids)


def test_stages_keep_columns_and_stand_hard_rows(spark, frame, hard, prose, tmp_path):
    import corpus_pipeline as cp

    rows = [*hard, (90, prose("a", 60)), (91, prose("a", 60)), (91, prose("a", 60)), (None, prose("n", 70)), (92, prose("a", 60) + " more"), (93, prose("b", 80))]
    frame(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("i", prose("b", 80)), (None, None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 2), 0) for i in range(15)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in cp.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.columns == docs.columns, name
        out = cp.tokenize(spark, now, str(tmp_path))
        if empty:
            assert out.count() == 0
    copies = cp.drop_copies(spark, docs, str(tmp_path)).where("doc_id >= 90").select("doc_id").collect()
    assert sorted(r[0] for r in copies) == [91, 91, 92, 93]
    near = cp.drop_near_copies(spark, docs, str(tmp_path)).where("doc_id >= 90 or doc_id is null").select("doc_id").collect()
    assert {r[0] for r in near} == {None, 90, 93}
    clean = cp.decontaminate(spark, docs, str(tmp_path)).where("doc_id >= 90").select("doc_id").distinct().collect()
    assert sorted(r[0] for r in clean) == [90, 91, 92]
    assert zlib.crc32(b"1")


def test_each_row_of_an_id_has_its_own_decision(spark, frame, prose, tmp_path):
    import corpus_pipeline as cp

    spark.createDataFrame([("i", prose("b", 80))], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leak, near = prose("b", 80), prose("n", 90)
    rows = [(None, leak), (None, prose("c", 50)), (1, leak), (1, prose("d", 50)), (2, near), (3, near + " more"), (3, prose("e", 50)), (None, "well " + near)]
    docs = frame(rows).select("doc_id", "text", "lang", "source", "n_chars")
    texts = lambda df: sorted((r["doc_id"] or 0, r["text"]) for r in df.collect())
    assert texts(cp.decontaminate(spark, docs, str(tmp_path))) == sorted((i or 0, t) for i, t in rows if t != leak)
    gone = [(None, leak), (3, near + " more"), (None, "well " + near)]
    assert texts(cp.drop_near_copies(spark, docs, str(tmp_path))) == sorted((i or 0, t) for i, t in rows if (i, t) not in gone)
