from __future__ import annotations

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from siftline.functions import quality
from siftline.operators import chunking, cleaning, filtering, interactive, search

CHUNKS = "source_path string, chunk_index int, text string"


# --- cleaning ---


def own(pattern):
    """A pattern of the operators in Python's spelling."""
    return re.compile(pattern.replace("(?iU)", "(?i)").replace(r"\z", r"\Z"))


def clean_model(md):
    """Line by line, with a flag."""
    md = html.unescape(re.sub(r"\r\n?", "\n", md))
    for p in (r"(?i)</?math>", r"(?i)</?(sup|sub|span|b|i|u|em|strong)>", r"(?s)<!--.*?-->"):
        md = re.sub(p, "", md)
    out, inside = [], False
    for line in md.splitlines():
        bare = line.strip()
        if own(cleaning.SITE_LINE).match(bare):
            continue
        if own(cleaning.INDEX_START).match(bare):
            inside = True
        elif inside and not own(cleaning.INDEX_END).match(bare):
            pass
        else:
            inside = False
            out.append(line.rstrip())
    return re.sub(r"\n{4,}", "\n\n\n", "\n".join(out)).strip() + "\n"


CLEAN = [
    "", "\n\n", "a\r\nb\rc", "&lt;b&gt;x&lt;/b&gt;", "&amp;lt;b&amp;gt;", "<math>y</math><!-- a\nb -->z", "a\n\n\n\n\nb", "x<br>y <p>", "one\n## INDICE\nlist\n## Other\n## EDC now\nend", "one\n  ## indice  \nlist", "## EDC alone",
    "## INDICE\na\n## INDICE\nb\n## Ayuda a c\nd", "t\nwww.eluniverso.com\nDIRECCIÓN EN INTERNET: WWW.ELUNIVERSO.COM\nu", "## INDICE\nwww.eluniverso.com\n## Bancomex x", "a  \nb c", "see www.eluniverso.com here", "&eacute;&#233; &copy", "<b class=x>k</b>",
]


def test_clean(spark):
    df = spark.createDataFrame(list(enumerate(CLEAN)), "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(cleaning.clean(F.col("t"))).collect()] == [clean_model(t) for t in CLEAN]
    lines = ["## INDICE", "## EDC a", "x", "", "www.eluniverso.com", " y "]
    r = random.Random(2)
    many = ["\n".join(r.choices(lines, k=r.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(many)), "i int, t string").orderBy("i")
    assert [x[0] for x in df.select(cleaning.clean(F.col("t"), every_entity=False)).collect()] == [clean_model(t) for t in many]


def test_clean_texts_of_many_lines_and_entities(spark):
    r = random.Random(3)
    texts = ["\n".join(r.choice(["x", "  y ", "## INDICE", "## EDC z", "www.eluniverso.com", "", "a &amp; b", "&lt;b&gt;"]) for _ in range(r.randrange(60))) for _ in range(60)] + ["line\n" * 20_000 + "## INDICE\n" + "gone\n" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    assert [x[0] for x in df.select(cleaning.clean(F.col("t"))).collect()] == [clean_model(t) for t in texts]
    entities = ["&amp", "&ampx", "&#39", "&#x41;", "&NBSP;", "&lt", "&notit;", "& a", "&", "&;", "&quot;&copy;&middot;&nbsp;&#39;", "&amp;amp;lt;", "&é;", "&Eacute;&lt;"]
    df = spark.createDataFrame(list(enumerate(entities)), "i int, t string").orderBy("i")
    assert [x[0] for x in df.select(cleaning.decode_entities(F.col("t"))).collect()] == [html.unescape(t) for t in entities]


def test_processed(spark):
    assert tuple(cleaning.processed(spark.createDataFrame([("a", "x"), ("b", None), ("c", "")], "doc string, raw_md string")).first()) == (2, 3)


def test_hot_copies(spark):
    """Nine of ten chunks have the same text."""
    rows = [("d%03d" % (i // 10), i % 10, "same text" if i % 10 else f"own {i}") for i in range(2000)]
    found = filtering.with_duplicates(spark.createDataFrame(rows, "source_path string, chunk_index int, text string")).collect()
    assert sorted((r["source_path"], r["chunk_index"]) for r in found if not r["is_duplicate"]) == sorted([(p, i) for p, i, t in rows if t != "same text"] + [("d000", 1)])


def test_clean_documents(spark):
    got = cleaning.clean_documents(spark.createDataFrame([("a", "x "), ("b", None)], "doc string, raw_md string")).collect()
    assert sorted(map(tuple, got)) == [("a_rawclean.md", "x\n"), ("b_rawclean.md", "\n")]


# --- chunking ---


def chunk_model(text, size, overlap):
    text = re.sub(r"\r\n?", "\n", text).strip()
    paras = [p.strip() for p in re.split(r"\n\s*\n+", text) if p.strip()] or [text]
    done, held, n = [], [], 0
    for p in paras:
        w = p.split()
        if held and n + len(w) > size:
            done.append("\n\n".join(held))
            held, n = [], 0
        if len(w) > size:
            done += [" ".join(w[i : i + size]) for i in range(0, len(w), max(size - overlap, 1))]
        else:
            held, n = [*held, p], n + len(w)
    return [c for c in [*done, "\n\n".join(held)] if c.strip()]


def test_chunks(spark):
    def words(n, tag="w"):
        return " ".join(f"{tag}{i}" for i in range(n))

    fixed = ["\n\n".join(words(n, f"p{n}_") for n in (300, 150, 100, 600, 10)), words(500), words(501), words(850), "", "  \n\n ", "a\r\n\r\nb", "a \n\u0085\nb"]
    r = random.Random(4)
    drawn = ["".join(r.choices(["word ", "x", "\n\n", "\n", " ", " ", "\u001c", "\r\n"], k=r.randrange(120))) for _ in range(300)]
    for texts, size, overlap in ((fixed, 500, 80), (drawn, 7, 2), (drawn[:60], 3, 5)):
        df = spark.createDataFrame([(f"{i:04d}", t) for i, t in enumerate([*texts, None])], "source_path string, text string")
        got = {}
        for row in chunking.chunk_documents(df, max_tokens=size, overlap=overlap).orderBy("source_path", "chunk_index").collect():
            assert row["chunk_index"] == len(got.setdefault(row["source_path"], []))
            got[row["source_path"]].append(row["text"])
        assert got == {f"{i:04d}": c for i, t in enumerate(texts) if (c := chunk_model(t, size, overlap))}


class Letters:
    """A tokenizer of which each character is a token."""

    def encode(self, text):
        return [ord(c) for c in text]

    def decode(self, ids):
        return "".join(map(chr, ids))


def test_chunks_of_tokens(spark):
    df = spark.createDataFrame([("a", "abcde\n\nfgh\n\n" + "0123456789" * 2), ("b", " ")], "source_path string, text string")
    got = [r["text"] for r in chunking.chunk_documents(df, max_tokens=8, overlap=2, tokenizer=Letters).orderBy("chunk_index").collect()]
    # five and three fit without their separator; windows of eight begin every six and end with the paragraph; each gets the tail before it
    assert got == ["abcde\n\nfgh", "gh\n01234567", "67\n67890123", "23\n23456789"]
    assert chunking.pack_tokens(["x" * 501], Letters(), 500, 0) == ["x" * 500, "x"]


def test_tokenizer_that_is_not_there():
    assert chunking.resolve_tokenizer("no such encoding") is None


# --- filtering ---


def judged(spark, rows, **more):
    return filtering.judged(spark.createDataFrame(rows, CHUNKS), **more)


GOOD = "many good words follow each other in this long chunk of text so that it is kept by the filter"


def test_first_copy_counts_even_if_dropped(spark):
    one_a_line = GOOD.replace(" ", "\n")
    rows = [("a", 0, one_a_line), ("a", 1, GOOD), ("b", 0, GOOD + " more"), ("b", 1, GOOD + "  more"), ("c", 0, ""), ("d", 0, None)]
    got = {(r["source_path"], r["chunk_index"]): r for r in judged(spark, rows, threshold=0.8).collect()}
    assert not got["a", 0]["keep"] and got["a", 0]["drop_reasons"] == ["many_short_lines", "below_threshold"]
    assert got["a", 1]["is_duplicate"] and got["a", 1]["drop_reasons"] == ["duplicate"]
    assert got["b", 0]["keep"] and got["b", 0]["drop_reasons"] == [] and got["b", 1]["is_duplicate"]
    assert got["c", 0]["drop_reasons"] == ["too_short", "empty", "below_threshold"]
    assert got["d", 0]["drop_reasons"] == ["duplicate", "too_short", "empty", "below_threshold"]


def test_length_bound(spark):
    got = {r["source_path"]: r["keep"] for r in judged(spark, [("short", 0, " " + "x" * 79 + " "), ("long", 0, "y" * 80)]).collect()}
    assert got == {"short": False, "long": True}


def test_report(spark):
    j = judged(spark, [("a", 0, GOOD), ("a", 1, "x"), ("b", 0, GOOD), ("b", 1, "12%")])
    counted = {r["reason"]: r["count"] for r in filtering.drop_reasons(j, blank_lines=2).collect()}
    assert counted == {"duplicate": 1, "too_short": 2, "below_threshold": 1, "digit_heavy": 1, "percent+digits": 1, "empty_line": 2}
    r = filtering.full_report(j, blank_lines=2).collect()[0]
    assert (r["kept"], r["dropped"], r["kept_unique_docs"], r["docs_with_zero_kept_chunks"], r["score_count"]) == (1, 5, 1, 1, 1)
    assert [x["reason"] for x in r["drop_reasons_top"]][:2] == ["empty_line", "too_short"] and r["score_min"] == r["score_max"] == r["score_avg"]
    nothing = filtering.report(judged(spark, [("a", 0, "x")])).collect()[0]
    assert nothing["kept"] == 0 and nothing["score_avg"] is None
    none = filtering.full_report(judged(spark, []).limit(0)).collect()[0]
    assert none["kept"] == none["dropped"] == 0
    assert {tuple(x) for x in filtering.per_document(j).collect()} == {("a", 1, 1), ("b", 0, 2)}
    assert filtering.kept(j).columns == ["source_path", "chunk_index", "quality_score", "text"]


# --- search ---


def test_query_words(spark):
    one = spark.range(1)
    asked = {"crisis política en ecuador 2001": ["crisis", "politica"], "La de el año 2006, señor SEÑOR": ["2006", "senor"], "": []}
    for q, want in asked.items():
        assert one.select(search.query_words(F.lit(q))).first()[0] == want
    assert one.select(interactive.query_words(F.lit("paz PAZ de política"))).first()[0] == ["paz", "paz", "política"]


def test_rerank(spark):
    rows = [("x", "nothing"), ("x", "La Política y la crisis"), ("x", "crisis política. El Ministro dijo"), ("x", "ing. juan"), ("x", "ing.juan")]
    df = spark.createDataFrame([(0.5, t) for _, t in rows], "base_score double, text string")
    got = [(r["hits"], round(r["score"], 6)) for r in search.reranked(df, "crisis política en ecuador").collect()]
    assert got == [(0, -0.15), (2, 0.56), (2, 0.51), (0, -0.15), (0, -0.2)]
    assert {r["score"] for r in search.reranked(df, "de la").collect()} == {0.5, 0.45}


def docs_model(hits, need, docs=5, per_doc=2):
    by = {}
    for h in hits:
        by.setdefault(h["source_path"], []).append(h)
    out = []
    for path, own in by.items():
        own = sorted(own, key=lambda h: (-h["score"], -h["base_score"], h["id"]))
        full, part = [h for h in own if need and h["hits"] >= need], [h for h in own if need and h["hits"] == need - 1]
        chosen = full or part or own
        out.append((chosen[0]["score"], path, [h["id"] for h in chosen[:per_doc]]))
    return sorted(out, key=lambda x: (-x[0], x[1]))[:docs]


def test_best_documents(spark):
    r = random.Random(7)
    for need in (0, 1, 2, 3):
        hits = [{"id": i, "source_path": f"d{r.randrange(8)}", "hits": r.randrange(need + 1), "score": r.randrange(10) / 10, "base_score": r.randrange(5) / 10, "query_words": ["w"] * need} for i in range(40)]
        df = spark.createDataFrame(hits, "id int, source_path string, hits int, score double, base_score double, query_words array<string>")
        got = {}
        for row in search.best_documents(df).orderBy("doc_rank", "chunk_rank").collect():
            got.setdefault((row["doc_score"], row["source_path"]), []).append(row["id"])
        assert [(s, p, ids) for (s, p), ids in got.items()] == docs_model(hits, need)


@pytest.fixture
def index(spark):
    rows = [("a", 0, "política crisis", [1.0, 0.0]), ("a", 1, "other", [0.8, 0.6]), ("b", 0, "crisis política hoy", [0.6, 0.8]), ("c", 0, "nada", [0.0, 1.0]), ("d", 0, None, None)]
    return spark.createDataFrame([(f"{p}::#{i}", p, i, None, t, v) for p, i, t, v in rows], "id string, source_path string, chunk_index int, quality_score double, text string, embedding array<double>")


def test_nearest(spark, index):
    q = F.array(F.lit(2.0), F.lit(0.0))
    assert [(r["id"], r["base_score"]) for r in search.nearest(index, q, 2).orderBy(F.desc("base_score")).collect()] == [("a::#0", 2.0), ("a::#1", 1.6)]
    low = search.nearest(index, q, 99, metric="l2").orderBy(F.desc("base_score")).collect()
    assert [r["id"] for r in low] == ["a::#0", "a::#1", "b::#0", "c::#0"] and low[0]["base_score"] == -1.0
    table = spark.createDataFrame([([2.0, 0.0],)], "query_vector array<double>")
    assert search.nearest(index, table, 2).count() == 2


@pytest.mark.parametrize("weight, label", [(1.0, "HQ"), (0.385, "HQ"), (0.38, "ALL")])
def test_fallback_bound(index, weight, label):
    # the best document's score is the weight and 0.06 for two hits; 0.45 is still strong... of all chunks or of the good ones
    q = F.array(F.lit(weight + 0.005), F.lit(0.0))
    got = search.search_with_fallback(index.where("id = 'a::#0'"), index, "crisis política", q).collect()
    assert {r["label"] for r in got} == {label}
    assert search.search_with_fallback(index.limit(0), index, "crisis", q).first()["label"] == "ALL"


def test_build_index_and_texts(spark, index):
    chunks = spark.createDataFrame([("a", 0, "x"), ("b", 3, "y")], CHUNKS)
    vectors = spark.createDataFrame([("a::#0", [3.0, 4.0]), ("z::#0", [1.0, 1.0])], "id string, embedding array<float>")
    got = search.build_index(chunks, vectors).collect()
    assert len(got) == 1 and got[0]["id"] == "a::#0" and got[0]["embedding"] == pytest.approx([0.6, 0.8]) and got[0]["quality_score"] is None
    assert [tuple(r) for r in search.dimensions(search.build_index(chunks, vectors, normalized=False)).collect()] == [(2, 1)]
    docs = spark.createDataFrame([("a", "z" * 7000)], "source_path string, text string")
    texts = {r["source_path"]: r["full_text"] for r in search.full_text(index.where("embedding is not null").select("source_path").distinct(), docs).collect()}
    assert len(texts["a"]) == 6000 and texts["b"] is None


# --- interactive ---


def words_of(t):
    return t.lower().split()


def shingles(t, k=5):
    w = words_of(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def greedy_model(rows, similar, per_doc):
    kept = []
    for r in rows:
        if sum(k["doc_path"] == r["doc_path"] for k in kept) >= per_doc:
            continue
        s = shingles(r["text"])
        if any(s and (u := shingles(k["text"])) and len(s & u) / len(s | u) >= similar for k in kept):
            continue
        kept.append(r)
    return [r["id"] for r in kept]


def test_greedy(spark):
    r = random.Random(8)
    base = "one two three four five six seven eight nine ten".split()
    rows = []
    for g in range(40):
        for i in range(12):
            w = list(base)
            for _ in range(r.randrange(3)):
                w[r.randrange(10)] = r.choice("xyz")
            rows.append((g, i, f"d{r.randrange(4)}", " ".join(w[: r.choice([3, 10, 10])])))
    df = spark.createDataFrame(rows, "g int, id int, doc_path string, text string")
    got = {}
    for row in interactive.greedy(df, [F.asc("id")], 0.5, 2, group="g").orderBy("g", "position").collect():
        got.setdefault(row["g"], []).append(row["id"])
        assert row["position"] == len(got[row["g"]])
    for g in range(40):
        assert got[g] == greedy_model([{"id": i, "doc_path": d, "text": t} for h, i, d, t in rows if h == g], 0.5, 2)


def test_shingles_and_jaccard(spark):
    df = spark.createDataFrame([("a b c d", "a b c d"), ("a b c d e", "A  b\nc d e"), ("a b c d e f", "b c d e f g")], "a string, b string")
    a, b = interactive.shingles(F.col("a")), interactive.shingles(F.col("b"))
    assert [round(r[0], 6) for r in df.select(interactive.jaccard(a, b)).collect()] == [0.0, 1.0, 0.333333]


def test_interactive_search(spark, index):
    q = F.array(F.lit(1.0), F.lit(0.0))
    got = interactive.interactive_search(index, "crisis crisis política politica", q, top=5).orderBy("position").collect()
    assert [(r["id"], r["hits"]) for r in got] == [("a::#0", 3), ("b::#0", 3), ("a::#1", 0), ("c::#0", 0)]
    assert got[0]["rerank"] == pytest.approx(1.24) and got[0]["chunk_id"] == "0"
    plain = interactive.interactive_search(index, "x", q, top=5, rerank=False, dedup=False).orderBy("position").collect()
    assert [r["id"] for r in plain] == ["a::#0", "a::#1", "b::#0", "c::#0"]
    assert interactive.interactive_search(index.limit(0), "x", q).count() == 0
    assert spark.range(1).select(interactive.first_filled(F.lit(None), F.lit(""), F.lit(0))).first()[0] == "0"
    with pytest.raises(ValueError):
        interactive.interactive_search(index, "x", q, top=81)


def test_scores_are_worked_out_once_and_reports_write_no_texts(spark):
    chunks = spark.createDataFrame([("a", 0, f"Tel 1 {'good words ' * 20}"), ("b", 0, "x"), ("c", 0, "x")], "source_path string, chunk_index int, text string")
    plan = filtering.scored(chunks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[Aa][Xx]") == 1 and plan.count("ÁÉÍÓÚÜÑáéíóúüñ") == 1
    found = filtering.judged(chunks, texts=False)
    assert "text" not in found.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, filtering.judged(chunks).drop("text").collect()))


@pytest.mark.parametrize("given", ["-----", "--=_-", "----", "a-----b", "|||", "||", "||-|-", "-- ---", "x|||x"])
def test_separators(spark, given):
    assert spark.range(1).select(F.lit(given).rlike(quality.SEPARATORS)).first()[0] == bool(re.search(r"[-_=]{5,}|[|]{3,}", given))


def test_phone_words(spark):
    given = ["Tel", "telf 1", "hotel", "Telfa", "Téltel", "_fax", "a Fax.", "PBX", "pbxs", "ñtel", "tel é", "tél tel"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(given)), "i int, t string").orderBy("i").select(F.col("t").rlike(quality.PHONE)).collect()]
    assert got == [bool(re.search(r"\b(Tel|Telf|PBX|Fax)\b", t, re.I)) for t in given]


def test_blanks_remembers_nothing(spark):
    from siftline.queries import Blanks

    own = Blanks()
    ids = own.encode(" ñ  a\nñ 😀 a")
    assert vars(own) == {} and Blanks().decode(ids) == "ñ a ñ 😀 a" and len(set(ids)) == 3
    docs = spark.createDataFrame([(str(i), f"w{i} " * (i % 700) + "\n\nend") for i in range(450)], "source_path string, text string").coalesce(1)
    got = chunking.chunk_documents(docs, tokenizer=Blanks)
    assert got.where("chunk_index = 0").count() == 450
