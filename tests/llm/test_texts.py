from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftline.llm import decontamination as dc
from siftline.llm import pii, quality, toxicity
from siftline.llm.fitting import logistic, probability

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

# --- personal data ---


def luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(d[0::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def base_model(t):
    """The contract's expressions as they stand."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    found = [(m.start(), n, k, m.end()) for n, (k, (p, ok)) in enumerate(checks.items()) for m in re.finditer(p, t) if ok(m[0])]
    return [(a, b, k) for a, _, k, b in sorted(found)]


def test_base_spans_are_the_expressions():
    r = random.Random(1)
    alphabet = ["a", "b.c", "@", "x@y.z", ".", "-", "+", "1", "23", "4.5", "192.168.0.1", "4111 1111 1111 1111", " ", "(", ")", "é", "+49 30 123456", "%", "_", "\n", "999.1.1.1"]
    for _ in range(4000):
        t = "".join(r.choices(alphabet, k=r.randrange(14)))
        base, spans = pii.find(t)
        assert base == base_model(t), t
        assert set(base) <= set(spans)


@pytest.mark.parametrize(
    "text, want",
    [
        ("mail jo.doe at example dot com now", ["jo.doe at example dot com"]),
        ("mail jo [at] example [dot] org", ["jo [at] example [dot] org"]),
        ("write jo(at)example(dot)co(dot)uk.", ["jo(at)example(dot)co(dot)uk"]),
        ("jо@exаmple.com with Cyrillic letters", ["jо@exаmple.com"]),
        ("ｊｏ＠ｅｘａｍｐｌｅ．ｃｏｍ", ["ｊｏ＠ｅｘａｍｐｌｅ．ｃｏｍ"]),
        ("card four one one one 1111 1111 1111 here", ["four one one one 1111 1111 1111"]),
        ("host 10 dot 0 dot 0 dot 7", ["10 dot 0 dot 0 dot 7"]),
        ("plain jo@example.com", ["jo@example.com"]),
        ("we met at the dot on the map, at noon", []),
        ("one two three, and nobody at home", []),
        ("", []),
    ],
)
def test_disguises(text, want):
    assert [text[a:b] for a, b, _ in pii.find(text)[1]] == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("ask jane.doe at gmail.com today", ["jane.doe at gmail.com"]),
        ("email jane at gmail.com today", ["jane at gmail.com"]),
        ("jane at mail dot hu", ["jane at mail dot hu"]),
        ("jane at mail dot ro, or jane at mail dot xyz", ["jane at mail dot ro", "jane at mail dot xyz"]),
        ("jane at mail dot com . Thanks for all", ["jane at mail dot com"]),
        ("jane at mail dot co dot hu", ["jane at mail dot co dot hu"]),
        ("jo [at] mail [dot] com . Thanks", ["jo [at] mail [dot] com"]),
        ("we met at example.com on Monday", []),
        ("look at the dot on it", []),
        ("in 2020 at example.com and, e.g. at example.com", []),
        ("contact us at example.com", []),
    ],
)
def test_disguises_by_shape(text, want):
    assert [text[a:b] for a, b, _ in pii.find(text)[1]] == want


@pytest.mark.parametrize(
    "name, text, spans",
    [
        ("letters", "mail me @ home " + "a" * 10**6, 0),
        ("digits", "x [at] y " + "1" * 10**6, 0),
        ("mixed", "one 2 " + "3" * 10**6 + "a", 0),
        ("base64", "see @ " + "QUJD+/09" * 125_000, 0),
        ("signs", "@" * 10**6, 0),
        ("names", "a@" * 500_000, 0),
        ("ats", " at" * 300_000, 0),
        ("dots", "x at " + "a." * 500_000, 0),
        ("spaces", " " * 10**6 + "@ a", 0),
        ("phones", "+1(" * 300_000, 0),
        ("plain", "jo@mail.com " * 100_000, 100_000),
        ("disguised", "jo [at] mail dot com, " * 100_000, 100_000),
        ("hosts", "10 dot 0 dot 0 dot 1, " * 50_000, 50_000),
    ],
)
def test_long_texts_take_seconds(name, text, spans):
    began = time.perf_counter()
    assert len(pii.find(text)[1]) == spans
    assert time.perf_counter() - began < 8


def test_pii_rows(frame, hard):
    rows = [*hard, (50, "a@b.c"), (50, "a@b.c"), (None, "x at example dot com")]
    found = {(r["doc_id"], r["spans"]) for r in pii.personal_data(frame(rows)).collect()}
    assert {x for x in found if x[1]} == {(50, "email:0:5"), (None, "email:0:20")}
    assert pii.personal_data(frame(rows)).count() == len(rows) and pii.personal_data(frame(rows).limit(0)).count() == 0
    assert {r["text"] for r in pii.redacted(frame([(1, "to a@b.c, +49 30 123456!"), (2, None)])).collect()} == {"to [email], [phone]!", ""}


def test_pii_query(spark):
    from siftline.llm.queries import op4_pii

    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")["text"].to_dict()
    for r in op4_pii(spark, SF).collect():
        want = base_model(docs[r["doc_id"]] or "")
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[2] == k for w in want) for k in pii.KINDS]
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


# --- benchmark decontamination ---


def item_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def hits_model(text, items, window=10):
    own = item_words(text)
    hit, names = [False] * len(own), set()
    for name, t in items:
        w = item_words(t)
        n = min(window, len(w))
        runs = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(own) - n + 1):
            if runs and tuple(own[i : i + n]) in runs:
                hit[i : i + n] = [True] * n
                names.add(name)
    return len(own), sum(hit), sorted(n for n in names if n is not None)


def test_contamination(spark, frame, hard, prose, monkeypatch):
    monkeypatch.setattr(dc, "SEGMENT", 300)
    items = [("i1", prose("i1", 30)), ("i2", prose("i2", 10)), ("i10", "three short words"), ("i3", ""), ("i4", None), (None, prose("null", 20)), ("i5", "solo"), ("i5", prose("i5", 12)), ("i6", prose("i1", 30).upper())]
    r = random.Random(5)
    rows = list(hard)
    for k in range(60):
        w = prose(f"d{k}", r.randrange(60)).split()
        for _ in range(r.randrange(3)):
            p = (r.choice(items)[1] or "x").split()
            a = r.randrange(len(p)) if p else 0
            at = r.randrange(len(w) + 1)
            w[at:at] = p[a : a + r.choice([9, 10, 11, 30])]
        rows.append((100 + k, ", ".join(w)))
    rows += [(300, prose("i1", 30)), (300, prose("i1", 30)), (None, "solo")]
    frames = spark.createDataFrame(items, "item_id string, text string")
    want = sorted(((i, *hits_model(t, items)) for i, t in rows), key=str)

    def got(found):
        return sorted(((x["doc_id"], x["n_words"], x["n_hit"], list(x["items"])) for x in found.collect()), key=str)

    assert got(dc.contamination(frame(rows), frames)) == want
    monkeypatch.setattr(dc, "blocks", lambda items, n=20, real=dc.blocks: real(items, n))  # many passes over the index
    assert got(dc.contamination(frame(rows), frames)) == want
    assert got(dc.contamination(frame(rows), frames.limit(0))) == sorted(((i, len(item_words(t)), 0, []) for i, t in rows), key=str)
    assert dc.contamination(frame(rows).limit(0), frames).count() == 0


def test_proximity(spark, frame):
    index = dc.build_index(frame([(1, "alpha x beta gamma"), (2, "gamma alpha far far far far far beta"), (3, "beta gamma")]))
    items = spark.createDataFrame([("q", "alpha beta gamma")], "item_id string, text string")
    found = dc.search(index, items, window=10, slop=1)
    docs = index.select("segment", F.posexplode("docs").alias("no", "d"))
    assert [r["doc_id"] for r in found.join(docs, ["segment", "no"]).select("d.doc_id").collect()] == [1]


def test_proximity_against_all_windows():
    r = random.Random(8)
    for _ in range(400):
        docs = [[r.choice("abcd") for _ in range(r.randrange(1, 12))] for _ in range(3)]
        phrase, slop = [r.choice("abc") for _ in range(r.randrange(1, 5))], r.choice([0, 1, 2, 70])
        vocabulary = np.unique(dc.WORDS.of(phrase)[0])
        b = dc._segment(0, [1, 2, 3], [dc.WORDS.of(d)[0] for d in docs])
        starts = np.array(b.column("docs")[0].values.field("start"), dtype=np.int64)
        s = dc.Segment(b.column("terms")[0].as_py(), b.column("offsets")[0].as_py(), b.column("positions")[0].as_py(), vocabulary)
        found = s.near(np.searchsorted(vocabulary, dc.WORDS.of(phrase)[0]), slop, starts)
        fits = lambda w: all(w.count(x) >= phrase.count(x) for x in phrase)
        want = [(o + i, o + j) for o, d in zip(starts.tolist(), docs) for i in range(len(d)) for j in range(i, min(len(d), i + len(phrase) + slop)) if fits(d[i : j + 1]) and not fits(d[i + 1 : j + 1]) and not fits(d[i:j])]
        assert found == want


def test_contamination_query(spark):
    from siftline.llm.queries import op5_decontamination

    docs, items = (pd.read_parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    items = [(str(i), t) for i, t in zip(items["item_id"], items["text"])]
    want = {i: hits_model(t, items) for i, t in zip(docs["doc_id"], docs["text"])}
    for r in op5_decontamination(spark, SF).collect():
        n, hit, names = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(names), hit > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()


# --- classifiers ---


@pytest.mark.parametrize("name, label, least", [("op6_quality", "quality", 0.85), ("op7_toxicity", "toxic", 0.9)])
def test_held_out(spark, name, label, least):
    from siftline.llm import queries

    found = queries.QUERIES[name](spark, LARGER).toPandas().set_index("doc_id")
    assert len(found) == len(pd.read_parquet(f"{LARGER}/documents.parquet")) and found["score"].between(0, 1).all()
    limit = 0.3 if label == "quality" else 0.7
    assert (found["predicted"] == (found["score"] >= limit)).all()
    joined = found.join(pd.read_parquet(f"{LARGER}/labels.parquet").set_index("doc_id")[label], how="inner")
    held = joined[joined["held_out"]]
    assert (held["predicted"] == held[label]).mean() >= least


def test_scores_of_hard_rows(spark, frame, hard, prose):
    docs = frame([*hard, *((100 + i, prose(i, 40) if i % 2 else "spam $$$ 111 " * 10) for i in range(40)), (None, "x")])
    labels = spark.createDataFrame([(100 + i, i % 2, 1 - i % 2) for i in range(40)] + [(100, 0, 1), (None, 1, 1), (101, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        model = module.fit(docs, labels, F.lit(True))
        rows = module.scored(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert module.scored(docs.limit(0), model).count() == 0
        for few in (labels.limit(0), labels.where("quality = 1 and toxic = 0")):
            assert {r["score"] for r in module.scored(docs, module.fit(docs, few, F.lit(True))).collect()} == {0.5}
    model = quality.fit(docs, labels, F.lit(True))
    score = {r["doc_id"]: r["score"] for r in quality.scored(docs, model).collect()}
    middle = sorted(score.values())[len(score) // 2]  # ties with the limit are accepted
    kept = quality.accepted(docs, model, middle)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in score.items() if s >= middle}


def test_repeated_rows_and_ids_are_learned_from_as_they_come(spark, frame, prose):
    rows = [(i, prose(i, 40) if i % 2 else "spam $$$ 111 " * 10) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        once, twice = (module.scored(frame(rows), module.fit(frame(x), labels, F.lit(True))).collect() for x in (rows, rows + rows))
        assert all((a["score"] < 0.5) == (b["score"] < 0.5) for a, b in zip(sorted(once), sorted(twice), strict=True))
        again = module.scored(frame(rows), module.fit(frame(rows[::-1]), labels, F.lit(True))).collect()  # however the rows come
        assert {r["doc_id"]: r["score"] for r in again} == pytest.approx({r["doc_id"]: r["score"] for r in once}, abs=1e-6)


def test_quality_score_by_hand(spark):
    """Dictionaries, differences, calibration and scores again, from the tables, in plain Python."""
    import zstandard

    from siftline.llm.queries import op6_quality

    docs, labels = (pd.read_parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    texts = docs.set_index("doc_id")["text"].fillna("").to_dict()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    learn = sorted((y, i) for i, y in zip(labels["doc_id"].tolist(), labels["quality"].tolist()) if y in (0, 1) and i in texts and not held(i))

    def shapes(t):
        raw = t.encode()
        shape = "".join("A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 or b > 127 else "0" if 48 <= b <= 57 else chr(b) for b in raw)
        return raw, shape.encode(), re.sub("([aA0])\\1*", r"\1", shape).encode()

    def parts(v, n):
        return [v[k : k + n] for k in range(0, len(v), n) if k == 0 or len(v) - k > n // 2]

    def drawn(y, v):
        mask = (1 << 64) - 1

        def mixed(h):
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ h >> shift) * factor & mask
            return h ^ h >> 31

        every = []
        for label, i in learn:
            if label == y:
                own = parts(shapes(texts[i])[v], 600) or [b""]
                every += [(-np.log((mixed(mixed(i) + k & mask) >> 11) / 2**53) * len(own), p) for k, p in enumerate(own)]
        return b"\n".join(p for _, p in sorted(every)[:218])[:65_536]

    squeeze = [[zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(drawn(y, v), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for y in (1, 0)] for v in range(3)]

    def differences(t):
        out = []
        for v, view in enumerate(shapes(t)):
            diff = lambda p: (lambda g, b: (b - g) / (b + g))(*(len(z.compress(p)) for z in squeeze[v]))
            out.append(diff(view))
            if v:
                each = [diff(p) for p in parts(view, (200, 100)[v - 1]) or [b""]]
                out += [min(each), max(each), sum(each) / len(each)]
        return out

    x, y = np.array([differences(texts[i]) for _, i in learn]), np.array([y for y, _ in learn], float)
    wide = lambda a: (lambda z: np.column_stack([np.ones(len(z)), z, *(z[:, i] * z[:, j] for i in range(z.shape[1]) for j in range(i, z.shape[1]))]))(np.clip((a - x.mean(0)) / (x.std(0) + 1e-9), -5, 5))
    w = logistic(wide(x), y, 1e-4)
    want = {i: float(probability(wide(np.array([differences(t)])), w)[0]) for i, t in texts.items()}
    found = op6_quality(spark, SF).collect()
    assert {r["doc_id"]: r["score"] for r in found} == pytest.approx(want, abs=1e-6)
    assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.3) for r in found)


def maximal(values):
    """By the definition: segments of which every part scores less, and that aren't within another such segment."""
    n, total = len(values), lambda a, b: sum(values[a : b + 1])
    good = [(a, b) for a in range(n) for b in range(a, n) if total(a, b) > 0 and all(total(c, d) < total(a, b) for c in range(a, b + 1) for d in range(c, b + 1) if (c, d) != (a, b))]
    return [(a, b, total(a, b)) for a, b in good if not any((c <= a and b <= d) and (c, d) != (a, b) for c, d in good)]


def test_segments_are_all_maximal_ones():
    r = random.Random(2)
    for _ in range(3000):
        values = [r.choice([-5, -4, -3, -2, -1, 1, 2, 3, 4]) for _ in range(r.randrange(0, 14))]
        assert toxicity.segments(np.array(values, float)) == maximal(values), values


def test_segments_take_linear_time():
    for s in (np.where(np.arange(400_000) % 2 == 0, 1.0, -0.99), np.where(np.arange(400_000) % 2 == 0, 1.0, -1.01), np.tile([1.0] + [-0.001] * 9, 40_000), np.repeat([1.0, -1.0], 200_000)):
        began = time.perf_counter()
        toxicity.segments(s)
        assert time.perf_counter() - began < 4


def test_toxicity_score_by_hand(spark):
    """Counts, priors, log-odds, segments and scores again, from the tables, in plain Python."""
    from siftline.llm.queries import op7_toxicity

    docs, labels = (pd.read_parquet(f"{LARGER}/{n}.parquet") for n in ("documents", "labels"))
    texts = docs.set_index("doc_id")["text"].fillna("").to_dict()
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    learn = [(i, y) for i, y in zip(labels["doc_id"].tolist(), labels["toxic"].tolist()) if y in (0, 1) and i in texts and not held(i)]
    split = lambda t: re.findall("[a-z\u0080-\U0010ffff]+", t.lower())
    count = {}
    for i, y in learn:
        for w in set(split(texts[i])):
            count.setdefault(w, [0, 0])[y] += 1
    share = sum(c[1] for c in count.values()) / sum(map(sum, count.values()))
    types = {}
    for w, c in count.items():
        if len(w) > 4:
            types.setdefault(w[:4], []).append(c[1] / sum(c))

    def score(w, y=None):
        c, own = list(count.get(w, (0, 0))), types.get(w[:4], []) if len(w) > 4 else []
        known = sum(c) > 1
        n, u = len(own) - known * (len(w) > 4), sum(own) - known * (len(w) > 4) * c[1] / max(sum(c), 1)
        mean = (max(u, 0) + 30 * share) / (n + 30)
        if not known:
            c = [0, 0]
        elif y is not None:
            c[y] = max(c[y] - 1, 0)
        return np.log((c[1] + 10 * mean) / (c[0] + 10 * (1 - mean))) - np.log(share / (1 - share)) - 1

    clean = [(s, toxicity.segments(s)) for i, y in learn if not y for s in [np.array([score(w, 0) for w in split(texts[i])])]]
    s = np.round(np.concatenate([x for x, _ in clean]), 2)
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if np.exp(np.minimum(mid * s, 600)).mean() < 1 else (low, mid)
    k = np.exp(low * np.mean([max((z for *_, z in f), default=0) for _, f in clean]) - 0.5772) / np.mean([len(x) for x, _ in clean])

    def features(t, y=None):
        v = np.array([score(w, y) for w in split(t)])
        each = [max(0.0, low * z - np.log(max(k * len(v), 1e-12))) for *_, z in toxicity.segments(v)]
        return [1.0, np.log1p(sum(each)), np.log1p(max(each, default=0))]

    w = logistic(np.array([features(texts[i], y) for i, y in learn]), np.array([y for _, y in learn], float))
    want = {i: float(probability(np.array([features(t)]), w)[0]) for i, t in texts.items()}
    found = op7_toxicity(spark, LARGER).collect()
    assert {r["doc_id"]: r["score"] for r in found} == pytest.approx(want, abs=1e-4)
    assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.7) for r in found)


def test_logistic():
    r = np.random.default_rng(1)
    x = np.column_stack([np.ones(4000), r.normal(size=4000)])
    y = (r.random(4000) < probability(x, np.array([0.5, 2.0]))).astype(float)
    assert logistic(x, y) == pytest.approx([0.5, 2.0], abs=0.25)
