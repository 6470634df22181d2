from __future__ import annotations

import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from siftline.functions import quality, text, vectors

SAMPLES = ["", " ", "a", " \n x \t ", "señor Ñandú  ÁÉ", "a b\u0085c\u001cd e\r\nf\rg\u000bh", "٣ 12", "\n\n\n", "tail 　", "x\n", "ﬁn ½", "Política É", "😀a 😀"]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate([*SAMPLES, None])], "i int, t string")


def column(samples, c):
    return [r[0] for r in samples.orderBy("i").select(c).collect()]


@pytest.mark.parametrize(
    "name, model",
    [
        ("strip", str.strip),
        ("rstrip", str.rstrip),
        ("squeeze", lambda t: re.sub(r"\s+", " ", t.strip())),
        ("newlines", lambda t: t.replace("\r\n", "\n").replace("\r", "\n")),
        ("words", str.split),
        ("content_hash", lambda t: hashlib.sha1(re.sub(r"\s+", " ", t.strip()).encode()).hexdigest()),
        ("fold_exact", lambda t: "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c))),
        ("snippet", lambda t: t[:320] + "…" if len(t) > 320 else t),
        ("preview", lambda t: t[:500].replace("\n", " ")),
    ],
)
def test_as_python(samples, name, model):
    assert column(samples, getattr(text, name)(F.col("t"))) == [*map(model, SAMPLES), None]


def test_lines(samples):
    got = column(samples, text.lines(F.col("t")))
    for t, lines in zip(SAMPLES, got):
        assert [x for x in lines if x] == [x for x in t.splitlines() if x]


def test_fold_differs_only_where_a_character_becomes_several(spark):
    chars = [chr(i) for i in range(32, 0x3000) if chr(i).isprintable()]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(chars)), "i int, t string").orderBy("i").select(text.fold(F.col("t"))).collect()]
    for ch, g in zip(chars, got):
        want = "".join(c for c in unicodedata.normalize("NFKD", ch.lower()) if not unicodedata.combining(c))
        if len(want) <= 1:
            assert g == want, ch


def test_bind_keeps_value(samples):
    assert column(samples, text.bind(F.length("t"), lambda n: F.transform(F.sequence(F.lit(1), F.lit(2)), lambda i: i * n)))[2] == [1, 2]


def stats_model(t):
    t = t.strip()
    n, lines = len(t), [x.strip() for x in t.splitlines() if x.strip()]
    if not n:
        return dict.fromkeys(quality.STATS, 0) | {"short_lines_ratio": 1.0}
    a, d, s = (len(re.findall(p, t)) for p in (quality.LETTERS, r"\d", r"\s"))
    return {"n": n, "alpha": a, "digit": d, "space": s, "alpha_ratio": a / n, "digit_ratio": d / n, "space_ratio": s / n, "lines": len(lines), "avg_line_len": sum(map(len, lines)) / len(lines), "short_lines_ratio": sum(len(x) <= 20 for x in lines) / len(lines)}


def score_model(s, t):
    if s["n"] == 0:
        return 0.0, ["empty"]
    costs = [
        ("digit_heavy", s["digit_ratio"] > 0.18, (s["digit_ratio"] - 0.18) * 1.8), ("many_short_lines", s["short_lines_ratio"] > 0.55 and s["lines"] >= 6, (s["short_lines_ratio"] - 0.55) * 1.2),
        ("many_separators", re.search(r"[-_=]{5,}|[|]{3,}", t), 0.15), ("phoneish", re.search(r"\b(Tel|Telf|PBX|Fax)\b", t, re.I), 0.10),
        ("percent+digits", "%" in t and s["digit_ratio"] > 0.12, 0.08), ("money+digits", re.search(r"[$€]|USD", t, re.I) and s["digit_ratio"] > 0.10, 0.06),
    ]
    total = min(0.85, 1.6 * s["alpha_ratio"])
    for _, met, cost in costs:
        total -= cost if met else 0
    return max(0.0, min(1.0, total)), [n for n, met, _ in costs if met]


PAGES = ["", "   ", "plain words only here", "1234567890 12", "\n".join(["ab"] * 6), "\n".join(["ab"] * 5), "a-----b", "|||", "Tel 12", "tel: 5", "hotel telf", "50% of 1234", "50% of it and many more words", "$ 12345 abcdefgh", "usd 1 abcdefghijklmnop", "ñandú ß ç", "x" * 79, " " + "y" * 80 + " ", "٣٣٣ abc"]


def test_statistics_score_and_reasons(spark):
    s = F.col("s")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*PAGES, None])], "i int, t string").orderBy("i").withColumn("s", quality.stats(F.col("t"))).select("s", quality.score(s, F.col("t")).alias("score"), quality.reasons(s, F.col("t")).alias("why")).collect()
    for t, r in zip([*PAGES, ""], rows):
        want = stats_model(t)
        assert {k: r["s"][k] for k in quality.STATS} == pytest.approx(want)
        score, why = score_model(want, t)
        assert (r["score"], r["why"]) == (pytest.approx(score), why)
        assert 0 <= r["score"] <= 0.85


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    got = df.select(vectors.dot(a, b), vectors.squared_distance(a, b), vectors.norm(a), vectors.normalize(a)).collect()
    assert list(got[0]) == [11.0, 8.0, 5.0, [0.6000000000000001, 0.8]] or list(got[0])[:3] == [11.0, 8.0, 5.0] and got[0][3] == pytest.approx([0.6, 0.8])
    assert list(got[1]) == [0.0, 2.0, 0.0, [0.0, 0.0]]
