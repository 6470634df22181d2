"""Rows that the test tables have none of, or only the larger ones, against the SQL of each query, to the sign of a zero."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from siftline.functions.numbers import rounded

PAGES = [(1, "<title>cut &quot</title>"), (2, "&copy &middot &lt &#39 &eacute; &amp &am"), (3, None), (4, "a &quot;b&quot; &amp;lt; <b>c</b>")]
DOCUMENTS = [(1, "one\n \ntwo", "en", "a", 8), (2, "", "en", "a", 0), (3, " \n \n", "en", "a", 4), (4, None, "en", "b", 0), (5, "x", "en", "b", 1)]
VECTORS = [(1, [1.0, -2e-7, 0.5], 0), (2, [0.0, 0.0, 0.0], 0), (3, None, 0), (4, [-0.0, 3.0, 4.0], 1), (5, [0.1234565, -1.0, 2e-7], 1)]
SCHEMAS = {"pages": "page_id long, html string", "documents": "doc_id long, text string, lang string, source string, n_chars long", "embeddings": "vec_id long, embedding array<float>, label int"}


@pytest.fixture
def differ(spark, tmp_path):
    """Writes tables and gives the rows that only the query or only its SQL has."""
    import duckdb

    def run(query, **tables):
        c = duckdb.connect()
        for name, rows in tables.items():
            spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
            c.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
        want = c.execute(entry.oracle_sql()[query])
        names = [x[0] for x in want.description]
        got = entry.queries()[query](spark, str(tmp_path)).select(*names).collect()
        return sorted(map(repr, map(tuple, got))), sorted(map(repr, want.fetchall()))

    return run


def test_clean_markup_of_cut_entities(differ):
    got, want = differ("clean_markup", pages=PAGES)
    assert got == want


def test_split_paragraphs_of_blank_texts(differ):
    got, want = differ("split_paragraphs", documents=DOCUMENTS)
    assert got == want and len(want) == 3


def test_l2_normalize_of_small_and_zero_elements(differ):
    got, want = differ("l2_normalize", embeddings=VECTORS)
    assert got == want and "-0.0" in str(want) and "nan" in str(want)


def test_index_table_of_small_and_zero_elements(differ):
    got, want = differ("index_table", documents=DOCUMENTS, embeddings=VECTORS)
    assert got == want and "-0.0" in str(want) and "nan" in str(want)


def test_rounded(spark):
    import duckdb

    values = [0.84375, 0.71235, 1.00005, -0.00004, 0.0, -0.0, 0.49999999999999994, 0.00015, 123456.00005]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(rounded("v", 4)).collect()
    assert list(map(repr, (r[0] for r in got))) == [repr(duckdb.execute("select round(?::double, 4)", [v]).fetchone()[0]) for v in values]


def test_shingle_jaccard_shuffles_no_shingles(spark, differ, tmp_path):
    texts = [(1, "a b c d e f", "en", "a", 11), (2, "A b c d e g", "en", "a", 11), (3, "a b", "en", "a", 3), (4, None, "en", "a", 0), (5, "a b c d e a b c d e a", "en", "a", 21), (6, "b c d e a b", "en", "a", 11)]
    got, want = differ("shingle_jaccard", documents=texts)
    assert got == want and len(want) == 5
    plan = entry.queries()["shingle_jaccard"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" in plan and "array_distinct" not in plan[plan.index("Join Inner") :]
