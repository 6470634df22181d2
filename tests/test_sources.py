from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from siftline.operators import filtering, search
from siftline.plans import corpus
from siftline.sources import files, plugins
from siftline.streaming.filtering import kept_stream

GOOD = "many good words follow each other in this long chunk of text so that it is kept by the filter"


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def test_images(spark, tmp_path):
    for name in ("b.jpg", "a.JPG", "c.png", "below/d.jpg"):
        write(tmp_path / name, b"<p>x</p>")
    assert sorted(r["doc"] for r in files.read_images(spark, str(tmp_path)).collect()) == ["a", "b"]


def test_markdown_readers(spark, tmp_path):
    write(tmp_path / "in put/raw.md", "one\ntwo")
    write(tmp_path / "other/none.txt", "x")
    write(tmp_path / "deep/er/n.md", b"a\xffb")
    assert [tuple(r) for r in files.read_raw_markdown(spark, str(tmp_path)).collect()] == [("in put", "one\ntwo")]
    got = {tuple(r) for r in files.read_markdown(spark, f"{tmp_path}/").collect()}
    assert got == {("in put/raw.md", "one\ntwo"), ("deep/er/n.md", "a�b")}


def test_named_files(spark, tmp_path):
    parsed = spark.createDataFrame([("a b/c%", "one\ntwo", '{"x": 1}', None), ("d", None, None, "failed"), ("é", "", None, None)], plugins.PARSED)
    files.write_named_files(parsed, str(tmp_path / "out"), "raw.md", "doc", "raw_md")
    files.write_layouts(parsed, str(tmp_path / "out"))
    files.write_named_files(plugins.failed(parsed), str(tmp_path / "out"), "ERROR.txt", "doc", "error")
    got = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert got == {"a b/c%/raw.md": "one\ntwo\n", "a b/c%/layout.json": '{"x": 1}\n', "d/ERROR.txt": "failed\n", "é/raw.md": "\n"}


def test_index_held_and_released(spark, tmp_path):
    index = spark.createDataFrame([("a::#0", "a", 0, None, "t", [1.0])], files.INDEX)
    files.write_index(index, str(tmp_path / "i"))
    held = files.held_index(spark, str(tmp_path / "i"))
    assert held is files.held_index(spark, str(tmp_path / "i")) and held.count() == 1 and held.is_cached
    files.release_index(spark, str(tmp_path / "i"))
    files.release_index(spark, str(tmp_path / "i"))
    assert not held.is_cached


def test_chunk_lines(spark, tmp_path):
    lines = [json.dumps({"source_path": "a", "chunk_index": 0, "text": "ñ  "}, ensure_ascii=False), "", "  ", json.dumps({"source_path": "a", "chunk_index": 1})]
    write(tmp_path / "c.jsonl", "\n".join(lines))
    got = sorted(map(tuple, files.read_chunk_lines(spark, f"{tmp_path}/c.jsonl").collect()), key=str)
    assert got == [(False, "a", 0, "ñ  "), (False, "a", 1, ""), (True, None, None, ""), (True, None, None, "")]
    assert files.read_chunks(spark, f"{tmp_path}/c.jsonl").count() == 2
    write(tmp_path / "bad.jsonl", '{"text": "x"}')
    with pytest.raises(Exception, match="no source_path"):
        files.read_chunk_lines(spark, f"{tmp_path}/bad.jsonl").collect()


def test_writers(spark, tmp_path):
    chunks = spark.createDataFrame([("d/x.md", 0, "é"), ("d/x.md", 11, "b")], files.CHUNK)
    files.write_records(chunks, f"{tmp_path}/records")
    assert files.read_chunks(spark, f"{tmp_path}/records").count() == 2
    files.write_chunk_texts(chunks, f"{tmp_path}/texts")
    assert sorted(p.parent.name for p in (tmp_path / "texts").glob("*/*.txt")) == ["chunk=d%2Fx%2Fchunk_0000", "chunk=d%2Fx%2Fchunk_0011"]
    assert next((tmp_path / "texts").glob("*0000/*.txt")).read_text().rstrip("\n") == "é"
    files.write_report(filtering.full_report(filtering.judged(chunks)), f"{tmp_path}/report")
    assert files.read_report(spark, f"{tmp_path}/report").first()["dropped"] == 2
    assert files.read_report(spark, f"{tmp_path}/nowhere") is None
    files.write_documents_as_files(spark.createDataFrame([("a.md", "x\ny")], "source_path string, text string"), f"{tmp_path}/each")
    assert next((tmp_path / "each/document=a.md").glob("*.txt")).read_text() == "x\ny\n"
    files.write_markdown(chunks, f"{tmp_path}/markdown")
    assert spark.read.parquet(f"{tmp_path}/markdown").count() == 2


def test_parse_and_dead_letters(spark):
    def extractor(raw):
        if raw == b"bad":
            raise ValueError("unreadable")
        return plugins.html_extractor(raw) if raw != b"odd" else ("text", {"x": {1, 2}})

    rows = spark.createDataFrame([("a", b"<h2>T</h2><p>x &amp; y</p><script>z</script>"), ("b", b"bad"), ("c", b"odd"), ("d", None)], "doc string, content binary")
    got = {r["doc"]: r for r in plugins.parse(rows, extractor).collect()}
    assert got["a"]["raw_md"] == "## T\n\nx & y" and json.loads(got["a"]["layout_json"])["blocks"][1] == {"text": "x & y"}
    assert got["b"]["raw_md"] is None and "unreadable" in got["b"]["error"]
    assert got["c"]["raw_md"] == "text" and got["c"]["layout_json"] is None and got["c"]["error"]
    assert got["d"]["raw_md"] == "" and got["d"]["error"] is None
    assert sorted(r["doc"] for r in plugins.failed(plugins.parse(rows, extractor)).collect()) == ["b", "c"]


def test_corpus_to_index(spark, tmp_path):
    raw = spark.createDataFrame([("a", f"{GOOD}\n\n{GOOD} twice"), ("b", "x"), ("c", GOOD)], "doc string, raw_md string")
    built = corpus.build(raw, max_tokens=30)
    assert built.chunks.count() == 4 and built.report.first()["kept"] == 2

    def embedder(texts):
        return [[float(len(t)), 1.0] for t in texts]

    files.write_index(built.index(embedder), f"{tmp_path}/index")
    held = files.held_index(spark, f"{tmp_path}/index")
    assert held.count() == 2 and files.held_index(spark, f"{tmp_path}/index") is held
    assert search.search_documents(held, "words follow", F.array(F.lit(1.0), F.lit(0.0))).count() == 2
    assert built.index(embedder, best=False).count() == 4
    held.unpersist()


def test_stream(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", "a", 0, GOOD), ("2024-01-01 00:00:01", "b", 0, GOOD), ("2024-01-01 00:00:02", "c", 0, "x")]
    spark.createDataFrame(rows, "at string, source_path string, chunk_index int, text string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("at timestamp, source_path string, chunk_index int, text string").parquet(f"{tmp_path}/in")
    asked = kept_stream(stream, "at").writeStream.format("memory").queryName("kept").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    asked.awaitTermination(120)
    assert [r["source_path"] for r in spark.table("kept").collect()] in (["a"], ["b"])


def test_named_files_are_written_and_read_by_tasks(spark, tmp_path):
    """None gets its name on the driver; hidden names, repeated documents, and a file that was there before."""
    rows = [(str(i), "é\n" * (i % 3)) for i in range(300)] + [("_x", "a"), ("7", "again")]
    for _ in range(2):
        files.write_named_files(spark.createDataFrame(rows, "source_path string, text string"), str(tmp_path / "out"), "raw.md")
    assert not (tmp_path / "out/_parts").exists() and len(list((tmp_path / "out").rglob("*"))) == 2 * 301
    got = {r["doc"]: r["raw_md"] for r in files.read_raw_markdown(spark, f"file://{tmp_path}/out/").collect()}
    want = {d: t + "\n" for d, t in rows}
    assert got.pop("7") in ("é\n\nagain\n", "again\né\n\n") and want.pop("7") and got == want
    paths = sorted(r["source_path"] for r in files.read_markdown(spark, str(tmp_path / "out")).collect())
    assert paths == sorted(f"{i}/raw.md" for i in range(300))


def test_images_of_a_pattern(spark, tmp_path):
    for name in ("p/x.jpg", "q/x.JPG", "q/y.jpg", "q/z.png", "q/deep/w.jpg", "top.jpg"):
        write(tmp_path / name, b"x\xff")
    got = sorted(tuple(r) for r in files.read_images(spark, f"{tmp_path}/*").collect())
    assert [(d, p.rsplit("/", 2)[1]) for d, p, _ in got if d != "top"] == [("x", "p"), ("x", "q"), ("y", "q")] and all(bytes(c) == b"x\xff" for _, _, c in got)
