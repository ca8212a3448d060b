from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lessonlake.operators import audits, quality
from lessonlake.plans import pipeline
from lessonlake.sources import files, sinks
from lessonlake.streaming import arrivals


def test_listings(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.pdf").write_bytes(b"abc")
    (tmp_path / "sub" / "b.pdf").write_bytes(b"d")
    (tmp_path / "c.txt").write_text("x")
    assert [r["name"] for r in files.list_pdfs(spark, str(tmp_path)).collect()] == ["a.pdf", "b.pdf"]
    assert [(r["name"], r["size"]) for r in files.list_pdfs(spark, str(tmp_path), recursive=False).collect()] == [("a.pdf", 3)]
    assert files.list_pdfs(spark, str(tmp_path / "none")).count() == 0
    assert len(files.file_digests(spark, str(tmp_path)).first()["sha256"]) == 64
    (tmp_path / "list.json").write_text(json.dumps([{"Name": "a.pdf", "Size": 3, "IsDir": False}, {"Path": "z.pdf"}]))
    assert {r["name"] for r in audits.remote_listing(files.remote_listing(spark, str(tmp_path / "list.json"))).collect()} == {"a.pdf", "z.pdf"}


def test_texts_json_waivers_logs(spark, tmp_path):
    (tmp_path / "p1.txt").write_text("uno\ndos", encoding="utf-8")
    assert [tuple(r)[::2] for r in files.texts(spark, str(tmp_path)).collect()] == [("p1", "uno\ndos")]
    (tmp_path / "w.json").write_text(json.dumps({"waivers": [{"publication_id": "p", "pdf_page": 3, "issue_code": "zero_text"}]}))
    assert files.waivers(spark, str(tmp_path / "w.json")).first()["pdf_page"] == 3
    assert files.waivers(spark, str(tmp_path / "no.json")).count() == 0
    (tmp_path / "log.json").write_text(json.dumps({"source_pdf": "in/p.pdf", "pages": [{"pdf_page": 1, "word_count": 0, "quality_status": "NEEDS_OCR", "quality_issues": ["zero_text"]}, {"pdf_page": 2, "word_count": 40, "quality_status": "PASS"}]}))
    pages = files.logged_pages(files.json_documents(spark, str(tmp_path / "log.json"), files.PAGE_LOG))
    assert {r["publication_id"] for r in pages.collect()} == {"p"}
    assert quality.publication_report(pages, files.waivers(spark, str(tmp_path / "no.json"))).first()["status"] == "BLOCKED"


def test_yaml_round_trip(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    df = spark.createDataFrame([("a/x.yaml", "Título", ["uno", "dos"])], "path string, title string, items array<string>")
    sinks.write_yaml(df, str(tmp_path))
    assert yaml.safe_load((tmp_path / "a/x.yaml").read_text()) == {"title": "Título", "items": ["uno", "dos"]}
    (tmp_path / "b.yaml").write_text("# nothing\n")
    got = {r["title"] for r in files.yaml_documents(spark, str(tmp_path), "title string, items array<string>").select("document.*").collect()}
    assert got == {"Título", None}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x-maestro", 1), ("y-alumno", 2)], "publication_id string, n int")
    sinks.write_once(df, str(tmp_path / "once"))
    with pytest.raises(AnalysisException):
        sinks.write_once(df, str(tmp_path / "once"))
    sinks.write_classified(df, str(tmp_path / "fam"))
    assert {p.name for p in (tmp_path / "fam").glob("classification=*")} == {"classification=maestro", "classification=alumno"}
    assert sinks.markdown("T", df.orderBy("n")).splitlines()[4] == "| x-maestro | 1 |"
    assert sinks.epoch_timestamp(0) == "1970-01-01T00:00:00+00:00"


def test_pipeline_steps(spark, tmp_path):
    ok = pipeline.Step("ok", lambda s, t: s.range(3), ("a",))
    bad = pipeline.Step("bad", lambda s, t: t["none"], ("b",), optional=True)
    fatal = pipeline.Step("fatal", lambda s, t: t["none"])
    last = pipeline.Step("indexing", lambda s, t: s.range(1))
    tables, log = pipeline.run_steps(spark, pipeline.select_steps([ok, bad, fatal, ok, last]), {}, str(tmp_path))
    assert [s["returncode"] for s in log.steps] == [0, 1, 1] and tables["ok"].count() == 3 and json.loads(log.to_json())["steps"]
    assert [s.name for s in pipeline.select_steps([ok, bad, last], run=["a", "b"], skip=["b"])] == ["ok"]


def test_default_pipeline(spark, tmp_path):
    pages = spark.createDataFrame([(1, "p-maestro", 1, "embedded", "CONTENIDO\n1. La fe 2", None), (2, "p-maestro", 2, "embedded", "LECCIÓN 1\nLectura Bíblica: Juan 3:16\nNotas para el maestro: ore", None)], "page_id bigint, publication_id string, page_number int, source string, text string, ocr_confidence double")
    tables, log = pipeline.run_steps(spark, pipeline.select_steps(pipeline.default_steps()), {"pages": pages, "waivers": spark.createDataFrame([], files.WAIVERS), "books": spark.createDataFrame([("Juan", "new", "John")], "book_name string, testament string, book_standardized string")}, str(tmp_path))
    assert all(s["returncode"] == 0 for s in log.steps), log.steps
    assert tables["segments"].first()["expected_title"] == "La fe"
    draft = tables["drafts"].first()
    assert draft["lesson_sections"]["teacher_notes"]["items"] == ["ore"] and draft["lesson_sections"]["biblical_reading"]["canonical_references"][0]["book_standardized"] == "John"
    assert draft["path"] == "p-maestro/2024/C1/LES-2024-C1-001.yaml" and tables["validation"].first()["error"] == "placeholder value"
    assert {r["section"] for r in tables["missing"].collect()} == {"lesson_outline", "summary_application"} and tables["audit"].first()["total_missing"] == 2
    every, log = pipeline.run_steps(spark, pipeline.default_steps()[-4:], tables, str(tmp_path / "index"))
    assert all(s["returncode"] == 0 for s in log.steps) and every["lessons_index"].count() == 1
    assert json.loads(pipeline.write_log(log, str(tmp_path / "runs")).read_text())["steps"]


def test_arriving_pages(spark, tmp_path):
    rows = [(1, "p", 1, "embedded", "uno " * 30, None), (2, "p", 2, "embedded", "", None)]
    df = spark.createDataFrame(rows, "page_id bigint, publication_id string, page_number int, source string, text string, ocr_confidence double").withColumn("extracted_at", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = arrivals.gate_stream(arrivals.arriving_pages(spark, str(tmp_path / "in")))
    for _ in range(2):  # the second run finds nothing new
        arrivals.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r["page_id"]: r["status"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "PASS", 2: "NEEDS_OCR"}
    counted = arrivals.status_windows(stream)
    q = counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["status"], r["n_pages"]) for r in spark.sql("select * from counted").collect()} == {("PASS", 1), ("NEEDS_OCR", 1)}


def test_steps_from_a_file(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"steps": [{"name": "report", "optional": True}, {"name": "gate", "tags": ["x"]}]}))
    got = pipeline.load_steps(str(tmp_path / "s.json"))
    assert [(s.name, s.tags, s.optional) for s in got] == [("report", ("quality",), True), ("gate", ("x",), False)]
    for bad in ({"steps": {}}, [], {"steps": [{"name": "none"}]}):
        (tmp_path / "b.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            pipeline.load_steps(str(tmp_path / "b.json"))


def test_profiles_from_files(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "maestro.yaml").write_text("profile_id: maestro\nprofile_version: '2.0'\nexpected_sections: [lesson_outline]\nsection_aliases:\n  lesson_outline: [bosquejo]\n")
    got = files.profiles(spark, str(tmp_path), known=("maestro",))
    assert got["maestro"] == {"version": "2.0", "sections": {"lesson_outline": ["bosquejo"]}} and got["unclassified"]["sections"] == {}
    with pytest.raises(FileNotFoundError, match="alumno"):
        files.profiles(spark, str(tmp_path), known=("maestro", "alumno"))


def test_waivers_must_be_a_list(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"waivers": {"publication_id": "p"}}))
    with pytest.raises(Exception, match="must be a list"):
        files.waivers(spark, str(tmp_path / "w.json")).collect()
    (tmp_path / "e.json").write_text(json.dumps({}))
    assert files.waivers(spark, str(tmp_path / "e.json")).count() == 0


def test_reports_and_logs_are_whole(spark, tmp_path):
    with pytest.raises(ValueError, match="no report"):
        sinks.markdown("T", spark.range(11), most=10)
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "publication_id string, n int")
    sinks.write_once(df, str(tmp_path / "raw"), log=df)
    assert spark.read.json(str(tmp_path / "raw-log")).count() == 3
    sinks.write_json_by(df, str(tmp_path / "by"))
    assert {p.name for p in (tmp_path / "by").glob("publication_id=*")} == {"publication_id=a", "publication_id=b"}


STUBS = {
    "fitz": "class Page:\n    def __init__(self, t): self.t = t\n    def get_text(self, kind): return self.t\n    def get_pixmap(self, dpi):\n        import types\n        return types.SimpleNamespace(tobytes=lambda k: self.t.encode())\n"
    "class Doc(list):\n    metadata = {'title': 'Guía'}\n    def __enter__(self): return self\n    def __exit__(self, *a): pass\ndef open(stream, filetype): return Doc(map(Page, bytes(stream).decode().split(chr(12))))\n",
    "pytesseract": "class Output: DICT = 1\ndef image_to_data(image, lang, output_type): return {'conf': ['-1', '80', '90']}\ndef image_to_string(image, lang): return image.upper()\n",
}


def test_pdf_pages_with_stand_ins(spark, tmp_path, monkeypatch):
    """The adapter's own logic, with stand-ins for the libraries that are not installed here."""
    lib, pil = tmp_path / "lib", tmp_path / "lib" / "PIL"
    pil.mkdir(parents=True)
    for name, code in STUBS.items():
        (lib / f"{name}.py").write_text(code)
    (pil / "__init__.py").write_text("")
    (pil / "Image.py").write_text("def open(b): return b.read().decode()\n")
    monkeypatch.syspath_prepend(str(lib))
    archive = __import__("shutil").make_archive(str(tmp_path / "stubs"), "zip", lib)
    spark.sparkContext.addPyFile(archive)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.pdf").write_bytes("uno\x0cdos\x0ctres".encode())
    rows = files.pdf_pages(spark, str(tmp_path / "in"), page_limit=2, language="spa")
    assert [tuple(r) for r in rows.orderBy("page_number").collect()] == [("p", "Guía", 1, "uno", "UNO", 85.0), ("p", "Guía", 2, "dos", "DOS", 85.0)]
    embedded, ocr = map(quality.gate, files.extractions(rows))
    assert {r["source"] for r in quality.best_source(embedded, ocr).collect()} <= {"embedded", "ocr", "none"}
    assert files.pdf_pages(spark, str(tmp_path / "in")).where("ocr_text is null").count() == 3
