from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lessonlake.operators import audits, documents, indexes, references


BOOKS = [("Éxodo", "old", "Exodus"), ("Salmos", "old", "Psalms"), ("Mateo", "new", "Matthew"), ("Lucas", "new", "Luke"), ("Juan", "new", "John"), ("1 Corintios", "new", "1 Corinthians")]


def parse(spark, display):
    df = spark.createDataFrame([(1, display)], "id int, reference_display string")
    books = spark.createDataFrame(BOOKS, "book_name string, testament string, book_standardized string")
    return [(r["book_standardized"], r["chapter"], r["verse_start"], r["verse_end"]) for r in references.parse(df, books, ["id"]).orderBy("ref_no").collect()]


def test_citations(spark):
    assert parse(spark, "Exodo 30:14-15; Mateo 17:24-27; 22:17, 19-21") == [("Exodus", 30, 14, 15), ("Matthew", 17, 24, 27), ("Matthew", 22, 17, 17), ("Matthew", 22, 19, 21)]
    assert parse(spark, "Salmo 3:1; SALMOS 4:2") == [("Psalms", 3, 1, 1), ("Psalms", 4, 2, 2)]
    assert parse(spark, "I Corintios 3:10-19") == [("1 Corinthians", 3, 10, 19)]


def test_unknown_book_drops_what_continues_it(spark):
    assert parse(spark, "Juan 1:1; Tobías 2:3; 4:5; Lucas 1:2") == [("John", 1, 1, 1), ("Luke", 1, 2, 2)]
    assert parse(spark, "3:4; Juan 1:1") == [("John", 1, 1, 1)]
    assert parse(spark, None) == parse(spark, " ; ") == []


def lessons(spark, display="Juan 3:16", n=3):
    seg = spark.createDataFrame([("x-maestro", i, i * 10, "Contenido", i * 10 + 9, i, i, f"Título {i}", i, None) for i in range(1, n + 1)], "publication_id string, lesson_number int, start_line int, marker string, end_line int, page_start int, page_end int, expected_title string, expected_page_start int, lesson_date string")
    ref = [("new", "John", 3, 16, 16)]
    reads = spark.createDataFrame([("x-maestro", i, display, ref) for i in range(1, n + 1)], f"publication_id string, lesson_number int, reference_display string, canonical_references array<{documents.REFERENCE}>")
    items = spark.createDataFrame([("x-maestro", 1, "lesson_outline", ["I. Uno", "(Juan 3:16)", " ", "A. Dos"]), ("x-maestro", 1, "teacher_notes", ["nota"]), ("x-maestro", 1, "summary_application", ["fin"])], "publication_id string, lesson_number int, section string, items array<string>")
    return seg, reads, items


def test_draft_and_index_items_keep_gaps(spark):
    d = documents.draft_lessons(*lessons(spark))
    got = [(r["item_id"], r["item_order"], r["kind"]) for r in indexes.item_table(d).where("section = 'lesson_outline' and lesson_number = 1").orderBy("item_order").collect()]
    assert got == [("LES-2024-C1-001-lesson-outline-001", 1, "roman_heading"), ("LES-2024-C1-001-lesson-outline-002", 2, "scripture_reference"), ("LES-2024-C1-001-lesson-outline-003", 3, "letter_subpoint")]
    assert indexes.section_outline_index(d).count() == 9 and indexes.compact_index(d).first()["profile_id"] == "maestro"


def test_timestamps_are_kept(spark):
    seg, reads, items = lessons(spark)
    old = spark.createDataFrame([("x-maestro", 1, "2024-05-05T00:00:00+00:00")], "publication_id string, lesson_number int, imported_at string")
    got = {r["lesson_number"]: r["source_integrity"]["imported_at"] for r in documents.draft_lessons(seg, reads, items, previous=old).collect()}
    assert got[1] == "2024-05-05T00:00:00+00:00" and got[2] == documents.PENDING
    assert documents.draft_lessons(seg, reads, items, previous=old, imported_at="2025-01-01").first()["source_integrity"]["imported_at"] == "2025-01-01"


def valid(spark):
    """A lesson without a placeholder."""
    d = documents.draft_lessons(*lessons(spark, n=1), imported_at="2025-01-01T00:00:00+00:00")
    for path, kind in documents.string_leaves(d.schema):
        root, _, rest = path.partition(".")
        if root in ("processing_audit", "source_integrity", "semantic_metadata") and rest:
            d = d.withColumn(root, F.col(root).withField(rest, F.array(F.lit("x")) if kind == "many" else F.lit("x")))
    return d.withColumn("lesson_sections", F.col("lesson_sections").withField("lesson_header.lesson_date", F.lit("03/mar/24")))


KEY = ["publication_id", "lesson_number"]


def error(df):
    return documents.first_error(df, KEY).first()["error"]


def test_validation(spark):
    d = valid(spark)
    assert error(d) is None and documents.all_valid(d, KEY)
    r = "biblical_reading"
    assert error(d.withColumn("lesson_sections", F.col("lesson_sections").withField(f"{r}.reference_display", F.lit("TBD")))) == "placeholder value"
    zero = F.transform(F.col(f"lesson_sections.{r}.canonical_references"), lambda x: x.withField("chapter", F.lit(0)))
    assert error(d.withColumn("lesson_sections", F.col("lesson_sections").withField(f"{r}.canonical_references", zero))) == "reading positive_integers"
    assert error(d.withColumn("processing_audit", F.col("processing_audit").withField("review_status", F.lit("automated_unreviewed")))) == "placeholder value"
    assert error(d.withColumn("title", F.lit(" "))) == "missing title"


def test_listing_sync_has_all_outcomes(spark):
    a = spark.createDataFrame([("a.pdf", 1), ("b.pdf", 2), ("c.pdf", 3)], "name string, size bigint")
    b = spark.createDataFrame([(0, "b.pdf", None, 2, False), (1, "c.pdf", None, 3, False), (2, "c.pdf", None, 9, False), (3, None, "d.PDF", None, False), (4, "dir", None, 0, True), (5, "x.txt", None, 1, None)], "position int, Name string, Path string, Size bigint, IsDir boolean")
    got = {r["name"]: r["outcome"] for r in audits.listing_sync(a, audits.remote_listing(b)).collect()}
    assert got == {"a.pdf": "missing_remote", "b.pdf": "match", "c.pdf": "size_mismatch", "d.PDF": "missing_local"}


def test_rename_proposals(spark):
    rows = [("a", "Expositor del Maestro Vol. 7"), ("b", "guía lecc12 maestro"), ("c", "volumen veinte"), ("d", "nada"), ("e", "expositor maestro volumen 07")]
    got = {r["stem"]: (r["target"], r["n_same_target"]) for r in audits.rename_proposals(spark.createDataFrame(rows, "stem string, reference_text string")).collect()}
    assert got["a"] == ("expositor-guia-maestro-volumen-07.pdf", 2) and got["b"][0].endswith("volumen-12.pdf") and got["c"][0].endswith("volumen-20.pdf") and got["d"][0] == "expositor-guia-maestro-d.pdf"


def test_missing_sections_and_ids(spark):
    seg = spark.createDataFrame([("p", 1, 1, 2)], "publication_id string, lesson_number int, page_start int, page_end int")
    have = spark.createDataFrame([("p", 1, "biblical_reading"), ("p", 1, "summary_application")], "publication_id string, lesson_number int, section string")
    t = audits.missing_totals(audits.missing_sections(have, seg)).first()
    assert (t["total_missing"], t["critical_missing"], t["has_critical"]) == (2, 2, True)
    ids = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), ("a", "xay")], "x string, y string")
    assert audits.id_mismatches(ids, "x", "y").count() == 3 and audits.id_mismatches(ids, "x", "y", contains=True).count() == 2


def test_reference_texts_take_the_first_pages_in_order(spark):
    stems = spark.createDataFrame([("a", "Título"), ("b", None)], "stem string, title string")
    pages = spark.createDataFrame([("a", 2, "volumen 7"), ("a", 1, "portada"), ("a", 6, "volumen 9"), ("a", 3, None)], "publication_id string, page_number int, text string")
    texts = audits.reference_texts(stems, pages)
    assert {r["stem"]: r["reference_text"] for r in texts.collect()} == {"a": "a\nTítulo\nportada\nvolumen 7\n", "b": "b"}
    reasons = {r["stem"]: r["reason"] for r in audits.rename_proposals(texts).collect()}
    assert reasons == {"a": "used default; volume 7 found", "b": "used default; volume number not found"}


def test_strings_are_found_at_any_depth(spark):
    df = spark.createDataFrame([(1, {"k": "TBD"}, [[("pending-x", ["ok", "TBD"])]], "x")], "id int, m map<string,string>, n array<array<struct<a:string,b:array<string>>>>, s string")
    assert sorted(documents.string_leaves(df.schema)) == [("m", "many"), ("n.a", "many"), ("n.b", "many"), ("s", "one")]
    assert sorted((r["path"], r["value"]) for r in documents.placeholders(df, ["id"]).collect()) == [("m", "TBD"), ("n.a", "pending-x"), ("n.b", "TBD")]


def test_digests_traces_and_paths(spark):
    seg, reads, items = lessons(spark)
    digests = spark.createDataFrame([("x-maestro", "ab" * 32)], "publication_id string, sha256 string")
    traces = spark.createDataFrame([("x-maestro", 1, "lesson_outline", 12, 15, 1, 2)], "publication_id string, lesson_number int, section string, line_start int, line_end int, page_start int, page_end int")
    d = documents.draft_lessons(seg, reads, items, digests=digests, traces=traces)
    assert {r["source_integrity"]["sha256"] for r in d.collect()} == {"ab" * 32}
    assert documents.draft_lessons(seg, reads, items).first()["source_integrity"]["sha256"] == documents.NO_FILE
    one = indexes.lessons_index(d).where("lesson_number = 1").first()
    assert one["lesson_outline"]["item_count"] == 3 and one["lesson_outline"]["items"][0]["source_trace_ref"] == "lesson_outline" and one["lesson_outline"]["source_trace"]["line_end"] == 15
    assert one["teacher_notes"]["source_trace"] is None and one["teacher_notes"]["items"][0]["source_trace_ref"] is None and one["replacement_strategy"] == "replace_by_canonical_reference"
    assert documents.with_paths(d).count() == 3
    with pytest.raises(ValueError, match="draft path"):
        documents.with_paths(d.unionByName(d))


def test_index_gate(spark, tmp_path):
    seg, reads, items = lessons(spark)
    d = documents.draft_lessons(seg, reads, items)
    assert tuple(documents.gate(d, KEY).first()) == (3, 3, False) and tuple(documents.gate(valid(spark), KEY).first()) == (1, 0, True)
    with pytest.raises(ValueError, match="invalid lesson"):
        indexes.write_views(d, str(tmp_path / "no"))
    assert not (tmp_path / "no").exists()
    indexes.write_views(d, str(tmp_path / "draft"), scope="automated_unreviewed_draft")
    indexes.write_views(valid(spark), str(tmp_path / "good"))
    assert spark.read.parquet(str(tmp_path / "good" / "detailed_lessons" / "all")).count() == 1
    assert (tmp_path / "draft" / "compact_lessons" / "by_family" / "classification=maestro").exists()


def test_audits_in_one_list(spark):
    paths = spark.createDataFrame([("maestro/a.txt",), ("b.txt",), ("c.txt",), ("extra/d.txt",), (None,)], "path string")
    got = [tuple(r) for r in audits.normalized_audit(paths).collect()]
    assert ("txt_file_count", "", 4) in got and ("by_family", "maestro", 1) in got and ("unknown_family", "extra", 1) in got
    assert [r[1] for r in got if r[0] == "warning" and "root" in r[1]] == ["text at the root level"]  # the first only
    d = documents.draft_lessons(*lessons(spark))
    y = {tuple(r) for r in audits.yaml_audit(d, d.limit(0)).collect()}
    assert {("draft_count", "", 3), ("canonical_count", "", 0), ("warning", "no reviewed lesson exists", 1), ("warning", "drafts remain unreviewed", 1), ("profile", "maestro", 3)} <= y
    x = {tuple(r) for r in audits.indexing_audit({"compact_lessons": indexes.compact_index(d)}, indexes.header(d, "compact_lessons", scope="automated_unreviewed_draft"), indexes.compact_index(d)).collect()}
    assert ("view", "compact_lessons", 3) in x and ("family_folder", "maestro", 1) in x and {r[1] for r in x if r[0] == "warning"} == {"section_outline is missing", "translation_alignment is missing"}
    ids = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None)], "x string, y string")
    assert [tuple(r) for r in audits.id_audit({"draft": (ids, "x", "y", False)}).collect()] == [("draft", "a", "b")]
    sizes = {r["part"]: (r["n"], r["bytes"]) for r in audits.output_sizes({"t": ids.select("x"), "u": spark.createDataFrame([("ñ",)], "x string")}).collect()}
    assert sizes == {"t": (3, 3), "u": (1, 2)}
