from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lessonlake.operators import quality

PAGE = "page_id bigint, publication_id string, page_number int, source string, text string, ocr_confidence double"
CLEAN = "La lección de hoy invita a toda la familia a leer con calma\nel pasaje de Juan 3:16 y a conversar sobre la gracia que cada persona recibe,\npues la palabra enseña paciencia y amor."


def gate(spark, rows):
    df = spark.createDataFrame([(i, "p", i, s, t, c) for i, (s, t, c) in enumerate(rows, 1)], PAGE)
    return {r["page_id"]: r for r in quality.gate(df).collect()}


def test_empty_pages(spark):
    r = gate(spark, [("embedded", "", None), ("ocr", None, 40.0), ("embedded", "  \n ", None)])
    assert (r[1]["gate_status"], r[1]["ocr_needed"]) == ("NEEDS_OCR", True) and "zero_text" in r[1]["gate_issues"]
    assert r[2]["gate_status"] == "NEEDS_HUMAN_REVIEW" and {"zero_text", "low_ocr_confidence"} <= set(r[2]["gate_issues"])
    assert r[3]["gate_status"] == "NEEDS_OCR" and r[3]["n_chars"] == 0


def test_prose_passes_with_full_score(spark):
    r = gate(spark, [("embedded", CLEAN, None)])[1]
    assert (r["gate_status"], r["gate_score"], r["selected_source"]) == ("PASS", 100, "embedded")
    assert r["n_valid"] / r["n_chars"] >= 0.99


def test_short_text_warns(spark):
    r = gate(spark, [("embedded", "Una línea de más o menos once palabras para probar la puerta.", None)])[1]
    assert (r["gate_status"], r["ocr_needed"]) == ("WARNING", False) and r["gate_issues"] == ["low_word_count"]


@pytest.mark.parametrize("citation", ["Juan 3 16", "Romanos 8.28", "1 Corintios 13;4", "Éxodo 3:l4"])
def test_malformed_citations(spark, citation):
    r = gate(spark, [("embedded", CLEAN + " " + citation, None)])[1]
    assert r["n_malformed"] == 1 and r["gate_status"] == "WARNING"


def test_three_malformed_citations_go_to_review(spark):
    r = gate(spark, [("embedded", CLEAN + " Juan 3 16, Romanos 8.28 y Lucas 4;5.", None)])[1]
    assert r["gate_status"] == "NEEDS_HUMAN_REVIEW"


def test_confidence_and_replacement_characters(spark):
    r = gate(spark, [("ocr", CLEAN, 60.0), ("ocr", CLEAN, 80.0), ("ocr", CLEAN, 91.0), ("embedded", CLEAN + "�" * 5, None)])
    assert [r[i]["gate_status"] for i in (1, 2, 3, 4)] == ["NEEDS_HUMAN_REVIEW", "WARNING", "PASS", "NEEDS_OCR"]
    assert r[3]["gate_score"] == 91


def test_merged_lines(spark):
    long = "palabra " * 30
    r = gate(spark, [("embedded", long, None), ("ocr", long, None)])
    assert r[1]["gate_status"] == "NEEDS_OCR" and r[2]["gate_status"] == "WARNING"


def test_repeated_edges_flag_all_pages(spark):
    rows = [("embedded", f"Expositor de la clase\n{CLEAN}\nPie de página {i}", None) for i in (1, 2, 3)]
    df = spark.createDataFrame([(i, "p", i, *x) for i, x in enumerate(rows, 1)], PAGE)
    out = quality.gate_with_edges(quality.gate(df)).collect()
    assert all(r["gate_status"] == "WARNING" and r["gate_score"] == 90 and "repeated_header_footer" in r["gate_issues"] for r in out)
    assert {r["text"] for r in out} == {x[1] for x in rows}


def test_best_source(spark):
    def one(a, b):
        x = [quality.gate(spark.createDataFrame([(1, "p", 1, *r)], PAGE)) for r in (a, b)]
        return quality.best_source(*x).first()

    assert one(("embedded", "", None), ("ocr", CLEAN, 91.0))["source"] == "ocr"
    assert one(("embedded", CLEAN, None), ("ocr", CLEAN, 96.0))["source"] == "embedded"
    none = one(("embedded", "", None), ("ocr", "", 30.0))
    assert (none["source"], none["status"]) == ("none", "NEEDS_HUMAN_REVIEW")


def test_report_and_waivers(spark):
    df = quality.gate(spark.createDataFrame([(1, "a", 1, "embedded", CLEAN, None), (2, "a", 2, "embedded", "", None), (3, "b", 1, "embedded", CLEAN, None)], PAGE))
    w = spark.createDataFrame([("a", 2, "zero_text")], "publication_id string, pdf_page int, issue_code string")
    r = {x["publication_id"]: x for x in quality.publication_report(df, w).collect()}
    assert (r["a"]["status"], r["a"]["n_waived_zero_text"], r["b"]["status"]) == ("BLOCKED", 1, "PASS")
    assert {x["publication_id"]: x["status"] for x in quality.publication_report(df, w, waive_review=True).collect()}["a"] == "PASS"


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], PAGE).withColumn("extra", F.lit(1))
    assert quality.gate(df).count() == 0 and "extra" in quality.gate(df).columns
    assert quality.publication_report(quality.gate(df), spark.createDataFrame([], "publication_id string, pdf_page int, issue_code string")).count() == 0


def test_scores_stay_in_range_whatever_the_partitions(spark):
    rows = [(i, "p", i % 5, "ocr" if i % 2 else "embedded", CLEAN[: i * 3] + "�" * (i % 7), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, PAGE)
    a = {r["page_id"]: (r["gate_status"], r["gate_score"]) for r in quality.gate(df.repartition(7)).collect()}
    b = {r["page_id"]: (r["gate_status"], r["gate_score"]) for r in quality.gate(df.coalesce(1)).collect()}
    assert a == b and all(0 <= s <= 100 for _, s in a.values())


def test_extraction_summary(spark):
    df = quality.gate(spark.createDataFrame([(1, "a", 1, "embedded", CLEAN, None), (2, "a", 2, "embedded", "", None), (3, "a", 3, "ocr", "", 20.0), (4, "b", 1, "ocr", CLEAN, 95.0)], PAGE))
    r = {x["publication_id"]: x for x in quality.extraction_summary(df).collect()}
    assert (r["a"]["weak_direct_text_pages"], r["a"]["ocr_fallback_pages"], r["a"]["human_review_pages"], r["a"]["manual_review_required"]) == ("2", "3", "3", True)
    assert (r["b"]["ocr_fallback_page_count"], r["b"]["manual_review_required"]) == (1, False)
    w = spark.createDataFrame([], "publication_id string, pdf_page int, issue_code string")
    o = {x["source"]: (x["status"], x["page_count"], x["issue_counts"]) for x in quality.ocr_reports(df, w).collect()}
    assert o["b"] == ("PASS", 1, "") and o["a"][:2] == ("BLOCKED", 3) and "zero_text=2" in o["a"][2]
