"""Lesson intervals and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def page_lines(markers: DataFrame) -> DataFrame:
    """(publication_id, page, line_number) of the last marker of each page."""
    page = F.regexp_extract("text", "PDF_PAGE\\s+(\\d+)", 1).try_cast("int")
    return markers.where("marker_type = 'page_marker'").groupBy("publication_id", page.alias("page")).agg(F.max("line_number").alias("line_number"))


def totals(lines: DataFrame, markers: DataFrame) -> DataFrame:
    n = lines.groupBy("publication_id").agg(F.max("line_number").alias("total_lines"))
    p = page_lines(markers).groupBy("publication_id").agg(F.max("page").alias("total_pages"))
    return n.join(p, "publication_id", "left")


def from_contents(contents: DataFrame, markers: DataFrame, lines: DataFrame) -> DataFrame:
    """One interval per contents row: it ends where the next begins; page numbers become line numbers."""
    order = Window.partitionBy("publication_id").orderBy("line_number")
    following = F.lead("page_start").over(order)
    x = contents.withColumn("following", following).join(totals(lines, markers), "publication_id", "left")
    x = x.withColumn("page_end", F.when(F.col("following").isNotNull(), F.greatest("page_start", F.col("following") - 1)).otherwise(F.col("total_pages")))
    pages = page_lines(markers)
    starts = pages.select("publication_id", F.col("page").alias("page_start"), F.col("line_number").alias("start_at"))
    ends = pages.select("publication_id", (F.col("page") - 1).alias("page_end"), F.col("line_number").alias("next_at"))
    return x.join(starts, ["publication_id", "page_start"], "left").join(ends, ["publication_id", "page_end"], "left").select(
        "publication_id",
        "lesson_number",
        F.coalesce("start_at", F.lit(0)).alias("start_line"),
        F.lit("Contenido").alias("marker"),
        F.when(F.col("next_at").isNotNull(), F.greatest(F.lit(0), F.col("next_at") - 1)).otherwise(F.col("total_lines")).alias("end_line"),
        "page_start",
        "page_end",
        F.col("title").alias("expected_title"),
        F.col("page_start").alias("expected_page_start"),
        "lesson_date",
    )


def from_headers(markers: DataFrame) -> DataFrame:
    """Fallback for publications without contents: number, start and marker of each lesson header."""
    number = F.regexp_extract("text", "(\\d+)", 1).try_cast("int")
    none = {"end_line": "int", "page_start": "int", "page_end": "int", "expected_title": "string", "expected_page_start": "int", "lesson_date": "string"}
    return markers.where("marker_type = 'lesson_header'").select("publication_id", number.alias("lesson_number"), F.col("line_number").alias("start_line"), F.col("text").alias("marker"), *[F.lit(None).cast(t).alias(n) for n, t in none.items()]).where("lesson_number is not null")


def segments(contents: DataFrame, markers: DataFrame, lines: DataFrame) -> DataFrame:
    rest = markers.join(contents.select("publication_id").distinct(), "publication_id", "left_anti")
    return from_contents(contents, markers, lines).unionByName(from_headers(rest))


def duplicates(rows: DataFrame, number: str = "lesson_number") -> DataFrame:
    return rows.where(F.col(number).isNotNull()).groupBy("publication_id", number).agg(F.count("*").alias("n")).where("n > 1")


def observed_headers(markers: DataFrame) -> DataFrame:
    """(publication_id, lesson_number, header_lines): where each lesson header stands."""
    return from_headers(markers).groupBy("publication_id", "lesson_number").agg(F.array_join(F.array_sort(F.collect_list("start_line")), ",").alias("header_lines"), F.count("*").alias("n"))


def messages(publications: DataFrame, contents: DataFrame, segments_: DataFrame, markers: DataFrame) -> DataFrame:
    """(publication_id, severity, code, lesson_numbers) for the seven checks."""

    def listed(rows: DataFrame, severity: str, code: str) -> DataFrame:
        return rows.groupBy("publication_id").agg(F.array_join(F.array_sort(F.collect_set("lesson_number")), ",").alias("lesson_numbers")).select("publication_id", F.lit(severity).alias("severity"), F.lit(code).alias("code"), "lesson_numbers")

    def bare(rows: DataFrame, severity: str, code: str) -> DataFrame:
        return rows.select("publication_id", F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.lit("").alias("lesson_numbers"))

    pubs = publications.select("publication_id").distinct()
    keys = ["publication_id", "lesson_number"]
    expected, observed = segments_.select(*keys).distinct(), observed_headers(markers).select(*keys, "n")
    out = bare(pubs.join(contents, "publication_id", "left_anti"), "warning", "CONTENT_INDEX_MISSING")
    for part in (
        listed(expected.join(observed, keys, "left_anti"), "warning", "LESSON_HEADERS_MISSING_FOR_CONTENT_INDEX"),
        listed(observed.join(expected, keys, "left_anti"), "warning", "UNEXPECTED_LESSON_HEADERS"),
        listed(observed.where("n > 1"), "warning", "DUPLICATE_OBSERVED_LESSON_HEADERS"),
        listed(duplicates(contents), "error", "DUPLICATE_CONTENT_INDEX_LESSON_NUMBERS"),
        listed(duplicates(segments_), "error", "DUPLICATE_SEGMENT_LESSON_NUMBERS"),
        bare(pubs.join(segments_, "publication_id", "left_anti"), "error", "NO_LESSON_SEGMENTS_CREATED"),
    ):
        out = out.unionByName(part)
    return out


def validation_status(publications: DataFrame, messages_: DataFrame) -> DataFrame:
    per = messages_.groupBy("publication_id").agg(F.count_if(F.col("severity") == "error").alias("n_errors"), F.count_if(F.col("severity") == "warning").alias("n_warnings"))
    x = publications.select("publication_id").distinct().join(per, "publication_id", "left").fillna(0, ["n_errors", "n_warnings"])
    return x.withColumn("status", F.when(F.col("n_errors") > 0, "error").when(F.col("n_warnings") > 0, "warning").otherwise("pass"))
