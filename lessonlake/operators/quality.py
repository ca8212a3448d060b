"""The page gate: metrics, issues, status, score, choice of source, repeated edges, reports.

All operators are DataFrame to DataFrame. Pages need publication_id, page_number, source, text and
ocr_confidence; extra columns pass through. A null text counts as an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import PENALTIES, Thresholds
from ..functions import text as T

USABLE = ("PASS", "WARNING")


def metrics(pages: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Adds the counts the gate decides on."""
    t = T.strip(F.coalesce("text", F.lit("")))
    return (
        pages.withColumn("stripped", t)
        .withColumn("words", T.word_count(F.col("stripped")))
        .withColumn("n_chars", F.length("stripped"))
        .withColumn("n_valid", T.valid_chars(F.col("stripped")))
        .withColumn("filled", T.filled_lines(F.col("stripped")))
        .withColumn("n_lines", F.size("filled"))
        .withColumn("n_long", F.size(F.filter("filled", lambda x: F.length(x) > limits.long_line)))
        .withColumn("n_replacement", T.replacement_chars(F.col("stripped")))
        .withColumn("n_malformed", T.malformed_citations(F.col("stripped")))
        .drop("filled")
    )


def is_ocr() -> Column:
    return ~F.lower("source").isin("pymupdf", "embedded")


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def issues(limits: Thresholds = Thresholds()) -> Column:
    """The issue codes in their fixed order."""
    low = F.col("ocr_confidence") < limits.confidence_warning
    tests = {
        "zero_text": F.col("n_chars") == 0,
        "low_word_count": F.col("words") < limits.pass_words,
        "low_valid_char_ratio": (F.col("n_chars") > 0) & (_ratio("n_valid", "n_chars") < limits.valid_ratio),
        "malformed_characters": F.col("n_replacement") >= 1,
        "merged_lines": _ratio("n_long", "n_lines") > limits.merged_warning,
        "malformed_scripture_reference": F.col("n_malformed") > 0,
        "low_ocr_confidence": F.coalesce(low, F.lit(False)),
    }
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in tests.items()]))


def status(limits: Thresholds = Thresholds()) -> Column:
    """First rule that holds."""
    unreadable = F.when(is_ocr(), "NEEDS_HUMAN_REVIEW").otherwise("NEEDS_OCR")
    return (
        F.when((F.col("n_chars") == 0) | (F.col("words") < limits.ocr_words), unreadable)
        .when((_ratio("n_valid", "n_chars") < limits.valid_ratio) | (F.col("n_replacement") >= limits.replacement_fail), unreadable)
        .when(~is_ocr() & (_ratio("n_long", "n_lines") > limits.merged_ocr), "NEEDS_OCR")
        .when(F.col("n_malformed") >= limits.malformed_review, "NEEDS_HUMAN_REVIEW")
        .when(is_ocr() & (F.col("ocr_confidence") < limits.confidence_warning), "NEEDS_HUMAN_REVIEW")
        .when(is_ocr() & (F.col("ocr_confidence") < limits.confidence_pass), "WARNING")
        .when((F.col("words") < limits.pass_words) | (_ratio("n_long", "n_lines") > limits.merged_warning) | (F.col("n_malformed") > 0) | (F.col("n_replacement") > 0), "WARNING")
        .otherwise("PASS")
    )


def score(issue_list: Column, status_: Column) -> Column:
    """100 or the OCR confidence, less each issue's penalty, capped by status."""
    base = F.coalesce(F.bround("ocr_confidence").cast("int"), F.lit(100))
    for name, n in PENALTIES.items():
        base = base - F.when(F.array_contains(issue_list, name), n).otherwise(0)
    cap = F.when(status_ == "NEEDS_OCR", 49).when(status_ == "NEEDS_HUMAN_REVIEW", 59).when(status_ == "WARNING", 89).otherwise(100)
    return F.greatest(F.lit(0), F.least(F.lit(100), base, cap)).cast("int")


def gate(pages: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Every page with gate_issues, gate_status, gate_score and ocr_needed, from its text alone."""
    out = metrics(pages, limits).withColumn("gate_issues", issues(limits)).withColumn("gate_status", status(limits))
    return out.withColumn("gate_score", score(F.col("gate_issues"), F.col("gate_status"))).withColumn("ocr_needed", F.col("gate_status") == "NEEDS_OCR").withColumn("selected_source", F.when(F.col("gate_status").isin(*USABLE), F.col("source")))


def best_source(embedded: DataFrame, ocr: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """One row per (publication_id, page_number) of `embedded`: which extraction to keep."""
    keys = ["publication_id", "page_number"]
    cols = ["source", "gate_status", "gate_score", "gate_issues", "words", "n_malformed"]
    a = embedded.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols])
    b = ocr.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols])
    ok_a, ok_b = F.col("a_gate_status").isin(*USABLE), F.coalesce(F.col("b_gate_status").isin(*USABLE), F.lit(False))
    alone = F.col("b_source").isNull()
    take_b = ok_b & (~ok_a | (F.col("b_gate_score") - F.col("a_gate_score") > limits.tie_margin))
    pick = F.when(alone | (ok_a & ~take_b), "a").when(take_b, "b").otherwise("none")

    def chosen(name: str, none: Column) -> Column:
        return F.when(F.col("pick") == "a", F.col(f"a_{name}")).when(F.col("pick") == "b", F.col(f"b_{name}")).otherwise(none)

    both = a.join(b, keys, "left").withColumn("pick", pick)
    return both.select(
        *keys,
        chosen("source", F.lit("none")).alias("source"),
        chosen("gate_status", F.lit("NEEDS_HUMAN_REVIEW")).alias("status"),
        chosen("gate_score", F.greatest("a_gate_score", "b_gate_score")).alias("score"),
        chosen("words", F.greatest("a_words", "b_words")).alias("words"),
        F.array_join(chosen("gate_issues", F.array_distinct(F.concat("a_gate_issues", "b_gate_issues"))), ",").alias("issues"),
    )


def edge_keys(pages: DataFrame, n: int = 3) -> DataFrame:
    """(publication_id, page_number, page_id, key): the comparable first and last lines of each page."""
    keys = F.filter(F.transform(T.edge_lines(F.col("text"), n), T.edge_key), lambda x: x.isNotNull())
    return pages.where("text is not null").select("publication_id", "page_number", "page_id", F.explode_outer(F.array_distinct(keys)).alias("key")).where("key is not null")


def repeated(keys: DataFrame, least: int = 3) -> DataFrame:
    """(publication_id, key, n_pages) of edge keys on at least `least` page numbers."""
    return keys.groupBy("publication_id", "key").agg(F.count_distinct("page_number").alias("n_pages")).where(F.col("n_pages") >= least)


def repeated_edges(pages: DataFrame, least: int = 3, n: int = 3) -> DataFrame:
    return repeated(edge_keys(pages, n), least)


def gate_with_edges(gated: DataFrame, least: int = 3, n: int = 3, keys: DataFrame | None = None) -> DataFrame:
    """The gate with repeated edges: adds the issue, lowers PASS to WARNING and takes 10 off the score.

    keys: the pages' `edge_keys` as a table, so that texts are read for them once.
    """
    keys = edge_keys(gated, n) if keys is None else keys
    hit = keys.join(repeated(keys, least), ["publication_id", "key"], "left_semi").select("page_id").distinct()
    marked = gated.join(hit.withColumn("repeated", F.lit(True)), "page_id", "left").withColumn("repeated", F.coalesce("repeated", F.lit(False)))
    return (
        marked.withColumn("gate_issues", F.when(F.col("repeated"), F.array_distinct(F.concat("gate_issues", F.array(F.lit("repeated_header_footer"))))).otherwise(F.col("gate_issues")))
        .withColumn("gate_score", F.when(F.col("repeated"), F.greatest(F.lit(0), F.col("gate_score") - 10)).otherwise(F.col("gate_score")))
        .withColumn("gate_status", F.when(F.col("repeated") & (F.col("gate_status") == "PASS"), "WARNING").otherwise(F.col("gate_status")))
    )


def issue_counts(gated: DataFrame) -> DataFrame:
    return gated.select("publication_id", F.explode("gate_issues").alias("issue")).groupBy("publication_id", "issue").agg(F.count("*").alias("n"))


def status_counts(pages: DataFrame, column: str = "gate_status") -> DataFrame:
    """Pages by status; a null or blank status is UNKNOWN."""
    s = F.coalesce(F.when(T.strip(F.col(column)) != "", F.col(column)), F.lit("UNKNOWN"))
    return pages.select("publication_id", s.alias("status")).groupBy("publication_id", "status").agg(F.count("*").alias("n"))


def waived(pages_issues: DataFrame, waivers: DataFrame) -> DataFrame:
    """Rows (publication_id, page_number, issue) that have a waiver."""
    w = waivers.select("publication_id", F.col("pdf_page").alias("page_number"), F.col("issue_code").alias("issue")).distinct()
    return pages_issues.join(w, ["publication_id", "page_number", "issue"], "left_semi")


def unwaived(pages_issues: DataFrame, waivers: DataFrame) -> DataFrame:
    w = waivers.select("publication_id", F.col("pdf_page").alias("page_number"), F.col("issue_code").alias("issue")).distinct()
    return pages_issues.join(w, ["publication_id", "page_number", "issue"], "left_anti")


def _pages_where(c: Column) -> Column:
    """Sorted page numbers as text; bounded by a publication's pages."""
    return F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("page_number")))), ",")


def publication_report(gated: DataFrame, waivers: DataFrame, waive_review: bool = False) -> DataFrame:
    """One row per publication: status, counts and page lists.

    A page without text blocks unless it is waived; a page that needs OCR or review always blocks, so a
    waiver cannot unblock a page the gate sends to review, unless waive_review lets waived zero-text pages pass.
    """
    w = waivers.where("issue_code = 'zero_text'").select("publication_id", F.col("pdf_page").alias("page_number")).distinct().withColumn("is_waived", F.lit(True))
    p = gated.join(w, ["publication_id", "page_number"], "left").withColumn("is_waived", F.coalesce("is_waived", F.lit(False)))
    zero = F.col("words") == 0
    blocks = F.col("gate_status").isin("NEEDS_HUMAN_REVIEW", "NEEDS_OCR")
    if waive_review:
        blocks = blocks & ~(zero & F.col("is_waived"))
    status_ = F.when(F.bool_or(blocks | (zero & ~F.col("is_waived"))), "BLOCKED").when(F.bool_or(F.col("gate_status") == "WARNING"), "WARNING").otherwise("PASS")
    return p.groupBy("publication_id").agg(
        F.count("*").alias("page_count"),
        status_.alias("status"),
        F.count_if(F.col("gate_status") == "PASS").alias("n_pass"),
        F.count_if(F.col("gate_status") == "WARNING").alias("n_warning"),
        F.count_if(F.col("gate_status") == "NEEDS_OCR").alias("n_needs_ocr"),
        F.count_if(F.col("gate_status") == "NEEDS_HUMAN_REVIEW").alias("n_review"),
        F.count_if(zero).alias("n_zero_text"),
        F.count_if(zero & F.col("is_waived")).alias("n_waived_zero_text"),
        _pages_where(zero).alias("zero_text_pages"),
        _pages_where((F.col("words") > 0) & (F.col("words") < 25)).alias("low_word_pages"),
        _pages_where(F.col("gate_status") == "NEEDS_OCR").alias("needs_ocr_pages"),
        _pages_where(F.col("gate_status") == "NEEDS_HUMAN_REVIEW").alias("review_pages"),
        _pages_where(is_ocr()).alias("ocr_pages"),
    )


def extraction_summary(gated: DataFrame) -> DataFrame:
    """Per publication: pages whose embedded text was weak, OCR was used for or people must look at, and whether they must at all."""
    weak, review = ~is_ocr() & (F.col("gate_status") == "NEEDS_OCR"), F.col("gate_status") == "NEEDS_HUMAN_REVIEW"
    used = is_ocr()
    return gated.groupBy("publication_id").agg(
        _pages_where(weak).alias("weak_direct_text_pages"),
        _pages_where(used).alias("ocr_fallback_pages"),
        F.count_distinct(F.when(used, F.col("page_number"))).alias("ocr_fallback_page_count"),
        _pages_where(review).alias("human_review_pages"),
        F.count_distinct(F.when(review, F.col("page_number"))).alias("human_review_page_count"),
        F.bool_or(weak | review).alias("manual_review_required"),
    )


def ocr_reports(gated: DataFrame, waivers: DataFrame) -> DataFrame:
    """(source, status, page_count, issue_counts) of each publication's report, the counts as `issue=n` in order."""
    counts = issue_counts(gated).groupBy("publication_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "issue", F.col("n").cast("string")))), ",").alias("issue_counts"))
    report = publication_report(gated, waivers).select("publication_id", "status", "page_count")
    return report.join(counts, "publication_id", "left").select(F.col("publication_id").alias("source"), "status", "page_count", F.coalesce("issue_counts", F.lit("")).alias("issue_counts"))


def page_log(gated: DataFrame, prefix: str = "") -> DataFrame:
    """The flat log entry of each page; ratios with four places, half to even."""
    return gated.select(
        "page_id",
        "publication_id",
        "page_number",
        F.col("gate_status").alias(f"{prefix}quality_status"),
        F.array_join("gate_issues", ",").alias(f"{prefix}quality_issues"),
        F.col("gate_score").alias(f"{prefix}confidence_score"),
        F.bround(_ratio("n_valid", "n_chars"), 4).alias(f"{prefix}valid_char_ratio"),
        F.bround(_ratio("n_long", "n_lines"), 4).alias(f"{prefix}long_line_ratio"),
        F.col("selected_source").alias(f"{prefix}selected_source"),
    )
