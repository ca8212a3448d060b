"""The pN_ queries: each takes (spark, directory of tables) and applies an operator to its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boilerplate, canonical_names, encoding, lookalikes, mixing, packing, page_kinds, scan_noise, shared_spans
from .base import cut, table
from .tokens import token_counts


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """What words and characters are counted over: page texts and lesson titles."""
    return table(spark, d, "page_quality").select("text").unionAll(table(spark, d, "lesson_segments").select(F.col("expected_title").alias("text")))


def _bigrams(spark: SparkSession, d: str) -> dict[str, int]:
    return lookalikes.bigram_counts(_texts(spark, d))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical_names.found(table(spark, d, "biblical_readings"), table(spark, d, "bible_books"))


def p1_resolved(spark: SparkSession, d: str) -> DataFrame:
    return canonical_names.resolved(table(spark, d, "biblical_readings"), table(spark, d, "bible_books"))


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return canonical_names.unmatched(table(spark, d, "biblical_readings"), table(spark, d, "bible_books"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page_quality")
    bigrams = _bigrams(spark, d)
    return boilerplate.found(pages, boilerplate.excess_keys(pages, bigrams), bigrams)


def p2_clean_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page_quality")
    bigrams = _bigrams(spark, d)
    return boilerplate.clean(pages, boilerplate.excess_keys(pages, bigrams), bigrams)


def _p3(spark: SparkSession, d: str) -> tuple:
    pages = table(spark, d, "page_quality")
    titles = table(spark, d, "lesson_segments").select("publication_id", F.col("expected_title").alias("title"), F.col("page_start").alias("first"), F.col("page_end").alias("last"))
    bigrams, words, compounds = scan_noise.count_words(_texts(spark, d))
    counts, vectors = scan_noise.count_lines_and_pairs(pages, bigrams, words)
    return pages, boilerplate.excess_keys(pages, bigrams, counts=counts), titles, (words, compounds, vectors), bigrams


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.found(*_p3(spark, d))


def p3_repaired_pages(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.repaired(*_p3(spark, d))


def p4_page_kinds(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page_quality")
    return page_kinds.classify(pages, page_kinds.fit(pages, table(spark, d, "page_labels")))


def p4_figures(spark: SparkSession, d: str) -> DataFrame:
    return page_kinds.statistics(table(spark, d, "page_quality"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_page_kinds(spark, d).where("page_kind <> 'prose'").select("page_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.affected(table(spark, d, "page_quality"), _bigrams(spark, d)).select("page_id")


def p5_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.repair(table(spark, d, "page_quality"), _bigrams(spark, d))


def _p6(spark: SparkSession, d: str, with_text: bool) -> DataFrame:
    bigrams = _bigrams(spark, d)
    titles = lookalikes.normalize(table(spark, d, "lesson_segments"), bigrams, "segment_id", "expected_title", "lesson_segments", with_text)
    return titles.unionAll(lookalikes.normalize(table(spark, d, "page_quality"), bigrams, "page_id", "text", "page_quality", with_text))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _p6(spark, d, False).select("table_name", "record_id")


def p6_normalized(spark: SparkSession, d: str) -> DataFrame:
    return _p6(spark, d, True)


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    capacities = [(r["capacity_id"], r["capacity_tokens"]) for r in table(spark, d, "pack_capacity").collect()]
    sizes = cut(token_counts(table(spark, d, "documents")))
    return packing.pack(sizes, capacities), sizes


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[0]


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(_packed(spark, d)[0], table(spark, d, "pack_capacity"))


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    packed, sizes = _packed(spark, d)
    return packing.checks(cut(packed), sizes, table(spark, d, "pack_capacity"))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sizes = cut(token_counts(table(spark, d, "documents"), keep=("source",)))
    weights = table(spark, d, "source_weights")
    return mixing.mix(sizes, weights), sizes, weights


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    mixture, sizes, weights = _mixed(spark, d)
    return mixing.shares(cut(mixture), sizes, weights)


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    mixture, sizes, weights = _mixed(spark, d)
    return mixing.checks(cut(mixture), sizes, weights)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.found(table(spark, d, "documents"))


def p9_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.class_pairs(table(spark, d, "documents"))


def p9_spans(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.spans(table(spark, d, "documents"))


def p9_coverage(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.coverage(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_resolved, p1_unmatched, p2_found, p2_clean_pages, p3_found, p3_repaired_pages, p4_found, p4_page_kinds, p4_figures, p5_found, p5_restored, p6_found, p6_normalized, p7_packed, p7_fill, p7_checks, p8_mixture, p8_shares, p8_checks, p9_found, p9_class_pairs, p9_spans, p9_coverage)}
