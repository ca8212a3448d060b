"""Index views over lesson documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import documents, sections

SECTIONS = ("lesson_outline", "teacher_notes", "summary_application")


def header(lessons: DataFrame, view: str, scope: str = "canonical_reviewed", source_archive: str | None = None) -> DataFrame:
    """One row: scope, view, the profiles in use and a warning unless the lessons are reviewed."""
    p = sections.profile_metadata(lessons).select(F.concat_ws(" ", "profile_id", "profile_version").alias("p")).agg(F.array_join(F.array_sort(F.collect_set("p")), ",").alias("profiles"))
    warning = None if scope == "canonical_reviewed" else "Index built from unreviewed lessons; not official."
    return p.select(F.lit("1.0.0").alias("schema_version"), F.lit(scope).alias("index_scope"), F.lit(view).alias("index_view"), "profiles", F.lit(source_archive).cast("string").alias("source_archive"), F.lit(warning).cast("string").alias("warning"))


def item_table(lessons: DataFrame) -> DataFrame:
    """Every section item: id, order (blank items leave gaps), kind and text."""
    parts = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(s.replace("_", "-")).alias("slug"), F.col(f"lesson_sections.{s}.items").alias("items")) for s in SECTIONS])
    x = lessons.select("publication_id", "lesson_id", "lesson_number", F.explode(parts).alias("p")).select("publication_id", "lesson_id", "lesson_number", "p.section", "p.slug", F.posexplode("p.items").alias("pos", "raw"))
    x = x.withColumn("text", T.strip(F.col("raw"))).where("text <> ''").withColumn("item_order", F.col("pos") + 1)
    return x.select("publication_id", "lesson_id", "lesson_number", "section", "item_order", F.format_string("%s-%s-%03d", "lesson_id", "slug", "item_order").alias("item_id"), T.item_kind(F.col("text")).alias("kind"), "text")


ITEM = "struct<item_id:string,order:int,kind:string,text:string,source_trace_ref:string>"


def indexed_sections(lessons: DataFrame) -> DataFrame:
    """Per lesson and section (of all three): item_count, its items in order and its source trace, null where there is none."""
    key = ["publication_id", "lesson_number"]
    parts = F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"source_trace.section_traces.{s}").alias("source_trace")) for s in SECTIONS])
    every = lessons.select(*key, "lesson_id", F.explode(parts).alias("p")).select(*key, "lesson_id", "p.*")
    item = F.struct(F.col("item_order").alias("order"), "item_id", "kind", "text")
    lists = item_table(lessons).groupBy(*key, "section").agg(F.array_sort(F.collect_list(item)).alias("x"))
    ref = F.when(F.col("source_trace").isNotNull(), F.col("section"))
    items = F.transform(F.coalesce("x", F.array().cast("array<struct<order:int,item_id:string,kind:string,text:string>>")), lambda i: F.struct(i["item_id"].alias("item_id"), i["order"].alias("order"), i["kind"].alias("kind"), i["text"].alias("text"), ref.alias("source_trace_ref")))
    return every.join(lists, [*key, "section"], "left").withColumn("items", items).select(*key, "lesson_id", "section", F.size("items").alias("item_count"), "items", "source_trace")


def lessons_index(lessons: DataFrame) -> DataFrame:
    """The detailed view: lesson, reading, profile and each section with its items and trace."""
    key = ["publication_id", "lesson_number"]
    wide = indexed_sections(lessons).groupBy(*key).pivot("section", list(SECTIONS)).agg(F.first(F.struct("item_count", "items", "source_trace")))
    strategy = lessons.select(*key, F.col("lesson_sections.biblical_reading.replacement_policy.strategy").alias("replacement_strategy"))
    return compact_index(lessons).join(strategy, key).join(wide, key)


def compact_index(lessons: DataFrame) -> DataFrame:
    """Lessons without section text."""
    r = "lesson_sections.biblical_reading"
    x = lessons.select("publication_id", "lesson_number", "lesson_id", "collection_type", "year", "cycle", "title", F.col(f"{r}.reference_display").alias("reference_display"), F.col(f"{r}.replacement_policy.provider").alias("replacement_provider"))
    return x.join(sections.profile_metadata(lessons), "publication_id")


def section_outline_index(lessons: DataFrame) -> DataFrame:
    """One row per lesson and section with its items, its trace and the lesson's profile."""
    return indexed_sections(lessons).join(sections.profile_metadata(lessons), "publication_id")


def translation_index(lessons: DataFrame, target: str = "pending") -> DataFrame:
    """Every item with a place for its translation."""
    return item_table(lessons).select("publication_id", "item_id", "section", "item_order", "kind", F.col("text").alias("source_text"), F.lit("es").alias("source_language"), F.lit(target).alias("target_language"), F.lit(None).cast("string").alias("target_text"))


def scripture_index(lessons: DataFrame) -> DataFrame:
    r = "lesson_sections.biblical_reading"
    x = lessons.select("publication_id", "lesson_number", "lesson_id", F.col(f"{r}.reference_display").alias("reference_display"), F.posexplode(f"{r}.canonical_references").alias("pos", "c"))
    return x.select("publication_id", "lesson_number", "lesson_id", "reference_display", (F.col("pos") + 1).alias("ref_no"), "c.*")


def family_counts(lessons: DataFrame) -> DataFrame:
    return lessons.select(sections.classification(F.col("publication_id")).alias("classification")).groupBy("classification").agg(F.count("*").alias("n_lessons"))


def write_by_family(view: DataFrame, path: str) -> None:
    """A view as one folder per family."""
    view.withColumn("classification", sections.classification(F.col("publication_id"))).write.mode("overwrite").partitionBy("classification").parquet(path)


def write_views(lessons: DataFrame, folder: str, scope: str = "canonical_reviewed", key: tuple[str, ...] = ("publication_id", "lesson_number")) -> list[str]:
    """Writes all views below `folder`, three of them by family too, and gives their names.

    Views of reviewed lessons are written only if every lesson is valid; else ValueError and nothing is written.
    """
    if scope == "canonical_reviewed" and not documents.all_valid(lessons, list(key)):
        raise ValueError("an invalid lesson keeps the index from being written")
    views = {"detailed_lessons": lessons_index, "compact_lessons": compact_index, "section_outline": section_outline_index, "translation_alignment": translation_index, "scripture": scripture_index}
    for name, view in views.items():
        header(lessons, name, scope).write.mode("overwrite").json(f"{folder}/{name}/header")
        view(lessons).write.mode("overwrite").parquet(f"{folder}/{name}/all")
        if name in ("compact_lessons", "section_outline", "translation_alignment"):
            write_by_family(view(lessons).drop("classification"), f"{folder}/{name}/by_family")
    return list(views)
