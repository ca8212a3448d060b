"""Sections of a lesson: label search, blocks, outlines, prose merging, traces.

Labels and the lines that end a block are found by as-of joins over the few lines that hold them; only the lines of
the blocks themselves then meet their segments, in an interval join. Aliases come from family profiles, a short table.
All windows are per (publication, segment, section), so one long publication is spread over its lessons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dictionaries import PROFILES, STOP_LABELS
from ..functions import text as T
from . import structure

KEY = ["publication_id", "lesson_number", "start_line", "section"]
OUTLINE = "(?i)^(?:[IVXLCDM]+\\.|[A-Z]\\.)\\s+"
READING = "(?iu)(?:^|.*?(?<![\\p{L}\\p{N}_]))Lectura\\s+B[ií]blica:\\s*(.+)"
SUMMARY = "(?iu)(?:iv\\.\\s*)?resumen(?: y aplicaci[oó]n pr[aá]ctica)?:?"


def classification(publication: Column) -> Column:
    p = F.lower(publication)
    return F.when(p.contains("maestro"), "maestro").when(p.contains("alumno"), "alumno").otherwise("unclassified")


def profiles(spark, known: dict = PROFILES) -> DataFrame:
    return spark.createDataFrame([(k, v["version"]) for k, v in known.items()], "profile_id string, profile_version string")


def profile_sections(spark, known: dict = PROFILES) -> DataFrame:
    """(profile_id, section, aliases) of every family (fixed size)."""
    return spark.createDataFrame([(k, s, a) for k, v in known.items() for s, a in v["sections"].items()], "profile_id string, section string, aliases array<string>")


def profile_metadata(publications: DataFrame, known: dict = PROFILES) -> DataFrame:
    """publication_id with its family, profile and version."""
    x = publications.select("publication_id").distinct().withColumn("classification", classification(F.col("publication_id")))
    return x.join(F.broadcast(profiles(publications.sparkSession, known)).withColumnRenamed("profile_id", "classification"), "classification", "left").select("publication_id", "classification", F.col("classification").alias("profile_id"), F.coalesce("profile_version", F.lit("0.0.0")).alias("profile_version"))


def body_lines(lines: DataFrame) -> DataFrame:
    """Lines with their active page, stripped (s) and folded; what the functions below start from."""
    return structure.with_active_page(lines).withColumn("s", T.strip(F.col("line"))).withColumn("folded", T.fold_label(F.col("line")))


def labels(body: DataFrame, segments: DataFrame, known: dict = PROFILES) -> DataFrame:
    """(key, label_line, last): the first line of a segment that contains one of a section's aliases, and the segment's end."""
    family = F.broadcast(profile_sections(body.sparkSession, known)).withColumnRenamed("profile_id", "family")
    any_alias = T.contains_any(F.col("folded"), sorted({x for v in known.values() for names in v["sections"].values() for x in names}))
    x = body.where(any_alias).select("publication_id", "line_number", "folded").join(family, classification(F.col("publication_id")) == F.col("family"))
    hits = x.where(F.exists("aliases", lambda a: F.contains(F.col("folded"), a))).select("publication_id", "section", "line_number")
    points = segments.join(family, classification(F.col("publication_id")) == F.col("family")).select("publication_id", "section", F.greatest("start_line", F.lit(1)).alias("line_number"), "lesson_number", "start_line", F.coalesce("end_line", F.lit(2**31 - 1)).alias("last")).distinct()
    out = structure.next_line(points, hits, ["publication_id", "section"], "label_line")
    return out.where("label_line <= last").select(*KEY, "label_line", "last")


def stops(folded: Column, but: tuple[str, ...] = ()) -> Column:
    return T.starts_with_any(folded, tuple(x for x in STOP_LABELS if x not in but))


def _at_label(body: DataFrame, found: DataFrame) -> DataFrame:
    return body.join(found.withColumnRenamed("label_line", "line_number"), ["publication_id", "line_number"]).withColumn("label_line", F.col("line_number"))


def _next(found: DataFrame, targets: DataFrame, at: str, name: str, add: int = 0) -> DataFrame:
    """Adds the first target line from `at` + add on; null if there is none or nothing to start from."""
    cols = found.columns
    points = found.where(F.col(at).isNotNull()).withColumn("line_number", F.col(at) + add)
    return found.join(structure.next_line(points, targets, ["publication_id"], name).select(*KEY, name), KEY, "left").select(*cols, name)


def readings(body: DataFrame, found: DataFrame) -> DataFrame:
    """(publication_id, lesson_number, start_line, line_number, reference_display) after the reading's label."""
    x = _at_label(body, found.where("section = 'biblical_reading'"))
    ref = T.strip(F.regexp_extract("s", READING, 1))
    return x.withColumn("reference_display", ref).where("reference_display <> ''").select("publication_id", "lesson_number", "start_line", "line_number", "reference_display")


def _marker() -> Column:
    return F.col("s").rlike(T.PAGE_MARKER)


def _skipped() -> Column:
    return F.col("s").rlike("^\\d{1,4}$") | F.col("folded").isin("maestro", "alumno")


def blocks(body: DataFrame, found: DataFrame) -> DataFrame:
    """Items of list sections other than outlines: what follows the label on its line, then lines up to a stop label."""
    lists = found.where("section not in ('biblical_reading', 'lesson_outline')")
    summary = F.col("section") == "summary_application"
    rest = F.when(summary, F.try_element_at(F.split(F.col("s"), SUMMARY, -1), F.lit(2))).when(F.col("s").contains(":"), F.substring(F.col("s"), F.instr("s", ":") + 1, F.length("s")))
    head = _at_label(body, lists).withColumn("text", T.strip(rest)).where("text <> ''")
    stop = body.where((stops(F.col("folded")) | T.contains_any(F.col("folded"), ["vocabulario", "aplicacion del maestro"])) & ~_marker()).select("publication_id", "line_number")
    ends = _next(lists, stop, "label_line", "stop_line", 1)
    spans = ends.withColumn("low", F.col("label_line") + 1).withColumn("high", F.least("last", F.coalesce(F.col("stop_line") - 1, "last"))).drop("last", "stop_line")
    kept = structure.lines_within(body.where((F.col("s") != "") & ~_marker() & ~_skipped()), spans).withColumn("text", F.col("s"))
    cols = [*KEY, "label_line", "line_number", "active_page", "text"]
    return head.select(*cols).unionByName(kept.select(*cols))


def outlines(body: DataFrame, found: DataFrame) -> DataFrame:
    """Items of outlines: outline rows and, once one was seen, short lines; ends at the first line that fits neither.

    An outline begins with its first item and ends at the next page, so it holds few lines.
    """
    lists = found.where("section = 'lesson_outline'")
    hard = ~_marker() & ((F.col("folded").contains("resumen") & F.col("folded").contains("aplicacion")) | stops(F.col("folded"), ("resumen y aplicacion practica",)))
    is_item = ~_marker() & ~hard & ~_skipped() & F.col("s").rlike(OUTLINE)
    at = lambda c: body.where(c).select("publication_id", "line_number")
    x = _next(lists, at((F.col("s") != "") & hard), "label_line", "hard_line", 1)
    x = _next(x, at(is_item), "label_line", "item_line", 1)
    x = _next(x, at(_marker()), "item_line", "marker_line")
    high = F.least("last", F.coalesce(F.col("hard_line") - 1, "last"), F.coalesce(F.col("marker_line") - 1, "last"))
    spans = x.where("item_line is not null").withColumn("low", F.col("item_line")).withColumn("high", high).select(*KEY, "label_line", "low", "high")
    y = structure.lines_within(body.where("s <> ''"), spans).withColumn("item", is_item)
    w = Window.partitionBy(*KEY).orderBy("line_number")
    before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    closing = F.col("item") & T.starts_with_any(F.lower("s"), ("iv. resumen", "resumen y aplicacion"))
    y = y.withColumn("after_close", F.coalesce(F.max(closing.cast("int")).over(before), F.lit(0)) > 0)
    y = y.withColumn("ended", F.max((~F.col("item") & ~_skipped() & (F.length("s") >= 120)).cast("int")).over(upto) > 0)
    return y.where(~F.col("ended") & ~F.col("after_close") & ~_skipped()).select(*KEY, "label_line", "line_number", "active_page", F.col("s").alias("text"))


def merge_prose(items: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Joins an item to the one before if that does not end a sentence, neither is structural and it starts in lower case."""
    w = Window.partitionBy(*keys).orderBy("line_number")
    structural = F.col("text").rlike(OUTLINE) | F.col("text").rlike("^\\(.+\\)$") | T.fold_label(F.col("text")).isin("maestro", "alumno")
    x = items.withColumn("structural", structural)
    before, was = F.lag("text").over(w), F.lag("structural").over(w)
    joins = before.isNotNull() & ~before.rlike("[.?!:;)\\]]$") & ~was & ~F.col("structural") & F.col("text").rlike("^\\p{Ll}")
    x = x.withColumn("starts", F.when(joins, 0).otherwise(1)).withColumn("item_no", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_number", "text"))), lambda r: r["text"]), " ")
    return x.groupBy(*keys, "item_no").agg(merged.alias("text"))


def items(blocks_: DataFrame, outlines_: DataFrame) -> DataFrame:
    """All section items in order: prose merged, outlines as they are."""
    w = Window.partitionBy(*KEY).orderBy("line_number")
    rows = outlines_.select(*KEY, F.row_number().over(w).alias("item_no"), "text")
    return merge_prose(blocks_).select(*KEY, F.col("item_no").cast("int").alias("item_no"), "text").unionByName(rows)


def traces(section_lines: DataFrame) -> DataFrame:
    """(key, line_start, line_end, page_start, page_end) of each section's source lines."""
    return section_lines.groupBy(*KEY).agg(
        F.min("label_line").alias("line_start"), F.max("line_number").alias("line_end"), F.min_by("active_page", "line_number").alias("page_start"), F.max_by("active_page", "line_number").alias("page_end")
    )


def present(reading: DataFrame, blocks_: DataFrame, outlines_: DataFrame) -> DataFrame:
    """(publication_id, lesson_number, section) of the sections that have content."""
    key = ["publication_id", "lesson_number", "section"]
    return reading.withColumn("section", F.lit("biblical_reading")).select(*key).unionByName(blocks_.select(*key)).unionByName(outlines_.select(*key)).distinct()


def missing(present: DataFrame, lessons: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Required sections a lesson lacks."""
    need = lessons.select("publication_id", "lesson_number").distinct().withColumn("section", F.explode(F.array(*map(F.lit, required))))
    return need.join(present.select("publication_id", "lesson_number", "section").distinct(), ["publication_id", "lesson_number", "section"], "left_anti")
