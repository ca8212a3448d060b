"""Audits over listings, drafts, sections and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dictionaries import CRITICAL_SECTIONS, NUMBER_WORDS, REQUIRED_SECTIONS
from ..functions import text as T
from . import sections


def listing_sync(local: DataFrame, remote: DataFrame) -> DataFrame:
    """(name, local_size, remote_size, outcome): missing_local, missing_remote, size_mismatch or match."""
    a, b = local.select("name", F.col("size").alias("local_size")), remote.select("name", F.col("size").alias("remote_size"))
    outcome = F.when(F.col("local_size").isNull(), "missing_local").when(F.col("remote_size").isNull(), "missing_remote").when(F.col("local_size") != F.col("remote_size"), "size_mismatch").otherwise("match")
    return a.join(b, "name", "full_outer").select("name", "local_size", "remote_size", outcome.alias("outcome"))


def remote_listing(entries: DataFrame) -> DataFrame:
    """A remote listing as (name, size): no folders, only PDFs in any case, Name or Path, sizes default to 0, the last of equal names wins.

    entries: position, Name, Path, Size, IsDir.
    """
    name = F.coalesce(F.nullif("Name", F.lit("")), "Path")
    x = entries.where(~F.coalesce("IsDir", F.lit(False))).select(name.alias("name"), F.coalesce("Size", F.lit(0)).alias("size"), "position").where(F.lower("name").endswith(".pdf"))
    return x.groupBy("name").agg(F.max_by("size", "position").alias("size"))


def volume_number(reference: str) -> object:
    """The volume a file's name or text names; the first pattern that matches wins."""
    t = T.fold_slug(F.col(reference))
    edge, end = "(?<![\\p{L}\\p{N}_])", "(?![\\p{L}\\p{N}_])"
    # How a volume's number may be written, in the order they are tried.
    patterns = [f"{edge}vol(?:umen)?\\.?\\s*(?:no\\.?\\s*)?(\\d{{1,3}}){end}", f"{edge}volume\\s*(?:no\\.?\\s*)?(\\d{{1,3}}){end}", f"{edge}lecc(?:ion|iones)?\\s*(\\d{{1,3}}){end}", f"{edge}lecc(\\d{{1,3}}){end}"]
    digits = [F.nullif(F.regexp_extract(t, p, 1), F.lit("")).cast("int") for p in patterns]
    words = F.create_map(*[F.lit(v) for kv in NUMBER_WORDS.items() for v in kv])
    phrase = F.regexp_extract(t, f"{edge}vol(?:umen)?\\s+([a-z]+){end}", 1)
    return F.coalesce(*digits, F.try_element_at(words, phrase))


def reference_texts(stems: DataFrame, pages: DataFrame, first: int = 5) -> DataFrame:
    """(stem, reference_text): the stem, the title if there is one, and the texts of the first pages in order.

    stems: stem, title (or no such column). pages: publication_id, page_number, text. A file without pages keeps its stem.
    """
    texts = pages.where(F.col("page_number") <= first).groupBy(F.col("publication_id").alias("stem")).agg(F.array_sort(F.collect_list(F.struct("page_number", F.coalesce("text", F.lit("")).alias("text")))).alias("x"))
    said = F.array_join(F.transform("x", lambda p: p["text"]), "\n")
    title = F.nullif("title", F.lit("")) if "title" in stems.columns else F.lit(None).cast("string")
    return stems.join(texts, "stem", "left").select("stem", F.concat_ws("\n", "stem", title, said).alias("reference_text"))


def rename_proposals(files: DataFrame, default_slug: str = "expositor-guia-maestro") -> DataFrame:
    """(stem, volume, target, reason, n_same_target). files: stem, reference_text (`reference_texts`)."""
    t = T.fold_slug(F.col("reference_text"))
    both = t.contains("expositor") & t.contains("maestro")
    slug = F.when(both, "expositor-guia-maestro").otherwise(default_slug)
    why = F.when(both, "matched publication and family").when(t.contains("maestro"), "matched family; used default").otherwise("used default")
    why = F.concat(why, F.when(F.col("volume").isNull(), "; volume number not found").otherwise(F.concat(F.lit("; volume "), F.col("volume").cast("string"), F.lit(" found"))))
    x = files.withColumn("volume", volume_number("reference_text")).withColumn("slug", slug)
    target = F.when(F.col("volume").isNull(), F.concat("slug", F.lit("-"), "stem", F.lit(".pdf"))).otherwise(F.format_string("%s-volumen-%02d.pdf", "slug", "volume"))
    x = x.withColumn("target", target)
    same = x.groupBy("target").agg(F.count("*").alias("n_same_target"))
    return x.join(same, "target").select("stem", "volume", "target", why.alias("reason"), "n_same_target")


def missing_sections(present: DataFrame, segments: DataFrame) -> DataFrame:
    """Required sections without content, with the lesson's pages and whether the lack is critical."""
    gone = sections.missing(present, segments, REQUIRED_SECTIONS)
    pages = segments.groupBy("publication_id", "lesson_number").agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"))
    out = gone.join(pages, ["publication_id", "lesson_number"], "left").withColumn("critical", F.col("section").isin(*CRITICAL_SECTIONS))
    return out.orderBy("publication_id", "lesson_number", "section")


def missing_totals(missing: DataFrame) -> DataFrame:
    return missing.agg(F.count("*").alias("total_missing"), F.count_if("critical").alias("critical_missing"), F.coalesce(F.bool_or("critical"), F.lit(False)).alias("has_critical"))


def profile_completeness(lessons: DataFrame, treat_placeholder_missing: bool = False) -> DataFrame:
    """Lessons lacking each section their family expects (a placeholder counts as present unless told otherwise)."""
    spark = lessons.sparkSession
    expected = sections.profile_sections(spark).where("section <> 'biblical_reading'").select(F.col("profile_id").alias("classification"), "section")
    parts = [F.struct(F.lit(s).alias("section"), F.col(f"lesson_sections.{s}.items").alias("items")) for s in ("lesson_outline", "teacher_notes", "summary_application")]
    have = lessons.select("publication_id", "lesson_number", F.explode(F.array(*parts)).alias("p")).select("publication_id", "lesson_number", "p.section", "p.items").where(F.size("items") > 0)
    if treat_placeholder_missing:
        have = have.where(F.exists("items", lambda x: x != "TBD"))
    need = lessons.select("publication_id", "lesson_number", sections.classification(F.col("publication_id")).alias("classification")).join(F.broadcast(expected), "classification")
    gone = need.join(have, ["publication_id", "lesson_number", "section"], "left_anti")
    return gone.groupBy("classification", "section").agg(F.count("*").alias("n_missing"))


def review_statuses(lessons: DataFrame) -> DataFrame:
    return lessons.select(F.coalesce("processing_audit.review_status", F.lit("unknown")).alias("review_status")).groupBy("review_status").agg(F.count("*").alias("n"))


def id_mismatches(rows: DataFrame, by_path: str, by_content: str, contains: bool = False) -> DataFrame:
    """Rows whose id by path differs from the id inside (or is not part of it)."""
    differs = ~F.coalesce(F.contains(F.col(by_content), F.col(by_path)), F.lit(False)) if contains else ~F.col(by_path).eqNullSafe(F.col(by_content))
    return rows.where(differs)


def index_cardinality(views: dict[str, DataFrame]) -> DataFrame:
    """(view, n) of each index."""
    out = None
    for name, df in views.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("view"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def normalized_by_family(texts: DataFrame) -> DataFrame:
    """Texts and characters per family."""
    return texts.select(sections.classification(F.col("publication_id")).alias("family"), F.length("text").alias("n")).groupBy("family").agg(F.count("*").alias("n_texts"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_chars"))


KNOWN_FAMILIES = ("maestro", "alumno", "joven", "adolescente", "nino", "parvulo", "unclassified")


def _row(df: DataFrame, part: str, name: Column | None = None, n: Column | None = None) -> DataFrame:
    return df.select(F.lit(part).alias("part"), (F.lit("") if name is None else name).alias("name"), (F.lit(1) if n is None else n).cast("bigint").alias("n"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def normalized_audit(paths: DataFrame) -> DataFrame:
    """(part, name, n) of normalized texts by their path below the folder: how many, by family, those at the root, unknown families, warnings.

    Of texts at the root only the first is warned of.
    """
    x = paths.where("path is not null").select("path", F.split_part("path", F.lit("/"), F.lit(1)).alias("family"), F.contains("path", F.lit("/")).alias("below"))
    by = x.groupBy("family").agg(F.count("*").alias("n"))
    root, odd = x.where("not below"), by.where(~F.col("family").isin(*KNOWN_FAMILIES))
    return _all([
        _row(x.agg(F.count("*").alias("n")), "txt_file_count", n=F.col("n")), _row(by, "by_family", F.col("family"), F.col("n")), _row(root, "root_level_file", F.col("path")), _row(odd, "unknown_family", F.col("family")),
        _row(root.limit(1), "warning", F.lit("text at the root level")), _row(odd, "warning", F.concat(F.lit("unknown family folder: "), "family")),
    ])


def yaml_audit(drafts: DataFrame, canonical: DataFrame) -> DataFrame:
    """(part, name, n) of drafts and reviewed lessons: counts, review statuses, profiles, missing sections, warnings."""
    total = lambda df: df.agg(F.count("*").alias("n"))
    statuses, n = review_statuses(drafts), total(canonical)
    profiles = drafts.groupBy(sections.classification(F.col("publication_id")).alias("p")).agg(F.count("*").alias("n"))
    gone = profile_completeness(drafts).groupBy("section").agg(F.sum("n_missing").alias("n"))
    return _all([
        _row(total(drafts), "draft_count", n=F.col("n")), _row(n, "canonical_count", n=F.col("n")), _row(statuses, "review_status", F.col("review_status"), F.col("n")), _row(profiles, "profile", F.col("p"), F.col("n")),
        _row(gone, "missing_section", F.col("section"), F.col("n")), _row(n.where("n = 0"), "warning", F.lit("no reviewed lesson exists")), _row(statuses.where("review_status = 'automated_unreviewed'"), "warning", F.lit("drafts remain unreviewed")),
    ])


#: The views that are warned of if they are missing.
EXPECTED_VIEWS = ("compact_lessons", "section_outline", "translation_alignment")


def indexing_audit(views: dict[str, DataFrame], scope: DataFrame, families: DataFrame, expected_scope: str = "automated_unreviewed_draft") -> DataFrame:
    """(part, name, n) of index views: rows of each, family folders, warnings of a wrong scope and of missing or empty views.

    scope: one row with index_scope. families: classification of each folder.
    """
    sizes = index_cardinality(views)
    spark = scope.sparkSession
    wanted = spark.createDataFrame([(v,) for v in EXPECTED_VIEWS], "view string").join(sizes, "view", "left").where(F.coalesce("n", F.lit(0)) == 0)
    return _all([
        _row(sizes, "view", F.col("view"), F.col("n")), _row(families.select("classification").distinct(), "family_folder", F.col("classification")),
        _row(scope.where(~F.col("index_scope").eqNullSafe(expected_scope)), "warning", F.lit("the scope is not that of unreviewed drafts")), _row(wanted, "warning", F.concat("view", F.lit(" is missing"))),
    ])


def title_inconsistencies(titles: DataFrame) -> DataFrame:
    """(publication_id, lesson_number, n_titles) of lessons with several titles, compared folded. titles: publication_id, lesson_number, title."""
    x = titles.where("title is not null").groupBy("publication_id", "lesson_number").agg(F.count_distinct(T.fold_label(F.col("title"))).alias("n_titles"))
    return x.where("n_titles > 1")


def content_audits(missing: DataFrame, inconsistent_titles: DataFrame, unresolved: DataFrame) -> DataFrame:
    """One row of totals: missing sections, critical ones and whether there are any, inconsistent titles, readings of low confidence."""
    n = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    parts = [n(missing, "total_missing"), n(missing.where("critical"), "critical_missing"), n(inconsistent_titles, "inconsistent_titles"), n(unresolved, "low_confidence_scripture")]
    return _all(parts).groupBy().pivot("name", ["total_missing", "critical_missing", "inconsistent_titles", "low_confidence_scripture"]).agg(F.first("n")).withColumn("has_critical", F.col("critical_missing") > 0)


def output_sizes(parts: dict[str, DataFrame]) -> DataFrame:
    """(part, n, bytes) of the texts of each part; each has one string column."""
    return _all([df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(df.columns[0])), F.lit(0)).alias("bytes")).select(F.lit(name).alias("part"), "n", "bytes") for name, df in parts.items()])


def id_audit(checks: dict[str, tuple[DataFrame, str, str, bool]]) -> DataFrame:
    """(kind, by_path, by_content) of all id checks: per kind the rows, the columns of both ids and whether one need only contain the other.

    Rows without an id inside are no mismatch.
    """
    return _all([id_mismatches(df.where(F.col(b).isNotNull()), a, b, contains).select(F.lit(kind).alias("kind"), F.col(a).alias("by_path"), F.col(b).alias("by_content")) for kind, (df, a, b, contains) in checks.items()])
