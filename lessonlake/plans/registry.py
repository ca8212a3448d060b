"""All core queries by name; each takes (spark, directory of tables) and runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audits, documents, indexes, quality, references, sections, segments, structure
from ..sources.shared import materialize
from .oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pages(spark, d) -> DataFrame:
    """The pages; where a file has fewer parts than there are cores, they are spread, since each text costs work."""
    x = table(spark, d, "page_quality").select("page_id", "publication_id", "page_number", "source", "text", "ocr_confidence")
    cores = spark.sparkContext.defaultParallelism
    return x.repartition(cores) if x.rdd.getNumPartitions() < cores else x


def gated(spark, d) -> DataFrame:
    return quality.gate(pages(spark, d))


# ---- the page gate


@query
def page_metrics(spark, d):
    return quality.metrics(pages(spark, d)).select("page_id", "words", "n_chars", "n_valid", "n_lines", "n_long", "n_replacement", "n_malformed")


@query
def page_quality_gate(spark, d):
    return gated(spark, d).select("page_id", F.array_join("gate_issues", ",").alias("issues"), F.col("gate_status").alias("status"), F.col("gate_score").alias("score"), "ocr_needed", "selected_source")


@query
def stale_figures(spark, d):
    """Stored figures that are missing or not those of the text."""
    stored = table(spark, d, "page_quality").select("page_id", F.col("word_count").cast("bigint").alias("stored_words"), F.col("malformed_scripture_count").cast("bigint").alias("stored_malformed"))
    m = quality.metrics(pages(spark, d)).select("page_id", F.col("words").cast("bigint").alias("words"), F.col("n_malformed").cast("bigint").alias("n_malformed"))
    return m.join(stored, "page_id").where(~F.col("words").eqNullSafe(F.col("stored_words")) | ~F.col("n_malformed").eqNullSafe(F.col("stored_malformed")))


@query
def page_log(spark, d):
    return quality.page_log(gated(spark, d))


@query
def repeated_edge_lines(spark, d):
    return quality.repeated_edges(pages(spark, d))


@query
def gate_with_edges(spark, d):
    p = pages(spark, d)
    return quality.gate_with_edges(quality.gate(p), keys=materialize(quality.edge_keys(p))).select("page_id", F.array_join("gate_issues", ",").alias("issues"), F.col("gate_status").alias("status"), F.col("gate_score").alias("score"))


@query
def best_source_selection(spark, d):
    g = gated(spark, d)
    best = [g.where(c).groupBy("publication_id", "page_number").agg(F.max("page_id").alias("page_id")) for c in (~quality.is_ocr(), quality.is_ocr())]
    a, b = (g.join(x.select("page_id"), "page_id", "left_semi") for x in best)
    return quality.best_source(a, b)


@query
def issue_counts(spark, d):
    return quality.issue_counts(gated(spark, d))


@query
def status_counts(spark, d):
    return quality.status_counts(table(spark, d, "page_quality"), "status")


@query
def waived_pages(spark, d):
    x = table(spark, d, "page_quality").select("page_id", "publication_id", "page_number", F.explode("issues").alias("issue"))
    return quality.waived(x, table(spark, d, "waivers"))


@query
def unwaived_zero_text(spark, d):
    x = gated(spark, d).select("page_id", "publication_id", "page_number", F.explode("gate_issues").alias("issue")).where("issue = 'zero_text'")
    return quality.unwaived(x, table(spark, d, "waivers"))


@query
def publication_quality_report(spark, d):
    return quality.publication_report(gated(spark, d), table(spark, d, "waivers"))


@query
def extraction_summary(spark, d):
    return quality.extraction_summary(gated(spark, d))


@query
def ocr_audit(spark, d):
    return quality.ocr_reports(gated(spark, d), table(spark, d, "waivers"))


# ---- text


@query
def fold_text(spark, d):
    x = table(spark, d, "lesson_segments").where("expected_title is not null")
    t = F.col("expected_title")
    return x.select("segment_id", T.fold(t).alias("folded"), T.fold_label(t).alias("label"), T.fold_slug(t).alias("slug"))


@query
def tidy_text(spark, d):
    return table(spark, d, "page_quality").where("text is not null").select("page_id", F.md5(T.tidy(F.col("text"))).alias("digest"), F.length(T.tidy(F.col("text"))).alias("n_chars"))


def _page_lines(spark, d) -> DataFrame:
    return structure.lines_of_pages(pages(spark, d))


@query
def normalized_text(spark, d):
    """The normalized text of each page, with the page as the unit: page markers part paragraphs."""
    x = structure.normalized_pages(pages(spark, d)).where("text is not null")
    return x.select("page_id", F.md5("text").alias("digest"), F.length("text").alias("n_chars"))


@query
def structural_line_flags(spark, d):
    x = _page_lines(spark, d)
    return x.select("publication_id", "line_number", T.is_structural(F.col("line")).alias("structural"), T.is_citation_only(T.strip(F.col("line"))).alias("citation_only"), T.is_section_label(F.col("line")).alias("label"))


@query
def reflow_paragraphs(spark, d):
    """Paragraphs of every extraction."""
    return structure.reflow(pages(spark, d).where("text is not null"), "page_id")


@query
def rename_proposals(spark, d):
    p = structure.latest_pages(pages(spark, d).where("page_number <= 5"))
    stems = table(spark, d, "page_quality").select(F.col("publication_id").alias("stem")).distinct()
    return audits.rename_proposals(audits.reference_texts(stems, p))


@query
def classify_publications(spark, d):
    return sections.profile_metadata(table(spark, d, "page_quality"))


@query
def normalized_by_family(spark, d):
    return audits.normalized_by_family(structure.latest_pages(pages(spark, d)))


@query
def normalized_audit(spark, d):
    """Texts of documents filed by section and publication."""
    x = table(spark, d, "documents").where("publication_id is not null")
    return audits.normalized_audit(x.select(F.concat_ws("/", "section_key", F.concat("publication_id", F.lit(".txt"))).alias("path")))


@query
def output_sizes(spark, d):
    raw = structure.latest_pages(pages(spark, d)).select("text")
    return audits.output_sizes({"raw_text": raw, "normalized_text": structure.normalized_pages(pages(spark, d)).select("text"), "documents": table(spark, d, "documents").select("text")})


@query
def publication_paths(spark, d):
    x = table(spark, d, "page_quality").select("publication_id").distinct()
    raw, family = T.expected_path(F.col("publication_id"), "/archive/raw", ".txt"), sections.classification(F.col("publication_id"))
    return x.select("publication_id", raw.alias("raw_path"), T.expected_path(F.col("publication_id"), "/archive/logs/", ".json").alias("log_path"), T.relative_path(raw, "/archive").alias("relative"), T.runtime_path(raw, "/else/").alias("runtime"), T.classified_path(F.col("publication_id"), family, T.relative_path(raw, "/archive/raw")).alias("classified"))


# ---- structure: over all pages, and over lines composed from segments and readings, which hold every label


def lessons(spark, d) -> DataFrame:
    """One delivery of each lesson (the last), with its last reading."""
    s = table(spark, d, "lesson_segments").groupBy("publication_id", "lesson_number").agg(F.max_by(F.struct("expected_title", "page_start", "lesson_date", "segment_id"), "segment_id").alias("x")).select("publication_id", "lesson_number", "x.*")
    r = table(spark, d, "biblical_readings").groupBy("publication_id", "lesson_number").agg(F.max_by("reference_display", "reading_id").alias("reference_display"))
    return s.join(r, ["publication_id", "lesson_number"], "left")


def source_lines(spark, d) -> DataFrame:
    """A publication's text: a contents page, then each lesson's page. Numbers and pages come from running sums of lessons, not of lines."""
    x = lessons(spark, d)
    title = F.coalesce("expected_title", F.lit("Sin título"))
    n = F.col("lesson_number").cast("string")
    entry = (F.col("lesson_date"), F.concat(n, F.lit(". "), title), F.concat(F.lit("..... "), F.coalesce(F.col("page_start").cast("string"), F.lit("7"))))
    body = (
        F.concat(F.lit("===== PDF_PAGE "), (F.col("lesson_number") * 4).cast("string"), F.lit(" =====")),
        F.concat(F.lit("LECCIÓN "), n),
        title,
        F.concat(F.lit("Lectura Bíblica: "), F.col("reference_display")),
        F.lit("Bosquejo de la lección"),
        F.concat(F.lit("I. "), title),
        F.lit("A. primer punto"),
        F.concat(F.lit("("), F.col("reference_display"), F.lit(")")),
        F.lit("sigue el punto"),
        F.lit("12"),
        F.lit("Notas para el maestro: lea con la clase"),
        F.lit("el pasaje de hoy."),
        F.concat(F.lit("¿"), title, F.lit("?")),
        F.lit("Maestro"),
        F.lit("repase la lección anterior"),
        F.lit("y ore."),
        F.lit("Resumen y aplicación práctica: viva"),
        F.lit("lo aprendido."),
        F.lit("Lecturas diarias"),
    )
    # counts and pages of each lesson's lines, from the columns they are made of: literals cost nothing here
    n_entry, n_body = (sum((c.isNotNull().cast("int") for c in lines), F.lit(0)) for lines in (entry, body))
    in_entry, in_body = (F.coalesce(*[structure.page_of(c) for c in reversed(lines)]) for lines in (entry, body))
    x = x.select("*", n_entry.alias("n_entry"), n_body.alias("n_body"), in_entry.alias("in_entry"), in_body.alias("in_body"))
    order = Window.partitionBy("publication_id").orderBy("lesson_number")
    earlier, all_ = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = x.select(
        *x.columns[:-4],
        (F.row_number().over(order) == 1).alias("is_first"),
        F.coalesce(F.sum("n_entry").over(earlier), F.lit(0)).alias("entries_before"),
        F.sum("n_entry").over(all_).alias("entries"),
        F.coalesce(F.sum("n_body").over(earlier), F.lit(0)).alias("bodies_before"),
        F.last("in_entry", True).over(earlier).alias("entry_page"),
        F.coalesce(F.last("in_body", True).over(earlier), F.last("in_entry", True).over(all_)).alias("body_page"),
    )
    first = F.col("is_first")
    head = (F.when(first, "===== PDF_PAGE 1 ====="), F.when(first, "CONTENIDO"))

    def block(before, carried, lines):
        each = F.array(*[F.struct(c.alias("line"), structure.page_of(c).alias("page")) for c in lines])
        return F.struct(before.alias("before"), carried.alias("carried"), F.filter(each, lambda v: v["line"].isNotNull()).alias("lines"))

    at_entry = block(F.when(first, 0).otherwise(F.col("entries_before") + 2), F.when(~first, F.coalesce("entry_page", F.lit(1))), (*head, *entry))
    at_body = block(F.col("entries") + 2 + F.col("bodies_before"), F.coalesce("body_page", F.lit(1)), body)
    blocks = x.select("publication_id", F.array(at_entry, at_body).alias("b")).select("publication_id", F.explode_outer("b").alias("b")).select("publication_id", "b.*")
    return structure.numbered_lines(blocks.select("publication_id", "before", "carried", F.col("lines.line").alias("block_lines"), structure.marks_of_pages(F.col("lines.page")).alias("marks")), "publication_id")


def _composed_structure(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    lines = materialize(source_lines(spark, d))  # the rest reads it several times
    candidates = materialize(structure.contents_candidates(lines))  # a few pages, of known size to the join with their lines
    return lines, materialize(structure.markers(lines)), materialize(structure.contents_index(structure.contents_rows(lines, candidates)))


def _structure(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The lines of all pages, their markers, and the contents as delivered (pages hold no table of contents)."""
    lines = materialize(sections.body_lines(_page_lines(spark, d)))
    x = lessons(spark, d).where("page_start is not null")
    contents = x.select("publication_id", F.lit(None).cast("int").alias("contents_page"), F.col("lesson_number").alias("line_number"), "lesson_number", F.col("expected_title").alias("title"), "page_start", "lesson_date")
    return lines, materialize(structure.markers(lines)), materialize(contents)


@query
def active_page(spark, d):
    x = structure.with_active_page(_page_lines(spark, d))
    return x.groupBy("publication_id", "active_page").agg(F.min("line_number").alias("first_line"), F.count("*").alias("n_lines"))


@query
def structure_markers(spark, d):
    return structure.markers(_page_lines(spark, d))


@query
def contents_candidates(spark, d):
    return structure.contents_candidates(_page_lines(spark, d))


@query
def composed_contents_candidates(spark, d):
    return structure.contents_candidates(source_lines(spark, d))


@query
def composed_contents_entries(spark, d):
    return _composed_structure(spark, d)[2]


@query
def composed_lesson_segments(spark, d):
    lines, marks, contents = _composed_structure(spark, d)
    return segments.segments(contents, marks, lines)


def _segments(spark, d) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    lines, marks, contents = _structure(spark, d)
    return lines, marks, contents, materialize(segments.segments(contents, marks, lines))


@query
def lesson_segments(spark, d):
    return _segments(spark, d)[3]


@query
def header_fallback_segments(spark, d):
    return segments.from_headers(structure.markers(_page_lines(spark, d))).select("publication_id", "lesson_number", "start_line", "marker")


@query
def duplicate_headers(spark, d):
    return segments.observed_headers(structure.markers(_page_lines(spark, d))).where("n > 1")


@query
def segment_validation(spark, d):
    """The seven checks: delivered lessons against the headers on the pages."""
    _, marks, contents, cut = _segments(spark, d)
    return segments.messages(table(spark, d, "page_quality"), contents, cut, marks)


@query
def segment_status(spark, d):
    return segments.validation_status(table(spark, d, "page_quality"), materialize(segment_validation(spark, d)))


# ---- sections


def _composed_sections(spark, d):
    lines = materialize(sections.body_lines(source_lines(spark, d)))
    cut = segments.from_headers(structure.markers(lines)).withColumn("end_line", F.col("start_line") + 17)
    return lines, materialize(sections.labels(lines, cut))


def _sections(spark, d):
    """(lines, labels, segments) of all pages."""
    lines, _, _, cut = _segments(spark, d)
    return lines, materialize(sections.labels(lines, cut)), cut


def _section_queries(name: str, of: Callable) -> None:
    """The section queries, over the pages and over composed lessons."""
    cols = [*sections.KEY, "line_number", "text"]
    QUERIES[f"{name}section_labels"] = lambda spark, d: of(spark, d)[1].drop("last")
    QUERIES[f"{name}biblical_reading"] = lambda spark, d: sections.readings(*of(spark, d)[:2])
    QUERIES[f"{name}section_blocks"] = lambda spark, d: sections.blocks(*of(spark, d)[:2]).select(*cols)
    QUERIES[f"{name}outline_blocks"] = lambda spark, d: sections.outlines(*of(spark, d)[:2]).select(*cols)
    QUERIES[f"{name}merged_prose"] = lambda spark, d: sections.merge_prose(sections.blocks(*of(spark, d)[:2]))

    def traces(spark, d):
        body, found = of(spark, d)[:2]
        return sections.traces(sections.blocks(body, found).unionByName(sections.outlines(body, found)))

    QUERIES[f"{name}section_traces"] = traces


_section_queries("", _sections)
_section_queries("composed_", _composed_sections)


# ---- references


@query
def parsed_references(spark, d):
    return references.parse(table(spark, d, "biblical_readings"), table(spark, d, "bible_books"), ["reading_id"])


@query
def unresolved_references(spark, d):
    return references.unresolved(table(spark, d, "biblical_readings"), table(spark, d, "bible_books"), ["reading_id"])


@query
def verse_ranges(spark, d):
    x = references.parts(table(spark, d, "biblical_readings"), table(spark, d, "bible_books"), ["reading_id"]).where("verses <> ''")
    return x.select("reading_id", "part_no", F.posexplode(references.verse_ranges(F.col("verses"))).alias("pos", "r")).select("reading_id", "part_no", "pos", "r.verse_start", "r.verse_end")


# ---- documents


KEY = ["publication_id", "lesson_number"]


def _last_readings(spark, d) -> DataFrame:
    return table(spark, d, "biblical_readings").groupBy(*KEY).agg(F.max_by(F.struct("reference_display", "canonical_references"), "reading_id").alias("x")).select(*KEY, "x.*")


def drafts(spark, d) -> DataFrame:
    """Drafts of all lessons: readings as delivered, items and traces from the sections of their pages."""
    lines, found, cut = _sections(spark, d)
    blocks, outlines = materialize(sections.blocks(lines, found)), materialize(sections.outlines(lines, found))
    items = sections.items(blocks, outlines).groupBy(*KEY, "section").agg(F.array_sort(F.collect_list(F.struct("item_no", "text"))).alias("x")).select(*KEY, "section", F.transform("x", lambda r: r["text"]).alias("items"))
    return materialize(documents.draft_lessons(cut, _last_readings(spark, d), items, traces=sections.traces(blocks.unionByName(outlines))))


def composed_drafts(spark, d) -> DataFrame:
    """Drafts with composed items of all sections and kinds."""
    s = lessons(spark, d)
    seg = s.select("publication_id", "lesson_number", (F.col("lesson_number") * 10).cast("int").alias("start_line"), F.lit("Contenido").alias("marker"), F.lit(None).cast("int").alias("end_line"), F.lit(None).cast("int").alias("page_end"), "page_start", "expected_title", F.col("page_start").alias("expected_page_start"), "lesson_date")
    t = F.coalesce("expected_title", F.lit(""))
    trace = [F.col("start_line").alias("line_start"), (F.col("start_line") + 3).alias("line_end"), "page_start", "page_start"]
    rows = F.array(
        F.struct(F.lit("lesson_outline").alias("section"), F.array(F.concat(F.lit("I. "), t), F.lit("A. punto"), F.lit(" "), F.lit("(Juan 3:16)")).alias("items")),
        F.struct(F.lit("teacher_notes").alias("section"), F.array(t, F.concat(F.lit("¿"), t, F.lit("?"))).alias("items")),
    )
    items = s.select(*KEY, F.explode(rows).alias("r")).select(*KEY, "r.*")
    traces = seg.select(*KEY, F.lit("lesson_outline").alias("section"), *trace[:2], F.col("page_start"), F.col("page_start").alias("page_end"))
    return materialize(documents.draft_lessons(seg, _last_readings(spark, d), items, traces=traces))


def delivered(spark, d) -> DataFrame:
    """Lessons as they were delivered, without the defaults of drafts: what the checks are for."""
    raw = lessons(spark, d).select(*KEY, F.col("expected_title").alias("raw_title"), F.col("lesson_date").alias("raw_date"))
    read = _last_readings(spark, d).select(*KEY, F.col("reference_display").alias("raw_display"), F.col("canonical_references").alias("raw_references"))
    x = composed_drafts(spark, d).join(raw, KEY).join(read, KEY, "left")
    inside = F.col("lesson_sections").withField("title.text", F.col("raw_title")).withField("lesson_header.lesson_date", F.col("raw_date"))
    inside = inside.withField("biblical_reading.reference_display", F.col("raw_display")).withField("biblical_reading.canonical_references", F.col("raw_references"))
    return materialize(x.withColumn("title", F.col("raw_title")).withColumn("lesson_sections", inside).drop("raw_title", "raw_date", "raw_display", "raw_references"))


def _draft_row(x: DataFrame) -> DataFrame:
    r, t = "lesson_sections.biblical_reading", "source_trace.section_traces"
    return x.select(
        *KEY, "lesson_id", "year", "title", F.col("page_range.start").alias("page_start"), F.col("page_range.end").alias("page_end"), F.col(f"{r}.reference_display").alias("reference_display"),
        F.size(f"{r}.canonical_references").alias("n_references"), F.array_join("lesson_sections.teacher_notes.items", "|").alias("teacher_notes"), F.md5(F.array_join("lesson_sections.summary_application.items", "|")).alias("summary_digest"), F.size("lesson_sections.summary_application.items").alias("summary_items"),
        F.col(f"{t}.summary_application.line_start").alias("summary_line"), F.col(f"{t}.summary_application.line_end").alias("summary_end"), F.col("processing_audit.review_status").alias("review_status"), F.col("source_integrity.sha256").alias("sha256"),
    )


@query
def draft_lessons(spark, d):
    return _draft_row(drafts(spark, d))


@query
def composed_draft_lessons(spark, d):
    return _draft_row(composed_drafts(spark, d))


@query
def missing_fields(spark, d):
    return documents.missing_fields(delivered(spark, d), KEY).select(*KEY, "rule", "path")


@query
def reading_policy_errors(spark, d):
    return documents.reading_errors(delivered(spark, d), KEY)


@query
def placeholder_leaves(spark, d):
    return documents.placeholders(composed_drafts(spark, d), KEY)


@query
def first_error(spark, d):
    return documents.first_error(delivered(spark, d), KEY)


@query
def index_gate(spark, d):
    return documents.gate(delivered(spark, d), KEY)


@query
def draft_paths(spark, d):
    return documents.with_paths(composed_drafts(spark, d)).select(*KEY, "path")


@query
def duplicate_draft_paths(spark, d):
    """Lessons of all publications under one folder: ids repeat across publications."""
    return documents.duplicate_paths(composed_drafts(spark, d).withColumn("publication_id", F.lit("all")))


# ---- indexes


@query
def index_items(spark, d):
    return indexes.item_table(composed_drafts(spark, d))


@query
def index_header(spark, d):
    return indexes.header(composed_drafts(spark, d), "compact_lessons", scope="provisional_unreviewed")


def _items_text(items) -> F.Column:
    return F.array_join(F.transform(items, lambda i: F.concat_ws("|", i["item_id"], i["order"].cast("string"), i["kind"], i["text"], F.coalesce(i["source_trace_ref"], F.lit("")))), "¶")


@query
def lessons_index(spark, d):
    x = indexes.lessons_index(composed_drafts(spark, d))
    for s in indexes.SECTIONS:
        x = x.withColumns({f"{s}_count": F.col(f"{s}.item_count"), f"{s}_items": _items_text(F.col(f"{s}.items")), f"{s}_line": F.col(f"{s}.source_trace.line_start")}).drop(s)
    return x


@query
def compact_index(spark, d):
    return indexes.compact_index(composed_drafts(spark, d))


@query
def section_outline_index(spark, d):
    """Over the sections of all pages."""
    x = indexes.section_outline_index(drafts(spark, d))
    return x.select(*KEY, "lesson_id", "section", "profile_id", "profile_version", "item_count", F.md5(_items_text(F.col("items"))).alias("items_digest"), F.col("source_trace.line_start").alias("line_start"), F.col("source_trace.page_end").alias("page_end"))


@query
def translation_alignment_index(spark, d):
    return indexes.translation_index(composed_drafts(spark, d))


@query
def scripture_index(spark, d):
    return indexes.scripture_index(composed_drafts(spark, d))


@query
def family_counts(spark, d):
    return indexes.family_counts(composed_drafts(spark, d))


@query
def family_views(spark, d):
    """What each family's folder of the compact view holds."""
    x = indexes.compact_index(composed_drafts(spark, d))
    return x.groupBy("classification").agg(F.count("*").alias("n_lessons"), F.countDistinct("publication_id").alias("n_publications"))


# ---- audits


@query
def listing_sync(spark, d):
    """Publications with pages against those that lessons or documents name; sizes are page numbers."""
    name = F.concat("publication_id", F.lit(".pdf"))
    local = table(spark, d, "page_quality").groupBy(name.alias("name")).agg(F.max("page_number").cast("bigint").alias("size"))
    entry = lambda at, size, d_: d_.select(F.lit(at).alias("position"), name.alias("Name"), F.lit(None).cast("string").alias("Path"), size.cast("bigint").alias("Size"), F.lit(False).alias("IsDir"))
    docs = table(spark, d, "documents").where("publication_id is not null").select("publication_id").distinct()
    parts = table(spark, d, "lesson_segments").groupBy("publication_id").agg(F.max("page_end").alias("size"))
    return audits.listing_sync(local, audits.remote_listing(entry(1, F.lit(None), docs).unionByName(entry(2, F.col("size"), parts))))


def _missing(spark, d) -> DataFrame:
    lines, found, cut = _sections(spark, d)
    return audits.missing_sections(sections.present(sections.readings(lines, found), sections.blocks(lines, found), sections.outlines(lines, found)), cut)


@query
def missing_sections(spark, d):
    return _missing(spark, d)


@query
def missing_totals(spark, d):
    return audits.missing_totals(_missing(spark, d))


def _titles(spark, d) -> DataFrame:
    return audits.title_inconsistencies(table(spark, d, "lesson_segments").select(*KEY, F.col("expected_title").alias("title")))


@query
def title_inconsistencies(spark, d):
    return _titles(spark, d)


@query
def content_audits(spark, d):
    low = references.unresolved(table(spark, d, "biblical_readings"), table(spark, d, "bible_books"), ["reading_id"]).select("reading_id").distinct()
    return audits.content_audits(materialize(_missing(spark, d)), _titles(spark, d), low)


@query
def profile_completeness(spark, d):
    return audits.profile_completeness(composed_drafts(spark, d), treat_placeholder_missing=True)


@query
def review_statuses(spark, d):
    return audits.review_statuses(composed_drafts(spark, d))


@query
def yaml_audit(spark, d):
    x = composed_drafts(spark, d)
    return audits.yaml_audit(x, x.where("processing_audit.review_status = 'reviewed'"))


@query
def indexing_audit(spark, d):
    x = composed_drafts(spark, d)
    views = {"detailed_lessons": indexes.lessons_index(x), "compact_lessons": indexes.compact_index(x), "section_outline": indexes.section_outline_index(x), "scripture": indexes.scripture_index(x)}
    return audits.indexing_audit(views, indexes.header(x, "detailed_lessons", scope="provisional_unreviewed"), indexes.compact_index(x))


@query
def id_consistency(spark, d):
    """Stored lesson ids of readings against the ids composed from their numbers."""
    x = table(spark, d, "biblical_readings").select("reading_id", "lesson_id", F.format_string("-C1-%03d", "lesson_number").alias("tail"))
    return audits.id_mismatches(x, "tail", "lesson_id", contains=True)


@query
def id_audit(spark, d):
    """All id checks in one list: drafts by path, readings by number, documents by the publication in their source."""
    drafts_ = documents.draft_paths(composed_drafts(spark, d)).select(F.split_part("path", F.lit("/"), F.lit(1)).alias("a"), F.col("publication_id").alias("b"))
    reads = table(spark, d, "biblical_readings").select(F.format_string("-C1-%03d", "lesson_number").alias("a"), F.col("lesson_id").alias("b"))
    docs = table(spark, d, "documents").where("publication_id is not null").select(F.col("publication_id").alias("a"), F.col("source").alias("b"))
    return audits.id_audit({"draft": (drafts_, "a", "b", False), "reading": (reads, "a", "b", True), "document": (docs, "a", "b", False)})


@query
def pipeline_summary(spark, d):
    x = composed_drafts(spark, d)
    views = {"lessons": x, "section_outline": indexes.section_outline_index(x), "items": indexes.item_table(x), "scripture": indexes.scripture_index(x)}
    return audits.index_cardinality(views)
