"""Draft lessons as nested rows and their validation against the declared contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as X

from ..dictionaries import LESSON_SECTIONS, NESTED_FIELDS, PLACEHOLDER_PREFIXES, PLACEHOLDERS, ROOT_FIELDS
from ..functions import text as T

CYCLE, LANGUAGE, SCHEMA_VERSION = "C1", "es", "1.0.0"
PENDING = "1970-01-01T00:00:00+00:00"
# Fixed value: the digest of a source file that is not there.
NO_FILE = "pending-source-file-verification"
TRACED = ("biblical_reading", "lesson_outline", "teacher_notes", "summary_application")
REFERENCE = "struct<testament:string,book_standardized:string,chapter:int,verse_start:int,verse_end:int>"


def lesson_year(segments: DataFrame, year: int) -> DataFrame:
    """publication_id and year: 2024 if any date ends in /24, else the given year."""
    return segments.groupBy("publication_id").agg(F.when(F.bool_or(F.coalesce(F.col("lesson_date").endswith("/24"), F.lit(False))), 2024).otherwise(year).cast("int").alias("year"))


def placeholder_reference() -> Column:
    return F.array(F.struct(F.lit("TBD").alias("testament"), F.lit("TBD").alias("book_standardized"), F.lit(0).alias("chapter"), F.lit(0).alias("verse_start"), F.lit(0).alias("verse_end"))).cast(f"array<{REFERENCE}>")


def or_tbd(items: Column) -> Column:
    """Non-blank items, or the one placeholder."""
    kept = F.filter(F.transform(items, T.strip), lambda x: x != "")
    return F.when(items.isNull() | (F.size(kept) == 0), F.array(F.lit("TBD"))).otherwise(kept)


def draft_lessons(segments: DataFrame, readings: DataFrame, items: DataFrame, year: int = 2024, imported_at: str | None = None, previous: DataFrame | None = None, traces: DataFrame | None = None, digests: DataFrame | None = None) -> DataFrame:
    """One nested lesson per segment.

    readings: publication_id, lesson_number, reference_display, canonical_references.
    items: publication_id, lesson_number, section, items (array). previous: lesson key and imported_at of an
    earlier snapshot, which wins over the default but not over imported_at. traces: lesson key, section, line_start,
    line_end, page_start, page_end. digests: publication_id and sha256 of its source file.
    """
    key = ["publication_id", "lesson_number"]
    wide = items.groupBy(*key).pivot("section", ["lesson_outline", "teacher_notes", "summary_application"]).agg(F.first("items"))
    order = Window.partitionBy("publication_id").orderBy("lesson_number", "start_line")
    following = F.lead("expected_page_start").over(order)
    x = segments.withColumn("following", following).join(readings.select(*key, "reference_display", "canonical_references"), key, "left").join(wide, key, "left").join(lesson_year(segments, year), "publication_id")
    if previous is not None:
        x = x.join(previous.select(*key, F.col("imported_at").alias("kept_at")), key, "left")
    else:
        x = x.withColumn("kept_at", F.lit(None).cast("string"))
    trace = "struct<line_start:int,line_end:int,page_start:int,page_end:int>"
    if traces is not None:
        t = traces.groupBy(*key).pivot("section", list(TRACED)).agg(F.first(F.struct("line_start", "line_end", "page_start", "page_end").cast(trace)))
        x = x.join(t.select(*key, *[F.col(n).alias(f"trace_{n}") for n in TRACED]), key, "left")
    else:
        x = x.withColumns({f"trace_{n}": F.lit(None).cast(trace) for n in TRACED})
    if digests is not None:
        x = x.join(digests.groupBy("publication_id").agg(F.max("sha256").alias("sha256")), "publication_id", "left")
    else:
        x = x.withColumn("sha256", F.lit(None).cast("string"))
    stamp = F.coalesce(F.lit(imported_at).cast("string"), "kept_at", F.lit(PENDING))
    start = F.coalesce(F.nullif("page_start", F.lit(0)), F.nullif("expected_page_start", F.lit(0)), F.lit(0))
    end = F.coalesce(F.nullif("page_end", F.lit(0)), F.greatest(start, F.coalesce(F.col("following"), start + 1) - 1))
    title = F.coalesce(F.nullif("expected_title", F.lit("")), F.concat(F.lit("Lesson "), F.col("lesson_number").cast("string")))
    used = F.col("reference_display").isNotNull() | F.col("lesson_outline").isNotNull() | F.col("teacher_notes").isNotNull() | F.col("summary_application").isNotNull()
    display = F.coalesce(F.nullif(T.strip(F.col("reference_display")), F.lit("")), F.lit("TBD"))
    references = F.when(F.size("canonical_references") > 0, F.col("canonical_references").cast(f"array<{REFERENCE}>")).otherwise(placeholder_reference())
    pdf = F.concat(F.col("publication_id"), F.lit(".pdf"))
    s = F.struct
    return x.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.format_string(f"LES-%d-{CYCLE}-%03d", "year", "lesson_number").alias("lesson_id"),
        "publication_id",
        F.lit("adult").alias("collection_type"),
        "year",
        F.lit(CYCLE).alias("cycle"),
        "lesson_number",
        title.alias("title"),
        F.lit(LANGUAGE).alias("language"),
        s(start.alias("start"), end.alias("end")).alias("page_range"),
        s(
            s(F.coalesce(F.nullif("marker", F.lit("")), F.lit("Contenido")).alias("marker"), F.col("lesson_number"), F.coalesce("lesson_date", F.lit("TBD")).alias("lesson_date")).alias("lesson_header"),
            s(title.alias("text")).alias("title"),
            s(
                display.alias("reference_display"),
                references.alias("canonical_references"),
                s(F.lit("api.bible").alias("provider"), F.lit("replace_by_canonical_reference").alias("strategy"), F.lit(False).alias("source_text_included")).alias("replacement_policy"),
            ).alias("biblical_reading"),
            s(or_tbd(F.col("lesson_outline")).alias("items")).alias("lesson_outline"),
            s(or_tbd(F.col("teacher_notes")).alias("items")).alias("teacher_notes"),
            s(or_tbd(F.col("summary_application")).alias("items")).alias("summary_application"),
        ).alias("lesson_sections"),
        s(
            stamp.alias("intake_date"),
            F.lit("PyMuPDF").alias("ocr_engine"),
            F.lit("pending-version-capture").alias("ocr_engine_version"),
            F.lit("pdf_text_extraction").alias("extraction_method"),
            F.when(used, "automated-unreviewed").otherwise("minimal-valid-placeholder").alias("extraction_confidence"),
            F.lit(True).alias("manual_review_required"),
            F.lit("pending-human-review").alias("reviewed_by"),
            F.when(used, "automated_unreviewed").otherwise("pending").alias("review_status"),
        ).alias("processing_audit"),
        s(pdf.alias("original_filename"), F.coalesce("sha256", F.lit(NO_FILE)).alias("sha256"), stamp.alias("imported_at"), F.lit("pending-human-review").alias("source_scan_quality")).alias("source_integrity"),
        s(*[F.lit(v).alias(k) for k, v in zip(NESTED_FIELDS["processing_status"], (True, True, True, False, False, True, False), strict=True)]).alias("processing_status"),
        s(pdf.alias("source_pdf"), start.alias("page_start"), end.alias("page_end"), F.coalesce("start_line", F.lit(0)).alias("line_start"), F.coalesce("end_line", F.lit(0)).alias("line_end"), F.col("publication_id").alias("extraction_block"), s(*[F.col(f"trace_{n}").alias(n) for n in TRACED]).alias("section_traces")).alias("source_trace"),
        s(F.array(F.lit("TBD")).alias("doctrinal_categories"), F.array(F.lit("TBD")).alias("theological_themes"), F.lit("adult").alias("educational_level"), F.lit("adult").alias("intended_audience")).alias("semantic_metadata"),
    )


def _type(schema: X.DataType, path: str) -> X.DataType | None:
    for name in path.split("."):
        if not isinstance(schema, X.StructType) or name not in schema.names:
            return None
        schema = schema[name].dataType
    return schema


def is_missing(kind: X.DataType | None, path: str) -> Column:
    """Null, a blank string, an empty list or map; 0 and false are present."""
    if kind is None:
        return F.lit(True)
    c = F.col(path)
    if isinstance(kind, X.StringType):
        return c.isNull() | (T.strip(c) == "")
    if isinstance(kind, (X.ArrayType, X.MapType)):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull()


def contract_paths() -> list[tuple[str, str]]:
    """(rule, path) of every required field in the order they are checked."""
    out = [("root", f) for f in ROOT_FIELDS]
    out += [("nested", f"{parent}.{f}") for parent, fields in NESTED_FIELDS.items() for f in fields]
    return out + [("section", f"lesson_sections.{name}.{f}") for name, fields in LESSON_SECTIONS.items() for f in fields]


def missing_fields(lessons: DataFrame, key: list[str]) -> DataFrame:
    """(key, position, rule, path) of every required field that is missing."""
    checks = [F.when(is_missing(_type(lessons.schema, p), p), F.struct(F.lit(i).alias("position"), F.lit(r).alias("rule"), F.lit(p).alias("path"))) for i, (r, p) in enumerate(contract_paths())]
    return lessons.select(*key, F.explode(F.array_compact(F.array(*checks))).alias("m")).select(*key, "m.*")


def reading_errors(lessons: DataFrame, key: list[str]) -> DataFrame:
    """(key, position, error) of the reading policy."""
    r = "lesson_sections.biblical_reading"
    policy, refs = f"{r}.replacement_policy", F.col(f"{r}.canonical_references")
    tests = [
        ("provider", ~F.col(f"{policy}.provider").eqNullSafe("api.bible")),
        ("strategy", ~F.col(f"{policy}.strategy").eqNullSafe("replace_by_canonical_reference")),
        ("source_text_included", ~F.col(f"{policy}.source_text_included").eqNullSafe(False)),
        ("canonical_references", refs.isNull() | (F.size(refs) == 0)),
        ("reference_fields", F.exists(refs, lambda x: x["testament"].isNull() | (F.trim(x["testament"]) == "") | x["book_standardized"].isNull() | (F.trim(x["book_standardized"]) == ""))),
        ("positive_integers", F.exists(refs, lambda x: F.coalesce(x["chapter"], F.lit(0)).cast("int") <= 0)),
        ("positive_integers", F.exists(refs, lambda x: (F.coalesce(x["verse_start"], F.lit(0)) <= 0) | (F.coalesce(x["verse_end"], F.lit(0)) <= 0))),
    ]
    checks = [F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(i).alias("position"), F.lit(n).alias("error"))) for i, (n, c) in enumerate(tests)]
    return lessons.select(*key, F.explode(F.array_compact(F.array(*checks))).alias("m")).select(*key, "m.*")


def string_leaves(schema: X.DataType, path: str = "") -> list[tuple[str, str]]:
    """(path, 'one' or 'many') of every string in a nested type: in structs, arrays of any depth and the values of maps."""
    return [(p, kind) for p, kind, _ in _leaves(schema, path)]


def _leaves(kind: X.DataType, path: str):
    """(path, 'one' or 'many', function of the value at the path's start to the array of its strings)."""
    if isinstance(kind, X.StringType):
        return [(path, "one", lambda c: F.array(c))]
    if isinstance(kind, X.StructType):
        out = []
        for f in kind.fields:
            for p, n, fn in _leaves(f.dataType, f"{path}.{f.name}" if path else f.name):
                out.append((p, n, lambda c, fn=fn, name=f.name: fn(c.getField(name) if path else F.col(f"`{name}`"))))
        return out
    if isinstance(kind, X.ArrayType):
        return [(p, "many", lambda c, fn=fn: F.flatten(F.transform(c, lambda v: fn(v)))) for p, _, fn in _leaves(kind.elementType, path)]
    if isinstance(kind, X.MapType):
        return [(p, "many", lambda c, fn=fn: F.flatten(F.transform(F.map_values(c), lambda v: fn(v)))) for p, _, fn in _leaves(kind.valueType, path)]
    return []


def is_placeholder(c: Column) -> Column:
    out = c.isin(*PLACEHOLDERS)
    for p in PLACEHOLDER_PREFIXES:
        out = out | F.lower(c).startswith(p)
    return out


def placeholders(lessons: DataFrame, key: list[str]) -> DataFrame:
    """(key, path, value) of every string that only holds a place, anywhere in the document."""

    none = F.array().cast("array<string>")

    def leaf(path: str, values: Column) -> Column:
        return F.transform(F.coalesce(values, none), lambda v: F.struct(F.lit(path).alias("path"), v.alias("value")))

    leaves = [leaf(path, fn(None)) for path, _, fn in _leaves(lessons.schema, "")]
    flat = lessons.select(*key, F.explode(F.concat(*leaves)).alias("leaf")).select(*key, "leaf.*")
    return flat.where(F.col("value").isNotNull() & is_placeholder(F.col("value")))


def first_error(lessons: DataFrame, key: list[str]) -> DataFrame:
    """(key, error): each lesson's first error in the order root, nested, section, reading, placeholder; null if valid."""
    miss = missing_fields(lessons, key).select(*key, F.col("position").cast("bigint").alias("at"), F.concat(F.lit("missing "), "path").alias("error"))
    read = reading_errors(lessons, key).select(*key, (F.col("position") + 10_000).cast("bigint").alias("at"), F.concat(F.lit("reading "), "error").alias("error"))
    hold = placeholders(lessons, key).select(*key, F.lit(20_000).cast("bigint").alias("at"), F.lit("placeholder value").alias("error"))
    per = miss.unionByName(read).unionByName(hold).groupBy(*key).agg(F.min_by("error", "at").alias("error"))
    return lessons.select(*key).join(per, key, "left")


def gate(lessons: DataFrame, key: list[str]) -> DataFrame:
    """One row (n_lessons, n_invalid, may_index): official indexes are only built when every lesson is valid."""
    x = first_error(lessons, key).agg(F.count("*").alias("n_lessons"), F.count("error").alias("n_invalid"))
    return x.withColumn("may_index", F.col("n_invalid") == 0)


def all_valid(lessons: DataFrame, key: list[str]) -> bool:
    """The gate before reviewed indexes: no lesson has an error."""
    return first_error(lessons, key).where("error is not null").isEmpty()


def draft_paths(lessons: DataFrame) -> DataFrame:
    return lessons.select("publication_id", "lesson_number", F.format_string("%s/%d/%s/%s.yaml", "publication_id", "year", "cycle", "lesson_id").alias("path"))


def duplicate_paths(lessons: DataFrame) -> DataFrame:
    return draft_paths(lessons).groupBy("path").agg(F.count("*").alias("n")).where("n > 1")


def with_paths(lessons: DataFrame) -> DataFrame:
    """Lessons with their draft path; two of one path are an error, since one would overwrite the other."""
    twice = duplicate_paths(lessons).orderBy("path").first()
    if twice:
        raise ValueError(f"{twice['n']} lessons have the draft path {twice['path']}")
    return lessons.withColumn("path", F.format_string("%s/%d/%s/%s.yaml", "publication_id", "year", "cycle", "lesson_id"))
