"""Source lines, active page, structure markers and the table of contents.

`lines` tables have publication_id, line_number (from 1) and line. No window holds the lines of a whole publication:
numbers and pages are carried on page-level rows without text, in buckets and then over buckets, and the windows over
lines are per bucket of `BUCKET` lines or per page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dictionaries import MARKER_LABELS
from ..functions import text as T

#: Lines per bucket of windows and interval joins, pages per bucket of running sums.
BUCKET, PAGES = 1024, 256


def latest_pages(pages: DataFrame) -> DataFrame:
    """One extraction of each page: the one with the largest page_id. Ids are picked first, so only kept texts move."""
    kept = pages.groupBy("publication_id", "page_number").agg(F.max("page_id").alias("page_id")).select("page_id")
    return pages.join(kept, "page_id", "left_semi").select("publication_id", "page_number", "text", "page_id")


def page_of(line: Column) -> Column:
    """The number on a page marker line, else null. A look at its first character spares most lines the rest."""
    may_be = F.when(line.rlike(f"^[{T.SPACE}]*+="), line)
    return F.nullif(F.regexp_extract(T.strip(may_be), T.PAGE_MARKER, 1), F.lit("")).try_cast("int")


def marker_page() -> Column:
    return page_of(F.col("line"))


def page_marks(lines: Column) -> Column:
    """(i, page) of the page markers in an array of lines."""
    return marks_of_pages(F.transform(lines, page_of))


def marks_of_pages(pages: Column) -> Column:
    """The same from what page_of gives for each line."""
    return F.filter(F.transform(pages, lambda v, i: F.struct(i.alias("i"), v.alias("page"))), lambda m: m["page"].isNotNull())


def last_page(marks: Column) -> Column:
    return F.try_element_at(marks, F.lit(-1))["page"]


def numbered_lines(blocks: DataFrame, *keys: str) -> DataFrame:
    """The lines of blocks (keys, before, carried, marks, block_lines), which have some: `before` counts the lines before a block, `carried` is the page they end with.

    The outer explode spares a filter that would build each array once more.
    """
    rows = blocks.select(*keys, "before", "carried", "marks", F.posexplode_outer("block_lines").alias("pos", "line"))

    def page_at(pos: Column) -> Column:
        # most blocks have one marker, their first line: no search there
        found = F.when(F.size("marks") == 1, F.when(F.col("marks")[0]["i"] <= pos, F.col("marks")[0]["page"])).when(F.size("marks") > 1, last_page(F.filter("marks", lambda m: m["i"] <= pos)))
        return F.coalesce(found, "carried")

    return rows.select(*keys, (F.col("before") + F.col("pos") + 1).cast("int").alias("line_number"), "line", page_at(F.col("pos")).alias("active_page"), page_at(F.col("pos") - 1).alias("page_before"))


def lines_of_pages(pages: DataFrame) -> DataFrame:
    """The lines of each publication as one text: per page its marker line, then the lines of its latest extraction.

    Adds active_page, the page of the last marker up to a line, and page_before, that of the line before. Pages
    without a number come first and have no page. Texts move once, to meet their page's line number.
    """
    header = F.coalesce(T.page_header(F.col("page_number")), F.lit("===== PDF_PAGE null ====="))
    x = pages.select("page_id", "publication_id", "page_number", F.concat(F.array(header), F.coalesce(T.lines(F.col("text")), F.array().cast("array<string>"))).alias("block_lines"))
    x = x.withColumn("marks", page_marks(F.col("block_lines")))
    last = last_page(F.col("marks"))
    at = F.coalesce("page_number", F.lit(-(2**31)))
    sizes = x.select("page_id", "publication_id", at.alias("at"), F.size("block_lines").alias("n"), last.alias("page"))
    sizes = sizes.groupBy("publication_id", "at").agg(F.max_by(F.struct("page_id", "n", "page"), "page_id").alias("x")).select("publication_id", "at", "x.*", F.floor(F.col("at") / PAGES).alias("bucket"))
    earlier = Window.partitionBy("publication_id", "bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    pages_ = sizes.withColumn("inside", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("page_inside", F.last("page", True).over(earlier))
    buckets = sizes.groupBy("publication_id", "bucket").agg(F.sum("n").alias("total"), F.max_by("page", F.when(F.col("page").isNotNull(), F.col("at"))).alias("page"))
    before = Window.partitionBy("publication_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(F.col("publication_id").alias("p"), F.col("bucket").alias("b"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("outside"), F.last("page", True).over(before).alias("page_outside"))
    starts = pages_.join(buckets, F.col("publication_id").eqNullSafe(F.col("p")) & (F.col("bucket") == F.col("b"))).select("page_id", (F.col("inside") + F.col("outside")).alias("before"), F.coalesce("page_inside", "page_outside").alias("carried"))
    # texts are never the side that is broadcast or sorted
    return numbered_lines(x.join(starts.hint("shuffle_hash"), "page_id"), "publication_id", "page_number")


def lines_of_texts(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The lines of whole texts, keyed as publications."""
    each = texts.select(F.col(key).alias("publication_id"), F.posexplode_outer(T.lines(F.col(text))).alias("pos", "line"))
    return each.where("pos is not null").select("publication_id", (F.col("pos") + 1).alias("line_number"), "line")


def bucket(column: str = "line_number") -> Column:
    return F.floor(F.col(column) / BUCKET).alias("bucket")


def with_active_page(lines: DataFrame) -> DataFrame:
    """Adds active_page, the page of the last marker up to a line, and page_before, that of the line before, where they are not there yet."""
    if "active_page" in lines.columns:
        return lines
    x = lines.withColumn("marked", marker_page()).withColumn("bucket", bucket())
    upto = Window.partitionBy("publication_id", "bucket").orderBy("line_number").rowsBetween(Window.unboundedPreceding, 0)
    ends = x.where("marked is not null").groupBy("publication_id", "bucket").agg(F.max_by("marked", "line_number").alias("page"))
    buckets = x.select("publication_id", "bucket").distinct().join(ends, ["publication_id", "bucket"], "left")
    before = Window.partitionBy("publication_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("publication_id", "bucket", F.last("page", True).over(before).alias("carried"))
    x = x.withColumn("inside", F.last("marked", True).over(upto)).withColumn("inside_before", F.last("marked", True).over(upto.rowsBetween(Window.unboundedPreceding, -1)))
    return x.join(buckets, ["publication_id", "bucket"]).select(*lines.columns, F.coalesce("inside", "carried").alias("active_page"), F.coalesce("inside_before", "carried").alias("page_before"))


def next_line(points: DataFrame, targets: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds to each point (keys, line_number, more) as `name` the smallest line_number of the targets of equal keys that is not before it.

    An as-of join: within buckets of lines by a window, then over buckets by one of at most one row per bucket.
    """
    more = [c for c in points.columns if c not in (*keys, "line_number")]
    kind = "struct<" + ",".join(f"`{c}`:{points.schema[c].dataType.simpleString()}" for c in more) + ">"
    own = points.select(*keys, "line_number", F.lit(1).alias("kind"), F.struct(*more).alias("more")) if more else points.select(*keys, "line_number", F.lit(1).alias("kind"), F.lit(None).cast("struct<x:int>").alias("more"))
    both = own.unionByName(targets.select(*keys, "line_number").distinct().select(*keys, "line_number", F.lit(0).alias("kind"), F.lit(None).cast(kind if more else "struct<x:int>").alias("more"))).withColumn("bucket", bucket())
    behind = Window.partitionBy(*keys, "bucket").orderBy(F.desc("line_number"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("inside", F.last(F.when(F.col("kind") == 0, F.col("line_number")), True).over(behind))
    buckets = both.groupBy(*keys, "bucket").agg(F.min(F.when(F.col("kind") == 0, F.col("line_number"))).alias("first"))
    later = Window.partitionBy(*keys).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*keys, "bucket", F.last("first", True).over(later).alias("outside"))
    out = both.where("kind = 1").join(buckets, [*keys, "bucket"])
    return out.select(*keys, "line_number", *[F.col(f"more.`{c}`").alias(c) for c in more], F.coalesce("inside", "outside").alias(name))


def lines_within(lines: DataFrame, intervals: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """Each line (publication_id, line_number, more) with each interval (publication_id, low, high, more) it lies in.

    An equi-join on publication and bucket of lines; its size is that of the result, up to a bucket at either end.
    An interval without end, or with one behind the text, ends with the publication.
    """
    ends = lines.groupBy("publication_id").agg(F.max("line_number").alias("end"))
    x = intervals.join(ends, "publication_id").withColumn(high, F.least(F.coalesce(F.col(high), F.col("end")), F.col("end"))).drop("end").where(F.col(low) <= F.col(high))
    x = x.withColumn("bucket", F.explode(F.sequence(F.floor(F.col(low) / BUCKET), F.floor(F.col(high) / BUCKET))))
    return lines.withColumn("bucket", bucket()).join(x, ["publication_id", "bucket"]).where((F.col("line_number") >= F.col(low)) & (F.col("line_number") <= F.col(high))).drop("bucket")


LESSON_HEADER = "(?iu)^\\s*LECCI[OÓ]N\\s+(\\d+)(?![\\p{L}\\p{N}_])"


def markers(lines: DataFrame) -> DataFrame:
    """(publication_id, line_number, marker_type, text): page markers where the page changes, lesson headers, labels."""
    kind = (
        F.when(F.col("active_page").isNotNull() & (F.col("page_before").isNull() | (F.col("active_page") != F.col("page_before"))), "page_marker")
        .when(F.col("line").rlike(LESSON_HEADER), "lesson_header")
        .when(T.starts_folded(F.col("line"), MARKER_LABELS), "section_label")
    )
    return with_active_page(lines).withColumn("marker_type", kind).where("marker_type is not null").select("publication_id", "line_number", "marker_type", T.strip(F.col("line")).alias("text"))


ENTRY = "^(\\d{1,3})\\.\\s*(.+)$"


def contents_candidates(lines: DataFrame) -> DataFrame:
    """(publication_id, page, signals, rank): pages with a contents label, most table-like first."""
    s = T.strip(F.col("line"))
    paged = with_active_page(lines).where(F.col("active_page").isNotNull() & marker_page().isNull())
    signal = F.when(F.col("line").rlike(f"^[{T.SPACE}]*+\\d") & (s.rlike(T.DATE) | s.rlike(ENTRY)), 1).otherwise(0)
    per = paged.groupBy("publication_id", F.col("active_page").alias("page")).agg(F.bool_or(T.is_contents_label(F.col("line"))).alias("labelled"), F.sum(signal).alias("signals"))
    w = Window.partitionBy("publication_id").orderBy(F.desc("signals"), "page")
    return per.where("labelled").select("publication_id", "page", "signals", F.row_number().over(w).alias("rank"))


ENTRY_END = "^(.*?)(\\d{1,4})\\s*$"
#: What `.` does not match, so that a text that holds it has no ENTRY_END, and what is left of a title by clean_title.
BREAK, NAMED = "[\n\r\x85\u2028\u2029]", f"[^{T.SPACE}.]"


def contents_rows(lines: DataFrame, candidates: DataFrame) -> DataFrame:
    """Lessons parsed from every candidate page.

    An entry starts at `n. rest` and ends at the first line on which the text so far ends in a page number;
    it takes the last date line since the entry before. Lines after its end are ignored until the next start, and
    there may be any number of them (numbers above 999 start no entry), so where an entry ends is told from each line
    alone and from two flags of the lines before, and only texts of entries that end are put together, once.
    """
    s = T.strip(F.col("line"))
    rows = (
        with_active_page(lines)
        .where(marker_page().isNull())
        .join(candidates.select("publication_id", F.col("page").alias("active_page"), "rank"), ["publication_id", "active_page"])
        .withColumn("s", s)
        .where((F.col("s") != "") & ~T.is_contents_label(F.col("s")))
    )
    page = Window.partitionBy("publication_id", "active_page").orderBy("line_number").rowsBetween(Window.unboundedPreceding, 0)
    is_date = F.col("s").rlike(T.DATE)
    rows = rows.withColumn("is_date", is_date).withColumn("is_start", ~F.col("is_date") & F.col("s").rlike(ENTRY))
    rows = rows.withColumn("entry", F.sum(F.col("is_start").cast("int")).over(page))
    body = F.when(F.col("is_start"), F.regexp_extract("s", ENTRY, 2)).when(~F.col("is_date"), F.col("s"))
    rows = rows.withColumn("body", body)
    within = Window.partitionBy("publication_id", "active_page", "entry").orderBy("line_number")
    broken = F.max(F.col("body").rlike(BREAK)).over(within.rowsBetween(Window.unboundedPreceding, 0))
    named = F.max(F.col("body").rlike(NAMED)).over(within.rowsBetween(Window.unboundedPreceding, -1))
    ends = F.col("body").rlike(ENTRY_END) & (F.coalesce(named, F.lit(False)) | F.regexp_extract("body", ENTRY_END, 1).rlike(NAMED))
    rows = rows.withColumn("done", (F.col("entry") > 0) & ~F.col("is_date") & ~broken & ends)
    first = F.min(F.when(F.col("done"), F.col("line_number"))).over(Window.partitionBy("publication_id", "active_page", "entry"))
    rows = rows.withColumn("first", first).withColumn("completes", F.col("done") & (F.col("line_number") == F.col("first")))
    earlier = Window.partitionBy("publication_id", "active_page").orderBy("line_number").rowsBetween(Window.unboundedPreceding, -1)
    last_date = F.last(F.when(F.col("is_date"), F.struct("line_number", "s")), True).over(page)
    last_done = F.last(F.when(F.col("completes"), F.col("line_number")), True).over(earlier)
    rows = rows.withColumn("d", last_date).withColumn("p", last_done).where("line_number <= first")
    said = F.array_sort(F.collect_list(F.when(F.col("body").isNotNull(), F.struct("line_number", "body"))))
    out = rows.groupBy("publication_id", "active_page", "rank", "entry").agg(
        F.max("line_number").alias("line_number"),
        F.max(F.when(F.col("is_start"), F.regexp_extract("s", ENTRY, 1))).alias("number"),
        F.array_join(F.transform(said, lambda x: x["body"]), " ").alias("said"),
        F.max_by(F.struct("d", "p"), "line_number").alias("at"),
    )
    return out.select(
        "publication_id",
        F.col("active_page").alias("contents_page"),
        "rank",
        "line_number",
        F.col("number").try_cast("int").alias("lesson_number"),
        T.clean_title(F.regexp_extract("said", ENTRY_END, 1)).alias("title"),
        F.regexp_extract("said", ENTRY_END, 2).try_cast("int").alias("page_start"),
        F.when(F.col("at.p").isNull() | (F.col("at.d.line_number") > F.col("at.p")), F.col("at.d.s")).alias("lesson_date"),
    )


def contents_index(rows: DataFrame) -> DataFrame:
    """The rows of each publication's first candidate page that has any."""
    best = F.min("rank").over(Window.partitionBy("publication_id"))
    return rows.withColumn("best", best).where("rank = best").select("publication_id", "contents_page", "line_number", "lesson_number", "title", "page_start", "lesson_date")


def reflow(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, paragraph, first_line, text) of each text: neighbouring lines joined unless a structural or blank line parts them.

    Page markers are structural, so the paragraphs of a publication are those of its pages and a page is the unit.
    Blank paragraphs count but are left out.
    """
    x = texts.select(key, F.posexplode_outer(T.reflow_lines(T.lines(F.col(text)))).alias("pos", "p"))
    return x.select(key, (F.col("pos") + 1).cast("bigint").alias("paragraph"), F.col("p.first_line").alias("first_line"), F.col("p.text").alias("text")).where("text <> ''")


def normalized_pages(pages: DataFrame) -> DataFrame:
    """(publication_id, page_number, page_id, text): the normalized text of each page's latest extraction."""
    return latest_pages(pages).withColumn("text", T.normalize(F.col("text")))
