"""Citations: verse lists, books carried over a reading's parts, placeholders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dictionaries import BOOK_ALIASES
from ..functions import text as T

NAME = "[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]+"
VERSES = "\\d+(?:-\\d+)?(?:\\s*,\\s*\\d+(?:-\\d+)?)*"
CITATION = f"((?:(?:[123]|I{{1,3}})\\s*)?{NAME}(?:\\s+{NAME})*)\\s+(\\d+):({VERSES})"
CONTINUED = f"(\\d+):({VERSES})"
UNKNOWN = "?"


def alias(book: Column) -> Column:
    """A book as typed in the form of the dictionary: folded, roman numerals as digits."""
    x = T.strip(F.regexp_replace(F.lower(T.strip_accents(book)), f"[{T.SPACE}]+", " "))
    first = F.element_at(F.split(x, " ", 2), 1)
    digit = F.when(first == "i", "1").when(first == "ii", "2").when(first == "iii", "3")
    return F.when(digit.isNull(), x).when(x.contains(" "), F.concat(digit, F.lit(" "), F.element_at(F.split(x, " ", 2), 2))).otherwise(first)


def book_aliases(books: DataFrame) -> DataFrame:
    """(alias, testament, book_standardized) from the table of books (book_name, testament, book_standardized): the names in the form of `alias`."""
    x = books.select(alias(F.col("book_name")).alias("alias"), "testament", "book_standardized").where("alias is not null")
    more = [x.where(F.col("alias") == name).withColumn("alias", F.lit(other)) for other, name in BOOK_ALIASES.items()]
    for m in more:
        x = x.unionByName(m)
    return x.groupBy("alias").agg(F.min(F.struct("testament", "book_standardized")).alias("b")).select("alias", "b.*")


def parts(readings: DataFrame, books: DataFrame, keys: list[str], display: str = "reference_display") -> DataFrame:
    """Each `;` part of a reading with its book (the unknown sign for a book not in the table)."""
    p = readings.select(*keys, F.posexplode(F.split(F.col(display), ";")).alias("part_no", "part"))
    p = p.withColumn("part", T.strip(F.trim(T.strip(F.col("part")), F.lit(".")))).where("part <> ''")
    own = p.withColumn("book", F.nullif(F.regexp_extract("part", CITATION, 1), F.lit(""))).withColumn("alias", alias(F.col("book")))
    known = own.join(book_aliases(books), "alias", "left")
    carry = Window.partitionBy(*keys).orderBy("part_no").rowsBetween(Window.unboundedPreceding, 0)
    said = F.when(F.col("book").isNotNull(), F.coalesce("book_standardized", F.lit(UNKNOWN)))
    test = F.when(F.col("book").isNotNull(), F.coalesce("testament", F.lit(UNKNOWN)))
    group = F.when(F.col("book").isNotNull(), F.lit(0)).otherwise(F.lit(1))
    chapter = F.when(group == 0, F.regexp_extract("part", CITATION, 2)).otherwise(F.regexp_extract("part", CONTINUED, 1))
    verses = F.when(group == 0, F.regexp_extract("part", CITATION, 3)).otherwise(F.regexp_extract("part", CONTINUED, 2))
    return known.select(*keys, "part_no", "part", F.last(said, True).over(carry).alias("book"), F.last(test, True).over(carry).alias("testament"), chapter.alias("chapter"), verses.alias("verses"))


def verse_ranges(verses: Column) -> Column:
    """`a-b, c` as an array of (start, end)."""
    def bounds(v: Column) -> Column:
        ends = F.split(v, "-")
        return F.struct(F.trim(ends[0]).try_cast("int").alias("verse_start"), F.trim(F.element_at(ends, -1)).try_cast("int").alias("verse_end"))

    return F.transform(F.split(verses, "\\s*,\\s*"), bounds)


def parse(readings: DataFrame, books: DataFrame, keys: list[str], display: str = "reference_display") -> DataFrame:
    """(keys, ref_no, testament, book_standardized, chapter, verse_start, verse_end).

    A part without a book continues the book before; an unknown book drops what continues it.
    """
    p = parts(readings, books, keys, display).where((F.col("chapter") != "") & F.col("book").isNotNull() & (F.col("book") != UNKNOWN))
    e = p.select(*keys, "part_no", F.posexplode(verse_ranges(F.col("verses"))).alias("range_no", "r"), "testament", "book", "chapter")
    order = Window.partitionBy(*keys).orderBy("part_no", "range_no")
    return e.select(*keys, F.row_number().over(order).alias("ref_no"), "testament", F.col("book").alias("book_standardized"), F.col("chapter").try_cast("int").alias("chapter"), "r.verse_start", "r.verse_end")


def unresolved(readings: DataFrame, books: DataFrame, keys: list[str], display: str = "reference_display") -> DataFrame:
    """Parts that give no reference."""
    p = parts(readings, books, keys, display)
    return p.where((F.col("chapter") == "") | F.col("book").isNull() | (F.col("book") == UNKNOWN)).select(*keys, "part_no", "part")
