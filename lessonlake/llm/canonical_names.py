"""Problem 1: mapping free-entered names to a canonical list.

Token-level repair, then soft TF-IDF, in DataFrames only. Distinct typed names are cut into tokens;
each distinct token is joined to the reference vocabulary through deletion neighbourhoods (an equi-join
that finds every pair within two edits), prefixes and consonant skeletons, and keeps a similarity. An entry
of the list is then ranked by the soft TF-IDF cosine of its tokens and the repaired tokens; it must have all
of its tokens repaired, or at least a name of four letters if no entry has. Typed names without such an
entry get id 0 and are reported.

Rows are expanded to distinct names before anything is joined, so repeated deliveries and a name that holds
a third of all rows cost one row each; the reference list is a fixed table whose size Spark checks before
broadcasting it. Defined results: null or blank references have no parts; ties go to the smaller id; an
empty list gives id 0 everywhere; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import cut
from .chars import LOOKALIKE

BLANKS = "\xa0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + BLANKS
PLAIN = "".join(chr(c) for c in range(0x21, 0x7F)) + " " * len(BLANKS)
ACCENTS, BARE = "áàâäãéèêëíìîïóòôöõúùûüñç", "aaaaaeeeeiiiiooooouuuunc"
IGNORABLE = "[­͏​-‏‪-‮⁠-⁤﻿̀-ͯ]"

# Ways to write the number of a book.
ORDINALS = {
    "1": "1 1ra 1a 1er 1ro 1o 1st i primera primer primero first",
    "2": "2 2da 2a 2do 2o 2nd ii segunda segundo second",
    "3": "3 3ra 3a 3er 3ro 3o 3rd iii tercera tercer tercero third",
}
# Letter groups that print is misread as, with the letter meant.
GLYPHS = (("ii", "u"), ("ri", "n"), ("rn", "m"), ("lvl", "m"), ("cl", "d"), ("vv", "w"))
# Words that may stand after a name and before a chapter.
AFTER = ("cap", "caps", "capitulo", "capitulos")


def parts(readings: DataFrame, key: str = "reading_id", text: str = "reference_display") -> DataFrame:
    """(key, part_no, part, typed): the non-blank pieces between semicolons and their text before the chapter, '' if none."""
    pieces = F.filter(F.split(F.col(text), ";"), lambda x: F.regexp_replace(x, "(?U)[\\s\\p{Cf}]+", "") != "")
    out = readings.select(key, F.posexplode(pieces).alias("at", "part"))
    plain = F.translate("part", WIDE, PLAIN)
    head = F.regexp_extract(plain, r"^(.*?\p{L}.*?)\s*(?:\d+(?:\s*[:.]\s*\d[\d\s,.:–—-]*)?)?[\s.,)\]]*$", 1)
    return out.select(key, (F.col("at") + 1).alias("part_no"), "part", F.regexp_replace(F.substring(F.col("part"), F.lit(1), F.length(head)), r"(?U)^\s+|\s+$", "").alias("typed"))


def tokens(name: Column) -> Column:
    """The folded tokens of a name: one case, width and script, no accents, ordinals as digits, glyphs as letters."""
    x = F.lower(F.translate(F.regexp_replace(name, IGNORABLE, ""), WIDE, PLAIN))
    x = F.translate(F.translate(x, "".join(LOOKALIKE), "".join(LOOKALIKE.values())), ACCENTS, BARE)
    x = F.translate(F.lower(x), ACCENTS, BARE)
    x = F.regexp_replace(F.regexp_replace(x, "^\\s*([123])(?=[a-z])(?!(?:ra|a|er|ro|o|st|da|do|nd|rd)\\b)", "$1 "), "[^a-z0-9@|$!]+", " ")
    words = F.filter(F.split(F.trim(x), " "), lambda t: t != "")

    def number(t: Column) -> Column:
        out = F.when(F.lit(False), t)
        for digit, ways in ORDINALS.items():
            out = out.when(t.isin(*ways.split()), F.lit(digit))
        return out.when(t.rlike("[a-z@].*[a-z@]"), F.translate(t, "@|$!0156", "alslolsb")).otherwise(t)

    return F.transform(words, number)


def deletions(word: Column) -> Column:
    """A word, what one deletion leaves of it, and what two leave (two only from six letters on)."""

    def without(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))

    one = F.when(F.length(word) >= 3, without(word)).otherwise(F.array().cast("array<string>"))
    two = F.when(F.length(word) >= 6, F.flatten(F.transform(one, without))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(word), one, two))


def skeleton(word: Column) -> Column:
    return F.regexp_replace(word, "[aeiou]", "")


def repairs(typed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, word, sim) for distinct tokens: the reference words each may stand for."""
    near = typed.select("token", F.explode(deletions(F.col("token"))).alias("k")).join(vocabulary.select("word", F.explode(deletions(F.col("word"))).alias("k")), "k").select("token", "word").distinct()
    d = F.levenshtein("token", "word")
    swapped = (d == 2) & (F.array_sort(F.split("token", "")) == F.array_sort(F.split("word", "")))
    dist = F.when(swapped, 1).otherwise(d)
    n = F.greatest(F.length("token"), F.length("word"))
    initial = F.substring("token", 1, 1) == F.substring("word", 1, 1)
    short = F.least(F.length("token"), F.length("word"))
    allowed = F.when(n <= 3, F.when(initial & (short == 3), 1).otherwise(0)).when(n <= 5, 1).when(n <= 6, F.when(initial, 2).otherwise(1)).otherwise(F.when(initial, 3).when(n <= 8, 1).otherwise(2))
    letters = F.col("token").rlike("[a-z]") & F.col("word").rlike("^[a-z]{3,}$")
    edited = near.where((dist == 0) | letters & (dist <= allowed)).select("token", "word", (1 - dist / (n + F.lit(0.0)) * 0.9).alias("sim"))
    starts = vocabulary.where(F.length("word") > 3).select("word", F.explode(F.sequence(F.lit(2), F.length("word") - 1)).alias("n")).select("word", F.substring(F.col("word"), F.lit(1), F.col("n")).alias("token"), F.when(F.col("n") > 2, 0.85).otherwise(0.5).alias("sim"))
    main = vocabulary.where("main and word rlike '^[a-z]{4,}$'").select("word", skeleton(F.col("word")).alias("bone")).where("length(bone) > 2")
    bones = main.select("word", "bone", F.explode(F.sequence(F.lit(2), F.length("bone"))).alias("n"))
    bones = bones.select("word", F.substring(F.col("bone"), F.lit(1), F.col("n")).alias("token"), (F.lit(0.6) + F.col("n") * 0.02).alias("sim")).unionByName(
        bones.where("n > 2").select("word", F.concat(F.substring("bone", 1, 1), F.substring(F.col("bone"), F.col("n"), F.lit(1))).alias("token"), F.lit(0.55).alias("sim"))
    )
    swaps = F.array(*[F.replace("token", F.lit(a), F.lit(b)) for a, b in GLYPHS])
    glyphs = typed.select("token", F.explode(F.array_distinct(swaps)).alias("word")).where("word <> token").join(vocabulary.select("word"), "word").select("token", "word", F.lit(0.9).alias("sim"))
    edited = edited.unionByName(glyphs)
    other = typed.join(starts.unionByName(bones), "token").select("token", "word", "sim")
    return edited.unionByName(other).groupBy("token", "word").agg(F.max("sim").alias("sim"))


def match(typed: DataFrame, entries: DataFrame, entry_id: str, names: list[str]) -> DataFrame:
    """(typed, entry id or 0, score) for each distinct typed name; entries may have several names each."""
    variants = entries.select(F.col(entry_id).alias("id"), F.posexplode(F.array(*names)).alias("at", "name")).where("name is not null").groupBy("id", "name").agg((F.min("at") == 0).alias("main")).select("id", "name", "main", F.array_distinct(tokens(F.col("name"))).alias("words"))
    words = variants.select("id", "name", "main", F.explode("words").alias("word"), F.size("words").alias("size"))
    size = entries.select(F.count_distinct(entry_id)).first()[0]
    vocabulary = words.groupBy("word").agg(F.count_distinct("id").alias("df"), F.max("main").alias("main")).select("word", "main", F.log(1 + size / F.col("df")).alias("w"))
    vocabulary = cut(vocabulary)
    names_ = cut(typed.select("typed").where("typed is not null").distinct())
    said = names_.select("typed", F.array_distinct(F.filter(tokens(F.col("typed")), lambda t: ~t.isin(*AFTER))).alias("said"))
    letters = F.filter("said", lambda t: t.rlike("[a-z@]"))
    each = said.select("typed", F.element_at(F.concat(F.array(F.lit("")), letters), -1).alias("last"), F.size(letters).alias("n_words"), F.posexplode("said").alias("pos", "token"))
    each = cut(each)  # each step below starts from one row per distinct name and token
    fixes = repairs(each.select("token").distinct(), vocabulary)
    each = each.join(vocabulary.select(F.col("word").alias("token"), F.col("w").alias("own")), "token", "left").withColumn("own", F.coalesce("own", F.lit(2.0)))
    weight = each.groupBy("typed").agg(F.sqrt(F.sum(F.col("own") ** 2)).alias("q"))
    norm = words.join(vocabulary, "word").groupBy("id", "name").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("e"))
    best = (
        each.join(fixes, "token")
        .where((F.length("token") > 3) | F.col("token").rlike("^[0-9]$") | (F.col("token") == F.col("last")) & ((F.length("token") > 2) | (F.col("n_words") == 1) | (F.col("sim") == 1)))
        .join(words, "word")
        .join(vocabulary.drop("main"), "word")
        .groupBy("typed", "id", "name", "size", "word")
        .agg(F.max_by(F.struct("sim", "w", "own", "pos"), F.col("sim") * 1000 - F.col("pos")).alias("x"))
        .select("typed", "id", "name", "size", "word", "x.*")
        .groupBy("typed", "id", "name", "size")
        .agg(F.count("*").alias("covered"), F.sum(F.col("w") * F.col("own") * F.col("sim")).alias("dot"), F.min(F.when(F.col("word").rlike("[a-z]"), F.col("pos"))).alias("pos"), F.max(F.when(F.length("word") > 3, 1).otherwise(0)).alias("long"), F.max(F.when(F.col("word").rlike("[a-z]"), 1).otherwise(0)).alias("named"))
        .where((F.col("named") == 1) & ((F.col("covered") == F.col("size")) | (F.col("long") == 1)))
        .join(norm, ["id", "name"])
        .join(weight, "typed")
        .withColumn("score", F.col("dot") / (F.col("q") * F.col("e")))
    )
    first = Window.partitionBy("typed").orderBy(F.desc(F.col("covered") == F.col("size")), F.desc(F.round("score", 6)), "pos", "id")
    top = best.withColumn("rank", F.row_number().over(first)).where("rank = 1").select("typed", "id", "score")
    return names_.join(top, "typed", "left").select("typed", F.coalesce("id", F.lit(0)).cast("int").alias("id"), F.coalesce("score", F.lit(0.0)).alias("score"))


def cases(readings: DataFrame, books: DataFrame, names: list[str]) -> DataFrame:
    """The parts whose typed name is not exactly one of the list's."""
    exact = books.select(F.explode(F.array(*names)).alias("typed")).where("typed is not null").distinct()
    return parts(readings).where("typed <> ''").join(exact, "typed", "left_anti")


BOOK_NAMES = ["book_name", "book_standardized", "abbreviation"]


def found(readings: DataFrame, books: DataFrame) -> DataFrame:
    """(reading_id, part_no, book_id) of every part that needs mapping; 0 where no book is meant."""
    todo = cut(cases(readings, books, BOOK_NAMES))
    return todo.join(match(todo, books, "book_id", BOOK_NAMES), "typed").select("reading_id", "part_no", F.col("id").alias("book_id"))


def resolved(readings: DataFrame, books: DataFrame) -> DataFrame:
    """Every part with its book, continuing parts included, so that canonical_references can be filled."""
    all_parts = parts(readings)
    exact = books.select(F.explode(F.array(*BOOK_NAMES)).alias("typed"), F.col("book_id").alias("exact_id")).groupBy("typed").agg(F.min("exact_id").alias("exact_id"))
    mapped = match(cases(readings, books, BOOK_NAMES), books, "book_id", BOOK_NAMES)
    own = all_parts.join(exact, "typed", "left").join(mapped, "typed", "left").withColumn("own", F.when(F.col("typed") == "", None).otherwise(F.coalesce("exact_id", "id", F.lit(0))))
    carry = Window.partitionBy("reading_id").orderBy("part_no").rowsBetween(Window.unboundedPreceding, 0)
    said = own.withColumn("book_id", F.coalesce(F.last("own", True).over(carry), F.lit(0)))
    numbers = F.regexp_extract(F.translate("part", WIDE, PLAIN), r"(\d+)\s*[:.]\s*(\d[\d\s,.–-]*)[\s.,)\]]*$", 1)
    verses = F.regexp_replace(F.regexp_extract(F.translate("part", WIDE, PLAIN), r"(\d+)\s*[:.]\s*(\d[\d\s,.–-]*)[\s.,)\]]*$", 2), "[\\s.]+$", "")
    return said.join(books.select("book_id", "testament", "book_standardized"), "book_id", "left").select("reading_id", "part_no", "typed", "book_id", "testament", "book_standardized", F.nullif(numbers, F.lit("")).try_cast("int").alias("chapter"), F.nullif(verses, F.lit("")).alias("verses"))


def unmatched(readings: DataFrame, books: DataFrame) -> DataFrame:
    """(typed, n_parts): what names no listed book, with how often it was typed."""
    todo = cut(cases(readings, books, BOOK_NAMES))
    missing = match(todo, books, "book_id", BOOK_NAMES).where("id = 0").select("typed")
    return todo.join(missing, "typed", "left_semi").groupBy("typed").agg(F.count("*").alias("n_parts"))
