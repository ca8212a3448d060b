"""Text functions as column expressions: nothing here leaves the JVM."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dictionaries import CITED_BOOKS, CONTENTS_LABELS, PUNCTUATION, SECTION_LABELS, STANDALONE

#: Everything str.strip() takes off.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: What ends a line besides \n.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
WORD = "[\\p{L}\\p{N}]+(?:['\\-][\\p{L}\\p{N}]+)?"


def _accents() -> tuple[str, str]:
    """Letters that are a base letter and marks, with their base letters, by Unicode's own rule."""
    found, base = [], []
    for o in range(0xC0, 0x2000):
        plain = "".join(c for c in unicodedata.normalize("NFD", chr(o)) if unicodedata.category(c) != "Mn")
        if len(plain) == 1 and plain != chr(o):
            found.append(chr(o))
            base.append(plain)
    return "".join(found), "".join(base)


ACCENTED, BASES = _accents()


def strip(c: Column) -> Column:
    """All white space off both ends."""
    return F.trim(c, F.lit(SPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACE))


def strip_accents(c: Column) -> Column:
    bare = F.regexp_replace(F.translate(c, ACCENTED, BASES), "\\p{Mn}", "")
    return F.when(c.rlike("[^\\x00-\\x7f]"), bare).otherwise(c)  # plain text has none, and most lines are plain


def fold(c: Column) -> Column:
    """Lower case without accents, stripped."""
    return strip(F.lower(strip_accents(c)))


def fold_label(c: Column) -> Column:
    """fold, with white space collapsed and trailing colons off."""
    x = F.lower(strip_accents(c))
    spaced = F.when(x.rlike(f"[{SPACE}]{{2}}|[{SPACE[:5]}{SPACE[5:].replace(' ', '')}]"), F.regexp_replace(x, f"[{SPACE}]+", " ")).otherwise(x)
    return F.rtrim(strip(spaced), F.lit(":"))


def fold_slug(c: Column) -> Column:
    """Lower case with the seven accented letters of file names replaced."""
    return F.translate(F.lower(c), "áéíóúüñ", "aeiouun")


def unix_lines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def lines(c: Column) -> Column:
    """The lines as splitlines() gives them: any line end, no empty last line; null and '' have none."""
    parts = F.split(c, LINE_END)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts))


def filled_lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, LINE_END), strip), lambda x: x != "")


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD))


def valid_chars(c: Column) -> Column:
    allowed = re.sub(r"([\[\]\-&\\^])", r"\\\1", PUNCTUATION)
    return F.length(F.regexp_replace(c, f"[^\\p{{L}}\\p{{N}}{allowed}{SPACE}]+", ""))


def valid_ratio(c: Column) -> Column:
    return F.when(F.length(c) > 0, valid_chars(c) / F.length(c)).otherwise(0.0)


def long_lines(c: Column, limit: int) -> Column:
    return F.size(F.filter(filled_lines(c), lambda x: F.length(x) > limit))


def long_line_ratio(c: Column, limit: int) -> Column:
    n = F.size(filled_lines(c))
    return F.when(n > 0, long_lines(c, limit) / n).otherwise(0.0)


def replacement_chars(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("�"), F.lit("")))


CITED = "|".join(CITED_BOOKS)
_WS = f"[{SPACE}]"
# A word (with its number, if any), a chapter, a wrong separator or none, and a verse that may hold letters.
LIKE_CITATION = f"(?iu)(?<![\\p{{L}}\\p{{N}}_])(?:[1-3]{_WS}*+)?((?:Song of )?\\p{{L}}++){_WS}++\\d{{1,3}}{_WS}*(?:[;.{SPACE}]|:[lIoO]){_WS}*[lIoO0-9]{{1,3}}(?:{_WS}*-{_WS}*[lIoO0-9]{{1,3}})?(?![\\p{{L}}\\p{{N}}_])"


def malformed_citations(c: Column) -> Column:
    """Citations with a wrong separator or letters for digits: found by their shape first, then by the book's name."""
    return F.size(F.filter(F.regexp_extract_all(c, F.lit(LIKE_CITATION), 1), lambda w: w.rlike(f"(?iu)^(?:{CITED})$")))


def edge_lines(c: Column, n: int = 3) -> Column:
    """The first and last n filled lines, or all if there are at most 2n."""
    x = filled_lines(c)
    return F.when(F.size(x) <= 2 * n, x).otherwise(F.concat(F.slice(x, 1, n), F.slice(x, -n, n)))


def edge_key(line: Column) -> Column:
    """A line as compared across pages: one case, blanks collapsed, whole numbers as #; null if shorter than 5."""
    k = F.regexp_replace(F.regexp_replace(F.lower(strip(line)), f"[{SPACE}]+", " "), "(?<![\\p{L}\\p{N}_])\\p{Nd}+(?![\\p{L}\\p{N}_])", "#")
    return F.when(F.length(k) >= 5, k)


LETTERS = "A-Za-zÁÉÍÓÚáéíóúñÑ"
CITATION_WORD = "[A-ZÁÉÍÓÚÑ][A-Za-zÁÉÍÓÚáéíóúñÑ]+"
CITATION = f"(?:\\d?\\s?{CITATION_WORD}(?:\\s+{CITATION_WORD})?\\s+)?\\d+:\\d+(?:-\\d+)?"
CITATION_ONLY = f"^{CITATION}(?:\\s*[;,]\\s*{CITATION})*$"
PAGE_MARKER = "^===== PDF_PAGE (\\d+) =====$"
DATE = f"^\\d{{1,2}}/[{LETTERS}]{{3}}/\\d{{2}}$"
STRUCTURAL = [PAGE_MARKER, "(?iu)^LECCI[OÓ]N\\s+\\d+(?![\\p{L}\\p{N}_])", "(?i)^[IVXLCDM]+\\.\\s+", "^[A-Z]\\.\\s+", "^\\d{1,3}\\.\\s+", DATE, "^\\d{1,4}$", "^¿", "(?iu)^(?:Expositor|Guía del Maestro|TRIMESTRE)(?![\\p{L}\\p{N}_])"]


def starts_with_any(folded: Column, labels: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for x in labels:
        out = out | folded.startswith(x)
    return out


def contains_any(folded: Column, labels: tuple[str, ...] | list[str]) -> Column:
    out = F.lit(False)
    for x in labels:
        out = out | folded.contains(x)
    return out


def may_start_with(c: Column, labels: tuple[str, ...]) -> Column:
    """Can the folded text start with a label? A look at its first two letters, which spares most lines the folding."""
    first, two = "".join(sorted({x[0] for x in labels})), "|".join(sorted({re.escape(x[:2]) for x in labels}))
    return c.rlike(f"^[{SPACE}\\p{{Mn}}]*+(?:[{first}{first.upper()}]?[^\\x00-\\x7f]|(?i:{two}))")


def starts_folded(c: Column, labels: tuple[str, ...]) -> Column:
    """Does the folded text start with one of the labels? In one pattern, since every mention of the folded text folds it again."""
    return F.when(may_start_with(c, labels), fold(c).rlike("^(?:" + "|".join(map(re.escape, labels)) + ")")).otherwise(False)


def is_word(c: Column, words: tuple[str, ...]) -> Column:
    """Is the folded text one of the words? Texts with a blank inside are none."""
    return F.when(strip(c).rlike(f"[{SPACE}]"), False).otherwise(fold(c).isin(*words))


def is_section_label(line: Column) -> Column:
    return starts_folded(line, SECTION_LABELS)


def is_citation_only(line: Column) -> Column:
    return (F.length(line) <= 80) & line.rlike(CITATION_ONLY)


def is_structural(line: Column) -> Column:
    """Lines that are never joined with their neighbours."""
    s = strip(line)
    out = s == ""
    for p in STRUCTURAL:
        out = out | s.rlike(p)
    return out | is_citation_only(s) | is_section_label(s) | is_word(s, STANDALONE)


def is_contents_label(line: Column) -> Column:
    return F.when(may_start_with(line, CONTENTS_LABELS), is_word(line, CONTENTS_LABELS)).otherwise(False)


def join_hyphens(c: Column) -> Column:
    """A word cut at a line's end and continued on the next."""
    return F.regexp_replace(c, "([\\p{L}\\p{N}_])-\n([\\p{L}\\p{N}_])", "$1$2")


def tidy(c: Column) -> Column:
    """Composed form, line ends, cut words and blanks put right, before paragraphs are reflowed."""
    joined = join_hyphens(unix_lines(nfc(c)))
    return F.array_join(F.transform(F.split(F.regexp_replace(joined, "[ \t]+", " "), "\n"), rstrip), "\n")


# What Unicode's composition may change: marks, letters that are no more than another one, the parts of Hangul syllables.
COMPOSABLE = "[\\p{M}\\u0374\\u037e\\u0387\\u1f71-\\u1ffd\\u2000\\u2001\\u2126\\u212a\\u212b\\u2329\\u232a\\u1100-\\u11ff\\uf900-\\ufaff]"


def _composer():
    from pyspark.sql.functions import pandas_udf

    def compose(texts):  # pickled by value, so workers need no package
        import unicodedata

        return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    import pandas as pd

    compose.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pandas_udf(compose, "string")


def nfc(c: Column) -> Column:
    """The composed form. Spark has no function for it, so texts that it may change (few) go through Python, the rest does not."""
    return F.coalesce(_composer()(F.when(c.rlike(COMPOSABLE), c)), c)


def reflow_lines(lines: Column) -> Column:
    """The paragraphs of an array of lines: (first_line from 1, text) each; neighbouring lines are joined unless a structural or blank one parts them."""
    marked = F.transform(lines, lambda x: F.struct(strip(x).alias("s"), is_structural(x).alias("stands")))

    def paragraphs(m: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.try_element_at(m, i)["stands"]).otherwise(True)
            said = F.when(x["stands"], x["s"]).otherwise(F.regexp_replace(x["s"], f"[{SPACE}]+", " "))
            return F.struct((x["stands"] | before).alias("starts"), (i + 1).alias("line"), said.alias("s"))

        pieces = F.transform(m, piece)
        text = F.array_join(F.transform(pieces, lambda p, i: F.concat(F.when(i == 0, "").when(p["starts"], "\n").otherwise(" "), p["s"])), "")
        firsts = F.transform(F.filter(pieces, lambda p: p["starts"]), lambda p: p["line"])
        return F.arrays_zip(firsts.alias("first_line"), F.split(text, "\n").alias("text"))

    return F.element_at(F.transform(F.array(marked), paragraphs), 1)


def normalize(c: Column) -> Column:
    """A text as later steps read it: composed, line ends and cut words and blanks put right, paragraphs reflowed,
    stripped with one final line end; '' if nothing is left. Lines are those between line feeds."""
    paragraphs = reflow_lines(F.split(tidy(c), "\n"))
    text = strip(F.array_join(F.transform(paragraphs, lambda p: p["text"]), "\n"))
    return F.when(text == "", "").when(text.isNotNull(), F.concat(text, F.lit("\n")))


def clean_title(c: Column) -> Column:
    """Dot leaders off, blanks collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "\\.{2,}", " "), f"[{SPACE}]+", " "), F.lit(" ."))


def item_kind(c: Column) -> Column:
    """The kind of a section item; roman numerals come before letters, in any case."""
    s = strip(c)
    return (
        F.when((s == "") | (F.upper(s) == "TBD"), "placeholder")
        .when(s.rlike("(?i)^[IVXLCDM]+\\.\\s+"), "roman_heading")
        .when(s.rlike("^[A-Z]\\.\\s+"), "letter_subpoint")
        .when(s.startswith("(") & s.endswith(")"), "scripture_reference")
        .when(s.startswith("¿") | s.endswith("?"), "question")
        .otherwise("paragraph")
    )


def page_header(number: Column) -> Column:
    """The marker line of a page."""
    return F.concat(F.lit("===== PDF_PAGE "), number.cast("string"), F.lit(" ====="))


def expected_path(publication: Column, folder: str, suffix: str) -> Column:
    """Where a publication's text (`.txt`) or log (`.json`) stands."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), publication, F.lit(suffix))


def relative_path(path: Column, root: str) -> Column:
    """A path below the root as seen from there; any other one as it is."""
    top = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(top)), F.substring(path, F.lit(len(top) + 1), F.length(path))).otherwise(path)


def runtime_path(path: Column, root: str) -> Column:
    """As relative_path, but of a path outside only its last part, marked as external."""
    inside = relative_path(path, root)
    return F.when(inside == path, F.concat(F.lit("external:"), F.element_at(F.split(path, "/"), -1))).otherwise(inside)


def classified_path(publication: Column, family: Column, path: Column) -> Column:
    """A path below its family's folder."""
    return F.when(publication.isNotNull(), F.concat(family, F.lit("/"), path))
