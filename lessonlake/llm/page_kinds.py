"""Problem 4: per-document text quality statistics and the kind of each page.

A hidden Markov model labels every line prose, list, table or junk. What is observed of a line is a symbol
made of its shape (bullet, cells, dot leader, citation, noise, words), its length and how it starts and
ends. Emissions start from a bounded sample of hand-labelled pages (`SAMPLE` rows, taken in the order of a
hash) and are refined by Baum-Welch on that sample; all pages are then decoded by Viterbi, many at a time.
Label shares per page decide its kind.

The plain figures (words, valid characters, long lines, malformed citations and more) are Spark
expressions. Defined results: a null text has null shares and no kind; a blank one zero words and no kind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .base import map_rows

KINDS = ("prose", "list", "table", "junk")
#: The most labelled pages the model is fitted on.
SAMPLE = 4000
SHAPES = 14
SYMBOLS = SHAPES * 3 * 2 * 2

BULLET = re.compile(r"\s*(?:[•*·–—]|-(?!\s*\d+\s*-))\s+\w")
NUMBERED = re.compile(r"\s*(?:\d{1,3}[.)ª]|[a-zA-Z][.)]|[IVXivx]{1,5}[.)])\s+\S")
LEADER = re.compile(r"\.{4,}|_{4,}|(?:\. ){4,}")
CELLS = re.compile(r"\t|\s[|;]\s|\s\|$|^\|\s")
GAPS = re.compile(r"\S {2,}(?=\S)")
CITATION = re.compile(r"\s*(?:[123]\s?)?[A-ZÁÉÍÓÚ][\w@|]{0,14}\.?\s+\d{1,3}[:.;]\s?\d{1,3}[\d\s:;,.‑-]*(?:\s[–—-]+\s.*)?\s*$")
PAGE_NO = re.compile(r"\s*\W{0,3}\s*(?:p[aá]g\w*\.?\s*)?[\dlO]{1,4}(?:\s*(?:de|/)\s*\d+)?\s*\W{0,3}\s*$|\s*[ivxl]{1,5}\s*$", re.I)
WORDS = re.compile(r"[^\W\d_]+")
VOWEL = re.compile("[aeiouáéíóúüy@0136|]", re.I)
TOKENS = re.compile(r"\S+")


def noise(line: str) -> int:
    """0 no noise, 1 signs and digits, 2 letters that are no words, 3 unbroken strings."""
    s = line.strip()
    letters = sum(map(len, WORDS.findall(s)))
    tokens = s.split()
    if len(s) >= 4 and letters * 2.2 < sum(map(len, tokens)) and not CITATION.match(s):
        digits = sum(map(str.isdigit, s))
        if (letters + digits) * 1.6 < sum(map(len, tokens)) or letters and digits and re.search(r"\d[a-z]{1,2}\b|0x\d|[!&)(%<_/:]{2}\d", s):
            return 1
    if any(len(t) > 32 for t in tokens) or len(tokens) == 1 and len(s) > 14 and any(map(str.isdigit, s)):
        return 3
    if len(tokens) >= 3 and letters:
        words = WORDS.findall(s)
        mute = sum(1 for t in words if len(t) > 1 and not VOWEL.search(t) or len(t) > 4 and len(VOWEL.findall(t)) * 5 < len(t))
        single = sum(1 for t in tokens if len(t) == 1)
        if mute * 2 >= max(1, len(words)) or single * 3 > 2 * len(tokens) and len(tokens) >= 4:
            return 2
    elif tokens and letters > 3 and not VOWEL.search(s):
        return 2
    return 0


#: Running text as nearly all lines are: words with common marks, single blanks, no number.
PLAIN = re.compile(r"[¿¡(«“]?[^\W\d_]{1,20}[,;:]?(?: [¿¡(«“]?[^\W\d_]{1,20}(?:-[^\W\d_]{1,20})?[,.;:?)]{0,2}){3,}[-¬]?")


def symbol(line: str) -> int:
    """The observation of one line."""
    s = line.strip()
    if not s:
        return 0
    n = len(s)
    if n > 27 and PLAIN.fullmatch(s) and (s.count("a") + s.count("e") + s.count("o")) * 6 > n > 3 * s.count(" "):
        return ((39 + (1 if n < 50 else 2)) * 2 + s[0].islower()) * 2 + (s[-1] in ".?!,;:-¬…)”»")
    cells = len(CELLS.findall(line))
    gaps = len(GAPS.findall(s))
    tokens = s.count(" ") + 1 - (s.count("  ") if gaps else 0)
    if PAGE_NO.match(s):
        shape = 1
    elif LEADER.search(s):
        shape = 2
    elif BULLET.match(line):
        shape = 3
    elif cells >= 2 or "\t" in s or cells == 1 and n < 50:
        shape = 4
    elif NUMBERED.match(line):
        shape = 5
    elif CITATION.match(s):
        shape = 6
    elif gaps >= 1 and gaps * 3 <= max(3, len(s.split()) - 1) * 2 and re.search(r"\S {3,}\S", s):
        shape = 7
    else:
        k = noise(s)
        if k:
            shape = 7 + k
        elif "©" in s or s.isupper():
            shape = 11
        elif gaps >= 3:
            shape = 12
        else:
            shape = 13
    length = 0 if n < 28 else 1 if n < 50 else 2
    return ((shape * 3 + length) * 2 + (s[0].islower())) * 2 + (s[-1] in ".?!,;:-¬…)”»")


def symbols(text: str) -> np.ndarray:
    """The symbols of a text's non-blank lines."""
    out = [symbol(x) for x in text.split("\n")]
    return np.array([x for x in out if x], dtype=np.int32)


class Model:
    """Hidden Markov model over the four line kinds."""

    def __init__(self, sequences: list[np.ndarray], labels: list[int], rounds: int = 6):
        k = len(KINDS)
        prior = np.full((k, SYMBOLS), 0.05)
        for seq, y in zip(sequences, labels, strict=True):
            np.add.at(prior[y], seq, 1.0 if y == 0 else 0.6)
            if y:
                np.add.at(prior[0], seq, 0.02)
        self.start = np.array([0.82, 0.07, 0.06, 0.05])
        self.trans = np.full((k, k), 0.04) + np.eye(k) * 0.84
        self.trans /= self.trans.sum(axis=1, keepdims=True)
        self.emit = prior / prior.sum(axis=1, keepdims=True)
        lean = np.eye(k) * 3.0 + 1.0  # a page's label makes its kind likelier for each of its lines
        for _ in range(rounds):
            e, t, s = np.full((k, SYMBOLS), 0.02), np.eye(k) * 3 + 0.3, np.full(k, 0.5)
            for seq, y in zip(sequences, labels, strict=True):
                if not len(seq):
                    continue
                b = self.emit[:, seq].T * lean[y]
                a = np.empty_like(b)
                a[0] = self.start * b[0]
                a[0] /= a[0].sum()
                for i in range(1, len(seq)):
                    a[i] = (a[i - 1] @ self.trans) * b[i]
                    a[i] /= a[i].sum()
                z = np.ones(k)
                for i in range(len(seq) - 1, -1, -1):
                    g = a[i] * z
                    g /= g.sum()
                    e[:, seq[i]] += g
                    if i == 0:
                        s += g
                    if i:
                        x = a[i - 1][:, None] * self.trans * (b[i] * z)[None, :]
                        t += x / x.sum()
                        z = self.trans @ (b[i] * z)
                        z /= z.sum()
            self.emit, self.trans, self.start = e / e.sum(axis=1, keepdims=True), t / t.sum(axis=1, keepdims=True), s / s.sum()

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi over many sequences at once."""
        if not sequences:
            return []
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(sequences)
        le, lt, ls = np.log(self.emit).T, np.log(self.trans), np.log(self.start)
        for at in range(0, len(order), 512):
            part = order[at : at + 512]
            size = np.array([len(sequences[i]) for i in part])
            top = int(size.max())
            if not top:
                continue
            padded = np.zeros((len(part), top), dtype=np.int64)
            for r, i in enumerate(part):
                padded[r, : size[r]] = sequences[i]
            score = ls + le[padded[:, 0]]
            back = np.zeros((top, len(part), len(KINDS)), dtype=np.int8)
            for step in range(1, top):
                each = score[:, :, None] + lt[None]
                back[step] = each.argmax(axis=1)
                new = each.max(axis=1) + le[padded[:, step]]
                score = np.where((step < size)[:, None], new, score)
            best = score.argmax(axis=1)
            path = np.zeros((len(part), top), dtype=np.int64)
            for step in range(top - 1, -1, -1):
                live = step < size
                path[live, step] = best[live]
                if step:
                    best = np.where(live, back[step, np.arange(len(part)), best], best)
            for r, i in enumerate(part):
                out[i] = path[r, : size[r]]
        return out


def fit(pages: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """A model fitted on at most `most` hand-labelled pages with text."""
    sample = (
        labels.where(F.col("page_kind").isin(*KINDS) & F.col("page_id").isNotNull())
        .groupBy("page_id")
        .agg(F.min("page_kind").alias("page_kind"))
        .orderBy(F.xxhash64("page_id"), "page_id")
        .limit(most)
    )
    rows = map_rows(
        pages.where("text is not null").join(sample, "page_id").select("page_kind", "text"),
        "y int, line_symbols array<int>",
        lambda kinds, texts: ((KINDS.index(k), symbols(t).tolist()) for k, t in zip(kinds, texts, strict=True)),
    ).collect()  # at most `most` short rows
    rows.sort(key=lambda r: (r[0], r[1]))
    return Model([np.array(r[1], dtype=np.int32) for r in rows], [r[0] for r in rows])


def page_kind(shares: list[float], lines: int) -> str | None:
    if not lines:
        return None
    if shares[0] >= 0.5:
        return "prose"
    return KINDS[1:][int(np.argmax(shares[1:]))] if sum(shares[1:]) > 0.5 else "prose"


#: Lines that say nothing of the page's own text: page numbers and capitals at the edges.
NEUTRAL = {1, 11}


def classify(pages: DataFrame, model: Model, key: str = "page_id") -> DataFrame:
    """(page_id, lines, prose_share, list_share, table_share, junk_share, page_kind) for each page with text."""

    def fn(ids, texts) -> Iterator[tuple]:
        ids, texts = zip(*((i, t) for i, t in zip(ids, texts, strict=True) if t is not None), strict=True) if any(t is not None for t in texts) else ((), ())
        observed = [symbols(t) for t in texts]
        for i, seq, path in zip(ids, observed, model.decode(observed), strict=True):
            shape = seq // 12
            keep = ~np.isin(shape, list(NEUTRAL)) if len(seq) > 6 else np.ones(len(seq), dtype=bool)
            own = path[keep]
            n = len(own)
            c = np.bincount(own, minlength=4)
            s = [float(x) / n for x in c] if n else [0.0] * 4
            yield i, n, *s, page_kind(s, n)

    return map_rows(pages.select(key, "text"), "page_id bigint, n_lines int, prose_share double, list_share double, table_share double, junk_share double, page_kind string", fn)


# Common words of the corpus' languages.
COMMON_WORDS = "a al como con cuando de del desde e el en entre es esta este la las lo los más no o otra otro para pero por que se según si sin sobre su sus un una y the of and to in is that for it as with do da os um uma não com".split()


def statistics(pages: DataFrame, key: str = "page_id", text: str = "text") -> DataFrame:
    """Plain figures of each text, right whatever is stored: counts, and ratios that are 0 for a text without the thing counted.

    A null text counts as an empty one.
    """
    t = T.strip(F.coalesce(text, F.lit("")))
    x = pages.select(key, t.alias("t")).withColumn("words", F.regexp_extract_all(F.lower("t"), F.lit(f"({T.WORD})"), 1)).withColumn("ls", T.filled_lines(F.col("t")))
    n_words, n_lines = F.size("words"), F.size("ls")

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    return x.select(
        key,
        n_words.alias("word_count"),
        ratio(F.aggregate("words", F.lit(0), lambda a, w: a + F.length(w)), n_words).alias("mean_word_length"),
        ratio(F.length(F.regexp_replace("t", f"[\\p{{L}}\\p{{N}}{T.SPACE}]+", "")), F.length("t")).alias("symbol_ratio"),
        ratio(F.size(F.filter("ls", lambda v: v.rlike("[.!?…:;,]$"))), n_lines).alias("punctuated_lines"),
        ratio(F.size(F.filter("words", lambda w: w.isin(*COMMON_WORDS))), n_words).alias("common_words"),
        T.valid_ratio(F.col("t")).alias("valid_char_ratio"),
        ratio(F.size(F.filter("ls", lambda v: F.length(v) > 160)), n_lines).alias("long_line_ratio"),
        T.malformed_citations(F.col("t")).alias("malformed_scripture_count"),
    )
