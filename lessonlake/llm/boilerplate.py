"""Problem 2: lines repeated across one source's documents.

Line keys (case, blanks and numbers folded, encoding and look-alikes repaired) are counted per source by hash
with map-side aggregation. Every key that stands on two or more pages of a source is tested: a log-likelihood
ratio compares its rate there with its rate elsewhere, and Benjamini-Hochberg over all tested keys, ranked from
a histogram, sets the threshold. (A key seen once is no repetition and is not tested.) Significant keys are
removed where they are also on more than `share` of the source's page numbers, two at least. A line is resolved
to the key it is a copy of: an equal one, or one that differs by a few characters, after restoring encoding and
look-alikes; each page meets its source's keys (at most lines-per-page / share of them) in a join. `clean` takes
the resolved lines out by an anti-join on page and position and reassembles what is left by position.

Hot sources: the first aggregation combines before the shuffle and is keyed by line, not source; the page
join is on (source, page bucket), so a hot source is spread over its buckets. Null sources form no
group. Pages without a number count as one more page of their source. Null texts have no lines. Lines without a
letter are never removed. In `clean` the lines of pages without a page_id stay, and rows with one page_id are one page.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, map_columns, map_rows
from .chars import STRANGE, LookalikeModel, repair_encoding

def fold_numbers(text: str) -> str:
    """Every run of ASCII digits as one #."""
    for d in "0123456789":
        if d in text:
            text = text.replace(d, "#")
    while "##" in text:
        text = text.replace("##", "#")
    return text


def folded_lines(text: str) -> list[str]:
    """The lines of a readable lower-case text as keys: blanks collapsed, runs of digits as #."""
    text = fold_numbers(text)
    if "  " in text or "\t" in text or "\r" in text:
        return [" ".join(x.split()) for x in text.split("\n")]
    return list(map(str.strip, text.split("\n")))


def page_keys(text: str, model: LookalikeModel) -> list[str]:
    """The folded lines of a text, encoding and look-alikes repaired."""
    return folded_lines(readable(text, model).lower())


def _g2(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """The log-likelihood ratio of k1 of n1 against k2 of n2 (0 where the first rate is not the higher)."""
    p = (k1 + k2) / (n1 + n2)

    def ll(k, n, p):
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0) + F.when(n > k, (n - k) * F.log((n - k) / (n * (1 - p)))).otherwise(0.0)

    return F.when((k1 / n1 > k2 / F.greatest(n2, F.lit(1))) & (p < 1), 2 * (ll(k1, n1, p) + F.when(n2 > 0, ll(k2, n2, p)).otherwise(0.0))).when(p >= 1, 1e6).otherwise(0.0)


#: Slots of the filter that spares most pages a look; it is broadcast, and its rows are bounded by this number.
SLOTS = 1 << 18


#: Spark's xxhash64 of a string, without its sign.
key_hash = partial(xxhash.xxh64_intdigest, seed=42)


def line_keys(text: str, model: LookalikeModel) -> set[str]:
    """The distinct keys of a text that may be repeated lines: more than one character, with a letter."""
    return {k for k in page_keys(text, model) if len(k) > 1 and k.islower()}


def hashes(values) -> np.ndarray:
    return np.fromiter(map(key_hash, values), np.uint64).view(np.int64)


def filled_pages(pages: DataFrame, source: str, number: str, text: str) -> DataFrame:
    return pages.where(F.col(text).isNotNull()).select(source, text, F.coalesce(F.col(number).cast("bigint"), F.lit(-1)).alias("number"))


def line_rows(pages: DataFrame, model: LookalikeModel, source: str = "publication_id", number: str = "page_number", text: str = "text") -> DataFrame:
    """(s, h, number, n): one row for each distinct key of each page, as hashes of source and key; n is 1."""

    def rows(sources, texts, numbers):
        each = [hashes(line_keys(t, model)) for t in texts]
        size = [len(x) for x in each]
        h = np.concatenate(each) if each else np.empty(0, np.int64)
        return [pa.array(np.repeat(hashes(sources), size)), pa.array(h), pa.array(np.repeat(np.array(numbers, np.int64), size)), pa.array(np.ones(len(h), np.int64))]

    return map_columns(filled_pages(pages, source, number, text).where(F.col(source).isNotNull()), "s bigint, h bigint, number bigint, n bigint", rows)


def count_rows(rows: DataFrame) -> DataFrame:
    """(s, h, c, number): hashes only, the source's too; small rows, combined before the shuffle."""
    return cut(rows.groupBy("s", "h").agg(F.sum("n").alias("c"), F.max("number").alias("number")))


def excess_keys(pages: DataFrame, bigrams: dict[str, int], source: str = "publication_id", number: str = "page_number", text: str = "text", share: float = 0.08, fdr: float = 0.01, counts: DataFrame | None = None) -> DataFrame:
    """(source, key, copies, share, g2) of the line keys in significant excess within their source; share is of its page numbers.

    counts: those of `count_rows`, where they are known.
    """
    model = LookalikeModel(bigrams)
    if counts is None:
        counts = count_rows(line_rows(pages, model, source, number, text))
    sizes = cut(pages.where(F.col(source).isNotNull()).groupBy(source).agg(F.count_distinct(F.coalesce(F.col(number).cast("bigint"), F.lit(-1))).alias("n1"), F.count("*").alias("rows")).withColumn("s", F.xxhash64(source)))
    again = counts.where("c > 1")
    total = counts.groupBy("h").agg(F.sum("c").alias("k"), F.max("c").alias("most")).where("most > 1").drop("most")
    rows_all = sizes.agg(F.sum("rows")).first()[0] or 0
    c = F.col("c")
    tested = cut(again.join(sizes, "s").join(total, "h").withColumn("g2", _g2(c, F.col("rows"), F.col("k") - c, F.lit(rows_all) - F.col("rows"))))
    threshold = excess_threshold(tested, fdr)
    often = tested.where((F.col("g2") >= threshold) & (c > share * F.col("n1")))

    # the key itself, from one page that has it
    slot = F.pmod(F.xxhash64(source, "number"), F.lit(SLOTS)).alias("slot")
    slots = F.broadcast(often.select(slot).distinct())  # at most SLOTS rows
    some = filled_pages(pages, source, number, text).where(F.col(source).isNotNull()).withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot")

    def named(sources, texts, numbers):
        for s, t, n in zip(sources, texts, numbers, strict=True):
            for k in line_keys(t, model):
                yield s, n, k

    lines = map_rows(some, f"{source} string, number bigint, key string", named).withColumn("h", F.xxhash64("key"))
    names = lines.join(often.select(source, "h", "number"), [source, "h", "number"]).groupBy(source, "h").agg(F.max("key").alias("key"))
    scored = cut(often.drop("number", "s").join(names, [source, "h"]).select(source, "key", "h", "n1", "rows", "c", (c / F.col("n1")).alias("share"), "g2"))
    # a page extracted twice counts once: where that could decide, page numbers are told apart
    unsure = scored.where(c - (F.col("rows") - F.col("n1")) <= F.greatest(share * F.col("n1"), F.lit(1.0))).select(source, "h")
    if not unsure.isEmpty():
        apart = line_rows(pages, model, source, number, text).join(unsure.select(F.xxhash64(source).alias("s"), "h"), ["s", "h"], "left_semi").groupBy("s", "h", "number").count().groupBy("s", "h").agg(F.count("*").alias("apart"))
        scored = cut(scored.withColumn("s", F.xxhash64(source)).join(apart, ["s", "h"], "left").drop("s").withColumn("share", F.coalesce(F.col("apart") / F.col("n1"), "share")).drop("apart"))
    return scored.where((F.col("share") > share) & (F.col("share") * F.col("n1") > 1.5)).select(source, "key", c.alias("copies"), "share", "g2")


def excess_threshold(tested: DataFrame, fdr: float) -> float:
    """The g2 from which keys are in significant excess: Benjamini-Hochberg over all rows of `tested`, in steps of 1/4."""
    bins = tested.groupBy(F.least(F.floor(F.col("g2") * 4), F.lit(4000)).alias("bin")).agg(F.count("*").alias("n")).collect()  # at most 4,001 rows
    threshold, rank, size = 1e9, 0, sum(b["n"] for b in bins)
    for b in sorted(bins, key=lambda r: -r["bin"]):
        rank += b["n"]
        if math.erfc(math.sqrt(max(0.0, b["bin"] / 4) / 2)) <= fdr * rank / size:
            threshold = b["bin"] / 4
    return threshold


def within(a: str, b: str, most: int) -> bool:
    """Is the edit distance of a and b at most `most`? Cells off the band are skipped."""
    if abs(len(a) - len(b)) > most:
        return False
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    j, n = 0, min(len(a), len(b))
    while j < n and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[: len(a) - j], b[: len(b) - j]
    if not a or not b:
        return len(a) + len(b) <= most
    far = most + 1
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = i - most if i > most else 1, i + most if i + most < len(b) else len(b)
        last = row[lo - 1]
        row[lo - 1] = left = i if lo == 1 and i <= most else far
        best = left
        for j in range(lo, hi + 1):
            up = row[j]
            if x == b[j - 1]:
                cost = last
            else:
                cost = last if last < left else left
                if up < cost:
                    cost = up
                cost += 1
            last = up
            row[j] = left = cost
            if cost < best:
                best = cost
        if hi < len(b):
            row[hi + 1] = far
        if best > most:
            return False
    return row[len(b)] <= most


def letters(key: str) -> list[tuple[str, int]]:
    """The characters of a key with their counts."""
    return list(Counter(key).items())


def lacks(text: str, counted: list[tuple[str, int]], most: int) -> bool:
    """Does a text lack more than `most` of the counted characters? Then it is more edits than that away."""
    lost = 0
    for c, n in counted:
        n -= text.count(c)
        if n > 0:
            lost += n
            if lost > most:
                return True
    return False


def pieces(key: str, most: int) -> list[str]:
    """most + 1 parts of a key: a text with at most `most` edits holds one of them whole."""
    n = most + 1
    cuts = [len(key) * i // n for i in range(n + 1)]
    return [key[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


# Words too common to tell a line by.
COMMON = frozenset("# · — - © | / a al con de del el en la las los no para por su un una y".split())


class Matcher:
    """Finds damaged copies of one source's keys: shared words first, then edit distance up to a quarter of the key."""

    def __init__(self, keys: list[str]):
        self.exact = frozenset(keys)
        self.words: dict[str, list[int]] = {}
        self.keys = [(k, len(k) // 4 if len(k) > 11 else 1, len(set(k.split()) - COMMON)) for k in keys]
        for i, k in enumerate(keys):
            for w in set(k.split()) - COMMON:
                self.words.setdefault(w, []).append(i)
        self.telling = frozenset(self.words)
        # damage may leave no word of a short key whole: lines of its length are compared outright
        self.short = [(k, m, pieces(k, m)) for k, m, n in self.keys if n <= 3]
        self.reach = max((len(k) + m for k, m, _ in self.short), default=0)
        self.letters = {k: letters(k) for k in keys}
        self.of_length: list[list[tuple[str, int, list[str]]]] = [[] for _ in range(self.reach + 1)]
        for k, m, parts in self.short:
            for n in range(max(0, len(k) - m), len(k) + m + 1):
                self.of_length[n].append((k, m, parts))
        self.least = min((len(k) - m for k, m, _ in self.keys), default=1)
        self.most = max((len(k) + m for k, m, _ in self.keys), default=0)

    def resolve(self, key: str) -> str | None:
        """The key that a line is a copy of, if any."""
        return key if key in self.exact else self.near(key, key.split())

    def near(self, key: str, words: list[str]) -> str | None:
        """The key of which a line that equals none is a damaged copy. words: those of the line."""
        if not self.least <= len(key) <= self.most:
            return None
        if len(key) <= self.reach:
            for k, m, parts in self.of_length[len(key)]:
                for part in parts:
                    if part in key:
                        if not lacks(key, self.letters[k], m) and within(k, key, m):
                            return k
                        break
        shared: dict[int, int] = {}
        for w in self.telling.intersection(words):
            for i in self.words[w]:
                shared[i] = shared.get(i, 0) + 1
        for i, n in shared.items():
            k, most, size = self.keys[i]
            if n * 4 >= size and abs(len(k) - len(key)) <= most and not lacks(key, self.letters[k], most) and within(k, key, most):
                return k
        return None


def readable(text: str, model: LookalikeModel) -> str:
    """The text with encoding and look-alikes repaired; its lines stay where they are."""
    return model.normalize(repair_encoding(text, model)[0])[0] if STRANGE.search(text) else text


def repeated_lines(text: str, matcher: Matcher, model: LookalikeModel) -> list[tuple[int, str]]:
    """(line number from 1, key) of the lines that are copies of a key."""
    resolve = matcher.resolve
    hits = ((i, key, resolve(key)) for i, key in enumerate(page_keys(text, model), 1) if key)
    return [(i, k) for i, key, k in hits if k is not None and key.islower()]


def page_bucket(number: str, bucket: int) -> Column:
    """The bucket of a page; pages without a number have one of their own."""
    return F.coalesce(F.floor(F.col(number) / bucket), F.lit(-(2**40)))


def with_keys(pages: DataFrame, keys: DataFrame, source: str = "publication_id", number: str = "page_number", bucket: int = 16) -> DataFrame:
    """Each page with the array of its source's keys, for a map over whole pages.

    The join is on (source, page number / bucket), so a hot source is spread over its buckets.
    """
    at = page_bucket(number, bucket).alias("bucket")
    by = keys.groupBy(source).agg(F.sort_array(F.collect_list("key")).alias("keys"))
    places = pages.where(F.col(source).isNotNull()).select(source, at).distinct().join(by, source)
    return pages.withColumn("bucket", at).join(places, [source, "bucket"], "left").drop("bucket")


def copies(pages: DataFrame, keys: DataFrame, bigrams: dict[str, int], key: str = "page_id", source: str = "publication_id", number: str = "page_number", text: str = "text") -> DataFrame:
    """(page_id, line_no, key): every line that is a copy of one of its source's keys, resolved to it."""
    model = LookalikeModel(bigrams)
    known: dict[tuple[str, ...], Matcher] = {}

    def fn(ids, texts, lists) -> Iterator[tuple]:
        for k, t, ks in zip(ids, texts, lists, strict=True):
            at = tuple(ks)
            m = known.get(at)
            if m is None:
                if len(known) > 500:
                    known.clear()
                m = known[at] = Matcher(ks)
            for n, said in repeated_lines(t, m, model):
                yield k, n, said

    some = with_keys(pages.select(key, source, number, text), keys, source, number).where(F.col(text).isNotNull() & F.col("keys").isNotNull())
    return map_rows(some.select(key, text, "keys"), f"{key} {pages.schema[key].dataType.simpleString()}, line_no int, key string", fn)


def found(pages: DataFrame, keys: DataFrame, bigrams: dict[str, int]) -> DataFrame:
    return copies(pages, keys, bigrams).select("page_id", "line_no")


def clean(pages: DataFrame, keys: DataFrame, bigrams: dict[str, int]) -> DataFrame:
    """(page_id, clean_text, lines_removed): each page reassembled by position without its repeated lines.

    Pages without such a line pass as they are; only the others are taken apart.
    """
    gone = cut(copies(pages, keys, bigrams).select("page_id", "line_no"))
    touched = gone.groupBy("page_id").agg(F.count("*").cast("int").alias("lines_removed"))
    whole = pages.join(touched, "page_id", "left_anti").select("page_id", F.col("text").alias("clean_text"), F.lit(0).alias("lines_removed"))
    lines = pages.join(touched, "page_id").where("text is not null").select("page_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).select("page_id", (F.col("at") + 1).alias("line_no"), "line")
    kept = lines.join(gone, ["page_id", "line_no"], "left_anti").groupBy("page_id").agg(F.array_sort(F.collect_set(F.struct("line_no", "line"))).alias("x"))
    joined = F.array_join(F.transform(F.coalesce("x", F.array().cast("array<struct<line_no:int,line:string>>")), lambda r: r["line"]), "\n")
    return whole.unionByName(touched.join(kept, "page_id", "left").select("page_id", joined.alias("clean_text"), "lines_removed"))
