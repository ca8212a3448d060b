"""Problem 9: long exact spans shared between records.

Each text is sampled by winnowing: of every `SPAN - BLOCK + 1` neighbouring block hashes the smallest is
kept, so any span of `SPAN` characters that two texts share contains a block both keep. Block hashes kept by
more than one class of texts are the index; it tells which reference texts a text is parsed against. The parse
is greedy relative Lempel-Ziv: the text is cut into the longest factors that the reference's indexed blocks
lead to, the factors are checked at their boundaries, where a longer span may have been cut in two, and those
of `SPAN` characters or more are the shared spans.

Exact copies are one class: only one representative is sampled and parsed, and copies rejoin by their class.
A block in more than `HOT` classes is not paired directly. All its occurrences in each text are told apart by
the hashes of the SPAN-character windows around the block; only classes with an equal window are paired. So no
link is lost, whatever `HOT` is, and no group is expanded that does not share a whole span.

Lengths are code points. Null texts and texts shorter than `SPAN` share nothing; ties and repeated rows are
copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, map_rows

SPAN = 200
BLOCK = 100
#: Classes per block from which windows decide instead of the block alone.
HOT = 16

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown when a longer text comes."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 4096)
            with np.errstate(over="ignore"):
                cls.up = np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(size - 1, BASE))])
                cls.down = np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(size - 1, INVERSE))])
        return cls.up[:n], cls.down[:n]


def window_hashes(text: str, size: int) -> np.ndarray:
    """A 64-bit hash of every `size` neighbouring code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes)
    if n < size:
        return np.empty(0, dtype=np.uint64)
    up, down = _Powers.to(n + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n])])
        h = (sums[size:] - sums[:-size]) * down[: n - size + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the smallest hash of every `width` neighbours (of all when there are fewer)."""
    n = len(hashes)
    if not n:
        return np.empty(0, dtype=np.int64)
    if n <= width:
        return np.array([int(np.argmin(hashes))])
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = hashes
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[: n - width + 1], left[width - 1 : n])
    at = np.zeros(n, dtype=bool)
    # a hash is kept if it is the least of some window that holds it
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    for i in first:
        w = hashes[i : i + width] == least[i]
        at[i + int(np.argmax(w))] = True
    # equal hashes (periodic text): a window must hold a kept one
    kept = np.flatnonzero(at)
    gaps = np.flatnonzero(np.diff(np.concatenate([[-1], kept, [n]])) > width)
    for g in gaps:
        lo = kept[g - 1] + 1 if g else 0
        hi = kept[g] if g < len(kept) else n
        i = lo
        while i + width <= hi:
            j = i + int(np.argmin(hashes[i : i + width]))
            at[j] = True
            i = j + 1
    return np.flatnonzero(at)


#: Hash values apart in the table that tells which blocks two texts may share.
TABLE = 1 << 17


def _maybe(hashes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Positions of the hashes that others may hold too; a table of their low bits drops most of the rest."""
    table = np.zeros(TABLE, dtype=bool)
    table[(others & np.uint64(TABLE - 1)).astype(np.int64)] = True
    return np.flatnonzero(table[(hashes & np.uint64(TABLE - 1)).astype(np.int64)])


class Reference:
    """A text as the reference of a parse: the blocks another text may share, with all their positions."""

    def __init__(self, text: str, hashes: np.ndarray, own: np.ndarray, block: int = BLOCK):
        self.text, self.block = text, block
        at = _maybe(hashes, own)
        self.order = at[np.argsort(hashes[at], kind="stable")]
        self.keys = hashes[self.order]

    def places(self, text: str, i: int, a: int, b: int) -> list[int]:
        """Where the block of text at i, whose hash has the ranks a to b, stands; of periodic stretches only the places that can win.

        In a stretch of places at equal distance both sides of a match grow or shrink step by step, so the longest
        match, and the furthest one to either side, is at an end or where one text's stretch ends with the other's.
        """
        at = self.order[a:b].tolist()
        if len(at) < 8:
            return at
        out, k = [], 0
        while k < len(at):
            d, m = (at[k + 1] - at[k] if k + 1 < len(at) else 0), k + 1
            while m + 1 < len(at) and at[m + 1] - at[m] == d:
                m += 1
            if d > self.block or m - k < 4:
                out.append(at[k])
                k += 1
                continue
            right = d + _common(text, text, i, i + d, 1)
            left = _common(text, text, i, i + d, -1)
            end = at[m] + d + _common(self.text, self.text, at[m], at[m] + d, 1)
            start = at[k] - _common(self.text, self.text, at[k], at[k] + d, -1)
            steps = {k, m}
            for x in (end - right, start + left):
                q = k + (x - at[k]) // d
                steps |= {min(max(q, k), m), min(max(q + 1, k), m)}
            out += [at[j] for j in sorted(steps)]
            k = m + 1
        return out


def parse(text: str, other: str, least: int = SPAN, block: int = BLOCK, hashes: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int, int]]:
    """The factors (start, reference start, length) of `least` or more code points of text against a reference.

    hashes: the block hashes of both texts, where known.

    Greedy relative Lempel-Ziv: at each position that is not yet parsed the longest factor that starts there is
    taken and the parse goes on behind it; a character whose block the reference lacks is a literal. At both
    boundaries of a factor all places of the block that starts or ends there are extended to both sides. A span of
    2 * block - 1 characters or more that crosses a boundary has `block` of them on one side of it, so it is met
    there; one that crosses none lies in a factor. So every character of every such span is in some factor given.
    """
    if len(text) < least or len(other) < least:
        return []
    own, theirs = hashes or (window_hashes(text, block), window_hashes(other, block))
    reference = Reference(other, theirs, own, block)
    at = _maybe(own, reference.keys)
    low, high = np.searchsorted(reference.keys, own[at], "left"), np.searchsorted(reference.keys, own[at], "right")
    real = high > low
    hits, low, high = at[real], low[real], high[real]
    out: set[tuple[int, int, int]] = set()

    def extend(k: int) -> int:
        """Extends all places of the k-th block that the reference has; the length of the longest factor that starts there."""
        i, most = int(hits[k]), 0
        for r in reference.places(text, i, low[k], high[k]):
            if text[i : i + block] != other[r : r + block]:
                continue
            right = block + _common(text, other, i + block, r + block, 1)
            left = _common(text, other, i, r, -1)
            if left + right >= least:
                out.add((i - left, r - left, left + right))
            most = max(most, right)
        return most

    i = 0
    while (k := int(np.searchsorted(hits, i))) < len(hits):
        i = int(hits[k])
        n = extend(k)
        last = int(np.searchsorted(hits, i + n - block))
        if n > block and hits[last] == i + n - block:
            extend(last)
        i += max(n, 1)
    return sorted(out)


def _common(a: str, b: str, i: int, j: int, way: int) -> int:
    """How many characters agree from (i, j) on, rightwards, or leftwards before them."""
    n, step = 0, 64
    most = min(len(a) - i, len(b) - j) if way > 0 else min(i, j)
    while n < most:
        k = min(step, most - n)
        x, y = (a[i + n : i + n + k], b[j + n : j + n + k]) if way > 0 else (a[i - n - k : i - n], b[j - n - k : j - n])
        if x == y:
            n += k
            step = min(step * 2, 4096)
        elif k == 1:
            return n
        elif step > 1 and k > 8:
            step = k // 2
        else:
            pairs = zip(x, y, strict=True) if way > 0 else zip(reversed(x), reversed(y), strict=True)
            for p, q in pairs:
                if p != q:
                    return n
                n += 1
    return n


def _signed(a: np.ndarray) -> list[int]:
    return a.view(np.int64).tolist()


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = SPAN) -> DataFrame:
    """(key, class_id) of the texts long enough; class_id is the smallest key among exact copies.

    Copies are told by two independent hashes and the length, so no text is shuffled.
    """
    sized = docs.where(F.length(text) >= least).select(key, F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), F.reverse(text)).alias("h2"), F.length(text).alias("n"))
    first = sized.groupBy("h1", "h2", "n").agg(F.min(key).alias("class_id"))
    return sized.join(first, ["h1", "h2", "n"]).select(key, "class_id")


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(membership, candidate pairs of class ids a < b) such that every pair of classes that shares a span is among them."""
    member = cut(classes(docs, key, text))
    kind = docs.schema[key].dataType.simpleString()

    def sample(ids, texts) -> Iterator[tuple]:
        for k, t in zip(ids, texts, strict=True):
            h = window_hashes(t, BLOCK)
            at = winnow(h, SPAN - BLOCK + 1)
            seen = set()
            for value, p in zip(_signed(h[at]), at.tolist(), strict=True):
                if value not in seen:  # for counts and direct pairs; `_hot_links` takes all occurrences
                    seen.add(value)
                    yield value, k

    # every text is sampled and copies are dropped by their hash afterwards, so no text is joined or moved
    blocks = map_rows(docs.where(F.length(text) >= SPAN).select(key, text), f"h bigint, {key} {kind}", sample)
    several = member.where(F.col(key) != F.col("class_id")).select(key)
    blocks = cut(blocks.join(several, key, "left_anti").select("h", F.col(key).alias("id")))
    counts = blocks.groupBy("h").agg(F.count("*").alias("c"), F.min("id").alias("low"), F.max("id").alias("high"))
    shared = cut(counts.where("c > 1"))
    two = shared.where("c = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    some = blocks.join(shared.where((F.col("c") > 2) & (F.col("c") <= hot)).select("h"), "h")
    few = some.groupBy("h").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    few = few.select(F.explode("ids").alias("a"), "ids").select("a", F.explode("ids").alias("b")).where("a < b")
    out = two.unionByName(few)
    many = shared.where(F.col("c") > hot).select("h")
    if not many.isEmpty():
        held = blocks.join(many, "h", "left_semi").groupBy("id").agg(F.collect_list("h").alias("held"))
        out = out.unionByName(_hot_links(docs, held, key, text, kind))
    return member, cut(out.distinct())


def _hot_links(docs: DataFrame, held: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    """Pairs of classes that share a whole window around any occurrence of a block of many classes.

    held: id and the hashes of such blocks in its text.
    """

    def sample(ids, texts, lists) -> Iterator[tuple]:
        for k, t, hashes in zip(ids, texts, lists, strict=True):
            w = window_hashes(t, SPAN)
            keep = np.zeros(len(w), dtype=bool)
            blocks = window_hashes(t, BLOCK)
            for p in np.flatnonzero(np.isin(blocks, np.array(hashes, dtype=np.int64).view(np.uint64))).tolist():
                keep[max(0, p - (SPAN - BLOCK)) : p + 1] = True
            for x in _signed(np.unique(w[keep])):
                yield x, k

    windows = map_rows(docs.select(F.col(key).alias("id"), text).join(held, "id"), f"w bigint, id {kind}", sample)
    windows = cut(windows)
    # windows held by the same set of classes lead to the same pairs: keep one of each set
    sets = windows.groupBy("w").agg(F.count("*").alias("c"), F.min("id").alias("low"), F.max("id").alias("high"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s")).where("c > 1")
    one = sets.groupBy("c", "low", "high", "s").agg(F.min("w").alias("w")).select("w")
    own = windows.join(one, "w")
    left, right = own.select("w", F.col("id").alias("a")), windows.join(one, "w", "left_semi").select("w", F.col("id").alias("b"))
    return left.join(right, "w").where("a < b").select("a", "b")


def factors(docs: DataFrame, candidates: DataFrame, key: str = "doc_id", text: str = "text", both: bool = True) -> DataFrame:
    """(id, other, start, other_start, length): the parse of each text of a candidate pair against the other one.

    With both=False only b is parsed against a, which tells whether they share a span.
    """
    ids = candidates.select(F.col("a").alias(key)).unionByName(candidates.select(F.col("b").alias(key))).distinct()
    texts = docs.select(key, text).join(ids, key, "left_semi")
    pairs = candidates.join(texts.select(F.col(key).alias("a"), F.col(text).alias("ta")), "a").join(texts.select(F.col(key).alias("b"), F.col(text).alias("tb")), "b")
    kind = docs.schema[key].dataType.simpleString()

    def run(a, b, ta, tb) -> Iterator[tuple]:
        kept: dict = {}

        def hashed(k, t) -> np.ndarray:
            if k not in kept:
                if len(kept) > 64:
                    kept.clear()
                kept[k] = window_hashes(t, BLOCK)
            return kept[k]

        for x, y, s, t in zip(a, b, ta, tb, strict=True):
            p, q = hashed(x, s), hashed(y, t)
            for start, ref, n in parse(t, s, hashes=(q, p)):
                yield y, x, start, ref, n
            if both:
                for start, ref, n in parse(s, t, hashes=(p, q)):
                    yield x, y, start, ref, n

    return map_rows(pairs.select("a", "b", "ta", "tb"), f"id {kind}, other {kind}, start int, other_start int, length int", run)


def found(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(a, b): every pair of rows with a common span, smaller key first. Copies are pairs too."""
    member, candidates = links(docs, key, text, hot)
    true = factors(docs, candidates, key, text, both=False).select(F.col("other").alias("a"), F.col("id").alias("b")).distinct()
    left, right = member.select(F.col("class_id").alias("a"), F.col(key).alias("x")), member.select(F.col("class_id").alias("b"), F.col(key).alias("y"))
    apart = true.join(left, "a").join(right, "b").select("x", "y")
    copied = member.groupBy("class_id").agg(F.count("*").alias("c")).where("c > 1").select("class_id")
    copies = member.join(copied, "class_id").select("class_id", F.col(key).alias("x")).join(member.select("class_id", F.col(key).alias("y")), "class_id").where("x < y").select("x", "y")
    both = apart.unionByName(copies)
    return both.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))


def class_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(class_a, class_b, longest_span): pairs of representatives with a common span; copies are not expanded (see `classes`)."""
    _, candidates = links(docs, key, text, hot)
    f = factors(docs, candidates, key, text, both=False)
    return f.groupBy(F.col("other").alias("class_a"), F.col("id").alias("class_b")).agg(F.max("length").alias("longest_span"))


def _merged(f: DataFrame) -> DataFrame:
    """(class_id, spans): the disjoint stretches (s, e) of each representative that its factors cover, in order.

    Equal factors against many others are one before any list is made.
    """
    each = f.select("id", F.col("start").alias("s"), (F.col("start") + F.col("length")).alias("e")).groupBy("id", "s").agg(F.max("e").alias("e"))
    lists = each.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("x"))
    span = "array<struct<s:int,e:int>>"

    def add(acc, x):
        touches = (F.size(acc) > 0) & (x["s"] <= F.try_element_at(acc, F.lit(-1))["e"])
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["s"].alias("s"), F.greatest(F.try_element_at(acc, F.lit(-1))["e"], x["e"]).alias("e"))))
        return F.when(touches, grown).otherwise(F.concat(acc, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e")))))

    return lists.select(F.col("id").alias("class_id"), F.aggregate("x", F.array().cast(span), add).alias("spans"))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(key, span_no, start_char, n_chars): the disjoint stretches of each row that stand in another row too, from character 0 on.

    A row that has an exact copy is one span from end to end. Rows that share nothing have no span.
    """
    member, candidates = links(docs, key, text, hot)
    merged = _merged(factors(docs, candidates, key, text))
    sizes = member.groupBy("class_id").agg(F.count("*").alias("n_copies"))
    rows = member.join(sizes, "class_id").join(docs.select(key, F.length(text).alias("n")), key).join(merged, "class_id", "left")
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e")))
    out = rows.select(key, F.posexplode(F.when(F.col("n_copies") > 1, whole).otherwise(F.col("spans"))).alias("at", "x"))
    return out.select(key, (F.col("at") + 1).alias("span_no"), F.col("x.s").alias("start_char"), (F.col("x.e") - F.col("x.s")).alias("n_chars"))


def coverage(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(key, class_id, n_copies, n_chars, shared_chars, shared_ratio, n_links) for every row: how much of it
    stands in another row too, and with how many other rows it shares a span. Exact copies are wholly shared."""
    member, candidates = links(docs, key, text, hot)
    f = cut(factors(docs, candidates, key, text))
    sizes = member.groupBy("class_id").agg(F.count("*").alias("n_copies"))
    linked = f.select(F.col("id").alias("class_id"), "other").distinct().join(sizes.select(F.col("class_id").alias("other"), "n_copies"), "other").groupBy("class_id").agg(F.sum("n_copies").alias("n_links"))
    covered = _merged(f).select("class_id", F.aggregate("spans", F.lit(0), lambda n, x: n + x["e"] - x["s"]).alias("covered"))
    base = docs.select(key, F.length(text).alias("n_chars")).join(member, key, "left").join(sizes, "class_id", "left").join(covered, "class_id", "left").join(linked, "class_id", "left")
    shared = F.when(F.col("n_copies") > 1, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0)))
    return base.select(key, F.coalesce("class_id", key).alias("class_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "n_chars", shared.alias("shared_chars"), F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(0.0).alias("shared_ratio"), (F.coalesce("n_links", F.lit(0)) + F.coalesce("n_copies", F.lit(1)) - 1).alias("n_links"))
