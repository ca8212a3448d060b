"""Problem 3: noise in text from scanned pages.

One pass counts words, hyphenated compounds and character bigrams over all texts, a second counts skip-gram pairs of
the frequent words; only frequent words (at least `RATE` of all words, so at most 1 / RATE of them) and their
pair counts with the `CONTEXTS` most frequent (at least `PAIR_RATE` of all) reach the driver, where skip-gram
vectors with negative sampling are learned on those counts for every frequent word.

Words are linked to frequent neighbours with plausible glyph edits, found by walking a trie of the vocabulary. A
frequent word is linked where the contexts it was seen with lie near the vector of a word many times as frequent; a word too rare for a vector is
linked at each place by what its neighbours' vectors say of the words around. At each place the candidate is weighed
by its count and by how much likelier its vector makes the words around; the best one
is meant if it outweighs the word itself, else the word stays. Then furniture goes (repeated lines of problem 2, running titles, page numbers at the edges), cut
words are joined and paragraphs reflowed.

Defined results: a null text gives a null text and no lines; an empty one itself; line numbers count blank
lines from 1; pages of an unknown source have no repeated lines or titles. Texts are processed whole.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, map_columns, map_rows
from .boilerplate import Matcher, count_rows, filled_pages, fold_numbers, folded_lines, hashes, page_bucket, readable
from .chars import LookalikeModel, repair_encoding
from .lookalikes import JOIN, plain_tokens, token_bigrams

#: A word is frequent from this share of all words (and five times) on.
RATE = 2e-6
#: Words that are contexts of the vectors: the most frequent. Every frequent word gets a vector.
CONTEXTS = 2000
#: Words on each side that are context, and negative samples per pair.
WINDOW, NEGATIVE = 2, 5
#: Chance pairs added to those of each word that is no context, so that few pairs say little.
CHANCE = 20
#: Pairs of words reach the driver from this share of all words (and two times) on.
PAIR_RATE = 2e-8
#: A word is a damaged form only of a word this many times as frequent; of a word FEW times as frequent if their vectors are LIKE.
RATIO, FEW = 20, 3
#: The mean log odds of a frequent word's contexts under the vector of another one from which the two are near (a word with a digit
#: or sign in it is none by itself: from ODD on), and from which they are much alike.
NEAR, ODD, LIKE = 0.0, -1.0, 1.0
#: A word of two letters is meant only if it makes this share of all words.
SHORT_RATE = 0.002

# What print is misread as, and the letters meant.
GLYPHS = {
    "@": "a", "c": "e g", "0": "o", "j": "i", "ri": "n", "f": "t í e", "5": "s", "cl": "d", "|": "l i", "1": "l i", "l": "i t", "ii": "u",
    "rn": "m", "d": "ci", "q": "g", "6": "b ó", "y": "v", "b": "h", "fi": "ñ", "lvl": "m", "8": "b", "!": "l i", "vv": "w", "9": "g", "$": "s",
}
EDITS = {k: v.split() for k, v in GLYPHS.items()}
LONGEST = max(map(len, EDITS))

WORD = re.compile(r"[^\W_]+(?:[@|][^\W_]*)*|[@|]+[^\W_]+(?:[@|][^\W_]*)*")
CUT_END = re.compile(r"([^\W_]+(?:[@|][^\W_]*)*|[@|][^\W_]+(?:[@|][^\W_]*)*)([-¬])[ \t\r]*\Z")
STARTS = re.compile(r"[ \t]*([^\W_]+(?:[@|][^\W_]*)*|[@|][^\W_]+(?:[@|][^\W_]*)*)")
CUT_INSIDE = re.compile(r"([^\W\d_]+(?:[@|0-9][^\W_]*)*|[@|][^\W_]+)([-¬]) +([^\W\d_A-ZÁÉÍÓÚÑ][^\W_]*(?:[@|][^\W_]*)*|[@|0-9][^\W_]+)")
COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
MIXED = re.compile(r"(?<![\w@|])(?=[0-9lO]*[0-9])(?=[0-9lO]*[lO])[0-9lO]+(?![\w@|])")
ROMAN = re.compile(r"[ivxlc]+")
PAGE_NO = re.compile(r"(?:\W|_)*(?:p[aá]g(?:ina|\.)?\s*)?([0-9lOoISB]+|[ivxlc]+)(?:\s*(?:de|/)\s*[0-9lO]+)?(?:\W|_)*", re.I)
LESSON = re.compile(r"\W*l[ei]cc?i[oó0]n\W+[0-9lO]+\b", re.I)


def skeleton(text: str) -> str:
    """A key that glyph damage leaves mostly alike: both sides of each edit become one letter."""
    s = fold_numbers(" ".join(text.lower().split()))
    for a, b in (("lvl", "m"), ("rn", "m"), ("ri", "n"), ("cl", "d"), ("ci", "d"), ("ii", "u"), ("fi", "ñ")):
        s = s.replace(a, b)
    for a, b in SKELETON:
        s = s.replace(a, b)
    return s


# In this order: a letter meant is no other one misread further down.
SKELETON = tuple(zip("b6@0j|1!5cqyfñíáéóúl", "hbaoiiiisegvtniaeoui", strict=True))


class Vectors(dict):
    """Unit vectors by word, and the fitted skip-gram vectors: `inner` of every word, `outer` of the contexts.

    `seen` is the mean outer vector of the contexts that a word was seen with.
    """

    def __init__(self, unit: dict[str, np.ndarray] | None = None, inner: dict[str, np.ndarray] | None = None, outer: dict[str, np.ndarray] | None = None, seen: dict[str, np.ndarray] | None = None):
        super().__init__(unit or {})
        self.inner, self.outer, self.seen = inner or {}, outer or {}, seen or {}


class Vocabulary:
    """Frequent words with counts, compounds, vectors; decodes damaged words through glyph edits."""

    def __init__(self, counts: dict[str, int], compounds: dict[str, int], vectors: dict[str, np.ndarray] | None = None, links: dict[str, list[str]] | None = None):
        self.counts, self.compounds, self.memo, self.told = counts, compounds, {}, {}
        self.inner, self.outer, self.seen = (getattr(vectors, x, {}) for x in ("inner", "outer", "seen"))
        self.short = SHORT_RATE * sum(counts.values())
        self.trie: dict = {}
        for w in counts:
            node = self.trie
            for c in w:
                node = node.setdefault(c, {})
            node["$"] = w
        self.links = self._link() if links is None else links
        self.words = counts.keys() - self.links.keys()

    def _link(self) -> dict[str, list[str]]:
        """The frequent words that are damaged forms, with the words they may stand for: glyph neighbours near in vector space."""
        out = {}
        for w, n in self.counts.items():
            if w in self.seen:
                near = [v for v in self._walk(w, 2) if self.counts[v] >= FEW * n and self._near(w, v)]
                if near:
                    out[w] = near
        return out

    def _resolve(self, w: str) -> list[str]:
        """The words that a linked word stands for in the end; each link leads to a more frequent word."""
        return list(dict.fromkeys(x for v in self.links[w] for x in ([v] if v in self.words else self._resolve(v))))

    def _near(self, w: str, v: str) -> bool:
        """Would v make the words that w was seen with likelier than chance (or, if it is not much more frequent, much likelier)?"""
        if v not in self.inner:
            return False
        odds = float(self.inner[v] @ self.seen[w]) + math.log(NEGATIVE)
        return odds >= (NEAR if w.isalpha() else ODD) and self.counts[v] >= RATIO * self.counts[w] or odds >= LIKE and len(w) > 2

    def _walk(self, word: str, most: int) -> list[str]:
        """The frequent words that `word` may stand for by 1 to `most` glyph edits."""
        out, stack = {}, [(0, self.trie, 0)]
        n = len(word)
        while stack:
            i, node, edits = stack.pop()
            if i == n:
                if edits and "$" in node and node["$"] != word:
                    out[node["$"]] = min(edits, out.get(node["$"], 9))
                continue
            nxt = node.get(word[i])
            if nxt is not None:
                stack.append((i + 1, nxt, edits))
            if edits < most:
                for size in range(1, min(LONGEST, n - i) + 1):
                    for meant in EDITS.get(word[i : i + size], ()):
                        at = node
                        for c in meant:
                            at = at.get(c)
                            if at is None:
                                break
                        if at is not None:
                            stack.append((i + size, at, edits + 1))
        least = min(out.values(), default=0)
        return [w for w, e in out.items() if e == least]

    def candidates(self, word: str) -> list[str]:
        """Words meant by a lower-case word that is not itself one; empty if it is or nothing is plausible."""
        if word in self.words:
            return []
        got = self.memo.get(word)
        if got is None:
            if word in self.links:
                got = self._resolve(word)
            else:
                got = self._walk(word, min(4, 1 + len(word) // 2)) if len(word) > 1 else []
                got = list(dict.fromkeys(x for v in got for x in ([v] if v in self.words else self._resolve(v)) if self.counts[x] >= RATIO))
            got = [v for v in got if len(v) > 2 or self.counts[v] >= self.short or not v.isascii()]
            if len(self.memo) < 1_000_000:
                self.memo[word] = got
        return got

    def context(self, word: str, around: list[str]) -> float:
        """Log of how much likelier the words around are if `word` is meant; 0 where the vectors tell nothing."""
        out, told = 0.0, self.told
        for u in around:
            if u not in self.outer:
                continue
            got = told.get((word, u))
            if got is None:
                got = max(-3.0, min(3.0, float(self.inner[word] @ self.outer[u]) + math.log(NEGATIVE))) if word in self.inner else 0.0
                if len(told) < 1_000_000:
                    told[word, u] = got
            out += got
        return out

    def meant(self, word: str, around: list[str]) -> str | None:
        """The candidate meant at this place, by its count and the words around; None if the word itself is.

        What holds a digit or sign is no word, so there the words around only choose among the candidates.
        """
        score, best = max(((math.log(self.counts[v]) + self.context(v, around), v) for v in self.candidates(word)), default=(0.0, None))
        return best if best and (not word.isalpha() or score >= math.log(self.counts.get(word, 1))) else None

    def known(self, word: str) -> bool:
        return word in self.words or word.isdigit()


def count_words(texts: DataFrame, text: str = "text") -> tuple[dict[str, int], dict[str, int], dict[str, int]]:
    """(character bigrams, frequent words, compounds) over all texts, in one pass. The bigrams are those of `lookalikes.bigram_counts`."""

    def fn(values):
        raw: Counter = Counter()
        for t in values:
            if t:
                raw.update(plain_tokens(t))
        words: dict[str, int] = {}
        compounds: dict[str, int] = {}
        for token, n in raw.items():  # each distinct token once
            for w in WORD.findall(token):
                words[w] = words.get(w, 0) + n
            if "-" in token:
                for w in COMPOUND.findall(token):
                    compounds[w] = compounds.get(w, 0) + n
        rows = [(k, w, n) for k, c in (("w", words), ("c", compounds), ("b", token_bigrams(raw))) for w, n in c.items()]
        return [list(x) for x in zip(*rows, strict=True)] or [[], [], []]

    each = cut(map_columns(texts.where(F.col(text).isNotNull()).select(text), "kind string, word string, n bigint", fn).groupBy("kind", "word").agg(F.sum("n").alias("n")))
    total = {r["kind"]: r["n"] for r in each.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    least = F.when(F.col("kind") == "w", max(5, RATE * total.get("w", 0))).when(F.col("kind") == "c", max(3, RATE * total.get("c", 0))).otherwise(1)
    out: dict[str, dict[str, int]] = {"b": {}, "w": {}, "c": {}}
    for r in each.where(F.col("n") >= least).collect():
        out[r["kind"]][r["word"]] = r["n"]
    return out["b"], out["w"], out["c"]


class Pairs:
    """Counts the skip-gram pairs of texts: each pair is one number, a word's rank times the number of contexts and the context's rank."""

    def __init__(self, counts: dict[str, int], window: int = WINDOW):
        self.top = sorted(counts, key=lambda w: (-counts[w], w))
        self.size, self.window, self.least = min(CONTEXTS, len(self.top)), window, max(2, PAIR_RATE * sum(counts.values()))
        self.known = Ids({w: i for i, w in enumerate(self.top)})

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pairs, how often) in the lower-case texts."""
        gap, size = [""] * self.window, self.size  # what is no word has no id
        kind = np.int32 if len(self.top) * size < 2**31 else np.int64
        a = np.fromiter(map(self.known.__getitem__, chain.from_iterable(chain(t.split(), gap) for t in texts)), kind)
        keys = [np.empty(0, dtype=kind)]
        for d in range(1, self.window + 1):
            x, y = a[:-d], a[d:]
            less = np.minimum(x, y)
            keep = (less >= 0) & (less < size)
            x, y = x[keep], y[keep]
            key, far = x * kind(size) + y, np.flatnonzero(y >= size)  # the context is below size
            key[far] = y[far] * kind(size) + x[far]
            keys.append(key)
        keys = np.concatenate(keys)
        if len(self.top) * size > 16_000_000:  # too many counters for a batch
            return np.unique(keys, return_counts=True)
        n = np.bincount(keys, minlength=1)
        found = np.flatnonzero(n)
        return found, n[found]


class Ids(dict):
    """Of a token with its marks: the id of the word in it, -1 if it has none or several."""

    def __init__(self, ids: dict[str, int]):
        super().__init__()
        self.ids = ids

    def __missing__(self, token: str) -> int:
        found = WORD.findall(token)
        out = self.ids.get(found[0], -1) if len(found) == 1 else -1
        if len(self) < 500_000:
            self[token] = out
        return out


#: What a worker process keeps of the last passes it worked for, by their tokens.
_STATES: dict[str, object] = {}


def kept(token: str, make: Callable[[], object]):
    """What a pass keeps in this worker process from task to task: words and tokens once looked at stay known."""
    if token not in _STATES:
        while len(_STATES) > 1:
            _STATES.pop(next(iter(_STATES)))
        _STATES[token] = make()
    return _STATES[token]


def learn_vectors(texts: DataFrame, counts: dict[str, int], text: str = "text", dims: int = 24, steps: int = 120) -> Vectors:
    """Skip-gram vectors of all frequent words, fitted on the pair counts of all texts."""
    pairs = Pairs(counts)

    def fn(values):
        return list(map(pa.array, pairs.count([t.lower() for t in values])))

    rows = map_columns(texts.where(F.col(text).isNotNull()).select(text), "pair bigint, n bigint", fn).groupBy("pair").agg(F.sum("n").alias("n"))
    return fit_vectors(rows.where(F.col("n") >= pairs.least).toPandas(), pairs, dims, steps)


def count_lines_and_pairs(pages: DataFrame, bigrams: dict[str, int], counts: dict[str, int]) -> tuple[DataFrame, Vectors]:
    """(line counts for `boilerplate.excess_keys`, vectors), both counted in one pass over the texts."""
    own, token = (LookalikeModel(bigrams), pairs := Pairs(counts)), uuid.uuid4().hex

    def fn(sources, texts, numbers):
        model, pairs = kept(token, lambda: own)
        low = [readable(t, model).lower() for t in texts]
        each = [hashes({k for k in folded_lines(t) if len(k) > 1 and k.islower()} if s is not None else ()) for s, t in zip(sources, low, strict=True)]
        size = [len(x) for x in each]
        keys, n = pairs.count(low)
        none = np.zeros(len(keys), np.int64)
        of = np.repeat(hashes([s or "" for s in sources]), size)
        return [
            pa.array(np.concatenate([of, none]), mask=np.concatenate([np.zeros(len(of), bool), np.ones(len(keys), bool)])),  # pairs have no source
            pa.array(np.concatenate([*each, keys])), pa.array(np.concatenate([np.repeat(np.array(numbers, np.int64), size), none])), pa.array(np.concatenate([np.ones(len(of), np.int64), n])),
        ]

    both = count_rows(map_columns(filled_pages(pages, "publication_id", "page_number", "text"), "s bigint, h bigint, number bigint, n bigint", fn))
    rows = both.where("s is null").where(F.col("c") >= pairs.least).select(F.col("h").alias("pair"), F.col("c").alias("n")).toPandas()
    return both.where("s is not null"), fit_vectors(rows, pairs)


def fit_vectors(rows, pairs: Pairs, dims: int = 24, steps: int = 120, negative: int = NEGATIVE) -> Vectors:
    """Skip-gram vectors with negative sampling, fitted on pair counts.

    The most frequent words are fitted together; each other word then to their context vectors, which are kept.
    """
    top, size = pairs.top, pairs.size
    if size < 2:
        return Vectors()
    ids = {w: i for i, w in enumerate(top)}
    own, other, n = rows.pair.to_numpy() // size, rows.pair.to_numpy() % size, rows.n.to_numpy()
    m = np.zeros((size, size), dtype=np.float32)
    m[own[own < size], other[own < size]] = n[own < size]
    m += m.T
    total = m.sum()
    if not total:
        return Vectors()
    share = m.sum(axis=1) / total
    expected = negative * total * share[:, None] * share[None, :]
    most = (m + expected).max()
    m, expected = (m / most).astype(np.float32), (expected / most).astype(np.float32)
    rng = np.random.default_rng(7)
    w, c = (rng.normal(0, 0.1, (size, dims)).astype(np.float32) for _ in range(2))
    mw = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(c), np.zeros_like(c)]
    both, g = m + expected, np.empty_like(m)
    for step in range(1, steps + 1):
        np.matmul(w, c.T, out=g)  # g becomes m - both * sigmoid(w c), in place
        np.clip(g, -30, 30, out=g)
        np.negative(g, out=g)
        np.exp(g, out=g)
        g += 1
        np.divide(both, g, out=g)
        np.subtract(m, g, out=g)
        for k, (p, grad) in enumerate(((w, g @ c), (c, g.T @ w))):
            a, b = mw[2 * k], mw[2 * k + 1]
            a *= 0.9
            a += 0.1 * grad
            b *= 0.99
            b += 0.01 * grad * grad
            p += 0.05 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
    del m, expected, both, g
    w = np.concatenate([w, *(_fit_to(c, share, own, other, n, lo, min(lo + 500, len(top)), negative, steps) for lo in range(size, len(top), 500))])
    v = w / (np.linalg.norm(w, axis=1, keepdims=True) + 1e-9)
    back = own < size  # pairs of two contexts count for both
    ends, far, times = np.concatenate([own, other[back]]), np.concatenate([other, own[back]]), np.concatenate([n, n[back]])
    size_ = np.maximum(np.bincount(ends, weights=times, minlength=len(top)), 1)
    seen = np.stack([np.bincount(ends, weights=times * c[far, k], minlength=len(top)) / size_ for k in range(dims)], axis=1)
    return Vectors(*({word: x[i] for word, i in ids.items()} for x in (v, w)), {word: c[i] for word, i in ids.items() if i < size}, {word: seen[i] for word, i in ids.items()})


def _fit_to(c: np.ndarray, share: np.ndarray, own: np.ndarray, other: np.ndarray, n: np.ndarray, lo: int, hi: int, negative: int, steps: int) -> np.ndarray:
    """Vectors of the words lo to hi, which are no contexts, fitted to the context vectors c."""
    m = np.repeat((CHANCE * share)[None, :], hi - lo, axis=0).astype(np.float32)
    here = (own >= lo) & (own < hi)
    m[own[here] - lo, other[here]] += n[here]
    size = m.sum(axis=1, keepdims=True)
    m /= size
    both = m + np.float32(negative) * share[None, :].astype(np.float32)
    w = np.zeros((hi - lo, c.shape[1]), dtype=np.float32)
    a, b = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        grad = (m - both / (1 + np.exp(-np.clip(w @ c.T, -30, 30)))) @ c
        a = 0.9 * a + 0.1 * grad
        b = 0.99 * b + 0.01 * grad * grad
        w += 0.05 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
    return w


class Tokens(dict):
    """Of a blank-separated lower-case token in which something may be misread: whether digits and letters are mixed in it.

    Each distinct token is looked at once; those with nothing misread are `plain`.
    """

    def __init__(self, vocabulary: "Vocabulary"):
        super().__init__()
        self.v, self.plain = vocabulary, set()

    def odd(self, tokens: Iterable[str]) -> dict[str, bool]:
        """Those of the tokens in which something may be misread."""
        return {x: mixed for x in set(filterfalse(self.plain.__contains__, tokens)) if (mixed := self[x]) is not None}

    def __missing__(self, token: str) -> bool | None:
        mixed = MIXED.search(token.replace("o", "O")) is not None
        some = mixed or any(w not in self.v.words and self.v.candidates(w) for w in WORD.findall(token))
        if len(self) + len(self.plain) < 1_000_000:
            if some:
                self[token] = mixed
            else:
                self.plain.add(token)
        return mixed if some else None


class Page:
    """One page taken apart: readable lines, furniture, cut words, misread words."""

    def __init__(self, text: str, number: int | None, matcher: Matcher, titles: set[str], vocabulary: Vocabulary, model: LookalikeModel, tokens: Tokens | None = None):
        self.v, self.tokens = vocabulary, Tokens(vocabulary) if tokens is None else tokens
        whole = readable(text, model)
        self.lines = whole.split("\n")
        low = whole.lower()
        self.low = low.split("\n")
        self.cuts = "-" in low or "¬" in low
        self.gaps = self.cuts and ("- " in low or "¬ " in low)
        if len(self.low) != len(self.lines):  # lower() never makes lines, but be safe
            self.low = [x.lower() for x in self.lines]
            low = "\n".join(self.low)
        self.keys = folded_lines(low)
        self.text, self.said = low, [x.split() for x in self.low]
        self.furniture = self._furniture(number, matcher, titles)
        self.own = [i for i, x in enumerate(self.keys) if x and i not in self.furniture]
        self.fixes: dict[int, list[tuple[int, int, str]]] = {}
        self.joins: dict[int, int] = {}  # line whose last word goes on in another
        self.inside: set[int] = set()
        self._words()

    def _lines_with(self, parts: Iterable[str]) -> set[int]:
        """The lines that hold one of the texts, be it inside a word."""
        find, out = self.text.find, set()
        ends = [n + i for i, n in enumerate(accumulate(map(len, self.low)))]
        for x in parts:
            at = find(x)
            while at >= 0:
                i = bisect_right(ends, at)
                out.add(i)
                at = find(x, ends[i])
        return out

    def _furniture(self, number: int | None, matcher: Matcher, titles: set[str]) -> set[int]:
        filled = [i for i, x in enumerate(self.keys) if x]
        keys, said, exact, near, reach, apart = self.keys, self.said, matcher.exact, matcher.near, matcher.reach, matcher.telling.isdisjoint
        out = {i for i in filled if (keys[i] in exact or (len(keys[i]) <= reach or not apart(said[i])) and near(keys[i], said[i])) and keys[i].islower()}
        for side in (filled, filled[::-1]):
            n = 0
            for i in side:
                if i in out:
                    continue
                if self._is_number(self.lines[i], number):
                    out.add(i)
                    continue
                if side is filled and n == 0 and self._is_title(i, titles):
                    out.add(i)
                    continue
                n += 1
                if n >= 1:
                    break
        return out

    @staticmethod
    def _is_number(line: str, number: int | None) -> bool:
        if number is None or len(line.strip()) > 24:
            return False
        m = PAGE_NO.fullmatch(line.strip())
        if not m:
            return False
        said = m.group(1)
        if ROMAN.fullmatch(said.lower()) and not any(c in "lO" for c in said) or said.lower() in ("l", "li", "ll"):
            return roman(number) == said.lower().replace("l", "i") or roman(number) == said.lower()
        return said.translate(AS_DIGIT) == str(number)

    def _is_title(self, i: int, titles: set[str]) -> bool:
        line = self.lines[i]
        if LESSON.match(line):
            return True
        return bool(titles) and skeleton(line.strip().rstrip(".")) in titles

    def _words(self) -> None:
        v, skip = self.v, {}  # of a line: where words start that are seen to as cut ones
        own = self.own
        for k in [k for k, i in enumerate(own[:-1]) if self.said[i][-1][-1] in "-¬"] if self.cuts else ():
            i = own[k]
            line = self.low[i]
            m = CUT_END.search(line, line.rindex(self.said[i][-1]))
            j = self.own[k + 1]
            n = STARTS.match(self.low[j])
            if m and n and not m.group(1).isdigit():
                first = self.lines[j].strip()[:1]
                if (first.islower() or first in "@|0156" or self.lines[i].isupper()) and self._is_cut(m.group(1), n.group(1), m.group(2)):
                    self.joins[i] = j
                skip.setdefault(i, set()).add(m.start(1))
                skip.setdefault(j, set()).add(n.start(1))
                self._joined(i, m, j, n)
        for i in own if self.gaps else ():
            line = self.low[i]
            if "- " in line or "¬ " in line:
                for m in CUT_INSIDE.finditer(line):
                    if self._is_cut(m.group(1), m.group(3), m.group(2)):
                        self.inside.add(i)
                        skip.setdefault(i, set()).update((m.start(1), m.start(3)))
                        whole = m.group(1) + m.group(3)
                        w = None if v.known(whole) else v.meant(whole, self._around(i, m.start(1), m.end(3)))
                        if w:
                            self.fixes.setdefault(i, []).append((m.start(1), m.end(3), w))
        odd_tokens = self.tokens.odd(chain.from_iterable(map(self.said.__getitem__, own)))
        if not odd_tokens:
            return
        mixed = [x for x in odd_tokens if odd_tokens[x]]
        known, lines, digits = v.words, self._lines_with(odd_tokens), self._lines_with(mixed) if mixed else ()
        for i in [i for i in own if i in lines]:
            said, cut = WORD.findall(self.low[i]), skip.get(i, ())
            spans = [m.span() for m in WORD.finditer(self.low[i])] if cut else []
            hits = []
            for k in [k for k, word in enumerate(said) if word not in known]:
                if v.candidates(said[k]) and not (cut and spans[k][0] in cut):
                    w = v.meant(said[k], said[max(0, k - WINDOW) : k] + said[k + 1 : k + 1 + WINDOW])
                    if w:
                        hits.append((k, w))
            odd = list(MIXED.finditer(self.lines[i])) if i in digits else []
            if not hits and not odd:
                continue
            good = sum(map(known.__contains__, said)) + len(hits)
            if good * 2 < len(said):
                good += sum(x not in known and (x.isdigit() or bool(cut) and spans[k][0] in cut) for k, x in enumerate(said))
            if good * 2 < len(said) or len(said) < 3 and len(self.lines[i]) > 3 * sum(map(len, said)) + 60:
                continue
            if hits:
                spans = spans or [m.span() for m in WORD.finditer(self.low[i])]
                self.fixes.setdefault(i, []).extend((*spans[k], w) for k, w in hits)
            for m in odd:
                before, after = self.lines[i][: m.start()][-1:], self.lines[i][m.end() :][:1]
                if before in ":.-" and before or after == ":" or after == "-":
                    self.fixes.setdefault(i, []).append((m.start(), m.end(), m.group().translate(AS_DIGIT)))

    def _around(self, i: int, start: int, end: int) -> list[str]:
        """The words of line i next to a part of it."""
        return WORD.findall(self.low[i][:start])[-WINDOW:] + WORD.findall(self.low[i][end:])[:WINDOW]

    def _is_cut(self, a: str, b: str, mark: str) -> bool:
        v = self.v
        if a.isdigit() or b.isdigit():
            return False
        if mark == "¬":
            return True
        compound, whole = v.compounds.get(f"{a}-{b}", 0), v.counts.get(a + b, 0)
        if whole or compound:
            return whole > compound
        if v.candidates(a + b):
            return True
        x, y = ((w if w in v.words else next(iter(v.candidates(w)), "")) for w in (a, b))
        return not (x and y and (v.compounds.get(f"{x}-{y}", 0) or (len(x) > 4 and len(y) > 4)))

    def _joined(self, i: int, m: re.Match, j: int, n: re.Match) -> None:
        """A misread character in a word that is cut: on which of its two lines does it stand?"""
        a, b = m.group(1), n.group(1)
        v = self.v
        if i in self.joins:
            whole = a + b
            w = None if v.known(whole) else v.meant(whole, self._around(i, m.start(1), len(self.low[i])) + self._around(j, 0, n.end(1)))
            if not w:
                return
            if not w.startswith(a):
                self.fixes.setdefault(i, []).append((m.start(1), m.end(1), w[: len(a)]))
            if not w.endswith(b):
                self.fixes.setdefault(j, []).append((n.start(1), n.end(1), w[max(0, len(w) - len(b)) :]))
        else:
            for k, x in ((i, m), (j, n)):
                w = v.meant(x.group(1), self._around(k, x.start(1), x.end(1)))
                if w:
                    self.fixes.setdefault(k, []).append((x.start(1), x.end(1), w))

    def found(self) -> Iterator[tuple[int, str]]:
        for i in sorted(self.furniture):
            yield i + 1, "furniture"
        for i in sorted(self.inside | set(self.joins)):
            yield i + 1, "hyphen"
        for i in sorted(self.fixes):
            yield i + 1, "glyph"

    def repaired(self) -> str:
        """Continuous paragraphs of corrected words: furniture gone, cut words joined, lines reflowed."""
        lines: dict[int, str] = {}
        for i in self.own:
            x = self.lines[i]
            for s, e, w in sorted(self.fixes.get(i, ()), reverse=True):
                x = x[:s] + (w.upper() if x[s:e].isupper() and e - s > 1 else w.capitalize() if x[s : s + 1].isupper() else w) + x[e:]
            if i in self.inside:
                x = CUT_INSIDE.sub(lambda m: m.group(1) + m.group(3) if self._is_cut(m.group(1).lower(), m.group(3).lower(), m.group(2)) else m.group(), x)
            lines[i] = x.strip()
        out: list[str] = []
        part: list[str] = []
        for i, raw in enumerate(self.lines):
            if i in self.furniture:
                continue
            if not raw.strip():
                if part:
                    out.append(" ".join(part))
                    part = []
                continue
            x = lines[i]
            if STRUCTURE.match(x) and part:
                out.append(" ".join(part))
                part = []
            if part and part[-1][-1:] in "-¬" and any(self.joins.get(k) == i for k in self.joins):
                part[-1] = part[-1][:-1] + x
            else:
                part.append(x)
            if ENTRY.search(x) or STRUCTURE.match(x) and x.endswith((".", ":")):
                out.append(" ".join(part))
                part = []
        if part:
            out.append(" ".join(part))
        return "\n\n".join(out)


AS_DIGIT = str.maketrans("lIOoSB", "110058")
STRUCTURE = re.compile(r"(?:[•*–-]|\d{1,3}[.)]|[A-Za-z][.)]|[IVX]+\.)\s|.*(?:\t|\s\|\s|\s;\s.*\s;\s)|(?:[123] )?[A-ZÁÉÍÓÚ][a-záéíóúñ]+ \d+:\d+")
ENTRY = re.compile(r"\.{4,}\s*\d*$|_{4,}$|\t|\s\|\s")


def roman(n: int) -> str:
    out = ""
    for value, sign in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        if n > 399:
            return ""
        while n >= value:
            out += sign
            n -= value
    return out


def with_context(pages: DataFrame, keys: DataFrame, titles: DataFrame | None, bucket: int = 16) -> DataFrame:
    """Pages with their source's repeated-line keys and the titles of the lessons around the page.

    The join is on (publication, page_number / bucket), so a hot publication is spread over its buckets and
    each joined list is short. titles: publication_id, title, first, last (page numbers).
    """
    at = page_bucket("page_number", bucket).alias("bucket")
    places = pages.where("publication_id is not null").select("publication_id", at).distinct()
    near = keys.groupBy("publication_id").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    side = places.join(near, "publication_id", "left")
    if titles is not None:
        ends = pages.groupBy("publication_id").agg(F.max("page_number").alias("end"))
        last = F.greatest(F.coalesce("last", F.col("first") + bucket), "first")  # no page lies behind a publication's end
        spread = (
            titles.where("title is not null and first is not null")
            .join(ends, "publication_id")
            .withColumn("low", F.floor((F.col("first") - 2) / bucket))
            .withColumn("high", F.floor(F.least(last, "end") / bucket))
            .where("low <= high")
            .select("publication_id", "title", F.explode(F.sequence("low", "high")).alias("bucket"))
            .groupBy("publication_id", "bucket")
            .agg(F.sort_array(F.collect_set("title")).alias("titles"))
        )
        side = side.join(spread, ["publication_id", "bucket"], "left")
    else:
        side = side.withColumn("titles", F.lit(None).cast("array<string>"))
    return pages.select("page_id", "publication_id", "page_number", "text", at).join(side, ["publication_id", "bucket"], "left").select("page_id", "page_number", "text", "keys", "titles")


def take_apart(pages: DataFrame, keys: DataFrame, titles: DataFrame | None, vocabulary: tuple, bigrams: dict[str, int], rows, schema: str) -> DataFrame:
    """Maps rows(page_id, Page or None, text) over all pages. The vocabulary is broadcast (its size is bounded by 1 / RATE words) and built once per worker."""
    links = Vocabulary(*vocabulary).links
    shared, token = pages.sparkSession.sparkContext.broadcast((*vocabulary, links, bigrams)), uuid.uuid4().hex

    def start() -> dict:
        *words, pairs = shared.value
        v = Vocabulary(*words)
        return {"v": v, "t": Tokens(v), "m": {}, "h": {}, "l": LookalikeModel(pairs)}

    def fn(ids, numbers, texts, lists, names):
        state = kept(token, start)
        known, heads_, model = state["m"], state["h"], state["l"]

        def head(title: str) -> str:
            got = heads_.get(title)
            if got is None:
                got = skeleton(model.normalize(repair_encoding(title, model)[0])[0].strip().rstrip("."))
                if len(heads_) < 200_000:
                    heads_[title] = got
            return got

        for k, n, t, ks, ts in zip(ids, numbers, texts, lists, names, strict=True):
            if not t:
                yield from rows(k, None, t)
                continue
            at = tuple(ks or ())
            if at not in known:
                if len(known) > 500:
                    known.clear()
                known[at] = Matcher(list(at))
            heads = set(map(head, ts or ()))
            yield from rows(k, Page(t, n, known[at], heads, state["v"], model, state["t"]), t)

    return map_rows(with_context(pages, keys, titles), schema, fn)


def found(*args) -> DataFrame:
    def rows(k, page, _):
        if page:
            for n, kind in page.found():
                yield k, n, kind

    return take_apart(*args, rows, "page_id bigint, line_no int, kind string")


def repaired(*args) -> DataFrame:
    def rows(k, page, text):
        yield k, page.repaired() if page else text, len(page.furniture) if page else 0, len(page.joins) + len(page.inside) if page else 0, sum(map(len, page.fixes.values())) if page else 0

    return take_apart(*args, rows, "page_id bigint, repaired_text string, lines_removed int, words_joined int, words_corrected int")
