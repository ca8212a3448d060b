"""Character-level repair: wrong decodings (best-first search) and look-alike characters (Viterbi).

Everything here is plain Python over one text and is called from Arrow-batched Spark functions. A text
without any unusual character leaves after one compiled regular-expression scan.
"""

from __future__ import annotations

import heapq
import html
import math
import re
import unicodedata
from functools import cache

# Characters that ordinary Spanish, Portuguese or English print uses besides ASCII.
ORDINARY = "áéíóúüñÁÉÍÓÚÜÑ¿¡«»“”‘’—–…·ºª°§©²³¹½¼¾¬•¤±"
UNUSUAL = re.compile(f"[^\x00-\x7f{ORDINARY}]")

# The single-byte encodings searched.
ENCODINGS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251")


def char_cost(c: str, memo: dict[str, float] = {}) -> float:  # noqa: B006 - a process-wide memo
    """How implausible a character is in the corpus' languages (0: plain, 6: surely damage)."""
    got = memo.get(c)
    if got is not None:
        return got
    o = ord(c)
    if o < 0x80:
        cost = 0.0
    elif c in "áéíóúüñÁÉÍÓÚÜÑ¿¡":
        cost = 0.2
    elif c in ORDINARY and c not in "¬¤±":
        cost = 0.5
    elif o < 0xA0 or c == "�":
        cost = 5.0 if o < 0xA0 else 6.0
    elif 0x370 <= o < 0x3E2 or 0x1F00 <= o < 0x2000 or 0x590 <= o < 0x600:
        cost = 0.8
    elif 0x400 <= o < 0x530:
        cost = 1.5
    else:
        kind = unicodedata.category(c)
        if kind[0] == "L":
            cost = 1.2 if o < 0x180 else 3.0
        elif kind in ("Cn", "Co", "Cs"):
            cost = 6.0
        else:
            cost = 2.0 if o < 0x100 or kind in ("Mn", "Zs", "Cf") else 3.0
    memo[c] = cost
    return cost


def text_cost(text: str) -> float:
    return sum(map(char_cost, text))


def _bytes(text: str, encoding: str) -> bytes | None:
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        if encoding != "cp1252":
            return None
    out = bytearray()  # the undefined bytes of cp1252 are usually passed through as C1 controls
    for c in text:
        try:
            out += c.encode("cp1252")
        except UnicodeEncodeError:
            if ord(c) > 0xFF:
                return None
            out.append(ord(c))
    return bytes(out)


def _steps(text: str, reread: bool):
    """The texts one operation away: unescape, or encode with one encoding and decode as UTF-8 or, if `reread`, with another one."""
    if "&" in text:
        plain = html.unescape(text)
        if plain != text:
            yield plain, "unescape", reread
    for encoding in ENCODINGS:
        raw = _bytes(text, encoding)
        if raw is None:
            continue
        try:
            yield raw.decode("utf-8"), f"{encoding}>utf-8", reread
        except UnicodeDecodeError:
            pass
        if reread:
            for other in ENCODINGS:
                if other != encoding:
                    try:
                        yield raw.decode(other), f"{encoding}>{other}", False
                    except UnicodeDecodeError:
                        pass


def _final(text: str) -> bool:
    """May the search end here? Cyrillic is only ever a stage on the way in these languages."""
    return not any(0x400 <= ord(c) < 0x530 for c in text)


#: What a run costs at least that no operation makes plausible: a lost byte, as U+FFFD, a C1 control or a `?` behind a lead byte.
LOST_COST = 5.0
LEADS = "ÃÂâÎÏ×"
GONE = re.compile(f"(?<=[{LEADS}])\\?+")


def search_run(run: str, gain: float = 0.8) -> tuple[str, tuple[str, ...], float]:
    """Best-first search from one run of non-ASCII characters to the cheapest text that can be reached.

    States are texts, visited states are kept by hash, the queue is ordered by plausibility cost plus a
    little for every step. Edges decode as UTF-8 or unescape; both shorten a text, so the search ends by itself. (Between
    single-byte encodings the bytes give no evidence; `reread` searches those edges with the word as context.)
    Returns the text, the operations and the cost; the run itself, () and its cost if nothing is cheaper by `gain`.
    A run that stays at `LOST_COST` or more is lost.
    """
    start = text_cost(run) + 3.0 * (run[0] == "&") + 4.0 * sum(map(len, GONE.findall(run)))  # an escape is no text, a lost byte no question
    best, best_cost, best_path = run, start, ()
    queue, seen = [(start, 0, run, ())], {hash(run)}
    while queue:
        _, depth, text, path = heapq.heappop(queue)
        for other, name, _ in _steps(text, False):
            h = hash(other)
            if h in seen:
                continue
            seen.add(h)
            cost, via = text_cost(other), (*path, name)
            if cost + 0.1 * len(via) < best_cost + 0.1 * len(best_path) and cost <= start - gain and _final(other):
                best, best_cost, best_path = other, cost, via
            heapq.heappush(queue, (cost + 0.1 * len(via), depth + 1, other, via))
    return best, best_path, best_cost


_RUNS: dict[str, tuple[str, tuple[str, ...], float]] = {}


def _run(run: str) -> tuple[str, tuple[str, ...], float]:
    got = _RUNS.get(run)
    if got is None:
        if len(_RUNS) > 200_000:
            _RUNS.clear()
        got = _RUNS[run] = search_run(run)
    return got


# Runs as they are searched: with the question marks behind a lead byte whose other bytes had no character.
BARE_RUNS = re.compile(f"[^\x00-\x7f]+(?:(?<=[{LEADS}])\\?+)?")
RUNS = re.compile(f"{BARE_RUNS.pattern}|&(?:#[0-9]{{2,6}}|#x[0-9A-Fa-f]{{2,5}}|[A-Za-z]{{2,8}}[0-9]?);")


def repair_encoding(text: str | None, model: "LookalikeModel | None" = None, words: bool = True) -> tuple[str | None, int, int, tuple[str, ...]]:
    """(text with its wrongly decoded runs restored, runs restored, runs beyond repair, operations used).

    Each distinct run is searched once; then words with a sign or letter that is none of the languages' are read
    again in other single-byte encodings (`reread`), unless `words` is false. Null gives null, 0, 0.
    """
    if not text or not (UNUSUAL.search(text) or "&" in text or words and SIGN_IN_WORD.search(text)):
        return text, 0, 0, ()
    known, odd, runs = {}, False, RUNS if "&" in text else BARE_RUNS
    for run in set(runs.findall(text)):
        _, path, cost = _run(run)
        odd = odd or bool(path) or cost >= LOST_COST
        if path and len(run) > 1 and (run[0] == "&" or UNUSUAL.search(run)):
            known[path] = True
    fixed = lost = 0

    def put(m: re.Match) -> str:
        nonlocal fixed, lost
        run = m.group()
        out, path, cost = _run(run)
        if path and len(run) > 1 and (path in known or UNUSUAL.search(run)):
            fixed += 1
            lost += len(LOST.findall(out))
            return out
        # signs that occur by themselves count only beside others of the same wrong decoding
        if cost >= LOST_COST and (LOST.search(run) or known or _cut_off(text, m)):
            lost += len(LOST.findall(run)) or 1
        elif known and run[-1] in LEADS and m.end() == len(text):
            lost += 1
        return run

    out = runs.sub(put, text) if odd or known else text
    paths = [" ".join(p) for p in known]
    if words and SUSPECT.search(out):
        out, n, more = _reread_words(out, model)
        fixed += n
        paths += sorted(more)
    return out, fixed, lost, tuple(paths)


def _cut_off(text: str, m: re.Match) -> bool:
    """Do question marks behind a lead byte stand where no question ends: in a word or, after a quote's first byte, between blanks?"""
    run, before, after = m.group(), text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
    if run == "â??":
        return before in ("", " ", "\n") and after == " "
    return run == "Ã?" and (before.isalpha() and before.islower() or after.isascii() and after.islower())


LOST = re.compile("[\x80-\x84\x86-\x9f�]")

SPANISH = "áéíóúüñÁÉÍÓÚÜÑ"
# What may be a letter read in another single-byte encoding: neither ASCII nor a letter, mark or blank of print,
# or a capital of print or a fraction or sign inside a small-letter word.
SIGNS, IN_WORD = "¼½¾§±¤¹²³ÁÉÍÓÚÜÑ", "(?<=[a-záéíóúüñ].)(?=[a-záéíóúüñ])"
SIGN_IN_WORD = re.compile(f"[¢{SIGNS}]{IN_WORD}")
# What begins with one set of characters is searched several times as fast as alternatives are.
NO_SIGN_OR_IN_WORD = f"(?:(?<![{SIGNS}])|{IN_WORD})"
STRANGE = re.compile(f"[^\x00-\x7f{''.join(c for c in ORDINARY if c not in SIGNS)}]{NO_SIGN_OR_IN_WORD}")  # UNUSUAL or SIGN_IN_WORD
SUSPECT = re.compile(f"[^\x00-\x7fáéíóúüñ¿¡«»“”‘’—–…·•¬ºª°©\xa0\xad\u0300-\u036f\u2000-\u200f\u2010-\u2012\u2028-\u202f\u205f-\u206f\u3000\ufeff\ufe00-\ufe0f\ufffd\x80-\x9f]{NO_SIGN_OR_IN_WORD}")


def _letter(c: str) -> bool:
    return c.isalpha() or c in "¼½¾¢§±¤¹²³" or not c.isascii() and SUSPECT.match(c) is not None


def _reread_words(text: str, model: "LookalikeModel | None") -> tuple[str, int, set[str]]:
    out, end, n, paths = [], 0, 0, set()
    for m in SUSPECT.finditer(text):
        i = m.start()
        if i < end:
            continue
        a, b = i, i + 1
        while a > end and _letter(text[a - 1]):
            a -= 1
        while b < len(text) and _letter(text[b]):
            b += 1
        said = reread(text[a:b], model)
        if said:
            out += text[end:a], said[0]
            paths.add(said[1])
            n += 1
        else:
            out.append(text[end:b])
        end = b
    out.append(text[end:])
    return "".join(out), n, paths


# What may be a character of several bytes that was read byte by byte.
SEQUENCE = re.compile("[^\x00-\x7f]{2}")
_REREAD: dict[str, tuple[str, str] | None] = {}


def reread(word: str, model: "LookalikeModel | None" = None, gain: float = 8.0, beyond: float = 6.0) -> tuple[str, str] | None:
    """(word, operations) if a word is far likelier as its bytes read in other encodings, else None.

    The same best-first search with the whole word as state and all pairs of encodings as edges; a path reads a word
    again in another single-byte encoding at most once, so it ends. With a model the words are weighed by its character
    bigrams, and the reading must also beat the word's look-alike reading; without one only a sign, a capital or a
    letter of another script inside a small-letter word is read again, if it is no look-alike.
    """
    memo = _REREAD if model is None else model.reread
    if word in memo:
        return memo[word]
    best, best_cost = None, math.inf
    if sum(c.isascii() and c.isalpha() for c in word) >= 3:
        if model is not None:
            cost_of = lambda w: -model.word_score(w)
            base, seen_as = cost_of(word) - gain, model.decode(word)
            if seen_as != word:
                base = min(base, cost_of(seen_as) - beyond)
        else:
            cost_of = text_cost
            strange = [c for c in word if SUSPECT.match(c) or c in "¼½¾¢§±¤¹²³" or c.isupper()]
            small = any(c.islower() and c.isascii() for c in word)
            odd = strange and all(not c.isalpha() or small and c.isupper() or script(c) != "L" for c in strange) and not any(c in LOOKALIKE and not c.isascii() for c in strange)
            base = text_cost(word) + 3.0 * len(strange) - 0.8 if odd and word[0].isascii() and not word[0].isupper() and word[-1].isascii() else -1.0
        queue, seen = [(cost_of(word), word, (), True)], {hash((word, True))}
        while queue:
            _, text, path, free = heapq.heappop(queue)
            for other, name, still in _steps(text, free):
                h = hash((other, still))
                if h in seen:
                    continue
                seen.add(h)
                cost, via = cost_of(other), (*path, name)
                if still or SEQUENCE.search(other):  # else no step is left
                    heapq.heappush(queue, (cost, other, via, still))
                plain = other.isalpha() and all(c.isascii() or c in SPANISH for c in other) and (other[1:].islower() or other.isupper())
                if plain and cost <= base and cost < best_cost and (model is None or cost <= 4.5 * (len(other) + 1)):
                    best, best_cost = (other, " ".join(via)), cost
    if len(memo) < 500_000:
        memo[word] = best
    return best


# Letters of other scripts by the Latin letter they look like.
LOOKALIKE = dict(
    zip(
        "авеѕіјкмнорсутхһԁԛԝγАВЕЅІЈКМНОРСТУХҮԚԜ",
        "abesijkmhopcytxhdqwyABESIJKMHOPCTYXYQW",
        strict=True,
    )
) | dict(
    zip(
        "ανορυικτχεςηωΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "avopuiktxecnwABEZHIKMNOPTYX",
        strict=True,
    )
) | dict(zip("άέίόύΆΈΊΌΎїёЁ", "áéíóúÁÉÍÓÚïëË", strict=True)) | {"в": "b", "м": "m", "н": "h", "т": "t", "к": "k", "ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "օ": "o"}

IGNORABLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿]")
SPACES = re.compile("[   -   　]")
HYPHENS = re.compile("[‐‑‒−﹣－]")
#: Compatibility characters that are ordinary print: ordinals, superscripts, fractions, dots, spacing accents, signs.
KEPT = set("ªº²³¹½¼¾…´¨¯¸µ™ⁿ⅓⅔⅛") | {chr(c) for c in range(0x2070, 0x209D)} | {chr(c) for c in range(0x2150, 0x2190)} | {"″", "‴", "№"}
COMPAT = re.compile("[ſĲĳĿŀŉǄ-ǌʰ-ʸ․-…₨℀-⅏Ⅰ-ⅿ①-⓿㈀-㏿ﬀ-ﬆ︰-﹯！-～￠-￮\U0001d400-\U0001d7ff]")
OTHER_SCRIPT = re.compile("[ıɑɡͰ-ϿЀ-ԯԱ-֏ἀ-῿]")
MARK = re.compile("[\u0300-\u036f]")
LATIN_MARK = re.compile("[A-Za-zÀ-ɏ][̀-ͯ]+")


@cache
def _kinds(c: str) -> tuple[re.Pattern, ...]:
    """What a character is that is none of ordinary print (… is COMPAT and stays as it is)."""
    return tuple(x for x in (IGNORABLE, SPACES, HYPHENS, COMPAT, MARK, OTHER_SCRIPT) if x.match(c))


def _in_word(c: str) -> bool:
    return c.isalpha() or "\u0300" <= c <= "\u036f"


def script(c: str) -> str:
    o = ord(c)
    if o < 0x250 or 0x1E00 <= o < 0x1F00 or o in (0x251, 0x261):
        return "L"
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "G"
    if 0x400 <= o < 0x530:
        return "C"
    return "O"


class LookalikeModel:
    """Character bigrams of the corpus' words; decodes look-alike lattices by Viterbi.

    `bigrams` maps two characters ("^" and "$" are the ends) to how often they stand in words of one script.
    """

    def __init__(self, bigrams: dict[str, int], switch: float = 12.0):
        self.switch, self.memo, self.reread = switch, {}, {}
        total: dict[str, int] = {}
        for pair, n in bigrams.items():
            total[pair[0]] = total.get(pair[0], 0) + n
        self.score = {pair: math.log((n + 0.1) / (total[pair[0]] + 20)) for pair, n in bigrams.items()}
        self.rare = {c: math.log(0.1 / (n + 20)) for c, n in total.items()}

    def _p(self, a: str, b: str) -> float:
        got = self.score.get(a + b)
        return got if got is not None else self.rare.get(a, -6.0)

    def word_score(self, word: str) -> float:
        """Log-likelihood of a word's characters."""
        w = f"^{word.lower()}$"
        return sum(map(self._p, w, w[1:]))

    def decode(self, token: str) -> str:
        """The likeliest reading of a word: each character stays or becomes the Latin letter it looks like."""
        got = self.memo.get(token)
        if got is not None:
            return got
        paths = {("^", ""): (0.0, "")}
        for c in token:
            choices = {c, LOOKALIKE.get(c, c)}
            step: dict[tuple[str, str], tuple[float, str]] = {}
            for (last, kind), (score, said) in paths.items():
                for x in choices:
                    k = script(x)
                    s = score + self._p(last.lower(), x.lower()) - (self.switch if kind and k != kind else 0.0) - (0.5 if x != c else 0.0)
                    if (x, k) not in step or s > step[x, k][0]:
                        step[x, k] = (s, said + x)
            paths = step
        best = max((score + self._p(last.lower(), "$"), said) for (last, _), (score, said) in paths.items())[1]
        if len(self.memo) < 500_000:
            self.memo[token] = best
        return best

    def normalize(self, text: str | None) -> tuple[str | None, int]:
        """(one consistent form of the text, how many characters only looked like it or were invisible)."""
        unusual = set(UNUSUAL.findall(text)) if text else ()
        if not unusual:
            return text, 0
        n, kinds = 0, set().union(*map(_kinds, unusual))  # only what the text holds is looked for
        for kind, plain in ((IGNORABLE, ""), (SPACES, " "), (HYPHENS, "-")):
            if kind in kinds:
                text, k = kind.subn(plain, text)
                n += k
        if COMPAT in kinds:
            text, k = COMPAT.subn(lambda m: m.group() if m.group() in KEPT else unicodedata.normalize("NFKC", m.group()), text)
            n += k - sum(map(text.count, "…™№"))
            kinds |= {x for x in (MARK, OTHER_SCRIPT) if x.search(text)}
        if MARK in kinds:
            text, k = LATIN_MARK.subn(lambda m: unicodedata.normalize("NFC", m.group()), text)
            n += k
        if OTHER_SCRIPT in kinds:
            out, end, changed = [], 0, 0
            for m in OTHER_SCRIPT.finditer(text):
                i = m.start()
                if i < end:
                    continue
                a, b = i, i + 1
                while a > end and _in_word(text[a - 1]):
                    a -= 1
                while b < len(text) and _in_word(text[b]):
                    b += 1
                word = text[a:b]
                said = self.decode(word)
                changed += sum(x != y for x, y in zip(word, said, strict=False))
                out += text[end:a], said
                end = b
            out.append(text[end:])
            text = "".join(out)
            n += changed
        return text, n


def word_bigrams(word: str, n: int, into: dict[str, int]) -> None:
    """Adds a word's character bigrams if all its letters are of one of the scripts that look alike."""
    if not word.isalpha():
        return
    if not word.isascii() and not ORDINARY_WORD.fullmatch(word):
        kinds = {script(c) for c in word}
        if len(kinds) != 1 or "O" in kinds:
            return
    w = f"^{word.lower()}$"
    for a, b in zip(w, w[1:], strict=False):
        p = a + b
        into[p] = into.get(p, 0) + n


ORDINARY_WORD = re.compile("[A-Za-záéíóúüñÁÉÍÓÚÜÑ]+")
