"""Problem 6: visually identical text with different characters.

Compatibility normalization and deletion of ignorable characters come first; letters of another script
then span a look-alike lattice per token, which Viterbi decodes under character bigrams of the corpus with
a penalty for changing script inside a word (`chars.LookalikeModel`). The bigrams are counted over all
texts; only their sums (bounded by the square of the alphabet) reach the driver.

Wrongly decoded sequences (problem 5) are restored before, so they do not count as look-alikes. A null or
empty text gives itself and 0.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_columns, map_rows
from .chars import LookalikeModel, repair_encoding, word_bigrams

STRIP = " .,;:()[]¿?¡!“”«»\"'…|*•–—-_·©"


# A word cut at a line's end, or behind blanks where lines ran together.
JOIN = re.compile(r"[-¬](?<=[^\W\d_][-¬])(?:[ \t\r]*\n[ \t]*|(?<=¬) +)(?=[^\W\d_A-ZÁÉÍÓÚÑ])")


def plain_tokens(text: str) -> list[str]:
    """The lower-case blank-separated tokens of a text, its encoding restored and cut words joined."""
    low = repair_encoding(text, words=False)[0].lower()
    return (JOIN.sub("", low) if "-" in low or "¬" in low else low).split()


def token_bigrams(tokens: dict[str, int]) -> dict[str, int]:
    """Character bigrams of counted tokens."""
    pairs: dict[str, int] = {}
    for w, n in tokens.items():
        word_bigrams(w.strip(STRIP), n, pairs)
    return pairs


def bigram_counts(texts: DataFrame, text: str = "text") -> dict[str, int]:
    """Character bigrams of all words of `texts`.

    Only words of one of the scripts that look alike count (Latin, Greek, Cyrillic: under 1,700 letters, and no
    pair across scripts), so what reaches the driver is bounded by their alphabets, not by the data.
    """

    def fn(values):
        words: Counter = Counter()
        for t in values:
            if t:
                words.update(plain_tokens(t))
        pairs = token_bigrams(words)
        return [list(pairs), list(pairs.values())]

    counted = map_columns(texts.where(F.col(text).isNotNull()).select(text), "pair string, n bigint", fn)
    return {r["pair"]: r["n"] for r in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect()}


def normalize(df: DataFrame, bigrams: dict[str, int], key: str, text: str, name: str, with_text: bool = True) -> DataFrame:
    """(table_name, record_id, n_changed[, normalized]) for each row; without texts only rows with n_changed > 0."""
    model = LookalikeModel(bigrams)

    def fn(keys, texts):
        for k, t in zip(keys, texts, strict=True):
            out, n = model.normalize(repair_encoding(t, model)[0])
            if with_text:
                yield name, k, n, out
            elif n:
                yield name, k, n

    schema = "table_name string, record_id bigint, n_changed int" + ", normalized string" * with_text
    return map_rows(df.select(key, text), schema, fn)
