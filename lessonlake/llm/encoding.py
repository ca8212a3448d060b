"""Problem 5: text that was decoded with a wrong encoding.

Best-first graph search: a state is a piece of text, an edge unescapes it or encodes it with one encoding and
decodes it with another, visited states are kept by hash, and a character-plausibility cost guides the
search to the cheapest reachable text (`chars.search_run`). The pieces searched are a text's maximal runs
of non-ASCII characters, which repeat, so a worker searches each distinct run once. A piece that reaches no
plausible text and holds lost bytes is reported as beyond repair. Between two single-byte encodings nothing in the
bytes tells right from wrong, so there the whole word is the piece and the corpus' character bigrams are the cost
(`chars.reread`).

Defined results: a null or empty text comes back as it is with zero counts; repeated rows each give their
own row; other columns of the input are not read and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_rows
from .chars import LookalikeModel, repair_encoding


def repair(df: DataFrame, bigrams: dict[str, int] | None = None, key: str = "page_id", text: str = "text") -> DataFrame:
    """(key, restored_text, runs_restored, runs_lost, operations) for every row."""
    kind = df.schema[key].dataType.simpleString()
    model = LookalikeModel(bigrams) if bigrams else None

    def fn(keys, texts):
        for k, t in zip(keys, texts, strict=True):
            out, fixed, lost, ops = repair_encoding(t, model)
            yield k, out, fixed, lost, sorted(ops)

    return map_rows(df.select(key, text), f"{key} {kind}, restored_text string, runs_restored int, runs_lost int, operations array<string>", fn)


def affected(df: DataFrame, bigrams: dict[str, int] | None = None, key: str = "page_id", text: str = "text") -> DataFrame:
    """(key, runs_restored, runs_lost) of the rows with at least one wrongly decoded sequence."""
    kind = df.schema[key].dataType.simpleString()
    model = LookalikeModel(bigrams) if bigrams else None

    def fn(keys, texts):
        for k, t in zip(keys, texts, strict=True):
            _, fixed, lost, _ = repair_encoding(t, model)
            if fixed or lost:
                yield k, fixed, lost

    return map_rows(df.where(F.col(text).isNotNull()).select(key, text), f"{key} {kind}, runs_restored int, runs_lost int", fn)
