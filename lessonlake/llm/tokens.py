"""Token counts of texts under a public tokenizer (a parameter; its files stay where they are)."""

from __future__ import annotations

import base64
import os

from pyspark.sql import DataFrame

from .base import map_rows

TOKENIZER = os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
# Fixed value: the pattern this vocabulary splits text by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENCODINGS: dict = {}


def encoding(path: str = TOKENIZER):
    """The tiktoken encoding of a rank file, built once per worker."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), path: str = TOKENIZER) -> DataFrame:
    """(key, *keep, n_tokens) for every row; a null or empty text has 0 tokens."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def fn(texts, *columns):
        encode = encoding(path).encode_ordinary
        for t, *rest in zip(texts, *columns, strict=True):
            yield *rest, len(encode(t)) if t else 0

    names = (key, *keep)
    return map_rows(docs.select(text, *names), ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", n_tokens bigint", fn)
