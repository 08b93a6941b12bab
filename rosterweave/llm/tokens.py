"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoding(path: str):  # noqa: ANN201
    """The tokenizer of a rank file, loaded once for each worker process."""
    held = sys.modules.setdefault("_rosterweave_held", types.ModuleType("_rosterweave_held")).__dict__
    if path not in held:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        held[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return held[path]


def token_counts(docs: DataFrame, id_col: str, text_col: str, *keep: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(id_col, *keep, n_tokens)``; a null or empty text has 0 tokens."""
    columns = [id_col, *keep]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(tokenizer)
        for batch in batches:
            out = batch[columns].copy()
            out["n_tokens"] = [len(enc.encode_ordinary(t)) if t else 0 for t in batch[text_col]]
            yield out

    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in columns) + ", n_tokens long"
    return docs.select(*dict.fromkeys([*columns, text_col])).mapInPandas(count, schema)
