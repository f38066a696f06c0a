"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pre-tokenisation pattern of that vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_tokenizer(path: str = VOCABULARY, pattern: str = PATTERN):
    """A byte-level BPE encoding from a file of base64 tokens and ranks."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, key: str, text: str, *keep: str, path: str = VOCABULARY) -> DataFrame:
    """(key, *keep, tokens): the size of each whole text; null and empty texts have 0 tokens. One pass, no shuffle."""
    columns = [key, *keep]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns) + ", tokens bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = None
        for pdf in batches:
            encoding = encoding or load_tokenizer(path)
            sizes = [len(encoding.encode_ordinary(t)) if t else 0 for t in pdf[text]]
            yield pdf[columns].assign(tokens=pd.Series(sizes, index=pdf.index, dtype="int64"))

    return docs.select(*columns, text).mapInPandas(run, schema)
