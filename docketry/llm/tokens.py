"""Token counts of texts under a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Place of the vocabulary; the files are never copied into the repository.
TOKENIZER = os.environ.get("DOCKETRY_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")

# Fixed value: the published split pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict = {}


def encoder(path: str = TOKENIZER):
    """The encoder of a vocabulary file, made once per process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encoders[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_count(text: Column, path: str = TOKENIZER) -> Column:
    """Tokens of the whole text; 0 for null and empty. Marked as not deterministic, so that no filter takes a second copy of it along."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        e = encoder(path)
        return texts.map(lambda t: len(e.encode_ordinary(t)) if t else 0).astype("int64")

    return count.asNondeterministic()(text)
