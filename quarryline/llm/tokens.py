"""Token counts by a public tokenizer, whose files lie outside the repository."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the tokenizers' files, and the vocabulary taken from it.
FOLDER, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
#: How this vocabulary's makers cut text before merging: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def encoder(folder: str = FOLDER, vocabulary: str = VOCABULARY):
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, text: str, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """df's other columns and n_tokens, the length of the whole text in tokens; null and empty texts have 0. An n_tokens that df has is replaced."""
    others = [c for c in df.columns if c not in (text, "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(folder, vocabulary).encode_ordinary
        for batch in batches:
            counts = pa.array([len(encode(t.as_py())) if t.is_valid else 0 for t in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], counts], names=[*others, "n_tokens"])

    schema = df.select(*others).withColumn("n_tokens", F.lit(0).cast("long")).schema
    return df.select(text, *others).mapInArrow(run, schema)
