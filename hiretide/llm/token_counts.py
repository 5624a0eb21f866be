"""Token counts of texts, by a tokenizer library inside Arrow functions that return lengths only.

A batch is cut into parts of about ``BATCH_BYTES`` of text, so that few long texts weigh like many
short ones; a text over ``PIECE_CHARS`` is split where no token can reach across, in front of a
single space between two non-space characters, and its pieces' counts are added. A text without such
a place is encoded whole.

Null and empty texts have 0 bytes and 0 tokens. Rows are independent, so ties, repeated rows and
equal ids each give a row; columns other than id and text are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiretide.llm.common import arrow_map, by_bytes, type_of
from hiretide.llm.words import text_bytes

BATCH_BYTES, PIECE_CHARS = 1 << 20, 1 << 15
#: A token of these pre-tokenisers may begin with a space but never goes on over one.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def safe_pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of at least ``most`` characters (but the last), cut at safe places."""
    start = 0
    while len(text) - start > most:
        cut = _SAFE.search(text, start + most)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


@lru_cache(maxsize=2)
def _json_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _piece_model(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def count_tokens(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text, without added special tokens."""
    if path.endswith(".model"):
        ids = _piece_model(path).encode(texts, num_threads=1)
        return np.fromiter(map(len, ids), np.int64, len(texts))
    pieces, owner = [], []
    for i, text in enumerate(texts):
        for piece in safe_pieces(text):
            pieces.append(piece)
            owner.append(i)
    encoded = _json_tokenizer(path).encode_batch_fast(pieces, add_special_tokens=False)
    lengths = np.fromiter(map(len, encoded), np.int64, len(pieces))
    return np.bincount(owner, lengths, len(texts)).astype(np.int64)


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, and whether the tokens exceed ``limit``."""

    def run(batch: pa.RecordBatch):
        for part in by_bytes(batch, batch.schema.names[1], BATCH_BYTES):
            texts = [t or "" for t in part.column(1).to_pylist()]
            yield [part.column(0), pa.array(np.diff(text_bytes(part.column(1))[1])),
                   pa.array(count_tokens(texts, path))]

    counted = arrow_map(df.select(id_col, text_col), run, [
        (id_col, type_of(df, id_col)), ("n_bytes", T.LongType()), ("n_tokens", T.LongType())])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
