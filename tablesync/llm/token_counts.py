"""Token counts: batch encoding in an Arrow function that returns lengths only.

Batches are balanced by bytes of text, long texts are split at safe boundaries
(see ``bpe``).  No shuffle: one scan, one Arrow pass.

Edge cases: null or empty text has 0 tokens and 0 bytes; a null id stays null;
repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.bpe import encoder, read_tokenizer
from tablesync.llm.common import arrow_map, balanced

MAX_TOKENS = 2048
BATCH_BYTES = 4 << 20


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", max_tokens: int = MAX_TOKENS,
                 batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens`` (no special tokens added)
    and ``over_limit`` (more than ``max_tokens``)."""
    spec = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = encoder(spec.value, lengths_only=True)
        for part, texts in balanced(batches, "text", batch_bytes):
            counts = np.asarray(lengths.batch(texts), np.int64)
            sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), sizes, pa.array(counts), pa.array(counts > max_tokens)],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    out = arrow_map(slim, encode, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
