"""Token counts of whole texts.

Arrow functions that return lengths only. Batches are balanced by bytes, so that one with very long
texts needs no more memory than others; long texts are split where a pre-token surely ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import by_bytes, map_arrow
from shelfline.llm.tokens import BATCH_BYTES, encoder


def token_counts(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 512, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    Tokens are those the library gives for the file ``tokenizer`` without added special tokens,
    truncation or padding. Null and empty texts have 0 bytes and 0 tokens. Null keys, repeated rows
    and ties are counted row by row; an empty table gives an empty result; other columns are not
    read. No shuffle.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(tokenizer)
        for batch in by_bytes(batches, "text", batch_bytes):
            texts = batch.column("text")
            n_bytes = pa.compute.binary_length(texts).fill_null(0).cast(pa.int64())
            n_tokens = pa.array(counter.count(texts), pa.int64())
            over = pa.compute.greater(n_tokens, limit)
            yield pa.RecordBatch.from_arrays([batch.column("key"), n_bytes, n_tokens, over], ["key", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_arrow(rows, count, f"key {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("key", key)
