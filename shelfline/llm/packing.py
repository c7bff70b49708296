"""Best-fit packing of token sequences.

Documents become pieces of at most one sequence. Pieces go to packs of bounded size by a hash, so
that every pack sees the same mix of lengths and all packs are filled side by side; what is lost is
less than one sequence a pack. Inside a pack the longest pieces go first, each to the open sequence
that fits best: capacities (tokens, documents, attention cost) form a vector, every one of them has
to hold, and the fit is the weighted dot product of demand and residual, or the norm of what would
be left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import by_bytes, map_arrow, materialized
from shelfline.llm.tokens import BATCH_BYTES, encoder

SEQUENCE = 1024
#: Pieces in a pack, about.
PACK = 16_384


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", most: int = SEQUENCE, remembered: int | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``key, piece, start, length, ids_crc32``: every row's ids and then ``end_id``, cut into
    pieces of ``most`` ids of which only the first may be shorter. A null text is an empty one. ``remembered``
    bounds the pieces a worker keeps encoded, ``batch_bytes`` the text it encodes at a time."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, remembered)
        end = np.array([end_id], "<u4")
        for batch in by_bytes(batches, "text", batch_bytes):
            ids, ends = coder.encode(batch.column("text"))
            ids, begin = ids.astype("<u4", copy=False), 0
            of, piece, start, length, crc = [], [], [], [], []
            for row, stop in enumerate(ends.tolist()):
                total = stop - begin + 1
                at, width = 0, (total - 1) % most + 1
                for number in range(-(-total // most)):
                    part = ids[begin + at : min(begin + at + width, stop)].tobytes()
                    if at + width == total:
                        part += end.tobytes()
                    of.append(row)
                    piece.append(number)
                    start.append(at)
                    length.append(width)
                    crc.append(zlib.crc32(part))
                    at, width = at + width, most
                begin = stop
            columns = [batch.column("key").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "piece", "start", "length", "ids_crc32"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_arrow(rows, cut, f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(
    tokens: np.ndarray, most_tokens: int, most_documents: int | None = None, most_cost: float | None = None,
    score: str = "norm", weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
) -> np.ndarray:
    """The sequence of every piece, numbered from 0. ``tokens``: their lengths; a piece costs the
    square of its length in attention. None: no limit. ``score`` is ``norm``, the smallest weighted
    norm of the residual left, or ``dot``, the smallest weighted product of demand and residual."""
    size = len(tokens)
    caps = np.array([most_tokens, most_documents or max(size, 1), most_cost or float(most_tokens) ** 2], np.float64)
    demand = np.stack([tokens, np.ones(size), np.square(tokens.astype(np.float64))], axis=1) / caps
    if size and demand.max() > 1:
        raise ValueError("a piece is above a capacity on its own")
    bound = np.array([most_tokens is not None, most_documents is not None, most_cost is not None])
    w = np.where(bound, np.asarray(weights, np.float64), 0.0)
    used = np.flatnonzero(bound)
    left = np.empty((len(used), max(size, 1)))
    number = np.empty(max(size, 1), np.int64)
    placed = np.empty(size, np.int64)
    opened = made = 0
    smallest = demand.min(0)[used] if size else None
    slack = 1e-12
    for i in np.argsort(-tokens, kind="stable"):
        need = demand[i, used]
        rest = left[:, :opened] - need[:, None]
        fits = (rest >= -slack).all(0)
        if fits.any():
            fit = (w[used, None] * rest * rest).sum(0) if score == "norm" else (w[used] * need) @ left[:, :opened]
            b = int(np.argmin(np.where(fits, fit, np.inf)))
            left[:, b] = rest[:, b]
            placed[i] = number[b]
        else:
            b, opened = opened, opened + 1
            left[:, b] = 1 - need
            number[b] = placed[i] = made
            made += 1
        if (left[:, b] < smallest - slack).any():
            # Nothing fits any more: closed.
            opened -= 1
            left[:, b], number[b] = left[:, opened], number[opened]
    return placed


def pack(
    pieces: DataFrame, most_tokens: int = SEQUENCE, most_documents: int | None = None, most_cost: float | None = None,
    score: str = "norm", weights: tuple[float, float, float] = (1.0, 1.0, 1.0), pack_size: int = PACK,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, the tokens before a piece in its sequence.

    Pieces are rows: repeated ones are packed each. They are written to the shared folder first, so
    that no text is encoded twice and a lost task packs the same pieces again. No piece, no row.
    """
    held = materialized(pieces, "pieces")
    packs = max(1, -(-held.count() // pack_size))
    row = F.monotonically_increasing_id()
    dealt = held.withColumn("_row", row).withColumn("_pack", F.pmod(F.xxhash64("_row"), F.lit(packs)))
    columns = held.columns

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row", kind="stable", ignore_index=True)
        lengths = frame["length"].to_numpy(np.int64)
        frame["sequence_id"] = best_fit(lengths, most_tokens, most_documents, most_cost, score, weights) + frame["_pack"].iloc[0] * (1 << 32)
        frame["offset"] = frame.groupby("sequence_id")["length"].cumsum() - frame["length"]
        return frame[[*columns, "sequence_id", "offset"]]

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields)
    return dealt.groupBy("_pack").applyInPandas(fill, f"{ddl}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", most: int = SEQUENCE, remembered: int | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` of every document of ``docs``.

    Null and empty texts are a piece of one token, the end. Null keys and repeated rows are packed
    like others, an empty table gives an empty result, other columns are not read.
    """
    return pack(token_pieces(docs, tokenizer, end_id, key, text, most, remembered, batch_bytes), most).withColumnRenamed("key", key)
