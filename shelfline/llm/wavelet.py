"""Token ids as wavelet matrices, one compressed file per shard.

A shard holds the ids of consecutive documents as bit planes, most significant bit first; below each
plane the sequence is rearranged, zeros before ones, both in order. With counts of ones before every
block of a plane, ``rank`` and ``select`` answer which token is at a place, how often a token occurs
and where, without decoding the shard.

File: the mark ``WVM1``, the length of a JSON header (4 bytes, little endian), the header, then
Zstandard frames: the planes (bits from the lowest of each byte), the counts of ones before every
512 bits of each plane, the documents' keys, their numbers of ids and whether the key is known.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import by_bytes, files, map_arrow, materialized, put, shared_folder
from shelfline.llm.tokens import BATCH_BYTES, encoder
from shelfline.plans.lookup import lookup_join

MARK = b"WVM1"
BLOCK = 512
#: Ids in a shard, about; a document is never cut.
SHARD = 1 << 21


class WaveletMatrix:
    """A sequence of numbers below ``2 ** levels``."""

    def __init__(self, planes: list[np.ndarray], size: int, ones_before: list[np.ndarray] | None = None):
        self.planes, self.size, self.levels = planes, size, len(planes)
        words = -(-size // 64) + 1
        self.words = [np.frombuffer(p.tobytes().ljust(words * 8, b"\0"), "<u8") for p in planes]
        self.before = [np.concatenate([[0], np.cumsum(np.bitwise_count(w), dtype=np.int64)]) for w in self.words]
        self.zeros = [size - int(b[-1]) for b in self.before]
        if ones_before is not None and any((a != b).any() for a, b in zip(ones_before, self.directory(), strict=True)):
            raise ValueError("the counts of a plane do not fit it")

    @classmethod
    def build(cls, values: np.ndarray, levels: int) -> WaveletMatrix:
        if len(values) and int(values.max()) >> levels:
            raise ValueError(f"a value does not fit {levels} bits")
        now, planes = values.astype(np.uint16 if levels <= 16 else np.uint32), []
        for level in range(levels - 1, -1, -1):
            bit = now & now.dtype.type(1 << level) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            now = np.concatenate([now.compress(~bit), now.compress(bit)])
        return cls(planes, len(values))

    def directory(self) -> list[np.ndarray]:
        """Ones before every block of each plane."""
        return [b[:-1][:: BLOCK // 64].astype("<u4") for b in self.before]

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def _nth(self, level: int, n: np.ndarray, one: bool) -> np.ndarray:
        """Place of the one (or zero) of a plane that has ``n`` such before it."""
        before = self.before[level]
        counts = before if one else np.arange(len(before)) * 64 - before
        word = np.searchsorted(counts, n, side="right") - 1
        bits = np.unpackbits(self.words[level][word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") == one
        return word * 64 + np.argmax(np.cumsum(bits, axis=1) > (n - counts[word])[:, None], axis=1)

    def access(self, places: np.ndarray) -> np.ndarray:
        """The values at the places."""
        at = np.asarray(places, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.size):
            raise IndexError("no such place")
        value = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            one = (self.words[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(level, at)
            at = np.where(one, self.zeros[level] + ones, at - ones)
            value = value << 1 | one
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the value's occurrences before ``end`` lie below the last plane."""
        at = np.array([0, end], np.int64)
        for level in range(self.levels):
            ones = self._ones(level, at)
            at = self.zeros[level] + ones if value >> (self.levels - 1 - level) & 1 else at - ones
        return int(at[0]), int(at[1])

    def count(self, value: int, end: int | None = None) -> int:
        """How often the value occurs before ``end``."""
        begin, stop = self._range(value, self.size if end is None else end)
        return stop - begin

    def locate(self, value: int) -> np.ndarray:
        """All places of the value, ascending."""
        begin, stop = self._range(value, self.size)
        at = np.arange(begin, stop)
        for level in range(self.levels - 1, -1, -1):
            one = bool(value >> (self.levels - 1 - level) & 1)
            at = self._nth(level, at - self.zeros[level] if one else at, one)
        return at

    def decode(self) -> np.ndarray:
        """The whole sequence."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        now = np.zeros(self.size, kind)
        for level in range(self.levels - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.size, bitorder="little").astype(bool)
            up = np.empty_like(now)
            up[~bit] = now[: self.zeros[level]]
            up[bit] = now[self.zeros[level] :] | kind(1 << (self.levels - 1 - level))
            now = up
        return now.astype(np.uint32)


def to_file(values: np.ndarray, levels: int, keys: list, lengths: list[int]) -> bytes:
    """A shard's file."""
    matrix = WaveletMatrix.build(values, levels)
    known = np.array([k is not None for k in keys], np.uint8)
    parts = [b"".join(p.tobytes() for p in matrix.planes), b"".join(d.tobytes() for d in matrix.directory())]
    parts += [np.array([k or 0 for k in keys], "<i8").tobytes(), np.array(lengths, "<i8").tobytes(), known.tobytes()]
    frames = [zstandard.ZstdCompressor(level=1).compress(p) for p in parts]
    header = json.dumps({"size": matrix.size, "levels": levels, "documents": len(keys), "frames": [len(f) for f in frames]}).encode()
    return b"".join([MARK, len(header).to_bytes(4, "little"), header, *frames])


def from_file(data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """The sequence, the keys of its documents and where each ends."""
    if data[:4] != MARK:
        raise ValueError("not a wavelet matrix file")
    at = 8 + int.from_bytes(data[4:8], "little")
    header, parts = json.loads(data[8:at]), []
    for length in header["frames"]:
        parts.append(zstandard.ZstdDecompressor().decompress(data[at : at + length]))
        at += length
    size, levels = header["size"], header["levels"]
    planes = np.frombuffer(parts[0], np.uint8).reshape(levels, -(-size // 8))
    directory = np.frombuffer(parts[1], "<u4").reshape(levels, -1)
    matrix = WaveletMatrix(list(planes), size, list(directory))
    keys = [k if known else None for k, known in zip(np.frombuffer(parts[2], "<i8").tolist(), parts[4], strict=True)]
    return matrix, keys, np.cumsum(np.frombuffer(parts[3], "<i8"))


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", shard: int = SHARD
) -> DataFrame:
    """Encode every whole text, ``end_id`` after each, and write ``folder`` in ascending order of the
    key (null first). Returns the list of files: ``part, number, name, documents, size``.

    Rows are ranged by key, so a hot spot needs one and the same key. Null texts are empty, repeated
    rows are documents of their own, an empty table makes no file. Keys are whole numbers.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        levels = max(coder.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id, 1).bit_length()
        part, number = TaskContext.get().partitionId(), 0
        values, keys, lengths, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"{part:08d}-{number:06d}.wvm"
            put(f"{folder}/{name}", to_file(np.concatenate(values), levels, keys, lengths))
            row = {"part": [part], "number": [number], "name": [name], "documents": [len(keys)], "size": [held]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int64()), ("number", pa.int64()), ("name", pa.string()), ("documents", pa.int64()), ("size", pa.int64())]))

        for batch in by_bytes(batches, "text", BATCH_BYTES):
            ids, ends = coder.encode(batch.column("text"))
            ids = np.insert(ids, ends, end_id)
            of = np.diff(np.concatenate([[0], ends])) + 1
            at = 0
            for k, length in zip(batch.column("key").to_pylist(), of.tolist(), strict=True):
                values.append(ids[at : at + length])
                keys.append(k)
                lengths.append(length)
                at, held = at + length, held + length
                if held >= shard:
                    yield flush()
                    values, keys, lengths, held, number = [], [], [], 0, number + 1
        if keys:
            yield flush()

    ranged = rows.repartitionByRange("key").sortWithinPartitions("key")
    return materialized(map_arrow(ranged, write, "part bigint, number bigint, name string, documents bigint, size bigint"), "shards")


def read_shards(spark, folder: str) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document in the files of ``folder``: ``start``
    counts the ids of all documents before it, in this file and those whose names come before."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content"), strict=True):
                matrix, keys, ends = from_file(content.as_py())
                data = matrix.decode().astype("<u4", copy=False)
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                crc = [zlib.crc32(data[b:e].tobytes()) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array([name.as_py()] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(begins), pa.array(ends - begins), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["name", "key", "begin", "n_tokens", "ids_crc32"])

    decoded = materialized(map_arrow(files(spark, folder), read, "name string, key bigint, begin bigint, n_tokens bigint, ids_crc32 bigint"), "decoded")
    part, number = (F.split("name", "[-.]").getItem(i).cast("long") for i in (0, 1))
    listed = decoded.groupBy("name").agg(F.sum("n_tokens").alias("size")).withColumns({"part": part, "number": number})
    # Ids before a part: one row a task; before a file of it: one row a file.
    parts = listed.groupBy("part").agg(F.sum("size").alias("_size"))
    earlier = F.sum("_size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(earlier, F.lit(0)).alias("_part"))
    inside = F.sum("size").over(Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    starts = listed.withColumn("_file", F.coalesce(inside, F.lit(0))).join(parts, "part").select("name", (F.col("_part") + F.col("_file")).alias("_start"))
    placed = lookup_join(decoded, starts, "name", "inner")
    return placed.select("key", (F.col("_start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", shard: int = SHARD) -> DataFrame:
    """Write all documents to shards in the shared folder and read them back."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "wavelet")
    listed = write_shards(docs, folder, tokenizer, end_id, key, text, shard)
    if listed.isEmpty():
        return spark.createDataFrame([], "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint").withColumnRenamed("key", key)
    return read_shards(spark, folder).withColumnRenamed("key", key)
