"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.sources.folders import materialized, shared_folder

__all__ = ["at_end", "by_bytes", "files", "map_arrow", "materialized", "put", "shared_folder", "table", "worker_cache"]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, across the tasks it runs."""
    name = "_shelfline_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("values", {})


def at_end(do: Callable[[], None]) -> None:
    """Have ``do`` called when the running task's :func:`map_arrow` function ends."""
    worker_cache().setdefault("at end", []).append(do)


def map_arrow(rows: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``rows.mapInArrow(fn, schema)`` whose workers, which Spark keeps for later tasks, hand back to the
    system what they held when a task ends: an executor's other stages need that memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            for do in worker_cache().pop("at end", []):
                do()
            _release()

    return rows.mapInArrow(run, schema)


def _release() -> None:
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``most`` bytes, one row at least."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < len(sizes):
            yield batch.slice(start)


def put(uri: str, data: bytes) -> None:
    """Write a file from a task: under another name first, so that a name stands for a whole file
    and a repeated task replaces what it wrote. Local and other paths that Arrow opens by URI."""
    import os
    import uuid

    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    system.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{os.path.dirname(path)}/_{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, path)


def files(spark, folder: str) -> DataFrame:
    """``name, content`` of the finished files of a folder."""
    found = spark.read.format("binaryFile").load(folder).select("path", "content")
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(name.alias("name"), "content")
