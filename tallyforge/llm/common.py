"""Helpers shared by the operators: texts in Arrow batches, per-worker models, grouped streams."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BATCH_BYTES = 4 << 20


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker: models loaded once, not once per task."""
    return sys.modules.setdefault("_tallyforge_worker", types.ModuleType("_tallyforge_worker")).__dict__


def byte_slices(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into slices of about `most` text bytes; a longer text is a slice of its own."""
    if batch.num_rows == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Returns freed memory to the system, which Arrow and the C library (glibc) keep for later."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, then `give_back`: Python workers outlive their tasks, and what idle ones keep is missing in later stages."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def map_texts(docs: DataFrame, work: Callable[[list], Sequence], fields: str, keep: Sequence[str], text: str = "text",
              as_arrow: bool = False, most: int = BATCH_BYTES) -> DataFrame:
    """The `keep` columns of every row plus the columns `fields` that `work(texts)` returns for a list of texts.

    Texts come whole, as a list in which null is None, or as they are in Arrow. A kept column that has the name of a new one gives way to it. Python
    holds one slice of about `most` bytes at a time.
    """
    added = StructType.fromDDL(fields)
    kept = [c for c in keep if c not in added.names]
    # Numbered names: Spark cannot pass columns whose names hold a dot to mapInArrow.
    rows = docs.select(*[F.col(f"`{c}`").alias(f"__{k}") for k, c in enumerate(kept)], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = StructType([StructField(c, f.dataType, f.nullable) for c, f in zip(kept, rows.schema.fields)] + added.fields)
    names, at = schema.names, len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, at, most):
                made = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in work(part.column(at) if as_arrow else part.column(at).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *made], names=names)

    return rows.mapInArrow(giving_back(run), schema)
