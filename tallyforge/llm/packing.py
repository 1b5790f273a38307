"""Packing of token sequences by multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stored
from .common import byte_slices, giving_back
from .piececoder import SLICE, json_coder

CAPACITY = 2048
#: A rest below the capacity is cut into even parts of at most this many tokens.
PART = 512
#: Pieces that are packed together.
GROUP = 1024
#: Room for the sequence numbers of a group.
STRIDE = 1 << 20


def cuts(length: int, capacity: int = CAPACITY, part: int = PART) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full sequences, then the rest in even parts."""
    full, rest = divmod(length, capacity)
    out = [(k * capacity, capacity) for k in range(full)]
    if rest:
        n = -(-rest // part)
        edges = [full * capacity + rest * k // n for k in range(n + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:])]
    return out


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", end_id: int = 1, with_ids: bool = False,
                 capacity: int = CAPACITY, part: int = PART) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens, and the ids if asked for.

    Where a document is cut depends on its length alone, so one pass encodes and cuts.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("body"))
    fields = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * with_ids
    schema = StructType.fromDDL(fields)
    closing = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot in byte_slices(batch, 1, SLICE):
                at, start, length, crc, tokens, kept = [], [], [], [], [], []
                for i, ids in enumerate(json_coder(tokenizer).encode(lot.column(1))):
                    ids += closing
                    for a, n in cuts(len(ids) // 4, capacity, part):
                        at.append(i)
                        start.append(a)
                        length.append(n)
                        crc.append(zlib.crc32(ids[4 * a : 4 * (a + n)]))
                        tokens.append(len(ids) // 4)
                        if with_ids:
                            kept.append(ids[4 * a : 4 * (a + n)])
                numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)]
                yield pa.RecordBatch.from_arrays([lot.column(0).take(pa.array(at, pa.int64())), *numbers, *([pa.array(kept, pa.binary())] if with_ids else [])], names=schema.names)

    return rows.mapInArrow(giving_back(run), schema)


def differencing(sizes: Sequence[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: indexes of `sizes` in `windows` nearly equal parts.

    Each size starts as a partition of its own. The two partitions with the largest spread merge, the heaviest part of
    one meeting the lightest of the other, until one is left. A partition holds only its parts that are not empty.
    """
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    children: list = []
    count = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        free = windows - len(a)  # both are in falling order; parts beyond their ends are empty
        if len(b) <= free:
            merged = a + b
        else:
            merged = a[: windows - len(b)]
            for (x, i), (y, j) in zip(a[windows - len(b) :], reversed(b[free:])):
                children.append((i, j))
                merged.append((x + y, -len(children)))
            merged += b[:free]
        merged.sort(reverse=True)
        heapq.heappush(heap, (-(merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)), count, merged))
        count += 1
    out: list[list[int]] = []
    for _, top in heap[0][2] if heap else []:
        part, todo = [], [top]
        while todo:
            i = todo.pop()
            if i >= 0:
                part.append(i)
            else:
                todo.extend(children[-i - 1])
        out.append(part)
    return out


def windows_of(sizes: Sequence[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Parts that fit the capacity; their number rises until they do."""
    n = -(-sum(sizes) // capacity)
    step = 1
    while True:
        parts = differencing(sizes, n)
        if all(sum(sizes[i] for i in p) <= capacity for p in parts):
            return parts
        n += step
        step += 1


def assign(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces (a stored table) with sequence_id and offset. Groups of about `group` pieces are drawn by a hash of id,
    start and the row's number in the table, so no document, source or length gathers in one, nor do repeated rows or
    those without an id; each is packed by one task."""
    n = pieces.count()
    numbered = pieces.withColumn("__row", F.monotonically_increasing_id())
    dealt = numbered.withColumn("__group", F.pmod(F.xxhash64("doc_id", "start", "length", "__row"), F.lit(max(1, -(-n // group)))))
    schema = StructType(pieces.schema.fields + StructType.fromDDL("sequence_id bigint, offset bigint").fields)
    names = schema.names

    def pack(key, table):
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("__row", "ascending")]).drop_columns(["__group", "__row"])
        sizes = table["length"].to_pylist()
        sequence, offset, number = [0] * len(sizes), [0] * len(sizes), key[0].as_py() * STRIDE
        short = [i for i, s in enumerate(sizes) if s < capacity]
        parts = [[i] for i, s in enumerate(sizes) if s == capacity] + [[short[j] for j in sorted(p)] for p in windows_of([sizes[i] for i in short], capacity)]
        for part in parts:
            filled = 0
            for i in part:
                sequence[i], offset[i] = number, filled
                filled += sizes[i]
            number += 1
        return table.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64())).select(names)

    return dealt.groupBy("__group").applyInArrow(pack, schema)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset.

    A document is its token ids and `end_id`; null and empty texts are that id alone. Full sequences stand for
    themselves; rests are cut into parts and differenced into windows of nearly equal size. Repeated rows are packed
    one by one. Other columns are dropped. An empty table gives no rows.
    """
    return assign(stored(token_pieces(docs, tokenizer, id_col, text, end_id, with_ids), "pieces"))
