"""Byte-level BPE encoding and decoding by a rank file."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts
from .piececoder import SLICE, rank_coder


def character_spans(ids: np.ndarray, lengths: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points (start, end) that each token touches. A token that holds part of a character covers all of it."""
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    index = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    return index[starts], index[ends - 1] + 1


def decode_ids(ids: bytes, token_bytes: list[bytes]) -> bytes:
    """Bytes behind the ids. Characters split over tokens come together because bytes are joined before decoding."""
    return b"".join(map(token_bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode(docs: DataFrame, ranks: str, pattern: str, keep: Sequence[str] = ("doc_id",), text: str = "text",
           decoded: bool = False, offsets: bool = False) -> DataFrame:
    """`keep` columns with `ids`, the ids as little-endian unsigned 32-bit integers.

    decoded=True adds `decoded`, the bytes that the ids stand for, read back from the ids in the same pass.
    offsets=True adds `starts` and `ends`, code points per token. Null and empty texts have no ids. Repeated rows
    stay; other columns are dropped; a kept column named like a result gives way; an empty table gives an empty one.
    """
    fields = "ids binary" + ", decoded binary" * decoded + ", starts array<int>, ends array<int>" * offsets

    def work(texts) -> list:
        coder = rank_coder(ranks, pattern)
        ids = coder.encode(texts)
        out = [pa.array(ids, pa.binary())]
        if decoded:
            out.append(pa.array([decode_ids(i, coder.token_bytes) for i in ids], pa.binary()))
        if offsets:
            spans = [character_spans(np.frombuffer(i, "<u4"), coder.lengths, t or "") if i else ([], []) for i, t in zip(ids, texts.to_pylist())]
            out += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
        return out

    return map_texts(docs, work, fields, keep, text, as_arrow=True, most=SLICE)


def decode(encoded: DataFrame, ranks: str, pattern: str, keep: Sequence[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """`keep` columns with `decoded` (bytes) and `text`; null ids give empty ones. Bytes that are no UTF-8, as from
    ids that end inside a character, show as the replacement character in `text` and stay as they are in `decoded`."""
    from pyspark.sql import functions as F

    kept = [c for c in keep if c not in ("decoded", "text")]
    rows = encoded.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids}`").alias("__ids"))
    schema = rows.drop("__ids").withColumns({"decoded": F.lit(b""), "text": F.lit("")}).schema

    def run(batches):
        table = rank_coder(ranks, pattern).token_bytes
        for b in batches:
            raw = [decode_ids(i or b"", table) for i in b.column(len(kept)).to_pylist()]
            shown = [r.decode("utf-8", "replace") for r in raw]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], pa.array(raw, pa.binary()), pa.array(shown, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
