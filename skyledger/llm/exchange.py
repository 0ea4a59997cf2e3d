"""Packed exchange between blocks of documents and buckets of hashes.

Documents are dealt over blocks of a few megabytes. A block sends each bucket one row with all the hashes it has for it, as
arrays; the bucket, grouped by Spark's shuffle, sees what every block has and answers each block with one row. A hash that is
in a third of all documents is still one entry per block, so it cannot fill a bucket, and no list of links or fingerprints
passes through the driver. Lost tasks are recomputed from the shuffle's inputs like those of any grouping.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.common import block_count, documents, in_blocks

BLOCK_BYTES = 4 << 20


def blocked(docs: DataFrame, block_bytes: int, id_col: str = "doc_id", text_col: str = "text", further: list[str] = ()) -> tuple[DataFrame, int]:
    """``(block, doc_id, text, *further)`` and the number of blocks, in proportion to the bytes of the corpus."""
    texts = documents(docs, id_col, text_col, further)
    blocks = block_count(texts, block_bytes)
    return in_blocks(texts, blocks).select("block", "doc_id", "text", *further), blocks


def schema(columns: list[str]) -> str:
    return "bucket int, block int, " + ", ".join(f"{name} binary" for name in columns)


def arrow_schema(columns: list[str]) -> pa.Schema:
    return pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *[(name, pa.binary()) for name in columns]])


def parcels(target: np.ndarray, **columns: np.ndarray) -> list[tuple[int, dict[str, np.ndarray]]]:
    """Cut arrays by target: ``(target, its part of every column)``, in order of the targets."""
    if not len(target):
        return []
    order = np.argsort(target, kind="stable")
    target = target[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(target)) + 1, [len(target)]))
    sorted_ = {name: column[order] for name, column in columns.items()}
    return [(int(target[a]), {name: column[a:b] for name, column in sorted_.items()}) for a, b in zip(cuts, cuts[1:], strict=False)]


def letters(sent: list[tuple[int, int, dict[str, np.ndarray | bytes]]], columns: list[str]) -> pa.Table:
    """Rows of ``(bucket, block, *columns)``."""
    rows = {"bucket": [x[0] for x in sent], "block": [x[1] for x in sent]}
    for name in columns:
        rows[name] = [x[2][name] if isinstance(x[2][name], bytes) else x[2][name].tobytes() for x in sent]
    return pa.table(rows, schema=arrow_schema(columns))


def received(table: pa.Table, **columns: str) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """All rows' arrays one behind the other, by name and type, and the block that every entry comes from."""
    parts = {name: [np.frombuffer(x.as_py(), dtype=kind) for x in table.column(name)] for name, kind in columns.items()}
    joined = {name: np.concatenate(part) if part else np.zeros(0, dtype=columns[name]) for name, part in parts.items()}
    lengths = [len(part) for part in next(iter(parts.values()))]
    return np.repeat(np.asarray(table.column("block")), lengths), joined


def texts_of(table: pa.Table) -> list[tuple[int, str]]:
    """The distinct ``(doc_id, text)`` rows of a block, by id and text: the same order in every step."""
    return sorted(set(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True)))


def planes(values: np.ndarray) -> bytes:
    """The bytes of an array by significance: sorted or small numbers then compress well."""
    return values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def whole(data: bytes, width: int) -> np.ndarray:
    """Numbers of ``width`` bytes written by ``planes``."""
    parts = np.frombuffer(data, dtype=np.uint8).reshape(width, -1)
    out = np.zeros((parts.shape[1], 8), dtype=np.uint8)
    out[:, :width] = parts.T
    return out.view("<u8").ravel()


def narrow(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit numbers, by significance."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
