"""Documents dealt into batches by a hash of the row, texts compressed for the shuffle.

Operators that ask a corpus-wide table about every word or string position deal the
documents this way, so that each distinct key travels once a batch and answers come
back to the batch that asked. A batch is the same set of rows in every job, on
whichever executor it runs.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_bytes(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def packed(rows: DataFrame, n_batches: int) -> DataFrame:
    """``rows`` (doc_id, text, other columns) with ``batch`` and ``packed`` in place of ``text``."""
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)).cast("long"))
    kept = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in kept] + ["packed"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zipper = zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in kept), pa.array([zipper.compress(t) if t else b"" for t in texts], pa.binary())],
                names)

    return rows.mapInArrow(pack, T.StructType([*kept, T.StructField("packed", T.BinaryType())]))


def texts(pdf: pd.DataFrame) -> list[bytes]:
    unzip = zstandard.ZstdDecompressor()
    return [unzip.decompress(z) if z else b"" for z in pdf["packed"]]


def pack_arrays(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    return zlib.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def unpack_arrays(blob: bytes, *types) -> list[np.ndarray]:
    raw = zlib.decompress(blob)
    out, at = [], 8 * len(types)
    for n, t in zip(np.frombuffer(raw, np.int64, len(types)).tolist(), types):
        out.append(np.frombuffer(raw, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def pack_ints(*arrays: np.ndarray) -> bytes:
    """Arrays of integers of 0 or more, as planes of their bytes: small numbers take little room."""
    head, planes = [], []
    for a in arrays:
        a = np.ascontiguousarray(a, np.uint64)
        width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
        planes.append(a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
        head += [len(a), width]
    return zstandard.ZstdCompressor(level=9).compress(np.array(head, np.int64).tobytes() + b"".join(planes))


def unpack_ints(blob: bytes, number: int) -> list[np.ndarray]:
    """The ``number`` arrays of a blob, as int64 (64-bit hashes keep their bits)."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    out, at = [], 16 * number
    for n, width in np.frombuffer(raw, np.int64, 2 * number).reshape(-1, 2).tolist():
        a = np.zeros((n, 8), np.uint8)
        a[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(a.view(np.int64).reshape(-1))
        at += n * width
    return out
