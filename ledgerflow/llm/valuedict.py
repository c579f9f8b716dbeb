"""Vector code compression with per-dimension value dictionaries.

Every component x becomes the integer floor(scale * x). Vectors are held in blocks of
at most ``BLOCK_CELLS`` integers: per dimension the block's distinct integers, sorted (the
dictionary), and for each vector the position of its integer in it (the code). To
assign parts to codebook entries, a block tabulates the squared difference of every
dictionary integer to every entry; part distances are gathers from these tables by
code, added up. Sums for the next codebook are counts per (entry, code) times the
dictionary. A round reads the written blocks once and sends one row per (dimension,
entry) and block, added up by Spark; the driver sees the codebooks only.

Defined results: vectors that are null or hold null or non-finite components are
dropped, as are those of another length than the kept vector with the smallest id (ids
ascend, null last, ties by the vector). Lengths that the number of parts doesn't divide are cut at
floor(k * length / parts); an empty part has code 0 and adds no error. Integers
saturate at +-2**26, so squares stay exact. With fewer vectors than entries, the
codebook has as many entries as vectors. Repeated rows each count and each return;
an empty table gives no rows; other columns are ignored, whatever their names.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, tidy

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_CELLS = 1 << 20
LIMIT = 1 << 26


@dataclass
class Codebooks:
    """``entries``: one row of integers per entry, all parts side by side; ``cuts``: where parts begin and end."""
    cuts: list[int]
    entries: np.ndarray

    def digest(self) -> str:
        flat = [str(int(x)) for a, b in zip(self.cuts, self.cuts[1:]) for row in self.entries for x in row[a:b]]
        return hashlib.sha256(",".join(flat).encode()).hexdigest()

    def decode(self, code: str) -> list[int]:
        """The integers that a code string stands for."""
        at = [int(code[2 * k:2 * k + 2], 16) for k in range(len(self.cuts) - 1)]
        return [int(x) for e, a, b in zip(at, self.cuts, self.cuts[1:]) for x in self.entries[e][a:b]]


def is_kept(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * scale), -LIMIT, LIMIT).astype(np.int32)


def blocks(kept: DataFrame, dim: int, scale: int) -> DataFrame:
    """``kept`` (id, label, vector) as (ids, labels, codes, sizes, values) rows."""
    id_type, label_type = (kept.schema[c].dataType for c in ("id", "label"))
    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("labels", T.ArrayType(label_type)),
                           T.StructField("codes", T.BinaryType()), T.StructField("sizes", T.ArrayType(T.IntegerType())),
                           T.StructField("values", T.BinaryType())])
    rows_a_block = max(1, BLOCK_CELLS // max(1, dim))

    def block(ids, labels, ints):
        codes, sizes, values = np.empty(ints.shape, np.uint32), [], []
        for d in range(dim):
            own, codes[:, d] = np.unique(ints[:, d], return_inverse=True)
            sizes.append(len(own))
            values.append(own)
        whole = lambda xs: pa.chunked_array(xs).combine_chunks()
        lists = [pa.ListArray.from_arrays(pa.array([0, len(ints)], pa.int32()), whole(x)) for x in (ids, labels)]
        return pa.RecordBatch.from_arrays(
            [*lists, pa.array([codes.T.tobytes()], pa.binary()), pa.array([sizes], pa.list_(pa.int32())),
             pa.array([np.concatenate(values).astype("<i4").tobytes() if values else b""], pa.binary())], schema.names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows_a_block - n)
                at += part.num_rows
                n += part.num_rows
                ints = integers(part.column("vector").flatten().to_numpy(zero_copy_only=False), scale).reshape(-1, dim)
                held.append((part.column("id"), part.column("label"), ints))
                if n == rows_a_block:
                    ids, labels, parts = zip(*held)
                    yield block(ids, labels, np.concatenate(parts))
                    held, n = [], 0
        if held:
            ids, labels, parts = zip(*held)
            yield block(ids, labels, np.concatenate(parts))

    return kept.select("id", "label", "vector").mapInArrow(tidy(task), schema)


def _open(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    sizes = batch.column("sizes")[k].as_py()
    values = np.frombuffer(batch.column("values")[k].as_buffer(), "<i4").astype(np.int64)
    codes = np.frombuffer(batch.column("codes")[k].as_buffer(), np.uint32).reshape(len(sizes), -1)
    return codes, np.split(values, np.cumsum(sizes)[:-1]) if sizes else []


def _nearest(codes: np.ndarray, dictionary: list[np.ndarray], books: Codebooks, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per part the nearest entry of each vector (the lower of equals), and its distance."""
    best, far = [], []
    for a, b in zip(books.cuts, books.cuts[1:]):
        total = np.zeros((n, len(books.entries)), np.int64)
        for d in range(a, b):
            table = (dictionary[d][:, None] - books.entries[None, :, d]) ** 2
            total += table[codes[d]]
        best.append(total.argmin(1))
        far.append(total.min(1))
    return np.array(best), np.array(far)


def _sums(written: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, int]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_entries = len(books.entries)
        for batch in batches:
            for k in range(batch.num_rows):
                codes, dictionary = _open(batch, k)
                best, _ = _nearest(codes, dictionary, books, codes.shape[1])
                out = []
                for part, (a, b) in enumerate(zip(books.cuts, books.cuts[1:])):
                    for d in range(a, b):
                        size = len(dictionary[d])
                        seen = np.bincount(best[part] * size + codes[d], minlength=n_entries * size).reshape(n_entries, size)
                        out += zip([d] * n_entries, range(n_entries), (seen @ dictionary[d]).tolist(), seen.sum(1).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                    ["d", "entry", "s", "n"])

    got = written.select("codes", "sizes", "values").mapInArrow(tidy(task), "d int, entry int, s long, n long")
    return {(r.d, r.entry): (r.s, r.n) for r in got.groupBy("d", "entry").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """((id, label, code, error) rows, the final codebooks); no codebooks for no vectors."""
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    kept = kept.where(is_kept(F.col("vector")))
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*order).limit(1).collect()
    none = T.StructType([kept.schema["id"], kept.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return vectors.sparkSession.createDataFrame([], none), None
    dim = len(first[0].vector)
    kept = kept.where(F.size("vector") == dim)
    seeds = kept.orderBy(*order).limit(entries).collect()
    books = Codebooks([k * dim // parts for k in range(parts + 1)],
                      integers(np.array([r.vector for r in seeds], np.float64).reshape(len(seeds), dim), scale).astype(np.int64))
    written = materialise(blocks(kept, dim, scale), "valuedict-blocks")
    for _ in range(rounds if dim else 0):
        new = books.entries.copy()
        for (d, entry), (s, n) in _sums(written, books).items():
            if n:
                new[entry, d] = s // n
        books = Codebooks(books.cuts, new)
    return _coded(written, books, none), books


def _coded(written: DataFrame, books: Codebooks, schema: T.StructType) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(k, 1).flatten() for c in ("ids", "labels"))
                codes, dictionary = _open(batch, k)
                best, far = _nearest(codes, dictionary, books, len(ids))
                text = ["".join(f"{e:02x}" for e in row) for row in best.T.tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(far.sum(0), pa.int64())], schema.names)

    return written.mapInArrow(tidy(task), schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors of equal labels added up (nulls together; null beyond a long)."""
    coded = materialise(coded, "valuedict-codes")
    by_label = materialise(coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")), "valuedict-labels")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
