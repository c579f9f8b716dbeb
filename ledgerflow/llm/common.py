"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Fixed value: a word is a run of anything but ASCII white space. ``bytes.split()``
# and ``bytes.lower()`` follow the same rule (ASCII white space, ASCII letters only).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends
    there, any executor can read it again, and the planner knows its size."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(task):
    """An Arrow task that gives freed memory back to the system at its end: workers
    live on, and several stages of a job share them."""
    import pyarrow as pa

    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()

    return run


def id_mod(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as '')."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def hex64(c: Column) -> Column:
    """A 64-bit long as 16 lowercase hex digits, read as unsigned."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))
