"""The driver tables as inputs of the registered queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import files

TASK_BYTES = 128 << 20  # a task's worth of input


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. A small one is a single row group, so one task would hold all its rows, whatever
    the number of its splits: below a task's worth of bytes for each core it is dealt out. A large one, and
    one with a file for each core, is left as it is. Rows and results are the same either way."""
    df = files.read_table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * TASK_BYTES and len(df.inputFiles()) < cores else df
