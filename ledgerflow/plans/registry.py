"""All driver queries: name -> (spark_fn(spark, sf_dir), sql_fn() | None)."""
from __future__ import annotations

from . import file_queries, io_queries, message_queries, ml_queries, pipeline_queries, rules_queries, statement_queries


def all_queries() -> dict:
    out = {}
    for module in (rules_queries, statement_queries, message_queries, ml_queries, pipeline_queries, io_queries,
                   file_queries):
        out.update(module.QUERIES)
    return out
