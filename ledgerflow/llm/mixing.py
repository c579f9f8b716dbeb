"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents stand in a shuffled order (md5 of the id) and form one
stream of words that starts again at its end. The stream is cut into blocks of
``block_words`` words. Slot ``i`` of the schedule is the point
frac((i + 1) * golden ratio) (64-bit fixed point); the cumulative target shares map
it to a source, and the rank of the slot among the source's slots names the block
that it takes. Slots beyond a source's quota lapse; where the points left a source
a few slots short, closing slots follow, so each source takes its target to the word.

Defined results: null text has size 0 and takes nothing; a null source is a source
of its own and stands last; rows with equal ids are told apart by their place in the
stream; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise

# Fixed values.
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
GOLDEN_64 = 0x9E3779B97F4A7C15  # 2^64 / golden ratio
BLOCK_WORDS = 64
ROWS_PER_BUCKET = 20_000
SLOTS_PER_CHUNK = 65_536


def targets(sizes: list[int], weights: list[float], total: float, max_repeat: int = MAX_REPEAT) -> list[float]:
    """Share ``total`` by weight; a share stops at ``max_repeat`` times the size
    and its excess goes to the others by weight."""
    out = [0.0] * len(sizes)
    active, rest = list(range(len(sizes))), float(total)
    while active:
        w = sum(weights[i] for i in active)
        over = [i for i in active if rest * weights[i] / w > max_repeat * sizes[i]]
        if not over:
            for i in active:
                out[i] = rest * weights[i] / w
            return out
        for i in over:
            out[i] = float(max_repeat * sizes[i])
        active = [i for i in active if i not in set(over)]
        rest = float(total) - sum(out[i] for i in range(len(sizes)) if i not in set(active))
    return out


def _schedule(spark, sources: list[dict], block_words: int) -> DataFrame:
    """(src, block, slot): which slot takes which block of which source."""
    total = sum(s["size"] for s in sources)
    n_slots = -(-total // block_words)
    edges = np.cumsum([s["target"] for s in sources]) / max(1.0, sum(s["target"] for s in sources))
    edges[-1:] = 1.0

    @F.pandas_udf("int")
    def source_at(slot: pd.Series) -> pd.Series:
        u = (slot.to_numpy().astype(np.uint64) + np.uint64(1)) * np.uint64(GOLDEN_64)
        return pd.Series(np.searchsorted(edges, u.astype(np.float64) / 2.0 ** 64, side="right")
                         .clip(max=len(edges) - 1).astype(np.int32))

    slots = (spark.range(n_slots).select(F.col("id").alias("slot"), source_at("id").alias("src"))
             .withColumn("chunk", F.floor(F.col("slot") / SLOTS_PER_CHUNK)))
    slots = materialise(slots, "mix-slots")
    per_chunk = slots.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = per_chunk.select("src", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("src", "chunk").orderBy("slot")
    ranked = (slots.withColumn("r", F.row_number().over(inside) - 1).join(base, ["src", "chunk"])
              .select("src", (F.col("first") + F.col("r")).alias("block"), "slot"))
    quota = spark.createDataFrame([(i, -(-s["quota"] // block_words)) for i, s in enumerate(sources)],
                                  "src int, need long")
    had = per_chunk.groupBy("src").agg(F.sum("n").alias("had"))
    closing = (quota.join(had, "src", "left").withColumn("had", F.coalesce("had", F.lit(0)))
               .where("had < need")
               .select("src", F.explode(F.sequence("had", F.col("need") - 1)).alias("block"))
               .withColumn("slot", F.lit(n_slots) + F.col("block")))
    kept = ranked.join(F.broadcast(quota), "src").where("block < need").select("src", "block", "slot")  # a row a source
    return kept.unionByName(closing)


def mixed(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` that the mix takes words of, with size, source_size, target, taken and
    first_slot (a column of ``docs`` of such a name gives way). Rows that repeat an id
    are paired with their places in the order of id, source and size, so each keeps one row."""
    added = ["size", "source_size", "target", "taken", "first_slot"]
    kept = [k for k, c in enumerate(docs.columns) if c not in added]
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns come back under their own names, whatever these are
    id_, text, source = (names[docs.columns.index(c)] for c in ("doc_id", "text", "source"))
    w = Window.partitionBy("doc_id").orderBy("source", "size")
    shares = mix(docs, weights, max_repeat, block_words).withColumn("n", F.row_number().over(w)).where("taken > 0")
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.toDF(*names).withColumn("words", size).withColumn(
        "place", F.row_number().over(Window.partitionBy(id_).orderBy(source, "words")))
    return (rows.join(shares, F.col(id_).eqNullSafe(F.col("doc_id")) & (F.col("place") == F.col("n")))
            .select(*[F.col(names[k]).alias(docs.columns[k]) for k in kept], *added))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken,
    first_slot (the slot at which the mix first takes it; null if never).

    The driver holds one row per source, no more.
    """
    spark = docs.sparkSession
    base = materialise(docs.select(
        "doc_id", "source", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key")), "mix-sizes")
    rows = base.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    got = targets([r["size"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))],
                  sum(r["size"] for r in rows), max_repeat)
    sources = [{"size": r["size"], "target": t, "quota": int(t + 1e-6)} for r, t in zip(rows, got)]
    info = spark.createDataFrame([(i, r["source"], r["size"], s["target"], s["quota"])
                                  for i, (r, s) in enumerate(zip(rows, sources))],
                                 "src int, name string, source_size long, target double, quota long")
    buckets = max(1, -(-sum(r["n"] for r in rows) // ROWS_PER_BUCKET))
    placed = (base.join(F.broadcast(info), F.col("source").eqNullSafe(F.col("name"))).drop("name")  # a row a source
              .withColumn("bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / 2 ** 32)))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
              .select("src", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at")))
    inside = (Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (placed.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(starts, ["src", "bucket"]).withColumn("start", F.col("at") + F.col("ahead")))
    # each pass over the source's stream, then each block that the document reaches into
    rounds = placed.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1)))).withColumn(
        "lo", F.col("start") + F.col("round") * F.col("source_size")).withColumn(
        "hi", F.least(F.col("lo") + F.col("size"), F.col("quota")))
    pieces = rounds.withColumn("block", F.explode_outer(F.when(
        F.col("hi") > F.col("lo"), F.sequence(F.floor(F.col("lo") / block_words),
                                              F.floor((F.col("hi") - 1) / block_words)))))
    pieces = pieces.withColumn("words", F.when(
        F.col("block").isNotNull(), F.least(F.col("hi"), (F.col("block") + 1) * block_words)
        - F.greatest(F.col("lo"), F.col("block") * block_words)))
    taken = pieces.join(_schedule(spark, sources, block_words), ["src", "block"], "left")
    keys = ["doc_id", "source", "size", "source_size", "target"]
    one = taken.groupBy("src", "start", "size", *[k for k in keys if k != "size"]).agg(
        F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0)).alias("taken"),
        F.min("slot").alias("first_slot"),
        F.count(F.when(F.col("round") == 0, 1)).alias("pieces"))
    # empty documents share a place: each came with one piece in the first round
    copies = F.when(F.col("size") == 0, F.col("pieces")).otherwise(1).cast("int")
    return (one.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
            .select(*keys, "taken", "first_slot"))
