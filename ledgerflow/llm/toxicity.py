"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the unlabelled part is a draw from all training
documents, whatever their label, so it holds toxic ones by the class prior, as the risk supposes. With class
prior pi (the toxic share among the labelled training rows) a logistic model minimises
pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)); while the corrected negative risk is below
zero, the step goes up that term instead (non-negative estimator).

Features are words (runs of letters, lower case) and their first 5 and 7 letters,
present or not; the ``N_FEATURES`` with the largest signed divergence between positives and
unlabelled are kept. Bounds of the fitted sample: ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` documents, by
md5 of the id; only their feature numbers reach the driver. All documents are scored
on whole texts.

Defined results: empty and null texts score the model's intercept; without a positive row
every score is 0; several labels of an id count as toxic if one is; rows of ``labels``
without a document are ignored; a very long text counts by its set of words; an empty table gives no rows; other
columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_mod, materialise

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
N_FEATURES = 2_048
MIN_POSITIVES = 4  # documents a feature must be seen in
STEMS = (5, 7)
STEPS = 400
RATE = 0.05
DECAY = 5e-4
_WORDS = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """Words and stems of a text; a stem is marked by a leading '<'."""
    words = set(_WORDS.findall((text or "").lower()))
    return words.union(*({f"<{w[:k]}" for w in words if len(w) >= k} for k in STEMS))


def sample(docs: DataFrame, labels: DataFrame, max_positive=MAX_POSITIVE, max_unlabelled=MAX_UNLABELLED):
    """((doc_id, y, text) of the sample: y is 1 or 0; the class prior)."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    ids = docs.where(id_mod("doc_id", 5) != 0).select("doc_id").join(known, "doc_id", "left")
    ids = materialise(ids.distinct(), "toxic-ids")
    n = ids.agg(F.count_if(F.col("toxic") == 1).alias("pos"), F.count("toxic").alias("known")).first()
    if not n["pos"]:
        return None, 0.0
    order = [F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.col("doc_id")]
    chosen = ids.where(F.col("toxic") == 1).orderBy(*order).limit(max_positive).select("doc_id", F.lit(1).alias("y"))
    chosen = chosen.unionByName(ids.orderBy(*order).limit(max_unlabelled).select("doc_id", F.lit(0).alias("y")))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most the two bounds
    return materialise(rows, "toxic-sample"), n["pos"] / n["known"]


def choose_features(rows: DataFrame, n_features: int = N_FEATURES) -> list[str]:
    """The features that tell positives from unlabelled rows best."""
    counted = rows.groupBy("y").count().collect()
    n = {r["y"]: r["count"] for r in counted}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                found = list(features(text))
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(found), pa.int32()), pa.array(found, pa.string())],
                                                 ["y", "feature"])

    seen = rows.select("y", "text").mapInArrow(task, "y int, feature string").groupBy("feature").agg(
        F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("u")).where(F.col("p") >= MIN_POSITIVES)
    p, u = (F.col("p") + 0.5) / (n[1] + 1), (F.col("u") + 0.5) / (n.get(0, 0) + 1)
    top = seen.select("feature", (p * F.ln(p / u)).alias("gain")).where("gain > 0").orderBy(F.desc("gain"), "feature")
    return [r["feature"] for r in top.limit(n_features).collect()]


def nnpu(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_cols: int, prior: float,
         steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept of the logistic model; (rows, cols) are the ones of the matrix."""
    n = len(y)
    pos, unl = y == 1, y == 0
    w, b = np.zeros(n_cols), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    m, v, mb, vb = np.zeros(n_cols), np.zeros(n_cols), 0.0, 0.0
    mean_w, mean_b, tail = np.zeros(n_cols), 0.0, steps // 2  # the second half's mean: the risk isn't smooth
    for t in range(1, steps + 1):
        z = np.clip(b + np.bincount(rows, w[cols], n), -30, 30)
        s = 1 / (1 + np.exp(-z))  # d of -log(1 - s) is s, d of -log s is s - 1
        loss_neg = np.logaddexp(0, z)
        n_p, n_u = max(1, pos.sum()), max(1, unl.sum())
        r_neg = loss_neg[unl].sum() / n_u - prior * loss_neg[pos].sum() / n_p
        g_neg = np.where(unl, s / n_u, -prior * s / n_p)
        g = np.where(pos, prior * (s - 1) / n_p, 0.0) + g_neg if r_neg >= 0 else -g_neg
        gw, gb = np.bincount(cols, g[rows], n_cols) + DECAY * w, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw ** 2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb ** 2
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = w - RATE * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b = b - RATE * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
        if t > steps - tail:
            mean_w, mean_b = mean_w + w / tail, mean_b + b / tail
    return mean_w, mean_b


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """{"weights": feature -> weight, "bias": intercept}; bias None without a positive row."""
    rows, prior = sample(docs, labels)
    if rows is None:
        return {"weights": {}, "bias": None}
    names = choose_features(rows)
    at = {f: k for k, f in enumerate(names)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(at[f] for f in features(t) if f in at) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"),
                                              pa.array(found, pa.list_(pa.int32()))], ["doc_id", "y", "on"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("y", T.IntegerType()),
                           T.StructField("on", T.ArrayType(T.IntegerType()))])
    got = rows.select("doc_id", "y", "text").mapInArrow(task, schema).collect()
    got.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["y"], r["on"]))
    y = np.array([r["y"] for r in got])
    cols = np.array([c for r in got for c in r["on"]], np.int64)
    where = np.repeat(np.arange(len(got)), [len(r["on"]) for r in got])
    w, b = nnpu(where, cols, y, len(names), prior)
    return {"weights": {f: float(w[k]) for f, k in at.items()}, "bias": float(b)}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # N_FEATURES weights

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value["weights"], shared.value["bias"]
        known = set(weights)
        for batch in batches:
            z = [0.0 if bias is None else bias + sum(sorted(weights[f] for f in known & features(t)))
                 for t in batch.column("text").to_pylist()]
            s = np.zeros(len(z)) if bias is None else 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())]))
