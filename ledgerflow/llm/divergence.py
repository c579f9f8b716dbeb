"""Source divergence audit with a frequent-pattern tree of term rows.

A term is a maximal run of letters (ASCII letters lower-cased, every other code point from
U+0080 on as it is). Each language keeps the terms in at least ``min_docs`` of its documents.
A group is a (lang, source); with its count c of a kept term, N of all kept terms and V
kept terms in the language, it gives the term p = 1 + floor(10^9 (c + 5) / (N + 5 V)).

The distance of two groups is the sum of |p - p'| over all kept terms. Most counts are
zero, so it is put together exactly from
- the term that no group holds, V times: V |z - z'|, z being p at count 0;
- for each group its own terms against the other's z: running sums over its sorted p;
- a correction for each term that both hold. Term rows list their nonzero sources in order
  with p; equal rows are counted, sorted and inserted into a tree, where rows that share a
  path share its nodes. Each node holds how many terms pass through it, and adds the
  correction of its source with every ancestor's once, times that number.

Counting happens in the tasks that read documents (one row per group and term and flush),
so a hot source or word travels as partial sums. Tasks hold one path of the tree at a time;
a tree cut between tasks gives the same sums. Output grows with the pairs of sources
within a language, as it must.

Defined results: null text, lang and source count as ''; a group without terms has all
counts 0; a language without kept terms has distance 0 throughout; repeated rows and ids
are documents of their own; a text without letters adds its group only; very long texts are
counted piece by piece, as one document; an empty table gives no rows; other columns, whatever their
names, are ignored.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, tidy

MIN_DOCS = 30
TOP_TERMS = 50
SLICE = 1 << 22  # bytes of a text that are split at once
HELD = 1 << 16  # counters that a task holds; Spark adds up what it sends on
FLUSH = 1 << 18  # pair corrections that a task holds
# What isn't part of a term becomes a space: up to U+0040, U+005B to U+0060, U+007B to U+007F.
_CASE = bytes(32 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded size."""
    at = 0
    while at < len(text):
        part = text[at:at + SLICE].translate(_CASE)
        if at + SLICE < len(text):
            cut = part.rfind(b" ")
            if cut < 0:  # one term over the whole slice and beyond: find its end
                end = at + SLICE
                while end < len(text) and _CASE[text[end]] != 32:
                    end += 1
                part, cut = text[at:end].translate(_CASE), end - at
            part = part[:cut]
        yield part.split()
        at += len(part) + 1


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) partial counts; a row with term '' for each group seen."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def out(held: dict, seen: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), n in held.items():
            own, size = seen.pop((lang, source)), len(n) + 1
            cols = [pa.repeat(lang, size), pa.repeat(source, size), pa.array([b"", *n], pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(own.__getitem__, n)], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "n", "docs"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = {}
        seen: dict[tuple, Counter] = {}
        size = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for k, key in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
                n = held.setdefault(key, Counter())
                docs_ = seen.setdefault(key, Counter())
                size -= len(n)
                once: set = set()
                for some in terms(texts[k].as_py()):
                    n.update(some)
                    once.update(some)
                docs_.update(once)
                size += len(n)
                if size >= HELD:
                    yield from out(held, seen)
                    held, seen, size = {}, {}, 0
        yield from out(held, seen)

    return rows.mapInArrow(tidy(task), "lang string, source string, term string, n long, docs long")


def share(n: str, total: str, terms_: str) -> F.Column:
    """p in whole numbers, with 38 digits: counts may be of any size."""
    return F.expr(f"""CASE WHEN {terms_} = 0 THEN 1L ELSE 1L + (cast(1000000000 AS decimal(10,0)) * cast({n} + 5 AS decimal(20,0)))
                      div cast({total} + 5 * {terms_} AS decimal(20,0)) END""")


def corrections(rows: DataFrame) -> DataFrame:
    """``rows`` (lang, path: array of (ix, p, z) by ix, mult) to (lang, lo, hi, v): what a term that
    both sources hold adds beyond each one's own part, over all terms, partly added up."""
    # ranges of the first items keep shared paths together; the planner's sample holds those, not whole paths, and
    # the last key lets a range end inside a frequent beginning
    dealt = rows.repartitionByRange("lang", F.slice("path", 1, 2), F.pmod(F.xxhash64("path"), F.lit(64))).sortWithinPartitions("lang", "path")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang = None
        ix = p = z = np.empty(0, np.int64)  # the open path
        mult = np.empty(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def close(down_to: int) -> None:
            nonlocal size
            for d in range(len(ix) - 1, max(down_to, 1) - 1, -1):
                v = np.abs(p[:d] - p[d]) - np.abs(p[d] - z[:d]) - np.abs(p[:d] - z[d]) + np.abs(z[:d] - z[d])
                held.append(((ix[:d] << 32) | ix[d], v * mult[d]))
                size += d

        def flush() -> pa.RecordBatch:
            nonlocal size
            keys, v = (np.concatenate(x) for x in zip(*held))
            held.clear()
            size = 0
            order = keys.argsort(kind="stable")
            keys, v = keys[order], v[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, v = keys[first], np.add.reduceat(v, first)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(v), pa.string()), pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(v)],
                ["lang", "lo", "hi", "v"])

        for batch in batches:
            paths = batch.column("path")
            at = paths.offsets.to_numpy()
            # a sliced array's fields come whole: the offsets point into them
            flat = [paths.values.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("ix", "p", "z")]
            mults = batch.column("mult").to_numpy()
            for k, now in enumerate(batch.column("lang").to_pylist()):
                own = [x[at[k]:at[k + 1]] for x in flat]
                n = min(len(ix), len(own[0])) if now == lang else 0
                same = (ix[:n] == own[0][:n]) & (p[:n] == own[1][:n])
                shared = n if same.all() else int(same.argmin())
                close(shared)
                if held and (now != lang or size >= FLUSH):
                    yield flush()
                lang, (ix, p, z) = now, own
                mult = np.r_[mult[:shared], np.zeros(len(ix) - shared, np.int64)] + int(mults[k])
        close(0)
        if held:
            yield flush()

    return dealt.mapInArrow(tidy(task), "lang string, lo long, hi long, v long")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank); see the module."""
    counts = materialise(counted(docs).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = materialise(counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("held"))
        .where(F.col("docs") >= min_docs), "divergence-terms")
    cells = kept.select("lang", "term", "lang_n", F.inline("held"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = (counts.where("term = ''").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", zero("total"), zero("held"), zero("kept"), zero("lang_total"))
              .withColumn("z", share("0", "total", "kept"))
              .withColumn("ix", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")))
    groups = materialise(groups, "divergence-groups")
    cells = (cells.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "kept"))
             .withColumn("q", share("lang_n", "lang_total", "kept")))
    cells = materialise(cells.select("lang", "source", "ix", "term", "p", "q", "z"), "divergence-cells")

    rows = cells.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("ix", "p", "z"))).alias("path"))
    rows = rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("mult"))

    # each group's own terms against z of every other group of its language
    side = lambda s: groups.select("lang", *[F.col(c).alias(f"{c}_{s}") for c in ("ix", "z", "held", "kept")])
    both = side("a").join(side("b"), "lang").where("ix_a <> ix_b")
    gap = F.abs(F.col("z_a") - F.col("z_b"))
    asked = both.select("lang", F.col("ix_a").alias("ix"), F.col("z_b").alias("x"), F.lit(0).cast("long").alias("w"),
                        F.lit(0).cast("long").alias("wx"), F.col("ix_b").alias("other"),
                        (F.when(F.col("ix_a") < F.col("ix_b"), F.col("kept_a")).otherwise(0) * gap - F.col("held_a") * gap).alias("rest"))
    line = cells.groupBy("lang", "ix", F.col("p").alias("x")).agg(F.count(F.lit(1)).alias("w"))
    line = line.select("lang", "ix", "x", "w", (F.col("x") * F.col("w")).alias("wx"),
                       F.lit(None).cast("long").alias("other"), F.lit(0).cast("long").alias("rest"))
    group = Window.partitionBy("lang", "ix")
    below = group.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = line.unionByName(asked).select("*", *[F.sum(c).over(w).alias(f"{c}_{n}") for c in ("w", "wx") for n, w in (("below", below), ("all", group))])
    onesided = at.where("other IS NOT NULL").select(
        "lang", F.least("ix", "other").alias("lo"), F.greatest("ix", "other").alias("hi"),
        F.expr("x * w_below - wx_below + (wx_all - wx_below) - x * (w_all - w_below) + rest").alias("v"))
    total = onesided.unionByName(corrections(rows)).groupBy("lang", "lo", "hi").agg(F.sum("v").alias("value"))
    ends = total.select("lang", "value", F.inline(F.array(F.struct(F.col("lo").alias("ix"), F.col("hi").alias("other")),
                                                         F.struct(F.col("hi").alias("ix"), F.col("lo").alias("other")))))
    names = groups.select("lang", "ix", "source")
    pairs = ends.join(names, ["lang", "ix"]).join(
        names.select("lang", F.col("ix").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    over = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                       (F.col("p") - F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(over)
