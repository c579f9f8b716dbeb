"""SimHash near-dedup with BK-trees.

A fingerprint bit is 1 if it is set in over half of the XXH64 values (seed 42) of a
text's word shingles. Distinct fingerprints within ``max_bits`` differing bits are linked.

Fingerprints are dealt to shards whose members agree on some of their bits: with
``max_bits`` = r, two linked fingerprints agree on one of r + 1 bit ranges, and
within the remaining bits again on one of r + 1 ranges, so every linked pair meets in
one of the (r + 1)^2 shards of each. A shard is a BK-tree: children keyed by their
Hamming distance to the parent, searched along the edges within the radius. A shard
above ``SHARD_ROWS`` members is cut into several trees of bounded size, and each tree is
asked by all members, so a hot shard spreads over tasks and no pair is lost. A task
returns a star per connected part of its tree's answers, never all pairs. Components come from
rounds of large-star and small-star over the links, each round written to the shared folder.

Defined results: no words (null or empty text) gives fingerprint 0, linked like any
other; rows with equal ids keep one row each; the component of null ids only is
null; very long texts are hashed in slices; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, tidy

SEED = 42
SHINGLE = 3
MAX_BITS = 2
SHARD_ROWS = 4096
SLICE = 1 << 18  # shingles whose bits are counted at once


def simhash(data: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = data.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    sums = np.zeros(64, np.int64)
    for lo in range(0, n, SLICE):
        part = words[lo:min(n, lo + SLICE) + shingle - 1]
        h = np.array([digest(b" ".join(t), SEED) for t in zip(*(part[k:] for k in range(shingle)))], "<u8")
        sums += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(sums * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, text_hash): the fingerprint as a signed long."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fps = np.array([simhash(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64()), batch.column("text_hash")],
                                             ["doc_id", "fp", "text_hash"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("text").cast("string")).alias("text_hash")).mapInArrow(tidy(task), "doc_id long, fp long, text_hash long")


class BKTree:
    """Integers under Hamming distance; a node is [value, {distance: node}]."""

    def __init__(self):
        self.top = None

    def add(self, value: int) -> None:
        if self.top is None:
            self.top = [value, {}]
            return
        node = self.top
        while True:
            d = (value ^ node[0]).bit_count()
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [self.top] if self.top else []
        while stack:
            node = stack.pop()
            d = (value ^ node[0]).bit_count()
            if d <= radius:
                found.append(node[0])
            children = node[1]
            for k in range(d - radius, d + radius + 1):
                if k in children:
                    stack.append(children[k])
        return found


def _ranges(bits: list[int], n: int) -> list[list[int]]:
    return [list(map(int, x)) for x in np.array_split(bits, n)]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def shard_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Bit masks, (max_bits + 1)^2 of them: any two values within ``max_bits``
    differing bits agree under at least one."""
    n, out = max_bits + 1, []
    for first in _ranges(list(range(64)), n):
        rest = [b for b in range(64) if b not in first]
        out += [_mask(first) | _mask(second) for second in _ranges(rest, n)]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _stars(tree_rows: np.ndarray, queries: np.ndarray, radius: int) -> dict[int, int]:
    """value -> smallest value of its connected part (members other than it)."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    tree = BKTree()
    for v in tree_rows.tolist():
        tree.add(v)
    for q in queries.tolist():
        for v in tree.within(q, radius):
            a, b = find(q), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return {x: r for x in list(parent) if (r := find(x)) != x}


def links(distinct: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b), b < a: stars that connect the fingerprints within ``max_bits``."""
    masks = F.array(*[F.struct(F.lit(k).alias("range"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("bits"))
                      for k, m in enumerate(shard_masks(max_bits))])
    keyed = distinct.select("fp", F.explode(masks).alias("key")).select("fp", "key.range", "key.bits")
    sizes = keyed.groupBy("range", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    trees = F.ceil(F.col("n") / shard_rows)
    rows = (keyed.join(sizes, ["range", "bits"])
            .withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), trees - 1)))
            .withColumn("member", F.pmod(F.xxhash64("fp"), trees) == F.col("tree"))
            .select("range", "bits", "tree", "fp", "member"))
    rows = rows.repartition("range", "bits", "tree").sortWithinPartitions("range", "bits", "tree")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(fp, member):
            star = _stars(fp[member].view(np.uint64), fp.view(np.uint64), max_bits)
            ends = ((_signed(a), _signed(b)) for a, b in star.items())
            return [(max(e), min(e)) for e in ends]  # the smaller of two unsigned values may be the larger signed one

        held: list[tuple] = []  # the arrays of the shard that the last batch left open
        key, out = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy() for k in range(3)]
            fp, member = batch.column(3).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                now = tuple(int(c[lo]) for c in cols)
                if now != key and held:
                    out += answer(*map(np.concatenate, zip(*held)))
                    held = []
                key = now
                held.append((fp[lo:hi], member[lo:hi]))
                if len(out) >= 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                    out = []
        if held:
            out += answer(*map(np.concatenate, zip(*held)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return rows.mapInArrow(task, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every node of ``edges`` that isn't its component's smallest, with
    that smallest. Rounds of large-star and small-star until nothing changes."""
    state = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    def star(df, large: bool):
        near = df.select("a", "b")
        if large:
            near = near.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        to = near.join(least, "a")
        if large:
            got = to.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            got = to.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b")))
        return got.where("a > b").distinct()

    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))  # a link has no direction
    now = materialise(now.where("a > b").distinct(), "simhash-links")
    seen = state(now)
    while seen[0]:
        now = materialise(star(star(now, True), False), "simhash-round")
        was, seen = seen, state(now)
        if was == seen:
            break
    return now


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fp, text_hash, root, component_id): component_id is the smallest doc_id
    among the documents that links reach, root the smallest of their fingerprints."""
    rows = materialise(fingerprints(docs, shingle), "simhash-rows")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    part = components(links(distinct.select("fp"), max_bits, shard_rows))
    rooted = distinct.join(part.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialise(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id (null ids
    last), and of rows that repeat its id the first by text and other columns."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns come back under their own names, whatever these are
    id_, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    plain = docs.toDF(*names)
    kept = near_groups(docs, shingle, max_bits).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")).select(
        "first.doc_id", "first.text_hash")
    w = Window.partitionBy(id_, "hash").orderBy(*[F.col(n) for n in names if n != id_])
    return (plain.withColumn("hash", F.xxhash64(F.col(text).cast("string")))
            .join(kept, F.col(id_).cast("long").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left_semi")
            .withColumn("n", F.row_number().over(w)).where("n = 1").select(names).toDF(*docs.columns))
