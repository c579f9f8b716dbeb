"""MinHash near-dedup with bottom-k sketches.

A document's set holds the 64-bit hashes (one hash function) of its distinct 5-word
shingles; equal sets form a class. Its sketch is the ``K`` smallest hashes.

1. Inverted lists of retained values. Of two sketches that share ``NEED`` of their values, each has a shared
   value among its ``m - need + 1`` rarest (m retained, one order for all): only those are
   listed, so common lines and passages make no lists unless a document is made of them.
2. In a list of up to ``LIST_ROWS`` classes, overlaps of the sketches and then the share of common values
   in the sketch of the union (the estimate) pick likely pairs. They are sent on
   as stars, never as pairs. A longer list is a star as a whole.
3. What the stars connect is a family. Its classes meet in blocks, where the estimate picks
   pairs again and the exact Jaccard of the full sets decides. Every block also holds the
   family's pivots. If a family of several blocks isn't one component by then, those
   outside its largest component meet all blocks. Pairs that are connected by then are skipped; a
   block returns stars of its links.

Components come from the links by large-star and small-star rounds.

A pair at the threshold of 0.85 is missed only if under half of the union's 64 smallest hashes are common, or
in a block under 0.7 of its 256 smallest: probabilities 1e-11 and 1e-9 for a pair at 0.85 exactly, less
above; sets below 64 shingles lose none.

Defined results: null text and text without words have no shingle, link with nothing and are
their own component; a text of under five words is one shingle; rows that repeat a text (and
id) share a class and each return; of rows that repeat an id with different texts, each
keeps the component of its text; ``kept`` is false for a null id; very long texts are
hashed in slices and verified in blocks of bounded size (one text alone may exceed the bound); an
empty table gives no rows; other columns, whatever their names, are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, tidy
from .simhash import components

SHINGLE = 5
K = 64
PERCENT = 85
NEED = 0.5  # share of retained values, and least estimate, of a pair that is looked at
FINE_K, FINE_NEED = 256, 0.7  # the same where the whole sets are at hand
LIST_ROWS = 512
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 20
PIVOTS = 32
SLICE = 1 << 18


def shingle_set(data: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a UTF-8 text's shingles."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    if len(words) < shingle:
        return np.array([digest(b" ".join(words))], np.uint64)
    n, parts = len(words) - shingle + 1, []
    for lo in range(0, n, SLICE):
        some = words[lo:min(n, lo + SLICE) + shingle - 1]
        parts.append(np.unique(np.array([digest(b" ".join(t)) for t in zip(*(some[k:] for k in range(shingle)))], np.uint64)))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def sketches(docs: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """(doc_id, text_hash, n, sig, sketch) of every row; sig is 128 bits of the whole set."""
    id_field = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    schema = T.StructType([id_field, T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("sig", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t or b"", shingle) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            small = [s[:k].view(np.int64) for s in sets]
            at = np.cumsum([0, *map(len, small)]).astype(np.int32)
            flat = np.concatenate(small) if small else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], schema.names)

    return _with_hash(docs).mapInArrow(tidy(task), schema)


def _with_hash(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"))


class Union:
    """Disjoint sets; the smaller value is the root."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        p = self.parent
        while p.setdefault(x, x) != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple]:
        return [(x, r) for x in list(self.parent) if (r := self.find(x)) != x]


def estimate(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of common values among the k smallest of the union of two sorted sketches."""
    both, n = np.unique(np.concatenate([a, b]), return_counts=True)
    return float((n[:k] == 2).mean()) if len(both) else 0.0


def likely(sizes: np.ndarray, held: list[np.ndarray], percent: int, need: float, k: int,
           left: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) whose sketches' overlap and sizes allow the threshold, most overlap
    first. ``left``: only pairs of which one is in it."""
    n = len(held)
    if n < 2:
        return
    # values that two sketches hold, as columns of a 0/1 matrix
    flat = np.concatenate(held)
    who = np.repeat(np.arange(n), [len(h) for h in held])
    values, col, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    if not shared.any():
        return
    place = np.cumsum(shared) - 1
    keep = shared[col]
    overlap = np.zeros((n, n), np.float32)
    who, col = who[keep], place[col[keep]]
    for lo in range(0, int(shared.sum()), 4096):
        some = (col >= lo) & (col < lo + 4096)
        m = np.zeros((n, 4096), np.float32)
        m[who[some], col[some] - lo] = 1
        overlap += m @ m.T
    least = np.ceil(need * np.minimum.outer(*[np.array([len(h) for h in held])] * 2))
    fits = (overlap >= least) & (100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes))
    fits &= np.triu(np.ones((n, n), bool), 1)
    if left is not None:
        fits &= left[:, None] | left[None, :]
    a, b = np.nonzero(fits)
    for t in np.argsort(-overlap[a, b], kind="stable"):
        yield int(a[t]), int(b[t])


def jaccard_reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive rows that agree on the first ``n_keys`` long columns."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(n_keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            now = tuple(int(c[lo]) for c in cols)
            if held and now != key:
                yield held
                held = []
            key = now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held


def _edges(pairs: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*pairs)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])


def listed(classes: DataFrame, need: float = NEED) -> DataFrame:
    """(v, f, cid): each class in the lists of its rarest retained values; f classes retain v.
    Values that one class alone retains are counted, not listed."""
    posted = classes.select("cid", F.explode("sketch").alias("v"))
    often = posted.groupBy("v").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = posted.join(often, "v").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("vs"))
    m = F.size("sketch")
    rows = shared.join(classes.select("cid", m.alias("m")), "cid")
    alone = F.col("m") - F.size("vs")
    take = F.greatest(F.lit(0), F.col("m") - F.ceil(F.col("m") * need).cast("int") + 1 - alone)
    return rows.select("cid", F.inline(F.slice("vs", F.lit(1), take)))


def families(classes: DataFrame, percent: int = PERCENT, need: float = NEED, k: int = K, list_rows: int = LIST_ROWS) -> DataFrame:
    """(a, b): each class of a family but its smallest, with that smallest."""
    lists = materialise(listed(classes, need), "bottomk-lists")
    hot = lists.where(F.col("f") > list_rows)
    star = hot.join(hot.groupBy("v").agg(F.min("cid").alias("b")), "v").select(F.col("cid").alias("a"), "b").where("a > b").distinct()
    few = lists.where(F.col("f") <= list_rows).select("v", "cid").join(classes.select("cid", "n", "sketch"), "cid")
    rows = few.select("v", "cid", "n", "sketch").repartition("v").sortWithinPartitions("v")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in _groups(batches, 1):
            if sum(g.num_rows for g in group) < 2:
                continue
            cids = np.concatenate([g.column("cid").to_numpy() for g in group]).tolist()
            sizes = np.concatenate([g.column("n").to_numpy() for g in group])
            held = [np.asarray(s.values.to_numpy(), np.int64).view(np.uint64) for g in group for s in g.column("sketch")]
            part = Union()
            for i, j in likely(sizes, held, percent, need, k):
                a, b = cids[i], cids[j]
                if part.find(a) != part.find(b) and estimate(held[i], held[j], k) >= need:
                    part.join(a, b)
            out += part.stars()
            if len(out) >= 1 << 16:
                yield _edges(out)
                out = []
        yield _edges(out)

    return components(star.unionByName(rows.mapInArrow(tidy(task), "a long, b long")))


def _verified(rows: DataFrame, percent: int, shingle: int, named: str = "cid", need: float = FINE_NEED, k: int = FINE_K) -> DataFrame:
    """``rows`` (k1, k2, k3, cid, comp, own, text) to (a, b) stars of the links within each (k1, k2, k3), between
    classes or (``named``) their components. Rows with ``own`` meet all, others only those; classes of one
    component aren't compared."""
    # a stated number of partitions: the work grows with the pairs, so small inputs aren't put together again
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.select("k1", "k2", "k3", "cid", "comp", "own", "text").repartition(parts, "k1", "k2", "k3")
             .sortWithinPartitions("k1", "k2", "k3", "cid"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in _groups(batches, 3):
            cids, comps, own, sets = [], [], [], []
            for g in group:
                texts = g.column("text").cast(pa.binary())
                for r, cid in enumerate(g.column("cid").to_pylist()):
                    if cids and cids[-1] == cid:  # a repeated row, or a pivot in its own block
                        own[-1] |= g.column("own")[r].as_py()
                        continue
                    cids.append(cid)
                    comps.append(g.column("comp")[r].as_py())
                    own.append(g.column("own")[r].as_py())
                    sets.append(shingle_set(texts[r].as_py() or b"", shingle))
            part = Union()
            names = comps if named == "comp" else cids
            for i, j in likely(np.array([len(s) for s in sets]), [s[:k] for s in sets], percent, need, k, np.array(own)):
                if (part.find(names[i]) != part.find(names[j]) and estimate(sets[i][:k], sets[j][:k], k) >= need
                        and jaccard_reaches(sets[i], sets[j], percent)):
                    part.join(names[i], names[j])
            out += part.stars()
            if len(out) >= 1 << 16:
                yield _edges(out)
                out = []
        yield _edges(out)

    return dealt.mapInArrow(tidy(task), "a long, b long")


def near_groups(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, k: int = K, need: float = NEED,
                list_rows: int = LIST_ROWS, block_rows: int = BLOCK_ROWS, pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept); see the module."""
    rows = materialise(sketches(docs, shingle, k), "bottomk-rows")
    classes = rows.where("n > 0").groupBy("sig").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first"),
        F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "bottomk-classes")
    near = families(classes, percent, need, k, list_rows)
    member = near.select(F.col("a").alias("cid"), F.col("b").alias("family")).unionByName(
        near.select(F.col("b").alias("cid"), F.col("b").alias("family")).distinct())
    member = member.join(classes.select("cid", "first.doc_id", "first.text_hash", "n"), "cid")
    sizes = member.groupBy("family").agg(F.count(F.lit(1)).alias("size"), F.ceil(F.greatest(
        F.count(F.lit(1)) / block_rows, F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("blocks"))
    member = materialise(member.join(sizes, "family"), "bottomk-members")
    # the same kind of join at every size, whether the planner thinks the members small or not
    texts = _with_hash(docs).alias("d").join(
        member.hint("merge").alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("d.text_hash").eqNullSafe(F.col("m.text_hash")))
    texts = texts.select("m.family", "m.blocks", "m.cid", "d.text", F.pmod(F.xxhash64("m.cid"), F.col("m.blocks")).alias("block"),
                         (F.pmod(F.xxhash64("m.cid", "m.family"), F.col("m.size")) < pivots).alias("pivot"))
    texts = materialise(texts, "bottomk-texts")

    everywhere = texts.where("pivot AND blocks > 1").withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    inside = texts.withColumn("to", F.col("block")).unionByName(everywhere).select(
        F.col("family").alias("k1"), F.col("to").alias("k2"), F.lit(0).cast("long").alias("k3"), "cid", F.col("cid").alias("comp"),
        F.lit(True).alias("own"), "text")
    part = components(_verified(inside, percent, shingle))

    large = texts.where("blocks > 1").join(part.select(F.col("a").alias("cid"), F.col("b").alias("comp")), "cid", "left").select(
        "family", "blocks", "block", "cid", F.coalesce("comp", "cid").alias("comp"))
    most = large.groupBy("family", "comp").agg(F.countDistinct("cid").alias("n")).groupBy("family").agg(
        F.max(F.struct("n", "comp"))["comp"].alias("main"), F.sum("n").alias("size"), F.max("n").alias("held"))
    most = most.where("size > held").withColumn("outside", F.ceil((F.col("size") - F.col("held")) / block_rows).cast("long"))
    rest = materialise(large.distinct().join(most.select("family", "main", "outside"), "family"), "bottomk-rest")
    later = None  # what the links across blocks connect further
    if rest.limit(1).count():
        outer = F.pmod(F.xxhash64("cid", "main"), F.col("outside"))
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        base = rest.select("family", "block", upto("outside").alias("outer"), "cid", "comp", F.lit(False).alias("own"))
        others = rest.where("comp <> main").select("family", upto("blocks").alias("block"), outer.alias("outer"), "cid", "comp", F.lit(True).alias("own"))
        across = base.unionByName(others).join(texts.select("cid", "text"), "cid").select(
            F.col("family").alias("k1"), F.col("block").alias("k2"), F.col("outer").alias("k3"), "cid", "comp", "own", "text")
        later = components(_verified(across, percent, shingle, "comp"))

    rooted = classes.select("sig", "cid", "first.doc_id").join(part.select(F.col("a").alias("cid"), F.col("b").alias("root")), "cid", "left")
    rooted = rooted.select("sig", "doc_id", F.coalesce("root", "cid").alias("root"))
    if later is not None:
        rooted = rooted.join(later.select(F.col("a").alias("root"), F.col("b").alias("top")), "root", "left").select(
            "sig", "doc_id", F.coalesce("top", "root").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = materialise(rooted.join(least, "root").select("sig", "component_id"), "bottomk-named")
    found = rows.join(named, "sig", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
