"""Benchmark decontamination: BM25 over the test items, searched by block-max WAND.

The test items are indexed: each term has its items in order, cut into blocks that
know their largest impact. An impact is the term's BM25 weight in the item over the
item's own total, so a passage's score for an item is the share (0 to 1) of the
item's BM25 mass that the passage holds, and one threshold fits all items.

Every document is cut into passages of ``passage`` words (twice the longest item at
least) at every half passage, so any copy of an item lies whole within a passage.
Each passage is a query. First a bound per block of items is taken in numpy from the passage's
rarer terms, with the most that the common terms can add; passages in which
no block can reach the threshold are done. The others go through block-max WAND,
which returns every item at or above the threshold. A hit is a leak if the 5-word
shingles of the item's question and those of its answer both occur in the passage
for a share of ``OVERLAP`` or more. The answer is what follows "Answer:" or "A:", or else the last sentence.

The index is sharded: a shard holds at most ``SHARD_ITEMS`` items and about ``SHARD_BYTES`` of text, is
broadcast alone, and each shard passes over the documents.

Defined results: words are runs of letters or digits in lower case; items without a word
are never found; null and empty texts have no passage; equal items are found each
under its id; rows with equal ids are searched on their own; very long texts are
searched passage by passage; empty tables give no rows; ``find_leaks`` ignores other columns, ``clean`` keeps them.
"""
from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, tidy

K1, B = 1.2, 0.75  # fixed values of BM25
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
PASSAGE = 128
BLOCK_ITEMS = 8
SHARD_ITEMS = 20_000
SHARD_BYTES = 16 << 20
_WORDS = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of a test item."""
    marked = re.search(r"(?:^|\n)\s*(?:Answer|A)\s*:", text)
    if marked and words(text[:marked.start()]) and words(text[marked.end():]):
        return text[:marked.start()], text[marked.end():]
    ends = [m.end() for m in re.finditer(r"[.!?](?=\s|$)", text.rstrip())]
    for end in reversed(ends):
        if words(text[end:]) and words(text[:end]):
            return text[:end], text[end:]
    return text, text


def shingles(ws: list[str], n: int = SHINGLE) -> set[tuple[str, ...]]:
    return {tuple(ws)} if 0 < len(ws) < n else {tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)}


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's shingles that occur in the passage (a shorter part: itself)."""
    want = shingles(part)
    n = min(SHINGLE, len(part))
    have = {tuple(passage[k:k + n]) for k in range(len(passage) - n + 1)}
    return len(want & have) / len(want) if want else 0.0


class Index:
    """Inverted index of one shard of items, with blocks of ``BLOCK_ITEMS`` postings' items."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD, counts: tuple | None = None):
        """``counts``: (document frequency of each of the items' words, items, mean and greatest length) of the whole test
        set, of which ``items`` are a shard; by default of ``items``."""
        items = sorted((i, t or "") for i, t in items)
        parts = [(i, t, words(t)) for i, t in items]
        parts = [x for x in parts if x[2]]
        self.ids = [i for i, _, _ in parts]
        self.threshold = threshold
        self.parts = [tuple(words(x) for x in split_item(t)) for _, t, _ in parts]
        own_df, n = Counter(t for _, _, w in parts for t in set(w)), len(parts)
        df, total, mean, longest = counts or (own_df, n, sum(len(w) for _, _, w in parts) / max(1, n),
                                              max((len(w) for _, _, w in parts), default=0))
        self.passage = max(PASSAGE, 2 * longest)
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for k, (_, _, w) in enumerate(parts):
            tf = Counter(w)
            raw = {t: math.log(1 + (total - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1)
                   / (c + K1 * (1 - B + B * len(w) / mean)) for t, c in tf.items()}
            own = sum(raw[t] for t in sorted(raw))
            for t, x in raw.items():
                postings[t].append((k, x / own))
        self.postings = dict(postings)
        self.blocks = {t: self._block_max(p) for t, p in self.postings.items()}
        self.bound = {t: max(x for _, x in p) for t, p in self.postings.items()}
        self._split_terms(own_df, n)

    @staticmethod
    def _block_max(p: list[tuple[int, float]]) -> dict[int, float]:
        """block of items -> largest impact of the term there."""
        out: dict[int, float] = {}
        for k, x in p:
            out[k // BLOCK_ITEMS] = max(out.get(k // BLOCK_ITEMS, 0.0), x)
        return out

    def _split_terms(self, df: Counter, n: int) -> None:
        """Common terms are taken out of the bound as long as no item draws
        half its threshold from them; their largest sum per block is added instead."""
        mass = np.zeros(n)
        common = set()
        for t in sorted(df, key=lambda t: (-df[t], t)):
            if df[t] < 3:
                break
            more = mass.copy()
            for k, x in self.postings[t]:
                more[k] += x
            if n and more.max() > self.threshold / 2:
                break
            mass, common = more, common | {t}
        self.n_blocks = -(-n // BLOCK_ITEMS)
        self.common = np.zeros(self.n_blocks)
        np.maximum.at(self.common, np.arange(n) // BLOCK_ITEMS, mass)
        rare = sorted(t for t in df if t not in common)
        self.rare = {t: k + 1 for k, t in enumerate(rare)}
        self.counts = np.array([0] + [len(self.blocks[t]) for t in rare])
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])[:-1]
        flat = [(b, x) for t in rare for b, x in sorted(self.blocks[t].items())]
        self.flat_block = np.array([b for b, _ in flat], np.int64)
        self.flat_max = np.array([x for _, x in flat], float)

    def candidates(self, ws: list[str]) -> list[tuple[int, int]]:
        """Passages (begin, end) in which some block's bound reaches the threshold."""
        get = self.rare.get
        term = np.array([get(w, 0) for w in ws], np.int64)
        at = np.flatnonzero(term)
        half, last = self.passage // 2, max(0, -(-len(ws) // (self.passage // 2)) - 2)
        if not len(at):
            return []
        term = term[at]
        # a word counts for the passage that begins in its half and for the one before
        p = np.concatenate([np.minimum(at // half, last), at // half - 1])
        t = np.concatenate([term, term])
        ok = (p >= 0) & (p <= last) & ~((np.arange(len(p)) >= len(at)) & (p == np.concatenate([p[:len(at)]] * 2)))
        pairs = np.unique(p[ok] * (len(self.counts) + 1) + t[ok])  # a term counts once a passage
        p, t = pairs // (len(self.counts) + 1), pairs % (len(self.counts) + 1)
        n = self.counts[t]
        spot = np.repeat(self.starts[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        cell, where = np.unique(np.repeat(p, n) * self.n_blocks + self.flat_block[spot], return_inverse=True)
        bound = np.bincount(where, self.flat_max[spot]) + self.common[cell % self.n_blocks]
        hit = np.unique(cell[bound >= self.threshold - 1e-9] // self.n_blocks)
        return [(int(k) * half, min(len(ws), int(k) * half + self.passage)) for k in hit]

    def search(self, terms: set[str]) -> list[tuple[int, float]]:
        """Block-max WAND: all (item number, score) at or above the threshold."""
        goal = self.threshold - 1e-9
        lists = [[0, t, self.postings[t], self.bound[t]] for t in sorted(terms) if t in self.postings]
        found = []
        while lists:
            lists.sort(key=lambda c: c[2][c[0]][0])
            total, pivot = 0.0, -1
            for k, c in enumerate(lists):
                total += c[3]
                if total >= goal:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][2][lists[pivot][0]][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][2][lists[pivot + 1][0]][0] == item:
                pivot += 1
            block = item // BLOCK_ITEMS
            if sum(self.blocks[c[1]].get(block, 0.0) for c in lists[:pivot + 1]) < goal:
                # no item up to the block's end, or up to the next list, can reach the goal
                to = (block + 1) * BLOCK_ITEMS
                if pivot + 1 < len(lists):
                    to = min(to, lists[pivot + 1][2][lists[pivot + 1][0]][0])
                self._advance(lists[:pivot + 1], max(to, item + 1))
            elif lists[0][2][lists[0][0]][0] == item:
                score = math.fsum(c[2][c[0]][1] for c in lists[:pivot + 1])
                if score >= goal:
                    found.append((item, score))
                self._advance(lists[:pivot + 1], item + 1)
            else:
                self._advance([c for c in lists[:pivot] if c[2][c[0]][0] < item], item)
            lists = [c for c in lists if c[0] < len(c[2])]
        return found

    @staticmethod
    def _advance(lists, to: int) -> None:
        for c in lists:
            p, k = c[2], c[0]
            while k < len(p) and p[k][0] < to:
                k += 1
            c[0] = k

    def leaks(self, text: str | None) -> list[tuple]:
        """(item_id, score, word at which the passage begins, question overlap, answer
        overlap), the best passage of each item that leaks."""
        ws = words(text)
        best: dict[int, tuple] = {}
        for lo, hi in self.candidates(ws) if self.ids else ():
            passage = ws[lo:hi]
            for k, score in self.search(set(passage)):
                q, a = (overlap(part, passage) for part in self.parts[k])
                if q >= OVERLAP and a >= OVERLAP:
                    best[k] = max(best.get(k, (-1.0, 0, 0.0, 0.0)), (score, -lo, q, a))
        return [(self.ids[k], s, -lo, q, a) for k, (s, lo, q, a) in sorted(best.items())]


_INDEXES: dict[str, Index] = {}  # a Python worker builds a shard's index once


def _index(key: str, shard: tuple, threshold: float) -> Index:
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(shard[0], threshold, shard[1])
    return _INDEXES[key]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, word, length) of each item: its distinct words, and one row without a word for its length."""
    for batch in batches:
        for shard, text in zip(batch.column("shard").to_pylist(), batch.column("text").to_pylist()):
            found = words(text)
            if found:
                own = [None, *sorted(set(found))]
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(own), pa.int64()), pa.array(own, pa.string()),
                                                  pa.array([len(found)] * len(own), pa.int64())], ["shard", "word", "length"])


def _shards(items: DataFrame):
    """(key, (items, counts of the whole test set)) of each shard, one at a time. A shard holds the
    document frequencies of its own words; they are counted over all items, however many shards there are."""
    import uuid
    items = items.where(F.col("text").isNotNull()).select("item_id", "text")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n = max(1, -(-2 * size["n"] // SHARD_ITEMS) if size["n"] > SHARD_ITEMS else 1, -(-(size["b"] or 0) // SHARD_BYTES))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    seen = materialise(items.select("shard", "text").mapInArrow(_counted, "shard long, word string, length long"), "decontam-words")
    whole = seen.where("word IS NULL").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("sum"), F.max("length").alias("most")).first()
    per_shard = seen.where("word IS NOT NULL").groupBy("word", "shard").agg(F.count(F.lit(1)).alias("n"))
    df = materialise(per_shard.groupBy("word").agg(F.sum("n").alias("df"), F.collect_list("shard").alias("shards")), "decontam-df")
    for k in range(n):
        own = {r["word"]: r["df"] for r in df.where(F.array_contains("shards", F.lit(k).cast("long"))).select("word", "df").collect()}
        part = items.where(F.col("shard") == k).select("item_id", "text").collect()
        yield uuid.uuid4().hex, ([(r["item_id"], r["text"]) for r in part], (own, whole["n"], (whole["sum"] or 0) / max(1, whole["n"]), whole["most"] or 0))


LEAKS = "doc_id long, item_id long, score double, passage_at long, question_overlap double, answer_overlap double"


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per document and test item that it leaks."""
    spark, out = docs.sparkSession, None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [x.split()[0] for x in LEAKS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.float64()]
    for key, part in _shards(items):
        shared = spark.sparkContext.broadcast(part)  # a shard: SHARD_ITEMS, SHARD_BYTES

        def task(batches: Iterator[pa.RecordBatch], key=key, shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(key, shared.value, threshold)
            for batch in batches:
                found = [(d, *x) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                         for x in index.leaks(t)]
                cols = list(zip(*found)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        got = rows.mapInArrow(tidy(task), LEAKS)
        out = got if out is None else out.unionByName(got)
    return out


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that leak an item; nothing is shuffled."""
    spark = docs.sparkSession
    for key, part in _shards(items):
        shared = spark.sparkContext.broadcast(part)  # a shard: SHARD_ITEMS, SHARD_BYTES

        def task(batches: Iterator[pa.RecordBatch], key=key, shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index(key, shared.value, threshold)
            for batch in batches:
                keep = [not index.leaks(t) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(tidy(task), docs.schema)
    return docs
