"""Exact substring dedup by hash-compared suffix sorting.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too.

Anchors: among the ``KGRAM``-byte strings of a window of ``length`` bytes, the one with the
least hash (the leftmost on a tie) is the window's anchor. Equal windows have equal
anchors at equal places, so all copies of a string meet at its anchor. An occurrence of
an anchor stands for the consecutive windows that chose it; its span is their bytes (under 2 x ``length``).

1. Every batch of documents sends its distinct anchors with a digest of the span. Of
   an anchor seen once nothing repeats; if all its spans are equal, all repeat.
2. Only anchors with differing spans send the bytes. Per anchor, the suffixes that begin
   at it and the reversed prefixes before it are sorted by mergesort. Two suffixes
   are compared through their longest common extension, found by binary search over prefix polynomial
   hashes (so in logarithmic steps) and verified on the bytes. From
   the extensions of neighbours in both orders follows which windows recur (see ``covers``).
   Anchors with more than ``HOT`` occurrences are settled by their windows instead: each
   window's 128-bit digest goes to its own bucket and comes back as seen once or again, so no
   group of copies meets in one task.
3. The covered intervals go back to the batch, which cuts them out of the texts.

Digests that settle a whole span have 128 bits with the anchor's. All counts are exact; nothing is
capped or sampled. Texts are bytes of UTF-8, and no window crosses two documents.

Defined results: null counts as empty; texts under ``length`` bytes are kept whole; rows that
repeat (even their id) are copies of each other; a very long text is whole in the task of its batch; an empty
table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batching import pack_arrays, packed, text_bytes, texts, unpack_arrays
from .common import shared_path

LENGTH = 200
KGRAM = 32
HOT = 2000
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
CHUNK = 1 << 21  # windows looked at together
BASE = 0x9E3779B97F4A7C15 | 1  # odd: it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
ONCE, EQUAL, MIXED, CROWDED = range(4)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, n of them at least."""
    if len(_POWERS[0]) < n:
        _POWERS[:] = [_powers(BASE, n), _powers(INVERSE, n)]
    return _POWERS


class PrefixHash:
    """Prefix polynomial hashes of a buffer."""

    def __init__(self, data: np.ndarray):
        self.data = data
        up, self.down = powers(len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            (data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64)])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        """Hash of data[start:start + size], the same wherever the string stands."""
        return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at a and b, ``most`` at most:
        binary search over the hashes, then verified on the bytes."""
        lo, hi = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
        while True:
            mid = (lo + hi + 1) // 2
            if not (lo < hi).any():
                break
            same = self.of(a, mid) == self.of(b, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        for k in range(0, len(a), 1 << 14):  # a collision of hashes shows here
            x, y, n = a[k:k + (1 << 14)], b[k:k + (1 << 14)], lo[k:k + (1 << 14)]
            if not len(n) or not n.max():
                continue
            j = np.arange(n.max())
            inside = j < n[:, None]
            last = len(self.data) - 1
            bad = (self.data[np.minimum(x[:, None] + j, last)] != self.data[np.minimum(y[:, None] + j, last)]) & inside
            wrong = bad.any(1)
            if wrong.any():
                lo[k:k + (1 << 14)] = np.where(wrong, bad.argmax(1), n)
        return lo


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH):
    """(place, first window, last window, hash) of every anchor of the documents
    data[starts:ends], in order."""
    n_windows = len(data) - length + 1
    if n_windows <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    step = np.zeros(len(data) + 1, np.int32)
    long_ = ends - starts >= length
    np.add.at(step, starts[long_], 1)
    np.add.at(step, ends[long_] - length + 1, -1)
    valid = np.cumsum(step[:n_windows]) > 0
    width = length - KGRAM + 1
    got = []
    for lo in range(0, n_windows, CHUNK):
        js = np.flatnonzero(valid[lo:lo + CHUNK])
        if not len(js):
            continue
        part = data[lo:lo + CHUNK + length - 1]
        n = len(part) - KGRAM + 1
        h = PrefixHash(part).of(np.arange(n), KGRAM)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        v = (h >> np.uint64(24) << np.uint64(24)) | np.arange(n, dtype=np.uint64)  # CHUNK + length < 2^24
        size = 1
        while size * 2 <= width:  # least value of each window, by doubling
            v = np.minimum(v[:-size], v[size:])
            size *= 2
        if size < width:
            v = np.minimum(v[:len(v) - (width - size)], v[width - size:])
        at = (v[js] & np.uint64((1 << 24) - 1)).astype(np.int64)
        cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(js) != 1)) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [len(js)]]) - 1
        got.append((at[first] + lo, js[first] + lo, js[last] + lo, h[at[first]]))
    if not got:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    place, first, last, h = (np.concatenate(x) for x in zip(*got))
    same = np.concatenate([[False], (place[1:] == place[:-1]) & (first[1:] == last[:-1] + 1)])  # cut by a chunk's border
    keep = np.flatnonzero(~same)
    return place[keep], first[keep], last[np.concatenate([keep[1:], [len(place)]]) - 1], h[keep]


# ---------------------------------------------------------------- suffix sort
def merge_sort(ph: PrefixHash, group: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order by group (given sorted), then by the strings data[start:start + size].

    Bottom-up mergesort of all groups side by side: an element's place in a merged run
    is its place in its own run plus its rank in the other, found by binary search.
    """
    n = len(group)
    order = np.arange(n)
    if not n:
        return order
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.concatenate([begin, [n]]))
    first = np.repeat(begin, sizes)
    count = np.repeat(sizes, sizes)
    place = np.arange(n) - first  # place within the group
    width = 1

    def before(x: np.ndarray, y: np.ndarray, tie: np.ndarray) -> np.ndarray:
        most = np.minimum(size[x], size[y])
        l = ph.extension(start[x], start[y], most)
        inside = l < most
        last = len(ph.data) - 1
        cx, cy = ph.data[np.minimum(start[x] + l, last)], ph.data[np.minimum(start[y] + l, last)]
        return np.where(inside, cx < cy, np.where(size[x] != size[y], size[x] < size[y], tie))

    while width < sizes.max():
        act = np.flatnonzero(count > width)
        run = place[act] // width
        sib = run ^ 1
        lo0 = first[act] + sib * width
        hi0 = np.minimum(first[act] + count[act], lo0 + width)
        has = lo0 < first[act] + count[act]
        act, run, lo, hi = act[has], run[has], lo0[has].copy(), hi0[has].copy()
        base = lo.copy()
        left = run % 2 == 0
        while (open_ := lo < hi).any():
            at = np.flatnonzero(open_)
            mid = (lo[at] + hi[at]) // 2
            # the other's element stands before: strictly, or on a tie if it is the left run's
            go = before(order[mid], order[act[at]], ~left[at])
            lo[at] = np.where(go, mid + 1, lo[at])
            hi[at] = np.where(go, hi[at], mid)
        to = first[act] + (run // 2) * 2 * width + place[act] % width + (lo - base)
        new = order.copy()
        new[to] = order[act]
        order = new
        width *= 2
    return order


def covers(data: np.ndarray, group: np.ndarray, start: np.ndarray, size: np.ndarray, off: np.ndarray,
           twice: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Per distinct span the intervals (in it) that repeated strings cover.

    ``off`` is the anchor's place in its span, ``twice`` says that the span occurs again as a
    whole. For spans a and b of one anchor with common extensions R to the right and L
    to the left, [anchor - L, anchor + R) repeats if L + R reaches ``length``. For each
    value r among a group's neighbours in the right order, the spans that share r are put in the left order;
    the largest L there is a neighbour's.
    """
    out: list[list[tuple[int, int]]] = [[(0, n)] if t else [] for n, t in zip(size.tolist(), twice.tolist())]
    if not len(group):
        return out
    ahead = PrefixHash(data)
    back = PrefixHash(np.ascontiguousarray(data[::-1]))
    right_at, right_n = start + off, size - off
    left_at, left_n = len(data) - (start + off), off
    right = merge_sort(ahead, group, right_at, right_n)
    left = merge_sort(back, group, left_at, left_n)

    def neighbours(ph, order, at, n):
        x, y = order[:-1], order[1:]
        return np.where(group[x] == group[y], ph.extension(at[x], at[y], np.minimum(n[x], n[y])), 0)

    r_near, l_near = neighbours(ahead, right, right_at, right_n), neighbours(back, left, left_at, left_n)
    l_pad = np.append(l_near, 0)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    finish = np.concatenate([begin[1:], [len(group)]])
    place = np.empty(len(group), np.int64)
    place[left] = np.arange(len(group))
    found: list[tuple[int, int, int]] = []
    for a, b in zip(begin.tolist(), finish.tolist()):
        if b - a < 2:
            continue
        if b - a == 2:
            l, r = int(l_near[a]), int(r_near[a])
            if l + r >= length:
                found += [(a, l, r), (a + 1, l, r)]
            continue
        near, members = r_near[a:b - 1], right[a:b]
        most = int(l_near[a:b - 1].max())
        for r in np.unique(near[near + most >= length]).tolist():
            joined = near >= r
            edge = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
            for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
                spots = np.sort(place[members[lo:hi + 1]])
                gap = np.minimum.reduceat(l_pad, spots)[:-1]
                best = np.maximum(np.concatenate([[0], gap]), np.concatenate([gap, [0]]))
                ok = best + r >= length
                found += [(int(m), int(l), r) for m, l in zip(left[spots[ok]], best[ok])]
    for m, l, r in found:
        o = int(off[m])
        out[m].append((o - l, o + r))
    return out


# ---------------------------------------------------------------- jobs
class Spans:
    """The anchors of a batch of texts with their spans and digests."""

    def __init__(self, docs: list[bytes], length: int):
        self.data = np.frombuffer(b"".join(docs), np.uint8)
        sizes = np.array([len(d) for d in docs], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.place, self.first, last, self.key = anchors(self.data, self.starts, self.ends, length)
        self.stop = last + length
        view = memoryview(self.data)
        digest = xxhash.xxh3_64_intdigest
        self.digest = np.array([digest(view[a:b], o) for a, b, o in zip(
            self.first.tolist(), self.stop.tolist(), (self.place - self.first).tolist())], np.uint64)
        # distinct anchors: least and largest digest and how many
        order = np.lexsort((self.digest, self.key))
        k = self.key[order]
        cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        self.keys = k[cut]
        self.counts = np.diff(np.concatenate([cut, [len(k)]])).astype(np.uint32)
        d = self.digest[order]
        self.low = d[cut]
        self.mixed = (d[np.concatenate([cut[1:], [len(k)]]) - 1] != self.low) if len(k) else np.zeros(0, bool)
        self.of_anchor = np.searchsorted(self.keys, self.key)


def _by_bucket(keys: np.ndarray, n: int):
    """(bucket, places of its keys) in order."""
    of = (keys % np.uint64(n)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    names = np.unique(of)
    lo, hi = np.searchsorted(of[order], names), np.searchsorted(of[order], names, side="right")
    for name, a, b in zip(names.tolist(), lo.tolist(), hi.tolist()):
        yield name, order[a:b]


def _settle(parts: list[list[np.ndarray]], hot: int) -> np.ndarray:
    """Verdict on each (key, digest, mixed, count) entry of a bucket."""
    key, digest, mixed, count = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((digest, key))
    k, d = key[order], digest[order]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    end = np.concatenate([cut[1:], [len(k)]])
    total = np.add.reduceat(count[order].astype(np.int64), cut)
    differ = (d[cut] != d[end - 1]) | np.maximum.reduceat(mixed[order], cut).astype(bool)
    verdict = np.where(total < 2, ONCE, np.where(~differ, EQUAL, np.where(total > hot, CROWDED, MIXED)))
    out = np.empty(len(key), np.uint8)
    out[order] = np.repeat(verdict, end - cut)
    return out


def _window_digests(s: Spans, which: np.ndarray, length: int):
    """(occurrence, window start, two digests) of every window of the given occurrences."""
    n = (s.stop - length + 1 - s.first)[which]
    occ = np.repeat(which, n)
    begin = np.repeat(s.first[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    view, digest = memoryview(s.data), xxhash.xxh3_64_intdigest
    one = np.array([digest(view[b:b + length]) for b in begin.tolist()], np.uint64)
    return occ, begin, one, s.key[occ] ^ (begin - s.place[occ]).astype(np.uint64)


def _union(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


ANCHOR = (np.uint64, np.uint64, np.uint8, np.uint32)  # key, digest, mixed, count
SPAN = (np.uint64, np.uint64, np.uint16, np.uint16, np.uint8, np.uint8)  # key, digest, size, anchor, twice, bytes
WINDOW = (np.uint64, np.uint64, np.uint32)  # two digests, count


def dedup(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed): ``removed`` lists the
    cut intervals as start, end, start, end, ... in bytes."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    n_bytes = text_bytes(rows)
    n_batches, n_buckets = 1 + n_bytes // BATCH_BYTES, 1 + n_bytes // BUCKET_BYTES
    dealt = packed(rows, n_batches)
    folder = shared_path(spark, "suffix")

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        s = Spans(texts(pdf), length)
        out = [(name, int(pdf["batch"].iloc[0]), pack_arrays(
            s.keys[at], s.low[at], s.mixed[at].astype(np.uint8), s.counts[at])) for name, at in _by_bucket(s.keys, n_buckets)]
        return pd.DataFrame(out, columns=["bucket", "batch", "blob"])

    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_arrays(blob, *ANCHOR) for blob in pdf["blob"]]
        verdict = _settle(parts, hot)
        cut = np.cumsum([len(p[0]) for p in parts])[:-1]
        return pd.DataFrame([(batch, int(key[0]), pack_arrays(v)) for batch, v in zip(
            pdf["batch"].tolist(), np.split(verdict, cut))], columns=["batch", "bucket", "blob"])

    verdicts = (dealt.groupBy("batch").applyInPandas(ask, "bucket long, batch long, blob binary")
                .groupBy("bucket").applyInPandas(settle, "batch long, bucket long, blob binary"))

    def spread(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        """What is settled already (bucket -1), and the spans and windows that are not."""
        names = ["kind", "bucket", "batch", "blob"]
        if not len(rows):
            return pd.DataFrame(columns=names)
        batch, docs_ = int(rows["batch"].iloc[0]), texts(rows)
        s = Spans(docs_, length)
        verdict = np.zeros(len(s.keys), np.uint8)
        blobs = dict(zip(got["bucket"].tolist(), got["blob"]))
        for name, at in _by_bucket(s.keys, n_buckets):
            verdict[at] = unpack_arrays(blobs[name], np.uint8)[0]
        verdict = verdict[s.of_anchor]
        out = []
        # spans to compare: distinct (anchor, digest), in the order of their keys
        mixed = np.flatnonzero(verdict == MIXED)
        order = mixed[np.lexsort((s.digest[mixed], s.key[mixed]))]
        new = np.concatenate([[True], (s.key[order][1:] != s.key[order][:-1]) | (s.digest[order][1:] != s.digest[order][:-1])]) \
            if len(order) else np.zeros(0, bool)
        lead = order[new]
        row_of = np.cumsum(new) - 1  # which distinct span an occurrence is
        times = np.bincount(row_of, minlength=len(lead))
        for name, at in _by_bucket(s.key[lead], n_buckets):
            x = lead[at]
            out.append(("span", name, batch, pack_arrays(
                s.key[x], s.digest[x], (s.stop - s.first)[x].astype(np.uint16), (s.place - s.first)[x].astype(np.uint16),
                (times[at] > 1).astype(np.uint8),
                np.concatenate([s.data[a:b] for a, b in zip(s.first[x].tolist(), s.stop[x].tolist())]))))
        crowded = np.flatnonzero(verdict == CROWDED)
        occ, begin, one, two = _window_digests(s, crowded, length)
        wins, w_of = np.unique(np.stack([one, two], 1), axis=0, return_inverse=True) if len(one) else (
            np.zeros((0, 2), np.uint64), np.zeros(0, np.int64))
        w_times = np.bincount(w_of.ravel(), minlength=len(wins)).astype(np.uint32)
        for name, at in _by_bucket(wins[:, 0], n_buckets):
            out.append(("window", name, batch, pack_arrays(wins[at, 0], wins[at, 1], w_times[at])))
        # what the last job needs: settled intervals, and where answers go
        equal = np.flatnonzero(verdict == EQUAL)
        owner = lambda at: np.searchsorted(s.ends, at, side="right")
        hit = np.unique(np.concatenate([owner(s.first[equal]), owner(s.first[order]), owner(begin)])).astype(np.int64)
        hit_set = set(hit.tolist())
        state = {
            "ids": rows["doc_id"].tolist(), "sizes": [len(d) for d in docs_],
            "sha": [None if k in hit_set else hashlib.sha256(d).hexdigest() for k, d in enumerate(docs_)],
            "texts": {k: docs_[k] for k in hit_set}, "starts": s.starts,
            "equal": (s.first[equal], s.stop[equal]),
            "spans": (s.first[order], row_of, s.key[lead]),
            "windows": (begin, w_of.ravel(), wins[:, 0]),
        }
        out.append(("state", -1, batch, zstandard.ZstdCompressor(level=3).compress(pickle.dumps(state))))
        return pd.DataFrame(out, columns=names)

    (dealt.groupBy("batch").cogroup(verdicts.groupBy("batch"))
     .applyInPandas(spread, "kind string, bucket long, batch long, blob binary")
     .write.partitionBy("kind").parquet(folder))
    saved = spark.read.schema("bucket long, batch long, blob binary, kind string").parquet(folder)

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """Sort the spans of a bucket; or count its windows."""
        kind, bucket = key[0], int(key[1])
        if kind == "window":
            parts = [unpack_arrays(blob, *WINDOW) for blob in pdf["blob"]]
            pair = np.concatenate([np.stack(p[:2], 1) for p in parts])
            _, of = np.unique(pair, axis=0, return_inverse=True)
            again = (np.bincount(of.ravel(), np.concatenate([p[2] for p in parts])) > 1)[of.ravel()].astype(np.uint8)
            answers = [pack_arrays(x) for x in np.split(again, np.cumsum([len(p[0]) for p in parts])[:-1])]
        else:
            parts = [unpack_arrays(blob, *SPAN) for blob in pdf["blob"]]
            k, d, size, off, twice = (np.concatenate([p[j] for p in parts]) for j in range(5))
            data = np.concatenate([p[5] for p in parts])
            size, off = size.astype(np.int64), off.astype(np.int64)
            start = np.cumsum(size) - size
            order = np.lexsort((d, k))
            new = np.concatenate([[True], (k[order][1:] != k[order][:-1]) | (d[order][1:] != d[order][:-1])])
            lead, of = order[new], np.empty(len(k), np.int64)
            of[order] = np.cumsum(new) - 1
            seen = np.bincount(of, 1 + twice.astype(np.int64)) > 1
            _, group = np.unique(k[lead], return_inverse=True)
            found = [_union(x) for x in covers(data, group, start[lead], size[lead], off[lead], seen, length)]
            answers, at = [], 0
            for p in parts:
                mine = [found[j] for j in of[at:at + len(p[0])].tolist()]
                at += len(p[0])
                flat = np.array([x for f in mine for ab in f for x in ab], np.uint16)
                answers.append(pack_arrays(np.array([len(f) for f in mine], np.uint16), flat))
        return pd.DataFrame({"batch": pdf["batch"], "bucket": bucket, "kind": kind, "blob": answers})

    answers = saved.where("kind <> 'state'").groupBy("kind", "bucket").applyInPandas(
        compare, "batch long, bucket long, kind string, blob binary")
    id_type = rows.schema["doc_id"]
    schema = T.StructType([id_type, *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept_sha256", T.StringType()), T.StructField("removed", T.ArrayType(T.LongType()))])

    def finish(states: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        blobs = {(k, b): blob for k, b, blob in zip(got["kind"], got["bucket"].tolist(), got["blob"])}
        out = []
        for packed_state in states["blob"]:
            st = pickle.loads(zstandard.ZstdDecompressor().decompress(packed_state))
            starts = st["starts"]
            cuts: dict[int, list[tuple[int, int]]] = {}

            def cut(a: np.ndarray, b: np.ndarray):
                doc = np.searchsorted(starts, a, side="right") - 1
                for k, x, y in zip(doc.tolist(), (a - starts[doc]).tolist(), (b - starts[doc]).tolist()):
                    cuts.setdefault(k, []).append((x, y))

            cut(*st["equal"])
            first, row_of, keys = st["spans"]
            found: list = [()] * len(keys)
            for name, at in _by_bucket(keys, n_buckets):
                n, flat = unpack_arrays(blobs["span", name], np.uint16, np.uint16)
                stop = np.cumsum(n, dtype=np.int64) * 2
                for j, b, m in zip(at.tolist(), stop.tolist(), n.tolist()):
                    found[j] = flat[b - 2 * m:b].reshape(-1, 2).tolist()
            pairs = [(f + x, f + y) for f, j in zip(first.tolist(), row_of.tolist()) for x, y in found[j]]
            if pairs:
                cut(*np.array(pairs, np.int64).T)
            begin, w_of, keys = st["windows"]
            again = np.zeros(len(keys), bool)
            for name, at in _by_bucket(keys, n_buckets):
                again[at] = unpack_arrays(blobs["window", name], np.uint8)[0].astype(bool)
            begin = begin[again[w_of]] if len(begin) else begin
            cut(begin, begin + length)
            for k, (doc_id, size, sha) in enumerate(zip(st["ids"], st["sizes"], st["sha"])):
                gone = _union(cuts.get(k, []))
                if sha is None:
                    text, at, kept = st["texts"][k], 0, hashlib.sha256()
                    for a, b in gone:
                        kept.update(text[at:a])
                        at = b
                    kept.update(text[at:])
                    sha = kept.hexdigest()
                out.append((doc_id, size, sum(b - a for a, b in gone), len(gone), sha, [x for ab in gone for x in ab]))
        return pd.DataFrame(out, columns=[f.name for f in schema.fields])

    states = saved.where("kind = 'state'").select("batch", "blob")
    return states.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(finish, schema)
