"""Language-model scoring with a hierarchical Pitman-Yor model.

A token is drawn in the restaurant of the word before it, one restaurant a word; those
restaurants share one parent, the restaurant over all words, whose base is uniform over
the training vocabulary and one unknown word. Seating is
sampled by Gibbs: a dish's number of tables is drawn from its conditional given its customers, the
other tables and the parent's probability (generalised Stirling numbers); dishes above
``EXACT`` customers seat the rest in blocks. The tables are the parent's customers.
Predictive probabilities are averaged over ``SAMPLES`` sweeps after ``BURN_IN`` and summed
as log10 over a text's tokens (perplexity is 10 ** (-score / n_tokens)).

As Spark jobs: each task cuts its documents into batches of about ``BATCH_BYTES``, whose tokens are
split once and kept as numbers. Words are dealt into buckets by a 64-bit hash; a bucket numbers
its words, those of most batches first, and tells the batches. Each batch then sends every bucket its
distinct pairs (word before, word) with training counts, so a hot pair travels once a batch. A bucket
adds the counts up and samples the seating of its words, a job a sweep: after a
sweep every bucket sends what its dishes hold of a restaurant to the bucket of that
restaurant's word, which adds up the restaurant's tables over all buckets and tells them to those buckets; of the
parent the driver adds up two totals. A dish takes only its own tables off them. Then every
bucket answers each batch, which scores its texts. All counts cover all training documents.

Defined results: words are runs without ASCII white space, A-Z lower-cased; a text ends
with one end token, so null and empty texts have one token, and the end token stands before a
text's first word; without training
documents every token has the base's probability 1 (one unknown word); rows with
equal ids are scored each; a very long text is whole in the task of its batch; an empty table gives no rows; other
columns are ignored. A bucket holds at most 2 ** 24 distinct words, a corpus 2 ** 16 buckets (1 TB of text).
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batching import pack_ints, text_bytes, unpack_ints
from .common import materialise

CONTEXTS = 16  # groups of restaurants in a state's control sums; there is a restaurant for each word
RANK_BITS, BUCKET_BITS = 24, 16  # a word's number: its bucket, then its rank there
BATCH_BYTES = 14 << 20
SPLIT_BYTES = 1 << 20
BUCKET_BYTES = 16 << 20
DISCOUNTS = (0.8, 0.6)  # context restaurants, word restaurant
STRENGTHS = (5.0, 10.0)
BURN_IN, SAMPLES = 3, 2
EXACT = 64
SEED = 17


# ---------------------------------------------------------------- seating
def _log_stirling(d: float, size: int) -> np.ndarray:
    """log of the generalised Stirling numbers, [customers, tables]."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(size):
        t = np.arange(1, c + 2)
        grow = np.where(t <= c, np.log(np.maximum(c - d * t, 1e-300)), -np.inf)
        out[c + 1, 1:c + 2] = np.logaddexp(out[c, :c + 1], out[c, 1:c + 2] + grow)
    return out


_STIRLING: dict[float, np.ndarray] = {}


def sample_tables(c: np.ndarray, p: np.ndarray, mass: np.ndarray, d: float, rng) -> np.ndarray:
    """Tables of dishes with ``c`` customers (0 or more), given the parent's
    probability ``p`` and ``mass`` = strength + d * (tables of the other dishes)."""
    if d not in _STIRLING:
        _STIRLING[d] = _log_stirling(d, EXACT)
    table = _STIRLING[d]
    t = np.minimum(c, 1).astype(np.int64)
    order = np.argsort(np.minimum(c, EXACT), kind="stable")
    sizes = np.minimum(c, EXACT)[order]
    edges = np.searchsorted(sizes, np.arange(2, EXACT + 2))
    lp = np.log(np.maximum(p, 1e-300))
    for n in range(2, EXACT + 1):
        at = order[edges[n - 2]:edges[n - 1]]
        if not len(at):
            continue
        j = np.arange(n)
        logit = np.cumsum(np.log(mass[at, None] + d * j) + lp[at, None], axis=1) + table[n, 1:n + 1]
        weight = np.exp(logit - logit.max(1, keepdims=True)).cumsum(1)
        t[at] = 1 + (weight < rng.random(len(at))[:, None] * weight[:, -1:]).sum(1)
    at = np.flatnonzero(c > EXACT)
    seated = np.full(len(at), EXACT, np.int64)
    while len(at):
        more = np.minimum(np.maximum(1, seated // 16), c[at] - seated)
        new = (mass[at] + d * t[at]) * p[at]
        t[at] += rng.binomial(more, np.clip(new / np.maximum(seated - d * t[at] + new, 1e-12), 0, 1))
        seated += more
        left = seated < c[at]
        at, seated = at[left], seated[left]
    return t


# ---------------------------------------------------------------- batches
def split_texts(texts: list[bytes | None], learned: np.ndarray, n_buckets: int) -> tuple[bytes, list[tuple[int, np.ndarray]]]:
    """The tokens of a batch of texts as numbers, and the hashes of its words a bucket. Words are
    numbered by bucket, then hash."""
    hashed, sizes, tokens, waiting = [], [], [], 0

    def fold():
        held = np.empty(len(tokens), object)
        held[:] = tokens
        codes, words = pd.factorize(held)
        hashed.append(np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)[codes])
        tokens.clear()

    for t in texts:
        ws = t.lower().split() if t else []
        sizes.append(len(ws) + 1)
        tokens += ws
        tokens.append(b"")  # the end, and what stands before the first word
        waiting += len(t or b"")
        if waiting > SPLIT_BYTES:
            fold()
            waiting = 0
    fold()
    codes, hashes = pd.factorize(np.concatenate(hashed))
    bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    codes = number[codes]
    often = np.bincount(codes)
    frequent = np.empty(len(order), np.int64)  # frequent words as small numbers take less room
    frequent[np.argsort(-often, kind="stable")] = np.arange(len(order))
    each = np.bincount(bucket, minlength=n_buckets)
    parts = np.split(hashes[order], np.cumsum(each)[:-1])
    return pack_ints(np.array(sizes), learned, frequent[codes], often, each), [(k, h) for k, h in enumerate(parts) if len(h)]


class Batch:
    """Tokens of a batch: distinct pairs (word, word before) in the order of the words' numbers, and the pair of each token."""

    def __init__(self, blob: bytes):
        # of a text: its tokens, whether it is learned from; words a bucket
        self.sizes, self.learned, frequent, often, self.each = unpack_ints(blob, 5)
        codes = np.argsort(-often, kind="stable")[frequent]
        self.n_words = int(self.each.sum())
        pairs, self.token_pair = np.unique(codes * self.n_words + np.roll(codes, 1), return_inverse=True)
        self.pair_word, self.pair_context = pairs // self.n_words, pairs % self.n_words

    def requests(self, ranks: dict[int, np.ndarray]):
        """(bucket, ranks of its words, pairs a word, numbers of the words before, training counts),
        given the ranks of the batch's words a bucket."""
        bucket = np.repeat(np.arange(len(self.each)), self.each)
        rank = np.concatenate([ranks[k] for k in np.flatnonzero(self.each).tolist()])
        number = bucket << RANK_BITS | rank
        count = np.bincount(self.token_pair[np.repeat(self.learned > 0, self.sizes)], minlength=len(self.pair_word))
        ends = np.cumsum(self.each)
        cuts = np.searchsorted(self.pair_word, ends)
        w0 = p0 = 0
        for k, (w1, p1) in enumerate(zip(ends.tolist(), cuts.tolist())):
            if w1 > w0:
                yield (k, rank[w0:w1], np.bincount(self.pair_word[p0:p1] - w0, minlength=w1 - w0),
                       number[self.pair_context[p0:p1]], count[p0:p1])
            w0, p0 = w1, p1


def pair_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch's request: ranks of its words, keys of its pairs (word's rank, then number of the word before), counts."""
    rank, each, context, count = unpack_ints(blob, 4)
    return rank, np.repeat(rank, each).astype(np.uint64) << np.uint64(RANK_BITS + BUCKET_BITS) | context.astype(np.uint64), count


def merged(blobs: Iterator[bytes], pending: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of all requests to a bucket and their counts; at most about ``pending`` pairs stand unmerged."""
    keys, counts, waiting = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0

    def fold():
        k, at = np.unique(np.concatenate(keys), return_inverse=True)
        keys[:], counts[:] = [k], [np.bincount(at, np.concatenate(counts), len(k)).astype(np.int64)]

    for blob in blobs:
        _, k, c = pair_keys(blob)
        keys.append(k)
        counts.append(c)
        waiting += len(k)
        if waiting > max(pending, len(keys[0])):
            fold()
            waiting = 0
    fold()
    return keys[0], counts[0]


def steps(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The first array, and of each other its differences from the one before, with the sign in the lowest bit."""
    return [arrays[0], *((d << 1) ^ (d >> 63) for d in (b - a for a, b in pairwise(arrays)))]


def from_steps(arrays: list[np.ndarray]) -> list[np.ndarray]:
    return list(accumulate(arrays, lambda a, d: a + ((d >> 1) ^ -(d & 1))))


class Seats:
    """Seating of a bucket's dishes. Pairs seen once hold one table for ever, so only
    pairs seen more often (``word``, ``context``, ``count``, ``tables``) are drawn;
    ``single`` counts the pairs seen once a word, ``single_group`` a group of restaurants.
    ``context`` is a place in ``contexts``, the numbers of the restaurants of those pairs."""

    FIXED, MOVING = 6, 2 + 2 * SAMPLES  # arrays of a state that no sweep changes, and others

    def __init__(self, live, context, count, contexts, single, single_group, tables, word_tables, *kept):
        self.word = np.repeat(np.arange(len(live)), live)
        self.context, self.count, self.tables, self.contexts = context, count, tables, contexts
        self.single, self.single_group, self.word_tables = single, single_group, word_tables
        self.kept, self.kept_words = list(kept[:SAMPLES]), list(kept[SAMPLES:])

    @classmethod
    def new(cls, word, context, count, n_words: int) -> Seats:
        """Of pairs in the order of their words."""
        live, once = count > 1, count == 1
        contexts, at = np.unique(context[live], return_inverse=True)
        s = cls(np.bincount(word[live], minlength=n_words), at, count[live], contexts,
                np.bincount(word[once], minlength=n_words), np.bincount(context[once] % CONTEXTS, minlength=CONTEXTS),
                np.ones(int(live.sum()), np.int64), None, *[np.zeros(0, np.int64)] * (2 * SAMPLES))
        s.word_tables = np.minimum(s.customers(s.tables), 1)
        return s

    @classmethod
    def load(cls, fixed: bytes, moving: bytes) -> Seats:
        live, context, count, contexts, *single = unpack_ints(fixed, cls.FIXED)
        return cls(live, context, count, np.cumsum(contexts), *single, *unpack_ints(moving, cls.MOVING))

    def fixed(self) -> bytes:
        return pack_ints(np.bincount(self.word, minlength=len(self.single)), self.context, self.count,
                         np.diff(self.contexts, prepend=0), self.single, self.single_group)

    def state(self, key: int, last: bool) -> dict:
        """What a sweep changed, the control sums, and what goes to the homes of the restaurants: what the
        bucket's dishes take off their customers, after the last sweep in all samples."""
        taken = [self.shared(t) for t in (self.kept if last else [self.tables])]
        home, place = self.contexts >> RANK_BITS, self.contexts & ((1 << RANK_BITS) - 1)
        homes, at = np.unique(home, return_index=True)
        sent = [pack_ints(np.diff(place[i:j], prepend=0), *(t[i:j] for t in taken))
                for i, j in pairwise([*at.tolist(), len(home)])]
        return {"bucket": [key], "blob": [pack_ints(self.tables, self.word_tables, *self.kept, *self.kept_words)],
                "totals": [self.totals().tobytes()], "homes": [homes], "sent": [sent]}

    def customers(self, tables: np.ndarray) -> np.ndarray:
        """The parent's customers a word: the word's tables in all restaurants."""
        return self.single + np.bincount(self.word, tables, len(self.single)).astype(np.int64)

    def known(self) -> np.ndarray:
        """The training count of each word: the customers of its dishes, and as many of its own restaurant."""
        return self.customers(self.count)

    def shared(self, tables: np.ndarray) -> np.ndarray:
        """Customers less tables a restaurant of ``contexts``: what the bucket's dishes take off its customers."""
        return np.bincount(self.context, self.count - tables, len(self.contexts)).astype(np.int64)

    def totals(self) -> np.ndarray:
        """Tables a group of restaurants, the parent's customers and tables: a bucket's share of what all buckets add up."""
        tables = self.single_group + np.bincount(self.contexts[self.context] % CONTEXTS, self.tables, CONTEXTS).astype(np.int64)
        return np.concatenate([tables, [self.customers(self.tables).sum(), self.word_tables.sum()]]).astype(np.int64)

    def sweep(self, tables: np.ndarray, totals: np.ndarray, n_kinds: int, number: int, rng) -> None:
        """One Gibbs sweep, given the tables of each restaurant of ``contexts`` and the parent's totals
        over all buckets after the sweep before. A dish takes its own tables, and only those, off them."""
        d1, d0 = DISCOUNTS
        s1, s0 = STRENGTHS
        big_c, big_t = int(totals[CONTEXTS]), int(totals[CONTEXTS + 1])
        base = 1 / (1 + n_kinds)
        c0, t0 = self.customers(self.tables), self.word_tables
        rest_c = c0[self.word] - self.tables
        rest_t = np.minimum(t0[self.word], rest_c)
        others = big_t - t0[self.word] + rest_t
        p = (rest_c - d0 * rest_t + (s0 + d0 * others) * base) / (s0 + big_c - self.tables)
        self.tables = sample_tables(self.count, p, s1 + d1 * (tables[self.context] - self.tables), d1, rng)
        c0 = self.customers(self.tables)
        self.word_tables = sample_tables(c0, np.full(len(c0), base), s0 + d0 * (big_t - t0), d0, rng)
        if number >= BURN_IN:
            self.kept[number - BURN_IN] = self.tables
            self.kept_words[number - BURN_IN] = self.word_tables

    def pair_tables(self, count: np.ndarray) -> np.ndarray:
        """Tables a pair, added up over the samples, for the ``count`` the seats were made of."""
        out = np.where(count == 1, SAMPLES, 0)
        out[count > 1] = sum(self.kept)
        return out


def _seat(word, context, count, n_words: int, n_buckets: int, seed: int):
    """All sweeps over dishes (word, context, count) that stand in one bucket, in restaurants numbered
    below ``CONTEXTS``: what ``score`` does over many. Returns the mean of count - d * tables per pair, per sample
    customers - d * tables per word, and the totals: customers a restaurant, then per sample
    tables a restaurant, the parent's customers and tables, and last the words that were learned."""
    if n_buckets != 1:
        raise ValueError("totals of several buckets are added up between sweeps")
    rng = np.random.default_rng(seed)
    d1, d0 = DISCOUNTS
    seats = Seats.new(word, context, count, n_words)
    customers = np.bincount(context, count, CONTEXTS).astype(np.int64)
    n_kinds, per = len(np.unique(word[count > 0])), [seats.totals()]
    for number in range(BURN_IN + SAMPLES):
        seats.sweep(customers[seats.contexts] - seats.shared(seats.tables), per[-1], n_kinds, number, rng)
        per.append(seats.totals())
    return ((count - d1 * seats.pair_tables(count) / SAMPLES).astype(np.float32),
            [(seats.customers(k) - d0 * w).astype(np.float32) for k, w in zip(seats.kept, seats.kept_words)],
            np.concatenate([customers, *per[-SAMPLES:], [n_kinds]]).astype(np.int64))


def score(docs: DataFrame, held_out) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score);
    rows where the column ``held_out`` is true are not learned from."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    n_bytes = text_bytes(rows)
    n_buckets, batch_bytes = min(1 + n_bytes // BUCKET_BYTES, 1 << BUCKET_BITS), BATCH_BYTES
    id_type = rows.schema["doc_id"]

    def deal(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's rows in batches of about BATCH_BYTES of text, split into numbered tokens."""
        first, number = TaskContext.get().partitionId() << 32, 0
        waiting: list[pa.RecordBatch] = []
        size = 0

        def batch():
            ids, held, text = (pa.concat_arrays([w.column(k) for w in waiting]) for k in range(3))
            blob, words = split_texts(text.cast(pa.binary()).to_pylist(), ~held.to_numpy(zero_copy_only=False).astype(bool), n_buckets)
            asks = [{"bucket": k, "blob": pack_ints(np.diff(h, prepend=np.uint64(0)))} for k, h in words]
            whole = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([first + number], pa.int64()), pa.ListArray.from_arrays(whole, ids), pa.ListArray.from_arrays(whole, held),
                 pa.array([blob], pa.binary()), pa.array([asks], pa.list_(pa.struct([("bucket", pa.int64()), ("blob", pa.binary())])))],
                ["batch", "doc_id", "held_out", "blob", "asks"])

        for b in arrow:
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at, done = 0, 0
            while at < len(ends):
                to = min(len(ends), int(np.searchsorted(ends, done + batch_bytes - size)) + 1)
                waiting.append(b.slice(at, to - at))
                size += int(ends[to - 1]) - done
                at, done = to, int(ends[to - 1])
                if size >= batch_bytes:
                    yield batch()
                    number += 1
                    waiting, size = [], 0
        if waiting:
            yield batch()

    def rank(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """The ranks of a bucket's words, those of most batches first, told to each batch."""
        pdf = pdf.sort_values("batch")
        parts = [np.cumsum(unpack_ints(b, 1)[0].view(np.uint64)) for b in pdf["blob"]]
        hashes, at = np.unique(np.concatenate(parts), return_inverse=True)
        if len(hashes) > 1 << RANK_BITS:
            raise ValueError(f"{len(hashes)} distinct words in a bucket: BUCKET_BYTES is too large")
        ranks = np.empty(len(hashes), np.int64)
        ranks[np.argsort(-np.bincount(at, minlength=len(hashes)), kind="stable")] = np.arange(len(hashes))
        told = np.split(ranks[at], np.cumsum([len(p) for p in parts])[:-1])
        return pd.DataFrame({"batch": pdf["batch"].to_numpy(), "bucket": int(key[0]), "blob": [pack_ints(t) for t in told]})

    def ask(key: tuple, pdf: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        ranks = {k: unpack_ints(b, 1)[0] for k, b in zip(told["bucket"].tolist(), told["blob"])}
        out = [(k, int(key[0]), pack_ints(*arrays)) for k, *arrays in Batch(pdf["blob"].iloc[0]).requests(ranks)]
        return pd.DataFrame(out, columns=["bucket", "batch", "blob"])

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys, count = merged(pdf.sort_values("batch")["blob"])
        word = (keys >> np.uint64(RANK_BITS + BUCKET_BITS)).astype(np.int64)
        seats = Seats.new(word, (keys & np.uint64((1 << RANK_BITS + BUCKET_BITS) - 1)).astype(np.int64), count, int(word[-1]) + 1)
        known = seats.known()
        first = np.concatenate([seats.totals(), [known.sum(), (known > 0).sum()]])
        return pd.DataFrame(seats.state(int(key[0]), False) | {"totals": [first.astype(np.int64).tobytes()],
                                                               "fixed": [seats.fixed()], "known": [pack_ints(known)]})

    def add_tables(key: tuple, sent: pd.DataFrame, fixed: pd.DataFrame) -> pd.DataFrame:
        """The tables of a bucket's own restaurants over all buckets, told to each that holds dishes of them."""
        tables = unpack_ints(fixed["known"].iloc[0], 1)[0]
        places = []
        for blob in sent["blob"]:
            at, taken = unpack_ints(blob, 2)
            places.append(np.cumsum(at))
            tables[places[-1]] -= taken
        return pd.DataFrame({"bucket": sent["sender"].astype(np.int64), "home": int(key[0]), "blob": [pack_ints(tables[at]) for at in places]})

    def sweeps(totals, n_kinds: int, number: int):
        def run(key: tuple, fixed: pd.DataFrame, moving: pd.DataFrame) -> pd.DataFrame:
            told = moving.sort_values("home")["blob"].tolist()  # the bucket's own state, then the tables of its restaurants
            seats = Seats.load(fixed["fixed"].iloc[0], told[0])
            tables = np.concatenate([np.empty(0, np.int64), *(unpack_ints(b, 1)[0] for b in told[1:])])
            seats.sweep(tables, totals, n_kinds, number, np.random.default_rng([SEED, int(key[0]), number]))
            return pd.DataFrame(seats.state(int(key[0]), number == BURN_IN + SAMPLES - 1))
        return run

    def answer(key: tuple, pdf: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """Per word its training count, and per sample its restaurant's tables, its tables as a dish (each as steps
        from the one before) and at the parent; per pair its training count and its tables, added up over the samples."""
        pdf = pdf.sort_values("batch")
        keys, count = merged(pdf["blob"])
        fixed, moving, *sent = held.sort_values("sender")["blob"]
        seats = Seats.load(fixed, moving)
        known = seats.known()
        own = [known.copy() for _ in range(SAMPLES)]
        for blob in sent:
            at, *taken = unpack_ints(blob, 1 + SAMPLES)
            at = np.cumsum(at)
            for tables, t in zip(own, taken):
                tables[at] -= t
        words = [*steps([known, *own, *(seats.customers(k) for k in seats.kept)]), *seats.kept_words]
        tables = seats.pair_tables(count)
        out = []
        for blob in pdf["blob"]:
            ws, k, _ = pair_keys(blob)
            at = np.searchsorted(keys, k)
            out.append(pack_ints(*(x[ws] for x in words), count[at], tables[at]))
        return pd.DataFrame({"batch": pdf["batch"].to_numpy(), "bucket": int(key[0]), "blob": out})

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for blob in b.column("totals").to_pylist():
                x = np.frombuffer(blob, np.int64)
                total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], ["totals"])

    def over_all(state: DataFrame, size: int) -> np.ndarray:
        total = np.zeros(size, np.int64)
        for r in state.select("totals").coalesce(64).mapInArrow(add_up, "totals array<long>").toLocalIterator():
            total += np.array(r["totals"], np.int64)
        return total

    whole = [T.StructField(f, T.ArrayType(t)) for f, t in (("doc_id", id_type.dataType), ("held_out", T.BooleanType()))]
    dealt = materialise(rows.mapInArrow(deal, T.StructType([
        T.StructField("batch", T.LongType()), *whole, T.StructField("blob", T.BinaryType()),
        T.StructField("asks", T.ArrayType(T.StructType([T.StructField("bucket", T.LongType()), T.StructField("blob", T.BinaryType())])))])),
        "lm-batches")
    told = dealt.select("batch", F.explode("asks").alias("ask")).select("batch", "ask.bucket", "ask.blob").groupBy("bucket").applyInPandas(
        rank, "batch long, bucket long, blob binary")
    # kept where they were shuffled to: read for the first seats and for the answers
    parts = max(n_buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = dealt.select("batch", "blob").groupBy("batch").cogroup(told.groupBy("batch")).applyInPandas(
        ask, "bucket long, batch long, blob binary")
    asked = asked.repartition(parts, "bucket").persist(StorageLevel.DISK_ONLY)
    schema = "bucket long, blob binary, totals binary, homes array<long>, sent array<binary>"
    state = materialise(asked.groupBy("bucket").applyInPandas(gather, schema + ", fixed binary, known binary"), "lm-seats")
    fixed = state.select("bucket", "fixed", "known").repartition(parts, "bucket").persist(StorageLevel.DISK_ONLY)
    first = over_all(state, CONTEXTS + 4)
    n_train, n_kinds, per = int(first[-2]), int(first[-1]), [first[:CONTEXTS + 2]]

    def sent(state: DataFrame) -> DataFrame:
        one = state.select(F.col("bucket").alias("sender"), F.explode(F.arrays_zip("homes", "sent")).alias("one"))
        return one.select(F.col("one.homes").alias("bucket"), "sender", F.col("one.sent").alias("blob"))

    def marked(state: DataFrame, mark: int, name: str, blob: str) -> DataFrame:
        return state.select("bucket", F.lit(mark).cast("long").alias(name), F.col(blob).alias("blob"))

    for number in range(BURN_IN + SAMPLES):
        tables = sent(state).groupBy("bucket").cogroup(fixed.groupBy("bucket")).applyInPandas(
            add_tables, "bucket long, home long, blob binary")
        state = materialise(fixed.groupBy("bucket").cogroup(marked(state, -1, "home", "blob").union(tables).groupBy("bucket")).applyInPandas(
            sweeps(per[-1], n_kinds, number), schema), "lm-seats")
        per.append(over_all(state, CONTEXTS + 2))
    held = marked(fixed, -2, "sender", "fixed").union(marked(state, -1, "sender", "blob")).union(sent(state))
    replies = asked.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInPandas(answer, "batch long, bucket long, blob binary")
    shared = [(int(p[CONTEXTS]), int(p[CONTEXTS + 1])) for p in per[-SAMPLES:]]  # the parent's customers and tables a sample
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    d1, d0 = DISCOUNTS
    s1, s0 = STRENGTHS

    def finish(rows: pa.Table, got: pa.Table) -> pa.Table:
        b = Batch(rows.column("blob")[0].as_py())
        blobs = dict(zip(got.column("bucket").to_pylist(), got.column("blob").to_pylist()))
        parts = zip(*(unpack_ints(blobs[k], 3 + 3 * SAMPLES) for k in np.flatnonzero(b.each).tolist()))
        *words, count, tables = (np.concatenate(p) for p in parts)
        known, *per = *from_steps(words[:1 + 2 * SAMPLES]), *words[1 + 2 * SAMPLES:]
        ctx, base = b.pair_context, 1 / (1 + n_kinds)
        back = np.zeros(len(ctx))
        for (c0, t0), own, customers, at_parent in zip(shared, per[:SAMPLES], per[SAMPLES:2 * SAMPLES], per[2 * SAMPLES:]):
            parent = (customers - d0 * at_parent + (s0 + d0 * t0) * base) / (s0 + c0)
            back += (s1 + d1 * own[ctx]) * parent[b.pair_word] / SAMPLES
        logp = np.log10((count - d1 * tables / SAMPLES + back) / (s1 + known[ctx]))
        doc = np.repeat(np.arange(len(b.sizes)), b.sizes)
        c = known[b.pair_word][b.token_pair]
        plain = np.log10((c + 1) / (n_train + n_kinds + 1))
        sums = lambda x: np.bincount(doc, x, len(b.sizes))
        return pa.table(dict(zip(names, (
            rows.column("doc_id").combine_chunks().flatten(), rows.column("held_out").combine_chunks().flatten(), b.sizes,
            sums(c > 0).astype(np.int64), np.full(len(b.sizes), n_train, np.int64), sums(plain), sums(logp[b.token_pair])))))

    schema = T.StructType([id_type, T.StructField("held_out", T.BooleanType()),
                           *[T.StructField(k, T.LongType()) for k in ("n_tokens", "n_known", "train_tokens")],
                           *[T.StructField(k, T.DoubleType()) for k in ("base_score", "score")]])
    scores = materialise(dealt.drop("asks").groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(finish, schema), "lm-scores")
    asked.unpersist()
    fixed.unpersist()
    return scores
