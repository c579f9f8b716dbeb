"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a sample of its labelled text. A text
is parsed against an automaton into phrases, each the longest match that the
automaton still accepts (a symbol it has never seen is a phrase of its own). The
language that needs fewest phrases wins, normalised to bits per byte: phrases x
log2(sample length) / length of the text (Ziv-Merhav cross entropy).

Texts are lower-cased, and whatever isn't a letter or mark becomes one blank; the
symbols are UTF-8 bytes. Every text is parsed whole, in blocks of ``BLOCK`` bytes
that run side by side in numpy; no phrase crosses a block's border. The mismatch rule
is folded into a transition table: an entry holds the next state and how many phrases ended.

Bound of the fitted sample: ``SAMPLE_DOCS`` documents a language (by md5 of the id), and
``SAMPLE_BYTES`` bytes of them. A document gives pieces of ``PIECE`` characters that are spread over its
whole text; the first piece of every document comes first, then the second of each, until the bytes are
full, so no opening, however long, stands for the text. One sample per language reaches the driver and the tasks.

``known_language`` rejects by the parse: a text of at least ``SHORTEST`` bytes whose best language needs more bits a byte
than ``SLACK`` times what ``MOST`` of all held-in texts need at most, each in its own language (labels may be wrong, so the
last hundredth does not count), is of no language that was learned. Every labelled held-in text is parsed whole against its
language's sample, those that the sample was cut from by their pieces, against the other half of it; the bits are counted
in bins of 1 / ``BINS``, so only the bins reach the driver. Shorter texts say too little and stay.

Defined results: null text or a text without a letter is ``und`` with score 0, as is
every text if no language was learned (``known_language`` then keeps every text with a letter); ties go to the
language first by code point; an empty table gives no rows; rows with equal ids are judged on their own; very long texts are
parsed whole; columns that clash with those added give way to them in ``predict`` and are kept by ``known_language``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_mod, tidy

SAMPLE_DOCS = 64
SAMPLE_BYTES = 1 << 15
PIECE = 256
PIECES = (1 / 2, 1 / 4, 3 / 4, 1 / 8, 5 / 8, 3 / 8, 7 / 8, 1)  # where in the text each piece lies, in this order
SHORTEST = 256
SLACK = 1.5
MOST = 0.99
BINS = 1000
BLOCK = 1024
UNKNOWN = "und"
LANES = 1 << 12  # blocks parsed side by side


def letters(text: Column) -> Column:
    """Lower case, runs of other characters than letters and marks as one blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " "))


def pieces(text: str, size: int = PIECE) -> list[str]:
    """Pieces of ``size`` characters spread over a text, none twice; a short text is one piece."""
    if len(text) <= size:
        return [text]
    out, taken = [], []
    for share in PIECES:
        at = int(share * (len(text) - size))
        if all(abs(at - other) >= size for other in taken):
            taken.append(at)
            out.append(text[at:at + size])
    return out


def sampled(labelled: DataFrame, docs_each: int = SAMPLE_DOCS) -> dict[str, list[list[str]]]:
    """lang -> the pieces of its sampled documents, from rows (doc_id, text, lang)."""
    return {lang: [p for p, _ in texts] for lang, texts in _sampled(labelled, docs_each).items()}


def _sampled(labelled: DataFrame, docs_each: int = SAMPLE_DOCS) -> dict[str, list[tuple[list[str], int]]]:
    """``sampled`` with a hash of each document's text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [pieces(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("n"), batch.column("hash"), pa.array(got, pa.list_(pa.string()))],
                                             ["lang", "n", "hash", "pieces"])

    w = Window.partitionBy("lang").orderBy("order", "doc_id", "hash")
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("text"))
    chosen = known.select("lang", "doc_id", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("order"), "hash")
    chosen = F.broadcast(chosen.withColumn("n", F.row_number().over(w)).where(F.col("n") <= docs_each).alias("c"))  # docs_each a language
    rows = known.alias("k").join(chosen, F.col("k.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("k.hash") == F.col("c.hash"))
                                 & (F.col("k.lang") == F.col("c.lang"))).select("c.lang", "c.n", "c.hash", F.col("k.text").alias("text"))
    rows = rows.select("lang", "n", "hash", letters(F.col("text")).alias("text")).mapInArrow(cut, "lang string, n int, hash long, pieces array<string>")
    out: dict[str, dict[int, tuple[list[str], int]]] = {}
    for r in rows.collect():  # PIECES pieces of docs_each documents a language; rows that repeat one are equal
        out.setdefault(r["lang"], {})[r["n"]] = r["pieces"], r["hash"]
    return {lang: [texts[n] for n in sorted(texts)] for lang, texts in sorted(out.items())}


def dealt(texts: list[list[str]], bytes_each: int = SAMPLE_BYTES) -> bytes:
    """The first piece of every text, then the second of each, up to ``bytes_each`` bytes."""
    order = [p[k] for k in range(len(PIECES)) for p in texts if k < len(p)]
    return " ".join(order).encode()[:bytes_each]


def training_sample(labelled: DataFrame, docs_each: int = SAMPLE_DOCS,
                    bytes_each: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """lang -> sample text, from rows (doc_id, text, lang)."""
    return {lang: dealt(texts, bytes_each) for lang, texts in sampled(labelled, docs_each).items()}


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the minimal automaton that accepts every substring of ``data``."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Parser:
    """Transition tables of one automaton per language; counts phrases in numpy."""

    def __init__(self, samples: dict[str, bytes]):
        self.langs = sorted(samples)
        seen = sorted(set().union(*samples.values())) if samples else []
        self.symbols = np.full(256, len(seen), np.uint8)  # the one before the last: a byte never seen
        self.symbols[seen] = np.arange(len(seen))
        self.width = len(seen) + 2  # the last: the end of a block
        self.bits = np.array([np.log2(max(2, len(samples[x]))) for x in self.langs])
        self.tables = [self._table(samples[x]) for x in self.langs]

    def _table(self, data: bytes) -> np.ndarray:
        """entry = 4 * next state + phrases that ended."""
        nxt, other, end = suffix_automaton(data), self.width - 2, self.width - 1
        start = np.full(self.width, 1, np.int32)  # from the root, a symbol without an edge is a phrase
        for c, q in nxt[0].items():
            start[self.symbols[c]] = 4 * q
        start[end] = 0
        table = np.tile(start + 1, (len(nxt), 1))  # a mismatch ends the phrase and starts anew
        table[0] = start
        rows = np.repeat(np.arange(len(nxt)), [len(d) for d in nxt])
        cols = self.symbols[np.fromiter((c for d in nxt for c in d), np.uint8, len(rows))]
        table[rows, cols] = 4 * np.fromiter((q for d in nxt for q in d.values()), np.int32, len(rows))
        assert other < end
        return np.ascontiguousarray(table.ravel())

    def phrases(self, texts: list[bytes], only: str | None = None) -> np.ndarray:
        """Phrase counts, a row per text and a column per language (one column for the language ``only``)."""
        tables = self.tables if only is None else [self.tables[self.langs.index(only)]]
        out = np.zeros((len(texts), len(tables)), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        n_blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), n_blocks)
        first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        within = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        begin = first[owner] + within * BLOCK
        length = np.minimum(BLOCK, first[owner] + sizes[owner] - begin)
        data = self.symbols[np.frombuffer(b"".join(texts), np.uint8)]
        order = np.argsort(-length, kind="stable")
        for lo in range(0, len(order), LANES):
            lanes = order[lo:lo + LANES]
            got = self._lanes(tables, data, begin[lanes], length[lanes])
            for k in range(len(tables)):
                out[:, k] += np.bincount(owner[lanes], got[k], len(texts)).astype(np.int64)
        return out

    def _lanes(self, tables, data, begin, length) -> list[np.ndarray]:
        steps = int(length[0]) if len(length) else 0
        grid = np.full((steps, len(begin)), self.width - 1, np.uint8)
        active = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")  # lanes are sorted, longest first
        for i in range(steps):
            grid[i, :active[i]] = data[begin[:active[i]] + i]
        out = []
        for table in tables:
            state, count = np.zeros(len(begin), np.int32), np.zeros(len(begin), np.int32)
            for i in range(steps):
                a = active[i]
                e = table.take(state[:a] * self.width + grid[i, :a])
                count[:a] += e & 3
                state[:a] = e >> 2
            out.append(count + (state != 0))
        return out

    def rate(self, texts: list[bytes], lang: str) -> np.ndarray:
        """Bits per byte that texts (none empty) need in one language."""
        return self.phrases(texts, lang)[:, 0] * self.bits[self.langs.index(lang)] / np.array([len(t) for t in texts], float)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1: how far the runner-up stands behind), bits per byte."""
        sizes = np.array([len(t) for t in texts], float)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        cost = self.phrases(texts) * self.bits
        best = cost.argmin(1)
        least = cost[np.arange(len(texts)), best]
        rest = cost.copy()
        rest[np.arange(len(texts)), best] = np.inf
        second = rest.min(1)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(sizes == 0, 0.0, np.where(np.isinf(second), 1.0, 1 - least / second))
            rate = np.where(sizes == 0, 0.0, least / sizes)
        return [UNKNOWN if not s else self.langs[b] for s, b in zip(sizes, best)], np.clip(score, 0, 1), rate


_PARSERS: dict[int, Parser] = {}  # a Python worker builds the automata once


def _parser(samples: dict[str, bytes]) -> Parser:
    key = hash(tuple(sorted(samples.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(samples)
    return _PARSERS[key]


def _parsed(rows: DataFrame, samples: dict[str, bytes], added: list, most_bits: float | None = None) -> DataFrame:
    """``rows`` without ``_letters``; with the columns ``added``, of lang_pred, score and bits_per_byte. With
    ``most_bits`` the rows without a letter and the long ones above so many bits a byte are left out."""
    shared = rows.sparkSession.sparkContext.broadcast(samples)  # SAMPLE_BYTES a language
    fields = [f for f in rows.schema.fields if f.name != "_letters"]
    schema = T.StructType(fields + added)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                texts = part.column("_letters").cast(pa.binary()).to_pylist()
                lang, score, rate = parser.predict(texts)
                got = {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score), "bits_per_byte": pa.array(rate)}
                out = pa.RecordBatch.from_arrays([part.column(k) for k in range(len(fields))] + [got[f.name] for f in added],
                                                 schema.names)
                if most_bits is not None:
                    out = out.filter(pa.array([len(t) > 0 and (len(t) < SHORTEST or r <= most_bits) for t, r in zip(texts, rate)], pa.bool_()))
                yield out

    return rows.mapInArrow(tidy(task), schema)


def _only_letters(text: Column) -> Column:
    return F.when(text.rlike(r"\p{L}"), letters(text)).otherwise("").alias("_letters")


def predict(docs: DataFrame, samples: dict[str, bytes]) -> DataFrame:
    """``docs`` with lang_pred, score and bits_per_byte (of the winning language)."""
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("bits_per_byte", T.DoubleType())]
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in {"_letters", *(f.name for f in added)}]
    return _parsed(docs.select(*keep, _only_letters(F.col("text"))), samples, added)


def _held_in(docs: DataFrame) -> DataFrame:
    """The documents that may be learned from (crc32 of the id mod 3 is not 1)."""
    return docs.where(id_mod("doc_id", 3) != 1).select("doc_id", "text", "lang")


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Samples from the documents that are not held out."""
    return training_sample(_held_in(docs))


def most_bits(held_in: DataFrame, texts: dict[str, list[tuple[list[str], int]]]) -> float:
    """What ``MOST`` of all long held-in texts need at most in their own language, times ``SLACK``, the most of all languages;
    no bound where no text is long enough. ``texts``: the sampled ones and their hashes."""
    if not texts:
        return float("inf")
    own: dict[tuple[str, int], float | None] = {}  # of sampled texts: learned from the other half
    for lang, pairs in texts.items():
        for half in (0, 1):
            tested = [(h, t) for h, t in ((h, " ".join(p).encode()) for p, h in pairs[half::2]) if len(t) >= SHORTEST]
            other = dealt([p for p, _ in pairs[1 - half::2]])
            rates = Parser({lang: other}).rate([t for _, t in tested], lang).tolist() if tested and other else [None] * len(tested)
            own |= {(lang, h): r for (h, _), r in zip(tested, rates)}
    samples = {lang: dealt([p for p, _ in pairs]) for lang, pairs in texts.items()}
    shared = held_in.sparkSession.sparkContext.broadcast((samples, own))  # SAMPLE_BYTES and SAMPLE_DOCS numbers a language

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, own = _parser(shared.value[0]), shared.value[1]
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                langs, hashes = part.column("lang").to_pylist(), part.column("hash").to_pylist()
                todo: dict[str, list[bytes]] = {}
                found = []
                for lang, h, t in zip(langs, hashes, part.column("_letters").cast(pa.binary()).to_pylist()):
                    if len(t) < SHORTEST:
                        continue
                    if (lang, h) not in own:
                        todo.setdefault(lang, []).append(t)
                    elif own[lang, h] is not None:
                        found.append((lang, own[lang, h]))
                for lang, some in todo.items():
                    found += [(lang, r) for r in parser.rate(some, lang).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()),
                                                  pa.array([int(np.ceil(r * BINS)) for _, r in found], pa.int64())], ["lang", "bin"])

    rows = held_in.where(F.col("lang").isin(*samples)).select("lang", F.xxhash64("text").alias("hash"), _only_letters(F.col("text")))
    bins: dict[str, list[tuple[int, int]]] = {}
    for r in rows.mapInArrow(tidy(task), "lang string, bin long").groupBy("lang", "bin").count().collect():
        bins.setdefault(r["lang"], []).append((r["bin"], r["count"]))
    found = []
    for counts in bins.values():
        at, n = np.array(sorted(counts), np.int64).T
        found.append(at[np.searchsorted(n.cumsum(), MOST * n.sum())] / BINS)
    return SLACK * float(max(found)) if found else float("inf")


def known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose text has no language: null, without a letter, or like none that was learned."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # whatever the columns are called, they come back as they were
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], _only_letters(F.col("text")))
    held_in = _held_in(docs)
    texts = _sampled(held_in)
    samples = {lang: dealt([p for p, _ in own]) for lang, own in texts.items()}
    return _parsed(rows, samples, [], most_bits(held_in, texts)).toDF(*docs.columns)
