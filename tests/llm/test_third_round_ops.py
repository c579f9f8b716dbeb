"""Bottom-k near-dedup, the divergence audit and the value dictionaries against plain versions."""
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import bottomk, divergence, queries, valuedict


# ------------------------------------------------------------------ bottom-k near-dedup
def plain_set(text):
    ws = (text or "").encode().lower().split()
    return frozenset(tuple(ws[k:k + 5]) for k in range(len(ws) - 4)) or (frozenset([tuple(ws)]) if ws else frozenset())


def plain_groups(rows):
    """[(doc_id, n_shingles, component_id)] by all pairs of rows."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def family(rng, n_words, n, most):
    base = [f"w{rng.randrange(10**6)}" for _ in range(n_words)]
    for _ in range(n):
        ws = list(base)
        for _ in range(rng.randint(0, most)):
            ws[rng.randrange(len(ws))] = f"x{rng.randrange(10**6)}"
        yield " ".join(ws)


@pytest.mark.parametrize("sizes", [dict(), dict(list_rows=3, block_rows=7, pivots=2), dict(list_rows=12, block_rows=5, pivots=0)])
def test_bottomk_against_all_pairs(spark, sizes):
    rng = random.Random(11)
    passage = " ".join(f"common{k}" for k in range(30))
    texts = [*family(rng, 200, 60, 5), *family(rng, 30, 25, 1), *family(rng, 90, 12, 3)]
    texts += [" ".join(f"y{rng.randrange(10**6)}" for _ in range(40)) + " " + passage for _ in range(40)]
    texts += texts[:20] + ["one two", "ONE  two", "one two three", "a b c d e", "A b c\nd e", "", None, "  \t", "z " * 4000]
    rng.shuffle(texts)
    rows = [(3 * k + 1, t) for k, t in enumerate(texts)]
    rows += [rows[4], rows[4], (rows[7][0], "another text under a known id for once"), (None, texts[9]), (None, "only without an id in all"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"cid": F.lit("clash"), "family": F.lit(1), "n": F.lit(2.0)})
    got = bottomk.near_groups(docs.repartition(5), **sizes).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(plain_groups(rows))
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)


def test_bottomk_one_family_of_a_third_of_the_rows(spark):
    rng = random.Random(5)
    texts = [*family(rng, 120, 150, 4)] + [" ".join(f"q{rng.randrange(10**7)}" for _ in range(60)) for _ in range(300)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = bottomk.near_groups(docs, list_rows=20, block_rows=16, pivots=4).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(plain_groups(rows))


def test_bottomk_no_rows_and_text_ids(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert bottomk.near_groups(none).collect() == []
    some = spark.createDataFrame([("b", "u v w x y z"), ("a", "u v w x y z")], none.schema)
    assert {(r.doc_id, r.component_id, r.kept) for r in bottomk.near_groups(some).collect()} == {("b", "a", False), ("a", "a", True)}


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 400), min_size=1))
def test_estimate_is_over_the_union(a, b):
    k = 16
    both = sorted(a | b)[:k]
    small = lambda s: np.array(sorted(s)[:k], np.uint64)
    assert bottomk.estimate(small(a), small(b), k) == pytest.approx(sum(x in a and x in b for x in both) / len(both))


def test_bottomk_query_on_the_smallest_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op11_bottomk"][0](spark, sf).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(plain_groups(rows))


# ------------------------------------------------------------------ divergence
def plain_audit(rows, min_docs, top):
    table_ = {i: chr(i + 32) for i in range(65, 91)}
    docs = []
    for lang, source, text in rows:
        low = "".join(table_.get(ord(c), c) for c in text or "")
        docs.append((lang or "", source or "", "".join(c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in low).split(" ")))
    out = []
    for lang in {d[0] for d in docs}:
        own = [(s, [t for t in ts if t]) for g, s, ts in docs if g == lang]
        df = Counter(t for _, ts in own for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for s, ts in own:
            counts[s].update(t for t in ts if t in set(kept))
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        ps, q = {s: p(counts[s]) for s, _ in own}, p(sum(counts.values(), Counter()))
        for s in ps:
            pairs = [(r, sum(abs(ps[s][t] - ps[r][t]) for t in kept)) for r in ps if r != s]
            ts = [(t, ps[s][t] - q[t]) for t in kept if counts[s][t] and ps[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", ts, top)):
                for rank, (item, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                    out.append((lang, s, part, item, v, rank))
    return sorted(out)


def test_divergence_against_plain(spark):
    rng = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "naïve", "Ärger", "日本", "x", "it's", "a b", "q1r2", "zebra"]
    rows = []
    for _ in range(160):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s1", "s10", "s2", None, "é"])
        rows.append((lang, source, rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 9)))))
    rows += [("en", "empty", None), ("en", "blank", ""), ("fr", "few", "un deux"), ("fr", "other", "123 !"), ("en", "s1", "beta " * 5000)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"term": F.lit("clash"), "ix": F.lit(0)})
    got = divergence.audit(docs.repartition(4), min_docs=3, top_terms=4)
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, 3, 4)
    assert divergence.audit(docs.where("lang = 'none'")).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="aB é0\n日-", max_size=60), st.integers(1, 12))
def test_terms_do_not_depend_on_the_slices(text, size):
    import re
    was, divergence.SLICE = divergence.SLICE, size
    try:
        got = [t.decode() for some in divergence.terms(text.encode()) for t in some]
    finally:
        divergence.SLICE = was
    assert got == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.replace("B", "b"))


def test_tree_corrections_flush_and_shards(spark, monkeypatch):
    rng = random.Random(8)
    z = {("l", s): 10 + s for s in range(12)} | {("m", s): 7 for s in range(12)}
    rows = []
    for _ in range(300):
        lang = rng.choice("lm")
        path = [(s, rng.randint(1, 4) * 20, z[lang, s]) for s in sorted(rng.sample(range(12), rng.randint(1, 8)))]
        rows.append((lang, path, rng.randint(1, 5)))
    want = Counter()
    for lang, path, n in rows:
        for k, (b, pb, zb) in enumerate(path):
            for a, pa_, za in path[:k]:
                want[lang, a, b] += n * (abs(pa_ - pb) - abs(pb - za) - abs(pa_ - zb) + abs(za - zb))
    df = spark.createDataFrame(rows, "lang string, path array<struct<ix:long,p:long,z:long>>, mult long")
    for parts in (1, 7):
        got = divergence.corrections(df.repartition(parts)).groupBy("lang", "lo", "hi").agg(F.sum("v").alias("v")).collect()
        assert {(r.lang, r.lo, r.hi): r.v for r in got if r.v} == {k: v for k, v in want.items() if v}


# ------------------------------------------------------------------ value dictionaries
def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    ok = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not ok:
        return [], None
    dim = len(ok[0][1])
    ok = [r for r in ok if len(r[1]) == dim]
    ints = [[max(-2**26, min(2**26, math.floor(scale * x))) for x in r[1]] for r in ok]
    cuts = [k * dim // parts for k in range(parts + 1)]
    books = [[v[a:b] for v in ints[:entries]] for a, b in zip(cuts, cuts[1:])]

    def assign():
        out = []
        for v in ints:
            row = []
            for (a, b), book in zip(zip(cuts, cuts[1:]), books):
                row.append(min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), k) for k, e in enumerate(book)))
            out.append(row)
        return out

    for _ in range(rounds):
        got = assign()
        for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
            for k in range(len(books[part])):
                own = [v[a:b] for v, g in zip(ints, got) if g[part][1] == k]
                if own:
                    books[part][k] = [sum(c) // len(own) for c in zip(*own)]
    rows = [(r[0], r[2], "".join(f"{k:02x}" for _, k in g), sum(d for d, _ in g)) for r, g in zip(ok, assign())]
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return rows, hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("dim,n", [(16, 120), (64, 40), (11, 60), (5, 30), (8, 7)])
def test_valuedict_against_plain(spark, monkeypatch, dim, n):
    rng = random.Random(dim)
    rows = [(k // 2 if k % 9 == 0 else k, [rng.choice([rng.gauss(0, .2), 0.25, -1 / 4096]) for _ in range(dim)], rng.choice([0, 1, 1, None])) for k in range(n)]
    rows += [rows[3], rows[3], (None, [0.5] * dim, 1), (900, None, 1), (901, [None] * dim, 1), (902, [float("nan")] * dim, 2),
             (903, [float("inf")] + [0.0] * (dim - 1), 2), (904, [1e30] * dim, 3), (905, [0.1] * (dim + 1), 1), (906, [], 4)]
    rng.shuffle(rows)
    monkeypatch.setattr(valuedict, "BLOCK_CELLS", dim * 13)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit("clash"))
    coded, books = valuedict.compress(df.repartition(3))
    got = valuedict.with_label_error(coded).collect()
    want, digest = plain_codes(rows)
    assert Counter((r.id, r.label, r.code, r.error) for r in got) == Counter(want)
    assert books.digest() == digest
    by = Counter()
    for _, label, _, error in want:
        by[label] += error
    assert all(r.label_error == by[r.label] for r in got)


def test_valuedict_codes_decode_and_no_rows(spark):
    df = spark.createDataFrame([(k, [float(k)] * 8, 1) for k in range(5)], "vec_id long, embedding array<float>, label int")
    coded, books = valuedict.compress(df)
    assert {r.id: books.decode(r.code) for r in coded.collect()} == {k: [4096 * k] * 8 for k in range(5)}
    coded, books = valuedict.compress(df.where("vec_id < 0"))
    assert coded.collect() == [] and books is None
