"""Merkle trees, WARC, mixing, suffix dedup, SimHash and the language model
against plain versions."""
import hashlib
import io
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import merkle, mixing, pitman_yor, queries, simhash, suffix_dedup, warc
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(k for k, v in queries.QUERIES.items() if v[1]))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    query, sql = queries.QUERIES[name]
    df = query(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


# ------------------------------------------------------------------ Merkle trees
def test_merkle_edges(spark):
    rows = [(1, None), (2, ""), (3, "one\ntwo three"), (4, "one\ntwo three"), (5, "one\ntwo four"), (None, "é" * 50_000),
            (None, "x\n\n\n"), (5, "one\ntwo four")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    f = merkle.with_fingerprint(df, "text", "fp").collect()
    by = {}
    for r in f:
        by.setdefault(r.text or "", set()).add(merkle_root(r.fp))
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by)
    got = merkle.with_next(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["doc_id", "text"]).collect()
    plain = sorted([(d, t or "") for d, t in rows], key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted(str((a, b)) for a, b in zip(plain, plain[1:] + plain[:1]))
    assert sorted(str(((r.doc_id, r.text), (r.next.doc_id, r.next.text))) for r in got) == want
    none = spark.createDataFrame([], df.schema)
    assert merkle.with_next(none, ["doc_id", "text"]).count() == 0
    one = merkle.with_next(df.limit(1).coalesce(1), ["doc_id", "text"]).collect()
    assert len(one) == 1 and one[0].next.doc_id == one[0].doc_id


def merkle_root(fp):
    return fp.split(":")[0]


def test_merkle_locates_an_edit(spark):
    paragraphs = [f"paragraph {k} with some words in it" for k in range(30)]
    other = paragraphs[:12] + ["changed"] + paragraphs[13:]
    df = spark.createDataFrame([("\n".join(paragraphs), "\n".join(other))], "a string, b string")
    df = merkle.with_fingerprint(merkle.with_fingerprint(df, "a", "x"), "b", "y")
    r = df.select(merkle.first_difference(F.col("x"), F.col("y")).alias("d"),
                  merkle.likeness(merkle.nodes(F.col("x")), merkle.nodes(F.col("y"))).alias("l"),
                  merkle.likeness(merkle.nodes(F.col("x")), merkle.nodes(F.col("x"))).alias("s")).first()
    assert r.d == 12 and 0.5 < r.l < 1 and r.s == 1


# ------------------------------------------------------------------ WARC
@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=400), max_size=8), st.integers(1, 3))
def test_inflate_and_split(payloads, members):
    records = [warc.record_bytes(k, "http://x/", p, hashlib.sha1(p).hexdigest(), "response", None)
               for k, p in enumerate(payloads)]
    data, n = b"".join(records), len(records)
    cuts = sorted({round(len(data) * k / members) for k in range(members + 1)})
    blob = b""
    for a, b in zip(cuts, cuts[1:]):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        blob += z.compress(data[a:b]) + z.flush()
    got = list(warc.split_records(warc.inflate(io.BytesIO(blob))))
    assert got == records and len(got) == n
    for k, r in enumerate(got):
        fields, block = warc.parse_record(r)
        assert fields["warc-record-id"] == f"<urn:page:{k}>" and block.endswith(payloads[k])


def test_warc_ends_early():
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    blob = z.compress(b"x" * 1000) + z.flush()
    with pytest.raises(ValueError):
        list(warc.inflate(io.BytesIO(blob[:-12])))


def test_warc_edges(spark):
    big, small = "é" * 600, "tiny"
    rows = [(1, "http://a", big), (7, "http://b", big), (3, None, big), (4, "u v\nw", small), (5, "u", small), (6, "u", None),
            (None, "u", big), (8, "u", ""), (7, "http://b", big), (9, "u", "y" * 2_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    got = warc.round_trip(spark, df).collect()
    key = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in got)
    assert key == sorted([("1", 1200, "revisit", 7), ("7", 1200, "response", None), ("3", 1200, "revisit", 7),
                          ("4", 4, "response", None), ("5", 4, "response", None), ("6", 0, "response", None),
                          ("None", 1200, "revisit", 7), ("8", 0, "response", None), ("7", 1200, "response", None),
                          ("9", 2_000_000, "response", None)])
    assert all(r.payload_digest == hashlib.sha1((t or "").encode()).hexdigest() for r in got
               for t in [next(h for p, _, h in rows if p == r.page_id)])
    assert len({(r.archive, r.record_offset) for r in got}) == len(rows)
    assert warc.round_trip(spark, spark.createDataFrame([], df.schema)).count() == 0


# ------------------------------------------------------------------ mixing
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(sizes):
    w = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, w, sum(sizes))
    assert math.isclose(sum(got), sum(sizes), abs_tol=1e-6)
    assert all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes))
    free = [t / x for t, s, x in zip(got, sizes, w) if t < 3 * s - 1e-9]
    assert not free or max(free) - min(free) < 1e-6


def test_mixing_edges(spark):
    rows = [(i, "w " * (i % 50 + 1), "ab"[i % 2]) for i in range(60)] + [(None, "x y z", None), (61, None, "a"), (62, "", None),
                                                                         (1, "w w", "b"), (1, "w w", "b")]
    rows += [(100 + i, None, "a") for i in range(5)] + [(200, "long " * 30_000, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(df, block_words=7).collect()
    assert len(got) == len(rows)
    assert all(r.taken <= 3 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(n - t) <= 1 for n, t in by.values())
    assert sorted(map(str, mixing.mix(df, block_words=7).collect())) == sorted(map(str, got))
    assert mixing.mix(spark.createDataFrame([], df.schema)).count() == 0
    kept = mixing.mixed(df, block_words=7)
    assert kept.count() == sum(r.taken > 0 for r in got)


def test_schedule_is_even(spark):
    """Any stretch of the schedule holds each source by its share."""
    sources = [{"size": 1000, "target": t, "quota": int(t)} for t in (500.0, 300.0, 200.0)]
    s = mixing._schedule(spark, sources, 1).orderBy("slot").collect()
    for a, b in ((0, 100), (300, 400), (0, 1000)):
        n = Counter(r.src for r in s if a <= r.slot < b)
        assert all(abs(n[k] - (b - a) * x) <= 4 for k, x in enumerate((0.5, 0.3, 0.2)))
    assert len({(r.src, r.block) for r in s}) == len(s) == 1000


# ------------------------------------------------------------------ suffix dedup
def plain_dedup(docs, size):
    seen = Counter(d[i:i + size] for d in docs for i in range(len(d) - size + 1))
    out = []
    for d in docs:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - size + 1):
            if seen[d[i:i + size]] > 1:
                gone[i:i + size] = 1
        mask = gone[:len(d)].astype(bool)
        kept = np.frombuffer(d, np.uint8)[~mask].tobytes()
        out.append((len(d), int(mask.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot,batch", [(2000, 4 << 20), (3, 4 << 20), (2000, 6000)])
def test_suffix_dedup_is_exact(spark, monkeypatch, hot, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4 * batch)
    rng = random.Random(hot + batch)
    some = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    common = [some(n) for n in (230, 260, 300, 210, 700)]
    docs = []
    for _ in range(100):
        t = some(rng.randint(0, 400))
        for _ in range(rng.randint(0, 3)):
            c = rng.choice(common)
            t += c[rng.randint(0, 30):len(c) - rng.randint(0, 30)] + some(rng.randint(0, 60))
        docs.append(t)
    docs += ["a" * 700, "ab" * 300, "a" * 199, "", docs[5], docs[5], "x" + docs[6], ("-" * 250 + "\n") * 3, None]
    ids = list(range(len(docs) - 2)) + [None, 5]
    df = spark.createDataFrame(list(zip(ids, docs)), "doc_id long, text string").withColumn("packed", F.lit(1))
    want = plain_dedup([(t or "").encode() for t in docs], 200)
    got = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffix_dedup.dedup(df, hot=hot).collect()]
    assert sorted(map(str, got)) == sorted(map(str, zip(ids, want)))
    assert suffix_dedup.dedup(spark.createDataFrame([], df.schema)).count() == 0


def test_chunk_borders(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    starts, ends = np.array([0, 1500, 1600]), np.array([1500, 1600, 5000])
    whole = suffix_dedup.anchors(data, starts, ends)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 333)
    for a, b in zip(whole, suffix_dedup.anchors(data, starts, ends)):
        assert a.tolist() == b.tolist()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.text(alphabet="ab", max_size=12)), min_size=1, max_size=30))
def test_merge_sort(rows):
    rows = sorted(rows, key=lambda r: r[0])
    text = [t.encode() for _, t in rows]
    data = np.frombuffer(b"".join(text) + b"z", np.uint8)
    size = np.array([len(t) for t in text])
    order = suffix_dedup.merge_sort(suffix_dedup.PrefixHash(data), np.array([g for g, _ in rows]), np.cumsum(size) - size, size)
    assert [rows[k] for k in order] == sorted(rows)


def test_collisions_are_verified(monkeypatch):
    data = np.frombuffer(b"abcdefgh" + b"abcxefgh", np.uint8)
    ph = suffix_dedup.PrefixHash(data)
    monkeypatch.setattr(ph, "of", lambda a, n: np.zeros(len(a), np.uint64))  # every hash collides
    assert ph.extension(np.array([0, 0]), np.array([8, 0]), np.array([8, 8])).tolist() == [3, 8]


# ------------------------------------------------------------------ SimHash
def plain_simhash(text):
    ws = text.encode().lower().split()
    if not ws:
        return 0
    parts = [b" ".join(ws[k:k + 3]) for k in range(len(ws) - 2)] or [b" ".join(ws)]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(fps))]


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2 ** 64 - 1), st.lists(st.integers(0, 63), max_size=2, unique=True))
def test_linked_values_share_a_shard(x, flips):
    y = x
    for b in flips:
        y ^= 1 << b
    assert any(x & m == y & m for m in simhash.shard_masks(2))


def test_bk_tree():
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(50)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values:
        assert sorted(tree.within(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


@pytest.mark.parametrize("shard_rows", [4096, 3])
def test_simhash_groups(spark, shard_rows):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += [t + " tail" for t in texts[:40]] + texts[:30] + ["", None, "A b", "a B", "x" * 50_000] + ["one two three"] * 9
    ids = [3 * k + 1 for k in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = {r.doc_id: r for r in simhash.near_groups(df, shard_rows=shard_rows).collect()}
    fps = [plain_simhash(t or "") for t in texts]
    want = plain_components(fps)
    for k, i in enumerate(ids):
        assert got[i].fp % (1 << 64) == fps[k] and got[i].component_id == ids[want[k]]
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted({ids[w] for w in want})


def test_simhash_edges(spark):
    df = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (5, "q r s t u v"), (2, None)],
                               "doc_id long, text string")
    got = sorted((str(r.doc_id), r.component_id) for r in simhash.near_groups(df).collect())
    assert ("None", 5) in got and ("2", 2) in got and len(got) == 5
    assert sorted(r.doc_id for r in simhash.one_of_each(df).collect()) == [2, 5, 5]  # two texts under one id
    none = spark.createDataFrame([], df.schema)
    assert simhash.near_groups(none).count() == 0 and simhash.one_of_each(none).count() == 0


def test_long_chain_is_one_component(spark):
    chain = [(2 ** k - 1) for k in range(0, 60, 2)]
    edges = simhash.links(spark.createDataFrame([(c,) for c in chain], "fp long"))
    part = simhash.components(edges).collect()
    assert {r.b for r in part} == {0} and len(part) == len(chain) - 1


# ------------------------------------------------------------------ language model
def test_op9_counts_and_base(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    tokens = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in docs}
    c = Counter(t for d, ts in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2 for t in ts)
    n, v = sum(c.values()), len(c)
    rows = queries.op9_pitman_yor(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ts = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ts), sum(c[t] > 0 for t in ts), n)
        assert math.isclose(r.base_score, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    """Over all words and the unknown one, after any context."""
    mean, kept, totals = pitman_yor._seat(np.array([0, 0, 1, 2]), np.array([0, 1, 0, 1]), np.array([3, 1, 2, 70]), 3, 1, 5)
    customers, kinds = totals[:pitman_yor.CONTEXTS], totals[-1]
    per = totals[pitman_yor.CONTEXTS:-1].reshape(pitman_yor.SAMPLES, -1)
    d1, d0 = pitman_yor.DISCOUNTS
    s1, s0 = pitman_yor.STRENGTHS
    for ctx, pairs in ((0, {0: mean[0], 1: mean[2]}), (1, {0: mean[1], 2: mean[3]}), (9, {})):
        total = 0.0
        for w in range(4):  # three words and the unknown one
            p = 0.0
            for g in range(pitman_yor.SAMPLES):
                own = kept[g][w] if w < 3 else 0.0
                c0, t0 = per[g, pitman_yor.CONTEXTS], per[g, pitman_yor.CONTEXTS + 1]
                parent = (own + (s0 + d0 * t0) / (1 + kinds)) / (s0 + c0)
                p += (s1 + d1 * per[g, ctx]) * parent / pitman_yor.SAMPLES
            total += (p + pairs.get(w, 0.0)) / (s1 + customers[ctx])
        assert abs(total - 1) < 1e-5


def test_scores_do_not_hang_on_buckets_or_batches(spark, monkeypatch):
    """Counts are the same however the words are dealt; probabilities nearly."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.col("doc_id") % 5 == 0
    one = {r.doc_id: r for r in pitman_yor.score(df, held).collect()}
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 60_000)
    monkeypatch.setattr(pitman_yor, "BATCH_BYTES", 50_000)
    for r in pitman_yor.score(df, held).collect():
        o = one[r.doc_id]
        assert (r.n_known, r.train_tokens) == (o.n_known, o.train_tokens) and math.isclose(r.base_score, o.base_score)
        assert abs(r.score - o.score) < 0.02 * abs(o.score) + 0.5


def test_seats_take_exact_totals_in_every_bucket(spark, monkeypatch):
    """A very frequent word in one bucket must not blow up the totals the others use."""
    rare = [(i, f"a{i % 40} b{i % 7} a{i % 40} c{i % 11}") for i in range(300)]
    df = spark.createDataFrame([*rare, *[(1000 + i, "the the the the " * 20) for i in range(60)]], "doc_id long, text string")
    held = F.col("doc_id") % 5 == 0
    one = {r.doc_id: r for r in pitman_yor.score(df, held).collect()}
    seen = []
    real = pitman_yor.materialise
    monkeypatch.setattr(pitman_yor, "materialise", lambda d, name: seen.append((name, real(d, name))) or seen[-1][1])
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 300)
    many = pitman_yor.score(df, held).collect()
    for part in (range(300), range(1000, 1060)):  # all draws together: a text's own score is noisy
        a, b = (sum(x[k].score for k in part) for x in (one, {r.doc_id: r for r in many}))
        assert abs(a - b) < 0.01 * abs(a)
    states = [d for name, d in seen if name == "lm-seats"]
    assert len(states) == 1 + pitman_yor.BURN_IN + pitman_yor.SAMPLES and states[0].count() > 20
    # the totals are the sum over the buckets: as many parent's customers as tables in all contexts
    for d in states:
        per = [np.frombuffer(bytes(r.totals), np.int64) for r in d.collect()]
        total = sum(p[:pitman_yor.CONTEXTS + 2] for p in per)
        assert total[:pitman_yor.CONTEXTS].sum() == total[pitman_yor.CONTEXTS] >= total[pitman_yor.CONTEXTS + 1] > 0


def test_each_word_has_its_own_restaurant(spark):
    """Words with one ending: what follows the one says nothing about what follows the other."""
    rows = [(i, ("north", "south")[i % 2] + "western " + ("rain", "snow")[i % 2]) for i in range(200)]
    asked = [(1000, "northwestern rain"), (1001, "northwestern snow"), (1002, "southwestern rain"), (1003, "southwestern snow")]
    df = spark.createDataFrame([*rows, *asked], "doc_id long, text string")
    s = {r.doc_id: r.score for r in pitman_yor.score(df, F.col("doc_id") >= 1000).collect()}
    assert s[1000] > s[1001] + 1 and s[1003] > s[1002] + 1  # ten times likelier


def test_restaurants_hold_their_tables_of_all_buckets(spark, monkeypatch):
    """Scores against the model seated in one piece, with a number for each word; and the tables that homes
    add up for a restaurant are its customers less what the dishes of all buckets take off them."""
    texts = [" ".join(f"w{(i * k * k + k) % 13}" for k in range(12)) for i in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 500)
    monkeypatch.setattr(pitman_yor, "BATCH_BYTES", 900)
    got = {r.doc_id: r for r in pitman_yor.score(df, F.col("doc_id") % 4 == 0).collect()}
    words = ["", *sorted({w for t in texts for w in t.split()})]
    number = {w: k for k, w in enumerate(words)}
    assert len(words) <= pitman_yor.CONTEXTS
    pairs = {i: [(number[w], number[u]) for w, u in zip([*t.split(), ""], ["", *t.split()])] for i, t in enumerate(texts)}
    seen = Counter(p for i, ps in pairs.items() if i % 4 for p in ps)
    keys = sorted(seen)
    word, context = (np.array([k[j] for k in keys]) for j in (0, 1))
    mean, kept, totals = pitman_yor._seat(word, context, np.array([seen[k] for k in keys]), len(words), 1, 5)
    n, means = pitman_yor.CONTEXTS, dict(zip(keys, mean.tolist()))
    per = totals[n:-1].reshape(pitman_yor.SAMPLES, -1)
    (d1, d0), (s1, s0) = pitman_yor.DISCOUNTS, pitman_yor.STRENGTHS

    def logp(w, u):
        p = means.get((w, u), 0.0)
        for g in range(pitman_yor.SAMPLES):
            parent = (kept[g][w] + (s0 + d0 * per[g, n + 1]) / (1 + totals[-1])) / (s0 + per[g, n])
            p += (s1 + d1 * per[g, u]) * parent / pitman_yor.SAMPLES
        return math.log10(p / (s1 + totals[u]))

    plain = {i: sum(logp(*p) for p in ps) for i, ps in pairs.items()}
    assert abs(sum(plain.values()) - sum(r.score for r in got.values())) < 0.01 * abs(sum(plain.values()))
    for i, r in got.items():
        assert abs(plain[i] - r.score) < 0.05 * abs(plain[i])


def test_whole_numbers_and_steps_come_back():
    arrays = [np.array([0, 1, 255, 256, 1 << 40]), np.zeros(0, np.int64), np.array([7])]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, pitman_yor.unpack_ints(pitman_yor.pack_ints(*arrays), 3)))
    high = np.array([3, (1 << 64) - 1], np.uint64)
    assert (pitman_yor.unpack_ints(pitman_yor.pack_ints(high), 1)[0].view(np.uint64) == high).all()
    chain = [np.array([5, 9, 1]), np.array([4, 9, 3]), np.array([6, 0, 0])]
    assert all((a == b).all() for a, b in zip(chain, pitman_yor.from_steps(pitman_yor.steps(chain))))


def test_tables_follow_their_conditional():
    """Two customers share a table with the odds of the restaurant process."""
    rng = np.random.default_rng(1)
    n, d, p, mass = 40_000, 0.5, 0.2, 3.0
    t = pitman_yor.sample_tables(np.full(n, 2), np.full(n, p), np.full(n, mass), d, rng)
    one, two = 1 - d, (mass + d) * p
    assert abs((t == 2).mean() - two / (one + two)) < 0.01
    big = pitman_yor.sample_tables(np.full(50, 100_000), np.full(50, p), np.full(50, mass), d, rng)
    assert (big > 1).all() and (big < 100_000).all()


def test_language_model_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "A b"), (3, "a B"), (3, "a B"), (4, "w " * 50_000)],
                               "doc_id long, text string").withColumn("held_out", F.lit("clash"))
    got = pitman_yor.score(df, F.lit(False)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 3, 3, 3, 50_001]
    nothing = pitman_yor.score(df, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.score) < 1e-9 for r in nothing)
    assert pitman_yor.score(spark.createDataFrame([], df.schema), F.lit(False)).count() == 0
