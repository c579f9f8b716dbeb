"""PII, language ID, toxicity and decontamination against plain versions."""
import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import decontam, langid, pii, queries, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# the contract's patterns, run by the regex engine as they stand
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind in pii.BASE_KINDS:
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub(r"[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                  "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.+- ()0123456789é%_", max_size=60))
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", ["a@b.c@d.e@f.g", "1.2.3.4.5.6.7.8", "+1 (017) 555-7713)", "4111 1111 1111 1111",
                                  "4111-1111-1111-1111 4111111111111111", "999.1.1.1 0001.2.3.4", "x@y..z a@b.c-", ""])
def test_base_spans_cases(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_are_linear():
    for piece in ("a", "1", "1.", "@", "a@", "+1 "):
        pii.base_spans(piece * 200_000)


def test_em_finds_the_reliable_labelers():
    rng = np.random.default_rng(1)
    from collections import Counter
    pats = Counter()
    for _ in range(4000):
        y = rng.random() < 0.4
        pats["".join("+-"[int((rng.random() < e) == y)] for e in (0.05, 0.1, 0.5))] += 1
    post, share, rely = pii.em(pats)
    assert abs(share - 0.4) < 0.1
    assert abs(rely[1][0][1] - rely[0][0][1]) > abs(rely[1][2][1] - rely[0][2][1])
    assert post["++-"] > 0.8 > 0.2 > post["--+"]


def test_op1_whole_table(spark):
    got = {r.doc_id: r for r in queries.op1_pii(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        g, base = got[r.doc_id], plain_spans(r.text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert g.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        assert g.spans.startswith(joined)


def test_pii_edges(spark):
    token = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a@b.co", "x"), (4, token, "x"), (4, token, "x"),
                                (5, "x" * 100_000 + " 1.2.3.4", None)], "doc_id long, text string, score string")
    w = pii.learn(df)
    got = sorted((str(r.doc_id), r.spans) for r in pii.find(df, w).collect())
    assert ("1", "") in got and ("2", "") in got and ("None", "email:0:6") in got and ("5", "ip:100001:100008") in got
    assert sum(1 for k, s in got if k == "4" and s.startswith("secret:9:49")) == 2
    masked = {r.doc_id: r.text for r in pii.masked(df, w).collect()}
    assert masked[4] == 'token = "[SECRET]"' and masked[1] is None and masked[5].endswith(" [IP]")
    none = spark.createDataFrame([], df.schema)
    assert pii.learn(none) == {} and pii.find(none, {}).count() == 0 and pii.masked(none, {}).count() == 0


# ------------------------------------------------------------------ language ID
def plain_phrases(text: bytes, sample: bytes) -> int:
    n = 0
    for lo in range(0, len(text), langid.BLOCK):
        block, i = text[lo:lo + langid.BLOCK], 0
        while i < len(block):
            k = 1
            while i + k <= len(block) and block[i:i + k] in sample:
                k += 1
            i += max(1, k - 1)
            n += 1
    return n


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abcé ", max_size=40).map(str.encode), min_size=1, max_size=6),
       st.text(alphabet="abé ", min_size=1, max_size=60).map(str.encode),
       st.text(alphabet="bc ", min_size=1, max_size=60).map(str.encode))
def test_phrases_are_longest_matches(texts, one, two):
    got = langid.Parser({"a": one, "b": two}).phrases(texts)
    assert got.tolist() == [[plain_phrases(t, one), plain_phrases(t, two)] for t in texts]


def test_blocks(monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 7)
    texts = [b"abcabcab" * 5, b"", b"c" * 7, b"ab"]
    assert langid.Parser({"x": b"abcab"}).phrases(texts)[:, 0].tolist() == [plain_phrases(t, b"abcab") for t in texts]


def test_op2_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op2_langid(spark, SF).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.95


def test_langid_edges(spark):
    df = spark.createDataFrame([(1, "the cat", "en", "s", 7), (2, "el gato", "es", "s", 7), (3, None, "en", "s", 0),
                                (4, "", None, None, 0), (5, "123 ...", "en", "s", 7), (None, "the the", None, "s", 7),
                                (6, "gato " * 20_000, None, "s", 1), (1, "the cat", "en", "s", 7)], DOCS)
    found = langid.predict(df, {"en": b"the cat and the dog", "es": b"el gato y el perro"}).collect()
    by = {(r.doc_id, r.text): r.lang_pred for r in found}
    assert [by[k] for k in ((3, None), (4, ""), (5, "123 ..."))] == ["und"] * 3
    assert by[1, "the cat"] == "en" == by[None, "the the"] and by[6, "gato " * 20_000] == "es"
    assert {r.lang_pred for r in langid.predict(df, {}).collect()} == {"und"}
    clash = df.withColumn("score", F.lit("mine")).withColumn("c0", F.lit(1))
    kept = langid.known_language(clash)
    assert kept.columns == clash.columns and {r.score for r in kept.collect()} == {"mine"}
    none = spark.createDataFrame([], df.schema)
    assert langid.known_language(none).count() == 0


# ------------------------------------------------------------------ toxicity
def test_nnpu_separates():
    rng = np.random.default_rng(3)
    n, k = 600, 30
    y_true = rng.random(n) < 0.3
    x = rng.random((n, k)) < 0.1
    x[:, 0] |= y_true & (rng.random(n) < 0.9)
    y = (y_true & (rng.random(n) < 0.5)).astype(int)
    rows, cols = np.nonzero(x)
    w, b = toxicity.nnpu(rows, cols, y, k, 0.3)
    z = b + x @ w
    assert z[y_true].mean() > z[~y_true].mean() + 1 and w[0] == w.max()


def test_op10(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10_toxicity(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    pos, neg = ([s for y, s in held if y == k] for k in (1, 0))
    assert np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]) > 0.75


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "a b"), (3, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (None, 1), (99, 1), (3, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {0.0}
    some = spark.createDataFrame([(i, "foul word" if i % 2 else "fine day") for i in range(60)] + [(None, None)],
                                 "doc_id long, text string")
    marked = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(some, marked)
    got = {r.doc_id: r.score for r in toxicity.score(some, model).collect()}
    assert got[51] > got[50]
    assert toxicity.score(spark.createDataFrame([], docs.schema), model).count() == 0


# ------------------------------------------------------------------ decontamination
def plain_search(index, terms):
    out = []
    for k in range(len(index.ids)):
        s = sum(x for t in terms for j, x in index.postings.get(t, ()) if j == k)
        if s >= index.threshold - 1e-9:
            out.append((k, round(s, 9)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefghijklmnop"), min_size=1, max_size=9), min_size=1, max_size=40),
       st.lists(st.sampled_from("abcdefghijklmnopqr"), max_size=12), st.sampled_from([0.2, 0.4, 0.6, 0.9]))
def test_wand_finds_all_above_threshold(items, query, threshold):
    index = decontam.Index([(k, " ".join(w)) for k, w in enumerate(items)], threshold)
    got = [(k, round(s, 9)) for k, s in index.search(set(query))]
    assert got == plain_search(index, set(query))
    if plain_search(index, set(query)):
        assert index.candidates(query)


def test_op4_finds_what_a_scan_finds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = set()
    for d in docs:
        ws = decontam.words(d.text)
        for i in items:
            q, a = (decontam.words(x) for x in decontam.split_item(i.text))
            if decontam.overlap(q, ws) >= 1 and decontam.overlap(a, ws) >= 1:
                want.add((d.doc_id, i.item_id))
    got = {(r.doc_id, r.item_id) for r in queries.op4_decontamination(spark, SF).collect()}
    assert want <= got and want
    kept = {r.doc_id for r in decontam.clean(spark.createDataFrame(docs), spark.createDataFrame(items)).collect()}
    assert kept == {d.doc_id for d in docs} - {d for d, _ in got}


def test_decontam_edges(spark, monkeypatch):
    text = "what is the capital of france today? it is the city of paris now."
    docs = spark.createDataFrame([(1, None), (2, ""), (None, text), (3, "so " * 30_000 + text + " ok" * 500), (3, text),
                                  (4, "it is the city")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text), (8, None), (9, ""), (7, text), (10, "short one")], "item_id long, text string")
    got = decontam.find_leaks(docs, items).collect()
    assert sorted({str(r.doc_id) for r in got}) == ["3", "None"]
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 2)
    again = decontam.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in again} == {(r.doc_id, r.item_id) for r in got}
    assert decontam.clean(docs, items).count() == 3
    none = spark.createDataFrame([], items.schema)
    assert decontam.find_leaks(docs, none).count() == 0 and decontam.clean(docs, none).count() == 6
