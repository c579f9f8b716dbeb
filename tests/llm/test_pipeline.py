"""The pipeline's stages against plain versions, and their edge cases."""
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerflow.llm import decontam, mixing, pii
from tests.llm.test_structure_ops import plain_components, plain_simhash

SF = "/root/testdata/sf0.001"


def plain_run(docs, items):
    docs = [d for d in docs if d["text"] and any(c.isalpha() for c in d["text"])]
    docs.sort(key=lambda d: d["doc_id"])
    part = plain_components([plain_simhash(d["text"]) for d in docs])
    docs = [d for k, d in enumerate(docs) if part[k] == k]
    split = [tuple(decontam.words(x) for x in decontam.split_item(t)) for t in items]

    def leaks(text):
        ws = decontam.words(text)
        grams = {n: {tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)} for n in range(1, 6)}
        return any(all(len(s & grams[min(5, len(p))]) >= 0.8 * len(s) for p in qa for s in [decontam.shingles(p)]) for qa in split)

    docs = [d for d in docs if not leaks(d["text"])]
    return docs


def test_run_against_plain(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = plain_run(rows, items)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    weights = pii.learn(spark.createDataFrame(kept, "doc_id long, text string, lang string, source string, n_chars long"))
    texts = {d["doc_id"]: pii.mask(d["text"], pii.spans(d["text"], weights)) for d in kept}
    size = {i: len(t.encode().split()) for i, t in texts.items()}
    source = {d["doc_id"]: d["source"] for d in kept}
    names = sorted(set(source.values()), key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    target = dict(zip(names, mixing.targets([total[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))],
                                            sum(total.values()))))
    want = {}
    for s in names:
        at, quota = 0, int(target[s] + 1e-6)
        for i in sorted((i for i in size if source[i] == s), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i)):
            want[i] = sum(max(0, min(at + e * total[s] + size[i], quota) - at - e * total[s]) for e in range(3))
            at += size[i]
    assert {i: r.taken for i, r in got.items()} == {i: n for i, n in want.items() if n}
    for i, r in got.items():
        assert r.text == texts[i] and r.n_chars == len(texts[i]) and r.source == source[i]


EDGES = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, "one two three four", None, "a", 18),
         (3, "one two three four", None, "a", 18), (None, "mail me at a@b.co now", "en", "b", 21), (5, "12 34", "en", "a", 5),
         (6, "eins zwei drei vier " * 6000, "de", None, 120_000), (7, "one two three four", "en", "b", 18)]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, name, stage):
    df = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string, n_chars long")
    extra = df.withColumn("_keep", F.lit("k")).withColumn("score", F.lit(1)).withColumn("taken", F.lit("t"))
    got = stage(spark, extra, SF)
    rows = got.collect()
    if name != "mix_sources":
        assert got.columns == extra.columns
    n = {"language_id": 5, "near_dedup": 5, "decontamination": 8, "private_data": 8}
    assert len(rows) == n[name] if name in n else {r.source for r in rows} <= {"a", "b", None}
    if name == "private_data":
        assert "mail me at [EMAIL] now" in {r.text for r in rows}
    assert stage(spark, extra.limit(0), SF).count() == 0
