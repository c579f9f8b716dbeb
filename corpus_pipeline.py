"""The corpus pipeline: stages over ``documents``, each written and read again.

1. language ID: documents without any recognisable language (null, no letter) go
2. SimHash near-dedup: one document of each group stays, that with the smallest id
3. benchmark decontamination: documents that hold a test item go
4. PII: every span found is masked in the text (``n_chars`` is counted anew)
5. mixing: the documents that the mix takes words of, with their share in it

All but the last return the columns of ``documents``. Each stage handles nulls, empty
texts, repeated rows and empty tables as its operator's docstring says; other
columns pass through, but for those that a stage itself adds (its value stands).
"""
from __future__ import annotations

from ledgerflow.llm import decontam, langid, mixing, pii, simhash
from ledgerflow.llm.common import materialise, table


def language_id(spark, docs, sf_dir):
    return langid.known_language(docs)


def near_dedup(spark, docs, sf_dir):
    return simhash.one_of_each(docs)


def decontamination(spark, docs, sf_dir):
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark, docs, sf_dir):
    return pii.masked(docs, pii.learn(docs))


def mix_sources(spark, docs, sf_dir):
    return mixing.mixed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("mix_sources", mix_sources),
]
ORACLE_SQL = None  # cross parsing, SimHash and the span classifier are beyond SQL; tests hold run() against brute force


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
