"""The bound of the language stage comes from all held-in texts, not from those the samples were cut from."""
import hashlib
import random
import zlib

from ledgerflow.llm import langid

DOCS = "doc_id long, text string, lang string, source string"


def test_the_bound_covers_texts_that_were_not_sampled(spark):
    rng = random.Random(4)
    held_in = [k for k in range(600) if zlib.crc32(str(k).encode()) % 3 != 1]
    held_in.sort(key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    stock = ["tana", "sol", "mire", "dun", "ta", "lors"]
    letters = "abcdefghijklmnopqrstuvwxyz"

    def plain():
        return " ".join(rng.choice(stock) for _ in range(120))

    def rich():
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(80))

    rows = [(k, plain() + " " + letters if n < langid.SAMPLE_DOCS else rich(), "xx", "s") for n, k in enumerate(held_in)]
    rows += [(1000 + k, rich(), None, "s") for k in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = {r.doc_id for r in langid.known_language(docs).collect()}
    assert kept == {r[0] for r in rows}


def test_a_few_wrong_labels_do_not_lift_the_bound(spark):
    rng = random.Random(5)
    stock = ["tana", "sol", "mire", "dun", "ta", "lors"]
    rows = [(k, " ".join(rng.choice(stock) for _ in range(120)), "xx", "s") for k in range(900)]
    odd = "ΑΒΓΔ " * 100
    wrong = [k for k in range(900, 1000) if zlib.crc32(str(k).encode()) % 3 != 1][:3]
    docs = spark.createDataFrame(rows + [(k, odd, "xx", "s") for k in wrong], DOCS)
    kept = {r.doc_id for r in langid.known_language(docs).collect()}
    assert kept == set(range(900))
