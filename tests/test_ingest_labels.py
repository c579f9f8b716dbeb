"""Ingest (dates, sources, records, dedupe, limit), labels, split, metrics."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.functions.dates import short_date, text_date
from ledgerflow.functions.text import clean_description, strip_html
from ledgerflow.operators.evaluate import class_report, confusion_matrix, summary
from ledgerflow.operators.features import char_noise, class_weights, stratified_split
from ledgerflow.operators.ingest import dedupe_keep_first, limit_per_file, records_to_ledger, source_from_filename
from ledgerflow.operators.labels import collapse_rare, filter_for_training, normalize_labels


def test_short_dates(spark):
    vals = ["Mar. 29", "Apr 03", "17mar", "mars 29", "12fév", "3aoû", "30 feb", "19 JUIL", "bad"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(short_date(F.col("s"), 2026)).collect()]
    assert got == [dt.datetime(2026, 3, 29), dt.datetime(2026, 4, 3), dt.datetime(2026, 3, 17),
                   dt.datetime(2026, 3, 29), dt.datetime(2026, 2, 12), dt.datetime(2026, 8, 3), None,
                   dt.datetime(2026, 7, 19), None]


def test_text_dates(spark):
    df = spark.createDataFrame([("Sent Sept. 3, 2025 and 2025-01-02",), ("on 2025-02-30 or 03/14/2025",),
                                ("Feb 30, 2025 then 2025-01-05",), ("nothing",)], "t string")
    got = [r[0] for r in df.select(text_date(F.col("t"), F.lit(dt.date(2000, 1, 1)))).collect()]
    assert got == [dt.date(2025, 9, 3), dt.date(2025, 3, 14), dt.date(2025, 1, 5), dt.date(2000, 1, 1)]


def test_clean_and_html(spark):
    df = spark.createDataFrame([("[POS] Coffee  shop 1234567890123 \n",),
                                ("<p>A&amp;B&nbsp;&lt;x&gt;</p>\n\n\n<b>z</b>",)], "t string")
    r = df.select(clean_description(F.col("t")).alias("c"), strip_html(F.col("t")).alias("h")).collect()
    assert r[0].c == "Coffee shop"
    assert r[1].h == "A&B <x> \n\n z"


def test_source_from_filename(spark):
    df = spark.createDataFrame([("/x/BMO_MC_2025.csv",), ("TD_x.csv",), ("other.csv",), ("Tangerine.csv",)],
                               "f string")
    assert [r[0] for r in df.select(source_from_filename(F.col("f"))).collect()] == [
        "BMO_MC", "TD_Visa", "other", "Tangerine"]


def test_records_to_ledger(spark):
    rows = [("transfer", dt.date(2026, 4, 1), "received", Decimal("10.00"), "TD", "Jo", None, "REF123456",
             None, None, None, None, "m1"),
            ("invoice", dt.date(2026, 4, 2), None, Decimal("0.00"), "", None, "Acme", None, Decimal("0.00"),
             Decimal("1.00"), "Your receipt", None, None),
            ("order", None, None, None, None, None, "Shop", None, Decimal("12.50"), None, None, Decimal("0.50"),
             None)]
    schema = ("type string, date date, direction string, amount decimal(14,2), bank string, contact string, "
              "vendor string, reference string, total decimal(14,2), gst_hst decimal(14,2), subject string, "
              "qst_pst decimal(14,2), memo string")
    out = records_to_ledger(spark.createDataFrame(rows, schema)).collect()
    assert (out[0].source, out[0].credit, out[0].debit, out[0].description) == ("TD_Visa", Decimal("10.00"), None,
                                                                               "Jo | REF123456")
    assert (out[1].source, out[1].debit, out[1].description, out[1].gst) == ("CIBC", Decimal("0.00"),
                                                                           "Acme | Your receipt", Decimal("1.00"))
    assert (out[2].amount, out[2].debit, out[2].year, out[2].transaction) == (Decimal("12.50"), Decimal("12.50"),
                                                                             None, "order")


def test_dedupe_and_limit(spark):
    rows = [("S", None, Decimal("1.00"), "x" * 85, "b.csv", 0), ("S", None, Decimal("1.00"), "x" * 80 + "y", "a.csv", 5),
            ("S", None, Decimal("2.00"), "z", "a.csv", 6)]
    df = spark.createDataFrame(rows, "source string, date timestamp_ntz, amount decimal(14,2), description string, "
                                     "file string, row_no long").withColumn("file_rank", F.col("file"))
    kept = sorted((r.file, r.row_no) for r in dedupe_keep_first(df).collect())
    assert kept == [("a.csv", 5), ("a.csv", 6)]
    lim = sorted(r.row_no for r in limit_per_file(df, 1).collect())
    assert lim == [0, 5]


def test_labels(spark):
    rows = [("CIBC", " expenses ", "trainning ", "[x] a"), ("Total", "REVENUE", None, "b"),
            ("TD_Visa", "0", "Car", "c"), ("CIBC", "TRANSFER", None, "d"), ("CIBC", "Personal", "", "  ")]
    df = spark.createDataFrame(rows, "source string, category string, sub_category1 string, description string")
    n = normalize_labels(df).collect()
    assert [(r.category, r.sub_category1, r.description) for r in n] == [
        ("EXPENSES", "Training", "a"), ("REVENUE", None, "b"), (None, "Car", "c"), ("TRANSFER", None, "d"),
        ("PERSONAL", None, "")]
    kept = filter_for_training(normalize_labels(df)).collect()
    assert [r.description for r in kept] == ["a"]


def test_collapse_rare(spark):
    rows = [(i, "EXPENSES", "Big") for i in range(6)] + [(10, "EXPENSES", "Tiny"), (11, "PERSONAL", "Tiny"),
                                                         (12, "EXPENSES", None)]
    df = spark.createDataFrame(rows, "id int, category string, sub_category1 string")
    got = {r.id: r.sub_category1 for r in collapse_rare(df).collect()}
    assert got[0] == "Big" and got[10] == "Other" and got[11] == "Tiny" and got[12] is None


def test_split_and_weights(spark):
    rows = [(i, "a" if i % 3 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y string")
    s = stratified_split(df, "y", "id", bucket_rows=40)
    c = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert (c[("a", "train")], c[("a", "val")], c[("a", "test")]) == (160, 20, 20)
    assert (c[("b", "train")], c[("b", "val")], c[("b", "test")]) == (80, 10, 10)
    again = stratified_split(df, "y", "id", bucket_rows=5)
    assert sorted(s.select("id", "split").collect()) == sorted(again.select("id", "split").collect())
    w = {r.y: r.weight for r in class_weights(s.where("split = 'train'"), "y").collect()}
    assert abs(w["a"] - (240 / (2 * 160)) ** 0.5) < 1e-12 and abs(w["b"] - (240 / (2 * 80)) ** 0.5) < 1e-12


def test_metrics(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    df = spark.createDataFrame(pairs, "t string, p string")
    s = summary(df, "t", "p").first()
    # per class: a p=3/4 r=3/4 f=.75; b p=2/3 r=1 f=.8; c p=0 r=0 f=0
    assert abs(s.accuracy - 5 / 7) < 1e-12
    assert abs(s.macro_f1 - (0.75 + 0.8 + 0) / 3) < 1e-12
    rep = {r.label: r for r in class_report(df, "t", "p").collect()}
    assert rep["c"].support == 1 and rep["weighted avg"].support == 7
    cm = {r.label: (r.a, r.b, r.c) for r in confusion_matrix(df, "t", "p").collect()}
    assert cm == {"a": (3, 1, 0), "b": (0, 2, 0), "c": (1, 0, 0)}


def test_char_noise_deterministic(spark):
    df = spark.createDataFrame([(1, "interac e-transfer received" * 3), (2, None)], "k long, t string")
    a = df.select(char_noise(F.col("t"), F.col("k"), rate=0.3).alias("n")).collect()
    b = df.select(char_noise(F.col("t"), F.col("k"), rate=0.3).alias("n")).collect()
    assert a == b and a[0].n != "interac e-transfer received" * 3 and a[1].n is None


def test_char_noise_is_the_rule(spark):
    """Swap with the character put out before, delete or keep, drawn per position."""
    from ledgerflow.operators.features import HASH_MOD, HASH_MUL, NOISE_MUL
    rate, seed = 0.4, 42
    texts = ["interac e-transfer", "a", "", "naïve 𝄞 clef\nline", "x" * 300, "abcdefghijklmnopqrstuvwxyz" * 4]

    def plain(text, key):
        out, h = [], (key % HASH_MOD * HASH_MUL + seed * 97) % HASH_MOD
        for i, c in enumerate(text):
            u = (h + (i + 1) * NOISE_MUL * NOISE_MUL) % HASH_MOD * NOISE_MUL % HASH_MOD
            drawn = u % 3 if u < int(rate * HASH_MOD) else 2
            if drawn == 0 and out:
                out.insert(len(out) - 1, c)
            elif drawn != 1:
                out.append(c)
        return "".join(out)

    rows = [(k, t) for k, t in enumerate(texts * 5, start=2 ** 33)]
    df = spark.createDataFrame(rows, "k long, t string")
    got = {r.k: r.n for r in df.select("k", char_noise(F.col("t"), F.col("k"), rate, seed).alias("n")).collect()}
    assert got == {k: plain(t, k) for k, t in rows}


def test_split_of_large_and_negative_keys(spark):
    """Keys beyond 2^33, as monotonically_increasing_id makes them, do not overflow."""
    rows = [(k * 2 ** 33 + j, "a") for k in range(-3, 7) for j in range(20)]
    s = stratified_split(spark.createDataFrame(rows, "id long, y string"), "y", "id")
    assert {r.split: r["count"] for r in s.groupBy("split").count().collect()} == {"train": 160, "val": 20, "test": 20}
