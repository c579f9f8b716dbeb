"""CSV readers: columns by header, per-file isolation, UTC dates."""
import datetime as dt
import os
import tempfile
from decimal import Decimal

from ledgerflow.operators.ingest import dedupe_keep_first
from ledgerflow.plans.pipeline import ingest
from ledgerflow.sources.files import (load_known_contacts, load_transfer_index, read_records_csv, read_statement_csv,
                                      write_records)


def folder(**files):
    root = tempfile.mkdtemp(prefix="lf-csv-")
    for name, text in files.items():
        path = os.path.join(root, name.replace("__", "/") + ".csv")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write(text)
    return root


def test_statements_by_header(spark):
    root = folder(
        mybank="TRANS DATE,DESCRIPTION,AMOUNT,CARD TYPE\nApr 04,coffee,12.50,Debit\n",
        Tangerine_x="TRANS DATE,POSTING DATE,DESCRIPTION,AMOUNT,CARD TYPE\nApr 04,Apr 05,\"rent, flat\",\"9.00\",credit\n",
        TD_odd="﻿card type,AMOUNT,trans date,DESCRIPTION,NOTE\ndebit,not a number,99 99,x,y\n",
        broken="DATE,WHAT\n1,2\n", empty="")
    scan = read_statement_csv(spark, root + "/*.csv")
    got = {r.description: r for r in scan.rows.collect()}
    assert (got["coffee"].source, got["coffee"].debit, got["coffee"].posting_date) == ("mybank", Decimal("12.50"), None)
    assert got["coffee"].date.month == 4 and got["coffee"].date.day == 4
    rent = got["rent, flat"]
    assert (rent.source, rent.credit, rent.posting_date.day) == ("Tangerine", Decimal("9.00"), 5)
    assert got["x"].amount is None and got["x"].date is None and len(got) == 3
    bad = {os.path.basename(r.file): r.reason for r in scan.rejected.collect()}
    assert bad == {"broken.csv": "no column trans_date, description, amount, card_type", "empty.csv": "empty or unreadable"}


def test_records_by_header(spark):
    root = folder(
        email_records_a="TYPE,DATE,DIRECTION,AMOUNT,BANK,CONTACT,REFERENCE\ntransfer,2026-04-01,received,10.00,TD,Jo,REF1\n"
                        "transfer,not a date,sent,abc,BMO,Al,REF2\n",
        email_records_b="TOTAL,VENDOR,DATE,TYPE,MEMO\n20.00,Acme,2026-04-02,invoice,\"two\nlines \"\"quoted\"\"\"\n",
        email_records_c="TYPE,AMOUNT\ntransfer,1\n")
    scan = read_records_csv(spark, root + "/*.csv")
    got = {r.description: r for r in scan.rows.collect()}
    assert (got["Jo | REF1"].credit, got["Jo | REF1"].source) == (Decimal("10.00"), "TD_Visa")
    assert got["Al | REF2"].date is None and got["Al | REF2"].amount is None
    acme = got['Acme | two\nlines "quoted"']
    assert (acme.debit, acme.memo, acme.date) == (Decimal("20.00"), 'two\nlines "quoted"', dt.datetime(2026, 4, 2))
    assert [r.reason for r in scan.rejected.collect()] == ["no column date"]


def test_files_of_one_name_stay_apart(spark):
    """Provenance is the full path: keep-first takes the first folder's row."""
    line = "TRANS DATE,DESCRIPTION,AMOUNT,CARD TYPE\nApr 04,coffee,12.50,{}\n"
    root = folder(a__x=line.format("debit"), b__x=line.format("credit"))
    rows = read_statement_csv(spark, root + "/*/*.csv").rows
    assert rows.select("file").distinct().count() == 2
    kept = ingest(rows, None).collect()
    assert len(kept) == 1 and kept[0].debit == Decimal("12.50")


def test_csv_rows_flow_into_ingest(spark):
    root = folder(BMO_CK_1="TRANS DATE,DESCRIPTION,AMOUNT,CARD TYPE\nApr 04,coffee,12.50,debit\n",
                  mail="DATE,TYPE,TOTAL,VENDOR\n2026-04-02,invoice,3.00,Acme\n")
    st = read_statement_csv(spark, root + "/BMO*.csv").rows
    rec = read_records_csv(spark, root + "/mail.csv").rows
    out = ingest(st, rec)
    assert sorted(r.description for r in out.collect()) == ["Acme", "coffee"]
    assert dedupe_keep_first(out.withColumnRenamed("file_rank", "file_rank")).count() == 2


def test_transfer_index(spark):
    root = folder(
        a="date,direction,amount,contact\n2026-04-04T10:00:00-04:00,Sending,-5.005,X\n2026-04-04,sent,1e20,Y\n",
        b="Interactor,AMOUNT,Transfer_Type,DATE\nZ,7,receiving,2026-04-04T10:00:00Z\nW,7,sent,2026-04-04 10:00:00\nV,7,sent,soon\n",
        c="date,amount\n2026-01-01,1\n")
    scan = load_transfer_index(spark, root + "/*.csv")
    got = {r.contact: (r.date, r.direction, r.amount) for r in scan.rows.collect()}
    ten = dt.datetime(2026, 4, 4, 10)
    assert got["X"][:2] == (dt.datetime(2026, 4, 4, 14), "sent") and "Y" not in got
    assert got["Z"] == (ten, "received", Decimal("7.00")) and got["W"][0] == ten and got["V"][0] is None
    order = [r.contact for r in scan.rows.orderBy("ordinal").collect()]
    assert order[0] == "X" and order[1:] == ["Z", "W", "V"]
    assert [r.reason for r in scan.rejected.collect()] == ["no column direction, contact"]


def test_known_contacts(spark):
    root = folder(known="# remark\ncontact,lean\nAcme Ltd,business\n# Joe,personal\nJo,personal\n")
    got = [(r.contact, r.lean) for r in load_known_contacts(spark, root + "/known.csv").orderBy("ordinal").collect()]
    assert got == [("Acme Ltd", "business"), ("Jo", "personal")]
    assert load_known_contacts(spark, root + "/none.csv").count() == 0


def test_write_records(spark):
    root = tempfile.mkdtemp(prefix="lf-out-")
    path = write_records(spark.createDataFrame([("a", 1)], "TYPE string, n int"), root, dt.date(2026, 1, 1), dt.date(2026, 2, 1))
    assert path.endswith("email_records_2026-01-01_2026-02-01") and spark.read.csv(path, header=True).count() == 1


def test_damaged_files_have_no_rows(spark):
    """A compressed file that ends early is rejected as a whole; whole ones stay, several streams in one too."""
    import bz2
    import gzip
    text = "TRANS DATE,DESCRIPTION,AMOUNT,CARD TYPE\n" + "".join(f"Apr 04,row {k},{k}.00,debit\n" for k in range(20_000))
    root = tempfile.mkdtemp(prefix="lf-csv-")
    whole, squeezed = gzip.compress(text.encode()), bz2.compress(text.encode())
    half = text.index("row 10000")
    half = text.index("\n", half) + 1
    streams = gzip.compress(text[:half].encode()) + gzip.compress(text[half:].encode())
    wrong = bytearray(whole)
    wrong[-6] ^= 1  # the checksum
    for name, data in {"whole.csv.gz": whole, "cut.csv.gz": whole[:len(whole) // 2], "tail.csv.gz": whole[:-3], "two.csv.gz": streams,
                       "wrong.csv.gz": bytes(wrong), "none.csv.gz": b"", "b.csv.bz2": squeezed, "bcut.csv.bz2": squeezed[:-20]}.items():
        with open(os.path.join(root, name), "wb") as fh:
            fh.write(data)
    scan = read_statement_csv(spark, root + "/*.csv.*", source_of=lambda f: f)
    counts = {os.path.basename(r.source): r["count"] for r in scan.rows.groupBy("source").count().collect()}
    assert counts == {"whole.csv.gz": 20_000, "two.csv.gz": 20_000, "b.csv.bz2": 20_000}
    bad = {os.path.basename(r.file): r.reason for r in scan.rejected.collect()}
    assert set(bad) == {"cut.csv.gz", "tail.csv.gz", "wrong.csv.gz", "none.csv.gz", "bcut.csv.bz2"}
    assert {n: r for n, r in bad.items() if r != "cut off or damaged"} == {"none.csv.gz": "empty or unreadable"}


def test_lines_that_were_not_read_reject_the_file(spark):
    """An uncompressed file is held against its length."""
    from pyspark.sql import functions as F

    from ledgerflow.sources import delimited
    root = folder(a="x,y\n1,2\n3,4", b="x,y\n1,2\n", c="\ufeffx\r\n1\r\n")
    files, lines = delimited.listing(spark, [root]), delimited.lines(spark, [root])
    assert delimited.unread(files, lines).collect() == []
    short = lines.where(~(F.col("file").endswith("a.csv") & (F.col("line") == "1,2")))
    assert [(os.path.basename(r.file), r.reason) for r in delimited.unread(files, short).collect()] == [("a.csv", "cut off: 8 of 11 bytes read")]


def test_any_number_of_columns(spark):
    extra = [f"extra {k}" for k in range(66)]
    root = folder(wide=",".join([*extra, "trans date", "description", "amount", "card type"]) + "\n"
                  + ",".join(["x"] * 66 + ["Apr 04", '"a, ""b"""', "1.50", "debit"]) + "\n",
                  wider=",".join([f"c{k}" for k in range(3000)] + ["TRANS DATE", "DESCRIPTION", "AMOUNT", "CARD TYPE", "posting date"]) + "\n"
                  + "," * 3000 + "Apr 04,far,2.50,credit,Apr 05\n")
    scan = read_statement_csv(spark, root + "/*.csv")
    got = {r.description: r for r in scan.rows.collect()}
    assert got['a, "b"'].debit == Decimal("1.50") and (got["far"].credit, got["far"].posting_date.day) == (Decimal("2.50"), 5)
    assert scan.rejected.collect() == []


def test_records_over_splits(spark):
    """Quoted cells with line ends, commas and quotes, cut into many small splits."""
    rows = [(k, f'cell "{k}"\nwith, a second line\n\n' * (k % 4)) for k in range(400)]
    body = "".join('{},"{}",x{}\n'.format(k, t.replace('"', '""'), k) for k, t in rows)
    root = folder(a="n,text,tail\n" + body, plain="n,text,tail\n7,seven,x7\n")
    from ledgerflow.sources.files import scan_csv
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "999")
    try:
        scan = scan_csv(spark, root + "/*.csv", {"n": ("n",), "text": ("text",), "tail": ("tail",)}, ("n",), multi_line=True)
        got = sorted((r.file.rsplit("/", 1)[-1], int(r.n), r.text or "", r.tail) for r in scan.rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == sorted([("a.csv", k, t, f"x{k}") for k, t in rows] + [("plain.csv", 7, "seven", "x7")])


def test_cells_before_the_first_quoted_one_are_cut_at_commas(spark):
    """The fast way gives what the pattern gives over the whole record, whatever its quotes; a header is cut once a file."""
    import itertools
    from pyspark.sql import functions as F
    from ledgerflow.sources import delimited
    texts = ["".join(x) for n in range(7) for x in itertools.product('a,"', repeat=n)]
    texts += [t.replace("a", "é\n\r") for t in texts if len(t) == 5]
    rows = spark.createDataFrame([(t,) for t in texts], "record string")
    plain = F.regexp_extract_all(F.concat(F.lit(","), "record"), F.lit(delimited._CELL), 1)
    assert rows.where(~delimited.cells(F.col("record")).eqNullSafe(plain)).collect() == []


def test_only_one_record_of_a_file_is_read_as_a_header(spark, tmp_path):
    from ledgerflow.sources.files import CONTACT_FIELDS, scan_csv
    (tmp_path / "a.csv").write_text("Contact,LEAN\n" + "".join(f"c{k},x\n" for k in range(50)))
    plan = scan_csv(spark, str(tmp_path / "*.csv"), CONTACT_FIELDS, ("contact",)).rejected._jdf.queryExecution().optimizedPlan().toString()
    # what makes names of cells stands above the aggregate that leaves one record a file
    assert plan.index("transform(") < plan.index("min(struct(row_no")
