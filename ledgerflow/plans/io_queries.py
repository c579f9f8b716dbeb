"""Driver queries for the CSV readers, the all-bank statement job and the
operators that no other query reaches.

The CSV queries render driver tables as CSV folders below the shared checkpoint
folder (layouts mixed, bad dates, offsets, a layout that does not fit) and
read them back; the oracles state the expected rows from the tables.
"""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import TAX_YEAR
from ..functions import mail as M
from ..functions.text import clean_description, strip_html
from ..operators.features import char_noise
from ..operators.labels import category_counts, collapse_rare, index_labels, label_vocab
from ..operators.messages import csv_rows
from ..schema import MONEY
from ..session import checkpoint_dir, written
from ..sources.files import load_known_contacts, load_transfer_index, read_records_csv, read_statement_csv
from . import sqlgen as S
from .inputs import read_table
from .message_queries import _records, render_messages, sql_mail_records
from .ml_queries import _sql_collapsed, _trainable
from .model_sql import noise
from .pipeline import extract_statements
from .statement_queries import ordered_orders, render_ck_tangerine, render_loc_mc, render_td

CSV_OPTIONS = {"header": "true", "emptyValue": "", "escape": '"'}


def _folder(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"


def _write(df, path):
    df.write.options(**CSV_OPTIONS).csv(path)


def _layout(file):
    """The folder that a file lies in."""
    return F.regexp_extract(file, r"([^/]+)/[^/]+$", 1)


# ---------------------------------------------------------------- S3 / S4 / F9
def render_statement_csv(spark, sf) -> str:
    o = read_table(spark, sf, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    day = F.when(urgent, F.lit("no date")).otherwise(F.date_format("o_orderdate", "MMM dd"))
    card = F.when(F.col("o_orderstatus") == "F", F.lit("credit")).otherwise(F.lit("Debit"))
    desc = F.concat(F.lit("#"), F.col("o_orderkey").cast("string"), F.lit(" "), F.col("o_orderpriority"))
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    rows = o.select("o_orderstatus", day.alias("TRANS DATE"), F.date_format(F.date_add("o_orderdate", 1), "MMM dd").alias("POSTING DATE"),
                    desc.alias("DESCRIPTION"), price.alias("AMOUNT"), card.alias("CARD TYPE"))
    folder = _folder(spark)
    five = ["TRANS DATE", "POSTING DATE", "DESCRIPTION", "AMOUNT", "CARD TYPE"]
    _write(rows.where("o_orderstatus = 'F'").select(five), f"{folder}/five")
    four = rows.where("o_orderstatus = 'O'").select(F.col("CARD TYPE").alias("card type"), "AMOUNT", F.col("DESCRIPTION").alias("Description"),
                                                    F.col("TRANS DATE").alias(" TRANS DATE "))
    _write(four, f"{folder}/four")
    _write(rows.where("o_orderstatus = 'P'").select("DESCRIPTION", "TRANS DATE", F.lit("x").alias("REMARK"), "CARD TYPE", "AMOUNT"),
           f"{folder}/other")
    _write(rows.select("TRANS DATE", "DESCRIPTION", "CARD TYPE"), f"{folder}/unfit")  # no amount: every file is rejected
    return folder


def q_statement_csv(spark, sf):
    scan = read_statement_csv(spark, f"{render_statement_csv(spark, sf)}/*/*.csv", source_of=_layout)
    return scan.rows.select("source", "description", F.date_format("date", "yyyy-MM-dd").alias("date"), "year", "month",
                            F.date_format("posting_date", "yyyy-MM-dd").alias("posting_date"),
                            F.col("amount").cast("double").alias("amount"), F.col("debit").cast("double").alias("debit"),
                            F.col("credit").cast("double").alias("credit"))


def _sql_day(e):
    return (f"TRY_CAST('{TAX_YEAR}-' || lpad(CAST(month({e}) AS VARCHAR), 2, '0') || '-' || "
            f"lpad(CAST(day({e}) AS VARCHAR), 2, '0') AS DATE)")


def sql_statement_csv():
    d = f"CASE WHEN o_orderpriority <> '1-URGENT' THEN {_sql_day('o_orderdate')} END"
    return ("SELECT CASE o_orderstatus WHEN 'F' THEN 'five' WHEN 'O' THEN 'four' ELSE 'other' END AS source, "
            f"'#' || o_orderkey || ' ' || o_orderpriority AS description, strftime({d}, '%Y-%m-%d') AS date, "
            f"CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month, "
            f"CASE WHEN o_orderstatus = 'F' THEN strftime({_sql_day('(o_orderdate + INTERVAL 1 DAY)')}, '%Y-%m-%d') END AS posting_date, "
            "CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS amount, "
            "CASE WHEN o_orderstatus <> 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) END AS debit, "
            "CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) END AS credit FROM orders")


# ---------------------------------------------------------------- S5
def render_mail_csv(spark, sf) -> str:
    e = read_table(spark, sf, "events")
    ref = F.concat(F.lit("R"), F.col("event_id").cast("string"))
    value = F.col("value").cast(MONEY).cast("string")
    moves = e.where(F.col("event_type").isin("purchase", "click")).select(
        F.lit("transfer").alias("TYPE"), F.date_format("ts", "yyyy-MM-dd").alias("DATE"),
        F.when(F.col("event_type") == "purchase", F.lit("sent")).otherwise(F.lit("Received")).alias("DIRECTION"),
        value.alias("AMOUNT"), F.lit("TD").alias("BANK"), F.concat(F.lit("User, "), F.col("user_id").cast("string")).alias("CONTACT"),
        ref.alias("REFERENCE"), F.concat(F.lit("two\nlines "), F.col("props")).alias("MEMO"))
    bills = e.where(~F.col("event_type").isin("purchase", "click")).select(
        ref.alias("Reference"), F.lit("Acme").alias("VENDOR"), F.lit("not asked for").alias("EXTRA"), value.alias("TOTAL"),
        F.when(F.col("event_type") == "error", F.lit("not a date")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("DATE"),
        F.lit("invoice").alias("TYPE"))
    folder = _folder(spark)
    _write(moves, f"{folder}/moves")
    _write(bills, f"{folder}/bills")
    return folder


def q_mail_csv(spark, sf):
    scan = read_records_csv(spark, f"{render_mail_csv(spark, sf)}/*/*.csv")
    return scan.rows.select(_layout(F.col("file")).alias("layout"), "source", F.date_format("date", "yyyy-MM-dd").alias("date"),
                            "description", *[F.col(c).cast("double").alias(c) for c in ("amount", "debit", "credit")],
                            "transaction", "memo")


def sql_mail_csv():
    v = "CAST(CAST(value AS DECIMAL(14,2)) AS DOUBLE)"
    return (f"SELECT 'moves' AS layout, 'TD_Visa' AS source, strftime(ts, '%Y-%m-%d') AS date, 'User, ' || user_id || ' | R' || event_id "
            f"AS description, {v} AS amount, CASE WHEN event_type = 'purchase' THEN {v} END AS debit, "
            f"CASE WHEN event_type = 'click' THEN {v} END AS credit, 'transfer' AS transaction, 'two' || chr(10) || 'lines ' || props AS memo "
            "FROM events WHERE event_type IN ('purchase', 'click') UNION ALL "
            "SELECT 'bills', 'CIBC', CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END, 'Acme | R' || event_id, "
            f"nullif({v}, 0), nullif({v}, 0), NULL, 'invoice', NULL FROM events WHERE event_type NOT IN ('purchase', 'click')")


# ---------------------------------------------------------------- S6
def render_transfer_csv(spark, sf) -> str:
    e = read_table(spark, sf, "events")
    who = F.concat(F.lit("E"), F.col("event_id").cast("string"))
    folder = _folder(spark)
    _write(e.where("event_type = 'purchase'").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"), F.lit("SENT ").alias("direction"),
        F.concat(F.lit("-"), F.col("value").cast(MONEY).cast("string")).alias("amount"), who.alias("contact")), f"{folder}/plain")
    _write(e.where("event_type = 'signup'").select(
        who.alias("Interactor"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-04:00")).alias("Date"),
        F.lit("receiving").alias("transfer_type"), F.col("value").cast(MONEY).cast("string").alias("AMOUNT")), f"{folder}/zoned")
    _write(e.where("event_type = 'click'").select(  # amounts out of range, then a layout that does not fit
        F.lit("never").alias("date"), F.lit("sent").alias("direction"), F.lit("1e20").alias("amount"), who.alias("contact")),
        f"{folder}/large")
    _write(e.where("event_type = 'view'").select(F.lit("sent").alias("direction"), who.alias("contact")), f"{folder}/unfit")
    return folder


def q_transfer_index_csv(spark, sf):
    scan = load_transfer_index(spark, f"{render_transfer_csv(spark, sf)}/*/*.csv")
    return scan.rows.select("contact", "direction", F.col("amount").cast("double").alias("amount"),
                            F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"))


def sql_transfer_index_csv():
    return ("SELECT 'E' || event_id AS contact, CASE WHEN event_type = 'purchase' THEN 'sent' ELSE 'received' END AS direction, "
            "CAST(abs(CAST(value AS DECIMAL(14,2))) AS DOUBLE) AS amount, strftime(CASE WHEN event_type = 'purchase' THEN ts "
            "ELSE ts + INTERVAL 4 HOUR END, '%Y-%m-%d %H:%M:%S.%f') AS date FROM events WHERE event_type IN ('purchase', 'signup')")


# ---------------------------------------------------------------- S8
def q_known_contacts_csv(spark, sf):
    c = read_table(spark, sf, "customer").select(F.col("c_name").alias("contact"), F.when(
        F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Personal")).otherwise(F.lit("business")).alias("lean"))
    path = f"{_folder(spark)}/known"
    _write(c, path)
    return load_known_contacts(spark, f"{path}/*.csv").groupBy("contact", "lean").agg(F.count(F.lit(1)).alias("n"))


def sql_known_contacts_csv():
    return ("SELECT c_name AS contact, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Personal' ELSE 'business' END AS lean, "
            "count(*) AS n FROM customer GROUP BY 1, 2")


# ---------------------------------------------------------------- S1 / S2 / T20
def all_statement_lines(spark, sf):
    """Five layouts in one table, a copy of the chequing files whose opening balance
    does not parse, and a copy of the line-of-credit files with a blank last page."""
    named = lambda df, prefix: df.withColumn("file", F.concat(F.lit(prefix), F.col("file")))
    o = written(ordered_orders(spark, sf), "orders")
    ck, loc = (written(df, "rendered") for df in (render_ck_tangerine(spark, sf, "CK", o), render_loc_mc(spark, sf, "LOC", o)))
    bad = ck.withColumn("line", F.when(F.col("line").startswith("Opening Balance"), F.lit("Opening Balance n/a"))
                        .otherwise(F.col("line")))
    parts = [named(loc, "BMO_LOC_"), named(render_loc_mc(spark, sf, "MC", o), "BMO_MC_"), named(ck, "BMO_CK_"),
             named(render_ck_tangerine(spark, sf, "Tangerine", o), "Tangerine_"), named(render_td(spark, sf, o), "TD_Visa_"),
             named(bad, "BMO_CK_bad_"), named(loc, "BMO_LOC_blank_").withColumn("last_page", F.lit(99))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def q_all_statements(spark, sf):
    rows = extract_statements(written(all_statement_lines(spark, sf), "lines"), source_from_file=True)
    return rows.select("file", "source", "description", F.date_format("date", "yyyy-MM-dd").alias("date"), "year", "month",
                       *[F.col(c).cast("double").alias(c) for c in ("amount", "debit", "credit")])


def sql_all_statements():
    d = _sql_day("o_orderdate")
    v = "CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE)"

    def one(prefix, source, credit, scope=""):
        return (f"SELECT '{prefix}cust_' || o_custkey AS file, '{source}' AS source, '#' || o_orderkey || ' ' || o_orderpriority "
                f"AS description, strftime({d}, '%Y-%m-%d') AS date, CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) "
                f"AS month, {v} AS amount, CASE WHEN NOT ({credit}) THEN {v} END AS debit, CASE WHEN {credit} THEN {v} END AS credit "
                f"FROM orders o {scope}")

    last = ("WHERE year(o_orderdate) = (SELECT max(year(p.o_orderdate)) FROM orders p WHERE p.o_custkey = o.o_custkey)")
    f = "o_orderstatus = 'F'"
    return " UNION ALL ".join([one("BMO_LOC_", "BMO_LOC", f, last), one("BMO_MC_", "BMO_MC", f), one("BMO_CK_", "BMO_CK", f),
                               one("Tangerine_", "Tangerine", f), one("TD_Visa_", "TD_Visa", "true")])


# ---------------------------------------------------------------- M3
def q_char_noise(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", clean_description(F.col("text")).alias("t"))
    return d.select("doc_id", F.md5(char_noise(F.col("t"), F.col("doc_id")).cast("binary")).alias("noisy_md5"),
                    F.length(char_noise(F.col("t"), F.col("doc_id"))).alias("n"))


def sql_char_noise():
    return (f"SELECT doc_id, md5(x) AS noisy_md5, CAST(length(x) AS INTEGER) AS n FROM (SELECT doc_id, "
            f"{noise('t', 'doc_id')} AS x FROM (SELECT doc_id, {S.clean_desc('text')} AS t FROM documents))")


# ---------------------------------------------------------------- E2 / E6 / E28 / L5 / L8
def q_page_text(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", strip_html(F.coalesce(F.col("html"), F.lit(""))).alias("text"))


def sql_page_text():
    e = "regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g')"
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"'), ("&apos;", "'")):
        e = f"replace({e}, {S.q(a)}, {S.q(b)})"
    e = f"regexp_replace({e}, '[ \\t]+', ' ', 'g')"
    e = f"regexp_replace({e}, '\\n\\s*\\n+', chr(10) || chr(10), 'g')"
    return f"SELECT page_id, {S.strip_ws(e)} AS text FROM pages"


def q_sender_match(spark, sf):
    m = render_messages(spark, sf)
    addr = M.from_address(F.col("from_header"))
    return m.select("msg_id", M.sender_matches(addr, M.TRANSFER_SENDERS).alias("transfer_sender"),
                    M.sender_matches(addr, ("orders@shop1?.*", "*[a-c]e.com")).alias("shop_sender"))


def sql_sender_match():
    addr = ("CASE event_type WHEN 'purchase' THEN 'notify@payments.interac.ca' WHEN 'signup' THEN 'alerts@bmo.com' "
            "WHEN 'click' THEN 'receipts@stripe.com' WHEN 'view' THEN 'orders@shop' || user_id || '.example.com' "
            "ELSE CASE WHEN value < 100 THEN 'notify@payments.interac.ca' ELSE 'billing@waveapps.com' END END")
    globs = " OR ".join(f"a GLOB '{p}'" for p in M.TRANSFER_SENDERS)
    return (f"SELECT msg_id, ({globs}) AS transfer_sender, (a GLOB 'orders@shop1?.*' OR a GLOB '*[a-c]e.com') AS shop_sender "
            f"FROM (SELECT event_id AS msg_id, {addr} AS a FROM events)")


def q_record_rows(spark, sf):
    return csv_rows(_records(spark, sf))


def sql_record_rows():
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c.upper()}" for c in (
        "type", "date", "direction", "bank", "contact", "account", "reference", "memo", "vendor", "invoice_no", "currency",
        "source", "link", "subject"))
    money = ", ".join(f"coalesce(printf('%.2f', {c}), '') AS {c.upper()}" for c in ("amount", "subtotal", "gst_hst", "qst_pst", "total"))
    return f"SELECT {text}, {money} FROM ({sql_mail_records()})"


def q_category_counts(spark, sf):
    return category_counts(_trainable(spark, sf))


def sql_category_counts():
    return f"{_sql_collapsed()} SELECT category, count(*) AS n FROM r WHERE category IS NOT NULL GROUP BY 1"


def q_label_index(spark, sf):
    """Expense rows with the number of their label among the labels of all categories."""
    c = collapse_rare(_trainable(spark, sf))
    known = label_vocab(c.where(F.col("category") == "EXPENSES"), "sub_category1")
    return index_labels(c, "sub_category1", known).select("p_partkey", "sub_category1", "idx")


def sql_label_index():
    return (f"{_sql_collapsed()}, v AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx FROM "
            "(SELECT DISTINCT sub_category1 AS label FROM r WHERE category = 'EXPENSES' AND sub_category1 IS NOT NULL)) "
            "SELECT p_partkey, sub_category1, idx FROM r JOIN v ON r.sub_category1 = v.label")


QUERIES = {
    "statement_csv": (q_statement_csv, sql_statement_csv),
    "mail_csv": (q_mail_csv, sql_mail_csv),
    "transfer_index_csv": (q_transfer_index_csv, sql_transfer_index_csv),
    "known_contacts_csv": (q_known_contacts_csv, sql_known_contacts_csv),
    "all_statements": (q_all_statements, sql_all_statements),
    "char_noise": (q_char_noise, sql_char_noise),
    "page_text": (q_page_text, sql_page_text),
    "sender_match": (q_sender_match, sql_sender_match),
    "record_rows": (q_record_rows, sql_record_rows),
    "category_counts": (q_category_counts, sql_category_counts),
    "label_index": (q_label_index, sql_label_index),
}
