"""Driver queries for the rule layer, ingest dedupe and transfer match.

Inputs are the driver tables: ``documents`` stand in for ledger
descriptions, ``events`` for bank transfer lines and transfer notices,
``customer`` for counterparties. Each query has a Spark plan built from the
library operators and an independent DuckDB oracle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SOURCE_VOCAB
from ..functions.text import clean_description, norm
from ..operators.ingest import dedupe_keep_first, limit_per_file
from ..operators.rules import apply_rules
from ..operators.xref import match_transfers
from ..schema import MONEY, conform, row_position
from .inputs import read_table
from . import sqlgen as S

DOC_BANKS = SOURCE_VOCAB + ("Other",)
FILE_LIMIT = 10


def doc_bank(src) -> F.Column:
    n = F.regexp_extract(src, r"(\d+)$", 1).try_cast("int")
    arr = F.array(*[F.lit(b) for b in DOC_BANKS])
    return F.get(arr, n % F.lit(len(DOC_BANKS)))


def lang_category(lang) -> F.Column:
    out = None
    for k, v in S.LANG_CATEGORY:
        out = F.when(lang == k, F.lit(v)) if out is None else out.when(lang == k, F.lit(v))
    return out


def documents_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as ledger rows: bank source, cleaned description, model category."""
    d = read_table(spark, sf, "documents")
    led = d.select(F.col("doc_id").alias("row_id"), doc_bank(F.col("source")).alias("source"),
                   clean_description(F.col("text")).alias("description"),
                   lang_category(F.col("lang")).alias("category"),
                   F.col("source").alias("file"), F.col("doc_id").alias("row_no"))
    return conform(led, keep=["row_id", "file", "row_no"])


# ---------------------------------------------------------------- decision_chain
def q_decision_chain(spark, sf):
    r = apply_rules(documents_ledger(spark, sf))
    return r.select(F.col("row_id").alias("doc_id"), "source", "category", "sub_category2",
                    F.col("decision_source"), F.col("account_lean"))


_DOCS_CTE = (f"d AS (SELECT doc_id, {S.doc_bank('source')} AS source, "
             f"lower({S.clean_desc('text')}) AS dn, {S.lang_category('lang')} AS category FROM documents)")


def sql_decision_chain():
    c = S.chain("source", "dn", "category")
    return (f"WITH {_DOCS_CTE} SELECT doc_id, source, {c['category']} AS category, "
            f"{S.vendor('dn')} AS sub_category2, {c['decision']} AS decision_source, "
            f"{c['lean']} AS account_lean FROM d")


def q_decision_counts(spark, sf):
    return q_decision_chain(spark, sf).groupBy("decision_source").agg(F.count(F.lit(1)).alias("n"))


def sql_decision_counts():
    return f"SELECT decision_source, count(*) AS n FROM ({sql_decision_chain()}) GROUP BY 1"


def q_vendor_tag(spark, sf):
    return (q_decision_chain(spark, sf).groupBy("sub_category2")
            .agg(F.count(F.lit(1)).alias("n")))


def sql_vendor_tag():
    return f"WITH {_DOCS_CTE} SELECT {S.vendor('dn')} AS sub_category2, count(*) AS n FROM d GROUP BY 1"


# ---------------------------------------------------------------- clean_description
def q_clean_description(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", clean_description(F.col("text")).alias("description"))


def sql_clean_description():
    return f"SELECT doc_id, {S.clean_desc('text')} AS description FROM documents"


# ---------------------------------------------------------------- dedupe_first
def q_dedupe_first(spark, sf):
    led = documents_ledger(spark, sf)
    kept = dedupe_keep_first(led, order_cols=("row_no",))
    return kept.select(F.col("row_id").alias("doc_id"), "source",
                       F.substring("description", 1, 80).alias("desc_key"))


def sql_dedupe_first():
    return ("SELECT doc_id, source, desc_key FROM ("
            f"SELECT doc_id, {S.doc_bank('source')} AS source, left({S.clean_desc('text')}, 80) AS desc_key, "
            f"row_number() OVER (PARTITION BY {S.doc_bank('source')}, left({S.clean_desc('text')}, 80) "
            "ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")


# ---------------------------------------------------------------- file_limit
def q_file_limit(spark, sf):
    led = documents_ledger(spark, sf)
    return limit_per_file(led, FILE_LIMIT, "file", ("row_no",)).select(
        F.col("row_id").alias("doc_id"), F.col("file").alias("file"))


def sql_file_limit():
    return (f"SELECT doc_id, file FROM (SELECT doc_id, source AS file, row_number() OVER "
            f"(PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= {FILE_LIMIT}")


# ---------------------------------------------------------------- transfer match
def events_index(spark, sf, with_customer: bool = False) -> DataFrame:
    """Purchases are sent transfers, signups received ones; the event id is
    the index order."""
    e = read_table(spark, sf, "events").where(F.col("event_type").isin("purchase", "signup"))
    idx = e.select(F.col("event_id").alias("ordinal"), F.col("ts").alias("date"),
                   F.when(F.col("event_type") == "purchase", F.lit("sent")).otherwise(F.lit("received"))
                   .alias("direction"),
                   F.col("value").cast(MONEY).alias("amount"), F.col("user_id"))
    if not with_customer:
        return idx.withColumn("contact", F.concat(F.lit("User "), F.col("user_id").cast("string")))
    c = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), customer_contact().alias("contact"))
    return idx.join(c, "user_id", "left")


def customer_contact() -> F.Column:
    seg = F.col("c_mktsegment")
    suffix = F.when(seg == "AUTOMOBILE", F.lit(" Inc")).when(seg == "MACHINERY", F.lit(" Ltd.")) \
        .otherwise(F.lit(""))
    return F.concat(F.col("c_name"), suffix)


def events_bank(spark, sf) -> DataFrame:
    """Clicks are debits, views credits, errors undated debits."""
    e = read_table(spark, sf, "events").where(F.col("event_type").isin("click", "view", "error"))
    return e.select(F.col("event_id").alias("row_id"),
                    F.when(F.col("event_type") != "error", F.col("ts")).alias("date"),
                    F.when(F.col("event_type") == "view", F.lit("received")).otherwise(F.lit("sent"))
                    .alias("direction"),
                    F.abs(F.col("value").cast(MONEY)).alias("amount"), "event_type", "user_id", "props")


def q_transfer_match(spark, sf):
    m = match_transfers(events_bank(spark, sf), events_index(spark, sf))
    return m.select(F.col("row_id").alias("event_id"), "xref_contact", "xref_ordinal")


_IDX_SQL = ("idx AS (SELECT event_id AS ordinal, ts AS date, CASE WHEN event_type = 'purchase' THEN 'sent' "
            "ELSE 'received' END AS direction, CAST(value AS DECIMAL(14,2)) AS amount, {contact} AS contact "
            "FROM events e {join} WHERE event_type IN ('purchase', 'signup'))")
_BANK_SQL = ("bank AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS date, "
             "CASE WHEN event_type = 'view' THEN 'received' ELSE 'sent' END AS direction, "
             "abs(CAST(value AS DECIMAL(14,2))) AS amount, event_type, user_id, props FROM events "
             "WHERE event_type IN ('click', 'view', 'error'))")
_MATCH_SQL = (
    "dated AS (SELECT b.event_id, i.contact, i.ordinal, row_number() OVER (PARTITION BY b.event_id "
    "ORDER BY abs(epoch_us(i.date) - epoch_us(b.date)), i.ordinal) AS rn FROM bank b JOIN idx i "
    "ON b.direction = i.direction AND b.amount = i.amount WHERE b.date IS NOT NULL AND i.date IS NOT NULL "
    "AND abs(epoch_us(i.date) - epoch_us(b.date)) < 8 * 86400000000), "
    "undated AS (SELECT b.event_id, min(i.contact) AS contact, min(i.ordinal) AS ordinal FROM bank b "
    "JOIN idx i ON b.direction = i.direction AND b.amount = i.amount WHERE b.date IS NULL "
    "GROUP BY b.event_id HAVING count(*) = 1), "
    "m AS (SELECT event_id, contact, ordinal FROM dated WHERE rn = 1 UNION ALL "
    "SELECT event_id, contact, ordinal FROM undated)")


def sql_transfer_match():
    idx = _IDX_SQL.format(contact="'User ' || CAST(user_id AS VARCHAR)", join="")
    return (f"WITH {idx}, {_BANK_SQL}, {_MATCH_SQL} "
            "SELECT event_id, contact AS xref_contact, ordinal AS xref_ordinal FROM m")


# ---------------------------------------------------------------- transfer rules
BANK_SOURCE = (("click", "CIBC"), ("view", "Tangerine"), ("error", "BMO_CK"))
BANK_CATEGORY = (("click", "PERSONAL"), ("view", "EXPENSES"), ("error", "REVENUE"))


def _case(col, table):
    out = None
    for k, v in table:
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out


def known_from_customers(spark, sf) -> DataFrame:
    c = read_table(spark, sf, "customer").where(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"))
    return c.select(F.col("c_custkey").alias("ordinal"), F.col("c_name").alias("contact"),
                    F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("personal"))
                    .otherwise(F.lit("business")).alias("lean"))


def events_ledger(spark, sf, with_provenance: bool = True) -> DataFrame:
    """Bank-side transfer lines from events as ledger rows (clicks debits,
    views credits, errors undated debits)."""
    b = events_bank(spark, sf)
    et = F.col("event_type")
    led = b.select("row_id", "date", F.col("date").alias("transaction_date"),
                   _case(et, BANK_SOURCE).alias("source"),
                   F.concat(F.lit("INTERAC e-Transfer "), et).alias("description"),
                   F.when(F.col("direction") == "sent", F.col("amount")).alias("debit"),
                   F.when(F.col("direction") == "received", F.col("amount")).alias("credit"),
                   F.col("amount"), _case(et, BANK_CATEGORY).alias("category"),
                   F.when(et == "view", F.col("props")).alias("note"),
                   F.year("date").alias("year"), F.month("date").alias("month"),
                   F.lit("bank_events").alias("file"), row_position(F.lit(0), "row_id").alias("row_no"))
    if with_provenance:
        return conform(led.drop("row_id"), keep=["file", "row_no"])
    return conform(led, keep=["row_id"])


def q_transfer_rules(spark, sf):
    led = events_ledger(spark, sf, with_provenance=False)
    r = apply_rules(led, events_index(spark, sf, with_customer=True), known_from_customers(spark, sf))
    return r.select(F.col("row_id").alias("event_id"), "category", "decision_source", "account_lean",
                    "unresolved", "note")


def sql_transfer_rules():
    contact = ("c.c_name || CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN ' Inc' WHEN 'MACHINERY' "
               "THEN ' Ltd.' ELSE '' END")
    idx = _IDX_SQL.format(contact=contact, join="LEFT JOIN customer c ON e.user_id = c.c_custkey")
    src = "CASE b.event_type " + " ".join(f"WHEN {S.q(k)} THEN {S.q(v)}" for k, v in BANK_SOURCE) + " END"
    cat = "CASE b.event_type " + " ".join(f"WHEN {S.q(k)} THEN {S.q(v)}" for k, v in BANK_CATEGORY) + " END"
    known = (f"known AS (SELECT {S.norm_name('c_name')} AS name, min(c_custkey) AS ordinal, "
             "arg_max(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'personal' ELSE 'business' END, c_custkey) "
             "AS lean FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') "
             f"AND {S.norm_name('c_name')} <> '' GROUP BY 1)")
    mk = f"mk AS (SELECT event_id, contact, {S.norm_name('contact')} AS nk FROM m)"
    kl = ("kl AS (SELECT mk.event_id, arg_min(k.lean, k.ordinal) AS klean FROM mk JOIN known k "
          "ON contains(mk.nk, k.name) GROUP BY mk.event_id)")
    lean = (f"lean AS (SELECT mk.event_id, mk.contact, CASE WHEN mk.nk = '' THEN NULL ELSE "
            f"coalesce(kl.klean, CASE WHEN {S.suffix_business('mk.nk')} THEN 'business' END) END AS xlean "
            "FROM mk LEFT JOIN kl ON mk.event_id = kl.event_id)")
    rows = (f"r AS (SELECT b.event_id, {src} AS source, lower('INTERAC e-Transfer ' || b.event_type) AS dn, "
            f"{cat} AS category, CASE WHEN b.event_type = 'view' THEN b.props END AS note, b.direction, "
            "l.contact, l.xlean, l.event_id IS NOT NULL AS matched, "
            "CASE WHEN l.xlean = 'business' THEN CASE WHEN b.direction = 'sent' THEN 'EXPENSES' "
            "ELSE 'REVENUE' END WHEN l.xlean = 'personal' THEN 'PERSONAL' END AS xcat "
            "FROM bank b LEFT JOIN lean l ON b.event_id = l.event_id)")
    it = f"(NOT starts_with(coalesce(source, ''), 'TD') AND {S.transfer_terms('dn')})"
    c = S.chain("source", "dn", "category",
                {"is_transfer": it, "matched": "matched", "xcat": "xcat", "xlean": "xlean"})
    # contact carried by the decision: only the two transfer outcomes with a match
    carried = (f"CASE WHEN NOT starts_with(coalesce(source, ''), 'TD') AND {S.transfer_terms('dn')} "
               "AND matched THEN contact END")
    note = (f"CASE WHEN {carried} IS NOT NULL AND {carried} <> '' THEN CASE WHEN "
            f"{S.strip_ws('coalesce(note, ' + chr(39) * 2 + ')')} = '' THEN 'xref: ' || {carried} "
            f"ELSE note || ' | xref: ' || {carried} END ELSE note END")
    return (f"WITH {idx}, {_BANK_SQL}, {_MATCH_SQL}, {known}, {mk}, {kl}, {lean}, {rows} "
            f"SELECT event_id, {c['category']} AS category, {c['decision']} AS decision_source, "
            f"{c['lean']} AS account_lean, {c['unresolved']} AS unresolved, {note} AS note FROM r")


QUERIES = {
    "decision_chain": (q_decision_chain, sql_decision_chain),
    "decision_counts": (q_decision_counts, sql_decision_counts),
    "vendor_tag": (q_vendor_tag, sql_vendor_tag),
    "clean_description": (q_clean_description, sql_clean_description),
    "dedupe_first": (q_dedupe_first, sql_dedupe_first),
    "file_limit": (q_file_limit, sql_file_limit),
    "transfer_match": (q_transfer_match, sql_transfer_match),
    "transfer_rules": (q_transfer_rules, sql_transfer_rules),
}
