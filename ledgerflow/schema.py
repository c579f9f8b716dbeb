"""Ledger, record and index schemas plus the conform step."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import LEDGER_COLUMNS, RECORD_COLUMNS

MONEY = T.DecimalType(14, 2)

_LEDGER_TYPES = {
    "source": T.StringType(), "year": T.IntegerType(), "month": T.IntegerType(),
    "date": T.TimestampNTZType(), "transaction_date": T.TimestampNTZType(),
    "posting_date": T.TimestampNTZType(), "category": T.StringType(),
    "sub_category1": T.StringType(), "sub_category2": T.StringType(),
    "description": T.StringType(), "amount": MONEY, "debit": MONEY, "credit": MONEY,
    "balance": MONEY, "note": T.StringType(), "qst": MONEY, "gst": MONEY,
    "transaction": T.StringType(), "memo": T.StringType(),
}

LEDGER_SCHEMA = T.StructType([T.StructField(c, _LEDGER_TYPES[c], True) for c in LEDGER_COLUMNS])

# Provenance columns that stand in for the implicit row order of files.
PROVENANCE = ("file", "file_rank", "row_no")


def row_position(block, idx):
    """``row_no`` convention: struct<block: long, id: long> (position of the
    split or page, then the row inside it); orders like file order."""
    from pyspark.sql import functions as F
    b = F.col(block) if isinstance(block, str) else block
    i = F.col(idx) if isinstance(idx, str) else idx
    return F.struct(b.cast("long").alias("block"), i.cast("long").alias("id"))

_RECORD_TYPES = {c: T.StringType() for c in RECORD_COLUMNS}
_RECORD_TYPES.update({"date": T.DateType(), "amount": MONEY, "subtotal": MONEY,
                      "gst_hst": MONEY, "qst_pst": MONEY, "total": MONEY})
RECORD_SCHEMA = T.StructType([T.StructField(c, _RECORD_TYPES[c], True) for c in RECORD_COLUMNS])

TRANSFER_INDEX_SCHEMA = T.StructType([
    T.StructField("ordinal", T.LongType(), False),
    T.StructField("date", T.TimestampNTZType(), True),
    T.StructField("direction", T.StringType(), True),
    T.StructField("amount", MONEY, True),
    T.StructField("contact", T.StringType(), True),
])

KNOWN_CONTACTS_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("contact", T.StringType(), True),
    T.StructField("lean", T.StringType(), True),
])

WORDS_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("page", T.IntegerType()),
    T.StructField("seq", T.IntegerType()), T.StructField("text", T.StringType()),
    T.StructField("x0", T.DoubleType()), T.StructField("top", T.DoubleType()),
])

LINES_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("bank", T.StringType()),
    T.StructField("page", T.IntegerType()), T.StructField("line_no", T.IntegerType()),
    T.StructField("line", T.StringType()),
])

PART_SCHEMA = T.StructType([
    T.StructField("content_type", T.StringType()), T.StructField("filename", T.StringType()),
    T.StructField("text", T.StringType()),
])
MESSAGES_SCHEMA = T.StructType([
    T.StructField("msg_id", T.LongType()), T.StructField("from_header", T.StringType()),
    T.StructField("subject", T.StringType()), T.StructField("received_ts", T.TimestampNTZType()),
    T.StructField("parts", T.ArrayType(PART_SCHEMA)),
])


def conform(df: DataFrame, columns=LEDGER_COLUMNS, types=None, keep=()) -> DataFrame:
    """Add missing ledger columns as typed nulls, cast the others (what does not
    parse is null) and fix the column order.

    ``keep`` names extra columns (provenance, predictions) carried after the
    ledger columns.
    """
    types = types or _LEDGER_TYPES
    have = set(df.columns)
    cols: list[Column] = []
    for c in columns:
        if c in have:
            cols.append(F.col(c).try_cast(types[c]).alias(c))
        else:
            cols.append(F.lit(None).cast(types[c]).alias(c))
    cols += [F.col(k) for k in keep if k in have]
    return df.select(*cols)

