"""Scans and sinks (S1-S16): statement and mail CSVs, transfer index, known
contacts, labelled ledgers, and writers.

CSV files name their columns themselves: every file of a scan may have its own
header, in its own order and of any width. One scan reads all files as arrays of cells
(``delimited``); the header record of each file (a row per file), joined back to the file's
rows, turns names into positions. Files that lack a required column, and files that were not
read to their end, go to a dead-letter table of file and reason as a whole; the others are not touched by it.

Readers keep provenance: ``file`` (the full path) and ``row_no`` (block start of the
split, then the row id inside it), so "first row" decisions follow file order even
when a file is split over many partitions.
"""
from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_ws
from ..operators.ingest import records_to_ledger, source_from_filename, statement_to_ledger
from ..schema import KNOWN_CONTACTS_SCHEMA, LEDGER_COLUMNS, MONEY, RECORD_COLUMNS
from ..session import cut_lineage
from . import delimited

# Header names of each field, first match wins; lower case.
STATEMENT_FIELDS = {"trans_date": ("trans date",), "posting_date": ("posting date",), "description": ("description",),
                    "amount": ("amount",), "card_type": ("card type",)}
STATEMENT_REQUIRED = ("trans_date", "description", "amount", "card_type")
RECORD_FIELDS = {c: (c,) for c in RECORD_COLUMNS}
RECORD_REQUIRED = ("date",)
TRANSFER_FIELDS = {"date": ("date",), "direction": ("direction", "transfer_type"), "amount": ("amount",),
                   "contact": ("contact", "interactor")}
CONTACT_FIELDS = {"contact": ("contact",), "lean": ("lean",)}


@dataclass
class CsvScan:
    """Rows of the files that fit, and (file, reason) of those that don't."""
    rows: DataFrame
    rejected: DataFrame


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scan_csv(spark: SparkSession, paths, fields: dict[str, tuple[str, ...]], required=(), comment: str | None = None,
             multi_line: bool = False, header_row: int | None = 1) -> CsvScan:
    """Rows (one string column per field, ``file``, ``row_no``) of CSV files that
    each have their own header of any width. ``multi_line`` lets quoted cells hold line
    ends. The header is the ``header_row``-th record, or (None) the first record that names every
    required field; what stands above it is left out."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files, scanned = delimited.listing(spark, paths), delimited.lines(spark, paths)
    records = delimited.records(scanned, multi_line, comment)
    read = records.select("file", "row_no", delimited.cells(F.col("record")).alias("cells"))
    clean = lambda c: F.lower(strip_ws(F.regexp_replace(F.coalesce(delimited.cell_value(c), F.lit("")), "^\ufeff", "")))

    def place(names):  # position of the first of the names that the record has
        at = [F.nullif(F.array_position("head", F.lit(n)), F.lit(0).cast("long")) for n in names]
        return F.coalesce(*at, F.lit(None).cast("long"))

    if header_row is None:
        named = read.select("file", "row_no", F.transform("cells", clean).alias("head"))
        fits = F.lit(True)
        for f in required:
            fits = fits & place(fields[f]).isNotNull()
        named = named.groupBy("file").agg(F.coalesce(F.min(F.when(fits, F.struct("row_no", "head"))), F.min(F.struct("row_no", "head"))).alias("h"))
    else:  # the record is found first; only the one of each file is cut into cells
        if header_row == 1:
            named = records.groupBy("file").agg(F.min(F.struct("row_no", "record")).alias("r"))
        else:
            order = Window.partitionBy("file").orderBy("row_no")
            named = records.withColumn("k", F.row_number().over(order)).where(F.col("k") == header_row).select(
                "file", F.struct("row_no", "record").alias("r"))
        named = named.select("file", F.struct(F.col("r.row_no").alias("row_no"), F.transform(
            delimited.cells(F.col("r.record")), clean).alias("head")).alias("h"))
    heads = named.select("file", F.col("h.row_no").alias("first"), F.col("h.head").alias("head"))
    heads = heads.select("file", "first", *[place(names).alias(f"_at_{f}") for f, names in fields.items()])
    lacks = F.filter(F.array(*[F.when(F.col(f"_at_{f}").isNull(), F.lit(f)) for f in required]).cast("array<string>"),
                     lambda c: c.isNotNull())
    heads = heads.withColumn("_lacks", lacks)
    broken = delimited.unread(files, scanned)
    fit = cut_lineage(heads.where(F.size("_lacks") == 0).join(broken, "file", "left_anti"))
    rows = (read.join(fit, "file").where(F.col("row_no") > F.col("first"))
            .select(*[F.when(F.col(f"_at_{f}").isNotNull(),
                             delimited.cell_value(F.try_element_at("cells", F.col(f"_at_{f}").cast("int")))).alias(f)
                      for f in fields], "file", "row_no"))
    lacking = heads.where(F.size("_lacks") > 0).select("file", F.concat(F.lit("no column "), F.array_join("_lacks", ", ")).alias("lacking"))
    # a scan says nothing of empty files: the names come from the listing, and an empty compressed file is cut off
    same = lambda c: F.regexp_replace(c, ":/+", ":/")  # noqa: E731  file:/x and file:///x are one path
    known = broken.unionByName(lacking.withColumnRenamed("lacking", "reason")).unionByName(
        fit.select("file", F.lit(None).cast("string").alias("reason"))).groupBy("file").agg(F.first("reason", True).alias("reason"), F.lit(True).alias("seen"))
    rejected = (spark.createDataFrame([(f,) for f in spark.read.text(paths).inputFiles()], "listed string")
                .join(known, same(F.col("listed")) == same(F.col("file")), "left")
                .where(F.col("seen").isNull() | F.col("reason").isNotNull())
                .select(F.col("listed").alias("file"), F.coalesce("reason", F.lit("empty or unreadable")).alias("reason")))
    return CsvScan(rows, rejected)


def read_statement_csv(spark: SparkSession, paths, cfg=None, source_of=source_from_filename) -> CsvScan:
    """Statement CSVs -> ledger rows + provenance, columns by header name;
    the posting date is null where a file has none."""
    from ..config import DEFAULT
    scan = scan_csv(spark, paths, STATEMENT_FIELDS, STATEMENT_REQUIRED)
    return CsvScan(statement_to_ledger(scan.rows, source_of(F.col("file")), cfg or DEFAULT), scan.rejected)


def read_records_csv(spark: SparkSession, paths) -> CsvScan:
    """Combined mail-record CSVs -> ledger rows; absent columns are null,
    dates and numbers that do not parse are null."""
    scan = scan_csv(spark, paths, RECORD_FIELDS, RECORD_REQUIRED, multi_line=True)
    return CsvScan(records_to_ledger(scan.rows), scan.rejected)


def utc_timestamp(c: Column) -> Column:
    """Text -> timestamp_ntz in UTC: a time with an offset is converted, one without
    is taken as it stands; null when it does not parse."""
    t = strip_ws(c)
    zoned = t.rlike(r"\d:\d{2}.*([Zz]|UTC|GMT|[+-]\d{2}:?\d{2})$")
    moved = F.convert_timezone(F.current_timezone(), F.lit("UTC"), t.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(zoned, moved).otherwise(t.try_cast("timestamp_ntz"))


def transfer_rows(df: DataFrame, ordinal: Column) -> DataFrame:
    """S6 for rows with date, direction, amount, contact as text."""
    d = F.lower(strip_ws(F.col("direction").cast("string")))
    d = F.when(d == "sending", F.lit("sent")).when(d == "receiving", F.lit("received")).otherwise(d)
    amount = F.abs(strip_ws(F.col("amount").cast("string")).try_cast(MONEY))
    date = F.col("date") if isinstance(df.schema["date"].dataType, (T.TimestampNTZType, T.DateType)) else \
        utc_timestamp(F.col("date").cast("string"))
    return (df.select(ordinal.alias("ordinal"), date.cast("timestamp_ntz").alias("date"), d.alias("direction"),
                      amount.alias("amount"), F.col("contact").cast("string").alias("contact"))
            .where(F.col("amount").isNotNull()))


def load_transfer_index(spark: SparkSession, paths) -> CsvScan:
    """Transfer index over all files in the order of their paths. ``ordinal`` is
    the sortable (file, row position) struct: no global numbering pass. Files
    without the four columns are rejected as a whole."""
    scan = scan_csv(spark, paths, TRANSFER_FIELDS, tuple(TRANSFER_FIELDS))
    return CsvScan(transfer_rows(scan.rows, F.struct("file", "row_no")), scan.rejected)


def load_known_contacts(spark: SparkSession, path: str) -> DataFrame:
    """CSV with ``#`` comment lines; missing or unfit file -> empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], KNOWN_CONTACTS_SCHEMA)
    rows = scan_csv(spark, path, CONTACT_FIELDS, tuple(CONTACT_FIELDS), comment="#").rows
    return rows.select(F.struct("file", "row_no").alias("ordinal"), "contact", "lean")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by=None) -> None:
    """Write beside the target and publish in one move, so a reader never meets a half-written
    table and a failed job leaves the old one. ``mode``: ``errorifexists`` refuses an existing target
    before anything is computed and again before publishing, ``overwrite`` replaces it as a whole."""
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r} is neither errorifexists nor overwrite")
    spark, path = df.sparkSession, path.rstrip("/")
    refuse = mode == "errorifexists"
    if refuse and path_exists(spark, path):
        raise FileExistsError(f"{path} exists; mode 'overwrite' replaces it")
    aside = f"{path.rsplit('/', 1)[0]}/_writing-{uuid.uuid4().hex}"  # same store; scans skip names that begin with _
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    if fmt == "csv":
        w.option("header", "true").option("escape", '"').option("emptyValue", "").csv(aside)
    elif fmt == "json":
        w.json(aside)
    else:
        w.parquet(aside)
    _publish(spark, aside, path, refuse)


def _publish(spark: SparkSession, aside: str, path: str, refuse: bool) -> None:
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = new(aside).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{aside}-old"
    try:
        if fs.exists(new(path)):
            if refuse:
                raise FileExistsError(f"{path} was written meanwhile; it is kept")
            if not fs.rename(new(path), new(old)):
                raise OSError(f"{path} can't be replaced")
        if not fs.rename(new(aside), new(path)):
            if fs.exists(new(old)):
                fs.rename(new(old), new(path))  # the old table comes back
            raise OSError(f"{path} can't be published")
    finally:
        for left in (aside, old):
            if fs.exists(new(left)) and fs.exists(new(path)):
                fs.delete(new(left), True)


def safe_for_path(s: str) -> str:
    """Characters outside ``[A-Za-z0-9._-]`` become ``_``."""
    return re.sub(r"[^A-Za-z0-9._\-]", "_", s)


def write_records(df: DataFrame, root: str, since, until, fmt: str = "csv", mode: str = "errorifexists") -> str:
    """Mail records under a folder named by their date range."""
    path = f"{root.rstrip('/')}/{safe_for_path(f'email_records_{since.isoformat()}_{until.isoformat()}')}"
    write_table(df, path, fmt, mode)
    return path


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(str(s.getPath()) for s in (fs.globStatus(path) or []))


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(glob_paths(spark, path))


def resolve_sources(spark: SparkSession, pattern: str, fallback: str | None = None) -> list[str]:
    """Files matching ``pattern`` (sorted) if any, else the fallback file
    if it exists, else nothing. Lists names only; no data reaches the driver."""
    names = glob_paths(spark, pattern)
    return names or ([fallback] if fallback and path_exists(spark, fallback) else [])


LEDGER_FIELDS = {c: tuple({c, c.replace("_", " "), c.replace("sub_category", "sub-category")}) for c in LEDGER_COLUMNS}


def read_labelled(spark: SparkSession, path: str, fmt: str = "parquet", header_row: int | None = None) -> DataFrame:
    """The labelled ledger (CSV or Parquet), conformed. A CSV's header is its ``header_row``-th record,
    as sheets with a title above the header have it; without a number it is looked for: the first
    record that names a category and a description. Files without one raise."""
    from ..schema import conform
    if fmt != "csv":
        df = spark.read.parquet(path)
        renamed = df.select(*[F.col(f"`{c}`").alias(c.strip().lower().replace(" ", "_").replace("-", "_"))
                              for c in df.columns])
        return conform(renamed, keep=[c for c in renamed.columns if c not in ("file", "row_no")])
    scan = scan_csv(spark, path, LEDGER_FIELDS, ("category", "description"), multi_line=True, header_row=header_row)
    bad = scan.rejected.limit(5).collect()
    if bad:
        raise ValueError("no labelled ledger: " + "; ".join(f"{r.file}: {r.reason}" for r in bad))
    return conform(scan.rows, keep=["file", "row_no"])


def write_classified(df: DataFrame, root: str, run_date, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """The classified ledger under ``run_date=YYYY-MM-DD``; other dates are not touched."""
    path = f"{root.rstrip('/')}/run_date={run_date.isoformat()}"
    write_table(df, path, fmt, mode)
    return path
