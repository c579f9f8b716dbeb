"""Label preparation (L1-L8, S12): normalise categories, filter training rows,
collapse rare sub-categories, build the label vocabularies and label map.

Counts are grouped aggregates (partial aggregation before the shuffle), so a
label that covers a large share of the rows never sits in one task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORY_MAP, EXCLUDE_CATEGORIES, MIN_SUBCAT_SAMPLES, SUBCAT_MAP
from ..functions.text import clean_description, col_, strip_ws


def _normalise(c, table) -> Column:
    raw = strip_ws(col_(c).cast("string"))
    m = F.create_map(*[x for k, v in table for x in (F.lit(k), F.lit(v))])
    return F.when(raw.isNull() | (raw == "") | (raw == "0"), F.lit(None).cast("string")) \
        .otherwise(F.coalesce(F.try_element_at(m, F.lower(raw)), raw))


def normalize_category(c) -> Column:
    """L1: trim; blank or '0' -> null; case-insensitive map, else the raw text."""
    return _normalise(c, CATEGORY_MAP)


def normalize_subcat(c) -> Column:
    """L2: same rule with the sub-category map."""
    return _normalise(c, SUBCAT_MAP)


def normalize_labels(df: DataFrame) -> DataFrame:
    """L3: category, sub_category1 and description (F8)."""
    return (df.withColumn("category", normalize_category(F.col("category")))
              .withColumn("sub_category1", normalize_subcat(F.col("sub_category1")))
              .withColumn("description", clean_description(F.col("description"))))


def filter_for_training(df: DataFrame, exclude=EXCLUDE_CATEGORIES) -> DataFrame:
    """L4: source != 'Total', category present and not excluded (exact case),
    non-empty description."""
    src = F.coalesce(F.col("source").cast("string"), F.lit("<NA>"))
    return df.where((src != "Total") & F.col("category").isNotNull()
                    & ~F.col("category").isin(*exclude)
                    & (F.length(F.coalesce(F.col("description"), F.lit(""))) > 0))


def category_counts(df: DataFrame) -> DataFrame:
    """Rows per category."""
    return df.where(F.col("category").isNotNull()).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def top_subcategories(df: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent sub-categories of EXPENSES rows (ties by name)."""
    c = (df.where((F.col("category") == "EXPENSES") & F.col("sub_category1").isNotNull())
         .groupBy("sub_category1").agg(F.count(F.lit(1)).alias("n")))
    return c.orderBy(F.desc("n"), F.asc("sub_category1")).limit(k)


def collapse_rare(df: DataFrame, min_count: int = MIN_SUBCAT_SAMPLES, other: str = "Other") -> DataFrame:
    """EXPENSES sub-categories seen fewer than ``min_count`` times become
    ``other``; null stays null. Counts are a grouped aggregate joined back
    (one row per label, so AQE can split a hot label's partition)."""
    exp = F.col("category") == "EXPENSES"
    counts = (df.where(exp & F.col("sub_category1").isNotNull())
              .groupBy("sub_category1").agg(F.count(F.lit(1)).alias("_n")))
    rare = counts.where(F.col("_n") < min_count).select(F.col("sub_category1").alias("_key"), F.lit(True).alias("_rare"))
    # rows without a label to look up get one of many keys that match nothing
    nothing = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(4096)).cast("string"))
    out = df.withColumn("_key", F.when(exp & F.col("sub_category1").isNotNull(), F.col("sub_category1")).otherwise(nothing))
    out = out.join(rare, "_key", "left")
    return out.withColumn("sub_category1", F.when(exp & F.coalesce(F.col("_rare"), F.lit(False)), F.lit(other))
                          .otherwise(F.col("sub_category1"))).select(*df.columns)


def label_vocab(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels with their index (alphabetical order).
    The vocabulary is one row per class; its index is a rank over that small
    distinct set."""
    from pyspark.sql import Window
    d = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct()
    return d.withColumn("idx", (F.row_number().over(Window.orderBy("label")) - 1).cast("int"))


def index_labels(df: DataFrame, label: str, vocab: DataFrame) -> DataFrame:
    """Attach the label index; rows with labels outside the vocabulary drop."""
    return df.join(vocab.select(F.col("label").alias(label), "idx"), label, "inner")


def stage_frames(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stage 1 rows (category present), stage 2 rows (EXPENSES with a
    sub-category)."""
    s1 = df.where(F.col("category").isNotNull())
    s2 = df.where((F.col("category") == "EXPENSES") & F.col("sub_category1").isNotNull())
    return s1, s2


def label_map(df: DataFrame, min_count: int = MIN_SUBCAT_SAMPLES) -> DataFrame:
    """One row: sorted stage-1 / stage-2 classes, exclusions, counts."""
    exp = F.col("category") == "EXPENSES"
    return df.agg(
        F.array_sort(F.collect_set("category")).alias("stage1_categories"),
        F.array_sort(F.collect_set(F.when(exp, F.col("sub_category1")))).alias("stage2_subcategories"),
        F.array_sort(F.array(*[F.lit(x) for x in EXCLUDE_CATEGORIES])).alias("excluded_categories"),
        F.lit(min_count).alias("min_subcat_samples"),
        F.count(F.lit(1)).alias("n_train_rows"),
        F.sum(F.when(exp, 1).otherwise(0)).cast("long").alias("n_stage2_rows"))
