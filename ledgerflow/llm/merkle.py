r"""Document fingerprints: a Merkle tree over pieces, paragraphs, sections, root.

All of it is DataFrame functions. A text is cut at line feeds into paragraphs and a
paragraph into pieces of up to ``PIECE_WORDS`` words (white space behind a word stays with it,
so the pieces spell the whole paragraph). A paragraph's node is the SHA-256 of the
text of the paragraph; a section ends behind a paragraph whose digest starts with one of
``SECTION_ENDS`` (about every fourth), so an insertion moves no later section; a
section's node hashes its paragraph nodes and the root hashes the section nodes.

The fingerprint string is ``root:sections:paragraphs:pieces``: the root in full (64
hex digits), the others cut to 8 digits each, joined by '-'. Equal texts have equal
fingerprints, different texts different roots. ``likeness`` is the share of distinct
nodes of both trees that both have; ``first_difference`` locates an edit: it compares
the paragraph nodes from the front.

Defined results: null text is the empty text (one empty paragraph); empty texts are
alike (1.0); long texts are hashed whole; an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
PIECE_WORDS = 8
PIECE = r"(?:[^ ]+ *){1,%d}| +" % PIECE_WORDS
SECTION_ENDS = "0123"
SHORT = 8


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint string of column ``text`` as column ``name``."""
    lines, digests, sections = (f"_{name}_{k}" for k in ("lines", "digests", "sections"))
    cut = lambda nodes: F.array_join(F.transform(nodes, lambda d: F.substring(d, 1, SHORT)), "-")
    # the sections' ends are marked in the joined digests and then split there: linear in the text
    marked = F.array_join(F.transform(F.col(digests), lambda d: F.concat(
        d, F.when(F.substring(d, 1, 1).isin(*SECTION_ENDS), F.lit("/")).otherwise(F.lit(",")))), "")
    pieces = F.flatten(F.transform(F.col(lines), lambda p: F.regexp_extract_all(p, F.lit(PIECE), F.lit(0))))
    return (df.withColumn(lines, F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
            .withColumn(digests, F.transform(lines, lambda p: F.sha2(p.cast("binary"), 256)))
            .withColumn(sections, F.transform(F.split(F.rtrim(marked, F.lit("/")), "/", -1),
                                              lambda x: F.sha2(x.cast("binary"), 256)))
            .withColumn(name, F.concat_ws(
                ":", F.sha2(F.array_join(sections, ",").cast("binary"), 256), cut(F.col(sections)),
                cut(F.col(digests)),
                F.array_join(F.transform(pieces, lambda p: F.substring(F.md5(p.cast("binary")), 1, SHORT)), "-")))
            .drop(lines, digests, sections))


def root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, ":", 1)


def _level(fingerprint: Column, k: int) -> Column:
    return F.array_remove(F.split(F.split(fingerprint, ":", -1)[k], "-", -1), "")


def nodes(fingerprint: Column) -> Column:
    """The distinct nodes of a fingerprint's tree, told apart by level."""
    def marked(k):
        return F.transform(_level(fingerprint, k), lambda d: F.concat(F.lit(str(k)), d))

    return F.array_distinct(F.concat(*[marked(k) for k in range(4)]))


def likeness(a: Column, b: Column) -> Column:
    """Common share of two node lists (0 to 1)."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def first_difference(a: Column, b: Column) -> Column:
    """Index of the first paragraph in which the trees of two fingerprints differ;
    null if their roots are equal."""
    x, y = _level(a, 2), _level(b, 2)
    n = F.least(F.size(x), F.size(y))
    at = F.array_position(F.zip_with(F.slice(x, 1, n), F.slice(y, 1, n), lambda p, q: p == q), F.lit(False)) - 1
    return F.when(root(a) == root(b), F.lit(None)).when(at >= 0, at).otherwise(n.cast("long"))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(columns..., next: struct of the same columns) where next is the row that
    follows in descending doc_id (null ids last, ties by text); the first follows the last.

    Rows are dealt into ranges of ids by approximate quantiles, the ranges growing in
    number with the shuffle partitions. The rows with a range's largest id also
    go to the range above, whose last row they follow. Each text is shuffled once.
    """
    spark = docs.sparkSession
    n = 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    step = max(1, int(len(cuts) ** 0.5))
    coarse = F.array(*[F.lit(c).cast("long") for c in cuts[step - 1::step]]) if cuts[step - 1::step] else None
    fine = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else None

    def count_below(cuts_, id_):
        return F.size(F.filter(cuts_, lambda c: c <= id_)) if cuts_ is not None else F.lit(0)

    def range_of(id_):  # -1: null ids; two short searches instead of one over all cuts
        if fine is None:
            return F.when(id_.isNull(), -1).otherwise(0)
        at = count_below(coarse, id_) * step
        return F.when(id_.isNull(), -1).otherwise(at + count_below(F.slice(fine, at + 1, step), id_))

    ranged = docs.withColumn("_range", range_of(F.col("doc_id")))
    tops = ranged.groupBy("_range").agg(F.max("doc_id").alias("_top"))
    rows = tops.collect()  # a row a range
    order = sorted(r["_range"] for r in rows)
    above = {r: order[(k + 1) % len(order)] for k, r in enumerate(order)}
    top = {r["_range"]: r["_top"] for r in rows}
    if not order:
        return docs.select(*columns, F.struct(*columns).alias("next"))
    look = spark.createDataFrame([(r, above[r], top[r]) for r in order], "_range int, _above int, _top long")
    dealt = ranged.join(F.broadcast(look), "_range").withColumn(  # a row a range
        "_to", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("_top")), F.array(
            F.struct(F.lit(0).alias("halo"), F.col("_range").alias("to")),
            F.struct(F.lit(1).alias("halo"), F.col("_above").alias("to"))))
            .otherwise(F.array(F.struct(F.lit(0).alias("halo"), F.col("_range").alias("to"))))))
    w = Window.partitionBy("_to.to").orderBy(F.col("_to.halo"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    return (dealt.withColumn("next", F.lead(F.struct(*columns)).over(w))
            .where(F.col("_to.halo") == 0).select(*columns, "next"))
