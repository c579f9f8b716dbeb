"""Driver queries for labels, features, split, weights, metrics and flags.

``part`` rows become a labelled ledger (raw category from the part type, raw
sub-category from the name and size, description with a bank tag and a long
reference number), ``orders`` feed the numeric features, ``labels`` and
``documents`` feed the split and the metrics.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORY_MAP, EXCLUDE_CATEGORIES, SOURCE_VOCAB, SUBCAT_MAP
from ..operators.evaluate import class_report, confusion_matrix, summary
from ..operators.features import HASH_MOD, HASH_MUL, class_weights, numeric_features, source_onehot, \
    stratified_split
from ..operators.labels import (collapse_rare, filter_for_training, label_map, label_vocab,
                                normalize_labels, top_subcategories)
from ..operators.rules import highlight, review_mask, vendor_mask
from .inputs import read_table
from . import sqlgen as S

# FIXED VALUES: raw label text rendered per part type (exercises the maps).
RAW_CATEGORY = (("MEDIUM", " expenses "), ("STANDARD", "Personal"), ("LARGE", "revenue"), ("PROMO", "0"),
                ("SMALL", "TRANSFER"), ("ECONOMY", "EXPENSES"))
RAW_SUBCAT = (("MEDIUM", " office expenses"), ("STANDARD", "Entertainement"), ("LARGE", "TRAINNING "),
              ("PROMO", ""))


def _case(col, table, default=None):
    out = None
    for k, v in table:
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(default if default is not None else F.lit(None).cast("string"))


def _sql_case(col, table, default="NULL"):
    return "CASE " + " ".join(f"WHEN {col} = {S.q(k)} THEN {S.q(v)}" for k, v in table) + f" ELSE {default} END"


def labelled_parts(spark, sf) -> DataFrame:
    p = read_table(spark, sf, "part")
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    src = F.when(brand_no == 13, F.lit("Total")).otherwise(
        F.get(F.array(*[F.lit(v) for v in SOURCE_VOCAB]), brand_no % F.lit(len(SOURCE_VOCAB))))
    sub = _case(F.col("p_type"), RAW_SUBCAT, F.concat(F.col("p_name"), F.lit(" #"), F.col("p_size").cast("string")))
    desc = F.when(F.col("p_size") == 1, F.lit("  ")).otherwise(
        F.concat(F.lit("[POS] "), F.col("p_name"), F.lit("  "), F.lpad(F.col("p_partkey").cast("string"), 10, "0"),
                 F.lit(" "), F.col("p_type")))
    return p.select("p_partkey", src.alias("source"), _case(F.col("p_type"), RAW_CATEGORY).alias("category"),
                    sub.alias("sub_category1"), desc.alias("description"))


def _sql_parts_raw():
    sub = _sql_case("p_type", RAW_SUBCAT, "p_name || ' #' || p_size")
    vocab = "[" + ", ".join(S.q(v) for v in SOURCE_VOCAB) + "]"
    return ("raw AS (SELECT p_partkey, CASE WHEN TRY_CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) = 13 "
            f"THEN 'Total' ELSE {vocab}[(TRY_CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % "
            f"{len(SOURCE_VOCAB)}) + 1] END AS source, {_sql_case('p_type', RAW_CATEGORY)} AS category, "
            f"{sub} AS sub_category1, CASE WHEN p_size = 1 THEN '  ' ELSE '[POS] ' || p_name || '  ' || "
            "lpad(CAST(p_partkey AS VARCHAR), 10, '0') || ' ' || p_type END AS description FROM part)")


def _sql_norm(col, table):
    raw = S.strip_ws(f"CAST({col} AS VARCHAR)")
    cases = " ".join(f"WHEN lower({raw}) = {S.q(k)} THEN {S.q(v)}" for k, v in table)
    return f"(CASE WHEN {raw} IS NULL OR {raw} = '' OR {raw} = '0' THEN NULL {cases} ELSE {raw} END)"


def _sql_normalized():
    return (f"WITH {_sql_parts_raw()}, n AS (SELECT p_partkey, source, {_sql_norm('category', CATEGORY_MAP)} AS "
            f"category, {_sql_norm('sub_category1', SUBCAT_MAP)} AS sub_category1, "
            f"{S.clean_desc('description')} AS description FROM raw)")


def _sql_trainable():
    ex = ", ".join(S.q(x) for x in EXCLUDE_CATEGORIES)
    return (f"{_sql_normalized()}, t AS (SELECT * FROM n WHERE coalesce(source, '<NA>') <> 'Total' AND category "
            f"IS NOT NULL AND category NOT IN ({ex}) AND length(coalesce(description, '')) > 0)")


def _normalized(spark, sf):
    return normalize_labels(labelled_parts(spark, sf))


def _trainable(spark, sf):
    return filter_for_training(_normalized(spark, sf))


def q_normalize_labels(spark, sf):
    return _normalized(spark, sf).select("p_partkey", "category", "sub_category1", "description")


def sql_normalize_labels():
    return f"{_sql_normalized()} SELECT p_partkey, category, sub_category1, description FROM n"


def q_training_filter(spark, sf):
    return _trainable(spark, sf).select("p_partkey", "category")


def sql_training_filter():
    return f"{_sql_trainable()} SELECT p_partkey, category FROM t"


def q_rare_collapse(spark, sf):
    return collapse_rare(_trainable(spark, sf)).select("p_partkey", "category", "sub_category1")


def _sql_collapsed():
    return (f"{_sql_trainable()}, c AS (SELECT sub_category1, count(*) AS k FROM t WHERE category = 'EXPENSES' "
            "AND sub_category1 IS NOT NULL GROUP BY 1), r AS (SELECT t.p_partkey, t.category, CASE WHEN "
            "t.category = 'EXPENSES' AND c.k < 5 THEN 'Other' ELSE t.sub_category1 END AS sub_category1 "
            "FROM t LEFT JOIN c ON t.sub_category1 = c.sub_category1)")


def sql_rare_collapse():
    return f"{_sql_collapsed()} SELECT * FROM r"


def q_label_vocab(spark, sf):
    c = collapse_rare(_trainable(spark, sf))
    s1 = label_vocab(c, "category").withColumn("stage", F.lit(1))
    s2 = label_vocab(c.where(F.col("category") == "EXPENSES"), "sub_category1").withColumn("stage", F.lit(2))
    return s1.unionByName(s2).select("stage", "label", "idx")


def sql_label_vocab():
    return (f"{_sql_collapsed()} SELECT 1 AS stage, label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) "
            "AS idx FROM (SELECT DISTINCT category AS label FROM r WHERE category IS NOT NULL) UNION ALL "
            "SELECT 2, label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) FROM (SELECT DISTINCT "
            "sub_category1 AS label FROM r WHERE category = 'EXPENSES' AND sub_category1 IS NOT NULL)")


def q_label_map(spark, sf):
    m = label_map(collapse_rare(_trainable(spark, sf)))
    return m.select(F.array_join("stage1_categories", "|").alias("stage1"),
                    F.array_join("stage2_subcategories", "|").alias("stage2"),
                    F.array_join("excluded_categories", "|").alias("excluded"),
                    "min_subcat_samples", "n_train_rows", "n_stage2_rows")


def sql_label_map():
    ex = "|".join(sorted(EXCLUDE_CATEGORIES))
    return (f"{_sql_collapsed()} SELECT array_to_string(list_sort(list(DISTINCT category)), '|') AS stage1, "
            "array_to_string(list_sort(list(DISTINCT sub_category1) FILTER (WHERE category = 'EXPENSES' AND "
            f"sub_category1 IS NOT NULL)), '|') AS stage2, {S.q(ex)} AS excluded, 5 AS min_subcat_samples, "
            "count(*) AS n_train_rows, CAST(sum(CASE WHEN category = 'EXPENSES' THEN 1 ELSE 0 END) AS BIGINT) "
            "AS n_stage2_rows FROM r")


def q_top_subcategories(spark, sf):
    return top_subcategories(_trainable(spark, sf), 20)


def sql_top_subcategories():
    return (f"{_sql_trainable()} SELECT sub_category1, count(*) AS n FROM t WHERE category = 'EXPENSES' AND "
            "sub_category1 IS NOT NULL GROUP BY 1 ORDER BY n DESC, sub_category1 LIMIT 20")


# ------------------------------------------------------------------ M1 / M2
def q_numeric_features(spark, sf):
    o = read_table(spark, sf, "orders")
    bank = F.get(F.array(*[F.lit(v) for v in SOURCE_VOCAB + ("Other",)]),
                 F.length(F.col("o_orderpriority")) % F.lit(len(SOURCE_VOCAB) + 1))
    signed = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(-F.col("o_totalprice"))
    month = F.when(F.col("o_orderstatus") != "P", F.month("o_orderdate"))
    feats = numeric_features(signed, month, F.col("o_orderdate"))
    onehot = source_onehot(bank)
    names = ["log_amount", "sign", "month_sin", "month_cos", "is_weekend"] + [f"src_{v}" for v in SOURCE_VOCAB]
    return o.select("o_orderkey", *[(F.round(c, 6) + F.lit(0.0)).alias(n) for c, n in zip(feats + onehot, names)])


def sql_numeric_features():
    vocab = "[" + ", ".join(S.q(v) for v in SOURCE_VOCAB + ("Other",)) + "]"
    bank = f"{vocab}[(length(o_orderpriority) % {len(SOURCE_VOCAB) + 1}) + 1]"
    a = "CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END"
    m = "CASE WHEN o_orderstatus <> 'P' THEN month(o_orderdate) ELSE 0 END"
    ang = f"({2 * 3.141592653589793!r} * ({m}) / 12.0)"
    one = ", ".join(f"CASE WHEN {bank} = {S.q(v)} THEN 1.0 ELSE 0.0 END + 0.0 AS \"src_{v}\"" for v in SOURCE_VOCAB)
    return (f"SELECT o_orderkey, round(ln(1 + abs({a})), 6) + 0.0 AS log_amount, "
            f"round(sign({a}), 6) + 0.0 AS sign, "
            f"round(CASE WHEN ({m}) <> 0 THEN sin({ang}) ELSE 0.0 END, 6) + 0.0 AS month_sin, "
            f"round(CASE WHEN ({m}) <> 0 THEN cos({ang}) ELSE 0.0 END, 6) + 0.0 AS month_cos, "
            "CASE WHEN isodow(o_orderdate) >= 6 THEN 1.0 ELSE 0.0 END + 0.0 AS is_weekend, "
            f"{one} FROM orders")


# ------------------------------------------------------------------ M5 / M6
def q_stratified_split(spark, sf):
    lab = read_table(spark, sf, "labels")
    return stratified_split(lab, "quality", "doc_id").select("doc_id", "quality", "split")


def _sql_hash(key):
    return f"((CAST({key} AS BIGINT) % {HASH_MOD} * {HASH_MUL} + {42 * 97}) % {HASH_MOD})"


def sql_stratified_split():
    return ("SELECT doc_id, quality, CASE WHEN r < floor((n * 80 + 50) / 100) THEN 'train' WHEN r < "
            "floor((n * 90 + 50) / 100) THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, quality, "
            f"row_number() OVER (PARTITION BY quality ORDER BY {_sql_hash('doc_id')}, doc_id) - 1 AS r, "
            "count(*) OVER (PARTITION BY quality) AS n FROM labels)")


def q_class_weights(spark, sf):
    c = read_table(spark, sf, "customer")
    s = stratified_split(c, "c_mktsegment", "c_custkey")
    w = class_weights(s.where(F.col("split") == "train"), "c_mktsegment")
    return w.select("c_mktsegment", (F.round("weight", 9) + F.lit(0.0)).alias("weight"))


def sql_class_weights():
    return ("WITH s AS (SELECT c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY "
            f"{_sql_hash('c_custkey')}, c_custkey) - 1 AS r, count(*) OVER (PARTITION BY c_mktsegment) AS n "
            "FROM customer), t AS (SELECT c_mktsegment, count(*) AS c FROM s WHERE r < floor((n * 80 + 50) / 100) "
            "GROUP BY 1) SELECT c_mktsegment, round(sqrt((SELECT sum(c) FROM t) / ((SELECT count(*) FROM t) * c)), "
            "9) + 0.0 AS weight FROM t")


# ------------------------------------------------------------------ M11-M13
def _scored_labels(spark, sf):
    lab = read_table(spark, sf, "labels")
    doc = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    return j.select("doc_id", F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("bad")).alias("y_true"),
                    F.when(F.col("toxic") == 1, F.lit("toxic"))
                    .when(F.col("n_chars") >= 1000, F.lit("good")).otherwise(F.lit("bad")).alias("y_pred"))


_SQL_SCORED = ("sc AS (SELECT l.doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS y_true, CASE WHEN "
               "toxic = 1 THEN 'toxic' WHEN n_chars >= 1000 THEN 'good' ELSE 'bad' END AS y_pred FROM labels l "
               "JOIN documents d ON l.doc_id = d.doc_id)")
_SQL_PC = (_SQL_SCORED + ", cls AS (SELECT y_true AS label FROM sc UNION SELECT y_pred FROM sc), "
           "pc AS (SELECT label, (SELECT count(*) FROM sc WHERE y_true = label) AS support, "
           "(SELECT count(*) FROM sc WHERE y_pred = label) AS predicted, "
           "(SELECT count(*) FROM sc WHERE y_true = label AND y_pred = label) AS tp FROM cls), "
           "m AS (SELECT label, support, tp, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision, "
           "CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc), "
           "f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) "
           "ELSE 0.0 END AS f1 FROM m)")


def _round_cols(df, cols):
    return df.select(*[(F.round(c, 9) + F.lit(0.0)).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_macro_f1(spark, sf):
    return _round_cols(summary(_scored_labels(spark, sf), "y_true", "y_pred"), {"accuracy", "macro_f1"})


def sql_macro_f1():
    return (f"WITH {_SQL_PC} SELECT round(sum(tp) / sum(support), 9) + 0.0 AS accuracy, "
            "round(avg(f1), 9) + 0.0 AS macro_f1 FROM f")


def q_class_report(spark, sf):
    return _round_cols(class_report(_scored_labels(spark, sf), "y_true", "y_pred"), {"precision", "recall", "f1"})


def sql_class_report():
    r = lambda e: f"round({e}, 9) + 0.0"
    return (f"WITH {_SQL_PC} SELECT label, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, "
            "CAST(support AS BIGINT) AS support FROM f UNION ALL SELECT 'accuracy', "
            f"{r('sum(tp) / sum(support)')}, {r('sum(tp) / sum(support)')}, {r('sum(tp) / sum(support)')}, "
            f"CAST(sum(support) AS BIGINT) FROM f UNION ALL SELECT 'macro avg', {r('avg(precision)')}, "
            f"{r('avg(recall)')}, {r('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM f UNION ALL SELECT "
            f"'weighted avg', {r('sum(precision * support) / sum(support)')}, "
            f"{r('sum(recall * support) / sum(support)')}, {r('sum(f1 * support) / sum(support)')}, "
            "CAST(sum(support) AS BIGINT) FROM f")


def q_confusion_matrix(spark, sf):
    return confusion_matrix(_scored_labels(spark, sf), "y_true", "y_pred", ("bad", "good", "toxic"))


def sql_confusion_matrix():
    cols = ", ".join(f"CAST(count(sc.doc_id) FILTER (WHERE sc.y_pred = '{c}') AS BIGINT) AS {c}"
                     for c in ("bad", "good", "toxic"))
    return (f"WITH {_SQL_SCORED}, cls AS (SELECT y_true AS label FROM sc UNION SELECT y_pred FROM sc) "
            f"SELECT cls.label, {cols} FROM cls LEFT JOIN sc ON sc.y_true = cls.label GROUP BY cls.label")


# ------------------------------------------------------------------ R12-R14
def q_review_flags(spark, sf):
    from .rules_queries import q_decision_chain
    d = q_decision_chain(spark, sf)
    doc = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf, "labels").select("doc_id", "toxic")
    j = d.join(doc, "doc_id").join(lab, "doc_id", "left")
    conf = F.least(F.col("n_chars") / F.lit(5000.0), F.lit(1.0))
    conf2 = F.when(F.col("toxic") == 1, F.lit(0.5)).when(F.col("toxic") == 0, F.lit(0.9))
    rev = review_mask(F.lit(False), conf, F.col("category"), conf2)
    return j.select("doc_id", highlight(rev, vendor_mask(F.col("sub_category2"))).alias("highlight"))


def sql_review_flags():
    from .rules_queries import sql_decision_chain
    return (f"WITH dc AS ({sql_decision_chain()}) SELECT dc.doc_id, CASE WHEN least(d.n_chars / 5000.0, 1.0) < 0.7 "
            "OR (dc.category = 'EXPENSES' AND coalesce(CASE WHEN l.toxic = 1 THEN 0.5 WHEN l.toxic = 0 THEN 0.9 END "
            "< 0.7, false)) THEN 'unresolved' WHEN dc.sub_category2 IN ('AMAZON', 'PAYPAL', 'TEMU', 'UBER') "
            "THEN 'vendor' END AS highlight FROM dc JOIN documents d ON dc.doc_id = d.doc_id "
            "LEFT JOIN labels l ON dc.doc_id = l.doc_id")


QUERIES = {
    "normalize_labels": (q_normalize_labels, sql_normalize_labels),
    "training_filter": (q_training_filter, sql_training_filter),
    "rare_collapse": (q_rare_collapse, sql_rare_collapse),
    "label_vocab": (q_label_vocab, sql_label_vocab),
    "label_map": (q_label_map, sql_label_map),
    "top_subcategories": (q_top_subcategories, sql_top_subcategories),
    "numeric_features": (q_numeric_features, sql_numeric_features),
    "stratified_split": (q_stratified_split, sql_stratified_split),
    "class_weights": (q_class_weights, sql_class_weights),
    "macro_f1": (q_macro_f1, sql_macro_f1),
    "class_report": (q_class_report, sql_class_report),
    "confusion_matrix": (q_confusion_matrix, sql_confusion_matrix),
    "review_flags": (q_review_flags, sql_review_flags),
}
