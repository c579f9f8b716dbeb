"""The registered queries of the training-data operators, with DuckDB SQL where
SQL can express them: name -> (query, sql or None)."""
from __future__ import annotations

from pyspark.sql import functions as F

from . import (bottomk, decontam, divergence, langid, merkle, mixing, pii, pitman_yor, simhash, suffix_dedup, toxicity,
               valuedict, warc)
from .common import hex64, id_mod, table


def op1_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs))


def op2_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.learn(docs))
    return found.select("doc_id", (id_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op3_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = merkle.with_fingerprint(docs, "text", "fingerprint")
    both = merkle.with_next(docs, ["doc_id", "text", "fingerprint"])
    n = F.char_length("text")
    k = F.floor(n / 3).cast("int")
    both = both.select("doc_id", F.col("fingerprint"), n.cast("long").alias("n_chars"),
                       F.concat(F.substr("text", F.lit(1), n - k), F.substr("next.text", F.lit(1), k)).alias("edited"),
                       F.col("next.fingerprint").alias("next_fingerprint"))
    both = merkle.with_fingerprint(both, "edited", "edited_fingerprint")
    both = (both.withColumn("_a", merkle.nodes(F.col("fingerprint")))
            .withColumn("_b", merkle.nodes(F.col("edited_fingerprint")))
            .withColumn("_c", merkle.nodes(F.col("next_fingerprint"))))
    return both.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", merkle.likeness(F.col("_a"), F.col("_b")).alias("near_edited"),
        merkle.likeness(F.col("_a"), F.col("_c")).alias("near_next"),
        merkle.first_difference(F.col("fingerprint"), F.col("edited_fingerprint")).alias("first_diff"))


def _sql_tree(text: str) -> str:
    return f"""(SELECT sha256(array_to_string(sections, ',')) || ':' ||
        array_to_string(list_transform(sections, lambda d: d[:8]), '-') || ':' ||
        array_to_string(list_transform(digests, lambda d: d[:8]), '-') || ':' ||
        coalesce(array_to_string(list_transform(flatten(list_transform(lines, lambda p:
            regexp_extract_all(p, '{merkle.PIECE}'))), lambda p: md5(p)[:8]), '-'), '')
      FROM (SELECT *, list_transform(string_split(rtrim(array_to_string(list_transform(digests, lambda d:
              d || CASE WHEN d[1] IN ('0', '1', '2', '3') THEN '/' ELSE ',' END), ''), '/'), '/'), lambda s: sha256(s))
              AS sections
            FROM (SELECT lines, list_transform(lines, lambda p: sha256(p)) AS digests
                  FROM (SELECT string_split({text}, chr(10)) AS lines))))"""


def _sql_nodes(fp: str) -> str:
    levels = [f"list_transform(list_filter(string_split(string_split({fp}, ':')[{k + 1}], '-'), lambda d: d <> ''), "
              f"lambda d: '{k}' || d)" for k in range(4)]
    return f"list_distinct(list_concat({', '.join(levels)}))"


def _sql_like(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"{both}::DOUBLE / (len({a}) + len({b}) - {both})"


OP3_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT *, length(text) AS n, length(text) // 3 AS k,
        coalesce(lead(text) OVER w, first_value(text) OVER w) AS after FROM t
      WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, substr(text, 1, n - k) || substr(after, 1, k) AS edited FROM p),
f AS (SELECT *, {_sql_tree('text')} AS fingerprint, {_sql_tree('edited')} AS edited_fingerprint,
        {_sql_tree('after')} AS next_fingerprint FROM e),
g AS (SELECT *, {_sql_nodes('fingerprint')} AS a, {_sql_nodes('edited_fingerprint')} AS b,
        {_sql_nodes('next_fingerprint')} AS c,
        string_split(string_split(fingerprint, ':')[3], '-') AS x,
        string_split(string_split(edited_fingerprint, ':')[3], '-') AS y FROM f)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
  {_sql_like('a', 'b')} AS near_edited, {_sql_like('a', 'c')} AS near_next,
  CASE WHEN string_split(fingerprint, ':')[1] = string_split(edited_fingerprint, ':')[1] THEN NULL
    ELSE coalesce(list_min(list_filter(range(least(len(x), len(y))), lambda i: x[i + 1] <> y[i + 1])),
                  least(len(x), len(y))) END AS first_diff
FROM g"""


def op4_decontamination(spark, sf_dir):
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return warc.round_trip(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
w AS (SELECT *, CASE WHEN payload_bytes >= {warc.MIN_REVISIT_BYTES}
        THEN max(page_id) OVER (PARTITION BY payload_digest) END AS winner FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN winner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN winner <> page_id THEN winner END AS refers_to FROM w"""


def op6_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


OP6_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3] AS w
      FROM d GROUP BY source),
fill AS (
  SELECT 0 AS round, source, source_size, w, false AS capped FROM s
  UNION ALL
  SELECT round + 1, source, source_size, w, capped OR over_ FROM (
    SELECT *, NOT capped AND rest * w / wsum > 3 * source_size AS over_,
           bool_or(NOT capped AND rest * w / wsum > 3 * source_size) OVER () AS any_ FROM (
      SELECT *, (sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE AS rest,
             sum(CASE WHEN capped THEN 0 ELSE w END) OVER () AS wsum FROM fill)) WHERE any_),
last_ AS (SELECT * FROM fill WHERE round = (SELECT max(round) FROM fill)),
t AS (SELECT source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE
        ELSE (sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE * w
             / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END AS target FROM last_),
q AS (SELECT *, floor(target + 1e-6)::BIGINT AS quota, row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1 AS src FROM t),
edges AS (SELECT src, sum(target) OVER (ORDER BY src ROWS UNBOUNDED PRECEDING) / greatest(1.0, sum(target) OVER ()) AS edge,
            count(*) OVER () AS n FROM q),
points AS (SELECT slot, (((slot + 1)::HUGEINT * {mixing.GOLDEN_64}) % 18446744073709551616)::DOUBLE / 18446744073709551616.0 AS u
           FROM (SELECT unnest(range(CAST(ceil((SELECT sum(size) FROM d) / {mixing.BLOCK_WORDS}.0) AS BIGINT))) AS slot)),
slots AS (SELECT slot, (SELECT count(*) FROM edges WHERE src < n - 1 AND edge <= u) AS src FROM points),
ranked AS (SELECT src, slot, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS block FROM slots),
need AS (SELECT src, CAST(ceil(quota / {mixing.BLOCK_WORDS}.0) AS BIGINT) AS need FROM q),
taken AS (
  SELECT r.src, r.block, r.slot FROM ranked r JOIN need USING (src) WHERE block < need
  UNION ALL SELECT src, block, (SELECT count(*) FROM points) + block FROM (
    SELECT src, unnest(range((SELECT count(*) FROM ranked r WHERE r.src = need.src), need)) AS block FROM need)),
p AS (SELECT d.*, q.source_size, q.target, q.quota, q.src,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(lo + size, quota) - lo)
   + greatest(0, least(lo + source_size + size, quota) - lo - source_size)
   + greatest(0, least(lo + 2 * source_size + size, quota) - lo - 2 * source_size))::BIGINT AS taken, t.slot AS first_slot
FROM p LEFT JOIN taken t ON t.src = p.src AND t.block = lo // {mixing.BLOCK_WORDS} AND least(lo + size, quota) > lo"""


def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("removed")


def op8_simhash(spark, sf_dir):
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op9_pitman_yor(spark, sf_dir):
    return pitman_yor.score(table(spark, sf_dir, "documents"), id_mod("doc_id", 7) == 2)


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model)
    return found.select("doc_id", (id_mod("doc_id", 5) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_bottomk(spark, sf_dir):
    return bottomk.near_groups(table(spark, sf_dir, "documents"))


def op12_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


# the group's and the language's p are restated from plain counts, pair by pair and term by term
OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT lang, source, row_id, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT row_id) >= %(min_docs)d),
langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
held AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::BIGINT AS total FROM held GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
        1 + 1000000000 * (coalesce(h.n, 0) + 5) // (coalesce(s.total, 0) + 5 * l.v) AS p,
        1 + 1000000000 * (k.n + 5) // (l.total + 5 * l.v) AS q
      FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
      LEFT JOIN totals s USING (lang, source) LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.v, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS v
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM ranked)
WHERE part = 'pair' OR rank <= %(top)d""" % {"min_docs": divergence.MIN_DOCS, "top": divergence.TOP_TERMS}


def op13_valuedict(spark, sf_dir):
    coded, books = valuedict.compress(table(spark, sf_dir, "embeddings"))
    return valuedict.with_label_error(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.digest() if books else "").alias("codebooks_sha256"))


def _op13_sql() -> str:
    """The rounds as one chain of plain joins: every part against every entry."""
    n_parts, n_entries, scale = valuedict.PARTS, valuedict.ENTRIES, valuedict.SCALE
    rounds = []
    total, n = "sum(x.x)::BIGINT", "count(*)"
    down = f"({total} - (({total} % {n}) + {n}) % {n}) // {n}"  # integer division that goes down
    for r in range(valuedict.ROUNDS + 1):
        last = r == valuedict.ROUNDS
        rounds.append(f"""far{r} AS MATERIALIZED (
  SELECT row_id, part, min(far * {n_entries} + entry) AS best FROM (
    SELECT x.row_id, x.part, e.entry, sum((x.x - e.x) * (x.x - e.x))::BIGINT AS far
    FROM comps x JOIN book{r} e ON x.part = e.part AND x.pos = e.pos GROUP BY ALL) GROUP BY ALL)""")
        if not last:
            rounds.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT e.part, e.entry, e.pos, coalesce(s.x, e.x) AS x FROM book{r} e LEFT JOIN (
    SELECT x.part, f.best % {n_entries} AS entry, x.pos, {down} AS x
    FROM comps x JOIN far{r} f ON x.row_id = f.row_id AND x.part = f.part GROUP BY ALL) s
  ON s.part = e.part AND s.entry = e.entry AND s.pos = e.pos)""")
    chain = ",\n".join(rounds)
    f, b = f"far{valuedict.ROUNDS}", f"book{valuedict.ROUNDS}"
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row_id, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comps AS MATERIALIZED (
  SELECT row_id, (i - 1) // (n // {n_parts}) AS part, (i - 1) % (n // {n_parts}) AS pos, floor({scale} * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT row_id, embedding, len(embedding) AS n, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, row_id - 1 AS entry, pos, x FROM comps WHERE row_id <= {n_entries}),
{chain},
coded AS (SELECT row_id, string_agg(lpad(lower(to_hex(best % {n_entries})), 2, '0'), '' ORDER BY part) AS code,
            sum(best // {n_entries})::BIGINT AS error FROM {f} GROUP BY ALL),
labelled AS (SELECT k.vec_id, k.label, c.code, c.error FROM kept k JOIN coded c USING (row_id))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM {b}) AS codebooks_sha256
FROM labelled"""


QUERIES = {
    "op1_pii": (op1_pii, None),
    "op2_langid": (op2_langid, None),
    "op3_merkle": (op3_merkle, OP3_SQL),
    "op4_decontamination": (op4_decontamination, None),
    "op5_warc": (op5_warc, OP5_SQL),
    "op6_mixing": (op6_mixing, OP6_SQL),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_simhash": (op8_simhash, None),
    "op9_pitman_yor": (op9_pitman_yor, None),
    "op10_toxicity": (op10_toxicity, None),
    "op11_bottomk": (op11_bottomk, None),
    "op12_divergence": (op12_divergence, OP12_SQL),
    "op13_valuedict": (op13_valuedict, _op13_sql()),
}
