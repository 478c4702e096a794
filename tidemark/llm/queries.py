"""The operators' queries over whole tables, and DuckDB SQL for those that SQL expresses at that size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_quality, op2_lm, op3_html, op4_lines, op5_minhash, op6_suffix, op7_decontaminate, op8_license, op9_bpe, op10_chat, op11_centroids, op12_exact, op13_align


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    out = op1_quality.quality_report(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_lm_score(spark, sf_dir):
    return op2_lm.score(_table(spark, sf_dir, "documents"))


def op3_html_extract(spark, sf_dir):
    return op3_html.extract(_table(spark, sf_dir, "pages"))


def op4_line_dedup(spark, sf_dir):
    out = op4_lines.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("_lines").cast("long").alias("n_lines"), F.size("_dropped").cast("long").alias("n_dropped"), F.sha2(op4_lines.kept_text(), 256).alias("kept_sha256"))


def op5_minhash_dedup(spark, sf_dir):
    return op5_minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4)


def op6_suffix_dedup(spark, sf_dir):
    return op6_suffix.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op7_decontaminate_bm25(spark, sf_dir):
    return op7_decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_license_scan(spark, sf_dir):
    return op8_license.scan(_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark, sf_dir):
    return op9_bpe.encode_digests(_table(spark, sf_dir, "documents"))


def op10_preference_format(spark, sf_dir):
    out = op10_chat.format_preferences(*op10_chat.stale_reply_pairs(_table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return out.select(
        F.col("pair_id").alias("conv_id"), F.col("n_common").cast("long").alias("n_common"), F.length("prompt").cast("long").alias("prompt_chars"),
        F.sha2("prompt", 256).alias("prompt_sha256"), F.sha2("chosen", 256).alias("chosen_sha256"), F.sha2("rejected", 256).alias("rejected_sha256"),
        spans("chosen_loss").alias("chosen_loss"), spans("rejected_loss").alias("rejected_loss"),
    )


def op11_centroid_clustering(spark, sf_dir):
    return op11_centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark, sf_dir):
    return op12_exact.dedup(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark, sf_dir):
    return op13_align.link_table(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_lm_score, op3_html_extract, op4_line_dedup, op5_minhash_dedup, op6_suffix_dedup, op7_decontaminate_bm25, op8_license_scan, op9_byte_bpe, op10_preference_format, op11_centroid_clustering, op12_exact_dedup, op13_token_alignment)}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _kmeans_sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds of assignment and exact means over all pairs of vectors and centroids, one after another."""
    distance = "CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    nearest = lambda r: f"(SELECT vec_id, any_value(v) AS v, min({{'d': {distance}, 'cid': cid}}) AS m FROM v CROSS JOIN c{r} GROUP BY vec_id)"
    with_ = f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cid, v AS c FROM v ORDER BY sha256('2:' || vec_id) LIMIT {k})"""
    for r in range(rounds):
        with_ += f""",
a{r} AS MATERIALIZED (SELECT v, m.cid AS cid FROM {nearest(r)}),
s{r} AS (SELECT cid, d, sum(x) AS s, count(*) AS n FROM (SELECT cid, unnest(v) AS x, unnest(range(1, 65)) AS d FROM a{r}) GROUP BY cid, d),
m{r} AS (SELECT cid, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS c FROM s{r} GROUP BY cid),
c{r + 1} AS MATERIALIZED (SELECT cid, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cid))"""
    return f"""WITH {with_},
z AS MATERIALIZED (SELECT vec_id, CAST(m.cid AS INTEGER) AS cluster, m.d AS distance FROM {nearest(rounds)})
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256 FROM z JOIN c{rounds} ON cid = cluster"""


SQL = {
    "op11_centroid_clustering": _kmeans_sql(),
    "op12_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op1_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i+1], w[i+2]) AS n
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i+1, i+2]) AS p FROM t WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR 100 * n_dup_lines > 40 * n_lines) AS kept
FROM m""",
    "op4_line_dedup": rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
bad AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM bad)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (key NOT IN (SELECT key FROM bad)), '')) AS kept_sha256
FROM k GROUP BY doc_id""",
    "op10_preference_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
z AS (SELECT *, max(turn) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS last FROM c),
y AS (SELECT *, max(turn) FILTER (role = 'assistant' AND turn < last) OVER (PARTITION BY conv_id) AS prior FROM z WHERE turn <= last),
x AS (SELECT *, coalesce(max(text) FILTER (turn = prior) OVER (PARTITION BY conv_id), '') AS before FROM y),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS k,
             CASE WHEN turn = last AND role = 'assistant' THEN before ELSE text END AS other FROM x),
s AS (SELECT conv_id, turn, role, text, other, k, coalesce(min(k) FILTER (text <> other) OVER (PARTITION BY conv_id), count(*) OVER (PARTITION BY conv_id)) AS n_common FROM t),
p AS (SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS a, '<|' || role || '|>' || chr(10) || other || '<|end|>' || chr(10) AS b, length('<|' || role || '|>' || chr(10)) AS head FROM s),
o AS (SELECT *, coalesce(sum(CASE WHEN k >= n_common THEN length(a) END) OVER w, 0) AS enda, coalesce(sum(CASE WHEN k >= n_common THEN length(b) END) OVER w, 0) AS endb FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY k))
SELECT conv_id, CAST(max(n_common) AS BIGINT) AS n_common, CAST(coalesce(sum(length(a)) FILTER (k < n_common), 0) AS BIGINT) AS prompt_chars,
       sha256(coalesce(string_agg(a, '' ORDER BY k) FILTER (k < n_common), '')) AS prompt_sha256,
       sha256(coalesce(string_agg(a, '' ORDER BY k) FILTER (k >= n_common), '')) AS chosen_sha256,
       sha256(coalesce(string_agg(b, '' ORDER BY k) FILTER (k >= n_common), '')) AS rejected_sha256,
       coalesce(string_agg(CAST(enda - length(a) + head AS BIGINT) || '-' || CAST(enda AS BIGINT), ',' ORDER BY k) FILTER (k >= n_common AND role = 'assistant'), '') AS chosen_loss,
       coalesce(string_agg(CAST(endb - length(b) + head AS BIGINT) || '-' || CAST(endb AS BIGINT), ',' ORDER BY k) FILTER (k >= n_common AND role = 'assistant'), '') AS rejected_loss
FROM o GROUP BY conv_id""",
}
