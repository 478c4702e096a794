"""Deterministic sampling, splits, queues and leakage on documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import hashing, ladders, text
from ..functions.stats import r6
from ..operators import labels, ranking, splits
from ..sources.tables import table
from .registry import query


def _docs(spark, sf, *columns):
    return table(spark, sf, "documents").select("doc_id", *columns)


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY sha256('17:' || doc_id)) AS r FROM documents) WHERE r <= 3")
def hash_rank_topk(spark, sf):
    return ranking.top_k(_docs(spark, sf, "lang", "source"), ["lang", "source"], 3, hashing.rank(F.col("doc_id"), 17))


@query("SELECT doc_id, lang, g FROM (SELECT doc_id, lang, sha256(text) AS g, row_number() OVER (PARTITION BY sha256(text) ORDER BY sha256('5:' || doc_id)) AS r FROM documents) WHERE r = 1")
def group_representative(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("g"))
    return ranking.representatives(d, "g", "doc_id", 5)


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('9:' || doc_id), doc_id) AS "round" FROM documents)
SELECT doc_id, source, "round", row_number() OVER (ORDER BY "round", source) AS position FROM r ORDER BY "round", source LIMIT 64""")
def round_robin_merge(spark, sf):
    return ranking.round_robin(_docs(spark, sf, "source"), "source", "doc_id", 9, 64)


@query("""WITH l AS (SELECT doc_id, quality = 1 AS pos FROM labels), r AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY sha256('2:' || doc_id), doc_id) AS n FROM l)
SELECT doc_id, pos FROM (SELECT *, n > 20 AS late FROM r WHERE n <= 40) ORDER BY late, n, pos DESC LIMIT 40""")
def balanced_pos_neg(spark, sf):
    d = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("pos"))
    return ranking.balanced(d, "pos", "doc_id", 2, 40).select("doc_id", "pos")


_B = "CAST('0x' || sha256({})[1:8] AS BIGINT)"


@query(f"""WITH b AS (SELECT doc_id, {_B.format("'' || doc_id")} % 10000 AS a, {_B.format("'generic:' || doc_id")} % 1000 AS g, {_B.format("'distill:' || doc_id")} % 1000 AS d FROM documents)
SELECT doc_id, CASE WHEN a < 9500 THEN 'train' WHEN a < 9750 THEN 'validation' ELSE 'test' END AS plain, CASE WHEN g < 900 THEN 'train' WHEN g < 950 THEN 'validation' ELSE 'test' END AS generic,
CASE WHEN d < 800 THEN 'train' WHEN d < 900 THEN 'validation' ELSE 'test' END AS distilled FROM b""")
def stable_split_buckets(spark, sf):
    i = F.col("doc_id")
    return _docs(spark, sf).select(
        "doc_id", hashing.split(i, [(9500, "train"), (9750, "validation")], "test", 10000).alias("plain"),
        hashing.split(i, [(900, "train"), (950, "validation")], "test", 1000, "generic:").alias("generic"), hashing.split(i, [(800, "train"), (900, "validation")], "test", 1000, "distill:").alias("distilled"),
    )


@query("""SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN 'source:' || source WHEN lang <> 'en' THEN 'lang:' || lang ELSE 'digest:' || sha256(text)[1:20] END AS split_group,
CASE WHEN source IN ('src0', 'src1') THEN 'source' WHEN lang <> 'en' THEN 'lang' ELSE 'digest' END AS group_source, CASE WHEN source IN ('src0', 'src1') THEN 'low' WHEN lang <> 'en' THEN 'medium' ELSE 'high' END AS risk FROM documents""")
def split_group_ladder(spark, sf):
    d = table(spark, sf, "documents")
    group, source = splits.split_group(("source", F.when(F.col("source").isin("src0", "src1"), F.col("source"))), ("lang", F.when(F.col("lang") != "en", F.col("lang"))), ("digest", F.substring(F.sha2("text", 256), 1, 20)))
    risk = ladders.ladder((F.col("group_source") == "source", "low"), (F.col("group_source") == "lang", "medium"), otherwise="high")
    return d.select("doc_id", group.alias("split_group"), source.alias("group_source")).withColumn("risk", risk)


@query("""WITH d AS (SELECT doc_id, sha256(text) AS g FROM documents), h AS (SELECT DISTINCT g FROM d JOIN labels USING (doc_id) WHERE quality = 0)
SELECT d.doc_id, h.g IS NOT NULL AS quarantined FROM d LEFT JOIN h USING (g) WHERE d.doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)""")
def partition_quarantine(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("g"))
    gold = table(spark, sf, "labels").filter("quality = 0").select("doc_id")
    return splits.quarantine(d.join(gold, "doc_id", "left_anti"), d.join(gold, "doc_id", "left_semi"), "g").select("doc_id", "quarantined")


@query(f"""WITH d AS (SELECT sha256(text) AS g, CASE WHEN {_B.format("'' || doc_id")} % 1000 < 800 THEN 'train' WHEN {_B.format("'' || doc_id")} % 1000 < 900 THEN 'validation' ELSE 'test' END AS s FROM documents)
SELECT g AS identity, array_to_string(list_sort(list_distinct(list(s))), ',') AS splits FROM d GROUP BY g HAVING count(DISTINCT s) > 1""")
def leakage_audit(spark, sf):
    d = table(spark, sf, "documents").select(F.sha2("text", 256).alias("identity"), hashing.split(F.col("doc_id"), [(800, "train"), (900, "validation")], "test", 1000).alias("s"))
    return splits.leaks(d, "identity", "s").select("identity", F.array_join("splits", ",").alias("splits"))


@query("""WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source), m AS (SELECT sum(sqrt(n)) / sum(n) AS mean FROM n) SELECT doc_id, round(greatest(0.25, least(4.0, 1 / sqrt(n) / mean)), 6) AS weight FROM documents JOIN n USING (source), m""")
def sampling_weights(spark, sf):
    return labels.sampling_weights(_docs(spark, sf, "source"), "source").select("doc_id", r6(F.col("weight")).alias("weight"))


@query("""WITH d AS (SELECT doc_id, lang, source, n_chars FROM documents), k AS (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256('1:' || doc_id), doc_id) AS r FROM d)
SELECT d.doc_id, k.doc_id AS donor FROM d JOIN (SELECT lang, max(r) AS n FROM k GROUP BY lang) c USING (lang) JOIN k ON k.lang = d.lang AND k.r = 1 + d.n_chars % c.n WHERE k.source <> d.source""")
def donor_other_group(spark, sf):
    """A donor of the same language and another source: the donor's place in a ranked list, so an equi-join, no cross join."""
    d = _docs(spark, sf, "lang", "source", "n_chars")
    w = W.partitionBy("lang").orderBy(hashing.rank(F.col("doc_id"), 1), "doc_id")
    k = d.select("lang", F.col("source").alias("s"), F.col("doc_id").alias("donor"), F.row_number().over(w).cast("bigint").alias("r"))
    n = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    j = d.join(n, "lang").withColumn("r", 1 + F.col("n_chars") % F.col("n")).join(k, ["lang", "r"])
    return j.filter("s <> source").select("doc_id", "donor")


@query("""WITH t AS (SELECT p_partkey, trim(regexp_replace(lower(regexp_replace(regexp_replace(p_name || ' ' || p_type, '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '[_-]', ' ', 'g')), '\\s+', ' ', 'g')) AS t FROM part)
SELECT p_partkey, t AS normalised, array_to_string(list_sort(list_filter([CASE WHEN regexp_matches(t, '(^|[^a-z0-9])(steel|tin|brass)([^a-z0-9]|$)') THEN 'metal' END, CASE WHEN regexp_matches(t, '(^|[^a-z0-9])(small|medium|large)([^a-z0-9]|$)') THEN 'size' END,
CASE WHEN regexp_matches(t, '(^|[^a-z0-9])(polished|plated|anodized|burnished|brushed)([^a-z0-9]|$)') THEN 'finish' END], lambda x: x IS NOT NULL)), ',') AS labels FROM t""")
def taxonomy_match(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", text.normalise(F.concat_ws(" ", "p_name", "p_type")).alias("normalised"))
    found = text.labels(F.col("normalised"), {"metal": ["steel", "tin", "brass"], "size": ["small", "medium", "large"], "finish": ["polished", "plated", "anodized", "burnished", "brushed"]})
    return t.select("p_partkey", "normalised", F.array_join(found, ",").alias("labels"))


@query("""WITH p AS (SELECT page_id, url, string_split(regexp_replace(url, '^https?://', ''), '/') AS s FROM pages)
SELECT page_id, s[1] AS host, CASE WHEN len(s) >= 2 AND s[2] <> '' THEN s[2] ELSE 'unknown' END AS section, regexp_extract(url, '([0-9]+)', 1) AS item, url LIKE 'https:%' AS secure FROM p""")
def uri_identity_recovery(spark, sf):
    s = F.split(F.regexp_replace("url", "^https?://", ""), "/")
    p = table(spark, sf, "pages").select("page_id", "url", s.alias("s"))
    section = F.coalesce(F.when(F.get("s", F.lit(1)) != "", F.get("s", F.lit(1))), F.lit("unknown"))
    return p.select("page_id", F.get("s", F.lit(0)).alias("host"), section.alias("section"), F.regexp_extract("url", "([0-9]+)", 1).alias("item"), F.startswith("url", F.lit("https:")).alias("secure"))


@query("SELECT page_id, len(string_split(regexp_replace(url, '^https?://[^/]*', ''), '/')) - 1 AS depth FROM pages WHERE len(string_split(regexp_replace(url, '^https?://[^/]*', ''), '/')) - 1 <= 2 AND url NOT LIKE '%/.%'")
def listing_depth_filter(spark, sf):
    depth = F.size(F.split(F.regexp_replace("url", "^https?://[^/]*", ""), "/")) - 1
    return table(spark, sf, "pages").select("page_id", "url", depth.alias("depth")).filter((F.col("depth") <= 2) & ~F.contains("url", F.lit("/."))).select("page_id", "depth")


@query("""SELECT doc_id, CASE WHEN n_chars < 200 THEN 'metadata_blocked' WHEN n_chars > 20000 THEN 'too_long' WHEN lang = 'en' AND source = 'src0' THEN 'human_review' WHEN lang = 'en' THEN 'auto_candidate' WHEN source IN ('src1', 'src2') THEN 'needs_labels' ELSE 'catalogued' END AS stage,
array_to_string(list_filter([CASE WHEN n_chars < 200 THEN 'short' END, CASE WHEN n_chars > 20000 THEN 'long' END, CASE WHEN lang <> 'en' THEN 'foreign' END], lambda x: x IS NOT NULL), ',') AS reasons FROM documents""")
def promotion_state_machine(spark, sf):
    n, en = F.col("n_chars"), F.col("lang") == "en"
    stage = ladders.ladder((n < 200, "metadata_blocked"), (n > 20000, "too_long"), (en & (F.col("source") == "src0"), "human_review"), (en, "auto_candidate"), (F.col("source").isin("src1", "src2"), "needs_labels"), otherwise="catalogued")
    return _docs(spark, sf, "lang", "source", "n_chars").select("doc_id", stage.alias("stage"), F.array_join(ladders.reasons(short=n < 200, long=n > 20000, foreign=~en), ",").alias("reasons"))


@query("""SELECT doc_id, lang = 'en' AS language_loss, n_chars BETWEEN 200 AND 20000 AS length_ok, CASE WHEN lang = 'en' AND n_chars BETWEEN 200 AND 20000 THEN 'text,contrastive' WHEN n_chars BETWEEN 200 AND 20000 THEN 'contrastive' ELSE '' END AS objectives,
CASE WHEN lang = 'en' THEN 'declared' WHEN source = 'src0' THEN 'derived' ELSE 'missing' END AS provenance FROM documents""")
def training_contract_struct(spark, sf):
    en, ok = F.col("lang") == "en", F.col("n_chars").between(200, 20000)
    supported = F.when(ok, F.array(F.lit("text"), F.lit("contrastive"))).otherwise(F.array().cast("array<string>"))
    enabled = F.array_compact(F.array(F.when(en, F.lit("text")), F.lit("contrastive")))
    return _docs(spark, sf, "lang", "source", "n_chars").select("doc_id", en.alias("language_loss"), ok.alias("length_ok"), F.array_join(F.array_intersect(supported, enabled), ",").alias("objectives"), ladders.ladder((en, "declared"), (F.col("source") == "src0", "derived"), otherwise="missing").alias("provenance"))


@query(f"""SELECT doc_id, coalesce(CASE WHEN lang <> 'fr' THEN lang END, source, 'unknown') AS identity, lang = 'fr' AS inferred, round({_B.format("'4:0:' || doc_id")} / 4294967296.0 * greatest(0, n_chars - 100), 4) AS start FROM documents""")
def provenance_defaults(spark, sf):
    u = F.conv(F.substring(F.sha2(F.concat(F.lit("4:0:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("bigint") / 4294967296.0
    return _docs(spark, sf, "lang", "source", "n_chars").select("doc_id", F.coalesce(F.when(F.col("lang") != "fr", F.col("lang")), "source", F.lit("unknown")).alias("identity"), (F.col("lang") == "fr").alias("inferred"), F.round(u * F.greatest(F.lit(0), F.col("n_chars") - 100), 4).alias("start"))


@query("SELECT doc_id, coalesce(trim(text), '') <> '' AS nonempty, n_chars = length(text) AS count_matches, lang IN ('en', 'de') AND n_chars > 500 AS candidate FROM documents")
def predicate_flags(spark, sf):
    return table(spark, sf, "documents").select("doc_id", (F.coalesce(F.trim("text"), F.lit("")) != "").alias("nonempty"), (F.col("n_chars") == F.length("text")).alias("count_matches"), (F.col("lang").isin("en", "de") & (F.col("n_chars") > 500)).alias("candidate"))


@query("""WITH s AS (SELECT source, list_sort(list_distinct(list(lang))) AS langs FROM documents GROUP BY source) SELECT source, array_to_string(langs, ',') AS langs, len(list_filter(['en', 'fr', 'de', 'es'], lambda x: NOT list_contains(langs, x))) AS missing FROM s""")
def use_intersection(spark, sf):
    s = _docs(spark, sf, "source", "lang").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("l"))
    return s.select("source", F.array_join("l", ",").alias("langs"), F.size(F.array_except(F.array(*map(F.lit, ("en", "fr", "de", "es"))), "l")).alias("missing"))


@query("SELECT lang, source, grouping(lang) AS all_langs, grouping(source) AS all_sources, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, count(*) FILTER (n_chars > 2000) AS long FROM documents GROUP BY GROUPING SETS ((lang, source), (lang), (source), ())")
def counter_rollup(spark, sf):
    d = _docs(spark, sf, "lang", "source", "n_chars").cube("lang", "source")
    return d.agg(F.grouping("lang").cast("bigint").alias("all_langs"), F.grouping("source").cast("bigint").alias("all_sources"), F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.count_if(F.col("n_chars") > 2000).alias("long"))


@query("""WITH r AS (SELECT doc_id, lang, source, n_chars, row_number() OVER (PARTITION BY lang ORDER BY sha256('6:' || doc_id), doc_id) AS r, row_number() OVER (PARTITION BY lang, source ORDER BY sha256('6:' || doc_id), doc_id) AS rs,
row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, sha256('6:' || doc_id), doc_id) AS longest FROM documents)
SELECT doc_id, r <= 5 AS by_language, rs <= 2 AS by_stratum, longest <= 3 AS evidence, ['blur', 'noise', 'crop'][1 + rs % 3] AS family FROM r WHERE r <= 5 OR rs <= 2 OR longest <= 3""")
def balanced_variants(spark, sf):
    rank = hashing.rank(F.col("doc_id"), 6)
    d = _docs(spark, sf, "lang", "source", "n_chars").withColumn("k", rank)
    r = d.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("k", "doc_id"))).withColumn("rs", F.row_number().over(W.partitionBy("lang", "source").orderBy("k", "doc_id")))
    r = r.withColumn("longest", F.row_number().over(W.partitionBy("lang").orderBy(F.col("n_chars").desc(), "k", "doc_id"))).filter("r <= 5 OR rs <= 2 OR longest <= 3")
    return r.select("doc_id", (F.col("r") <= 5).alias("by_language"), (F.col("rs") <= 2).alias("by_stratum"), (F.col("longest") <= 3).alias("evidence"), F.element_at(F.array(*map(F.lit, ("blur", "noise", "crop"))), 1 + F.col("rs") % 3).alias("family"))


@query("""WITH p AS (SELECT doc_id, 'positive' AS kind, row_number() OVER (ORDER BY sha256('8:' || doc_id)) AS r FROM labels WHERE quality = 0), c AS (SELECT doc_id, 'control' AS kind, row_number() OVER (ORDER BY sha256('8:' || doc_id)) AS r FROM labels WHERE quality = 1),
n AS (SELECT count(*) AS n FROM p) SELECT doc_id, kind FROM p, n WHERE r <= 60 UNION ALL SELECT doc_id, kind FROM c, n WHERE r <= 100 - least(n, 60)""")
def union_quota_spill(spark, sf):
    """100 rows, up to 60 of them positives; what positives leave goes to controls."""
    d = table(spark, sf, "labels").select("doc_id", "quality", hashing.rank(F.col("doc_id"), 8).alias("k"))
    take = lambda q, kind, n: d.filter(F.col("quality") == q).orderBy("k").limit(n).select("doc_id", F.lit(kind).alias("kind"), "k")
    p, c = take(0, "positive", 60), take(1, "control", 100)
    n = p.agg(F.count(F.lit(1)).alias("n"))
    c = c.withColumn("r", F.row_number().over(W.orderBy("k"))).crossJoin(F.broadcast(n)).filter("r <= 100 - n")
    return p.select("doc_id", "kind").unionByName(c.select("doc_id", "kind"))


@query("""SELECT page_id, 'clip-' || sha256(url || '|' || page_id)[1:16] AS clip_id, 'task-' || sha256('pages|' || page_id)[1:12] AS task_id, regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g') AS component FROM pages""")
def stable_ids(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", hashing.short_id("clip-", 16, F.col("url"), F.col("page_id")).alias("clip_id"), hashing.short_id("task-", 12, F.lit("pages"), F.col("page_id")).alias("task_id"), F.regexp_replace("url", "[^A-Za-z0-9._-]+", "_").alias("component"))


@query("""SELECT page_id, regexp_matches(html, '<article') AS has_article, regexp_matches(html, '<script') AS has_script, regexp_extract(html, 'lang="([a-z]+)"', 1) AS declared, coalesce(nullif(regexp_extract(html, 'lang="([a-z]+)"', 1), ''), regexp_extract(url, '/([a-z][a-z])/', 1)) AS lang FROM pages""")
def sidecar_capability_infer(spark, sf):
    declared = F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    return table(spark, sf, "pages").select("page_id", F.contains("html", F.lit("<article")).alias("has_article"), F.contains("html", F.lit("<script")).alias("has_script"), declared.alias("declared"), F.coalesce(F.nullif(declared, F.lit("")), F.regexp_extract("url", "/([a-z][a-z])/", 1)).alias("lang"))


@query("""WITH g AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source), r AS (SELECT *, sum(n) OVER (PARTITION BY lang ORDER BY sha256('4:' || lang || '/' || source) ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER (PARTITION BY lang) AS total FROM g)
SELECT lang, source, n, CASE WHEN (upto - n) < 0.1 * total THEN 'test' WHEN (upto - n) < 0.2 * total THEN 'validation' ELSE 'train' END AS partition FROM r""")
def greedy_partition(spark, sf):
    """Whole groups, in hash order, fill test and then validation to their share of each stratum."""
    g = _docs(spark, sf, "lang", "source").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    order = F.sha2(F.concat(F.lit("4:"), F.col("lang"), F.lit("/"), F.col("source")), 256)
    w = W.partitionBy("lang")
    r = g.withColumn("before", F.sum("n").over(w.orderBy(order).rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).withColumn("total", F.sum("n").over(w))
    return r.select("lang", "source", "n", ladders.ladder((F.col("before") < 0.1 * F.col("total"), "test"), (F.col("before") < 0.2 * F.col("total"), "validation"), otherwise="train").alias("partition"))


# ---- conversations ----


@query("""WITH t AS (SELECT conv_id, role, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY conv_id, role), w AS (SELECT conv_id, arg_max(role, (chars, role)) AS main FROM t GROUP BY conv_id)
SELECT main, count(*) AS conversations FROM w GROUP BY main""")
def review_stats_grouping(spark, sf):
    t = table(spark, sf, "conversations").groupBy("conv_id", "role").agg(F.sum(F.length("text")).alias("chars"))
    main = t.groupBy("conv_id").agg(F.max_by("role", F.struct("chars", "role")).alias("main"))
    return main.groupBy("main").agg(F.count(F.lit(1)).alias("conversations"))


@query("""SELECT conv_id, CASE WHEN max(turn) FILTER (role = 'system') IS NOT NULL AND max(turn) > 5 THEN 'done' WHEN max(turn) FILTER (role = 'user') IS NULL THEN 'free' WHEN max(turn) FILTER (role = 'user') + 2 > 5 THEN 'busy' ELSE 'expired' END AS state, max(turn) FILTER (role = 'user') AS last FROM conversations GROUP BY conv_id""")
def lease_replay(spark, sf):
    from ..operators import control

    c = table(spark, sf, "conversations")
    n = c.groupBy("conv_id").agg(F.max("turn").alias("m"), F.bool_or(F.col("role") == "system").alias("s")).filter("s AND m > 5").select("conv_id", F.lit(0).cast("bigint").alias("turn"), F.lit("done").alias("kind"))
    events = c.select("conv_id", "turn", F.when(F.col("role") == "user", "claim").otherwise("other").alias("kind")).unionByName(n)
    return control.lease_state(events, "conv_id", "turn", "kind", F.lit(5), 2).select("conv_id", "state", "last")


@query("""WITH w AS (SELECT conv_id, role, list_distinct(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: length(x) >= 7)) AS words FROM conversations WHERE turn <= 1 AND role IN ('user', 'assistant')),
a AS (SELECT conv_id, words FROM w WHERE role = 'user'), b AS (SELECT conv_id, words FROM w WHERE role = 'assistant')
SELECT conv_id, len(list_filter(b.words, lambda x: NOT list_contains(a.words, x))) AS added, len(list_filter(a.words, lambda x: NOT list_contains(b.words, x))) AS removed FROM a JOIN b USING (conv_id)""")
def paired_set_changes(spark, sf):
    words = F.array_distinct(F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: F.length(x) >= 7))
    w = table(spark, sf, "conversations").filter("turn <= 1 AND role IN ('user', 'assistant')").select("conv_id", "role", words.alias("w"))
    j = w.filter("role = 'user'").select("conv_id", F.col("w").alias("a")).join(w.filter("role = 'assistant'").select("conv_id", F.col("w").alias("b")), "conv_id")
    return j.select("conv_id", F.size(F.array_except("b", "a")).alias("added"), F.size(F.array_except("a", "b")).alias("removed"))


@query("""SELECT conv_id, turn, round(least(greatest(length(text) / 100.0, 0.5), 8.0), 6) AS "end", length(text) / 100.0 > 8.0 AS clamped FROM conversations""")
def finding_time_clamp(spark, sf):
    raw = F.length("text") / 100.0
    return table(spark, sf, "conversations").select("conv_id", "turn", r6(F.least(F.greatest(raw, F.lit(0.5)), F.lit(8.0))).alias("end"), (raw > 8.0).alias("clamped"))


@query("""WITH s AS (SELECT conv_id, max(turn) + 1 AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY conv_id) SELECT s.conv_id, turns, chars, lang, source, CASE WHEN lang IS NULL THEN 'unmatched' ELSE 'matched' END AS state FROM s LEFT JOIN documents ON doc_id = s.conv_id""")
def review_record_assembly(spark, sf):
    s = table(spark, sf, "conversations").groupBy("conv_id").agg((F.max("turn") + 1).alias("turns"), F.sum(F.length("text")).alias("chars"))
    d = _docs(spark, sf, "lang", "source").withColumnRenamed("doc_id", "conv_id")
    return s.join(d, "conv_id", "left").withColumn("state", ladders.ladder((F.col("lang").isNull(), "unmatched"), otherwise="matched"))


@query("SELECT conv_id, turn, role, place FROM (SELECT *, row_number() OVER (ORDER BY CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END, conv_id, turn) AS place FROM conversations) WHERE place <= 500")
def severity_ordered_report(spark, sf):
    order = [F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1).otherwise(2), F.col("conv_id"), F.col("turn")]
    top = table(spark, sf, "conversations").select("conv_id", "turn", "role").orderBy(*order).limit(500)
    return top.withColumn("place", F.row_number().over(W.orderBy(*order)))


@query("""WITH u AS (SELECT conv_id, turn, role, length(text) AS n, 0 AS v FROM conversations WHERE role <> 'assistant' UNION ALL SELECT conv_id, turn, 'edited', length(text) + 1, 1 FROM conversations WHERE turn % 2 = 0)
SELECT conv_id, turn, arg_max(role, v) AS role, arg_max(n, v) AS n FROM u GROUP BY conv_id, turn""")
def upsert_latest_view(spark, sf):
    from ..operators import control

    c = table(spark, sf, "conversations").withColumn("key", F.struct("conv_id", "turn"))
    base = c.filter("role <> 'assistant'").select("key", "role", F.length("text").alias("n"))
    changes = c.filter("turn % 2 = 0").select("key", F.lit("edited").alias("role"), (F.length("text") + 1).alias("n"))
    return control.upsert(base, changes, "key").select("key.conv_id", "key.turn", "role", "n")
