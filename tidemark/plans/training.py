"""Labels, weak pools and evaluation. Scores are a digest of doc_id, so they are the same everywhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, ladders
from ..functions.stats import r6, wilson
from ..operators import evaluation, labels
from ..sources.tables import table
from .registry import query

#: Scored labels in SQL: p in thousandths of a digest, moved towards the label.
S = """s AS (SELECT l.doc_id, lang, source, quality AS label, toxic, (CAST('0x' || sha256('p:' || l.doc_id)[1:8] AS BIGINT) % 700 + 300 * quality) / 1000.0 AS p FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""
_C = "CAST(coalesce(sum(CASE WHEN p >= {t} AND label = 1 THEN 1 END), 0) AS BIGINT) AS tp, CAST(coalesce(sum(CASE WHEN p >= {t} AND label = 0 THEN 1 END), 0) AS BIGINT) AS fp, CAST(coalesce(sum(CASE WHEN p < {t} AND label = 1 THEN 1 END), 0) AS BIGINT) AS fn, CAST(coalesce(sum(CASE WHEN p < {t} AND label = 0 THEN 1 END), 0) AS BIGINT) AS tn"
_W = "({p} + {z2} / (2 * {n}) {sign} 1.959963984540054 * sqrt({p} * (1 - {p}) / {n} + {z2} / (4 * {n} * {n}))) / (1 + {z2} / {n})"
_Z2 = "3.8414588206941236"


def _wilson(k, n, sign):
    return _W.format(p=f"({k} / {n}::DOUBLE)", n=f"({n})::DOUBLE", z2=_Z2, sign=sign)


def scored(spark, sf):
    p = (hashing.bucket(F.col("doc_id"), 700, "p:") + 300 * F.col("quality")) / 1000.0
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return table(spark, sf, "labels").join(d, "doc_id").select("doc_id", "lang", "source", F.col("quality").alias("label"), "toxic", p.alias("p"))


@query(f"""WITH {S}, c AS (SELECT lang, {_C.format(t=0.5)} FROM s GROUP BY lang)
SELECT lang, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall, round(tn / nullif(tn + fp, 0)::DOUBLE, 6) AS specificity, round(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 6) AS f1,
CASE WHEN tp + fp > 0 THEN round(greatest(0, {_wilson('tp', '(tp + fp)', '-')}), 6) END AS precision_low FROM c""")
def confusion_metrics(spark, sf):
    c = scored(spark, sf).groupBy("lang").agg(*evaluation.confusion(F.col("p"), F.col("label"), 0.5).values())
    m = evaluation.with_metrics(c)
    return m.select("lang", "tp", "fp", "fn", "tn", *[r6(F.col(x)).alias(x) for x in ("precision", "recall", "specificity", "f1", "precision_low")])


@query(f"""WITH {S}, g AS (SELECT lang, p, count(*) AS n, sum(label) AS pos FROM s GROUP BY lang, p),
w AS (SELECT *, sum(n) OVER d AS cn, sum(pos) OVER d AS ctp, coalesce(sum(n - pos) OVER (PARTITION BY lang ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g WINDOW d AS (PARTITION BY lang ORDER BY p DESC ROWS UNBOUNDED PRECEDING))
SELECT lang, round(sum(pos * (below + (n - pos) / 2.0)) / nullif(sum(pos) * sum(n - pos), 0), 6) AS auroc, round(sum(pos * (ctp / cn::DOUBLE)) / nullif(sum(pos), 0), 6) AS average_precision FROM w GROUP BY lang""")
def average_precision_auroc(spark, sf):
    m = evaluation.ranking_metrics(scored(spark, sf), ["lang"])
    return m.select("lang", r6(F.col("auroc")).alias("auroc"), r6(F.col("average_precision")).alias("average_precision"))


@query(f"""WITH {S}, b AS (SELECT least(floor(p * 15), 14) AS bin, count(*) AS n, avg(p) AS c, avg(label) AS a, sum((p - label) * (p - label)) AS q FROM s GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(q) / sum(n), 6) AS brier, round(sum(abs(c - a) * n) / sum(n), 6) AS ece FROM b""")
def calibration_ece(spark, sf):
    return evaluation.calibration(scored(spark, sf), 15).select("n", r6(F.col("brier")).alias("brier"), r6(F.col("ece")).alias("ece"))


@query(f"""WITH {S}, g AS (SELECT p, count(*) AS n, sum(label) AS pos FROM s GROUP BY p), t AS (SELECT p, sum(n) OVER d AS selected, sum(pos) OVER d AS tp, (SELECT sum(pos) FROM g) AS positives FROM g WINDOW d AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
w AS (SELECT *, greatest(0, {_wilson('tp', 'selected', '-')}) AS lower, tp / positives::DOUBLE AS recall FROM t)
SELECT round(p, 6) AS threshold, CAST(selected AS BIGINT) AS selected, CAST(tp AS BIGINT) AS tp, round(recall, 6) AS recall, round(lower, 6) AS lower FROM w WHERE lower >= 0.88 ORDER BY w.recall DESC, w.lower DESC, p LIMIT 1""")
def threshold_search(spark, sf):
    t = evaluation.select_threshold(scored(spark, sf), 0.88)
    return t.select(r6(F.col("threshold")).alias("threshold"), "selected", "tp", r6(F.col("recall")).alias("recall"), r6(F.col("lower")).alias("lower"))


@query(f"""WITH {S}, g AS (SELECT *, row_number() OVER (ORDER BY k) AS place, count(*) OVER () AS n FROM (SELECT 'batch:' || doc_id % 37 AS k, {_C.format(t=0.5)} FROM s GROUP BY 1)),
d AS (SELECT r, CAST('0x' || sha256('3:' || r || ':' || j)[1:13] AS BIGINT) % n + 1 AS place FROM (SELECT any_value(n) AS n FROM g), (SELECT unnest(range(200)) AS r), (SELECT unnest(range(n)) AS j FROM (SELECT any_value(n) AS n FROM g))),
x AS (SELECT r, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM d JOIN g USING (place) GROUP BY r),
m AS (SELECT tp / nullif(tp + fp, 0)::DOUBLE AS p, tp / nullif(tp + fn, 0)::DOUBLE AS c, 2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE AS f FROM x)
SELECT {', '.join(f'round(quantile_cont({c}, {q}), 6) AS {name}_{end}' for c, name in (('p', 'precision'), ('c', 'recall'), ('f', 'f1')) for q, end in ((0.025, 'low'), (0.975, 'high')))} FROM m""")
def cluster_bootstrap_ci(spark, sf):
    s = scored(spark, sf).withColumn("batch", F.col("doc_id") % 37)
    b = evaluation.cluster_bootstrap(s, evaluation.identity_group("batch"), 0.5, 200, 3)
    return b.select(*[r6(F.col(c)).alias(c) for c in b.columns])


@query(f"""WITH {S}, g AS (SELECT lang, source, grouping(lang) AS gl, count(*) AS n, {_C.format(t=0.5)} FROM s GROUP BY GROUPING SETS ((lang), (source))),
m AS (SELECT CASE WHEN gl = 0 THEN 'lang' ELSE 'source' END AS field, coalesce(lang, source) AS value, n, round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision FROM g)
SELECT field, value, n, precision, n >= 30 AND precision = min(CASE WHEN n >= 30 THEN precision END) OVER (PARTITION BY field) AS worst FROM m""")
def group_reports_worst(spark, sf):
    from pyspark.sql import Window as W

    s = scored(spark, sf)
    s = s.select("p", "label", F.explode(F.array(F.struct(F.lit("lang").alias("field"), F.col("lang").alias("value")), F.struct(F.lit("source").alias("field"), F.col("source").alias("value")))).alias("g"))
    c = s.groupBy("g.field", "g.value").agg(F.count(F.lit(1)).alias("n"), *evaluation.confusion(F.col("p"), F.col("label"), 0.5).values())
    m = evaluation.with_metrics(c).select("field", "value", "n", r6(F.col("precision")).alias("precision"))
    lowest = F.min(F.when(F.col("n") >= 30, F.col("precision"))).over(W.partitionBy("field"))
    return m.withColumn("worst", (F.col("n") >= 30) & (F.col("precision") == lowest))


@query("""SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL THEN 'human' WHEN source = 'src3' THEN 'teacher' WHEN n_chars < 300 THEN 'programmatic' ELSE 'none' END AS source,
CAST(CASE WHEN l.quality IS NOT NULL THEN l.quality WHEN source = 'src3' THEN 0.8 WHEN n_chars < 300 THEN 0.2 END AS DOUBLE) AS value, CASE WHEN l.quality IS NOT NULL THEN 1.0 WHEN source = 'src3' THEN 0.25 WHEN n_chars < 300 THEN 0.1 ELSE 0.0 END::DOUBLE AS weight FROM documents d LEFT JOIN labels l USING (doc_id)""")
def label_precedence(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("source").alias("s"), "n_chars").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    chosen = labels.precedence([("human", F.col("quality"), F.lit(1.0)), ("teacher", F.when(F.col("s") == "src3", 0.8), F.lit(0.25)), ("programmatic", F.when(F.col("n_chars") < 300, 0.2), F.lit(0.1))])
    d = d.withColumn("c", chosen)
    return d.select("doc_id", F.coalesce("c.source", F.lit("none")).alias("source"), F.col("c.value").alias("value"), F.coalesce("c.weight", F.lit(0.0)).alias("weight"))


@query(f"""WITH {S} SELECT doc_id, CASE WHEN p >= 0.8 THEN 'strong_positive' WHEN p <= 0.2 THEN 'strong_negative' ELSE 'soft' END AS band, round(0.5 * abs(p - 0.5) * 2, 6) AS weight FROM s WHERE toxic = 0""")
def weak_pool_bands(spark, sf):
    s = scored(spark, sf).filter("toxic = 0")
    return s.select("doc_id", labels.bands(F.col("p"), 0.8, 0.2).alias("band"), r6(0.5 * F.abs(F.col("p") - 0.5) * 2).alias("weight"))


@query(f"""WITH {S} SELECT doc_id, CASE WHEN toxic = 1 THEN 'skip_source' WHEN p BETWEEN 0.45 AND 0.55 THEN 'review' WHEN (p >= 0.5)::INT <> label THEN 'disagreement' ELSE 'train' END AS route, round(least(0.25, 0.5 * p), 6) AS weight FROM s""")
def weak_pool_teacher(spark, sf):
    p = F.col("p")
    route = ladders.ladder((F.col("toxic") == 1, "skip_source"), (p.between(0.45, 0.55), "review"), ((p >= 0.5).cast("int") != F.col("label"), "disagreement"), otherwise="train")
    return scored(spark, sf).select("doc_id", route.alias("route"), r6(F.least(F.lit(0.25), 0.5 * p)).alias("weight"))


@query("SELECT source, count(*) AS labelled, count(*) FILTER (quality = 1) AS positive, count(*) FILTER (toxic = 1) AS toxic, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'fr') AS fr, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'es') AS es FROM labels JOIN documents USING (doc_id) GROUP BY source")
def coverage_pivot(spark, sf):
    s = scored(spark, sf)
    n = s.groupBy("source").agg(F.count(F.lit(1)).alias("labelled"), F.count_if(F.col("label") == 1).alias("positive"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    by = s.groupBy("source").pivot("lang", ["en", "fr", "de", "es"]).count().na.fill(0)
    return n.join(by, "source")


@query("""SELECT l.doc_id, array_to_string(list_filter([CASE WHEN d.doc_id IS NULL THEN 'identity_missing' END, CASE WHEN quality = 0 AND toxic = 0 THEN 'unexplained_negative' END, CASE WHEN quality = 1 AND toxic = 1 THEN 'contradiction' END], lambda x: x IS NOT NULL), ',') AS issues FROM labels l LEFT JOIN documents d USING (doc_id)""")
def gold_contract_issues(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.lit(True).alias("there"))
    j = table(spark, sf, "labels").join(d, "doc_id", "left")
    q, t = F.col("quality"), F.col("toxic")
    found = ladders.reasons(identity_missing=F.col("there").isNull(), unexplained_negative=(q == 0) & (t == 0), contradiction=(q == 1) & (t == 1))
    return j.select("doc_id", F.array_join(found, ",").alias("issues"))


@query(f"""WITH {S}, m AS (SELECT lang, round(avg(abs(p - label)), 6) AS mae, {_C.format(t=0.5)}, count(*) AS n FROM s GROUP BY lang)
SELECT lang, n, mae, round((tp / nullif(tp + fn, 0)::DOUBLE + tn / nullif(tn + fp, 0)::DOUBLE) / 2, 6) AS balanced_accuracy FROM m""")
def comparison_table(spark, sf):
    c = scored(spark, sf).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), r6(F.avg(F.abs(F.col("p") - F.col("label")))).alias("mae"), *evaluation.confusion(F.col("p"), F.col("label"), 0.5).values())
    m = evaluation.with_metrics(c)
    return m.select("lang", "n", "mae", r6((F.col("recall") + F.col("specificity")) / 2).alias("balanced_accuracy"))


@query(f"""WITH {S} SELECT doc_id, task, label, round(p, 6) AS p, (p >= 0.5)::INT = label AS agrees FROM (SELECT doc_id, 'quality' AS task, label, p FROM s UNION ALL SELECT doc_id, 'toxic', toxic, 1 - p FROM s)""")
def pred_gold_pairs(spark, sf):
    pairs = F.explode(F.array(F.struct(F.lit("quality").alias("task"), F.col("label").alias("label"), F.col("p").alias("p")), F.struct(F.lit("toxic").alias("task"), F.col("toxic").alias("label"), (1 - F.col("p")).alias("p"))))
    s = scored(spark, sf).select("doc_id", pairs.alias("x"))
    return s.select("doc_id", "x.task", "x.label", r6(F.col("x.p")).alias("p"), ((F.col("x.p") >= 0.5).cast("int") == F.col("x.label")).alias("agrees"))


@query("""SELECT coalesce(d.lang, 'none') AS lang, count(*) FILTER (l.doc_id IS NULL) AS without_label, count(*) FILTER (l.doc_id IS NOT NULL) AS with_label FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def overlay_unmatched(spark, sf):
    j = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.groupBy(F.coalesce("lang", F.lit("none")).alias("lang")).agg(F.count_if(F.col("quality").isNull()).alias("without_label"), F.count_if(F.col("quality").isNotNull()).alias("with_label"))


@query("SELECT doc_id, quality, CASE WHEN quality = 1 THEN 'v2' ELSE 'v1' END AS schema_version FROM labels WHERE quality = 1 AND doc_id IN (SELECT doc_id FROM documents WHERE source <> 'src0')")
def label_file_lookup(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", "quality", ladders.ladder((F.col("quality") == 1, "v2"), otherwise="v1").alias("schema_version"))
    return lab.filter("schema_version = 'v2'").join(table(spark, sf, "documents").filter("source <> 'src0'").select("doc_id"), "doc_id", "left_semi")


@query(f"""WITH {S}, g AS (SELECT source, count(*) AS n, sum(label) AS k FROM s GROUP BY source) SELECT source, n, round(greatest(0, {_wilson('k', 'n', '-')}), 6) AS low, round(least(1, {_wilson('k', 'n', '+')}), 6) AS high FROM g""")
def wilson_intervals(spark, sf):
    g = scored(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k"))
    low, high = wilson(F.col("k"), F.col("n"))
    return g.select("source", "n", r6(low).alias("low"), r6(high).alias("high"))
