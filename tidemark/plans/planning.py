"""Catalogues of files and datasets: scans, routes, integrity, incremental plans, registry views, on orders and line items.

A dataset is an order; its files are its line items (size l_extendedprice, kind l_returnflag, present if l_linestatus = 'F').
"""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import hashing, ladders
from ..functions.stats import r6, ratio
from ..operators import control, intervals, labels, ranking, validation
from ..sources.tables import table
from .registry import query


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 40")
def scan_projection_filter(spark, sf):
    return table(spark, sf, "lineitem").filter("l_returnflag = 'R' AND l_quantity >= 40").select("l_orderkey", "l_partkey", "l_quantity")


@query("SELECT o_orderstatus AS project, count(*) AS n, count(DISTINCT o_custkey) AS customers, round(sum(o_totalprice), 2) AS total, round(avg(CASE WHEN o_totalprice < 50000 THEN 1.0 ELSE 0.0 END), 6) AS below FROM orders GROUP BY o_orderstatus")
def index_summary(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("project"))
    return o.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("total"), r6(F.avg((F.col("o_totalprice") < 50000).cast("double"))).alias("below"))


@query("SELECT DISTINCT printf('data/chunk-%03d/file-%03d.parquet', CAST(l_orderkey // 1000 AS INT), CAST(l_orderkey % 1000 // 10 AS INT)) AS path FROM lineitem")
def route_paths(spark, sf):
    k = F.col("l_orderkey")
    return table(spark, sf, "lineitem").select(F.format_string("data/chunk-%03d/file-%03d.parquet", F.floor(k / 1000), F.floor(k % 1000 / 10)).alias("path")).distinct()


@query("SELECT * FROM (SELECT o_orderkey, o_custkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderkey) AS matches FROM orders WHERE o_orderkey = 7) WHERE matches = 1")
def point_lookup_unique(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderkey = 7").select("o_orderkey", "o_custkey", "o_orderstatus")
    return o.withColumn("matches", F.count(F.lit(1)).over(W.partitionBy("o_orderkey"))).filter("matches = 1")


@query("SELECT c.c_custkey, coalesce(n.n_name, 'unknown') AS nation, coalesce(r.r_name, n.n_name, 'unknown') AS region FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey")
def broadcast_dim_coalesce(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")  # 25 and 5 rows by definition
    c = table(spark, sf, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return c.select("c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"), F.coalesce("r_name", "n_name", F.lit("unknown")).alias("region"))


_SPANS = "s AS (SELECT l_suppkey, l_orderkey, l_linenumber, datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS start, datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) AS \"end\" FROM lineitem)"


def _spans(spark, sf):
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    return table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", day.alias("start"), (day + F.col("l_quantity").cast("bigint")).alias("end"))


@query(f"""WITH {_SPANS} SELECT l_suppkey, l_orderkey, l_linenumber, coalesce(lag("end") OVER w > start, false) OR coalesce("end" > lead(start) OVER w, false) AS overlaps FROM s WINDOW w AS (PARTITION BY l_suppkey ORDER BY start, "end", l_orderkey, l_linenumber)""")
def interval_overlap_adjacent(spark, sf):
    return intervals.adjacent_overlaps(_spans(spark, sf), "l_suppkey", ["start", "end", "l_orderkey", "l_linenumber"]).select("l_suppkey", "l_orderkey", "l_linenumber", "overlaps")


_MERGED = _SPANS + """, a AS (SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY l_suppkey ORDER BY start, "end", l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS b FROM s),
g AS (SELECT *, sum(b) OVER (PARTITION BY l_suppkey ORDER BY start, "end", l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS g FROM a), m AS (SELECT l_suppkey, min(start) AS start, max("end") AS "end", count(*) AS n FROM g GROUP BY l_suppkey, g)"""


@query(f"""WITH {_MERGED} SELECT l_suppkey, start, "end", n FROM m""")
def merge_intervals(spark, sf):
    return intervals.merge(_spans(spark, sf), "l_suppkey")


@query(f"""WITH {_MERGED}, h AS (SELECT l_suppkey, "end" AS start, lead(start) OVER (PARTITION BY l_suppkey ORDER BY start) AS "end" FROM m)
SELECT l_suppkey, unnest(range(start, "end" - 1, 2)) AS control_start FROM h WHERE "end" - start >= 2""")
def gap_complement_controls(spark, sf):
    g = intervals.gaps(intervals.merge(_spans(spark, sf), "l_suppkey"), "l_suppkey").filter(F.col("end") - F.col("start") >= 2)
    return g.select("l_suppkey", F.explode(F.sequence(F.col("start"), F.col("end") - 2, F.lit(2).cast("bigint"))).alias("control_start"))


@query("SELECT l_orderkey AS file, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS decisions, count(DISTINCT l_suppkey) AS episodes, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey")
def file_rollup(spark, sf):
    g = table(spark, sf, "lineitem").filter("l_returnflag <> 'N'").groupBy(F.col("l_orderkey").alias("file"))
    return g.agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("decisions"), F.count_distinct("l_suppkey").alias("episodes"), F.count(F.lit(1)).alias("n"))


@query("""SELECT o.o_orderkey, o.o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linestatus = o.o_orderstatus)""")
def incremental_plan_antijoin(spark, sf):
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"))
    return control.plan(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), done, ["o_orderkey", "o_orderstatus"])


_SIG = "sha256(string_agg({}, chr(10) ORDER BY {}))"
_REC = "l_linenumber || '|' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '|' || l_returnflag"


@query(f"""WITH a AS (SELECT l_orderkey, {_SIG.format(_REC, _REC)} AS signature FROM lineitem GROUP BY l_orderkey),
b AS (SELECT l_orderkey, {_SIG.format(_REC, _REC)} AS old FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey)
SELECT l_orderkey, signature, CASE WHEN old IS NULL THEN 'new' WHEN old <> signature THEN 'stale' ELSE 'current' END AS state FROM a LEFT JOIN b USING (l_orderkey)""")
def signature_stale(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("bigint"))
    fields = ["l_linenumber", "l_quantity", "l_returnflag"]
    now, old = control.signature(li, "l_orderkey", fields), control.signature(li.filter("l_linestatus = 'F'"), "l_orderkey", fields).withColumnRenamed("signature", "old")
    return now.join(old, "l_orderkey", "left").select("l_orderkey", "signature", ladders.ladder((F.col("old").isNull(), "new"), (F.col("old") != F.col("signature"), "stale"), otherwise="current").alias("state"))


@query("""WITH l AS (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS run, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status, max(o_orderdate) AS last_at FROM orders GROUP BY o_custkey)
SELECT c_custkey, run, coalesce(status, 'never') AS status, last_at FROM customer LEFT JOIN l ON c_custkey = o_custkey""")
def latest_run_dashboard(spark, sf):
    o = labels.latest(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"), "o_custkey", "o_orderdate", "o_orderkey")
    j = table(spark, sf, "customer").select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.select("c_custkey", F.col("o_orderkey").alias("run"), F.coalesce("o_orderstatus", F.lit("never")).alias("status"), F.col("o_orderdate").alias("last_at"))


@query("SELECT l_returnflag AS kind, count(*) AS files, count(*) FILTER (l_linestatus = 'F') AS present, round(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END), 0), 2) AS bytes, count(DISTINCT l_orderkey) AS datasets FROM lineitem GROUP BY l_returnflag")
def registry_status(spark, sf):
    there = F.col("l_linestatus") == "F"
    g = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("kind"))
    return g.agg(F.count(F.lit(1)).alias("files"), F.count_if(there).alias("present"), F.round(F.coalesce(F.sum(F.when(there, F.col("l_extendedprice"))), F.lit(0.0)), 2).alias("bytes"), F.count_distinct("l_orderkey").alias("datasets"))


@query("""WITH h AS (SELECT median(l_extendedprice / l_quantity) AS rate FROM lineitem), b AS (SELECT l_returnflag, sum(l_extendedprice) AS bytes, count(*) AS files FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, round(bytes / rate + 0.02 * files, 4) AS eta, round(0.75 * (bytes / rate + 0.02 * files), 4) AS low, round(1.4 * (bytes / rate + 0.02 * files), 4) AS high FROM b, h""")
def eta_estimate(spark, sf):
    li = table(spark, sf, "lineitem")
    (rate,) = ranking.quantiles(li, F.col("l_extendedprice") / F.col("l_quantity"), [0.5])
    b = li.groupBy("l_returnflag").agg(F.sum("l_extendedprice").alias("bytes"), F.count(F.lit(1)).alias("files"))
    eta = F.col("bytes") / F.lit(rate).cast("double") + 0.02 * F.col("files")
    return b.select("l_returnflag", F.round(eta, 4).alias("eta"), F.round(0.75 * eta, 4).alias("low"), F.round(1.4 * eta, 4).alias("high"))


@query("SELECT o_orderkey, CAST(o_orderpriority[1:1] AS INT) AS priority, place FROM (SELECT *, row_number() OVER (ORDER BY o_orderpriority[1:1], sha256('11:' || o_orderkey)) AS place FROM orders) WHERE place <= 50")
def bounded_topk_priority(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), hashing.rank(F.col("o_orderkey"), 11).alias("r"))
    best = o.orderBy("priority", "r").limit(50)
    return best.select("o_orderkey", "priority", F.row_number().over(W.orderBy("priority", "r")).alias("place"))


@query("""WITH q AS (SELECT o_orderkey, ntile(5) OVER (ORDER BY o_totalprice, o_orderkey) AS bin FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY sha256('3:' || o_orderkey)) AS r FROM q) SELECT o_orderkey, bin FROM k WHERE r <= 8""")
def quantile_bin_sample(spark, sf):
    # bins of equal rank without a global sort of rows in one task: places come from a range-partitioned sort
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    placed = ranking.global_rank(o, "o_totalprice", "o_orderkey")
    n, big = F.col("total"), F.col("total") % 5
    small = F.floor(n / 5)
    edge = big * (small + 1)
    bin_ = F.when(F.col("place") <= edge, F.ceil(F.col("place") / (small + 1))).otherwise(big + F.ceil((F.col("place") - edge) / small))
    return ranking.top_k(placed.withColumn("bin", bin_.cast("bigint")), ["bin"], 8, hashing.rank(F.col("o_orderkey"), 3)).select("o_orderkey", "bin")


@query("""WITH c AS (SELECT quantile_cont(o_totalprice, 0.67) AS hi, quantile_cont(o_totalprice, 0.2) AS lo FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'blocked' WHEN o_totalprice >= hi THEN 'clean' WHEN o_totalprice <= lo THEN 'hard_negative' ELSE 'review' END AS tier FROM orders, c""")
def quantile_tiers(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderstatus") != "P").alias("passing"))
    return labels.quantile_tiers(o, "o_totalprice", "passing").select("o_orderkey", "tier")


@query("""WITH a AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey), b AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, round(coalesce(b.total, 0) - coalesce(a.total, 0), 2) AS delta, CASE WHEN a.o_custkey IS NULL THEN 'added' WHEN b.o_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""")
def full_outer_delta(spark, sf):
    total = lambda s, n: table(spark, sf, "orders").filter(F.col("o_orderstatus") == s).groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias(n))
    j = total("F", "a").join(total("O", "b"), "o_custkey", "full_outer")
    change = ladders.ladder((F.col("a").isNull(), "added"), (F.col("b").isNull(), "removed"), otherwise="changed")
    return j.select("o_custkey", F.round(F.coalesce("b", F.lit(0.0)) - F.coalesce("a", F.lit(0.0)), 2).alias("delta"), change.alias("change"))


@query("SELECT l_partkey, arg_max(l_orderkey, (l_orderkey, l_linenumber)) AS last_order, arg_min(l_orderkey, (l_orderkey, l_linenumber)) AS first_order, count(*) AS versions FROM lineitem GROUP BY l_partkey")
def last_wins_first_wins(spark, sf):
    order = F.struct("l_orderkey", "l_linenumber")
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max_by("l_orderkey", order).alias("last_order"), F.min_by("l_orderkey", order).alias("first_order"), F.count(F.lit(1)).alias("versions"))


@query("""SELECT o_orderkey, count(l_orderkey) AS files, count(*) FILTER (l_linestatus = 'F') AS present, CASE WHEN count(l_orderkey) = 0 THEN 'missing_data_route' WHEN count(*) FILTER (l_linestatus = 'F') = 0 THEN 'missing_data_file' ELSE 'ok' END AS state
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def stat_inventory_missing(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("f"), F.count_if(F.col("l_linestatus") == "F").alias("p"))
    j = table(spark, sf, "orders").select("o_orderkey").join(li, "o_orderkey", "left").select("o_orderkey", F.coalesce("f", F.lit(0)).alias("files"), F.coalesce("p", F.lit(0)).alias("present"))
    return j.withColumn("state", ladders.ladder((F.col("files") == 0, "missing_data_route"), (F.col("present") == 0, "missing_data_file"), otherwise="ok"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity >= 10 AS enough, l_discount <= 0.05 AS cheap, l_tax < 0.08 AS taxed, l_quantity >= 10 AND l_discount <= 0.05 AND l_tax < 0.08 AS hard_pass,
(l_quantity < 10)::INT + (l_discount > 0.05)::INT + (l_tax >= 0.08)::INT = 1 AND l_quantity < 10 AS only_quantity_failed FROM lineitem""")
def hard_gates_forall(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") >= 10).alias("enough"), (F.col("l_discount") <= 0.05).alias("cheap"), (F.col("l_tax") < 0.08).alias("taxed"))
    gates = F.array("enough", "cheap", "taxed")
    failed = F.size(F.filter(gates, lambda g: ~g))
    return li.withColumn("hard_pass", F.forall(gates, lambda g: g)).withColumn("only_quantity_failed", (failed == 1) & ~F.col("enough"))


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS m FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(n, 0) AS rows, coalesce(m, 0) AS declared, CASE WHEN n IS NULL THEN 'empty' WHEN n <> m THEN 'episode_length_mismatch' ELSE 'ok' END AS status FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def length_vs_metadata(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("m"))
    j = table(spark, sf, "orders").select("o_orderkey").join(li, "o_orderkey", "left")
    return j.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("rows"), F.coalesce("m", F.lit(0)).alias("declared"), ladders.ladder((F.col("n").isNull(), "empty"), (F.col("n") != F.col("m"), "episode_length_mismatch"), otherwise="ok").alias("status"))


@query("""SELECT l_partkey AS key, count(*) AS n, 'task_index_unknown' AS code FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10) GROUP BY l_partkey
UNION ALL SELECT p_partkey, 0, 'task_unused' FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey) AND p_size > 10""")
def unknown_reference_sets(spark, sf):
    used = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = table(spark, sf, "part").filter("p_size > 10").select(F.col("p_partkey").alias("key"))
    unknown = used.join(known, "key", "left_anti").withColumn("code", F.lit("task_index_unknown"))
    return unknown.unionByName(known.join(used, "key", "left_anti").select("key", F.lit(0).cast("bigint").alias("n"), F.lit("task_unused").alias("code")))


@query("""SELECT code, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN l_linenumber < 1 THEN 'segment_marker_invalid' END, CASE WHEN l_returnflag NOT IN ('N', 'A') THEN 'invalid_main_type' END, CASE WHEN l_discount > 0.09 THEN 'value_out_of_range' END], lambda x: x IS NOT NULL)) AS code FROM lineitem) GROUP BY code""")
def marker_and_domain_checks(spark, sf):
    rules = [("segment_marker_invalid", F.col("l_linenumber") < 1, "error"), ("invalid_main_type", ~F.col("l_returnflag").isin("N", "A"), "error"), ("value_out_of_range", F.col("l_discount") > 0.09, "warning")]
    return validation.issues(table(spark, sf, "lineitem"), "l_orderkey", rules).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT l_orderkey, sum(l_extendedprice) AS size, max(l_quantity) AS longest FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, round(size, 2) AS size, CASE WHEN size > 200000 THEN 'file_size_limit' WHEN abs(size - o_totalprice) > 0.5 * o_totalprice THEN 'duration_mismatch' WHEN longest < 10 THEN 'too_short' ELSE 'ok' END AS status FROM orders JOIN f ON l_orderkey = o_orderkey""")
def declared_vs_actual(spark, sf):
    f = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("size"), F.max("l_quantity").alias("longest"))
    j = table(spark, sf, "orders").select("o_orderkey", "o_totalprice").join(f, "o_orderkey")
    off = F.abs(F.col("size") - F.col("o_totalprice")) > 0.5 * F.col("o_totalprice")
    return j.select("o_orderkey", F.round("size", 2).alias("size"), ladders.ladder((F.col("size") > 200000, "file_size_limit"), (off, "duration_mismatch"), (F.col("longest") < 10, "too_short"), otherwise="ok").alias("status"))


@query("SELECT l_suppkey, count(*) AS samples, round(count(*) FILTER (l_discount > 0.08) / count(*)::DOUBLE, 6) AS over, round(count(*) FILTER (l_discount < 0.02) / count(*)::DOUBLE, 6) AS under, count(*) FILTER (l_discount > 0.08) / count(*)::DOUBLE > 0.2 AS flagged FROM lineitem GROUP BY l_suppkey")
def exposure_ratio(spark, sf):
    n = F.count(F.lit(1))
    over, under = F.count_if(F.col("l_discount") > 0.08) / n, F.count_if(F.col("l_discount") < 0.02) / n
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(n.alias("samples"), r6(over).alias("over"), r6(under).alias("under"), (over > 0.2).alias("flagged"))


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS d FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS datasets, count(*) FILTER (n IS NULL) AS without_files, count(*) FILTER (n <> d) AS repeated, count(*) FILTER (n = d) AS verified FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def integrity_verify(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_linenumber").alias("d"))
    j = table(spark, sf, "orders").select("o_orderkey").join(li, "o_orderkey", "left")
    return j.agg(F.count(F.lit(1)).alias("datasets"), F.count_if(F.col("n").isNull()).alias("without_files"), F.count_if(F.col("n") != F.col("d")).alias("repeated"), F.count_if(F.col("n") == F.col("d")).alias("verified"))


@query("SELECT l_orderkey, l_linenumber, o_orderstatus, count(*) OVER (PARTITION BY l_orderkey) AS in_file FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'A'")
def per_file_broadcast(spark, sf):
    li = table(spark, sf, "lineitem").filter("l_returnflag = 'A'").select("l_orderkey", "l_linenumber")
    j = li.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey")  # the join and the window share one exchange
    return j.withColumn("in_file", F.count(F.lit(1)).over(W.partitionBy("l_orderkey")))


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, lag(l_quantity) OVER w AS q, lag(l_discount) OVER w AS d FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_discount))
SELECT l_orderkey, l_linenumber, coalesce(abs(l_quantity - q) <= 10 AND abs(l_discount - d) <= 0.0205, false) AS reusable FROM c""")
def cache_compat_tolerance(spark, sf):
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_quantity", "l_discount")
    near = (F.abs(F.col("l_quantity") - F.lag("l_quantity").over(w)) <= 10) & (F.abs(F.col("l_discount") - F.lag("l_discount").over(w)) <= 0.0205)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(near, F.lit(False)).alias("reusable"))


@query("""WITH o AS (SELECT o_orderkey, CAST(1 + floor(o_totalprice / 50000) AS BIGINT) AS n, o_totalprice AS d FROM orders) SELECT o_orderkey, k, round(CASE WHEN n = 1 THEN 0 ELSE (d - d / 10) * k / (n - 1) END, 6) AS start FROM (SELECT *, unnest(range(n)) AS k FROM o)""")
def uniform_tiling(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (1 + F.floor(F.col("o_totalprice") / 50000)).cast("bigint").alias("n"), F.col("o_totalprice").alias("d"))
    o = o.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    return o.select("o_orderkey", "k", F.round(F.when(F.col("n") == 1, 0.0).otherwise((F.col("d") - F.col("d") / 10) * F.col("k") / (F.col("n") - 1)), 6).alias("start"))


@query("""SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS codes, array_to_string(list_sort(list_distinct(list(CAST(l_suppkey AS VARCHAR)))), ',') AS files,
CASE WHEN bool_or(l_returnflag = 'R') THEN 'reject' WHEN bool_or(l_returnflag = 'A') THEN 'review' ELSE 'accept' END AS decision FROM lineitem GROUP BY l_orderkey""")
def manifest_row(spark, sf):
    flag = F.col("l_returnflag")
    g = table(spark, sf, "lineitem").groupBy("l_orderkey")
    return g.agg(F.array_join(F.array_sort(F.collect_set(flag)), ",").alias("codes"), F.array_join(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))), ",").alias("files"), ladders.ladder((F.bool_or(flag == "R"), "reject"), (F.bool_or(flag == "A"), "review"), otherwise="accept").alias("decision"))


@query("""WITH c AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY sha256('5:' || o_orderkey)) AS r FROM orders)
SELECT o_orderkey, o_orderpriority AS stratum, CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'profiled' END AS state FROM c WHERE r <= 4""")
def candidate_batch(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("stratum"), "o_orderstatus")
    picked = ranking.top_k(o, ["stratum", "o_orderstatus"], 4, hashing.rank(F.col("o_orderkey"), 5))
    return picked.select("o_orderkey", "stratum", ladders.ladder((F.col("o_orderstatus") == "P", "error"), otherwise="profiled").alias("state"))


@query("SELECT o_orderpriority AS system, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE seed END AS seed, count(DISTINCT o_custkey) AS groups, count(*) AS n FROM orders, (SELECT unnest([1, 2, 3]) AS seed) WHERE o_orderstatus <> 'P' OR seed = 1 GROUP BY 1, 2")
def matrix_cross(spark, sf):
    # systems by seeds: a trained system runs once a seed, an untrained one (P) once without a seed
    o = table(spark, sf, "orders")
    o = o.withColumn("seed", F.explode(F.when(F.col("o_orderstatus") == "P", F.array(F.lit(None).cast("int"))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3)))))
    return o.groupBy(F.col("o_orderpriority").alias("system"), "seed").agg(F.count_distinct("o_custkey").alias("groups"), F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name)
SELECT r_name AS source_class, CASE WHEN r_name = 'AFRICA' THEN 'external' ELSE 'internal' END AS use, CAST(sum(n) AS BIGINT) AS rows, count(*) AS groups, CAST(greatest(0, 1000 - sum(n)) AS BIGINT) AS shortfall FROM r GROUP BY r_name""")
def cohort_plan(spark, sf):
    n, r = F.broadcast(table(spark, sf, "nation")), F.broadcast(table(spark, sf, "region"))
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    g = c.groupBy(F.col("r_name").alias("source_class")).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("groups"))
    return g.select("source_class", ladders.ladder((F.col("source_class") == "AFRICA", "external"), otherwise="internal").alias("use"), "rows", "groups", F.greatest(F.lit(0).cast("bigint"), 1000 - F.col("rows")).alias("shortfall"))


@query("""SELECT 'l_orderkey' AS "column", 'bigint' AS declared, count(*) FILTER (l_orderkey IS NULL) AS nulls, 0 AS unfit FROM lineitem
UNION ALL SELECT 'l_quantity', 'int', count(*) FILTER (l_quantity IS NULL), count(*) FILTER (l_quantity <> trunc(l_quantity)) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'int', count(*) FILTER (l_extendedprice IS NULL), count(*) FILTER (l_extendedprice <> trunc(l_extendedprice)) FROM lineitem
UNION ALL SELECT 'l_linenumber', 'string', count(*) FILTER (l_linenumber IS NULL), 0 FROM lineitem
UNION ALL SELECT 'l_returnflag', 'int', count(*) FILTER (l_returnflag IS NULL), count(*) FILTER (try_cast(l_returnflag AS INT) IS NULL AND l_returnflag IS NOT NULL) FROM lineitem
UNION ALL SELECT 'l_missing', 'bigint', NULL, NULL""")
def schema_conformance(spark, sf):
    wanted = {"l_orderkey": "bigint", "l_quantity": "int", "l_extendedprice": "int", "l_linenumber": "string", "l_returnflag": "int", "l_missing": "bigint"}
    return validation.value_conformance(table(spark, sf, "lineitem"), wanted)
