"""Stable digests, guards of plans and the dealing of work."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import digests
from ..operators import balance, guards
from ..sources.tables import table
from .registry import query

_FIELDS = ["n", "parts"]
_PARTS = "sum(CAST('0x' || sha256(r)[{a}:{b}] AS BIGINT))"
#: digests.multiset in SQL.
MULTISET = "sha256(concat_ws(':', count(r), " + ", ".join(_PARTS.format(a=a, b=a + 14) for a in (1, 16, 31)) + "))"


@query("""SELECT event_id, sha256('{"k":' || json_extract_string(props, '$.k') || '}') AS hash FROM events""")
def config_hashes(spark, sf):
    return table(spark, sf, "events").select("event_id", digests.config_hash(F.col("props")).alias("hash"))


@query("""WITH h AS (SELECT doc_id, lower(to_hex(from_hex(sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode('tidemark:documents:' || doc_id))))) AS h FROM documents)
SELECT doc_id, concat_ws('-', h[1:8], h[9:12], '5' || h[14:16], '89ab'[(CAST('0x' || h[17:17] AS BIGINT) % 4) + 1] || h[18:20], h[21:32]) AS id FROM h""")
def name_based_ids(spark, sf):
    return table(spark, sf, "documents").select("doc_id", digests.stable_uuid("tidemark", "documents", F.col("doc_id")).alias("id"))


@query("SELECT page_id, sha256(url[1:16] || CASE WHEN length(url) > 16 THEN url[-16:] ELSE '' END || length(url)) AS print FROM pages")
def content_fingerprints(spark, sf):
    return table(spark, sf, "pages").select("page_id", digests.fingerprint(F.encode("url", "UTF-8"), 16).alias("print"))


def _shards(spark, sf):
    """A table of orders as shards of sources: number and digest of their items."""
    li = table(spark, sf, "lineitem").withColumn("_r", F.concat_ws("|", "l_linenumber", "l_partkey", "l_quantity", "l_linestatus"))
    return li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), digests.multiset(F.col("_r")).alias("parts")), li


_NOW = f"""i AS (SELECT l_orderkey, l_linenumber, l_linestatus, concat_ws('|', l_linenumber, l_partkey, l_quantity, l_linestatus) AS r FROM lineitem), c AS (SELECT l_orderkey, count(*) AS n, {MULTISET} AS parts FROM i GROUP BY l_orderkey),
p AS (SELECT l_orderkey, count(*) AS n, {MULTISET} AS parts FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 5 = 0 THEN r || 'x' ELSE r END AS r FROM i WHERE l_linenumber < 7 AND l_orderkey % 11 <> 0) GROUP BY l_orderkey)"""


@query(f"""WITH {_NOW}, b AS (SELECT coalesce(p.l_orderkey, c.l_orderkey) AS l_orderkey, CASE WHEN c.n IS NULL THEN 'missing' WHEN p.n IS NULL THEN 'added' WHEN p.n <> c.n AND p.parts <> c.parts THEN 'changed:n,parts' WHEN p.n <> c.n THEN 'changed:n' WHEN p.parts <> c.parts THEN 'changed:parts' END AS reason FROM p FULL JOIN c USING (l_orderkey))
SELECT o_orderkey, reason AS stale FROM orders LEFT JOIN b ON o_orderkey = l_orderkey""")
def stale_plan_flags(spark, sf):
    """Orders with what changed since they were planned: lines added, altered, or whole orders that the plan doesn't have."""
    now, li = _shards(spark, sf)
    old = li.filter("l_linenumber < 7 AND l_orderkey % 11 <> 0").withColumn("_r", F.when(F.col("l_orderkey") % 5 == 0, F.concat("_r", F.lit("x"))).otherwise(F.col("_r")))
    planned = old.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), digests.multiset(F.col("_r")).alias("parts"))
    faults = guards.drift(planned, now, "l_orderkey", _FIELDS).withColumnRenamed("l_orderkey", "o_orderkey")
    return guards.flagged(table(spark, sf, "orders").select("o_orderkey"), faults, "o_orderkey")


@query("SELECT o_orderkey, o_orderkey % 2 AS half FROM orders")
def guarded_plan(spark, sf):
    """A plan whose source is as it was: every row passes the guard, which any difference would stop."""
    now, li = _shards(spark, sf)
    planned = li.repartition("l_partkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), digests.multiset(F.col("_r")).alias("parts"))
    header = table(spark, sf, "region").limit(1).select(F.lit("v2").alias("plan_version"), F.lit("orders").alias("dataset"))
    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 2).alias("half"))
    return guards.guarded(rows, guards.drift(planned, now, "l_orderkey", _FIELDS), guards.header_faults(header, ["v2", "v3"], "orders"))


@query("""WITH RECURSIVE o AS MATERIALIZED (SELECT c_nationkey AS pool, o_orderkey AS item, CAST(o_totalprice AS DOUBLE) AS load, row_number() OVER (PARTITION BY c_nationkey ORDER BY CAST(o_totalprice AS DOUBLE) DESC, o_orderkey) AS k FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT DISTINCT pool, CAST(NULL AS BIGINT) AS item, CAST(0 AS BIGINT) AS k, [0.0, 0.0, 0.0]::DOUBLE[] AS loads, CAST(0 AS BIGINT) AS pick FROM o
UNION ALL SELECT t.pool, t.item, t.k, [CASE WHEN t.pick = i THEN t.loads[i] + t.load ELSE t.loads[i] END for i in [1, 2, 3]], t.pick
  FROM (SELECT o.pool, o.item, o.k, o.load, s.loads, CAST(list_position([s.loads[1] / 1, s.loads[2] / 2, s.loads[3] / 4], list_min([s.loads[1] / 1, s.loads[2] / 2, s.loads[3] / 4])) AS BIGINT) AS pick FROM s JOIN o ON o.pool = s.pool AND o.k = s.k + 1) t)
SELECT pool, item, CAST(pick AS INT) AS worker, round(loads[pick], 2) AS total FROM s WHERE k > 0""")
def weighted_assignment(spark, sf):
    """Orders of each nation for its three reviewers, of capacities 1, 2 and 4."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    items = o.select(F.col("c_nationkey").alias("pool"), F.col("o_orderkey").alias("item"), F.col("o_totalprice").alias("load"))
    workers = table(spark, sf, "nation").select(F.col("n_nationkey").alias("pool"), F.explode(F.array(*[F.struct(F.lit(k).alias("worker"), F.lit(w).alias("weight")) for k, w in ((1, 1), (2, 2), (3, 4))])).alias("w")).select("pool", "w.*")
    return balance.assign(items, workers, "pool", "item", "load").withColumn("total", F.round("total", 2))
