"""Archives and inventories of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import archives, boundary
from ..sources.shared import fresh_path
from ..sources.tables import table
from .registry import query


def _pages_as_tars(spark, sf):
    """Every page as a member of one of eight archives, some in folders."""
    path = fresh_path(spark, "tars")
    p = table(spark, sf, "pages").select(F.concat(F.when(F.col("page_id") % 3 == 0, "deep/er/").otherwise(""), F.lit("page-"), F.col("page_id").cast("string"), F.lit(".html")).alias("member"), "html")
    archives.write_tars(p, path, "member", "html", 8)
    return path


@query("""SELECT CASE WHEN page_id % 3 = 0 THEN 'deep/er/' ELSE '' END || 'page-' || page_id || '.html' AS member, 'page-' || page_id || '.html' AS basename, octet_length(encode(coalesce(html, ''))) AS size FROM pages""")
def tar_members(spark, sf):
    return archives.tar_members(spark, _pages_as_tars(spark, sf)).select("member", "basename", "size")


@query("""SELECT o_orderkey, CASE WHEN page_id IS NOT NULL THEN CASE WHEN page_id % 3 = 0 THEN 'deep/er/' ELSE '' END || 'page-' || page_id || '.html' END AS member, octet_length(encode(coalesce(html, ''))) AS size FROM orders LEFT JOIN pages ON page_id = o_orderkey - 1""")
def tar_lookup(spark, sf):
    """A member for every order, by name, without extraction."""
    wanted = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("page-"), (F.col("o_orderkey") - 1).cast("string"), F.lit(".html")).alias("expected"))
    found = archives.located(wanted, archives.tar_members(spark, _pages_as_tars(spark, sf)))
    return found.select("o_orderkey", "member", F.coalesce("size", F.when(F.col("member").isNull(), 0)).cast("long").alias("size"))


@query("""SELECT '_partition=' || lang AS partition, '_task=' || source AS task, count(*) OVER (PARTITION BY lang) AS tasks, 1 AS files FROM (SELECT DISTINCT lang, source FROM documents)""")
def file_inventory(spark, sf):
    """Documents as files of languages and sources, listed twice: from the folders, then from the kept inventory."""
    path, cache = boundary.as_files(table(spark, sf, "documents"), "lang", "source"), fresh_path(spark, "inventory")
    boundary.inventory(spark, path, "*.parquet", cache)
    rows = boundary.balanced_pick(boundary.inventory(spark, path, "*.parquet", cache), 1, 17)
    per = rows.groupBy("partition").agg(F.count_distinct("task").alias("tasks"))
    return rows.groupBy("partition", "task").agg(F.count(F.lit(1)).cast("int").alias("files")).join(per, "partition").select("partition", "task", "tasks", "files")
