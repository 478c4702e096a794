"""Tables of relational databases: partitioned reads whose bounds come from the source, with filters and aggregates pushed down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, table: str, column: str | None = None, rows_a_partition: int = 1_000_000, most: int = 64, **options) -> DataFrame:
    """The table, in ranges of a numeric column between its bounds in the source: as many as its rows ask for, most at most.

    Bounds and count are one aggregate that the source computes. An empty table, or no column, is read in one partition. Rows
    without a value in the column are read with the first range.
    """
    reader = lambda: spark.read.format("jdbc").option("url", url).options(**options)
    plain = reader().option("dbtable", table).option("pushDownAggregate", "true").option("pushDownLimit", "true")
    if column is None:
        return plain.load()
    named = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
    low, high, n = reader().option("query", f"SELECT MIN({named}) AS low, MAX({named}) AS high, COUNT(*) AS n FROM {table}").load().first()
    parts = min(most, -(-int(n) // rows_a_partition))
    if low is None or parts < 2:
        return plain.load()
    return plain.option("partitionColumn", column).option("lowerBound", int(low)).option("upperBound", int(high) + 1).option("numPartitions", parts).load()


def run_status(runs: DataFrame, dataset: str = "dataset", at: str = "finished_at", state: str = "state") -> DataFrame:
    """dataset, runs, failed, last_at, last_state: what a registry's status page asks of its table of runs."""
    return runs.groupBy(dataset).agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col(state) == "failed").alias("failed"), F.max(at).alias("last_at"), F.max_by(state, at).alias("last_state"))
