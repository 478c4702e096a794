"""Greedy dealing of work: the largest item to the worker with the least load for its weight, pool by pool.

A pool's choices follow one another, so a pool is one stream of rows in order, with a heap of its workers as the only state;
pools run beside each other.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assign(items: DataFrame, workers: DataFrame, pool: str, item: str, load: str, worker: str = "worker", weight: str = "weight", had: str | None = None) -> DataFrame:
    """pool, item, worker, total: the worker's load after the item. Workers have a positive weight and perhaps a load that they
    had before; those without one start at 0. Items go in descending load, equal ones in order of item; of workers with the
    same load for their weight the smallest takes it. Null loads count as 0. Without workers in its pool, an item has null.
    """
    import pyarrow as pa

    kinds = dict(items.dtypes)
    who = dict(workers.dtypes)[worker]
    none = lambda kind: F.lit(None).cast(kind)
    as_items = items.select(F.col(pool).alias("_pool"), F.lit(1).alias("_kind"), F.col(item).alias("_item"), none(who).alias("_worker"), F.coalesce(F.col(load).cast("double"), F.lit(0.0)).alias("_load"), F.lit(1.0).alias("_weight"))
    start = F.coalesce(F.col(had).cast("double"), F.lit(0.0)) if had else F.lit(0.0)
    as_workers = workers.select(F.col(pool).alias("_pool"), F.lit(0).alias("_kind"), none(kinds[item]).alias("_item"), F.col(worker).alias("_worker"), start.alias("_load"), F.col(weight).cast("double").alias("_weight"))
    rows = as_workers.unionByName(as_items).repartition("_pool").sortWithinPartitions("_pool", "_kind", F.desc("_load"), "_item")

    def deal(batches):
        current, heap, first = None, [], True
        for b in batches:
            out = []
            for p, kind, name, w, amount, share in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if first or p != current:
                    current, heap, first = p, [], False
                if kind == 0:
                    heapq.heappush(heap, (amount / share, w, amount, share))
                elif heap:
                    _, w, had_, share = heap[0]
                    total = had_ + amount
                    heapq.heapreplace(heap, (total / share, w, total, share))
                    out.append((p, name, w, total))
                else:
                    out.append((p, name, None, None))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (b.column(0).type, b.column(2).type, b.column(3).type, pa.float64()), strict=True)], [pool, item, worker, "total"])

    return rows.mapInArrow(deal, f"{pool} {kinds[pool]}, {item} {kinds[item]}, {worker} {who}, total double")
