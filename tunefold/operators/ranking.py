"""Global dense rank and top-k-with-ties without a single-task window.

``dense_rank() OVER (ORDER BY k DESC)`` with no partition moves every row into
one task. A dense rank depends only on the *distinct* values of ``k``, so the
rank is computed over the distinct keys and joined back, by one plan for every
size and every orderable type:

1. ``keys = df.select(k).distinct()``: partial aggregation per map task, so a
   value held by a third of all rows costs one row per task in the shuffle.
2. The distinct keys are range-partitioned in rank order and ranked inside
   their partition; a partition's offset is the number of keys before it (a
   running sum over one row per partition, broadcast).
3. The ranked keys are joined back on ``k``; Spark picks the join by measured
   size, and AQE's skew-join split handles a hot key.

Desc order puts NULL first (rank 1), asc puts it last, as the warehouse does.
Building the plan runs no job: the offsets are part of it. Both uses of the
ranges (ranks inside them, their sizes) come from one exchange, which Spark
reuses. Should a session have turned that reuse off, the ranges could be cut
twice and differently; every row therefore compares its range's size with the
one that its offset was made from, and a difference fails the query.

Top-k with ties is the same idea cut short: the k best distinct values come
from ``orderBy().limit(k)`` (per-task top-k, then a merge of k x tasks rows),
and that k-row table is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_K = "__rank_key"
_P = "__rank_part"


def _order(col: Column, descending: bool) -> Column:
    # Warehouse rule: NULLs sort as larger than every value.
    return col.desc_nulls_first() if descending else col.asc_nulls_last()


def ranked_keys(df: DataFrame, key: str, out: str, descending: bool = True) -> DataFrame:
    """``(distinct key, dense rank)``; NaN is one value, greater than all numbers, as Spark orders it."""
    order = _order(F.col(_K), descending)
    keys = df.select(F.col(key).alias(_K)).distinct()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keys.repartitionByRange(parts, order).withColumn(_P, F.spark_partition_id())
    # Exact sizes of the ranges, one row each; the running sum is over those rows only.
    sizes = placed.groupBy(_P).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(_P), F.col("__size"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(_P)
    local = placed.withColumns({
        "__local": F.row_number().over(inside.orderBy(order)),
        "__here": F.count(F.lit(1)).over(inside),
    })
    rank = F.when(F.col("__here") == F.col("__size"), F.col("__offset") + F.col("__local")).otherwise(
        F.raise_error(F.lit("ranges of rank keys were cut twice")))
    return local.join(F.broadcast(offsets), _P, "left").select(_K, rank.cast("bigint").alias(out))


def dense_rank_global(df: DataFrame, key: str, out: str, descending: bool = True) -> DataFrame:
    """Append ``out = dense_rank() over (order by key [desc nulls first])`` to every row of ``df``."""
    ranked = ranked_keys(df, key, out, descending)
    return df.join(ranked, df[key].eqNullSafe(ranked[_K]), "inner").drop(_K)


def top_k_values(df: DataFrame, key: str, k: int, out: str, descending: bool = True) -> DataFrame:
    """The ``k`` best distinct values of ``key`` with their dense rank (at most ``k`` rows)."""
    keys = df.select(F.col(key).alias(_K)).distinct()
    best = keys.orderBy(_order(F.col(_K), descending)).limit(k)
    w = Window.orderBy(_order(F.col(_K), descending))
    return best.select(_K, F.dense_rank().over(w).cast("bigint").alias(out))


def top_k_with_ties(df: DataFrame, key: str, k: int, out: str, descending: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``key`` has dense rank <= ``k``, with the rank (ties all kept)."""
    best = F.broadcast(top_k_values(df, key, k, out, descending))  # at most k rows
    return df.join(best, df[key].eqNullSafe(best[_K]), "inner").drop(_K)
