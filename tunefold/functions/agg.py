"""Aggregate expressions with the warehouse's semantics.

``string_agg(DISTINCT x, sep)`` per group, values in ascending binary order,
NULL for a group with no non-NULL value.

A plain ``collect_set`` per group would gather every distinct value of a hot
group into one task and sort it there. Here the work is spread out instead:

1. distinct ``(group, value)`` pairs: a hash shuffle on both columns, so one
   hot group is spread over all tasks;
2. a range partitioning on ``(group, value)`` cuts each group into contiguous,
   sorted chunks of bounded size; each chunk is joined into one string in its
   own task (``spark_partition_id`` names the chunk: it is fixed by the range
   bounds, so recomputed tasks build the same chunks);
3. per group, the chunks are ordered and joined. That last step holds only the
   finished output value of the group; ``sorted_distinct_chunks`` stops before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sorted_distinct_chunks(df: DataFrame, group_cols: list[str], value, sep: str = ", ",
                           n_chunks: int | None = None) -> DataFrame:
    """The sorted distinct non-NULL values of every group in chunks: ``group_cols..., chunk, first, last, num_values, text``.

    A group's chunks in order of ``chunk`` (not dense), joined by ``sep``, are its whole list. A chunk holds what
    one task holds, so a writer can stream a list of any length that no single value could hold.
    """
    if n_chunks is None:
        n_chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = "__v"
    # NULL values go after the aggregate: a filter here would be pushed below an exchange that others read too.
    pairs = df.select(*group_cols, _c(value).alias(v)).distinct()
    return (pairs.repartitionByRange(n_chunks, *group_cols, v)
            .withColumn("chunk", F.spark_partition_id())
            .groupBy(*group_cols, "chunk")
            .agg(F.min(v).alias("first"), F.max(v).alias("last"), F.count(v).alias("num_values"),
                 F.array_join(F.array_sort(F.collect_list(v)), sep).alias("text"))
            .where(F.col("num_values") > 0))


def joined_chunks(which: Column, sep: str = ", ", empty: bool = True) -> Column:
    """The list that some of a group's chunks make, NULL without any: an aggregate over ``sorted_distinct_chunks``.

    ``empty``: whether an empty text, of an empty value alone, is a list too. Texts are not copied before they are
    joined, and ``concat_ws`` makes the list in its length at once, where ``array_join`` doubles a buffer as it goes.
    """
    ordered = F.array_sort(F.collect_list(F.when(which, F.struct("chunk", "text"))))
    some = F.size(ordered) > 0 if empty else (F.size(ordered) > 1) | (F.get(ordered, F.lit(0))["text"] != "")
    return F.when(some, F.concat_ws(sep, ordered["text"]))


def sorted_distinct_join(df: DataFrame, group_cols: list[str], value, out: str, sep: str = ", ",
                         n_chunks: int | None = None) -> DataFrame:
    """One row per group with at least one non-NULL value: ``group_cols..., out``."""
    chunks = sorted_distinct_chunks(df, group_cols, value, sep, n_chunks)
    return chunks.groupBy(*group_cols).agg(joined_chunks(F.lit(True), sep).alias(out))
