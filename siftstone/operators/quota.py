"""The first rows of every group in hash order, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import hash_order
from ..sources.scratch import Scratch

#: Hex digits of a hash that make its bucket; a group has at most 16 to this power of them.
DIGITS = 3


def first_of_groups(rows: DataFrame, group: Column, quota: Callable[[Column], Column], seed: int, key: str, name: str) -> DataFrame:
    """Adds ``name``: whether a row is among the first ``quota(size)`` of its group in hash order.

    Counts by group and hash bucket tell in which bucket a group's quota ends. Rows of
    other buckets are decided by comparing buckets; only the rows of that one bucket are
    ranked, one of 4,096 of a large group. Nulls are a group of their own; of rows with
    equal keys any may come first; empty input gives empty output.
    """
    rows = rows.withColumns({"__group": group, "__hash": F.coalesce(hash_order(seed, F.col(key)), F.lit(""))})
    rows = rows.withColumn("__bucket", F.substring("__hash", 1, DIGITS))
    counts = rows.groupBy("__group", "__bucket").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("__group")
    # at most 4,097 rows a group are in these windows
    upto = F.sum("n").over(whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0))
    summed = counts.withColumns({"before": upto - F.col("n"), "__wanted": quota(F.sum("n").over(whole))})
    last = summed.filter("before < __wanted").groupBy("__group").agg(
        F.max("__bucket").alias("__edge"), F.min(F.col("__wanted") - F.col("before")).alias("__rest")
    )
    # written first, so that its true size decides whether the join broadcasts it
    last = Scratch(rows.sparkSession, "quota").save(last.withColumnRenamed("__group", "__g"), "edges")
    joined = rows.join(last, F.col("__group").eqNullSafe(F.col("__g")), "left")
    private = ("__group", "__g", "__hash", "__bucket", "__edge", "__rest")
    at_edge = F.coalesce(F.col("__bucket") == F.col("__edge"), F.lit(False))
    sure = joined.filter(~at_edge).withColumn(name, F.coalesce(F.col("__bucket") < F.col("__edge"), F.lit(False)))
    order = Window.partitionBy("__group").orderBy("__hash", key)
    ranked = joined.filter(at_edge).withColumn(name, F.row_number().over(order) <= F.col("__rest"))
    return sure.unionByName(ranked).drop(*private)
