"""Exact dedup by content sort.

Texts are normalised (A-Z lower-cased, null as empty), dealt to partitions by
sampled splitters and sorted there, so that equal texts lie next to each other;
each row is compared in full with its neighbour. Spark's range exchange samples
the splitters and its sort spills to disk.

The order is (first 64 characters, 64-bit hash, whole text, doc_id descending).
Splitters therefore stay small however long the texts are, and since doc_id is
part of the order, a group of copies larger than a partition is cut across
neighbouring partitions instead of landing in one task. Only the first and last
run of each partition can be cut; those few rows are put together by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

PREFIX_CHARS = 64

_RUNS = "doc_id long, text_sha256 string, run_keep long, run_size long, lead boolean, edge boolean"


def _normalised(col):
    return F.translate(
        F.coalesce(col, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut a sorted partition into runs of equal texts.

    Holds one text, the ids of its run and the closed runs of one batch. The
    first and the last run are marked as edges; the first row of a run leads it.
    """
    text: str | None = None
    ids: list[int | None] = []
    done: list[tuple] = []
    first = True

    def close(edge: bool) -> None:
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        done.extend((i, sha, ids[0], len(ids), k == 0, edge) for k, i in enumerate(ids))

    def frame() -> pd.DataFrame:
        made = pd.DataFrame(done, columns=["doc_id", "text_sha256", "run_keep", "run_size", "lead", "edge"])
        done.clear()
        return made.astype({"doc_id": "Int64", "run_keep": "Int64"})

    for batch in batches:
        for t, i in zip(batch["norm"], batch["doc_id"], strict=True):
            i = None if pd.isna(i) else int(i)
            if t == text:
                ids.append(i)
                continue
            if text is not None:
                close(edge=first)
                first = False
            text, ids = t, [i]
        yield frame()
    if text is not None:
        close(edge=True)
        yield frame()


def exact_dedup(spark: SparkSession, docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised text the one with the largest doc_id stays.
    Null text counts as the empty text. Repeated rows are members of their group
    like any other and exactly one row of a group is kept (of rows that share the
    largest doc_id, one). A null doc_id is below every other. An empty table
    gives an empty result; other columns are not read.
    """
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _normalised(F.col("text")).alias("norm"))
    order = [
        F.substring("norm", 1, PREFIX_CHARS),
        F.xxhash64("norm"),
        F.col("norm"),
        F.col("doc_id").desc_nulls_last(),
    ]
    dealt = norm.repartitionByRange(n, order[0], order[1], order[3]).sortWithinPartitions(*order)
    scratch = Scratch(spark, "exact-dedup")
    runs = scratch.save(dealt.select("doc_id", "norm").mapInPandas(_runs, _RUNS), "runs")
    # Two runs at most for each partition: bounded by the partition count, so broadcast.
    edges = (
        runs.filter("edge AND lead")
        .groupBy("text_sha256")
        .agg(F.max("run_keep").alias("all_keep"), F.sum("run_size").alias("all_size"))
    )
    joined = runs.join(F.broadcast(edges), "text_sha256", "left")
    keep = F.when(F.col("edge"), F.col("all_keep")).otherwise(F.col("run_keep"))
    size = F.when(F.col("edge"), F.col("all_size")).otherwise(F.col("run_size"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        size.cast("long").alias("group_size"),
        (F.col("lead") & F.col("doc_id").eqNullSafe(keep)).alias("kept"),
        "text_sha256",
    )
