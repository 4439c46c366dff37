"""Mixing sources to target weights by subset-sum budget fitting.

The size of a document is its number of words. Sources share a budget of
``BUDGET`` times all sizes by weight, none above ``MOST`` times its own size. Each
source's target is then met by whole documents:

1. documents are counted by source and exact length;
2. the whole multiples of the source are taken for every document; of the rest,
   each length gives its share in whole documents, what it leaves open going to the
   next longer one. At most twice the longest document remains, and a bounded-knapsack
   dynamic program over lengths and counts left closes it;
3. of each length, as many documents as were chosen are selected in the order of a
   seeded hash of doc_id.

A length of one source may hold a large part of all rows (copies), so the hash
order is found by bucket: bucket counts and their prefix sums say which buckets are
taken whole, and only rows of one bucket are ranked together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS, Scratch

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2.0
SEED = 20240607

_SRC, _SIZE, _HASH, _CELL = "__mix_src", "__mix_size", "__mix_hash", "__mix_cell"


def word_count(text: Column) -> Column:
    """Number of runs of anything but the six ASCII white-space characters."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE_CLASS}]+")).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null and sets a null source apart from any text."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def fit_lengths(lengths: dict[int, int], target: float) -> tuple[int, dict[int, int]]:
    """(copies for every document, documents by length that get one more).

    The total, copies included, is as near below the target as the lengths allow;
    it meets the rounded target exactly wherever the knapsack reaches it.
    """
    total = sum(size * n for size, n in lengths.items())
    if total == 0:
        return 0, {}
    copies = min(int(target // total), int(MOST))
    budget = 0 if copies == MOST else round(target - copies * total)
    left = {size: n for size, n in sorted(lengths.items()) if size > 0}
    chosen: dict[int, int] = {}
    seen = taken = 0
    for size, n in left.items():
        seen += size * n
        # what shorter lengths left open counts here, so that less than one document stays open
        chosen[size] = (budget * seen // total - taken) // size
        taken += chosen[size] * size
    rest = budget - taken
    longest = max(left)
    for size in left:  # short documents are given back, so that the program has a choice
        back = min(chosen[size], (2 * longest - rest) // size)
        chosen[size] -= back
        rest += size * back
    for size, n in _knapsack({s: n - chosen[s] for s, n in left.items() if s <= rest}, rest).items():
        chosen[size] += n
    return copies, {size: n for size, n in chosen.items() if n}


def _knapsack(left: dict[int, int], budget: int) -> dict[int, int]:
    """Bounded knapsack over lengths: the largest reachable sum within the budget.

    Counts go in as powers of two. For each sum the step that first reached it is
    kept, which takes 5 bytes a word of the budget. It ends at the first length that
    makes the budget reachable.
    """
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    by_step = np.full(budget + 1, -1, dtype=np.int32)
    steps: list[tuple[int, int]] = []
    for size, n in left.items():
        n, part = min(n, budget // size), 1
        while n > 0 and not reached[budget]:
            part = min(part, n)
            fresh = size * part + np.flatnonzero(reached[: budget + 1 - size * part] & ~reached[size * part :])
            reached[fresh], by_step[fresh] = True, len(steps)
            steps.append((size, part))
            n, part = n - part, part * 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    out: dict[int, int] = {}
    while at:
        size, part = steps[by_step[at]]
        out[size] = out.get(size, 0) + part
        at -= size * part
    return out


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Targets by source from (src, source, source_size).

    Weights follow the sources in code-point order, null last. With sources in the
    order of cap / weight, a source is at its cap as long as an equal share by
    weight of what is left would exceed it; the first that is not sets the level.
    The table has one row a source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    by = sources.withColumn("weight", pick).withColumn("cap", F.col("source_size") * MOST)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) * BUDGET - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(after)
    by = by.withColumn("level", level)
    open_level = F.min(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "src", "level"))).over(every)
    by = by.withColumn("open", open_level["level"])
    target = F.when(F.col("open").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("open") * F.col("weight")))
    return by.select("src", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


@dataclass
class MixPlan:
    """What was chosen, by cell of (source, length, hash bucket)."""

    cells: DataFrame
    buckets: int
    seed: int

    def keyed(self, docs: DataFrame) -> DataFrame:
        return docs.withColumns(_keys(self.seed)).withColumn(_CELL, F.pmod(_HASH, F.lit(self.buckets)))

    def select(self, keyed: DataFrame) -> DataFrame:
        """Adds __mix_copies (0, 1 or 2), __mix_source_size and __mix_target."""
        joined = keyed.join(self.cells, [_SRC, _SIZE, _CELL])
        place = F.row_number().over(Window.partitionBy(_SRC, _SIZE, _CELL).orderBy(_HASH, "doc_id"))
        more = F.when(F.col("__mix_some") == 0, F.lit(0)).when(place <= F.col("__mix_some"), 1).otherwise(0)
        return joined.withColumn("__mix_copies", (F.col("__mix_all") + more).cast("int"))


def _keys(seed: int) -> dict[str, Column]:
    return {
        _SRC: source_key(F.col("source")),
        _SIZE: word_count(F.col("text")),
        _HASH: F.xxhash64(F.lit(seed), F.col("doc_id")),
    }


def plan_mix(spark: SparkSession, sized: DataFrame, seed: int = SEED) -> MixPlan:
    """Choose counts by source and length from rows of (source, keys)."""
    scratch = Scratch(spark, "mixing")
    rows = sized.count()
    buckets = max(64, 1 << math.ceil(math.log2(max(1, rows)) / 2))
    cell = F.pmod(_HASH, F.lit(buckets)).alias(_CELL)
    cells = scratch.save(
        sized.groupBy(_SRC, "source", _SIZE, cell).agg(F.count("*").alias("__mix_n")), "cells"
    )
    lengths = cells.groupBy(_SRC, "source", _SIZE).agg(F.sum("__mix_n").alias("n"))
    sources = lengths.groupBy(F.col(_SRC).alias("src"), "source").agg(F.sum(F.col(_SIZE) * F.col("n")).alias("source_size"))
    targets = scratch.save(source_targets(sources), "targets")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = dict(zip(pdf["size"].tolist(), pdf["n"].tolist(), strict=True))
        copies, more = fit_lengths(lengths, float(pdf["target"].iloc[0]))
        return pd.DataFrame(
            {
                _SRC: pdf["src"],
                _SIZE: pdf["size"],
                "__mix_all": copies,
                "__mix_more": [more.get(s, 0) for s in pdf["size"]],
                "__mix_source_size": pdf["source_size"],
                "__mix_target": pdf["target"],
            }
        )

    # A group is the length histogram of a source: its distinct lengths, not its rows.
    hist = lengths.select(F.col(_SRC).alias("src"), F.col(_SIZE).alias("size"), "n").join(targets, "src")
    fitted = hist.groupBy("src").applyInPandas(
        fit,
        f"{_SRC} string, {_SIZE} long, __mix_all int, __mix_more long, __mix_source_size long, __mix_target double",
    )
    quotas = scratch.save(fitted, "quotas")
    before = F.sum("__mix_n").over(
        Window.partitionBy(_SRC, _SIZE).orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    )
    with_quota = cells.drop("source").join(quotas, [_SRC, _SIZE])
    some = F.least(F.greatest(F.col("__mix_more") - F.coalesce(before, F.lit(0)), F.lit(0)), F.col("__mix_n"))
    chosen = with_quota.withColumn("__mix_some", some).drop("__mix_n", "__mix_more")
    return MixPlan(scratch.save(chosen, "chosen"), buckets, seed)


def mix_documents(spark: SparkSession, docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken.

    ``taken`` is the number of words the mix takes of a document, repeats counted:
    0, 1 or 2 times its size. Null text has size 0 and nothing is taken of it. A
    null source is a source of its own, last in order. Rows with equal doc_id rank
    together; an empty table gives an empty result; only doc_id, text and source
    are read.
    """
    scratch = Scratch(spark, "mixing")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    sized = scratch.save(keyed.withColumns(_keys(seed)).drop("text"), "sized")
    plan = plan_mix(spark, sized, seed)
    cells = sized.drop("source").withColumn(_CELL, F.pmod(_HASH, F.lit(plan.buckets)))
    return plan.select(cells).select(
        "doc_id",
        F.col(_SIZE).alias("size"),
        F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col(_SIZE) * F.col("__mix_copies")).alias("taken"),
    )


def mixed_rows(spark: SparkSession, docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of docs that the mix takes, repeated ones twice, all columns as they are.

    Rows without words (null, empty and blank texts) are not taken. A null source is a
    source of its own. Rows with equal doc_id rank together; an empty table stays empty.
    """
    scratch = Scratch(spark, "mixing")
    columns = docs.columns
    keyed = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), "text")
    sized = scratch.save(keyed.withColumns(_keys(seed)).drop("text"), "sized")
    plan = plan_mix(spark, sized, seed)
    picked = plan.select(plan.keyed(docs)).filter((F.col("__mix_copies") > 0) & (F.col(_SIZE) > 0))
    copies = F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))
    return picked.withColumn("__mix_copy", copies).select(*[F.col(f"`{c}`") for c in columns])
