"""Scoring predictions against truth, as single aggregations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.contract import exact_match
from ..functions.text import rouge_l
from ..schemas import ENUMS, INVALID, STRUCTURED, enum_dimension


def share(flag: Column) -> Column:
    """The share of rows where a flag holds; 0 without rows."""
    return F.coalesce(F.avg(F.coalesce(flag, F.lit(False)).cast("int")), F.lit(0.0))


def accuracy(gold: Column, predicted: Column) -> Column:
    """Share of equal rows; null equals null."""
    return share(gold.eqNullSafe(predicted))


#: Values that are gathered to pick one by its rank; among more, ranges are narrowed first.
EXACT_ROWS = 100_000
_ACCURACY = 10_000


def _picked(rows: DataFrame, ranks: list[int], below: int) -> dict[int, float]:
    """The values of these ranks, of few rows (v); ``below`` counts the values before them."""
    out, at, left = {}, below, sorted(ranks)
    for r in rows.groupBy("v").agg(F.count("*").alias("n")).orderBy("v").collect():
        at += r["n"]
        while left and left[0] < at:
            out[left.pop(0)] = r["v"]
    return out


def order_statistics(rows: DataFrame, ranks: list[int], count: int) -> dict[int, float]:
    """Exact values by rank (from 0) of ``count`` rows (v), sorted without a sort of all.

    Two values near a rank are estimated, and the values before, at and between them are
    counted, which says where the rank lies. The range between shrinks thousands of times
    a step, until its rows can be gathered.
    """
    if count <= EXACT_ROWS:
        return _picked(rows, ranks, 0)
    out = {}
    for rank in sorted(set(ranks)):
        inside, below, n = rows, 0, count
        while rank not in out:
            if n <= EXACT_ROWS:
                out |= _picked(inside, [rank], below)
                break
            share, step = (rank - below + 0.5) / n, 2 / _ACCURACY
            near = F.percentile_approx("v", [max(0.0, share - step), min(1.0, share + step)], _ACCURACY)
            a, b = inside.agg(near).first()[0]
            v = F.col("v")
            parts = (v < a, v == a, (v > a) & (v < b), (v == b) & (v > a), v > b)
            sizes = inside.agg(*[F.count_if(p) for p in parts]).first()
            for part, size, value in zip(parts, sizes, (None, a, None, b, None), strict=True):
                if rank < below + size:
                    if value is not None:
                        out[rank] = value
                    inside, n = inside.filter(part), size
                    break
                below += size
    return out


def percentiles(df: DataFrame, values: Column, wanted: list[float]) -> list[float]:
    """Exact percentiles (0 to 100) by linear interpolation between ranks; 0 without values. Nulls are left out."""
    rows = df.select(values.cast("double").alias("v")).filter("v IS NOT NULL")
    n = rows.count()
    if not n:
        return [0.0] * len(wanted)
    places = [(n - 1) * q / 100 for q in wanted]
    found = order_statistics(rows, [r for p in places for r in {math.floor(p), math.ceil(p)}], n)
    mixed = lambda p: found[math.floor(p)] * (1 - p % 1) + found[math.ceil(p)] * (p % 1)
    return [mixed(p) for p in places]


def latency_summary(df: DataFrame, values: Column) -> list[Column]:
    """Mean, median and 95th percentile of a column as columns of an aggregate over ``df``."""
    p50, p95 = percentiles(df, values, [50, 95])
    return [F.coalesce(F.avg(values), F.lit(0.0)).alias("mean"), F.lit(p50).alias("p50"), F.lit(p95).alias("p95")]


def class_counts(pairs: DataFrame, gold: str, predicted: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, label, tp, n_gold, n_pred) of every class on either side.

    Each row is counted under its gold and its predicted class, so one partial
    aggregation over classes does and rows never meet. A null is a class of its own.
    """
    g, p = F.col(gold), F.col(predicted)
    sides = F.array(
        F.struct(g.alias("label"), g.eqNullSafe(p).cast("int").alias("tp"), F.lit(1).alias("g"), F.lit(0).alias("p")),
        F.struct(p.alias("label"), F.lit(0).alias("tp"), F.lit(0).alias("g"), F.lit(1).alias("p")),
    )
    return (
        pairs.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, "s.label")
        .agg(*[F.sum(f"s.{k}").alias(v) for k, v in (("tp", "tp"), ("g", "n_gold"), ("p", "n_pred"))])
    )


def _f1() -> Column:
    # 2 tp / (gold + predicted) equals the harmonic mean of precision and recall
    return F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("n_gold") + F.col("n_pred")), F.lit(0.0))


def per_class_f1(pairs: DataFrame, gold: str, predicted: str, labels: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, label, f1) of the given labels, or of those that occur in gold.

    A label without rows scores 0. ``labels`` has the columns of ``by`` and label.
    """
    counts, key = class_counts(pairs, gold, predicted, by), [*by, "label"]
    if labels is None:
        return counts.filter("n_gold > 0").select(*key, _f1().alias("f1"))
    return labels.join(counts, key, "left").select(*key, F.coalesce(_f1(), F.lit(0.0)).alias("f1"))


def macro_f1(pairs: DataFrame, gold: str, predicted: str, labels: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """The unweighted mean of the F1 scores: one row, or one a group of ``by``."""
    scores = per_class_f1(pairs, gold, predicted, labels, by)
    return scores.groupBy(*by).agg(F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"))


def cohen_kappa(pairs: DataFrame, a: str, b: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, n, observed, expected, kappa) for two annotators: one row, or one a group of ``by``.

    Without rows kappa is 0. Where chance alone agrees on everything it is 1 if the
    annotators do, else 0.
    """
    counts = class_counts(pairs, a, b, by)
    total = counts.groupBy(*by).agg(
        F.coalesce(F.sum("n_gold"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("tp"), F.lit(0)).alias("hits"),
        F.coalesce(F.sum(F.col("n_gold") * F.col("n_pred")), F.lit(0)).alias("chance"),
    )
    observed = F.coalesce(F.try_divide("hits", "n"), F.lit(0.0))
    expected = F.coalesce(F.try_divide("chance", F.col("n") * F.col("n")), F.lit(0.0))
    one = lambda x: F.abs(x - 1) <= 1e-9
    kappa = (
        F.when(F.col("n") == 0, 0.0)
        .when(one(expected), F.when(one(observed), 1.0).otherwise(0.0))
        .otherwise((observed - expected) / (1 - expected))
    )
    return total.select(*by, "n", observed.alias("observed"), expected.alias("expected"), kappa.alias("kappa"))


def confusions(pairs: DataFrame, gold: str, predicted: str, top: int = 8, pos: str = "pos") -> DataFrame:
    """The most frequent wrong (gold, predicted) pairs; ties by first place.

    No prediction counts as the class ``__invalid__``.
    """
    p = F.coalesce(F.col(predicted), F.lit(INVALID))
    wrong = pairs.select(F.col(gold).alias("gold"), p.alias("predicted"), pos).filter("NOT gold <=> predicted")
    counted = wrong.groupBy("gold", "predicted").agg(F.count("*").alias("count"), F.min(pos).alias("first"))
    return counted.orderBy(F.desc("count"), "first").limit(top).drop("first")


def counted_by(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """(key, count) with the most frequent first and ties by first place."""
    return df.groupBy(key).agg(F.count("*").alias("count"), F.min(pos).alias("first")).orderBy(F.desc("count"), "first")


def matched(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Gold rows with their prediction by id; each side must have each id once.

    Ids on one side only raise, as two lists of unequal length would, and so do ids
    that a side repeats.
    """
    places = F.count("*").over(Window.partitionBy("id"))
    p = predictions.select("id", *[F.col(c).alias(f"p_{c}") for c in predictions.columns if c != "id"], places.alias("p_here"))
    joined = gold.withColumn("g_here", places).join(p, "id", "full_outer")
    once = F.coalesce((F.col("g_here") == 1) & (F.col("p_here") == 1), F.lit(False))
    checked = F.when(once, True).otherwise(F.raise_error(F.concat(F.lit("gold and predictions differ at id "), F.coalesce("id", F.lit("null")))))
    return joined.filter(checked).drop("g_here", "p_here")


def score_system(spark: SparkSession, rows: DataFrame) -> dict:
    """All scores of one system from matched rows (label, p_triage, p_json_valid, p_latency_s, pos)."""
    truth, answer = F.col("label"), F.col("p_triage")
    has = answer.isNotNull()

    def predicted(field: str) -> Column:
        return F.when(has, answer[field]).otherwise(INVALID)

    rouge = F.coalesce(F.avg(F.when(has, rouge_l(truth["summary"], answer["summary"])).otherwise(0.0)), F.lit(0.0))
    named = {
        "json_valid_rate": share(F.col("p_json_valid")),
        "schema_valid_rate": share(has),
        "exact_match": share(exact_match(answer, truth)),
        "summary_rouge_l": rouge,
        **{f"acc_{f}": accuracy(truth[f], predicted(f)) for f in STRUCTURED},
    }
    aggs = [F.count("*").alias("items"), *[c.alias(k) for k, c in named.items()], *latency_summary(rows, F.col("p_latency_s"))]
    one = rows.agg(*aggs).first()
    # one row a field, so that one scan scores all fields
    sides = F.array(*[F.struct(F.lit(f).alias("field"), truth[f].alias("g"), predicted(f).alias("p")) for f in ENUMS])
    flat = rows.select("pos", F.inline(sides))
    classes = enum_dimension(spark).select("field", F.col("value").alias("label"))
    f1 = {r["field"]: r["macro_f1"] for r in macro_f1(flat, "g", "p", classes, ("field",)).collect()}
    wrong = confusions(rows.select("pos", truth["intent"].alias("g"), predicted("intent").alias("p")), "g", "p").collect()
    return {
        "items": one["items"],
        **{k: round(one[k], 4) for k in ("json_valid_rate", "schema_valid_rate", "exact_match", "summary_rouge_l")},
        "field_accuracy": {f: round(one[f"acc_{f}"], 4) for f in STRUCTURED},
        "macro_f1": {f: round(v, 4) for f, v in f1.items()},
        "latency_s_per_item": {k: round(one[k], 3) for k in ("mean", "p50", "p95")},
        "intent_confusions": [r.asDict() for r in wrong],
    }
