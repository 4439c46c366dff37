"""What answers cost per thousand, in dollars."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CostConfig:
    # The default instance prices and the assumed speed on a GPU.
    cpu_hourly: float = 0.68
    gpu_hourly: float = 0.80
    gpu_items_per_second: float = 20.0
    cpu_workers: int = 1


def api_per_1k(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column) -> Column:
    """Tokens per item at prices per million."""
    return (tokens_in * price_in + tokens_out * price_out) / 1e6 * 1000


def self_hosted_per_1k(seconds: Column, hourly: Column, workers: Column) -> Column:
    return seconds * 1000 / 3600 / F.greatest(workers, F.lit(1)) * hourly


def routed_per_1k(student: Column, teacher: Column, offload: Column) -> Column:
    """Every item costs the student, the rest the teacher too."""
    return student + (1 - offload) * teacher


def cost_table(
    spark: SparkSession,
    prices: DataFrame,
    tokens_in: float,
    tokens_out: float,
    student_seconds: float | None,
    on_gpu: bool = False,
    config: CostConfig | None = None,
) -> DataFrame:
    """(name, usd_per_1k, measured).

    API rows need measured tokens, the student row a measured time; the assumed GPU
    row is left out once a GPU was measured.
    """
    c = config or CostConfig()
    api = api_per_1k(F.lit(tokens_in), F.lit(tokens_out), F.col("input_per_million"), F.col("output_per_million"))
    out = prices.select(F.concat(F.lit("teacher: "), "name").alias("name"), F.bround(api, 4).alias("usd_per_1k"), F.lit(True).alias("measured"))
    out = out.filter(F.lit(bool(tokens_in or tokens_out)))
    own = []
    if student_seconds is not None:
        hourly, workers = (c.gpu_hourly, 1) if on_gpu else (c.cpu_hourly, c.cpu_workers)
        own.append(("student: " + ("GPU" if on_gpu else "CPU"), float(student_seconds), hourly, workers, True))
    if not (on_gpu and student_seconds is not None):
        own.append(("student: GPU, assumed", 1 / c.gpu_items_per_second, c.gpu_hourly, 1, False))
    rows = spark.createDataFrame(own, "name string, seconds double, hourly double, workers int, measured boolean")
    price = self_hosted_per_1k(F.col("seconds"), F.col("hourly"), F.col("workers"))
    return out.unionByName(rows.select("name", F.bround(price, 4).alias("usd_per_1k"), "measured"))


def routed_table(costs: DataFrame, offload: float) -> DataFrame:
    """(teacher, usd_per_1k) of routing, for each teacher with the measured student; empty without one."""
    student = costs.filter("name LIKE 'student: %' AND measured").select(F.col("usd_per_1k").alias("s")).limit(1)
    teachers = costs.filter("name LIKE 'teacher: %'")
    price = routed_per_1k(F.col("s"), F.col("usd_per_1k"), F.lit(float(offload)))
    # one student row, so the product has a row a teacher
    return teachers.join(F.broadcast(student)).select(F.expr("substring(name, 10)").alias("teacher"), F.bround(price, 4).alias("usd_per_1k"))


def token_usage(calls: DataFrame) -> DataFrame:
    """One row: tokens in and out per item over call statistics."""
    items = F.greatest(F.coalesce(F.sum("items"), F.lit(0)), F.lit(1))
    return calls.agg(
        (F.coalesce(F.sum("input_tokens"), F.lit(0)) / items).alias("input_per_item"),
        (F.coalesce(F.sum("output_tokens"), F.lit(0)) / items).alias("output_per_item"),
    )


def latency_per_item(calls: DataFrame) -> DataFrame:
    """A row an item with its share of the call's latency."""
    return calls.filter("items > 0").select(F.explode(F.sequence(F.lit(1), F.col("items"))), (F.col("latency_s") / F.col("items")).alias("latency_s")).select("latency_s")
