"""How far annotators agree, from labels array<struct<model, triage, error, repaired>>."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STRUCTURED
from .metrics import cohen_kappa


def first_invalid(labels: Column) -> Column:
    """1-based position of the first label without triage; 0 if all have one."""
    return F.array_position(F.transform(labels, lambda x: x["triage"].isNull()), True)


def disagreements(labels: Column, fields: tuple[str, ...] = STRUCTURED) -> Column:
    """Fields on which labels differ, in field order; null equals null.

    Any label without triage gives the single entry "invalid".
    """

    def differs(field: str) -> Column:
        first = labels[0]["triage"][field]
        return F.when(F.exists(labels, lambda x: ~x["triage"][field].eqNullSafe(first)), field)

    return F.when(first_invalid(labels) > 0, F.array(F.lit("invalid"))).otherwise(
        F.array_compact(F.array(*[differs(f) for f in fields]))
    )


def teacher_validity(labeled: DataFrame) -> DataFrame:
    """(teacher, tickets, valid, repaired, invalid, models map<model, rows>), teachers from 1."""
    each = labeled.select(F.posexplode("labels").alias("i", "label"))
    by_model = each.groupBy((F.col("i") + 1).alias("teacher"), F.col("label.model").alias("model")).agg(
        F.count("*").alias("tickets"),
        F.count_if(F.col("label.triage").isNotNull()).alias("valid"),
        F.count_if(F.col("label.triage").isNotNull() & F.col("label.repaired")).alias("repaired"),
    )
    models = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("model", F.lit("?")), "tickets"))))
    return by_model.groupBy("teacher").agg(
        F.sum("tickets").alias("tickets"),
        F.sum("valid").alias("valid"),
        F.sum("repaired").alias("repaired"),
        (F.sum("tickets") - F.sum("valid")).alias("invalid"),
        models.alias("models"),
    )


def both_valid(labeled: DataFrame) -> DataFrame:
    """Rows where the first two labels are valid, as structs a and b; later teachers do not count."""
    a, b = F.get("labels", F.lit(0))["triage"], F.get("labels", F.lit(1))["triage"]
    return labeled.filter(a.isNotNull() & b.isNotNull()).select(a.alias("a"), b.alias("b"))


def agreement_table(labeled: DataFrame, fields: tuple[str, ...] = STRUCTURED) -> DataFrame:
    """(field, n, agreement, kappa) for each field, over rows valid for both."""
    # one row a field, so that one scan and one aggregation judge all fields
    sides = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a.{f}").alias("x"), F.col(f"b.{f}").alias("y")) for f in fields])
    found = cohen_kappa(both_valid(labeled).select(F.inline(sides)), "x", "y", ("field",))
    every = labeled.sparkSession.createDataFrame([(f,) for f in fields], "field string").join(found, "field", "left")
    none = F.lit(0.0)
    return every.select(
        "field", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("observed", none).alias("agreement"), F.coalesce("kappa", none).alias("kappa")
    )


def all_fields_agreement(labeled: DataFrame, fields: tuple[str, ...] = STRUCTURED) -> DataFrame:
    """One row: how many rows are valid for both, and the share equal on every field."""
    same = reduce(lambda x, y: x & y, [F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")) for f in fields])
    return both_valid(labeled).agg(
        F.count("*").alias("both_valid"), F.coalesce(F.avg(same.cast("int")), F.lit(0.0)).alias("all_fields")
    )
