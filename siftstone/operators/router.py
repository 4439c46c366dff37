"""Routing between a student and its teacher: decisions, calibration, what-if."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.contract import exact_match
from ..schemas import STRUCTURED
from ..sources.scratch import Scratch
from .metrics import share

# No threshold accepts anything; the fewest rows a calibration trusts;
# the threshold without anything to calibrate on.
NEVER, MIN_ACCEPTED, DEFAULT = 1.01, 5, 0.5
STEPS = 20


def decide(json_valid: Column, triage: Column, confidence: Column, threshold) -> Column:
    """struct<route, reason>: the student answers where it is valid and sure enough."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    low = F.format_string("confidence %.2f below %.2f", confidence, threshold)
    fine = F.format_string("confidence %.2f at or above %.2f", confidence, threshold)
    reason = (
        F.when(~F.coalesce(json_valid, F.lit(False)), "student output is not JSON")
        .when(triage.isNull(), "student output breaks the contract")
        .when(confidence < threshold, low)
    )
    return F.struct(F.when(reason.isNull(), "student").otherwise("teacher").alias("route"), F.coalesce(reason, fine).alias("reason"))


def calibrate(rows: DataFrame, target: float, confidence: str = "confidence", correct: str = "correct", pos: str = "pos", min_accepted: int = MIN_ACCEPTED) -> DataFrame:
    """One row (threshold): the least confidence from which on the student is right often enough.

    Rows are sorted by confidence, ties by place. The first row above 0 whose suffix
    has enough rows and a mean at the target gives its confidence; else 1.01. The
    suffix is one of rows, so among equal confidences a later row can decide. Rows are
    range-partitioned in that order, ties included; a suffix is the rest of its own
    range and the totals of the ranges after it. Nulls are least, and a null flag is
    no vote.
    """
    told = rows.select(F.col(confidence).alias("c"), F.col(pos).alias("p"), F.col(correct).cast("int").alias("y"))
    dealt = told.repartitionByRange("c", "p").withColumn("part", F.spark_partition_id())
    # the ranges are drawn from a sample, so they are written once and read by both sides
    dealt = Scratch(rows.sparkSession, "calibration").save(dealt, "ranges")
    sums = [F.coalesce(F.sum("y"), F.lit(0)).alias("s"), F.count("y").alias("v"), F.count("*").alias("n")]
    after = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ranges = dealt.groupBy("part").agg(*sums).select("part", *[F.coalesce(F.sum(x).over(after), F.lit(0)).alias(f"{x}_after") for x in "svn"])
    # from the end: a frame that grows is summed once, one that shrinks anew for every row
    suffix = Window.partitionBy("part").orderBy(F.desc("c"), F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    judged = dealt.join(F.broadcast(ranges), "part").select(
        "c",
        (F.coalesce(F.sum("y").over(suffix), F.lit(0)) + F.col("s_after")).alias("s"),
        (F.count("y").over(suffix) + F.col("v_after")).alias("v"),
        (F.count("*").over(suffix) + F.col("n_after")).alias("n"),
    )
    good = judged.filter((F.col("c") > 0) & (F.col("n") >= min_accepted) & (F.try_divide("s", "v") >= target))
    return good.agg(F.coalesce(F.min("c"), F.lit(NEVER)).alias("threshold"))


def _routed(rows: DataFrame, threshold: Column) -> DataFrame:
    by_student = decide(F.col("json_valid"), F.col("student"), F.col("confidence"), threshold)["route"] == "student"
    routed = rows.withColumn("by_student", by_student)
    return routed.withColumn("answer", F.when(F.col("by_student"), F.col("student")).otherwise(F.col("teacher")))


def _outcome() -> list[Column]:
    right = exact_match(F.col("answer"), F.col("label"))
    has = F.col("answer").isNotNull()
    fields = [share(has & F.col(f"answer.{f}").eqNullSafe(F.col(f"label.{f}"))).alias(f"acc_{f}") for f in STRUCTURED]
    return [
        F.count("*").alias("items"),
        share(F.col("by_student")).alias("offload_rate"),
        share(right).alias("exact_match"),
        F.avg(F.when(F.col("by_student"), right.cast("int"))).alias("exact_match_offloaded"),
        *fields,
    ]


def simulate(rows: DataFrame, threshold: float) -> DataFrame:
    """One row: how routing at a threshold does on rows (label, teacher, student, json_valid, confidence).

    Rates are 0 without rows; exact_match_offloaded is null where nothing is offloaded.
    """
    return _routed(rows, F.lit(float(threshold))).agg(*_outcome()).withColumn("threshold", F.lit(float(threshold)))


def without_teacher(rows: DataFrame) -> DataFrame:
    """The same rows with no teacher answer: what the student does alone."""
    return rows.withColumn("teacher", F.lit(None).cast(rows.schema["teacher"].dataType))


def tradeoff_curve(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """simulate at steps + 1 thresholds from 0 to 1, in one aggregation."""
    at = F.explode(F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: F.bround(i / F.lit(float(steps)), 3)))
    return _routed(rows.withColumn("threshold", at), F.col("threshold")).groupBy("threshold").agg(*_outcome())


def choose_threshold(setting, calibration: DataFrame | None, target: float) -> float:
    """A fixed number, the calibrated one, or the default without anything to calibrate on."""
    if setting != "auto":
        return float(setting)
    if calibration is None or calibration.isEmpty():
        return DEFAULT
    return calibrate(calibration, target).first()["threshold"]


def serving_threshold(setting, report: dict | None, backend: str) -> float:
    """A fixed number, or the report's if it was calibrated for this kind of student."""
    if setting != "auto":
        return float(setting)
    router = (report or {}).get("router") or {}
    same = router.get("student_backend") == backend
    return float(router["threshold"]) if same and router.get("threshold") is not None else DEFAULT


def compare_answers(rows: DataFrame) -> DataFrame:
    """Adds ``differs``: fields on which a teacher answer differs from the student's."""
    flags = [F.when(F.col("teacher").isNotNull() & ~F.col(f"student.{f}").eqNullSafe(F.col(f"teacher.{f}")), f) for f in (*STRUCTURED, "summary")]
    return rows.withColumn("differs", F.array_compact(F.array(*flags)))


def report_section(rows: DataFrame, threshold: float, has_teacher: bool) -> dict:
    """The router part of a report, rounded to four places."""

    def rounded(r) -> dict:
        named = {k: r[k] for k in ("threshold", "items", "offload_rate", "exact_match", "exact_match_offloaded")}
        named["field_accuracy"] = {f: round(r[f"acc_{f}"], 4) for f in STRUCTURED}
        return {k: round(v, 4) if isinstance(v, float) else v for k, v in named.items()}

    rows = rows if has_teacher else without_teacher(rows)
    out = {"threshold": threshold, "gold": rounded(simulate(rows, threshold).first())}
    if has_teacher:
        out["curve"] = [rounded(r) for r in tradeoff_curve(rows).orderBy("threshold").collect()]
    return out


def threshold_dimension(spark: SparkSession, steps: int = STEPS) -> DataFrame:
    return spark.range(steps + 1).select(F.bround(F.col("id") / steps, 3).alias("threshold"))
