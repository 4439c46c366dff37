"""The filter funnel: gates tag rows, one aggregation counts them.

Order: length, schema validity, teacher agreement, near duplicates, PII rewrite,
balance cap. A row carries the gate that dropped it and why; nothing is split, so
the funnel, the log of dropped rows and the examples are views of one table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pii
from ..functions.contract import ERROR_CHARS
from ..schemas import FUNNEL_STEP, STRUCTURED
from ..sources.scratch import Scratch
from .agreement import disagreements, first_invalid
from .near_dup import near_duplicates
from .quota import first_of_groups

# The default limits.
MIN_CHARS, MAX_CHARS, CAP, SEED = 20, 1500, 80, 42


@dataclass(frozen=True)
class FunnelConfig:
    min_chars: int = MIN_CHARS
    max_chars: int = MAX_CHARS
    require_agreement: bool = True
    agreement_fields: tuple[str, ...] = STRUCTURED
    dedup_threshold: float = 0.7
    dedup_mode: str = "lsh"
    shingle_size: int = 5
    cap: int | None = CAP
    scrub: bool = True
    scrub_dropped: bool = False
    seed: int = SEED


@dataclass
class FunnelResult:
    """examples, dropped and funnel tables, and the tagged rows they come from."""

    examples: DataFrame
    dropped: DataFrame
    funnel: DataFrame
    tagged: DataFrame = field(repr=False)


def length_reason(text: Column, low: int = MIN_CHARS, high: int = MAX_CHARS) -> Column:
    """too_short or too_long; null within the bounds, which are included."""
    n = F.length(F.coalesce(text, F.lit("")))
    return F.when(n < low, "too_short").when(n > high, "too_long")


def schema_reason(labels: Column) -> Column:
    """no_labels, or teacher_N_invalid for the first label without triage."""
    at = first_invalid(labels)
    return F.when(F.coalesce(F.size(labels), F.lit(0)) <= 0, "no_labels").when(
        at > 0, F.concat(F.lit("teacher_"), at.cast("string"), F.lit("_invalid"))
    )


def balance_cap(df: DataFrame, group: str, cap: int, seed: int = SEED, key: str = "id") -> DataFrame:
    """Adds ``kept``: whether a row is among the first ``cap`` of its group in hash order."""
    return first_of_groups(df, F.col(group), lambda n: F.lit(cap), seed, key, "kept")


def _capped_ids(alive: DataFrame, cap: int, seed: int) -> DataFrame:
    """Ids over the cap. Rows that repeat an id share its fate, so ids are ranked."""
    ids = alive.groupBy("id").agg(F.min("pos").alias("pos"), F.min_by("triage.intent", "pos").alias("intent"))
    return balance_cap(ids, "intent", cap, seed).filter("NOT kept").select("id")


def run_funnel(spark: SparkSession, labeled: DataFrame, config: FunnelConfig | None = None, requested: int | None = None) -> FunnelResult:
    """Run all gates over labeled rows (pos, id, text, source, labels).

    ``requested`` adds a head step where it is at least the number of rows. The
    agreement gate is on only if the first row that reaches it has several labels.
    """
    config = config or FunnelConfig()
    scratch = Scratch(spark, "funnel")
    rows = labeled.select("pos", "id", "text", "source", "labels")
    length = length_reason(F.col("text"), config.min_chars, config.max_chars)
    schema = schema_reason(F.col("labels"))
    at = first_invalid(F.col("labels"))
    error = F.when(at > 0, F.get("labels", at.cast("int") - 1)["error"])
    stage = F.when(length.isNotNull(), "length").when(schema.isNotNull(), "schema_valid")
    chars = F.concat(length, F.lit(" ("), F.length("text").cast("string"), F.lit(" chars)"))
    message = F.when(length.isNotNull(), chars).otherwise(F.substring(F.concat_ws(": ", schema, error), 1, ERROR_CHARS))
    tagged = rows.withColumns(
        {
            "stage": stage,
            "keys": F.when(stage.isNotNull(), F.array(F.coalesce(length, schema))),
            "message": F.when(stage.isNotNull(), message),
            "differ": disagreements(F.col("labels"), config.agreement_fields),
        }
    )
    tagged = scratch.save(tagged, "tagged")
    first = tagged.filter("stage IS NULL").agg(F.min_by(F.size("labels"), "pos").alias("n")).first()["n"]
    agreement_on = bool(config.require_agreement and first and first > 1)
    if agreement_on:
        drop = F.col("stage").isNull() & (F.size("differ") > 0)
        tagged = tagged.withColumns(
            {
                "keys": F.when(drop, F.col("differ")).otherwise(F.col("keys")),
                "message": F.when(drop, F.concat(F.lit("teachers disagree: "), F.array_join("differ", ", "))).otherwise(F.col("message")),
                "stage": F.when(drop, "teacher_agreement").otherwise(F.col("stage")),
            }
        )
    alive = tagged.filter("stage IS NULL")
    twins = near_duplicates(spark, alive.select("pos", "text"), config.dedup_threshold, config.dedup_mode, config.shingle_size)
    ids = alive.select(F.col("pos").alias("of"), F.col("id").alias("of_id"))
    twins = twins.join(ids, "of").select("pos", "of_id", "similarity")
    repeat = F.col("of_id").isNotNull()
    cited = F.format_string("near_duplicate of %s (jaccard %s)", F.col("of_id"), F.bround("similarity", 4).cast("string"))
    tagged = tagged.join(twins, "pos", "left").withColumns(
        {
            "keys": F.when(repeat, F.array(F.lit("near_duplicate"))).otherwise(F.col("keys")),
            "message": F.when(repeat, cited).otherwise(F.col("message")),
            "stage": F.when(repeat, "dedup").otherwise(F.col("stage")),
        }
    )
    if config.scrub:
        tagged = pii.with_scrubbed(tagged, "text", "scrubbed", "found")
    else:
        tagged = tagged.withColumns({"scrubbed": F.col("text"), "found": F.lit(None).cast("map<string,bigint>")})
    open_row = F.col("stage").isNull()
    tagged = tagged.withColumns(
        {
            "clean": F.when(open_row, F.col("scrubbed")).otherwise(F.col("text")),
            "pii": F.when(open_row, F.col("found")),
            "triage": F.when(open_row, F.get("labels", F.lit(0))["triage"]),
        }
    ).drop("of_id", "similarity", "differ", "labels", "scrubbed", "found")
    tagged = scratch.save(tagged, "scrubbed")
    if config.cap is not None:
        over = _capped_ids(tagged.filter("stage IS NULL"), config.cap, config.seed).withColumn("over", F.lit(True))
        drop = F.col("stage").isNull() & F.col("over")
        label = F.concat(F.lit("cap_"), F.col("triage.intent"))
        tagged = tagged.join(over, "id", "left").withColumns(
            {
                "keys": F.when(drop, F.array(label)).otherwise(F.col("keys")),
                "message": F.when(drop, label).otherwise(F.col("message")),
                "stage": F.when(drop, "balance").otherwise(F.col("stage")),
            }
        )
        tagged = scratch.save(tagged.drop("over"), "capped")
    logged = pii.scrub(F.col("text")) if config.scrub_dropped else F.col("text")
    dropped = tagged.filter("stage IS NOT NULL").select("pos", "id", "stage", F.col("message").alias("reason"), logged.alias("text"))
    examples = tagged.filter("stage IS NULL").select("pos", "id", F.col("clean").alias("text"), "triage", "source")
    funnel = funnel_table(spark, tagged, config, agreement_on, requested)
    return FunnelResult(examples, dropped, funnel, tagged)


def drop_reasons(tagged: DataFrame) -> DataFrame:
    """(stage, reason, count); a row with several reasons counts under each."""
    return tagged.filter("stage IS NOT NULL").select("stage", F.explode("keys").alias("reason")).groupBy("stage", "reason").agg(F.count("*").alias("count"))


def funnel_table(spark: SparkSession, tagged: DataFrame, config: FunnelConfig, agreement_on: bool, requested: int | None) -> DataFrame:
    """(ord, name, description, kept, dropped, modified, reasons) from the counts by stage."""
    total = tagged.count()
    gone = {r["stage"]: r["n"] for r in tagged.filter("stage IS NOT NULL").groupBy("stage").agg(F.count("*").alias("n")).collect()}
    why: dict[str, dict[str, int]] = {}
    for r in drop_reasons(tagged).orderBy("stage", "reason").collect():
        why.setdefault(r["stage"], {})[r["reason"]] = r["count"]
    kinds = tagged.select(F.explode("pii").alias("kind", "n")).groupBy("kind").agg(F.sum("n").alias("n"))
    found = {r["kind"]: r["n"] for r in kinds.orderBy("kind").collect()}
    rewritten = tagged.filter("size(pii) > 0").count()
    steps: list[tuple] = []
    if requested is not None and requested >= total:
        lost = requested - total
        steps.append(("requested", "texts asked of the teacher", requested, 0, 0, {}))
        steps.append(("generated", "texts the teacher returned", total, lost, 0, {"missing_from_teacher_output": lost} if lost else {}))
    else:
        steps.append(("input", "rows that came in", total, 0, 0, {}))
    kept = total
    gates = [("length", f"{config.min_chars} to {config.max_chars} characters"), ("schema_valid", "every label keeps the contract")]
    if agreement_on:
        gates.append(("teacher_agreement", "teachers agree on " + ", ".join(config.agreement_fields)))
    gates.append(("dedup", f"no similar earlier text (jaccard {config.dedup_threshold} or more)"))
    if config.scrub:
        gates.append(("pii_scrub", "e-mail, phone and card numbers replaced"))
    if config.cap is not None:
        gates.append(("balance", f"at most {config.cap} of an intent"))
    for name, description in gates:
        n = gone.get(name, 0)
        kept -= n
        scrub = name == "pii_scrub"
        steps.append((name, description, kept, n, rewritten if scrub else 0, found if scrub else why.get(name, {})))
    return spark.createDataFrame([(i, *s) for i, s in enumerate(steps)], FUNNEL_STEP)
