"""Building the chat dataset: split, records, statistics and card."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.contract import check_triage, triage_json
from ..functions.text import word_count
from ..schemas import ENUMS
from .metrics import percentiles
from .quota import first_of_groups

SYSTEM_PROMPT = (
    "You triage customer tickets. Answer with one JSON object with the keys intent, urgency, sentiment, "
    "product_area, order_id and summary, and nothing else."
)


def stratified_split(examples: DataFrame, group: Column, fraction: float, seed: int = 42, key: str = "id") -> DataFrame:
    """Adds ``split``: val for the share of each group that comes first in hash order, else train.

    A group gives its rows times the fraction, rounded half to even, and at least
    one if it has two or more and the fraction is above 0. The order of the input
    does not matter.
    """
    if not 0 <= fraction < 0.5:
        raise ValueError("the fraction must be at least 0 and below a half")

    def wanted(n: Column) -> Column:
        share = F.bround(n * F.lit(float(fraction)), 0).cast("long")
        return F.when((n >= 2) & F.lit(fraction > 0), F.greatest(share, F.lit(1).cast("long"))).otherwise(share)

    split = F.when(F.col("__val"), "val").otherwise("train")
    return first_of_groups(examples, group, wanted, seed, key, "__val").withColumn("split", split).drop("__val")


def chat_records(examples: DataFrame, system: str = SYSTEM_PROMPT) -> DataFrame:
    """(id, messages): system, the text as user, and the answer to learn as assistant."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = F.array(
        message("system", F.lit(system)), message("user", F.col("text")), message("assistant", triage_json(F.col("triage")))
    )
    return examples.select("id", messages.alias("messages"))


def from_chat_records(records: DataFrame) -> DataFrame:
    """(id, text, triage, source) of the first user and first assistant message."""

    def first(role: str) -> Column:
        return F.get(F.filter("messages", lambda m: m["role"] == role), F.lit(0))["content"]

    checked = check_triage(first("assistant"))["triage"]
    return records.select("id", first("user").alias("text"), checked.alias("triage"), F.lit("synthetic").alias("source"))


def conversation_records(turns: DataFrame) -> DataFrame:
    """(conv_id, messages) of turn rows (conv_id, turn, role, text), in turn order."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def label_distribution(examples: DataFrame) -> DataFrame:
    """(field, label, count, first): enum values that occur, and order_id as present or null."""
    values = [F.struct(F.lit(f).alias("field"), F.col(f"triage.{f}").alias("label")) for f in ENUMS]
    each = examples.select("pos", F.explode(F.array(*values)).alias("v"))
    enums = each.groupBy("v.field", "v.label").agg(F.count("*").alias("count"), F.min("pos").alias("first"))
    has = F.coalesce(F.col("triage.order_id") != "", F.lit(False))
    order = examples.agg(F.count_if(has).alias("present"), F.count_if(~has).alias("null"))
    order = order.select(
        F.lit("order_id").alias("field"), F.expr("stack(2, 'present', present, 'null', `null`) AS (label, count)")
    ).select("field", "label", "count", F.lit(None).cast("long").alias("first"))
    return enums.unionByName(order)


def share_of_field(distribution: DataFrame) -> DataFrame:
    """Adds ``share`` of the field's total and ``width`` against its largest count."""
    by = Window.partitionBy("field")
    total, top = F.sum("count").over(by), F.max("count").over(by)
    return distribution.withColumns({"share": F.col("count") / F.greatest(total, F.lit(1)), "width": 100.0 * F.col("count") / F.greatest(top, F.lit(1))})


def text_stats(df: DataFrame) -> DataFrame:
    """One row: rows, min, p50, p95 and max characters, p50 words; 0 without rows."""
    chars = F.length(F.coalesce("text", F.lit("")))
    p50, p95 = percentiles(df, chars, [50, 95])
    (words,) = percentiles(df, word_count(F.coalesce("text", F.lit(""))), [50])
    whole = lambda value: F.lit(round(value)).cast("long")
    zero = F.lit(0)
    return df.agg(
        F.count("*").alias("total"),
        F.coalesce(F.min(chars), zero).cast("long").alias("min_chars"),
        whole(p50).alias("p50_chars"),
        whole(p95).alias("p95_chars"),
        F.coalesce(F.max(chars), zero).cast("long").alias("max_chars"),
        whole(words).alias("p50_words"),
    )


def seed_summary(seeds: DataFrame) -> DataFrame:
    """(key, value, count) over a seed map, without its id; booleans as true or false."""
    each = seeds.select(F.explode("seed").alias("key", "value")).filter("key <> 'id' AND value IS NOT NULL")
    return each.groupBy("key", "value").agg(F.count("*").alias("count"))


def dataset_stats(examples: DataFrame, funnel: DataFrame, label_stats: dict | None, teachers: list[str], created: str) -> dict:
    """The statistics document of a split dataset (pos, id, text, triage, source, split)."""
    text = text_stats(examples).first()
    sizes = {r["split"]: r["count"] for r in examples.groupBy("split").count().collect()}
    parts = {"train": examples.filter("split = 'train'"), "val": examples.filter("split = 'val'"), "all": examples}
    tagged = [label_distribution(df).withColumn("part", F.lit(name)) for name, df in parts.items()]
    shares: dict[str, dict[str, dict[str, int]]] = {name: {f: {} for f in (*ENUMS, "order_id")} for name in parts}
    rows = reduce(DataFrame.unionByName, tagged).orderBy("part", "field", F.desc("count"), "first").collect()
    for r in rows:
        shares[r["part"]][r["field"]][r["label"]] = r["count"]
    for part in shares.values():
        part["order_id"] = {k: part["order_id"].get(k, 0) for k in ("present", "null")}
    sources = examples.groupBy("source").agg(F.count("*").alias("n"), F.min("pos").alias("first")).orderBy("first")
    return {
        "created": created,
        "teachers": teachers,
        "sizes": {"train": sizes.get("train", 0), "val": sizes.get("val", 0), "total": text["total"]},
        "sources": {r["source"]: r["n"] for r in sources.collect()},
        "text_chars": {k: text[f"{k}_chars"] for k in ("min", "p50", "p95", "max")},
        "text_words_p50": text["p50_words"],
        "distribution": shares,
        "funnel": [{k: v for k, v in r.asDict().items() if k != "ord"} for r in funnel.orderBy("ord").collect()],
        "label_agreement": label_stats or {},
    }


def dataset_card(stats: dict, name: str) -> str:
    """The statistics as Markdown."""
    sizes, chars = stats["sizes"], stats["text_chars"]
    out = [
        f"# {name}",
        "",
        f"Made {stats['created']} with teachers {', '.join(stats['teachers'])}.",
        f"{sizes['total']} examples: {sizes['train']} to train on, {sizes['val']} to validate, stratified by intent.",
        f"Texts have {chars['p50']} characters at the median, {chars['p95']} at the 95th percentile, "
        f"and {stats['text_words_p50']} words at the median.",
        "",
        "| step | rule | kept | dropped | details |",
        "|---|---|---:|---:|---|",
    ]
    for step in stats["funnel"]:
        details = ", ".join(f"{k}: {v}" for k, v in step["reasons"].items())
        if step["modified"]:
            details = f"{step['modified']} rewritten ({details})"
        out.append(f"| {step['name']} | {step['description']} | {step['kept']} | {step['dropped'] or ''} | {details} |")
    agreement = stats["label_agreement"]
    if agreement.get("fields"):
        out += [
            "",
            f"Both teachers were valid on {agreement['both_valid']} of {agreement['tickets']} rows and agreed on all "
            f"fields on {agreement['all_fields_agreement']:.1%} of these.",
            "",
            "| field | agreement | kappa |",
            "|---|---:|---:|",
        ]
        out += [f"| {f} | {v['agreement']:.1%} | {v['kappa']:.2f} |" for f, v in agreement["fields"].items()]
    out.append("")
    for field, counts in stats["distribution"]["all"].items():
        total = sum(counts.values()) or 1
        out.append(f"- {field}: " + ", ".join(f"{label} {n} ({n / total:.0%})" for label, n in counts.items()))
    return "\n".join([*out, ""])
