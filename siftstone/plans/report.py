"""View models of a run and their HTML."""

from __future__ import annotations

from html import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import STRUCTURED


def funnel_bars(funnel: DataFrame) -> DataFrame:
    """Adds width and dropped_width in percent of the widest step, and the details as text.

    The funnel has one row a step.
    """
    top = F.greatest(F.max(F.col("kept") + F.col("dropped")).over(Window.partitionBy()), F.lit(1))
    told = F.transform(F.map_entries("reasons"), lambda e: F.concat(F.replace(e["key"], F.lit("_"), F.lit(" ")), F.lit(" "), e["value"].cast("string")))
    return funnel.withColumns(
        {
            "width": F.bround(100.0 * F.col("kept") / top, 2),
            "dropped_width": F.bround(100.0 * F.col("dropped") / top, 2),
            "details": F.array_join(told, ", "),
        }
    )


def metric_table(scores: DataFrame, systems: list[str]) -> DataFrame:
    """(metric, one column a system) from wide score rows (system, metrics...)."""
    metrics = [c for c in scores.columns if c != "system"]
    pairs = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    long = scores.select("system", F.expr(f"stack({len(metrics)}, {pairs}) AS (metric, value)"))
    return long.groupBy("metric").pivot("system", systems).agg(F.first("value"))


def curve_point(threshold: Column, value: Column, width: int = 560, height: int = 240, pad: int = 36) -> Column:
    """struct<x, y> of a point of the trade-off curve in a drawing."""
    x = F.bround(pad + threshold * (width - 2 * pad), 1)
    y = F.bround(pad + (1 - value) * (height - 2 * pad), 1)
    return F.struct(x.alias("x"), y.alias("y"))


def curve_path(curve: DataFrame, value: str) -> DataFrame:
    """One row (path): the curve of a value as a drawing path, by threshold."""
    p = curve_point(F.col("threshold"), F.col(value))
    points = F.array_sort(F.collect_list(F.struct("threshold", p["x"].alias("x"), p["y"].alias("y"))))
    step = F.transform(points, lambda q, i: F.concat(F.when(i == 0, "M").otherwise("L"), q["x"].cast("string"), F.lit(","), q["y"].cast("string")))
    return curve.agg(F.array_join(step, " ").alias("path"))


def _table(head: list[str], rows: list[list]) -> str:
    top = "".join(f"<th>{escape(h)}</th>" for h in head)
    body = "".join("<tr>" + "".join(f"<td>{escape(str(c))}</td>" for c in r) + "</tr>" for r in rows)
    return f"<table><tr>{top}</tr>{body}</table>"


def render_html(stats: dict | None, report: dict | None) -> str:
    """A report of one page without anything to load."""
    parts = ["<!doctype html><meta charset=utf-8><title>Run report</title><style>body{font:15px sans-serif;max-width:60em;margin:2em auto}td,th{padding:2px 10px;text-align:left}</style><h1>Run report</h1>"]
    if stats:
        rows = [[s["name"], s["kept"], s["dropped"], ", ".join(f"{k} {v}" for k, v in s["reasons"].items())] for s in stats["funnel"]]
        parts += ["<h2>Funnel</h2>", _table(["step", "kept", "dropped", "reasons"], rows)]
    for name, system in ((report or {}).get("systems") or {}).items():
        rows = [[k, system[k]] for k in ("json_valid_rate", "schema_valid_rate", "exact_match", "summary_rouge_l")]
        rows += [[f"{f} accuracy", system["field_accuracy"][f]] for f in STRUCTURED]
        wrong = [[c["gold"], c["predicted"], c["count"]] for c in system["intent_confusions"][:5]]
        parts += [f"<h2>{escape(name)}</h2>", _table(["metric", "value"], rows), _table(["gold", "predicted", "count"], wrong)]
    router = (report or {}).get("router")
    if router:
        gold = router["gold"]
        parts += ["<h2>Router</h2>", _table(["threshold", "offload rate", "exact match"], [[router["threshold"], gold["offload_rate"], gold["exact_match"]]])]
    costs = ((report or {}).get("cost") or {}).get("per_1k")
    if costs:
        parts += ["<h2>Cost per thousand</h2>", _table(["option", "USD"], [[c["name"], c["usd_per_1k"]] for c in costs])]
    return "\n".join(parts)
