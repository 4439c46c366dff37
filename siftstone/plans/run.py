"""The seven stages of a run over a run folder: each reads and writes its artifacts."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.contract import exact_match, triage_schema
from ..functions.prompts import generation_schema
from ..operators import batching, cost, dataset, router, student, teacher
from ..operators.agreement import agreement_table, all_fields_agreement, teacher_validity
from ..operators.funnel import run_funnel
from ..operators.metrics import matched, score_system
from ..schemas import CHAT, EXAMPLE, INTENTS, LABELED, PRICE, RAW, RunPaths
from ..sources import tables
from ..sources.providers import endpoint
from ..sources.scratch import Scratch
from .config import RunConfig
from .report import render_html


class Run:
    """A run folder and its settings."""

    def __init__(self, spark: SparkSession, config: RunConfig):
        self.spark, self.config = spark, config
        self.paths = RunPaths(config.output_dir, config.dataset_dir)
        self.at = self.paths.artifacts

    def _need(self, name: str, stage: str) -> str:
        return tables.require(self.spark, self.at[name], stage)

    def generate(self, num: int | None = None, topics: tuple[str, ...] = INTENTS, prefix: str = "s", append: bool = False, imports: str | None = None) -> DataFrame:
        """Write tickets from a seed matrix, or import them; append adds a pass."""
        num = self.config.num_tickets if num is None else num
        if imports:
            new = tables.import_records(self.spark, imports)
        else:
            seeds = batching.seed_matrix(self.spark, num, self.config.seed, topics, prefix)
            c = self.config
            if c.generator.startswith("offline"):
                new = teacher.write_tickets(seeds, c.generator)
            else:
                remote = self.asker("generate", [c.generator], generation_schema())
                new = teacher.ask_for_tickets(Scratch(self.spark, "generate").save(seeds, "seeds"), remote, c.generator, c.tickets_per_call)
        manifest = {"passes": []}
        if append and tables.exists(self.spark, self.at["generated"]):
            old = tables.read_raw(self.spark, self.at["generated"])
            new = tables.append_records(old, new)
            manifest = tables.read_document(self.spark, self.at["generation"]) or manifest
        tables.write_jsonl(new, self.at["generated"])
        new = tables.read_raw(self.spark, self.at["generated"])
        n = new.count()
        if imports:
            manifest["imported"] = n
        else:
            manifest["passes"].append({"requested": num, "generated": n, "topics": list(topics), "id_prefix": prefix})
        tables.write_document(self.spark, manifest, self.at["generation"])
        return new

    def asker(self, stage: str, models, schema: dict | None = None) -> teacher.RemoteTeacher:
        """Who answers for the models of a stage, with the run's cache, ledger, budget, guide and pace."""
        c = self.config
        settings = {"effort": c.reasoning_effort, "max_tokens": c.max_tokens, "timeout": c.timeout_seconds, "schema": schema or triage_schema(True)}
        made = {}
        for m in models:
            if not m.startswith("offline"):
                own = {"fallbacks": c.fallback_models} if m.startswith("openrouter/") else {}
                made[m] = endpoint(m, free_only=c.require_free_models, **settings, **own)
        pace = {"spacing": c.seconds_between_calls, "retries": c.max_retries, "base": c.retry_seconds, "tasks": c.call_tasks}
        now = datetime.now(UTC).isoformat(timespec="seconds")
        guide = tables.read_document(self.spark, c.guide_path) if c.guide_path else None
        return teacher.RemoteTeacher(self.spark, made, stage, c.cache_dir or self.at["cache"], self.at["calls"], now, c.max_calls, guide, **pace)

    def label(self) -> DataFrame:
        rows = tables.read_jsonl(self.spark, self._need("generated", "generate"), RAW)
        c = self.config
        ask = self.asker("label", c.teachers)
        labeled = teacher.label_tickets(rows, list(c.teachers), c.label_batch, c.repairs, c.scrub_before_teacher, ask)
        tables.write_jsonl(labeled.select("pos", "id", "text", "source", "seed", "labels"), self.at["labeled"])
        labeled = tables.read_jsonl(self.spark, self.at["labeled"], LABELED)
        tables.write_document(self.spark, label_stats(labeled), self.at["label_stats"])
        return labeled

    def requested(self) -> int | None:
        """How many tickets the passes asked for; unknown after an import."""
        manifest = tables.read_document(self.spark, self.at["generation"]) or {}
        if "imported" in manifest:
            return None
        return sum(p["requested"] for p in manifest.get("passes", [])) or None

    def filter(self):
        labeled = tables.read_jsonl(self.spark, self._need("labeled", "label"), LABELED)
        made = run_funnel(self.spark, labeled, self.config.filter, self.requested())
        tables.write_jsonl(made.examples, self.at["filtered"])
        tables.write_jsonl(made.dropped, self.at["dropped"])
        steps = [{k: v for k, v in r.asDict().items() if k != "ord"} for r in made.funnel.orderBy("ord").collect()]
        tables.write_document(self.spark, steps, self.at["funnel"])
        return made

    def build(self, created: str | None = None) -> dict:
        examples = tables.read_jsonl(self.spark, self._need("filtered", "filter"), EXAMPLE)
        split = dataset.stratified_split(examples, F.col("triage.intent"), self.config.val_fraction, self.config.seed)
        for name in ("train", "val"):
            part = split.filter(F.col("split") == name)
            order = F.sha2(F.concat(F.lit(f"{self.config.seed}:order:"), F.col("id")), 256)
            tables.write_jsonl(dataset.chat_records(part.orderBy(order)), self.at[f"dataset_{name}"])
        steps = tables.read_document(self.spark, self.at["funnel"]) or []
        funnel = self.spark.createDataFrame(
            [(i, s["name"], s["description"], s["kept"], s["dropped"], s["modified"], s["reasons"]) for i, s in enumerate(steps)],
            "ord int, name string, description string, kept long, dropped long, modified long, reasons map<string,long>",
        )
        created = created or datetime.now(UTC).date().isoformat()
        stats = dataset.dataset_stats(split, funnel, tables.read_document(self.spark, self.at["label_stats"]), list(self.config.teachers), created)
        tables.write_document(self.spark, stats, self.at["dataset_stats"])
        tables.write_document(self.spark, dataset.dataset_card(stats, "dataset"), self.at["dataset_readme"])
        return stats

    def train(self) -> dict:
        """Fit the baseline student; the keyword student has nothing to learn."""
        if self.config.student == "keyword":
            return {}
        examples = dataset.from_chat_records(tables.read_jsonl(self.spark, self._need("dataset_train", "build"), CHAT))
        student.train_baseline(examples).write().overwrite().save(self.at["model"])
        metrics = {"examples": examples.count(), "student": self.config.student}
        tables.write_document(self.spark, metrics, self.at["train_metrics"])
        return metrics

    def predict(self, rows: DataFrame) -> DataFrame:
        if self.config.student == "keyword":
            return student.keyword_student(rows)
        from pyspark.ml import PipelineModel

        return student.baseline_student(PipelineModel.load(self._need("model", "train")), rows)

    def evaluate(self, tokens: tuple[float, float] | None = None, student_seconds: float | None = None) -> dict:
        """Score teacher and student on gold; tokens an item are those measured unless they are given."""
        c = self.config
        gold = tables.load_gold(self.spark, c.gold_path, c.gold_limit)
        report: dict = {"systems": {}}
        own = self.predict(gold.select("pos", "id", "text"))
        tables.write_jsonl(own, self.paths.predictions("student"))
        ask = self.asker("evaluate", c.teachers[:1])
        asked = teacher.label_tickets(gold.select("pos", "id", "text"), [c.teachers[0]], c.label_batch, c.repairs, c.scrub_before_teacher, ask)
        label = F.get("labels", F.lit(0))["triage"]
        # a teacher answer is JSON exactly if it keeps the contract
        answers = asked.select("pos", "id", label.alias("triage"), label.isNotNull().alias("json_valid"))
        answers = answers.join(self._waits(answers, ask), "pos", "left").fillna(0.0, ["latency_s"])
        tables.write_jsonl(answers, self.paths.predictions("teacher"))
        for name, predictions in (("teacher", answers), ("student", own)):
            rows = matched(gold, predictions.drop("pos"))
            report["systems"][name] = score_system(self.spark, rows)
        joined = matched(gold, own.drop("pos")).select(
            "pos", "id", "label", F.col("p_triage").alias("student"), F.col("p_json_valid").alias("json_valid"), F.col("p_confidence").alias("confidence")
        ).join(answers.select("id", F.col("triage").alias("teacher")), "id", "left")
        threshold = router.choose_threshold(c.min_confidence, self._calibration(), c.target_exact_match)
        if ask.usage:
            calls = reduce(DataFrame.unionByName, ask.usage)
            used = cost.token_usage(calls).first()
            report["teacher_usage"] = {"calls": calls.count(), **{k: round(v, 1) for k, v in used.asDict().items()}}
            tokens = tokens or tuple(used)
        report["router"] = router.report_section(joined, threshold, True) | {"student_backend": c.student}
        prices = self.spark.createDataFrame([(*p, "") for p in c.prices], PRICE)
        lines = cost.cost_table(self.spark, prices, *(tokens or (0.0, 0.0)), student_seconds, config=c.cost)
        report["cost"] = {"per_1k": [r.asDict() for r in lines.collect()]}
        routed = cost.routed_table(lines, report["router"]["gold"]["offload_rate"]).collect()
        report["cost"]["routed"] = [r.asDict() for r in routed]
        tables.write_document(self.spark, report, self.at["report"])
        return report

    def _waits(self, rows: DataFrame, ask: teacher.RemoteTeacher) -> DataFrame:
        """(pos, latency_s): the seconds of each row's first call, shared by the items of the call."""
        if not ask.usage:
            return rows.select("pos", F.lit(0.0).alias("latency_s"))
        batch = F.floor(F.col("pos") / self.config.label_batch).cast("long").alias("batch")
        each = ask.usage[0].select("batch", (F.col("latency_s") / F.col("items")).alias("latency_s"))
        return rows.select("pos", batch).join(each, "batch").select("pos", "latency_s")

    def _calibration(self) -> DataFrame | None:
        if not tables.exists(self.spark, self.at["dataset_val"]):
            return None
        val = tables.read_jsonl(self.spark, self.at["dataset_val"], CHAT)
        truth = dataset.from_chat_records(val).join(val.select("id", "pos"), "id")
        own = self.predict(truth.select("pos", "id", "text")).select("id", F.col("triage").alias("answer"), "confidence")
        rows = truth.join(own, "id")
        return rows.select("pos", "confidence", exact_match(F.col("answer"), F.col("triage")).alias("correct"))

    def report(self) -> str:
        html = render_html(tables.read_document(self.spark, self.at["dataset_stats"]), tables.read_document(self.spark, self.at["report"]))
        tables.write_document(self.spark, html, self.at["html"])
        return self.at["html"]

    def export(self, target: str) -> list[str]:
        """Copy the artifacts that exist to another folder, a dataset override under dataset/."""
        to = RunPaths(target)
        skip = {"cache", "html"}
        pairs = [(path, to.artifacts[name]) for name, path in self.at.items() if name not in skip]
        pairs += [(self.paths.predictions(s), to.predictions(s)) for s in ("teacher", "student")]
        return tables.copy_paths(self.spark, pairs)

    def run_all(self) -> None:
        self.generate()
        self.label()
        self.filter()
        self.build()
        self.train()
        if self.config.gold_path:
            self.evaluate()
        self.report()


def label_stats(labeled: DataFrame) -> dict:
    """Validity by teacher and agreement of the first two, rounded to four places."""
    whole = all_fields_agreement(labeled).first()
    fields = {r["field"]: {"agreement": round(r["agreement"], 4), "kappa": round(r["kappa"], 4)} for r in agreement_table(labeled).collect()}
    return {
        "tickets": labeled.count(),
        "teachers": [r.asDict() for r in teacher_validity(labeled).orderBy("teacher").collect()],
        "both_valid": whole["both_valid"],
        "all_fields_agreement": round(whole["all_fields"], 4),
        "fields": fields,
    }
