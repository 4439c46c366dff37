"""The data model: record schemas, enums and the layout of a run directory."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The closed enums of the triage contract, in their order.
INTENTS = (
    "order_status",
    "refund_request",
    "return_exchange",
    "billing_issue",
    "cancellation",
    "technical_issue",
    "setup_help",
    "account_access",
    "product_question",
    "feedback",
    "other",
)
URGENCIES = ("low", "medium", "high")
SENTIMENTS = ("negative", "neutral", "positive")
PRODUCT_AREAS = ("lighting", "thermostat", "camera", "doorbell", "app_account", "subscription", "none")

ENUMS = {"intent": INTENTS, "urgency": URGENCIES, "sentiment": SENTIMENTS, "product_area": PRODUCT_AREAS}
#: Fields with an exact truth; the summary is free text and scored apart.
STRUCTURED = ("intent", "urgency", "sentiment", "product_area", "order_id")
FIELDS = (*STRUCTURED, "summary")
#: Class of an answer that did not validate.
INVALID = "__invalid__"

TRIAGE = "struct<intent:string,urgency:string,sentiment:string,product_area:string,order_id:string,summary:string>"
LABEL = f"struct<model:string,triage:{TRIAGE},error:string,repaired:boolean>"

#: DDL by record; every table that needs an order carries pos.
RAW = "id string, text string, source string, seed map<string,string>, generator_model string"
LABELED = f"id string, text string, source string, seed map<string,string>, labels array<{LABEL}>"
EXAMPLE = f"id string, text string, triage {TRIAGE}, source string"
DROPPED = "id string, stage string, reason string, text string"
FUNNEL_STEP = "ord int, name string, description string, kept long, dropped long, modified long, reasons map<string,long>"
GOLD = f"id string, text string, label {TRIAGE}, note string"
PREDICTION = (
    f"id string, raw string, triage {TRIAGE}, json_valid boolean, error string, confidence double, "
    "field_confidence map<string,double>, latency_s double"
)
LEDGER = (
    "ts string, stage string, task string, provider string, served_model string, status string, latency_s double, "
    "input_tokens int, output_tokens int, items int, error string"
)
CHAT = "id string, messages array<struct<role:string,content:string>>"
SEED = (
    "id string, topic string, product string, tone string, length string, style string, "
    "order_number boolean, contact_details boolean"
)
CALL_STAT = "latency_s double, input_tokens int, output_tokens int, items int, cached boolean"
PRICE = "name string, input_per_million double, output_per_million double, source string"


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def enum_dimension(spark: SparkSession) -> DataFrame:
    """(field, value, ord) of every enum value; macro averages range over it."""
    rows = [(f, v, i) for f, values in ENUMS.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "field string, value string, ord int")


@dataclass(frozen=True)
class RunPaths:
    """Where the stages of a run keep their tables and documents."""

    root: str
    dataset_root: str | None = None

    def at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def dataset(self, name: str) -> str:
        return f"{(self.dataset_root or self.at('dataset')).rstrip('/')}/{name}"

    @property
    def artifacts(self) -> dict[str, str]:
        """Every artifact by name."""
        named = {
            "generated": self.at("generated.jsonl"),
            "generation": self.at("generation.json"),
            "labeled": self.at("labeled.jsonl"),
            "label_stats": self.at("label_stats.json"),
            "filtered": self.at("filtered.jsonl"),
            "dropped": self.at("dropped.jsonl"),
            "funnel": self.at("funnel.json"),
            "calls": self.at("calls.jsonl"),
            "cache": self.at("cache"),
            "train_metrics": self.at("student", "train_metrics.json"),
            "model": self.at("student", "model"),
            "report": self.at("eval", "report.json"),
            "html": self.at("report.html"),
        }
        for name in ("train.jsonl", "val.jsonl", "stats.json", "README.md"):
            named[f"dataset_{name.split('.')[0].lower()}"] = self.dataset(name)
        return named

    def predictions(self, system: str) -> str:
        return self.at("eval", f"predictions_{system}.jsonl")
