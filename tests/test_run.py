"""A whole run over a run folder, offline."""

import json

import pytest

from siftstone.plans.config import RunConfig, load_config
from siftstone.plans.run import Run
from siftstone.sources import tables


def test_settings():
    made = load_config(json.dumps({"num_tickets": 5, "filter": {"cap": 3}, "prices": [["a", 1.0, 2.0]]}))
    assert (made.num_tickets, made.filter.cap, made.prices) == (5, 3, (("a", 1.0, 2.0),))
    with pytest.raises(ValueError, match="unknown settings"):
        load_config('{"nope": 1}')
    with pytest.raises(ValueError, match="free"):
        RunConfig(teachers=("openai/x",), require_free_models=True)


def test_run_all(spark, tmp_path):
    gold = tmp_path / "gold.jsonl"
    label = {"intent": "refund_request", "urgency": "medium", "sentiment": "neutral", "product_area": "camera", "order_id": None, "summary": "Customer wants money back."}
    gold.write_text("\n".join(json.dumps({"id": f"g{i}", "text": f"Please refund camera number {i}, thanks a lot", "label": label}) for i in range(4)))
    config = RunConfig(output_dir=f"file://{tmp_path}/run", num_tickets=44, gold_path=str(gold), prices=(("plain", 1.0, 2.0),))
    run = Run(spark, config)
    with pytest.raises(FileNotFoundError, match="generate stage"):
        run.label()
    run.run_all()
    funnel = tables.read_document(spark, run.at["funnel"])
    assert funnel[0]["name"] == "requested" and funnel[0]["kept"] == 44
    stats = tables.read_document(spark, run.at["dataset_stats"])
    assert stats["sizes"]["total"] == stats["sizes"]["train"] + stats["sizes"]["val"] == funnel[-1]["kept"]
    report = tables.read_document(spark, run.at["report"])
    assert report["systems"]["student"]["items"] == 4 and "curve" in report["router"]
    assert "Run report" in spark.read.text(run.at["html"], wholetext=True).first()["value"]
    assert run.export(f"file://{tmp_path}/out")
