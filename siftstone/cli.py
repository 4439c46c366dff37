"""Command line: python -m siftstone.cli COMMAND [--config FILE] ..."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from .plans.config import RunConfig, load_config
from .plans.run import Run
from .session import local_session
from .sources.calls import ledger_rollup
from .schemas import LEDGER

COMMANDS = ("generate", "label", "filter", "build", "train", "eval", "report", "export", "run-all", "calls", "show-config")


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siftstone")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--config", help="YAML or JSON settings")
    parser.add_argument("--num", type=int, help="tickets to generate")
    parser.add_argument("--prefix", default="s", help="prefix of generated ids")
    parser.add_argument("--append", action="store_true", help="add to what is there")
    parser.add_argument("--imports", help="a .csv, .jsonl or .ndjson file of texts")
    parser.add_argument("--to", help="folder of an export")
    got = parser.parse_args(args)
    config = load_config(Path(got.config).read_text()) if got.config else RunConfig()
    if got.command == "show-config":
        print(config.show())
        return 0
    spark = local_session()
    run = Run(spark, config)
    if got.command == "calls":
        ledger_rollup(spark.read.schema(LEDGER).json(run.at["calls"])).orderBy("stage", "status", "served_model").show(100, False)
    elif got.command == "generate":
        run.generate(got.num, prefix=got.prefix, append=got.append, imports=got.imports)
    elif got.command == "export":
        print("\n".join(run.export(got.to)))
    else:
        {"eval": run.evaluate, "run-all": run.run_all}.get(got.command, getattr(run, got.command, None))()
    return 0


if __name__ == "__main__":
    sys.exit(main())
