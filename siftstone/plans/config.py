"""Settings of a run, from YAML where PyYAML is there, or from JSON."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, is_dataclass

from ..operators.cost import CostConfig
from ..operators.funnel import FunnelConfig
from ..sources.calls import check_free


@dataclass(frozen=True)
class RunConfig:
    """One field a tunable; unknown names are errors. Prices are (name, in, out) per million."""

    seed: int = 42
    output_dir: str = "runs/default"
    dataset_dir: str | None = None
    num_tickets: int = 400
    tickets_per_call: int = 12
    teachers: tuple[str, ...] = ("offline-a", "offline-b")
    label_batch: int = 12
    repairs: int = 1
    scrub_before_teacher: bool = True
    require_free_models: bool = False
    generator: str = "offline-writer"
    fallback_models: tuple[str, ...] = ()
    reasoning_effort: str | None = None
    max_tokens: int = 4096
    timeout_seconds: float = 120.0
    max_calls: int = 200
    max_retries: int = 4
    retry_seconds: float = 2.0
    seconds_between_calls: float = 3.0
    call_tasks: int = 4
    cache_dir: str | None = None
    guide_path: str | None = None
    val_fraction: float = 0.12
    student: str = "keyword"
    min_confidence: float | str = "auto"
    target_exact_match: float = 0.9
    gold_path: str | None = None
    gold_limit: int | None = None
    prices: tuple[tuple[str, float, float], ...] = ()
    filter: FunnelConfig = field(default_factory=FunnelConfig)
    cost: CostConfig = field(default_factory=CostConfig)

    def __post_init__(self):
        if not self.teachers:
            raise ValueError("at least one teacher is needed")
        if not 0 <= self.val_fraction < 0.5:
            raise ValueError("val_fraction must be at least 0 and below a half")
        if self.student not in ("keyword", "baseline"):
            raise ValueError("student is keyword or baseline")
        if self.require_free_models:
            check_free([m for m in self.remote_models() if not m.startswith("openrouter/")])
            # an endpoint's own name is not part of its model's
            check_free([m.removeprefix("openrouter/") for m in (*self.remote_models(), *self.fallback_models)])

    def remote_models(self) -> list[str]:
        """Models that are asked over the network, as kind/model."""
        return [m for m in (*self.teachers, self.generator) if not m.startswith("offline")]

    def show(self) -> str:
        return json.dumps(asdict(self), indent=2)


def _make(kind, values: dict):
    known = {f.name: f for f in fields(kind)}
    if extra := sorted(set(values) - set(known)):
        raise ValueError(f"unknown settings of {kind.__name__}: {', '.join(extra)}")
    made = {}
    for name, value in values.items():
        default = known[name].default_factory() if callable(known[name].default_factory) else known[name].default
        if is_dataclass(default):
            value = _make(type(default), value)
        elif isinstance(value, list):
            value = tuple(tuple(v) if isinstance(v, list) else v for v in value)
        made[name] = value
    return kind(**made)


def load_config(text: str) -> RunConfig:
    """Settings from the text of a YAML or JSON document."""
    try:
        values = json.loads(text)
    except ValueError:
        import yaml

        values = yaml.safe_load(text)
    return _make(RunConfig, values or {})
