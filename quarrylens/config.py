"""Settings of a run as frozen objects, read from JSON (or YAML where its reader is installed)."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class ScopeConfig:
    end_month: str = "9999-12"
    active_since_month: str = "0000-01"
    minimum_reviews: int = 300
    minimum_active_months: int = 12
    minimum_selected_product_groups: int = 2
    categories: tuple[str, ...] = ()


@dataclass(frozen=True)
class ThemeConfig:
    minimum_document_frequency: int = 5
    maximum_per_product_sentiment: int = 20
    cluster_similarity: float = 0.75
    cluster_size: int = 10


@dataclass(frozen=True)
class AlertConfig:
    recent: int = 3
    baseline: int = 12
    rise: float = 0.10
    minimum_reviews: int = 30


@dataclass(frozen=True)
class RunConfig:
    release: str
    run_id: str
    scope: ScopeConfig = field(default_factory=ScopeConfig)
    themes: ThemeConfig = field(default_factory=ThemeConfig)
    alerts: AlertConfig = field(default_factory=AlertConfig)


def _build(kind, values: dict):
    known = {f.name: f for f in dataclasses.fields(kind)}
    unknown = set(values) - set(known)
    if unknown:
        raise ValueError(f"unknown settings of {kind.__name__}: {sorted(unknown)}")
    nested = {"scope": ScopeConfig, "themes": ThemeConfig, "alerts": AlertConfig}
    return kind(**{n: _build(nested[n], v) if n in nested and kind is RunConfig else tuple(v) if isinstance(v, list) else v for n, v in values.items()})


def load_config(path: str) -> RunConfig:
    text = Path(path).read_text(encoding="utf-8-sig")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("YAML settings need a YAML reader; JSON needs none") from error
        return _build(RunConfig, yaml.safe_load(text))
    return _build(RunConfig, json.loads(text))
