"""Configuration: defaults as dataclasses, overridden by a YAML or JSON file."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path


@dataclass
class Gate:
    min_text_length: int = 200
    max_garbled_ratio: float = 0.10


@dataclass
class Windows:
    search_size: int = 512
    search_overlap: int = 64
    cluster_size: int = 2048
    cluster_overlap: int = 128


@dataclass
class Clustering:
    min_cluster_size: int = 10
    reduced_dimensions: int = 50


@dataclass
class Config:
    gate: Gate = field(default_factory=Gate)
    windows: Windows = field(default_factory=Windows)
    clustering: Clustering = field(default_factory=Clustering)
    sources: dict = field(default_factory=dict)


def _fill(obj, given: dict):
    for f in fields(obj):
        if f.name in given:
            now = getattr(obj, f.name)
            setattr(obj, f.name, _fill(now, given[f.name]) if is_dataclass(now) else given[f.name])
    return obj


def load_config(path: str | None = None) -> Config:
    """Defaults without a path; a missing file is an error. YAML needs the yaml module, JSON does not."""
    if path is None:
        return Config()
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(path)
    text = p.read_text(encoding="utf-8")
    if p.suffix == ".json":
        data = json.loads(text)
    else:
        import yaml

        data = yaml.safe_load(text)
    return _fill(Config(), data or {})
