"""Configuration: frozen dataclasses, from a mapping, a YAML file or the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any

from pagewright.operators.routing import Thresholds


@dataclass(frozen=True)
class Limits:
    """Bounds of a run; None is no bound."""

    documents: int | None = None
    pages: int | None = None
    pages_per_document: int | None = None

    def __post_init__(self):
        if any(v is not None and v < 1 for v in (self.documents, self.pages, self.pages_per_document)):
            raise ValueError("limits are at least 1")


@dataclass(frozen=True)
class Endpoint:
    url: str = ""
    model: str = ""
    api_key: str = ""
    timeout: float = 60.0

    @classmethod
    def from_env(cls, prefix: str, model: str = "", env: Mapping[str, str] = os.environ) -> Endpoint:
        """From ``<prefix>_URL``, ``_MODEL``, ``_API_KEY`` and ``_TIMEOUT``."""
        timeout = float(env.get(f"{prefix}_TIMEOUT", "60"))
        if timeout <= 0:
            raise ValueError("a timeout is positive")
        return cls(env.get(f"{prefix}_URL", ""), env.get(f"{prefix}_MODEL", model), env.get(f"{prefix}_API_KEY", ""), timeout)


@dataclass(frozen=True)
class Config:
    mode: str = "offline"
    pages_per_parse: int = 2
    #: Buckets of each table, and how many of its versions stay.
    buckets: int = 64
    versions: int = 2
    strict: bool = False
    fail_fast: bool = False
    embed: bool = True
    #: Whether answers of models are written down as they come, for tasks and runs that are tried again.
    journal: bool = False
    low_confidence: float = 0.65
    routing: Thresholds = field(default_factory=Thresholds)
    limits: Limits = field(default_factory=Limits)
    page_model: Endpoint = field(default_factory=Endpoint)
    ocr_model: Endpoint = field(default_factory=Endpoint)
    structured_model: Endpoint = field(default_factory=Endpoint)
    embedding_model: Endpoint = field(default_factory=Endpoint)

    def __post_init__(self):
        if self.mode not in ("offline", "live"):
            raise ValueError("the mode is offline or live")
        if not 1 <= self.pages_per_parse <= 100 or not 0 <= self.low_confidence <= 1:
            raise ValueError("1 to 100 pages per parse, and a confidence between 0 and 1")
        if self.buckets < 1 or self.versions < 1:
            raise ValueError("at least one bucket and one version")
        if self.mode == "live" and not (self.page_model.url and self.structured_model.url):
            raise ValueError("a live run needs its models' addresses")


def _built(kind: type, data: Mapping[str, Any]):
    known = {f.name: f for f in fields(kind)}
    if unknown := set(data) - set(known):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    defaults = kind()
    return kind(**{k: _built(type(getattr(defaults, k)), v) if is_dataclass(getattr(defaults, k)) else v for k, v in data.items()})


def from_mapping(data: Mapping[str, Any], mode: str | None = None) -> Config:
    return _built(Config, dict(data) | ({"mode": mode} if mode else {}))


def from_yaml(path: str, mode: str | None = None) -> Config:
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs the yaml package") from e
    with open(path, encoding="utf-8") as f:
        return from_mapping(yaml.safe_load(f) or {}, mode)
