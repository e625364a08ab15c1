"""Limits and thresholds of the book operators, as parameters; read from TOML on the driver."""

from __future__ import annotations

import tomllib
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace
from pathlib import Path


@dataclass(frozen=True)
class Chunking:
    chunk_size: int = 30_000
    soft_limit: int = 40_000
    min_chunk: int = 200
    chapter_only: bool = True


@dataclass(frozen=True)
class Quality:
    ratio_min: float = 0.6
    ratio_max: float = 2.0
    en_leak_chars: int = 80
    min_output_chars: int = 100


@dataclass(frozen=True)
class Polish:
    ratio_min: float = 0.5
    ratio_max: float = 2.0
    max_heading_delta: int = 2
    median_tolerance: float = 0.25
    max_para_delta_ratio: float = 0.1


@dataclass(frozen=True)
class Payload:
    snippet_chars: int = 800
    snippet_truncate: int = 200
    snippet_limit: int = 20
    pronoun_threshold: int = 50_000
    aggregate_threshold: int = 80_000


@dataclass(frozen=True)
class Config:
    chunking: Chunking = field(default_factory=Chunking)
    quality: Quality = field(default_factory=Quality)
    polish: Polish = field(default_factory=Polish)
    payload: Payload = field(default_factory=Payload)
    context_chars: int = 300
    high_frequency_top_n: int = 20
    epigraph_max_chars: int = 600
    max_retries: int = 2
    batch_size: int = 6


def overlay(config: Config, user: dict) -> Config:
    """User values over defaults, section by section; unknown sections and keys are passed over."""
    out = config
    for name, value in user.items():
        if name not in asdict(config):
            continue
        now = getattr(out, name)
        if isinstance(value, dict):
            value = replace(now, **{k: v for k, v in value.items() if k in asdict(now)})
        out = replace(out, **{name: value})
    return out


def load(places: Iterable[str | Path] = ()) -> Config:
    """The first TOML file among `places` over the defaults; a file that can't be parsed counts as empty."""
    for p in map(Path, places):
        if p.is_file():
            try:
                return overlay(Config(), tomllib.loads(p.read_text(encoding="utf-8")))
            except tomllib.TOMLDecodeError:
                return Config()
    return Config()
