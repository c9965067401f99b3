"""Where a corpus's settings come from (S11): arguments before the profile, the profile before the corpus, the corpus before the defaults."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any


@dataclass(frozen=True)
class RetrievalConfig:
    top_k: int = 10
    candidate_limit: int | None = 5000
    fusion: str = "weighted-v1"
    rrf_k: int = 60
    rrf_window: int = 0
    lexical_floor_count: int = 0
    lexical_floor_share: float = 0.0
    rerank_pool_size: int = 0
    lexical_min: int = 0
    semantic_min: int = 0

    @property
    def window(self) -> int:
        return self.rrf_window or max(8 * self.top_k, 64)


def resolve_config(*layers: Mapping[str, Any] | None) -> RetrievalConfig:
    """The settings of the first layer that has each of them; None counts as absent. Numbers are brought into range: top_k 1 or more, limits 1 to 5000, shares 0 to 1."""
    got = {f.name: next((layer[f.name] for layer in layers if layer and layer.get(f.name) is not None), f.default) for f in fields(RetrievalConfig)}
    unknown = {k for layer in layers if layer for k in layer} - set(got)
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    if got["fusion"] not in ("weighted-v1", "weighted-v2", "rrf-v1"):
        raise ValueError(f"unknown fusion: {got['fusion']}")
    got["top_k"] = max(1, int(got["top_k"]))
    got["candidate_limit"] = min(5000, max(1, int(got["candidate_limit"])))
    got["rrf_k"] = max(1, int(got["rrf_k"]))
    got["lexical_floor_share"] = min(1.0, max(0.0, float(got["lexical_floor_share"])))
    return RetrievalConfig(**got)
