"""The thresholds of all stages as one checked object."""

from __future__ import annotations

import dataclasses
import json


@dataclasses.dataclass(frozen=True)
class Settings:
    """Defaults (fixed values); counts and lengths are 0 or more, shares between 0 and 1, ratios 1 or more."""

    min_joint: int = 500
    min_reciprocal: float = 0.5
    density: float = 0.5
    min_full: int = 5
    min_deep: float = 0.999
    min_coherence: float = 0.667
    max_tandem: float = 0.30
    max_divergence: float = 25.0
    min_tools: int = 2
    min_gates: int = 6
    veto: float = 0.5
    full_edge: int = 20
    full_share: float = 0.8
    cap_ratio: float = 1.5
    deconvolve_ratio: float = 1.8
    agree_ratio: float = 1.3
    mode_ratio: float = 2.0

    def __post_init__(self) -> None:
        for field in dataclasses.fields(self):
            value = getattr(self, field.name)
            if isinstance(value, bool) or not isinstance(value, (int, float)) or (field.type == "int" and not isinstance(value, int)):
                raise ValueError(f"{field.name} must be of type {field.type}, not {value!r}")
            low, high = (1, float("inf")) if field.name.endswith("_ratio") else (0, 1 if field.type == "float" and field.name != "max_divergence" else float("inf"))
            if not low <= value <= high:
                raise ValueError(f"{field.name} = {value!r} is not between {low} and {high}")

    @classmethod
    def from_json(cls, text: str) -> Settings:
        """Settings of a JSON object; a name that isn't one of theirs is an error, one that is missing has its default."""
        given = json.loads(text)
        if unknown := sorted(set(given) - {f.name for f in dataclasses.fields(cls)}):
            raise ValueError(f"no such settings: {', '.join(unknown)}")
        return cls(**given)


DEFAULT = Settings()
