"""Thresholds of the guards, the matching ladder and the credit ceilings."""

from __future__ import annotations

from dataclasses import dataclass


# Names and defaults of the guards' thresholds.
@dataclass(frozen=True)
class GuardLimits:
    """``max_input_bytes`` and ``max_rows`` turn a file away only where they are asked for."""

    max_input_bytes: int | None = None
    max_invalid_fraction: float = 0.5
    min_rows_for_fraction: int = 5
    min_match_rate: float = 0.2
    min_rows_for_match_rate: int = 5
    warn_invalid_fraction: float = 0.2
    require_consent: bool = False
    name_max_length: int = 100
    field_max_length: int = 200
    email_max_length: int = 254
    max_rows: int | None = None


@dataclass(frozen=True)
class LadderConfig:
    identify_min_score: int = 70
    identify_min_margin: int = 20
    enrich_min_likelihood: int = 4
    location_hint: str | None = None
    max_attempts: int = 4
    max_wait_seconds: float = 60.0
    breaker_threshold: int = 3
    breaker_cooldown_seconds: int = 300
    cache_days: int = 90


@dataclass(frozen=True)
class CreditLimits:
    """Monthly ceiling per call kind and one cap per batch; ``None`` means unlimited."""

    enrich: int | None = None
    identify: int | None = None
    per_batch: int | None = None

    def ceilings(self) -> dict[str, int | None]:
        return {"enrich": self.enrich, "identify": self.identify}
