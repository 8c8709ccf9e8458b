"""Settings of a collection, from the environment, each held within its bounds; and requests, checked before they run."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import datetime


@dataclass(frozen=True)
class Settings:
    """What a run may use. ``BOUNDS`` are fixed values: least, most (None: no bound) and the value where nothing sound is set."""

    analysis_quota_7_days: int = 3000
    list_attempts: int = 4
    list_page_size: int = 100
    list_max_pages: int = 3000

    @classmethod
    def from_environment(cls, environment: Mapping[str, str] | None = None, prefix: str = "TIDEMILL_") -> Settings:
        environment = os.environ if environment is None else environment
        return cls(**{f.name: clamped(environment.get(prefix + f.name.upper()), *BOUNDS[f.name], f.default) for f in fields(cls)})


BOUNDS = {"analysis_quota_7_days": (1, None), "list_attempts": (1, 4), "list_page_size": (20, 100), "list_max_pages": (1, 3000)}


def clamped(value: str | None, least: int, most: int | None, otherwise: int) -> int:
    """A whole number within its bounds; ``otherwise`` where the value is none."""
    try:
        number = int(str(value).strip())
    except ValueError:
        return otherwise
    number = max(least, number)
    return number if most is None else min(most, number)


@dataclass(frozen=True)
class Request:
    """What to collect; a request that can't be met isn't made. Times are ISO texts, without a zone in UTC."""

    market: str
    ticker: str
    lookback_days: int = 1
    window_start: str | None = None
    window_end: str | None = None

    def __post_init__(self):
        if self.market not in ("cn", "hk"):
            raise ValueError("market must be cn or hk")
        if not self.ticker.strip():
            raise ValueError("ticker must not be empty")
        if not 1 <= self.lookback_days <= 30:
            raise ValueError("lookback_days must lie between 1 and 30")
        if self.window_start and self.window_end:
            start, end = (datetime.fromisoformat(t) for t in (self.window_start, self.window_end))
            if end <= start:
                raise ValueError("window_end must lie after window_start")
