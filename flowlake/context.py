"""Run context: the explicit "now" and lookback every model is driven by.

The reference reads ``current_date`` / ``now()`` inside its SQL; here the time
is a parameter so a run is reproducible and a backfill is just another
``as_of``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunContext:
    as_of: dt.date
    lookback_days: int = 2
    incremental: bool = False
    options: dict = field(default_factory=dict)

    @property
    def window_start(self) -> dt.date:
        """First day re-read on an incremental run: trunc_day(now - lookback)."""
        return self.as_of - dt.timedelta(days=self.lookback_days)

    def period_start(self, unit: str) -> dt.date:
        """trunc(now - lookback, unit) for unit in {'week', 'month'}."""
        d = self.window_start
        if unit == "week":
            return d - dt.timedelta(days=d.weekday())
        if unit == "month":
            return d.replace(day=1)
        if unit == "day":
            return d
        raise ValueError(f"unknown period unit {unit!r}")

    def opt(self, key: str, default=None):
        return self.options.get(key, default)
