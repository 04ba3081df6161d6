"""Day arithmetic on ``yyyy-MM-dd`` strings, done before the plan is built so that filters stay literal."""

from __future__ import annotations

from datetime import date, timedelta

OPEN_END = "9999-12-31"
WINDOWS = (1, 7, 30)


def shift(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def window_start(day: str, length: int) -> str:
    """First day of the window of ``length`` days that ends on ``day``."""
    return shift(day, 1 - length)


def month_start(day: str) -> str:
    return date.fromisoformat(day).replace(day=1).isoformat()
