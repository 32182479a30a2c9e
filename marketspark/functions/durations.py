"""Window lengths and their serving labels."""

from __future__ import annotations

import re

# The labels the serving queries accept.
WINDOW_LABELS = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour"}

_UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
    "day": 86_400_000_000, "week": 604_800_000_000,
}
_PART = rf"(\d+)\s+({'|'.join(_UNIT_MICROS)})s?"


def duration_micros(duration: str) -> int:
    """Length of a window such as ``"5 minutes"``, ``"1 hour 30 minutes"`` or ``"500 milliseconds"``."""
    text = duration.lower().strip()
    if not re.fullmatch(rf"{_PART}(\s+{_PART})*", text):
        raise ValueError(f"not a window duration: {duration!r}")
    length = sum(int(n) * _UNIT_MICROS[unit] for n, unit in re.findall(_PART, text))
    if length == 0:
        raise ValueError(f"not a window duration: {duration!r}")
    return length


def duration_seconds(duration: str) -> int | float:
    micros = duration_micros(duration)
    return micros / 1_000_000 if micros % 1_000_000 else micros // 1_000_000


def duration_text(seconds: int) -> str:
    return f"{seconds} seconds"


def resolve_window(window: str) -> str:
    """The stored duration for a label (``"1m"``) or for the duration itself."""
    if window in WINDOW_LABELS:
        return WINDOW_LABELS[window]
    if window in WINDOW_LABELS.values():
        return window
    raise ValueError(f"unknown window {window!r}; expected one of {sorted(WINDOW_LABELS)}")
