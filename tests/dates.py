"""Commit times for the tests of snapshot tables."""

from __future__ import annotations

from datetime import datetime


def day(number: int) -> datetime:
    return datetime(2024, 1, 1 + number)
