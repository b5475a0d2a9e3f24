"""Waiting times between attempts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wait_seconds(attempt: Column, kind: str = "exponential", multiplier: float = 1.0, most: float = 30.0, jitter_seed: int | None = None) -> Column:
    """Seconds to wait after attempt 1, 2, ...: ``multiplier * 2 ** (attempt - 1)`` up to ``most``, or ``multiplier`` if fixed.

    With ``jitter_seed`` a uniform share of a second is added.
    """
    wait = F.least(F.lit(multiplier) * F.pow(F.lit(2.0), attempt - 1), F.lit(most)) if kind == "exponential" else F.lit(multiplier)
    wait = wait.cast("double")
    return wait + F.rand(jitter_seed) if jitter_seed is not None else wait


def wait_of(attempt: int, kind: str, multiplier: float, most: float) -> float:
    """The same on the worker that fetches."""
    return min(multiplier * 2.0 ** (attempt - 1), most) if kind == "exponential" else multiplier
