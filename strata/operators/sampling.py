"""Whole-object hash sampling for quick runs.

Objects, not rows, are sampled: every version of a kept (type, id) stays,
so the lifecycle aggregate downstream always sees complete histories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_bucket(rate: float) -> int:
    """1/rate rounded half-to-even, at least 2. Rates 0.7 and 0.4 both give 2."""
    if rate <= 0:
        raise ValueError(f"sample rate must be > 0, got {rate}")
    return max(int(round(1.0 / rate)), 2)


def sample_objects(history: DataFrame, rate: float) -> DataFrame:
    """Keep objects whose Murmur3 hash of (type, id) falls in bucket 0.

    A no-op for ``rate >= 1``. ``pmod`` keeps exactly the rows
    ``abs(hash) % bucket == 0`` keeps (only residue 0 matters) without the
    ANSI overflow of ``abs`` on the minimum int.
    """
    if rate >= 1.0:
        return history
    bucket = sample_bucket(rate)
    return history.filter(F.pmod(F.hash("type", "id"), F.lit(bucket)) == 0)
