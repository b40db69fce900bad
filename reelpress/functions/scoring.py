"""Column functions for sentiment scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------------------
NEUTRAL_SCORE = 0.5
NOISE_SPREAD = 0.1
DIGITS = 3
# -----------------------------------------------------------------------------------------


def scale_score(polarity: Column, noise: Column | float = 0.0) -> Column:
    """Polarity in [-1, 1] as a score in [0, 1], clamped and rounded half up to 3 digits.

    NULL polarity or noise gives NULL.
    """
    noise = noise if isinstance(noise, Column) else F.lit(noise).cast("decimal(18,12)")
    base = (polarity.cast("decimal(18,12)") + F.lit(1)) / F.lit(2)
    # least() and greatest() skip NULL
    raw = base + noise
    bounded = F.when(raw.isNotNull(), F.least(F.lit(1), F.greatest(F.lit(0), raw)))
    return F.round(bounded, DIGITS).cast("double")


def keyed_noise(key: Column, seed: str, spread: float = NOISE_SPREAD) -> Column:
    """Uniform noise in [-spread, spread) that depends on key and seed only.

    A re-run, or a task that is computed again after an executor is lost, gives the same value.
    """
    drawn = F.conv(F.substring(F.md5(F.concat(key, F.lit(seed))), 1, 8), 16, 10).cast("double")
    return ((drawn / F.lit(float(2**32)) * 2 - 1) * F.lit(spread)).cast("decimal(18,12)")


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score > 0, F.lit("positive"))
        .when(score < 0, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )
