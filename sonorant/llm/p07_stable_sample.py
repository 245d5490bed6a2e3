"""Problem 7: a sample that reruns, partitionings and later deliveries cannot change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ids import clip_key

RATE = 0.1
SALT = "sample-v1"


def in_sample(key: Column, rate: float, salt: str = SALT) -> Column:
    """Whether a key's SHA-256 with the salt, as a 64-bit fraction of one, is below the rate.

    The first 16 hex digits are compared with the rate's as strings, so no
    rounding is involved. Raising the rate only adds keys. Null keys are never
    in the sample, at a rate of 1 all others are.
    """
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie in [0, 1]")
    if rate == 1:
        return key.isNotNull()
    digits = F.substring(F.sha2(F.concat(F.lit(f"{salt}|"), key), 256), 1, 16)
    return F.coalesce(digits < F.lit(threshold_digits(rate)), F.lit(False))


def threshold_digits(rate: float) -> str:
    return format(int(rate * (1 << 64)), "016x")


def sample(df: DataFrame, rate: float = RATE, salt: str = SALT, by: str = "audio_id") -> DataFrame:
    """All rows of the sampled clips, with their clip key; a map-only filter.

    Every spelling of an id is one clip, so all rows of a clip are taken or
    none. Rows without an id are not sampled. Each decision depends on the
    clip's key alone: new rows never remove a selected clip.
    """
    return df.withColumn("clip", clip_key(F.col(by))).where(in_sample(F.col("clip"), rate, salt))
