"""Stable hashes of strings and ids of runs."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, is_dataclass

from pyspark.sql import Column, functions as F


def unit_hash(value: Column, salt: str = "") -> Column:
    """First 64 bits of SHA-256 of `salt|value` as a fraction of one; null values count as 'None'."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{salt}|"), none_string(value)), 256), 1, 16)
    return F.conv(digits, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551616.0)


def none_string(value: Column) -> Column:
    """The value as a key; a missing one is the string None."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def run_id(prefix: str, manifest: str, config: object, extra: str = "") -> str:
    """The prefix and 16 hex digits that depend on the manifest, the settings and `extra` only."""
    settings = asdict(config) if is_dataclass(config) else str(config)
    text = json.dumps(settings, sort_keys=True, separators=(",", ":"))
    return f"{prefix}_{hashlib.sha256(f'{manifest}|{text}|{extra}'.encode()).hexdigest()[:16]}"


def stage_run_id(prefix: str, manifest: str, config: object, shard: int = 0, shards: int = 1, limit: int | None = None) -> str:
    return run_id(prefix, manifest, config, f"{shard}|{shards}|{limit}")
