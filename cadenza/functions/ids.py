"""Deterministic ids and noise: invariant to partitioning and re-runs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_id(entity: str, old_id) -> Column:
    """UUID-shaped id from md5(entity:old_id): join-free legacy-id mapping."""
    c = F.col(old_id) if isinstance(old_id, str) else old_id
    h = F.md5(F.concat(F.lit(entity), F.lit(":"), c.cast("string")))
    return F.regexp_replace(h, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")


def uniform_noise(key, seed: int) -> Column:
    """Uniform [0, 1): the first 12 hex digits of md5("seed:key"), which any engine can repeat."""
    c = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string"))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 48)


def normal_noise(key, seed: int, sigma: float = 1.0) -> Column:
    """N(0, sigma) by Box-Muller over two hash-derived uniforms."""
    u1 = F.greatest(uniform_noise(key, seed), F.lit(1e-12))
    u2 = uniform_noise(key, seed + 7919)
    return F.lit(sigma) * F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)


def stable_split(key, seed: int, fractions: dict[str, float]) -> Column:
    """REG-04: reproducible split label from pmod(xxhash64(key, seed), 1000)."""
    total = sum(fractions.values())
    if abs(total - 1.0) > 1e-9:
        raise ValueError(f"split fractions must sum to 1, got {total}")
    c = F.col(key) if isinstance(key, str) else key
    bucket = F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(1000))
    out, acc = None, 0.0
    items = list(fractions.items())
    for name, frac in items[:-1]:
        acc += frac
        cond = bucket < int(round(acc * 1000))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    last = F.lit(items[-1][0])
    return last if out is None else out.otherwise(last)
