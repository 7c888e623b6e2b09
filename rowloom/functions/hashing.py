"""Reproducible randomness: a hash of (seed, row key).

The draw depends on the key alone, so it survives repartitioning, task retries
and lost executors, and SQL engines can recompute it.
"""

import hashlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 2**32


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _leading_digits(key, seed, digits):
    text = F.concat(F.lit(f"{seed}:"), _col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def hash32(key, seed=0) -> Column:
    """Integer in [0, 2^32) from the first 8 hex digits of md5('seed:key')."""
    return _leading_digits(key, seed, 8)


def hash60(key, seed=0) -> Column:
    """Integer in [0, 2^60) from the first 15 hex digits; for draws among more rows than 2^32."""
    return _leading_digits(key, seed, 15)


def unit_interval(key, seed=0) -> Column:
    """Double in [0, 1)."""
    return hash32(key, seed).cast("double") / F.lit(float(SPAN))


def text_unit(text: str) -> float:
    """The draw of `unit_interval` for a text, on the driver (tree cuts, not rows)."""
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / SPAN


def text_units(texts) -> np.ndarray:
    """`text_unit` of every text."""
    return np.frombuffer(b"".join([hashlib.md5(t.encode()).digest()[:4] for t in texts]), ">u4") / SPAN


def uniform_draws(hashes, salt):
    """[0, 1) per row inside a task, from its 32-bit row hash and a round number (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        z = hashes.astype(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(float) / 2.0**53
