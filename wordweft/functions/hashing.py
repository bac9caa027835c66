"""Randomness as a pure function of row keys.

Every draw in the engine is a hash of (seed, stable keys). A draw therefore does not depend on how
rows are partitioned, a retried task repeats it exactly, and any SQL engine with md5 can check it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_hex(seed, *keys: Column) -> Column:
    """md5 hex digest of the seed and the keys, joined by ``|``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def hash_uniform(seed, *keys: Column) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of the digest."""
    return hex_uniform(hash_hex(seed, *keys))


def hex_uniform(digest: Column, start: int = 1) -> Column:
    """Uniform double in [0, 1) from 8 hex digits of a digest, first digit at ``start``."""
    word = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
    return word.cast("double") / F.lit(4294967296.0)
