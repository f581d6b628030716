"""Seeded row hashes that do not depend on partitioning, order or engine."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 13                 # 52 bits: exact in a double
HASH_SPACE = 16 ** HASH_DIGITS


def hash_digits(key: Sequence[str], seed: int = 42) -> Column:
    """The leading hex digits of the md5 of ``seed:key1:key2...``."""
    if not key:
        raise ValueError("name at least one key column")
    parts = [F.col(f"`{k}`").cast("string") for k in key]
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, HASH_DIGITS)


def row_hash(key: Sequence[str], seed: int = 42) -> Column:
    """The digits as a whole number in ``[0, HASH_SPACE)``."""
    return F.conv(hash_digits(key, seed), 16, 10).cast("bigint")


def hash_below(key: Sequence[str], share: float, seed: int = 42) -> Column:
    """Whether the hash falls into the lowest ``share`` of its range. Hex digits of one length sort like numbers."""
    bound = math.floor(share * HASH_SPACE)
    return hash_digits(key, seed) < F.lit(f"{bound:0{HASH_DIGITS}x}")
