"""Keyed hashing: reproducible pseudo-random choices that depend only on a seed and the row's id.

`rand()` depends on how rows are laid out over partitions and changes when a task is
retried; a hash of (seed, id) does not, so splits, folds, samples and injected gaps are
the same on one core and on a thousand executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def digest(salt: str, key: Column) -> Column:
    """md5 of `salt|key` as 32 hex digits: the random order of rows."""
    return F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string")).cast("binary"))


def keyed_int(salt: str, key: Column) -> Column:
    """A uniform integer in [0, 2^32) from (salt, key)."""
    return F.conv(F.substring(digest(salt, key), 1, 8), 16, 10).cast("bigint")


def keyed_unit(salt: str, key: Column) -> Column:
    """A uniform double in [0, 1) from (salt, key)."""
    return keyed_int(salt, key) / F.lit(TWO_32)
