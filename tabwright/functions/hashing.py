"""Repeatable row hashes: the basis of splits, folds and samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_digest(keys: Sequence[str], *salt: object) -> Column:
    """md5 over the key columns and the salt, joined by ``:``; null keys count as empty."""
    parts = [F.coalesce(F.col(quoted(k)).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws(":", *parts, *[F.lit(str(s)) for s in salt]))


def hash_below(keys: Sequence[str], share: float, *salt: object) -> Column:
    """Whether a row's hash, read as a number in [0, 1), lies below ``share``.

    It depends on the key values and the salt alone: unlike ``rand`` it is the same under every
    partitioning, row order and retry. Eight hex digits sort as the numbers they spell, so the
    bound is compared as text and no digit is converted per row.
    """
    bound = math.ceil(share * 2**32)
    return F.lit(True) if bound >= 2**32 else _digits(keys, *salt) < F.lit(f"{bound:08x}")


def hash_bucket(keys: Sequence[str], k: int, *salt: object) -> Column:
    """The row's hash in [0, 1) times ``k``, rounded down: a bucket number 0..k-1."""
    digits = _digits(keys, *salt)
    reached = [(digits >= F.lit(f"{-(-j * 2**32 // k):08x}")).cast("int") for j in range(1, k)]
    return sum(reached, F.lit(0))


def _digits(keys: Sequence[str], *salt: object) -> Column:
    return F.substring(row_digest(keys, *salt), 1, 8)


def quoted(name: str) -> str:
    """Back-quoted name, so that dots and spaces in column names are taken literally."""
    return "`" + name.replace("`", "``") + "`"
