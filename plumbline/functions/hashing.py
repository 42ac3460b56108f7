"""Pseudo-random values that depend only on the row key and a seed.

Unlike ``rand`` they do not depend on the partition or on the order of rows, so
a task that is run again after an executor is lost draws the same values. md5
is used because any other SQL engine can repeat it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.columns import quoted

WORD_DIGITS = 13                    # 52 bits: exact in a double
WORD_RANGE = float(16**WORD_DIGITS)


def digest(keys: Sequence[str], seed: int | str) -> Column:
    """md5 of the key columns and the seed, joined by '|'.

    Each part begins with its length, so no two different keys read alike; NULL is ``n``.
    """
    texts = [quoted(k).cast("string") for k in keys]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def word(hashed: Column, index: int = 0) -> Column:
    """One of the two 52-bit words of a digest as bigint."""
    return F.conv(F.substring(hashed, 1 + WORD_DIGITS * index, WORD_DIGITS), 16, 10).cast("bigint")


def uniform(hashed: Column, index: int = 0) -> Column:
    """Uniform value in [0, 1)."""
    return word(hashed, index).cast("double") / F.lit(WORD_RANGE)


def normal(hashed: Column) -> Column:
    """Standard normal value by the Box-Muller formula."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(hashed, 0)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(hashed, 1))


def bucket(hashed: Column, buckets: int) -> Column:
    return F.pmod(word(hashed), F.lit(buckets)).cast("int")
