"""Row placement that depends on the row's key only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_bucket(keys: Sequence[str], portable: bool = False) -> Column:
    """Bucket 0..99 of a row's key.

    Unlike a seeded random split it gives the same side for the same row whatever
    the partitioning, so a recomputed partition cannot move rows between sides.
    The default is Spark's 64-bit hash. ``portable`` takes the first 8 hex digits
    of md5 over the ``|``-joined keys, several times slower, which any engine can repeat.
    """
    if not portable:
        return F.pmod(F.xxhash64(*keys), F.lit(100))
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
