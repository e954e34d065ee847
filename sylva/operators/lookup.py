"""Attach the value of a key to rows whose keys may be very uneven."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BROADCAST = 100_000  # rows of a lookup table that may be broadcast
SALTS = 32


def attach(rows: DataFrame, table: DataFrame, keys: list[str], salt: Column, most: int = MOST_BROADCAST) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row a key, nulls match nulls); no key gathers its rows in one task.

    ``table`` must be cheap to count (a saved table). With at most ``most`` rows it is broadcast. Beyond
    that every row of ``table`` stands ``SALTS`` times and the rows of a key spread over that many groups
    by ``salt``; that side is never broadcast, since its size is told from the rows before they stand ``SALTS`` times.
    """
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    right = table.withColumnsRenamed(names)
    match = None
    if table.limit(most + 1).count() <= most:
        right = F.broadcast(right)
    else:
        rows = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
        right = right.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
        match = F.col("_salt") == F.col("_at")
    for k, other in names.items():
        same = rows[k].eqNullSafe(right[other])
        match = same if match is None else match & same
    return rows.join(right, match, "left").drop("_salt", "_at", *names.values())
