"""Join of a large table with rows of its frequent keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(rows: DataFrame, side: DataFrame, keys: list[str], salt_of: Column, how: str = "inner",
                salts: int = 16) -> DataFrame:
    """``rows`` joined with ``side`` (one row a key) so that a frequent key spreads over ``salts`` tasks.

    ``salt_of`` is a hash of what differs among the rows of a key.  ``side`` is
    repeated once a salt: it should hold only keys worth joining."""
    left = rows.withColumn("_salt", F.pmod(salt_of, F.lit(salts)).cast("int"))
    right = side.withColumn("_salt", F.explode(F.array(*[F.lit(k) for k in range(salts)])))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
