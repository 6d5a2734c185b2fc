"""Joining many rows to a table keyed by something popular."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 1_000_000
MOST_HOT = 100_000
# A table of more rows than this is never sent whole to every task, however small its file is.
MOST_SENT = 100_000


def rows_of_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """How many of the rows about to be joined each key has, as ``rows_of_key``."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows_of_key"))


def heaviest_keys(
    weights: DataFrame,
    keys: list[str],
    weight: str = "rows_of_key",
    rows_per_salt: int = ROWS_PER_SALT,
    most: int = MOST_HOT,
) -> DataFrame:
    """The keys worth splitting, with the number of parts of each as ``salts``.

    ``weights`` says how many rows of the large side each key has, once or more often.  A part
    holds ``rows_per_salt`` rows, or 1/``most`` of all rows where that is more.  Every key above
    that is split, and there are fewer than ``most`` of them, since their rows add up to no more
    than all rows: the result may be broadcast, whatever the data.
    """
    counted = weights.groupBy(*keys).agg(F.max(weight).alias("w"))
    part = F.greatest(F.lit(float(rows_per_salt)), counted.agg(F.sum("w") / most).scalar())
    return counted.where(F.col("w") > part).select(*keys, F.ceil(F.col("w") / part).alias("salts"))


def grows(table: DataFrame, most: int = MOST_SENT) -> bool:
    """Whether a stored ``table`` has more rows than may be broadcast.

    The planner goes by the size of its file.  Counts pack so well there that ten megabytes of
    Parquet are gigabytes of rows in the driver, so rows are what is counted, from the footers.
    """
    return table.count() > most


def join_spread(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    hot: DataFrame,
    spread_by: list[str],
    merge: bool = False,
) -> DataFrame:
    """Inner join of ``rows`` and ``table`` on ``keys``, the keys in ``hot`` in parts.

    Rows of a hot key go to one of its parts by the hash of ``spread_by``; the table rows of
    that key go to each part.  Other keys have one part and join as usual.  ``merge`` rules
    out a broadcast where both sides grow with the data.
    """
    parts: Column = F.coalesce("salts", F.lit(1).cast("bigint"))
    split = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "salt", F.pmod(F.xxhash64(*spread_by), parts)
    )
    copied = table.join(F.broadcast(hot), keys, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
    )
    copied = copied.drop("salts")
    if merge:
        copied = copied.hint("merge")
    return split.drop("salts").join(copied, [*keys, "salt"]).drop("salt")
