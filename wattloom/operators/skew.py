"""Equi-join that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of an even partition on, and is cut into pieces of that
#: size over ``PIECES``.
HOT = 1 / 4
PIECES = 8


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Keys without nulls that would fill a noticeable part of a shuffle partition, with the
    number of pieces (``_salts``) to cut each into, by its own count.

    Rows spread over ``partitions`` make an even share each. Fewer than ``partitions / HOT``
    keys can hold more than ``HOT`` of it, whatever the size of the data, so the result may
    be broadcast. All pieces together number at most ``(PIECES + 1 / HOT) * partitions``.
    """
    partitions = partitions or _partitions(df)
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n"))
    # Summed over the counts, so that both uses share one aggregation.
    even = counts.agg(F.sum("_n")).scalar() / F.lit(float(partitions))
    pieces = F.least(F.ceil(F.col("_n") * PIECES / even), F.col("_n")).cast("int")
    return counts.filter(F.col("_n") > even * HOT).select(*keys, pieces.alias("_salts"))


def skewed_join(
    many: DataFrame,
    one: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    spread_by: Column | None = None,
) -> DataFrame:
    """Join ``many`` rows per key to at most one, possibly very wide, row of ``one``.

    AQE splits a skewed join by the size of its input. Here a few small rows of
    ``many`` may each pick up a large row, so the output is what overloads a task.
    Rows of hot keys are therefore dealt to the pieces of their key by a hash of
    ``spread_by`` (all columns by default; give a row number of written rows where rows
    repeat); only the matching rows of ``one`` are copied. Rows of other keys take the
    ordinary path in the same join. Rows with a null key match nothing and are spread
    over all partitions.

    ``hot`` gives the keys to cut, or some of their columns, where they can be had for
    less than a second pass over ``many``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if hot is None:
        hot = hot_keys(many, keys)
    by = [k for k in keys if k in hot.columns]
    hot = F.broadcast(hot)
    spread = F.xxhash64(*many.columns) if spread_by is None else F.xxhash64(spread_by)
    unmatched = reduce(or_, [F.col(k).isNull() for k in keys])
    pieces = F.when(unmatched, F.lit(_partitions(many))).otherwise(F.coalesce("_salts", F.lit(1)))
    left = many.join(hot, by, "left").withColumn("_salt", F.pmod(spread, pieces).cast("int")).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = one.join(hot, by, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
