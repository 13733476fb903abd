"""The one join every operator uses: its strategy is decided, not estimated.

* ``broadcast=True`` - the caller has proven the small side fits the broadcast
  limit (``runtime.fits_broadcast``): broadcast hash join, the large side is
  not shuffled.
* otherwise a sort-merge join, forced with a ``merge`` hint so that no
  size *estimate* can turn it into a broadcast of an unproven side. With
  ``salts`` the large side gets a salt and every small-side row is replicated
  once per salt (``explode``), so one hot key is spread over ``salts`` partitions
  instead of landing in one task. The salt comes from a row's place among its
  partition's rows, sorted by all their columns: equal rows spread too, and a
  task that is run again gives the same rows the same salts in whatever order
  it reads them (only equal rows can change places, which changes nothing). With ``hot`` (a small frame of the hot key
  values, bounded by the caller) only those keys are salted and replicated;
  every other key joins with salt 0, so the small side barely grows. If
  ``hot`` has a ``_salts`` column, each hot key gets that many salts (e.g.
  proportional to its row count) instead of ``salts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.runtime import shuffle_partitions

DEFAULT_SALTS = 64
SALT = "_salt"  # join-key column added to both sides
SALTS = "_salts"  # per-key salt count in a ``hot`` frame
HOT = "_hot"


def salted(df: DataFrame, salts: Column) -> DataFrame:
    """``df`` with a salt from 0 to ``salts`` - 1 on each row, the same however a
    partition's rows are ordered. Columns that can't be sorted by are left out of
    the order."""
    ordered = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    place = F.xxhash64(F.monotonically_increasing_id())
    return df.sortWithinPartitions(*ordered).withColumn(SALT, F.pmod(place, salts).cast("int"))


def keyed_join(
    large: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    *,
    broadcast: bool,
    how: str = "inner",
    salts: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    if broadcast:
        return large.join(F.broadcast(small), keys, how)
    if not salts or salts <= 1:
        return large.join(small.hint("merge"), keys, how)
    # more salts than shuffle partitions would replicate without spreading further
    salts = max(1, min(salts, shuffle_partitions(large.sparkSession)))
    if hot is None:
        salted_large = salted(large, F.lit(salts))
        salted_small = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    else:
        n = F.col(SALTS) if SALTS in hot.columns else F.lit(salts)
        flags = F.broadcast(hot.select(*keys, n.cast("int").alias(SALTS)).withColumn(HOT, F.lit(True)))
        salted_large = salted(large.join(flags, keys, "left"), F.when(F.col(HOT), F.col(SALTS)).otherwise(F.lit(1))).drop(HOT, SALTS)
        salted_small = small.join(flags, keys, "left").withColumn(
            SALT, F.explode(F.when(F.col(HOT), F.sequence(F.lit(0), F.col(SALTS) - 1)).otherwise(F.array(F.lit(0))))
        ).drop(HOT, SALTS)
    return salted_large.join(salted_small.hint("merge"), [*keys, SALT], how).drop(SALT)
