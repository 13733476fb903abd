"""Views, SQL text, catalog reads and caching."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def sql_select_all(spark: SparkSession, view: str) -> DataFrame:
    """``SELECT * FROM <view>``; the parser resolves it to the same plan."""
    return spark.sql(f"SELECT * FROM `{view}`")


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def cache_as_table(
    df: DataFrame,
    name: str,
    partitions: int | None = None,
    storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> DataFrame:
    """Register ``df`` (optionally round-robin repartitioned) as a cached view
    and return the catalog table. Caching is lazy: the first action fills it.

    Round robin keeps partitions even whatever the key skew. Filter and prune
    ``df`` first: what is cached is what it holds. Call ``uncache_table`` when
    done, or use ``cached_table``; for repeated reports over large data prefer
    ``fleetlens.plans.UsageModel``, which keeps only the reduced tables.
    """
    spark = df.sparkSession
    (df.repartition(partitions) if partitions else df).createOrReplaceTempView(name)
    spark.catalog.cacheTable(name, storage_level)
    return spark.table(name)


def uncache_table(spark: SparkSession, name: str) -> None:
    spark.catalog.uncacheTable(name)


@contextmanager
def cached_table(
    df: DataFrame, name: str, partitions: int | None = None, storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """``cache_as_table`` for the length of a ``with`` block; the cache and the
    view are gone after it, also when the block fails."""
    try:
        yield cache_as_table(df, name, partitions, storage_level)
    finally:
        uncache_table(df.sparkSession, name)
        df.sparkSession.catalog.dropTempView(name)
