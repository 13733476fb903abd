"""Report sink: chart-ready tables as Parquet partitioned by client.

Replaces one image/PDF per client: each client's series land in their own
directory, so a reader that filters on ``client`` prunes the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_report(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("client",),
    mode: str = "overwrite",
    only_written_partitions: bool = False,
    rebalance: bool = True,
) -> None:
    """Write partitioned by client. ``only_written_partitions``: an overwrite
    replaces just the clients present in ``df`` (dynamic partition
    overwrite), leaving other clients' directories as they are.

    ``rebalance``: the rows are dealt by the partition columns before they are
    written, so that there are about as many files as the data needs
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each), not one per client
    and task. Adaptive execution packs small clients into one task, where each
    becomes one file, and splits a large one (with those dealt to the same partition) over several; without it
    (``spark.sql.adaptive.enabled`` false) nothing is dealt, since one task would
    then get all of a large client. Without it the writer sorts each task's rows
    by the partition columns and every task writes its own files."""
    if rebalance and partition_by and (df.sparkSession.conf.get("spark.sql.adaptive.enabled") or "").lower() == "true":
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if only_written_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read back with the declared schema (partition values are not re-typed)."""
    return spark.read.schema(schema).parquet(path)
