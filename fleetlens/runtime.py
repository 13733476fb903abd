"""Session-level helpers: where durable intermediates go, and size-checked
broadcasts.

Library code never sets the master or memory; the caller owns the session.
``local_session`` exists for tests, the bench and the driver contract only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Used when the session has no usable spark.sql.autoBroadcastJoinThreshold.
DEFAULT_MAX_BROADCAST_BYTES = 10 * 1024 * 1024
_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "fleetlens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.driver.memory", os.environ.get("FLEETLENS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for durable intermediates.

    Uses the checkpoint directory the session already names
    (``spark.checkpoint.dir``). Only a local-mode session without one gets a
    fresh temporary folder; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of that machine. Under
    Spark Connect (no SparkContext on the client) the session conf is read.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared (cluster-wide) folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared (cluster-wide) folder")
        configured = tempfile.mkdtemp(prefix="fleetlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/fleetlens/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where there is no such folder."""
    fs, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its store; the target must not exist. One step
    where the store has renames (on an object store it is a copy)."""
    fs, to = _file_system(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), to):
        raise RuntimeError(f"could not rename {source} to {target}")


def shuffle_partitions(spark: SparkSession, default: int = 200) -> int:
    """``spark.sql.shuffle.partitions`` as a number (some platforms allow
    non-numeric values such as ``auto``; those fall back to ``default``)."""
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", str(default))))
    except (TypeError, ValueError):
        return default


def broadcast_limit(spark: SparkSession) -> int:
    """Largest table (estimated bytes) to broadcast: the session's
    ``spark.sql.autoBroadcastJoinThreshold``; <= 0 there means never."""
    raw = (spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None) or "").strip().lower()
    if not raw:
        return DEFAULT_MAX_BROADCAST_BYTES
    num = raw.rstrip("bkmgt")
    unit = raw[len(num):] or "b"
    try:
        return int(float(num) * _UNITS[unit])
    except (KeyError, ValueError):
        return DEFAULT_MAX_BROADCAST_BYTES


def row_bytes(df: DataFrame) -> Column:
    """Per-row size estimate of ``df`` in memory (Spark's row format): byte
    length + 8 for every string, 24 for a decimal wider than 18 digits, 8 for
    any other flat field, 16 bytes of row overhead."""
    fixed, strings = 16, []
    for f in df.schema.fields:
        fixed += 24 if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18 else 8
        if isinstance(f.dataType, T.StringType):
            strings.append("coalesce(octet_length(`{}`), 0)".format(f.name.replace("`", "``")))
    return F.expr(f"CAST({' + '.join([str(fixed), *strings])} AS BIGINT)")


@dataclass(frozen=True)
class Table:
    """A written table: the DataFrame reading it back, its exact row count,
    its estimated in-memory size and any other metrics observed while it was
    written."""

    df: DataFrame
    rows: int
    bytes: int
    metrics: dict[str, Any] = field(default_factory=dict)
    path: str = ""

    def delete(self) -> None:
        delete_path(self.df.sparkSession, self.path)


def materialize(
    df: DataFrame, label: str, metrics: Mapping[str, Column] | None = None, partition_by: tuple[str, ...] = (), compression: str | None = None
) -> Table:
    """Write ``df`` as Parquet under the checkpoint root and read it back.

    Cuts the lineage (a lost executor re-reads the written table instead of
    recomputing from the raw scan) and gives the planner the real file size.
    The row count, size estimate and extra ``metrics`` are observed by the
    write job itself (``DataFrame.observe``), so no second job sizes it.
    ``partition_by`` columns become directories, so readers filtering on them
    skip the other directories (partition pruning). ``compression``: the Parquet
    codec, where the session's is not the one to use.
    """
    path = scratch_path(df.sparkSession, label)
    obs = Observation(f"fleetlens-{label}-{uuid.uuid4().hex[:12]}")  # unique: concurrent writes cannot mix
    exprs = [F.expr("count(1) AS rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")]
    exprs += [c.alias(k) for k, c in (metrics or {}).items()]
    writer = df.observe(obs, *exprs).write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    got = dict(obs.get)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return Table(back, int(got.pop("rows")), int(got.pop("bytes")), got, path)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None, bound: int | None = None) -> bool:
    """Whether ``df``'s estimated size is proven <= ``max_bytes`` (default: the
    session's broadcast threshold), using ``bound`` when it is tight enough
    and measuring the frame otherwise."""
    limit = broadcast_limit(df.sparkSession) if max_bytes is None else max_bytes
    if limit <= 0:
        return False
    if bound is None or bound > limit:
        bound = df.select(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()["b"]
    return bound <= limit
