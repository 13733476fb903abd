"""Load path: files with their own headers appended into a sample table.

The original pushed a whole spreadsheet through one Python process into a
document store, keyed by its headers. Here any Spark-readable export is read in
parallel, its columns are matched by name, and bad values stop the load or go
to a rejects output; nothing becomes null unseen.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.columns import METRIC
from fleetlens.runtime import delete_path, list_path, path_exists, rename_path
from fleetlens.sources.scan import CANONICAL_SCHEMA, canonicalize, rejection

# Text formats keep full microsecond precision (the default writes milliseconds).
TEXT_FORMATS = ("json", "csv")
TEXT_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
REASON = "reject_reason"


@dataclass(frozen=True)
class Loaded:
    """The target table after a load, and how many rows went where."""

    table: DataFrame
    loaded: int
    rejected: int


def _text_options(fmt: str) -> dict[str, str]:
    base = dict(TEXT_OPTIONS) if fmt in TEXT_FORMATS else {}
    return base | {"header": "true"} if fmt == "csv" else base


def read_source(
    spark: SparkSession, path: str | None, fmt: str = "json", schema: T.StructType | str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The source's own columns. Without a ``schema`` their names come from the
    file (a CSV header; for JSON a pass over the records, unless given) and
    values of text formats stay strings. A record that does not parse fails
    the job, and so does a CSV whose header differs from a given schema."""
    defaults = _text_options(fmt)
    if fmt in TEXT_FORMATS:
        defaults |= {"mode": "FAILFAST"}
    if fmt == "json":
        defaults |= {"primitivesAsString": "true"}
    if fmt == "csv":
        defaults |= {"enforceSchema": "false"}
    reader = spark.read.format(fmt).options(**defaults | dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def _stored(spark: SparkSession, fmt: str, path: str | None, options: Mapping[str, str], schema: T.StructType | None) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def _write(df: DataFrame, fmt: str, path: str | None, options: Mapping[str, str], mode: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write ``df``; the number of rows, observed by the write."""
    seen = Observation()
    writer = df.observe(seen, F.expr("count(1) AS n")).write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path) if path is not None else writer.save()
    return int(seen.get["n"])


def ingest(
    spark: SparkSession,
    source_path: str | None,
    target_path: str | None,
    source_format: str = "json",
    schema: T.StructType | str | None = None,
    target_format: str = "parquet",
    mode: str = "append",
    options: Mapping[str, str] | None = None,
    target_options: Mapping[str, str] | None = None,
    partition_by: tuple[str, ...] = (),
    mapping: Mapping[str, str] | None = None,
    metric_type: str = "double",
    rejects_path: str | None = None,
    load_id: str | None = None,
) -> Loaded:
    """Append the source's rows, as canonical samples, to the target.

    Columns are matched by name (``mapping``: source name -> canonical name).
    ``schema``: the source's own columns, declared. Without ``rejects_path`` a
    time or metric that does not parse fails the load; with it such rows go
    there, as they were read and with the reason, as JSON.

    A load is all or nothing. Rows and rejects are written to hidden folders
    (``_staging-<load_id>``) beside where they belong; only when both are whole are
    they renamed to ``load_id=<load_id>`` in the rejects folder, then in the
    target. A load that fails leaves neither. A load that is run again with the
    same ``load_id`` (letters, digits, ``.``, ``_`` and ``-``; a new one by default)
    adds nothing if its rows are there, and finishes a load that stopped between
    the two renames. Readers of the folders see ``load_id`` as a partition column.
    ``mode``: ``append``; ``overwrite`` (earlier loads go once this one is there);
    ``error`` and ``ignore`` where the target has something already.

    ``target_options`` without a ``target_path`` configure a connector: it writes
    by its own rules (``mode`` is handed on), and the rejects are published after it.
    """
    if load_id is None:
        load_id = uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", load_id):
        raise ValueError(f"not a load id: {load_id!r}")
    if mode not in ("append", "overwrite", "error", "errorifexists", "ignore"):
        raise ValueError(f"unknown mode {mode!r}")
    to = _text_options(target_format) | dict(target_options or {})
    rows_schema = T.StructType([T.StructField(f.name, T._parse_datatype_string(metric_type) if f.name == METRIC else f.dataType) for f in CANONICAL_SCHEMA])

    def home(root: str, prefix: str = "load_id=") -> str:
        return f"{root.rstrip('/')}/{prefix}{load_id}"

    def table() -> DataFrame:
        if target_path is None:
            return _stored(spark, target_format, None, to, None)
        return _stored(spark, target_format, target_path, to, rows_schema).select(*rows_schema.names)

    if target_path is not None:
        if path_exists(spark, home(target_path)):
            rejected = spark.read.text(home(rejects_path)).count() if rejects_path is not None and path_exists(spark, home(rejects_path)) else 0
            return Loaded(table(), _stored(spark, target_format, home(target_path), to, rows_schema).count(), rejected)
        taken = [n for n in list_path(spark, target_path) if not n.startswith(("_", "."))]
        if taken and mode in ("error", "errorifexists"):
            raise FileExistsError(target_path)
        if taken and mode == "ignore":
            return Loaded(table(), 0, 0)
    staged = [home(p, "_staging-") for p in (rejects_path, target_path) if p is not None]
    try:
        source = read_source(spark, source_path, source_format, schema, options)
        rejected = 0
        if rejects_path is not None:
            why = rejection(source, mapping, metric_type)
            bad = source.withColumn(REASON, why).filter(F.col(REASON).isNotNull())
            rejected = _write(bad, "json", home(rejects_path, "_staging-"), {}, "overwrite")
            source = source.filter(why.isNull())
        rows = canonicalize(source, mapping, metric_type)
        if target_path is None:
            loaded = _write(rows, target_format, None, to, mode, partition_by)
        else:
            loaded = _write(rows, target_format, home(target_path, "_staging-"), to, "overwrite", partition_by)
        for root in (rejects_path, target_path):  # the target last: where it is, all is
            if root is not None:
                if path_exists(spark, home(root)):  # of a load that stopped here
                    delete_path(spark, home(root))
                rename_path(spark, home(root, "_staging-"), home(root))
    finally:
        for path in staged:
            delete_path(spark, path)
    if target_path is not None and mode == "overwrite":
        for name in taken:
            delete_path(spark, f"{target_path.rstrip('/')}/{name}")
    return Loaded(table(), loaded, rejected)


def export(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite", options: Mapping[str, str] | None = None) -> None:
    """Write a sample table in an interchange format (the spreadsheet's role)."""
    df.write.mode(mode).format(fmt).options(**_text_options(fmt) | dict(options or {})).save(path)
