"""Sample-table scans: any Spark data source mapped onto the canonical schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.columns import METRIC, PROCESSOR, SERVER, TIME

CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField(SERVER, T.StringType(), True),
        T.StructField(PROCESSOR, T.StringType(), True),
        T.StructField(TIME, T.TimestampNTZType(), True),
        T.StructField(METRIC, T.DoubleType(), True),
    ]
)

# Column names of the original sample collection, mapped to ours.
SOURCE_COLUMNS = {
    "Server_Name": SERVER,
    "Processor": PROCESSOR,
    "HR_Time": TIME,
    "AVG_%_Processor_Time": METRIC,
}


# Why a row is rejected, by canonical column.
REASONS = {TIME: "time", METRIC: "metric"}


def _sources(df: DataFrame, mapping: Mapping[str, str] | None) -> dict[str, tuple[Column, T.DataType]]:
    """The source column of each canonical one, found by name: the original
    name first, then the canonical one."""
    by_target = {v: k for k, v in (SOURCE_COLUMNS if mapping is None else mapping).items()}
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for target in CANONICAL_SCHEMA.names:
        name = next((n for n in (by_target.get(target), target) if n is not None and n in fields), None)
        if name is None:
            raise ValueError(f"no column for {target} (looked for {by_target.get(target)!r}) in {sorted(fields)}")
        out[target] = F.col(f"`{name}`"), fields[name]
    return out


def _parsed(source: Column, dtype: T.DataType, kind: str) -> Column:
    # a string goes straight to the zone-free type: the session's zone plays no part
    return source.try_cast(kind) if isinstance(dtype, T.StringType) else source.cast(kind)


def rejection(df: DataFrame, mapping: Mapping[str, str] | None = None, metric_type: str = "double") -> Column:
    """Why ``canonicalize`` cannot take a row (``time``, ``metric``,
    ``time,metric``), or null. Null and missing values are not rejected."""
    found = _sources(df, mapping)
    bad = []
    for target, kind in ((TIME, "timestamp_ntz"), (METRIC, metric_type)):
        source, dtype = found[target]
        if isinstance(dtype, T.StringType):
            bad.append(F.when(source.isNotNull() & _parsed(source, dtype, kind).isNull(), F.lit(REASONS[target])))
    return F.nullif(F.concat_ws(",", *bad), F.lit("")) if bad else F.lit(None).cast("string")


def canonicalize(df: DataFrame, mapping: Mapping[str, str] | None = None, metric_type: str = "double", bad_values: str = "raise") -> DataFrame:
    """Select and cast the four used columns (column pruning reaches the scan).

    ``bad_values``: a string that is no time, or no number, makes the job fail
    (``raise``) or becomes null (``null``; count them with ``rejection``).
    """
    if bad_values not in ("raise", "null"):
        raise ValueError("bad_values must be 'raise' or 'null'")
    found = _sources(df, mapping)

    def strict(target: str, kind: str) -> Column:
        source, dtype = found[target]
        value = _parsed(source, dtype, kind)
        if bad_values == "null" or not isinstance(dtype, T.StringType):
            return value
        message = F.concat(F.lit(f"not a {REASONS[target]}: "), source)
        return F.when(source.isNotNull() & value.isNull(), F.raise_error(message).cast(kind)).otherwise(value)

    return df.select(
        found[SERVER][0].cast("string").alias(SERVER),
        found[PROCESSOR][0].cast("string").alias(PROCESSOR),
        strict(TIME, "timestamp_ntz").alias(TIME),
        strict(METRIC, metric_type).alias(METRIC),
    )


def scan_metrics(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    mapping: Mapping[str, str] | None = None,
    metric_type: str = "double",
    schema: T.StructType | str | None = None,
    table: str | None = None,
    bad_values: str = "raise",
) -> DataFrame:
    """``spark.read.format(fmt).options(...).load(path)``, or a catalog
    ``table`` or view, onto the canonical schema.

    The format is a parameter: a document-store connector (given its jar and a
    ``uri`` option), Parquet, ORC, JSON or CSV all work alike. Pass the source
    ``schema`` (or just the used columns) to skip inference.
    """
    if table is not None:
        return canonicalize(spark.read.table(table), mapping, metric_type, bad_values)
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.load(path) if path is not None else reader.load()
    return canonicalize(raw, mapping, metric_type, bad_values)


# The columns of the driver's ``events`` table that the adapter
# reads, with their types (declared, so no schema inference pass is needed).
EVENTS_COLUMNS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table shaped as CPU samples, every row used once.

    Names follow ``ccc-H`` plus a sixth character, from event_type and user_id.
    They also hold what real fleets do: every seventh user's name repeats a
    host letter (hosts overlap), every eleventh user's name ends in another
    client's key (clients overlap), some names are short or null, one client
    (``zor``) has no ``_Total`` rows, and some times and metrics are null. The
    metric is DECIMAL(18,2), so sums are exact in any order.
    """
    ev = spark.read.schema(EVENTS_COLUMNS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    prefix = "substring(event_type, 1, 3)"
    letter = lambda n: f"char(CAST(65 + user_id % {n} AS INT))"
    name = f"""concat({prefix}, '-', {letter(10)}, CASE WHEN user_id % 7 = 0 THEN {letter(3)} ELSE '0' END,
        CASE WHEN user_id % 11 = 0 THEN CASE WHEN {prefix} = 'pur' THEN 'vie' ELSE 'pur' END ELSE '' END)"""
    server = f"CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 47 = 0 THEN {prefix} WHEN event_id % 41 = 0 THEN 'zor-Z0' ELSE {name} END"
    return ev.selectExpr(
        f"{server} AS {SERVER}",
        f"CASE WHEN event_id % 4 = 0 OR ({server}) = 'zor-Z0' THEN '0' ELSE '_Total' END AS {PROCESSOR}",
        f"CASE WHEN event_id % 37 <> 0 THEN ts END AS {TIME}",
        f"CASE WHEN event_id % 31 <> 0 THEN CAST(value AS DECIMAL(18, 2)) END AS {METRIC}",
    )


def events_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a canonical sample table (the test adapter)."""
    return _events(spark, sf_dir)


def events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as the original collection has its records: its column
    names, with time and metric as text."""
    return _events(spark, sf_dir).select(*[F.col(c).cast("string").alias(name) for name, c in SOURCE_COLUMNS.items()])
