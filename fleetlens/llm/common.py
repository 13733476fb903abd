"""Helpers shared by the operators: table reads, column picks, Arrow output."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path Spark's reader accepts."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, doc_id="id", text="body")``: those columns under those names.

    Columns the operator does not use are left out, whatever they are called.
    """
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string; on the driver only."""
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def release_memory() -> None:
    """Give what is free in Arrow's pool and, where the C library can, in the heap
    that numpy and Python use back to the machine; a reused worker would keep it
    through all later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that few texts are Python objects at a time; the
    worker gives back what its last task left, and at the end freed buffers."""
    release_memory()
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)
    release_memory()


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Apply a batch function to ``df``: ``make()`` runs once in each task and
    returns ``f(columns) -> columns``, where both are dicts of name -> list."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in slices(batches):
            out = f({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(out[x.name], x.type) for x in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def crc_mod(doc_id: str, n: int):
    """crc32 of the id's decimal text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def per_worker(holder: Broadcast, name: str, make: Callable[[Any], Any]) -> Any:
    """``make(value)`` of a broadcast ``{"value": value}``, made once in each
    Python worker process and kept there for its later tasks."""
    held = holder.value
    if name not in held:
        held[name] = make(held["value"])
    return held[name]


class Recent(dict):
    """``make(key)`` by key, for the last ``most`` to twice ``most`` distinct keys;
    longer keys than ``longest`` are not kept. Memory is bounded."""

    def __init__(self, make: Callable, most: int, longest: int = 64):
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
