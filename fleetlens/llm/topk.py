"""Exact top-k search by inner product over a bit-sliced index.

Vectors are quantised to integers. A block of rows is stored as bitmaps: for
each component, one bitmap for each bit of the value above the block's smallest.
A query adds the slices of all components, weighted by the bits of its own
values, with carry-save adders on whole bitmaps, which gives the slices of every
row's score. The top rows are selected from the most significant slice
downward; rows that tie at the boundary go by their exact ids.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import arrow_schema, pick
from fleetlens.runtime import materialize

SCALE = 64
MOST_TASKS = 100_000
INDEX_SCHEMA = "dims int, n int, ids binary, low binary, bits binary, slices binary"
QUERY_SCHEMA = "dims int, asked int, asked_ids binary, asked_vectors binary"


def quantise(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(vectors * float(scale)).astype(np.int64)


def usable(vectors: pa.Array) -> np.ndarray:
    """Rows whose vector is there, not empty, and all finite."""
    out = np.zeros(len(vectors), bool)
    for i, v in enumerate(vectors):
        values = v.values
        if values is not None and len(values) and not values.null_count:
            out[i] = bool(np.isfinite(values.to_numpy(zero_copy_only=False).astype(np.float64)).all())
    return out


def groups_by_length(batches, most: int):
    """(dims, ids, quantised vectors) of up to ``most`` rows of one length each."""
    held: dict[int, list] = {}
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        ok = usable(vectors) & ids.is_valid().to_numpy(zero_copy_only=False)
        if not ok.any():
            continue
        keep = pa.array(ok)
        vectors, ids = vectors.filter(keep), ids.filter(keep).to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for dims in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == dims)
            flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            held.setdefault(dims, []).append((ids[rows], quantise(flat.reshape(len(rows), dims))))
            while sum(len(x) for x, _ in held[dims]) >= most:
                i, v = (np.concatenate(x) for x in zip(*held[dims]))
                yield dims, i[:most], v[:most]
                held[dims] = [(i[most:], v[most:])]
    for dims, parts in held.items():
        i, v = (np.concatenate(x) for x in zip(*parts))
        if len(i):
            yield dims, i, v


def to_slices(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smallest value of each component, number of its bits, bitmaps by
    component and bit) of a block; rows are padded to whole 64-bit words."""
    low = vectors.min(axis=0)
    above = vectors - low
    bits = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
    width = -(-len(vectors) // 64) * 64
    maps = np.zeros((int(bits.sum()), width), np.uint8)
    at = 0
    for d, b in enumerate(bits.tolist()):
        for j in range(b):
            maps[at, : len(vectors)] = above[:, d] >> j & 1
            at += 1
    return low, bits, np.packbits(maps, axis=1, bitorder="little").view(np.uint64)


def add_slices(levels: dict[int, list[np.ndarray]]) -> dict[int, np.ndarray]:
    """One bitmap for each power of two: the sum, row by row, of bitmaps that
    stand for 2**level each. ``levels`` holds them in stacks (rows, words).
    Three bitmaps of a level become one there and one a level up."""
    out: dict[int, np.ndarray] = {}
    level = min(levels, default=0)
    while levels:
        stack = levels.pop(level, None)
        if stack:
            m = np.concatenate(stack) if len(stack) > 1 else stack[0]
            carries = []
            while len(m) > 2:
                third = len(m) // 3
                a, b, c, rest = m[:third], m[third : 2 * third], m[2 * third : 3 * third], m[3 * third :]
                x = a ^ b
                carries.append((a & b) | (x & c))
                m = np.concatenate([x ^ c, rest]) if len(rest) else x ^ c
            if len(m) == 2:
                carries.append(m[:1] & m[1:])
                m = m[:1] ^ m[1:]
            out[level] = m[0]
            if carries:
                levels.setdefault(level + 1, []).extend(carries)
        level += 1
    return out


def select_top(score: dict[int, np.ndarray], live: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (above, tied): the rows surely among the top ``k``, and those
    that tie for the places left, found from the most significant slice down."""
    above, tied = np.zeros_like(live), live
    for level in range(max(score, default=-1), -1, -1):
        s = score.get(level)
        if s is None:
            continue
        best = tied & s
        n = int(np.bitwise_count(above | best).sum())
        if n > k:
            tied = best
        else:
            above = above | best
            tied = tied & ~s
            if n == k:
                return above, np.zeros_like(live)
    return above, tied


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class SlicedBlock:
    """One block of the index, ready for queries."""

    def __init__(self, n: int, ids: bytes, low: bytes, bits: bytes, slices: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.low, self.bits = np.frombuffer(low, np.int64), np.frombuffer(bits, np.int64)
        words = -(-n // 64)
        self.maps = np.frombuffer(slices, np.uint64).reshape(-1, words)
        self.live = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)
        self.component = np.repeat(np.arange(len(self.bits)), self.bits)
        self.bit = np.concatenate([np.arange(b) for b in self.bits.tolist()]) if len(self.bits) else np.empty(0, np.int64)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the block's best ``k`` rows for a query, ties to
        smaller ids, the row(s) with the query's own id left out."""
        # A negative weight w of value u <= m counts as |w| (m - u) + w m, so that
        # only positive weights are added; m - u is u's bits turned over.
        most = (1 << self.bits) - 1
        offset = int((query * self.low).sum() + (query * most)[query < 0].sum())
        weight, flip = np.abs(query)[self.component], (query < 0)[self.component]
        levels: dict[int, list[np.ndarray]] = {}
        for i in range(int(weight.max(initial=0)).bit_length()):
            with_bit = weight >> i & 1 == 1
            for j in np.unique(self.bit[with_bit]).tolist():
                rows = with_bit & (self.bit == j)
                levels.setdefault(i + j, []).extend(x for x in (self.maps[rows & ~flip], ~self.maps[rows & flip]) if len(x))
        score = add_slices(levels)
        live = self.live
        if len(same := np.flatnonzero(self.ids == own)):
            live = live.copy()
            for r in same.tolist():
                live[r >> 6] &= ~np.uint64(1 << (r & 63))
        above, tied = select_top(score, live, k)
        first = rows_of(above)
        rest = rows_of(tied)
        if (left := k - len(first)) < len(rest):  # all of these have one score: the smallest ids win
            rest = rest[np.argsort(self.ids[rest], kind="stable")[:left]]
        rows = np.concatenate([first, rest])
        totals = np.full(len(rows), offset, np.int64)
        for level, s in score.items():
            totals += (s[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << level
        return self.ids[rows], totals


def build_index(vectors: DataFrame, block_rows: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The bit-sliced index: a row for each block of up to ``block_rows``
    vectors of one length; ``part`` is the partition that it was made from."""

    schema = arrow_schema(INDEX_SCHEMA)

    def run(batches):
        for dims, ids, v in groups_by_length(batches, block_rows):
            low, bits, maps = to_slices(v)
            yield pa.RecordBatch.from_pylist([{"dims": dims, "n": len(ids), "ids": ids.tobytes(), "low": low.tobytes(), "bits": bits.tobytes(), "slices": maps.tobytes()}], schema=schema)

    return pick(vectors, id=id_col, v=vector_col).mapInArrow(run, INDEX_SCHEMA).withColumn("part", F.spark_partition_id())


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = 8192, query_rows: int = 512, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(``query_id``, ``rank`` from 1, ``vec_id``, ``score``): for each query
    the ``k`` rows of ``vectors`` of the greatest integer inner product with it,
    ties to smaller ids; fewer where there are fewer.

    Vectors that are null, empty, or hold a null or non-finite component take
    no part, nor do null ids; rows with the query's own id are no candidates;
    vectors of another length than the query's aren't compared with it. An id
    that repeats among the vectors is a candidate with each of its rows; one
    that repeats among the queries is answered once, by its first usable
    row in vector order. Quantised components must be under 2**24 in size, or the scores may
    not fit 64 bits. Other columns are ignored.

    Rows and queries are dealt into blocks of fixed size, and each pair of
    blocks is one step; only a block's best ``k`` rows for each query leave it.
    """
    parts = max(1, math.ceil(vectors.count() / block_rows))
    index = materialize(build_index(vectors.repartition(parts), block_rows, id_col=id_col, vector_col=vector_col), "sliced-index").df

    block_schema = arrow_schema(QUERY_SCHEMA)

    def run_queries(batches):
        for dims, ids, v in groups_by_length(batches, query_rows):
            yield pa.RecordBatch.from_pylist([{"dims": dims, "asked": len(ids), "asked_ids": ids.tobytes(), "asked_vectors": v.tobytes()}], schema=block_schema)

    fit = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    asked = pick(queries, id=id_col, v=vector_col).filter(fit).groupBy("id").agg(F.min("v").alias("v"))
    blocks = materialize(asked.mapInArrow(run_queries, QUERY_SCHEMA), "query-blocks").df
    # Each query block meets the index blocks of each part that have its length. Both
    # sides carry blocks of bounded size, so a pair is a bounded step.
    # A pair costs much time and few bytes: the number of partitions is given, so that it
    # is not made smaller by size, and large enough that few parts share one.
    asked_of = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    spread = min(4 * parts, MOST_TASKS)
    met = index.repartition(spread, "part", "dims").join(asked_of.repartition(spread, "part", "dims").hint("merge"), ["part", "dims"])

    def search(batches):
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        for batch in batches:
            for i in range(batch.num_rows):  # a row at a time: each holds two blocks
                row = batch.slice(i, 1).to_pylist()[0]
                block = SlicedBlock(row["n"], row["ids"], row["low"], row["bits"], row["slices"])
                query_ids = np.frombuffer(row["asked_ids"], np.int64)
                values = np.frombuffer(row["asked_vectors"], np.int64).reshape(row["asked"], -1)
                best = [block.top(int(own), v, k) for own, v in zip(query_ids, values)]
                of = np.repeat(query_ids, [len(x) for x, _ in best])
                yield pa.RecordBatch.from_arrays([pa.array(of), *(pa.array(np.concatenate(x)) for x in zip(*best))], schema=schema)

    found = met.mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
