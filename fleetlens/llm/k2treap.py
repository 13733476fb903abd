"""Ranked lexical search over K2-treaps.

A block of documents is a grid of terms by documents whose cells hold impacts,
kept as a compressed quadtree: every level has only the cells that are not
empty, four bits a cell say which quarters follow, the rank of a bit gives the
quarter's place, and each cell knows the greatest impact inside it. An item's
terms are rows of the grid. Their paths descend together over ranges of
documents: a range's bound is the weighted sum of the greatest impacts of the
cells that its rows are in, the ranges of the best bounds are halved first, and
a range of one document has its exact score. What cannot reach the k-th best
score is never opened.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import arrow_schema, pick, release_memory, slices
from fleetlens.llm.jaccard import FILTER_BITS, bitmap, has_bit
from fleetlens.runtime import broadcast_limit, materialize

# Bytes of UTF-8 that belong to terms: 0-9, A-Z, a-z and all of other characters.
# Only A-Z are folded; every other byte parts terms.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
BLOCK_POSTINGS, BLOCK_DOCS, CHUNK_ITEMS = 1 << 20, 1 << 16, 1024
NO_ID = -1 - (1 << 62)  # stands for a null id: such a row is counted, but no answer
PIECE = 1 << 17  # postings that arithmetic is done on at a time
BLOCK_SCHEMA = "n_docs long, n_words long, ids binary, lengths binary, terms binary, dfs binary, cols binary, tfs binary"
HIT_SCHEMA = "item_id long, doc_id long, score long"
# How many of the quarters before q a cell has, by 4 * mask + q; -1 where quarter q is empty.
RANK = np.array([bin(m & ((1 << q) - 1)).count("1") if m >> q & 1 else -1 for m in range(16) for q in range(4)], np.int32)


def term_bit(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) & (FILTER_BITS - 1)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class BlockBuilder:
    """Documents of one block: postings by (term, document), terms by falling
    document frequency, documents by their most frequent term and length, so
    that neighbours in the grid are alike and the bounds are tight."""

    def __init__(self) -> None:
        self.row: dict[bytes, int] = defaultdict(lambda: len(self.row))
        self.ids, self.lengths, self.distinct = array("q"), array("q"), array("q")
        self.rows, self.tfs = array("i"), array("q")

    def add(self, doc_id: int, words: list[bytes]) -> None:
        counts = Counter(words)
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.distinct.append(len(counts))
        self.rows.extend(map(self.row.__getitem__, counts))
        self.tfs.extend(counts.values())

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_POSTINGS or len(self.ids) >= BLOCK_DOCS

    def block(self) -> dict:
        rows, tfs = np.frombuffer(self.rows, np.int32).astype(np.int64), np.frombuffer(self.tfs, np.int64)
        ids, lengths, distinct = (np.frombuffer(x, np.int64) for x in (self.ids, self.lengths, self.distinct))
        df = np.bincount(rows, minlength=len(self.row))
        by_df = np.argsort(-df, kind="stable")
        place = np.empty(len(by_df), np.int64)
        place[by_df] = np.arange(len(by_df))
        rows = place[rows]
        starts = np.cumsum(distinct) - distinct
        common = np.maximum.reduceat((np.minimum(tfs, (1 << 31) - 1) << 32) - rows, starts)  # the most frequent term, the first of these
        docs = np.lexsort((lengths, (-common) & ((1 << 32) - 1)))
        column = np.empty(len(ids), np.int64)
        column[docs] = np.arange(len(ids))
        cols = np.repeat(column, distinct)
        order = np.lexsort((cols, rows))
        terms = list(self.row)
        tfs = np.minimum(tfs[order], (1 << 32) - 1)
        return {
            "n_docs": len(ids),
            "n_words": int(lengths.sum()),
            "ids": ids[docs].tobytes(),
            "lengths": lengths[docs].tobytes(),
            "terms": b" ".join([terms[i] for i in by_df.tolist()]),
            "dfs": df[by_df].astype(np.int32).tobytes(),
            "cols": cols[order].astype(np.uint16).tobytes(),
            "tfs": tfs.astype(np.min_scalar_type(int(tfs.max()))).tobytes(),
        }


def build_blocks(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index's blocks: postings of up to a million (term, document) pairs.
    Documents without a term are in none."""
    schema = arrow_schema(BLOCK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = BlockBuilder()
        for batch in slices(batches, 256):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if words := terms_of(text):
                    held.add(NO_ID if doc_id is None else doc_id, words)
                    if held.full():
                        yield pa.RecordBatch.from_pylist([held.block()], schema=schema)
                        held = BlockBuilder()
        if held.ids:
            yield pa.RecordBatch.from_pylist([held.block()], schema=schema)

    return pick(documents, id=id_col, text=text_col).mapInArrow(run, BLOCK_SCHEMA)


def spread(x: np.ndarray) -> np.ndarray:
    """The bits of numbers under 2**32, each moved to twice its place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """A grid of positive impacts as a compressed quadtree with cell maxima.

    Cells of all levels are numbered from the root on, level after level, in
    Morton order: ``mask`` has a bit for each quarter that follows, ``first``
    the number of the first of these (the rank of the bits before the cell),
    ``most`` the greatest impact inside. Number -1 is an empty cell."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray):
        self.height = max(int(rows.max(initial=0)), int(cols.max(initial=0)), 1).bit_length()
        code = np.empty(len(rows), np.uint64)
        for a in range(0, len(rows), PIECE):
            code[a : a + PIECE] = spread(rows[a : a + PIECE]) << np.uint64(1) | spread(cols[a : a + PIECE])
        order = np.argsort(code, kind="stable")
        code, most = code[order], impacts[order].astype(np.int32)
        del order
        masks, mosts = [np.zeros(len(code), np.uint8)], [most]
        for _ in range(self.height):
            above = code >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]]))
            masks.append(np.bitwise_or.reduceat((1 << (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8), starts))
            most = np.maximum.reduceat(most, starts)
            mosts.append(most)
            code = above[starts]
        self.mask = np.concatenate([*masks[::-1], np.zeros(1, np.uint8)])
        del masks
        self.most = np.concatenate([*mosts[::-1], np.zeros(1, np.int32)])
        del mosts
        follow = np.bitwise_count(self.mask)
        self.first = np.cumsum(follow, dtype=np.int32)
        self.first -= follow
        self.first += 1

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of the columns with the ``k`` greatest weighted sums
        of impacts over ``rows``, and all that tie with the last of them; those
        under ``least`` and those of score 0 may be left out."""
        least = max(least, 1)
        inside = rows >> self.height == 0  # rows beyond the grid are empty
        rows, weights = rows[inside], weights[inside]
        found_cols, found = np.empty(0, np.int64), np.empty(0, np.int64)
        cells = np.zeros((1, len(rows)), np.int32)
        start, level = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = (self.most[cells].astype(np.int64) * weights).sum(axis=1)
        while len(bound):
            # The ranges of the best bounds are halved, some at a time.
            if len(bound) > step:
                now = np.argpartition(-bound, step)
                now, later = now[:step], now[step:]
                later = later[bound[later] >= least]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            c, s, v = cells[now], start[now], level[now]
            side = (rows[None, :] >> (self.height - 1 - v)[:, None]) & 1
            at, first = self.mask[c].astype(np.int64) << 2 | side << 1, self.first[c]
            parts = []
            for half in (0, 1):
                rank = RANK[at | half]
                child = np.where(rank < 0, -1, first + rank)
                total = (self.most[child] * weights).sum(axis=1)
                keep = total >= least
                parts.append((child[keep], (s | half << (self.height - 1 - v))[keep], v[keep] + 1, total[keep]))
            c, s, v, b = (np.concatenate(x) for x in zip(*parts))
            done = v == self.height
            if done.any():
                found_cols, found = np.concatenate([found_cols, s[done]]), np.concatenate([found, b[done]])
                if len(found) > k:
                    least = max(least, int(-np.partition(-found, k - 1)[k - 1]))
                    keep = found >= least
                    found_cols, found = found_cols[keep], found[keep]
            keep = ~done & (b >= least)
            cells, start, level, bound = (np.concatenate([old[later], new[keep]]) for old, new in ((cells, c), (start, s), (level, v), (bound, b)))
        return found_cols, found


class TreapBlock:
    """One block of the index with its impacts; ``ask`` makes it ready for items
    that ask for no other terms."""

    def __init__(self, row: dict, n_docs: int, n_words: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        lengths = np.frombuffer(row["lengths"], np.int64)
        m = 100 - 25 + (25 * lengths * n_docs) // n_words
        cols, dfs = np.frombuffer(row["cols"], np.uint16), np.frombuffer(row["dfs"], np.int32)
        tfs = np.frombuffer(row["tfs"], f"u{len(row['tfs']) // len(cols)}")
        impacts = np.empty(len(cols), np.int32)
        for a in range(0, len(cols), PIECE):
            tf = tfs[a : a + PIECE].astype(np.int64)
            impacts[a : a + PIECE] = (1_000_000_000 * tf) // (1000 * tf + 12 * m[cols[a : a + PIECE]])
        self.treap = Treap(np.repeat(np.arange(len(dfs), dtype=np.int32), dfs), cols, impacts)
        self.terms = row["terms"]

    def ask(self, asked: set[bytes]) -> None:
        self.row = {t: i for i, t in enumerate(bytes(self.terms).split(b" ")) if t in asked}

    def best(self, terms: list[bytes], weights: list[int], k: int, least: int) -> list[tuple[int, int]]:
        """(score, id) of the block's best documents for an item: those that can
        be among the ``k`` best, best first, ties to smaller ids."""
        have = [(self.row[t], w) for t, w in zip(terms, weights) if t in self.row]
        if not have:
            return []
        rows, weights = (np.array(x, np.int64) for x in zip(*have))
        cols, scores = self.treap.best(rows, weights, k, least)
        ids = self.ids[cols]
        keep = ids != NO_ID
        ids, scores = ids[keep], scores[keep]
        top = np.lexsort((ids, -scores))[:k]
        return list(zip(scores[top].tolist(), ids[top].tolist()))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``item_id``, ``term``, ``n``, ``bit``): each item's terms with their repeats
    and ``term_bit``."""
    ddl = "item_id long, term binary, n long, bit long"
    schema = arrow_schema(ddl)
    one = pick(items, id=id_col, text=text_col).filter("id IS NOT NULL").groupBy("id").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            rows = [(i, t, n, term_bit(t)) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t, n in Counter(terms_of(text)).items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else ((), (), (), ()), schema)], schema=schema)

    return one.mapInArrow(run, ddl)


def document_frequencies(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """(``term``, ``df``) of each block, of its terms that may be among the asked
    ones: a bitmap keeps most others out of what follows."""
    table = blocks.sparkSession.sparkContext.broadcast(bitmap(asked.select("bit")))
    schema = arrow_schema("term binary, df long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):  # a row at a time: each holds a block's terms
            terms, dfs = batch.column(0)[0].as_py().split(b" "), np.frombuffer(batch.column(1)[0].as_buffer(), np.int32)
            some = np.flatnonzero(has_bit(table.value, np.fromiter(map(term_bit, terms), np.int64, len(terms))))
            yield pa.RecordBatch.from_arrays([pa.array([terms[i] for i in some.tolist()], pa.binary()), pa.array(dfs[some], pa.int64())], schema=schema)

    return blocks.select("terms", "dfs").mapInArrow(run, "term binary, df long")


def ranked_search(
    documents: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(``item_id``, ``rank`` from 1, ``doc_id``, ``score``): for each item the
    ``k`` documents of the greatest score above 0, ties to smaller ids, or all
    such documents where there are fewer.

    The score is BM25 (k1 1.2, b 0.25) in integers: a term has the weight
    floor(1000 ln((2N + 2) / (2 df + 1))) and the impact
    10^9 tf div (1000 tf + 12 m), m = 75 + 25 n N div L; its repeats in the item
    count. N, L and df cover all documents.

    A null or empty text has no terms, and a document without a term is not
    counted in N. A document without an id counts in N, L and df but is no
    answer; with an id that repeats, each of its rows is one. Items without an
    id or term have no rows; an item id that repeats is asked by its least text.
    Empty tables give no rows. Other columns are ignored.

    Every document is indexed, in blocks of a bounded number of postings that
    are written once; each block meets the items in pieces of bounded number by
    an equi-join, broadcast only when the pieces' size is measured and fits, and
    only a task's best ``k`` documents of each item leave it.
    """
    spark = documents.sparkSession
    table = materialize(
        build_blocks(documents, id_col, text_col).withColumns({"part": F.spark_partition_id(), "block": F.monotonically_increasing_id()}),
        "treap-blocks",
        {"n_docs": F.sum("n_docs"), "n_words": F.sum("n_words"), "parts": F.max("part")},
    )
    if not table.rows:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    blocks, n_docs, n_words, parts = table.df, int(table.metrics["n_docs"]), int(table.metrics["n_words"]), int(table.metrics["parts"]) + 1

    asked = materialize(item_terms(items, item_col, item_text_col), "item-terms", {"term_bytes": F.sum(F.octet_length("term"))})
    asked_bytes = 64 * asked.rows + int(asked.metrics["term_bytes"] or 0)  # in memory, at most
    vocabulary = asked.df.select("term").distinct()
    small = asked_bytes <= broadcast_limit(spark)
    counted = document_frequencies(blocks, asked.df)
    df = counted.join(F.broadcast(vocabulary) if small else vocabulary.hint("merge"), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    weighted = asked.df.join(df.hint("merge"), "term").select("item_id", "term", (weight * F.col("n")).alias("w")).filter("w > 0")
    one = weighted.groupBy("item_id").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    chunks = -(-asked.rows // (CHUNK_ITEMS * 32)) or 1
    pieces = materialize(
        one.withColumn("chunk", F.pmod(F.xxhash64("item_id"), F.lit(chunks)))
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("item_id", F.col("terms.term").alias("terms"), F.col("terms.w").alias("weights"))).alias("items"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))),
        "item-pieces",
    ).df
    small = asked_bytes * parts <= broadcast_limit(spark)
    met = blocks.drop("n_docs", "n_words").join(F.broadcast(pieces) if small else pieces.hint("merge"), "part")
    schema = arrow_schema(HIT_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, list[tuple[int, int]]] = {}
        held, block = None, None
        release_memory()
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):  # a row at a time: each holds a block
                if (name := batch.column(at["block"])[i].as_py()) != held:
                    block = None  # before there is another
                    held, block = name, TreapBlock({x: batch.column(at[x])[i].as_buffer() for x in ("ids", "lengths", "terms", "dfs", "cols", "tfs")}, n_docs, n_words)
                    release_memory()
                items = batch.column(at["items"])[i].as_py()
                block.ask({t for item in items for t in item["terms"]})
                for item in items:
                    so_far = top.get(item["item_id"], [])
                    least = so_far[-1][0] if len(so_far) == k else 1
                    new = block.best(item["terms"], item["weights"], k, least)
                    top[item["item_id"]] = sorted(so_far + new, key=lambda x: (-x[0], x[1]))[:k]
        block = None
        release_memory()
        rows = [(item, doc, score) for item, best in top.items() for score, doc in best]
        for a in range(0, len(rows), 8192):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows[a : a + 8192]), schema)], schema=schema)

    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    hits = met.mapInArrow(run, HIT_SCHEMA)
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
