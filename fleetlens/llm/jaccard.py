"""N-gram Jaccard join: documents linked by the overlap of their word shingles.

The documents are the rows, and the shingles the columns, of a sparse incidence
matrix; overlaps are entries of its product with its own transpose. A linked
pair must share one of the rarest shingles of each row, one more of them than
its size allows to miss; rows that share none of these cannot reach the bound,
and fall into different blocks of the product. Each block is multiplied by
column chunks, and pairs whose overlap so far plus all that is left stays below
the bound that their sizes give are discarded on the way. In a large block whose
rows share few of their rarest shingles, the product of these alone comes first,
and only pairs that can still reach the bound are looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import Recent, arrow_schema, pick, slices
from fleetlens.llm.components import connected_components
from fleetlens.runtime import materialize

FILTER_BITS = 1 << 24
PIVOTS = 8
SMALL = 96  # shingles of a set, at most, for it to be compared under the order of small sets
CHUNK = 2048  # columns multiplied at a time
STRIP = 256  # rows of a product that are looked at together


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingle_set(text: str | None, size: int, hashes: Recent) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles of the text,
    A-Z lower-cased; of fewer words, all of them make one shingle."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z only, and 0x20, 0x09-0x0D
    if not words:
        return np.empty(0, np.uint64)
    a = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    run = min(size, len(a))
    h = np.full(len(a) - run + 1, run, np.uint64)
    for j in range(run):
        h = (h ^ a[j : len(a) - run + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h * np.uint64(0xD6E8FEB86659FD93))


def fingerprint(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def prefix_size(n: int, percent: int) -> int:
    """Of a set of n, so many shingles in any fixed order hold one of any linked set."""
    return n - -(-percent * n // 100) + 1


def first_hashes(percent: int) -> int:
    """Shingles whose hashes are below this come first in the order of the largest
    sets, rare before frequent: five thirds of the share of a set that a prefix
    takes, at most half."""
    return min(1 << 63, (1 << 64) * (100 - percent) * 5 // 300)


def first_of_band(band: int, percent: int, whole: bool = False) -> int:
    """As ``first_hashes``; in the order of small sets (band 0) all come first. Of
    a small set few shingles have such hashes by chance, and where they hardly
    fill its prefix, what many sets share would get into that, too. ``whole``: all
    come first in the other order, too."""
    return first_hashes(percent) if band and not whole else 1 << 64


def bands(n: int, percent: int) -> list[int]:
    """The bands, each with an order of its own, that a set of n is in: its own, and
    the one above if that has a set which it may link with."""
    return [band for band, is_in in enumerate((n <= SMALL, 100 * n >= percent * (SMALL + 1))) if is_in]


def front_of(s: np.ndarray, band: int, percent: int, whole: bool) -> np.ndarray:
    """The shingles of a set that come first in a band's order, or its whole prefix
    where these are fewer, as keys: hashes whose last bit is the band."""
    first = first_of_band(band, percent, whole)
    early = len(s) if first >> 64 else int(np.searchsorted(s, np.uint64(first)))
    return (s[: max(early, prefix_size(len(s), percent))] & ~np.uint64(1)) | np.uint64(band)


def signatures(docs: DataFrame, size: int, percent: int, whole: bool = False) -> DataFrame:
    """(doc_id, n, print, front) of each row: its set's size, a 128-bit
    fingerprint of the set (null if empty), and of each of its bands the keys of
    its shingles that come first, or more where these are fewer than the prefix,
    by rising hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, n long, print binary, front array<long>"
    schema = arrow_schema(ddl)

    def run(batches):
        hashes = Recent(word_hash, 100_000)
        for batch in slices(batches):
            n, prints, fronts = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, size, hashes)
                n.append(len(s))
                prints.append(fingerprint(s))
                keys = [front_of(s, band, percent, whole) for band in bands(len(s), percent)] if len(s) else [s]
                fronts.append(np.concatenate(keys).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(fronts, pa.list_(pa.int64()))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def bitmap(bits: DataFrame) -> np.ndarray:
    """The bits (column ``bit``, below FILTER_BITS) that occur: a table of fixed
    size, built by partial ORs."""
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def has_bit(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (table[bits >> 6] >> (bits & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def hashed_bit(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{column}`")), F.lit(FILTER_BITS))


def shared_prefixes(signed: DataFrame, classes: DataFrame, percent: int, whole: bool = False) -> DataFrame:
    """(node, shingle): the keys of each class's prefixes, one of each of its bands,
    that other classes hold too.

    The order is: those of ``first_of_band`` by the number of classes that hold
    them, then the others by hash. Shingles of one class only need not be known one
    by one, so just the repeated ones, found by a count over all classes, go
    back to their rows. A bitmap of these keeps most others out of that join,
    and one of the classes' own rows keeps most copies out of the count (one
    that slips in makes a shingle seem less rare, for all rows alike).
    """
    spark = signed.sparkSession
    own = spark.sparkContext.broadcast(bitmap(classes.select(hashed_bit("node").alias("bit"))))

    def own_shingles(batches):
        for batch in batches:
            kept = batch.column(1).filter(pa.array(has_bit(own.value, batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays([kept.flatten()], names=["shingle"])

    fronts = signed.filter("n > 0").select(hashed_bit("row").alias("bit"), "front").mapInArrow(own_shingles, "shingle long")
    held = fronts.groupBy("shingle").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    held = materialize(held, "jaccard-columns").df
    table = spark.sparkContext.broadcast(bitmap(held.select(F.shiftright("shingle", 1).bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit"))))
    first = [first_of_band(band, percent, whole) for band in (0, 1)]
    ddl = "row long, unshared long, early int, front array<long>"
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in slices(batches):
            n, keys = batch.column(1).to_numpy(), batch.column(2).flatten().to_numpy()
            of, band = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy()), keys & 1
            member, at, size = np.unique(of * 2 + band, return_inverse=True, return_counts=True)  # a row in a band
            keep = has_bit(table.value, keys >> 1 & (FILTER_BITS - 1))
            early = np.zeros(len(keys), bool)
            for b, end in enumerate(first):
                early |= (band == b) & (True if end >> 64 else keys.view(np.uint64) < np.uint64(end))
            kept = np.bincount(at[keep], minlength=len(member))
            some = np.flatnonzero(kept)
            # how many of the prefix are left for shared ones, if no other is shared
            room = prefix_size(n[member >> 1], percent) - size
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept[some])]), pa.int32()), pa.array(keys[keep]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(member[some] >> 1)), pa.array(room[some]), pa.array(np.bincount(at[keep & early], minlength=len(member))[some], pa.int32()), lists], schema=schema)

    likely = signed.filter("n > 0").select("row", "n", "front").mapInArrow(run, ddl)
    likely = likely.join(classes.select("node").hint("merge"), F.col("row") == F.col("node")).select("node", F.col("unshared").alias("room"), "early", F.posexplode("front").alias("nth", "shingle"))
    known = likely.select("node", "room", (F.col("nth") >= F.col("early")).alias("late"), "shingle").join(held.hint("merge"), "shingle")
    order = F.struct("late", F.when(F.col("late"), 0).otherwise(F.col("classes")).alias("classes"), "shingle")
    rows = known.groupBy("node", F.expr("shingle & 1").alias("band")).agg(F.first("room").alias("room"), F.sort_array(F.collect_list(order)).alias("all"))
    rows = rows.withColumn("take", F.col("room") + F.size("all")).filter("take > 0")
    return rows.select("node", F.explode(F.slice("all", F.lit(1), F.col("take").cast("int"))).alias("s")).select("node", F.col("s.shingle").alias("shingle"))


def prefix_blocks(entries: DataFrame) -> DataFrame:
    """(node, block): nodes that share a key are in one block, and so are chains of these."""
    pivots = entries.groupBy("shingle").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("classes")).filter("classes > 1").select("shingle", "first")
    pivots = materialize(pivots, "jaccard-pivots").df
    near = entries.join(pivots.hint("merge"), "shingle").filter("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v")).distinct()
    return connected_components(near).select("node", F.col("root").alias("block"))


def bound_pairs(entries: DataFrame, parted: DataFrame, percent: int) -> DataFrame:
    """(u, v): pairs within a block, u of them open, that share prefix shingles and
    may link by their sizes (n) and by how many of these they share: what two
    sets share beyond the prefix of the one whose prefix ends first is at most the
    rest of that one. Only prefixes of the larger set's band count. ``parted`` has
    (node, block, n, open), ``entries`` (node, shingle)."""
    rest = f"ceil({percent} * n / 100) - 1"  # of n, those beyond the prefix
    held = entries.join(parted.select("node", "block", "n", "open", F.expr(rest).alias("rest")), "node")
    u = held.filter("open").select("block", "shingle", F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("rest").alias("rest_u"))
    v = held.select("block", "shingle", F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("rest").alias("rest_v"), F.col("open").alias("open_v"))
    fits = f"u <> v AND (NOT open_v OR u < v) AND 100 * least(n_u, n_v) >= {percent} * greatest(n_u, n_v)"
    same_band = F.expr(f"shingle & 1 = CAST(greatest(n_u, n_v) > {SMALL} AS INT)")
    shared = u.join(v.hint("merge"), ["block", "shingle"]).filter(fits).filter(same_band).groupBy("u", "v", "n_u", "n_v", "rest_u", "rest_v").agg(F.count(F.lit(1)).alias("shared"))
    return shared.filter(f"{100 + percent} * (shared + greatest(rest_u, rest_v)) >= {percent} * (n_u + n_v)").select("u", "v")


def checked_pairs(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (u, v) that link, by the texts of their nodes."""

    def run(batches):
        hashes = Recent(word_hash, 100_000)
        of = Recent(lambda t: shingle_set(t, size, hashes), 256, 1 << 20)
        for batch in slices(batches):
            sets = [[of[t] for t in batch.column(i).to_pylist()] for i in (2, 3)]
            keep = [(100 + percent) * len(np.intersect1d(a, b, assume_unique=True)) >= percent * (len(a) + len(b)) for a, b in zip(*sets)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    of_u, of_v = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in ("u", "v"))
    return pairs.join(of_v.hint("merge"), "v").join(of_u.hint("merge"), "u").select("u", "v", "text_u", "text_v").mapInArrow(run, EDGES)


def candidate_texts(docs: DataFrame, candidates: DataFrame, size: int) -> DataFrame:
    """(node, block, n, text) of the candidates (doc_id, print, node, block, n). A
    bitmap of their ids keeps most other rows out of the shuffle."""
    table = docs.sparkSession.sparkContext.broadcast(bitmap(candidates.select(hashed_bit("doc_id").alias("bit"))))
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, print binary, text string"
    schema = arrow_schema(ddl)

    def run(batches):
        hashes = Recent(word_hash, 100_000)
        for batch in slices(batches):
            likely = batch.filter(pa.array(has_bit(table.value, batch.column(2).to_numpy())))
            prints = [fingerprint(shingle_set(t, size, hashes)) for t in likely.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([likely.column(0), pa.array(prints, pa.binary()), likely.column(1)], schema=schema)

    texts = docs.select("doc_id", "text", hashed_bit("doc_id").alias("bit")).mapInArrow(run, ddl)
    alike = Window.partitionBy("doc_id", "print").orderBy(F.lit(0))  # rows that repeat id and set
    joined = texts.alias("t").join(candidates.hint("merge").alias("c"), F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.print") == F.col("c.print")))
    return joined.select("t.doc_id", "t.print", "text", "node", "block", "n").withColumn("nth", F.row_number().over(alike)).filter("nth = 1").select("node", "block", "n", "text")


def incidence(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the sets' elements, by column, rare columns first; those of
    one row are left out, as they add to no overlap."""
    _, column, frequency = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    shared = frequency[column] > 1
    order = np.argsort(frequency, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    row, column = row[shared], place[column[shared]] - np.int32((frequency == 1).sum())
    by = np.argsort(column, kind="stable")
    return row[by], column[by]


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Which pairs (of ``left`` by ``right``, or within ``left``) link: the
    incidence matrix times its transpose, a chunk of columns at a time. Of pairs
    only the overlap and whether they can link are kept; all else that is as large is
    made STRIP rows at a time."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], np.int64)
    split = len(left)
    row, column = incidence(sets)
    remaining = np.bincount(row, minlength=len(sets))
    rows, cols = (slice(0, split), slice(split, None)) if right is not None else (slice(None), slice(None))
    needed_rows, needed_cols = percent * sizes[rows], percent * sizes[cols]  # links if (100 + percent) * overlap >= their sum
    overlap = np.zeros((len(needed_rows), len(needed_cols)), np.float32)
    alive = np.ones(overlap.shape, bool)
    strips = [slice(a, a + STRIP) for a in range(0, len(overlap), STRIP)]

    def bound() -> None:
        """Discard pairs whose overlap so far plus all that is left is too small."""
        for s in strips:
            most = overlap[s] + np.minimum(remaining[rows][s, None], remaining[None, cols])
            alive[s] &= (100 + percent) * most >= needed_rows[s, None] + needed_cols[None, :]

    bound()
    if right is None:
        np.fill_diagonal(alive, False)
    live = np.ones(len(sets), bool)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, CHUNK):
        live[rows] = alive.any(axis=1)
        if right is not None:
            live[cols] = alive.any(axis=0)
        if not live.any():
            break
        i, e = np.searchsorted(column, [a, a + CHUNK])
        r, c = row[i:e], column[i:e] - a
        remaining -= np.bincount(r, minlength=len(sets))
        use = live[r]
        found, at = np.unique(r[use], return_inverse=True)
        part = np.zeros((len(found), CHUNK), np.float32)
        part[at, c[use]] = 1
        if right is None:
            for k in range(0, len(found), STRIP):  # what is above the diagonal is below it, too
                both = part[k : k + STRIP] @ part[k:].T
                overlap[np.ix_(found[k : k + STRIP], found[k:])] += both
                overlap[np.ix_(found[k + STRIP :], found[k : k + STRIP])] += both[:, STRIP:].T
        else:
            first = int(np.searchsorted(found, split))
            for k in range(0, first, STRIP):
                overlap[np.ix_(found[k : min(k + STRIP, first)], found[first:] - split)] += part[k : min(k + STRIP, first)] @ part[first:].T
        bound()
    for s in strips:
        alive[s] &= (100 + percent) * overlap[s].astype(np.float64) >= needed_rows[s, None] + needed_cols[None, :]
    return alive


def spanning(linked: np.ndarray, left: np.ndarray, right: np.ndarray | None) -> list[tuple[int, int]]:
    """Edges (node, node) that join what the pairs join, one for each node at most."""
    out: list[tuple[int, int]] = []
    if right is not None:
        n = len(left)
        whole = np.zeros((n + len(right),) * 2, bool)
        whole[:n, n:] = linked
        linked = whole | whole.T
        left = np.concatenate([left, right])
    unseen = linked.any(axis=1)
    while unseen.any():
        seed = int(unseen.argmax())
        reached = np.zeros(len(left), bool)
        reached[seed] = True
        front = reached
        while front.any():
            front = linked[front].any(axis=0) & ~reached
            reached = reached | front
        out += [(int(left[i]), int(left[seed])) for i in np.flatnonzero(reached) if i != seed]
        unseen &= ~reached
    return out


EDGES = "u long, v long"


def pivot_links(members: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, block, text, links): which of the block's PIVOTS pivots, some of
    its own members, a member links with. Work is linear in the block."""
    first = members.withColumn("nth", F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64("node"), "node"))).filter(F.col("nth") <= PIVOTS)
    pivots = materialize(first.groupBy("block").agg(F.collect_list(F.struct("node", "text")).alias("pivots")), "jaccard-pivots").df
    ddl = "node long, block long, text string, links array<long>"
    schema = arrow_schema(ddl)

    def run(batches):
        hashes, of = Recent(word_hash, 100_000), Recent(lambda t: shingle_set(t, size, hashes), 64, 1 << 20)
        for batch in slices(batches):
            links = []
            for node, text, pivots in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s, own = shingle_set(text, size, hashes), []
                for p in pivots:
                    t = of[p["text"]]
                    if (100 + percent) * len(np.intersect1d(s, t, assume_unique=True)) >= percent * (len(s) + len(t)):
                        own.append(p["node"])
                links.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(links, pa.list_(pa.int64()))], schema=schema)

    return members.join(pivots, "block").select("node", "block", "text", "pivots").mapInArrow(run, ddl)


def split_blocks(members: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(node, block, n, text) and (node, shingle): blocks as ``prefix_blocks`` makes
    them of the members of some blocks under orders that count all of their
    shingles. Members without a shared shingle in their prefixes link with none."""
    signed = signatures(members.select(F.col("node").alias("doc_id"), "text"), size, percent, True).withColumnRenamed("doc_id", "row")
    signed = materialize(signed, "jaccard-split-sets").df
    entries = materialize(shared_prefixes(signed, members.select("node"), percent, True), "jaccard-split-prefixes").df
    parted = members.select("node", "n", "text").join(prefix_blocks(entries).hint("merge"), "node").select("node", "block", "n", "text")
    return materialize(parted, "jaccard-split").df, entries


def block_links(members: DataFrame, entries: DataFrame, size: int, percent: int, block_rows: int, block_chars: int) -> DataFrame:
    """Edges (u, v) that join all linked members of each block (node, block, n, text).

    A block of up to ``block_rows`` rows and ``block_chars`` characters is
    multiplied in one step. A larger one whose members share many prefix shingles
    is split first, by prefixes that are made of all shingles of its members
    (``split_blocks``). In one that is still larger, members that link with one pivot
    are joined already, so no pair of them is looked at again; the others, the
    open ones, must meet the members that they can link with. Where they share few
    prefix shingles (``entries``: node, shingle), as in blocks that only chains of
    chance hold together, these pairs are listed, bounded and checked one by one;
    where listing them takes over a quarter of all pairs, as in a group of near
    copies, the open members meet all, in steps of two parts of about that size.
    """
    parts = lambda rows, chars: F.ceil(F.greatest(rows / block_rows, chars / block_chars)).cast("int")

    def by_size(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        sizes = rows.groupBy("block").agg(parts(F.count(F.lit(1)), F.sum(F.length("text"))).alias("size"))
        sized = rows.join(materialize(sizes, "jaccard-sizes").df, "block")
        one_step = sized.filter(F.col("size") <= 1).select("node", "block", "text", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))
        return one_step, sized.filter(F.col("size") > 1).select("node", "block", "n", "text")

    whole, large = by_size(members)
    sharing = entries.join(large.select("node", "block"), "node").groupBy("block", "shingle").agg(F.count(F.lit(1)).cast("double").alias("all"))
    sharing = sharing.groupBy("block").agg(F.sum(F.col("all") * F.col("all")).alias("listed"))
    rows = large.groupBy("block").agg(F.count(F.lit(1)).cast("double").alias("rows"))
    dense = materialize(sharing.join(rows, "block").filter("4 * listed > rows * rows").select("block"), "jaccard-dense")
    if dense.rows:
        dealt, all_counted = split_blocks(large.join(dense.df, "block", "left_semi"), size, percent)
        one_step, still_large = by_size(dealt)
        rest = large.join(dense.df, "block", "left_anti")
        entries = entries.join(rest.select("node"), "node", "left_semi").union(all_counted)
        whole, large = whole.unionByName(one_step), rest.unionByName(still_large)
    met = materialize(pivot_links(large, size, percent).join(large.select("node", "n").hint("merge"), "node"), "jaccard-large").df
    edges = met.select(F.col("node").alias("u"), F.explode("links").alias("v"))
    best = edges.join(met.select("node", "block"), F.col("u") == F.col("node")).groupBy("block", "v").agg(F.count(F.lit(1)).alias("n"))
    best = best.groupBy("block").agg(F.max_by("v", F.struct("n", "v")).alias("pivot"))
    parted = met.join(best, "block").withColumn("open", ~F.array_contains("links", F.col("pivot")))
    chars, done = F.length("text"), ~F.col("open")
    parted = materialize(parted, "jaccard-open").df
    by_shingle = entries.join(parted.select("node", "block", "open"), "node").groupBy("block", "shingle").agg(F.count_if("open").alias("opens"), F.count(F.lit(1)).alias("all"))
    listed = by_shingle.groupBy("block").agg(F.sum(F.col("opens").cast("double") * F.col("all")).alias("listed"))
    counts = parted.groupBy("block").agg(
        (F.count_if("open").cast("double") * F.count(F.lit(1))).alias("every"),
        parts(F.count_if("open"), F.coalesce(F.sum(F.when(F.col("open"), chars)), F.lit(0))).alias("opens"),
        parts(F.count_if(done), F.coalesce(F.sum(F.when(done, chars)), F.lit(0))).alias("dones"),
    )
    counts = counts.join(listed, "block", "left").withColumn("by_list", F.col("listed") * 4 <= F.col("every")).drop("listed", "every")
    counts = materialize(counts, "jaccard-steps").df
    by_list = parted.join(counts.filter("opens > 0 AND by_list").select("block"), "block", "left_semi")
    pairs = materialize(bound_pairs(entries, by_list, percent), "jaccard-pairs").df
    edges = edges.union(checked_pairs(pairs, by_list, size, percent))
    dealt = parted.join(counts.filter("opens > 0 AND NOT coalesce(by_list, false)").drop("by_list"), "block")
    dealt = dealt.withColumn("b", F.when(F.col("open"), F.pmod(F.hash("node"), F.col("opens"))).otherwise(F.col("opens") + F.pmod(F.hash("node"), F.greatest("dones", F.lit(1)))))
    # Steps (i, j): i among the open parts, j from i on; a row is in each step that names its part.
    others = F.when(F.col("open"), F.sequence(F.lit(0), F.col("opens") + F.col("dones") - 1)).otherwise(F.sequence(F.lit(0), F.col("opens") - 1))
    steps = dealt.withColumn("o", F.explode(others)).select("node", "block", "text", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), (F.col("b") > F.col("o")).cast("int").alias("side"))

    def multiply(key, table):
        node = table.column("node").to_numpy()
        hashes = Recent(word_hash, 100_000)
        sets = [shingle_set(x.as_py(), size, hashes) for x in table.column("text")]
        if key[1].as_py() == key[2].as_py():
            found = spanning(linked_pairs(sets, None, percent), node, None)
        else:
            side = table.column("side").to_numpy()
            parts = [np.flatnonzero(side == k) for k in (0, 1)]
            if not all(map(len, parts)):
                found = []
            else:
                found = spanning(linked_pairs(*([sets[x] for x in p] for p in parts), percent), *(node[p] for p in parts))
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return whole.unionByName(steps).groupBy("block", "i", "j").applyInArrow(multiply, EDGES).union(edges)


def jaccard_components(docs: DataFrame, shingle_words: int = 4, percent: int = 85, block_rows: int = 2048, block_chars: int = 16_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_shingles`` (size of its set) and
    ``component_id`` (the smallest id reachable by links, its own included).

    Documents link when their sets' Jaccard similarity is at least ``percent``
    %. Null and empty texts, and texts without words, have the empty set, link
    with nothing and have their own id. Rows are documents of their own, also
    where ids repeat; a null id is never the smallest, and a component of null
    ids has a null id. Other columns are ignored. Shingles are told apart by
    64-bit, sets by 128-bit hashes.

    Equal sets are one row of the product, whatever their number. Joins with
    tables that grow with the documents are sort-merge joins at every size,
    which Spark splits at hot keys.
    """
    src = pick(docs, doc_id=id_col, text=text_col)
    signed = materialize(signatures(src, shingle_words, percent).withColumn("row", F.monotonically_increasing_id()), "jaccard-sets").df
    classes = signed.filter("n > 0").groupBy("print").agg(F.min("row").alias("node"), F.min("doc_id").alias("doc_id"), F.min_by("doc_id", "row").alias("node_id"), F.min("n").alias("n"))
    classes = materialize(classes, "jaccard-classes").df
    entries = materialize(shared_prefixes(signed, classes, percent), "jaccard-prefixes").df
    blocks = prefix_blocks(entries)
    candidates = materialize(classes.select("node", F.col("node_id").alias("doc_id"), "print", "n").join(blocks.hint("merge"), "node"), "jaccard-candidates").df
    members = materialize(candidate_texts(src, candidates, shingle_words), "jaccard-members").df
    links = materialize(block_links(members, entries, shingle_words, percent, block_rows, block_chars), "jaccard-links").df
    roots = connected_components(links)
    rooted = classes.select("node", "print", "doc_id").join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = materialize(rooted.select("print", "root").join(least.hint("merge"), "root").select("print", "component_id"), "jaccard-named").df
    full = signed.filter("n > 0").select("doc_id", "n", "print").join(named.hint("merge"), "print").select("doc_id", "n", "component_id")
    empty = signed.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.union(empty).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def may_be_in(table: Broadcast, column: str) -> Column:
    """Whether the column's value may be among those whose hashed bits are in a bitmap."""

    @F.arrow_udf("boolean")  # pandas would stay in a reused worker through all later stages
    def test(bits: pa.Array) -> pa.Array:
        return pa.array(has_bit(table.value, bits.to_numpy(zero_copy_only=False).astype(np.int64)))

    return test(hashed_bit(column))


def keep_one_of_each(docs: DataFrame, components: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose id is that of their component:
    one document of each. Rows alike in id and text are one document, of which
    one row stays; rows that repeat an id with other texts all stay, or all
    go, and so do those with a null id.

    Rows whose id heads its component and occurs once stay where they are; a
    bitmap of the other ids tells them. Only what is left is shuffled.
    """
    heads = components.select(F.col(f"`{id_col}`").alias("id"), F.col("component_id").eqNullSafe(F.col(f"`{id_col}`")).alias("head"))
    heads = materialize(heads.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.max("head").alias("head")), "jaccard-heads").df
    table = docs.sparkSession.sparkContext.broadcast(bitmap(heads.filter("rows > 1 OR NOT head OR id IS NULL").select(hashed_bit("id").alias("bit"))))
    unsure = docs.filter(may_be_in(table, id_col))
    left = unsure.join(heads.filter("head").select(F.col("id").alias("__id")).hint("merge"), docs[f"`{id_col}`"].eqNullSafe(F.col("__id")), "left_semi")
    alike = Window.partitionBy(f"`{id_col}`", F.xxhash64(f"`{text_col}`"), F.crc32(F.col(f"`{text_col}`").cast("binary"))).orderBy(F.lit(0))
    return docs.filter(~may_be_in(table, id_col)).unionByName(left.withColumn("__nth", F.row_number().over(alike)).filter("__nth = 1").drop("__nth"))
