"""Language-model scoring: prediction by partial matching over byte contexts.

A trie of byte contexts up to five bytes long is counted over all training
texts. A byte is coded in the longest context in the trie; if that context has
not seen it, an escape is coded and the next shorter context takes over, with
the symbols of the longer one excluded. A document's score is the sum of the
logarithms of these probabilities (its code length, negated).

The trie is dealt by the three bytes nearest to the symbol, contexts that too
many pieces ask for by a byte or two more, and is never in one place. Pieces of
the texts ask it for the logarithms of the distinct (context, symbol) pairs that
they hold; a piece's sorted pairs travel as byte planes of their differences.

Beside it stands a unigram word score with additive smoothing, whose counts are
asked for in the same way.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Recent, arrow_schema, crc_mod, per_worker, slices
from fleetlens.runtime import materialize

ORDER = 5
END = 0xFF  # never a byte of UTF-8: the end of a text, and the contexts before its start
MIN_SHARE = 0.0  # of the training bytes, that a context must hold to stay; 0 keeps all
PIECE = 32 << 20  # bytes of text that ask the trie together
PART_BYTES = 2 << 20  # bytes of text for each part of the trie and of the words
LEAST_PARTS, MOST_PARTS = 64, 1 << 20
NEAR = 2  # contexts up to so long are broadcast: at most 65,536 of a length
HOT = 4 << 20  # asked (context, symbol) pairs from which a context is dealt by a byte more


# The byte model


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts laid out as ORDER end marks, the bytes, one end mark; the places of the
    symbols to code; and where each text begins among these."""
    pad = bytes([END]) * ORDER
    stream = np.frombuffer(b"".join(pad + t + pad[:1] for t in texts), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.cumsum(lengths) - lengths
    coded = np.ones(len(stream), bool)
    for i in range(ORDER):
        coded[begin + ORDER * np.arange(len(texts)) + i] = False
    return stream, np.flatnonzero(coded), begin


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The context of ORDER bytes and symbol, as one number, of each symbol to
    code, and where each text begins among these."""
    stream, places, begin = joined(texts)
    wide = stream.astype(np.uint64)
    grams = wide.copy()
    for i in range(1, ORDER + 1):
        grams[i:] |= wide[:-i] << np.uint64(8 * i)
    grams = grams[places]
    return grams, begin


def count_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(context of ORDER bytes and symbol as one number, how often) over texts."""
    return np.unique(grams_of(texts)[0], return_counts=True)


class ByteModel:
    """The trie and, for each of its contexts, the logarithms (base 10) of all
    256 symbol probabilities.

    ``levels[n]`` has (context and symbol as one number, count) of the contexts
    of n bytes in the trie; the nearest byte is the lowest. A context's suffixes
    must be in it too, as they are where a level keeps all contexts from one count on.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        counts: list[np.ndarray] = []  # by level: a row of 256 counts for each context
        keys: list[np.ndarray] = []
        for n, (grams, seen) in enumerate(levels):
            grams = np.asarray(grams, np.uint64)
            found, row = np.unique(grams >> np.uint64(8), return_inverse=True)
            if not n and not len(found):
                found = np.zeros(1, np.uint64)
            table = np.zeros((len(found), 256))
            table[row, grams & np.uint64(255)] = seen
            counts.append(table)
            keys.append(found)
        first = np.cumsum([0, *map(len, keys)])
        self.child = np.full(first[-1] * 256, -1, np.int32)  # of each context, by the byte before it
        for n in range(1, len(levels)):
            above = np.searchsorted(keys[n - 1], keys[n] & np.uint64(256 ** (n - 1) - 1)) + first[n - 1]
            self.child[above * 256 + (keys[n] >> np.uint64(8 * (n - 1))).astype(np.int64)] = first[n] + np.arange(len(keys[n]))
        self.logs = np.empty((first[-1], 256), np.float32)
        for n, found in enumerate(keys):
            for a in range(0, len(found), 1024):
                self.logs[first[n] + a : first[n] + a + len(found[a : a + 1024])] = np.log10(self.mix(n, found[a : a + 1024], lambda m, x: counts[m][np.searchsorted(keys[m], x)]))
        self.logs = self.logs.ravel()

    @staticmethod
    def mix(n: int, found: np.ndarray, counts: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
        """Probabilities of all 256 symbols in some contexts of n bytes, with
        ``counts(m, contexts of m bytes)`` as rows of 256 numbers: escape
        estimate d / (t + d) for d symbols seen t times, symbols of longer
        contexts excluded, and last the symbols never seen, alike."""
        p = np.zeros((len(found), 256))
        escape = np.ones((len(found), 1))
        excluded = np.zeros((len(found), 256), bool)
        for m in range(n, -1, -1):
            c = np.where(excluded, 0.0, counts(m, found & np.uint64(256**m - 1)))
            kinds = (c > 0).sum(axis=1, keepdims=True)
            excluded |= c > 0
            kinds[excluded.all(axis=1)] = 0  # nothing is left to escape to
            total = c.sum(axis=1, keepdims=True)
            p += escape * c / np.maximum(total + kinds, 1)
            escape = np.where(total > 0, escape * kinds / np.maximum(total + kinds, 1), escape)
        rest = ~excluded
        return p + escape * rest / np.maximum(rest.sum(axis=1, keepdims=True), 1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 of the probability of each text and its end."""
        if not texts:
            return np.empty(0)
        stream, places, begin = joined(texts)
        node = np.zeros(len(places), np.int64)
        deeper = np.ones(len(places), bool)
        for i in range(1, ORDER + 1):  # down the trie, a byte further back each time
            below = self.child[node << 8 | stream[places - i]]
            deeper &= below >= 0
            node = np.where(deeper, below, node)
        return np.add.reduceat(self.logs[node << 8 | stream[places]].astype(np.float64), begin)


def in_batches(texts: list[bytes], most: int = 1 << 21):
    """Runs of texts of about ``most`` bytes; a longer text goes alone."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


class Level:
    """Contexts of one length and the counts of their symbols, as sparse rows;
    contexts seen less than ``least`` times are left out."""

    def __init__(self, grams: np.ndarray, seen: np.ndarray, least: float = 0.0):
        grams, inverse = np.unique(grams[seen > 0], return_inverse=True)
        seen = np.bincount(inverse, seen[seen > 0], len(grams))
        context = grams >> np.uint64(8)
        self.contexts, first, size = np.unique(context, return_index=True, return_counts=True)
        keep = (np.add.reduceat(seen, first) if len(first) else np.empty(0)) >= least
        self.contexts, self.first, self.size = self.contexts[keep], first[keep], size[keep]
        self.symbols, self.seen = (grams & np.uint64(255)).astype(np.int64), seen

    def rows(self, asked: np.ndarray) -> np.ndarray:
        """A row of 256 counts for each context asked for; zeros where it is not in."""
        found, inverse = np.unique(asked, return_inverse=True)
        out = np.zeros((len(found), 256))
        if len(self.contexts):
            at = np.minimum(np.searchsorted(self.contexts, found), len(self.contexts) - 1)
            has = np.flatnonzero(self.contexts[at] == found)
            first, size = self.first[at[has]], self.size[at[has]]
            place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
            out[np.repeat(has, size), self.symbols[place]] = self.seen[place]
        return out[inverse]


def gram_logs(grams: np.ndarray, seen: np.ndarray, near: list[Level], least: float) -> np.ndarray:
    """log10 of the probability of the symbol of each of ``grams`` (distinct)
    after its context. ``grams`` must have all that were seen of each context
    of NEAR + 1 bytes in it; ``near`` has the levels below that."""
    mask = lambda n: np.uint64((256 << 8 * n) - 1)
    levels = [*near, *(Level(grams & mask(n), seen, least) for n in range(len(near), ORDER + 1))]
    nearest_first = grams >> np.uint64(8) & mask(NEAR)
    order = np.lexsort((grams, nearest_first))
    context = grams[order] >> np.uint64(8)
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.empty(0, np.int64)
    ends, out = np.append(first, len(context)), np.empty(len(grams))
    for a in range(0, len(first), 1024):  # of dense rows, few at a time
        e = min(a + 1024, len(first))
        p = ByteModel.mix(ORDER, context[first[a:e]], lambda m, x: levels[m].rows(x))
        part = order[ends[a] : ends[e]]
        out[part] = np.log10(p[np.repeat(np.arange(e - a), np.diff(ends[a : e + 1])), (grams[part] & np.uint64(255)).astype(np.int64)])
    return out


def flipped(grams: np.ndarray) -> np.ndarray:
    """Grams with the bytes of the context in turned order: those with the
    same nearest bytes are neighbours when these are sorted. Its own inverse."""
    out = grams & np.uint64(255)
    for i in range(1, ORDER + 1):
        out |= (grams >> np.uint64(8 * i) & np.uint64(255)) << np.uint64(8 * (ORDER + 1 - i))
    return out


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of numbers, all first bytes, then all second ones
    and so on: small numbers leave planes of zeros, which compress to nothing."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel().astype(np.uint64)


def to_differences(sorted_keys: np.ndarray, width: int) -> bytes:
    return planes(np.diff(sorted_keys, prepend=np.uint64(0)), width)


def from_differences(data: bytes, width: int) -> np.ndarray:
    return np.cumsum(from_planes(data, width), dtype=np.uint64)


GRAM, WORD, SEEN = 6, 8, 5  # bytes of a gram, a word hash, a count


def near_bytes(keys: np.ndarray, n: int) -> np.ndarray:
    """The nearest ``n`` bytes of the contexts of flipped grams."""
    return keys >> np.uint64(8 * (ORDER + 1 - n))


def dealt(keys: np.ndarray, near: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """(part, places of its keys) of sorted ``keys``, by a hash of ``near``."""
    part = (near * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    found, first = np.unique(part[order], return_index=True)
    return list(zip(found.tolist(), np.split(order, first[1:])))


def near_grams(asked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The grams of contexts of NEAR bytes and how often they were seen; at
    most 65,536 contexts."""

    def run(batches):
        for batch in batches:
            for keys, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = flipped(from_differences(keys, GRAM)) & np.uint64((256 << 8 * NEAR) - 1)
                grams, sums = add_up(grams, from_planes(seen, SEEN))
                yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int64)), pa.array(sums.astype(np.int64))], names=["gram", "n"])

    got = asked.select("keys", "seen").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 0").toArrow()
    return got.column("gram").to_numpy().astype(np.uint64), got.column("n").to_numpy()


def hot_contexts(asked: DataFrame, pieces: int) -> list[np.ndarray]:
    """For lengths NEAR + 1 and NEAR + 2: the sorted contexts (flipped) that HOT
    or more pairs are asked for; fewer than all pairs / (HOT / 2). A piece names a
    context from a share of HOT / 2 on, so at most half of the pairs are not seen."""
    least = max(1, HOT // (2 * max(1, pieces)))

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                keys = from_differences(data, GRAM)
                for n in (NEAR + 1, NEAR + 2):
                    found, count = np.unique(near_bytes(keys, n), return_counts=True)
                    keep = count >= least
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(keep.sum(), n)), pa.array(found[keep].astype(np.int64)), pa.array(count[keep])], names=["length", "context", "n"])

    many = asked.select("keys").mapInArrow(run, "length long, context long, n long").groupBy("length", "context").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT // 2).collect()
    return [np.sort(np.array([r["context"] for r in many if r["length"] == n], np.uint64)) for n in (NEAR + 1, NEAR + 2)]


def hot_counts(asked: DataFrame, hot: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each list of hot contexts: their grams and how often they were seen."""

    def run(batches):
        for batch in batches:
            for data, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, count = from_differences(data, GRAM), from_planes(seen, SEEN)
                for n, contexts in enumerate(hot, NEAR + 1):
                    has = np.isin(near_bytes(keys, n), contexts)
                    grams, sums = add_up(flipped(keys[has]) & np.uint64((256 << 8 * n) - 1), count[has])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), n)), pa.array(grams.astype(np.int64)), pa.array(sums.astype(np.int64))], names=["length", "gram", "n"])

    got = asked.select("keys", "seen").mapInArrow(run, "length long, gram long, n long").groupBy("length", "gram").agg(F.sum("n").alias("n")).toArrow()
    length, grams, n = (got.column(c).to_numpy() for c in ("length", "gram", "n"))
    return [(grams[length == m].astype(np.uint64), n[length == m]) for m in (NEAR + 1, NEAR + 2)]


ASKED = "piece long, part long, depth int, keys binary, seen binary"
ANSWERS = "piece long, kind string, keys binary, answers binary"


def trie_logs(asked: DataFrame, pieces: int, parts: int, min_share: float) -> DataFrame:
    """(piece, kind, keys, answers) of ``asked`` (piece, part of the trie, keys,
    seen): log10 of the probability of each gram that a piece asks for. A part
    has all grams, of all pieces, of its contexts of NEAR + 1 bytes (``depth``); a
    hot context's grams are dealt by a byte more, and then their counts up to that
    length are broadcast."""
    asked = asked.withColumn("depth", F.lit(NEAR + 1))
    near = near_grams(asked)
    least = min_share * float(near[1].sum())
    hot = hot_contexts(asked, pieces)
    counts = []
    if len(hot[0]):
        counts = hot_counts(asked, hot)
        schema = arrow_schema(ASKED)

        def split(batches):
            for batch in batches:
                for piece, part, _, data, seen in zip(*(c.to_pylist() for c in batch.columns)):
                    keys, n = from_differences(data, GRAM), from_planes(seen, SEEN)
                    depth = np.full(len(keys), NEAR + 1)
                    for length, contexts in enumerate(hot, NEAR + 1):
                        depth += (depth == length) & np.isin(near_bytes(keys, length), contexts)
                    rows = []
                    for d in np.unique(depth).tolist():
                        places = np.flatnonzero(depth == d)
                        groups = [(part, places)] if d == NEAR + 1 else [(q, places[x]) for q, x in dealt(keys[places], near_bytes(keys[places], d), parts)]
                        rows += [(piece, q, d, to_differences(keys[x], GRAM), planes(n[x], SEEN)) for q, x in groups]
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

        asked = asked.select("piece", "part", "depth", "keys", "seen").mapInArrow(split, ASKED)
    held = asked.sparkSession.sparkContext.broadcast({"value": (near, counts)})

    def levels(value):
        (grams, seen), more = value
        out = [Level(grams & np.uint64((256 << 8 * n) - 1), seen, least if n else 0.0) for n in range(NEAR + 1)]
        return out + [Level(g, c, least) for g, c in more]

    def solve(table):
        known = per_worker(held, "levels", levels)
        depth = table.column("depth")[0].as_py()
        data = table.column("keys").to_pylist()
        each = [flipped(from_differences(x, GRAM)) for x in data]
        asked_for, n = np.concatenate(each), np.concatenate([from_planes(x, SEEN) for x in table.column("seen").to_pylist()])
        grams, inverse = np.unique(asked_for, return_inverse=True)
        logs = gram_logs(grams, np.bincount(inverse, n, len(grams)), known[:depth], least).astype(np.float32)[inverse]
        size = np.array([len(x) for x in each])
        return pa.table({"piece": table.column("piece"), "kind": ["gram"] * len(data), "keys": data, "answers": binary_array(logs, np.cumsum(size) - size)}, schema=arrow)

    arrow = arrow_schema(ANSWERS)
    return asked.groupBy("part", "depth").applyInArrow(solve, ANSWERS)


def word_counts(asked: DataFrame) -> DataFrame:
    """(piece, kind, keys, answers, kinds, total) of ``asked`` words: how often each
    was seen in training; on one row of a part, how many of its words were, and how
    often they all were."""
    ddl = ANSWERS + ", kinds long, total long"
    arrow = arrow_schema(ddl)

    def solve(table):
        data = table.column("keys").to_pylist()
        each = [from_differences(x, WORD) for x in data]
        words, inverse = np.unique(np.concatenate(each), return_inverse=True)
        total = np.zeros(len(words), np.int64)
        np.add.at(total, inverse, np.concatenate([from_planes(x, SEEN) for x in table.column("seen").to_pylist()]).astype(np.int64))
        size = np.cumsum([len(x) for x in each])
        answers = [planes(x, WORD) for x in np.split(total[inverse], size[:-1])]
        return pa.table({"piece": table.column("piece"), "kind": ["word"] * len(data), "keys": data, "answers": answers, "kinds": [int((total > 0).sum())] + [0] * (len(data) - 1), "total": [int(total.sum())] + [0] * (len(data) - 1)}, schema=arrow)

    return asked.groupBy("part").applyInArrow(solve, ddl)


# The word model


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def words_of(texts: list[bytes], hashes: Recent) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of lower-cased texts, and how many each text has."""
    held = [t.split() for t in texts]  # bytes.split() parts at 0x20 and 0x09-0x0D only
    size = np.array([len(w) for w in held], np.int64)
    return np.fromiter(map(hashes.__getitem__, itertools.chain.from_iterable(held)), np.uint64, int(size.sum())), size


def binary_array(data: np.ndarray, first: np.ndarray) -> pa.Array:
    """One binary value for each run of ``data`` rows that begins at ``first``."""
    offsets = np.concatenate([first, [len(data)]]) * data.dtype.itemsize * (data.shape[1] if data.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def add_up(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    found, inverse = np.unique(keys, return_inverse=True)
    return found, *(np.bincount(inverse, v, len(found)) for v in values)


class Asked:
    """The distinct keys of a piece, and how often its training texts have them."""

    def __init__(self) -> None:
        self.keys, self.seen = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, learnt: np.ndarray, others: np.ndarray) -> None:
        learnt, times = np.unique(learnt, return_counts=True)
        others = np.unique(others)
        self.keys, seen = add_up(np.concatenate([self.keys, learnt, others]), np.concatenate([self.seen, times, np.zeros(len(others), np.int64)]))
        self.seen = seen.astype(np.int64)


class Places:
    """Places of distinct 64-bit keys, by an open hash table of arrays: looking up
    many keys takes one or two rounds for most of them."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self.slot(keys)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            again = self.table[slot] != left
            left, slot = left[again], (slot[again] + 1) & (len(self.table) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, asked: np.ndarray) -> np.ndarray:
        """The place of each of ``asked``, all of which must be there."""
        slot = self.slot(asked)
        out = self.table[slot]
        left = np.flatnonzero(self.keys[out] != asked)
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.table) - 1)
            found = self.table[slot]
            out[left] = found
            again = self.keys[found] != asked[left]
            left, slot = left[again], slot[again]
        return out


GATHERED = "kind string, piece long, part long, keys binary, seen binary, train boolean, doc_id {0}"


def gather(docs: DataFrame, parts: int) -> DataFrame:
    """What the corpus gives, in one pass over (doc_id, text, train): ``text``
    rows (piece, keys: the lower-cased text, train, doc_id), and for each piece
    ``gram`` and ``word`` rows (piece, part, keys, seen) with its distinct grams and
    words and how often they are in its training texts."""
    ddl = GATHERED.format(docs.schema["doc_id"].dataType.simpleString())
    schema = arrow_schema(ddl)

    def rows(kind, size, **columns):
        columns = {"kind": pa.array([kind] * size, pa.string())} | columns
        return pa.RecordBatch.from_arrays([x if isinstance(x := columns.get(f.name), pa.Array) else pa.nulls(size, f.type) if x is None else pa.array(x, f.type) for f in schema], schema=schema)

    def run(batches):
        from pyspark import TaskContext

        hashes = Recent(word_hash, 200_000)
        piece, filled = TaskContext.get().partitionId() << 32, 0
        grams, words = Asked(), Asked()

        def asked():
            for kind, held, width in (("gram", grams, GRAM), ("word", words, WORD)):
                keys = flipped(held.keys) if kind == "gram" else held.keys
                order = np.argsort(keys)
                keys, seen = keys[order], held.seen[order]
                near = near_bytes(keys, NEAR + 1) if kind == "gram" else keys
                groups = dealt(keys, near, parts)
                for a in range(0, len(groups), 256):
                    some = groups[a : a + 256]
                    yield rows(
                        kind, len(some), piece=[piece] * len(some), part=[q for q, _ in some], keys=[to_differences(keys[x], width) for _, x in some], seen=[planes(seen[x], SEEN) for _, x in some]
                    )

        for batch in slices(batches, 8192):
            texts = [(t or "").encode().lower() for t in batch.column(1).to_pylist()]  # bytes.lower() changes A-Z only
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            at = 0
            for run_ in in_batches(texts):
                e = at + len(run_)
                yield rows("text", len(run_), piece=[piece] * len(run_), keys=pa.array(run_, pa.binary()), train=pa.array(train[at:e]), doc_id=batch.column(0).slice(at, len(run_)))
                learnt, others = ([t for t, x in zip(run_, train[at:e]) if x == y] for y in (True, False))
                grams.add(grams_of(learnt)[0], grams_of(others)[0])
                words.add(words_of(learnt, hashes)[0], words_of(others, hashes)[0])
                filled += sum(map(len, run_))
                at = e
                if filled >= PIECE:
                    yield from asked()
                    piece, filled, grams, words = piece + 1, 0, Asked(), Asked()
        yield from asked()

    return docs.mapInArrow(run, ddl)


def score_documents(docs: DataFrame, train_if=None, id_col: str = "doc_id", text_col: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """One row per input row: the id, ``held_out``, ``n_tokens`` (words and one
    end), ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score``
    (smoothed unigram, log10), ``score`` (log10 probability of the lower-cased
    text and its end under the byte model) and ``n_bytes``.

    ``train_if``: a condition on the id column; by default crc32(id) mod 5 <>
    1. Rows where it is null, as for a null id, train. A null text counts as
    empty. Repeated rows are scored, and counted, each. Other columns are
    ignored. Words are told apart by 64-bit hashes.

    Counts cover all training rows. Neither model leaves the cluster: the
    distinct grams and words of the texts' pieces meet by part, a part being one
    step, and the answers go back to the piece. The number of parts grows with the
    text. ``min_share``: contexts with a smaller share of the training bytes are
    left out; by default every context is kept.
    """
    train = F.coalesce(train_if if train_if is not None else crc_mod(id_col, 5) != 1, F.lit(True))
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), train.alias("train"))
    size = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count(F.when(F.col("train"), 1)).alias("ends")).first()
    parts, ends = min(max(LEAST_PARTS, size["bytes"] // PART_BYTES), MOST_PARTS), size["ends"]
    gathered = materialize(gather(src, parts), "ppm-corpus", partition_by=("kind",), compression="zstd").df

    def asked(kind: str) -> DataFrame:
        return gathered.filter(F.col("kind") == kind).select("piece", "part", "keys", "seen")

    words = materialize(word_counts(asked("word")), "ppm-words", {"kinds": F.sum("kinds"), "total": F.sum("total")}, compression="zstd")
    train_tokens, kinds = int(words.metrics["total"] or 0) + ends, int(words.metrics["kinds"] or 0) + (ends > 0)
    answers = trie_logs(asked("gram"), asked("gram").select("piece").distinct().count(), parts, min_share).union(words.df.drop("kinds", "total"))
    texts = gathered.filter("kind = 'text'").select("piece", "keys", "train", "doc_id")
    ddl = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, train boolean, n_words long, n_known long, logs double, n_bytes long, score double"
    schema = arrow_schema(ddl)

    def score(left, right):
        hashes = Recent(word_hash, 200_000)
        kind = np.array(right.column("kind").to_pylist())
        keys, found = (right.column(c).to_pylist() for c in ("keys", "answers"))
        grams, logs, counted, counts = [np.empty(0, np.uint64)], [np.empty(0, np.float32)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for k, x, y in zip(kind, keys, found):
            if k == "gram":
                grams.append(flipped(from_differences(x, GRAM)))
                logs.append(np.frombuffer(y, np.float32))
            else:
                counted.append(from_differences(x, WORD))
                counts.append(from_planes(y, WORD))
        del keys, found
        logs, counts = np.concatenate(logs), np.concatenate(counts)
        gram_at, word_at = Places(np.concatenate(grams)), Places(np.concatenate(counted))
        held = left.column("keys").to_pylist()
        sums, base, known, sizes = [np.empty(0)], [np.empty(0)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for run_ in in_batches(held):
            asked_for, begin = grams_of(run_)
            sums.append(np.add.reduceat(logs[gram_at.of(asked_for)].astype(np.float64), begin))
            asked_for, n = words_of(run_, hashes)
            c = counts[word_at.of(asked_for)].astype(np.float64)
            of = np.repeat(np.arange(len(run_)), n)
            base.append(np.bincount(of, np.log10(c + 0.5), len(run_)))
            known.append(np.bincount(of, c > 0, len(run_)).astype(np.int64))
            sizes.append(n)
        columns = [left.column("doc_id"), left.column("train"), *map(np.concatenate, (sizes, known, base)), [len(t) for t in held], np.concatenate(sums)]
        return pa.table([x if isinstance(x, pa.ChunkedArray) else pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    scored = texts.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(score, ddl)
    each = F.log10(F.lit(float(train_tokens)) + 0.5 * (kinds + 1.0))
    n_tokens = F.col("n_words") + 1
    return scored.select(
        F.col("doc_id").alias(id_col),
        (~F.col("train")).alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.log10(F.lit(ends + 0.5)) - n_tokens * each).alias("base_score"),
        "score",
        "n_bytes",
    )
