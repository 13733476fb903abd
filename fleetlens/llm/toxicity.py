"""Toxicity: nearest labelled examples by exact TF-IDF cosine.

A bounded sample of labelled documents gives the examples and the terms: every
word, and every word beginning, that is in one of them. A term weighs (1 + ln tf)
idf, its document frequency taken over all documents, times how much it tells
about the label in the sample; besides, every text has one term of a fixed
weight, so that texts without telling terms are like each other. The examples
stand in an inverted index. The postings of terms that many examples have are
columns of a matrix; those of all others are lists. For a text, the matrix gives the
frequent terms' part of every cosine, and the lists of its other terms add the rest:
the cosine with every example. The nearest examples vote by distance, and the votes are
calibrated on the examples themselves.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import arrow_schema, crc_mod, per_worker, pick, release_memory, slices
from fleetlens.runtime import materialize

PREFIXES = (4, 5, 6)  # bytes of a word's beginning that are a term, for longer words
BLOCK = 64
FREQUENT = 16  # terms in more than one of so many examples are columns of the matrix
BATCH = 128  # texts scored by the matrix together
STRIP = 16  # texts whose lists are looked up together
GROUND = 60.0  # weight of the term that every text has
PER_CLASS, EXAMPLE_BYTES = 2048, 32768  # the sample: texts of a class, and of no more bytes each
# Lower-case letters and the bytes of characters beyond ASCII stay; all else parts words.
LETTERS = bytes(b if b >= 0x80 or chr(b).islower() else 0x20 for b in range(256))


def letters(text: str | None) -> bytes:
    return text.lower().encode().translate(LETTERS) if text else b""


def words_of(text: str | None) -> list[bytes]:
    return letters(text).split()


def stems_of(word: bytes) -> list[bytes]:
    """A word's terms: itself, and its beginnings marked by a star."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) > n)]


class Words(dict):
    """By word, the number of its last known term: the word itself or, if no example
    has it, its longest beginning that one has; all shorter ones are known then,
    too. Without any, the number of terms. Words asked for lately are taken from
    ``older``."""

    def __init__(self, number: dict[bytes, int], older: dict[bytes, int]):
        self.number, self.older = number, older

    def __missing__(self, word: bytes) -> int:
        n = self.older.get(word)
        if n is None:
            n = self.number.get(word)
            for size in PREFIXES[::-1] if n is None else ():
                if len(word) > size and (n := self.number.get(word[:size] + b"*")) is not None:
                    break
            if n is None:
                n = len(self.number)
        self[word] = n
        return n


class Vocabulary:
    """Counts the known terms of texts; a term's number is its place in ``terms``,
    which hold every beginning of their words."""

    def __init__(self, terms: list[bytes], most_words: int = 100_000):
        self.number = {t: i for i, t in enumerate(terms)}
        self.most_words, self.words = most_words, Words(self.number, {})
        # A last known term stands for itself and the shorter beginnings: places in ``flat``.
        flat, ends = array("i"), array("q")
        for i, t in enumerate(terms):
            letters = len(t) - t.endswith(b"*")
            flat.extend([n for m in PREFIXES if letters > m and (n := self.number.get(t[:m] + b"*")) is not None])
            flat.append(i)
            ends.append(len(flat))
        ends.append(len(flat))
        self.flat, ends = np.array(flat, np.int32), np.array(ends, np.int64)
        self.size = np.diff(ends, prepend=0)
        self.first = ends - self.size

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the text, term number, how often it occurs there), by text and
        then term."""
        if len(self.words) > self.most_words:
            self.words.older = {}
            self.words = Words(self.number, self.words)
        held = pc.ascii_split_whitespace(pa.array([letters(t) for t in texts], pa.binary()).cast(pa.string()))
        size = np.diff(held.offsets.to_numpy())
        found = pc.list_flatten(held).dictionary_encode()  # each word of the texts is looked up once
        words = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        last = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))[found.indices.to_numpy()]
        count = self.size[last]
        terms = self.flat[spans(self.first[last], count)]
        text = np.repeat(np.repeat(np.arange(len(texts)), size), count)
        keys, times = np.unique(text * len(self.number) + terms, return_counts=True)
        text = keys // max(1, len(self.number))
        return text, keys - text * len(self.number), times


def weigh(text: np.ndarray, terms: np.ndarray, times: np.ndarray, texts: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of texts' terms, and by text of the term that every text has, each
    text's scaled to length 1."""
    w = np.log(times)
    w += 1
    w *= weight[terms]
    length = np.sqrt(np.bincount(text, w * w, texts) + GROUND * GROUND)
    w /= length[text]
    return w, GROUND / length


def spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] numbers), and so on for each."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def alike(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int, ids: np.ndarray) -> np.ndarray:
    """An order of the columns of a sparse matrix (those named by ``ids``) that puts
    like ones together: halved along the direction in which they differ most
    (some steps of power iteration) until a block is left."""
    x = np.zeros((height, len(ids)), np.float32)
    x[rows, columns] = values
    out, left = [], [np.argsort(ids, kind="stable")]
    while left:
        of = left.pop()
        if len(of) <= BLOCK:
            out.append(of)
            continue
        part = x[:, of]
        part -= part.mean(axis=1, keepdims=True)
        v = np.cos(np.arange(len(of), dtype=np.float32))
        for _ in range(5):
            v = (part @ v) @ part
            v /= np.linalg.norm(v) or 1.0
        of = of[np.argsort(v, kind="stable")]
        half = -(-len(of) // BLOCK) // 2 * BLOCK
        left += [of[half:], of[:half]]
    return np.concatenate(out) if out else np.empty(0, np.int64)


class BlockMaxIndex:
    """Examples as postings by term: columns of a matrix for the frequent terms; for
    all others lists of the examples that have a term equally often, which weigh the
    same but for the examples' lengths."""

    def __init__(self, examples: tuple[np.ndarray, ...], counts: tuple[np.ndarray, ...], weight: np.ndarray, frequent: int = FREQUENT):
        """examples: (doc_ids, labels, class weights); counts: those of their texts,
        as ``Vocabulary.count`` gives them."""
        ids, label, class_weight = examples
        text, term, times = counts
        common = np.flatnonzero(np.bincount(term, minlength=len(weight)) * frequent > len(ids))
        self.column = np.full(len(weight), -1)
        self.column[common] = np.arange(len(common))
        often = self.column[term] >= 0
        value, ground = weigh(text, term, times, len(ids), weight)
        value, column, of = value[often], self.column[term[often]].astype(np.int32), text[often]
        # The order of the examples decides ties. Those alike lie together, and with
        # them the sums that a text's lists add to.
        order = alike(column, of, value, len(common), ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.label, self.weight = ids[order], label[order].astype(float), class_weight[order]
        self.term_weight = weight
        self.blocks = -(-len(ids) // BLOCK)
        self.size = self.blocks * BLOCK
        self.matrix = np.zeros((len(common) + 1, self.size))
        self.matrix[-1, : len(ids)] = ground[order]
        self.matrix[column, place[of]] = value
        del value, column, of
        term, times, example = term[~often], times[~often], place[text[~often]]
        by = np.lexsort((example, times, term))
        term, times = term[by], times[by]
        self.example = example[by].astype(np.uint16 if self.size < 1 << 16 else np.int64)
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (times[1:] != times[:-1])
        at = np.flatnonzero(new)
        self.start, self.value = np.append(at, len(term)), (1 + np.log(times[at])) * weight[term[at]]
        self.list = np.searchsorted(term[at], np.arange(len(weight) + 1))
        self.shorter = self.matrix[-1] / GROUND  # 1 / length

    def nearest(self, counts: tuple[np.ndarray, ...], texts: int, k: int, without: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of some texts, by their counts: (places, cosines) of the ``k``
        nearest examples, ties to the earlier place; an example with the id of that
        place in ``without`` is left out."""
        text, term, times = counts
        w, ground = weigh(text, term, times, texts, self.term_weight)
        asked = np.zeros((texts, len(self.matrix)))
        column = self.column[term]
        often = column >= 0
        asked[text[often], column[often]] = w[often]
        asked[:, -1] = ground
        score = asked @ self.matrix  # the frequent terms' part of the cosines
        score[:, len(self.ids) :] = -2.0
        if without is not None:
            score[:, : len(self.ids)][self.ids == without[:, None]] = -2.0
        text, term, w = text[~often], term[~often], w[~often]
        ends = np.searchsorted(text, np.arange(texts + 1))
        out = []
        for i, row in enumerate(score):
            if i % STRIP == 0:  # the lists of a few texts at a time
                s = slice(ends[i], ends[min(i + STRIP, texts)])
                lists = self.list[term[s] + 1] - self.list[term[s]]
                at = spans(self.list[term[s]], lists)
                weights, first, count = np.repeat(w[s], lists) * self.value[at], self.start[at], self.start[at + 1] - self.start[at]
                upto = np.searchsorted(np.repeat(text[s], lists), np.arange(i, i + STRIP + 1))
            a, e = upto[i % STRIP], upto[i % STRIP + 1]
            held = self.example[spans(first[a:e], count[a:e])]
            row += np.bincount(held, np.repeat(weights[a:e], count[a:e]), self.size) * self.shorter
            least = np.partition(row, self.size - min(k, self.size))[self.size - min(k, self.size)]
            places = np.flatnonzero((row > 0) & (row >= least - 1e-12))
            best = places[np.lexsort((places, -np.round(row[places], 12)))[:k]]
            out.append((best, row[best]))
        return out

    def vote(self, counts: tuple[np.ndarray, ...], texts: int, k: int, without: np.ndarray | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each text: the toxic share of its nearest examples' votes, each the
        example's class weight over its distance, and the examples; 0 without any."""
        out = []
        for places, cosines in self.nearest(counts, texts, k, without) if self.blocks else [(np.empty(0, np.int64), np.empty(0))] * texts:
            votes = self.weight[places] / (1.01 - np.minimum(cosines, 1.0))
            out.append((float((votes * self.label[places]).sum() / votes.sum()) if len(places) else 0.0, places, cosines))
        return out


def isotonic(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(middles, values) of the steps of the rising function nearest to the
    labels; between middles it is read by linear interpolation, so that votes
    that differ keep their order."""
    order = np.argsort(raw, kind="stable")
    steps: list[list[float]] = []  # sum of weight * label, weight, sum of weight * raw, raw
    for x, y, w in zip(raw[order].tolist(), label[order].tolist(), weight[order].tolist()):
        if steps and steps[-1][3] == x:
            for i, v in enumerate((y * w, w, x * w)):
                steps[-1][i] += v
        else:
            steps.append([y * w, w, x * w, x])
        while len(steps) > 1 and steps[-2][0] * steps[-1][1] >= steps[-1][0] * steps[-2][1]:
            s = steps.pop()
            steps[-1] = [*(u + v for u, v in zip(steps[-1][:3], s)), s[3]]
    return np.array([s[2] / s[1] for s in steps]), np.array([s[0] / s[1] for s in steps])


def calibrated(raw: np.ndarray, curve: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.clip(np.interp(raw, *curve), 0.0, 1.0) if len(curve[0]) else raw


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, per_class: int, example_bytes: int) -> DataFrame:
    """(doc_id, text, label, weight): up to ``per_class`` training documents of
    each class, the first by hash of their ids, texts of more than ``example_bytes``
    bytes left out. ``weight``: labelled documents of the class for each that was
    taken. A document with several label rows is toxic if one says so; null labels
    and ids are no labels."""
    known = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    known = known.filter(F.col("label").isin(0, 1))
    taken = None
    for y in (0, 1):
        of = known.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        taken = of if taken is None else taken.unionByName(of)
    # At most 2 * per_class rows of two numbers: small enough to broadcast.
    texts = docs.filter(F.octet_length("text") <= example_bytes).join(F.broadcast(taken), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    texts = materialize(texts, "toxicity-sample").df
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = F.lit(1.0)
    for y, n in got.items():
        weight = F.when(F.col("label") == y, sizes[y] / n).otherwise(weight)
    return texts.withColumn("weight", weight)


def class_counts(sample: DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Every term of the sample, and how many examples of label 0 and of label 1
    have it. Bounded by the sample."""

    def count(batches):
        n: dict[bytes, list[int]] = {}

        def sums():
            keys = list(n)
            for a in range(0, len(keys), 50_000):
                part = keys[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), *(pa.array([n[t][y] for t in part], pa.int64()) for y in (0, 1))], names=["term", "n0", "n1"])
            n.clear()

        for batch in slices(batches):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for t in set(chain.from_iterable(map(stems_of, words_of(text)))):
                    n.setdefault(t, [0, 0])[y] += 1
                if len(n) > 500_000:  # sent in parts, which are added up later
                    yield from sums()
        yield from sums()

    seen = sample.select("text", "label").mapInArrow(count, "term binary, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow().sort_by("term")
    return seen.column("term").to_pylist(), seen.column("n0").to_numpy().astype(float), seen.column("n1").to_numpy().astype(float)


def telling(a: np.ndarray, b: np.ndarray, n0: float, n1: float) -> np.ndarray:
    """How much terms tell about the label, by the examples of label 0 (``a`` of
    ``n0``) and of label 1 (``b`` of ``n1``) that have them: relevance frequency, log2(2 +
    the ratio of the classes' rates), times the root of the log-likelihood ratio
    by example of label 1; 0.1 at least, so that every term weighs."""
    if not n0 or not n1:
        return np.ones(len(a))

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300)), 0.0)

    held = (a + b) / (n0 + n1)
    ratio = 2 * (part(a, n0 * held) + part(b, n1 * held) + part(n0 - a, n0 * (1 - held)) + part(n1 - b, n1 * (1 - held)))
    return np.log2(2 + (b / n1) / (np.maximum(a, 1) / n0)) * np.sqrt(100 * np.maximum(ratio, 0) / n1) + 0.1


def document_frequencies(docs: DataFrame, terms: list[bytes]) -> tuple[int, np.ndarray]:
    """(rows, rows that hold each term) over all of ``docs``; a task sends a
    number for each term at most."""
    held = docs.sparkSession.sparkContext.broadcast({"value": terms})

    def count(batches):
        vocabulary, n, rows = per_worker(held, "vocabulary", Vocabulary), np.zeros(len(held.value["value"]), np.int64), 0
        for batch in slices(batches, BATCH):
            n += np.bincount(vocabulary.count(batch.column(0).to_pylist())[1], minlength=len(n))
            rows += batch.num_rows
        found = np.flatnonzero(n)
        for a in range(0, len(found), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(found[a : a + 65536]), pa.array(n[found[a : a + 65536]])], names=["term", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([rows], pa.int64())], names=["term", "n"])

    found = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = found.column("term").to_numpy(), found.column("n").to_numpy()
    df = np.zeros(len(terms))
    df[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), df


SCORED = "score double, neighbours array<long>, cosines array<double>, toxic_neighbours int"


def worker_index(held: Broadcast) -> tuple[BlockMaxIndex, Vocabulary]:
    """Made once in each Python worker; what they are made from is then let go."""
    kept = held.value
    if "index" not in kept:
        examples, counts, terms, weight = kept["value"]
        kept["vocabulary"] = Vocabulary(terms)
        kept["index"] = BlockMaxIndex(examples, counts, weight)
        kept["value"] = examples = counts = terms = weight = None
        release_memory()
    return kept["index"], kept["vocabulary"]


def voted(rows: DataFrame, held: Broadcast, k: int, curve: tuple[np.ndarray, np.ndarray] = (np.empty(0), np.empty(0)), leave_out: bool = False) -> DataFrame:
    """The doc_id of ``rows`` (doc_id, text) and the columns of SCORED, the score
    by ``curve``; ``leave_out``: an example with the row's own id does not vote."""
    ddl = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCORED}"
    schema = arrow_schema(ddl)

    def run(batches):
        index, vocabulary = worker_index(held)
        for batch in slices(batches, BATCH):
            without = batch.column("doc_id").to_numpy(zero_copy_only=False) if leave_out else None
            got = index.vote(vocabulary.count(batch.column("text").to_pylist()), batch.num_rows, k, without)
            columns = [
                batch.column("doc_id"),
                pa.array(calibrated(np.array([g[0] for g in got]), curve), pa.float64()),
                pa.array([index.ids[g[1]] for g in got], pa.list_(pa.int64())),
                pa.array([g[2] for g in got], pa.list_(pa.float64())),
                pa.array([int(index.label[g[1]].sum()) for g in got], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.select("doc_id", "text").mapInArrow(run, ddl)


@dataclass(frozen=True)
class ToxicityModel:
    """A fitted index of labelled examples; ``score`` applies it."""

    held: Broadcast
    curve: tuple[np.ndarray, np.ndarray]
    k: int
    threshold: float

    def score_of(self, text: Column) -> Column:
        """The score alone; rows stay in the JVM, only their texts pass through Python."""
        held, k, curve = self.held, self.k, self.curve

        @F.arrow_udf("double")
        def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            index, vocabulary = worker_index(held)
            for texts in batches:
                parts = (texts.slice(a, BATCH).to_pylist() for a in range(0, len(texts), BATCH))  # few texts are Python objects at a time
                raw = [g[0] for part in parts for g in index.vote(vocabulary.count(part), len(part), k)]
                yield pa.array(calibrated(np.array(raw), curve), pa.float64())
            release_memory()

        return vote(text)

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` (doc_id, text) without the text, and with ``score``,
        ``predicted`` and the evidence."""
        return voted(rows, self.held, self.k, self.curve).withColumn("predicted", (F.col("score") >= self.threshold).cast("int"))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, train: Column | None = None, per_class: int = PER_CLASS, example_bytes: int = EXAMPLE_BYTES, k: int = 15, threshold: float = 0.3
) -> ToxicityModel:
    """The model of ``docs`` (doc_id, text) and ``labels`` (doc_id, label).

    ``train``: a condition on the label rows' doc_id saying which may be
    learned from; by default crc32(id) mod 4 <> 2. ``per_class`` and
    ``example_bytes`` bound the labelled sample, and with it the terms and the
    index, which are all of the sample's; document frequencies cover all documents.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, train if train is not None else crc_mod("doc_id", 4) != 2, per_class, example_bytes)
    sample = sample.withColumn("doc_id", F.col("doc_id").cast("long"))
    terms, a, b = class_counts(sample)
    size = {r["label"]: float(r["n"]) for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, df = document_frequencies(docs, terms)
    weight = (np.log((1.0 + rows) / (1.0 + df)) + 1.0) * telling(a, b, size.get(0, 0.0), size.get(1, 0.0))
    held_terms = spark.sparkContext.broadcast({"value": terms})

    def vectors(batches):
        vocabulary = per_worker(held_terms, "vocabulary", Vocabulary)
        for batch in slices(batches):
            text, term, times = vocabulary.count(batch.column(1).to_pylist())
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (term, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *lists], names=["doc_id", "label", "weight", "terms", "times"])

    # Bounded by the sample.
    found = sample.select("doc_id", "text", "label", "weight").mapInArrow(vectors, "doc_id long, label int, weight double, terms array<int>, times array<int>").toArrow().sort_by("doc_id").combine_chunks()
    examples = tuple(found.column(c).to_numpy() for c in ("doc_id", "label", "weight"))
    lists = [pc.list_flatten(found.column(c)).to_numpy() for c in ("terms", "times")]
    counts = (pc.list_parent_indices(found.column("terms")).to_numpy().astype(np.int32), *lists)
    held = spark.sparkContext.broadcast({"value": (examples, counts, terms, weight)})
    score = {r["doc_id"]: r["score"] for r in voted(sample.select("doc_id", "text"), held, k, leave_out=True).select("doc_id", "score").collect()}
    curve = isotonic(np.array([score[i] for i in examples[0].tolist()]), examples[1].astype(float), examples[2])
    return ToxicityModel(held, curve, k, threshold)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> DataFrame:
    """One row per input row: the id, ``score`` (0 to 1, higher: toxic
    likelier), ``predicted`` (1 if the score reaches the threshold) and the
    evidence: ``neighbours`` (ids of the nearest examples), their ``cosines``
    and ``toxic_neighbours`` (how many of them are labelled 1).

    ``options``: those of ``fit_toxicity``. A null text counts as empty; an empty
    text, like any without a term of the sample, is nearest to the examples with
    the least telling terms. Terms that no example has take no part. Without
    labels of both classes the score is the share of 1 among them, 0 without any.
    Repeated rows are each scored; other columns are ignored. Ids must be integers.
    """
    src = pick(docs, doc_id=id_col, text=text_col)
    model = fit_toxicity(src, pick(labels, doc_id=id_col, label=label_col), **options)
    return model.score(src).select(F.col("doc_id").alias(id_col), "score", "predicted", "neighbours", "cosines", "toxic_neighbours")


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic. See
    ``score_toxicity``; each row is judged by its own text."""
    model = fit_toxicity(pick(docs, doc_id=id_col, text=text_col), pick(labels, doc_id=id_col, label=label_col), **options)
    return docs.filter(model.score_of(F.col(f"`{text_col}`")) < model.threshold)
