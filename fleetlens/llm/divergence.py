"""Source divergence audit: how far the sources of a language differ in words.

Documents become exact sparse count vectors over their language's vocabulary
(the terms in enough of its documents, of any number: the rule of a count
vectoriser with a least document frequency and no limit on the vocabulary). The
vectors are summed by group, and groups are compared over sparse sums: where a
term is in neither or in one of two groups, its part of the value depends only
on the counts' distinct values, and shared terms correct that.

The vocabulary stays a table. Spark's own ``CountVectorizer`` gathers it on the
driver and sends it to every task, which has no bound here.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import arrow_schema, pick, slices
from fleetlens.runtime import materialize

# Bytes of UTF-8 that belong to terms: A-Z, a-z and all of other characters than
# ASCII. Only A-Z are folded; every other byte parts terms.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
MIN_DF, TOP_TERMS = 10, 10
HELD = 400_000  # (group, term) pairs that a task sums before it writes them
CHUNK_ROWS, STEP = 200_000, 1 << 18  # rows of a piece of the vocabulary; entries compared at once
SUM_SCHEMA = "lang string, source string, term string, n long, df long"


def vector_of(text: str | None) -> Counter:
    """A document's sparse vector, term -> count."""
    return Counter(text.encode("utf-8", "surrogatepass").translate(LETTERS).split()) if text else Counter()


def group_sums(documents: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(``lang``, ``source``, ``term``, ``n`` occurrences, ``df`` documents):
    the vectors' sums, summed in parts by each task, then over all."""
    schema = arrow_schema(SUM_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, df) in held.items():
                terms = list(n)
                for a in range(0, len(terms), 65536):
                    part = terms[a : a + 65536]
                    columns = [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part]), pa.array([df[t] for t in part])]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
            held.clear()

        size = 0
        for batch in slices(batches, 256):
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                if vector := vector_of(text):
                    n, df = held.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    n.update(vector)
                    df.update(vector.keys())
                    size += len(n)
            if size > HELD:
                yield from flush()
                size = 0
        yield from flush()

    named = F.coalesce(F.col("lang"), F.lit("")).alias("lang"), F.coalesce(F.col("source"), F.lit("")).alias("source")
    parts = pick(documents, lang=lang_col, source=source_col, text=text_col).select(*named, "text").mapInArrow(run, SUM_SCHEMA)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact: the division is
    carried on in two steps, so that no product leaves 64 bits."""
    a, b = f"({count} + 2)", f"({total} + 2 * {kept})"
    return F.expr(f"1 + (100000 * {a} div {b}) * 10000 + (10000 * (100000 * {a} % {b})) div {b}")


def gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def np_gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def shared_part(table: pa.Table) -> pa.Table:
    """The corrections of one piece of a language's vocabulary: for each two
    groups, over the terms that both hold, f(p, q) - f(p, q0) - f(p0, q) +
    f(p0, q0), where p0 and q0 are the groups' values of a term not held."""
    term = table["term"].combine_chunks().dictionary_encode()
    order = np.argsort(term.indices.to_numpy(), kind="stable")
    place = term.indices.to_numpy()[order]
    sources = table["source"].combine_chunks().dictionary_encode()
    source = sources.indices.to_numpy()[order].astype(np.int64)
    p, p0 = (table[c].to_numpy()[order] for c in ("p", "p0"))
    starts = np.searchsorted(place, np.arange(len(term.dictionary) + 1))
    many = len(sources.dictionary)
    own = np.zeros(many, np.int64)
    own[source] = p0
    out = []
    by_source = np.argsort(source, kind="stable")
    ends = np.searchsorted(source[by_source], np.arange(many + 1))
    for a in range(many):
        total = np.zeros(many, np.int64)
        mine = by_source[ends[a] : ends[a + 1]]
        holders = starts[place[mine] + 1] - starts[place[mine]]
        step = np.cumsum(holders) // STEP  # a step has STEP entries of this group's terms, and at most one term more
        for at in range(int(step[-1]) + 1 if len(step) else 0):
            rows = mine[step == at]
            first, count = starts[place[rows]], starts[place[rows] + 1] - starts[place[rows]]
            others = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            left = np.repeat(p[rows], count)
            value = np_gap(left, p[others]) - np_gap(left, p0[others]) - np_gap(own[a], p[others]) + np_gap(own[a], p0[others])
            np.add.at(total, source[others], value)
        met = np.flatnonzero((total != 0) & (np.arange(many) != a))
        out += [(a, int(b), int(total[b])) for b in met]
    names = sources.dictionary
    a, b, v = zip(*out) if out else ((), (), ())
    lang = table["lang"][0].as_py()
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": names.take(pa.array(a, pa.int32())), "item": names.take(pa.array(b, pa.int32())), "value": pa.array(v, pa.int64())})


def source_divergence(documents: DataFrame, min_df: int = MIN_DF, top_terms: int = TOP_TERMS, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``).

    A language keeps the V terms in at least ``min_df`` of its documents. A group
    (a language's source), and the language as a whole, give each kept term p = 1 +
    floor(10^9 (count + 2) / (N + 2 V)), N their count of all kept terms. Part
    ``pair`` ranks each group's other sources by the sum over all kept terms of
    floor((p - q)^2 / (p + q)); part ``term`` the group's terms that it gives more
    than its language does, the first ``top_terms``. Ranks go by falling value,
    then by the item's bytes.

    Null text, languages and sources are empty ones. A group without a term still
    is one; a language without kept terms has pairs of value 0 and no terms. A
    language's only source has no pairs. Repeated rows count each; an empty table
    gives no rows; other columns are ignored. Counts may reach 9 * 10^13.

    Groups' sums and the vocabulary are tables. A language's vocabulary is dealt
    into pieces by term, in number by its rows; a piece's groups are compared in one
    step, and only its sums by pair leave it.
    """
    sums = group_sums(documents, lang_col, source_col, text_col)
    by_term = Window.partitionBy("lang", "term")
    kept = materialize(
        sums.withColumn("lang_df", F.sum("df").over(by_term)).withColumn("lang_n", F.sum("n").over(by_term)).filter(F.col("lang_df") >= min_df).select("lang", "source", "term", "n", "lang_n"),
        "divergence-sums",
    ).df
    languages = kept.groupBy("lang").agg(F.countDistinct("term").alias("v"), F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("rows"))
    held = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"))
    named = F.coalesce(F.col(f"`{lang_col}`"), F.lit("")).alias("lang"), F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("source")
    groups = documents.select(*named).distinct().join(languages, "lang", "left").join(held, ["lang", "source"], "left").na.fill(0, ["v", "lang_total", "rows", "total", "size"])
    # A language without kept terms has N + 2 V = 0; its values aren't used.
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, share("0", "total", "v")).otherwise(F.lit(1)))
    groups = materialize(groups, "divergence-groups").df
    terms = kept.join(groups, ["lang", "source"])

    gained = terms.select("lang", "source", "term", share("n", "total", "v").alias("p"), share("lang_n", "lang_total", "v").alias("q")).filter("p > q")
    rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = gained.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap("p", "q").alias("value"))
    top = top.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top_terms)

    # f over all kept terms = those of a alone by distinct value, against b's value of a
    # term not held, and the other way round, + the rest + corrections for shared terms.
    values = materialize(terms.groupBy("lang", "source", "p0", share("n", "total", "v").alias("p")).agg(F.count(F.lit(1)).alias("n")), "divergence-values").df
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    alone = values.join(others, "lang").filter("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.expr("n * (((p - q0) * (p - q0)) div (p + q0))")).alias("value"))
    alone = materialize(alone, "divergence-alone").df
    pairs = groups.join(others.join(groups.select("lang", F.col("source").alias("item"), F.col("size").alias("other_size")), ["lang", "item"]), "lang").filter("source <> item")
    rest = pairs.select("lang", "source", "item", F.expr("(v - size - other_size) * (((p0 - q0) * (p0 - q0)) div (p0 + q0))").alias("value"))
    piece = F.pmod(F.xxhash64("term"), F.ceil(F.col("rows") / CHUNK_ROWS)).alias("piece")
    both = terms.select("lang", "source", "term", "p0", share("n", "total", "v").alias("p"), piece).groupBy("lang", "piece").applyInArrow(shared_part, "lang string, source string, item string, value long")
    swapped = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    value = rest.unionByName(alone).unionByName(swapped).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pair = value.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(rank))
    return pair.unionByName(top)
