"""Quality rules: in-document base rules and cross-document line frequency.

Lines are normalised and hashed; the distinct documents of each host that hold
a line are counted; lines above the limit are removed, and a document that
loses most of its words that way is rejected as depleted.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import map_rows, pick
from fleetlens.runtime import materialize

SYMBOLS = "#*$%&|<>"
DIGITS_TO_ZERO = str.maketrans("123456789", "000000000")
WINDOW = 8

BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word run found twice or more."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    runs = n - window + 1
    keys = np.zeros(runs, np.uint64)
    for j in range(window):  # a polynomial over the window; it wraps at 64 bits
        keys = keys * np.uint64(0xD6E8FEB86659FD93) + mixed[j : j + runs]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    first, second = order[:-1][same], order[1:][same]
    span = np.arange(window)
    if (ids[first[:, None] + span] == ids[second[:, None] + span]).all():
        starts = np.union1d(first, second)
    else:  # two different runs have one key: compare the runs themselves
        _, inverse, counts = np.unique(np.lib.stride_tricks.sliding_window_view(ids, window), axis=0, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[inverse.ravel()] > 1)
    covered = np.zeros(n + 1, np.int64)
    covered[starts] += 1
    covered[starts + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def normalise_line(line: str) -> str:
    """Lower case, digits as 0, runs of white space as one blank."""
    return " ".join(line.lower().translate(DIGITS_TO_ZERO).split())


def line_key(line: str) -> int:
    """Signed 64-bit hash of the normalised line."""
    h = xxhash.xxh3_64_intdigest(normalise_line(line).encode())
    return h - (1 << 64) if h >> 63 else h


def measure(text: str | None) -> tuple[int, int, int, int, int, dict[int, int]]:
    """The base counts of a text (null: no words), and the words on its lines
    by line hash."""
    if not text:
        return 0, 0, 0, 0, 0, {}
    raw = text.encode()
    words = raw.split()  # bytes.split() parts at 0x20 and 0x09-0x0D only
    lines = [x for x in raw.split(b"\n") if x.strip()]
    by_line: dict[int, int] = {}
    for x in lines:
        k = line_key(x.decode())
        by_line[k] = by_line.get(k, 0) + len(x.split())
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), by_line


def quality_verdicts(
    docs: DataFrame,
    max_docs_per_host: int = 10,
    min_kept_percent: int = 30,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """One row per input row: the id, the base counts, ``base_failed``,
    ``n_removed_words`` (words on lines that more than ``max_docs_per_host``
    distinct documents of the host hold), ``removed_lines`` (their hashes) and
    ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` % of them in repeated 8-word runs. ``kept``: not
    ``base_failed``, and at least ``min_kept_percent`` % of the words left.

    A null text has no words. Rows with one doc_id count as one document, rows
    with a null doc_id too; a null host is a host of its own. Other columns
    are ignored. Line counts cover all rows; a line that sits in a third of
    them is counted by partial sums and joined by a join that Spark may split.
    """

    def make():
        def f(c):
            got = [measure(t) for t in c["text"]]
            out = {"doc_id": c["doc_id"], "host": c["host"]} | {n: [g[i] for g in got] for i, n in enumerate(BASE_COLUMNS)}
            return out | {"lines": [list(g[5]) for g in got], "line_words": [list(g[5].values()) for g in got]}

        return f

    src = pick(docs, doc_id=id_col, text=text_col, host=host_col)
    kind = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    schema = f"doc_id {kind['doc_id']}, host {kind['host']}, " + ", ".join(f"{n} long" for n in BASE_COLUMNS) + ", lines array<long>, line_words array<long>"
    # Written once: the numbers of the rows stay the same from here on.
    measured = materialize(map_rows(src, make, schema).withColumn("row", F.monotonically_increasing_id()), "line-counts").df
    lines = measured.select("row", "doc_id", "host", F.inline(F.arrays_zip(F.col("lines").alias("line"), F.col("line_words").alias("words"))))
    holders = lines.select("host", "line", "doc_id").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    frequent = materialize(holders.filter(F.col("n_docs") > max_docs_per_host).select("host", "line"), "frequent-lines").df
    hit = lines.alias("a").join(frequent.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.line") == F.col("b.line")))
    lost = hit.groupBy("a.row").agg(F.sum("a.words").alias("n_removed_words"), F.sort_array(F.collect_list("a.line")).alias("removed_lines"))
    left = 100 * (F.col("n_words") - F.col("n_removed_words"))
    return (
        measured.drop("lines", "line_words", "host")
        .join(lost, "row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
        .withColumn("removed_lines", F.coalesce("removed_lines", F.array().cast("array<bigint>")))
        .withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (left >= min_kept_percent * F.col("n_words")))
        .select(F.col("doc_id").alias(id_col), *BASE_COLUMNS, "base_failed", "n_removed_words", "removed_lines", "kept")
    )


def remove_frequent_lines(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept documents, all columns, with the frequent lines taken out of
    their texts. Rows with a null id, or an id that repeats with different
    verdicts, keep a row each that any verdict keeps, without the lines that
    any verdict removes."""
    held = verdicts.filter("kept").groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.array_distinct(F.flatten(F.collect_set("removed_lines"))).alias("__removed"))

    @F.udf("string", useArrow=True)
    def cleaned(text, removed):
        if text is None or not len(removed):
            return text
        gone = set(removed)
        return "\n".join(x for x in text.split("\n") if not x.strip() or line_key(x) not in gone)

    joined = docs.join(held, docs[f"`{id_col}`"].eqNullSafe(F.col("__id")))
    return joined.withColumn(text_col, cleaned(F.col(f"`{text_col}`"), F.col("__removed"))).select(*[F.col(f"`{c}`") for c in docs.columns])
