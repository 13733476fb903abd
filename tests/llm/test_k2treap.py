"""Ranked search against plain scoring, and the treap against its grid."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import CLASHING, EDGE_TEXTS, edge_docs, make_docs, no_docs, rows_for  # noqa: F401

from fleetlens.llm import k2treap
from fleetlens.llm.k2treap import Treap, ranked_search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=20):
    docs = [(i, Counter(t := plain_terms(x)), len(t)) for i, x in docs if plain_terms(x)]
    count, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    least = {}
    for i, text in items:
        if i is not None and text is not None:
            least[i] = min(text, least.get(i, text))
    out = []
    for i, text in least.items():
        scores = []
        for doc, c, n in docs:
            m = 75 + (25 * n * count) // total
            s = sum(k_ * math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, k_ in Counter(plain_terms(text)).items() if c[t])
            if s > 0 and doc is not None:
                scores.append((-s, doc))
        out += [(i, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def test_terms():
    for text in ("Ünï A-b 9_x\x00é\x7fZ 漢字 İ ÀB @[`{", "", None, "\u0085a b"):
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_treap_finds_the_best_columns(data):
    n_rows, n_cols = data.draw(st.integers(1, 40)), data.draw(st.integers(1, 70))
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    grid = np.where(rng.random((n_rows, n_cols)) < data.draw(st.sampled_from([0.05, 0.3, 0.9])), rng.integers(1, data.draw(st.sampled_from([2, 50]))+1, (n_rows, n_cols)), 0)
    grid[0, 0] = 1
    rows, cols = np.nonzero(grid)
    treap = Treap(rows, cols, grid[rows, cols])
    asked = rng.choice(n_rows, min(n_rows, 7), replace=False)
    weights, k = rng.integers(1, 9, len(asked)), data.draw(st.integers(1, 25))
    want = weights @ grid[asked]
    found, scores = treap.best(asked, weights, k, 1, step=data.draw(st.sampled_from([1, 3, 256])))
    assert (want[found] == scores).all() and len(set(found.tolist())) == len(found)
    least = max(1, np.sort(want)[::-1][: k][-1])
    assert set(found[scores >= least].tolist()) == set(np.flatnonzero(want >= least).tolist())


def test_quarter_cells_hold_maxima():
    treap = Treap(np.array([0, 5, 5]), np.array([0, 2, 7]), np.array([4, 9, 3]))
    assert treap.height == 3 and treap.most[0] == 9 and treap.mask[0] == 0b1101 and treap.most[1:4].tolist() == [4, 9, 3]


def test_edge_documents(spark, edge_docs, no_docs):
    items = [(1, "two ONE hunter2hunter2 漢字"), (2, None), (3, ""), (4, "!!"), (5, "alpha alpha x beta"), (None, "one"), (6, "nothing here is"), (6, "one"), (7, "zzz")]
    asked = spark.createDataFrame([(i, t, 5, "x") for i, t in items], "item_id long, text string, doc_id int, term string").repartition(2)
    assert got(ranked_search(edge_docs, asked)) == plain(EDGE_TEXTS, items)
    assert got(ranked_search(edge_docs, asked, k=1)) == plain(EDGE_TEXTS, items, 1)
    assert got(ranked_search(no_docs, asked)) == [] and got(ranked_search(edge_docs, asked.limit(0))) == []


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_many_blocks_and_ties(spark, monkeypatch, limit):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(60)], k=rng.randint(0, 40)))) for i in range(400)]
    docs += [(1000 + i, "w1 w2 w3 w50") for i in range(80)] + [(2000, "w7 " * 3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(25)] + [(99, "w1 w2 w3 w50")]
    df = spark.createDataFrame(rows_for(docs), "doc_id long, text string, " + CLASHING).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(k2treap, "BLOCK_POSTINGS", 700)
    monkeypatch.setattr(k2treap, "CHUNK_ITEMS", 1)  # several pieces of items
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert got(ranked_search(df, asked)) == plain(docs, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_blocks_of_equal_ids_are_told_apart(spark):
    """Two blocks, in one task, of documents that have the same id."""
    docs, items = [(5, "one two"), (5, "two three")], [(1, "one"), (2, "three"), (3, "two")]
    df = spark.createDataFrame(docs[:1], "doc_id long, text string").coalesce(1).union(spark.createDataFrame(docs[1:], "doc_id long, text string").coalesce(1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert got(ranked_search(df, spark.createDataFrame(items, "item_id long, text string"))) == plain(docs, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_treap_is_made_in_little_memory():
    """Beside what it keeps, under 40 bytes a posting at a time."""
    rng = np.random.default_rng(3)
    code = np.unique(rng.integers(0, 1 << 28, 1 << 18))
    rows, cols, impacts = (code >> 12).astype(np.int32), (code & 4095).astype(np.uint16), rng.integers(1, 1000, len(code)).astype(np.int32)
    tracemalloc.start()
    try:
        treap = Treap(rows, cols, impacts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak - sum(x.nbytes for x in (treap.mask, treap.most, treap.first)) < 40 * len(code)


def test_only_terms_that_may_be_asked_for_are_counted(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(200)) + " one") for i in range(20)], "doc_id long, text string").repartition(2)
    asked = k2treap.item_terms(spark.createDataFrame([(1, "one w3x7 none")], "item_id long, text string"), "item_id", "text")
    counted = k2treap.document_frequencies(k2treap.build_blocks(docs), asked).collect()
    assert len(counted) < 10 and sum(r["df"] for r in counted if r["term"] == b"one") == 20 and [r["df"] for r in counted if r["term"] == b"w3x7"] == [1]
