import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_fixtures import edge_docs, make_docs, no_docs, sf_texts  # noqa: F401
from fleetlens.llm.mixing import LEVELS, WEIGHTS, allocate, mix_counts, mix_documents, with_domain


def fill(children, budget):
    """{child: (capacity, weight)} -> {child: share}: full children leave the rest to the others, again and again."""
    out, open_ = {c: 0.0 for c in children}, {c for c, (cap, w) in children.items() if w > 0 and cap > 0}
    while open_ and budget > 1e-9:
        total = sum(children[c][1] for c in open_)
        full = {c for c in open_ if children[c][0] - out[c] <= budget * children[c][1] / total + 1e-12}
        if not full:
            for c in open_:
                out[c] += budget * children[c][1] / total
            break
        for c in full:
            budget -= children[c][0] - out[c]
            out[c] = children[c][0]
        open_ -= full
    return out


def plain_budgets(leaves, weights, budget, epochs):
    """leaves: {path: tokens}"""

    def capacity(paths, depth):
        if depth == len(weights):
            return sum(leaves[p] for p in paths) * epochs
        return sum(capacity(ps, depth + 1) for k, ps in split(paths, depth).items() if weights[depth].get(k, 1.0) > 0)

    def split(paths, depth):
        out = defaultdict(list)
        for p in paths:
            out[p[depth]].append(p)
        return out

    def down(paths, depth, given):
        if depth == len(weights):
            return {paths[0]: given}
        parts = split(paths, depth)
        shares = fill({k: (capacity(ps, depth + 1), weights[depth].get(k, 1.0)) for k, ps in parts.items()}, given)
        out = {}
        for k, ps in parts.items():
            out |= down(ps, depth + 1, shares[k])
        return out

    return down(list(leaves), 0, budget)


@pytest.mark.parametrize("seed", range(3))
def test_budgets_against_repeated_filling(spark, seed):
    rng = random.Random(seed)
    leaves = {(a, b, c): rng.choice([0, 5, 50, 1000, 30000]) for a in "xyz" for b in "pq" for c in [None, "s", "t", "u"] if rng.random() < 0.8}
    weights = ({"x": 3.0, "y": 1.0, "z": 0.0 if seed == 1 else 2.0}, {"p": 5.0}, {None: 2.0, "u": 0.5})
    key = lambda v: "" if v is None else f"={v}"
    df = spark.createDataFrame([(*map(key, p), t) for p, t in leaves.items()], "k0 string, k1 string, k2 string, tokens long")
    budget = sum(leaves.values()) * rng.choice([0.3, 0.8, 1.7])
    got = {(r["k0"], r["k1"], r["k2"]): r["budget"] for r in allocate(df, ["k0", "k1", "k2"], weights, budget, 2).collect()}
    want = {tuple(map(key, p)): b for p, b in plain_budgets(leaves, weights, budget, 2).items()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) <= 1 for p in want)


def plain_copies(rows, budgets, tokens_of, seed=17):
    """rows: (path, doc_id, text)"""
    by, out = defaultdict(list), Counter()
    for path, i, t in rows:
        if tokens_of(t):
            by[path].append((i, t))
    for path, members in by.items():
        total = sum(tokens_of(t) for _, t in members)
        whole, rest = divmod(budgets[path], total)
        place = lambda m: (hashlib.md5(":".join([str(seed), str(whole), *([str(m[0])] if m[0] is not None else [])]).encode()).hexdigest(), -1 if m[0] is None else m[0], hashlib.md5(m[1].encode()).hexdigest())
        so_far = 0
        groups = defaultdict(list)
        for m in members:
            groups[place(m)].append(m)
        taken = set()
        for p in sorted(groups):
            so_far += sum(tokens_of(t) for _, t in groups[p])
            if so_far > rest:
                break
            taken.add(p)
        for m in members:
            out[m[0], len(m[1])] += whole + (place(m) in taken)
    return +out


def test_documents_against_plain_python(make_docs, edge_docs, sf_texts, no_docs):
    docs = with_domain(make_docs(sf_texts).unionByName(edge_docs), name="domain")
    tokens_of = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = [((r["domain"], r["lang"], r["source"]), r["doc_id"], r["text"]) for r in docs.select("domain", "lang", "source", "doc_id", "text").collect()]
    leaves = defaultdict(int)
    for path, _, t in rows:
        leaves[path] += tokens_of(t)
    budgets = {p: int(b + 1e-6) for p, b in plain_budgets(leaves, WEIGHTS, sum(leaves.values()) * 0.8, 2).items()}
    want = plain_copies(rows, budgets, tokens_of)
    taken = mix_documents(docs, LEVELS, WEIGHTS)
    assert taken.schema == docs.schema
    got = Counter((r["doc_id"], len(r["text"])) for r in taken.select("doc_id", "text").collect())
    assert got == want
    counts = mix_counts(docs, LEVELS, WEIGHTS)
    assert counts.columns == ["doc_id", "n_tokens", "copies"]
    assert counts.agg(F.sum("copies")).first()[0] == sum(want.values())
    assert counts.agg(F.sum(F.col("copies") * F.col("n_tokens"))).first()[0] <= 0.8 * sum(leaves.values()) + 1
    everything = mix_counts(docs, LEVELS, WEIGHTS, budget_share=5.0, max_epochs=3)
    assert {r["copies"] for r in everything.collect()} == {3}
    assert mix_documents(with_domain(no_docs, name="domain"), LEVELS, WEIGHTS).collect() == []
