import random
import re
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import edge_docs, make_docs, no_docs  # noqa: F401
from fleetlens.llm import jaccard
from fleetlens.llm.components import connected_components
from fleetlens.llm.jaccard import jaccard_components, keep_one_of_each, linked_pairs, spanning

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def plain(rows, percent=85, words=4):
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    known = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return sorted(str((d, len(s), known[find(i)])) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near_copies(seed, groups=6, size=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage, rows = [word() for _ in range(60)], []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([3, 4, 30, 120]))] + (passage if g % 2 else [])
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w) if rng.random() < 0.5 else " ".join(w).upper())
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize("block_rows, block_chars", [(2048, 10**7), (7, 10**7), (2048, 1500)])
def test_components_against_all_pairs(make_docs, edge_docs, block_rows, block_chars):
    rows = near_copies(block_rows) + [(0, "one more text under an id that is taken"), (1, "one more text under an id that is taken")]
    docs = make_docs([(i + 100, t) for i, t in rows]).unionByName(edge_docs)
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = jaccard_components(docs, block_rows=block_rows, block_chars=block_chars)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    kept = keep_one_of_each(docs, got)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    heads = {r["component_id"] for r in got.collect()}
    assert {i for i in ids if i is not None} == {h for h in heads if h is not None} and ids.count(8) == 1


def test_other_parameters(make_docs):
    rows = near_copies(5)
    sets = [(i, " ".join(t.split())) for i, t in rows]
    got = sorted(str((r["doc_id"], r["component_id"])) for r in jaccard_components(make_docs(sets), shingle_words=2, percent=60).collect())
    assert got == sorted(str((eval(x)[0], eval(x)[2])) for x in plain(sets, 60, 2))


def test_any_order_gives_the_same(make_docs, monkeypatch):
    rows = near_copies(3, groups=3)
    monkeypatch.setattr(jaccard, "first_hashes", lambda percent: 1 << 58)
    assert sorted(str(tuple(r)) for r in jaccard_components(make_docs(rows)).collect()) == plain(rows)


def test_products(monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 16)
    rng = np.random.default_rng(1)
    for _ in range(40):
        base = rng.integers(0, 300, 40).astype(np.uint64)
        sets = [np.unique(np.where(rng.random(40) < 0.05, rng.integers(0, 300, 40), base).astype(np.uint64))[: rng.integers(1, 41)] for _ in range(14)]
        want = np.array([[i != j and 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
        assert (linked_pairs(sets, None, 85) == want).all()
        assert (linked_pairs(sets[:5], sets[5:], 85) == want[:5, 5:]).all()
        ids = np.arange(14)
        assert all(want[i].any() for e in spanning(want, ids, None) for i in e)


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(400, 400), (None, 3), (5, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u is not None and v is not None:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in got.collect()} == {(x, find(x)) for x in root}


def test_empty_table(no_docs):
    assert jaccard_components(no_docs).collect() == []


def test_blocks_of_chance_compare_only_pairs_that_can_link(make_docs, monkeypatch):
    """Texts over 16 words: chains of shared shingles make one block, yet few pairs share many."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(16)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(120))) for i in range(700)]
    for i in range(0, 40, 2):  # and some near copies, chains of three
        w = rows[i][1].split()
        w[rng.randrange(120)] = "new"
        rows += [(1000 + i, " ".join(w)), (1001 + i, " ".join([*w[:60], "other", *w[61:]]))]
    listed = []
    real = jaccard.checked_pairs
    monkeypatch.setattr(jaccard, "checked_pairs", lambda pairs, *rest: listed.append({(r["u"], r["v"]) for r in pairs.collect()}) or real(pairs, *rest))
    product = jaccard.bound_pairs
    entries = []
    monkeypatch.setattr(jaccard, "bound_pairs", lambda e, *rest: entries.append([tuple(r) for r in e.collect()]) or product(e, *rest))
    got = jaccard_components(make_docs(rows), block_rows=150)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows)
    holders = defaultdict(set)
    for node, shingle in entries[0]:
        holders[shingle].add(node)
    sharing = {(min(u, v), max(u, v)) for nodes in holders.values() for u in nodes for v in nodes if u != v}
    compared = {(min(u, v), max(u, v)) for u, v in listed[0]}
    assert compared and compared <= sharing and len(compared) < len(sharing) / 20


def test_a_common_passage_does_not_tie_short_texts(make_docs, monkeypatch):
    """Short texts of own words beside a passage that all hold: only near copies share a block, also
    those on either side of the size where the order changes."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage, rows = [word() for _ in range(13)], []
    for i in range(300):
        rows.append((i, " ".join(passage + [word() for _ in range(rng.choice([16, 25, 80]))])))
    for i in range(0, 20, 2):
        rows.append((1000 + i, rows[i][1] + " " + word()))
    for i in range(6):  # of 92 to 99 shingles, each a near copy of the next
        rows.append((2000 + i, " ".join(f"x{j}" for j in range(95 + i + i % 2))))
    blocks = []
    real = jaccard.candidate_texts
    monkeypatch.setattr(jaccard, "candidate_texts", lambda docs, candidates, size: blocks.extend(r["count"] for r in candidates.groupBy("block").count().collect()) or real(docs, candidates, size))
    got = jaccard_components(make_docs(rows))
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows)
    assert len(blocks) >= 11 and max(blocks) <= 12


def test_a_product_keeps_few_bytes_a_pair():
    import tracemalloc

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(60) < 0.9, base, rng.integers(0, 1 << 62, 60).astype(np.uint64))) for _ in range(1024)]
    tracemalloc.start()
    linked = linked_pairs(sets, None, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert linked.any() and (linked == linked.T).all() and peak < 32 * 1024 * 1024  # bytes, of 1024 by 1024 pairs


def test_free_memory_goes_back_after_a_task():
    import ctypes
    import re
    from pathlib import Path

    from fleetlens.llm.common import slices

    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("the C library cannot")
    used = lambda: int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024
    held = [np.ones(3000) for _ in range(8000)]
    some, before = held[::100], used()
    del held
    assert list(slices(iter([]))) == [] and len(some) == 80 and before - used() > 100  # MB


def test_workers_need_no_pandas():
    # A reused worker would keep it through all later stages.
    code = "import sys, fleetlens.llm.jaccard, fleetlens.llm.toxicity, fleetlens.llm.secret_scan; assert 'pandas' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parents[2])


def test_slices_give_back_what_the_last_task_left(monkeypatch):
    from fleetlens.llm import common

    done = []
    monkeypatch.setattr(common, "release_memory", lambda: done.append(1))
    batch = pa.RecordBatch.from_pydict({"x": list(range(5))})
    rows = []
    for part in common.slices(iter([batch]), 2):
        assert done == [1]
        rows.append(part.num_rows)
    assert rows == [2, 2, 1] and done == [1, 1]
