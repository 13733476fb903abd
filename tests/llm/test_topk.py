import math
import random

import numpy as np
import pytest

from fleetlens.llm.topk import SlicedBlock, add_slices, quantise, rows_of, to_slices, top_k


def plain(rows, asked, k):
    ok = lambda v: v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and ok(v)]
    out = set()
    for i, v in rows:
        if i is None or not ok(v) or i not in asked:
            continue
        q = [math.floor(64 * x) for x in v]
        scores = sorted(((-sum(a * b for a, b in zip(q, w)), j) for j, w in ints if j != i and len(w) == len(q)))[:k]
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)}
    return out


def test_slices_add_up():
    rng = np.random.default_rng(1)
    for _ in range(30):
        v = rng.integers(-50, 60, (rng.integers(1, 200), rng.integers(1, 6)))
        low, bits, maps = to_slices(v)
        at, levels = 0, {}
        for b in bits.tolist():
            for j in range(b):
                levels.setdefault(j, []).append(maps[at : at + 1])
                at += 1
        total = np.zeros(maps.shape[1] * 64 if len(maps) else 0, np.int64)
        for level, s in add_slices(levels).items():
            total[rows_of(s)] += 1 << level
        assert (total[: len(v)] + low.sum() == v.sum(axis=1)).all() or not len(maps)


@pytest.mark.parametrize("spread", [0, 1, 3, 100, 5000])
def test_block_against_sort(spread):
    rng = np.random.default_rng(spread)
    v = rng.integers(-spread, spread + 1, (300, 8))
    ids = rng.permutation(300).astype(np.int64)
    low, bits, maps = to_slices(v)
    block = SlicedBlock(300, ids.tobytes(), low.tobytes(), bits.tobytes(), maps.tobytes())
    for r in range(0, 300, 7):
        for k in (1, 20, 400):
            scores = v @ v[r]
            want = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != ids[r])[:k]
            got = block.top(int(ids[r]), v[r], k)
            assert sorted(zip((-got[1]).tolist(), got[0].tolist())) == want


def test_quantise_rounds_down():
    assert quantise(np.array([0.999 / 64, -0.001, -1 / 64, 1.0])).tolist() == [0, -1, -1, 64]


def test_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.3, 0.1, 0.25, 0.5]) for _ in range(4)]) for i in range(130)]
    rows += [(i, [1.0, 2.0]) for i in range(130, 140)] + [(140, None), (141, []), (160, [1.0, None]), (161, [float("nan"), 1.0]), (180, [float("inf"), 1.0]), (None, [1.0, 2.0])]
    rows += [(200, [0.5, -7.0, 2.0]), (7, rows[7][1]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows], "vec_id long, embedding array<float>, label int, part int, dims double").repartition(4)
    asked = df.filter("vec_id % 20 = 0")
    got = top_k(df, asked, k=5, block_rows=50, query_rows=3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    wanted = plain([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], set(range(0, 300, 20)), 5)
    assert {tuple(r) for r in got.collect()} == wanted
    none = df.filter("false")
    assert top_k(none, none).collect() == [] and top_k(df, none).collect() == []


def test_repeated_query_with_malformed_rows(spark):
    good = [(i, [float(i), 1.0]) for i in range(1, 6)]
    bad = [(1, []), (2, [None, 1.0]), (3, [float("-inf"), 1.0]), (4, None), (5, [float("nan"), 1.0])]
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = {tuple(r) for r in top_k(frame(good), frame(good), k=3).collect()}
    assert {r[0] for r in want} == {1, 2, 3, 4, 5}
    assert {tuple(r) for r in top_k(frame(good + bad), frame(good + bad), k=3).collect()} == want


def test_a_very_long_vector(spark):
    import numpy as np

    from fleetlens.llm.topk import top_k

    rng = np.random.default_rng(4)
    long = rng.normal(size=(6, 20_000)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(long)] + [(100, [0.5, -0.5]), (101, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(map(tuple, top_k(df, df.filter("vec_id in (0, 100)"), k=3).collect()))
    q = np.floor(64 * long.astype(np.float64)).astype(np.int64)
    scores = sorted(((-int(q[0] @ q[i]), i) for i in range(1, 6)))[:3]
    assert got == [(0, r, i, -s) for r, (s, i) in enumerate(scores, 1)] + [(100, 1, 101, 0)]
