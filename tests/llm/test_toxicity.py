import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import make_docs, no_docs  # noqa: F401
from fleetlens.llm.toxicity import GROUND, BlockMaxIndex, Vocabulary, calibrated, isotonic, reject_toxic, score_toxicity, stems_of, telling, words_of


def test_words():
    assert words_of("Tra'sh, É_x1y\nZ") == [b"tra", b"sh", "é".encode(), b"x", b"y", b"z"] and words_of(None) == []
    v = Vocabulary([b"trash", b"tras*", b"none"])
    for _ in range(2):
        assert [x.tolist() for x in v.count(["Trash! trashy", None, "tras", "NONE trash"])] == [[0, 0, 3, 3, 3], [0, 1, 0, 1, 2], [1, 2, 1, 1, 1]]
        v.most_words = 0  # the words are looked up anew
    assert [len(x) for x in v.count([])] == [0, 0, 0] == [len(x) for x in Vocabulary([]).count(["a b"])]


def plain_cosines(examples, weight, text):
    """By definition: dictionaries, all examples."""

    def vector(terms, times):
        v = {int(t): (1 + math.log(n)) * weight[t] for t, n in zip(terms, times)} | {-1: GROUND}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    q = vector(*text)
    return [sum(x * q.get(t, 0.0) for t, x in vector(*e[3:]).items()) for e in examples]


@pytest.mark.parametrize("frequent", [1, 8, 10**9])  # no term, some, all as columns of the matrix
def test_nearest_is_exact(frequent):
    rng = random.Random(1)
    weight = np.array([100 * (1 + rng.random()) for _ in range(60)])

    def text():
        t = sorted(rng.sample(range(60), rng.randrange(0, 9)) if rng.random() < 0.8 else range(3))
        return np.array(t, np.int64), np.array([rng.randrange(1, 4) for _ in t], np.int64)

    def counts(texts):
        return tuple(np.concatenate(x) for x in zip(*((np.full(len(t), i), t, n) for i, (t, n) in enumerate(texts))))

    examples = [(i, rng.randrange(2), 1.0 + i % 2, *text()) for i in range(500)]
    columns = tuple(np.array(x) for x in zip(*((e[:3]) for e in examples)))
    index = BlockMaxIndex(columns, counts([e[3:] for e in examples]), weight, frequent)
    assert (len(index.matrix) - 1 in (0, 60)) == (frequent != 8)
    asked = [e[3:] for e in examples[::9]] + [text() for _ in range(300)]
    for (places, got), q in zip(index.nearest(counts(asked), len(asked), 15), asked):
        want = plain_cosines(examples, weight, q)
        assert np.allclose(got, sorted(want, reverse=True)[:15]) and len(set(places.tolist())) == 15
        assert all(np.isclose(want[int(index.ids[p])], c) for p, c in zip(places, got))
    left = index.nearest(counts(asked[:50]), 50, 500, np.array([examples[i * 9][0] for i in range(50)]))
    assert all(i * 9 not in index.ids[p] and len(p) == 499 for i, (p, _) in enumerate(left))
    none = np.empty(0, np.int64)
    assert BlockMaxIndex((none, none, none), (none, none, none), weight).vote(counts(asked[:2]), 2, 15)[1][0] == 0.0


def test_isotonic():
    middles, values = isotonic(np.array([0.1, 0.2, 0.2, 0.9, 1.0]), np.array([0.0, 1.0, 0.0, 0.0, 1.0]), np.ones(5))
    assert (np.diff(values) > 0).all() and (np.diff(middles) > 0).all() and values.tolist() == pytest.approx([0, 1 / 3, 1]) and middles.tolist() == pytest.approx([0.1, 1.3 / 3, 1])
    assert np.allclose(calibrated(np.array([0.0, 0.1, 1.0, 2.0]), (middles, values)), [0, 0, 1, 1])
    assert (np.diff(calibrated(np.linspace(0.1, 1, 50), (middles, values))) > 0).all()


def fixture_rows():
    rng = random.Random(2)
    plain = ["ba" + "".join(rng.choice("lmnrst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["Vileword!", "nastyxyz,", f"stemmo{rng.choice(plain)}"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_edges(spark, make_docs, no_docs):
    from llm_fixtures import EDGE_TEXTS

    rows, labels = fixture_rows()
    edge = [(None if i is None else i + 1000, t) for i, t in EDGE_TEXTS]
    docs = make_docs(rows + edge + [(1100, "so vileword")])
    marks = spark.createDataFrame([(i, 1, y, "x") for i, y in labels] + [(None, 1, 1, "x"), (7, 1, None, "x"), (9999, 0, 1, "x")], "doc_id long, quality int, toxic int, text string")
    got = score_toxicity(docs, marks)
    assert got.columns == ["doc_id", "score", "predicted", "neighbours", "cosines", "toxic_neighbours"]
    found = got.collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    truth = dict(labels)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in found if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.97 * len(held)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1100]["predicted"] == 1 and by_id[1100]["toxic_neighbours"] == len(by_id[1100]["neighbours"])
    assert by_id[1002]["predicted"] == by_id[1003]["predicted"] == 0 and by_id[1002]["score"] == by_id[1003]["score"]
    # held-out labels change nothing
    flipped = marks.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic")
    assert {(r["doc_id"], r["score"]) for r in score_toxicity(docs, flipped).select("doc_id", "score").collect()} == {(r["doc_id"], r["score"]) for r in found}
    left = reject_toxic(docs, marks)
    assert left.schema == docs.schema and sorted(map(str, (r["doc_id"] for r in left.collect()))) == sorted(str(r["doc_id"]) for r in found if not r["predicted"])
    assert score_toxicity(no_docs, marks).collect() == []
    assert {r["score"] for r in score_toxicity(docs, marks.filter("false")).collect()} == {0.0}


def test_the_whole_query_by_definition(spark):
    """Terms, document frequencies, weights, neighbours, votes and calibration of real texts, in plain Python."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None}
    learnt = sorted(i for i in truth if zlib.crc32(str(i).encode()) % 4 != 2 and len((texts[i] or "").encode()) <= 32768)
    n1 = sum(truth[i] for i in learnt)
    n0 = len(learnt) - n1
    counts = {i: Counter(s for w in words_of(t) for s in stems_of(w)) for i, t in texts.items()}
    df = Counter(t for c in counts.values() for t in c)
    by_class = [Counter(t for i in learnt if truth[i] == y for t in counts[i]) for y in (0, 1)]
    weight = {}
    for t in by_class[0].keys() | by_class[1].keys():
        a, b = (c[t] for c in by_class)
        h = (a + b) / (n0 + n1)
        g = 2 * sum(o * math.log(o / e) for o, e in ((a, n0 * h), (b, n1 * h), (n0 - a, n0 * (1 - h)), (n1 - b, n1 * (1 - h))) if o)
        told = math.log2(2 + (b / n1) / (max(a, 1) / n0)) * math.sqrt(100 * max(g, 0) / n1) + 0.1
        weight[t] = (math.log((1 + len(texts)) / (1 + df[t])) + 1) * told
        assert told == pytest.approx(telling(np.array([a], float), np.array([b], float), n0, n1)[0], rel=1e-9)

    def vector(i):
        v = {t: (1 + math.log(n)) * weight[t] for t, n in counts[i].items() if t in weight} | {None: GROUND}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    vectors = {i: vector(i) for i in texts}
    per_class = {y: sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in truth if truth[i] == y) / n for y, n in ((0, n0), (1, n1))}

    def near(i, without=None):
        q = vectors[i]
        return sorted(((sum(x * q.get(t, 0.0) for t, x in vectors[e].items()), e) for e in learnt if e != without), reverse=True)[:15]

    def vote(found):
        votes = [(per_class[truth[e]] / (1.01 - min(c, 1.0)), truth[e]) for c, e in found]
        return sum(v * y for v, y in votes) / sum(v for v, _ in votes)

    curve = isotonic(np.array([vote(near(i, i)) for i in learnt]), np.array([float(truth[i]) for i in learnt]), np.array([per_class[truth[i]] for i in learnt]))
    for r in score_toxicity(docs, labels).collect():
        want = near(r["doc_id"])
        assert r["cosines"] == pytest.approx([c for c, _ in want], abs=1e-9)
        if want[-1][0] - near_next(vectors, learnt, r["doc_id"]) > 1e-9:  # no tie at the 15th place
            assert sorted(r["neighbours"]) == sorted(e for _, e in want)
            assert r["score"] == pytest.approx(calibrated(np.array([vote(want)]), curve)[0], abs=1e-6)
            assert r["toxic_neighbours"] == sum(truth[e] for _, e in want) and r["predicted"] == int(r["score"] >= 0.3)


def near_next(vectors, learnt, i):
    """The 16th cosine."""
    return sorted((sum(x * vectors[i].get(t, 0.0) for t, x in vectors[e].items()) for e in learnt), reverse=True)[15]


def test_words_of_the_last_texts_are_not_looked_up_anew():
    v = Vocabulary([b"trash", b"tras*"])
    v.most_words = 1
    v.count(["trash can"])
    first = v.words
    v.count(["can do"])
    assert v.words is not first and v.words.older is first and first.older == {}
    v.words.number = {}  # a word that is looked up anew is not found
    assert v.words[b"trash"] == 0


def test_postings_alike_share_a_weight():
    weight = np.array([2.0, 3.0])
    text, term, times = np.array([0, 1, 1, 2]), np.array([0, 0, 1, 0]), np.array([1, 1, 1, 2])
    index = BlockMaxIndex((np.arange(3), np.zeros(3), np.ones(3)), (text, term, times), weight, 0)
    assert len(index.value) == 3 and len(index.example) == 4  # lists, postings
    asked = np.array([0, 0]), np.array([0, 1]), np.array([1, 1])
    (places, got), want = index.nearest(asked, 1, 3)[0], plain_cosines([(i, 0, 1.0, term[text == i], times[text == i]) for i in range(3)], weight, (asked[1], asked[2]))
    assert np.allclose(got, sorted(want, reverse=True)) and sorted(index.ids[places].tolist()) == [0, 1, 2]


def test_making_the_index_and_voting_are_lean():
    """What the index is made from is not copied several times over, and few texts'
    lists are looked up together."""
    rng = np.random.default_rng(3)
    examples, terms, each = 600, 20_000, 500
    text = np.repeat(np.arange(examples), each).astype(np.int32)
    term = np.sort(rng.integers(0, terms, (examples, each)), axis=1).astype(np.int32).ravel()
    keep = np.append(True, (np.diff(term) != 0) | (np.diff(text) != 0))
    text, term = text[keep], term[keep]
    times = rng.integers(1, 9, len(term)).astype(np.int32)
    tracemalloc.start()
    index = BlockMaxIndex((np.arange(examples), np.arange(examples) % 2, np.ones(examples)), (text, term, times), np.ones(terms))
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.reset_peak()
    first = text < 128
    got = index.vote((text[first].astype(np.int64), term[first].astype(np.int64), times[first]), 128, 5)
    most = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert [int(index.ids[g[1][0]]) for g in got] == list(range(128))
    assert peak < 15e6 and most < 15e6  # bytes; 16 and 28 million before
