import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import edge_docs, make_docs, no_docs, sf_texts  # noqa: F401
from fleetlens.llm import ppm
from fleetlens.llm.ppm import ORDER, ByteModel, count_grams, dealt, flipped, from_differences, from_planes, in_batches, planes, score_documents, to_differences

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def trie(texts):
    levels = [defaultdict(Counter) for _ in range(ORDER + 1)]
    for t in texts:
        s = b"\xff" * ORDER + t + b"\xff"
        for i in range(ORDER, len(s)):
            for n in range(ORDER + 1):
                levels[n][s[i - n : i]][s[i]] += 1
    return levels


def plain_score(levels, text, least):
    s, total = b"\xff" * ORDER + text + b"\xff", 0.0
    for i in range(ORDER, len(s)):
        p, excluded = 1.0, set()
        for n in range(ORDER, -1, -1):
            counts = levels[n].get(s[i - n : i])
            if not counts or (n and counts.total() < least):
                continue
            counts = {k: c for k, c in counts.items() if k not in excluded}
            if not counts:
                continue
            seen, kinds = sum(counts.values()), len(counts)
            whole = seen + (kinds if len(excluded) + kinds < 256 else 0)
            if s[i] in counts:
                total += math.log10(p * counts[s[i]] / whole)
                break
            p *= kinds / whole
            excluded |= set(counts)
        else:
            total += math.log10(p / (256 - len(excluded)))
    return total


def fitted(texts, least):
    grams, seen = count_grams(texts)
    levels = []
    for n in range(ORDER + 1):
        g, inverse = np.unique(grams & np.uint64((256 << 8 * n) - 1), return_inverse=True)
        c = np.bincount(inverse, seen).astype(int)
        _, context = np.unique(g >> np.uint64(8), return_inverse=True)
        keep = np.bincount(context, c)[context] >= (least if n else 0)
        levels.append((g[keep], c[keep]))
    return ByteModel(levels)


@pytest.mark.parametrize("least", [0, 5, 60])
def test_byte_model_by_definition(least):
    rng = random.Random(least)
    texts = ["".join(rng.choice("abc dé漢") for _ in range(rng.randrange(60))).encode() for _ in range(40)]
    model, levels = fitted(texts, least), trie(texts)
    asked = [*texts[:8], b"", b"zzz", "漢é字 abc".encode(), bytes(range(0xFF))]
    for got, t in zip(model.score(asked), asked):
        assert got == pytest.approx(plain_score(levels, t, least), rel=1e-6)
    assert np.allclose((10.0 ** model.logs.astype(float).reshape(-1, 256)).sum(axis=1), 1, atol=1e-5)


def test_every_byte_seen():
    texts = [bytes(range(0xFF))] * 2
    model = fitted(texts, 0)
    assert model.score([b"ab"])[0] == pytest.approx(plain_score(trie(texts), b"ab", 0), rel=1e-6)
    assert len(fitted([], 0).score([b"x", b""])) == 2


def test_keys_travel_as_planes():
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 1 << 48, 500, dtype=np.uint64))
    assert (flipped(flipped(grams)) == grams).all() and int(flipped(np.array([0x0102030405FF], np.uint64))[0]) == 0x0504030201FF
    keys = np.sort(flipped(grams))
    assert (from_differences(to_differences(keys, 6), 6) == keys).all()
    words = np.sort(rng.integers(0, 1 << 64, 300, dtype=np.uint64))
    assert (from_differences(to_differences(words, 8), 8) == words).all() and len(to_differences(words[:0], 8)) == 0
    counts = np.array([0, 1, 2**39, 7])
    assert from_planes(planes(counts, 5), 5).tolist() == counts.tolist()
    assert sorted(np.concatenate([x for _, x in dealt(keys, keys, 7)]).tolist()) == list(range(len(keys)))
    assert [len(x) for x in in_batches([b"ab", b"c", b"defgh", b""], 3)] == [2, 1, 1]


def test_places():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 1000, 70_000):
        keys = rng.permutation(np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64) if n != 1000 else np.arange(1000, dtype=np.uint64)))
        at = rng.integers(0, len(keys), 3 * n) if n else np.empty(0, np.int64)
        assert (ppm.Places(keys).of(keys[at]) == at).all()


@pytest.mark.parametrize("hot", [1, 40, 400])
def test_hot_contexts_are_dealt_further(make_docs, sf_texts, monkeypatch, hot):
    """Several pieces and parts; contexts that many pairs are asked for split by the bytes further back."""
    texts = [(i, (t or "")[:600]) for i, t in sf_texts[:40]]
    docs = make_docs(texts).repartition(4)
    whole = {r["doc_id"]: (r["score"], r["base_score"]) for r in score_documents(docs).collect()}
    monkeypatch.setattr(ppm, "HOT", hot)
    monkeypatch.setattr(ppm, "PIECE", 3000)
    monkeypatch.setattr(ppm, "LEAST_PARTS", 5)
    depths = []
    solve = ppm.hot_counts
    monkeypatch.setattr(ppm, "hot_counts", lambda asked, hot: depths.append([len(x) for x in hot]) or solve(asked, hot))
    split = {r["doc_id"]: (r["score"], r["base_score"]) for r in score_documents(docs).collect()}
    assert depths and depths[0][0] > 0 and (hot > 40 or depths[0][1] > 0)
    assert whole.keys() == split.keys() and all(split[i] == pytest.approx(whole[i], rel=1e-5) for i in whole)
    training = [t.translate(LOWER).encode() for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    levels = trie(training)
    assert all(split[i][0] == pytest.approx(plain_score(levels, t.translate(LOWER).encode(), 0), rel=1e-5) for i, t in texts)


def test_scores_against_plain_python(edge_docs, make_docs, sf_texts, no_docs):
    docs = make_docs(sf_texts[:60]).unionByName(edge_docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None] for _, t in rows]
    counts = Counter(w for (i, _), t in zip(rows, tokens) if not held(i) for w in t)
    n, v = counts.total(), len(counts)
    want = sorted((str((i, held(i), len(t), sum(counts[w] > 0 for w in t), n)), sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for (i, _), t in zip(rows, tokens))
    found = score_documents(docs)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]
    got = found.collect()
    assert [k for k, _ in want] == [k for k, _ in sorted((str((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"])), r["base_score"]) for r in got)]
    assert [b for _, b in want] == pytest.approx([b for _, b in sorted((str((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"])), r["base_score"]) for r in got)], rel=1e-9)
    training = [(t or "").translate(LOWER).encode() for i, t in rows if not held(i)]
    levels, least = trie(training), 0
    scores = {(r["doc_id"], r["n_bytes"]): r["score"] for r in got}
    for i, t in rows:
        if t is None or len(t) < 3000:
            raw = (t or "").translate(LOWER).encode()
            assert scores[i, len((t or "").encode())] == pytest.approx(plain_score(levels, raw, least), rel=1e-5)
    assert score_documents(no_docs).collect() == []


def test_query_keeps_every_context(spark, make_docs, tmp_path):
    """A corpus in which a context seen once or twice holds less than 2^-16 of the bytes."""
    from fleetlens.llm.registry import op8_lm_scores

    texts = [(i, f"the hot source says the same thing again {i % 7}. " * 60) for i in range(100)] + [(200 + i, "zq rare words: näive quixotic jumble, kvass") for i in range(4)]
    make_docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    training = [t.lower().encode() for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    assert sum(len(t) + 1 for t in training) > 2**17
    levels = trie(training)
    want = {i: plain_score(levels, t.lower().encode(), 0) for i, t in texts}
    got = {r["doc_id"]: r["score"] for r in op8_lm_scores(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], rel=1e-5) for i in want)
