"""Source divergence against a dense plain-Python statement."""

import random
import re
from collections import Counter, defaultdict

import pytest
from llm_fixtures import EDGE_TEXTS, edge_docs, make_docs, no_docs, rows_for  # noqa: F401

from fleetlens.llm import divergence
from fleetlens.llm.divergence import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, min_df=10, top=10):
    """docs: (lang, source, text)."""
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        c = Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        counts[lang, source].update(c)
        df[lang].update(c.keys())
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_df]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        q = share(whole)
        shares = {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(f(shares[s][t], shares[o][t]) for t in kept), o.encode(), o) for o in sources - {s}]
            terms = [(-f(shares[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and shares[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def docs():
    rng = random.Random(11)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Élan", "élan", "漢字", "x9y"]
    out = []
    for i in range(260):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice(["s1", "s1", "s1", "s2", "ß", None, "s\U0001f600", "s￮"])
        shift = len(source or "") * 5
        out.append((lang, source, " ".join(rng.choice(words[shift : shift + 60]) for _ in range(rng.randint(0, 30)))))
    return out + [("fr", "only", "un deux"), ("en", "void", None), ("en", "void", "12 34"), ("it", "a", "uno"), ("it", "b", "due")]


def frame(spark, docs):
    rows = [(lang, source, text, 1, "c", 2, 3, "d") for lang, source, text in docs]
    return spark.createDataFrame(rows, "lang string, source string, text string, n int, term string, p int, rows int, item string").repartition(4)


@pytest.mark.parametrize("held, rows, step", [(400_000, 200_000, 1 << 18), (20, 30, 16)])
def test_against_dense_counts(spark, docs, monkeypatch, held, rows, step):
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "CHUNK_ROWS", rows)
    monkeypatch.setattr(divergence, "STEP", step)
    want = plain(docs)
    assert {"pair", "term"} == {r[2] for r in want} and got(source_divergence(frame(spark, docs))) == want


def test_other_limits(spark, docs):
    assert got(source_divergence(frame(spark, docs), min_df=1, top_terms=3)) == plain(docs, 1, 3)


def test_edge_documents(spark, edge_docs, no_docs):
    edge = [(r[2], r[3], r[1]) for r in rows_for(EDGE_TEXTS)]
    assert got(source_divergence(edge_docs, min_df=2)) == plain(edge, 2)
    assert got(source_divergence(edge_docs)) == plain(edge)
    assert got(source_divergence(no_docs)) == []


def test_large_counts_stay_exact(spark):
    count, total, kept = 9 * 10**12, 8 * 10**13, 10**9
    row = spark.createDataFrame([(count, total, kept)], "n long, total long, v long").select(divergence.share("n", "total", "v").alias("p")).first()
    assert row["p"] == 1 + 10**9 * (count + 2) // (total + 2 * kept)
