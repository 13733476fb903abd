import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import edge_docs, make_docs, no_docs  # noqa: F401
from fleetlens.llm import bpe_codec
from fleetlens.llm.bpe_codec import BpeCodec, RankQueue, decode_documents, encode_documents
from fleetlens.llm.bpe_count import TokenCounter, count_tokens

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = st.text(st.sampled_from("aab eé漢\n\t '\"s1٣<|endoftext|>\x85\x1c !😀"), max_size=80)


@pytest.fixture(scope="module")
def counters():
    with open(JSON, "rb") as f:
        return TokenCounter(f.read(), most=50), Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def codecs():
    with open(RANKS, "rb") as f:
        raw = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return BpeCodec(raw, public_tokenizers.PATTERN, most=50), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_counts_as_the_library(counters, text):
    own, library = counters
    assert own(text) == len(library.encode(text, add_special_tokens=False).ids)


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_ids_as_the_library_and_back(codecs, text):
    own, library = codecs
    ids = own.encode(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_long_pretokens(counters, codecs):
    rng = random.Random(5)
    for text in ("ab" * 20000, "a" * 5000, "".join(rng.choice("abcdefgh") for _ in range(20000))):
        assert counters[0](text) == len(counters[1].encode(text, add_special_tokens=False).ids)
        assert codecs[0].encode(text).tolist() == codecs[1].encode_ordinary(text)


@given(st.lists(st.one_of(st.none(), st.tuples(st.integers(0, 70000), st.integers(0, 40))), max_size=120))
def test_rank_queue_pops_in_order(steps):
    queue, held = RankQueue(), []
    for s in steps:
        if s is None:
            if held:
                assert queue.top and queue.pop() == min(held)
                held.remove(min(held))
            else:
                assert not queue.top
        else:
            queue.push(*s)
            held.append(s)


def test_count_query_rows(edge_docs, no_docs, counters):
    got = count_tokens(edge_docs, JSON)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(counters[1].encode(r["text"] or "", add_special_tokens=False).ids)) for r in edge_docs.collect()), key=str)
    assert sorted(((r[0], r[1], r[2]) for r in got.collect()), key=str) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got.collect())
    assert count_tokens(no_docs, JSON).collect() == []


def test_codec_query_rows(edge_docs, no_docs, codecs):
    got = encode_documents(edge_docs, RANKS, public_tokenizers.PATTERN, outputs=("ids", "decoded", "ids_sha256", "decoded_sha256"), keep=("lang", "score"))
    assert got.columns == ["doc_id", "lang", "score", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"]
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    texts = sorted((r["text"] or "").encode() for r in edge_docs.collect())
    assert sorted(bytes(r["decoded"]) for r in rows) == texts
    for r in rows:
        assert r["ids"] == codecs[1].encode_ordinary(bytes(r["decoded"]).decode()) and r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in r["ids"])).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(bytes(r["decoded"])).hexdigest()
    back = decode_documents(got.select("doc_id", "ids"), RANKS)
    assert sorted((r["text"] or "").encode() for r in back.collect()) == texts
    assert encode_documents(no_docs, RANKS).collect() == []


def test_texts_share_a_queue(codecs, monkeypatch):
    made = []

    class Counted(RankQueue):
        def __init__(self, *waiting):
            made.append(1)
            super().__init__(*waiting)

    monkeypatch.setattr(bpe_codec, "RankQueue", Counted)
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdefghé漢", k=rng.randint(1, 12))) for _ in range(40)) for _ in range(20)] + [None, "", "aaaaaaa aaaaaaaa"]
    with open(RANKS, "rb") as f:
        codec = BpeCodec(f.read(), public_tokenizers.PATTERN)
    assert [x.tolist() for x in codec.encode_all(texts)] == [codecs[1].encode_ordinary(t or "") for t in texts]
    assert len(made) == 1
    assert [x.tolist() for x in codec.encode_all(texts)] == [codecs[1].encode_ordinary(t or "") for t in texts]
    assert len(made) == 1  # all known by now


@given(st.permutations(["ab", "bc", "abc", "ca", "cab", "aa", "aaa", "bca", "abab"]), st.lists(st.text("abc", min_size=1, max_size=14), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_any_order_of_ranks(tokens, pieces):
    # A merge may make a pair of a lower rank than its own.
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(tokens)}
    library = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    raw = b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in ranks.items())
    codec = BpeCodec(raw, r"\w+", step=8)
    got = codec.encode_all(pieces + [" ".join(pieces)])
    assert [x.tolist() for x in got] == [library.encode_ordinary(p) for p in pieces] + [[i for p in pieces for i in library.encode_ordinary(p)]]


def test_recent_pretokens_are_bounded(codecs):
    with open(RANKS, "rb") as f:
        codec = BpeCodec(f.read(), public_tokenizers.PATTERN, most=30)
    for k in range(5):
        text = " ".join(f"w{k}x{i}" for i in range(100)) + " " + "q" * 200
        assert codec.encode(text).tolist() == codecs[1].encode_ordinary(text)
        assert len(codec.recent) <= 30 and len(codec.older) <= 30
        assert "q" * 200 not in codec.recent
