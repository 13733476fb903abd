"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each merge rank has a bucket of linked-list positions. A bitmap over ranks, with
a bitmap of its non-empty words above it, names the non-empty buckets;
find-first-set on both gives the lowest rank in two steps, whatever the
number of positions. Entries made stale by another merge are
skipped when they come up. Within a bucket the leftmost position goes first.
The pre-tokens of several texts share a queue.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from fleetlens.llm.bpe_count import PRETOKEN_PATTERN
from fleetlens.llm.common import map_rows, per_worker, pick

BITS = 8  # 256 ranks to a word of the lower bitmap; the upper one has a bit for each word
BATCH = 128  # texts whose unknown pre-tokens are merged together


class RankQueue:
    """Smallest rank first, then smallest position."""

    __slots__ = ("buckets", "top", "words")

    def __init__(self, waiting: np.ndarray | None = None):
        """waiting: the rank at each position, -1 for none."""
        self.buckets, self.words, self.top = {}, {}, 0  # words: of the lower bitmap, by rank >> BITS
        if waiting is None:
            return
        place = np.flatnonzero(waiting >= 0)
        rank = waiting[place]
        order = np.argsort(rank, kind="stable")
        rank, place = rank[order], place[order].tolist()
        first = np.flatnonzero(np.diff(rank, prepend=-1))
        starts = first.tolist()
        for r, a, b in zip(rank[first].tolist(), starts, [*starts[1:], len(place)]):
            self.put(r, place[a:b])

    def put(self, rank: int, positions: list[int]) -> None:
        """Queue ascending positions under a rank that has none."""
        self.buckets[rank] = positions
        word = rank >> BITS
        self.words[word] = self.words.get(word, 0) | 1 << (rank & 255)
        self.top |= 1 << word

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heapq.heappush(bucket, position)
        else:
            self.put(rank, [position])

    def take(self) -> tuple[int, list[int]]:
        """The first rank and all its positions; only while ``top`` is not 0."""
        top = self.top
        word = (top & -top).bit_length() - 1
        bits = self.words[word]
        low = bits & -bits
        rank = word << BITS | low.bit_length() - 1
        self.words[word] = bits ^ low
        if bits == low:
            self.top = top ^ 1 << word
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket

    def pop(self) -> tuple[int, int]:
        """(rank, position) of the first entry; only while ``top`` is not 0."""
        rank, bucket = self.take()
        position = heapq.heappop(bucket)
        if bucket:
            self.put(rank, bucket)
        return rank, position


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks by token bytes, of a rank file (a base64 token and its rank a line)."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line.strip())}


class Merger:
    """Encodes pre-tokens, many in one queue: no pair spans two of them, so the
    merges of each come in its own order, and pre-tokens share the queue's steps."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.single = np.array([ranks.get(bytes([x]), -1) for x in range(256)])
        self.pairs = np.full(1 << 16, -1)  # ranks of tokens of two bytes
        for token, rank in ranks.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, as little-endian unsigned 32-bit integers."""
        text, longest, rank_of = b"".join(pieces), self.longest, self.ranks.get
        n, ends = len(text), np.cumsum([len(p) for p in pieces])
        raw = np.frombuffer(text, np.uint8).astype(np.intp)
        ranks = np.full(n, -1)
        ranks[:-1] = self.pairs[raw[:-1] << 8 | raw[1:]]
        ranks[ends - 1] = -1
        queue, waiting = RankQueue(ranks), ranks.tolist()  # waiting: the rank that the pair at each place is queued under
        border = bytearray(n + 1)  # 1 where a pre-token starts, and at the end
        for e in (0, *ends.tolist()):
            border[e] = 1
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a symbol is text[i:end[i]]; end[i] is the next one's place
        ids, symbol = self.single[raw].tolist(), bytearray(b"\1") * n  # symbol: 1 where one starts
        while queue.top:
            rank, places = queue.take()
            for nth, i in enumerate(places, 1):
                if waiting[i] != rank:
                    continue  # stale: one of the two has been merged since
                j = end[i]
                waiting[j], symbol[j] = -1, 0
                end[i] = k = end[j]
                ids[i] = lowest = rank
                if border[k]:
                    waiting[i] = -1
                else:
                    before[k] = i
                    waiting[i] = r = rank_of(text[i : end[k]], -1) if end[k] - i <= longest else -1
                    if r >= 0:
                        queue.push(r, i)
                        lowest = min(r, lowest)
                if not border[i]:
                    h = before[i]
                    waiting[h] = r = rank_of(text[h:k], -1) if k - h <= longest else -1
                    if r >= 0:
                        queue.push(r, h)
                        lowest = min(r, lowest)
                if lowest < rank and nth < len(places):  # that one goes first
                    queue.put(rank, places[nth:])
                    break
        left = np.frombuffer(symbol, bool)
        found = np.array(ids)[left]
        if (found < 0).any():
            raise KeyError("a byte has no token")
        flat, upto = found.astype("<u4").tobytes(), (4 * np.cumsum(left)[ends - 1]).tolist()
        return [flat[a:b] for a, b in zip([0, *upto], upto)]


class BpeCodec:
    """Encodes texts and decodes ids by a rank file; no special tokens.

    The ids of pre-tokens are kept, for the last ``most`` to twice ``most`` distinct
    ones of at most ``longest`` characters; others are merged together, about
    ``step`` bytes at a time, which bounds the queue."""

    def __init__(self, raw: bytes, pattern: str = PRETOKEN_PATTERN, most: int = 150_000, longest: int = 64, step: int = 1 << 14):
        self.ranks = read_ranks(raw)
        self.split = regex.compile(pattern).findall
        self.merge, self.most, self.longest, self.step = Merger(self.ranks), most, longest, step
        # ids by pre-token, as little-endian unsigned 32-bit integers
        self.recent, self.older = {}, {}
        self.token = np.full(max(self.ranks.values()) + 1, None)
        for token, i in self.ranks.items():
            self.token[i] = token

    def look_up(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pre-tokens that are not among the recent ones, which they join."""
        out, left = {}, []
        for p in pieces:
            ids = self.older.get(p)
            if ids is None:
                b = p.encode()
                if (whole := self.ranks.get(b)) is None:
                    left.append((p, b))
                    continue
                ids = whole.to_bytes(4, "little")
            out[p] = ids
        a = size = 0
        for e, (_, b) in enumerate(left, 1):
            size += len(b)
            if size >= self.step or e == len(left):
                out.update(zip([p for p, _ in left[a:e]], self.merge([b for _, b in left[a:e]])))
                a, size = e, 0
        for p, ids in out.items():
            if len(p) <= self.longest:
                if len(self.recent) >= self.most:
                    self.recent, self.older = {}, self.recent
                self.recent[p] = ids
        return out

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text (null: none)."""
        known, parts, unknown = self.recent.get, [], set()
        for text in texts:
            pieces = self.split(text) if text else []
            ids = list(map(known, pieces))
            unknown.update([p for p, i in zip(pieces, ids) if i is None])
            parts.append((pieces, ids))
        new = self.look_up(unknown)
        return [np.frombuffer(b"".join([new[p] if i is None else i for p, i in zip(*x)]), "<u4") for x in parts]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.token[ids].tolist())


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str = PRETOKEN_PATTERN, outputs: tuple[str, ...] = ("ids",), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per input row: the id, the ``keep`` columns, ``n_tokens`` and the ``outputs`` asked for.

    ``outputs``: ``ids`` (array of int), ``decoded`` (the ids decoded back, as
    bytes), ``ids_sha256`` (of the ids as little-endian unsigned 32-bit
    integers), ``decoded_sha256``. A null text is encoded as an empty one;
    null and repeated ids pass through; other columns are ignored. The rank
    file is read on the driver and broadcast (a vocabulary, fixed in size).
    """
    kinds = {"ids": "array<int>", "decoded": "binary", "ids_sha256": "string", "decoded_sha256": "string"}
    with open(ranks_path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast({"value": f.read()})

    def make():
        codec = per_worker(held, "codec", lambda raw: BpeCodec(raw, pattern))

        def f(c):
            out = {n: v for n, v in c.items() if n != "text"} | {"n_tokens": []} | {o: [] for o in outputs}
            texts = c["text"]
            for ids in chain.from_iterable(codec.encode_all(texts[a : a + BATCH]) for a in range(0, len(texts), BATCH)):
                out["n_tokens"].append(len(ids))
                back = codec.decode(ids) if "decoded" in out or "decoded_sha256" in out else b""
                for o in outputs:
                    out[o].append(ids if o == "ids" else back if o == "decoded" else hashlib.sha256(ids.tobytes() if o == "ids_sha256" else back).hexdigest())
            return out

        return f

    src = pick(docs, doc_id=id_col, text=text_col, **{f"keep_{i}": k for i, k in enumerate(keep)})
    kind = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    schema = ", ".join(f"{n} {kind[n]}" for n in src.columns if n != "text") + ", n_tokens long" + "".join(f", {o} {kinds[o]}" for o in outputs)
    return map_rows(src, make, schema).withColumnsRenamed({"doc_id": id_col} | {f"keep_{i}": k for i, k in enumerate(keep)})


def decode_documents(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text of each row's ids (null ids: empty); bytes that are not UTF-8,
    as in a cut token list, become replacement characters."""
    with open(ranks_path, "rb") as f:
        held = tokens.sparkSession.sparkContext.broadcast({"value": f.read()})

    def make():
        token = per_worker(held, "token", lambda raw: {i: t for t, i in read_ranks(raw).items()})
        return lambda c: {"doc_id": c["doc_id"], "text": [b"".join(token[i] for i in ids or ()).decode("utf-8", "replace") for ids in c["ids"]]}

    src = pick(tokens, doc_id=id_col, ids=ids_col)
    return map_rows(src, make, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string").withColumnRenamed("doc_id", id_col)
