"""Token counts by heap-and-linked-list byte-pair merging (no ids emitted).

A pre-token's bytes form a linked list of symbols; a heap holds the ranks of
adjacent pairs. The lowest-rank pair is popped and merged again and again, and
the token count is the number of first symbols minus the number of merges.
"""

from __future__ import annotations

import heapq
import json

import regex
from pyspark.sql import DataFrame

from fleetlens.llm.common import Recent, map_rows, per_worker, pick

# The pattern byte-level tokenizers split text by.
PRETOKEN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_merges(raw: bytes) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """Merge ranks by pair of byte strings, and the special strings, of a
    tokenizer file (JSON, byte-level BPE)."""
    spec = json.loads(raw)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
        raise ValueError("only byte-level BPE files without a normalizer or prefix space are supported")
    if model.get("ignore_merges") or model.get("dropout"):
        raise ValueError("ignore_merges and dropout are not supported")
    special = []
    for t in spec.get("added_tokens") or []:
        if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized"):
            raise ValueError(f"unsupported flags of the added token {t['content']!r}")
        special.append(t["content"])
    byte_of = byte_alphabet()
    to_bytes = lambda s: bytes(byte_of[c] for c in s)
    ranks: dict[tuple[bytes, bytes], int] = {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        ranks[to_bytes(left), to_bytes(right)] = rank
    return ranks, special


def count_merged(piece: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Tokens left of ``piece`` after all merges, in O(n log n)."""
    n = len(piece)
    if n < 2:
        return n
    symbol: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    rank_of = ranks.get
    heap = [(r, i) for i in range(n - 1) if (r := rank_of((symbol[i], symbol[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        if symbol[i] is None or (j := after[i]) < 0 or rank_of((symbol[i], symbol[j])) != rank:
            continue  # one of the two has been merged since
        symbol[i] += symbol[j]
        symbol[j] = None
        after[i] = k = after[j]
        merges += 1
        if k >= 0:
            before[k] = i
            if (r := rank_of((symbol[i], symbol[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := rank_of((symbol[h], symbol[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


class TokenCounter:
    """Counts the tokens of texts as the file's tokenizer does by default
    (special strings in the text count as one token, nothing is added)."""

    def __init__(self, raw: bytes, most: int = 300_000):
        ranks, special = read_merges(raw)
        self.split = regex.compile(PRETOKEN_PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.counts = Recent(lambda piece: count_merged(piece.encode(), ranks), most)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        parts, total = [text], 0
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            total = len(parts) - 1
        look = self.counts.__getitem__
        return total + sum(sum(map(look, self.split(p))) for p in parts)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (``n_tokens > limit``).

    A null text counts as empty (0, 0, false); null and repeated ids pass
    through; other columns are ignored. The tokenizer file is read on the
    driver and broadcast (a vocabulary, fixed in size).
    """
    with open(tokenizer_path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast({"value": f.read()})

    def make():
        count = per_worker(held, "counter", TokenCounter)

        def f(c):
            n = [count(t) for t in c["text"]]
            return {"doc_id": c["doc_id"], "n_bytes": [len(t.encode()) if t else 0 for t in c["text"]], "n_tokens": n, "over_limit": [x > limit for x in n]}

        return f

    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_rows(src, make, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("doc_id", id_col)
