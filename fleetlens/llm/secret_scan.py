"""Secret scans: fixed patterns, and sliding-window Shannon entropy per
character class with allow-list suppression.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import map_rows, pick, release_memory

# The base kinds, in the order in which ties are listed.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # greedy, so the same as runs of any length kept from 24 on
KEYWORDS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGIT = re.compile(r"[0-9]")
# Bits a character that a window must reach, by the class of the whole
# stretch; a 20-character window has log2(20) = 4.32 at most, and a hex one 4.
THRESHOLDS = {"hex": 3.2, "upper": 3.6, "lower": 3.6, "mixed": 3.8, "letters": 3.8}
# Strings that look random and are known not to be secrets.
UUID = re.compile(r"(?<![0-9a-zA-Z])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9a-zA-Z])")
PIECE = re.compile(r"[^/=_+-]+")
# A number; letters, with a number before or after; in short pieces, letters and numbers twice.
PLAIN = re.compile(r"[0-9]++|([A-Za-z]++)[0-9]{0,8}|[0-9]{1,8}([A-Za-z]++)[0-9]{0,4}")
TWICE = re.compile(r"([A-Za-z]++)[0-9]{1,8}([A-Za-z]++)[0-9]{0,8}")
SHORT, SHORT_MIXED, SHORT_TWICE, LONG_WORD = 3, 8, 12, 16
HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
CONSONANTS = re.compile(r"[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{8}")
VOWELS = re.compile(r"[aeiouyAEIOUY]")
PLACEHOLDER = re.compile(r"example|sample|placeholder|xxxx|0123456789|abcdefgh", re.IGNORECASE)
LONGEST_ALLOWED = 64  # a longer piece with a placeholder in it is no placeholder as a whole
TERMS = [0.0, *(c * math.log2(c) for c in range(1, WINDOW + 2))]  # a step adds before it takes away


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, in order."""
    out = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def character_class(s: str) -> str | None:
    """The class whose threshold holds for a stretch; None: it has no letters."""
    if not re.search("[A-Za-z]", s):
        return None
    if not DIGIT.search(s):
        return "letters"
    if re.fullmatch("[0-9a-fA-F]+", s):
        return "hex"
    if not re.search("[a-z]", s):
        return "upper"
    return "mixed" if re.search("[A-Z]", s) else "lower"


def dense_windows(s: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged spans of the windows with at least ``threshold`` bits a character.

    The sum of c log2 c over a window's character counts changes by two terms
    as the window moves on, so each step costs the same whatever its width.
    """
    counts: dict[str, int] = {}
    total = 0.0
    least = window * (math.log2(window) - threshold) + 1e-9  # H >= t  <=>  sum(c log2 c) <= w (log2 w - t)
    out: list[tuple[int, int]] = []
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += TERMS[c + 1] - TERMS[c]
        counts[ch] = c + 1
        if i >= window:
            gone = s[i - window]
            c = counts[gone]
            total += TERMS[c - 1] - TERMS[c]
            counts[gone] = c - 1
        if i >= window - 1 and total <= least:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def gaps(a: int, b: int, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What the spans of ``taken``, in order, leave of a to b."""
    for start, _, end in taken:
        if start >= b:
            break
        if start > a:
            yield a, start
        a = max(a, end)
    if a < b:
        yield a, b


def placeholders(text: str, a: int, b: int) -> list[tuple[int, int, int]]:
    """The pieces of a to b, parted by / = _ and -, that hold a placeholder; of
    a long piece, the placeholder alone."""
    if not PLACEHOLDER.search(text, a, b):
        return []
    out = []
    for m in PIECE.finditer(text, a, b):
        found = [(x.start(), 3, x.end()) for x in PLACEHOLDER.finditer(text, m.start(), m.end())]
        out += found if m.end() - m.start() > LONGEST_ALLOWED else [(m.start(), 3, m.end())] if found else []
    return out


def is_word(letters: str) -> bool:
    """Whether letters can be a word, or words in a row, told by their case: random
    ones change case every other letter. A long word must have vowels."""
    if len(letters) > SHORT and not letters.isupper() and not letters.islower() and len(letters) < (3 if len(letters) < LONG_WORD else 3.5) * len(HUMP.findall(letters)):
        return False
    return len(letters) < LONG_WORD or len(VOWELS.findall(letters)) >= 0.2 * len(letters) and not CONSONANTS.search(letters)


def is_plain(piece: str) -> bool:
    """Whether a piece is a word, a number, or words with numbers."""
    m = PLAIN.fullmatch(piece) or (TWICE.fullmatch(piece) if len(piece) <= SHORT_TWICE else None)
    return m is not None and all(is_word(x) for x in m.groups() if x)


def odd_stretches(text: str, a: int, b: int) -> Iterator[tuple[int, int, list[re.Match]]]:
    """(start, end, pieces) of the runs of pieces of a to b, parted by / = _ + and -,
    that are not plain. A key's own signs may cut it anywhere: plain pieces that are
    short (longer ones too, if not just small letters or digits) belong to a run
    between two others, and at its ends where it would otherwise be shorter than a
    window; so do signs there."""
    pieces = list(PIECE.finditer(text, a, b))
    # 0: not plain, 1: plain but short, 2: plain
    kinds = [0 if not is_plain(p := m.group()) else 1 if len(p) <= (SHORT if p.islower() or p.isdigit() else SHORT_MIXED) else 2 for m in pieces]
    i = 0
    while i < len(pieces):
        if kinds[i]:
            i += 1
            continue
        first = last = i
        while i < len(pieces) and kinds[i] < 2:
            last = i if not kinds[i] else last
            i += 1
        least = first
        while pieces[last].end() - pieces[first].start() < WINDOW and least > 0 and kinds[least - 1] == 1:
            least = first = least - 1
        while pieces[last].end() - pieces[first].start() < WINDOW and last + 1 < len(pieces) and kinds[last + 1] == 1:
            last += 1
        start, end = pieces[first].start(), pieces[last].end()
        if end - start < WINDOW:
            start = a if not first else pieces[first - 1].end()
            end = b if last + 1 == len(pieces) else pieces[last + 1].start()
        yield start, end, pieces[first : last + 1]


def stretches(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, str, str]]:
    """(start, stretch, class) of what the spans of ``taken`` and the allow-list
    (UUIDs, placeholders, plain pieces) leave of the candidates. Stretches without
    digits go piece by piece."""
    at = 0
    for m in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][2] <= m.start():
            at += 1
        e = at
        while e < len(taken) and taken[e][0] < m.end():
            e += 1
        known = [(x.start(), 3, x.end()) for x in UUID.finditer(text, m.start(), m.end())]
        for a, b in gaps(m.start(), m.end(), sorted(taken[at:e] + known)):
            if b - a < WINDOW:
                continue
            for c, d in gaps(a, b, placeholders(text, a, b)):
                for x, y, pieces in odd_stretches(text, c, d):
                    if y - x < WINDOW or (kind := character_class(text[x:y])) is None:
                        continue
                    if kind != "letters":
                        yield x, text[x:y], kind
                        continue
                    for p in pieces:
                        if p.end() - p.start() >= WINDOW and not is_plain(p.group()):
                            yield p.start(), p.group(), kind


def entropy_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of dense stretches in what the spans of ``taken``
    and the allow-list leave of the candidates."""
    return [(a + x, 3, a + y) for a, s, kind in stretches(text, taken) for x, y in dense_windows(s, THRESHOLDS[kind])]


def all_spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and all spans, of a text (null: empty)."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + entropy_spans(text, base))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each stretch covered by spans replaced by ``mark``."""
    out, at = [], 0
    for a, _, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_assign``, ``n_access``, ``n_hex``,
    ``n_entropy``, ``base_spans`` and ``spans`` as ``kind:start:end`` in code
    points, end exclusive, by start and then kind, and ``base_sha256`` of the
    former.

    A null text counts as empty; null and repeated ids pass through; other
    columns are ignored. Texts of any length are scanned whole.
    """

    def make():
        def f(c):
            out = {n: [] for n in ("n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "base_spans", "spans")}
            for text in c["text"]:
                base, spans = all_spans(text)
                for i, n in enumerate(("n_assign", "n_access", "n_hex", "n_entropy")):
                    out[n].append(sum(k == i for _, k, _ in spans))
                out["base_spans"].append(listed(base))
                out["base_sha256"].append(hashlib.sha256(out["base_spans"][-1].encode()).hexdigest())
                out["spans"].append(listed(spans))
            return out | {"doc_id": c["doc_id"]}

        return f

    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_rows(src, make, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, base_spans string, spans string").withColumnRenamed("doc_id", id_col)


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every found span in ``text_col`` replaced by ``[SECRET]``,
    and ``length_col``, if there is one, set to the new length in code points.
    Null texts stay null; all other columns and all rows stay as they are."""

    @F.arrow_udf("string")
    def masked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:  # null: nothing to mask
        for texts in batches:
            out = []
            for x in texts:
                spans = all_spans(text := x.as_py())[1]
                out.append(redact(text, spans) if spans else None)
            yield pa.array(out, pa.string())
        release_memory()

    new = docs.withColumn("__masked", masked(F.col(f"`{text_col}`")))
    out = {text_col: F.coalesce("__masked", F.col(f"`{text_col}`"))}
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out[length_col] = F.when(F.col("__masked").isNotNull(), F.length("__masked").cast(kind)).otherwise(F.col(f"`{length_col}`"))
    return new.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
