import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import edge_docs, make_docs, no_docs, sf_texts  # noqa: F401
from fleetlens.llm.quality import BASE_COLUMNS, line_key, measure, normalise_line, quality_verdicts, remove_frequent_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


@given(st.text(st.sampled_from("ab \n\t\x0b\x1c\x85#é|"), max_size=150))
@settings(max_examples=400, deadline=None)
def test_base_counts(text):
    assert measure(text)[:5] == plain(text)


def test_repeats_of_long_texts():
    assert measure("a b c d e f g h " * 5000)[4] == 40000
    assert measure(None)[:5] == (0, 0, 0, 0, 0)


def test_verdicts_against_plain_python(edge_docs, make_docs, sf_texts):
    common = "a line that many documents of one host hold 42"
    rows = sf_texts + [(10_000 + 2 * i, common.replace("42", str(i % 10)).upper() + "\nand own words" + "".join(f" w{i}x{j}" for j in range(20))) for i in range(15)]
    rows += [(20_000 + 2 * i, common) for i in range(3)] + [(20_000, common), (None, None), (30_001, None)]
    docs = make_docs(rows).unionByName(edge_docs)
    holders = defaultdict(set)
    for r in docs.collect():
        for x in (r["text"] or "").split("\n"):
            if x.strip(" \t\n\x0b\x0c\r"):
                holders[r["source"], normalise_line(x)].add(r["doc_id"])
    want = []
    for r in docs.collect():
        base = plain(r["text"])
        lost = sum(len(WORD.findall(x)) for x in (r["text"] or "").split("\n") if WORD.search(x) and len(holders[r["source"], normalise_line(x)]) > 10)
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        want.append((r["doc_id"], *base, failed, lost, not failed and 100 * (base[0] - lost) >= 30 * base[0]))
    got = quality_verdicts(docs)
    assert got.columns == ["doc_id", *BASE_COLUMNS, "base_failed", "n_removed_words", "removed_lines", "kept"]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.drop("removed_lines").collect())
    kept = remove_frequent_lines(docs, got)
    assert kept.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts[10_000].startswith("and own words") and 20_000 not in texts
    assert line_key("A  9 b") == line_key("a 1 B")


def test_empty_table(no_docs):
    assert quality_verdicts(no_docs).collect() == []
