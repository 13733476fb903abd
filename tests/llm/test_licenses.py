import random

from llm_fixtures import edge_docs, make_docs, no_docs  # noqa: F401
from fleetlens.llm.licenses import TEMPLATES, LicenseMatcher, bigrams, dice, normal_words, scan_licenses


def plain(text, threshold=0.8):
    lines = [(i, w) for i, x in enumerate((text or "").split("\n")) if (w := normal_words(x))]
    templates = [bigrams(normal_words(t)) for _, t in TEMPLATES]
    found = []
    for a in range(len(lines)):
        for e in range(a + 1, len(lines) + 1):
            got = bigrams([w for _, line in lines[a:e] for w in line])
            best = max(dice(got, t) for t in templates)
            if best >= threshold - 1e-12:
                found.append((lines[a][0], lines[e - 1][0] + 1, best))
    out = []
    for h in sorted(found, key=lambda h: (-h[2], h[1] - h[0], h[0])):
        if all(h[1] <= o[0] or h[0] >= o[1] for o in out):
            out.append(h)
    return sorted(out)


def test_pruning_loses_nothing():
    matcher, rng = LicenseMatcher(), random.Random(4)
    for _ in range(150):
        text = []
        for _ in range(rng.randrange(1, 4)):
            words = rng.choice(TEMPLATES)[1].split()
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(["foo", "the", "software"])
            cut = rng.randrange(len(words) + 1)
            text += [rng.choice(["foo bar", "the work of", "", "license"]), " ".join(words[:cut]), " ".join(words[cut:])]
        s = "\n".join(text)
        assert [h[:3] for h in matcher.scan(s)] == plain(s)


def test_known_notices():
    matcher = LicenseMatcher()
    names = lambda t: [h[3] for h in matcher.scan(t)]
    assert names("Some prose here.\nReleased under the MIT License.\nMore prose.") == ["MIT"]
    assert names("licensed UNDER cc by-nc 4.0") == ["CC-BY-NC-4.0"] and names("Licensed under the Apache License, Version 2.0.") == ["Apache-2.0"]
    assert names("the work of the people of the land and the sea") == [] and names("") == [] and names(None) == []
    for name, text in TEMPLATES:
        assert name in names("intro line\n" + text + "\nlast line")


def test_rows(edge_docs, no_docs):
    got = scan_licenses(edge_docs)
    assert got.columns == ["doc_id", "n_matches", "licenses", "best_dice", "spans"]
    assert got.count() == edge_docs.count() and {r["n_matches"] for r in got.collect()} == {0}
    assert scan_licenses(no_docs).collect() == []
    own = scan_licenses(edge_docs, templates=[("pair", "one two")], threshold=1.0)
    assert sorted((r["doc_id"], r["spans"]) for r in own.collect() if r["n_matches"]) == [(9, "pair:0:1"), (10, "pair:0:1")]


def test_notices_within_lines(make_docs):
    mit, bsd = (max((t for n, t in TEMPLATES if n == name), key=len) for name in ("MIT", "BSD-2-Clause"))
    prose = "the quick brown fox jumps over a lazy dog and goes home to sleep " * 40
    texts = [
        "This project is released under the MIT License.",
        "Copyright 2024 Acme. Released under the MIT License.",
        "Code is licensed under the MIT License; see LICENSE.",
        prose + mit + " " + prose,
        prose + bsd.replace("following", "next", 1) + prose + mit,
        prose + "\nprose that goes on, Released under\nthe MIT License. And so on\n" + prose,
        prose + "the license of the work is under review",
    ]
    got = {r["doc_id"]: r for r in scan_licenses(make_docs(list(enumerate(texts)))).collect()}
    assert [got[i]["licenses"] for i in range(7)] == ["MIT", "MIT", "MIT", "MIT", "BSD-2-Clause,MIT", "MIT", ""]
    assert got[5]["spans"] == "MIT:1:3" and got[3]["best_dice"] == 1.0


def test_siblings_have_their_own_names():
    matcher = LicenseMatcher()
    gnu = next(t for n, t in TEMPLATES if n == "GPL-3.0-or-later")
    lesser = next(t for n, t in TEMPLATES if n == "LGPL-3.0-or-later")
    three = [t for n, t in TEMPLATES if n == "BSD-3-Clause"]
    for text, name in (
        (gnu.replace("version 3", "version 2"), "GPL-2.0-or-later"),
        (gnu.replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later"),
        (lesser.replace("version 3", "version 2.1"), "LGPL-2.1-or-later"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("Licensed under CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0"),
        (max(three, key=len), "BSD-3-Clause"),
    ):
        for around in (text, "intro words " + text + " and more words"):
            assert [h[3] for h in matcher.find(around)] == [name], (name, around)
    assert len(three) == 2 and "business interruption" in max(three, key=len).lower()


def plain_windows(words, templates, threshold):
    """All windows of words, all templates of three bigrams or more."""
    prepared = [(i, name, b) for i, (name, t) in enumerate(templates) if (b := bigrams(normal_words(t))).total() >= 3]
    found = []
    for a in range(len(words)):
        for e in range(a + 2, len(words) + 1):
            got = bigrams(words[a:e])
            found += [(-d, e - a, a, i, name) for i, name, b in prepared if (d := dice(got, b)) >= threshold - 1e-12]
    out = []
    for d, n, a, _, name in sorted(found):
        if all(a + n <= o[0] or a >= o[1] for o in out):
            out.append((a, a + n, -d, name))
    return sorted(out)


def test_windows_by_definition():
    rng = random.Random(8)
    for _ in range(120):
        vocabulary = [f"w{i}" for i in range(rng.randrange(4, 12))]
        templates = [(f"t{i}", " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(2, 9)))) for i in range(4)]
        threshold = rng.choice([0.5, 0.8, 1.0])
        words = [rng.choice([*vocabulary, "other"]).encode() for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = normal_words(rng.choice(templates)[1])
        got = LicenseMatcher(templates, threshold).windows(words)
        assert [(a, e, round(d, 9), n) for a, e, d, n in got] == [(a, e, round(d, 9), n) for a, e, d, n in plain_windows(words, templates, threshold)]


def test_find_is_runs_and_then_windows_between_them():
    matcher, rng = LicenseMatcher(), random.Random(12)
    for _ in range(40):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            notice = rng.choice([t for _, t in TEMPLATES if len(t) < 200])
            lines.append(rng.choice(["some prose and more of it", "", notice, "words before " + notice + " and after", notice.replace(" ", "\n", 1)]))
        text = "\n".join(lines)
        runs = matcher.scan(text)
        want, words, of = list(runs), [], []
        for i, line in enumerate([*text.split("\n"), None]):
            if line is None or any(a <= i < e for a, e, *_ in runs):
                want += [(of[a], of[e - 1] + 1, d, n) for a, e, d, n in plain_windows(words, TEMPLATES, 0.8)]
                words, of = [], []
            else:
                words += normal_words(line)
                of += [i] * len(normal_words(line))
        assert [(a, e, round(d, 9), n) for a, e, d, n in matcher.find(text)] == [(a, e, round(d, 9), n) for a, e, d, n in sorted(want)], text


def test_ties_go_to_the_template_listed_first():
    long, short = ("long", "a b c d x y"), ("short", "a b c d")
    words = normal_words("a b c d z")  # 3 common bigrams with both: 6 / 9 and 6 / 7
    same = [("one", "a b c q"), ("two", "a b c r")]
    for templates in (same, same[::-1]):
        assert LicenseMatcher(templates, 0.6).best(normal_words("a b c"), 3)[1] == templates[0][0]
        assert LicenseMatcher(templates, 0.6).windows(normal_words("p a b c s"))[0][3] == templates[0][0]
    # two templates of different sizes at one coefficient
    tied = [("larger", "a b c d e f"), ("smaller", "a b c")]  # of "a b c d": 2 * 3 / (3 + 5) = 0.75 and 2 * 2 / (3 + 2) = 0.8
    assert LicenseMatcher([long, short], 0.6).best(words, 4)[1] == "short" and LicenseMatcher(tied, 0.7).best(normal_words("a b c d"), 4)[1] == "smaller"
    equal = [("five", "a b c d e f"), ("four", "a b c x d")]  # of "a b c d e": 2 * 4 / 9; of the other 2 * 2 / 8
    assert LicenseMatcher(equal, 0.4).best(normal_words("a b c d e"), 5)[1] == "five"
    half = [("wide", "a b c p q r s"), ("narrow", "a b p")]  # of "a b c": 2 * 2 / (2 + 6) = 0.5 and 2 * 1 / (2 + 2) = 0.5
    for templates in (half, half[::-1]):
        assert LicenseMatcher(templates, 0.5).best(normal_words("a b c"), 3) == (0.5, templates[0][0])
