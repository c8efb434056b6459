from __future__ import annotations

import itertools
import random

from framelake.llm import licenses as li

READY = li.compiled(tuple(sorted(li.TEMPLATES.items())), 80)


def names(text):
    return [x["license"] for x in li.scan(text, READY, 80)]


def test_longest_increasing_by_brute_force():
    rng = random.Random(0)
    for _ in range(200):
        v = [rng.randrange(8) for _ in range(rng.randrange(9))]
        got = [v[i] for i in li.longest_increasing(v)]
        best = max((len(c) for n in range(len(v) + 1) for c in itertools.combinations(v, n) if all(a < b for a, b in zip(c, c[1:], strict=False))), default=0)
        assert len(got) == best and all(a < b for a, b in zip(got, got[1:], strict=False))


def test_alignment_is_ordered_and_equal():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(20))] for _ in range(2))
        m = li.align(a, b)
        assert all(a[i] == b[j] for i, j in m) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(m, m[1:], strict=False))
    assert len(li.align(list("abcdef"), list("abcdef"))) == 6


def test_found_and_not_found():
    filler = "and the of that was with these words " * 300
    for name, text in li.TEMPLATES.items():
        assert name in names(filler + text + "\n" + filler), name
    assert names(filler) == [] and names(None) == [] and names("") == [] and names("license") == []
    assert names("Licensed under CC BY-NC 4.0.") == ["cc-by-nc-4.0"] and names("Licensed under CC BY 4.0.") == ["cc-by-4.0"]


def test_repeated_notice_and_small_edits():
    assert names("Released under the MIT License. " * 50) == ["mit-line"]
    words = li.TEMPLATES["mit"].split()
    for i in range(5, len(words), 9):
        words[i] = "changed"
    got = li.scan("x y " * 50 + " ".join(words), READY, 80)
    assert [x["license"] for x in got] == ["mit"] and 0.8 <= got[0]["coverage"] < 1 and got[0]["first_word"] >= 100


def test_each_stretch_counts():
    by, nc, mit = "Licensed under CC BY 4.0", "Licensed under CC BY-NC 4.0", "Released under the MIT License"
    for far in (1, 4, 9, 40, 400):
        gap = " some words between " * far
        assert names(f"a b {nc}\n{gap}\n{by} c d") == ["cc-by-4.0", "cc-by-nc-4.0"] == names(f"a b {by}\n{gap}\n{nc} c d"), far
        assert names(f"{nc}{gap}{nc}") == ["cc-by-nc-4.0"]
        notice, line = li.TEMPLATES["apache-2.0-notice"], li.TEMPLATES["apache-2.0-line"]
        assert names(f"{notice}{gap}{notice}") == ["apache-2.0-notice"]
        assert names(f"{notice}{gap}{line}") == ["apache-2.0-line", "apache-2.0-notice"] == names(f"{line}{gap}{notice}")
    assert names(f"a {nc}. {by}. b") == ["cc-by-4.0", "cc-by-nc-4.0"] == names(f"a {by}. {nc}. b")
    got = li.scan(" ".join([nc, mit, by, mit, nc]), READY, 80)
    assert [(x["license"], x["first_word"], x["last_word"], x["coverage"]) for x in got] == [("cc-by-4.0", 11, 15, 1.0), ("cc-by-nc-4.0", 0, 5, 1.0), ("mit-line", 6, 10, 1.0)]


def test_neighbours_are_told_apart():
    for name, text in li.TEMPLATES.items():
        assert names(f"some words {text} some more") == [name], name
        assert names(f"{text}\n\n{text}") == [name], name
    assert names("Released under the BSD License") == ["bsd-line"] and names("Released under the Foo License") == []
    assert names("Licensed under CC BY 2.5") == [] and names("Licensed under CC BY-ND 4.0") == ["cc-by-nd-4.0"]
    line = "This work is licensed under the GNU General Public License"
    assert names(f"{line} v3") == names(f"{line}, version 3.0") == ["gpl-3.0-line"] and names(f"{line}, version 7") == []
    assert names(li.TEMPLATES["gpl-3.0-notice"].replace("GNU General", "GNU Other General")) == []
    assert names(li.TEMPLATES["bsd-3-clause"].replace("the copyright holder nor", "Some University nor")) == ["bsd-3-clause"]
    assert names("Licensed under the Apache License 2.0") == ["apache-2.0-line"]
    own = li.compiled((("mit-line", "These are my own words"),), 80)
    assert [x["license"] for x in li.scan("these are my own words", own, 80)] == ["mit-line"]


def test_prefilter_loses_nothing():
    """A text with the coverage has a needed word: those unmatched can't be all the needed ones."""
    for t in READY:
        held = sum(w in t.needed for w in t.words)
        assert held > len(t.words) - -(-len(t.words) * 80 // 100)


def test_column(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, li.TEMPLATES["isc"], 1), (3, li.TEMPLATES["isc"], 2)], "doc_id long, text string, licenses int")
    got = sorted((r["doc_id"], [x["license"] for x in r["licenses"]]) for r in li.scan_documents(df).collect())
    assert got == [(1, []), (2, []), (3, ["isc"]), (3, ["isc"])] and li.scan_documents(df.limit(0)).isEmpty()


def test_planted_lines(spark):
    lines = {"apache-2.0-line": "Licensed under the Apache License, Version 2.0", "mit-line": "Released under the MIT License", "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3", "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0"}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        assert names(r["text"]) == sorted(k for k, v in lines.items() if v in r["text"])
