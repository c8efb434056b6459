from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from framelake.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op5_language_id(spark, SF).collect()
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def by_hand(text):
    """n-grams of a text by plain Python: tuples of letters, None for a space."""
    code = [None]
    for c in text or "":
        x = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else None
        if x or code[-1]:
            code.append(x)
    if code[-1]:
        code.append(None)
    out = Counter()
    for i, c in enumerate(code):
        if c:
            out[c,] += 1
        if i + 1 < len(code):
            out[c, code[i + 1]] += 1
        if i + 2 < len(code) and code[i + 1]:
            out[c, code[i + 1], code[i + 2]] += 1
    return out


def number(gram):
    """Code points as digits of base 2^21; 1 for a space."""
    key = 0
    for c in gram:
        key = key * 2**21 + (ord(c) if c else 1)
    return key


def ranked_by_hand(counts, top):
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:top]


def test_grams_and_ranks():
    for text in ("The tea, Tea  to ION!", "é", "a", "x1y", "İstanbul ß", "日本 語"):
        want = by_hand(text)
        assert langid.counted(text) == {number(g): n for g, n in want.items()}
        keys, counts = np.unique(langid.grams(text), return_counts=True)
        order = [number(g) for g in ranked_by_hand(want, 500)]
        assert langid.ranked(keys, counts, 5).tolist() == order[:5] and langid.ranked(keys, counts, 500).tolist() == order
    assert not len(langid.grams("12 ,.")) and not langid.counted(None)


def test_learning_and_prediction_by_hand(spark):
    """Profiles of a whole table's labelled texts, and all predictions, by plain counting."""
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect() if r["text"]]
    learned = [r for r in rows if r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = langid.learn(df.where(~langid.held_out()), top=100)
    profiles = {}
    for r in learned:
        profiles.setdefault(r["lang"], Counter()).update(by_hand(r["text"]))
    profiles = {x: ranked_by_hand(c, 100) for x, c in profiles.items()}
    assert p.langs == sorted(profiles)
    for i, x in enumerate(p.langs):
        assert [int(p.keys[j]) for j in np.argsort(p.ranks[:, i], kind="stable")[: len(profiles[x])]] == [number(g) for g in profiles[x]]
    places = {x: {g: i for i, g in enumerate(v)} for x, v in profiles.items()}
    for r in rows:
        mine = ranked_by_hand(by_hand(r["text"]), 100)
        if mine:
            far = {x: sum(abs(v[g] - i) if g in v else 100 for i, g in enumerate(mine)) for x, v in places.items()}
            best = min(sorted(far), key=far.__getitem__)
            got = p.predict(r["text"])
            assert got[0] == best and abs(got[1] - (1 - far[best] / (100 * len(mine)))) < 1e-12


def test_sample_is_by_hash_of_the_key(spark):
    """With more labelled rows than asked for, the rows of the smallest hashes teach, whatever their text."""
    df = spark.range(4000).selectExpr("id as doc_id", "concat('w', id, ' common') as text", "'en' as lang")
    p = langid.learn(df, docs_per_lang=100)
    assert 0 < len(p.keys) and p.predict("common")[1] > 0.3


def test_distance_by_hand(spark):
    df = spark.createDataFrame([(1, "aba aba", "x"), (2, "cdc dcd", "y"), (3, None, "x"), (4, "zz", None)], "doc_id long, text string, lang string")
    p = langid.learn(df, top=20)
    assert p.langs == ["x", "y"]
    for text in ("abab", "cd", "ab cd", "zz"):
        want = []
        for i in range(2):
            ranks = {int(k): int(r) for k, r in zip(p.keys, p.ranks[:, i], strict=True) if r < p.top}
            mine = [number(g) for g in ranked_by_hand(by_hand(text), 20)]
            want.append(sum(abs(ranks[k] - j) if k in ranks else p.top for j, k in enumerate(mine)) / (p.top * len(mine)))
        lang, score = p.predict(text)
        assert lang == p.langs[int(np.argmin(want))] and abs(score - (1 - min(want))) < 1e-12


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score string, source string"
    df = spark.createDataFrame([(1, "the cat and the dog", "en", "s", None), (2, "le chat et le chien", "fr", "s", None), (None, None, None, "s", None), (4, "12 !?", "en", "s", None), (5, "", "fr", "s", None), (1, "the cat and the dog", "en", "s", None)], schema)
    got = langid.predict(df, langid.learn(df))
    rows = [(r["doc_id"], r["lang_pred"]) for r in got.collect()]
    assert sorted(rows, key=str) == sorted([(1, "en"), (2, "fr"), (None, "und"), (4, "und"), (5, "und"), (1, "en")], key=str)
    assert {r["doc_id"] for r in langid.accept(got).collect()} == {1, 2}
    nothing = langid.learn(df.limit(0))
    assert nothing.predict("the cat") == ("und", 0.0) and langid.predict(df.limit(0), nothing).isEmpty()
    assert df.select(langid.held_out()).count() == 6


def test_long_text_is_read_whole(spark):
    df = spark.createDataFrame([(1, "the cat and the dog " * 50, "en"), (2, "le chat et le chien " * 50, "fr")], "doc_id long, text string, lang string")
    p = langid.learn(df)
    assert p.predict("12, " * 200_000 + "le chat et le chien")[0] == "fr"


def test_many_letters_stay_apart(spark):
    """Two small languages of different scripts beside one with more letters than a byte can number."""
    han = "".join(chr(0x4E00 + i) for i in range(600))
    scripts = {"han": han * 20, "ka": "აბგ დე " * 5, "hy": "աբգ դե " * 5}
    df = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(scripts.items())], "doc_id long, text string, lang string")
    p = langid.learn(df)
    for x, t in scripts.items():
        lang, score = p.predict(t)
        assert lang == x and score == 1.0, x
    for x, t in (("ka", "დე აბგ"), ("hy", "դե աբգ")):
        assert p.predict(t)[0] == x


def test_sampled_texts_are_counted_whole(spark):
    df = spark.createDataFrame([(1, "a " * 15_000 + "zyx " * 15_000, "x")], "doc_id long, text string, lang string")
    assert langid.learn(df).predict("zyx")[1] > 0.5
