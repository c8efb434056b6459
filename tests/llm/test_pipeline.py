from __future__ import annotations

import importlib.util
from collections import Counter

import numpy as np
import pytest
from test_mixing import words
from test_neardup import brute
from tokenizers import Tokenizer

from framelake.llm import langid, mixing, queries, work

pytestmark = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="the pipeline goes with this folder")

SF = "/root/testdata/sf0.001"


def test_stages_and_run_by_brute_force(spark):
    import corpus_pipeline as cp

    docs = queries.table(spark, SF, "documents")
    outs = []
    for i, (_, stage) in enumerate(cp.STAGES):
        docs = work.materialize(stage(spark, docs, SF), f"t{i}")
        outs.append(docs)
    first = queries.table(spark, SF, "documents").collect()
    columns = queries.table(spark, SF, "documents").columns
    assert all(o.columns == columns for o in outs[:-1])

    profiles = langid.learn(queries.table(spark, SF, "documents"))
    named = [r for r in first if (p := profiles.predict(r["text"]))[0] != "und" and p[1] >= 0.2]
    assert sorted(outs[0].collect()) == sorted(named) and len(named) == len(first)  # all of these have a language

    of, _ = brute([(r["doc_id"], r["text"]) for r in named], 5, 80)
    kept = [r for r in named if of[r["doc_id"]] == r["doc_id"]]
    assert sorted(outs[1].collect()) == sorted(kept) and len(kept) < len(named)

    sizes = Counter()
    for r in kept:
        sizes[r["source"]] += words(r["text"])
    goal = mixing.targets(list(sizes.items()))
    mixed = outs[2].collect()
    got, longest = Counter(), Counter()
    for r in mixed:
        got[r["source"]] += words(r["text"])
        longest[r["source"]] = max(longest[r["source"]], words(r["text"]))
    most = max(words(r["text"]) for r in kept)
    assert all(-1 <= goal[s] - got[s] <= most for s in sizes) and max(Counter(r["doc_id"] for r in mixed).values()) <= 3

    t = Tokenizer.from_file(queries.TOKENIZER)
    t.no_truncation()
    t.no_padding()
    want = Counter((r["doc_id"], len(t.encode(r["text"], add_special_tokens=False).ids)) for r in mixed)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in outs[3].collect()) == want
    assert sorted(cp.run(spark, SF).collect()) == sorted(outs[3].collect())


def test_rejects_and_edges(spark):
    import corpus_pipeline as cp

    rows = [(i, f"the cat and the dog of the house number {'abcdefgh'[i]} " * 3, "en", f"s{i % 2}", 1) for i in range(8)]
    rows += [(20, None, "en", "s0", 0), (21, "123 !!", "en", None, 6), (22, "", None, "s1", 0), (None, "the cat and a null", "en", "s1", 3), (3, rows[3][1], "en", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    a = cp.language_id(spark, docs, SF)
    assert {r["doc_id"] for r in a.collect()} == {*range(8), None}
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).isEmpty()
    b = cp.near_dedup(spark, docs, SF)
    assert {r["doc_id"] for r in b.collect()} >= {20, 21, 22, None}
    assert np.isfinite(cp.source_mix(spark, docs, SF).count()) and cp.tokenize(spark, docs, SF).count() == len(rows)
