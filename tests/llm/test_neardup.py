from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import assert_same, connection

from framelake.llm import neardup as nd
from framelake.llm import queries, work


def shingles(text, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, width, percent):
    """doc -> smallest doc reachable, by comparing all pairs that share a shingle."""
    sets = [(k, shingles(t, width)) for k, t in rows]
    parent = {k: k for k, _ in rows if k is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    post = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            post[g].append(i)
    both = Counter(p for v in post.values() for p in itertools.combinations(v, 2))
    for (i, j), n in both.items():
        (a, x), (b, y) = sets[i], sets[j]
        if a is not None and b is not None and 100 * n >= percent * (len(x) + len(y) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in parent}, sets


def agree(spark, rows, width=3, percent=85, **options):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, doc string, n int")
    got = nd.near_duplicates(df, width=width, percent=percent, **options).collect()
    want, sets = brute(rows, width, percent)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((k, len(s)) for k, s in sets)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"]) and r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    return got


def family(rng, n, words, edits):
    """Copies of one text with edits of their own, which link in chains and not all with all."""
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(edits)):
            t[rng.randrange(len(t))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_families(spark):
    rng = random.Random(1)
    texts = family(rng, 120, 150, 9) + family(rng, 60, 40, 4) + [" ".join(f"z{rng.randrange(10**6)}" for _ in range(30)) for _ in range(50)]
    rng.shuffle(texts)
    got = agree(spark, list(enumerate(texts)))
    assert 20 < sum(not r["kept"] for r in got) < 200


def test_drifting_chain(spark):
    """Each text is linked with its neighbours alone, so the first reaches the last only through all."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[: 100 + 0] if i == 0 else [f"n{j}" for j in range(4 * i)] + base[4 * i :])) for i in range(12)]
    agree(spark, rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (9, "one  TWO"), (5, "one two three"), (None, "one two"), (None, None), (6, "É é"), (7, "é é"), (8, "one two"), (8, "other words here now"), (10, "OTHER words here now"), (11, "x " * 3000)]
    agree(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(empty).isEmpty() and nd.deduplicate(empty).isEmpty()


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, sets = brute(rows, 3, 85)
    size = dict(sets)
    got = queries.op9_near_dedup(spark, sf).collect()
    assert {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in got} == {(k, want[k], len(size[k])) for k in want}


def test_components_by_brute_force(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in nd.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == find(x) for x in parent)


def test_minima_estimate_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 9000).astype(np.uint64)
    a, b = nd.minima(x[:8000], 2000), nd.minima(x[1000:], 2000)
    assert abs((a == b).mean() - 7000 / 9000) < 0.04


@pytest.mark.parametrize("width", [3, 5])
def test_whole_sequence_when_short(width):
    assert len(nd.shingle_set(nd.words("a b"), width)) == 1 and not len(nd.shingle_set(nd.words(""), width))
    assert nd.shingle_set(nd.words("A b"), width) == nd.shingle_set(nd.words("a\tB"), width)


def test_dedup_keeps_columns_and_one_of_each(spark):
    rows = [(2, "a b c d e f g", "s"), (1, "a b c d e f g", "t"), (3, "other text of no kin to these", None), (None, "a b c d e f g", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = nd.deduplicate(df)
    assert got.columns == df.columns and sorted(r["source"] or "" for r in got.collect()) == ["", "t", "u"]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert_same(queries.op9_near_dedup(spark, sf), connection(sf), queries.SQL["op9_near_dedup"])


def test_least_agreement():
    """The chance of fewer equal minima than asked for, at the least similarity, is below one in 10^9."""
    from math import comb

    for samples, percent in ((80, 85), (112, 80)):
        k, p = nd.least_agreement(samples, percent), percent / 100
        chance = lambda n: sum(comb(samples, i) * p**i * (1 - p) ** (samples - i) for i in range(n))
        assert chance(k) <= 1e-9 < chance(k + 1)


def test_signatures_estimate_similarity_and_lose_nothing(spark):
    rng = np.random.default_rng(5)
    sets = []
    for i in range(60):
        base = rng.integers(0, 2**63, 400).astype(np.uint64)
        other = base.copy()
        other[: i * 2] = rng.integers(0, 2**63, i * 2).astype(np.uint64)
        sets.append((base, other))
    off = []
    for a, b in sets:
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = (nd.minima(a, 112) == nd.minima(b, 112)).mean()
        off.append(got - true)
        assert 100 * true < 80 or (nd.minima(a, 112) == nd.minima(b, 112)).sum() >= nd.least_agreement(112, 80)
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


@pytest.mark.parametrize(("width", "percent", "bands"), [(5, 80, 28), (3, 85, 20)])
def test_recall_of_links_at_the_threshold(spark, width, percent, bands):
    """Thousands of planted pairs from the threshold up: what links of them are found, each group one pair."""
    rng = np.random.default_rng(percent)
    rows, links = [], 0
    for i in range(2500):
        words = [f"w{x}" for x in rng.integers(0, 10**9, 150)]
        edited = list(words)
        for at in rng.choice(150, int(rng.integers(1, 5)), replace=False):
            edited[at] = f"e{rng.integers(0, 10**9)}"
        a, b = ({tuple(w[j : j + width]) for j in range(len(w) - width + 1)} for w in (words, edited))
        if 100 * len(a & b) >= percent * len(a | b):
            links += 1
            rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = nd.near_duplicates(df, width=width, percent=percent, bands=bands).where("not kept").count()
    assert links > 1000 and found >= 0.999 * links, (found, links)


def test_hot_postings_are_cut_into_blocks(spark, monkeypatch):
    """Lists longer than a block still give all pairs: the same components with blocks of four."""
    monkeypatch.setattr(nd, "POSTINGS", 4)
    common = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join([*common, *(f"x{i % 9}y{j}" for j in range(8 + i % 3))])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(df, width=3, percent=85, bands=20).collect()}
    assert got == brute(rows, 3, 85)[0]


def test_join_spread_equals_a_join(spark):
    rows = spark.range(5000).selectExpr("if(id % 3 = 0, null, if(id % 2 = 0, 7, id)) as k", "id as v")
    keyed = rows.where("k is not null").groupBy("k").count().withColumnRenamed("count", "n")
    for how in ("inner", "left"):
        got = work.join_spread(rows, keyed, "k", "n", 5000, "v", how)
        assert sorted(got.select("k", "v", "n").collect(), key=str) == sorted(rows.join(keyed, "k", how).select("k", "v", "n").collect(), key=str)
