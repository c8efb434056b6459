from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np

from framelake.llm import fingerprint as fp
from framelake.llm import queries


def bag(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def edited(rows):
    """doc_id, text in order -> edited texts."""
    out = []
    for i, (_, t) in enumerate(rows):
        nxt, m = rows[(i + 1) % len(rows)][1], len(t) // 4
        out.append(t[: len(t) - m] + nxt[:m])
    return out


def test_documents_by_hand(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in queries.op7_fingerprint(spark, sf).collect()}
    near, far, prints = [], [], {}
    for i, ((k, t), e) in enumerate(zip(rows, edited(rows), strict=True)):
        r = got[k]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        near.append(r["near_edited"] - jaccard(bag(t), bag(e)))
        far.append(r["near_next"] - jaccard(bag(t), bag(rows[(i + 1) % len(rows)][1])))
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
    # 48 samples: a standard deviation of 0.07 at most for one document
    assert abs(np.mean(near)) < 0.02 and np.std(near) < 0.09 and abs(np.mean(far)) < 0.02


def test_fingerprints_have_64_samples(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "d e")], "doc_id long, text string")
    assert all(len(r["fingerprint"]) == len(r["edited_fingerprint"]) == 64 * 8 for r in fp.edited_fingerprints(df).collect())
    assert all(len(r["signature"]) == 64 for r in fp.signatures(df, ["doc_id"]).collect())


def test_edges(spark):
    rows = [(3, "a b c d e f g h"), (1, None), (2, ""), (4, "a b c d e f g h"), (4, "a b c d e f g h"), (4, "other"), (None, "x"), (9, "é\té é\n" * 7), (10, "w" * 5000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string")
    got = fp.edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    empty = [r for r in got if r["doc_id"] in (1, 2)]
    assert all(r["fingerprint"] == "" and r["n_chars"] == 0 and r["near_edited"] == 1.0 for r in empty)
    order = sorted({(k is not None, k or 0, hashlib.sha256((t or "").encode()).hexdigest(), t or "") for k, t in rows})
    want = Counter((k if has else None, hashlib.sha256(e.encode()).hexdigest()) for (has, k, _, _), e in zip(order, edited([(o[1], o[3]) for o in order]), strict=True))
    assert set(want) == {(r["doc_id"], r["edited_sha256"]) for r in got}
    same = {r["fingerprint"] for r in got if r["doc_id"] in (3,)} | {r["fingerprint"] for r in got if r["doc_id"] == 4 and r["n_chars"] == 15}
    assert len(same) == 1
    assert fp.edited_fingerprints(df.limit(0)).isEmpty() and fp.edited_fingerprints(df.where("doc_id = 3")).count() == 1


def test_collision_rate_is_generalised_jaccard(spark):
    """Many samples on two weighted sets, so that the rate is known to a hundredth."""
    a, b = "x " * 9 + "y " * 3 + "z " * 4, "x " * 3 + "y " * 5 + "q " * 2
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    s = {r["doc_id"]: r["signature"] for r in fp.signatures(df, ["doc_id"], samples=4096).collect()}
    rate = np.mean(np.array(s[1]) == np.array(s[2]))
    assert abs(rate - jaccard(bag(a), bag(b))) < 0.03


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = fp.edited_fingerprints(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
