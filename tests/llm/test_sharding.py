from __future__ import annotations

import zlib

import numpy as np
import pytest

from framelake.llm import queries, sharding, work


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 255, 1000, 65537])
def test_permutation(total):
    p = sharding.permute(np.arange(total), total, seed=3)
    assert sorted(p.tolist()) == list(range(total)) and (p == sharding.permute(np.arange(total), total, seed=3)).all()
    if total > 200:
        assert (p != sharding.permute(np.arange(total), total, seed=4)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(total), p)[0, 1]) < 0.2


def test_one_number_by_hand():
    """Each number alone gives what it gives among the others."""
    p = sharding.permute(np.arange(100), 100)
    assert [int(sharding.permute(np.array([i]), 100)[0]) for i in range(100)] == p.tolist()


def test_row_numbers(spark):
    df = spark.createDataFrame([(x,) for x in [5, 3, None, 3, 9, 1, None]], "k long").repartition(3)
    got, total = work.with_row_numbers(df, ["k"], "rn")
    rows = sorted((r["rn"], r["k"]) for r in got.collect())
    assert total == 7 and [r[0] for r in rows] == list(range(7)) and [r[1] for r in rows] == [None, None, 1, 3, 3, 5, 9]


def check(rows, shards=8):
    slots = {}
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(i, [])) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op8_sharding(spark, sf).collect()
    check(rows)
    assert len(rows) == len(text) and all(r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in rows)
    assert {tuple(r) for r in rows} == {tuple(r) for r in queries.op8_sharding(spark, sf).collect()}


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 7), (None, "", 7), (2, "é", 7), (2, "é", 7)], "doc_id long, text string, slot int")
    rows = sharding.document_shards(df).collect()
    check(rows)
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == [(0, 1, 0), (1, 1, 0), (2, 3, zlib.crc32("é".encode())), (2, 3, zlib.crc32("é".encode()))]
    assert sharding.document_shards(df.limit(0)).isEmpty()
