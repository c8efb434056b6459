from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
import zstandard
from compare import assert_same, connection

from framelake.llm import queries, warc

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, payload string, n int"
BIG = "<p>" + "same words again and again " * 10 + "</p>"


def pages(spark):
    rows = [(5, "http://a/x%20\r\ny", BIG), (3, "http://b", BIG), (9, None, BIG), (None, "http://d", BIG), (1, "http://e", "short"), (2, "http://f", "short"), (7, "u", None), (8, "u", ""), (3, "http://b", BIG), (11, "é", "é" * 50), (12, "é", "é" * 50), (13, "é", "é" * 49), (14, "é", "é" * 49)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)


def round_trip(spark, df, tmp_path, **options):
    path = f"file://{tmp_path}/archives"
    warc.write_archives(warc.with_revisits(df), path, **options)
    return warc.read_archives(spark, path)


def test_revisits(spark, tmp_path):
    got = round_trip(spark, pages(spark), tmp_path).collect()
    assert len(got) == 13
    rows = {(r["page_id"], r["url"]): r for r in got}
    assert rows[5, "http://a/x%20\r\ny"]["refers_to"] == 3 and rows[9, None]["refers_to"] == 3 and rows[None, "http://d"]["refers_to"] == 3
    assert [r["record_type"] for r in got if r["page_id"] == 3] == ["response", "response"]
    assert all(r["record_type"] == "response" for r in got if r["page_id"] in (1, 2, 7, 8, 13, 14)) and rows[12, "é"]["refers_to"] == 11
    for r in got:
        if r["payload"] is not None:
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"]
    assert rows[7, "u"]["payload_bytes"] == 0 and rows[9, None]["payload"] is None and rows[9, None]["payload_bytes"] == len(BIG)


def test_dictionary_and_frames(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html><body><p>page {i * 7919} of the same site with the same words</p></body></html>" * 4) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = round_trip(spark, df, tmp_path, archive_bytes=100_000, sample_bytes=20_000, dictionary_bytes=4096)
    assert {r["page_id"]: r["payload"].decode() for r in got.collect()} == {r[0]: r[2] for r in rows}
    files = list(Path(tmp_path, "archives").rglob("part-*"))
    assert len(files) > 1
    for f in files:
        data = f.read_bytes()
        assert data[:4] == warc.DICTIONARY_MAGIC
        n = int.from_bytes(data[4:8], "little")
        learned = zstandard.ZstdCompressionDict(zstandard.decompress(data[8 : 8 + n]))
        assert learned.dict_id()
        assert len(data) < sum(len(b) for _, b in warc.records(data)) / 3
        # each record is a frame of its own: one alone can be read under the dictionary
        d = zstandard.ZstdDecompressor(dict_data=learned).decompressobj()
        at = data.index(b"\x28\xb5\x2f\xfd", 8 + n)
        assert d.decompress(data[at:]).startswith(b"WARC/1.1") and d.unused_data.startswith(b"P*M\x18")


@pytest.mark.parametrize("longs", [[0], [0, 1, 2, 3, 4], list(range(30)), "alone"])
def test_long_records_have_a_dictionary(spark, tmp_path, longs):
    text = lambda i, n: "".join(f"<p>page {j * 7919 + i} of the same site with the same words</p>" for j in range(n))
    count = 3 if longs == "alone" else 40
    rows = [(i, f"http://h/{i}", text(i, 2000 if longs == "alone" or i in longs else 3)) for i in range(count)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = round_trip(spark, df, tmp_path, sample_bytes=50_000, dictionary_bytes=4096)
    assert {r["page_id"]: r["payload"].decode() for r in got.collect()} == {r[0]: r[2] for r in rows}
    files = list(Path(tmp_path, "archives").rglob("part-*"))
    assert files and all(f.read_bytes()[:4] == warc.DICTIONARY_MAGIC for f in files)


@pytest.mark.parametrize("parts", [1, 40, 400])
def test_every_archive_has_a_dictionary(spark, tmp_path, parts):
    """However the rows are dealt: 40 tasks have a few rows each, 400 one or none."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(200).repartition(parts)
    got = {r["page_id"]: r["payload"] for r in round_trip(spark, df, tmp_path).collect()}
    assert got == {r["page_id"]: (r["html"] or "").encode() for r in df.collect()}
    files = [f.read_bytes() for f in Path(tmp_path, "archives").rglob("part-*")]
    assert len(files) >= min(parts, 100) and all(d[:4] == warc.DICTIONARY_MAGIC for d in files)


def test_record_longer_than_an_archive(spark, tmp_path):
    rows = [(1, "u", "first words " * 5000), (2, "u", "x"), (3, "u", "other words " * 9000), (4, "u", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = round_trip(spark, df, tmp_path, archive_bytes=1000).collect()
    assert {r["page_id"]: r["payload"].decode() for r in got} == {r[0]: r[2] or "" for r in rows} and len({r["archive"] for r in got}) > 1


def test_damage_is_noticed(spark, tmp_path):
    one = warc.record(1, "u", b"x" * 10, "0" * 64, None, "2026-01-01T00:00:00Z")
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "part-0").write_bytes(zstandard.compress(one))
    with pytest.raises(Exception, match="does not match"):
        warc.read_archives(spark, f"file://{folder}").collect()


def test_empty(spark, tmp_path):
    assert round_trip(spark, pages(spark).limit(0), tmp_path).isEmpty()


def test_sql(spark):
    assert_same(queries.op1_warc(spark, SF), connection(SF), queries.SQL["op1_warc"])
