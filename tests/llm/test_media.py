from __future__ import annotations

import hashlib
import html
import io
import re
import zlib

import pytest

from framelake.llm import media


def test_sequences():
    page = '<h1>A</h1><p>one <img src="sha256:AB" alt="x">two</p><figure><img src=\'sha256:cd\'><figcaption>cap &amp; tion</figcaption></figure><video src=http://v></video><script>"<p>"</script><p>end'
    got = media.sequence(page)
    assert [(x["kind"], x["text"], x["digest"], x["caption"]) for x in got] == [
        ("text", "A", None, None), ("text", "one", None, None), ("image", None, "ab", "x"), ("text", "two", None, None), ("image", None, "cd", "cap & tion"), ("video", "http://v", None, None), ("text", "end", None, None)
    ]
    assert [x["position"] for x in got] == list(range(7)) and media.sequence(None) == [] and media.sequence("") == []


@pytest.mark.parametrize("text", [None, "", "a", "é" * 288, "x" * 577, "z" * 100_000])
def test_lossless(text):
    data = media.payload(text)
    raw = (text or "").encode()
    assert len(data) % 576 == 0 and len(data) > 0 and data.startswith(raw) and set(data[len(raw) :]) <= {255}
    stored = media.to_png(data)
    assert media.from_png(stored) == data
    with pytest.raises(ValueError):
        media.from_png(stored[:-20] + bytes([stored[-20] ^ 1]) + stored[-19:])


def test_png_is_a_png():
    data = media.payload("x" * 2000)
    image = pytest.importorskip("PIL.Image").open(io.BytesIO(media.to_png(data)))
    assert image.size == (576, 4) and image.tobytes() == data


def test_resolution_keeps_positions(spark):
    pages = spark.createDataFrame([(1, "<p>t</p><img src='sha256:aa' alt='A'><img src='sha256:bb'>"), (2, "<img src='sha256:aa'>"), (3, None)], "page_id long, html string")
    store = spark.createDataFrame([("aa", b"x")], "digest string, media binary")
    got = sorted((r["page_id"], r["position"], r["caption"], None if r["media"] is None else bytes(r["media"])) for r in media.resolve(media.flatten(media.sequences(pages), ["page_id"]), store, ["page_id", "position"]).collect())
    assert got == [(1, 0, None, None), (1, 1, "A", b"x"), (1, 2, None, None), (2, 0, None, b"x")]


def stored(data):
    """The stored form by hand: a PNG of grey samples, 576 a row, none filtered."""
    body = zlib.compress(b"".join(b"\0" + data[i : i + 576] for i in range(0, len(data), 576)), 6)
    out = bytes([0x89]) + b"PNG\r\n\x1a\n"
    for kind, content in ((b"IHDR", (576).to_bytes(4, "big") + (len(data) // 576).to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])), (b"IDAT", body), (b"IEND", b"")):
        out += len(content).to_bytes(4, "big") + kind + content + zlib.crc32(kind + content).to_bytes(4, "big")
    return out


def average_hash(data):
    """The feature by hand: columns of the image fall into 64 cells of 9 samples each."""
    cells = [0] * 64
    for i, x in enumerate(data):
        column = i % 576
        cells[column // 24 // 3 * 8 + column % 24 // 3] += x
    mean = sum(cells) / 64
    return f"{int(''.join('1' if c > mean else '0' for c in cells), 2):016x}"


def expected(text):
    data = (text or "").encode()
    data += b"\xff" * (max(1, -(-len(data) // 576)) * 576 - len(data))
    png = stored(data)
    return (len((text or "").encode()), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(png), hashlib.sha256(png).hexdigest(), average_hash(data))


COLUMNS = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def test_documents(spark):
    rows = [(1, "abc"), (2, None), (3, ""), (4, "x" * 576), (5, "abc"), (None, "é" * 300), (5, "abc"), (6, "long " * 500_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, media string, digest int")
    got = media.document_media(df).collect()
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(d) for d, _ in rows)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == expected(dict(rows)[r["doc_id"]])
    assert media.document_media(df.limit(0)).isEmpty()


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in media.document_media(table).collect()}
    rows = table.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert tuple(got[r["doc_id"]][c] for c in COLUMNS) == expected(r["text"])
    # a page has a heading, then a line of text and an image of each document it shows
    assert {(r["position"], r["caption"]) for r in got.values()} <= {(2 * k + 2, str(k)) for k in range(16)} and len({r["caption"] for r in got.values()}) == 16


def test_hot_digest_is_dealt_over_tasks(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(3000)]
    got = media.document_media(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert sorted((r["doc_id"], r["n_bytes"]) for r in got.collect()) == sorted((i, len(t)) for i, t in rows)


def test_pages_as_sequences(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        items = media.sequence(r["html"])
        assert [x["position"] for x in items] == list(range(len(items)))
        bare = re.sub(r"<!--.*?-->|<(script|style).*?</\1>", "", r["html"], flags=re.S)
        pieces = re.split(r"</?(?:p|h1|ul|li|div|article|footer|nav|body|html|title|head|meta|br)\b[^>]*>", re.sub(r"</?(?:a|b|nav|article|footer|head|meta)\b[^>]*>", lambda m: "" if re.match(r"</?(?:a|b)\b", m[0]) else "\n" * ("article" in m[0]) + " ", bare))
        assert "".join(x["text"] for x in items if x["kind"] == "text").replace(" ", "") == "".join("".join(html.unescape(x).split()) for x in pieces)
