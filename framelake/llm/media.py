"""Media columns: pages as ordered sequences of text and media references, and a store of payloads.

A sequence is an array of structs (position, kind, text, digest, caption). Media are kept in a table by
the SHA-256 digest of their payload; a join on the digest resolves references, and position and caption
stay in the struct they came with. Payloads are stored as grey PNG images of eight bits a sample.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import work

#: Samples in a row of an image, and the signature of PNG files.
WIDTH = 576
PNG = b"\x89PNG\r\n\x1a\n"

SEQUENCE = "array<struct<position:int,kind:string,text:string,digest:string,caption:string>>"

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.I | re.S)
_ATTR = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_BLOCKS = frozenset("p div h1 h2 h3 h4 h5 h6 li ul ol table tr td th blockquote pre section article figure figcaption body html br hr title".split())
_MEDIA = frozenset("img video audio source embed".split())


def sequence(page: str | None) -> list[dict]:
    """Text and media of a page in order. A figure's caption, else the alternative text, goes with its
    media; a reference is `sha256:` and the digest, any other source has a null digest and its address
    as text. Null and empty pages have no items."""
    items: list[dict] = []
    pieces: list[str] = []
    figure: list[dict] | None = None
    caption = False

    def flush() -> str:
        text = " ".join(entities.unescape("".join(pieces)).split())
        pieces.clear()
        return text

    def add(kind: str, text: str | None, digest: str | None = None, alt: str | None = None) -> None:
        items.append({"position": len(items), "kind": kind, "text": text, "digest": digest, "caption": alt})

    def end_block() -> None:
        nonlocal caption
        text = flush()
        if caption and figure is not None:
            if text:
                for x in figure:
                    x["caption"] = text
                if not figure:
                    add("text", text)
            caption = False
        elif text:
            add("text", text)

    at, page = 0, page or ""
    for m in _PIECE.finditer(page):
        pieces.append(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if tag in _BLOCKS or tag in _MEDIA:
            end_block()
        if tag == "figure":
            figure = None if m[2] else []
        elif tag == "figcaption":
            caption = not m[2]
        elif tag in _MEDIA and not m[2]:
            attrs = {a[1].lower(): entities.unescape(a[2] or a[3] or a[4] or "") for a in _ATTR.finditer(m[4])}
            if source := attrs.get("src"):
                known = source.startswith("sha256:")
                add(tag if tag in ("video", "audio") else "image", None if known else source, source[7:].lower() if known else None, attrs.get("alt"))
                if figure is not None:
                    figure.append(items[-1])
    pieces.append(page[at:])
    end_block()
    return items


def sequences(pages: DataFrame, html: str = "html", out: str = "items") -> DataFrame:
    """Adds each page's sequence; rows are independent."""

    @F.pandas_udf(SEQUENCE)
    def parse(page: pd.Series) -> pd.Series:
        return page.map(sequence, na_action=None)

    return pages.withColumn(out, parse(F.col(html)))


def payload(text: str | None) -> bytes:
    """UTF-8 and bytes 255 up to a positive multiple of WIDTH."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b"\xff" * (-len(data) % WIDTH or (0 if data else WIDTH))


def to_png(data: bytes, level: int = 6) -> bytes:
    """Lossless grey image, WIDTH samples a row, from a positive multiple of WIDTH bytes."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    filtered = np.zeros((len(rows), WIDTH + 1), np.uint8)
    filtered[:, 1:] = rows

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(filtered.tobytes(), level)) + chunk(b"IEND", b"")


def from_png(stored: bytes) -> bytes:
    """The samples of an image that to_png() made; its checksums must hold."""
    if stored[:8] != PNG:
        raise ValueError("not a PNG file")
    at, body, size = 8, [], (0, 0)
    while at < len(stored):
        (n,) = struct.unpack(">I", stored[at : at + 4])
        kind, data = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + n]
        if struct.unpack(">I", stored[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + data):
            raise ValueError("a chunk's checksum does not match")
        if kind == b"IHDR":
            size = struct.unpack(">II", data[:8])
        elif kind == b"IDAT":
            body.append(data)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(size[1], size[0] + 1)
    return rows[:, 1:].tobytes()


def feature(data: bytes) -> str:
    """A 64-bit average hash: rows are averaged, folded to 24 x 24 and averaged to 8 x 8; a bit is set
    where the cell is above the mean. Sums are whole numbers, so equal payloads agree everywhere."""
    cells = np.frombuffer(data, np.uint8).reshape(-1, WIDTH).sum(0, dtype=np.int64).reshape(8, 3, 8, 3).sum((1, 3)).ravel()
    return np.packbits(cells * cells.size > cells.sum()).tobytes().hex()


def write_store(rows: DataFrame, path: str, digest: str = "digest", media: str = "media") -> None:
    """Writes digest and stored form. A task leaves out digests it has written before, of the last 65,536;
    copies in other tasks stay, and readers take any, as equal digests have equal payloads."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, None] = {}
        for b in batches:
            keep = []
            for i, d in enumerate(b.column(0).to_pylist()):
                if d not in seen:
                    keep.append(i)
                    seen[d] = None
                    if len(seen) > 65_536:
                        seen.pop(next(iter(seen)))
            if keep:
                yield b.take(pa.array(keep))

    rows.select(digest, media).mapInArrow(first, f"{digest} string, {media} binary").write.option("compression", "none").option("parquet.block.size", str(32 << 20)).parquet(path)


def store_texts(documents: DataFrame, path: str, text: str = "text", level: int = 6) -> None:
    """Stores the payload of each whole text; null texts are empty ones."""

    @F.pandas_udf("digest string, media binary")
    def made(texts: pd.Series) -> pd.DataFrame:
        data = [payload(t) for t in texts]
        return pd.DataFrame({"digest": [hashlib.sha256(d).hexdigest() for d in data], "media": [to_png(d, level) for d in data]})

    write_store(documents.select(made(F.col(text)).alias("m")).select("m.digest", "m.media"), path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A row per digest of a store: what was read back from the stored bytes, and its feature.

    Computed where the bytes are read, so that only a few short columns are shuffled by digest. A payload
    whose digest is another than it is stored under fails the task.
    """
    kinds = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    @F.pandas_udf(kinds)
    def read(digest: pd.Series, media: pd.Series) -> pd.DataFrame:
        rows = []
        for d, stored in zip(digest, media, strict=True):
            data = from_png(stored)
            sha = hashlib.sha256(data).hexdigest()
            if sha != d:
                raise ValueError(f"{d}: the stored payload has another digest")
            rows.append((len(data), sha, zlib.crc32(data[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(data)))
        return pd.DataFrame(rows, columns=["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    stored = spark.read.schema("digest string, media binary").parquet(path)
    rows = stored.select("digest", read("digest", "media").alias("m"))
    return rows.groupBy("digest").agg(F.min("m.payload_bytes").alias("payload_bytes"), F.min("m.tail_crc32").alias("tail_crc32"), F.min("m.media_bytes").alias("media_bytes"), F.min(F.struct("m.payload_sha256", "m.media_sha256", "m.feature")).alias("m")).selectExpr(
        "digest", "payload_bytes", "m.payload_sha256", "tail_crc32", "media_bytes", "m.media_sha256", "m.feature"
    )


def flatten(documents: DataFrame, key: list[str], items: str = "items") -> DataFrame:
    """key and the item's fields, a row per item, so that position and caption stay with its reference."""
    # the outer form keeps the optimizer from parsing twice to look for empty sequences
    return documents.select(*key, F.explode_outer(items).alias("media__item")).select(*key, "media__item.*").where("position is not null")


def resolve(references: DataFrame, store: DataFrame, by: list[str]) -> DataFrame:
    """The references with the store's columns, null where it lacks their digest or they have none.

    A left join on the digest. References are written first, as they are counted; a digest that many of
    them share is dealt over several tasks by the columns `by`, which tell them apart.
    """
    flat = work.materialize(references, "references")
    uses = flat.where("digest is not null").groupBy("digest").agg(F.count(F.lit(1)).alias("media__n"))
    used = work.materialize(store.join(uses, "digest"), "used")
    return work.join_spread(flat, used, "digest", "media__n", flat.count(), ", ".join(by), "left").drop("media__n")


def gallery(texts: DataFrame, key: str = "doc_id", per_page: int = 16) -> DataFrame:
    """held, html: pages that show the media of up to `per_page` rows of `texts` (key, n_bytes, digest), one
    after the other with a line of text before and a caption under each; held has the rows' key and n_bytes
    in order, and captions are places in it. Rows of an Arrow batch share pages: no shuffle."""
    kind = texts.schema[key].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, digests = b.column(0), b.column(1), b.column(2).to_pylist()
            starts = [*range(0, b.num_rows, per_page), b.num_rows]
            held = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays([keys, sizes], ["key", "n_bytes"]))
            pages = []
            for i, j in zip(starts, starts[1:]):
                shown = "".join(f'<p>Item {k} of {j - i} &amp; its image:</p><figure><img alt="" src="sha256:{digests[i + k]}"><figcaption>{k}</figcaption></figure>' for k in range(j - i))
                pages.append(f"<article><h1>{j - i} items</h1>{shown}</article>")
            if pages:
                yield pa.RecordBatch.from_arrays([held, pa.array(pages, pa.string())], ["held", "html"])

    return texts.select(key, "n_bytes", "digest").mapInArrow(make, f"held array<struct<key:{kind},n_bytes:bigint>>, html string")


def document_media(documents: DataFrame, level: int = 6) -> DataFrame:
    """Stores every text of `documents` as media, refers to them from pages of up to 16, parses, resolves.

    doc_id, n_bytes and what read_features() has; position and caption are those of the reference, and
    the caption says which of a page's documents it stands for. A null or empty text is stored as one row
    of bytes 255; repeated rows are returned as often, equal texts share one payload; whole texts however
    long, one row of pixels for each 576 bytes. Other columns don't matter.
    """
    spark = documents.sparkSession
    path = work.new_path(spark, "media")
    store_texts(documents, path, level=level)
    padded = F.expr("rpad(coalesce(cast(text as binary), X''), cast(greatest(576, 576 * ceil(coalesce(octet_length(text), 0) / 576)) as int), X'FF')")
    texts = documents.select("doc_id", F.expr("cast(coalesce(octet_length(text), 0) as bigint)").alias("n_bytes"), F.sha2(padded, 256).alias("digest"))
    items = flatten(sequences(gallery(texts)), ["held"]).where("kind = 'image'")
    references = items.withColumn("of", F.expr("held[cast(caption as int)]")).selectExpr("of.key as doc_id", "of.n_bytes", "digest", "position", "caption")
    found = resolve(references, read_features(spark, path), ["doc_id", "position"])
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")
