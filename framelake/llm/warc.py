"""WARC archives compressed record by record under a trained Zstandard dictionary.

An archive is a `.warc.zst` file: a leading skippable frame (magic 0x184D2A5D) holds the dictionary,
itself compressed where that is shorter, then each record is a Zstandard frame of its own. Spark's text writer stores the frames; its line
separator is an empty skippable frame, which every Zstandard reader passes over, so the files need no
file system but the one Spark writes to, and its committer keeps a retried task from leaving halves.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import work

#: Fixed values of the two formats.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
EMPTY_FRAME = "P*M\x18\0\0\0\0"  # magic 0x184D2A50, length 0
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records or pieces of them that a dictionary is learned from, at least.
LEAST_SAMPLES = 8
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

READ_SCHEMA = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary, archive string"


def with_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url", min_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to of each row.

    Among payloads of at least `min_bytes` that are equal, the smallest page_id is the response; others
    refer to it. Null html is an empty payload. Rows that share the smallest page_id are all responses;
    a group without any page_id holds responses only; a null page_id beside others revisits.
    Only digests that occur twice or more take part in the join, and its skew is left to AQE.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("payload_digest", F.sha2("payload", 256))
    firsts = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .drop("n")
    )
    return rows.join(firsts, "payload_digest", "left").withColumn("refers_to", F.expr("case when first is null or page_id <=> first then null else first end")).drop("first")


def _name(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    revisit = refers_to is not None
    body = HTTP_HEAD if revisit else HTTP_HEAD + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def pieces(held: list[bytes], sample_bytes: int, dictionary_bytes: int) -> list[bytes]:
    """What a dictionary is learned from: an even share of `sample_bytes` from each record, whole records where they
    fit. Fewer than LEAST_SAMPLES are cut, but not if all are too short to be worth a dictionary."""
    if len(held) >= LEAST_SAMPLES and sum(map(len, held)) < 2 * sample_bytes:
        return held
    share = max(1, sample_bytes // max(1, len(held)))
    used = [one[:share] for one in held]
    size = sum(map(len, used))
    if len(held) >= LEAST_SAMPLES or size < LEAST_SAMPLES * dictionary_bytes:
        return used
    step = size // (2 * LEAST_SAMPLES)
    return [one[i : i + step] for one in used for i in range(0, len(one), step)]


def train(samples: list[bytes], dictionary_bytes: int) -> zstandard.ZstdCompressionDict:
    """A dictionary learned from samples; of fewer, shorter or more uniform ones than the trainer takes, their
    own bytes, the last `dictionary_bytes` of them. Every archive has one, however its rows are dealt."""
    if len(samples) >= LEAST_SAMPLES:
        try:
            return zstandard.train_dictionary(dictionary_bytes, samples, k=256, d=8)
        except zstandard.ZstdError:  # what the trainer says of samples it can't learn from
            pass
    return zstandard.ZstdCompressionDict(b"".join(samples)[-dictionary_bytes:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def dictionary_frame(learned: zstandard.ZstdCompressionDict) -> bytes:
    data = learned.as_bytes()
    short = zstandard.compress(data, 19)
    data = short if len(short) < len(data) or data[:4] == ZSTD_MAGIC else data
    return DICTIONARY_MAGIC + struct.pack("<I", len(data)) + data


def write_archives(rows: DataFrame, path: str, archive_bytes: int = 32 << 20, sample_bytes: int = 1 << 20, dictionary_bytes: int = 32 << 10, level: int = 5, date: str = "2026-01-01T00:00:00Z") -> None:
    """Writes with_revisits() rows to archives under `path`.

    A task begins a new archive once `archive_bytes` of records went into one, so an archive, and what
    reads it, stays bounded. The dictionary is trained on the records that open the archive, `sample_bytes`
    of them and LEAST_SAMPLES records, of long ones on a part (see pieces(), train()); all records are compressed with it. A record longer than the bound has
    an archive as long as itself. An empty table writes no archive.
    """

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        count, raw, seq, held, held_bytes, squeeze = 0, 0, 0, [], 0, None
        out: list[tuple[int, int, bytes]] = []

        def begin() -> None:
            nonlocal squeeze, seq, held, held_bytes
            learned = train(pieces(held, sample_bytes, dictionary_bytes), dictionary_bytes)
            squeeze = zstandard.ZstdCompressor(level=level, dict_data=learned, write_checksum=True)
            out.append((task * 1_000_000 + count, 0, dictionary_frame(learned)))
            for one in held:
                seq += 1
                out.append((task * 1_000_000 + count, seq, squeeze.compress(one)))
            held, held_bytes = [], 0

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["archive", "seq", "frame"])
            out.clear()
            return made

        for b in batches:
            for i in range(b.num_rows):
                one = record(*(b.column(k)[i].as_py() for k in range(5)), date)
                raw += len(one)
                if squeeze is None:
                    held.append(one)
                    held_bytes += len(one)
                    if held_bytes >= sample_bytes and len(held) >= LEAST_SAMPLES:
                        begin()
                else:
                    seq += 1
                    out.append((task * 1_000_000 + count, seq, squeeze.compress(one)))
                if raw >= archive_bytes:
                    if squeeze is None:
                        begin()
                    count, raw, seq, squeeze = count + 1, 0, 0, None
            if out:
                yield batch()
        if held:
            begin()
        if out:
            yield batch()

    (
        rows.select("page_id", "url", "payload", "payload_digest", "refers_to")
        .mapInArrow(frames, "archive long, seq long, frame binary")
        .sortWithinPartitions("archive", "seq")
        .select("archive", F.col("frame").cast("string").alias("value"))
        .write.partitionBy("archive")
        .option("lineSep", EMPTY_FRAME)
        .text(path)
    )


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and HTTP body of each record of an archive, in order."""
    learned = None
    if archive[:4] == DICTIONARY_MAGIC:
        (n,) = struct.unpack("<I", archive[4:8])
        data = archive[8 : 8 + n]
        learned = zstandard.ZstdCompressionDict(zstandard.decompress(data) if data[:4] == ZSTD_MAGIC else data)
    with zstandard.ZstdDecompressor(dict_data=learned).stream_reader(archive, read_across_frames=True) as stream:
        data = stream.read()
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
        body = data[end + 4 : end + 4 + int(head["Content-Length"])]
        at = end + 4 + len(body) + 4
        yield head, body


def _number(name: str | None) -> int | None:
    return None if name in (None, "<urn:page:none>") else int(name[len("<urn:page:") : -1])


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """READ_SCHEMA rows of all archives under `path`; payload is null for revisits, or if not asked for.

    The digest and length of a response are taken from the bytes read back and must match the header;
    a mismatch fails the task.
    """
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("archive", pa.string())]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                name, rows = b.column(0)[i].as_py(), []
                for head, body in records(b.column(1)[i].as_py()):
                    digest, size, payload = head["WARC-Payload-Digest"][len("sha256:") :], int(head["X-Payload-Length"]), None
                    if head["WARC-Type"] == "response":
                        payload = body[len(HTTP_HEAD) :]
                        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                            raise ValueError(f"{name}: a record's payload does not match its digest")
                    url = head.get("WARC-Target-URI")
                    url = None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    rows.append((_number(head["WARC-Record-ID"]), url, head["WARC-Type"], digest, size, _number(head.get("WARC-Refers-To")), payload if payloads else None, name))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields, strict=True)], [n for n, _ in fields])

    found = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return found.select("path", "content").mapInArrow(parse, READ_SCHEMA)
