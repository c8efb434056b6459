"""Queries over the tables of a folder, one for each operation, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprint, html_extract, langid, licenses, media, mixing, neardup, sharding, warc, work

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    work.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.new_path(spark, "warc")
    warc.write_archives(warc.with_revisits(table(spark, sf_dir, "pages")), path)
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).selectExpr("page_id", "url", "text", "cast(char_length(text) as bigint) as n_chars")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.selectExpr("doc_id", "size(licenses) as n_licenses", "array_join(licenses.license, ',') as licenses", "coalesce(array_max(licenses.coverage), 0D) as coverage")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    profiles = langid.learn(documents.where("not held_out"))
    return langid.predict(documents.drop("lang"), profiles).select("doc_id", "held_out", "lang_pred", "score")


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.document_media(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"), shards=8)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85, bands=20)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_html_extract": op2_html_extract,
    "op3_license_scan": op3_license_scan,
    "op4_bpe": op4_bpe,
    "op5_language_id": op5_language_id,
    "op6_media": op6_media,
    "op7_fingerprint": op7_fingerprint,
    "op8_sharding": op8_sharding,
    "op9_near_dedup": op9_near_dedup,
    "op10_mixing": op10_mixing,
}

SQL = {
    "op1_warc": """
        with p as (
            select page_id, sha256(coalesce(html, '')) as payload_digest, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes from pages
        ), q as (
            select *, min(page_id) over (partition by payload_digest) as first from p
        )
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 100 and first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 100 and page_id is distinct from first then first end as refers_to
        from q
    """,
    "op9_near_dedup": r"""
        with recursive w as (
            select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
        ), s as (
            select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from w
        ), f as (
            select doc_id, len(s) as n, unnest(s) as g from s
        ), links as (
            select a.doc_id as a, b.doc_id as b from f a join f b on a.g = b.g and a.doc_id < b.doc_id
            group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), e as (
            select a, b from links union all select b, a from links
        ), reach(doc_id, root) as (
            select doc_id, doc_id from documents
            union
            select e.b, r.root from reach r join e on e.a = r.doc_id where r.root < e.b
        ), c as (
            select doc_id, min(root) as component_id from reach group by 1
        )
        select s.doc_id, cast(len(s.s) as bigint) as n_shingles, c.component_id, s.doc_id = c.component_id as kept from s join c on c.doc_id = s.doc_id
    """,
}
