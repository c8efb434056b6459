"""A training corpus from `documents`: identify languages, drop near-duplicates, mix sources, tokenize.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Whatever other
columns docs has pass through the first three.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import bpe, langid, mixing, neardup, queries, work


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with letters whose text is near one of the languages learned from docs' labels.

    Null, empty and letterless texts go, as do those that share next to nothing with any profile. Rows are
    judged alone: repeated rows stay or go together. Where no row has a label, no language is known and
    all rows go; an empty table stays empty.
    """
    profiles = langid.learn(docs)
    judged = docs.withColumnsRenamed({c: f"given__{c}" for c in ("lang_pred", "score") if c in docs.columns})
    kept = langid.accept(langid.predict(judged, profiles))
    return kept.select([F.col(f"given__{c}").alias(c) if c in ("lang_pred", "score") else c for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component at five words and a similarity of 0.8, that of the smallest doc_id.

    Documents without words are linked with nothing and stay, as do rows without a doc_id; rows that
    repeat a doc_id stay or go together.
    """
    return neardup.deduplicate(docs, width=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their targets; none more than three times.

    A null source is a source like any other. Documents without words have size 0 and go along as often as
    their source's whole passes; rows that repeat a doc_id share what it takes.
    """
    return mixing.apply_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row that the mix holds; a null or empty text has no
    tokens, and digests of nothing."""
    return bpe.digests(docs.select("doc_id", "text"), queries.TOKENIZER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("tokenize", tokenize),
]

#: Profiles, components and the automaton are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet and read again but the last; what a stage
    has read is deleted once the next one's rows are written."""
    docs = queries.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return made
        made = work.materialize(made, f"stage-{name}")
        work.release(docs)
        docs = made
    return docs
