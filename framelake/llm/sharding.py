"""Shards by a Feistel permutation of row numbers.

A balanced Feistel network permutes 0 .. 4^b - 1, the smallest such range that holds all rows; cycle
walking applies it again until the value is below the row count, which makes it a permutation of the
row numbers. Shard and slot of a row follow from its number, the count and the seed alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import work

#: The multipliers of the 64-bit finalizer of MurmurHash3.
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    for m in MIX:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def permute(numbers: np.ndarray, total: int, seed: int = 0, rounds: int = 6) -> np.ndarray:
    """Where each row number goes; a permutation of 0 .. total - 1 that total and seed determine."""
    half = max(1, ((max(total - 1, 1)).bit_length() + 1) // 2)
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & (2**64 - 1)))
    out = numbers.astype(np.uint64)
    walking = np.ones(len(out), bool)
    with np.errstate(over="ignore"):
        while walking.any():
            left, right = out[walking] >> width, out[walking] & mask
            for k in keys:
                left, right = right, left ^ (_mix(right + k) & mask)
            out[walking] = left << width | right
            walking = out >= total
    return out.astype(np.int64)


def assign(df: DataFrame, order: list[str], shards: int = 8, seed: int = 0) -> DataFrame:
    """Adds row_number, shard and slot: shards differ by one row at most, slots have no gap.

    `order` fixes the row numbers, nulls first; rows alike in it may swap places. The range exchange
    carries the columns given, so select what is needed. Columns of these names are replaced.
    An empty table gives an empty result.
    """
    numbered, total = work.with_row_numbers(df.drop("row_number", "shard", "slot"), order, "row_number")

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for numbers in batches:
            yield pd.Series(permute(numbers.to_numpy(), total, seed))

    return numbered.withColumn("shard__place", place("row_number")).withColumns({"shard": F.expr(f"cast(shard__place % {shards} as int)"), "slot": F.expr(f"shard__place div {shards}")}).drop("shard__place")


def document_shards(documents: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law (`rows`), shard, slot, grown_shard (null) of each document.

    Size is the text's UTF-8 bytes plus one, 1 for a null text. Numbers follow doc_id, then size and
    checksum, so only rows alike in all of these may swap. Texts never leave the scan.
    """
    narrow = documents.selectExpr("doc_id", "coalesce(octet_length(text), 0) + 1L as size", "crc32(coalesce(cast(text as binary), X'')) as text_crc32")
    return assign(narrow, ["doc_id", "size", "text_crc32"], shards, seed).selectExpr("doc_id", "size", "text_crc32", "'rows' as law", "shard", "slot", "cast(null as int) as grown_shard")
