"""Language identification by rank-order profiles of character n-grams.

A profile is a language's most frequent 1- to 3-grams in order. A document's own profile is compared to
each by out-of-place distance: the sum of rank differences, with the profile's length for an n-gram that
the language's lacks. Letters are lower-cased; a run of anything else is one space. An n-gram's key is
its code points, 21 bits each, so that no two are confused.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .caches import claim

SPACE = 1  # stands for what is not a letter; U+0001 is none
BITS = 21


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """The lower-case letter of each code point, SPACE for others. No letter lies above plane 3."""
    claim("langid", folded.cache_clear)
    table = np.full(0x110000, SPACE, np.int32)
    for i in range(0x40000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def grams(text: str) -> np.ndarray:
    """Keys of all n-grams of a text; none if it has no letter."""
    code = folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not (code != SPACE).any():
        return np.zeros(0, np.int64)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != SPACE) | (code[:-1] != SPACE)
    code = code[keep].astype(np.int64)
    if code[0] != SPACE:
        code = np.concatenate([[SPACE], code])
    if code[-1] != SPACE:
        code = np.concatenate([code, [SPACE]])
    two = code[:-1] << BITS | code[1:]
    three = two[:-1] << BITS | code[2:]
    return np.concatenate([code[code != SPACE], two, three[code[1:-1] != SPACE]])


def counted(text: str | None) -> dict[int, int]:
    """How often each n-gram occurs in a whole text."""
    keys, n = np.unique(grams(text or ""), return_counts=True)
    return dict(zip(keys.tolist(), n.tolist()))


def ranked(keys: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent keys in order; the smaller key first among equals."""
    if len(counts) > top:
        some = counts >= np.partition(counts, len(counts) - top)[-top]
        keys, counts = keys[some], counts[some]
    return keys[np.lexsort((keys, -counts))[:top]].astype(np.int64)


@dataclass
class Profiles:
    """keys: sorted n-grams of all profiles. ranks: their rank in each language's, `top` where absent."""

    langs: list[str]
    keys: np.ndarray
    ranks: np.ndarray
    top: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: how far the distance stays below that of a document that shares nothing."""
        found = grams(text or "")
        if not len(found) or not self.langs:
            return "und", 0.0
        keys, counts = np.unique(found, return_counts=True)
        mine = ranked(keys, counts, self.top)
        at = np.minimum(np.searchsorted(self.keys, mine), len(self.keys) - 1)
        known = self.keys[at] == mine
        places = np.arange(len(mine))
        apart = np.abs(self.ranks[at[known]].astype(np.int64) - places[known, None])
        apart[self.ranks[at[known]] == self.top] = self.top
        distance = apart.sum(0) + self.top * int((~known).sum())
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.top * len(mine)))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", top: int = 400, docs_per_lang: int = 1500) -> Profiles:
    """Profiles of all languages in `lang`, from rows with a text and a label.

    Fitted on a bounded sample of labelled rows: about `docs_per_lang` rows a language, those with the
    smallest hash of the key, each read whole. Prediction has no bound.
    Languages come in code point order; the first wins among equal distances, the smaller key among
    n-grams that are as frequent. Labelled texts without letters and rows without text or label teach
    nothing; rows that repeat count as often; extra columns don't matter.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(F.col(lang)).agg(F.count(F.lit(1))).collect()}
    langs = sorted(counts)
    if not langs:
        return Profiles([], np.zeros(1, np.int64), np.zeros((1, 0), np.int32), top)
    spark = labelled.sparkSession
    share = spark.createDataFrame([(x, min(1.0, docs_per_lang / counts[x]) * 2.0**32) for x in langs], "langid__lang string, langid__below double")
    point = F.xxhash64(F.col(key).cast("string"), F.lit("langid")).bitwiseAND(F.lit((1 << 32) - 1))
    sample = rows.join(F.broadcast(share), F.col(lang) == F.col("langid__lang")).where(point <= F.col("langid__below"))

    @F.pandas_udf("map<long,long>")
    def all_grams(texts: pd.Series) -> pd.Series:
        return texts.map(counted)

    total = sample.select(F.col(lang).alias("lang"), F.explode(all_grams(F.col(text))).alias("gram", "n")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = total.withColumn("i", F.expr("row_number() over (partition by lang order by n desc, gram)")).where(f"i <= {top}")
    found = sorted((r["lang"], r["i"], r["gram"]) for r in first.collect())
    profiles = [np.array([g for name, _, g in found if name == x], np.int64) for x in langs]
    keys = np.unique(np.concatenate([*profiles, np.zeros(1, np.int64)]))
    ranks = np.full((len(keys), len(langs)), top, np.int32)
    for i, p in enumerate(profiles):
        ranks[np.searchsorted(keys, p), i] = np.arange(len(p))
    return Profiles(langs, keys, ranks, top)


def held_out(key: str = "doc_id") -> Column:
    """crc32 of the key as text, by four, is 2; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def predict(df: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Adds lang_pred and score (0 to 1), replacing columns of these names. No shuffle; `und` and 0 for a
    text that is null or has no letter, and where nothing was learned."""
    shared = df.sparkSession.sparkContext.broadcast(profiles)

    @F.arrow_udf("lang_pred string, score double")
    def both(texts: pa.Array) -> pa.Array:
        model = shared.value
        made = [model.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], ["lang_pred", "score"])

    got = df.withColumn("langid__made", both(F.col(text)))
    return got.withColumns({c: F.col(f"langid__made.{c}") for c in ("lang_pred", "score")}).drop("langid__made")


def accept(df: DataFrame, min_score: float = 0.1) -> DataFrame:
    """Rows whose language was identified: not `und`, and nearer to a profile than `min_score`."""
    return df.where((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
