"""Near-duplicates by MinHash: minima, banding, verification, components by large-star and small-star.

Texts with the same words are one class, named by its smallest doc_id. Classes that share a bucket of a
band are compared to the bucket's smallest and largest member, never all with all: first by their
signatures, which leave out what cannot be similar enough, then on their full sets.
Buckets that still span several components after that go through an exact join: documents whose sets
are similar enough share one of their rarest shingles (prefix filter), so no link between members of
a bucket is lost to the two pivots.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import work
from .caches import claim

#: Multipliers of a 64-bit mixing step (those of the SplitMix64 generator).
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)


#: Postings of one shingle that meet in one key of the exact join.
POSTINGS = 256


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hash of a word, kept for the words of late: two generations of up to `limit`."""

    limit = 100_000

    def __init__(self) -> None:
        super().__init__()
        self.older: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        h = self.older.get(word)
        if h is None:
            h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[word] = h
        return h


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    claim("neardup", _hashes.cache_clear)
    return WordHashes()


def words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z in lower case, as UTF-8: what bytes.split() and lower() mean."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(found: list[bytes], width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than `width` are one shingle, none is none."""
    if not found:
        return np.zeros(0, np.uint64)
    known = _hashes()
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = min(width, len(h))
    acc = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        acc = acc * np.uint64(MIX[2]) + h[i : len(h) - n + 1 + i]
        acc = acc ^ (acc >> np.uint64(29))
    return np.unique(_mix(acc))


@lru_cache(maxsize=4)
def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """`count` universal hash functions a x + b modulo 2^64, a odd."""
    raw = _mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(MIX[2]))
    return (raw[:count] | np.uint64(1))[:, None], raw[count:, None]


def minima(found: np.ndarray, count: int) -> np.ndarray:
    """Least value of each hash function over the whole set, a block of it at a time."""
    a, b = _family(count)
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 4096):
        least = np.minimum(least, (a * found[None, i : i + 4096] + b).min(1))
    return least


def buckets(least: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit bucket for each band, in which the band's place counts."""
    rows = least.reshape(bands, -1)
    acc = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        acc = _mix(acc * np.uint64(MIX[2]) + rows[:, i])
    return acc


def least_agreement(samples: int, percent: int, risk: float = 1e-9) -> int:
    """How many minima two sets of the least similarity have in common at least, but for a chance of `risk`."""
    p, below = percent / 100, 0.0
    for k in range(samples + 1):
        below += comb(samples, k) * p**k * (1 - p) ** (samples - k)
        if below > risk:
            return k
    return samples


def sketches(documents: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """doc, k1, k2 (128-bit hash of the words), n (set size), buckets and sig, the upper halves of the minima
    (none for an empty set). No shuffle."""

    def lists(parts: list[np.ndarray], of: np.dtype) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, of), *parts])))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                k1, k2, n, found, sigs = [], [], [], [], []
                for t in b.column(1):
                    w = words(t.as_py())
                    s = shingle_set(w, width)
                    d = xxhash.xxh3_128_intdigest(b" ".join(w))
                    k1.append((d >> 64) - (1 << 63))
                    k2.append((d & (2**64 - 1)) - (1 << 63))
                    n.append(len(s))
                    least = minima(s, bands * rows) if len(s) else np.zeros(0, np.uint64)
                    found.append(buckets(least, bands).view(np.int64) if len(s) else np.zeros(0, np.int64))
                    sigs.append((least >> np.uint64(32)).astype(np.uint32).view(np.int32))
                columns = [b.column(0), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(n, pa.int64()), lists(found, np.int64), lists(sigs, np.int32)]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "k1", "k2", "n", "buckets", "sig"])

    return documents.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(sketch, "doc long, k1 long, k2 long, n long, buckets array<long>, sig array<int>")


def shingle_sets(documents: DataFrame, key: str, text: str, width: int, batch_bytes: int = 8 << 20) -> DataFrame:
    """doc, n and its full set as sorted 64-bit hashes, for each text that has words. Batches are small,
    as sets are larger than their texts."""

    def batch(docs: list[int | None], sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = [len(s) for s in sets]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        flat = pa.array(np.concatenate(sets).view(np.int64), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, flat)], ["doc", "n", "shingles"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                docs, sets, held = [], [], 0
                for doc, t in zip(b.column(0), b.column(1), strict=True):
                    found = shingle_set(words(t.as_py()), width)
                    if len(found):
                        docs.append(doc.as_py())
                        sets.append(found)
                        held += found.nbytes
                    if held > batch_bytes:
                        yield batch(docs, sets)
                        docs, sets, held = [], [], 0
                if docs:
                    yield batch(docs, sets)

    return documents.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(make, "doc long, n long, shingles array<long>")


def alike(pairs: DataFrame, classes: DataFrame, percent: int, samples: int) -> DataFrame:
    """Signature verification: the pairs a < b whose sizes and minima allow the least similarity.

    The share of equal minima estimates it. A pair goes where so few agree that at the least similarity
    it would happen once in 10^9 times; what stays is compared on full sets.
    """
    of = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    equal = "aggregate(zip_with(sa, sb, (x, y) -> if(x = y, 1, 0)), 0, (s, x) -> s + x)"
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").where(f"{equal} >= {least_agreement(samples, percent)}").select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a < b whose full sets satisfy 100 |A and B| >= percent |A or B|."""
    of = lambda x: sets.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("shingles").alias(f"s{x}"))
    both = F.expr("cast(size(array_intersect(sa, sb)) as bigint)")
    joined = pairs.join(of("a"), "a").join(of("b"), "b").withColumn("both", both)
    return joined.where(f"100 * both >= {percent} * (na + nb - both)").select("a", "b")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        e = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = e.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        joined = e.join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest member) of each linked node, by alternating large-star and
    small-star until no edge changes. Links are any pairs u, v; the driver sees counts and checksums only."""
    edges = work.materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            labels.framelake_path = edges.framelake_path
            return labels
        before, old = now, edges
        edges = work.materialize(_star(_star(edges, True), False), "edges")
        work.release(old)


def _prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components among `members` (doc, comp) that may be similar enough.

    Shingles are ordered from rare to frequent. Of two sets with similarity p, one of the first
    n - ceil(p n) + 1 of each is common, and what follows the first common one in either set bounds
    their overlap: it must reach p / (1 + p) of both sizes together. Copies that differ from a shared
    original by edits of their own have these first, and so meet few others. Postings within one
    component go before the join.
    """
    flat = sets.join(members, "doc").select("doc", "comp", "n", F.explode("shingles").alias("s"))
    total = sets.join(members, "doc").agg(F.sum("n")).first()[0] or 0
    rarity = flat.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    order = work.join_spread(flat, rarity, "s", "df", total, "doc")
    # shingles of one member alone come first in its order and can't be shared: only their number counts
    alone = order.groupBy("doc").agg(F.count(F.lit(1)).alias("shared"))
    ranked = order.join(alone, "doc").withColumn("at", F.expr("n - shared + row_number() over (partition by doc order by df, s)"))
    prefix = work.materialize(ranked.where(f"at <= n - ceil({percent} * n / 100D) + 1").select("s", "doc", "comp", "n", "at"), "prefix")
    mixed = prefix.groupBy("s").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("postings")).where("c0 <> c1").select("s", "postings")
    left = work.join_spread(prefix, mixed, "s", "postings", total, "doc")
    # a long list of postings is cut into blocks, and each pair of blocks is a key of the join
    cut = left.withColumn("parts", F.expr(f"cast(ceil(postings / {POSTINGS}) as int)")).withColumn("own", F.expr("pmod(xxhash64(doc, s), parts)"))
    keys = cut.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).withColumns({"k0": F.least("own", "other"), "k1": F.greatest("own", "other")})
    x, y = keys.alias("x"), keys.alias("y")
    sized = F.expr(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
    reach = F.expr(f"{100 + percent} * (1 + least(x.n - x.at, y.n - y.at)) >= {percent} * (x.n + y.n)")
    # within one block all pairs meet; of two blocks, those of one with those of the other
    same = (F.col("x.s") == F.col("y.s")) & (F.col("x.k0") == F.col("y.k0")) & (F.col("x.k1") == F.col("y.k1")) & ((F.col("x.k0") == F.col("x.k1")) | (F.col("x.own") != F.col("y.own")))
    met = x.join(y, same & (F.col("x.doc") < F.col("y.doc")) & (F.col("x.comp") != F.col("y.comp")) & sized & reach)
    return met.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct()


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, bands: int = 28, rows: int = 4) -> DataFrame:
    """key, n_shingles, component_id, kept of each row.

    Documents are linked when their sets of `width`-word shingles have a Jaccard similarity of `percent`
    hundredths or more; component_id is the smallest key reachable, kept is whether that is the row's own.
    A pair at the least similarity shares no bucket with probability (1 - (percent / 100)^rows)^bands, and
    its signatures rule it out with one of 10^-9 at most.
    Null and empty texts are linked with nothing. Rows that repeat a key are one node: their links add
    up. A null key can't be named: its component is null and it is kept.
    """
    made = work.materialize(sketches(documents, key, text, width, bands, rows), "sketches")
    named = made.where("doc is not null and n > 0")
    classes = work.materialize(named.groupBy("k1", "k2").agg(F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("buckets").alias("buckets"), F.first("sig").alias("sig")), "classes")
    inside = classes.select("rep", F.explode("buckets").alias("h"))
    wide = work.materialize(inside.groupBy("h").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi"), "wide")
    among = wide.agg(F.sum("size")).first()[0] or 0
    shared = work.materialize(work.join_spread(inside, wide, "h", "size", among, "rep"), "shared")
    pairs = work.materialize(
        shared.select("rep", F.explode(F.array("lo", "hi")).alias("pivot")).where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct(), "pairs"
    )
    likely = work.materialize(alike(pairs, classes, percent, bands * rows), "likely")
    asked = shared.select(F.col("rep").alias("doc")).distinct()
    texts = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).join(asked.hint("shuffle_hash"), "doc", "left_semi")
    sets = work.materialize(shingle_sets(texts, "doc", "text", width), "sets")
    links = work.materialize(verified(likely, sets, percent).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    # a key that repeats with other texts ties their classes together
    of = named.join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).select("doc", "rep")
    torn = of.groupBy("doc").agg(F.min("rep").alias("r0"), F.max("rep").alias("r1")).where("r0 <> r1").select("doc")
    tied = of.join(torn, "doc").select(F.col("doc").alias("u"), F.col("rep").alias("v")).distinct()
    known = work.materialize(links.union(tied), "known")
    labels = components(known)

    crowded = shared.where("size > 3").select("h", "rep").join(labels, F.col("rep") == F.col("node"), "left").select("h", F.col("rep").alias("doc"), F.coalesce("component", "rep").alias("comp"))
    split = crowded.groupBy("h").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("size")).where("c0 <> c1").select("h", "size")
    members = work.materialize(work.join_spread(crowded, split, "h", "size", among, "doc").select("doc", "comp").distinct(), "members")
    if not members.isEmpty():
        more = work.materialize(verified(alike(_prefix_pairs(members, sets, percent), classes, percent, bands * rows), sets, percent).select(F.col("a").alias("u"), F.col("b").alias("v")), "more")
        if not more.isEmpty():
            old, labels = labels, components(known.union(more))
            work.release(old)
        work.release(more)
    work.release(wide, shared, pairs, likely, sets, links, known, members)
    return _labelled(made, classes, labels, key)


def _labelled(made: DataFrame, classes: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    named = classes.join(labels, F.col("rep") == F.col("node"), "left").select("k1", "k2", F.coalesce("component", "rep").alias("of_class"))
    component: Column = F.when(F.col("n") > 0, F.coalesce("of_class", "doc")).otherwise(F.col("doc"))
    rows = made.drop("buckets", "sig").join(named, ["k1", "k2"], "left").withColumn("component_id", F.when(F.col("doc").isNotNull(), component))
    return rows.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """The documents whose key is kept: one of each component. Rows without a key stay, as do all rows of
    a kept key."""
    gone = near_duplicates(documents, key, text, **options).where("not kept").select(F.col(key).alias("neardup__gone")).distinct()
    return documents.join(gone.hint("shuffle_hash"), F.col(key) == F.col("neardup__gone"), "left_anti")
