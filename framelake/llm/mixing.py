"""Mixing sources to target weights by fitting budgets with a subset sum.

Documents are counted by exact length. A source's budget takes whole passes over it first; for the
rest every length gives its share of documents, and what then remains is fitted by a bounded-knapsack
dynamic programme over the lengths' left-over counts. Seeded ranks pick the documents of a length.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import work

#: sources' weights in turn.
WEIGHTS = (5, 2, 1)


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0) -> dict[str | None, float]:
    """Target of each source, in code point order with null last: its weight's share of all sizes, at
    most `cap` times its own size; what is cut goes to the others by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, left, out = dict(order), float(sum(n for _, n in order)), {}
    while len(out) < len(order):
        open_ = [s for s, _ in order if s not in out]
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > cap * size[s]]
        for s in full or open_:
            out[s] = float(cap * size[s]) if full else unit * weight[s]
        left -= sum(out[s] for s in full)
    return out


def subset_sum(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of each length reach the largest sum within the budget, using at most its count.

    Counts are split in powers of two; a bit set holds the sums reached, and an array the step that
    reached each first: four bytes a unit of the budget, whatever the lengths and their number.
    """
    reached, full = 1, (1 << (budget + 1)) - 1
    first, steps = np.full(budget + 1, -1, np.int32), []
    for length in sorted(counts, reverse=True):
        n, step = min(counts[length], budget // length), 1
        while n > 0 and reached != full:
            k = min(step, n)
            fresh = (reached << (length * k)) & full & ~reached
            if fresh:
                reached |= fresh
                bits = np.frombuffer(fresh.to_bytes(budget // 8 + 1, "little"), np.uint8)
                first[np.flatnonzero(np.unpackbits(bits, bitorder="little"))] = len(steps)
                steps.append((length, k))
            n, step = n - k, step * 2
    at, out = reached.bit_length() - 1, {}
    while at:
        length, k = steps[first[at]]
        out[length] = out.get(length, 0) + k
        at -= length * k
    return out


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that lengths sum to the budget or just below."""
    total = sum(n * c for n, c in counts.items())
    if budget >= total:
        return {n: c for n, c in counts.items() if n > 0}
    taken = {n: c * budget // total for n, c in counts.items() if n > 0} if total else {}
    left = budget - sum(n * k for n, k in taken.items())
    for n in sorted(taken, reverse=True):
        # large lengths first until the rest is of the order of one document: the programme's bound
        if left <= 2 * max(taken):
            break
        k = min(counts[n] - taken[n], max(0, left - max(taken)) // n)
        taken[n] += k
        left -= n * k
    for n, k in subset_sum({n: counts[n] - taken[n] for n in taken if counts[n] > taken[n]}, left).items():
        taken[n] += k
    return taken


def plan(counts: dict[int, int], target: float, cap: int = 3) -> tuple[int, dict[int, int]]:
    """Whole passes over a source, and how many documents of each length go in once more."""
    total = sum(n * c for n, c in counts.items())
    budget = min(round(target), cap * total)
    passes = budget // total if total else 0
    return passes, fit(counts, budget - passes * total) if passes < cap else {}


def word_count(text: str) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`; 0 for null."""
    return F.expr(f"coalesce(regexp_count({text}, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0)").cast("long")


def mix(documents: DataFrame, key: str = "doc_id", source: str = "source", size: Column | None = None, weights: tuple[float, ...] = WEIGHTS, cap: int = 3, seed: str = "mix") -> DataFrame:
    """key, source, size, source_size, target, times and taken (= size * times) of each document.

    Rows are ranked by a seeded hash within source and length through dense row numbers, so that no
    task holds a source or a length; ties on hash and key are repeated rows, of which either may be
    taken. The driver holds one row per source; each source's lengths are fitted in one task, from
    one row per distinct length. Empty texts and tables take nothing. Reruns agree.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(key).alias("mix__key"), F.col(source).cast("string").alias("mix__source"), (size if size is not None else word_count("text")).alias("mix__size"))
    rows = rows.withColumn("mix__point", F.xxhash64(F.col("mix__key").cast("string"), F.lit(seed)))
    order = [F.col("mix__source"), F.col("mix__size"), F.col("mix__point"), F.col("mix__key")]
    numbered, _ = work.with_row_numbers(rows, order, "mix__rn")
    counted = work.materialize(numbered.groupBy("mix__source", "mix__size").agg(F.count(F.lit(1)).alias("n"), F.min("mix__rn").alias("start")), "lengths")
    per_source = [(r[0], r[1]) for r in counted.groupBy("mix__source").agg(F.sum(F.col("mix__size") * F.col("n"))).collect()]
    goal = targets(per_source, weights, cap)
    sizes = dict(per_source)
    wanted = spark.createDataFrame([(s, sizes[s], goal[s]) for s in goal], "mix__s string, source_size long, target double")
    plans = counted.join(F.broadcast(wanted), F.col("mix__source").eqNullSafe(F.col("mix__s"))).drop("mix__s").groupBy("mix__source").applyInPandas(_fitted(cap), "mix__source string, mix__size long, start long, source_size long, target double, passes long, once long")
    joined = numbered.alias("d").join(
        plans.alias("p"), F.col("d.mix__source").eqNullSafe(F.col("p.mix__source")) & (F.col("d.mix__size") == F.col("p.mix__size"))
    )
    times = F.expr("passes + case when d.mix__rn - start < once then 1 else 0 end")
    return joined.select(
        F.col("d.mix__key").alias(key), F.col("d.mix__source").alias(source), F.col("d.mix__size").alias("size"), "source_size", "target", times.alias("times"), (F.col("d.mix__size") * times).alias("taken")
    )


def _fitted(cap: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def one(lengths: pd.DataFrame) -> pd.DataFrame:
        counts = {int(n): int(c) for n, c in zip(lengths["mix__size"], lengths["n"], strict=True)}
        passes, once = plan(counts, float(lengths["target"].iloc[0]), cap)
        return lengths.drop(columns="n").assign(passes=passes, once=[once.get(int(n), 0) for n in lengths["mix__size"]])

    return one


def apply_mix(documents: DataFrame, key: str = "doc_id", source: str = "source", **options: object) -> DataFrame:
    """The documents that the mix takes, each as often as it does, with their own columns.

    Rows that repeat a key share what their key takes evenly. A null key is a key like any other.
    """
    taken = mix(documents, key, source, **options).groupBy(key).agg(F.sum("times").alias("mix__times"), F.count(F.lit(1)).alias("mix__n")).withColumnRenamed(key, "mix__of")
    joined = documents.join(taken.where("mix__times > 0").hint("shuffle_hash"), F.col(key).eqNullSafe(F.col("mix__of"))).drop("mix__of")
    single = joined.where("mix__n = 1").drop("mix__n")
    repeated = (
        joined.where("mix__n > 1")
        .withColumn("mix__i", F.expr(f"row_number() over (partition by {key} order by {source})"))
        .withColumn("mix__times", F.expr("mix__times div mix__n + if(mix__i <= mix__times % mix__n, 1, 0)"))
        .drop("mix__n", "mix__i")
        .where("mix__times > 0")
    )
    return single.unionByName(repeated).withColumn("mix__copy", F.expr("explode(sequence(1, mix__times))")).drop("mix__copy", "mix__times")
