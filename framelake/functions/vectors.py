"""Token vectors: norms, products, projections, stretches. Higher-order functions over arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import session


def dot(a: str, b: str) -> Column:
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> cast(x as double) * cast(y as double)), 0D, (s, x) -> s + x)")


def norm(a: str) -> Column:
    return F.expr(f"sqrt(aggregate({a}, 0D, (s, x) -> s + cast(x as double) * cast(x as double)))")


def l2_normalise(a: str, floor: float = 1e-8) -> Column:
    """The vector over its norm, which counts as `floor` at least."""
    length = f"greatest(sqrt(aggregate({a}, 0D, (s, x) -> s + cast(x as double) * cast(x as double))), {floor}D)"
    return F.expr(f"aggregate(array({length}), cast(array() as array<double>), (s, n) -> transform({a}, x -> cast(x as double) / n))")


def cosine(a: str, b: str, floor: float = 1e-8) -> Column:
    return F.expr(f"({_sum(a, b)}) / (sqrt({_sum(a, a)}) * sqrt({_sum(b, b)}) + {floor}D)")


def relative_l2(a: str, b: str, floor: float = 1e-8) -> Column:
    d = f"aggregate(zip_with({a}, {b}, (x, y) -> cast(x as double) - cast(y as double)), 0D, (s, x) -> s + x * x)"
    return F.expr(f"sqrt({d}) / (sqrt({_sum(b, b)}) + {floor}D)")


def _sum(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> cast(x as double) * cast(y as double)), 0D, (s, x) -> s + x)"


def drop_registers(tokens: str, registers: int) -> Column:
    """Token 0 and those after the `registers` tokens that follow it."""
    return F.expr(f"concat(slice({tokens}, 1, 1), slice({tokens}, {2 + registers}, greatest(size({tokens}) - {1 + registers}, 0)))")


def patch_side(n_tokens: str) -> Column:
    """Side of the square that the patches without token 0 form; an error where they form none."""
    return F.expr(f"if(cast(sqrt({n_tokens} - 1) as int) * cast(sqrt({n_tokens} - 1) as int) = {n_tokens} - 1, cast(sqrt({n_tokens} - 1) as int), raise_error('patches form no square'))")


def patch_grid(height: str, width: str, patch: int = 16) -> Column:
    """Rows and columns of patches."""
    return F.expr(f"named_struct('h', cast({height} div {patch} as int), 'w', cast({width} div {patch} as int))")


def native_size(height: str, width: str, patch: int = 16) -> Column:
    """True, or an error where a side is no multiple of the patch."""
    return F.expr(f"if({height} % {patch} = 0 and {width} % {patch} = 0, true, raise_error('image sides must be multiples of {patch}'))")


def stretched(value: str, low: str, high: str) -> Column:
    """value from low .. high to 0 .. 1, clipped; a range without width counts as one wide."""
    top = f"(case when {high} <= {low} + 1e-8D then {low} + 1D else {high} end)"
    return F.expr(f"least(greatest(({value} - {low}) / ({top} - {low}), 0D), 1D)")


def exact_percentiles(rows: DataFrame, value: str, shares: list[float]) -> list[float | None]:
    """The percentiles that percentile() gives, without one task that holds all distinct values.

    Values are counted, dealt by range and sorted within partitions; the partitions' counts say in which one
    a rank lies, and only that one is searched. The driver sees a count per partition and two values a
    percentile. Null values don't count; without others the percentiles are null.
    """
    spark = rows.sparkSession
    counts = session.written(rows.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n")), "values")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = session.written(counts.repartitionByRange(parts, "v").withColumn("at", F.spark_partition_id()), "ranges")
    sizes = sorted((r["at"], r["n"]) for r in placed.groupBy("at").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sizes)
    if not total:
        return [None] * len(shares)
    ranks = sorted({k for q in shares for k in (math.floor(q * (total - 1)), math.ceil(q * (total - 1)))})
    asked, before = [], 0
    for at, n in sizes:
        asked += [(at, k, k - before) for k in ranks if before <= k < before + n]
        before += n
    wanted = F.broadcast(spark.createDataFrame(asked, "at int, rank long, local long"))
    near = placed.join(wanted.select("at").distinct(), "at").withColumn("upto", F.expr("sum(n) over (partition by at order by v)"))
    found = {r["rank"]: r["v"] for r in near.join(wanted, "at").where("local < upto and local >= upto - n").select("rank", "v").collect()}
    out = []
    for q in shares:
        k = q * (total - 1)
        low, high = found[math.floor(k)], found[math.ceil(k)]
        out.append(low if low == high else (math.ceil(k) - k) * low + (k - math.floor(k)) * high)
    return out


def percentile_stretch(rows: DataFrame, values: list[str], low: float = 0.02, high: float = 0.98, by: list[str] | None = None) -> DataFrame:
    """Replaces each value by its stretch between two exact percentiles, over all rows or each group."""
    if by:
        cuts = [F.expr(f"percentile({v}, array({low}D, {high}D))").alias(f"stretch__{v}") for v in values]
        joined = rows.join(rows.groupBy(*by).agg(*cuts), by)
        return joined.withColumns({v: stretched(v, f"stretch__{v}[0]", f"stretch__{v}[1]") for v in values}).drop(*[f"stretch__{v}" for v in values])
    found = {v: exact_percentiles(rows, v, [low, high]) for v in values}
    lit = lambda x: "cast(null as double)" if x is None else f"{x!r}D"
    return rows.withColumns({v: stretched(v, lit(a), lit(b)) for v, (a, b) in found.items()})


def pca_basis(rows: DataFrame, vector: str, k: int = 3, groups: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Mean and the first k principal directions (k x dim), from sums that each task makes over its rows.

    Each task yields one row of 1 + d + d^2 sums; these are added up in `groups` groups, so the driver's share
    depends on the width alone. The sign of a direction makes its largest entry positive.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, g = 0, None, None
        for b in batches:
            x = np.array([v for v in b.column(0).to_pylist() if v is not None], float)
            if len(x):
                n += len(x)
                s = x.sum(0) + (0 if s is None else s)
                g = x.T @ x + (0 if g is None else g)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([s.tolist()]), pa.array([g.ravel().tolist()])], ["n", "s", "g"])

    def added(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [part["n"].sum()], "s": [np.add.reduce(part["s"].tolist()).tolist()], "g": [np.add.reduce(part["g"].tolist()).tolist()]})

    kind = "n long, s array<double>, g array<double>"
    made = rows.select(vector).mapInArrow(sums, kind).groupBy(F.spark_partition_id() % groups).applyInPandas(added, kind).collect()
    if not made:
        raise ValueError("no vectors to learn a basis from")
    n, s, g = sum(r["n"] for r in made), np.add.reduce([r["s"] for r in made]), np.add.reduce([r["g"] for r in made])
    mean = s / n
    _, vectors = np.linalg.eigh(g.reshape(len(s), len(s)) - n * np.outer(mean, mean))
    basis = vectors[:, ::-1][:, :k].T
    return mean, np.array([v * np.sign(v[np.abs(v).argmax()]) for v in basis])


def project(rows: DataFrame, vector: str, mean: np.ndarray, basis: np.ndarray, names: list[str]) -> DataFrame:
    """Adds a column per direction: (vector - mean) . direction."""
    out = {}
    for name, direction in zip(names, basis, strict=True):
        lits = "array(" + ",".join(f"{x!r}D" for x in map(float, direction)) + ")"
        out[name] = F.expr(f"aggregate(zip_with({vector}, {lits}, (x, y) -> cast(x as double) * y), 0D, (s, x) -> s + x) - ({float(mean @ direction)!r}D)")
    return rows.withColumns(out)
