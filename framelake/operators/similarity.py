"""Similarity transforms between point sets, applied to poses, composed along chains."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIT = "s double, r array<double>, t array<double>, m array<double>, n bigint, kind string"


def nearest_rotation(m: np.ndarray) -> np.ndarray:
    u, _, vt = np.linalg.svd(m)
    if np.linalg.det(u) * np.linalg.det(vt) < 0:
        u = u.copy()
        u[:, -1] *= -1
    return u @ vt


def similarity_from_sums(n: float, mean_s: np.ndarray, mean_d: np.ndarray, cov: np.ndarray, var_s: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Least-squares s, R, t with d = s R x + t, from means, cov = mean((d - md)(x - ms)^T) and the mean squared spread."""
    u, sing, vt = np.linalg.svd(cov)
    sign = np.ones(3)
    if np.linalg.det(u) * np.linalg.det(vt) < 0:
        sign[2] = -1
    rot = (u * sign) @ vt
    scale = float((sing * sign).sum() / var_s) if var_s > 0 else float("nan")
    return scale, rot, mean_d - scale * rot @ mean_s


def robust(src: np.ndarray, dst: np.ndarray, src_rot: np.ndarray, dst_rot: np.ndarray, min_spread: float = 1e-4) -> tuple[float, np.ndarray, np.ndarray]:
    """fit_similarity() of the centres and rotations of two arrays of poses."""
    ms, md = src.mean(0), dst.mean(0)
    spread = np.sqrt(((src - ms) ** 2).sum(1))
    if len(src) >= 3 and spread.mean() >= min_spread:
        scale, rot, move = similarity_from_sums(len(src), ms, md, (dst - md).T @ (src - ms) / len(src), float((spread**2).mean()))
        if np.isfinite(scale) and scale > 0 and np.isfinite(rot).all():
            return scale, rot, move
    rot = nearest_rotation((dst_rot @ src_rot.transpose(0, 2, 1)).sum(0))
    return 1.0, rot, md - rot @ ms


def fit_similarity(points: DataFrame, keys: list[str], rotations: bool = False, min_spread: float = 1e-4) -> DataFrame:
    """keys, s, r (nine numbers), t, m (mean source point), n, kind of each group of point pairs sx, sy, sz -> dx, dy, dz.

    Groups are reduced to a row of sums by Spark; only that row meets the 3 x 3 decomposition. Where the
    source points spread less than `min_spread`, are fewer than three, or the scale is not finite and
    positive, kind is `rotation`: scale 1 and, where rotation columns sr0..8, dr0..8 are given, the
    rotation nearest to the sum of dr sr^T, else the identity.
    """
    s, d = ("sx", "sy", "sz"), ("dx", "dy", "dz")
    means = points.groupBy(*keys).agg(*[F.avg(c).alias(f"sim__{c}") for c in (*s, *d)])
    on = points.join(means, keys)
    spread = F.expr("sqrt(" + " + ".join(f"pow({c} - sim__{c}, 2)" for c in s) + ")")
    sums = [F.count(F.lit(1)).alias("n"), F.avg(spread).alias("spread"), *[F.first(f"sim__{c}").alias(f"m_{c}") for c in (*s, *d)]]
    sums += [F.avg(F.expr(f"({b} - sim__{b}) * ({a} - sim__{a})")).alias(f"c{i}{j}") for i, b in enumerate(d) for j, a in enumerate(s)]
    sums.append(F.avg(F.expr(" + ".join(f"pow({c} - sim__{c}, 2)" for c in s))).alias("var_s"))
    if rotations:
        sums += [F.sum(F.expr(" + ".join(f"dr{3 * i + k} * sr{3 * j + k}" for k in range(3)))).alias(f"q{i}{j}") for i in range(3) for j in range(3)]
    reduced = on.groupBy(*keys).agg(*sums)

    @F.pandas_udf(FIT)
    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.to_dict("records"):
            ms, md = np.array([row[f"m_{c}"] for c in s]), np.array([row[f"m_{c}"] for c in d])
            if row["spread"] >= min_spread and row["n"] >= 3:
                cov = np.array([[row[f"c{i}{j}"] for j in range(3)] for i in range(3)])
                scale, rot, t = similarity_from_sums(row["n"], ms, md, cov, row["var_s"])
                if np.isfinite(scale) and scale > 0 and np.isfinite(rot).all():
                    out.append((scale, rot.ravel().tolist(), t.tolist(), ms.tolist(), row["n"], "similarity"))
                    continue
            rot = nearest_rotation(np.array([[row[f"q{i}{j}"] for j in range(3)] for i in range(3)])) if rotations else np.eye(3)
            out.append((1.0, rot.ravel().tolist(), (md - rot @ ms).tolist(), ms.tolist(), row["n"], "rotation"))
        return pd.DataFrame(out, columns=["s", "r", "t", "m", "n", "kind"])

    names = [c for c in reduced.columns if c not in keys]
    return reduced.select(*keys, solve(F.struct(*names)).alias("f")).select(*keys, "f.*")


def compose(fits: DataFrame, video: str, block: str) -> DataFrame:
    """Each block's transform into the first block's frame: g_k = g_(k-1) after f_k, folded over the video's
    blocks in order. `fits` has s, r, t from block k to block k - 1; the first block's is the identity.

    With kind and m as fit_similarity() gives them, a block of kind `rotation` has scale 1 in the first
    block's frame, whatever the scale before it, and its mean point goes where that of its partners is.
    """
    ident = "named_struct('b', cast(null as bigint), 's', 1D, 'r', array(1D,0D,0D,0D,1D,0D,0D,0D,1D), 't', array(0D,0D,0D))"
    product = lambda a, b, n: "array(" + ", ".join(" + ".join(f"{a}[{3 * i + k}] * {b}[{n * k + j}]" for k in range(3)) for i in range(3) for j in range(n)) + ")"
    plus = lambda a, b: f"zip_with({a}, {b}, (p, q) -> p + q)"
    kinds = {"kind", "m"} <= set(fits.columns)
    more = ["kind", "m"] if kinds else []
    # target of the mean point (of the origin, where its transform is all there is), then the transform
    met = plus("x.t", product("x.r", "x.m", 1)) if kinds else "x.t"
    moved = plus(f"transform({product('a.r', 'y.met', 1)}, p -> a.s * p)", "a.t")
    if kinds:
        alone = "x.kind = 'rotation'"
        back = f"transform({product('y.rot', 'x.m', 1)}, p -> -p * y.scale)"
        scale, move = f"if({alone}, 1D, a.s * x.s)", plus("y.moved", back)
        met = f"if({alone}, {met}, zip_with(x.t, {product('x.r', 'x.m', 1)}, (p, q) -> p + x.s * q))"
    else:
        scale, move = "a.s * x.s", "y.moved"
    let = lambda name, value, then: f"element_at(transform(array({value}), {name} -> {then}), 1)"
    step = let("y", f"named_struct('met', {met})", let("y", f"named_struct('moved', {moved}, 'rot', {product('a.r', 'x.r', 3)}, 'scale', {scale})", f"named_struct('b', x.b, 's', y.scale, 'r', y.rot, 't', {move})"))
    listed = fits.groupBy(video).agg(F.array_sort(F.collect_list(F.struct(F.col(block).cast("bigint").alias("b"), "s", "r", "t", *more))).alias("fs"))
    fold = (
        f"aggregate(fs, named_struct('a', {ident}, 'out', cast(array() as array<struct<b:bigint,s:double,r:array<double>,t:array<double>>>)), "
        f"(acc, x) -> aggregate(array(acc.a), acc, (z, a) -> aggregate(array({step}), z, (y, g) -> named_struct('a', g, 'out', array_append(y.out, g)))), acc -> acc.out)"
    )
    return listed.select(video, F.explode(F.expr(fold)).alias("g")).select(video, F.col("g.b").alias(block), "g.s", "g.r", "g.t")


def apply_similarity(poses: DataFrame, centre: tuple[str, str, str] = ("cx", "cy", "cz"), rotation: str = "r") -> DataFrame:
    """Moves centres to s R c + t and turns rotations to R R_i, from columns s, fr (nine), ft (three)."""
    moved = {c: F.expr("s * (" + " + ".join(f"fr[{3 * i + k}] * {centre[k]}" for k in range(3)) + f") + ft[{i}]") for i, c in enumerate(centre)}
    turned = {f"{rotation}{3 * i + j}": F.expr(" + ".join(f"fr[{3 * i + k}] * {rotation}{3 * k + j}" for k in range(3))) for i in range(3) for j in range(3)}
    return poses.withColumns(moved | turned)
