"""Block-wise models stitched into one sequence: depth by affine fits, poses by similarities.

The parallel form fits each block to the raw overlap of the one before it, composes these transforms
along the video with a short fold over blocks, and applies them: no block waits for another. The strict
form runs a video's blocks in order in one call, for inputs where masks or fallbacks depend on aligned
values.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import depth


def overlaps(rows: DataFrame, video: str, frame: str, block: str, value: str, at: list[str]) -> DataFrame:
    """Pairs a block's rows with the previous block's on the same frames: source, target."""
    now = rows.select(video, frame, *at, F.col(block), F.col(value).alias("source"))
    prev = rows.select(video, frame, *at, (F.col(block) + 1).alias(block), F.col(value).alias("target"))
    return now.join(prev, [video, frame, *at, block], "inner")


def chain_affine(fits: DataFrame, video: str, block: str) -> DataFrame:
    """Each block's scale and shift into the first block's values: composition along blocks, in order.

    A block without a fit (the first, or no overlap) begins anew with scale 1 and shift 0.
    """
    listed = fits.groupBy(video).agg(F.array_sort(F.collect_list(F.struct(F.col(block).cast("bigint").alias("b"), F.col("scale").cast("double").alias("a"), F.col("shift").cast("double").alias("h")))).alias("fs"))
    fold = (
        "aggregate(fs, named_struct('a', 1D, 'h', 0D, 'out', cast(array() as array<struct<b:bigint,a:double,h:double>>)), "
        "(s, x) -> named_struct('a', if(x.a is null, 1D, s.a * x.a), 'h', if(x.a is null, 0D, s.a * x.h + s.h), 'out', "
        "array_append(s.out, named_struct('b', x.b, 'a', if(x.a is null, 1D, s.a * x.a), 'h', if(x.a is null, 0D, s.a * x.h + s.h)))), s -> s.out)"
    )
    return listed.select(video, F.explode(F.expr(fold)).alias("g")).select(video, F.col("g.b").alias(block), F.col("g.a").alias("scale"), F.col("g.h").alias("shift"))


def align_depth(rows: DataFrame, video: str, frame: str, block: str, value: str, at: list[str], min_points: int = 1) -> DataFrame:
    """rows with the value in the first block's units, by the parallel form."""
    fits = depth.fit_affine(overlaps(rows, video, frame, block, value, at), [video, block], "source", "target", min_points)
    blocks = rows.select(video, block).distinct().join(fits.select(video, block, "scale", "shift"), [video, block], "left")
    chained = chain_affine(blocks, video, block)
    return rows.join(chained, [video, block]).withColumn(value, F.expr(f"{value} * scale + shift")).drop("scale", "shift")


def align_depth_strict(rows: DataFrame, video: str, frame: str, block: str, value: str, at: list[str], min_points: int = 1) -> DataFrame:
    """The same with each fit made to the aligned values of the block before: one call holds a video."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, prev = [], None
        for _, now in pdf.sort_values([block, frame, *at]).groupby(block, sort=True):
            now = now.copy()
            if prev is not None:
                both = now.merge(prev, on=[frame, *at], suffixes=("", "_prev"))
                both = both[(both[value] > depth.MIN_DEPTH) & (both[value + "_prev"] > depth.MIN_DEPTH)]
                if len(both) >= min_points:
                    x, y = both[value].to_numpy(), both[value + "_prev"].to_numpy()
                    sxx = ((x - x.mean()) ** 2).sum()
                    a = ((x - x.mean()) * (y - y.mean())).sum() / sxx if sxx >= depth.MIN_SPREAD else 1.0
                    h = y.mean() - a * x.mean() if sxx >= depth.MIN_SPREAD else max(0.0, y.mean() - x.mean())
                    now[value] = now[value] * a + h
            out.append(now)
            prev = now[[frame, *at, value]]
        return pd.concat(out)

    return rows.groupBy(video).applyInPandas(run, rows.schema)
