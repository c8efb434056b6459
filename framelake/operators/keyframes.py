"""Keyframes by a greedy scan, and parameters interpolated between them."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyframes(frames: DataFrame, video: str | list[str], frame: str, interval: int = 30, carried: str | None = None, force_last: bool = True) -> DataFrame:
    """video (a column, or several), frame of the keyframes: the first row, then each one at least `interval` after the keyframe
    before it, and the last row. With a `carried` column (a keyframe before the rows, null for none) the
    first row is no keyframe unless it is far enough. The scan is a fold over the video's sorted frames.
    """
    have = F.expr(f"min({carried})").cast("bigint") if carried else F.lit(None).cast("bigint")
    keys_of = [video] if isinstance(video, str) else video
    grouped = frames.groupBy(*keys_of).agg(F.array_sort(F.collect_set(F.col(frame).cast("bigint"))).alias("f"), have.alias("c"))
    fold = (
        "aggregate(f, named_struct('last', c, 'k', cast(array() as array<bigint>)), "
        f"(s, x) -> case when s.last is null or x - s.last >= {interval} then named_struct('last', x, 'k', array_append(s.k, x)) else s end, s -> s.k)"
    )
    keys = f"array_union({fold}, array(element_at(f, -1)))" if force_last else fold
    return grouped.select(*keys_of, F.explode(F.expr(keys)).alias(frame))


def keyframes_pandas(frames: DataFrame, video: str, frame: str, interval: int = 30, force_last: bool = True) -> DataFrame:
    """The same for videos of many million rows, where growing an array in a fold is slow: one video a call."""
    kind = dict(frames.dtypes)[video]

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        found: list[int] = []
        for x in sorted(pdf[frame].unique().tolist()):
            if not found or x - found[-1] >= interval:
                found.append(x)
            last = x
        if force_last and found[-1] != last:
            found.append(last)
        return pd.DataFrame({video: [pdf[video].iloc[0]] * len(found), frame: found})

    return frames.select(video, F.col(frame).cast("bigint").alias(frame)).groupBy(video).applyInPandas(scan, f"{video} {kind}, {frame} bigint")


def interpolate(rows: DataFrame, video: str, x: str, values: list[str]) -> DataFrame:
    """Fills nulls of `values` linearly over x, within `video` (a column, or several by commas), between the nearest rows that have them; before the first
    and after the last such row the nearest value holds. Rows of a video without any stay null.

    x is the source index, or a row number where that is wanted.
    """
    out = rows
    before = f"over (partition by {video} order by {x} rows between unbounded preceding and current row)"
    after = f"over (partition by {video} order by {x} rows between current row and unbounded following)"
    known = f"case when {values[0]} is not null then {x} end"
    out = out.withColumns({"interp__x0": F.expr(f"last({known}, true) {before}"), "interp__x1": F.expr(f"first({known}, true) {after}")})
    out = out.withColumns({f"interp__{v}{i}": F.expr(e) for v in values for i, e in enumerate((f"last({v}, true) {before}", f"first({v}, true) {after}"))})
    mixed = {
        v: F.expr(
            f"case when interp__x0 is null then interp__{v}1 when interp__x1 is null or interp__x1 = interp__x0 then interp__{v}0 "
            f"else interp__{v}0 + (interp__{v}1 - interp__{v}0) * (({x} - interp__x0) / cast(interp__x1 - interp__x0 as double)) end"
        )
        for v in values
    }
    return out.withColumns(mixed).drop("interp__x0", "interp__x1", *[f"interp__{v}{i}" for v in values for i in (0, 1)])


