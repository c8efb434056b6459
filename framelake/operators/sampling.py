"""Which frames of a video are taken: positions, samples, caps, routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_positions(frames: DataFrame, video: str, frame: str) -> DataFrame:
    """Adds row_pos (from 0, by frame) and n_frames of the video: one shuffle by video."""
    return frames.withColumn("row_pos", F.expr(f"cast(row_number() over (partition by {video} order by {frame}) - 1 as bigint)")).withColumn("n_frames", F.expr(f"count(*) over (partition by {video})"))


def sampled(row_pos: str, total: str, n: int | None) -> Column:
    """Whether a position is in a sample of n: every (total div n)-th from 0, n at most; all where n is
    null, not positive or not below total. With total under 2 n the sample is the first n."""
    if n is None or n <= 0:
        return F.lit(True)
    step = f"greatest(1, {total} div {n})"
    return F.expr(f"{total} <= {n} or ({row_pos} % {step} = 0 and {row_pos} div {step} < {n})")


def sample_frames(frames: DataFrame, video: str, frame: str, n: int | None) -> DataFrame:
    """The frames of each video's sample, with row_pos renumbered over the sample."""
    kept = with_positions(frames, video, frame).where(sampled("row_pos", "n_frames", n))
    step = f"greatest(1, n_frames div {n})" if n and n > 0 else "1"
    return kept.withColumn("row_pos", F.expr(f"case when n_frames <= {n or 0} then row_pos else row_pos div {step} end") if n and n > 0 else F.col("row_pos")).drop("n_frames")


def linspace_positions(videos: DataFrame, total: str, n: int) -> DataFrame:
    """Explodes each video into n positions spread evenly over 0 .. total - 1, truncated; all where total <= n."""
    at = f"case when {total} <= {n} then i when i = {n - 1} and i > 0 then {total} - 1 else cast(i * (({total} - 1) / {float(max(n - 1, 1))}D) as bigint) end"
    return videos.where(f"{total} > 0").withColumn("i", F.expr(f"explode(sequence(0L, least({total}, {n}L) - 1))")).withColumn("row_pos", F.expr(at)).drop("i")


def stride_cap(row_pos: str, total: str, cap: int = 1000) -> Column:
    """Implicit thinning of long videos: every (total div cap)-th frame beyond the cap."""
    return F.expr(f"{total} <= {cap} or {row_pos} % greatest(1, {total} div {cap}) = 0")


def strided_range(frame: str, start: int, stride: int, max_frames: int) -> Column:
    """Whether a frame is in range(start, ..., stride), max_frames of it at most."""
    step = max(1, stride)
    return F.expr(f"{frame} >= {start} and ({frame} - {start}) % {step} = 0 and ({frame} - {start}) div {step} < {max_frames}")


def in_range(frames: DataFrame, frame: str, total: str) -> DataFrame:
    """Frames that exist; see out_of_range() for the others."""
    return frames.where(f"{frame} >= 0 and {frame} < {total}")


def out_of_range(frames: DataFrame, frame: str, total: str) -> DataFrame:
    return frames.where(f"{frame} is null or {frame} < 0 or {frame} >= {total}")


def until_out_of_range(frames: DataFrame, video: str, position: str, frame: str, total: str) -> DataFrame:
    """The requests before the first one beyond the end, in order: readers that stop rather than skip."""
    bad = F.expr(f"max(case when {frame} >= {total} then 1 else 0 end) over (partition by {video} order by {position} rows unbounded preceding)")
    return frames.withColumn("sampling__bad", bad).where("sampling__bad = 0").drop("sampling__bad")


def route(total: str, threshold: int = 2000) -> Column:
    """`stream` for videos with more frames than the threshold, `memory` otherwise."""
    return F.expr(f"case when {total} > {threshold} then 'stream' else 'memory' end")


def parse_branches(text: str, known: tuple[str, ...] = ("dino", "depth", "pose")) -> list[str]:
    """Branches of a comma list, trimmed; empty entries go, an unknown one is an error."""
    found = [b.strip() for b in text.split(",") if b.strip()]
    if unknown := [b for b in found if b not in known]:
        raise ValueError(f"unknown branches: {', '.join(unknown)}")
    return found
