"""Two stores compared frame by frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rotation as rot
from ..functions import vectors
from . import similarity


def contiguity(frames: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """keys, first_frame, last_frame, n_frames, contiguous: whether the frames are a range without gaps."""
    return frames.groupBy(*keys).agg(F.min(frame).alias("first_frame"), F.max(frame).alias("last_frame"), F.count(F.lit(1)).alias("n_frames"), F.expr(f"max({frame}) - min({frame}) + 1 = count(*) and count(distinct {frame}) = count(*)").alias("contiguous"))


def near_boundary(frame: str, block_size: int, reach: int = 2) -> Column:
    """Within `reach` frames of a multiple of the block size."""
    return F.expr(f"least(pmod({frame}, {block_size}), {block_size} - pmod({frame}, {block_size})) <= {reach}")


def depth_frames(pairs: DataFrame, frame: list[str], a: str, b: str) -> DataFrame:
    """frame, mean_abs, max_abs, corr over the frame's pixels."""
    return pairs.groupBy(*frame).agg(F.avg(F.abs(F.col(a) - F.col(b))).alias("mean_abs"), F.max(F.abs(F.col(a) - F.col(b))).alias("max_abs"), F.corr(a, b).alias("corr"))


def depth_summary(frames: DataFrame, frame: str, block_size: int | None = None) -> DataFrame:
    """Averages and worst of depth_frames(); with a block size also means at and off its boundaries."""
    out = [F.count(F.lit(1)).alias("n_frames"), F.avg("mean_abs").alias("avg_mean_abs"), F.max("mean_abs").alias("worst_mean_abs"), F.max("max_abs").alias("worst_max_abs"), F.avg("corr").alias("avg_corr"), F.min("corr").alias("worst_corr")]
    if block_size:
        at = near_boundary(frame, block_size)
        out += [F.avg(F.when(at, F.col("mean_abs"))).alias("boundary_mean"), F.avg(F.when(~at, F.col("mean_abs"))).alias("interior_mean")]
    return frames.agg(*out)


def worst_frames(frames: DataFrame, measure: str, frame: str, k: int = 5) -> DataFrame:
    """The k frames with the largest measure, the smaller frame first among equals."""
    return frames.orderBy(F.desc(measure), frame).limit(k)


def dino_frames(pairs: DataFrame, keep: list[str], a: str, b: str) -> DataFrame:
    """Cosine and relative L2 distance of each pair of vectors."""
    return pairs.select(*keep, vectors.cosine(a, b).alias("cosine"), vectors.relative_l2(a, b).alias("rel_l2"))


def dino_summary(frames: DataFrame) -> DataFrame:
    return frames.agg(F.count(F.lit(1)).alias("n_frames"), F.avg("cosine").alias("avg_cosine"), F.min("cosine").alias("worst_cosine"), F.avg("rel_l2").alias("avg_rel_l2"), F.max("rel_l2").alias("worst_rel_l2"))


def pose_frames(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """Absolute difference and rotation angle of pairs of nine-number poses a0..a8, b0..b8."""
    a, b = rot.cols("a"), rot.cols("b")
    worst = F.greatest(*[F.abs(x - y) for x, y in zip(a, b, strict=True)])
    mean = sum((F.abs(x - y) for x, y in zip(a[1:], b[1:], strict=True)), F.abs(a[0] - b[0])) / 9
    angle = rot.geodesic_degrees(rot.from_6d(a[3:]), rot.from_6d(b[3:]))
    return pairs.select(*keep, mean.alias("mean_abs"), worst.alias("max_abs"), angle.alias("angle_deg"))


def trajectory_error(pairs: DataFrame, video: str) -> DataFrame:
    """video, ate_rmse, ate_worst, ate_percent after B's camera centres are fitted to A's; of three frames or more."""
    a, b = rot.cols("a"), rot.cols("b")
    _, ca = rot.rigid_inverse(rot.from_6d(a[3:]), a[:3])
    _, cb = rot.rigid_inverse(rot.from_6d(b[3:]), b[:3])
    points = pairs.select(video, *[x.alias(n) for x, n in zip([*cb, *ca], ("sx", "sy", "sz", "dx", "dy", "dz"), strict=True)])
    fits = similarity.fit_similarity(points, [video]).where("n >= 3")
    moved = points.join(fits, video).withColumn("err2", F.expr(" + ".join(f"pow(s * (" + " + ".join(f"r[{3 * i + k}] * {'sx sy sz'.split()[k]}" for k in range(3)) + f") + t[{i}] - {'dx dy dz'.split()[i]}, 2)" for i in range(3))))
    extent = F.sqrt(sum((F.pow(F.max(c) - F.min(c), 2) for c in ("dy", "dz")), F.pow(F.max("dx") - F.min("dx"), 2)))
    out = moved.groupBy(video).agg(F.sqrt(F.avg("err2")).alias("ate_rmse"), F.sqrt(F.max("err2")).alias("ate_worst"), extent.alias("extent"))
    return out.withColumn("ate_percent", F.expr("100 * ate_rmse / greatest(extent, 1e-12D)")).drop("extent")
