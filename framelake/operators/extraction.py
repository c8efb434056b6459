"""Branches of features from frames in blocks: models, stitching, metric depth, poses.

Frames are rows video_id, frame_idx, row_pos, n_frames, block_id, written and pixels, grey; see
video.read_blocks(). Every block is a task of its own: its transform into the first block's units follows
from its overlap with the block before it, and these transforms are composed along the video.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import models, session
from ..functions import rotation as rot
from . import alignment, depth, keyframes, similarity

UNIT = ["video_id", "block_id"]


def failures(rows: DataFrame, error: str) -> DataFrame:
    """video_id, error of the videos that a model failed on."""
    return rows.where(F.col(error).isNotNull()).groupBy("video_id").agg(F.min(error).alias("error"))


def dino(frames: DataFrame, model: str = "dinov3_vits16") -> tuple[DataFrame, DataFrame]:
    """video_id, frame_idx, token_idx, vec of the written rows of videos without an error; and the failures."""
    made = session.written(models.per_frame(frames.where("written").select("video_id", "frame_idx", "grey", "pixels"), "dino", "vec", "array<double>", model, errors="failed"), "dino")
    bad = failures(made, "failed")
    return made.join(bad, "video_id", "left_anti").selectExpr("video_id", "frame_idx", "0 as token_idx", "vec"), bad


def _inverse(values: str, scale: str, shift: str, zmin: float, zmax: float) -> str:
    """SQL of an array of inverse depths."""
    z = f"least(greatest(x * {scale} + {shift}, {zmin}D), {zmax}D)"
    return f"transform({values}, x -> case when isnan(x) then x else least(greatest((1D / {z} - {1.0 / zmax}D) / {1.0 / zmin - 1.0 / zmax + 1e-8}D, 0D), 1D) end)"


def depth_frames(frames: DataFrame, mode: str, zmin: float = 0.1, zmax: float = 100.0) -> tuple[DataFrame, DataFrame]:
    """Inverse depth by a model that sees one frame at a time."""
    rows = frames.where("written").select("video_id", "frame_idx", "pixels")
    made = session.written(models.per_frame(rows, "depth", "z", "array<double>", mode, ["frame_idx", "pixels"], "failed"), "depth")
    bad = failures(made, "failed")
    return made.join(bad, "video_id", "left_anti").select("video_id", "frame_idx", F.expr(_inverse("z", "1D", "0D", zmin, zmax)).alias("depth")), bad


def depth_windows(frames: DataFrame, mode: str = "video_depth_anything", interval: int = 30, min_points: int = 1024, zmin: float = 0.1, zmax: float = 100.0, streamed: str = "true") -> tuple[DataFrame, DataFrame]:
    """Inverse depth by a model that sees a block and gives depth in units of its own; and the failures.

    Blocks are aligned to the one before on the rows they share. Each block's keyframes, `interval` apart
    from the last row of the block before (from the first row, without overlap) and its last row, meet the
    metric model; scale and shift between them are interpolated over the source index, with the last row
    of the block before as an anchor. Videos for which `streamed` does not hold are interpolated by row.
    A keyframe or overlap with fewer than `min_points` valid pixels fails its video.
    """
    need = [*UNIT, "frame_idx", "row_pos", "n_frames", "written", "pixels"]
    made = session.written(models.per_block(frames.select(*need), UNIT, "frame_idx", "depth", "raw", "array<double>", mode, "failed"), "raw")
    bad = failures(made, "failed")
    good = made.join(bad, "video_id", "left_anti").drop("failed")

    before = good.select("video_id", "frame_idx", (F.col("block_id") + 1).alias("block_id"), F.col("raw").alias("target"))
    both = good.where("not written").select(*UNIT, "frame_idx", "raw").join(before, [*UNIT, "frame_idx"])
    fits = depth.fit_arrays(both, UNIT, "raw", "target", min_points)
    short = fits.where("scale is null").select("video_id")
    units = good.select(*UNIT).distinct().join(fits.select(*UNIT, "scale", "shift"), UNIT, "left")
    chained = alignment.chain_affine(units, "video_id", "block_id")
    aligned = good.join(chained, UNIT).withColumn("raw", F.expr("transform(raw, x -> x * scale + shift)")).drop("scale", "shift")
    aligned = session.written(aligned.withColumn("carried", F.expr("max(if(written, null, frame_idx)) over (partition by video_id, block_id)")), "aligned")

    keys = keyframes.keyframes(aligned, UNIT, "frame_idx", interval, carried="carried")
    asked = aligned.select(*UNIT, "frame_idx", "raw", "pixels").join(keys, [*UNIT, "frame_idx"])
    metric = session.written(models.per_frame(asked, "depth", "metric", "array<double>", "depth_pro", ["frame_idx", "pixels"], "failed").drop("pixels"), "metric")
    anchors = depth.fit_arrays(metric.where("failed is null"), [*UNIT, "frame_idx"], "raw", "metric", min_points).select(*UNIT, "frame_idx", "scale", "shift")
    last = anchors.groupBy(*UNIT).agg(F.max_by(F.struct("frame_idx", "scale", "shift"), "frame_idx").alias("a")).select("video_id", (F.col("block_id") + 1).alias("block_id"), "a.*")
    few = short.unionByName(anchors.where("scale is null").select("video_id")).distinct().select("video_id", F.lit(f"fewer than {min_points} valid pixels").alias("error"))
    bad = bad.unionByName(failures(metric, "failed")).unionByName(few).groupBy("video_id").agg(F.min("error").alias("error"))

    known = anchors.unionByName(last)
    x = F.expr(f"if({streamed}, frame_idx, row_pos)")
    params = keyframes.interpolate(aligned.drop("pixels", "carried").withColumn("x", x).join(known, [*UNIT, "frame_idx"], "left"), "video_id, block_id", "x", ["scale", "shift"])
    out = params.where("written").join(bad, "video_id", "left_anti")
    return out.select("video_id", "frame_idx", F.expr(_inverse("raw", "scale", "shift", zmin, zmax)).alias("depth")), bad


def pose_windows(frames: DataFrame, model: str = "stub") -> tuple[DataFrame, DataFrame]:
    """video_id, frame_idx, pose (translation and six numbers, relative to the video's first frame) by a model
    that sees a block and gives world-to-camera poses in a world of its own; and the failures.

    Each block is moved onto the one before by a similarity of the camera centres that they share, or of
    the orientations where the centres hardly differ. Without overlap, every block keeps its own world.
    """
    need = [*UNIT, "frame_idx", "row_pos", "written"]
    made = session.written(models.per_block(frames.select(*need), UNIT, "frame_idx", "pose", "m", "array<double>", model, "failed"), "pose")
    bad = failures(made, "failed")
    w2c = made.join(bad, "video_id", "left_anti").select(*need, *[F.col("m")[i].alias(f"w{i}") for i in range(9)], *[F.col("m")[9 + i].alias(f"v{i}") for i in range(3)])
    r, c = rot.rigid_inverse(rot.cols("w"), rot.cols("v", 3))
    c2w = w2c.select(*need, *[x.alias(n) for n, x in rot.named("r", r).items()], *[x.alias(n) for x, n in zip(c, ("cx", "cy", "cz"), strict=True)])

    now = c2w.where("not written").select(*UNIT, "frame_idx", F.col("cx").alias("sx"), F.col("cy").alias("sy"), F.col("cz").alias("sz"), *[F.col(f"r{i}").alias(f"sr{i}") for i in range(9)])
    prev = c2w.select("video_id", "frame_idx", (F.col("block_id") + 1).alias("block_id"), F.col("cx").alias("dx"), F.col("cy").alias("dy"), F.col("cz").alias("dz"), *[F.col(f"r{i}").alias(f"dr{i}") for i in range(9)])
    fits = similarity.fit_similarity(now.join(prev, [*UNIT, "frame_idx"]), UNIT, rotations=True).drop("n")
    alone = c2w.select(*UNIT).distinct().join(fits.select(*UNIT), UNIT, "left_anti").selectExpr(*UNIT, "1D as s", "array(1D,0D,0D,0D,1D,0D,0D,0D,1D) as r", "array(0D,0D,0D) as t", "array(0D,0D,0D) as m", "'similarity' as kind")
    world = similarity.compose(fits.unionByName(alone), "video_id", "block_id")
    # a block that shares no rows with the one before it has no place in its world
    apart = c2w.groupBy(*UNIT).agg(F.expr("bool_and(written) and block_id > 0").alias("apart"))
    placed = world.join(apart, UNIT).selectExpr(*UNIT, "if(apart, 1D, s) as s", "if(apart, array(1D,0D,0D,0D,1D,0D,0D,0D,1D), r) as fr", "if(apart, array(0D,0D,0D), t) as ft")
    moved = similarity.apply_similarity(c2w.where("written").join(placed, UNIT)).drop("s", "fr", "ft")

    r, t = rot.rigid_inverse(rot.cols("r"), [F.col(x) for x in ("cx", "cy", "cz")])
    back = moved.select("video_id", "frame_idx", "row_pos", *[x.alias(n) for n, x in rot.named("r", r).items()], *[x.alias(n) for n, x in rot.named("t", t).items()])
    first = back.where("row_pos = 0").select("video_id", *[F.col(f"{a}{i}").alias(f"f{a}{i}") for a, n in (("r", 9), ("t", 3)) for i in range(n)])
    g, d = rot.relative_pose(rot.cols("r"), rot.cols("t", 3), rot.cols("fr"), rot.cols("ft", 3))
    return back.join(first, "video_id").select("video_id", "frame_idx", F.array(*rot.pose9(d, g)).alias("pose")), bad


def extract(frames: DataFrame, branches: list[str], write: Callable[[str, DataFrame], None], *, dino_model: str = "dinov3_vits16", depth_mode: str = "video_depth_anything", pose_frames: DataFrame | None = None, pose_model: str = "stub", interval: int = 30, min_points: int = 1024, streamed: str = "true") -> DataFrame:
    """Makes the branches one after the other and hands their rows to `write`; video_id, branch, error of what failed.

    A video that fails in a branch is left out of the later ones; what was written of it stays, and other
    videos go on. Poses may have blocks of their own (`pose_frames`).
    """
    mode = models.ALIASES.get(depth_mode, depth_mode)
    failed: list[DataFrame] = []
    for branch in branches:
        given = pose_frames if branch == "pose" and pose_frames is not None else frames
        if failed:
            given = given.join(reduce(DataFrame.unionByName, failed).select("video_id"), "video_id", "left_anti")
        if branch == "dino":
            rows, bad = dino(given, dino_model)
        elif branch == "depth" and mode == "video_depth_anything":
            rows, bad = depth_windows(given, mode, interval, min_points, streamed=streamed)
        elif branch == "depth":
            rows, bad = depth_frames(given, mode)
        else:
            rows, bad = pose_windows(given, pose_model)
        write(branch, rows)
        failed.append(session.written(bad.select("video_id", F.lit(branch).alias("branch"), "error"), "failed"))
    return reduce(DataFrame.unionByName, failed)
