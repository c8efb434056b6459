"""Extraction from the command line: sources, samples, resume, branches, annotations, exit code."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import models, session
from .operators import extraction, sampling, store
from .sources import files, video


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="framelake", description="Per-frame features of videos into a store.")

    def add(name: str, **more: object) -> None:
        p.add_argument(f"--{name}", *([f"--{name.replace('_', '-')}"] if "_" in name else []), dest=name, **more)

    add("data_root", required=True, help="folder that has the videos")
    add("output_root", required=True, help="folder of the store")
    add("num_samples", type=int, help="only the first so many videos by path")
    add("device", default="cuda", help="what models are told; executors decide what they have")
    add("branches", default="dino,depth,pose")
    add("resume", action="store_true", help="leave out videos whose branches are complete")
    add("future_horizon", type=int, default=4, help="accepted, without effect")
    add("frames_per_video", type=int, default=120, help="frames sampled of each video; all where not above 0")
    add("block_size", type=int, default=1024, help="frames of a block of a streamed video")
    add("pose_window", type=int, default=64, help="frames of a window of poses of a streamed video")
    add("depth_overlap", type=int, default=96, help="frames that blocks share")
    add("pose_overlap", type=int, default=16, help="frames that windows of poses share")
    add("stream_threshold", type=int, default=2000, help="videos with more sampled frames go through blocks, others are one")
    add("dino_model", default="dinov3_vits16")
    add("depth_mode", default="video_depth_anything", choices=models.DEPTH_MODES)
    add("vda_input_size", type=int, default=224, help="what the depth model is told")
    add("annotation_dir", help="folder of annotations; output_root/annotations where not given")
    add("id_from_stem", action="store_true", help="the file's stem alone is the id")
    add("assets_root", help="folder of model files")
    add("min_points", type=int, default=1024, help="valid pixels that a fit of depths needs; frames are grids of 64")
    return p


def extract(spark: SparkSession, args: argparse.Namespace, openers: tuple[video.Opener, ...] = (video.DecordReader, video.PyAVReader)) -> DataFrame:
    """Runs the branches over all videos; video_id, status, branch, error of each. Raises where there are none.

    Videos with more sampled frames than the threshold are read, decoded and modelled block by block;
    others are one block. What fails is told by branch, and other videos go on.
    """
    branches = sampling.parse_branches(args.branches)
    found = files.first_by_path(files.find_videos(spark, args.data_root), "path", args.num_samples).withColumn("video_id", files.video_id("path", args.id_from_stem)).drop("length")
    if found.isEmpty():
        raise FileNotFoundError(f"no videos under {args.data_root}")
    if not files.collisions(found, "video_id").isEmpty():
        raise ValueError("two videos have the same id")
    kept = store.FeatureStore(spark, args.output_root)
    todo = kept.todo(found, branches) if args.resume else found

    # one task a video: opening it to learn its length
    spread = todo.select("path", "video_id").repartition("path")
    lengths = session.written(spread.mapInPandas(_lengths(openers), "path string, video_id string, n_frames bigint, error string"), "lengths")
    asked = lengths.where("error is null and n_frames > 0").select("path", "video_id", "n_frames", F.expr("explode(sequence(0L, n_frames - 1))").alias("frame_idx"))
    n = args.frames_per_video
    picked = asked.where(sampling.sampled("frame_idx", "n_frames", n))
    # positions and counts in the sample, in closed form
    thin = f"n_frames > {n}" if n and n > 0 else "false"
    picked = picked.selectExpr("path", "video_id", "frame_idx", f"if({thin}, frame_idx div greatest(1, n_frames div {max(n or 1, 1)}), frame_idx) as row_pos", f"if({thin}, least({n or 0}L, ceil(n_frames / greatest(1, n_frames div {max(n or 1, 1)}))), n_frames) as n_frames")
    whole = f"n_frames <= {args.stream_threshold}"
    read = lambda size, overlap, name: session.written(video.read_blocks(picked, size, overlap, openers, whole), name)
    frames = read(args.block_size, args.depth_overlap, "frames")
    poses = read(args.pose_window, args.pose_overlap, "windows") if "pose" in branches else None
    unread = frames.where("error is not null").select("video_id", F.lit("read").alias("branch"), "error")
    unread = unread.unionByName(lengths.where("error is not null").select("video_id", F.lit("read").alias("branch"), "error"))
    good = frames.join(unread.select("video_id").distinct(), "video_id", "left_anti").drop("error")
    windows = None if poses is None else poses.where("error is null").join(unread.select("video_id").distinct(), "video_id", "left_anti").drop("error")
    failed = extraction.extract(
        good, branches, kept.write, dino_model=args.dino_model, depth_mode=args.depth_mode, pose_frames=windows, min_points=args.min_points, streamed=f"n_frames > {args.stream_threshold}"
    )
    notes = args.annotation_dir or f"{args.output_root.rstrip('/')}/annotations"
    store.write_annotations(store.annotations(lengths.select("video_id", "path", "n_frames"), kept.completion()), notes)
    errors = unread.unionByName(failed).groupBy("video_id").agg(F.min(F.struct("branch", "error")).alias("e"))
    status = lengths.select("video_id").join(errors, "video_id", "left")
    return status.select("video_id", F.when(F.col("e").isNull(), "ok").otherwise("failed").alias("status"), F.col("e.branch").alias("branch"), F.col("e.error").alias("error"))


def _lengths(openers: tuple[video.Opener, ...]):
    def run(batches):
        for b in batches:
            n, errors = [], []
            for path in b["path"]:
                try:
                    n.append(len(video.open_video(path, openers)))
                    errors.append(None)
                except Exception as e:
                    n.append(0)
                    errors.append(f"{type(e).__name__}: {e}")
            yield b.assign(n_frames=n, error=errors)

    return run


def main(argv: list[str] | None = None, openers: tuple[video.Opener, ...] = (video.DecordReader, video.PyAVReader)) -> int:
    """0 if every video went well, else 1, also where there are none."""
    args = parser().parse_args(argv)
    spark = session.session()
    session.ship(spark)
    try:
        tally = {r[0]: r[1] for r in extract(spark, args, openers).groupBy("status").count().collect()}
    except FileNotFoundError as e:
        print(e, file=sys.stderr)
        return 1
    print(", ".join(f"{n} {status}" for status, n in sorted(tally.items())) or "nothing to do")
    return int(tally.get("failed", 0) > 0)


if __name__ == "__main__":
    sys.exit(main())
