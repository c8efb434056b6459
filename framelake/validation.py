"""Validation from the command line: invariants on synthetic frames, timings on real ones, a report, an exit code."""

from __future__ import annotations

import argparse
import resource
import sys
import time
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import models, schema, session
from .functions import rotation as rot
from .operators import depth, extraction, sampling, store, validate
from .sources import files, video

#: Valid pixels that a fit needs on the grids that frames are read as.
MIN_POINTS = 16


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="framelake-validate", description="Invariants, timings and a report.")
    p.add_argument("--data_root", "--data-root")
    p.add_argument("--report", default="validation_report.md")
    p.add_argument("--device", default="cuda")
    p.add_argument("--branches", default="dino,depth,pose")
    p.add_argument("--depth_mode", "--depth-mode", default="video_depth_anything", choices=models.DEPTH_MODES)
    p.add_argument("--frames-sweep", default="16,32,64,128")
    p.add_argument("--perf-frames", type=int, default=64)
    p.add_argument("--assets_root", "--assets-root")
    p.add_argument("--skip-perf", action="store_true")
    p.add_argument("--skip-sanity", action="store_true")
    return p


def synthetic(spark: SparkSession, n: int = 12) -> DataFrame:
    """One video of gradients, a block of its own."""
    ramp = files.ramp_frames(spark, n).drop("height", "width")
    return ramp.selectExpr("*", "frame_idx as row_pos", f"{n}L as n_frames", "0L as block_id", "true as written", "transform(sequence(0, 63), i -> (grey + 5 * i) % 256D) as pixels")


def branch_rows(branch: str, frames: DataFrame, depth_mode: str) -> DataFrame:
    """A branch's rows; raises what a model raised."""
    got: dict[str, DataFrame] = {}
    failed = extraction.extract(frames, [branch], got.__setitem__, depth_mode=depth_mode, min_points=MIN_POINTS, streamed="false").first()
    if failed:
        raise RuntimeError(failed["error"])
    return got[branch]


def branch_checks(branch: str, frames: DataFrame, depth_mode: str, kept: store.FeatureStore) -> list[DataFrame]:
    """Values, determinism (of what models give frame by frame), storage and alignment of one branch."""
    rows = branch_rows(branch, frames, depth_mode)
    kept.write(branch, rows)
    back = kept.read(branch)
    out = []
    if branch == "pose":
        numbered = rows.select(F.expr("frame_idx as pos"), *[F.col("pose")[i].alias(f"p{i}") for i in range(len(rot.IDENTITY_POSE))])
        out.append(validate.check_pose(numbered, "pos"))
    else:
        column = "vec" if branch == "dino" else "depth"
        values = rows.select(F.explode(column).alias("x"))
        out.append(validate.check_values(values, branch, "x") if branch == "dino" else validate.check_values(values, branch, "x", 0, 1))
        out.append(validate.check_determinism(rows, branch_rows(branch, frames, depth_mode), branch, ["video_id", "frame_idx"], column))
    column, limit = {"dino": ("vec", 0.0), "depth": ("depth", 2.0 / depth.SCALE), "pose": ("pose", 0.0)}[branch]
    pairs = rows.select("video_id", "frame_idx", F.col(column).cast("array<float>").alias("a")).join(back.select("video_id", "frame_idx", F.col(column).alias("b")), ["video_id", "frame_idx"])
    flat = pairs.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select(F.col("p.a").cast("double").alias("a"), F.col("p.b").cast("double").alias("b"))
    out.append(validate.check_round_trip(flat, branch, "a", "b", limit))
    out.append(validate.check_alignment(frames, back, branch))
    return out


def run_sanity(spark: SparkSession, branches: list[str], depth_mode: str) -> DataFrame:
    """Checks of all branches on a synthetic video; a branch that can't run is a failed check."""
    frames = session.written(synthetic(spark), "synthetic")
    kept = store.FeatureStore(spark, session.new_path(spark, "validation"))
    made: list[DataFrame] = []
    for branch in branches:
        try:
            made += [session.written(x, "checks") for x in branch_checks(branch, frames, depth_mode, kept)]
        except Exception as e:  # whatever it is, the report tells it
            made.append(spark.createDataFrame([validate.failed_check(branch, "runs", e)], schema.CHECKS))
    return reduce(DataFrame.unionByName, made) if made else spark.createDataFrame([], schema.CHECKS)


def measured(video_id: str, branch: str, frames: int, run: Callable[[], object], note: str = "") -> tuple:
    """A record of PERF without rates; an error is a record with its note."""
    start = time.perf_counter()
    try:
        run()
    except Exception as e:
        note, frames = f"{note} ERROR: {e}".strip(), 0
    return video_id, branch, frames, round(time.perf_counter() - start, 6), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024, note


def run_perf(spark: SparkSession, root: str, branches: list[str], depth_mode: str, n: int, sweep: list[int], openers: tuple[video.Opener, ...]) -> DataFrame:
    """Timings of decoding, of each branch, and of the first branch over a sweep of frame counts, on the first video."""
    kind = "video_id string, branch string, frames bigint, seconds double, peak_bytes bigint, note string"
    found = files.find_videos(spark, root).limit(1).withColumn("video_id", files.video_id("path", True)).first()
    if found is None:
        records = [("-", "perf", 0, 0.0, 0, "SKIPPED: no videos")]
    else:
        name, records = found["video_id"], []
        total = len(video.open_video(found["path"], openers))

        def read(count: int) -> DataFrame:
            asked = spark.range(total).selectExpr(f"'{found['path']}' as path", f"'{name}' as video_id", "id as frame_idx", f"{total}L as total").where(sampling.sampled("frame_idx", "total", count))
            step, taken = max(1, total // max(count, 1)), min(total, count)
            placed = asked.selectExpr("path", "video_id", "frame_idx", f"frame_idx div {step} as row_pos", f"{taken}L as n_frames")
            return session.written(video.read_blocks(placed, max(taken, 1), 0, openers, "true"), "perf")

        def branch(b: str, count: int, frames: DataFrame, note: str = "", as_: str = name) -> None:
            records.append(measured(as_, b, min(count, total), lambda: branch_rows(b, frames.drop("error"), depth_mode).count(), note))

        records.append(measured(name, "decode", min(n, total), lambda: read(n)))
        frames = read(n)
        for b in branches:
            branch(b, n, frames)
        for count in sweep if branches else []:
            branch(branches[0], count, read(count), f"sweep frames={count}", f"{name}@{count}")
    return validate.performance(spark.createDataFrame(records, kind))


def main(argv: list[str] | None = None, openers: tuple[video.Opener, ...] = (video.DecordReader, video.PyAVReader)) -> int:
    """Writes the report; 0 only if all invariants hold."""
    given = sys.argv[1:] if argv is None else argv
    args = parser().parse_args(given)
    if not args.skip_perf and not args.data_root:
        parser().error("timings need --data_root (or --skip-perf)")
    spark = session.session()
    session.ship(spark)
    branches = sampling.parse_branches(args.branches)
    checks = spark.createDataFrame([], schema.CHECKS) if args.skip_sanity else run_sanity(spark, branches, args.depth_mode)
    sweep = [int(x) for x in args.frames_sweep.split(",") if x.strip()]
    perf = run_perf(spark, args.data_root, branches, args.depth_mode, args.perf_frames, sweep, openers) if not args.skip_perf else validate.performance(spark.createDataFrame([], "video_id string, branch string, frames bigint, seconds double, peak_bytes bigint, note string"))
    text = validate.report(validate.environment(), checks, perf, " ".join(["python -m framelake.validation", *given]))
    Path(args.report).write_text(text, encoding="utf-8")
    told = validate.summary(checks).first()
    print(f"{args.report}: {told['n_pass']} of {told['n_total']} invariants hold")
    return 0 if told["overall"] == "PASS" else 1


if __name__ == "__main__":
    sys.exit(main())
