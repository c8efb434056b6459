"""Where videos come from: files under a root, ids, collisions, synthetic frames, assets."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Endings of video files, in the spellings that count.
EXTENSIONS = ("mp4", "avi", "mkv", "webm", "mov", "MP4", "AVI")
ASSETS_VARIABLE = "FRAMELAKE_ASSETS"


def find_videos(spark: SparkSession, root: str) -> DataFrame:
    """path, length of the video files under a root, by path. Listed through Hadoop's file system, so that
    empty files, which the binaryFile source leaves out, are there; contents aren't read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(root)
    listed, rows = at.getFileSystem(conf).listFiles(at, True), []
    while listed.hasNext():
        f = listed.next()
        path = f.getPath().toString()
        if path.rsplit(".", 1)[-1] in EXTENSIONS:
            rows.append((path, int(f.getLen())))
    return spark.createDataFrame(sorted(rows), "path string, length bigint").orderBy("path")


def first_by_path(videos: DataFrame, path: str, n: int | None, tie: str | None = None) -> DataFrame:
    """The first n by path; all where n is null."""
    ordered = videos.orderBy(path, *([tie] if tie else []))
    return ordered if n is None else ordered.limit(n)


def video_id(path: str, stem_only: bool = False) -> Column:
    """Parent folder and stem joined by an underscore, or the stem alone."""
    stem = f"regexp_replace(element_at(split({path}, '/'), -1), '\\\\.[^.]*$', '')"
    if stem_only:
        return F.expr(stem)
    parent = f"case when contains({path}, '/') then element_at(split({path}, '/'), -2) else '' end"
    return F.expr(f"case when ({parent}) = '' then {stem} else concat({parent}, '_', {stem}) end")


def collisions(videos: DataFrame, video: str) -> DataFrame:
    """Ids that more than one source has."""
    return videos.groupBy(video).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def ramp_frames(spark: SparkSession, n_frames: int = 12, width: int = 128, height: int = 96, step: int = 20) -> DataFrame:
    """Frames of one grey each, i * step: what is needed to see which frame was read."""
    return spark.range(n_frames).selectExpr("'ramp' as video_id", "id as frame_idx", f"{height} as height", f"{width} as width", f"cast(id * {step} as double) as grey")


def gradient_frames(spark: SparkSession, n_frames: int = 8, width: int = 128, height: int = 96) -> DataFrame:
    """Frames that go from 0 to 255 along every row."""
    row = f"transform(sequence(0, {width - 1}), i -> cast(floor(i * 255D / {max(width - 1, 1)}) as smallint))"
    return spark.range(n_frames).selectExpr("'gradient' as video_id", "id as frame_idx", f"{height} as height", f"{width} as width", f"{row} as row")


def assets_root(explicit: str | None = None) -> Path:
    """The argument, else the environment's folder, else the package's; ~ is expanded."""
    return Path(explicit or os.environ.get(ASSETS_VARIABLE) or Path(__file__).resolve().parents[1]).expanduser()


def find_checkpoint(files: DataFrame, path: str = "path", length: str = "length", names: tuple[str, ...] = ("model.safetensors", "model.pt")) -> str:
    """The last path by name of the first file name that is there; an error if none is. `files` is a listing
    of one model's folder."""
    for name in names:
        found = files.where(F.element_at(F.split(path, "/"), -1) == name).agg(F.max(path)).first()[0]
        if found:
            return found
    raise FileNotFoundError(f"none of {', '.join(names)}")


def largest_file(files: DataFrame, min_bytes: int = 100 << 20, path: str = "path", length: str = "length") -> str | None:
    """The largest file above a size, or none."""
    return files.where(F.col(length) > min_bytes).agg(F.max_by(path, length)).first()[0]
