"""A feature store: Parquet by branch and video, with completion committed after the data.

Data of a write go to `data/branch=…/video_id=…/attempt=…`; a row in `commits` names the attempt that
counts. Readers see committed attempts only, so a failed or repeated write leaves no half rows and an
overwritten video is never complete on old or partial data.
"""

from __future__ import annotations

import secrets
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .. import schema
from . import depth, lookup

FIELDS = {
    "dino": "frame_idx bigint, camera_key string, token_idx int, vec array<float>",
    "depth": "frame_idx bigint, camera_key string, height int, width int, px array<int>",
    "pose": "frame_idx bigint, pose array<float>",
}
COMMIT = "branch string, video_id string, attempt bigint, block_id bigint, reset boolean, complete boolean, representation string, scale double"


class FeatureStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _data(self, branch: str) -> str:
        if branch not in FIELDS:
            raise ValueError(f"unknown branch {branch!r}")
        return f"{self.root}/data/branch={branch}"

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT).parquet(f"{self.root}/commits")
        except AnalysisException:
            return self.spark.createDataFrame([], COMMIT)

    def _commit(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/commits")

    def _next_attempt(self) -> int:
        """Above all that were committed, and another for every writer: the time, and chance below its resolution."""
        return max((self.commits().agg(F.max("attempt")).first()[0] or 0) + 1, time.time_ns() // 1000 * 1000 + secrets.randbelow(1000))

    def write(self, branch: str, rows: DataFrame, *, block_id: int | None = None, reset: bool = True, complete: bool = True, representation: str | None = None) -> None:
        """Writes rows of one or many videos (video_id and the branch's fields) as one attempt.

        `reset` replaces what the videos had in this branch; otherwise the rows are appended, and a
        block_id written before is replaced, so that a repeated block counts once. Depth values are
        given as `depth` (0 to 1) and stored as whole numbers.
        """
        path, attempt = self._data(branch), self._next_attempt()
        if branch == "depth" and "depth" in rows.columns:
            rows = rows.withColumn("px", F.expr("transform(depth, x -> if(isnan(x), raise_error('depth is not a number'), cast(rint(least(greatest(cast(x as float), cast(0 as float)), cast(1 as float)) * cast(65535 as float)) as int)))"))
        names = [f.split()[0] for f in FIELDS[branch].split(", ")]
        have = rows.columns
        fields = FIELDS[branch].split(", ")
        cast = [F.col(n).cast(f.split(" ", 1)[1]).alias(n) if n in have else F.lit(None).cast(f.split(" ", 1)[1]).alias(n) for n, f in zip(names, fields, strict=True)]
        rows.select(*cast, "video_id", F.lit(attempt).alias("attempt")).write.partitionBy("video_id", "attempt").mode("append").parquet(path)
        if branch == "pose" and representation is None:
            kind = F.when(F.max(F.size("pose")) == 6, "se3_log").otherwise("translation_rot6d")
        else:
            kind = F.lit(representation or {"dino": "patch_tokens", "depth": "uint16"}.get(branch))
        done = self.spark.read.schema(f"{FIELDS[branch]}, video_id string, attempt bigint").parquet(path).where(F.col("attempt") == attempt).groupBy("video_id").agg(kind.alias("representation"))
        self._commit(
            done.select(
                F.lit(branch).alias("branch"), "video_id", F.lit(attempt).cast("bigint").alias("attempt"), F.lit(block_id).cast("bigint").alias("block_id"), F.lit(reset).alias("reset"), F.lit(complete).alias("complete"), "representation", F.lit(float(depth.SCALE) if branch == "depth" else None).cast("double").alias("scale")
            )
        )

    def write_episode(self, dino: DataFrame, depths: DataFrame, pose: DataFrame) -> None:
        for branch, rows in (("dino", dino), ("depth", depths), ("pose", pose)):
            self.write(branch, rows)

    def mark_complete(self, branch: str, video_ids: list[str]) -> None:
        """Marks what was appended as complete; a video without data gets a marker alone."""
        attempt = self._next_attempt()
        self._commit(self.spark.createDataFrame([(branch, v, attempt, None, False, True, None, None) for v in video_ids], COMMIT))

    def _live(self, branch: str) -> DataFrame:
        """Attempts that count: since the last reset, and of each block the last."""
        c = self.commits().where(F.col("branch") == branch)
        since = c.where("reset").groupBy("video_id").agg(F.max("attempt").alias("since"))
        kept = c.join(since, "video_id", "left").where("attempt >= coalesce(since, 0) and representation is not null")
        return kept.withColumn("unit", F.coalesce("block_id", -F.col("attempt"))).groupBy("video_id", "unit").agg(F.max("attempt").alias("attempt")).drop("unit")

    def read(self, branch: str, request: DataFrame | None = None) -> DataFrame:
        """video_id and the branch's fields, depth divided by its scale; with a request (video_id, pos,
        frame_idx) its rows in order of pos, misses left out. A frame stored twice counts once, as last written."""
        try:
            rows = self.spark.read.schema(f"{FIELDS[branch]}, video_id string, attempt bigint").parquet(self._data(branch))
        except AnalysisException:
            rows = self.spark.createDataFrame([], f"{FIELDS[branch]}, video_id string, attempt bigint")
        rows = rows.join(self._live(branch), ["video_id", "attempt"])
        unit = ["video_id", "frame_idx"] + (["camera_key"] if branch != "pose" else []) + (["token_idx"] if branch == "dino" else [])
        rows = lookup.last_stored(rows, unit, "attempt").drop("attempt")
        if branch == "depth":
            rows = rows.withColumn("depth", F.expr(f"transform(px, x -> cast(cast(x as float) / cast({depth.SCALE} as float) as float))"))
        return rows if request is None else lookup.requested_rows(request, rows, ["video_id", "frame_idx"])

    def read_all(self, strict: bool = False) -> DataFrame:
        """dino (tokens in order), depth and pose of each frame side by side; cameras' rows are left out."""
        dino = self.read("dino").where("camera_key is null").groupBy("video_id", "frame_idx").agg(F.expr("transform(array_sort(collect_list(struct(token_idx, vec))), x -> x.vec)").alias("dino"))
        depths = self.read("depth").where("camera_key is null").select("video_id", "frame_idx", "depth", "height", "width")
        pose = self.read("pose").select("video_id", "frame_idx", "pose")
        return lookup.read_all([dino, depths, pose], ["video_id", "frame_idx"], strict)

    def completion(self) -> DataFrame:
        """video_id, branch, complete, attempt: what the latest commit says."""
        return self.commits().groupBy("video_id", "branch").agg(F.max_by("complete", "attempt").alias("complete"), F.max("attempt").alias("attempt"))

    def todo(self, videos: DataFrame, branches: list[str]) -> DataFrame:
        return lookup.todo(videos, self.completion(), "video_id", branches)

    def list_videos(self) -> DataFrame:
        return self.commits().select("video_id").distinct().orderBy("video_id")

    def exists(self, video_id: str) -> bool:
        return not self.commits().where(F.col("video_id") == video_id).isEmpty()

    def frame_indices(self, branch: str) -> DataFrame:
        return self.read(branch).select("video_id", "frame_idx").distinct()

    def primary_frame_indices(self) -> DataFrame:
        """video_id, frame_idx of the first branch that each video has."""
        all_ = None
        for b in schema.BRANCHES:
            one = self.frame_indices(b).withColumn("branch", F.lit(b))
            all_ = one if all_ is None else all_.unionByName(one)
        first = lookup.primary_branch(all_, "video_id", "branch", schema.BRANCHES)
        return all_.join(first, ["video_id", "branch"]).select("video_id", "frame_idx")

    def inspect(self) -> DataFrame:
        """video_id, branch, n_frames, width (tokens by size, pixels, or numbers of a pose), representation, complete."""
        latest = self.commits().where("representation is not null").groupBy("video_id", "branch").agg(F.max_by("representation", "attempt").alias("representation"))
        dino = self.read("dino").groupBy("video_id").agg(F.countDistinct("frame_idx").alias("n_frames"), F.max(F.size("vec")).cast("bigint").alias("width")).withColumn("branch", F.lit("dino"))
        deep = self.read("depth").groupBy("video_id").agg(F.countDistinct("frame_idx").alias("n_frames"), F.max(F.size("px")).cast("bigint").alias("width")).withColumn("branch", F.lit("depth"))
        pose = self.read("pose").groupBy("video_id").agg(F.countDistinct("frame_idx").alias("n_frames"), F.max(F.size("pose")).cast("bigint").alias("width")).withColumn("branch", F.lit("pose"))
        return dino.unionByName(deep).unionByName(pose).join(latest, ["video_id", "branch"], "left").join(self.completion().drop("attempt"), ["video_id", "branch"], "left")


def annotations(videos: DataFrame, completion: DataFrame, fps: float = 30.0) -> DataFrame:
    """Annotation stubs of videos (video_id, path, n_frames); depth and pose are claimed where complete."""
    has = completion.where("complete").groupBy("video_id").agg(F.expr("bool_or(branch = 'depth')").alias("has_depth"), F.expr("bool_or(branch = 'pose')").alias("has_pose"))
    no = F.lit(False)
    return videos.join(has, "video_id", "left").select(
        "video_id", F.col("path").alias("video_path"), F.lit(fps).alias("fps"), F.coalesce("n_frames", F.lit(0)).cast("bigint").alias("num_frames"), no.alias("has_state"), no.alias("has_action"), no.alias("has_weak_action"), no.alias("has_strong_action"), F.coalesce("has_depth", no).alias("has_depth"), F.coalesce("has_pose", no).alias("has_pose"), F.lit(None).cast("int").alias("state_dim"), F.lit(None).cast("int").alias("action_dim"), F.lit(None).cast("array<double>").alias("state"), F.lit(None).cast("array<double>").alias("action"), F.lit("framelake").alias("source")
    )


def write_annotations(rows: DataFrame, path: str) -> None:
    """JSON, nulls included; videos that have an annotation are left alone."""
    spark = rows.sparkSession
    try:
        old = spark.read.schema(schema.ANNOTATION).json(path).select("video_id")
        rows = rows.join(old, "video_id", "left_anti")
    except AnalysisException:
        pass
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)
