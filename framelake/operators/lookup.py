"""Lookups by frame: requests in order, intersections, alignment, outer assembly, resume."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbered(request: DataFrame, frames: str, by: str | None = None, frame: str = "frame_idx") -> DataFrame:
    """Explodes an array of requested frames into pos and frame."""
    keep = [by] if by else []
    return request.select(*keep, F.posexplode(frames).alias("pos", frame))


def requested_rows(request: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows of the requested keys. `pos` keeps the request's order, repeats stay, misses are left out."""
    return request.join(stored, keys, "inner")


def last_stored(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the last in `order`."""
    by = ", ".join(keys)
    return rows.withColumn("lookup__i", F.expr(f"row_number() over (partition by {by} order by {order} desc)")).where("lookup__i = 1").drop("lookup__i")


def common_frames(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present in both stores, once each."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "inner")


def alignment(requested: DataFrame, stored: DataFrame, keys: list[str], position: str, frame: str) -> DataFrame:
    """keys, n_requested, n_stored, aligned: whether both list the same frames at the same positions."""
    a = requested.select(*keys, position, F.col(frame).alias("align__a"), F.lit(1).alias("align__in_a"))
    b = stored.select(*keys, position, F.col(frame).alias("align__b"), F.lit(1).alias("align__in_b"))
    both = a.join(b, [*keys, position], "full_outer")
    return both.groupBy(*keys).agg(
        F.count("align__in_a").alias("n_requested"), F.count("align__in_b").alias("n_stored"), F.expr("bool_and(align__in_a is not null and align__in_b is not null and align__a <=> align__b)").alias("aligned")
    )


def read_all(branches: list[DataFrame], keys: list[str], strict: bool = False) -> DataFrame:
    """Branches side by side: an absent branch has null columns, or drops the key where `strict`."""
    return reduce(lambda a, b: a.join(b, keys, "inner" if strict else "full_outer"), branches)


def primary_branch(rows: DataFrame, key: str, branch: str, order: tuple[str, ...]) -> DataFrame:
    """The first branch in `order` that each key has; keys with none of them are absent."""
    ranks = F.create_map(*[x for i, b in enumerate(order) for x in (F.lit(b), F.lit(i))])
    found = rows.where(F.col(branch).isin(*order)).groupBy(key).agg(F.min(F.element_at(ranks, F.col(branch))).alias("lookup__rank"))
    return found.select(key, F.element_at(F.array(*[F.lit(b) for b in order]), F.col("lookup__rank") + 1).alias(branch))


def todo(videos: DataFrame, completion: DataFrame, key: str, branches: list[str]) -> DataFrame:
    """Videos of which some branch is not complete. The latest attempt counts; no branches, nothing to do."""
    if not branches:
        return videos.limit(0)
    latest = completion.where(F.col("branch").isin(*branches)).groupBy(key, "branch").agg(F.max_by("complete", "attempt").alias("complete"))
    done = latest.where("complete").groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(f"n = {len(set(branches))}").select(key)
    return videos.join(done, key, "left_anti")
