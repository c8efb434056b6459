"""Frames that arrive bit by bit: the block operators as Structured Streaming.

Frames of a video must arrive in order. State per video is the last keyframe, or the aligned overlap
and transform of the block before; results equal the batch operators' over the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import models
from ..operators import depth, similarity, store


def keyframe_stream(frames: DataFrame, video: str, frame: str, interval: int = 30) -> DataFrame:
    """Keyframes as they are reached, without the forced last one: the state is the last keyframe."""
    kind = dict(frames.dtypes)[video]

    def scan(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        found = []
        for x in sorted(v for b in batches for v in b[frame].tolist()):
            if last is None or x - last >= interval:
                found.append(x)
                last = x
        if last is not None:
            state.update((int(last),))
        if found:
            yield pd.DataFrame({video: [key[0]] * len(found), frame: found})

    return frames.select(video, frame).groupBy(video).applyInPandasWithState(scan, f"{video} {kind}, {frame} bigint", "last bigint", "append", GroupStateTimeout.NoTimeout)


def dino_stream(frames: DataFrame, kept: store.FeatureStore, model: str = "stub", checkpoint: str | None = None) -> DataStreamWriter:
    """A writer that puts each micro-batch's tokens into the store as a block: models of single frames carry no
    state. The first batch replaces what the videos had; a batch that comes again counts once. Mark the
    branch complete (FeatureStore.mark_complete) once the stream is over."""

    def flush(batch: DataFrame, number: int) -> None:
        rows = models.per_frame(batch, "dino", "vec", "array<double>", model).withColumn("token_idx", F.lit(0))
        kept.write("dino", rows, block_id=number, reset=number == 0, complete=False)

    writer = frames.writeStream.foreachBatch(flush)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def depth_stream(blocks: DataFrame, video: str, block: str, frame: str, value: str, write_from: str, min_points: int = 1) -> DataFrame:
    """Aligned depth of each block's written rows. The state holds the last block's aligned rows."""
    kind = dict(blocks.dtypes)[video]

    def align(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        prev = pd.DataFrame({frame: state.get[0], value: state.get[1]}) if state.exists else None
        rows = pd.concat(list(batches))
        for _, now in rows.groupby(block, sort=True):
            now = now.sort_values(frame).reset_index(drop=True)
            if prev is not None:
                both = now.merge(prev, on=frame, suffixes=("", "_prev"))
                x, y = both[value].to_numpy(float), both[value + "_prev"].to_numpy(float)
                ok = (x > depth.MIN_DEPTH) & (y > depth.MIN_DEPTH)
                x, y = x[ok], y[ok]
                if len(x) >= min_points:
                    sxx = ((x - x.mean()) ** 2).sum()
                    flat = sxx < depth.MIN_SPREAD
                    a = 1.0 if flat else ((x - x.mean()) * (y - y.mean())).sum() / sxx
                    now[value] = now[value] * a + (max(0.0, y.mean() - x.mean()) if flat else y.mean() - a * x.mean())
            yield now.loc[now[write_from], [video, frame, value]]
            prev = now[[frame, value]]
        state.update((prev[frame].tolist(), prev[value].tolist()))

    return blocks.groupBy(video).applyInPandasWithState(align, f"{video} {kind}, {frame} bigint, {value} double", "frames array<bigint>, vals array<double>", "append", GroupStateTimeout.NoTimeout)


def _fit(x: np.ndarray, y: np.ndarray, min_points: int) -> tuple[float, float]:
    """depth.fit_affine() of two arrays."""
    ok = np.isfinite(x) & np.isfinite(y) & (x > depth.MIN_DEPTH) & (y > depth.MIN_DEPTH)
    x, y = x[ok], y[ok]
    if len(x) < min_points:
        raise ValueError(f"fewer than {min_points} valid pixels")
    sxx = ((x - x.mean()) ** 2).sum()
    if sxx < depth.MIN_SPREAD:
        return 1.0, max(0.0, float(y.mean() - x.mean()))
    a = float(((x - x.mean()) * (y - y.mean())).sum() / sxx)
    return a, float(y.mean() - a * x.mean())


def metric_depth_stream(blocks: DataFrame, interval: int = 30, min_points: int = 1024, zmin: float = 0.1, zmax: float = 100.0, mode: str = "video_depth_anything") -> DataFrame:
    """video_id, frame_idx, depth (inverse) of the written rows of blocks of frames (video_id, block_id,
    frame_idx, written, pixels), as extraction.depth_windows() gives them. The state is the last block's
    aligned rows and its last keyframe's index, scale and shift."""
    kind = dict(blocks.dtypes)["video_id"]
    window, single = models.get("depth", mode), models.get("depth", "depth_pro")

    def align(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        prev, anchor = ({}, None) if not state.exists else (dict(zip(state.get[0], state.get[1], strict=True)), tuple(state.get[2:5]))
        for _, now in pd.concat(list(batches)).groupby("block_id", sort=True):
            now = now.sort_values("frame_idx").reset_index(drop=True)
            raw = np.stack([np.asarray(x, float) for x in window(now)])
            idx = now["frame_idx"].tolist()
            shared = [i for i, f in enumerate(idx) if not now["written"][i] and f in prev]
            if shared:
                a, h = _fit(raw[shared].ravel(), np.concatenate([np.asarray(prev[idx[i]]) for i in shared]), min_points)
                raw = raw * a + h
            carried = anchor if shared else None
            last, keys = (carried[0] if carried else None), []
            for i, f in enumerate(idx):
                if last is None or f - last >= interval:
                    keys.append(i)
                    last = f
            if not keys or keys[-1] != len(idx) - 1:
                keys.append(len(idx) - 1)
            metric = single(now.iloc[keys].reset_index(drop=True))
            anchors = ([carried] if carried else []) + [(idx[i], *_fit(raw[i], np.asarray(m, float), min_points)) for i, m in zip(keys, metric, strict=True)]
            at, scales, shifts = (np.array(x, float) for x in zip(*anchors))
            scale, shift = np.interp(idx, at, scales)[:, None], np.interp(idx, at, shifts)[:, None]
            z = np.clip(raw * scale + shift, zmin, zmax)
            inv = np.clip((1 / z - 1 / zmax) / (1 / zmin - 1 / zmax + 1e-8), 0, 1)
            written = now["written"].to_numpy(bool)
            yield pd.DataFrame({"video_id": key[0], "frame_idx": now["frame_idx"][written], "depth": [x.tolist() for x in inv[written]]})
            prev, anchor = dict(zip(idx, raw.tolist(), strict=True)), anchors[-1]
        state.update((list(prev), list(prev.values()), int(anchor[0]), float(anchor[1]), float(anchor[2])))

    return blocks.groupBy("video_id").applyInPandasWithState(
        align, f"video_id {kind}, frame_idx bigint, depth array<double>", "frames array<bigint>, vals array<array<double>>, at bigint, scale double, shift double", "append", GroupStateTimeout.NoTimeout
    )


def pose_stream(windows: DataFrame, video: str, block: str, frame: str, write_from: str, min_spread: float = 1e-4) -> DataFrame:
    """Camera-to-world centres cx, cy, cz and rotations r0..r8 of each window in the first one's world.

    A window is moved onto the last one's placed rows by a similarity of the centres that they share, or
    with scale 1 by the orientations, where fewer than three are shared or they hardly differ. The state
    holds the last window's placed rows.
    """
    kind = dict(windows.dtypes)[video]
    names = ["cx", "cy", "cz", *[f"r{i}" for i in range(9)]]

    def stitch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        prev = dict(zip(state.get[0], state.get[1], strict=True)) if state.exists else {}
        for _, now in pd.concat(list(batches)).groupby(block, sort=True):
            now = now.sort_values(frame).reset_index(drop=True)
            values = now[names].to_numpy(float)
            shared = [i for i, f in enumerate(now[frame]) if f in prev and not now[write_from][i]]
            if shared:
                s, d = values[shared], np.array([prev[now[frame][i]] for i in shared])
                scale, turn, move = similarity.robust(s[:, :3], d[:, :3], s[:, 3:].reshape(-1, 3, 3), d[:, 3:].reshape(-1, 3, 3), min_spread)
                centres = scale * values[:, :3] @ turn.T + move
                values = np.concatenate([centres, (turn @ values[:, 3:].reshape(-1, 3, 3)).reshape(-1, 9)], axis=1)
            out = pd.DataFrame(values, columns=names).assign(**{video: key[0], frame: now[frame]})
            yield out.loc[now[write_from].to_numpy(bool), [video, frame, *names]]
            prev = dict(zip(now[frame].tolist(), values.tolist(), strict=True))
        state.update((list(prev), list(prev.values())))

    fields = f"{video} {kind}, {frame} bigint, " + ", ".join(f"{n} double" for n in names)
    return windows.groupBy(video).applyInPandasWithState(stitch, fields, "frames array<bigint>, vals array<array<double>>", "append", GroupStateTimeout.NoTimeout)
