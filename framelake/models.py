"""Model functions by name, with deterministic stand-ins, and how they run over frames and blocks.

A model takes frames as a pandas table and gives one value or vector a row; real weights are loaded by
the function itself, once per worker (see loaded()). Tests and defaults use the stand-ins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Frames = Callable[[pd.DataFrame], pd.Series]

_REGISTRY: dict[tuple[str, str], Frames] = {}

#: Depth modes, and other names of them.
DEPTH_MODES = ("video_depth_anything", "vda", "da3", "depth_pro")
ALIASES = {"vda": "video_depth_anything"}


def register(branch: str, name: str) -> Callable[[Frames], Frames]:
    def add(f: Frames) -> Frames:
        _REGISTRY[branch, name] = f
        return f

    return add


def get(branch: str, name: str = "stub") -> Frames:
    """The model of that name; an unknown one is an error that lists the known."""
    name = ALIASES.get(name, name)
    if (branch, name) not in _REGISTRY:
        raise ValueError(f"no {branch} model {name!r}; there are: {', '.join(sorted(n for b, n in _REGISTRY if b == branch))}")
    return _REGISTRY[branch, name]


@lru_cache(maxsize=8)
def loaded(loader: Callable[[], object]) -> object:
    """What `loader` returns, made once per worker process."""
    return loader()


def _plane(pixels: list[float]) -> np.ndarray:
    return np.asarray(pixels, float) / 255.0 + 1.0


@register("depth", "video_depth_anything")
def window_depth_stub(frames: pd.DataFrame) -> pd.Series:
    """Relative depth of a window's frames: a plane of the pixels, in a scale and shift of the window's own,
    which its first frame decides."""
    first = int(frames["frame_idx"].iloc[0])
    return frames["pixels"].map(lambda p: (_plane(p) * (1.0 + 0.1 * (first % 4)) + 0.2 * (first % 3)).tolist())


@register("depth", "da3")
def frame_depth_stub(frames: pd.DataFrame) -> pd.Series:
    """Depth of a frame alone: the plane."""
    return frames["pixels"].map(lambda p: _plane(p).tolist())


@register("depth", "depth_pro")
def metric_frame_stub(frames: pd.DataFrame) -> pd.Series:
    """Metric depth of a frame alone: three times the plane."""
    return frames["pixels"].map(lambda p: (3.0 * _plane(p)).tolist())


@register("depth", "brittle")
def brittle_depth_stub(frames: pd.DataFrame) -> pd.Series:
    """The plane, but an error where a pixel is saturated: to see what a failing model does."""
    if frames["pixels"].map(max).max() >= 255:
        raise ValueError("saturated")
    return frames["pixels"].map(lambda p: _plane(p).tolist())


@register("dino", "dinov3_vits16")
@register("dino", "stub")
def dino_stub(frames: pd.DataFrame) -> pd.Series:
    """Four numbers, all the frame's mean."""
    return frames["grey"].map(lambda g: [float(g)] * 4)


@register("depth", "stub")
def depth_stub(frames: pd.DataFrame) -> pd.Series:
    """Raw depth of a plane: mean / 255 + 1."""
    return frames["grey"] / 255.0 + 1.0


@register("pose", "stub")
def pose_stub(frames: pd.DataFrame) -> pd.Series:
    """World-to-camera rotation and translation (12 numbers) of cameras on a helix, in the window's own
    scale, turn and place, which its first frame decides."""
    first = int(frames["frame_idx"].iloc[0])
    k = 1.0 + 0.1 * (first % 5)
    turn = _yaw(0.2 * (first % 7))

    def one(i: int) -> list[float]:
        a = 0.15 * i
        centre = k * turn @ np.array([np.cos(a), np.sin(a), 0.1 * i]) + first
        r = _yaw(a).T @ turn.T
        return [*r.ravel(), *(-r @ centre)]

    return frames["frame_idx"].map(lambda i: one(int(i)))


def _yaw(a: float) -> np.ndarray:
    return np.array([[np.cos(a), -np.sin(a), 0.0], [np.sin(a), np.cos(a), 0.0], [0.0, 0.0, 1.0]])


def per_frame(frames: DataFrame, branch: str, out: str, kind: str, model: str = "stub", columns: list[str] | None = None, errors: str | None = None) -> DataFrame:
    """Adds the model's value of each frame: any order, no shuffle, one Arrow batch at a time.

    With `errors`, a frame the model fails on has a null value and what went wrong in that column, and
    the others go on; without, the task fails.
    """
    f, names = get(branch, model), columns or ["frame_idx", "grey"]

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for b in batches:
            yield f(b)

    @F.pandas_udf(f"v {kind}, e string")
    def guarded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            try:
                yield pd.DataFrame({"v": f(b).to_numpy(), "e": None})
            except Exception:
                rows = []
                for i in range(len(b)):
                    try:
                        rows.append((f(b.iloc[i : i + 1].reset_index(drop=True)).iloc[0], None))
                    except Exception as e:
                        rows.append((None, _said(e)))
                yield pd.DataFrame(rows, columns=["v", "e"])

    if not errors:
        return frames.withColumn(out, run(F.struct(*names)))
    return frames.withColumn("models__got", guarded(F.struct(*names))).withColumns({out: F.col("models__got.v"), errors: F.col("models__got.e")}).drop("models__got")


def per_block(rows: DataFrame, keys: list[str], order: str, branch: str, out: str, kind: str, model: str = "stub", errors: str | None = None) -> DataFrame:
    """Adds the value of a model that sees a block's frames together, in order: memory holds one block.

    A model that gives another number of values than the block has frames fails. With `errors`, a failure
    is a block of null values with what went wrong in that column, and other blocks go on.
    """
    f = get(branch, model)
    fields = ", ".join(f"{n} {t}" for n, t in rows.dtypes)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(order).reset_index(drop=True)
        try:
            made = f(block)
            if len(made) != len(block):
                raise ValueError(f"{branch} model gave {len(made)} values for {len(block)} frames")
        except Exception as e:
            if not errors:
                raise
            return block.assign(**{out: [None] * len(block), errors: _said(e)})
        told = {errors: None} if errors else {}
        return block.assign(**{out: made.to_numpy()} | told)

    return rows.groupBy(*keys).applyInPandas(run, f"{fields}, {out} {kind}" + (f", {errors} string" if errors else ""))


def _said(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def isolated(f: Callable[[pd.DataFrame], pd.DataFrame], key: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Wraps a grouped function so that a failure is a row (key, status, error) and other groups go on."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            f(pdf)
            return pd.DataFrame({key: [pdf[key].iloc[0]], "status": ["ok"], "error": [None]})
        except Exception as e:  # the point is to go on whatever it is
            return pd.DataFrame({key: [pdf[key].iloc[0]], "status": ["failed"], "error": [_said(e)]})

    return run
