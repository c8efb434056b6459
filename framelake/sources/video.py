"""Decoding videos: readers behind one interface, with fallback, as a partition-wise scan."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..operators import blocks


class Reader(Protocol):
    def __len__(self) -> int: ...
    def __getitem__(self, i: int) -> np.ndarray: ...
    def fps(self) -> float: ...


Opener = Callable[[str], Reader]


class RawReader:
    """`.raw` videos for tests: a header line `width height frames fps`, then grey bytes frame by frame."""

    def __init__(self, path: str) -> None:
        with open(path.removeprefix("file:"), "rb") as f:
            w, h, n, self._fps = f.readline().split()
            self._frames = np.frombuffer(f.read(), np.uint8).reshape(int(n), int(h), int(w))

    def __len__(self) -> int:
        return len(self._frames)

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < len(self):
            raise IndexError(i)
        return np.repeat(self._frames[i][:, :, None], 3, axis=2)

    def fps(self) -> float:
        return float(self._fps)


class PyAVReader:
    """Forward decoding with PyAV, where it is installed; an earlier frame than the last starts again."""

    def __init__(self, path: str) -> None:
        import av

        self._open = lambda: av.open(path.removeprefix("file:"))
        with self._open() as c:
            stream = c.streams.video[0]
            self._fps = float(stream.average_rate or 0)
            self._n = stream.frames or sum(1 for _ in c.decode(stream))
        self._restart()

    def _restart(self) -> None:
        self._container = self._open()
        self._decoder, self._next, self._last = self._container.decode(video=0), 0, None

    def __len__(self) -> int:
        return self._n

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < self._n:
            raise IndexError(i)
        if i < self._next - 1:
            self._container.close()
            self._restart()
        while self._next <= i:
            self._last = next(self._decoder)
            self._next += 1
        return self._last.to_ndarray(format="rgb24")

    def fps(self) -> float:
        return self._fps


class DecordReader:
    def __init__(self, path: str) -> None:
        import decord

        self._v = decord.VideoReader(path.removeprefix("file:"))

    def __len__(self) -> int:
        return len(self._v)

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < len(self):
            raise IndexError(i)
        return self._v[i].asnumpy()

    def fps(self) -> float:
        return float(self._v.get_avg_fps())


def open_video(path: str, openers: tuple[Opener, ...] = (DecordReader, PyAVReader)) -> Reader:
    """The first reader that opens the file; the last one's error if none does."""
    for i, opener in enumerate(openers):
        try:
            return opener(path)
        except Exception:
            if i == len(openers) - 1:
                raise
    raise ValueError("no readers")


def grid(image: np.ndarray, side: int = 8) -> list[float]:
    """Means of side x side cells, row by row; the image's last rows and columns that fill no cell are left out,
    a smaller image counts each pixel as often as it takes."""
    h, w = image.shape[:2]
    grey = image.reshape(h, w, -1).mean(2)
    if h < side or w < side:
        grey = grey[np.arange(side) * h // side][:, np.arange(side) * w // side]
        h = w = side
    return grey[: h // side * side, : w // side * side].reshape(side, h // side, side, w // side).mean((1, 3)).ravel().tolist()


FRAME = "height int, width int, pixels array<double>, grey double, error string"


def read_frames(requests: DataFrame, openers: tuple[Opener, ...] = (DecordReader, PyAVReader), keep: list[str] | None = None, by: list[str] | None = None, rgb: bool = False) -> DataFrame:
    """Frames of requests (path, video_id, frame_idx): height, width, pixels (a grid of means), grey mean, error,
    with `rgb` also the bytes. Columns `keep` of the requests come along.

    Requests that agree in `by` (the path, if not told) are decoded by one task, in order of the frames, so
    that decoding goes forward once. A frame or file that can't be read is a row with its error, and the
    rest go on.
    """
    keep, by = keep or [], by or ["path"]
    names = ["video_id", "frame_idx", *keep]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, reader, failed = None, None, None
        for b in batches:
            rows = []
            for i, (at, frame) in enumerate(zip(b["path"], b["frame_idx"], strict=True)):
                if at != path:
                    path, reader, failed = at, None, None
                    try:
                        reader = open_video(path, openers)
                    except Exception as e:
                        failed = f"{type(e).__name__}: {e}"
                got = (None, None, None, None, failed, None)
                if reader is not None:
                    try:
                        x = reader[int(frame)]
                        got = (x.shape[0], x.shape[1], grid(x), float(x.mean()), None, x.tobytes() if rgb else None)
                    except Exception as e:
                        got = (None, None, None, None, f"{type(e).__name__}: {e}", None)
                rows.append(got)
            made = pd.DataFrame(rows, columns=["height", "width", "pixels", "grey", "error", "rgb"]).astype({"height": "Int32", "width": "Int32"})
            yield pd.concat([b[names].reset_index(drop=True), made], axis=1)[[*names, *[f.split()[0] for f in kind.split(", ")]]]

    kind = FRAME + (", rgb binary" if rgb else "")
    of = dict(requests.dtypes)
    near = requests.select("path", *names).repartition(*by).sortWithinPartitions(*dict.fromkeys(["path", *by]), "frame_idx")
    return near.mapInPandas(scan, ", ".join([*[f"{n} {of[n]}" for n in names], kind]))


def read_blocks(requests: DataFrame, size: int, overlap: int = 0, openers: tuple[Opener, ...] = (DecordReader, PyAVReader), whole: str = "false") -> DataFrame:
    """Frames block by block: requests (path, video_id, frame_idx, row_pos, n_frames) go to the blocks that read
    them, with block_id and written, and each block is decoded by itself, so a long video by many tasks."""
    assigned = blocks.assign_blocks(requests, "row_pos", "n_frames", size, overlap, whole)
    return read_frames(assigned, openers, ["row_pos", "n_frames", "block_id", "written"], ["path", "block_id"])
