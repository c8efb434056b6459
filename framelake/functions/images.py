"""What image preparation needs besides pixels: sizes, colour order, names, labels. Scalar SQL."""

from __future__ import annotations

import json
import warnings
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Channel means and deviations that models of ImageNet descent expect.
MEAN, STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)

#: Names of token models, with their input side, patch and width, and names that mean them.
MODELS = {"dinov3_vits16plus": (512, 16, 384), "dinov3_vits16": (512, 16, 384)}
MODEL_ALIASES = {
    "facebook/dinov3-vits16plus-pretrain-lvd1689m": "dinov3_vits16plus",
    "facebook/dinov3-vits16plus": "dinov3_vits16plus",
    "dinov3-vits16plus": "dinov3_vits16plus",
    "facebook/dinov3-vits16-pretrain-lvd1689m": "dinov3_vits16",
    "facebook/dinov3-vits16": "dinov3_vits16",
    "dinov3-vits16": "dinov3_vits16",
}


def model_name(name: str) -> Column:
    """The model that a column's name or alias means; an unknown one is an error."""
    entries = [F.lit(x) for k, v in {**MODEL_ALIASES, **{m: m for m in MODELS}}.items() for x in (k, v)]
    found = F.element_at(F.create_map(*entries), F.col(name))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("unknown model "), F.coalesce(F.col(name), F.lit("null")))).cast("string"))


def contained_size(height: str, width: str, side: int = 518, patch: int = 14) -> Column:
    """Sides of an image scaled to fit a square, each rounded up to whole patches."""
    scale = f"least({float(side)}D / {height}, {float(side)}D / {width})"
    up = lambda x: f"cast(ceil({x} * {scale} / {patch}) * {patch} as int)"
    return F.expr(f"named_struct('h', {up(height)}, 'w', {up(width)})")


def covering_size(height: str, width: str, side: int = 518, patch: int = 14, widest: float = 1.78, shrink: float = 1.777) -> Column:
    """Sides of an image scaled to cover a square, to the nearest whole patches that still do; the square of
    an elongated image is made smaller first, in proportion, one patch at least."""
    ratio = f"(greatest({height}, {width}) / least({height}, {width}))"
    square = f"(case when {ratio} > {widest}D then greatest(cast(bround(cast(floor({side} * {shrink}D / {ratio}) as double) / {patch}) * {patch} as int), {patch}) else {side} end)"
    scale = f"greatest({square} / {height}, {square} / {width})"
    near = lambda x: f"(bround({x} * {scale} / {patch}) * {patch})"
    whole = lambda x: f"cast(case when {near(x)} < {square} then ceil({x} * {scale} / {patch}) * {patch} else {near(x)} end as int)"
    return F.expr(f"named_struct('h', {whole(height)}, 'w', {whole(width)})")


def normalised(value: str, channel: int) -> Column:
    """A byte of a channel as models expect it."""
    return F.expr(f"({value} / 255D - {MEAN[channel]}D) / {STD[channel]}D")


def swap_channels(pixel: str) -> Column:
    """Red, green, blue from blue, green, red, and back."""
    return F.reverse(F.col(pixel))


def frame_label(frame: str, fps: str) -> Column:
    """The caption of a rendered frame: number and seconds."""
    return F.expr(f"format_string('frame=%05d t=%06.2f', cast({frame} as bigint), cast({frame} as double) / {fps})")


def render_report(**known: object) -> str:
    """The JSON beside a rendered video; all keys are there, null where unknown."""
    keys = "video_path output_mp4 frames total_frames start_frame frame_stride max_frames fps original_resolution render_resolution dino_model panel_mode grid_side feature_shape".split()
    if unknown := set(known) - set(keys):
        raise ValueError(f"unknown keys: {', '.join(sorted(unknown))}")
    return json.dumps({k: known.get(k) for k in keys}, indent=2, ensure_ascii=False)


@lru_cache(maxsize=None)
def warn_once(key: str, message: str) -> None:
    """Warns about a key once in a process."""
    warnings.warn(f"{key}: {message}", stacklevel=3)
