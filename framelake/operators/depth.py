"""Depth: affine fits, metric and inverse depth, storage as whole numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The least depth that counts, the spread below which a fit is a shift alone, storage scale.
MIN_DEPTH, MIN_SPREAD, SCALE = 1e-6, 1e-8, 65535


def valid(source: str, target: str) -> Column:
    """Pixels that are finite and positive in both."""
    fine = " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity') and {c} > {MIN_DEPTH}" for c in (source, target))
    return F.expr(fine)


def thin(pixels: DataFrame, keys: list[str], order: str, max_points: int = 200_000) -> DataFrame:
    """Every (n div max_points)-th pixel of groups with more than max_points; a part of the fit's definition."""
    by = ", ".join(keys)
    numbered = pixels.withColumns({"thin__i": F.expr(f"row_number() over (partition by {by} order by {order}) - 1"), "thin__n": F.expr(f"count(*) over (partition by {by})")})
    return numbered.where(f"thin__n <= {max_points} or thin__i % greatest(1, thin__n div {max_points}) = 0").drop("thin__i", "thin__n")


def fit_affine(pixels: DataFrame, keys: list[str], source: str, target: str, min_points: int = 1024) -> DataFrame:
    """keys, scale, shift, n_valid, status: least squares target = scale * source + shift over valid pixels.

    A source without spread gives scale 1 and the difference of means, not below 0. Under `min_points`
    valid pixels scale and shift are null and the status says so; require_fit() raises instead.
    """
    ok = pixels.where(valid(source, target))
    agg = ok.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_valid"),
        F.expr(f"regr_sxx({target}, {source})").alias("fit__sxx"),
        F.expr(f"regr_slope({target}, {source})").alias("fit__slope"),
        F.expr(f"regr_intercept({target}, {source})").alias("fit__icept"),
        F.avg(target).alias("fit__t"),
        F.avg(source).alias("fit__s"),
    )
    enough, flat = f"n_valid >= {min_points}", f"coalesce(fit__sxx, 0D) < {MIN_SPREAD}"
    return agg.select(
        *keys,
        F.expr(f"case when not {enough} then null when {flat} then 1D else fit__slope end").alias("scale"),
        F.expr(f"case when not {enough} then null when {flat} then greatest(0D, fit__t - fit__s) else fit__icept end").alias("shift"),
        "n_valid",
        F.expr(f"case when not {enough} then 'too few valid pixels' when {flat} then 'shift only' else 'fitted' end").alias("status"),
    )


def fit_arrays(rows: DataFrame, keys: list[str], source: str, target: str, min_points: int = 1024) -> DataFrame:
    """fit_affine() where each row holds two arrays of as many pixels: a row is reduced to its count, means and
    sums of products where it lies, so that pixels never are rows and only these numbers are shuffled."""
    fine = " and ".join(f"p.{c} is not null and not isnan(p.{c}) and abs(p.{c}) < double('infinity') and p.{c} > {MIN_DEPTH}" for c in "xy")
    good = rows.withColumn("fit__p", F.expr(f"filter(zip_with({source}, {target}, (x, y) -> named_struct('x', cast(x as double), 'y', cast(y as double))), p -> {fine})")).where("size(fit__p) > 0")
    sums = good.withColumn("fit__n", F.expr("cast(size(fit__p) as bigint)"))
    sums = sums.withColumns({f"fit__m{c}": F.expr(f"aggregate(fit__p, 0D, (s, p) -> s + p.{c}) / fit__n") for c in "xy"})
    sums = sums.withColumns({f"fit__x{c}": F.expr(f"aggregate(fit__p, 0D, (s, p) -> s + (p.x - fit__mx) * (p.{c} - fit__m{c}))") for c in "xy"})
    total = sums.groupBy(*keys).agg(
        F.sum("fit__n").alias("n_valid"),
        *[F.expr(f"sum(fit__n * fit__m{c}) / sum(fit__n)").alias(f"fit__{c}") for c in "xy"],
        *[F.expr(f"sum(fit__x{c}) + sum(fit__n * fit__mx * fit__m{c}) - sum(fit__n * fit__mx) * sum(fit__n * fit__m{c}) / sum(fit__n)").alias(f"fit__sx{c}") for c in "xy"],
    )
    enough, flat = f"n_valid >= {min_points}", f"fit__sxx < {MIN_SPREAD}"
    slope = total.withColumn("scale", F.expr(f"case when not {enough} then null when {flat} then 1D else fit__sxy / fit__sxx end"))
    return slope.select(
        *keys,
        "scale",
        F.expr(f"case when not {enough} then null when {flat} then greatest(0D, fit__y - fit__x) else fit__y - scale * fit__x end").alias("shift"),
        "n_valid",
        F.expr(f"case when not {enough} then 'too few valid pixels' when {flat} then 'shift only' else 'fitted' end").alias("status"),
    )


def require_fit(fits: DataFrame, min_points: int = 1024) -> DataFrame:
    """Raises when a group had too few valid pixels."""
    return fits.withColumn("scale", F.expr(f"if(scale is null, raise_error('fewer than {min_points} valid pixels'), scale)"))


def metric(raw: str, scale: str, shift: str, zmin: float = 0.1, zmax: float = 100.0) -> Column:
    """raw * scale + shift, clipped; NaN stays NaN."""
    v = f"({raw} * {scale} + {shift})"
    return F.expr(f"case when isnan({v}) then {v} else least(greatest({v}, {zmin}D), {zmax}D) end")


def inverse(z: str, zmin: float = 0.1, zmax: float = 100.0) -> Column:
    """Inverse depth from 0 (far) to 1 (near)."""
    c = f"least(greatest({z}, {zmin}D), {zmax}D)"
    v = f"((1D / {c} - {1.0 / zmax}D) / {1.0 / zmin - 1.0 / zmax + 1e-8}D)"
    return F.expr(f"case when isnan({z}) then {z} else least(greatest({v}, 0D), 1D) end")


def quantise(value: str, mode: str = "round") -> Column:
    """0 .. 65535 from 0 .. 1 in single precision, half to even; `floor` truncates. NaN is an error."""
    v = f"least(greatest(cast({value} as float), cast(0 as float)), cast(1 as float)) * cast({SCALE} as float)"
    whole = f"rint({v})" if mode == "round" else f"floor({v})"
    return F.expr(f"case when isnan({value}) then raise_error('depth is not a number') else cast({whole} as int) end")


def dequantise(px: str, scale: float = SCALE) -> Column:
    return F.expr(f"cast({px} as float) / cast({scale} as float)").cast("float")
