"""Invariants as rows of checks, performance records, and the report."""

from __future__ import annotations

import platform
import subprocess
from collections.abc import Callable
from datetime import UTC, datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rotation as rot

#: Windows that a probe tries, in frames.
PROBE_WINDOWS = (24, 32, 48, 64, 80, 96, 112, 128)


def check(rows: DataFrame, branch: str, name: str, expected: str, observed: Column, passed: Column) -> DataFrame:
    """One row of CHECKS from an aggregate over all rows; no rows fail."""
    return rows.agg(observed.cast("string").alias("observed"), F.coalesce(passed, F.lit(False)).alias("passed")).select(F.lit(branch).alias("branch"), F.lit(name).alias("name"), F.lit(expected).alias("expected"), "observed", "passed")


def finite(value: str) -> Column:
    return F.expr(f"bool_and({value} is not null and not isnan({value}) and abs({value}) < double('infinity'))")


def number(x: Column) -> Column:
    """A double as DuckDB writes it: the shortest digits that read back, an exponent below 1e-4 and from 1e16 only."""
    return F.udf(lambda d: None if d is None else repr(d), "string")(x)


def extreme(pick: Callable[[Column], Column], value: str) -> Column:
    """The smallest or largest value (`pick`) to six places, as SQL writes it: what rounds to 0 keeps its sign. As
    min and max take 0.0 and -0.0 for equal, a zero's sign is picked by itself, -0.0 below 0.0, whatever the rows' order."""
    v = F.col(value).cast("double")
    x = pick(v)
    millionths = F.round(F.abs(x) * 1e6)
    to_six = F.signum(x) * F.when(millionths < float("inf"), millionths / 1e6).otherwise(F.abs(x))
    plus = pick(F.when(v == 0, v.cast("string") == "0.0"))
    return F.when(x == 0, F.when(plus, "0.0").otherwise("-0.0")).otherwise(number(to_six))


def check_values(rows: DataFrame, branch: str, value: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Finite, within range, not constant."""
    out = [check(rows, branch, "finite", "all finite", F.count_if(F.expr(f"{value} is null or isnan({value})")), finite(value))]
    if low is not None:
        out.append(check(rows, branch, "min", f">= {low:g}", extreme(F.min, value), F.min(value) >= low - 1e-6))
    if high is not None:
        out.append(check(rows, branch, "max", f"<= {high:g}", extreme(F.max, value), F.max(value) <= high + 1e-6))
    out.append(check(rows, branch, "not constant", "std > 0", F.expr(f"stddev_pop({value}) > 0"), F.expr(f"stddev_pop({value}) > 0")))
    return reduce(DataFrame.unionByName, out)


def check_pose(rows: DataFrame, position: str) -> DataFrame:
    """The first pose is the identity and all rotations are valid; columns p0..p8."""
    first = F.lit(True)
    for i, x in enumerate(rot.IDENTITY_POSE):
        first = first & (F.abs(F.col(f"p{i}") - x) <= 1e-3)
    rows = rot.with_matrix(rows, [F.col(f"p{i}").cast("double") for i in range(3, 9)], "m")
    ok = rot.is_rotation(rot.cols("m"))
    return check(rows, "pose", "first is identity", "within 1e-3", F.expr(f"count_if({position} = 0)"), F.bool_and(F.when(F.col(position) == 0, first))).unionByName(check(rows, "pose", "rotations valid", "all", F.count_if(~ok), F.bool_and(ok)))


def check_round_trip(pairs: DataFrame, branch: str, a: str, b: str, limit: float) -> DataFrame:
    return check(pairs, branch, "round trip", f"<= {limit:g}", F.max(F.abs(F.col(a) - F.col(b))) <= limit, F.max(F.abs(F.col(a) - F.col(b))) <= limit)


def close(a: str, b: str, atol: float = 1e-3, rtol: float = 1e-5) -> Column:
    return F.expr(f"bool_and(abs({a} - {b}) <= {atol}D + {rtol}D * abs({b}))")


def check_determinism(first: DataFrame, second: DataFrame, branch: str, keys: list[str], value: str) -> DataFrame:
    """Two runs give the same rows, value by value."""
    a, b = first.select(*keys, F.col(value).alias("first")), second.select(*keys, F.col(value).alias("second"))
    both = a.join(b, keys, "full_outer")
    return check(both, branch, "deterministic", "no difference", F.count_if(~F.col("first").eqNullSafe(F.col("second"))), F.bool_and(F.col("first").eqNullSafe(F.col("second"))))


def check_alignment(requested: DataFrame, stored: DataFrame, branch: str, frame: str = "frame_idx") -> DataFrame:
    """A branch's stored frames are those that were asked for."""
    a = requested.select(F.col(frame).alias("f"), F.lit(True).alias("asked")).distinct()
    b = stored.select(F.col(frame).alias("f"), F.lit(True).alias("there")).distinct()
    off = ~(F.col("asked").eqNullSafe(True) & F.col("there").eqNullSafe(True))
    return check(a.join(b, "f", "full_outer"), branch, "frames aligned", "all", F.count_if(off), F.bool_and(~off))


def failed_check(branch: str, name: str, error: Exception) -> tuple[str, str, str, str, bool]:
    """The row for a check that could not run."""
    return branch, name, "runs", f"{type(error).__name__}: {error}", False


def summary(checks: DataFrame) -> DataFrame:
    """n_pass, n_total, overall: PASS when none fails, no checks included."""
    return checks.agg(F.count_if("passed").alias("n_pass"), F.count(F.lit(1)).alias("n_total")).withColumn("overall", F.expr("if(n_pass = n_total, 'PASS', 'FAIL')"))


def performance(records: DataFrame) -> DataFrame:
    """Adds fps and peak_mem_mb (millions of bytes) from frames, seconds, peak_bytes."""
    return records.withColumns({"fps": F.expr("try_divide(frames, seconds)"), "peak_mem_mb": F.expr("peak_bytes / 1e6D")})


def recommend_window(probes: DataFrame, window: str, ok: str) -> DataFrame:
    """The largest window that fits, and 4/5 of it in fours with a quarter overlap: 16 and 4 at least."""
    best = probes.agg(F.max(F.when(F.col(ok), F.col(window))).alias("largest"))
    return best.withColumn("window", F.expr("greatest(16, cast(floor(largest * 0.8D) as int) div 4 * 4)")).withColumn("overlap", F.expr("greatest(4, window div 4)"))


def _number(x: float | None) -> str:
    return "—" if x is None else f"{x:.1f}"


def _cell(x: object) -> str:
    return str(x).replace("|", "\\|")


def report(meta: dict[str, str], checks: DataFrame, perf: DataFrame, command: str = "") -> str:
    """A Markdown report; checks and records are few rows by nature."""
    rows, runs = checks.collect(), perf.collect()
    good = sum(r["passed"] for r in rows)
    lines = ["# Feature validation", "", *[f"- {k}: {v}" for k, v in meta.items()], "", f"**{'PASS' if good == len(rows) else 'FAIL'}**: {good} of {len(rows)} invariants hold.", "", "## Invariants", "", "| branch | check | expected | observed | result |", "|---|---|---|---|---|"]
    lines += [f"| {_cell(r['branch'])} | {_cell(r['name'])} | {_cell(r['expected'])} | {_cell(r['observed'])} | {'pass' if r['passed'] else 'FAIL'} |" for r in rows]
    lines += ["", "## Performance", "", "| video | branch | frames | seconds | fps | peak MB | note |", "|---|---|---|---|---|---|---|"]
    lines += [f"| {_cell(r['video_id'])} | {_cell(r['branch'])} | {r['frames']} | {_number(r['seconds'])} | {_number(r['fps'])} | {_number(r['peak_mem_mb'])} | {_cell(r['note'] or '')} |" for r in runs]
    return "\n".join([*lines, "", f"Reproduce: `{command}`" if command else ""]).rstrip() + "\n"


def environment(**known: str) -> dict[str, str]:
    """Date, host, commit, GPU and versions, each `?` where it can't be had."""
    out = {"date": datetime.now(UTC).date().isoformat(), "host": platform.node() or "?"}
    for name, command in (("commit", ["git", "-C", str(Path(__file__).parent), "rev-parse", "--short", "HEAD"]), ("gpu", ["nvidia-smi", "--query-gpu=name", "--format=csv,noheader"])):
        try:
            out[name] = subprocess.run(command, capture_output=True, text=True, timeout=10, check=True).stdout.strip() or "?"
        except (OSError, subprocess.SubprocessError):
            out[name] = "?"
    for name in ("pyspark", "numpy", "pandas"):
        try:
            out[name] = __import__(name).__version__
        except (ImportError, AttributeError):
            out[name] = "?"
    return out | known
