"""Overlapping blocks over row positions: plans, assignment, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _checked(size: int, overlap: int) -> int:
    if size <= 0:
        raise ValueError("block size must be positive")
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the block size")
    return size - overlap


def last_block(total: str, size: int, overlap: int) -> str:
    """SQL for the id of the last block: the first whose end reaches the total."""
    step = _checked(size, overlap)
    return f"(case when {total} <= {size} then 0L else cast(ceil(({total} - {size}) / {float(step)}D) as bigint) end)"


def plan_blocks(videos: DataFrame, total: str, size: int, overlap: int = 0) -> DataFrame:
    """Explodes each video into its blocks. Block k reads `size` rows from k (size - overlap) and writes
    those after the overlap; written ranges tile the video once. No rows, no blocks."""
    step = _checked(size, overlap)
    made = videos.where(f"{total} > 0").withColumn("block_id", F.expr(f"explode(sequence(0L, {last_block(total, size, overlap)}))"))
    return made.selectExpr(
        "*", f"block_id * {step} as read_start", f"least(block_id * {step} + {size}, {total}) as read_end", f"case when block_id = 0 then 0L else block_id * {step} + {overlap} end as write_start"
    )


def assign_blocks(frames: DataFrame, row_pos: str, total: str, size: int, overlap: int = 0, whole: str = "false") -> DataFrame:
    """Explodes each row into the blocks that read it, with `written` for the one that writes it.

    The interval join of rows and blocks in closed form: no join, no shuffle. Videos for which the
    condition `whole` holds are one block.
    """
    step = _checked(size, overlap)
    first = f"greatest(0L, cast(ceil(({row_pos} - {size - 1}) / {float(step)}D) as bigint))"
    last = f"least({row_pos} div {step}, {last_block(total, size, overlap)})"
    made = frames.withColumn("block_id", F.expr(f"explode(if({whole}, array(0L), sequence({first}, {last})))"))
    return made.withColumn("written", F.expr(f"{row_pos} >= case when block_id = 0 then 0L else block_id * {step} + {overlap} end"))


def coverage(assigned: DataFrame, video: str, row_pos: str) -> DataFrame:
    """How many blocks read and write each row."""
    return assigned.groupBy(video, row_pos).agg(F.count(F.lit(1)).alias("n_read"), F.count_if("written").alias("n_written"))
