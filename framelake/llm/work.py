"""Lineage cuts through written tables, and dense row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path


#: Spark's own limit of an Arrow batch, and the one used in its place.
DEFAULT_BATCH, SMALL_BATCH = 64 << 20, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of an Arrow batch from Spark's default; a limit that was set stays.

    For programs that own their session, as the queries do; operators leave settings alone. Texts are
    long: at the default, a task holds batches of 64 MB in the JVM, in its buffers and in the worker at once.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name).removesuffix("b") == str(DEFAULT_BATCH):
        spark.conf.set(name, str(SMALL_BATCH))


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a written folder through Hadoop's file system, once nothing reads it any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it: lineage ends here, lost executors cost nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made.framelake_path = path
    return made


def release(*frames: DataFrame) -> None:
    """Deletes what materialize() wrote, once nothing that is still to run reads it."""
    for df in frames:
        path = df.__dict__.pop("framelake_path", None)
        if path:
            drop_path(df.sparkSession, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_spread(rows: DataFrame, keyed: DataFrame, on: str, n: str, total: int, by: str, how: str = "inner") -> DataFrame:
    """rows joined with `keyed`, which has one row for each value of `on` and in `n` how many rows have it.

    Values that many rows share are dealt over several tasks by the hash of `by`, and their row of `keyed`
    goes to each. Those are values of more than a quarter of a partition's even share of `total` rows, so
    there are four a partition at most: they are told to all tasks. `keyed` is read twice. Rows without a
    value, which a left join keeps, are dealt over all partitions.
    """
    parts = partitions(rows.sparkSession)
    limit = max(16, total // (4 * parts))
    hot = keyed.where(F.col(n) > limit).select(F.col(on).alias("spread__on"), F.expr(f"cast(ceil({n} / {limit}) as int)").alias("spread__of"))
    dealt = rows.join(F.broadcast(hot), F.col(on) == F.col("spread__on"), "left").withColumn("spread__at", F.expr(f"case when {on} is null then pmod(xxhash64({by}), {parts}) when spread__of is null then 0L else pmod(xxhash64({by}), spread__of) end")).drop("spread__on", "spread__of")
    each = keyed.withColumn("spread__at", F.explode(F.expr(f"sequence(0L, greatest(ceil({n} / {limit}), 1L) - 1)")))
    return dealt.join(each, [on, "spread__at"], how).drop("spread__at")


def with_row_numbers(df: DataFrame, order: list[str | Column], number: str) -> tuple[DataFrame, int]:
    """Adds 0, 1, 2, ... in the given order over all rows; returns the table and its row count.

    Rows are range-partitioned and sorted; each partition's count gives the offset of the next, so
    no task sees all rows. Nulls come first. Rows alike in all of `order` may take either's number.
    The driver holds one count per partition.
    """
    spark = df.sparkSession
    local = f"{number}__local"
    rows = materialize(df, "rows")  # a range exchange reads its input twice, to find the ranges and to deal
    placed = materialize(
        rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn(local, F.monotonically_increasing_id()),
        "numbered",
    )
    release(rows)
    part = F.shiftright(F.col(local), 33)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    p, off = f"{number}__part", f"{number}__off"
    base = spark.createDataFrame(offsets, f"{p} long, {off} long")
    numbered = placed.withColumn(p, part).join(F.broadcast(base), p)
    out = numbered.withColumn(number, F.col(off) + F.col(local).bitwiseAND(F.lit((1 << 33) - 1))).drop(local, p, off)
    out.framelake_path = placed.framelake_path
    return out, total
