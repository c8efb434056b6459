from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from framelake.operators import alignment, blocks, extraction, keyframes, store
from framelake.streaming import frames as streams


def stream(spark, df, path, parts, order):
    """Writes the rows as files that arrive one after the other."""
    rows = df.orderBy(order).collect()
    step = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * step : (i + 1) * step], df.schema).coalesce(1).write.mode("append").parquet(f"{path}/p{i:02}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{path}")


def run(spark, df, tmp_path, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/c-{name}").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_keyframes_like_batch(spark, tmp_path):
    df = spark.createDataFrame([("v", int(f)) for f in np.cumsum(np.arange(40) % 5 + 1)], "video string, f bigint")
    got = run(spark, streams.keyframe_stream(stream(spark, df, tmp_path / "k", 4, "f"), "video", "f", 9), tmp_path, "keys")
    want = keyframes.keyframes(df, "video", "f", 9, force_last=False)
    assert sorted(r["f"] for r in got.collect()) == sorted(r["f"] for r in want.collect())


def test_depth_like_batch(spark, tmp_path):
    df = spark.range(20).selectExpr("'v' as video", "id as f", "20L as n", "1 + id % 7 / 10D as raw")
    b = blocks.assign_blocks(df, "f", "n", 6, 2).withColumn("raw", F.expr("raw * (1 + block_id) + block_id")).drop("n")
    want = alignment.align_depth(b, "video", "f", "block_id", "raw", [], 2).where("written")
    got = run(spark, streams.depth_stream(stream(spark, b, tmp_path / "d", 5, "block_id"), "video", "block_id", "f", "raw", "written", 2), tmp_path, "deep")
    key = lambda d: [r["raw"] for r in d.orderBy("f").collect()]
    assert got.count() == 20 and np.allclose(key(got), key(want))


def rotation_z(angle):
    return [f"cos({angle})", f"-sin({angle})", "0D", f"sin({angle})", f"cos({angle})", "0D", "0D", "0D", "1D"]


def test_pose_like_truth(spark, tmp_path):
    """Windows turned, scaled and moved; centres and rotations come back, also where centres stand still."""
    for still in (False, True):
        path = tmp_path / str(still)
        at = ["2D", "3D", "4D"] if still else ["cos(0.15 * id)", "sin(0.15 * id)", "0.1D * id"]
        df = spark.range(15).selectExpr("'v' as video", "id as f", "15L as n", *[f"{x} as c{i}" for i, x in enumerate(at)])
        turn = "0.3D * block_id"
        b = blocks.assign_blocks(df, "f", "n", 6, 3)
        k = "1" if still else "(1 + block_id)"  # standing still, the scale can't be known
        b = b.selectExpr("video", "f", "block_id", "written", f"(cos({turn}) * c0 - sin({turn}) * c1) * {k} + block_id as cx", f"(sin({turn}) * c0 + cos({turn}) * c1) * {k} - block_id as cy", f"c2 * {k} as cz", *[f"{x} as r{i}" for i, x in enumerate(rotation_z("0.15 * f + 0.3D * block_id"))])
        rows = run(spark, streams.pose_stream(stream(spark, b, path / "p", 4, "block_id"), "video", "block_id", "f", "written"), path, f"poses_{still}").orderBy("f").collect()
        assert len(rows) == 15
        want = [[2, 3, 4]] * 15 if still else [[np.cos(0.15 * i), np.sin(0.15 * i), 0.1 * i] for i in range(15)]
        assert np.allclose([[r["cx"], r["cy"], r["cz"]] for r in rows], want, atol=1e-9)
        assert np.allclose([[r["r0"], r["r1"], r["r8"]] for r in rows], [[np.cos(0.15 * i), -np.sin(0.15 * i), 1] for i in range(15)])


def frames_of(spark, n=70):
    """Two videos of n frames with gaps in their source indices."""
    return spark.range(2 * n).selectExpr("concat('v', id div %d) as video_id" % n, f"3 * (id % {n}) + id div {n} as frame_idx", f"id % {n} as row_pos", f"{n}L as n_frames", f"cast(id % 7 * 20 as double) as grey", "transform(sequence(0, 15), i -> cast((id * 31 + i * i * 17) % 251 as double)) as pixels")


def test_metric_depth_stream_like_batch(spark, tmp_path):
    b = blocks.assign_blocks(frames_of(spark), "row_pos", "n_frames", 24, 7)
    want = {(r["video_id"], r["frame_idx"]): r["depth"] for r in extraction.depth_windows(b, interval=20, min_points=4)[0].collect()}
    parts = b.select("video_id", "block_id", "frame_idx", "written", "pixels")
    got = run(spark, streams.metric_depth_stream(stream(spark, parts, tmp_path / "m", 5, "block_id"), 20, 4), tmp_path, "metric").collect()
    assert len(got) == len(want) == 140
    for r in got:
        assert np.allclose(r["depth"], want[r["video_id"], r["frame_idx"]], atol=1e-9)
    # whatever units a block has, the metric model's come out
    for r in b.where("written").collect():
        z = np.clip(3 * (np.array(r["pixels"]) / 255 + 1), 0.1, 100)
        assert np.allclose(want[r["video_id"], r["frame_idx"]], (1 / z - 0.01) / (10 - 0.01 + 1e-8), atol=1e-9)


def test_dino_stream_flushes_blocks(spark, tmp_path):
    df = spark.range(20).selectExpr("'v' as video_id", "id as frame_idx", "id * 2D as grey")
    kept = store.FeatureStore(spark, f"file://{tmp_path}/store")
    kept.write("dino", df.limit(1).selectExpr("video_id", "99L as frame_idx", "0 as token_idx", "array(0D) as vec"))
    q = streams.dino_stream(stream(spark, df, tmp_path / "t", 4, "frame_idx"), kept, checkpoint=f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r["frame_idx"]: r["vec"][0] for r in kept.read("dino").collect()} == {i: 2.0 * i for i in range(20)}
    assert not kept.completion().first()["complete"]
    kept.mark_complete("dino", ["v"])
    assert kept.completion().first()["complete"]
