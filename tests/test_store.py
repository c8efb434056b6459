from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake import cli, models, session
from framelake.functions import vectors
from framelake.operators import blocks, sampling, similarity, store
from framelake.sources import video


@pytest.fixture
def fs(spark, tmp_path):
    return store.FeatureStore(spark, f"file://{tmp_path}/store")


def dino(spark, video_id, frames, value):
    return spark.createDataFrame([(video_id, f, t, [float(value + f)] * 5) for f in frames for t in range(3)], "video_id string, frame_idx bigint, token_idx int, vec array<float>")


def test_chunks_append_and_complete(spark, fs):
    fs.write("dino", dino(spark, "v", (0, 1), 0), block_id=0, reset=True, complete=False)
    fs.write("dino", dino(spark, "v", (2, 3), 100), block_id=1, reset=False, complete=False)
    assert not fs.completion().where("complete").count() and fs.frame_indices("dino").count() == 4
    fs.write("dino", dino(spark, "v", (2, 3), 200), block_id=1, reset=False, complete=False)  # a repeated block counts once
    assert fs.read("dino").where("frame_idx = 3 and token_idx = 0").first()["vec"][0] == 203.0
    fs.mark_complete("dino", ["v"])
    assert fs.completion().first()["complete"] and fs.read("dino").count() == 12
    videos = spark.createDataFrame([("v",), ("w",)], "video_id string")
    assert [r[0] for r in fs.todo(videos, ["dino"]).collect()] == ["w"]
    assert fs.todo(videos, ["dino", "depth"]).count() == 2
    fs.write("dino", dino(spark, "v", (7,), 0))  # a new write replaces all
    assert [r["frame_idx"] for r in fs.frame_indices("dino").collect()] == [7]


def test_depth_and_pose(spark, fs):
    d = spark.createDataFrame([("v", f, 2, 2, [0.25, 0.75, 1.5, -1.0]) for f in range(3)], "video_id string, frame_idx bigint, height int, width int, depth array<double>")
    fs.write("depth", d)
    got = fs.read("depth").first()["depth"]
    assert np.allclose(got, [0.25, 0.75, 1, 0], atol=1e-4)
    fs.write("pose", spark.createDataFrame([("v", 0, [0.0] * 9), ("w", 0, [0.0] * 6)], "video_id string, frame_idx bigint, pose array<float>"))
    kinds = {r["video_id"]: r["representation"] for r in fs.inspect().where("branch = 'pose'").collect()}
    assert kinds == {"v": "translation_rot6d", "w": "se3_log"}
    everything = fs.read_all().where("video_id = 'v'").orderBy("frame_idx").collect()
    assert [r["pose"] is None for r in everything] == [False, True, True] and everything[0]["dino"] is None
    assert fs.read_all(strict=True).isEmpty()
    assert {r["video_id"]: r["frame_idx"] for r in fs.primary_frame_indices().where("frame_idx = 0").collect()} == {"v": 0, "w": 0}
    assert [r[0] for r in fs.list_videos().collect()] == ["v", "w"] and fs.exists("v") and not fs.exists("x")


def test_requests_keep_order(spark, fs):
    fs.write("dino", dino(spark, "v", range(4), 0))
    ask = spark.createDataFrame([("v", 0, 3), ("v", 1, 9), ("v", 2, 0)], "video_id string, pos int, frame_idx bigint")
    rows = fs.read("dino", ask).where("token_idx = 0").orderBy("pos").collect()
    assert [(r["pos"], r["frame_idx"]) for r in rows] == [(0, 3), (2, 0)]


def test_empty_store_and_cameras(spark, fs):
    assert fs.read("pose").isEmpty() and fs.list_videos().isEmpty()
    fs.write("dino", dino(spark, "v", (0,), 0).withColumn("camera_key", F.lit("left")))
    assert fs.read("dino").where("camera_key = 'left'").count() == 3 and fs.read_all().isEmpty()
    with pytest.raises(ValueError):
        fs.write("sound", dino(spark, "v", (0,), 0))


def test_annotations(spark, tmp_path):
    path = f"file://{tmp_path}/notes"
    videos = spark.createDataFrame([("v", "/v.mp4", 5)], "video_id string, path string, n_frames int")
    done = spark.createDataFrame([("v", "depth", True)], "video_id string, branch string, complete boolean")
    store.write_annotations(store.annotations(videos, done), path)
    store.write_annotations(store.annotations(videos.union(spark.createDataFrame([("w", "/w.mp4", 1)], videos.schema)), done), path)
    rows = {r["video_id"]: r for r in spark.read.json(path).collect()}
    assert set(rows) == {"v", "w"} and rows["v"]["has_depth"] and not rows["w"]["has_depth"] and rows["v"]["num_frames"] == 5
    assert "state_dim" in spark.read.json(path).columns


def ramp(path, n=12):
    path.write_bytes(b"64 48 %d 10\n" % n + b"".join(bytes([i * 20]) * (64 * 48) for i in range(n)))


def test_read_frames_with_fallback(spark, tmp_path):
    ramp(tmp_path / "r.raw")
    (tmp_path / "bad.raw").write_bytes(b"no video")

    def broken(path):
        raise OSError("not this one")

    ask = spark.createDataFrame([(f"{tmp_path}/r.raw", "r", i) for i in (11, 1, 5, 0, 10, 12, -1)] + [(f"{tmp_path}/bad.raw", "bad", 0)], "path string, video_id string, frame_idx bigint")
    rows = video.read_frames(ask, (broken, video.RawReader)).collect()
    got = {r["frame_idx"]: round(r["grey"] / 20) for r in rows if r["error"] is None}
    assert got == {i: i for i in (11, 1, 5, 0, 10)}
    assert sorted(r["video_id"] for r in rows if r["error"]) == ["bad", "r", "r"]


def test_stub_blocks(spark):
    df = spark.range(10).selectExpr("'v' as video_id", "id as frame_idx", "id * 20D as grey", "10L as n")
    d = models.per_frame(df, "dino", "vec", "array<double>")
    assert d.where("vec[0] <> grey").isEmpty()
    b = blocks.assign_blocks(df, "frame_idx", "n", 6, 3)
    p = models.per_block(b, ["video_id", "block_id"], "frame_idx", "pose", "m", "array<double>")
    assert p.count() == b.count() and p.where("size(m) <> 12").isEmpty()
    with pytest.raises(ValueError, match="stub"):
        models.get("depth", "nothing")


def test_isolated(spark):
    def fails_on_b(pdf):
        if pdf["k"].iloc[0] == "b":
            raise RuntimeError("no")
        return pdf

    df = spark.createDataFrame([("a",), ("b",)], "k string")
    got = {r["k"]: r["status"] for r in df.groupBy("k").applyInPandas(models.isolated(fails_on_b, "k"), "k string, status string, error string").collect()}
    assert got == {"a": "ok", "b": "failed"}


def test_command_line(spark, tmp_path, monkeypatch):
    (tmp_path / "in" / "ep").mkdir(parents=True)
    ramp(tmp_path / "in" / "ep" / "a.mp4")
    args = ["--data_root", "file://" + str(tmp_path / "in"), "--output-root", "file://" + str(tmp_path / "out"), "--frames-per-video", "6", "--annotation-dir", "file://" + str(tmp_path / "notes"), "--min-points", "1"]
    a = cli.parser().parse_args(args)
    assert [tuple(r) for r in cli.extract(spark, a, (video.RawReader,)).collect()] == [("ep_a", "ok", None, None)]
    kept = store.FeatureStore(spark, a.output_root)
    assert [r["frame_idx"] for r in kept.frame_indices("pose").orderBy("frame_idx").collect()] == [0, 2, 4, 6, 8, 10]
    again = cli.parser().parse_args([*args, "--resume"])
    assert cli.extract(spark, again, (video.RawReader,)).isEmpty()
    (tmp_path / "in" / "ep" / "b.mp4").write_bytes(b"")
    status = {r["video_id"]: r["status"] for r in cli.extract(spark, again, (video.RawReader,)).collect()}
    assert status == {"ep_b": "failed"}
    with pytest.raises(FileNotFoundError):
        cli.extract(spark, cli.parser().parse_args(["--data_root", str(tmp_path / "notes"), "--output_root", "x"]))
    assert sampling.parse_branches(a.branches) == ["dino", "depth", "pose"]


def test_command_line_streams_long_videos_and_goes_on_after_failures(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    rng = np.random.default_rng(3)
    for name, n, high in (("long", 40, 200), ("short", 5, 200), ("bright", 30, 256)):
        body = rng.integers(0, high, (n, 48, 64)).astype(np.uint8)
        if name == "bright":
            body[:, :8, :8] = 255
        (tmp_path / "in" / f"{name}.mp4").write_bytes(b"64 48 %d 10\n" % n + body.tobytes())

    def run(out, *more):
        base = ["--data_root", f"file://{tmp_path}/in", "--output_root", f"file://{tmp_path}/{out}", "--frames_per_video", "0", "--block_size", "16", "--depth_overlap", "4", "--pose_window", "12", "--pose_overlap", "4", "--min_points", "8", "--id_from_stem"]
        a = cli.parser().parse_args([*base, *more])
        return {r["video_id"]: tuple(r)[1:] for r in cli.extract(spark, a, (video.RawReader,)).collect()}, store.FeatureStore(spark, a.output_root)

    status, blocked = run("blocks", "--stream_threshold", "10")
    assert status == {v: ("ok", None, None) for v in ("long", "short", "bright")}
    status, whole = run("whole", "--stream_threshold", "1000", "--depth_mode", "vda")
    assert set(status.values()) == {("ok", None, None)}
    # blocks stitched are the same as whole videos, in depth up to storage, in pose exactly
    for branch, column, atol in (("depth", "depth", 3 / 65535), ("pose", "pose", 1e-5)):
        one, two = ({(r["video_id"], r["frame_idx"]): r[column] for r in k.read(branch).collect()} for k in (blocked, whole))
        assert one.keys() == two.keys() and len(one) == 75 and all(np.allclose(one[k], two[k], atol=atol) for k in one)
    monkeypatch.setattr(models, "DEPTH_MODES", (*models.DEPTH_MODES, "brittle"))
    status, brittle = run("brittle", "--depth_mode", "brittle")
    assert status["bright"][:2] == ("failed", "depth") and "saturated" in status["bright"][2] and status["long"][0] == status["short"][0] == "ok"
    done = {(r["video_id"], r["branch"]) for r in brittle.completion().where("complete").collect()}
    assert done == {(v, b) for v in ("long", "short") for b in ("dino", "depth", "pose")} | {("bright", "dino")}
    for mode in ("da3", "depth_pro"):
        assert set(run(mode, "--depth_mode", mode, "--branches", "depth")[0].values()) == {("ok", None, None)}


def test_validate_command(spark, tmp_path, monkeypatch):
    from framelake import validation

    ramp(tmp_path / "a.mp4")
    report = tmp_path / "report.md"
    assert validation.main(["--data_root", f"file://{tmp_path}", "--report", str(report), "--perf-frames", "6", "--frames-sweep", "3,5"], (video.RawReader,)) == 0
    text = report.read_text()
    assert "**PASS**" in text and "deterministic" in text and "sweep frames=3" in text and "a@5" in text and "ERROR" not in text
    assert validation.main(["--skip-perf", "--report", str(report), "--depth_mode", "vda", "--branches", "depth"]) == 0
    monkeypatch.setattr(models, "DEPTH_MODES", (*models.DEPTH_MODES, "brittle"))
    assert validation.main(["--skip-perf", "--report", str(report), "--depth_mode", "brittle", "--branches", "depth"]) == 1
    assert "saturated" in report.read_text()
    with pytest.raises(SystemExit):
        validation.main([])


def test_exact_percentiles(spark):
    rng = np.random.default_rng(1)
    for x in (rng.normal(size=1000), np.repeat([1.0, 2.0, 7.0], 50), np.array([3.0]), np.zeros(0)):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(3)
        got = vectors.exact_percentiles(df, "v", [0.02, 0.5, 0.98, 1.0])
        assert got == [None] * 4 if not len(x) else np.allclose(got, np.quantile(x, [0.02, 0.5, 0.98, 1.0]))


def test_shared_folder_is_asked_for_on_a_cluster():
    nothing = SimpleNamespace(isDefined=lambda: False)
    away = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: nothing))))
    assert not session.is_local(away)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(away)


def test_compose_keeps_the_scale_of_a_window_that_stands_still(spark):
    """Window 1 is half as large as window 0's world; window 2, of one point, has scale 1 in that world."""
    still = [(0, 1.0, np.eye(3), [0.0] * 3, [0.0] * 3, "similarity"), (1, 2.0, np.eye(3), [1.0, 0.0, 0.0], [0.0] * 3, "similarity"), (2, 1.0, np.eye(3), [0.0, 5.0, 0.0], [1.0, 1.0, 1.0], "rotation")]
    df = spark.createDataFrame([("v", b, s, r.ravel().tolist(), t, m, k) for b, s, r, t, m, k in still], "video string, block long, s double, r array<double>, t array<double>, m array<double>, kind string")
    got = {r["block"]: (r["s"], r["t"]) for r in similarity.compose(df, "video", "block").collect()}
    # the mean point (1, 1, 1) meets (1, 6, 1) of window 1, which is (3, 12, 2) in the world
    assert got[1] == (2.0, [1.0, 0.0, 0.0]) and got[2] == (1.0, [2.0, 11.0, 1.0])
