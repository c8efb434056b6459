from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.functions import rotation as rot
from framelake.functions import vectors
from framelake.operators import alignment, blocks, compare, depth, keyframes, lookup, sampling, similarity, validate
from framelake.sources import files


def collect(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def plan(total, size, overlap):
    """Blocks by a loop, to compare with the closed form."""
    out, start = [], 0
    while total > 0:
        end = min(start + size, total)
        out.append((start, end, 0 if start == 0 else start + overlap))
        if end >= total:
            break
        start += size - overlap
    return out


@pytest.mark.parametrize(("total", "size", "overlap", "want"), [(10, 4, 0, [(0, 4, 0), (4, 8, 4), (8, 10, 8)]), (3, 4, 2, [(0, 3, 0)]), (0, 4, 0, []), (10, 4, 2, [(0, 4, 0), (2, 6, 4), (4, 8, 6), (6, 10, 8)])])
def test_block_plan(spark, total, size, overlap, want):
    df = spark.createDataFrame([("v", total)], "video string, n bigint")
    assert collect(blocks.plan_blocks(df, "n", size, overlap).select("read_start", "read_end", "write_start"), "read_start") == want


def test_block_plan_all_small_cases(spark):
    totals = spark.range(40).selectExpr("id as n")
    for size, overlap in itertools.product((1, 2, 3, 5, 9), (0, 1, 2, 4)):
        if overlap < size:
            got = collect(blocks.plan_blocks(totals, "n", size, overlap).select("n", "read_start", "read_end", "write_start"), "n", "read_start")
            assert got == [(t, *b) for t in range(40) for b in plan(t, size, overlap)]


@pytest.mark.parametrize(("size", "overlap"), [(10, 10), (0, 0), (4, -1)])
def test_block_plan_rejects(spark, size, overlap):
    with pytest.raises(ValueError):
        blocks.plan_blocks(spark.createDataFrame([(10,)], "n bigint"), "n", size, overlap)


def test_blocks_write_once(spark):
    df = spark.range(37).selectExpr("'v' as video", "id as row_pos", "37L as n")
    assert blocks.coverage(blocks.assign_blocks(df, "row_pos", "n", 8, 3), "video", "row_pos").where("n_written <> 1").isEmpty()


@pytest.mark.parametrize(("idx", "carried", "interval", "want"), [(range(5), None, 2, [0, 2, 4]), (range(11, 16), 10, 3, [13, 15]), (range(4, 8), 6, 2, [7]), ([7], None, 3, [7]), ([], None, 3, [])])
def test_keyframes(spark, idx, carried, interval, want):
    df = spark.createDataFrame([("v", i, carried) for i in idx], "video string, f bigint, c bigint")
    got = collect(keyframes.keyframes(df, "video", "f", interval, carried="c").select("f"), "f")
    # a carried keyframe inside the segment counts from where it is
    assert [f for (f,) in got] == ([7] if carried == 6 else want)


def test_keyframes_pandas_is_the_same(spark):
    df = spark.createDataFrame([("v", int(i)) for i in np.cumsum(np.arange(60) % 7 + 1)], "video string, f bigint")
    assert collect(keyframes.keyframes(df, "video", "f", 11), "f") == collect(keyframes.keyframes_pandas(df, "video", "f", 11), "f")


def test_interpolation(spark):
    rows = [("v", i, {10: 1.0, 14: 5.0}.get(i), {10: 0.0, 14: 8.0}.get(i)) for i in range(9, 17)]
    df = spark.createDataFrame(rows, "video string, x bigint, a double, b double")
    got = collect(keyframes.interpolate(df, "video", "x", ["a", "b"]).select("x", "a", "b"), "x")
    x = np.arange(9, 17)
    assert np.allclose([r[1] for r in got], np.interp(x, [10, 14], [1, 5])) and np.allclose([r[2] for r in got], np.interp(x, [10, 14], [0, 8]))
    none = spark.createDataFrame([("v", 1, None)], "video string, x bigint, a double")
    assert collect(keyframes.interpolate(none, "video", "x", ["a"]).select("a"), "a") == [(None,)]


def test_affine_fit(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0.5, 2, 400)
    rows = [("a", float(v), float(2 * v + 0.3)) for v in x] + [("flat", 1.0, float(1 + i % 3)) for i in range(30)] + [("few", 1.0, 2.0), ("few", float("nan"), 2.0), ("few", -1.0, 2.0)]
    px = spark.createDataFrame(rows, "k string, s double, t double")
    got = {r["k"]: r for r in depth.fit_affine(px, ["k"], "s", "t", min_points=10).collect()}
    assert got["a"]["scale"] == pytest.approx(2) and got["a"]["shift"] == pytest.approx(0.3)
    assert (got["flat"]["scale"], got["flat"]["shift"], got["flat"]["status"]) == (1.0, pytest.approx(1.0), "shift only")
    assert got["few"]["scale"] is None and got["few"]["n_valid"] == 1
    with pytest.raises(Exception, match="fewer than 10"):
        depth.require_fit(depth.fit_affine(px, ["k"], "s", "t", 10), 10).collect()


def test_quantise_like_numpy(spark):
    v = np.linspace(-0.1, 1.1, 5001).astype(np.float32)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i int, v float")
    got = np.array([r[1] for r in collect(df.select("i", depth.quantise("v")), "i")])
    assert (got == (np.clip(v, np.float32(0), np.float32(1)) * np.float32(65535)).round()).all()
    with pytest.raises(Exception, match="not a number"):
        spark.sql("select cast('NaN' as float) as v").select(depth.quantise("v")).collect()


def test_inverse_depth_ends(spark):
    df = spark.createDataFrame([(0.01,), (0.1,), (100.0,), (1e6,)], "z double").select(F.round(depth.inverse("z"), 6))
    assert [r[0] for r in df.collect()] == [1.0, 1.0, 0.0, 0.0]


def test_sampling_rule(spark):
    def by_hand(total, n):
        if n <= 0 or n >= total:
            return list(range(total))
        return list(range(0, total, max(1, total // n)))[:n]

    for total, n in [(10, 3), (10, 7), (10, 10), (10, 0), (100, 40), (7, 2)]:
        df = spark.range(total).selectExpr("'v' as v", "id as f")
        got = collect(sampling.sample_frames(df, "v", "f", n).select("f", "row_pos"), "f")
        assert got == [(f, i) for i, f in enumerate(by_hand(total, n))]


def test_linspace_positions(spark):
    for total, n in [(100, 7), (5, 9), (1000, 600), (2, 1)]:
        df = spark.createDataFrame([(total,)], "n bigint")
        want = range(total) if total <= n else np.linspace(0, total - 1, n).astype(int)
        assert [r[0] for r in collect(sampling.linspace_positions(df, "n", n).select("row_pos"), "row_pos")] == list(want)


def test_branches_and_routes(spark):
    assert sampling.parse_branches(" dino, ,pose") == ["dino", "pose"]
    with pytest.raises(ValueError, match="sound"):
        sampling.parse_branches("dino,sound")
    df = spark.createDataFrame([(2000,), (2001,)], "n bigint")
    assert [r[0] for r in df.select(sampling.route("n")).collect()] == ["memory", "stream"]


def test_lookup(spark):
    stored = spark.createDataFrame([(i, f"r{i}") for i in range(12)], "frame_idx bigint, v string")
    ask = lookup.numbered(spark.createDataFrame([([11, 1, 99, 1],)], "fs array<bigint>"), "fs")
    assert collect(lookup.requested_rows(ask, stored, ["frame_idx"]).select("pos", "v"), "pos") == [(0, "r11"), (1, "r1"), (3, "r1")]
    done = spark.createDataFrame([("a", "dino", True, 1), ("a", "dino", False, 2), ("b", "dino", True, 1)], "video_id string, branch string, complete boolean, attempt bigint")
    videos = spark.createDataFrame([("a",), ("b",), ("c",)], "video_id string")
    assert collect(lookup.todo(videos, done, "video_id", ["dino"]), "video_id") == [("a",), ("c",)]
    assert lookup.todo(videos, done, "video_id", []).isEmpty()


def test_rotations(spark):
    cases = {"identity": np.eye(3), "quarter": np.array([[0, -1, 0], [1, 0, 0], [0, 0, 1.0]]), "twos": np.full((3, 3), 2.0), "mirror": np.diag([1, 1, -1.0])}
    df = spark.createDataFrame([(k, *m.ravel().tolist()) for k, m in cases.items()], "k string, " + ", ".join(f"r{i} double" for i in range(9)))
    got = dict(collect(df.select("k", rot.is_rotation(rot.cols("r"))), "k"))
    assert got == {"identity": True, "quarter": True, "twos": False, "mirror": False}
    back = df.where("k in ('identity', 'quarter')").select("k", *rot.from_6d(rot.to_6d(rot.cols("r"))))
    for k, *v in collect(back, "k"):
        assert np.allclose(v, cases[k].ravel(), atol=1e-9)
    assert tuple(spark.range(1).select(rot.identity_pose()).first()[0]) == rot.IDENTITY_POSE


def yaw(a):
    return np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1.0]])


def test_similarity_recovers(spark):
    rng = np.random.default_rng(0)
    src, r, t = rng.normal(size=(12, 3)), yaw(0.7), np.array([1, -2, 3.0])
    dst = 2.5 * src @ r.T + t
    pts = spark.createDataFrame([("p", *map(float, a), *map(float, b)) for a, b in zip(src, dst, strict=True)], "k string, sx double, sy double, sz double, dx double, dy double, dz double")
    f = similarity.fit_similarity(pts, ["k"]).first()
    assert f["s"] == pytest.approx(2.5) and np.allclose(np.reshape(f["r"], (3, 3)), r) and np.allclose(f["t"], t)


def test_similarity_without_spread(spark):
    r = yaw(0.4)
    rows = [("p", 1.0, 2.0, 3.0, 5.0, 2.0, 3.0, *yaw(a).ravel().tolist(), *(r @ yaw(a)).ravel().tolist()) for a in (0.0, 0.3, 0.9)]
    names = ", ".join([f"{n} double" for n in ("sx", "sy", "sz", "dx", "dy", "dz")] + [f"sr{i} double" for i in range(9)] + [f"dr{i} double" for i in range(9)])
    f = similarity.fit_similarity(spark.createDataFrame(rows, "k string, " + names), ["k"], rotations=True).first()
    assert f["kind"] == "rotation" and f["s"] == 1.0 and np.allclose(np.reshape(f["r"], (3, 3)), r)


def test_strict_alignment_equals_parallel(spark):
    rng = np.random.default_rng(3)
    rows = [("v", f, b, float((1 + f % 5 + rng.normal() * 0.01) * (1 + b) + b)) for b in range(4) for f in range(b * 4, b * 4 + 6)]
    df = spark.createDataFrame(rows, "video string, f bigint, b bigint, raw double")
    a = collect(alignment.align_depth(df, "video", "f", "b", "raw", [], 2).select("b", "f", "raw"), "b", "f")
    s = collect(alignment.align_depth_strict(df, "video", "f", "b", "raw", [], 2).select("b", "f", "raw"), "b", "f")
    assert np.allclose([x[2] for x in a], [x[2] for x in s])


def test_blockwise_equals_whole(spark):
    df = spark.range(10).selectExpr("'v' as video", "id as f", "10L as n", "1 + id / 10D as raw")
    whole = collect(df.select("f", "raw"), "f")
    b = blocks.assign_blocks(df, "f", "n", 4, 2).withColumn("raw", F.expr("raw * (1 + block_id) + block_id"))
    got = collect(alignment.align_depth(b, "video", "f", "block_id", "raw", [], 2).where("written").select("f", "raw"), "f")
    assert np.allclose(got, whole, atol=2e-3)


def test_compare_poses(spark):
    rows = []
    for i in range(8):
        a, c = 0.15 * i, np.array([np.cos(0.15 * i), np.sin(0.15 * i), 0.1 * i])
        r = yaw(a).T
        turn = yaw(0.3)
        rb, cb = r @ turn.T, 2 * turn @ c + 1
        six = lambda m: [*m[:, 0], *m[:, 1]]
        rows.append(("v", i, *map(float, [*(-r @ c), *six(r)]), *map(float, [*(-rb @ cb), *six(rb)])))
    df = spark.createDataFrame(rows, "video string, f int, " + ", ".join(f"{x}{i} double" for x in "ab" for i in range(9)))
    t = compare.trajectory_error(df, "video").first()
    assert t["ate_rmse"] < 1e-9
    angles = [r["angle_deg"] for r in compare.pose_frames(df, ["f"]).collect()]
    assert np.allclose(angles, np.degrees(0.3))


def test_boundary_and_contiguity(spark):
    got = [r[0] for r in spark.range(12).select(compare.near_boundary("id", 8, 1)).collect()]
    assert got == [True, True, False, False, False, False, False, True, True, True, False, False]
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 3), ("c", 1), ("c", 1)], "v string, f bigint")
    assert [r[4] for r in collect(compare.contiguity(df, ["v"], "f"), "v")] == [True, False, False]


def test_tokens_and_sizes(spark):
    t = spark.createDataFrame([([0, 1, 2, 3, 4, 5, 6],)], "t array<int>")
    assert t.select(vectors.drop_registers("t", 4)).first()[0] == [0, 5, 6]
    assert spark.range(1).select(vectors.patch_side("1025")).first()[0] == 32
    for bad in (vectors.patch_side("1024"), vectors.native_size("512", "500")):
        with pytest.raises(Exception, match="square|multiples"):
            spark.range(1).select(bad).collect()


def test_checks_and_report(spark):
    ok = validate.check_values(spark.createDataFrame([(0.1,), (0.9,)], "v double"), "depth", "v", 0, 1)
    assert validate.summary(ok).first()["overall"] == "PASS"
    bad = validate.check_values(spark.createDataFrame([(0.1,), (float("nan"),)], "v double"), "a|b", "v")
    assert not bad.where("name = 'finite'").first()["passed"]
    assert not validate.check_values(spark.createDataFrame([], "v double"), "x", "v").where("passed").count()
    perf = spark.createDataFrame([("v", "dino", 64, 4.0, 16.0, 1200.0, None)], "video_id string, branch string, frames bigint, seconds double, fps double, peak_mem_mb double, note string")
    text = validate.report({"host": "here"}, ok.unionByName(bad), perf, "make check")
    assert "a\\|b" in text and "| 64 | 4.0 | 16.0 | 1200.0 |" in text and "**FAIL**" in text
    w = validate.recommend_window(spark.createDataFrame([(24, True), (96, True), (112, False)], "w int, ok boolean"), "w", "ok").first()
    assert (w["largest"], w["window"], w["overlap"]) == (96, 76, 19)


def test_pose_checks(spark):
    rows = [(0, *map(float, rot.IDENTITY_POSE)), (1, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, -1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "pos int, " + ", ".join(f"p{i} double" for i in range(9)))
    assert validate.check_pose(df, "pos").where("not passed").isEmpty()


def test_files(spark, tmp_path, monkeypatch):
    (tmp_path / "ep1").mkdir()
    for name in ("ep1/b.mp4", "a.MP4", "c.Mp4", "d.txt", "ep1/e.mov"):
        (tmp_path / name).write_bytes(b"" if name == "a.MP4" else b"x")
    found = [r["path"].rsplit("/", 2)[-2:] for r in files.find_videos(spark, f"file://{tmp_path}").collect()]
    assert [f[-1] for f in found] == ["a.MP4", "b.mp4", "e.mov"]
    ids = files.find_videos(spark, f"file://{tmp_path}").select(files.video_id("path"), files.video_id("path", stem_only=True)).collect()
    assert ids[1][0] == "ep1_b" and ids[1][1] == "b"
    monkeypatch.setenv(files.ASSETS_VARIABLE, "~/x")
    assert str(files.assets_root("/y")) == "/y" and files.assets_root().name == "x" and "~" not in str(files.assets_root())
    assert files.ramp_frames(spark).count() == 12 and files.gradient_frames(spark).first()["row"][-1] == 255
    listing = spark.createDataFrame([("/m/1/model.pt", 5), ("/m/2/model.safetensors", 200 << 20)], "path string, length bigint")
    assert files.find_checkpoint(listing) == "/m/2/model.safetensors" and files.largest_file(listing) == "/m/2/model.safetensors"
    with pytest.raises(FileNotFoundError):
        files.find_checkpoint(listing.limit(0))


def test_image_helpers(spark):
    from framelake.functions import images

    sizes = spark.createDataFrame([(480, 640), (100, 2000), (518, 518)], "h int, w int")
    got = [tuple(tuple(x) for x in r) for r in sizes.select(images.contained_size("h", "w"), images.covering_size("h", "w")).collect()]
    assert got[0][0] == (392, 518) and got[0][1][0] == 518 and got[2] == ((518, 518), (518, 518))
    assert all(h % 14 == 0 and w % 14 == 0 for r in got for h, w in r)
    with pytest.raises(Exception, match="unknown model"):
        spark.createDataFrame([("nothing",)], "n string").select(images.model_name("n")).collect()
    assert '"fps": 30' in images.render_report(fps=30) and len(__import__("json").loads(images.render_report())) == 14
    with pytest.raises(ValueError):
        images.render_report(colour=1)
    with pytest.warns(UserWarning, match="twice") as seen:
        images.warn_once("k", "twice")
        images.warn_once("k", "twice")
    assert len(seen) == 1
