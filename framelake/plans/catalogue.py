"""Registered queries over the tables of a folder, and the SQL each must equal.

Stand-ins: `events` is a sequence of frames per user (video = user_id, frame = event_id, signal =
value), `embeddings` holds token vectors (video = label, frame = vec_id), `pages.url` file paths,
`lineitem` pairs of raw and metric pixels. Results are scalar columns, rounded alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import images
from ..functions import rotation as rot
from ..functions import vectors
from ..operators import alignment, blocks, compare, depth, extraction, keyframes, lookup, sampling, similarity, store, validate
from ..session import new_path
from ..sources import files
from ..streaming import frames as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def frames(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", "event_id")


def totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# --- sources -----------------------------------------------------------------------------------


@query("""
    with p as (select page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) as path from pages)
    select page_id, path from p where path <> '' order by path, page_id limit 50
""")
def source_scan(spark: SparkSession, sf: str) -> DataFrame:
    """List sources by path, keep the first fifty."""
    paths = table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^?#]*)", 1).alias("path")).where("path <> ''")
    return files.first_by_path(paths, "path", 50, tie="page_id")


@query("""
    with e as (select ['mp4', 'avi', 'mkv', 'webm', 'mov', 'MP4', 'AVI', 'Mp4', 'txt'] as ext),
    p as (select 'd' || n_regionkey || '/' || n_nationkey || '.' || ext[n_nationkey % 9 + 1] as path, n_nationkey % 9 as k, n_regionkey, n_nationkey, 3 * n_nationkey as length from nation, e)
    select path, length, 'd' || n_regionkey || '_' || n_nationkey as video_id from p where k < 7 order by path
""")
def video_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Files below a folder whose names end as videos' do, by path; empty ones too."""
    root, jvm = new_path(spark, "videos"), spark.sparkContext._jvm
    endings = (*files.EXTENSIONS, "Mp4", "txt")
    for r in table(spark, sf, "nation").select("n_regionkey", "n_nationkey").collect():  # 25 rows by definition
        at = jvm.org.apache.hadoop.fs.Path(f"{root}/d{r['n_regionkey']}/{r['n_nationkey']}.{endings[r['n_nationkey'] % 9]}")
        out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
        out.write(bytearray(3 * r["n_nationkey"]))
        out.close()
    found = files.find_videos(spark, root).select(F.expr("concat_ws('/', slice(split(path, '/'), -2, 2))").alias("path"), "length")
    return found.withColumn("video_id", files.video_id("path"))


@query("""
    with p as (select page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) || '.mp4' as path from pages),
    q as (select *, regexp_replace(split_part(path, '/', -1), '\\.[^.]*$', '') as stem, case when contains(path, '/') then split_part(path, '/', -2) else '' end as parent from p)
    select page_id, case when parent = '' then stem else parent || '_' || stem end as video_id, stem from q
""")
def video_id_derive(spark: SparkSession, sf: str) -> DataFrame:
    """An id from the parent folder and the stem, or the stem alone."""
    paths = table(spark, sf, "pages").select("page_id", F.concat(F.regexp_extract("url", "^[a-z]+://([^?#]*)", 1), F.lit(".mp4")).alias("path"))
    return paths.select("page_id", files.video_id("path").alias("video_id"), files.video_id("path", stem_only=True).alias("stem"))


@query("""
    with p as (select page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) || '.mp4' as path from pages),
    q as (select page_id, regexp_replace(split_part(path, '/', -1), '\\.[^.]*$', '') as video_id from p)
    select video_id, count(*) as n from q group by 1 having count(*) > 1
""")
def id_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that more than one source claims."""
    paths = table(spark, sf, "pages").select("page_id", F.concat(F.regexp_extract("url", "^[a-z]+://([^?#]*)", 1), F.lit(".mp4")).alias("path"))
    return files.collisions(paths.withColumn("video_id", files.video_id("path", stem_only=True)), "video_id")


@query("select 'ramp' as video_id, i as frame_idx, 96 as height, 128 as width, cast(i * 20 as double) as grey from range(12) t(i)")
def synthetic_ramp(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of known grey levels."""
    return files.ramp_frames(spark, 12, 128, 96, 20)


# --- sampling ----------------------------------------------------------------------------------

_POS = "p as (select user_id, event_id, row_number() over (partition by user_id order by event_id) - 1 as row_pos, count(*) over (partition by user_id) as n from events)"


@query(f"""
    with {_POS}, q as (select *, greatest(1, n // 25) as step from p)
    select user_id, event_id, case when n <= 25 then row_pos else row_pos // step end as row_pos from q where n <= 25 or (row_pos % step = 0 and row_pos // step < 25)
""")
def frame_sampling(spark: SparkSession, sf: str) -> DataFrame:
    """25 frames of each video."""
    return sampling.sample_frames(frames(spark, sf), "user_id", "event_id", 25)


@query(f"with {_POS} select user_id, event_id, row_pos from p where n <= 20 or row_pos % greatest(1, n // 20) = 0")
def frame_stride_cap(spark: SparkSession, sf: str) -> DataFrame:
    """Thin videos above a cap by a stride."""
    return sampling.with_positions(frames(spark, sf), "user_id", "event_id").where(sampling.stride_cap("row_pos", "n_frames", 20)).select("user_id", "event_id", "row_pos")


@query("""
    with t as (select user_id, count(*) as n from events group by 1), i as (select t.*, i from t, range(16) r(i) where i < least(n, 16))
    select user_id, case when n <= 16 then i when i = 15 then n - 1 else cast(floor(i * ((n - 1) / 15.0::double)) as bigint) end as row_pos from i
""")
def pose_cap_linspace(spark: SparkSession, sf: str) -> DataFrame:
    """16 positions spread over each video."""
    return sampling.linspace_positions(totals(spark, sf), "n", 16).select("user_id", "row_pos")


@query("select event_id, case when event_id < 0 or event_id >= (select count(*) * 7 // 10 from events) then 'out' else 'in' end as side from events")
def range_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Requests that exist, and those that don't."""
    events = table(spark, sf, "events")
    rows = events.select("event_id").withColumn("total", events.agg(F.expr("count(*) * 7 div 10")).scalar())
    inside, outside = sampling.in_range(rows, "event_id", "total"), sampling.out_of_range(rows, "event_id", "total")
    return inside.select("event_id", F.lit("in").alias("side")).unionByName(outside.select("event_id", F.lit("out").alias("side")))


@query("""
    with q as (select user_id, event_id, max(case when event_id >= (select count(*) * 7 // 10 from events) then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as bad from events)
    select user_id, count(*) as n, max(event_id) as last_event from q where bad = 0 group by 1
""")
def stop_at_end(spark: SparkSession, sf: str) -> DataFrame:
    """Readers that stop at the first request beyond the end."""
    events = table(spark, sf, "events")
    rows = events.select("user_id", "event_id", F.struct("ts", "event_id").alias("pos")).withColumn("total", events.agg(F.expr("count(*) * 7 div 10")).scalar())
    return sampling.until_out_of_range(rows, "user_id", "pos", "event_id", "total").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"))


@query("select event_id from events where event_id >= 100 and (event_id - 100) % 7 = 0 and (event_id - 100) // 7 < 300")
def strided_range(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh frame from 100, 300 at most."""
    return table(spark, sf, "events").where(sampling.strided_range("event_id", 100, 7, 300)).select("event_id")


@query("select user_id, count(*) as n, case when count(*) > 66 then 'stream' else 'memory' end as route from events group by 1")
def stream_routing(spark: SparkSession, sf: str) -> DataFrame:
    """Which videos are streamed."""
    return totals(spark, sf).withColumn("route", sampling.route("n", 66))


# --- blocks ------------------------------------------------------------------------------------

_BLOCKS = """t as (select user_id, count(*) as n from events group by 1),
    b as (select user_id, n, unnest(range(0, case when n <= 16 then 0 else cast(ceil((n - 16) / 12.0) as bigint) end + 1)) as block_id from t)"""


@query(f"with {_BLOCKS} select user_id, block_id, block_id * 12 as read_start, least(block_id * 12 + 16, n) as read_end, case when block_id = 0 then 0 else block_id * 12 + 4 end as write_start from b")
def block_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of 16 rows that overlap by 4."""
    return blocks.plan_blocks(totals(spark, sf), "n", 16, 4).drop("n")


@query(f"""
    with {_POS}, {_BLOCKS}
    select p.user_id, p.event_id, b.block_id, p.row_pos >= case when b.block_id = 0 then 0 else b.block_id * 12 + 4 end as written
    from p join b on p.user_id = b.user_id and p.row_pos >= b.block_id * 12 and p.row_pos < least(b.block_id * 12 + 16, b.n)
""")
def block_assign(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to the blocks that read them, without a range join."""
    return blocks.assign_blocks(sampling.with_positions(frames(spark, sf), "user_id", "event_id"), "row_pos", "n_frames", 16, 4).select("user_id", "event_id", "block_id", "written")


@query(f"""
    with {_POS}, {_BLOCKS}, j as (select p.user_id, p.row_pos, p.row_pos >= case when b.block_id = 0 then 0 else b.block_id * 12 + 4 end as written
    from p join b on p.user_id = b.user_id and p.row_pos >= b.block_id * 12 and p.row_pos < least(b.block_id * 12 + 16, b.n))
    select user_id, row_pos, count(*) as n_read, count(*) filter (written) as n_written from j group by 1, 2
""")
def write_once_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Each row is written by one block."""
    assigned = blocks.assign_blocks(sampling.with_positions(frames(spark, sf), "user_id", "event_id"), "row_pos", "n_frames", 16, 4)
    return blocks.coverage(assigned, "user_id", "row_pos")


# --- keyframes, fits, depth ----------------------------------------------------------------------

_KEYS = """s as (select user_id, event_id, row_number() over (partition by user_id order by event_id) as i, max(event_id) over (partition by user_id) as top from events),
    r(user_id, i, f, last, is_key, top) as (
        select user_id, i, event_id, event_id, true, top from s where i = 1
        union all
        select s.user_id, s.i, s.event_id, case when s.event_id - r.last >= 1000 then s.event_id else r.last end, s.event_id - r.last >= 1000, s.top
        from r join s on s.user_id = r.user_id and s.i = r.i + 1
    )"""


@query(f"with recursive {_KEYS} select user_id, f as event_id from r where is_key or f = top")
def keyframe_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy keyframes at least 1000 apart, and the last frame."""
    return keyframes.keyframes(frames(spark, sf), "user_id", "event_id", 1000)


@query("""
    with recursive s as (select user_id, event_id, -200 * (user_id % 7) as c, row_number() over (partition by user_id order by event_id) as i, max(event_id) over (partition by user_id) as top from events),
    r(user_id, i, f, last, is_key, top) as (
        select user_id, i, event_id, case when event_id - c >= 1000 then event_id else c end, event_id - c >= 1000, top from s where i = 1
        union all
        select s.user_id, s.i, s.event_id, case when s.event_id - r.last >= 1000 then s.event_id else r.last end, s.event_id - r.last >= 1000, s.top
        from r join s on s.user_id = r.user_id and s.i = r.i + 1
    ) select user_id, f as event_id from r where is_key or f = top
""")
def keyframe_segment(spark: SparkSession, sf: str) -> DataFrame:
    """A segment that carries a keyframe over from before its rows."""
    rows = frames(spark, sf).withColumn("carried", F.expr("-200 * (user_id % 7)"))
    return keyframes.keyframes(rows, "user_id", "event_id", 1000, carried="carried")


_INTERP = """
    with a as (select user_id, event_id, case when event_id % 7 = 0 then value end as v from events),
    b as (select *,
        last_value(case when v is not null then event_id end ignore nulls) over w0 as x0, first_value(case when v is not null then event_id end ignore nulls) over w1 as x1,
        last_value(v ignore nulls) over w0 as v0, first_value(v ignore nulls) over w1 as v1
      from a window w0 as (partition by user_id order by event_id rows between unbounded preceding and current row), w1 as (partition by user_id order by event_id rows between current row and unbounded following))
    select user_id, event_id, round(case when x0 is null then v1 when x1 is null or x1 = x0 then v0 else v0 + (v1 - v0) * ((event_id - x0) / (x1 - x0)::double) end, 8) as v from b
"""


@query(_INTERP)
def interp_anchors(spark: SparkSession, sf: str) -> DataFrame:
    """Parameters between anchors, linear in the source index, clamped at the ends."""
    rows = table(spark, sf, "events").select("user_id", "event_id", F.expr("case when event_id % 7 = 0 then value end").alias("v"))
    return rounded(keyframes.interpolate(rows, "user_id", "event_id", ["v"]), 8, "v")


@query("""
    select l_suppkey, count(*) as n_valid, round(regr_slope(t, s), 6) as scale, round(regr_intercept(t, s), 5) as shift from (
        select l_suppkey, l_quantity as s, l_quantity * 3 + l_discount as t from lineitem where l_quantity > 1e-6 and l_quantity * 3 + l_discount > 1e-6)
    group by 1 having count(*) >= 100
""")
def affine_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Least squares per group over valid pixels, of groups with at least 100."""
    px = table(spark, sf, "lineitem").selectExpr("l_suppkey", "l_quantity as s", "l_quantity * 3 + l_discount as t")
    fits = depth.fit_affine(px, ["l_suppkey"], "s", "t", min_points=100).where("status = 'fitted'").drop("status")
    return rounded(rounded(fits, 6, "scale"), 5, "shift")


@query("select l_suppkey, count(*) as n_valid, 1.0::double as scale, round(greatest(0, avg(l_quantity) - 2), 6) as shift, 'shift only' as status from lineitem group by 1")
def affine_degenerate(spark: SparkSession, sf: str) -> DataFrame:
    """A1: a source without spread gives a shift alone."""
    px = table(spark, sf, "lineitem").selectExpr("l_suppkey", "2D as s", "l_quantity as t")
    return rounded(depth.fit_affine(px, ["l_suppkey"], "s", "t", min_points=1), 6, "shift")


@query("""
    with q as (select l_suppkey, l_quantity, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey) - 1 as i, count(*) over (partition by l_suppkey) as n from lineitem)
    select l_suppkey, count(*) as n, round(sum(l_quantity), 4) as total from q where n <= 50 or i % greatest(1, n // 50) = 0 group by 1
""")
def pixel_thinning(spark: SparkSession, sf: str) -> DataFrame:
    """P5: a strided subsample of large groups."""
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_orderkey", "l_linenumber", "l_partkey")
    return rounded(depth.thin(rows, ["l_suppkey"], "l_orderkey, l_linenumber, l_partkey", 50).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total")), 4, "total")


@query("""
    with z as (select event_id, least(greatest(value * 0.3 - 5, 0.1), 100.0)::double as z from events)
    select event_id, round(z, 6) as z, round(least(greatest((1 / z - 0.01) / (10 - 0.01 + 1e-8), 0), 1), 6) as inv from z
""")
def metricise_inverse_depth(spark: SparkSession, sf: str) -> DataFrame:
    """raw to metric to inverse depth."""
    rows = table(spark, sf, "events").select("event_id", depth.metric("value", "0.3D", "(-5D)").alias("z"))
    return rounded(rows.withColumn("inv", depth.inverse("z")), 6, "z", "inv")


@query("select event_id, cast(round_even((least(greatest((value / 400)::float, 0::float), 1::float) * 65535::float)::float, 0) as integer) as px from events")
def quantise_u16(spark: SparkSession, sf: str) -> DataFrame:
    """K2: depth as whole numbers, in single precision, half to even."""
    return table(spark, sf, "events").select("event_id", depth.quantise("value / 400").alias("px"))


@query("select event_id, cast(floor((least(greatest((value / 400)::float, 0::float), 1::float) * 65535::float)::float) as integer) as px from events")
def quantise_floor(spark: SparkSession, sf: str) -> DataFrame:
    """The stand-alone saver's truncated whole numbers."""
    return table(spark, sf, "events").select("event_id", depth.quantise("value / 400", "floor").alias("px"))


@query("""
    with q as (select least(greatest((value / 400)::float, 0::float), 1::float) as v from events), r as (select v, round_even((v * 65535::float)::float, 0)::float / 65535::float as back from q)
    select max(abs(v::double - back::double)) < 2 / 65535.0 as within, count(*) as n from r
""")
def roundtrip_error(spark: SparkSession, sf: str) -> DataFrame:
    """The error of storing depth."""
    rows = table(spark, sf, "events").select(F.expr("least(greatest(cast(value / 400 as float), cast(0 as float)), cast(1 as float))").alias("v")).withColumn("px", depth.quantise("v"))
    back = rows.withColumn("back", depth.dequantise("px"))
    return back.agg((F.max(F.abs(F.col("v").cast("double") - F.col("back").cast("double"))) < 2 / 65535).alias("within"), F.count(F.lit(1)).alias("n"))


@query("""
    with recursive frames as (
        select label as video, vec_id as f, vec_id as idx, list_transform(embedding::double[], lambda x: x + 1) as raw, max(vec_id) over () + 1 as n from embeddings),
    paired as (
        select a.video, a.f, a.raw, list_transform(range(1, 65), lambda i: 3 * a.raw[i] + 0.2 * b.embedding[i]::double) as metric
        from frames a join embeddings b on b.vec_id = (a.f + 1) % a.n),
    o as (select video, f, row_number() over (partition by video order by f) as i, max(f) over (partition by video) as top from frames),
    k(video, i, f, last, is_key, top) as (
        select video, i, f, f, true, top from o where i = 1
        union all
        select o.video, o.i, o.f, case when o.f - k.last >= 30 then o.f else k.last end, o.f - k.last >= 30, o.top from k join o on o.video = k.video and o.i = k.i + 1),
    px as (select p.video, p.f, unnest(p.raw) as s, unnest(p.metric) as t from paired p join k on k.video = p.video and k.f = p.f where k.is_key or k.f = k.top),
    fit as (select video, f, regr_slope(t, s) as a, regr_intercept(t, s) as h from px group by 1, 2),
    j as (select p.video, p.f, p.raw, fit.a, fit.h from paired p left join fit on fit.video = p.video and fit.f = p.f),
    w as (select *, last_value(case when a is not null then f end ignore nulls) over w0 as x0, first_value(case when a is not null then f end ignore nulls) over w1 as x1,
            last_value(a ignore nulls) over w0 as a0, first_value(a ignore nulls) over w1 as a1, last_value(h ignore nulls) over w0 as h0, first_value(h ignore nulls) over w1 as h1
          from j window w0 as (partition by video order by f rows between unbounded preceding and current row), w1 as (partition by video order by f rows between current row and unbounded following)),
    m as (select video, f, raw, case when x1 = x0 then a0 else a0 + (a1 - a0) * ((f - x0) / (x1 - x0)::double) end as a, case when x1 = x0 then h0 else h0 + (h1 - h0) * ((f - x0) / (x1 - x0)::double) end as h from w),
    inv as (select video, f, list_transform(raw, lambda x: least(greatest((1 / least(greatest(x * a + h, 0.1), 100) - 0.01) / (10 - 0.01 + 1e-8), 0), 1)) as v from m)
    select video, f as frame_idx, round(list_avg(v), 6) as mean_inv, round(list_min(v), 6) as min_inv, round(list_max(v), 6) as max_inv, len(v) as n_px from inv
""")
def keyframe_metric_depth(spark: SparkSession, sf: str) -> DataFrame:
    """W2, A1, W3, F2, F1 on one table: keyframe fits, interpolated, applied, inverted."""
    e = table(spark, sf, "embeddings").selectExpr("label as video", "vec_id as f", "transform(embedding, x -> cast(x as double)) as e")
    base = e.withColumn("n", e.agg(F.max("f") + 1).scalar())
    partner = e.select(F.col("f").alias("g"), F.col("e").alias("p"))
    paired = base.join(partner, F.expr("(f + 1) % n = g")).selectExpr("video", "f", "transform(e, x -> x + 1) as raw", "zip_with(e, p, (x, y) -> 3 * (x + 1) + 0.2D * y) as metric")
    keys = keyframes.keyframes(e, "video", "f", 30)
    pixels = paired.join(keys, ["video", "f"]).select("video", "f", F.explode(F.arrays_zip("raw", "metric")).alias("px")).select("video", "f", "px.raw", "px.metric")
    fits = depth.fit_affine(pixels, ["video", "f"], "raw", "metric", min_points=1).select("video", "f", "scale", "shift")
    params = keyframes.interpolate(paired.select("video", "f", "raw").join(fits, ["video", "f"], "left"), "video", "f", ["scale", "shift"])
    inv = "transform(raw, x -> least(greatest((1D / least(greatest(x * scale + shift, 0.1D), 100D) - 0.01D) / (10D - 0.01D + 1e-8D), 0D), 1D))"
    out = params.select("video", F.col("f").alias("frame_idx"), F.expr(inv).alias("v"))
    return out.selectExpr("video", "frame_idx", "round(aggregate(v, 0D, (s, x) -> s + x) / size(v), 6) as mean_inv", "round(array_min(v), 6) as min_inv", "round(array_max(v), 6) as max_inv", "cast(size(v) as bigint) as n_px")


# --- vectors -----------------------------------------------------------------------------------


@query("""
    with q as (select vec_id, embedding::double[] as e from embeddings), n as (select vec_id, e, greatest(sqrt(list_sum(list_transform(e, lambda x: x * x))), 1e-8) as n from q)
    select vec_id, round(n, 6) as norm, round(e[1] / n, 6) as first, round(e[64] / n, 6) as last from n
""")
def l2_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """vectors of length one."""
    v = table(spark, sf, "embeddings").select("vec_id", vectors.norm("embedding").alias("norm"), vectors.l2_normalise("embedding").alias("v"))
    return rounded(v.selectExpr("vec_id", "norm", "v[0] as first", "v[63] as last"), 6, "norm", "first", "last")


_COS = """
    with q as (select label, vec_id, embedding::double[] as e, row_number() over (partition by label order by vec_id) as i from embeddings),
    c as (select q.label, q.vec_id, list_inner_product(q.e, f.e) as c from q join q f on f.label = q.label and f.i = 1)
"""


def _to_first(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("label", "vec_id", "embedding")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("cls"))
    return e.join(first, "label").select("label", "vec_id", vectors.dot("embedding", "cls").alias("c"))


@query(_COS + "select label, vec_id, round(c, 6) as c from c")
def cls_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """likeness of tokens to the first of their group."""
    return rounded(_to_first(spark, sf), 6, "c")


@query(_COS + ", e as (select quantile_cont(c, 0.02) as lo, quantile_cont(c, 0.98) as hi from c) select label, vec_id, round(least(greatest((c - lo) / ((case when hi <= lo + 1e-8 then lo + 1 else hi end) - lo), 0), 1), 6) as c from c, e")
def percentile_stretch(spark: SparkSession, sf: str) -> DataFrame:
    """Values stretched between two percentiles."""
    return rounded(vectors.percentile_stretch(_to_first(spark, sf), ["c"]), 6, "c")


@query()
def pca_rgb(spark: SparkSession, sf: str) -> DataFrame:
    """Three principal components, stretched to colours. Tested against NumPy."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    mean, basis = vectors.pca_basis(e, "embedding", 3)
    out = vectors.percentile_stretch(vectors.project(e, "embedding", mean, basis, ["red", "green", "blue"]).drop("embedding"), ["red", "green", "blue"])
    return rounded(out, 6, "red", "green", "blue")


@query("""
    with q as (select vec_id, list_transform(range(8), lambda i: embedding[8 * i + 1]) as t from embeddings)
    select vec_id, len(k) as n, round(k[1]::double, 6) as cls, round(k[2]::double, 6) as next from (select vec_id, list_concat(t[1:1], t[4:]) as k from q)
""")
def token_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Register tokens go, token 0 stays."""
    t = table(spark, sf, "embeddings").select("vec_id", F.expr("transform(sequence(0, 7), i -> embedding[8 * i])").alias("t")).select("vec_id", vectors.drop_registers("t", 2).alias("k"))
    return rounded(t.selectExpr("vec_id", "cast(size(k) as bigint) as n", "cast(k[0] as double) as cls", "cast(k[1] as double) as next"), 6, "cls", "next")


@query("select p_partkey, p_size * 16 // 16 as h, (p_size * 32 + case when p_partkey % 2 = 0 then 0 else 5 end) // 16 as w, p_partkey % 2 = 0 as native from part")
def patch_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Patch grids and whether the size needs no resizing."""
    rows = table(spark, sf, "part").selectExpr("p_partkey", "p_size * 16 as height", "p_size * 32 + if(p_partkey % 2 = 0, 0, 5) as width")
    fits = F.expr("height % 16 = 0 and width % 16 = 0")
    return rows.withColumn("g", vectors.patch_grid("height", "width")).select("p_partkey", "g.h", "g.w", F.when(fits, vectors.native_size("height", "width")).otherwise(False).alias("native"))


@query("""
    with s as (select p_partkey, 240 + p_size * 13 as h, 320 + p_size * 31 as w from part),
    k as (select *, least(518.0::double / h, 518.0::double / w) as fit, greatest(h, w) / least(h, w)::double as ratio from s),
    q as (select *, case when ratio > 1.78 then greatest(cast(round_even(floor(518 * 1.777::double / ratio) / 14, 0) * 14 as integer), 14) else 518 end as side from k),
    c as (select *, greatest(side / h::double, side / w::double) as cover from q)
    select p_partkey, cast(ceil(h * fit / 14) * 14 as integer) as fit_h, cast(ceil(w * fit / 14) * 14 as integer) as fit_w,
        cast(case when round_even(h * cover / 14, 0) * 14 < side then ceil(h * cover / 14) * 14 else round_even(h * cover / 14, 0) * 14 end as integer) as cover_h,
        cast(case when round_even(w * cover / 14, 0) * 14 < side then ceil(w * cover / 14) * 14 else round_even(w * cover / 14, 0) * 14 end as integer) as cover_w from c
""")
def image_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """sizes to which models resize."""
    rows = table(spark, sf, "part").selectExpr("p_partkey", "240 + p_size * 13 as h", "320 + p_size * 31 as w")
    both = rows.select("p_partkey", images.contained_size("h", "w").alias("fit"), images.covering_size("h", "w").alias("cover"))
    return both.selectExpr("p_partkey", "fit.h as fit_h", "fit.w as fit_w", "cover.h as cover_h", "cover.w as cover_w")


@query("select event_id, round((event_id % 256 / 255.0::double - 0.456) / 0.224, 6) as green, event_id % 7 as red, format('frame={:05d} t={:06.2f}', event_id, event_id / 30.0::double) as label from events")
def image_channels(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised channels, colour order, labels."""
    rows = table(spark, sf, "events").selectExpr("event_id", "event_id % 256 as v", "array(0L, 1L, event_id % 7) as bgr", "30D as fps")
    out = rows.select("event_id", images.normalised("v", 1).alias("green"), images.swap_channels("bgr")[0].alias("red"), images.frame_label("event_id", "fps").alias("label"))
    return rounded(out, 6, "green")


@query("select vec_id, case when vec_id % 2 = 0 then 'dinov3_vits16plus' else 'dinov3_vits16' end as model from embeddings")
def model_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names and aliases to models."""
    rows = table(spark, sf, "embeddings").selectExpr("vec_id", "case when vec_id % 2 = 0 then 'facebook/dinov3-vits16plus' when vec_id % 3 = 0 then 'dinov3-vits16' else 'dinov3_vits16' end as given")
    return rows.select("vec_id", images.model_name("given").alias("model"))


# --- lookups -----------------------------------------------------------------------------------


@query("""
    with n as (select max(vec_id) as n from embeddings), r as (select vec_id as pos, (vec_id * 7 + 3) % (n.n + 20) as f from embeddings, n union all select vec_id, vec_id // 3 from embeddings)
    select r.pos, r.f as frame_idx, e.label, round(e.embedding[1]::double, 6) as first from r join embeddings e on e.vec_id = r.f
""")
def requested_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in the order asked for, repeats kept, misses left out."""
    e = table(spark, sf, "embeddings")
    request = e.withColumn("n", e.agg(F.max("vec_id")).scalar()).select("vec_id", F.expr("array((vec_id * 7 + 3) % (n + 20), vec_id div 3)").alias("fs"))
    stored = e.select(F.col("vec_id").alias("frame_idx"), "label", F.round(F.col("embedding")[0].cast("double"), 6).alias("first"))
    asked = lookup.numbered(request, "fs", by="vec_id").select(F.col("vec_id").alias("pos"), "frame_idx")
    return lookup.requested_rows(asked, stored, ["frame_idx"]).select("pos", "frame_idx", "label", "first")


@query("select distinct a.user_id, a.event_id // 100 as part from events a join events b on a.user_id = b.user_id and a.event_id // 100 = b.event_id // 100 where a.event_type = 'click' and b.event_type = 'view'")
def common_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that two stores share."""
    e = table(spark, sf, "events").withColumn("part", F.expr("event_id div 100"))
    return lookup.common_frames(e.where("event_type = 'click'"), e.where("event_type = 'view'"), ["user_id", "part"])


@query("""
    with c as (select user_id, event_id // 100 as part, count(*) as clicks from events where event_type = 'click' group by 1, 2), v as (select user_id, event_id // 100 as part, count(*) as views from events where event_type = 'view' group by 1, 2)
    select coalesce(c.user_id, v.user_id) as user_id, coalesce(c.part, v.part) as part, clicks, views from c full outer join v on c.user_id = v.user_id and c.part = v.part
""")
def read_all_outer(spark: SparkSession, sf: str) -> DataFrame:
    """Branches side by side."""
    e = table(spark, sf, "events").withColumn("part", F.expr("event_id div 100"))
    one = lambda kind, name: e.where(F.col("event_type") == kind).groupBy("user_id", "part").agg(F.count(F.lit(1)).alias(name))
    return lookup.read_all([one("click", "clicks"), one("view", "views")], ["user_id", "part"])


@query("""
    with a as (select user_id, row_number() over (partition by user_id order by event_id) - 1 as pos, event_id as f from events),
    b as (select user_id, row_number() over (partition by user_id order by event_id) - 1 as pos, event_id as f from events where value < 480)
    select coalesce(a.user_id, b.user_id) as user_id, count(a.f) as n_requested, count(b.f) as n_stored, bool_and(a.f is not null and b.f is not null and a.f = b.f) as aligned
    from a full outer join b on a.user_id = b.user_id and a.pos = b.pos group by 1
""")
def alignment_check(spark: SparkSession, sf: str) -> DataFrame:
    """Whether stored frames equal the request, in order."""
    e = table(spark, sf, "events")
    asked = sampling.with_positions(e.select("user_id", "event_id"), "user_id", "event_id")
    there = sampling.with_positions(e.where("value < 480").select("user_id", "event_id"), "user_id", "event_id")
    return lookup.alignment(asked, there, ["user_id"], "row_pos", "event_id")


@query("""
    with l as (select user_id, event_type, arg_max(value > 50, event_id) as complete from events where event_type in ('click', 'view', 'purchase') group by 1, 2)
    select distinct user_id from events where user_id not in (select user_id from l where complete group by 1 having count(*) = 3)
""")
def resume_todo(spark: SparkSession, sf: str) -> DataFrame:
    """Videos of which a requested branch is not complete, by its latest attempt."""
    e = table(spark, sf, "events")
    done = e.select("user_id", F.col("event_type").alias("branch"), F.expr("value > 50").alias("complete"), F.col("event_id").alias("attempt"))
    return lookup.todo(e.select("user_id").distinct(), done, "user_id", ["click", "view", "purchase"])


@query("""
    select event_id // 3 as video, case min(case event_type when 'purchase' then 0 when 'click' then 1 else 2 end) when 0 then 'purchase' when 1 then 'click' else 'view' end as branch
    from events where event_type in ('purchase', 'click', 'view') group by 1
""")
def primary_branch(spark: SparkSession, sf: str) -> DataFrame:
    """The first branch that a video has."""
    rows = table(spark, sf, "events").select(F.expr("event_id div 3").alias("video"), F.col("event_type").alias("branch"))
    return lookup.primary_branch(rows, "video", "branch", ("purchase", "click", "view"))


@query("select user_id, event_type, count(*) as n_frames, min(event_id) as first_frame, max(event_id) as last_frame, max(event_id) - min(event_id) + 1 = count(*) as contiguous from events group by 1, 2")
def inspect_store(spark: SparkSession, sf: str) -> DataFrame:
    """Shapes per branch and whether frames are contiguous."""
    return compare.contiguity(table(spark, sf, "events"), ["user_id", "event_type"], "event_id")


@query("select distinct user_id from events order by 1")
def list_videos(spark: SparkSession, sf: str) -> DataFrame:
    """Ids in order."""
    return table(spark, sf, "events").select("user_id").distinct().orderBy("user_id")


# --- comparison --------------------------------------------------------------------------------

_PAIRS = "f as (select l_orderkey, avg(abs(l_quantity - l_quantity * (1 - l_discount))) as mean_abs, max(abs(l_quantity - l_quantity * (1 - l_discount))) as max_abs from lineitem group by 1)"


def _depth_frames(spark: SparkSession, sf: str) -> DataFrame:
    return compare.depth_frames(table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_quantity as a", "l_quantity * (1 - l_discount) as b"), ["l_orderkey"], "a", "b")


@query(f"""
    with {_PAIRS}, b as (select *, least(l_orderkey % 64, 64 - l_orderkey % 64) <= 2 as near from f)
    select count(*) as n_frames, round(avg(mean_abs), 6) as avg_mean_abs, round(max(mean_abs), 6) as worst_mean_abs, round(max(max_abs), 6) as worst_max_abs,
        round(avg(mean_abs) filter (near), 6) as boundary_mean, round(avg(mean_abs) filter (not near), 6) as interior_mean from b
""")
def compare_depth(spark: SparkSession, sf: str) -> DataFrame:
    """Depth differences, at and off block boundaries."""
    out = compare.depth_summary(_depth_frames(spark, sf), "l_orderkey", 64).drop("avg_corr", "worst_corr")
    return rounded(out, 6, *[c for c in out.columns if c != "n_frames"])


@query(f"with {_PAIRS} select l_orderkey, round(mean_abs, 6) as mean_abs, round(max_abs, 6) as max_abs from f order by f.mean_abs desc, l_orderkey limit 5")
def compare_depth_worst5(spark: SparkSession, sf: str) -> DataFrame:
    """A5: the five worst frames."""
    return rounded(compare.worst_frames(_depth_frames(spark, sf).drop("corr"), "mean_abs", "l_orderkey"), 6, "mean_abs", "max_abs")


@query("""
    with p as (select l_suppkey, round(corr(l_quantity, l_quantity * (1 - l_discount)), 6) as corr from lineitem group by 1) select * from p
""")
def compare_depth_corr(spark: SparkSession, sf: str) -> DataFrame:
    """A5: correlation per frame."""
    px = table(spark, sf, "lineitem").selectExpr("l_suppkey", "l_quantity as a", "l_quantity * (1 - l_discount) as b")
    return rounded(compare.depth_frames(px, ["l_suppkey"], "a", "b").select("l_suppkey", "corr"), 6, "corr")


_VECS = """
    with n as (select max(vec_id) + 1 as n from embeddings), p as (select a.vec_id, a.embedding::double[] as a, b.embedding::double[] as b from embeddings a, n join embeddings b on b.vec_id = (a.vec_id + 7) % n.n),
    q as (select vec_id, list_inner_product(a, b) / (sqrt(list_inner_product(a, a)) * sqrt(list_inner_product(b, b)) + 1e-8) as cosine,
        sqrt(list_sum(list_transform(range(1, 65), lambda i: (a[i] - b[i]) * (a[i] - b[i])))) / (sqrt(list_inner_product(b, b)) + 1e-8) as rel_l2 from p)
"""


def _vec_pairs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    left = e.select("vec_id", F.col("embedding").alias("a")).withColumn("n", e.agg(F.max("vec_id") + 1).scalar())
    pairs = left.join(e.select(F.col("vec_id").alias("o"), F.col("embedding").alias("b")), F.expr("(vec_id + 7) % n = o"))
    return compare.dino_frames(pairs, ["vec_id"], "a", "b")


@query(_VECS + "select vec_id, round(cosine, 6) as cosine, round(rel_l2, 6) as rel_l2 from q")
def compare_dino(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine and relative distance of token vectors."""
    return rounded(_vec_pairs(spark, sf), 6, "cosine", "rel_l2")


@query(_VECS + "select count(*) as n_frames, round(avg(cosine), 6) as avg_cosine, round(min(cosine), 6) as worst_cosine, round(avg(rel_l2), 6) as avg_rel_l2, round(max(rel_l2), 6) as worst_rel_l2 from q")
def compare_dino_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Averages and worst."""
    out = compare.dino_summary(_vec_pairs(spark, sf))
    return rounded(out, 6, *[c for c in out.columns if c != "n_frames"])


# --- rotations ---------------------------------------------------------------------------------

_Q = "v as (select label, vec_id, embedding[1]::double as a, embedding[2]::double as b, embedding[3]::double as c, embedding[4]::double as d, embedding[5]::double as tx, embedding[6]::double as ty, embedding[7]::double as tz from embeddings)"
_R = f"""{_Q}, n as (select *, sqrt(a * a + b * b + c * c + d * d) + 1e-8 as m from v), u as (select label, vec_id, tx, ty, tz, a / m as x, b / m as y, c / m as z, d / m as w from n),
    r as (select label, vec_id, tx, ty, tz, 1 - 2 * (y * y + z * z) as r0, 2 * (x * y - z * w) as r1, 2 * (x * z + y * w) as r2, 2 * (x * y + z * w) as r3, 1 - 2 * (x * x + z * z) as r4, 2 * (y * z - x * w) as r5,
        2 * (x * z - y * w) as r6, 2 * (y * z + x * w) as r7, 1 - 2 * (x * x + y * y) as r8 from u)"""


def _quaternions(spark: SparkSession, sf: str) -> DataFrame:
    names = ("a", "b", "c", "d", "tx", "ty", "tz")
    return table(spark, sf, "embeddings").select("label", "vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])


def _rotations(spark: SparkSession, sf: str) -> DataFrame:
    q = _quaternions(spark, sf)
    return q.select("label", "vec_id", "tx", "ty", "tz", *[c.alias(n) for n, c in rot.named("r", rot.quaternion_matrix([F.col(x) for x in "abcd"])).items()])


@query(f"with {_R} select vec_id, round(r0, 6) as d0, round(r3, 6) as d1, round(r6, 6) as d2, round(r1, 6) as d3, round(r4, 6) as d4, round(r7, 6) as d5 from r")
def quat_to_rot6d(spark: SparkSession, sf: str) -> DataFrame:
    """quaternions to six numbers."""
    out = _rotations(spark, sf).select("vec_id", *[c.alias(n) for n, c in rot.named("d", rot.to_6d(rot.cols("r"))).items()])
    return rounded(out, 6, *[f"d{i}" for i in range(6)])


@query(f"with {_Q} select vec_id, round(d * d - a * a - b * b - c * c, 6) as w2, round(2 * d * a, 6) as x2, round(a * a + b * b + c * c + d * d, 6) as unit from v")
def quat_products(spark: SparkSession, sf: str) -> DataFrame:
    """q q and q q*."""
    q = _quaternions(spark, sf)
    v = [F.col(x) for x in "abcd"]
    square, unit = rot.quaternion_multiply(v, v), rot.quaternion_multiply(v, rot.quaternion_conjugate(v))
    return rounded(q.select("vec_id", square[3].alias("w2"), square[0].alias("x2"), unit[3].alias("unit")), 6, "w2", "x2", "unit")


@query(f"""with {_R}, k as (select vec_id, 1 + (vec_id % 3) * 0.00004 as k, r0, r1, r2, r3, r4, r5, r6, r7, r8 from r)
    select vec_id, abs(k * k * (r0 * r0 + r3 * r3 + r6 * r6) - 1) <= 1.1e-4 and abs(k * k * (r1 * r1 + r4 * r4 + r7 * r7) - 1) <= 1.1e-4 and abs(k * k * (r2 * r2 + r5 * r5 + r8 * r8) - 1) <= 1.1e-4
        and abs(k * k * k * (r0 * (r4 * r8 - r5 * r7) - r1 * (r3 * r8 - r5 * r6) + r2 * (r3 * r7 - r4 * r6)) - 1) <= 1.1e-4 as valid from k""")
def rot_valid(spark: SparkSession, sf: str) -> DataFrame:
    """six numbers to matrices, stretched a little, a little more and too much."""
    r = rot.with_matrix(_rotations(spark, sf), rot.to_6d(rot.cols("r")), "m")
    k = F.lit(1.0) + (F.col("vec_id") % 3) * F.lit(0.00004)
    stretched = r.select("vec_id", *[(x * k).alias(n) for n, x in rot.named("k", rot.cols("m")).items()])
    return stretched.select("vec_id", rot.is_rotation(rot.cols("k")).alias("valid"))


@query(f"""
    with {_Q}, f as (select *, {", ".join(f"first_value({c}) over w as f_{c}" for c in "abcd")}, {", ".join(f"first_value({c}) over w as f_{c}" for c in ("tx", "ty", "tz"))} from v window w as (partition by label order by vec_id))
    select label, vec_id, round(d * f_d + a * f_a + b * f_b + c * f_c, 6) as qw, round(-d * f_a + a * f_d - b * f_c + c * f_b, 6) as qx, round(tx - f_tx, 6) as dx from f
""")
def quat_relative(spark: SparkSession, sf: str) -> DataFrame:
    """rotation and move of each frame relative to the first, in quaternions."""
    names = ("a", "b", "c", "d", "tx", "ty", "tz")
    f = _quaternions(spark, sf).withColumns({f"f_{c}": F.expr(f"first_value({c}) over (partition by label order by vec_id)") for c in names})
    q, t = rot.relative_quaternion([F.col(c) for c in "abcd"], [F.col(f"t{x}") for x in "xyz"], [F.col(f"f_{c}") for c in "abcd"], [F.col(f"f_t{x}") for x in "xyz"])
    return rounded(f.select("label", "vec_id", q[3].alias("qw"), q[0].alias("qx"), t[0].alias("dx")), 6, "qw", "qx", "dx")


_FIRST = f"""{_R}, f as (select *, {", ".join(f"first_value({c}) over w as f_{c}" for c in ("tx", "ty", "tz", *[f"r{i}" for i in range(9)]))} from r window w as (partition by label order by vec_id)),
    g as (select label, vec_id, {", ".join(" + ".join(f"r{3 * i + k} * f_r{3 * j + k}" for k in range(3)) + f" as g{3 * i + j}" for i in range(3) for j in range(3))}, tx, ty, tz, f_tx, f_ty, f_tz from f)"""


@query(f"""with {_FIRST} select label, vec_id, {", ".join(f"round(t{'xyz'[i]} - ({' + '.join(f'g{3 * i + k} * f_t' + 'xyz'[k] for k in range(3))}), 6) as p{i}" for i in range(3))},
    {", ".join(f"round(g{k}, 6) as p{3 + n}" for n, k in enumerate((0, 3, 6, 1, 4, 7)))} from g""")
def frame0_relative(spark: SparkSession, sf: str) -> DataFrame:
    """Poses relative to the first frame of each video."""
    cs = ("tx", "ty", "tz", *[f"r{i}" for i in range(9)])
    f = _rotations(spark, sf).withColumns({f"f_{c}": F.expr(f"first_value({c}) over (partition by label order by vec_id)") for c in cs})
    g, t = rot.relative_pose(rot.cols("r"), [F.col(f"t{x}") for x in "xyz"], rot.cols("f_r"), [F.col(f"f_t{x}") for x in "xyz"])
    out = f.select("label", "vec_id", *[c.alias(n) for n, c in rot.named("p", rot.pose9(t, g)).items()])
    return rounded(out, 6, *[f"p{i}" for i in range(9)])


@query(f"with {_FIRST} select label, vec_id, round(degrees(acos(least(greatest((g0 + g4 + g8 - 1) / 2, -1), 1))), 4) as angle from g")
def geodesic(spark: SparkSession, sf: str) -> DataFrame:
    """F16: angles to the first frame."""
    r = _rotations(spark, sf).withColumns({f"f_r{i}": F.expr(f"first_value(r{i}) over (partition by label order by vec_id)") for i in range(9)})
    return rounded(r.select("label", "vec_id", rot.geodesic_degrees(rot.cols("r"), rot.cols("f_r")).alias("angle")), 4, "angle")


@query(f"with {_R} select vec_id, round(-(r0 * tx + r3 * ty + r6 * tz), 6) as cx, round(-(r1 * tx + r4 * ty + r7 * tz), 6) as cy, round(-(r2 * tx + r5 * ty + r8 * tz), 6) as cz from r")
def camera_centres(spark: SparkSession, sf: str) -> DataFrame:
    """rigid inverses and camera centres."""
    r = _rotations(spark, sf)
    _, c = rot.rigid_inverse(rot.cols("r"), [F.col(f"t{x}") for x in "xyz"])
    return rounded(r.select("vec_id", *[x.alias(n) for x, n in zip(c, ("cx", "cy", "cz"), strict=True)]), 6, "cx", "cy", "cz")


# --- similarities and chains ----------------------------------------------------------------------


@query("select label, count(*) as n, 2.5::double as s, 0.0::double as r0, -1.0::double as r1, 1.0::double as r3, 1.0::double as t0, -2.0::double as t1, 3.0::double as t2, 'similarity' as kind from embeddings group by 1")
def umeyama_known(spark: SparkSession, sf: str) -> DataFrame:
    """A2: the transform that made the target points is found: scale 2.5, a quarter turn, a move."""
    e = table(spark, sf, "embeddings").select("label", *[F.col("embedding")[i + 4].cast("double").alias(n) for i, n in enumerate(("sx", "sy", "sz"))])
    points = e.selectExpr("*", "-2.5D * sy + 1 as dx", "2.5D * sx - 2 as dy", "2.5D * sz + 3 as dz")
    f = similarity.fit_similarity(points, ["label"])
    out = f.selectExpr("label", "n", "s", "r[0] as r0", "r[1] as r1", "r[3] as r3", "t[0] as t0", "t[1] as t1", "t[2] as t2", "kind")
    return rounded(out, 6, "s", "r0", "r1", "r3", "t0", "t1", "t2").withColumns({c: F.expr(f"{c} + 0D") for c in ("r0",)})


@query("select label, count(*) as n, 1.0::double as s, -1.0::double as r1, 1.0::double as r3, 'rotation' as kind from embeddings group by 1")
def robust_rotation_only(spark: SparkSession, sf: str) -> DataFrame:
    """A3, A4: points without spread leave the rotation to the orientations."""
    e = table(spark, sf, "embeddings").select("label", *[F.lit(1.0 + i).alias(n) for i, n in enumerate(("sx", "sy", "sz"))])
    points = e.selectExpr("*", "sx + 4 as dx", "sy as dy", "sz as dz", *[f"{1.0 if i % 4 == 0 else 0.0}D as sr{i}" for i in range(9)], *[f"{v}D as dr{i}" for i, v in enumerate((0.0, -1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0))])
    f = similarity.fit_similarity(points, ["label"], rotations=True)
    return rounded(f.selectExpr("label", "n", "s", "r[1] as r1", "r[3] as r3", "kind"), 6, "r1", "r3")


@query("select user_id, event_id, round(value, 4) as v from events")
def chain_affine(spark: SparkSession, sf: str) -> DataFrame:
    """Every block after a video's first measures in units of its own; stitched, the values come back."""
    e = sampling.with_positions(table(spark, sf, "events").select("user_id", "event_id", "value"), "user_id", "event_id")
    b = blocks.assign_blocks(e, "row_pos", "n_frames", 16, 4).withColumn("raw", F.expr("case when block_id = 0 then value else (value + 1 + block_id % 3) * (1 + block_id % 4) / 2 end"))
    out = alignment.align_depth(b, "user_id", "event_id", "block_id", "raw", [], min_points=2)
    return rounded(out.where("written").selectExpr("user_id", "event_id", "raw as v"), 4, "v")


@query("select user_id, event_id, round(value, 4) as cx, round(value * value / 100, 4) as cy, round(event_id / 1000.0, 4) as cz from events")
def chain_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """Every window has a frame of its own; stitched by similarities, the trajectory comes back."""
    e = sampling.with_positions(table(spark, sf, "events").selectExpr("user_id", "event_id", "value as x", "value * value / 100 as y", "event_id / 1000D as z"), "user_id", "event_id")
    b = blocks.assign_blocks(e, "row_pos", "n_frames", 16, 4)
    # window k turns by a quarter k times, shrinks and moves
    k, s = "block_id % 4", "(1 + block_id % 3)"
    own = b.selectExpr(
        "*",
        f"(case {k} when 0 then x when 1 then y when 2 then -x else -y end) / {s} + block_id as cx",
        f"(case {k} when 0 then y when 1 then -x when 2 then -y else x end) / {s} - block_id as cy",
        f"z / {s} as cz",
    )
    now = own.selectExpr("user_id", "event_id", "block_id", "cx as sx", "cy as sy", "cz as sz")
    prev = own.selectExpr("user_id", "event_id", "block_id + 1 as block_id", "cx as dx", "cy as dy", "cz as dz")
    fits = similarity.fit_similarity(now.join(prev, ["user_id", "event_id", "block_id"]), ["user_id", "block_id"]).select("user_id", "block_id", "s", "r", "t")
    first = own.where("block_id = 0").select("user_id", "block_id").distinct().selectExpr("user_id", "block_id", "1D as s", "array(1D,0D,0D,0D,1D,0D,0D,0D,1D) as r", "array(0D,0D,0D) as t")
    world = similarity.compose(first.unionByName(fits), "user_id", "block_id").selectExpr("user_id", "block_id", "s", "r as fr", "t as ft")
    poses = own.where("written").select("user_id", "event_id", "block_id", "cx", "cy", "cz", *[F.lit(1.0 if i % 4 == 0 else 0.0).alias(f"r{i}") for i in range(9)])
    return rounded(similarity.apply_similarity(poses.join(world, ["user_id", "block_id"])).select("user_id", "event_id", "cx", "cy", "cz"), 4, "cx", "cy", "cz")


@query("""
    select user_id, event_id, case when i < 32 then 5.0::double else round(m, 8) end as depth from (
        select user_id, event_id, row_number() over w as i, avg(value) over (partition by user_id order by event_id rows between 31 preceding and current row) as m from events window w as (partition by user_id order by event_id))
""")
def warm_up_window(spark: SparkSession, sf: str) -> DataFrame:
    """A constant until 32 frames are there, then a model over the last 32; here it averages."""
    w = "over (partition by user_id order by event_id rows between 31 preceding and current row)"
    e = table(spark, sf, "events").select("user_id", "event_id", F.expr(f"collect_list(value) {w}").alias("window"))
    return e.selectExpr("user_id", "event_id", "case when size(window) < 32 then 5D else round(aggregate(window, 0D, (s, x) -> s + x) / 32, 8) end as depth")


# --- validation --------------------------------------------------------------------------------


@query("""
    select 'depth' as branch, 'finite' as name, 'all finite' as expected, '0' as observed, true as passed
    union all select 'depth', 'min', '>= 0', cast(round(min(value), 6) as varchar), min(value) >= -1e-6 from events
    union all select 'depth', 'max', '<= 400', cast(round(max(value), 6) as varchar), max(value) <= 400 + 1e-6 from events
    union all select 'depth', 'not constant', 'std > 0', 'true', stddev_pop(value) > 0 from events
    union all select 'dino', 'finite', 'all finite', cast(count(*) filter (x is null or isnan(x)) as varchar), bool_and(x is not null and isfinite(x)) from (select unnest(embedding)::double as x from embeddings)
    union all select 'dino', 'not constant', 'std > 0', cast(stddev_pop(x) > 0 as varchar), stddev_pop(x) > 0 from (select unnest(embedding)::double as x from embeddings)
""")
def sanity_report(spark: SparkSession, sf: str) -> DataFrame:
    """Invariants as rows."""
    e = table(spark, sf, "embeddings").select(F.explode("embedding").alias("f")).select(F.col("f").cast("double").alias("x"))
    return validate.check_values(table(spark, sf, "events"), "depth", "value", 0, 400).unionByName(validate.check_values(e, "dino", "x"))


@query("select count(*) filter (value > 50) as n_pass, count(*) as n_total, 'FAIL' as overall from events")
def check_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Passes and the verdict."""
    return validate.summary(table(spark, sf, "events").selectExpr("value > 50 as passed"))


@query("select user_id, count(*) as frames, round(sum(value), 4) as seconds, round(count(*) / round(sum(value), 4), 6) as fps, round(max(event_id) * 1000 / 1e6, 6) as peak_mem_mb from events group by 1")
def perf_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Frames a second and memory."""
    r = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("frames"), F.round(F.sum("value"), 4).alias("seconds"), (F.max("event_id") * 1000).alias("peak_bytes"))
    return rounded(validate.performance(r).drop("peak_bytes"), 6, "fps", "peak_mem_mb")


@query("select 80 as largest, 64 as window, 16 as overlap")
def probe_window(spark: SparkSession, sf: str) -> DataFrame:
    """The window to use, from what fitted."""
    probes = spark.createDataFrame([(w, w <= 80) for w in validate.PROBE_WINDOWS], "window int, ok boolean")
    return validate.recommend_window(probes, "window", "ok").select("largest", "window", "overlap")


@query("""
    select c_custkey, c_name as video_path, 30.0::double as fps, 0::bigint as num_frames, c_mktsegment = 'BUILDING' as has_depth, false as has_pose, false as has_state, null::integer as state_dim from customer
""")
def annotation_stub(spark: SparkSession, sf: str) -> DataFrame:
    """K9: annotation stubs, with claims from what is complete."""
    c = table(spark, sf, "customer")
    videos = c.select(F.col("c_custkey").cast("string").alias("video_id"), F.col("c_name").alias("path"), F.lit(0).alias("n_frames"))
    done = c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("video_id"), F.lit("depth").alias("branch"), F.lit(True).alias("complete"))
    return store.annotations(videos, done).selectExpr("cast(video_id as bigint) as c_custkey", "video_path", "fps", "num_frames", "has_depth", "has_pose", "has_state", "state_dim")


# --- store and streams -----------------------------------------------------------------------------


def _store(spark: SparkSession) -> store.FeatureStore:
    return store.FeatureStore(spark, new_path(spark, "store"))


@query("select cast(label as varchar) as video_id, vec_id as frame_idx, 0 as token_idx, 64 as width, round(embedding[1]::double, 6) as first from embeddings")
def store_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens written for all videos at once and read back."""
    kept = _store(spark)
    kept.write("dino", table(spark, sf, "embeddings").selectExpr("cast(label as string) as video_id", "vec_id as frame_idx", "0 as token_idx", "embedding as vec"))
    return rounded(kept.read("dino").selectExpr("video_id", "frame_idx", "token_idx", "size(vec) as width", "cast(vec[0] as double) as first"), 6, "first")


@query("""
    select cast(label as varchar) as video_id, vec_id as frame_idx, cast(round_even((least(greatest(embedding[1], 0::float), 1::float) * 65535::float)::float, 0) as integer) as px from embeddings
""")
def store_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """K2, K6, K7: depth appended in two blocks, the second one twice; a repeated block counts once."""
    kept = _store(spark)
    rows = table(spark, sf, "embeddings").selectExpr("cast(label as string) as video_id", "vec_id as frame_idx", "1 as height", "1 as width", "slice(embedding, 1, 1) as depth")
    half = rows.agg(F.expr("percentile_approx(frame_idx, 0.5)")).first()[0] or 0
    kept.write("depth", rows.where(F.col("frame_idx") <= half), block_id=0, reset=True, complete=False)
    for _ in range(2):
        kept.write("depth", rows.where(F.col("frame_idx") > half), block_id=1, reset=False, complete=False)
    return kept.read("depth").selectExpr("video_id", "frame_idx", "px[0] as px")


@query("select cast(label as varchar) as video_id, count(*) as n_frames, 9::bigint as width, 'translation_rot6d' as representation, true as complete, 'pose' as branch from embeddings group by 1")
def store_inspect(spark: SparkSession, sf: str) -> DataFrame:
    """What a store says of its videos."""
    kept = _store(spark)
    kept.write("pose", table(spark, sf, "embeddings").selectExpr("cast(label as string) as video_id", "vec_id as frame_idx", "slice(embedding, 1, 9) as pose"))
    return kept.inspect()


@query(f"with recursive {_KEYS} select user_id, f as event_id from r where is_key")
def stream_keyframes(spark: SparkSession, sf: str) -> DataFrame:
    """T4: keyframes of a stream of frames, the last one of a video carried as state."""
    kind = table(spark, sf, "events").schema
    source = spark.readStream.schema(kind).option("pathGlobFilter", "events.parquet").parquet(sf)
    return _drain(streams.keyframe_stream(source, "user_id", "event_id", 1000), "user_id bigint, event_id bigint")


@query("select user_id, event_id, round(value, 4) as v from events")
def stream_depth(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of a stream aligned to the one before, carried as state."""
    e = sampling.with_positions(table(spark, sf, "events").select("user_id", "event_id", "value"), "user_id", "event_id")
    b = blocks.assign_blocks(e, "row_pos", "n_frames", 16, 4).selectExpr("user_id", "event_id", "block_id", "written", "case when block_id = 0 then value else (value + 1 + block_id % 3) * (1 + block_id % 4) / 2 end as raw")
    path = new_path(spark, "blocks")
    b.write.parquet(path)
    aligned = streams.depth_stream(spark.readStream.schema(b.schema).parquet(path), "user_id", "block_id", "event_id", "raw", "written", 2)
    return rounded(_drain(aligned, "user_id bigint, event_id bigint, raw double").withColumnRenamed("raw", "v"), 4, "v")


# --- extraction ------------------------------------------------------------------------------------


def _videos(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of a video per label: 16 pixels from the first numbers of each vector, saturated where these are large."""
    pixels = "transform(slice(embedding, 1, 16), x -> least(255D, cast(cast(x as double) * 100 + 30 as double)))"
    e = table(spark, sf, "embeddings").selectExpr("cast(label as string) as video_id", "vec_id as frame_idx", f"transform({pixels}, x -> greatest(x, 0D)) as pixels")
    return sampling.with_positions(e.withColumn("grey", F.expr("aggregate(pixels, 0D, (s, x) -> s + x) / 16")), "video_id", "frame_idx")


_PIXELS = "v as (select cast(label as varchar) as video_id, vec_id as frame_idx, list_transform(embedding[1:16], lambda x: greatest(least(255.0::double, x::double * 100 + 30), 0.0::double)) as px from embeddings)"


@query(f"""
    with {_PIXELS}, z as (select video_id, frame_idx, list_transform(px, lambda p: (1 / least(greatest(3 * (p / 255 + 1), 0.1), 100) - 0.01) / (10 - 0.01 + 1e-8)) as d from v)
    select video_id, frame_idx, round(list_avg(d), 5) as mean, round(d[1], 5) as first, round(d[16], 5) as last from z
""")
def extract_depth_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Depths of blocks in units of their own, stitched and made metric at keyframes: what the metric
    model says of every frame."""
    b = blocks.assign_blocks(_videos(spark, sf), "row_pos", "n_frames", 16, 6)
    rows, _ = extraction.depth_windows(b, "video_depth_anything", interval=30, min_points=4)
    return rounded(rows.selectExpr("video_id", "frame_idx", "aggregate(depth, 0D, (s, x) -> s + x) / size(depth) as mean", "depth[0] as first", "depth[15] as last"), 5, "mean", "first", "last")


@query("""
    with v as (select cast(label as varchar) as video_id, vec_id as i, min(vec_id) over (partition by label) as i0 from embeddings),
    a as (select *, 0.15 * i as a, 0.15 * (i0 - i) as d, 1 + 0.1::double * (i0 % 5) as k, cos(0.15 * i0) - cos(0.15 * i) as x, sin(0.15 * i0) - sin(0.15 * i) as y, 0.1::double * (i0 - i) as z from v)
    select video_id, i as frame_idx, round(k * (cos(a) * x + sin(a) * y), 4) + 0 as p0, round(k * (cos(a) * y - sin(a) * x), 4) + 0 as p1, round(k * z, 4) + 0 as p2,
        round(cos(d), 4) + 0 as p3, round(sin(d), 4) + 0 as p4, round(-sin(d), 4) + 0 as p6, round(cos(d), 4) + 0 as p7 from a
""")
def extract_pose_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Poses of windows that each have a world of their own, stitched: the helix on which the cameras
    are, seen from the first one."""
    b = blocks.assign_blocks(_videos(spark, sf), "row_pos", "n_frames", 16, 5)
    rows, _ = extraction.pose_windows(b)
    return rows.select("video_id", "frame_idx", *[(F.round(F.col("pose")[i], 4) + F.lit(0.0)).alias(f"p{i}") for i in (0, 1, 2, 3, 4, 6, 7)])


@query(f"""
    with {_PIXELS} select video_id, case when max(list_max(px)) >= 255 then 'failed' else 'ok' end as status, case when max(list_max(px)) >= 255 then 'depth' end as branch, case when max(list_max(px)) >= 255 then 'ValueError: saturated' end as error from v group by 1
""")
def extract_failures(spark: SparkSession, sf: str) -> DataFrame:
    """A model that fails on some videos; the others go on, and each says how it went."""
    v = _videos(spark, sf).withColumns({"block_id": F.lit(0), "written": F.lit(True)})
    failed = extraction.extract(v, ["dino", "depth", "pose"], lambda branch, rows: None, depth_mode="brittle")
    out = v.select("video_id").distinct().join(failed, "video_id", "left")
    return out.select("video_id", F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), "branch", "error")


@query("select cast(label as varchar) as video_id, vec_id as frame_idx, 4 as width, round(list_avg(list_transform(embedding[1:16], lambda x: greatest(least(255.0::double, x::double * 100 + 30), 0.0::double)))::float::double, 5) as v from embeddings")
def stream_dino(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of a stream of frames, flushed to the store batch by batch."""
    path = new_path(spark, "frames")
    v = _videos(spark, sf).select("video_id", "frame_idx", "grey", "pixels")
    v.write.parquet(path)
    kept = _store(spark)
    run = streams.dino_stream(spark.readStream.schema(v.schema).parquet(path), kept, checkpoint=f"{path}-state").trigger(availableNow=True).start()
    run.awaitTermination()
    return kept.read("dino").selectExpr("video_id", "frame_idx", "size(vec) as width", "round(cast(vec[0] as double), 5) as v")


_POSE_PAIRS = f"""{_R}, n as (select max(vec_id) + 1 as n from embeddings), p as (select a.vec_id, {", ".join(f"a.{c} as a{i}, b.{c} as b{i}" for i, c in enumerate(("tx", "ty", "tz", "r0", "r3", "r6", "r1", "r4", "r7")))},
    {" + ".join(f"a.r{i} * b.r{i}" for i in range(9))} as trace from r a, n join r b on b.vec_id = (a.vec_id + 7) % n.n)""".replace("n as (select *, sqrt(", "norms as (select *, sqrt(").replace("z, d / m as w from n)", "z, d / m as w from norms)")


@query(f"""with {_POSE_PAIRS} select vec_id, round(({" + ".join(f"abs(a{i} - b{i})" for i in range(9))}) / 9, 6) as mean_abs, round(greatest({", ".join(f"abs(a{i} - b{i})" for i in range(9))}), 6) as max_abs,
    cast(floor(least(greatest((trace - 1) / 2, -1), 1) * 20) as bigint) as twentieths from p""")
def compare_pose(spark: SparkSession, sf: str) -> DataFrame:
    """Differences and angles of pairs of poses."""
    r = _rotations(spark, sf)
    p = r.select("vec_id", *[x.alias(n) for n, x in rot.named("a", rot.pose9([F.col(f"t{x}") for x in "xyz"], rot.cols("r"))).items()])
    other = p.select(F.col("vec_id").alias("o"), *[F.col(f"a{i}").alias(f"b{i}") for i in range(9)])
    pairs = p.withColumn("n", r.agg(F.max("vec_id") + 1).scalar()).join(other, F.expr("(vec_id + 7) % n = o"))
    # the angle by its cosine in steps: near a half turn it tells rotations apart that differ by rounding
    out = compare.pose_frames(pairs, ["vec_id"]).withColumn("twentieths", F.floor(F.cos(F.radians("angle_deg")) * 20)).drop("angle_deg")
    return rounded(out, 6, "mean_abs", "max_abs")


@query(f"""with {_FIRST}, p as (select label, row_number() over (partition by label order by vec_id) - 1 as pos, g0, g1, g3, g4, g6, g7 from g)
    select 'pose' as branch, 'first is identity' as name, 'within 1e-3' as expected, cast(count(*) filter (pos = 0) as varchar) as observed, bool_and(pos > 0 or abs(g0 - 1) <= 1e-3 and abs(g3) <= 1e-3 and abs(g6) <= 1e-3 and abs(g1) <= 1e-3 and abs(g4 - 1) <= 1e-3 and abs(g7) <= 1e-3) as passed from p
    union all select 'pose', 'rotations valid', 'all', cast(count(*) filter (not (abs(g0 * g0 + g3 * g3 + g6 * g6 - 1) <= 1e-4 and abs(g0 * g1 + g3 * g4 + g6 * g7) <= 1e-4)) as varchar), bool_and(abs(g0 * g0 + g3 * g3 + g6 * g6 - 1) <= 1e-4 and abs(g0 * g1 + g3 * g4 + g6 * g7) <= 1e-4) from p
""")
def pose_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The first pose of each video is the identity, and all rotations are valid."""
    cs = ("tx", "ty", "tz", *[f"r{i}" for i in range(9)])
    f = _rotations(spark, sf).withColumns({f"f_{c}": F.expr(f"first_value({c}) over (partition by label order by vec_id)") for c in cs}).withColumn("pos", F.expr("row_number() over (partition by label order by vec_id) - 1"))
    g, t = rot.relative_pose(rot.cols("r"), [F.col(f"t{x}") for x in "xyz"], rot.cols("f_r"), [F.col(f"f_t{x}") for x in "xyz"])
    return validate.check_pose(f.select("pos", *[x.alias(n) for n, x in rot.named("p", rot.pose9(t, g)).items()]), "pos")


@query("select 'dino' as branch, 'deterministic' as name, 'no difference' as expected, '0' as observed, count(*) > 0 as passed from embeddings union all select 'dino', 'frames aligned', 'all', '0', count(*) > 0 from embeddings")
def determinism(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the same frames, dealt otherwise, give the same; what is stored is what was asked for."""
    v = _videos(spark, sf).withColumn("written", F.lit(True))
    first, _ = extraction.dino(v)
    second, _ = extraction.dino(v.repartition(3))
    same = validate.check_determinism(first, second, "dino", ["video_id", "frame_idx"], "vec")
    return same.unionByName(validate.check_alignment(v, first, "dino"))


@query("""
    with x as (select generate_subscripts(embedding, 1) as i, unnest(embedding)::double as x from embeddings), s as (select i, var_pop(x) as s, avg(x) as m from x group by 1)
    select count(*) as n, round(sum(s), 4) as total_variance, round(max(m), 6) as largest_mean from s
""")
def pca_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """Along all principal directions the variances add up to those of the coordinates; the mean is their mean."""
    e = table(spark, sf, "embeddings").select("embedding")
    mean, basis = vectors.pca_basis(e, "embedding", 64)
    names = [f"c{i}" for i in range(len(basis))]
    out = vectors.project(e, "embedding", mean, basis, names).agg(F.lit(len(names)).cast("bigint").alias("n"), sum((F.var_pop(n) for n in names[1:]), F.var_pop(names[0])).alias("total_variance"), F.lit(float(mean.max())).alias("largest_mean"))
    return rounded(rounded(out, 4, "total_variance"), 6, "largest_mean")


@query("select cast(label as varchar) as video_id, vec_id as frame_idx, 64 as width, vec_id % 2 = 0 as has_depth, vec_id % 3 = 0 as has_pose from embeddings")
def store_episode(spark: SparkSession, sf: str) -> DataFrame:
    """Three branches written one after the other, read side by side; some frames lack depth or pose."""
    e = table(spark, sf, "embeddings").selectExpr("cast(label as string) as video_id", "vec_id as frame_idx", "embedding")
    kept = _store(spark)
    kept.write_episode(
        e.selectExpr("video_id", "frame_idx", "0 as token_idx", "embedding as vec"),
        e.where("frame_idx % 2 = 0").selectExpr("video_id", "frame_idx", "1 as height", "2 as width", "transform(slice(embedding, 1, 2), x -> abs(x)) as depth"),
        e.where("frame_idx % 3 = 0").selectExpr("video_id", "frame_idx", "slice(embedding, 1, 9) as pose"),
    )
    return kept.read_all().selectExpr("video_id", "frame_idx", "size(dino[0]) as width", "depth is not null as has_depth", "pose is not null as has_pose")


@query("""
    select cast(label as varchar) as video_id, 'dino' as branch, case vec_id % 2 when 0 then 'left' else 'right' end as camera_key, count(*) as n from embeddings group by all
    union all select cast(label as varchar), 'depth', 'left', count(*) from embeddings where vec_id % 2 = 0 group by all
""")
def store_cameras(spark: SparkSession, sf: str) -> DataFrame:
    """K5: tokens and depth of several cameras beside each other."""
    e = table(spark, sf, "embeddings").selectExpr("cast(label as string) as video_id", "vec_id as frame_idx", "embedding", "if(vec_id % 2 = 0, 'left', 'right') as camera_key")
    kept = _store(spark)
    kept.write("dino", e.selectExpr("video_id", "frame_idx", "camera_key", "0 as token_idx", "embedding as vec"))
    kept.write("depth", e.where("camera_key = 'left'").selectExpr("video_id", "frame_idx", "camera_key", "1 as height", "1 as width", "slice(embedding, 1, 1) as depth"))
    count = lambda b: kept.read(b).groupBy("video_id", F.lit(b).alias("branch"), "camera_key").agg(F.count(F.lit(1)).alias("n"))
    return count("dino").unionByName(count("depth"))


@query("select cast(label as varchar) as video_id, 'depth' as branch, label % 2 = 0 as complete from embeddings group by label union all select 'nothing', 'depth', true")
def store_complete(spark: SparkSession, sf: str) -> DataFrame:
    """K7, K8: appended blocks are not complete until marked; a video without data gets the mark alone."""
    e = table(spark, sf, "embeddings").selectExpr("cast(label as string) as video_id", "label", "vec_id as frame_idx", "1 as height", "1 as width", "slice(embedding, 1, 1) as depth")
    kept = _store(spark)
    kept.write("depth", e.drop("label"), block_id=0, reset=True, complete=False)
    even = [r["video_id"] for r in e.where("label % 2 = 0").select("video_id").distinct().collect()]
    kept.mark_complete("depth", [*even, "nothing"])
    return kept.completion().select("video_id", "branch", "complete")


@query("select cast(c_custkey as varchar) as video_id, case when c_mktsegment = 'BUILDING' then 1 else 2 end as num_frames, c_mktsegment = 'BUILDING' as has_depth from customer")
def annotation_skip(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations are written for videos that have none."""
    path = new_path(spark, "annotations")
    c = table(spark, sf, "customer")
    videos = c.select(F.col("c_custkey").cast("string").alias("video_id"), F.col("c_name").alias("path"), "c_mktsegment")
    done = videos.where("c_mktsegment = 'BUILDING'").select("video_id", F.lit("depth").alias("branch"), F.lit(True).alias("complete"))
    store.write_annotations(store.annotations(videos.where("c_mktsegment = 'BUILDING'").withColumn("n_frames", F.lit(1)), done), path)
    store.write_annotations(store.annotations(videos.withColumn("n_frames", F.lit(2)), done), path)
    return spark.read.schema("video_id string, num_frames int, has_depth boolean").json(path)


@query("select 'depth' as branch, 0 as pos union all select 'dino', 1")
def branch_list(spark: SparkSession, sf: str) -> DataFrame:
    """Branches of a comma list."""
    return spark.createDataFrame([(b, i) for i, b in enumerate(sampling.parse_branches(" depth, ,dino,"))], "branch string, pos int")


@query("select p_partkey, p_size as side from part")
def patch_sides(spark: SparkSession, sf: str) -> DataFrame:
    """The side of the square that patches form beside token 0."""
    return table(spark, sf, "part").selectExpr("p_partkey", "p_size * p_size + 1 as n").select("p_partkey", vectors.patch_side("n").alias("side"))


@query("select cast(label as varchar) as video_id, vec_id as frame_idx, label % 2 = 0 as primary_dino from embeddings")
def frame_indices(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of a branch, and of the first branch that a video has."""
    e = table(spark, sf, "embeddings").selectExpr("cast(label as string) as video_id", "label", "vec_id as frame_idx", "embedding")
    kept = _store(spark)
    kept.write("dino", e.where("label % 2 = 0").selectExpr("video_id", "frame_idx", "0 as token_idx", "embedding as vec"))
    kept.write("pose", e.selectExpr("video_id", "frame_idx", "slice(embedding, 1, 9) as pose"))
    own = kept.frame_indices("dino").withColumn("primary_dino", F.lit(True))
    return kept.primary_frame_indices().join(own, ["video_id", "frame_idx"], "left").select("video_id", "frame_idx", F.coalesce("primary_dino", F.lit(False)).alias("primary_dino"))


@query("select 'gradient' as video_id, f as frame_idx, x as col, cast(floor(x * 255 / 31.0::double) as integer) as v from range(8) t(f), range(32) u(x)")
def synthetic_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """Frames that go from dark to bright along every row."""
    return files.gradient_frames(spark, 8, 32, 8).select("video_id", "frame_idx", F.posexplode("row").alias("col", "v")).selectExpr("video_id", "frame_idx", "cast(col as bigint) as col", "cast(v as int) as v")


_FILES = "f as (select '/models/' || lpad(cast(p_partkey as varchar), 8, '0') || case p_partkey % 3 when 0 then '/model.pt' when 1 then '/model.safetensors' else '/notes.txt' end as path, p_size * 3000000 as length from part)"


@query(f"with {_FILES} select max(path) filter (path like '%/model.safetensors') as checkpoint, arg_max(path, length::bigint * 1000000 + cast(substr(path, 9, 8) as bigint)) filter (length > 104857600) as largest from f")
def checkpoint_pick(spark: SparkSession, sf: str) -> DataFrame:
    """S21 and the largest file: the last checkpoint of the preferred name, and the largest file above 100 MiB."""
    f = table(spark, sf, "part").selectExpr("concat('/models/', lpad(cast(p_partkey as string), 8, '0'), case p_partkey % 3 when 0 then '/model.pt' when 1 then '/model.safetensors' else '/notes.txt' end) as path", "p_partkey", "p_size * 3000000L as length")
    # lengths without ties
    lengths = f.selectExpr("path", "if(length > 104857600, length * 1000000 + p_partkey, 0L) as length")
    return spark.createDataFrame([(files.find_checkpoint(f), files.largest_file(lengths))], "checkpoint string, largest string")


@query(f"with {_R} select vec_id, round(-2 * ty + 1, 6) as cx, round(2 * tx - 2, 6) as cy, round(2 * tz + 3, 6) as cz, {', '.join(f'round({e}, 6) + 0 as r{i}' for i, e in enumerate(('-r3', '-r4', '-r5', 'r0', 'r1', 'r2', 'r6', 'r7', 'r8')))} from r")
def apply_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """centres and rotations moved by a similarity: scale 2, a quarter turn, a move."""
    r = _rotations(spark, sf).withColumnsRenamed({"tx": "cx", "ty": "cy", "tz": "cz"})
    moved = similarity.apply_similarity(r.selectExpr("*", "2D as s", "array(0D, -1D, 0D, 1D, 0D, 0D, 0D, 0D, 1D) as fr", "array(1D, -2D, 3D) as ft"))
    return rounded(moved, 6, "cx", "cy", "cz").select("vec_id", "cx", "cy", "cz", *[(F.round(F.col(f"r{i}"), 6) + F.lit(0.0)).alias(f"r{i}") for i in range(9)])


@query("select vec_id, i - 1 as pos, case when i in (4, 8) then 1.0::double else 0.0::double end as v from embeddings, range(1, 10) t(i)")
def identity_poses(spark: SparkSession, sf: str) -> DataFrame:
    """the pose of frames that no model has seen."""
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(rot.identity_pose()).alias("pos", "v")).selectExpr("vec_id", "cast(pos as bigint) as pos", "cast(v as double) as v")


@query("select branch, name, expected, observed, passed from (values ('depth', 'runs', 'runs', 'ValueError: no frames', false)) t(branch, name, expected, observed, passed) union all select 'depth', 'max', '<= 400', cast(round(max(value), 6) as varchar), max(value) <= 400 + 1e-6 from events")
def failed_checks(spark: SparkSession, sf: str) -> DataFrame:
    """A check that could not run is a failed row beside the others."""
    row = spark.createDataFrame([validate.failed_check("depth", "runs", ValueError("no frames"))], schema.CHECKS)
    good = validate.check_values(table(spark, sf, "events"), "depth", "value", 0, 400).where("name = 'max'")
    return row.unionByName(good)


def _drain(stream: DataFrame, schema: str) -> DataFrame:
    """Runs a stream over what is there, into a folder that driver and executors share."""
    spark = stream.sparkSession
    path = new_path(spark, "stream")
    run = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/rows")
    run.awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/rows")
