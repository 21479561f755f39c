"""The remote scans as plans: what is stored of an episode in, a wide row of it out.

Whatever fails fails its episode alone: a row with ``ok`` false and the first error."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnweave.operators import geometry, series
from tarnweave.operators.catalog import long_enough
from tarnweave.session import stash
from tarnweave.sources import arrays, shards
from tarnweave.sources.files import copy_missing
from tarnweave.sources.tables import lookup

KEY = "episode_hash"
#: Names of the stored arrays, and the measures of a stream of poses.
STREAMS = {"left": "left.obs_ee_pose", "right": "right.obs_ee_pose", "head": "obs_head_pose"}
POINTS = {"left": "left.obs_keypoints", "right": "right.obs_keypoints"}
STAMPS, CAMERA, FRAMES = "obs_rgb_timestamps_ns", "images.front_1", 32
MEASURES = ("path_len", "speed_max", "speed_mean", "jerk_rms", "sparc", "idle_frac", "ang_path", "net_disp", "straightness", "act_start", "act_end")


def stored_groups(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(groups, rows): the groups' attributes, and the rows of the arrays that the scans ask for, read
    once. Numbers are doubles: stamps beyond 2**53 ns keep some hundred nanoseconds' precision."""
    kinds = "total_frames long, fps double, intrinsics map<string,array<array<double>>>"
    groups = arrays.attributes(arrays.metadata(spark, path), kinds)
    return groups, stash(arrays.read_arrays(spark, path, [*STREAMS.values(), *POINTS.values(), STAMPS]))


def _failed(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("ok")).groupBy(KEY).agg(F.min_by("error", F.coalesce("array", F.lit(""))).alias("error"))


def _points(rows: DataFrame, side: str) -> DataFrame:
    """(key, frame_idx, points): a side's keypoints as structs."""
    at = lambda i, c: F.get("values", 3 * i + c)
    points = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.struct(at(i, 0).alias("x"), at(i, 1).alias("y"), at(i, 2).alias("z")))
    return rows.where(F.col("ok") & (F.col("array") == POINTS[side])).select(KEY, F.col("row").alias("frame_idx"), points.alias("points"))


def pose_scan(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """A row per episode: ok, error, n_frames, fps_attr, fps_true, duration_s, the MEASURES of each
    stream that is there, prefixed by it, and of each hand the mean span and its variation.

    Rates come from the stamps where there are two at least, else from the group, else 30. A stream of
    one frame can't be measured and fails its episode, as anything that can't be read does. One shuffle
    by episode and stream serves the measures; no value of a series reaches the driver."""
    rate = F.coalesce(F.nullif("fps", F.lit(0.0)), F.lit(30.0))
    base = groups.select(KEY, F.coalesce("total_frames", F.lit(0)).alias("n_frames"), rate.alias("fps_attr"))
    stamps = rows.where(F.col("ok") & (F.col("array") == STAMPS)).select(KEY, "row", F.get("values", F.lit(0)).cast("long").alias("ns"))
    rates = series.true_rate(stamps.join(base.select(KEY, "fps_attr"), KEY), KEY, "row", "ns", F.col("fps_attr")).select(KEY, "fps_true")
    base = base.join(rates, KEY, "left").withColumn("fps_true", F.coalesce("fps_true", "fps_attr"))

    by = [KEY, "body"]
    poses = arrays.pose_rows(rows).join(base.select(KEY, "fps_true", (1 / F.col("fps_true")).alias("dt")), KEY)
    steps = series.motion_steps(poses, by).where("step is not null")
    made = series.motion_features(poses, by).join(series.spectral_smoothness(steps, by, rate=F.col("fps_true")), by)
    wide = made.groupBy(KEY).agg(*(F.max(F.when(F.col("body") == b, F.col(m))).alias(f"{b}_{m}") for b in STREAMS for m in MEASURES))
    spans = [
        series.hand_span(_points(rows, s), KEY).select(KEY, F.col("hand_span_mean").alias(f"{s}_hand_span_mean"), F.col("hand_span_cv").alias(f"{s}_hand_span_cv"))
        for s in POINTS
    ]
    short = poses.groupBy(*by).count().where("count < 2").select(KEY, F.lit("ValueError: a stream of one frame").alias("error")).distinct()
    failed = _failed(rows).unionByName(short).groupBy(KEY).agg(F.min("error").alias("error"))
    whole = reduce(lambda a, b: a.join(b, KEY, "left"), [base, wide, *spans])
    found = whole.join(failed, KEY, "full").withColumn("ok", F.col("error").isNull())
    measured = [F.when(F.col("ok"), F.col(c)).alias(c) for c in whole.columns if c != KEY]
    return found.select(KEY, "ok", F.coalesce("error", F.lit("")).alias("error"), *measured)


def trajectory_scan(groups: DataFrame, rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(key, frame_idx, values): both hands' poses side by side, cut to the active span that
    ``spans`` (key, act_start, act_end) gives; episodes that can't be read have none."""
    poses = arrays.pose_rows(rows).where("body <> 'head'").join(_failed(rows), KEY, "left_anti")
    pose = F.concat(F.array("x", "y", "z"), "q")
    episodes = groups.select(KEY, F.col("total_frames").alias("n")).join(spans.select(KEY, "act_start", "act_end"), KEY, "left")
    return series.trajectories(poses.select(KEY, F.col("body").alias("side"), "frame_idx", pose.alias("pose")), episodes, KEY)


def wanted_frames(rows: DataFrame, episodes: DataFrame, count: int = FRAMES, motion_weighted: bool = True) -> DataFrame:
    """(key, frame_idx): the frames to embed of episodes (key, n_frames, act_start, act_end) of 16
    frames at least: at equal shares of the faster hand's way within the active span, evenly spaced
    where there is no way or its poses can't be read."""
    edge = lambda c, default: F.floor(F.coalesce(F.col(c), F.lit(default)) * (F.col("n_frames") - 1))
    spans = long_enough(episodes).select(KEY, edge("act_start", 0.0).alias("lo"), edge("act_end", 1.0).alias("hi"))
    spans = spans.withColumn("hi", F.greatest("hi", F.col("lo") + 1))
    poses = arrays.pose_rows(rows).where("body <> 'head'").join(_failed(rows), KEY, "left_anti")
    moved = series.motion_steps(poses.withColumn("dt", F.lit(1.0)), [KEY, "body"]).where("step is not null")
    # a step belongs to the frame that it leaves
    sides = [moved.where(F.col("body") == s).select(KEY, (F.col("frame_idx") - 1).alias("frame_idx"), "step") for s in POINTS]
    speeds = series.fastest_side(*sides, key=KEY, order="frame_idx", speed="step")
    speeds = speeds if motion_weighted else speeds.limit(0)
    return series.equal_motion_frames(spans, speeds, KEY, "frame_idx", "step", count).withColumnRenamed("frame", "frame_idx")


def hand_boxes(groups: DataFrame, rows: DataFrame, frames: DataFrame, camera: str = "front_1") -> DataFrame:
    """(key, frame_idx, left, top, right, bottom) of ``frames`` (key, frame_idx, width, height): a
    square around the keypoints of both hands as the camera on the head sees them."""
    points = reduce(DataFrame.unionByName, (_points(rows, s) for s in POINTS))
    flat = points.select(KEY, "frame_idx", F.explode("points").alias("p")).join(frames.select(KEY, "frame_idx", "width", "height"), [KEY, "frame_idx"])
    head = arrays.pose_rows(rows).where("body = 'head'").select(KEY, "frame_idx", *(F.col(c).alias(f"h{c}") for c in "xyz"), F.col("q").alias("hq"))
    lens = groups.select(KEY, F.col("intrinsics")[camera].alias("k")).where("k is not null")
    seen = flat.join(head, [KEY, "frame_idx"]).join(lens, KEY)
    u, v, depth = geometry.project(
        [F.col(f"p.{c}") for c in "xyz"], [F.col(f"h{c}") for c in "xyz"], [F.col("hq")[i] for i in range(4)], [[F.col("k")[i][j] for j in range(4)] for i in range(3)]
    )
    shown = seen.select(F.struct(KEY, "frame_idx").alias("at"), "width", "height", u.alias("u"), v.alias("v"), depth.alias("depth"))
    return geometry.hand_box(shown, "at", F.col("width"), F.col("height")).select("at.*", "left", "top", "right", "bottom")


def embed_scan(
    spark: SparkSession,
    path: str,
    episodes: DataFrame,
    make_encoder: Callable[[], Callable[..., np.ndarray]],
    decode: Callable[[bytes], np.ndarray] | None = None,
    hand_crop: bool = False,
    motion_weighted: bool = True,
    count: int = FRAMES,
) -> DataFrame:
    """A row per episode (key, n_frames, act_start, act_end; 16 frames at least): ok, error, frame_idx,
    emb (a unit vector of each frame), mean, cropped.

    The frames at equal shares of motion are fetched by ranged reads, a shard by one task, and encoded
    in batches. With ``decode`` an encoder gets pixels, heights and widths, cut to the hands on request;
    without it the stored pictures. A frame that can't be read, or an episode without frames, fails
    its episode; frames that aren't stored are left out."""
    groups, rows = stored_groups(spark, path)
    wanted = stash(wanted_frames(rows, episodes, count, motion_weighted))
    frames = stash(shards.fetch_frames(shards.frame_sizes(spark, path, CAMERA), wanted).drop("read"))
    cropped = F.lit(False)
    good = frames.where("ok")
    if decode is not None:
        shown = stash(shards.decoded(good, decode))
        if hand_crop:
            shown = shown.join(hand_boxes(groups, rows, shown.where("pixels is not null")), [KEY, "frame_idx"], "left")
            cropped = F.col("left").isNotNull()
            shown = shards.cropped(shown)
        bad = shown.where("pixels is null").select(KEY, "frame_idx", F.lit("ValueError: a frame that isn't decoded").alias("error"))
        frames = frames.where("not ok").select(KEY, "frame_idx", "error").unionByName(bad)
        good = shown.where("pixels is not null").withColumnRenamed("pixels", "content")
    encoded = shards.embedded(good, make_encoder, shapes=decode is not None).withColumn("cropped", cropped)
    each = F.array_sort(F.collect_list(F.struct("frame_idx", "emb")))
    found = encoded.groupBy(KEY).agg(each.alias("f"), F.count_if("cropped").alias("cropped"))
    failed = frames.where(F.col("error").isNotNull()).groupBy(KEY).agg(F.min_by("error", "frame_idx").alias("error"))
    every = long_enough(episodes).select(KEY).distinct().join(found, KEY, "left").join(failed, KEY, "left")
    error = F.coalesce("error", F.when(F.col("f").isNull(), F.lit("ValueError: no frames decoded")), F.lit(""))
    ok = F.col("error") == ""
    mean = F.transform(F.sequence(F.lit(0), F.size(F.col("emb")[0]) - 1), lambda i: F.aggregate("emb", F.lit(0.0), lambda s, x: s + F.get(x, i).cast("double")) / F.size("emb"))
    return (
        every.withColumn("error", error).withColumn("f", F.when(ok, F.col("f")))
        .select(KEY, ok.alias("ok"), "error", F.col("f.frame_idx").alias("frame_idx"), F.col("f.emb").alias("emb"), F.when(ok, F.col("cropped")).alias("cropped"))
        .withColumn("mean", F.when(F.col("ok"), mean))
    )


def embedding_rows(embedded: DataFrame, count: int = FRAMES) -> DataFrame:
    """(key, t, emb) of the episodes that have all ``count`` frames: what the outlier test takes."""
    whole = embedded.where(F.col("ok") & (F.size("emb") == count))
    return whole.select(KEY, F.posexplode("emb").alias("t", "emb"))


def described(spark: SparkSession, path: str, keys: list[str]) -> dict[str, DataFrame]:
    """What the stored groups of some episodes hold, each part a table: ``arrays`` with shapes, kinds,
    chunks, attributes and first numbers; ``rates``, with ``off`` where the declared one is more than a
    tenth from the stamps' own; ``spans`` of language; ``middle``, the frame in the middle as stored."""
    one = lambda df: df.where(F.col(KEY).isin(keys))
    groups = one(arrays.attributes(arrays.metadata(spark, path), "total_frames long, fps double"))
    stamps = one(arrays.read_arrays(spark, path, [STAMPS])).where("ok").select(KEY, "row", F.get("values", F.lit(0)).cast("long").alias("ns"))
    rates = series.true_rate(stamps.join(groups, KEY), KEY, "row", "ns", F.coalesce("fps", F.lit(0.0)))
    index = one(shards.frame_sizes(spark, path, CAMERA))
    return {
        "arrays": one(arrays.described(spark, path)),
        "rates": series.rate_check(rates),
        "spans": one(arrays.annotations(spark, path)),
        "middle": shards.fetch_frames(index, arrays.middle_frame(index, groups), absent=True),
    }


def episode(spark: SparkSession, catalog: DataFrame, path: str, key: str, cache: str | None = None) -> dict[str, DataFrame]:
    """One episode: its catalog row (an error if there is none), and the copy of its clip to
    ``cache`` where that is given and the row has one, else what its group holds."""
    row = lookup(catalog, KEY, key)
    if cache and "mp4_path" in catalog.columns:
        clip = row.where(F.col("mp4_path").isNotNull()).select(KEY, F.col("mp4_path").alias("source"), F.concat(F.lit(f"{cache}/"), KEY, F.lit(".mp4")).alias("target"))
        if not clip.isEmpty():
            return {"row": row, "clip": copy_missing(clip, KEY)}
    return {"row": row} | described(spark, path, [key])
