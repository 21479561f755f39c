"""Integrity rules, labels, flags, trims and the manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnweave.functions.scalars import clip
from tarnweave.operators.scoring import AXIS_LIMIT

MIN_FRAMES, MIN_DIP, MIN_SPAN = 60, 0.02, 0.35
#: What the integrity rules call the episodes that they drop.
HARD_REASONS = ["too_short", "frame_count_mismatch", "no_visible_change", "mostly_dead_time"]


def act_span(start: Column, end: Column) -> Column:
    return clip(end - start, 0.0, 1.0)


def integrity_reason(n: Column, declared: Column, has_progress: Column, dip: Column, span: Column) -> Column:
    """The first rule that a row breaks, '' if none. A null breaks no rule, but a null count isn't
    the declared one."""
    return (
        F.when(n < MIN_FRAMES, "too_short")
        .when((declared > 0) & (n.isNull() | (n != declared)), "frame_count_mismatch")
        .when(has_progress & (dip < MIN_DIP), "no_visible_change")
        .when(span < MIN_SPAN, "mostly_dead_time")
        .otherwise("")
    )


def declared_count(c: Column) -> Column:
    """A positive count, or -1."""
    return F.when(F.nanvl(c.cast("double"), F.lit(-1.0)) > 0, c.cast("long")).otherwise(F.lit(-1).cast("long"))


def _failing(axes: list[str]) -> Column:
    over = [
        F.when(F.col(a) > AXIS_LIMIT, F.struct((-F.col(a)).alias("z"), F.lit(k).alias("k"), F.lit(a.removeprefix("ax_")).alias("name")))
        for k, a in enumerate(axes)
    ]
    return F.array_compact(F.array(*over))


def failure_label(axes: list[str]) -> Column:
    """The two worst axes over the limit, worst first, ties in declaration order."""
    worst = F.slice(F.array_sort(_failing(axes)), 1, 2)
    names = F.concat_ws("+", F.transform(worst, lambda x: x["name"]))
    return F.when(F.size(worst) > 0, names).otherwise("below_average")


def flags(axes: list[str]) -> Column:
    """All axes over the limit, in declaration order, joined by +."""
    return F.concat_ws("+", F.transform(_failing(axes), lambda x: x["name"]))


def trim_frame(share: Column, n: Column, decision: Column) -> Column:
    """The frame at a share of the span, halves to even; null for dropped episodes."""
    return F.when(decision != "drop", F.bround(share * (n - 1), 0).cast("long"))


def decide(scored: DataFrame, outliers: DataFrame | None, key: str, axes: list[str]) -> DataFrame:
    """decision and reason: integrity rules first, then the outlier test's finding, else keep."""
    judged = scored if outliers is None else scored.join(outliers, key, "left")
    strange = F.lit(False) if outliers is None else F.coalesce(F.col("outlier"), F.lit(False))
    return (
        judged.withColumn("strange", strange & (F.col("reason") == ""))
        .withColumn("decision", F.when((F.col("reason") != "") | F.col("strange"), "drop").otherwise("keep"))
        .withColumn("reason", F.when(F.col("strange"), failure_label(axes)).otherwise(F.col("reason")))
        .drop("strange")
    )


def trim_text(start: Column, end: Column, n: Column, declared: Column) -> Column:
    """The trim as text: frames of how many, and their share in percent; a dash without either."""
    total = F.coalesce(F.nullif(n, F.lit(0)), F.nullif(declared, F.lit(0)))
    percent = F.round(100 * (end - start) / total).cast("long")
    text = F.format_string("frames %d–%d of %d (%d%% of clip)", start, end, total, percent)
    return F.when(percent.isNotNull(), text).otherwise("—")


def clip_url(base: str, key: Column) -> Column:
    return F.concat(F.lit(f"{base}/clip/"), key, F.lit(".mp4"))
