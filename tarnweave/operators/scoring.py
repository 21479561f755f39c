"""Normalisation within operators, axis and composite scores, the eta-squared gate."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnweave.functions.scalars import clip, row_mean
from tarnweave.operators.selection import long_form, order_statistics

Z_LIMIT, AXIS_LIMIT, ETA_LIMIT = 4.0, 1.0, 0.35
#: Direction of each feature, + means higher is better.
SIGNS = {
    "right_sparc": 1, "left_sparc": 1, "head_sparc": 1,
    "right_jerk_rms": -1, "left_jerk_rms": -1, "head_jerk_rms": -1,
    "right_idle_frac": -1, "left_idle_frac": -1, "head_idle_frac": -1,
    "low_detail_frac": -1, "faint_frac": -1, "size_cv": -1,
    "right_straightness": 1, "left_straightness": 1,
    "act_span": 1, "progress_dip": 1, "progress_final": 1,
}
#: Features of each axis and their direction, + means higher is worse.
AXES = {
    "poor_image": {"low_detail_frac": 1, "faint_frac": 1, "size_cv": 1},
    "jittery": {"right_sparc": -1, "left_sparc": -1, "head_sparc": -1},
    "unsteady_camera": {"head_jerk_rms": 1, "head_idle_frac": 1},
    "hesitant": {"right_idle_frac": 1, "left_idle_frac": 1},
    "incomplete": {"act_span": -1, "right_straightness": -1},
}


def with_robust_z(df: DataFrame, values: dict[str, Column], group: str) -> DataFrame:
    """A column per value: (value - group median) / group sample deviation (1 if null or 0), within
    +-4; null for a null group.

    Medians and deviations are one row per group, joined back: small enough for a broadcast, which
    is left to their measured size, and no row moves for it."""
    named = df.where(F.col(group).isNotNull()).withColumnRenamed(group, "__group") if group in df.columns else df
    moved = {n: F.col("__group") if n == group else v for n, v in values.items()}
    found = order_statistics(long_form(named, list(moved.values()), ["__group"]), ["__group"], [0.5])
    entry = F.struct("j", F.struct(F.get("q", F.lit(0)).alias("m"), F.coalesce(F.nullif("s.sd", F.lit(0.0)), F.lit(1.0)).alias("d")))
    of_group = found.groupBy("__group").agg(F.map_from_entries(F.collect_list(entry)).alias("__of"))
    joined = df.join(of_group, F.col(group) == F.col("__group"), "left")
    at = lambda j, c: F.try_element_at("__of", F.lit(j))[c]
    z = [clip((v.cast("double") - at(j, "m")) / at(j, "d"), -Z_LIMIT, Z_LIMIT).alias(n) for j, (n, v) in enumerate(values.items())]
    return joined.select(*(c for c in df.columns if c not in values), *z)


def eta_squared(episodes: DataFrame, features: list[str], group: str) -> DataFrame:
    """(feature, eta2, usage): the share of each feature's variance that lies between groups, 1 where
    it doesn't vary, for features that are there and not all null.

    From counts, means and variances of each group: rows are read once and only one row per group
    and feature moves. Rows without a group count for the whole variance alone."""
    spark, there = episodes.sparkSession, [f for f in features if f in episodes.columns]
    if not there:
        return spark.createDataFrame([], "feature string, eta2 double, usage string")
    of_group = long_form(episodes.withColumn("__group", F.col(group)), [F.col(f) for f in there], ["__group"]).groupBy("__group", "j").agg(
        F.count("*").alias("n"), F.avg("v").alias("m"), (F.var_pop("v") * F.count("*")).alias("w")
    )
    held = F.collect_list(F.struct("n", "m", "w", F.col("__group").isNotNull().alias("named")))
    # one entry per group; the spread of means about the whole mean needs that first
    whole = of_group.groupBy("j").agg(held.alias("g")).withColumn("n", F.aggregate("g", F.lit(0).cast("long"), lambda s, x: s + x["n"]))
    add = lambda f: F.aggregate("g", F.lit(0.0), lambda s, x: s + f(x))
    whole = whole.withColumn("mean", add(lambda x: x["n"] * x["m"]) / F.col("n"))
    total = add(lambda x: x["w"] + x["n"] * (x["m"] - F.col("mean")) * (x["m"] - F.col("mean"))) / (F.col("n") - 1)
    inside = add(lambda x: F.when(x["named"], x["w"]).otherwise(0.0))
    count = F.aggregate("g", F.lit(0).cast("long"), lambda s, x: s + F.when(x["named"], x["n"]).otherwise(F.lit(0).cast("long")))
    sums = whole.select("j", "n", F.when(F.col("n") > 1, total).otherwise(0.0).alias("total"), inside.alias("inside"), count.alias("count"))
    eta = F.when((F.col("total") > 0) & (F.col("count") > 1), 1.0 - F.col("inside") / (F.col("count") - 1) / F.col("total")).otherwise(1.0)
    named = F.element_at(F.array(*map(F.lit, there)), F.col("j") + 1)
    return sums.select(named.alias("feature"), eta.alias("eta2")).withColumn("usage", F.when(F.col("eta2") <= ETA_LIMIT, "USE").otherwise("DROP"))


def usable_features(episodes: DataFrame, signs: dict[str, int], group: str) -> list[str]:
    """The features that pass the gate, in their order: a driver barrier of one number per feature."""
    eta = {r["feature"]: r["eta2"] for r in eta_squared(episodes, list(signs), group).collect()}  # a row per feature
    return [f for f in signs if f in eta and eta[f] <= ETA_LIMIT]


def scores(episodes: DataFrame, group: str, signs: dict[str, int] | None = None, axes: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """``episodes`` with ``score`` by ``signs`` and ``ax_`` columns by ``axes``, whose features go
    through one pass together.

    ``score`` is the mean signed z of the features that pass the gate, nulls filled with the median of
    all; null where none does. An axis is the mean signed z of its features; those that are null or
    aren't there are left out, and an axis of none is null."""
    signs, axes = signs or {}, axes or {}
    used = usable_features(episodes, signs, group) if signs else []
    every = order_statistics(long_form(episodes, [F.col(f) for f in used], []), [], [0.5]).collect() if used else []  # a row per feature
    middle = {used[r["j"]]: r["q"][0] for r in every}
    values = {f"__s_{f}": F.coalesce(F.col(f).cast("double"), F.lit(middle[f])) for f in used}
    features = sorted({f for parts in axes.values() for f in parts if f in episodes.columns})
    values |= {f"__a_{f}": F.col(f) for f in features}
    scored = with_robust_z(episodes, values, group) if values else episodes
    none, made = F.lit(None).cast("double"), []
    if signs:
        made.append((row_mean(*(signs[f] * F.col(f"__s_{f}") for f in used)) if used else none).alias("score"))
    for a, parts in axes.items():
        z = [s * F.col(f"__a_{f}") for f, s in parts.items() if f in features]
        made.append((row_mean(*z) if z else none).alias(f"ax_{a}"))
    names = {"score"} & set(episodes.columns) if signs else set()
    return scored.select(*(c for c in episodes.columns if c not in names), *made)


def axis_scores(episodes: DataFrame, group: str, axes: dict[str, dict[str, int]] = AXES) -> DataFrame:
    """The ``ax_`` columns of ``scores``."""
    return scores(episodes, group, axes=axes)


def composite_score(episodes: DataFrame, signs: dict[str, int], group: str) -> DataFrame:
    """The ``score`` of ``scores``."""
    return scores(episodes, group, signs)


def axes_failed(axes: list[str], limit: float = AXIS_LIMIT) -> Column:
    """How many axes are over the limit."""
    return reduce(add, (F.coalesce((F.col(a) > limit).cast("int"), F.lit(0)) for a in axes))
