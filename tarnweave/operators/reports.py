"""Reports and audit screens over a manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.functions.scalars import split_flags
from tarnweave.operators.scoring import axes_failed, eta_squared
from tarnweave.operators.selection import quantiles
from tarnweave.operators.statistics import normalised_mutual_information


def fairness(manifest: DataFrame, group: str) -> DataFrame:
    """Per group, worst first: episodes, share kept and share dropped by integrity rules."""
    return manifest.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("n"),
        F.avg((F.col("decision") == "keep").cast("double")).alias("keep_rate"),
        F.avg(F.coalesce(F.col("hard"), F.lit(False)).cast("double")).alias("hard_rate"),
    ).orderBy("keep_rate", group)


def keep_rate_spread(manifest: DataFrame, group: str) -> DataFrame:
    """One row: the lowest and the highest share kept of a group."""
    return fairness(manifest, group).agg(F.min("keep_rate").alias("lowest"), F.max("keep_rate").alias("highest"))


def decisions(manifest: DataFrame) -> DataFrame:
    """(decision, n, share)."""
    counted = manifest.groupBy("decision").agg(F.count("*").alias("n"))  # two rows
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def failed_axes(manifest: DataFrame, axes: list[str]) -> DataFrame:
    """(failed, keep, drop): episodes by how many axes are over the limit and by decision."""
    counted = manifest.select(axes_failed(axes).alias("failed"), "decision")
    return counted.groupBy("failed").agg(*(F.count_if(F.col("decision") == d).alias(d) for d in ("keep", "drop")))


def warnings(manifest: DataFrame, hard: list[str]) -> DataFrame:
    """One row: the share of kept episodes with a flag; of those dropped for other than a hard
    reason, the share without a defect on any axis; and how many have no embedding, so no test."""
    kept, soft = F.col("decision") == "keep", (F.col("reason") != "") & ~F.col("reason").isin(hard)
    share = lambda of, c: F.try_divide(F.count_if(of & c), F.count_if(of))
    return manifest.agg(
        share(kept, F.col("flags") != "").alias("kept_flagged"), share(soft, F.col("reason") == "below_average").alias("no_defect"),
        F.count_if(F.col("progress_dip").isNull()).alias("untested"),
    )


def timings(results: DataFrame, fetch: str = "fetch_s", compute: str = "gpu_s") -> DataFrame:
    """One row: median seconds of either step and the share of the second."""
    middle = quantiles(results, {"fetch": F.col(fetch), "compute": F.col(compute)}, [0.5]).select(F.col("fetch_0").alias("fetch"), F.col("compute_0").alias("compute"))
    return middle.withColumn("share", F.try_divide(F.col("compute"), F.col("fetch") + F.col("compute")))


def transfers(results: DataFrame) -> DataFrame:
    """One row: copies that went well, those that failed, and bytes."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    return results.agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"), F.coalesce(F.sum(F.when(ok, F.col("bytes"))), F.lit(0)).alias("bytes"))


def cached(files: DataFrame, key: str) -> DataFrame:
    """(key, bytes, mb): what an episode's files take, in MB of a million bytes."""
    return files.groupBy(key).agg(F.sum("bytes").alias("bytes")).withColumn("mb", F.round(F.col("bytes") / 1e6, 2))


def crops(results: DataFrame) -> DataFrame:
    """One row: frames that were cropped and frames fetched, of results that went well."""
    good = results.where(F.coalesce(F.col("ok"), F.lit(False)))
    return good.agg(F.coalesce(F.sum("cropped"), F.lit(0)).alias("cropped"), F.coalesce(F.sum(F.size("frame_idx")), F.lit(0)).alias("fetched"))


def cluster_report(rows: DataFrame, cluster: str, group: str, outlier: Column, score: str) -> DataFrame:
    """Per cluster: size, outliers, the largest share of one group and the mean score."""
    parts = rows.groupBy(cluster, group).agg(
        F.count("*").alias("c"), F.count_if(outlier).alias("o"), F.sum(score).alias("s"), F.count(score).alias("k")
    )
    return parts.groupBy(cluster).agg(
        F.sum("c").alias("n"), F.sum("o").alias("outliers"),
        (F.max(F.when(F.col(group).isNotNull(), F.col("c"))) / F.sum("c")).alias("top_share"),
        F.try_divide(F.sum("s"), F.sum("k")).alias("mean_score"),
    )


def summary(manifest: DataFrame, group: str) -> DataFrame:
    """One row: total, kept, dropped, shares of both in percent (0 of none), those with a reason,
    groups (null is one)."""
    kept = F.count_if(F.col("decision") == "keep")
    percent = lambda n: F.coalesce(F.try_divide(100.0 * n, F.count("*")), F.lit(0.0))
    null = F.coalesce(F.max(F.col(group).isNull().cast("long")), F.lit(0))
    return manifest.agg(
        F.count("*").alias("total"), kept.alias("kept"), (F.count("*") - kept).alias("dropped"), percent(kept).alias("keep_pct"),
        percent(F.count("*") - kept).alias("drop_pct"), F.count_if(F.coalesce(F.col("reason"), F.lit("")) != "").alias("defect"),
        (F.countDistinct(group) + null).alias("operators"),
    )


def reason_tally(manifest: DataFrame) -> DataFrame:
    """(reason, n), most frequent first."""
    counted = manifest.where("reason is not null and reason <> ''").groupBy("reason").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "reason")


def operator_list(manifest: DataFrame, group: str = "operator") -> DataFrame:
    return manifest.select(group).distinct().orderBy(group)


def flag_tally(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode(split_flags(F.col("flags"))).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: Column, lo: float, hi: float, bins: int) -> DataFrame:
    """(bin, n): bins 1 to ``bins``, 0 below and ``bins`` + 1 above; nulls left out."""
    return df.select(F.width_bucket(value, F.lit(lo), F.lit(hi), F.lit(bins)).cast("long").alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))


def matching(manifest: DataFrame, key: str, decision: str | None = None, reason: str | None = None, operator: str | None = None, search: str = "", group: str = "operator") -> DataFrame:
    """Rows that meet all given conditions; the reason 'none' is an empty or null one."""
    rows = manifest.where(F.lower(F.col(key).cast("string")).contains(search.strip().lower()))
    if decision:
        rows = rows.where(F.col("decision") == decision)
    if reason:
        rows = rows.where(F.coalesce(F.nullif("reason", F.lit("")), F.lit("none")) == reason)
    if operator is not None:
        rows = rows.where(F.col(group) == operator)
    return rows


def listing(rows: DataFrame, key: str, sort: str = "worst", cap: int = 300) -> DataFrame:
    """The list screen: matching rows by score, ``worst`` or ``best`` first, or by ``hash``; at most
    ``cap`` of them, which is what the screen shows."""
    orders = {"worst": [F.col("score").asc_nulls_last(), key], "best": [F.col("score").desc_nulls_last(), key], "hash": [key]}
    return rows.orderBy(*orders[sort]).limit(cap)


def overflow(rows: DataFrame, cap: int = 300) -> DataFrame:
    """One row: how many matching rows the screen doesn't show."""
    return rows.agg(F.greatest(F.count("*") - cap, F.lit(0)).alias("overflow"))


def current(manifest: DataFrame, shown: DataFrame, key: str, selected: str | None, sort: str = "worst") -> DataFrame:
    """The selected episode, or the first one that the screen shows where there is none such."""
    first = listing(shown, key, sort, 1).withColumn("__first", F.lit(1))
    if selected is None:
        return first.drop("__first")
    wanted = manifest.where(F.col(key).cast("string") == selected).limit(1).withColumn("__first", F.lit(0))
    return wanted.unionByName(first).orderBy("__first").limit(1).drop("__first")


def report(manifest: DataFrame, axes: list[str], hard: list[str], group: str = "operator", episodes: DataFrame | None = None, signs: dict[str, int] | None = None, floor: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every part of the scoring report as a table of its own; with the scored ``episodes`` and their
    features' ``signs`` the choice of features, with clusters those and whether they follow the group,
    with a null floor that."""
    parts = {
        "decisions": decisions(manifest), "reasons": reason_tally(manifest), "failed_axes": failed_axes(manifest, axes),
        "warnings": warnings(manifest, hard), "fairness": fairness(manifest, group), "spread": keep_rate_spread(manifest, group),
    }
    if episodes is not None:
        parts["features"] = eta_squared(episodes, list(signs or {}), group)
    if "cluster" in manifest.columns:
        clustered = manifest.where(F.col("cluster").isNotNull())
        parts["clusters"] = cluster_report(clustered, "cluster", group, (F.col("decision") == "drop") & ~F.col("hard"), "score")
        parts["nmi"] = normalised_mutual_information(clustered, "cluster", group)
    return parts | ({"floor": floor} if floor is not None else {})


def report_rows(parts: dict[str, DataFrame]) -> DataFrame:
    """(part, item, measure, value): the parts of ``report`` as one long table. A part's first column
    names its items, or ``all`` where it is one row of numbers."""
    long = []
    for name, part in parts.items():
        named = part.dtypes[0][1] == "string" or name in ("clusters", "fairness", "failed_axes", "floor")
        item = F.coalesce(F.col(part.columns[0]).cast("string"), F.lit("")) if named else F.lit("all")
        measures = [c for c, k in part.dtypes[int(named) :] if k in ("int", "bigint", "double", "boolean")]
        values = F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in measures))
        long.append(part.select(F.lit(name).alias("part"), item.alias("item"), F.explode(values).alias("m")).select("part", "item", "m.*"))
    return reduce(DataFrame.unionByName, long)
