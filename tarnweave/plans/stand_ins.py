"""Domain artefacts derived from the driver's tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnweave.operators.rules import act_span
from tarnweave.operators.scoring import AXES, SIGNS
from tarnweave.session import read_table

#: Stand-ins of the features in terms of a customer's orders, the same in both dialects: one that
#: isn't there at all (left_sparc), one all null, one constant, one that follows the operator.
FEATURES = {
    "right_sparc": "CAST(c_custkey * 37 % 101 AS DOUBLE) / 101",
    "head_sparc": "CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey * 41 % 103 AS DOUBLE) END",
    "right_jerk_rms": "sd_price",
    "left_jerk_rms": "CAST(c_custkey * 43 % 107 AS DOUBLE)",
    "head_jerk_rms": "CAST(c_custkey * 47 % 109 AS DOUBLE)",
    "right_idle_frac": "late_share",
    "left_idle_frac": "CAST(c_custkey * 53 % 113 AS DOUBLE) / 113",
    "head_idle_frac": "CAST(NULL AS DOUBLE)",
    "low_detail_frac": "CAST(c_custkey * 59 % 127 AS DOUBLE) / 127",
    "faint_frac": "CAST(n_orders AS DOUBLE)",
    "size_cv": "CAST(c_nationkey * 10 + c_custkey % 3 AS DOUBLE)",
    "right_straightness": "mean_price",
    "left_straightness": "CAST(5 AS DOUBLE)",
    "progress_dip": "CASE WHEN c_custkey % 3 <> 0 THEN abs(CAST(c_acctbal AS DOUBLE)) / 10000 END",
    "progress_final": "CAST(c_custkey * 61 % 131 AS DOUBLE) / 131",
    "act_start": "CAST(c_custkey * 7 % 100 AS DOUBLE) / 100",
    "act_end": "CAST(c_custkey * 13 % 150 AS DOUBLE) / 100",
    "n_frames": "c_custkey * 11 % 400",
    "declared": "CASE WHEN c_custkey % 5 <> 0 THEN c_custkey * 11 % 400 + CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END END",
}
_THERE = [f for f in SIGNS if f in FEATURES or f == "act_span"]


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode, frame_idx, bytes): a user's events in order of time."""
    e = read_table(spark, sf_dir, "events").select("user_id", "ts", "value")
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("ts")) - 1
    return e.select(F.col("user_id").alias("episode"), at.alias("frame_idx"), F.col("value").alias("bytes"))


FRAMES_SQL = "fr AS (SELECT user_id AS episode, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS frame_idx, value AS bytes FROM events)"


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer as an episode, their nation as the operator (every fiftieth has none), features
    of their orders; one day in ten is deleted."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus")
    spent = o.groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), F.avg("o_totalprice").alias("mean_price"),
        F.stddev_pop("o_totalprice").alias("sd_price"),
        F.avg((F.col("o_orderstatus") == "O").cast("double")).alias("late_share"),
    )
    made = [F.expr(e).alias(f) for f, e in FEATURES.items()]
    known = c.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("episode"), F.expr(_OPERATOR).alias("operator"), *made
    )
    return known.withColumn("act_span", act_span(F.col("act_start"), F.col("act_end")))


_OPERATOR = "CASE WHEN c_custkey % 50 <> 0 THEN c_nationkey END"
EPISODES_SQL = f"""sp AS (SELECT o_custkey, count(*) AS n_orders, avg(o_totalprice) AS mean_price, stddev_pop(o_totalprice) AS sd_price,
 avg(CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0 END) AS late_share FROM orders GROUP BY 1),
ep0 AS (SELECT c_custkey AS episode, {_OPERATOR} AS operator, {', '.join(f'{e} AS {f}' for f, e in FEATURES.items())}
 FROM customer LEFT JOIN sp ON c_custkey = o_custkey),
ep AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, act_end - act_start)) AS act_span FROM ep0)"""


def _z(c: str) -> str:
    return (
        f"CASE WHEN operator IS NOT NULL AND {c} IS NOT NULL THEN least(4.0::DOUBLE, greatest(-4.0::DOUBLE, ({c}::DOUBLE - median({c}::DOUBLE) OVER w)"
        f" / coalesce(nullif(stddev_samp({c}::DOUBLE) OVER w, 0), 1))) END"
    )


def _mean(parts: dict[str, int]) -> str:
    total = " + ".join(f"coalesce({s} * z_{f}, 0)" for f, s in parts.items())
    n = " + ".join(f"(z_{f} IS NOT NULL)::INT" for f in parts)
    return f"({total}) / nullif({n}, 0)"


def _eta(f: str) -> str:
    return (
        f"(SELECT CASE WHEN var_samp(x) > 0 THEN coalesce(1 - var_samp(r) / var_samp(x), 1) ELSE 1 END FROM (SELECT {f}::DOUBLE AS x,"
        f" CASE WHEN operator IS NOT NULL THEN {f}::DOUBLE - avg({f}::DOUBLE) OVER (PARTITION BY operator) END AS r FROM ep))"
    )


_FEATURES = sorted({f for p in AXES.values() for f in p if f in _THERE})
_AXES = {a: {f: s for f, s in p.items() if f in _THERE} for a, p in AXES.items()}
AXES_SQL = (
    f"{EPISODES_SQL}, zs AS (SELECT *, {', '.join(f'{_z(f)} AS z_{f}' for f in _FEATURES)} FROM ep WINDOW w AS (PARTITION BY operator)),"
    f" ax AS (SELECT *, {', '.join(f'{_mean(p)} AS ax_{a}' for a, p in _AXES.items())} FROM zs)"
)
ETA_SQL = "et AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {_eta(f)} AS eta2, (SELECT count({f}) FROM ep) AS known" for f in _THERE) + ")"
_FILL = ", ".join(f"coalesce({f}::DOUBLE, (SELECT median({f}::DOUBLE) FROM ep)) AS {f}" for f in _THERE)
_GATED = ", ".join(f"CASE WHEN (SELECT known > 0 AND eta2 <= 0.35 FROM et WHERE feature = '{f}') THEN {_z(f)} END AS z_{f}" for f in _THERE)
SCORE_SQL = (
    f"{ETA_SQL}, filled AS (SELECT episode, operator, {_FILL} FROM ep), sz AS (SELECT episode, {_GATED}"
    f" FROM filled WINDOW w AS (PARTITION BY operator)), sc AS (SELECT episode, {_mean({f: SIGNS[f] for f in _THERE})} AS score FROM sz)"
)
REASON_SQL = (
    "CASE WHEN n_frames < 60 THEN 'too_short' WHEN declared > 0 AND (n_frames IS NULL OR n_frames <> declared) THEN 'frame_count_mismatch'"
    " WHEN progress_dip IS NOT NULL AND progress_dip < 0.02 THEN 'no_visible_change' WHEN act_span < 0.35 THEN 'mostly_dead_time' ELSE '' END"
)
FLAG_SQL = " || ".join(f"CASE WHEN ax_{a} > 1 THEN '{a}+' ELSE '' END" for a in AXES)
_WORST = ", ".join(f"CASE WHEN ax_{a} > 1 THEN {{'z': -ax_{a}, 'k': {k}, 'n': '{a}'}} END" for k, a in enumerate(AXES))
LABEL_SQL = (
    f"coalesce(nullif(array_to_string(list_transform(list_sort(list_filter([{_WORST}], lambda x: x IS NOT NULL))[1:2], lambda x: x.n), '+'), ''), 'below_average')"
)
def outlier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode, cluster, p): findings of an outlier test that isn't run here, for some episodes."""
    c = read_table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0")
    return c.select(F.col("c_custkey").alias("episode"), (F.col("c_custkey") % 3).cast("int").alias("cluster"), F.expr(_FOUND_P).alias("p"))


_FOUND_P = "CASE WHEN c_custkey % 9 = 1 THEN CAST(1 AS DOUBLE) / (c_custkey * 1000) ELSE CAST(c_custkey * 67 % 137 AS DOUBLE) / 137 END"


def manifest_sql(tested: bool) -> str:
    """``mf``: the manifest, with or without the outlier findings above at a level of 0.1."""
    strange = f"{REASON_SQL} = '' AND coalesce(o.p <= (SELECT cut FROM oc), false)"
    found = (
        f" op AS (SELECT c_custkey AS episode, c_custkey % 3 AS cluster, {_FOUND_P} AS p FROM customer WHERE c_custkey % 4 <> 0),"
        " oc AS (SELECT max(p) AS cut FROM (SELECT p, row_number() OVER (ORDER BY p) AS r, count(*) OVER () AS n FROM op) WHERE p <= 0.1::DOUBLE * r / n),"
    )
    return (
        f"{AXES_SQL}, {SCORE_SQL},{found} mf AS (SELECT ax.episode, operator,"
        f" CASE WHEN {REASON_SQL} <> '' OR ({strange if tested else 'false'}) THEN 'drop' ELSE 'keep' END AS decision, score,"
        f" CASE WHEN {strange if tested else 'false'} THEN {LABEL_SQL} ELSE {REASON_SQL} END AS reason, {REASON_SQL} <> '' AS hard,"
        f" rtrim({FLAG_SQL}, '+') AS flags, act_start, act_end, n_frames, act_span, progress_dip, {'o.cluster, o.p' if tested else 'NULL::INT AS cluster, NULL::DOUBLE AS p'},"
        f" {', '.join(f'ax_{a}' for a in AXES)} FROM ax JOIN sc ON ax.episode = sc.episode LEFT JOIN op o ON o.episode = ax.episode)"
    )


MANIFEST_SQL, TESTED_SQL = manifest_sql(False), manifest_sql(True)
