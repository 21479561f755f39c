"""Queries over the driver's tables, one for each operator, each with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnweave.functions import scalars as S
from tarnweave.operators import ablation, catalog, geometry, ranking, reports, rules, scoring, series, statistics
from tarnweave.plans import fixtures, scans
from tarnweave.plans import manifest as plan
from tarnweave.plans import stand_ins as I
from tarnweave.session import read_table, stash
from tarnweave.sources import arrays, files, shards, tables
from tarnweave.streaming.events import windowed_counts

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _FOUND[f.__name__] = (f, sql)
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*((F.round(c, digits) + 0.0).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes))


def _sql_round(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0 AS {n}" for n in names)


def _episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in episodes, stored: several passes read them."""
    return stash(I.episodes(spark, sf_dir))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.build_manifest(I.episodes(spark, sf_dir))


_QUALITY = """st AS (SELECT episode, frame_idx, bytes, median(bytes) OVER w AS mid, coalesce(nullif(stddev_pop(bytes) OVER w, 0), 1) AS dev FROM fr WINDOW w AS (PARTITION BY episode)),
z AS (SELECT *, (bytes - mid) / dev AS z, bytes - lag(bytes) OVER (PARTITION BY episode ORDER BY frame_idx) AS step FROM st),
isl AS (SELECT *, sum(CASE WHEN z < -1 THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY frame_idx) AS isl FROM z),
rn AS (SELECT episode, max(c) AS longest_faint_run FROM (SELECT episode, isl, count(*) FILTER (z < -1) AS c FROM isl GROUP BY 1, 2) GROUP BY 1)"""


@query(f"""WITH {I.FRAMES_SQL}, {_QUALITY}
SELECT z.episode, count(*) AS n_frames, round(avg((z < -2)::INT), 6) AS low_detail_frac, round(avg((z < -1)::INT), 6) AS faint_frac,
 max(longest_faint_run)::BIGINT AS longest_faint_run, round(first(dev) / avg(bytes), 6) AS size_cv, round(min(z), 6) AS min_z,
 round(coalesce(min(step), 0) / first(dev), 6) AS max_step_drop, round(first(mid), 6) AS median_bytes
FROM z JOIN rn ON z.episode = rn.episode GROUP BY z.episode""")
def frame_quality(spark, sf_dir):
    return rounded(series.frame_quality(I.frames(spark, sf_dir)))


@query(f"""WITH {I.FRAMES_SQL}, {_QUALITY} SELECT episode, longest_faint_run::BIGINT AS longest_faint_run FROM rn""")
def longest_faint_run(spark, sf_dir):
    return series.frame_quality(I.frames(spark, sf_dir)).select("episode", "longest_faint_run")


@query(f"WITH {I.EPISODES_SQL} SELECT episode, round({I._z('right_straightness')}, 6) AS z FROM ep WINDOW w AS (PARTITION BY operator)")
def robust_z(spark, sf_dir):
    return rounded(scoring.with_robust_z(_episodes(spark, sf_dir), {"z": F.col("right_straightness")}, "operator").select("episode", "z"))


@query(f"WITH {I.AXES_SQL} SELECT episode, {_sql_round(*(f'ax_{a}' for a in I.AXES))} FROM ax")
def axis_scores(spark, sf_dir):
    return rounded(scoring.axis_scores(_episodes(spark, sf_dir), "operator", I.AXES).select("episode", *(f"ax_{a}" for a in I.AXES)))


@query(f"WITH {I.EPISODES_SQL}, {I.ETA_SQL} SELECT feature, round(eta2, 6) AS eta2, CASE WHEN eta2 <= 0.35 THEN 'USE' ELSE 'DROP' END AS usage FROM et WHERE known > 0")
def eta_squared(spark, sf_dir):
    return rounded(scoring.eta_squared(_episodes(spark, sf_dir), list(I.SIGNS), "operator").orderBy("eta2", "feature"))


@query(f"WITH {I.EPISODES_SQL}, {I.SCORE_SQL} SELECT episode, round(score, 6) AS score FROM sc")
def composite_score(spark, sf_dir):
    return rounded(scoring.composite_score(_episodes(spark, sf_dir), I.SIGNS, "operator").select("episode", "score"))


@query(f"WITH {I.EPISODES_SQL} SELECT episode, {I.REASON_SQL} AS reason FROM ep")
def integrity_rules(spark, sf_dir):
    dip = F.col("progress_dip")
    return I.episodes(spark, sf_dir).select(
        "episode", rules.integrity_reason(F.col("n_frames"), F.col("declared"), dip.isNotNull(), dip, F.col("act_span")).alias("reason")
    )


@query(f"WITH {I.AXES_SQL} SELECT episode, {I.LABEL_SQL} AS label FROM ax")
def failure_label(spark, sf_dir):
    names = [f"ax_{a}" for a in I.AXES]
    return scoring.axis_scores(_episodes(spark, sf_dir), "operator", I.AXES).select("episode", rules.failure_label(names).alias("label"))


def _tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = statistics.benjamini_hochberg(I.outlier_rows(spark, sf_dir), "p", "episode", 0.1).withColumnRenamed("flagged", "outlier")
    return plan.build_manifest(I.episodes(spark, sf_dir), outliers=found)


@query(f"""WITH {I.TESTED_SQL} SELECT episode, operator, decision, round(score, 6) AS score, reason, flags, CASE WHEN decision <> 'drop' THEN round_even(act_start * (n_frames - 1), 0)::BIGINT END AS trim_start,
 CASE WHEN decision <> 'drop' THEN round_even(act_end * (n_frames - 1), 0)::BIGINT END AS trim_end, n_frames, round(act_span, 6) AS act_span, round(progress_dip, 6) AS progress_dip, cluster, round(p, 6) AS outlier_p, hard,
 {_sql_round(*(f'ax_{a}' for a in I.AXES))} FROM mf""")
def manifest_with_outliers(spark, sf_dir):
    return rounded(_tested(spark, sf_dir))


@query(f"""WITH {I.MANIFEST_SQL} SELECT episode, flags, CASE WHEN decision <> 'drop' THEN round_even(act_start * (n_frames - 1), 0)::BIGINT END AS trim_start,
 CASE WHEN decision <> 'drop' THEN round_even(act_end * (n_frames - 1), 0)::BIGINT END AS trim_end FROM mf""")
def flags_and_trim(spark, sf_dir):
    return _manifest(spark, sf_dir).select("episode", "flags", "trim_start", "trim_end")


@query(f"""WITH {I.MANIFEST_SQL} SELECT row_number() OVER (ORDER BY decision, score DESC NULLS LAST, episode) AS at_row, episode, operator, decision, round(score, 6) AS score, reason, flags FROM mf""")
def manifest_sorted(spark, sf_dir):
    order = [F.col("decision"), F.desc_nulls_last("score"), F.col("episode")]
    placed = ranking.running(_manifest(spark, sf_dir), order, "at_row")
    return rounded(placed.select("at_row", "episode", "operator", "decision", "score", "reason", "flags"))


@query("SELECT doc_id, source, lang FROM documents WHERE source = 'src1' AND lang = 'en' AND trim(coalesce(text, '')) <> '' AND doc_id % 3 <> 0")
def catalog_slice(spark, sf_dir):
    gone = F.when(F.col("doc_id") % 3 == 0, True).when(F.col("doc_id") % 3 == 1, False)  # null where unknown: not deleted
    d = read_table(spark, sf_dir, "documents").withColumn("is_deleted", gone)
    return catalog.live_slice(d, F.col("source") == "src1", F.col("lang") == "en", "text", "is_deleted").select("doc_id", "source", "lang")


@query("SELECT doc_id FROM documents WHERE source = 'src1' AND lang = 'en' AND trim(coalesce(text, '')) <> ''")
def catalog_slice_without_deletions(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return catalog.live_slice(d, F.col("source") == "src1", F.col("lang") == "en", "text", "is_deleted").select("doc_id")


@query("""WITH o AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS pos, greatest(1, count(*) OVER () // 24) AS k FROM documents)
SELECT doc_id, n_chars FROM o WHERE pos % k = 0 AND pos < k * 24""")
def stratified_sample(spark, sf_dir):
    return catalog.stratified_sample(read_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id", 24)


@query("""SELECT 'lang' AS "column", count(*) FILTER (lang IS NULL OR trim(lang) = '') AS blanks FROM documents UNION ALL SELECT 'source', count(*) FILTER (source IS NULL OR trim(source) = '') FROM documents
 UNION ALL SELECT 'text', count(*) FILTER (text IS NULL OR trim(text) = '') FROM documents""")
def catalog_profile(spark, sf_dir):
    return catalog.profile(read_table(spark, sf_dir, "documents"), ["lang", "source", "text"])


@query("""SELECT count(x) AS n, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min, round(quantile_cont(x, 0.25), 6) AS p25,
 round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max FROM (SELECT n_chars::DOUBLE AS x FROM documents)""")
def numeric_describe(spark, sf_dir):
    return rounded(catalog.describe(read_table(spark, sf_dir, "documents"), "n_chars"))


@query("SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def value_counts_topn(spark, sf_dir):
    return catalog.value_counts(read_table(spark, sf_dir, "events"), "event_type", 3)


@query("SELECT source, count(*) FILTER (lang = 'en') AS lang_en, count(*) FILTER (lang = 'de') AS lang_de FROM documents GROUP BY 1")
def crosstab_decision(spark, sf_dir):
    return catalog.crosstab(read_table(spark, sf_dir, "documents"), "source", "lang", ["en", "de"])


@query(f"""WITH {I.MANIFEST_SQL} SELECT operator, count(*) AS n, round(avg((decision = 'keep')::INT), 6) AS keep_rate, round(avg(hard::INT), 6) AS hard_rate FROM mf WHERE operator IS NOT NULL GROUP BY 1""")
def operator_fairness(spark, sf_dir):
    return rounded(reports.fairness(_manifest(spark, sf_dir), "operator"))


@query("""WITH d AS (SELECT label, vec_id % 7 AS operator, (vec_id % 5 = 0) AS o, vec_id::DOUBLE AS s FROM embeddings), p AS (SELECT label, operator, count(*) AS c, count(*) FILTER (o) AS oc, sum(s) AS s FROM d GROUP BY 1, 2)
SELECT label, sum(c)::BIGINT AS n, sum(oc)::BIGINT AS outliers, round(max(c)::DOUBLE / sum(c), 6) AS top_share, round(sum(s) / sum(c), 6) AS mean_score FROM p GROUP BY 1""")
def cluster_report(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("vec_id") % 7).alias("operator"), F.col("vec_id").cast("double").alias("score"))
    return rounded(reports.cluster_report(e, "label", "operator", F.col("vec_id") % 5 == 0, "score"))


@query(f"""WITH {I.TESTED_SQL} SELECT count(*) AS total, count(*) FILTER (decision = 'keep') AS kept, count(*) FILTER (decision <> 'keep') AS dropped,
 round(100.0 * count(*) FILTER (decision = 'keep') / count(*), 6)::DOUBLE AS keep_pct, round(100.0 * count(*) FILTER (decision <> 'keep') / count(*), 6)::DOUBLE AS drop_pct,
 count(*) FILTER (reason <> '') AS defect, count(DISTINCT operator) + max((operator IS NULL)::BIGINT) AS operators FROM mf""")
def ui_summary(spark, sf_dir):
    return rounded(reports.summary(_tested(spark, sf_dir), "operator"))


@query(f"WITH {I.MANIFEST_SQL} SELECT reason, count(*) AS n FROM mf WHERE reason <> '' GROUP BY 1")
def ui_reasons(spark, sf_dir):
    return reports.reason_tally(_manifest(spark, sf_dir))


def _shown(spark: SparkSession, sf_dir: str, operator: str | None = None) -> DataFrame:
    return reports.matching(_manifest(spark, sf_dir), "episode", decision="keep", reason="none", search=" 1 ", operator=operator)


@query(f"""WITH {I.MANIFEST_SQL} SELECT episode, operator, round(score, 6) AS score FROM mf WHERE decision = 'keep' AND lower(episode::VARCHAR) LIKE '%1%' ORDER BY mf.score ASC NULLS LAST, mf.episode LIMIT 300""")
def ui_filter_sort_cap(spark, sf_dir):
    return rounded(reports.listing(_shown(spark, sf_dir), "episode").select("episode", "operator", "score"))


@query(f"""WITH {I.MANIFEST_SQL}, h AS (SELECT episode, operator FROM mf WHERE decision = 'keep' AND episode::VARCHAR LIKE '%1%' AND operator = 7)
(SELECT 'hash' AS sort, * FROM h ORDER BY episode LIMIT 5) UNION ALL (SELECT 'best', mf.episode, mf.operator FROM h JOIN mf USING (episode) ORDER BY score DESC NULLS LAST, mf.episode LIMIT 5)""")
def ui_operator_orders(spark, sf_dir):
    rows = _shown(spark, sf_dir, "7")
    shown = [reports.listing(rows, "episode", sort, 5).select(F.lit(sort).alias("sort"), "episode", "operator") for sort in ("hash", "best")]
    return shown[0].unionByName(shown[1])


@query(f"WITH {I.MANIFEST_SQL} SELECT greatest(count(*) - 20, 0) AS overflow FROM mf WHERE decision = 'keep' AND episode::VARCHAR LIKE '%1%'")
def ui_overflow(spark, sf_dir):
    return reports.overflow(_shown(spark, sf_dir), 20)


@query(f"""WITH {I.MANIFEST_SQL}, s AS (SELECT episode FROM mf WHERE decision = 'keep' AND episode::VARCHAR LIKE '%1%' ORDER BY score ASC NULLS LAST, episode LIMIT 1)
SELECT 'known' AS asked, 17::BIGINT AS episode UNION ALL SELECT 'unknown', episode FROM s UNION ALL SELECT 'none', episode FROM s""")
def ui_current(spark, sf_dir):
    rows, shown = _manifest(spark, sf_dir), _shown(spark, sf_dir)
    asked = {"known": "17", "unknown": "-1", "none": None}
    every = [reports.current(rows, shown, "episode", k).select(F.lit(n).alias("asked"), "episode") for n, k in asked.items()]
    return reduce(DataFrame.unionByName, every)


@query(f"WITH {I.MANIFEST_SQL} SELECT DISTINCT operator FROM mf")
def operator_list(spark, sf_dir):
    return reports.operator_list(_manifest(spark, sf_dir))


@query(f"WITH {I.MANIFEST_SQL}, f AS (SELECT unnest(string_split(flags, '+')) AS flag FROM mf) SELECT flag, count(*) AS n FROM f WHERE flag <> '' GROUP BY 1")
def flag_counts(spark, sf_dir):
    return reports.flag_tally(_manifest(spark, sf_dir))


@query(f"""WITH {I.MANIFEST_SQL} SELECT CASE WHEN score < -4 THEN 0 WHEN score >= 4 THEN 17 ELSE floor((score + 4) * 2)::BIGINT + 1 END AS bin, count(*) AS n FROM mf WHERE score IS NOT NULL GROUP BY 1""")
def score_histogram(spark, sf_dir):
    return reports.histogram(_manifest(spark, sf_dir), F.col("score"), -4, 4, 16)


@query("""WITH l AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY doc_id ORDER BY quality, toxic) AS r FROM labels)
SELECT d.doc_id, l.quality FROM documents d LEFT JOIN (SELECT * FROM l WHERE r = 1) l ON d.doc_id = l.doc_id""")
def join_dedup_left(spark, sf_dir):
    first = catalog.first_of_each(read_table(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")
    return read_table(spark, sf_dir, "documents").select("doc_id").join(first.select("doc_id", "quality"), "doc_id", "left")


@query("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS has_clip FROM documents")
def semi_has_clip(spark, sf_dir):
    return catalog.with_membership(read_table(spark, sf_dir, "documents").select("doc_id"), read_table(spark, sf_dir, "labels"), "doc_id", "has_clip")


@query("""WITH h AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS pos FROM events GROUP BY 1)
SELECT event_id, event_type FROM events WHERE event_type NOT IN (SELECT event_type FROM h WHERE pos % 3 = 0 AND pos < 18)""")
def anti_heldout(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    return e.join(ablation.heldout_operators(e, "event_type"), "event_type", "left_anti").select("event_id", "event_type")


@query("SELECT d.doc_id, d.source, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def join_overlap_drop(spark, sf_dir):
    right = read_table(spark, sf_dir, "labels").withColumn("source", F.lit("other"))
    left = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return catalog.join_dropping_overlap(left, right, "doc_id")


def _poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    x = lambda i: F.col("embedding")[i].cast("double")
    size = F.sqrt(sum(x(i) * x(i) for i in range(3, 7)))
    return e.select(
        F.floor(F.col("vec_id") / 10).alias("episode"), (F.col("vec_id") % 10).alias("frame_idx"), x(0).alias("x"), x(1).alias("y"),
        x(2).alias("z"), F.array(*(x(i) / size for i in range(3, 7))).alias("q"), F.lit(1 / 30).alias("dt"),
    )


_E = [f"embedding[{i}]::DOUBLE" for i in range(1, 8)]
_SIZE = f"sqrt({' + '.join(f'{e} * {e}' for e in _E[3:])})"
_POSES = f"""po AS (SELECT vec_id // 10 AS episode, vec_id % 10 AS t, {_E[0]} AS x, {_E[1]} AS y, {_E[2]} AS z, [{', '.join(f'{e} / {_SIZE}' for e in _E[3:])}] AS q FROM embeddings),
s1 AS (SELECT *, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2 + (z - lag(z) OVER w) ** 2) AS step, 2 * acos(least(1, abs(list_inner_product(q, lag(q) OVER w)))) AS angle FROM po WINDOW w AS (PARTITION BY episode ORDER BY t)),
s2 AS (SELECT *, step * 30 AS speed, (step * 30 - lag(step * 30) OVER w) * 30 AS accel FROM s1 WINDOW w AS (PARTITION BY episode ORDER BY t)),
s3 AS (SELECT *, (accel - lag(accel) OVER w) * 30 AS jerk FROM s2 WINDOW w AS (PARTITION BY episode ORDER BY t)),
s4 AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY t) - 1 AS pos, speed > 0.15 * max(speed) OVER (PARTITION BY episode) AS active FROM s3 WHERE step IS NOT NULL),
en AS (SELECT episode, sqrt((last(x ORDER BY t) - first(x ORDER BY t)) ** 2 + (last(y ORDER BY t) - first(y ORDER BY t)) ** 2 + (last(z ORDER BY t) - first(z ORDER BY t)) ** 2) AS net_disp FROM po GROUP BY 1)"""


@query(f"""WITH {_POSES} SELECT s4.episode, round(sum(step), 6) AS path_len, round(max(speed), 6) AS speed_max, round(avg(speed), 6) AS speed_mean, round(coalesce(sqrt(avg(jerk * jerk)), 0), 4) AS jerk_rms,
 round(avg((speed < 0.01)::INT), 6) AS idle_frac, round(sum(angle), 6) AS ang_path, round(coalesce(min(pos) FILTER (active) / count(*), 0), 6) AS act_start, round(coalesce(max(pos) FILTER (active) / count(*), 1), 6) AS act_end,
 round(max(net_disp), 6) AS net_disp, round(coalesce(max(net_disp) / nullif(sum(step), 0), 0), 6) AS straightness FROM s4 JOIN en ON s4.episode = en.episode GROUP BY s4.episode""")
def motion_features(spark, sf_dir):
    return rounded(series.motion_features(_poses(spark, sf_dir), ["episode"]).withColumn("jerk_rms", F.round("jerk_rms", 4)))


@query(f"""WITH {_POSES} SELECT episode, round(coalesce(min(pos) FILTER (active) / count(*), 0), 6) AS act_start, round(coalesce(max(pos) FILTER (active) / count(*), 1), 6) AS act_end FROM s4 GROUP BY 1""")
def active_span(spark, sf_dir):
    return rounded(series.motion_features(_poses(spark, sf_dir), ["episode"]).select("episode", "act_start", "act_end"))


_POINTS = ", ".join("{'x': embedding[%d]::DOUBLE, 'y': embedding[%d]::DOUBLE, 'z': embedding[%d]::DOUBLE}" % (3 * i + 1, 3 * i + 2, 3 * i + 3) for i in range(21))
_SPAN = " + ".join(f"(list_max(list_transform(p, lambda k: k.{c})) - list_min(list_transform(p, lambda k: k.{c}))) ** 2" for c in "xyz")


@query(f"""WITH p AS (SELECT vec_id // 10 AS episode, [{_POINTS}] AS p FROM embeddings), s AS (SELECT episode, sqrt({_SPAN}) AS s FROM p)
SELECT episode, round(avg(s), 6) AS hand_span_mean, round(coalesce(stddev_pop(s) / nullif(avg(s), 0), 0), 6) AS hand_span_cv FROM s GROUP BY 1""")
def hand_span(spark, sf_dir):
    x = lambda i: F.col("embedding")[i].cast("double")
    points = F.array(*(F.struct(x(3 * i).alias("x"), x(3 * i + 1).alias("y"), x(3 * i + 2).alias("z")) for i in range(21)))
    e = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 10).alias("episode"), points.alias("points"))
    return rounded(series.hand_span(e, "episode"))


@query("""WITH s AS (SELECT user_id AS episode, ts, CASE WHEN event_id % 10 <> 0 THEN epoch_us(ts) * 1000 END AS ns FROM events),
a AS (SELECT episode, count(ns) AS k, count(*) AS n, (max(ns) - min(ns)) / 1e9::DOUBLE AS sec FROM s GROUP BY 1), r AS (SELECT episode, n, CASE WHEN k > 1 AND sec > 0 THEN k / sec ELSE 30.0::DOUBLE END AS f FROM a)
SELECT episode, 30.0::DOUBLE AS fps_attr, round(f, 12) AS fps_true, round(n / f, 3) AS duration_s FROM r""")
def true_fps(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("episode"), "ts", F.when(F.col("event_id") % 10 != 0, F.unix_micros(F.col("ts").cast("timestamp")) * 1000).otherwise(0).alias("ns")
    )
    rate = series.true_rate(e, "episode", "ts", "ns")
    return rate.select("episode", "fps_attr", F.round("fps_true", 12).alias("fps_true"), F.round("duration_s", 3).alias("duration_s"))


def _similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 10).alias("episode"), (F.col("vec_id") % 10).alias("t"), F.col("embedding").alias("emb"))
    return series.frame_similarity(e, "episode")


_SIMS = """v AS (SELECT vec_id // 10 AS episode, vec_id % 10 AS t, embedding::DOUBLE[] AS e FROM embeddings), u AS (SELECT episode, t, e, list_transform(e, lambda x: x / greatest(sqrt(list_inner_product(e, e)), 1e-8)) AS u FROM v),
l AS (SELECT *, last(u) OVER w AS lu, lead(u) OVER (PARTITION BY episode ORDER BY t) AS nu FROM u WINDOW w AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
ss AS (SELECT episode, list(list_inner_product(u, lu) ORDER BY t) AS sims, list(list_distance(u, nu) ORDER BY t) FILTER (nu IS NOT NULL) AS steps FROM l GROUP BY 1)"""


@query(f"WITH {_SIMS} SELECT episode, round(sims[1] - list_min(sims), 6) AS progress_dip, round(CASE WHEN len(sims) > 1 THEN sims[-2] END, 6) AS progress_final FROM ss")
def progress_features(spark, sf_dir):
    return rounded(series.progress(_similarity(spark, sf_dir), "episode"))


@query(f"WITH {_SIMS}, d AS (SELECT episode, list_concat(sims, coalesce(steps, [])) AS d FROM ss) SELECT episode, unnest(range(len(d)))::BIGINT AS i, round(unnest(d), 6) AS value FROM d")
def shape_descriptor(spark, sf_dir):
    both = _similarity(spark, sf_dir).select("episode", F.posexplode(F.concat("sims", "steps")).alias("i", "value"))
    return rounded(both.withColumn("i", F.col("i").cast("long")))


@query("""WITH x AS (SELECT vec_id // 10 AS episode, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS e FROM embeddings), m AS (SELECT episode, i, avg(e) AS m FROM x GROUP BY 1, 2)
SELECT episode, i::BIGINT AS i, round(m / greatest(sqrt(sum(m * m) OVER (PARTITION BY episode)), 1e-8), 6) AS value FROM m""")
def raw_descriptor(spark, sf_dir):
    raw = _similarity(spark, sf_dir).select("episode", F.posexplode("raw").alias("i", "value"))
    return rounded(raw.withColumn("i", F.col("i").cast("long")))


_MOVES = "CASE WHEN episode % 10 = 0 THEN 0 ELSE abs(bytes) END::DOUBLE AS speed"


@query(f"""WITH {I.FRAMES_SQL}, f AS (SELECT episode, frame_idx, {_MOVES}, count(*) OVER (PARTITION BY episode) AS n FROM fr),
sp AS (SELECT episode, max(n) // 10 AS lo, CASE WHEN episode % 13 = 0 THEN max(n) // 10 ELSE max(n) - max(n) // 10 END AS hi FROM f GROUP BY 1),
s AS (SELECT f.episode, frame_idx AS pos, lo, hi, CASE WHEN frame_idx >= lo AND frame_idx < hi THEN speed ELSE 0 END AS w FROM f JOIN sp ON f.episode = sp.episode WHERE f.episode % 11 <> 0 OR frame_idx < 3),
c AS (SELECT episode, pos, count(*) OVER e AS n, sum(w) OVER e AS total, sum(w) OVER (PARTITION BY episode ORDER BY pos) AS upto FROM s WINDOW e AS (PARTITION BY episode)),
m AS (SELECT episode, pos, upto / total AS share FROM c WHERE n >= 4 AND total > 0),
t AS (SELECT unnest(range(32)) AS k), p AS (SELECT episode, min(pos) AS frame FROM m, t WHERE share >= (k + 0.5::DOUBLE) / 32 GROUP BY episode, k)
SELECT DISTINCT episode, frame FROM p UNION ALL SELECT DISTINCT episode, CASE WHEN k = 31 THEN greatest(hi, lo + 1) ELSE trunc(lo + k * ((greatest(hi, lo + 1) - lo) / 31.0::DOUBLE))::BIGINT END FROM sp, t WHERE episode NOT IN (SELECT episode FROM m)""")
def equal_motion_frames(spark, sf_dir):
    f = I.frames(spark, sf_dir).withColumn("speed", F.when(F.col("episode") % 10 == 0, 0.0).otherwise(F.abs("bytes")))
    tenth = F.floor(F.count("*") / 10)
    end = F.when(F.col("episode") % 13 == 0, tenth).otherwise(F.count("*") - tenth)
    spans = f.groupBy("episode").agg(tenth.alias("lo"), end.alias("hi"))
    known = f.where("episode % 11 <> 0 or frame_idx < 3")
    return series.equal_motion_frames(spans, known, "episode", "frame_idx", "speed", slack=0.0)  # the SQL compares as is


_K = [[500.0, 0.0, 320.0, 0.0], [0.0, 500.0, 240.0, 0.0], [0.0, 0.0, 1.0, 0.0]]


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    x = lambda i: F.col("embedding")[i].cast("double")
    u, v, depth = geometry.project([x(0), x(1), x(2) + 1], [F.lit(0.1), F.lit(0.0), F.lit(0.0)], [F.lit(40 / 41), F.lit(0.0), F.lit(9 / 41), F.lit(0.0)], _K)
    return e.select((F.col("vec_id") % 50).alias("episode"), "vec_id", u.alias("u"), v.alias("v"), depth.alias("depth"))


_SEEN = f"""w AS (SELECT vec_id, {_E[0]} - 0.1::DOUBLE AS dx, {_E[1]} AS dy, {_E[2]} + 1 AS dz FROM embeddings),
c AS (SELECT vec_id, (1 - 162 / 1681.0::DOUBLE) * dx - 720 / 1681.0::DOUBLE * dz AS cx, dy AS cy, 720 / 1681.0::DOUBLE * dx + (1 - 162 / 1681.0::DOUBLE) * dz AS cz FROM w),
pr AS (SELECT vec_id % 50 AS episode, vec_id, (500 * cx + 320 * cz) / nullif(cz, 0) AS u, (500 * cy + 240 * cz) / nullif(cz, 0) AS v, cz AS depth FROM c)"""


@query(f"WITH {_SEEN} SELECT vec_id, round(u, 4) AS u, round(v, 4) AS v, round(depth, 6) AS depth FROM pr")
def project_points(spark, sf_dir):
    return _seen(spark, sf_dir).select("vec_id", F.round("u", 4).alias("u"), F.round("v", 4).alias("v"), F.round("depth", 6).alias("depth"))


@query(f"""WITH {_SEEN}, s AS (SELECT episode, avg(u) AS mu, avg(v) AS mv, greatest(max(u) - min(u), max(v) - min(v)) AS reach FROM pr WHERE depth > 0.01 AND u > -640 AND u < 1280 GROUP BY 1 HAVING count(*) >= 4),
d AS (SELECT *, least(greatest(reach * 1.8::DOUBLE, 96), 480) AS d FROM s), b AS (SELECT episode, d, least(greatest(mu - d / 2, 0), 640 - d) AS x, least(greatest(mv - d / 2, 0), 480 - d) AS y FROM d)
SELECT episode, trunc(x)::BIGINT AS "left", trunc(y)::BIGINT AS top, trunc(x + d)::BIGINT AS "right", trunc(y + d)::BIGINT AS bottom FROM b""")
def hand_box(spark, sf_dir):
    return geometry.hand_box(_seen(spark, sf_dir), "episode", 640, 480)


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.history_windows(I.frames(spark, sf_dir), "episode", "frame_idx", ["bytes"], 3, 15)


_WINDOWS = f"""{I.FRAMES_SQL}, hw AS (SELECT episode, frame_idx - 2 AS start, lag(bytes, 2) OVER w AS o0_bytes, lag(bytes, 1) OVER w AS o1_bytes, bytes AS o2_bytes, lead(bytes, 15) OVER w - bytes AS a_bytes,
 count(*) OVER (PARTITION BY episode) AS n FROM fr WINDOW w AS (PARTITION BY episode ORDER BY frame_idx)), hk AS (SELECT * FROM hw WHERE start >= 0 AND start < n - 18)"""


@query(f"WITH {_WINDOWS} SELECT episode, start, {_sql_round('o0_bytes', 'o1_bytes', 'o2_bytes', 'a_bytes')} FROM hk")
def history_window(spark, sf_dir):
    return rounded(_windows(spark, sf_dir).withColumn("start", F.col("start").cast("long")))


_X = ["1.0::DOUBLE", "o0_bytes", "o1_bytes", "o2_bytes"]
_GRAM = ", ".join(f"round(sum({_X[i]} * {_X[j]}), 2) AS g_{i}_{j}" for i in range(4) for j in range(i, 4))
_CROSS = ", ".join(f"round(sum({_X[i]} * a_bytes), 2) AS h_{i}_0" for i in range(4))


@query(f"WITH {_WINDOWS} SELECT episode, count(*) AS n, {_GRAM}, {_CROSS}, round(sum(a_bytes * a_bytes), 2) AS s_0 FROM hk GROUP BY 1")
def ridge_gram(spark, sf_dir):
    return rounded(ablation.gram(_windows(spark, sf_dir), "episode", ["o0_bytes", "o1_bytes", "o2_bytes"], ["a_bytes"]), 2)


@query(f"""WITH {I.EPISODES_SQL}, {I.SCORE_SQL}, r AS (SELECT episode, row_number() OVER (ORDER BY score DESC NULLS LAST, episode) AS pos, count(*) OVER () AS n FROM sc) SELECT episode FROM r WHERE pos <= greatest(floor(n * 0.3::DOUBLE), 20)""")
def top_fraction(spark, sf_dir):
    scored = scoring.composite_score(_episodes(spark, sf_dir), I.SIGNS, "operator").select("episode", "score")
    return ablation.top_fraction(scored, "score", "episode", 0.3).select("episode")


@query("""WITH h AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS pos FROM documents WHERE source IS NOT NULL GROUP BY 1) SELECT source FROM h WHERE pos % 3 = 0 AND pos < 18""")
def heldout_operators(spark, sf_dir):
    return ablation.heldout_operators(read_table(spark, sf_dir, "documents"), "source")


def _tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.pmod(F.col("o_orderkey") * 7919, F.lit(10007)) / F.lit(10007.0)
    return read_table(spark, sf_dir, "orders").select("o_orderkey", (p * p * p).alias("p"))


_P = "(o_orderkey * 7919 % 10007)::DOUBLE / 10007"


@query(f"""WITH t AS (SELECT o_orderkey, {_P} * ({_P}) * ({_P}) AS p FROM orders), r AS (SELECT *, row_number() OVER (ORDER BY p) AS r, count(*) OVER () AS n FROM t),
c AS (SELECT max(p) AS cut FROM r WHERE p <= 0.05::DOUBLE * r / n) SELECT o_orderkey, coalesce(p <= cut, false) AS flagged FROM t, c""")
def bh_flags(spark, sf_dir):
    return statistics.benjamini_hochberg(_tests(spark, sf_dir), "p", "o_orderkey", 0.05).select("o_orderkey", "flagged")


@query(f"""WITH t AS (SELECT 'flagged' AS side, {_P} * ({_P}) * ({_P}) AS p FROM orders UNION ALL SELECT 'floor', {_P} FROM orders),
r AS (SELECT side, p, row_number() OVER (PARTITION BY side ORDER BY p) AS r, count(*) OVER (PARTITION BY side) AS n FROM t), a AS (SELECT unnest([0.01::DOUBLE, 0.05::DOUBLE, 0.1::DOUBLE, 0.25::DOUBLE]) AS alpha),
x AS (SELECT side, alpha, coalesce(max(r) FILTER (p <= alpha * r / n), 0)::DOUBLE / max(n) AS rate FROM r, a GROUP BY 1, 2)
SELECT alpha, round(max(rate) FILTER (side = 'flagged'), 6) AS flagged, round(max(rate) FILTER (side = 'floor'), 6) AS floor FROM x GROUP BY 1""")
def null_floor_report(spark, sf_dir):
    nulls = read_table(spark, sf_dir, "orders").select((F.pmod(F.col("o_orderkey") * 7919, F.lit(10007)) / F.lit(10007.0)).alias("p"))
    return rounded(statistics.null_floor(_tests(spark, sf_dir), nulls))


@query("""WITH c AS (SELECT source AS a, lang AS b, count(*)::DOUBLE AS c FROM documents GROUP BY 1, 2), p AS (SELECT c / sum(c) OVER () AS p, sum(c) OVER (PARTITION BY a) / sum(c) OVER () AS pa, sum(c) OVER (PARTITION BY b) / sum(c) OVER () AS pb FROM c)
SELECT round(sum(p * ln(p / (pa * pb))) / ((-sum(p * ln(pa)) - sum(p * ln(pb))) / 2), 6) AS nmi, sum(p * ln(p / (pa * pb))) / ((-sum(p * ln(pa)) - sum(p * ln(pb))) / 2) > 0.3 AS tracks FROM p""")
def nmi(spark, sf_dir):
    return rounded(statistics.normalised_mutual_information(read_table(spark, sf_dir, "documents"), "source", "lang"))


@query("""WITH r AS (SELECT vec_id AS k, embedding::DOUBLE[] AS v, label AS c FROM embeddings), d AS (SELECT a.k, a.c, b.c AS c2, avg(list_distance(a.v, b.v)) AS d FROM r a JOIN r b ON a.k <> b.k GROUP BY 1, 2, 3),
m AS (SELECT k, max(d) FILTER (c = c2) AS a, min(d) FILTER (c <> c2) AS b FROM d GROUP BY 1) SELECT round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 6) AS silhouette FROM m""")
def silhouette(spark, sf_dir):
    return rounded(statistics.silhouette(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label"))


@query("SELECT doc_id, count(*) OVER (PARTITION BY lang) / count(*) OVER () < 0.12::DOUBLE AS rare FROM documents")
def rare_cluster(spark, sf_dir):
    return statistics.rare_clusters(read_table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", 0.12).select("doc_id", "rare")


@query(f"""WITH {I.FRAMES_SQL}, v AS (SELECT episode, {_MOVES}, row_number() OVER (PARTITION BY episode ORDER BY frame_idx) - 1 AS j, count(*) OVER (PARTITION BY episode) AS n FROM fr WHERE episode % 11 <> 0 OR frame_idx < 3),
s AS (SELECT *, (16 * pow(2, length(bin(n - 1))))::BIGINT AS size FROM v WHERE n >= 4),
k AS (SELECT episode, k, sqrt(sum(speed * cos(2 * pi() * (k * j % size) / size)) ** 2 + sum(speed * sin(2 * pi() * (k * j % size) / size)) ** 2) AS a FROM s, LATERAL (SELECT unnest(range((size / 3.0)::BIGINT + 1)) AS k) WHERE k <= size * 10 / 30.0 GROUP BY 1, 2),
r AS (SELECT *, a / max(a) OVER (PARTITION BY episode) AS share FROM k WHERE episode IN (SELECT episode FROM s GROUP BY 1 HAVING max(speed) > 0)),
l AS (SELECT *, min(CASE WHEN share >= 0.05 THEN k END) OVER w AS lo, max(CASE WHEN share >= 0.05 THEN k END) OVER w AS hi FROM r WINDOW w AS (PARTITION BY episode)),
d AS (SELECT episode, sqrt((1.0::DOUBLE / (hi - lo)) ** 2 + (share - lag(share) OVER (PARTITION BY episode ORDER BY k)) ** 2) AS arc FROM l WHERE k BETWEEN lo AND hi AND lo < hi)
SELECT e.episode, round(coalesce(-sum(arc), 0), 6) + 0 AS sparc FROM (SELECT DISTINCT episode FROM fr) e LEFT JOIN d ON e.episode = d.episode GROUP BY 1""")
def sparc(spark, sf_dir):
    f = I.frames(spark, sf_dir).withColumn("speed", F.when(F.col("episode") % 10 == 0, 0.0).otherwise(F.abs("bytes")))
    return rounded(series.spectral_smoothness(f.where("episode % 11 <> 0 or frame_idx < 3"), "episode"))


@query(f"""WITH {I.MANIFEST_SQL} SELECT episode, to_json({{'episode': episode, 'decision': decision, 'reason': nullif(reason, ''), 'n_frames': n_frames, 'act_span': CASE WHEN episode % 8 <> 0 THEN round(act_span, 3) + 0.25::DOUBLE END, 'has_clip': episode % 4 = 0}})::VARCHAR AS json FROM mf""")
def json_manifest(spark, sf_dir):
    span = F.when(F.col("episode") % 8 == 0, F.lit(float("nan"))).otherwise(F.round("act_span", 3) + 0.25).alias("act_span")
    rows = _manifest(spark, sf_dir).select("episode", "decision", "reason", "n_frames", span, F.lit("x").alias("mp4_path"))
    stored = rows.where("episode % 4 = 0").select("episode")
    served = tables.published(rows, stored, "episode", "mp4_path").select("episode", "decision", "reason", "n_frames", "act_span", "has_clip")
    return tables.json_rows(served).select(F.get_json_object("json", "$.episode").cast("long").alias("episode"), "json")


@query("""WITH d AS (SELECT *, CASE WHEN doc_id % 9 <> 0 THEN n_chars::DOUBLE / 1000 - 4 END AS z FROM documents)
SELECT doc_id, 100.0::DOUBLE * least(1, greatest(0, (coalesce(z, 0) + 4) / 8)) AS bar, coalesce(z, 0) > 1.25 AS bad, substring(source || '-' || lang, 1, 12) AS short, CASE WHEN z IS NULL THEN '—' ELSE printf('%.3f', z) END AS shown,
 CASE WHEN z IS NULL THEN '—' ELSE regexp_replace(printf('%.2e', z / 7), 'e([+-])0([0-9])', 'e\\1\\2') END AS small, 'https://x/clip/' || doc_id || '.mp4' AS url FROM d""")
def display_functions(spark, sf_dir):
    z = F.when(F.col("doc_id") % 9 != 0, F.col("n_chars") / 1000.0 - 4)
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", S.bar_percent(z).alias("bar"), S.bar_is_bad(z).alias("bad"), F.substring(F.concat_ws("-", "source", "lang"), 1, 12).alias("short"), S.fixed(z).alias("shown"),
        S.exponential(z / 7).alias("small"), rules.clip_url("https://x", F.col("doc_id").cast("string")).alias("url"),
    )


@query("SELECT page_id, regexp_replace(regexp_replace(trim(url), '^[a-z0-9]+://[^/]+/', ''), '^/+|/+$', '', 'g') AS path FROM pages")
def path_normalise(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", S.object_path(F.col("url")).alias("path"))


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1, 2""")
def windowed_events(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return rounded(windowed_counts(e).withColumn("start", F.col("start").cast("timestamp_ntz")))


@query()
def random_sample(spark, sf_dir):
    return catalog.random_sample(read_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", 100, 7)


@query()
def outlier_pipeline(spark, sf_dir):
    d = _similarity(spark, sf_dir).select("episode", F.concat("sims", "steps").alias("shape"))
    return statistics.cluster_outliers(d, "episode", "shape")


@query()
def ablation_sweep(spark, sf_dir):
    sums = ablation.gram(_windows(spark, sf_dir), "episode", ["o0_bytes", "o1_bytes", "o2_bytes"], ["a_bytes"])
    score = series.frame_quality(I.frames(spark, sf_dir)).select("episode", (F.col("episode") % 7).alias("operator"), (-F.col("size_cv")).alias("score"), F.lit(False).alias("hard"))
    return ablation.sweep(sums, score, "episode", "operator", 3, 1)


# --- the flagship plan and its parts ------------------------------------------------------------------


@query()
def keep_drop(spark, sf_dir):
    made, _ = plan.keep_drop(*_scans(spark, sf_dir), _frames_of(spark, sf_dir))
    return rounded(made)


@query()
def keep_drop_floor(spark, sf_dir):
    return rounded(plan.keep_drop_floor(*_scans(spark, sf_dir), _frames_of(spark, sf_dir)))


def _scans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Motion scan, visual scan and catalog: the stand-in features, dealt to the two scans."""
    e = I.episodes(spark, sf_dir)
    visual = ["low_detail_frac", "faint_frac", "size_cv", "declared"]
    motion = e.drop("operator", "progress_dip", "progress_final", "act_span", *visual)
    seen = e.select("episode", "operator", *visual, (F.col("n_frames") + 1).alias("n_frames"))
    return motion, seen, e.select("episode", "operator")


_ITEMS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
_PARTS = ["l_quantity / 50", "l_extendedprice / 100000", "l_discount * 10", "l_tax * 10", "l_linenumber / 7"]


def _frames_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode, t, emb): the first eight items of each customer that has so many, as frames; every
    other frame of some customers is turned around, which no other's is."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("episode"))
    rows = read_table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    own = Window.partitionBy("episode")
    numbered = rows.withColumns({"t": F.row_number().over(own.orderBy(*_ITEMS)) - 1, "n": F.count("*").over(own)})
    turned = F.when((F.col("episode") % 151 == 7) & (F.col("t") % 2 == 1), -1.0).otherwise(1.0)
    parts = F.array(*(turned * F.col(x.split()[0]).cast("double") * F.lit(float(x.split()[2]) if x.split()[1] == "*" else 1 / float(x.split()[2])) for x in _PARTS))
    return numbered.where("n >= 8 and t < 8").select("episode", F.col("t").cast("long").alias("t"), parts.alias("emb"))


@query(f"""WITH {I.EPISODES_SQL} SELECT episode, operator, n_frames, declared, round(size_cv, 6) AS size_cv FROM ep""")
def joined_scans(spark, sf_dir):
    return rounded(plan.joined_scans(*_scans(spark, sf_dir)).select("episode", "operator", "n_frames", "declared", "size_cv"))


_DIPS = f"""v AS (SELECT o_custkey AS episode, row_number() OVER (PARTITION BY o_custkey ORDER BY {', '.join(_ITEMS)}) - 1 AS t, CASE WHEN o_custkey % 151 = 7 AND t % 2 = 1 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS u, [{', '.join(f"u * {x.split()[0]}::DOUBLE {' '.join(x.split()[1:])}" for x in _PARTS)}] AS e
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey QUALIFY count(*) OVER (PARTITION BY o_custkey) >= 8 AND t < 8),
l AS (SELECT *, last(e) OVER (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS le FROM v),
dp AS (SELECT episode, first(c ORDER BY t) - min(c) AS dip FROM (SELECT episode, t, list_inner_product(e, le) / sqrt(list_inner_product(e, e)) / sqrt(list_inner_product(le, le)) AS c FROM l) GROUP BY 1)"""


@query(f"""WITH {I.EPISODES_SQL}, {_DIPS} SELECT ep.episode, round(dip, 6) AS progress_dip, dip IS NOT NULL AS has_progress FROM ep LEFT JOIN dp ON ep.episode = dp.episode""")
def joined_progress(spark, sf_dir):
    known, _ = plan.with_progress(I.episodes(spark, sf_dir), _frames_of(spark, sf_dir))
    return rounded(known.select("episode", "progress_dip", "has_progress"))


@query(f"""WITH {I.EPISODES_SQL}, {_DIPS} SELECT ep.episode FROM ep JOIN dp ON ep.episode = dp.episode WHERE ({I.REASON_SQL.replace('progress_dip', 'dip')}) = ''""")
def eligible_rows(spark, sf_dir):
    known, _ = plan.with_progress(I.episodes(spark, sf_dir), _frames_of(spark, sf_dir))
    dip = F.col("progress_dip")
    reason = rules.integrity_reason(F.col("n_frames"), F.col("declared"), F.col("has_progress"), dip, F.col("act_span"))
    return known.where((reason == "") & F.col("has_progress")).select("episode")


def _whitened(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """All components of the vectors, standardised and turned to principal components, as the plan does."""
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    head = e.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    return statistics.whitened(e, "vec_id", "v", head["n"], head["d"])


@query()
def kmeans_choose_k(spark, sf_dir):
    points, _ = _whitened(spark, sf_dir)
    labelled, _ = statistics.choose_clusters(points, "vec_id", "y")
    return labelled.select("vec_id", "cluster")


@query()
def mcd_pvalues(spark, sf_dir):
    points, dims = _whitened(spark, sf_dir)
    labels = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("cluster"))
    tested, _ = statistics.cluster_pvalues(points.join(labels, "vec_id").withColumn("rare", F.lit(False)), "vec_id", dims)
    return rounded(tested.select("vec_id", "p"))


# --- reports --------------------------------------------------------------------------------------------


_REPORT = f"""{I.TESTED_SQL},
a1 AS (SELECT 'decisions' AS part, decision AS item, count(*)::DOUBLE AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM mf GROUP BY 2),
a2 AS (SELECT 'failed_axes' AS part, failed::VARCHAR AS item, count(*) FILTER (decision = 'keep')::DOUBLE AS keep, count(*) FILTER (decision = 'drop')::DOUBLE AS "drop" FROM (SELECT decision, {' + '.join(f'coalesce((ax_{a} > 1)::INT, 0)' for a in I.AXES)} AS failed FROM mf) GROUP BY 2),
a3 AS (SELECT 'fairness' AS part, operator::VARCHAR AS item, count(*)::DOUBLE AS n, avg((decision = 'keep')::INT) AS keep_rate, avg(hard::INT) AS hard_rate FROM mf WHERE operator IS NOT NULL GROUP BY 2),
a4 AS (SELECT cluster, operator, count(*) AS c, count(*) FILTER (decision = 'drop' AND NOT hard) AS o, sum(score) AS s, count(score) AS k FROM mf WHERE cluster IS NOT NULL GROUP BY 1, 2),
a5 AS (SELECT 'clusters' AS part, cluster::VARCHAR AS item, sum(c)::DOUBLE AS n, sum(o)::DOUBLE AS outliers, max(c) FILTER (operator IS NOT NULL)::DOUBLE / sum(c) AS top_share, sum(s) / sum(k) AS mean_score FROM a4 GROUP BY 2),
a6 AS (SELECT c / sum(c) OVER () AS p, sum(c) OVER (PARTITION BY cluster) / sum(c) OVER () AS pa, sum(c) OVER (PARTITION BY operator) / sum(c) OVER () AS pb FROM (SELECT cluster, operator, sum(c)::DOUBLE AS c FROM a4 WHERE operator IS NOT NULL GROUP BY 1, 2)),
a7 AS (SELECT sum(p * ln(p / (pa * pb))) / ((-sum(p * ln(pa)) - sum(p * ln(pb))) / 2) AS nmi FROM a6),
a8 AS (SELECT count(*) FILTER (decision = 'keep' AND flags <> '')::DOUBLE / nullif(count(*) FILTER (decision = 'keep'), 0) AS kept_flagged,
 count(*) FILTER (reason = 'below_average')::DOUBLE / nullif(count(*) FILTER (reason <> '' AND NOT hard), 0) AS no_defect, count(*) FILTER (progress_dip IS NULL)::DOUBLE AS untested FROM mf)"""
_LONG = {"a1": ("n", "share"), "a2": ("keep", '"drop"'), "a3": ("n", "keep_rate", "hard_rate"), "a5": ("n", "outliers", "top_share", "mean_score")}


@query(f"""WITH {_REPORT} SELECT part, item, measure, round(value, 6) + 0 AS value FROM ({' UNION ALL '.join(f"SELECT part, item, '{m.strip(chr(34))}' AS measure, {m} AS value FROM {t}" for t, ms in _LONG.items() for m in ms)}
 UNION ALL SELECT 'reasons', reason, 'n', count(*)::DOUBLE FROM mf WHERE reason <> '' GROUP BY 2 UNION ALL SELECT 'spread', 'all', 'lowest', min(keep_rate) FROM a3 UNION ALL SELECT 'spread', 'all', 'highest', max(keep_rate) FROM a3
 UNION ALL SELECT 'nmi', 'all', 'nmi', nmi FROM a7 UNION ALL SELECT 'nmi', 'all', 'tracks', (nmi > 0.3)::INT::DOUBLE FROM a7 UNION ALL SELECT 'features', feature, 'eta2', eta2 FROM et WHERE known > 0
 {' '.join(f"UNION ALL SELECT 'warnings', 'all', '{m}', {m} FROM a8" for m in ("kept_flagged", "no_defect", "untested"))})""")
def scoring_report(spark, sf_dir):
    parts = reports.report(_tested(spark, sf_dir), [f"ax_{a}" for a in I.AXES], rules.HARD_REASONS, "operator", I.episodes(spark, sf_dir), I.SIGNS)
    return rounded(reports.report_rows(parts))


@query(f"WITH {I.MANIFEST_SQL} SELECT episode, decision, nullif(reason, '') AS reason, n_frames, episode % 4 = 0 AS has_clip FROM mf")
def manifest_sinks(spark, sf_dir):
    folder = fixtures.new_folder(spark)
    rows = _manifest(spark, sf_dir).withColumn("mp4_path", F.lit("x"))
    tables.write_manifest(rows, rows.where("episode % 4 = 0").select("episode"), "episode", folder)
    served = tables.read_json(spark, f"{folder}/json")
    whole = spark.read.parquet(f"{folder}/parquet").select("episode")
    return whole.join(served.select("episode", "decision", "reason", "n_frames", "has_clip"), "episode", "left")


@query(f"WITH {I.TESTED_SQL} SELECT decision, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM mf GROUP BY 1")
def decision_shares(spark, sf_dir):
    return rounded(reports.decisions(_tested(spark, sf_dir)))


_FAILS = " + ".join(f"coalesce((ax_{a} > 1)::INT, 0)" for a in I.AXES)


@query(f"WITH {I.TESTED_SQL} SELECT {_FAILS} AS failed, count(*) FILTER (decision = 'keep') AS keep, count(*) FILTER (decision = 'drop') AS \"drop\" FROM mf GROUP BY 1")
def failed_axes(spark, sf_dir):
    return reports.failed_axes(_tested(spark, sf_dir), [f"ax_{a}" for a in I.AXES])


@query(f"""WITH {I.TESTED_SQL} SELECT round(count(*) FILTER (decision = 'keep' AND flags <> '')::DOUBLE / nullif(count(*) FILTER (decision = 'keep'), 0), 6) AS kept_flagged,
 round(count(*) FILTER (reason = 'below_average')::DOUBLE / nullif(count(*) FILTER (reason <> '' AND NOT hard), 0), 6) AS no_defect, count(*) FILTER (progress_dip IS NULL) AS untested FROM mf""")
def warning_shares(spark, sf_dir):
    return rounded(reports.warnings(_tested(spark, sf_dir), rules.HARD_REASONS))


@query(f"WITH {I.TESTED_SQL} SELECT round(min(k), 6) AS lowest, round(max(k), 6) AS highest FROM (SELECT avg((decision = 'keep')::INT) AS k FROM mf WHERE operator IS NOT NULL GROUP BY operator)")
def fairness_spread(spark, sf_dir):
    return rounded(reports.keep_rate_spread(_tested(spark, sf_dir), "operator"))


@query(f"""WITH {I.MANIFEST_SQL} SELECT episode, CASE WHEN decision <> 'drop' AND n_frames <> 0 THEN printf('frames %d–%d of %d (%d%% of clip)', round_even(act_start * (n_frames - 1), 0)::BIGINT, round_even(act_end * (n_frames - 1), 0)::BIGINT, n_frames,
 round(100 * (round_even(act_end * (n_frames - 1), 0) - round_even(act_start * (n_frames - 1), 0)) / n_frames)::BIGINT) ELSE '—' END AS trim FROM mf""")
def trim_texts(spark, sf_dir):
    shown = rules.trim_text(F.col("trim_start"), F.col("trim_end"), F.col("n_frames"), F.lit(None).cast("long"))
    return _manifest(spark, sf_dir).select("episode", shown.alias("trim"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("episode"), (F.col("event_id") % 7 != 0).alias("ok"), (F.col("event_id") % 1000).alias("bytes"), F.abs("value").alias("fetch_s"),
        F.abs(F.col("value") * 2 + 1).alias("gpu_s"), (F.col("event_id") % 3).alias("cropped"), F.sequence(F.lit(0), (F.col("event_id") % 5).cast("int")).alias("frame_idx"),
    )


@query("""SELECT round(median(abs(value)), 6) AS fetch, round(median(abs(value * 2 + 1)), 6) AS compute, round(median(abs(value * 2 + 1)) / (median(abs(value)) + median(abs(value * 2 + 1))), 6) AS share FROM events""")
def timing_split(spark, sf_dir):
    return rounded(reports.timings(_results(spark, sf_dir)))


@query("SELECT count(*) FILTER (event_id % 7 <> 0) AS ok, count(*) FILTER (event_id % 7 = 0) AS failed, sum(event_id % 1000) FILTER (event_id % 7 <> 0)::BIGINT AS bytes FROM events")
def transfer_totals(spark, sf_dir):
    return reports.transfers(_results(spark, sf_dir))


@query("SELECT user_id AS episode, sum(event_id % 100000)::BIGINT AS bytes, round(sum(event_id % 100000) / 1e6::DOUBLE, 2) AS mb FROM events GROUP BY 1")
def cached_bytes(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("episode"), (F.col("event_id") % 100000).alias("bytes"))
    return reports.cached(e, "episode")


@query("SELECT sum(event_id % 3)::BIGINT AS cropped, sum(event_id % 5 + 1)::BIGINT AS fetched FROM events WHERE event_id % 7 <> 0")
def crop_counts(spark, sf_dir):
    return reports.crops(_results(spark, sf_dir))


@query("(SELECT 'good' AS side, event_id AS episode FROM events WHERE event_id % 7 <> 0) UNION ALL (SELECT 'bad', event_id FROM events WHERE event_id % 7 = 0 ORDER BY event_id LIMIT 5)")
def failure_rows(spark, sf_dir):
    good, bad = catalog.first_failures(_results(spark, sf_dir), "episode")
    return good.select(F.lit("good").alias("side"), "episode").unionByName(bad.select(F.lit("bad").alias("side"), "episode"))


# --- catalog ----------------------------------------------------------------------------------------------


@query("""SELECT c.column_name AS "column", c.kind, (SELECT count(*) FROM labels) AS rows FROM (VALUES ('doc_id', 'bigint'), ('quality', 'bigint'), ('toxic', 'bigint')) c(column_name, kind)""")
def table_shape(spark, sf_dir):
    l = read_table(spark, sf_dir, "labels")
    return catalog.shape(l.select(*(F.col(c).cast("long") for c in ("doc_id", "quality", "toxic"))))


@query("""SELECT 'source' AS "column", count(DISTINCT source) AS n FROM documents UNION ALL SELECT 'lang', count(DISTINCT lang) FROM documents""")
def distinct_counts(spark, sf_dir):
    return catalog.distinct_counts(read_table(spark, sf_dir, "documents"), ["source", "lang"])


@query("""SELECT count(*) FILTER (quality <> 1) AS scored, count(*) FILTER (toxic > 0 AND quality <> toxic) AS mismatched FROM labels""")
def conditional_counts(spark, sf_dir):
    return catalog.count_where(read_table(spark, sf_dir, "labels"), scored=F.col("quality") != 1, mismatched=(F.col("toxic") > 0) & (F.col("quality") != F.col("toxic")))


@query(f"WITH {I.EPISODES_SQL} SELECT episode, n_frames, 0.0::DOUBLE AS left_act_start FROM ep WHERE coalesce(n_frames, 0) >= 16")
def usable_episodes(spark, sf_dir):
    e = I.episodes(spark, sf_dir).withColumnRenamed("n_frames", "num_frames")
    filled = catalog.filled_columns(e, n_frames=F.col("num_frames"), left_act_start=0.0, act_start=1.0)
    return catalog.long_enough(filled).select("episode", "n_frames", "left_act_start")


@query(f"""WITH {I.MANIFEST_SQL} SELECT episode, decision FROM mf WHERE decision = 'drop' AND episode % 6 <> 0 ORDER BY episode LIMIT 40""")
def sync_rows(spark, sf_dir):
    rows = _manifest(spark, sf_dir).withColumn("mp4_path", F.when(F.col("episode") % 6 != 0, "x"))
    return catalog.to_sync(rows, "mp4_path", "episode", drops_only=True, limit=40).select("episode", "decision")


@query("SELECT d.doc_id, b.source FROM documents d JOIN (SELECT doc_id, source FROM documents UNION ALL SELECT doc_id, 'again' FROM documents WHERE doc_id % 5 = 0) b ON d.doc_id = b.doc_id WHERE d.doc_id % 2 = 0 AND d.doc_id % 3 <> 0")
def operator_fan_out(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    twice = d.unionByName(d.where("doc_id % 5 = 0").withColumn("source", F.lit("again"))).where("doc_id % 3 <> 0")
    return catalog.with_operator(d.where("doc_id % 2 = 0"), twice, "doc_id", "source").select("doc_id", "source")


@query("SELECT doc_id, url FROM (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) JOIN pages ON doc_id = page_id")
def path_by_join(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select("doc_id")
    p = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    there = catalog.with_column_of(d.withColumn("url", F.lit("own")), p, "doc_id", "url")
    return catalog.with_column_of(there.drop("url"), p, "doc_id", "url")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def known_only(spark, sf_dir):
    return catalog.only_known(read_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), read_table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, vec_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents) JOIN embeddings ON r = vec_id")
def joined_by_position(spark, sf_dir):
    d = ranking.running(read_table(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")], "row").withColumn("row", F.col("row") - 1)
    return catalog.by_position(d, read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("vec_id").alias("row"))).select("doc_id", "vec_id")


@query("SELECT count(*) AS missing FROM documents WHERE doc_id NOT IN (SELECT page_id FROM pages)")
def unmatched_rows(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return catalog.joined_with_misses(read_table(spark, sf_dir, "documents").select("doc_id"), p, "doc_id", "url")[1]


# --- series -------------------------------------------------------------------------------------------------


@query("""WITH r AS (SELECT user_id AS episode, count(*) / ((max(event_id) - min(event_id)) / 30.0::DOUBLE) AS f FROM events GROUP BY 1) SELECT episode, abs(f - 30) / 30 > 0.1 AS off FROM r""")
def rate_mismatch(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("episode"), "event_id", ((F.col("event_id") + 1) * 1_000_000_000 / 30).cast("double").alias("ns"))
    return series.rate_check(series.true_rate(e, "episode", "event_id", "ns")).select("episode", "off")


@query("""WITH e AS (SELECT vec_id // 20 AS episode, vec_id % 10 AS frame_idx, embedding[1]::DOUBLE AS s FROM embeddings WHERE vec_id % 20 < 10 OR vec_id % 3 <> 0) SELECT episode, frame_idx, round(max(s), 6) AS speed FROM e GROUP BY 1, 2""")
def fastest_side(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    side = lambda rows: rows.select(F.floor(F.col("vec_id") / 20).alias("episode"), (F.col("vec_id") % 10).alias("frame_idx"), F.col("embedding")[0].cast("double").alias("speed"))
    return rounded(series.fastest_side(side(e.where("vec_id % 20 < 10")), side(e.where("vec_id % 20 >= 10 and vec_id % 3 <> 0")), key="episode", order="frame_idx"))


@query("""WITH e AS (SELECT vec_id // 50 AS episode, vec_id % 50 AS t, embedding[1]::DOUBLE AS l, CASE WHEN vec_id // 50 % 2 = 0 THEN embedding[2]::DOUBLE END AS r FROM embeddings),
n AS (SELECT episode, CASE WHEN episode % 4 = 3 THEN 20 ELSE 50 END AS n, (episode % 10) / 10.0::DOUBLE AS a FROM e GROUP BY 1), s AS (SELECT *, floor(a * (n - 1)) AS lo FROM n WHERE n >= 24)
SELECT e.episode, t AS frame_idx, round(l, 6) AS first, CASE WHEN r IS NULL THEN 1 ELSE 2 END AS width FROM e JOIN s ON e.episode = s.episode WHERE t BETWEEN lo AND greatest(floor(0.8::DOUBLE * (n - 1)), lo + 24) AND t < n""")
def trajectory(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 50).alias("episode"), (F.col("vec_id") % 50).alias("frame_idx"), "embedding")
    side = lambda rows, name, i: rows.select("episode", F.lit(name).alias("side"), "frame_idx", F.array(F.col("embedding")[i].cast("double")).alias("pose"))
    poses = side(e, "left", 0).unionByName(side(e.where("episode % 2 = 0"), "right", 1))
    n = F.when(F.col("episode") % 4 == 3, 20).otherwise(50).cast("long")
    spans = e.select("episode").distinct().select("episode", n.alias("n"), (F.col("episode") % 10 / 10.0).alias("act_start"), F.lit(0.8).alias("act_end"))
    made = series.trajectories(poses, spans, "episode")
    return rounded(made.select("episode", "frame_idx", F.col("values")[0].alias("first"), F.size("values").alias("width")))


@query(f"""WITH {_WINDOWS}, n AS (SELECT episode, count(*) AS n FROM hk GROUP BY 1 HAVING count(*) >= 8), k AS (SELECT n.*, episode % 7 AS operator, episode % 9 = 0 AS hard FROM n),
h AS (SELECT operator, row_number() OVER (ORDER BY count(*) DESC, operator) - 1 AS pos FROM k GROUP BY 1), m AS (SELECT k.*, pos % 3 = 0 AND pos < 18 AS held FROM k JOIN h ON k.operator = h.operator)
SELECT count(*) AS usable, count(DISTINCT operator) AS operators, count(*) FILTER (held) AS held_out, count(DISTINCT operator) FILTER (held) AS held_operators, coalesce(sum(n) FILTER (held), 0)::BIGINT AS held_steps,
 count(*) FILTER (NOT held) AS pool, count(DISTINCT operator) FILTER (NOT held) AS pool_operators, count(*) FILTER (NOT held AND hard) AS excluded FROM m""")
def sweep_counts(spark, sf_dir):
    sums = ablation.gram(_windows(spark, sf_dir), "episode", ["o0_bytes"], ["a_bytes"])
    scores = sums.select("episode", (F.col("episode") % 7).alias("operator"), F.lit(0.0).alias("score"), (F.col("episode") % 9 == 0).alias("hard"))
    return ablation.sweep_counts(sums, scores, "episode", "operator")


@query("""WITH s AS (SELECT l_linenumber / 10.0::DOUBLE AS keep_frac, count(*) AS n, avg(l_discount::DOUBLE) AS quality_mse, max(l_orderkey * 31 % 97 + l_linenumber)::DOUBLE AS gain FROM lineitem GROUP BY l_linenumber),
b AS (SELECT * FROM s ORDER BY gain DESC, keep_frac LIMIT 1) SELECT round(keep_frac, 6) AS best_frac, n AS best_n, gain AS best_gain, (SELECT round(min(keep_frac), 6) FROM s WHERE quality_mse <= 0.05) AS parity_frac FROM b""")
def sweep_verdict(spark, sf_dir):
    found = read_table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(
        F.count("*").alias("n"), F.avg(F.col("l_discount").cast("double")).alias("quality_mse"),
        F.max(F.col("l_orderkey") * 31 % 97 + F.col("l_linenumber")).cast("double").alias("gain"),
    )
    return rounded(ablation.verdict(found.withColumn("keep_frac", F.col("l_linenumber") / 10.0), 0.05))


def _trajectories(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both hands' poses of 25 embeddings an episode, cut to the active span; and the episodes' scores."""
    e = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 25).alias("episode"), (F.col("vec_id") % 25).alias("frame_idx"), F.col("embedding").cast("array<double>").alias("v"))
    side = lambda name, first: e.select("episode", F.lit(name).alias("side"), "frame_idx", F.slice("v", first, 7).alias("pose"))
    spans = e.select("episode").distinct().select("episode", F.lit(25).cast("long").alias("n"), F.lit(0.0).alias("act_start"), F.lit(1.0).alias("act_end"))
    made = series.trajectories(side("left", 1).unionByName(side("right", 8)), spans, "episode")
    smooth = series.frame_similarity(e.select("episode", F.col("frame_idx").alias("t"), F.col("v").alias("emb")), "episode")
    scores = smooth.select("episode", (F.col("episode") % 7).alias("operator"), F.element_at("sims", 1).alias("score"), (F.col("episode") % 9 == 4).alias("hard"))
    return made, scores


_TRACKS = """tr AS (SELECT vec_id // 25 AS episode, vec_id % 25 AS t, embedding::DOUBLE[] AS v, count(*) OVER (PARTITION BY vec_id // 25) AS n FROM embeddings),
tw AS (SELECT a.episode, a.v[1:14] AS x0, b.v[1:14] AS x1, list_transform(list_zip(c.v[1:14], b.v[1:14]), lambda z: z[1] - z[2]) AS y FROM tr a JOIN tr b ON a.episode = b.episode AND b.t = a.t + 1 JOIN tr c ON c.episode = a.episode AND c.t = a.t + 6 WHERE a.t < a.n - 7)"""


@query(f"""WITH {_TRACKS} SELECT episode, count(*) AS n, 28 AS seen, round(sum(x0[3] * x1[14]), 6) AS g_3_28, round(sum(x1[1]), 6) AS g_0_15, round(sum(x0[14] * y[2]), 6) AS h_14_2, round(sum(list_inner_product(y, y)), 6) AS s FROM tw GROUP BY 1""")
def trajectory_gram(spark, sf_dir):
    made, _ = _trajectories(spark, sf_dir)
    sums = ablation.gram_arrays(made, "episode", history=2, horizon=5)
    at = lambda i: F.get("sums", F.lit(i))
    return rounded(sums.select(
        "episode", "n", F.lit(28).alias("seen"), at(3 * 29 + 28).alias("g_3_28"), at(15).alias("g_0_15"), at(29 * 29 + 14 * 14 + 1).alias("h_14_2"), at(29 * 29 + 29 * 14).alias("s")
    ))


@query()
def trajectory_sweep(spark, sf_dir):
    made, scores = _trajectories(spark, sf_dir)
    swept, full = ablation.sweep_trajectories(ablation.gram_arrays(made, "episode", history=2, horizon=5), scores, "episode", "operator", most=2)
    return swept.withColumn("full_mse", F.lit(full)).join(ablation.verdict(swept, full))


# --- files, shards and arrays -------------------------------------------------------------------------------


_SHARDS = """sh AS (SELECT user_id AS episode, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS i, event_id % 40 + 5 AS bytes FROM events)"""


@query(f"WITH {_SHARDS} SELECT lpad(lower(to_hex(episode + 1)), 24, '0') AS episode_hash, i // 20 * 1000 + i % 20 AS frame_idx, bytes FROM sh WHERE i % 7 <> 3")
def shard_index(spark, sf_dir):
    return shards.frame_sizes(spark, fixtures.shards(spark, sf_dir)).where("ok").select("episode_hash", "frame_idx", "bytes")


@query(f"WITH {_SHARDS} SELECT lpad(lower(to_hex(episode + 1)), 24, '0') AS episode_hash, i // 20 * 1000 + i % 20 AS frame_idx, (bytes - 2)::BIGINT AS shown FROM sh WHERE i % 7 <> 3 AND i % 5 = 0")
def shard_frames(spark, sf_dir):
    index = stash(shards.frame_sizes(spark, fixtures.shards(spark, sf_dir)))
    wanted = index.where("frame_idx % 5 = 0").select("episode_hash", "frame_idx").unionByName(index.select("episode_hash", F.lit(999).cast("long").alias("frame_idx")).distinct())
    return shards.fetch_frames(index, wanted).select("episode_hash", "frame_idx", F.length("content").cast("long").alias("shown"))


@query("""SELECT lpad(lower(to_hex(vec_id // 10 + 1)), 24, '0') AS episode_hash, CASE WHEN vec_id // 10 % 3 = 0 THEN 'head' ELSE 'left' END AS body, vec_id % 10 AS frame_idx, round(embedding[1]::DOUBLE, 6) AS x, round(embedding[7]::DOUBLE, 6) AS qz FROM embeddings WHERE vec_id % 10 < 8""")
def pose_arrays(spark, sf_dir):
    found = arrays.read_arrays(spark, fixtures.pose_groups(spark, sf_dir))
    return rounded(arrays.pose_rows(found).select("episode_hash", "body", "frame_idx", "x", F.element_at("q", 4).alias("qz")))


@query("""WITH e AS (SELECT DISTINCT vec_id // 10 AS e FROM embeddings) SELECT lpad(lower(to_hex(e + 1)), 24, '0') AS episode_hash, CASE WHEN e % 3 = 0 THEN 'obs_head_pose' ELSE 'left.obs_ee_pose' END AS "array", '10x7' AS shape, 7 AS n_head FROM e UNION ALL SELECT lpad(lower(to_hex(e + 1)), 24, '0'), '', NULL, NULL FROM e""")
def described_groups(spark, sf_dir):
    found = arrays.described(spark, fixtures.pose_groups(spark, sf_dir))
    size = F.when(F.col("shape").isNotNull(), F.concat_ws("x", F.col("shape").cast("array<string>")))
    return found.select("episode_hash", "array", size.alias("shape"), F.array_size("head").alias("n_head"))


_BODIES = {"left": (0, "e % 3 <> 0"), "right": (7, "true"), "head": (14, "e % 5 <> 0")}
#: A block of the head's array isn't stored for every fifth episode: rows 5 to 9 of columns 4 to 6 hold the fill value.
_COLUMN = lambda first, i: f"CASE WHEN {first} = 14 AND e % 5 = 1 AND t BETWEEN 5 AND 9 AND {i} BETWEEN 4 AND 6 THEN 0.25 ELSE x[{first + i}] END::DOUBLE"
_RECORDED = f"""rc AS (SELECT vec_id // 20 AS e, vec_id % 20 AS t, vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id % 20 < 18),
fp AS (SELECT e, CASE WHEN e % 4 = 1 THEN 25.0::DOUBLE ELSE 30.0::DOUBLE END AS fps_attr, CASE WHEN e % 2 = 0 THEN 17 / (16 * 0.04::DOUBLE) WHEN e % 4 = 1 THEN 25.0::DOUBLE ELSE 30.0::DOUBLE END AS fps FROM rc GROUP BY 1),
bo AS ({' UNION ALL '.join(f"SELECT e, '{b}' AS body, t, {', '.join(f'{_COLUMN(first, i)} AS c{i}' for i in range(1, 8))} FROM rc WHERE {there} AND e % 7 <> 6" for b, (first, there) in _BODIES.items())}),
b1 AS (SELECT bo.*, fps, sqrt((c1 - lag(c1) OVER w) ** 2 + (c2 - lag(c2) OVER w) ** 2 + (c3 - lag(c3) OVER w) ** 2) AS step,
 2 * acos(least(1, abs(c4 * lag(c4) OVER w + c5 * lag(c5) OVER w + c6 * lag(c6) OVER w + c7 * lag(c7) OVER w))) AS angle FROM bo JOIN fp USING (e) WINDOW w AS (PARTITION BY e, body ORDER BY t)),
b2 AS (SELECT *, step * fps AS speed, (step * fps - lag(step * fps) OVER w) * fps AS accel FROM b1 WINDOW w AS (PARTITION BY e, body ORDER BY t)),
b3 AS (SELECT *, (accel - lag(accel) OVER w) * fps AS jerk FROM b2 WINDOW w AS (PARTITION BY e, body ORDER BY t)),
b4 AS (SELECT *, row_number() OVER (PARTITION BY e, body ORDER BY t) - 1 AS pos, count(*) OVER (PARTITION BY e, body) AS n, speed > 0.15 * max(speed) OVER (PARTITION BY e, body) AS active FROM b3 WHERE step IS NOT NULL),
en AS (SELECT e, body, sqrt((last(c1 ORDER BY t) - first(c1 ORDER BY t)) ** 2 + (last(c2 ORDER BY t) - first(c2 ORDER BY t)) ** 2 + (last(c3 ORDER BY t) - first(c3 ORDER BY t)) ** 2) AS net FROM bo GROUP BY 1, 2),
fs AS (SELECT e, body, fps, pos, n, speed, (16 * pow(2, length(bin(n - 1))))::BIGINT AS size FROM b4),
fk AS (SELECT e, body, k, sqrt(sum(speed * cos(2 * pi() * (k * pos % size) / size)) ** 2 + sum(speed * sin(2 * pi() * (k * pos % size) / size)) ** 2) AS a FROM fs, LATERAL (SELECT unnest(range(size)) AS k) WHERE k <= size * 10 / fps GROUP BY 1, 2, 3),
fr AS (SELECT *, a / max(a) OVER (PARTITION BY e, body) AS share FROM fk),
fl AS (SELECT *, min(CASE WHEN share >= 0.05 THEN k END) OVER w AS lo, max(CASE WHEN share >= 0.05 THEN k END) OVER w AS hi FROM fr WINDOW w AS (PARTITION BY e, body)),
fd AS (SELECT e, body, sqrt((1.0::DOUBLE / (hi - lo)) ** 2 + (share - lag(share) OVER (PARTITION BY e, body ORDER BY k)) ** 2) AS arc FROM fl WHERE k BETWEEN lo AND hi AND lo < hi),
sp AS (SELECT e, body, -sum(arc) AS sparc FROM fd GROUP BY 1, 2),
ft AS (SELECT b4.e, b4.body, sum(step) AS path_len, max(speed) AS speed_max, avg(speed) AS speed_mean, coalesce(sqrt(avg(jerk * jerk)), 0) AS jerk_rms, max(sparc) AS sparc, avg((speed < 0.01)::INT) AS idle_frac, sum(angle) AS ang_path,
 max(net) AS net_disp, coalesce(max(net) / nullif(sum(step), 0), 0) AS straightness, coalesce(min(pos) FILTER (active) / count(*), 0) AS act_start, coalesce(max(pos) FILTER (active) / count(*), 1) AS act_end
 FROM b4 JOIN en ON en.e = b4.e AND en.body = b4.body LEFT JOIN sp ON sp.e = b4.e AND sp.body = b4.body GROUP BY 1, 2)"""
_HANDS = f"""kp AS (SELECT e, t, list_transform(range(21), lambda i: {{'x': x[3 * i + 1]::FLOAT::DOUBLE, 'y': x[3 * i + 2]::FLOAT::DOUBLE, 'z': x[3 * i + 3]::FLOAT::DOUBLE}}) AS p FROM rc WHERE e % 3 = 1 AND e % 7 <> 6),
hs AS (SELECT e, avg(s) AS hand_span_mean, coalesce(stddev_pop(s) / nullif(avg(s), 0), 0) AS hand_span_cv FROM (SELECT e, sqrt({_SPAN}) AS s FROM kp) GROUP BY 1)"""
_HASH = "lpad(lower(to_hex(e + 1)), 24, '0') AS episode_hash"
_DIGITS = {"jerk_rms": 3}


@query(f"""WITH {_RECORDED}, {_HANDS} SELECT lpad(lower(to_hex(fp.e + 1)), 24, '0') AS episode_hash, fp.e % 7 <> 6 AS ok, fp.e % 7 = 6 AS broken, CASE WHEN fp.e % 7 <> 6 THEN 18 END AS n_frames, CASE WHEN fp.e % 7 <> 6 THEN fps_attr END AS fps_attr,
 CASE WHEN fp.e % 7 <> 6 THEN round(fps, 6) END AS fps_true, {', '.join(f"round(max({m}) FILTER (body = '{b}'), {_DIGITS.get(m, 6)}) + 0 AS {b}_{m}" for b in scans.STREAMS for m in scans.MEASURES)}, round(max(hand_span_mean), 6) AS left_hand_span_mean, round(max(hand_span_cv), 6) AS left_hand_span_cv
 FROM fp LEFT JOIN ft ON ft.e = fp.e LEFT JOIN hs ON hs.e = fp.e GROUP BY fp.e, fps_attr, fps""")
def pose_scan(spark, sf_dir):
    found = scans.pose_scan(*scans.stored_groups(spark, fixtures.recordings(spark, sf_dir)))
    measured = [F.round(f"{b}_{m}", _DIGITS.get(m, 6)).alias(f"{b}_{m}") for b in scans.STREAMS for m in scans.MEASURES]
    return rounded(found.select(
        "episode_hash", "ok", F.contains("error", F.lit("blosc")).alias("broken"), "n_frames", "fps_attr", "fps_true", *measured, "left_hand_span_mean", "left_hand_span_cv"
    ))


_WAYS = f"""{_RECORDED}, wy AS (SELECT e, t - 1 AS pos, max(step) AS w FROM b1 WHERE step IS NOT NULL AND body <> 'head' GROUP BY 1, 2),
wc AS (SELECT e, pos, sum(CASE WHEN pos BETWEEN 1 AND 14 THEN w ELSE 0 END) OVER (PARTITION BY e) AS total, sum(CASE WHEN pos BETWEEN 1 AND 14 THEN w ELSE 0 END) OVER (PARTITION BY e ORDER BY pos) AS upto FROM wy),
wt AS (SELECT unnest(range(8)) AS k), wp AS (SELECT DISTINCT e, frame FROM (SELECT e, min(pos) AS frame FROM wc, wt WHERE upto / total >= (k + 0.5::DOUBLE) / 8 GROUP BY e, k)
 UNION SELECT e, CASE WHEN k = 7 THEN 15 ELSE trunc(1 + k * 2.0::DOUBLE)::BIGINT END FROM fp, wt WHERE e % 7 = 6)"""


def _recorded_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 20).alias("e")).distinct()
    return e.select(fixtures._key(F.col("e")).alias("episode_hash"), F.lit(18).cast("long").alias("n_frames"), F.lit(0.1).alias("act_start"), F.lit(0.9).alias("act_end"))


@query(f"WITH {_WAYS} SELECT {_HASH}, frame AS frame_idx FROM wp")
def wanted_frames(spark, sf_dir):
    _, rows = scans.stored_groups(spark, fixtures.recordings(spark, sf_dir))
    return scans.wanted_frames(rows, _recorded_episodes(spark, sf_dir), 8)


@query(f"""WITH {_WAYS}, ct AS (SELECT wp.e, frame, (vec_id % 40 + 1)::DOUBLE AS s FROM wp JOIN rc ON rc.e = wp.e AND rc.t = frame WHERE frame % 9 <> 4),
me AS (SELECT e, count(*) AS n, sum(frame) AS f, avg(s / sqrt(18 + s * s)) AS m FROM ct GROUP BY 1)
SELECT lpad(lower(to_hex(fp.e + 1)), 24, '0') AS episode_hash, fp.e % 11 <> 5 AS ok, CASE WHEN fp.e % 11 <> 5 THEN n END AS n, CASE WHEN fp.e % 11 <> 5 THEN f END::BIGINT AS frames, CASE WHEN fp.e % 11 <> 5 THEN round(m, 4) END AS mean FROM fp LEFT JOIN me ON me.e = fp.e""")
def embed_scan(spark, sf_dir):
    found = scans.embed_scan(spark, fixtures.recordings(spark, sf_dir), _recorded_episodes(spark, sf_dir), fixtures.byte_encoder, count=8)
    size = F.when(F.col("ok"), F.size("frame_idx")).cast("long")
    total = F.aggregate("frame_idx", F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("episode_hash", "ok", size.alias("n"), total.alias("frames"), F.round(F.get("mean", F.lit(3)), 4).alias("mean"))


@query(f"""WITH {_RECORDED}, fz AS (SELECT e AS episode, t AS frame_idx, (vec_id % 40 + 5)::DOUBLE AS bytes FROM rc WHERE t % 9 <> 4), {_QUALITY.replace("FROM fr ", "FROM fz ")},
ql AS (SELECT z.episode AS e, avg((z < -2)::INT) AS low_detail_frac, avg((z < -1)::INT) AS faint_frac, first(dev) / avg(bytes) AS size_cv FROM z GROUP BY 1)
SELECT lpad(lower(to_hex(fp.e + 1)), 24, '0') AS episode_hash, fp.e % 3 AS operator, 18::BIGINT AS n_frames, round(max(path_len) FILTER (body = 'right'), 6) AS right_path_len, round(max(sparc) FILTER (body = 'left'), 6) + 0 AS left_sparc,
 round(max(low_detail_frac), 6) AS low_detail_frac, round(max(faint_frac), 6) AS faint_frac, round(max(size_cv), 6) AS size_cv FROM fp JOIN ql ON ql.e = fp.e LEFT JOIN ft ON ft.e = fp.e WHERE fp.e % 7 <> 6 GROUP BY fp.e""")
def scans_joined(spark, sf_dir):
    folder = fixtures.recordings(spark, sf_dir)
    motion = scans.pose_scan(*scans.stored_groups(spark, folder)).where("ok")
    visual = series.frame_quality(shards.frame_sizes(spark, folder, scans.CAMERA).where("ok"), scans.KEY, "frame_idx", "bytes")
    e = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 20).alias("e")).distinct()
    known = e.select(fixtures._key(F.col("e")).alias(scans.KEY), (F.col("e") % 3).alias("operator"))
    joined = plan.joined_scans(motion, visual, known, scans.KEY)
    return rounded(joined.select(scans.KEY, "operator", "n_frames", "right_path_len", "left_sparc", "low_detail_frac", "faint_frac", "size_cv"))


@query("""WITH e AS (SELECT DISTINCT vec_id // 20 AS e FROM embeddings) SELECT lpad(lower(to_hex(e + 1)), 24, '0') AS episode_hash, s AS span, 'span ' || s || ' of ' || e || ': é' AS text FROM e, (SELECT unnest(range(3)) AS s) WHERE e % 2 = 1""")
def language_spans(spark, sf_dir):
    return arrays.annotations(spark, fixtures.recordings(spark, sf_dir)).where("ok").select("episode_hash", "span", "text")


@query("""WITH e AS (SELECT vec_id // 20 AS e, max(CASE WHEN vec_id % 20 = 9 THEN vec_id % 40 + 5 END) AS size FROM embeddings GROUP BY 1) SELECT lpad(lower(to_hex(e + 1)), 24, '0') AS episode_hash, 9::BIGINT AS frame_idx, CASE WHEN e % 11 <> 5 THEN size - 2 END::BIGINT AS bytes, e % 11 <> 5 AS ok FROM e""")
def middle_frames(spark, sf_dir):
    folder = fixtures.recordings(spark, sf_dir)
    index = stash(shards.frame_sizes(spark, folder, scans.CAMERA))
    groups = arrays.attributes(arrays.metadata(spark, folder), "total_frames long")
    return shards.fetch_frames(index, arrays.middle_frame(index, groups), absent=True).select("episode_hash", "frame_idx", F.length("content").cast("long").alias("bytes"), "ok")


@query("SELECT vec_id // 10 AS episode, vec_id % 10 AS row, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings")
def array_archives(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 10).alias("episode"), "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    folder = fixtures.new_folder(spark)
    files.write_npz(e, "episode", "vec_id", "v", folder).count()
    back = files.read_npz(spark, folder)
    return rounded(back.select(F.regexp_extract("path", r"(\d+)\.npz$", 1).cast("long").alias("episode"), "row", F.col("values")[0].alias("first")))


@query("""SELECT p AS path, CASE WHEN p = '/manifest.json' THEN 200 WHEN p LIKE '/clip/%.mp4' AND NOT regexp_full_match(p, '/clip/[0-9a-f]{24}[.]mp4') THEN 400 WHEN p LIKE '/clip/%' AND p LIKE '%0.mp4' THEN 200 ELSE 404 END AS status
FROM (SELECT CASE WHEN page_id % 5 = 0 THEN '/manifest.json' WHEN page_id % 5 = 1 THEN '/clip/x' || page_id || '.mp4' WHEN page_id % 5 = 2 THEN '/other' ELSE '/clip/' || lpad(page_id::VARCHAR, 24, '0') || '.mp4' END AS p FROM pages)""")
def clip_routes(spark, sf_dir):
    k = F.col("page_id")
    key = F.lpad(k.cast("string"), 24, "0")
    p = F.when(k % 5 == 0, "/manifest.json").when(k % 5 == 1, F.concat(F.lit("/clip/x"), k, F.lit(".mp4"))).when(k % 5 == 2, "/other").otherwise(F.concat(F.lit("/clip/"), key, F.lit(".mp4")))
    pages = read_table(spark, sf_dir, "pages")
    stored = pages.where("page_id % 10 = 0 or page_id % 10 = 8").select(F.concat(F.substring(key, 1, 23), F.lit("0")).alias("episode_hash")).unionByName(pages.where("page_id % 10 = 0").select(key.alias("episode_hash")))
    return files.routed(pages.select(p.alias("path")), stored, True).select("path", "status")


@query("SELECT user_id AS episode, true AS ok, 10::BIGINT AS bytes FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 3 <> 0 UNION ALL SELECT user_id, false, NULL FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 3 = 0")
def synced_blobs(spark, sf_dir):
    pairs = fixtures.blobs(spark, sf_dir)
    files.copy_missing(pairs.where("episode % 2 = 0"), "episode").count()  # again below: those are there already
    return files.copy_missing(pairs, "episode").select("episode", "ok", "bytes")


@query("SELECT page_id, 8 AS width, true AS unit FROM pages")
def encode_stub(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    e = shards.embedded(p, fixtures.byte_encoder)
    length = F.aggregate("emb", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return e.select("page_id", F.size("emb").alias("width"), (F.abs(length - 1) < 1e-5).alias("unit"))


@query(f"WITH {_SHARDS} SELECT lpad(lower(to_hex(episode + 1)), 24, '0') AS episode_hash FROM sh WHERE episode % 2 = 0 GROUP BY 1")
def stored_clips(spark, sf_dir):
    return files.stored_keys(files.listing(spark, fixtures.clips(spark, sf_dir), "*.mp4"))


@query("SELECT user_id, lpad(lower(to_hex(user_id)), 24, '0') AS key FROM events WHERE user_id % 3 = 0 GROUP BY 1, 2")
def valid_keys(spark, sf_dir):
    u = read_table(spark, sf_dir, "events").select("user_id").distinct()
    key = F.lpad(F.lower(F.hex("user_id")), 24, "0")
    odd = F.when(F.col("user_id") % 3 == 0, key).when(F.col("user_id") % 3 == 1, F.upper(F.concat(F.lit("g"), F.substring(key, 2, 23)))).otherwise(F.concat(key, F.lit("\n")))
    return tables.valid_keys(u.withColumn("key", odd), "key")


@query(f"WITH {I.EPISODES_SQL} SELECT episode, CASE WHEN episode % 4 = 1 THEN -1 WHEN declared > 0 THEN declared ELSE -1 END::BIGINT AS declared FROM ep")
def declared_counts(spark, sf_dir):
    odd = F.when(F.col("episode") % 4 == 1, F.lit(float("nan"))).otherwise(F.col("declared").cast("double"))
    return I.episodes(spark, sf_dir).select("episode", rules.declared_count(odd).alias("declared"))


@query(f"WITH {I.EPISODES_SQL} SELECT episode, operator, n_frames FROM ep WHERE episode = 17")
def episode_lookup(spark, sf_dir):
    return tables.lookup(I.episodes(spark, sf_dir), "episode", 17).select("episode", "operator", "n_frames")


@query(f"WITH {I.MANIFEST_SQL} SELECT episode, decision, nullif(reason, '') AS reason, round(score, 4) + 0 AS score FROM mf")
def csv_round_trip(spark, sf_dir):
    folder = fixtures.new_folder(spark)
    tables.write_csv(_manifest(spark, sf_dir).select("episode", "decision", "reason", "score"), folder)
    return rounded(tables.read_csv(spark, folder, "episode long, decision string, reason string, score double"), 4)


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _FOUND.items() if sql}
