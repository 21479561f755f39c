"""Hand-made cases at the edges of each operator."""

import functools
import gzip
import http.server
import json
import threading

import numpy as np
import pandas as pd
import pytest
import zstandard
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnweave.functions import scalars
from tarnweave.operators import ablation, catalog, ranking, reports, robust, rules, scoring, selection, series, statistics
from tarnweave.plans import scans
from tarnweave.sources import arrays, files, shards, tables


def test_constant_sizes_and_faint_runs(spark):
    rows = [("same", i, 5.0) for i in range(5)] + [("one", 0, 3.0)]
    runs = [9.0] * 20 + [0.0] * 2 + [9.0] + [0.0] * 4 + [9.0] * 3
    df = spark.createDataFrame(rows + [("run", i, v) for i, v in enumerate(runs)], "episode string, frame_idx int, bytes double")
    got = {r["episode"]: r for r in series.frame_quality(df).collect()}
    assert got["same"]["size_cv"] == pytest.approx(1 / 5) and got["same"]["longest_faint_run"] == 0
    assert got["one"]["max_step_drop"] == 0 and got["run"]["longest_faint_run"] == 4


def test_still_and_flipped_pose(spark):
    q = [1.0, 0.0, 0.0, 0.0]
    rows = [("still", i, 0.0, 0.0, 0.0, [(-1.0) ** i * x for x in q], 1 / 30) for i in range(6)]
    df = spark.createDataFrame(rows, "episode string, frame_idx int, x double, y double, z double, q array<double>, dt double")
    got = series.motion_features(df, ["episode"]).first()
    assert got["straightness"] == 0 and got["ang_path"] == 0 and (got["act_start"], got["act_end"]) == (0, 1)


def test_spectral_smoothness_against_a_transform(spark):
    rng = np.random.default_rng(2)
    profiles = {"short": [1.0, 2.0, 3.0], "still": [0.0] * 50, "bell": list(np.exp(-((np.arange(64) - 30) ** 2) / 80)), "rough": list(rng.random(65)), "four": [1.0, 5.0, 2.0, 4.0]}
    rows = [(k, i, float(x)) for k, v in profiles.items() for i, x in enumerate(v)] + [("bell", 99, None)]
    got = {r["e"]: r["sparc"] for r in series.spectral_smoothness(spark.createDataFrame(rows, "e string, frame_idx int, speed double"), "e").collect()}
    assert got["short"] == got["still"] == 0
    for k in ("bell", "rough", "four"):
        v = np.array(profiles[k])
        size = 16 * 2 ** int(np.ceil(np.log2(len(v))))
        a = np.abs(np.fft.rfft(v, size))
        a, f = a / a.max(), np.arange(size // 2 + 1) * 30.0 / size
        loud = [i for i in range(len(f)) if f[i] <= 10 and a[i] >= 0.05]
        arc = sum(np.hypot((f[i] - f[i - 1]) / (f[loud[-1]] - f[loud[0]]), a[i] - a[i - 1]) for i in range(loud[0] + 1, loud[-1] + 1))
        assert got[k] == pytest.approx(-arc, abs=1e-9)


def test_equal_motion_of_ten_frames(spark):
    speeds = [(0, i, 1.0 if i in (3, 4) else 0.0) for i in range(10)] + [(1, i, 1.0) for i in range(3)] + [(3, i, 1.0) for i in range(10)]
    spans = spark.createDataFrame([(0, 0, 10), (1, 2, 6), (2, 5, 5), (3, 4, 6)], "e long, lo long, hi long")
    got = series.equal_motion_frames(spans, spark.createDataFrame(speeds, "e long, t int, v double"), "e", "t", "v").collect()
    frames = {e: sorted(r["frame"] for r in got if r["e"] == e) for e in range(4)}
    assert frames == {0: [3, 4], 1: [2, 3, 4, 5, 6], 2: [5, 6], 3: [4, 5]}


def test_padded_stamps(spark):
    rows = [("a", i, 1_000_000_000 + i * 100_000_000 if i < 11 else 0) for i in range(15)]
    got = series.true_rate(spark.createDataFrame(rows, "e string, i int, ns long"), "e", "i", "ns").first()
    assert got["fps_true"] == pytest.approx(11.0)


def test_z_scores_of_odd_groups(spark):
    rows = [("a", 1.0)] * 9 + [("a", 1.5), ("a", 1e9), ("lone", 7.0), (None, 3.0)]
    df = scoring.with_robust_z(spark.createDataFrame(rows, "operator string, v double"), {"z": F.col("v")}, "operator")
    z = {(r["operator"], r["v"]): r["z"] for r in df.collect()}
    assert z[("lone", 7.0)] == 0 and z[(None, 3.0)] is None and abs(z[("a", 1e9)]) <= 4


@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=5))
def test_chi2_is_a_survival_function(x):
    for dims in (1, 2, 5, 10):
        p = robust.chi2_sf(np.abs(np.array(x)), dims)
        assert ((p >= 0) & (p <= 1 + 1e-12)).all()


def test_chi2_known_values():
    assert robust.chi2_sf(np.array([3.841459]), 1)[0] == pytest.approx(0.05, abs=1e-6)
    assert robust.chi2_sf(np.array([18.307038]), 10)[0] == pytest.approx(0.05, abs=1e-6)
    assert robust.chi2_sf(np.array([7.814728]), 3)[0] == pytest.approx(0.05, abs=1e-6)


def test_rules_first_match_and_halves(spark):
    rows = [(1, 10, None, None, 0.1), (2, None, 50, None, 1.0), (3, 100, -1, 0.01, 1.0), (4, 100, 100, None, 0.2), (5, 6, 6, None, 0.9)]
    df = spark.createDataFrame(rows, "k int, n long, declared long, dip double, span double")
    reason = rules.integrity_reason(F.col("n"), F.col("declared"), F.col("dip").isNotNull(), F.col("dip"), F.col("span"))
    got = {r[0]: r[1] for r in df.select("k", reason).collect()}
    assert got == {1: "too_short", 2: "frame_count_mismatch", 3: "no_visible_change", 4: "mostly_dead_time", 5: "too_short"}
    assert df.where("k = 5").select(rules.trim_frame(F.lit(0.5), F.col("n"), F.lit("keep"))).first()[0] == 2


def test_labels_ties_and_flags(spark):
    df = spark.createDataFrame([(2.0, 2.0, 3.0), (0.0, None, 1.0)], "ax_a double, ax_b double, ax_c double")
    names = ["ax_a", "ax_b", "ax_c"]
    assert [tuple(r) for r in df.select(rules.failure_label(names), rules.flags(names)).collect()] == [("c+a", "a+b+c"), ("below_average", "")]


def test_staircase_flags_up_to_the_last(spark):
    df = spark.createDataFrame([(1, 0.001), (2, 0.02), (3, 0.024), (4, 0.9), (5, None)], "k int, p double")
    got = {r["k"]: r["flagged"] for r in statistics.benjamini_hochberg(df, "p", "k", 0.05).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False}


def plain_robust_fit(x, starts):
    """Concentration steps over one array from each start, the best made consistent and reweighted."""
    n, p = x.shape
    h = (n + p + 1) // 2
    fit = lambda rows: (rows.mean(axis=0), np.cov(rows, rowvar=False, bias=True))
    far = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    best = (np.inf, None)
    for start in starts:
        rows, last = np.argsort(start(x))[:h], np.inf
        while (det := np.linalg.slogdet(fit(x[rows])[1])[1]) < last - 1e-12:
            last, kept = det, rows
            rows = np.argsort(far(*fit(x[rows])))[:h]
        best = min(best, (last, kept), key=lambda b: b[0])
    d = far(*fit(x[best[1]]))
    d /= np.median(d) / robust.chi2_quantile(0.5, p)
    d = far(*fit(x[d < robust.chi2_quantile(0.975, p)]))
    return best[0], d / (np.median(d) / robust.chi2_quantile(0.5, p))


@pytest.mark.parametrize("subset", [400, 4000])
def test_robust_fit_of_blocks_is_that_of_one_array(spark, monkeypatch, subset):
    monkeypatch.setattr(robust, "SUBSET_ROWS", subset)
    monkeypatch.setattr(robust, "BLOCK_ROWS", 300)
    rng = np.random.default_rng(0)
    x = {0: np.concatenate([rng.standard_normal((1900, 3)) * [1, 2, 5], rng.standard_normal((100, 3)) * 0.1 + 9]), 4: rng.standard_normal((500, 3)) @ rng.standard_normal((3, 3))}
    df = spark.createDataFrame([(c, r.tolist()) for c, rows in x.items() for r in rows], "cluster int, y array<double>")
    groups = robust.Groups(df, 3, 1, 5)
    begun, best, fits = groups.begun(), robust.concentrated(groups), robust.robust_fits(groups)
    drawn = np.concatenate([np.reshape(r["x"], (-1, 3)) for r in groups.drawn().where("cluster = 0").collect()])
    for group, rows in (((0, -1), x[0]), ((4, -1), x[4]), ((0, 0), drawn)):
        det, far = plain_robust_fit(rows, begun[group])
        assert best[group].logdet == pytest.approx(det, abs=1e-9) and np.allclose(fits[group](rows), far)
    assert (fits[0, -1](x[0])[1900:] > 20).all()
    assert len(drawn) == 2000 and set(fits) == {(c, t) for c in x for t in (-1, 0)}


def test_concentration_passes_a_step(spark, monkeypatch):
    monkeypatch.setattr(robust, "SUBSET_ROWS", 400)
    rng, met = np.random.default_rng(1), []
    x = rng.standard_normal((4000, 3)) @ rng.standard_normal((3, 3))
    groups = robust.Groups(spark.createDataFrame([(2, r.tolist()) for r in x], "cluster int, y array<double>"), 3, 0, 5)
    collect = type(groups.real).collect
    monkeypatch.setattr(type(groups.real), "collect", lambda df: met.append(1) or collect(df))
    begun = groups.begun()
    met.clear()
    monkeypatch.setattr(groups, "begun", lambda: {g: list(fits) for g, fits in begun.items()})
    best = robust.concentrated(groups)
    assert best[2, -1].logdet == pytest.approx(plain_robust_fit(x, begun[2, -1])[0], abs=1e-9)
    # the longest chain of steps on one array, and its last, which gains nothing
    steps = 0
    for fit in begun[2, -1]:
        last, n = np.inf, 0
        while (fit := robust.Fit.to(x[np.argsort(fit(x))[: (len(x) + 4) // 2]])).logdet < last - 1e-12:
            last, n = fit.logdet, n + 1
        steps = max(steps, n + 1)
    assert 8 < steps < robust.STEPS and len(met) < 2 * steps


def test_steps_whatever_is_guessed(spark, monkeypatch):
    monkeypatch.setattr(robust, "FEW", 5)
    monkeypatch.setattr(robust, "BLOCK_ROWS", 200)
    rng = np.random.default_rng(4)
    x = {1: rng.standard_normal((900, 2)), 3: np.concatenate([np.full((300, 2), 2.0), rng.standard_normal((99, 2))]), 6: np.full((50, 2), 7.0)}
    groups = robust.Groups(spark.createDataFrame([(c, r.tolist()) for c, rows in x.items() for r in rows], "cluster int, y array<double>"), 2, 0, 0)
    fits = {(c, -1): [robust.Fit(np.array(m), np.eye(2), 0.0) for m in ([0.1, 0.2], [2.0, 2.0])] for c in x}
    want = {}
    for (c, t), two in fits.items():
        for k, fit in enumerate(two):
            far = fit(x[c])
            limit = np.sort(far)[robust.nearest(len(far), 2) - 1]
            want[c, t, k] = limit, robust.Fit.to(x[c][far <= limit])
    for guess in (None, lambda v: (v * 0.9, v * 1.1), lambda v: (v, v), lambda v: (v * 1.1 + 0.1, v * 2 + 1), lambda v: (0.0, v / 2)):
        got = groups.stepped(fits, {name: guess(limit) for name, (limit, _) in want.items()} if guess else {})
        assert set(got) == set(want)
        for name, (limit, fit) in want.items():
            assert got[name][0] == limit and np.allclose(got[name][1].centre, fit.centre)
            assert name[0] == 6 or np.allclose(got[name][1].precision, fit.precision)
            assert got[name][1].logdet == pytest.approx(fit.logdet, abs=1e-9)


def test_ranks_by_refinement(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.standard_normal(1000), np.zeros(40), [3.0] * 30, [1e200]])
    groups = robust.Groups(spark.createDataFrame([(1, [v]) for v in x.tolist()], "cluster int, y array<double>"), 1, 0, 0)
    fit = {(1, -1): [robust.Fit(np.zeros(1), np.eye(1), 0.0)]}
    square = np.sort(x * x)
    for k in (0, 1, 38, 39, 40, 700, 1069, 1070):
        got = groups.ranked(fit, lambda g, i: g, {(1, -1): k})[1, -1]
        assert got == (square[k], square[min(k + 1, len(x) - 1)])


def test_robust_pvalues_find_masked_outliers(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.standard_normal((180, 3)), rng.standard_normal((20, 3)) * 0.1 + 8])
    rows = [(i, r.tolist(), 0, False) for i, r in enumerate(x)] + [(900 + i, [1.0, 2.0, 3.0], 1, False) for i in range(12)] + [(-1, [0.0] * 3, 2, True)]
    found, null = statistics.cluster_pvalues(spark.createDataFrame(rows, "k long, y array<double>, cluster int, rare boolean"), "k", 3, 1)
    p = {r["k"]: r["p"] for r in found.collect()}
    null = np.array([r["p"] for r in null.collect()])
    assert len(null) == 20 * 212 and len(p) == 213 and p[-1] == 0
    assert (null < 0.01).mean() == pytest.approx(0.01, abs=0.003)
    assert all(p[k] < 1e-6 for k in range(180, 200)) and np.mean([p[k] < 0.01 for k in range(180)]) < 0.06
    assert all(p[900 + i] == 1 for i in range(12))


@pytest.mark.parametrize(("cells", "few"), [(1024, 512), (64, 3)])
def test_quantiles_by_refinement(spark, cells, few):
    rng = np.random.default_rng(3)
    rows = [(rng.choice(["a", "b", None], p=[0.9, 0.07, 0.03]), float(v), float(int(v * 3)), None) for v in rng.standard_normal(700) ** 3]
    rows += [("a", 1e300, None, None), ("b", -1e300, float("nan"), None), ("c", None, None, None), ("d", 5.0, 1.0, None), ("a", float("inf"), 7.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double")
    values, shares = {c: F.col(c) for c in "xyz"}, [0.0, 0.25, 0.5, 0.9, 1.0]
    clean = lambda g, i: np.array([r[i] for r in rows if (g is ... or r[0] == g) and r[i] is not None and r[i] == r[i]])
    for by in ([], ["g"]):
        found = selection.order_statistics(selection.long_form(df, list(values.values()), by), by, shares, cells, few).collect()
        got = {(r["g"] if by else ..., "xyz"[r["j"]]): r for r in found}
        groups = ["a", "b", "c", "d", None] if by else [...]
        assert set(got) == {(g, c) for g in groups for i, c in enumerate("xyz", 1) if len(clean(g, i))}
        for (g, c), r in got.items():
            held = np.sort(clean(g, "xyz".index(c) + 1))
            assert (r["s"]["n"], r["s"]["lo"], r["s"]["hi"]) == (len(held), held[0], held[-1])
            for s, q in zip(shares, r["q"], strict=True):
                at = s * (len(held) - 1)
                low, high = held[[int(at), min(int(at) + 1, len(held) - 1)]]
                assert q == pytest.approx(low * (1 - at % 1) + (high * (at % 1) if at % 1 else 0), rel=1e-12)
    one = selection.quantiles(df, values, shares, cells, few).first()
    assert one["z_n"] == 0 and one["z_2"] is None and one["y_n"] == len(clean(..., 2)) and one["y_4"] == clean(..., 2).max()


def test_gram_gives_the_ridge_solution(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 2))
    y = x @ [1.5, -2.0] + 0.3
    df = spark.createDataFrame([("e", *map(float, r), float(t)) for r, t in zip(x, y, strict=True)], "e string, a double, b double, y double")
    sums = ablation.gram(df, "e", ["a", "b"], ["y"]).first().asDict()
    w = ablation.solve(sums, 2, 1)
    full = np.column_stack([np.ones(40), x])
    assert np.allclose(w[:, 0], np.linalg.solve(full.T @ full + 1e-3 * 40 * np.eye(3), full.T @ y))
    assert ablation.squared_error(sums, w) == pytest.approx(np.mean((full @ w[:, 0] - y) ** 2), abs=1e-9)


def test_history_windows_leave_out_the_last_start(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(30)] + [("b", i, 0.0) for i in range(17)], "e string, t int, v double")
    counts = {h: series.history_windows(df, "e", "t", ["v"], h, 15).groupBy("e").count().collect() for h in (1, 3)}
    assert {(h, r[0]): r[1] for h, rows in counts.items() for r in rows} == {(1, "a"): 14, (1, "b"): 1, (3, "a"): 12}


def test_crosstab_of_columns_that_are_there(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "g string, v string")
    assert sorted(map(tuple, catalog.crosstab(df, "g", "v", ["x", "y"]).collect())) == [("a", 1, 1), ("b", 0, 0)]
    none = catalog.crosstab(df, "g", "w", ["x"])
    assert none.columns == ["g", "w_x"] and none.count() == 0


def test_lookup_takes_the_first_of_several(spark):
    df = spark.createDataFrame([("k", 2), ("k", 1), ("l", 0)], "key string, n int")
    assert tables.lookup(df, "key", "k").collect() == [("k", 1)]


def test_empty_manifest_summary(spark):
    empty = spark.createDataFrame([], "decision string, reason string, operator string")
    got = reports.summary(empty, "operator").first()
    assert got["drop_pct"] == got["keep_pct"] == got["operators"] == 0
    nobody = spark.createDataFrame([("keep", None, None), ("drop", "x", "a")], "decision string, reason string, operator string")
    assert tuple(reports.summary(nobody, "operator").first())[-2:] == (1, 2)


def test_shard_index_and_frames(spark, tmp_path):
    table = np.full((1000, 2), 2**64 - 1, "<u8")
    body = b"xx\xff\xd8\xffabc" + zstandard.ZstdCompressor().compress(b"12\xff\xd8\xffdef")
    table[0], table[3] = (0, 8), (8, len(body) - 8)
    key = "a" * 24
    folder = tmp_path / ("b" * 24 + "c") / key
    folder.mkdir(parents=True)
    (folder / "0").write_bytes(body + table.tobytes() + b"crc!")
    (folder / "10").write_bytes(body + table.tobytes() + b"crc!")
    (folder / "1").write_bytes(b"short")
    index = shards.frame_sizes(spark, str(tmp_path))
    got = index.collect()
    assert sorted((r["frame_idx"], r["bytes"]) for r in got if r["ok"]) == [(0, 8), (3, len(body) - 8), (10000, 8), (10003, len(body) - 8)]
    assert [r["episode_hash"] for r in got if not r["ok"]] == [key] and {r["episode_hash"] for r in got} == {key}
    wanted = spark.createDataFrame([(key, 0), (key, 1), (key, 10003)], "episode_hash string, frame_idx long")
    frames = {r["frame_idx"]: bytes(r["content"]) for r in shards.fetch_frames(index, wanted).collect()}
    assert frames == {0: b"\xff\xd8\xffabc", 10003: b"\xff\xd8\xffdef"}
    content = spark.createDataFrame([(key, 0, b"ab"), (key, 1, b"")], "episode_hash string, frame_idx long, content binary")
    pictures = shards.decoded(content, lambda raw: np.frombuffer(raw, np.uint8).reshape(1, -1) if raw else 1 / 0).collect()
    assert [(r["height"], r["width"], r["pixels"]) for r in sorted(pictures, key=lambda r: r["frame_idx"])] == [(1, 2, b"ab"), (None, None, None)]
    assert files.listing(spark, str(tmp_path / "none")).count() == 0


def test_sizes_explode_and_arrays_fail_by_row(spark, tmp_path):
    frames, rest = shards.exploded_sizes(spark.createDataFrame([("e", [5, 7])], "k string, sizes array<long>"), "k")
    assert [tuple(r) for r in frames.orderBy("frame_idx").collect()] == [("e", 0, 5), ("e", 1, 7)] and rest.columns == ["k"]
    root = tmp_path / ("d" * 24 + ".zarr")
    meta = {"zarr_format": 3, "node_type": "array", "shape": [3, 2], "data_type": "int64", "chunk_grid": {"configuration": {"chunk_shape": [2, 2]}}, "codecs": [{"name": "bytes"}]}
    for name, codec in (("good", "bytes"), ("bad", "blosc")):
        (root / name / "c" / "0").mkdir(parents=True)
        (root / name / "c" / "1").mkdir()
        (root / name / "zarr.json").write_text(json.dumps(meta | {"codecs": [{"name": codec}]}))
        for c in (0, 1):
            (root / name / "c" / str(c) / "0").write_bytes(np.arange(4, dtype="<i8").tobytes())
    (root / "zarr.json").write_text('{"node_type": "group", "attributes": {"fps": 30}}')
    got = arrays.read_arrays(spark, str(tmp_path)).collect()
    assert sorted((r["row"], r["values"]) for r in got if r["ok"]) == [(0, [0, 1]), (1, [2, 3]), (2, [0, 1])]
    assert len([r for r in got if not r["ok"] and "blosc" in r["error"]]) == 1
    shown = {r["array"]: r for r in arrays.described(spark, str(tmp_path)).collect()}
    assert shown["good"]["head"] == [0, 1] and "fps" in shown[""]["attributes"]


def write_array(root, name, table, chunks, codecs=("bytes",), fill=0, absent=(), **more):
    """A stored array; chunks beyond its edge are padded."""
    meta = {"zarr_format": 3, "node_type": "array", "shape": table.shape, "data_type": str(table.dtype), "chunk_grid": {"configuration": {"chunk_shape": chunks}}}
    meta |= {"codecs": [{"name": c} for c in codecs], "fill_value": fill} | more
    (root / name).mkdir(parents=True, exist_ok=True)
    (root / name / "zarr.json").write_text(json.dumps(meta))
    for at in np.ndindex(*(-(-n // c) for n, c in zip(table.shape, chunks, strict=True))):
        if at not in absent:
            part = table[tuple(slice(i * c, (i + 1) * c) for i, c in zip(at, chunks, strict=True))]
            raw = np.pad(part, [(0, c - n) for n, c in zip(part.shape, chunks, strict=True)]).tobytes()
            for c in codecs[1:]:
                raw = {"zstd": zstandard.ZstdCompressor().compress, "gzip": gzip.compress, "crc32c": lambda x: x + b"sum!"}.get(c, bytes)(raw)
            place = root / name / "c" / "/".join(map(str, at))
            place.parent.mkdir(parents=True, exist_ok=True)
            place.write_bytes(raw)


def test_arrays_of_any_chunk_grid(spark, tmp_path):
    rng = np.random.default_rng(4)
    tables = {"grid": rng.standard_normal((11, 7)), "cube": rng.integers(0, 99, (5, 3, 4)).astype("<i4"), "line": np.arange(9.0), "gaps": rng.standard_normal((8, 6)).astype("<f4")}
    for k, key in enumerate(("a" * 24, "b" * 24)):
        root = tmp_path / f"{key}.zarr"
        write_array(root, "grid", tables["grid"] + k, (4, 3), ("bytes", "zstd", "crc32c"))
        write_array(root, "cube", tables["cube"], (2, 2, 3), ("bytes", "gzip"))
        write_array(root, "nested/line", tables["line"], (4,))
        write_array(root, "gaps", tables["gaps"], (3, 4), fill="NaN", absent={(0, 1), (2, 0)})
        (root / "zarr.json").write_text(json.dumps({"node_type": "group", "attributes": {"total_frames": 10} if k else {}}))
    gaps = tables["gaps"].astype(float)
    gaps[:3, 4:], gaps[6:, :4] = np.nan, np.nan
    whole = {"grid": tables["grid"], "cube": tables["cube"].reshape(5, -1), "nested/line": tables["line"].reshape(-1, 1), "gaps": gaps}
    rows = arrays.read_arrays(spark, str(tmp_path))
    got = {(r["episode_hash"], r["array"], r["row"]): r["values"] for r in rows.collect()}
    expected = {(key, n, i): (v + k if n == "grid" else v).tolist() for k, key in enumerate(("a" * 24, "b" * 24)) for n, x in whole.items() for i, v in enumerate(x[: 10 if k else None])}
    assert set(got) == set(expected) and all(np.array_equal(got[k], expected[k], equal_nan=True) for k in got)
    # what the filters leave out isn't read: it would fail
    (tmp_path / ("a" * 24 + ".zarr") / "grid" / "c" / "0" / "0").write_bytes(b"broken")
    (tmp_path / ("b" * 24 + ".zarr") / "grid" / "zarr.json").write_text("broken")
    some = rows.where((F.col("array") == "grid") & (F.col("episode_hash") == "a" * 24) & (F.col("row") >= 4) & (F.col("row") < 9))
    assert sorted((r["row"], r["values"], r["ok"]) for r in some.collect()) == [(i, tables["grid"][i].tolist(), True) for i in range(4, 9)]
    assert {(r["episode_hash"][0], r["array"], r["ok"]) for r in rows.where("not ok").collect()} == {("a", "grid", False), ("b", "grid", False)}
    assert arrays.read_arrays(spark, str(tmp_path / "none")).count() == 0


def test_frames_share_reads_and_fail_alone(spark, tmp_path):
    body, table = b"", np.full((1000, 2), 2**64 - 1, "<u8")
    for i in range(60):
        frame = b"no picture" if i == 7 else b"len!\xff\xd8\xff" + bytes([i]) * 50
        frame = zstandard.ZstdCompressor().compress(frame) if i % 2 else frame
        table[i] = len(body), len(frame)
        body += frame + (b"." * 900 if i == 29 else b"")
    keys = ["a" * 24, "b" * 24]
    for key in keys:
        (tmp_path / key / "cam" / "c").mkdir(parents=True)
        (tmp_path / key / "cam" / "c" / "0").write_bytes(body + table.tobytes() + b"crc!")
        (tmp_path / key / "other").write_bytes(b"no shard")
    index = shards.frame_sizes(spark, str(tmp_path), "cam")
    wanted = spark.createDataFrame([(k, i) for k in keys for i in [*range(5, 25), 40, 41, 999]], "episode_hash string, frame_idx long")
    got = [r for r in shards.fetch_frames(index, wanted, gap=64).collect()]
    assert len(got) == 44 and [(r["frame_idx"], r["ok"]) for r in got if not r["ok"]] == [(7, False)] * 2
    assert all(bytes(r["content"]) == b"\xff\xd8\xff" + bytes([r["frame_idx"]]) * 50 for r in got if r["ok"])
    reads = [r["read"] for r in got if r["read"]]
    sizes = table[:60, 1].astype(int)
    assert len(reads) == 4 and sum(reads) == 2 * (sizes[5:25].sum() + sizes[40:42].sum())
    assert sum(r["read"] > 0 for r in shards.fetch_frames(index, wanted, gap=1 << 20).collect()) == 2
    lost = index.withColumn("path", F.when(F.col("episode_hash") == keys[1], F.lit(str(tmp_path / "gone"))).otherwise(F.col("path")))
    assert {(r["episode_hash"][0], r["ok"]) for r in shards.fetch_frames(lost, wanted).where("frame_idx <> 7").collect()} == {("a", True), ("b", False)}


def plain_box(u, v, depth, width, height):
    seen = [(a, b) for a, b, d in zip(u, v, depth, strict=True) if d > 0.01 and -width < a < 2 * width]
    if len(seen) < 4:
        return None
    x, y = zip(*seen, strict=True)
    side = min(max(1.8 * max(max(x) - min(x), max(y) - min(y)), 96.0), min(width, height))
    left = min(max(np.mean(x) - side / 2, 0.0), width - side)
    top = min(max(np.mean(y) - side / 2, 0.0), height - side)
    return int(left), int(top), int(left + side), int(top + side)


def test_embedding_scan_of_cropped_pictures(spark, tmp_path):
    """Stored groups and shards through reading, cropping and encoding, against plain Python."""
    rng, n, w, h = np.random.default_rng(6), 24, 300, 200
    lens = [[90.0, 0.0, 150.0, 0.0], [0.0, 90.0, 100.0, 0.0], [0.0, 0.0, 1.0, 0.0]]
    head = np.tile([0.0, 0, 0, 1, 0, 0, 0], (n, 1))
    points = rng.normal([0.1, 0.0, 1.0], 0.25, (n, 21, 3))
    points[5] = -1.0  # behind the camera
    hand = np.cumsum(rng.random((n, 7)), axis=0)
    pictures = rng.integers(0, 255, (n, h, w), dtype=np.uint8)
    keys = ["a" * 24, "b" * 24, "c" * 24, "d" * 24]
    for key in keys:
        root = tmp_path / key
        write_array(root, "right.obs_ee_pose", hand, (10, 7))
        write_array(root, "obs_head_pose", head, (10, 4))
        write_array(root, "left.obs_keypoints", points.reshape(n, 63), (7, 63))
        (root / "zarr.json").write_text(json.dumps({"node_type": "group", "attributes": {"total_frames": n, "intrinsics": {"front_1": lens}}}))
        (root / "images.front_1" / "c").mkdir(parents=True)
        table, body = np.full((1000, 2), 2**64 - 1, "<u8"), b""
        for i in range(n):
            if key != "d" * 24 or i == 999:
                frame = b"\xff\xd8\xff" + (pictures[i].tobytes() if key != "c" * 24 else b"short")
                table[i] = len(body), len(frame)
                body += frame
        (root / "images.front_1" / "c" / "0").write_bytes(body + table.tobytes() + b"crc!")
    write_array(tmp_path / keys[1], "right.obs_ee_pose", hand, (10, 7), ("bytes", "blosc"))

    def decode(raw):
        return np.frombuffer(raw[3:], np.uint8).reshape(200, 300)

    def make():
        return lambda content, height, width: np.array([[len(c), a, b, np.frombuffer(bytes(c), np.uint8).sum()] for c, a, b in zip(content, height, width, strict=True)], float)

    episodes = spark.createDataFrame([(k, n, 0.0, 1.0) for k in keys] + [("e" * 24, 9, 0.0, 1.0)], "episode_hash string, n_frames long, act_start double, act_end double")
    got = {r["episode_hash"][0]: r for r in scans.embed_scan(spark, str(tmp_path), episodes, make, decode, hand_crop=True, count=6).collect()}
    assert set(got) == set("abcd") and {k: r["ok"] for k, r in got.items()} == {"a": True, "b": True, "c": False, "d": False}
    way = np.cumsum(np.sqrt((np.diff(hand[:, :3], axis=0) ** 2).sum(axis=1)))
    frames = {"a": sorted({int(np.searchsorted(way / way[-1], (k + 0.5) / 6)) for k in range(6)}), "b": sorted({int(k * 23 / 5) for k in range(6)})}
    for key, picked in frames.items():
        assert got[key]["frame_idx"] == picked
        cut = 0
        for i, emb in zip(picked, got[key]["emb"], strict=True):
            p = points[i]
            box = plain_box(90 * p[:, 0] / p[:, 2] + 150, 90 * p[:, 1] / p[:, 2] + 100, p[:, 2], w, h)
            part = pictures[i] if box is None else pictures[i][box[1] : box[3], box[0] : box[2]]
            cut += box is not None
            v = np.array([part.size, *part.shape, part.sum()], float)
            assert np.allclose(emb, v / np.linalg.norm(v), atol=1e-6)
        assert got[key]["cropped"] == cut and np.allclose(got[key]["mean"], np.mean(got[key]["emb"], axis=0), atol=1e-6)


@pytest.mark.parametrize("history", [1, 3])
def test_sweep_of_trajectories_against_plain_models(spark, history):
    rng, horizon = np.random.default_rng(8), 5
    tracks = {e: np.cumsum(rng.normal(size=(int(rng.integers(26, 40)), 14)), axis=0) for e in range(60)}
    tracks[60] = rng.normal(size=(30, 7))  # one hand: another width
    tracks[61] = rng.normal(size=(9, 14))  # too short
    rows = spark.createDataFrame([(e, i, r.tolist()) for e, t in tracks.items() for i, r in enumerate(t)], "e long, frame_idx long, values array<double>")
    scores = {e: (e, e % 9, float(rng.normal()), e % 10 == 3) for e in tracks}
    scored = spark.createDataFrame(list(scores.values()), "e long, operator int, score double, hard boolean")
    sums = ablation.gram_arrays(rows, "e", history=history, horizon=horizon)
    swept, full = ablation.sweep_trajectories(sums, scored, "e", "operator", most=2)

    def xy(t):
        n = len(t) - horizon - history
        return np.array([np.concatenate([[1.0], *t[j : j + history]]) for j in range(n)]), np.array([t[j + history - 1 + horizon] - t[j + history - 1] for j in range(n)])

    pairs = {e: xy(tracks[e]) for e in range(60)}
    by = sorted(range(9), key=lambda o: (-sum(e % 9 == o for e in pairs), o))
    held = {by[0], by[3]}
    pool = [e for e in pairs if e % 9 not in held]
    best = sorted((e for e in pool if not scores[e][3]), key=lambda e: -scores[e][2])
    stack = lambda es: (np.concatenate([pairs[e][0] for e in es]), np.concatenate([pairs[e][1] for e in es]))
    tx, ty = stack([e for e in pairs if e % 9 in held])

    def error(es):
        x, y = stack(es)
        return ((tx @ np.linalg.solve(x.T @ x + 1e-3 * len(x) * np.eye(x.shape[1]), x.T @ y) - ty) ** 2).mean()

    assert full == pytest.approx(error(pool))
    got = {round(10 * r["keep_frac"]): r for r in swept.collect()}
    for tenth in range(1, 11):
        n = min(len(best), max(len(best) * tenth // 10, 20))
        assert got[tenth]["n"] == n and got[tenth]["quality_mse"] == pytest.approx(error(best[:n]))
    assert got[10]["random_mse"] == pytest.approx(got[10]["quality_mse"])


def test_starts_find_a_rare_far_group(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(30_000, 2)), rng.normal([500, 500], 0.1, (3, 2)), [[-400.0, 300.0]]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, y array<double>")
    for points, weights in statistics.start_points(df, "k", "y", 3, 2, 4):
        assert weights.sum() == len(x) and weights[points[:, 0] > 400].sum() == 3 and weights[points[:, 0] < -300].sum() == 1
    centres = statistics.kmeans(df, "k", "y", [3], 2, 4)[3]
    assert sorted(map(tuple, centres.round(-1).tolist())) == [(-400, 300), (0, 0), (500, 500)]
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "k long, y array<double>")
    assert np.allclose(statistics.kmeans(same, "k", "y", [2], 1)[2], [1, 2])


def test_one_episode_described(spark, tmp_path):
    keys = ["a" * 24, "b" * 24]
    for k, key in enumerate(keys):
        root = tmp_path / key
        write_array(root, "obs_head_pose", np.arange(70.0).reshape(10, 7) + k, (4, 7))
        write_array(root, "obs_rgb_timestamps_ns", np.array([1, 2, 3, 4, 5, 6, 7, 8, 0, 0]) * (50_000_000 if k else 36_000_000), (10,))
        (root / "zarr.json").write_text(json.dumps({"node_type": "group", "attributes": {"total_frames": 9, "fps": 30.0, "task": "cup"}}))
        (root / "images.front_1" / "c").mkdir(parents=True)
        table = np.full((1000, 2), 2**64 - 1, "<u8")
        body = b"".join(b"\xff\xd8\xff" + bytes([i]) for i in range(9))
        table[:9] = [[4 * i, 4] for i in range(9)]
        (root / "images.front_1" / "c" / "0").write_bytes(body + table.tobytes() + b"crc!")
        spans = [f"take {k}", "é", ""]
        for c, part in enumerate((spans[:2], [spans[2], "padding"])):
            raw = b"".join(len(x.encode()).to_bytes(4, "little") + x.encode() for x in part)
            place = root / "annotations" / "c" / str(c)
            place.parent.mkdir(parents=True, exist_ok=True)
            place.write_bytes(len(part).to_bytes(4, "little") + raw)
        meta = {"node_type": "array", "shape": [3], "data_type": "string", "chunk_grid": {"configuration": {"chunk_shape": [2]}}, "codecs": [{"name": "vlen-utf8"}]}
        (root / "annotations" / "zarr.json").write_text(json.dumps(meta))
    catalog_rows = spark.createDataFrame([(keys[0], "x", None), (keys[1], "y", str(tmp_path / "clip"))], "episode_hash string, operator string, mp4_path string")
    (tmp_path / "clip").write_bytes(b"film")
    found = scans.episode(spark, catalog_rows, str(tmp_path), keys[1])
    assert found["row"].first()["operator"] == "y" and [r["text"] for r in found["spans"].orderBy("span").collect()] == ["take 1", "é", ""]
    rate = found["rates"].first()
    assert rate["fps_true"] == pytest.approx(8 / 0.35) and rate["off"] and rate["fps_attr"] == 30
    middle = found["middle"].first()
    assert (middle["frame_idx"], bytes(middle["content"])) == (4, b"\xff\xd8\xff\x04")
    shown = {r["array"]: r for r in found["arrays"].collect()}
    assert shown["obs_head_pose"]["head"] == [1, 2, 3, 4, 5, 6, 7] and "cup" in shown[""]["attributes"]
    assert not scans.described(spark, str(tmp_path), [keys[0]])["rates"].first()["off"]
    clip = scans.episode(spark, catalog_rows, str(tmp_path), keys[1], str(tmp_path / "cache"))
    assert clip["clip"].first()["bytes"] == 4 and (tmp_path / "cache" / f"{keys[1]}.mp4").exists()
    assert "arrays" in scans.episode(spark, catalog_rows, str(tmp_path), keys[0], str(tmp_path / "cache"))
    with pytest.raises(KeyError):
        scans.episode(spark, catalog_rows, str(tmp_path), "c" * 24)
    (tmp_path / keys[0] / "annotations" / "c" / "0").write_bytes(b"\xff" * 9)
    assert [r["ok"] for r in arrays.annotations(spark, str(tmp_path)).where(F.col("episode_hash") == keys[0]).orderBy("span").collect()] == [False, True]


def test_database_is_read_in_parts(spark):
    rows = spark.range(50).selectExpr("id as EPISODE", "id % 3 as LAB")
    url, driver = "jdbc:derby:memory:catalog;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows.write.jdbc(url, "EPISODES", mode="overwrite", properties=driver)
    whole = tables.read_database(spark, url, "EPISODES", driver)
    parts = tables.read_database(spark, url, "EPISODES", driver, "EPISODE", (0, 50), 5)
    assert whole.count() == parts.count() == 50 and parts.rdd.getNumPartitions() == 5
    some = parts.where("LAB = 1")
    assert some.count() == 17 and "LAB" in some._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]


def test_manifest_in_all_forms(spark, tmp_path):
    rows = [(k, d, s, r, 1e-12, "x") for k, d, s, r in (("b", "keep", 1.0, ""), ("c", "keep", None, ""), ("a", "keep", 2.0, ""), ("d", "drop", 5.0, "too_short"))]
    df = spark.createDataFrame(rows, "episode string, decision string, score double, reason string, p double, mp4_path string")
    tables.write_manifest(df, df.where("episode = 'a'").select("episode"), "episode", str(tmp_path))
    lines = [line for f in sorted((tmp_path / "csv").glob("part-*.csv")) for line in f.read_text().splitlines()[1:]]
    assert [x.split(",")[0] for x in lines] == ["d", "a", "b", "c"] and lines[1].split(",")[2:5:2] == ["2.0000", "0.0000"]
    served = {r["episode"]: r for r in tables.read_json(spark, str(tmp_path / "json")).collect()}
    assert served["a"]["has_clip"] and not served["b"]["has_clip"] and served["b"]["reason"] is None and "mp4_path" not in served["a"]
    assert spark.read.parquet(str(tmp_path / "parquet")).first()["p"] == 1e-12
    (tmp_path / "m.json").write_text('[{"episode": "a"}, {"episode": "b"}]')
    assert tables.read_json(spark, str(tmp_path / "m.json")).count() == 2


def test_bounds_hold_and_spare_comparisons(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(c, 0.3, (80, 3)) for c in ([0, 0, 0], [9, 0, 0], [0, 9, 9])] + [rng.normal(4, 3, (1, 3))])
    truth = [*np.repeat([0, 1, 2], 80).tolist(), 3]
    rows = [(i, v.tolist(), t, t % 2, i % 3, 0) for i, (v, t) in enumerate(zip(x, truth, strict=True))]
    df = spark.createDataFrame(rows, "k long, y array<double>, a int, b int, c int, d int")
    exact = {r["label"]: r["silhouette"] for r in statistics.silhouettes(df, "k", "y", ["a", "b", "c", "d"]).collect()}
    bounds = statistics.silhouette_bounds(df, "y", ["a", "b", "c", "d"])
    assert all(lo - 1e-9 <= exact[c] <= hi + 1e-9 for c, (lo, hi) in bounds.items()) and bounds["a"][1] - bounds["a"][0] < 0.1
    compared = []
    whole = statistics.silhouettes
    monkeypatch.setattr(statistics, "silhouettes", lambda df, key, vector, labels: compared.append(labels) or whole(df, key, vector, labels))
    assert statistics.best_labelling(df, "k", "y", ["b", "c", "a"]) == "a" and not compared
    twice = df.withColumn("e", 7 - F.col("a"))
    assert statistics.best_labelling(twice, "k", "y", ["c", "e", "a", "b"]) == "e" and compared == [["e", "a"]]


def test_sync_copies_what_is_new(spark, tmp_path):
    source, target, state = (tmp_path / n for n in ("from", "to", "state"))
    (source / "images").mkdir(parents=True)
    (source / "a").write_bytes(b"abc")
    (source / "images" / "b").write_bytes(b"picture")
    sync = lambda: sorted((r["path"].split("/")[-1], r["ok"], r["bytes"]) for r in files.sync_folder(spark, f"file://{source}", str(target), str(state)).collect())
    assert sync() == [("a", True, 3), ("b", True, 7)] and (target / "images" / "b").read_bytes() == b"picture"
    (target / "a").unlink()
    assert sync() == [("a", True, 3), ("b", True, 7)] and not (target / "a").exists()  # nothing new: nothing copied
    (source / "c").write_bytes(b"12345")
    (target / "d" / "x").mkdir(parents=True)
    (source / "d").write_bytes(b"in the way")
    got = sync()
    assert got[:3] == [("a", True, 3), ("b", True, 7), ("c", True, 5)] and got[3][:2] == ("d", False)


def test_copies_and_the_served_manifest(spark, tmp_path):
    (tmp_path / "in" / "images").mkdir(parents=True)
    (tmp_path / "in" / "poses").write_bytes(b"abc")
    (tmp_path / "in" / "images" / "0").write_bytes(b"12345")
    pairs = files.to_cache(files.listing(spark, str(tmp_path / "in")), "/in/", str(tmp_path / "out"), poses_only=True).withColumn("k", F.lit(1))
    done = files.copy_missing(pairs, "k")
    assert files.copied_bytes(done) == 3 and (tmp_path / "out" / "poses").read_bytes() == b"abc"
    with pytest.raises(FileNotFoundError):
        files.copied_bytes(done.limit(0))
    (tmp_path / "manifest.json").write_text('[{"k": "a", "score": 0.5}, {"k": "b", "score": null}]')
    (tmp_path / "other.json").write_text("{}")
    handler = functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(tmp_path))
    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        url = f"http://127.0.0.1:{server.server_port}"
        rows = files.fetch_manifest(spark, f"{url}/manifest.json", "k string, score double").collect()
        assert sorted((r["k"], r["score"]) for r in rows) == [("a", 0.5), ("b", None)]
        for name in ("other.json", "none.json"):
            with pytest.raises(Exception):
                files.fetch_manifest(spark, f"{url}/{name}", "k string").collect()
        server.shutdown()


def test_running_sums_over_parts(spark):
    df = spark.createDataFrame([(i * 37 % 101, i % 3) for i in range(101)], "x long, g long").repartition(7)
    got = sorted((r["x"], r["at"]) for r in ranking.running(df, ["x"], "at").collect())
    assert got == [(i, i + 1) for i in range(101)]
    by = ranking.running_by(df, "g", [F.desc("x")], "at").collect()
    for g in range(3):
        rows = sorted((r["at"], r["x"]) for r in by if r["g"] == g)
        assert [x for _, x in rows] == sorted((x for _, x in rows), reverse=True) and [a for a, _ in rows] == list(range(1, len(rows) + 1))


def test_tiny_clusters_are_tested_too(spark):
    rows = [(i, [float(i % 2 * 50 + i * 0.1), float(i % 3)]) for i in range(12)] + [(99, None)]
    table = spark.createDataFrame(rows, "k long, x array<double>")
    got = statistics.cluster_outliers(table, "k", "x", restarts=1, ks=range(2, 4)).collect()
    assert len(got) == 12 and all(r["p"] is not None and 0 <= r["p"] <= 1 for r in got)
    none = statistics.cluster_outliers(table.where("k < 2"), "k", "x").collect()
    assert [(r["p"], r["outlier"]) for r in none] == [(None, False)] * 2


def test_manifest_files(spark, tmp_path):
    df = spark.createDataFrame([("k1", "keep", 0.5, ""), ("k2", "drop", None, "too_short")], "k string, decision string, score double, reason string")
    tables.write_csv(df, str(tmp_path / "csv"))
    assert tables.read_csv(spark, str(tmp_path / "csv"), "k string, decision string, score double, reason string").count() == 2
    assert [r[0] for r in tables.json_rows(df).orderBy("json").collect()][1] == '{"k":"k2","decision":"drop","score":null,"reason":"too_short"}'
    with pytest.raises(KeyError):
        tables.lookup(df, "k", "none")


def test_sample_and_membership(spark):
    df = spark.range(100).withColumn("size", F.col("id") % 10)
    assert catalog.stratified_sample(df, "size", "id", 10).count() == 10
    assert [r[0] for r in catalog.random_sample(df, "id", 5).collect()] == [r[0] for r in catalog.random_sample(df.repartition(3), "id", 5).collect()]
    assert spark.range(1).select(scalars.clip(F.lit(None).cast("double"), -4.0, 4.0)).first()[0] is None


def test_silhouette_uses_every_row(spark):
    rng = np.random.default_rng(3)
    n = 5400  # more rows than a sample of 5,000, in blocks that don't come out even
    c = rng.integers(0, 3, n)
    x = rng.normal(size=(n, 3)) + 1.5 * c[:, None]
    x[1:4], c[0:4], c[n - 1] = x[0], 1, 9  # equal points, and a cluster of one
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    means = np.array([d[:, c == k].sum(axis=1) / ((c == k).sum() - (c == k)).clip(1) for k in (0, 1, 2, 9)])
    at = np.searchsorted([0, 1, 2, 9], c)
    a = means[at, np.arange(n)]
    means[at, np.arange(n)] = np.inf
    b = means.min(axis=0)
    expected = np.where(c == 9, 0, (b - a) / np.maximum(a, b)).mean()
    rows = spark.createDataFrame(pd.DataFrame({"k": np.arange(n), "v": x.tolist(), "c": c}))
    assert abs(statistics.silhouette(rows, "k", "v", "c").first()[0] - expected) < 1e-9
    few = spark.createDataFrame([(1, [0.0], "a"), (2, [1.0], "b"), (3, [1.0], "b"), (4, None, "b"), (None, [9.0], "a")], "k long, v array<double>, c string")
    assert statistics.silhouette(few, "k", "v", "c").first()[0] == 0.5
    assert statistics.silhouette(few.limit(0), "k", "v", "c").first()[0] is None


def test_kmeans_finds_separate_groups(spark):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0], [20, 0], [0, 20], [20, 20]])
    x = np.concatenate([c + rng.standard_normal((60, 2)) for c in centres])
    table = spark.createDataFrame(pd.DataFrame({"k": range(240), "y": x.tolist()})).repartition(3)
    found = statistics.kmeans(table, "k", "y", [2, 4], 3)
    assert sorted(map(tuple, np.rint(found[4] / 20).astype(int))) == [(0, 0), (0, 1), (1, 0), (1, 1)] and found[2].shape == (2, 2)
    means = np.array([x[60 * i : 60 * i + 60].mean(axis=0) for i in range(4)])
    assert np.allclose(sorted(map(tuple, found[4])), sorted(map(tuple, means)))
    labelled, k = statistics.choose_clusters(table, "k", "y", restarts=2)
    groups = {r["k"]: r["cluster"] for r in labelled.collect()}
    assert k == 4 and all(len({groups[i] for i in range(60 * g, 60 * g + 60)}) == 1 for g in range(4))


def test_windows_of_a_stream(spark, tmp_path):
    from tarnweave.streaming.events import windowed_counts

    rows = [("a", 1.0, f"2024-01-01 0{h}:{m:02d}:00") for h in range(3) for m in (5, 25, 45)] + [("b", 3.0, "2024-01-01 01:10:00")]
    batch = spark.createDataFrame(rows, "event_type string, value double, ts string").withColumn("ts", F.to_timestamp("ts"))
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    query = windowed_counts(stream).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.table("windows").collect())
    assert got == sorted(tuple(r) for r in windowed_counts(batch).collect()) and len(got) == 4


def test_kmeans_rounds_take_all_runs_through_one_product():
    """Counts, distances and sums as by differences, ties to the first centre, far from the origin too."""
    rng = np.random.default_rng(4)
    shifted = rng.standard_normal((500, 6)) + 1e4
    tied = rng.integers(0, 3, (500, 3)).astype(float)
    for x, runs in ((shifted, [shifted[rng.choice(500, k)] + 0.1 for k in (2, 5, 8)]), (tied, [rng.integers(0, 3, (k, 3)).astype(float) for k in (2, 6)])):
        for centres, got in zip(runs, statistics._moments(x, runs), strict=True):
            square = ((x[:, None] - centres) ** 2).sum(axis=2)
            at, cost = square.argmin(axis=1), square.min(axis=1)
            assert all((a == b).all() for a, b in zip(statistics._nearest(x, centres), (at, cost), strict=True))
            expected = np.zeros((len(centres), x.shape[1] + 2))
            np.add.at(expected, at, np.column_stack([np.ones(len(x)), cost, x]))
            assert (got[:, 0] == expected[:, 0]).all() and np.allclose(got, expected, rtol=1e-7)


def test_kmeans_rounds_read_whole_blocks(spark):
    df = spark.createDataFrame([(i, [float(i % 3), float(i)]) for i in range(300)], "k long, y array<double>").coalesce(1)
    blocks = statistics._packed(df, "k", "y", 0)
    assert blocks.count() == 1
    hashes, rows = next(statistics._unpacked(blocks.toArrow().to_batches()))
    assert len(hashes) == 300 and sorted(rows[:, 1].tolist()) == list(range(300))


def test_distances_of_blocks_are_whole_for_close_and_equal_rows():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((40, 4)) + 1e3
    y = np.concatenate([x[:10], x[10:20] + 1e-9, rng.standard_normal((30, 4))])
    assert np.allclose(statistics._gaps(x, y), np.sqrt(((x[:, None] - y) ** 2).sum(axis=2)), rtol=1e-6, atol=0)
