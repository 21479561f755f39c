"""Inputs of which some groups are cut short, sums that meet their targets, and the like."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnweave.functions import scalars
from tarnweave.operators import series, statistics
from tarnweave.plans import manifest
from tarnweave.plans import queries as curation
from tarnweave.sources import files


@pytest.fixture(scope="module")
def cut_short(tmp_path_factory):
    """Tables of 56 embeddings: the last group of ten and of twenty isn't whole."""
    folder = str(tmp_path_factory.mktemp("cut"))
    rng = np.random.default_rng(5)
    v = rng.normal(size=(56, 64))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype("float32")
    pd.DataFrame({"vec_id": np.arange(56), "embedding": list(v), "label": np.arange(56, dtype="int32") % 3}).to_parquet(f"{folder}/embeddings.parquet")
    return folder


def same(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.execute(curation.oracle_sql()[name]).fetchall()
    columns = [c[0] for c in con.description]
    got = [tuple(r) for r in curation.queries()[name](spark, folder).select(*columns).collect()]
    return sorted(map(str, got)) == sorted(map(str, want))


def test_outliers_among_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.normal(size=4)]) for k in range(30)]
    odd = [(30, [1.0, 2.0]), (31, [1.0, None, 0.0, 0.0]), (32, [1.0, float("nan"), 0.0, 0.0]), (33, []), (34, [float("inf"), 0.0, 0.0, 0.0])]
    table = lambda x: spark.createDataFrame(x, "k long, x array<double>")
    run = lambda x: {r["k"]: r for r in statistics.cluster_outliers(table(x), "k", "x", restarts=1, ks=range(2, 4)).collect()}
    got, plain = run(rows + odd), run(rows)
    assert set(got) == set(range(35)) and all(got[k]["p"] == pytest.approx(plain[k]["p"], abs=1e-6) and got[k]["cluster"] is not None for k in plain)
    assert all(got[k]["cluster"] is None and got[k]["p"] is None and not got[k]["outlier"] for k, _ in odd)


def test_numbers_are_printed_by_their_exact_value(spark):
    values = [9.485 / 7, 1.005, 0.0625, 2.5e-11, -9.995, 0.0, 1e22, 123456.7895, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [tuple(r) for r in df.select(scalars.fixed(F.col("v")), scalars.exponential(F.col("v"))).collect()]
    assert got[0] == ("1.355", "1.35e+0") and got[-1] == ("—", "—")
    for v, (a, b) in zip(values[:-1], got, strict=False):
        assert a == f"{v:.3f}" and float(b) == float(f"{v:.2e}")


def test_motion_that_meets_a_target_in_any_order_of_adding(spark):
    rng, cases = np.random.default_rng(1), []
    for e in range(200):
        cents = rng.integers(1, 5000, 20)
        cents = [*cents, 3 * cents.sum()]  # the first twenty are a quarter of the whole
        cases.append((e, [float(c) / 100 for c in cents]))
    rows = [(e, t, v) for e, w in cases for t, v in enumerate(w)]
    spans = spark.createDataFrame([(e, 0, len(w)) for e, w in cases], "e long, lo long, hi long")
    got = series.equal_motion_frames(spans, spark.createDataFrame(rows, "e long, t int, v double"), "e", "t", "v", count=2)
    first = {r["e"]: r["f"] for r in got.groupBy("e").agg(F.min("frame").alias("f")).collect()}
    assert all(first[e] == 19 for e in range(200))


def test_motion_whose_sums_miss_a_target_as_in_sql(spark, tmp_path):
    cents = [2277, 4294, 1794, 6982, 4322, 385, 2364, 8579, 4725, 3430, 2357, 908]  # 29 / 64 after the sixth, but for rounding
    at = pd.date_range("2024-01-01", periods=len(cents), freq="min").astype("datetime64[us]")
    pd.DataFrame({"event_id": range(len(cents)), "ts": at, "user_id": 1, "value": [c / 100 for c in cents]}).to_parquet(tmp_path / "events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = con.execute(curation.oracle_sql()["equal_motion_frames"]).fetchall()
    got = curation.queries()["equal_motion_frames"](spark, str(tmp_path)).select("episode", "frame").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_pose_arrays_of_a_group_cut_short(spark, cut_short):
    assert same(spark, cut_short, "pose_arrays") and same(spark, cut_short, "described_groups")


def test_middle_frames_by_the_declared_number(spark, cut_short):
    assert same(spark, cut_short, "middle_frames")


def test_a_listing_is_made_by_tasks(spark, tmp_path):
    kept = ["a.mp4", "e1/c/0.mp4", "e1/k=1/_x=2/b.mp4", "é e/5%20.mp4"]
    for name in [*kept, "e1/c/1.npz", ".h/a.mp4", "e1/_tmp/a.mp4", "e1/.a.mp4"]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * len(name))
    found = files.listing(spark, str(tmp_path), "*.mp4")
    assert {(r["path"], r["bytes"]) for r in found.collect()} == {(f"file:{tmp_path}/{n}", len(n)) for n in kept}
    assert found.where("modified > timestamp '2000-01-01'").count() == 4
    assert not found.inputFiles()  # the driver has no index of them
    assert files.listing(spark, f"file://{tmp_path}/e1/c/", "*").count() == 2
    assert files.read_range(found.where("path like '%20.mp4'").first()["path"], 0, 9) == b"x" * 9


def test_silhouettes_of_several_blocks_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(statistics, "BLOCK_ROWS", 50)
    monkeypatch.setattr(statistics, "SLICE_ROWS", 16)
    rng = np.random.default_rng(4)
    x, one, two = rng.normal(size=(230, 3)), rng.integers(0, 4, 230), np.r_[7, np.full(229, 3)]
    rows = [(k, v.tolist(), int(a), int(b)) for k, (v, a, b) in enumerate(zip(x, one, two))]
    got = statistics.silhouettes(spark.createDataFrame(rows, "k long, v array<double>, a int, b int"), "k", "v", ["a", "b"])
    gap = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    for r in got.collect():
        c, worth = {"a": one, "b": two}[r["label"]], []
        for i in range(len(x)):
            mean = {k: gap[i, (c == k) & (np.arange(len(x)) != i)].mean() for k in set(c) if ((c == k) & (np.arange(len(x)) != i)).any()}
            own, other = mean.pop(c[i], None), min(mean.values())
            worth.append(0 if own is None else (other - own) / max(other, own))
        assert r["silhouette"] == pytest.approx(np.mean(worth), abs=1e-12)


def test_the_null_floor_needs_no_scores(spark, monkeypatch):
    monkeypatch.setattr(manifest, "scores", None)
    floor = curation.queries()["keep_drop_floor"](spark, "/root/testdata/sf0.001").collect()
    monkeypatch.undo()
    assert floor == curation.rounded(manifest.keep_drop(*curation._scans(spark, "/root/testdata/sf0.001"), curation._frames_of(spark, "/root/testdata/sf0.001"))[1]).collect()
