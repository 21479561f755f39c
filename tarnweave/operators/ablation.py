"""Closed-form ridge ablation of a ranking, from sums that add up over episodes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.operators.ranking import running, running_by
from tarnweave.session import stash

RIDGE, MIN_STEPS, MIN_SUBSET = 1e-3, 8, 20


def gram(windows: DataFrame, key: str, xs: list[str], ys: list[str]) -> DataFrame:
    """Per episode: n and the sums of products of (1, xs) and ys with one another."""
    names = ["1", *xs]
    value = lambda c: F.lit(1.0) if c == "1" else F.col(c).cast("double")
    g = [F.sum(value(a) * value(b)).alias(f"g_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    h = [F.sum(value(a) * value(y)).alias(f"h_{i}_{k}") for i, a in enumerate(names) for k, y in enumerate(ys)]
    s = [F.sum(value(y) * value(y)).alias(f"s_{k}") for k, y in enumerate(ys)]
    return windows.groupBy(key).agg(F.count("*").alias("n"), *g, *h, *s)


def solve(sums: dict, x: int, y: int) -> np.ndarray:
    """Ridge coefficients, the intercept penalised too, the penalty scaled by the number of rows."""
    g = np.array([[sums[f"g_{min(i, j)}_{max(i, j)}"] for j in range(x + 1)] for i in range(x + 1)], float)
    h = np.array([[sums[f"h_{i}_{k}"] for k in range(y)] for i in range(x + 1)], float)
    return np.linalg.solve(g + RIDGE * sums["n"] * np.eye(x + 1), h)


def squared_error(sums: dict, w: np.ndarray) -> float:
    """Mean squared error of coefficients over rows and dimensions, from the sums alone."""
    x, y = w.shape[0] - 1, w.shape[1]
    g = np.array([[sums[f"g_{min(i, j)}_{max(i, j)}"] for j in range(x + 1)] for i in range(x + 1)], float)
    h = np.array([[sums[f"h_{i}_{k}"] for k in range(y)] for i in range(x + 1)], float)
    s = sum(sums[f"s_{k}"] for k in range(y))
    return float((s - 2 * (w * h).sum() + (w * (g @ w)).sum()) / (sums["n"] * y))


def gram_arrays(trajectories: DataFrame, key: str, order: str = "frame_idx", values: str = "values", history: int = 1, horizon: int = 15) -> DataFrame:
    """(key, width, n, sums): of each trajectory's windows (``history`` rows of all dimensions, and the
    way to ``horizon`` steps on; the last possible start is left out) the sums that a ridge needs,
    end to end: of products of (1, observed), of those with the actions, and of squared actions.

    An episode comes as one array and leaves as one; its windows exist in the worker alone."""
    steps = F.array_sort(F.collect_list(F.struct(order, F.col(values).alias("v"))))
    whole = trajectories.groupBy(key).agg(steps.alias("t")).select(key, F.flatten("t.v").alias("t"), F.size(F.col("t.v")[0]).alias("width"))

    @F.pandas_udf("struct<n long, sums array<double>>")
    def sums(t: pd.Series, width: pd.Series) -> pd.DataFrame:
        rows = []
        for flat, d in zip(t, width, strict=True):
            x = np.asarray(flat, float).reshape(-1, d)
            n = len(x) - horizon - history
            if n < 1:
                rows.append((0, []))
                continue
            seen = np.lib.stride_tricks.sliding_window_view(x, history, axis=0)[:n].transpose(0, 2, 1).reshape(n, -1)
            action = x[history - 1 + horizon :][:n] - x[history - 1 :][:n]
            known = np.column_stack([np.ones(n), seen])
            rows.append((n, np.concatenate([(known.T @ known).ravel(), (known.T @ action).ravel(), [(action**2).sum()]])))
        return pd.DataFrame(rows, columns=["n", "sums"])

    found = whole.select(key, "width", sums("t", "width").alias("s"))
    return found.select(key, F.col("width").cast("long").alias("width"), "s.n", "s.sums").where("n > 0")


def added_arrays(rows: DataFrame, by: str) -> dict:
    """value of ``by`` -> (n, sums) over its rows: partial sums of arrays in each task, then of those."""

    def partial(batches):
        held: dict = {}
        for batch in batches:
            for k, n, s in zip(batch[by].to_pylist(), batch["n"].to_pylist(), batch["sums"], strict=True):
                row = np.concatenate([[n], s.values.to_numpy(zero_copy_only=False)])
                held[k] = held[k] + row if k in held else row
        for k, row in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([int(row[0])], pa.int64()), pa.array([row[1:]])], [by, "n", "sums"])

    schema = f"{by} long, n long, sums array<double>"
    total = rows.select(F.col(by).cast("long").alias(by), "n", "sums").mapInArrow(partial, schema).groupBy(by).applyInArrow(lambda table: next(_added(table, by)), schema)
    return {r[by]: (r["n"], np.array(r["sums"])) for r in total.collect()}  # a row for each model


def _added(table: pa.Table, by: str):
    sums = np.stack([s.values.to_numpy(zero_copy_only=False) for s in table["sums"]]).sum(axis=0)
    yield pa.table({by: table[by][:1], "n": pa.array([sum(table["n"].to_pylist())], pa.int64()), "sums": pa.array([sums])})


def _parts(sums: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Gram matrix, cross products and squared actions out of one array of ``gram_arrays``."""
    p = next(p for p in range(1, len(sums)) if p * p + p * d + 1 == len(sums))
    return sums[: p * p].reshape(p, p), sums[p * p : -1].reshape(p, d), float(sums[-1])


def sweep_trajectories(sums: DataFrame, scores: DataFrame, key: str, group: str, seeds: int = 5, most: int = 6) -> tuple[DataFrame, float]:
    """(rows of ``sweep``, the error of all of the pool): the same judgement from ``gram_arrays``, of
    any number of dimensions. Only episodes of the most dimensions are compared: a model has one width."""
    widest = sums.agg(F.max("width")).first()[0]
    known = stash(sums.where((F.col("n") >= MIN_STEPS) & (F.col("width") == widest)).join(scores.select(key, group, "score", "hard"), key))
    held = heldout_operators(known, group, most)
    test_n, test = added_arrays(known.join(held, group, "left_semi").withColumn("arm", F.lit(0)), "arm")[0]
    pool = stash(known.join(held, group, "left_anti"))
    rankable = stash(pool.where(~F.coalesce(F.col("hard"), F.lit(False))))
    size = rankable.count()
    fitted = rankable.select(key, "n", "sums").join(arms(rankable, key, "score", size, seeds), key)
    every = pool.withColumn("arm", F.lit(-1)).select("arm", "n", "sums").unionByName(fitted.select("arm", "n", "sums"))
    tg, th, ts = _parts(test, widest)

    def error(n: int, s: np.ndarray) -> float:
        g, h, _ = _parts(s, widest)
        w = np.linalg.solve(g + RIDGE * n * np.eye(len(g)), h)
        return float((ts - 2 * (w * th).sum() + (w * (tg @ w)).sum()) / (test_n * widest))

    mse = {arm: error(n, s) for arm, (n, s) in added_arrays(every, "arm").items()}
    return _swept(sums, mse, size, seeds), mse[-1]


def heldout_operators(df: DataFrame, group: str, most: int = 6) -> DataFrame:
    """Every third operator by number of rows, ``most`` of them."""
    counted = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    largest = counted.orderBy(F.desc("n"), group).limit(3 * most)  # so few rows are left to number
    place = F.row_number().over(Window.orderBy(F.desc("n"), group)) - 1
    return largest.withColumn("at", place).where(F.col("at") % 3 == 0).select(group)


def top_fraction(df: DataFrame, score: str, key: str, share: float, least: int = MIN_SUBSET) -> DataFrame:
    """The best max(floor(rows * share), least) rows by score."""
    n = max(math.floor(df.count() * share), least)
    return running(df, [F.col(score).desc_nulls_last(), F.col(key)], "__at").where(F.col("__at") <= n).drop("__at")


def arms(pool: DataFrame, key: str, score: str, size: int, seeds: int) -> DataFrame:
    """(key, arm): which rows each model is fitted on. Arm 100 * f holds the best of tenth f by
    score, arm 100 * f + 1 + s a random part of that size that follows from key, tenth and s."""
    sizes = {f: min(size, max(size * f // 10, MIN_SUBSET)) for f in range(1, 11)}
    limit = F.create_map(*(F.lit(x) for f, n in sizes.items() for x in (f, n)))
    best = running(pool.select(key, score), [F.col(score).desc_nulls_last(), F.col(key)], "at").select(
        key, F.explode(F.array(*(F.lit(100 * f) for f in sizes))).alias("arm"), "at"
    )
    drawn = pool.select(key, F.explode(F.array(*(F.lit(100 * f + 1 + s) for f in sizes for s in range(seeds)))).alias("arm"))
    shuffled = running_by(drawn.withColumn("__h", F.xxhash64(F.col(key), "arm")), "arm", [F.col("__h"), F.col(key)], "at")
    every = best.unionByName(shuffled.select(key, "arm", "at"))
    return every.where(F.col("at") <= F.element_at(limit, F.floor(F.col("arm") / 100).cast("int"))).select(key, "arm")


def sweep(sums: DataFrame, scores: DataFrame, key: str, group: str, x: int, y: int, seeds: int = 5, most: int = 6) -> DataFrame:
    """(keep_frac, n, quality_mse, random_mse, random_sd, gain): models of the best share of the
    pool against random ones of that size, judged on operators held out. ``sums``: rows of
    ``gram``; ``scores``: key, group, score, hard (dropped by a rule, in neither arm).

    Sums add up over episodes: all models of the sweep come from one aggregate, one row each."""
    known = stash(sums.where(F.col("n") >= MIN_STEPS).join(scores, key))
    held = heldout_operators(known, group, most)
    names = [c for c in sums.columns if c != key]
    added = [F.sum(c).alias(c) for c in names]
    test = known.join(held, group, "left_semi").agg(*added).first().asDict()
    pool = stash(known.join(held, group, "left_anti").where(~F.coalesce(F.col("hard"), F.lit(False))))
    size = pool.count()
    chosen = arms(pool, key, "score", size, seeds).groupBy(key).agg(F.collect_list("arm").alias("arms"))
    fitted = pool.select(key, *names).join(chosen, key).select(*names, F.explode("arms").alias("arm")).groupBy("arm").agg(*added)
    mse = {r["arm"]: squared_error(test, solve(r.asDict(), x, y)) for r in fitted.collect()}  # one row per model
    return _swept(sums, mse, size, seeds)


def _swept(sums: DataFrame, mse: dict[int, float], size: int, seeds: int) -> DataFrame:
    rows = []
    for tenth in range(1, 11):
        others = [mse[100 * tenth + 1 + s] for s in range(seeds)]
        best, mean = mse[100 * tenth], float(np.mean(others))
        n = min(size, max(size * tenth // 10, MIN_SUBSET))
        rows.append((tenth / 10, n, best, mean, float(np.std(others)), 100 * (mean - best) / mean))
    return sums.sparkSession.createDataFrame(rows, "keep_frac double, n long, quality_mse double, random_mse double, random_sd double, gain double")


def sweep_counts(sums: DataFrame, scores: DataFrame, key: str, group: str, most: int = 6) -> DataFrame:
    """One row: usable episodes and operators, those held out with their steps, those of the pool,
    and how many a rule keeps out of both arms."""
    known = sums.where(F.col("n") >= MIN_STEPS).select(key, "n").join(scores, key)
    held = heldout_operators(known, group, most).withColumn("held", F.lit(True))
    marked = known.join(held, group, "left").withColumn("held", F.coalesce("held", F.lit(False)))
    hard = F.coalesce(F.col("hard"), F.lit(False))
    return marked.agg(
        F.count("*").alias("usable"), F.countDistinct(group).alias("operators"), F.count_if("held").alias("held_out"),
        F.countDistinct(F.when(F.col("held"), F.col(group))).alias("held_operators"),
        F.coalesce(F.sum(F.when(F.col("held"), F.col("n"))), F.lit(0)).alias("held_steps"), F.count_if(~F.col("held")).alias("pool"),
        F.countDistinct(F.when(~F.col("held"), F.col(group))).alias("pool_operators"), F.count_if(~F.col("held") & hard).alias("excluded"),
    )


def verdict(swept: DataFrame, full_mse: float) -> DataFrame:
    """One row: the share of the largest gain over random parts, and the smallest share whose model
    is no worse than that of all data (null if none is)."""
    enough = F.when(F.col("quality_mse") <= full_mse, F.col("keep_frac"))
    return swept.agg(
        F.max_by(F.struct("keep_frac", "n", "gain"), F.struct("gain", -F.col("keep_frac"))).alias("best"), F.min(enough).alias("parity_frac")
    ).select(F.col("best.keep_frac").alias("best_frac"), F.col("best.n").alias("best_n"), F.col("best.gain").alias("best_gain"), "parity_frac")
