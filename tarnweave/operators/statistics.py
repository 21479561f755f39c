"""Statistical operators: false discovery control, mutual information, silhouette, robust outliers."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.operators import robust
from tarnweave.operators.ranking import running
from tarnweave.session import stash

PCA_DIMS, CLUSTERS, RESTARTS = 10, range(2, 9), 10
NULL_TRIALS, NULL_QUANTILE = 20, 0.99
ALPHAS = (0.01, 0.05, 0.10, 0.25)
#: Rows of a block, two of which are compared in one row of a join, rows of it whose
#: distances are measured at once, and parts that the blocks on one side are dealt to.
BLOCK_ROWS, SLICE_ROWS, BLOCK_PARTS = 4096, 128, 8
#: Rounds in which the first centres of k-means are gathered, rows of a block.
START_ROUNDS, KMEANS_ROWS = 5, 2048


def cutoffs(tests: DataFrame, p: str, alphas: list[float]) -> dict[float, float | None]:
    """For each level the largest p that is within alpha * rank / n, None if no p is.

    Ranks are running counts of distinct p, so rows of equal p share the largest rank, which changes
    no cutoff; nulls aren't ranked. One number per level reaches the driver."""
    counted = tests.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("q")).agg(F.count("*").alias("c"))
    n = tests.where(F.col(p).isNotNull()).count()
    if not n:
        return dict.fromkeys(alphas)
    ranked = running(counted, ["q"], "rank", F.col("c"))
    within = [F.max(F.when(F.col("q") <= F.lit(a) * F.col("rank") / F.lit(n), F.col("q"))) for a in alphas]
    return dict(zip(alphas, ranked.agg(*within).first(), strict=True))


def benjamini_hochberg(tests: DataFrame, p: str, key: str, alpha: float) -> DataFrame:
    """Every row with ``flagged``: p up to the cutoff of the level; nulls are never flagged."""
    cut = cutoffs(tests, p, [alpha])[alpha]
    return tests.withColumn("flagged", F.coalesce(F.col(p) <= F.lit(cut).cast("double"), F.lit(False)))


def null_floor(tests: DataFrame, nulls: DataFrame, p: str = "p", alphas: tuple[float, ...] = ALPHAS) -> DataFrame:
    """(alpha, flagged, floor): shares that false discovery control flags among the tests and among
    p-values of data without outliers, which went through the same procedure."""
    shares = []
    for table in (tests, nulls):
        cut = cutoffs(table, p, list(alphas))
        is_in = [F.coalesce(F.col(p) <= F.lit(cut[a]).cast("double"), F.lit(False)).cast("double") for a in alphas]
        flagged = [F.coalesce(F.avg(F.when(F.col(p).isNotNull(), x)), F.avg(x)) for x in is_in]  # what isn't tested doesn't count
        shares.append(table.agg(*flagged).first())
    return tests.sparkSession.createDataFrame(list(zip(alphas, *shares, strict=True)), "alpha double, flagged double, floor double")


def normalised_mutual_information(df: DataFrame, a: str, b: str, limit: float = 0.3) -> DataFrame:
    """(nmi, tracks): mutual information of two labels over the mean of their entropies, and whether
    it is above the limit: the clusters follow the other label then."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("c"))
    n = cells.agg(F.sum("c")).first()[0]
    side = lambda k, name: cells.groupBy(k).agg((F.sum("c") / F.lit(n)).alias(name))
    shared = cells.withColumn("p", F.col("c") / F.lit(n)).join(side(a, "pa"), a).join(side(b, "pb"), b)
    sums = shared.agg(
        F.sum(F.col("p") * F.log(F.col("p") / (F.col("pa") * F.col("pb")))).alias("mi"),
        (-F.sum(F.col("p") * F.log("pa"))).alias("ha"), (-F.sum(F.col("p") * F.log("pb"))).alias("hb"),
    )
    mean = (F.col("ha") + F.col("hb")) / 2
    nmi = sums.select(F.when(mean > 0, F.col("mi") / mean).otherwise(1.0).alias("nmi"))
    return nmi.withColumn("tracks", F.col("nmi") > limit)


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` from all of ``y``; close ones are measured by difference."""
    centre = y.mean(axis=0)
    x, y = x - centre, y - centre
    one, two = (x * x).sum(axis=1)[:, None], (y * y).sum(axis=1)
    square = x @ (-2 * y.T)
    square += one
    square += two
    if square.size and square.min() < 1e-4 * (one.max() + two.max()):
        near = np.argwhere(square < 1e-4 * (one + two))
        np.maximum(square, 0, out=square)
        for at in range(0, len(near), 1 << 15):
            i, j = near[at : at + (1 << 15)].T
            square[i, j] = ((x[i] - y[j]) ** 2).sum(axis=1)
    return np.sqrt(square, out=square)


def _blocks(rows: DataFrame, n: int) -> DataFrame:
    """(d, ks, cs, v): rows (k, v, c) without nulls in blocks of BLOCK_ROWS at most, labels and vectors
    end to end, stored. Rows of equal labels lie side by side, so that a block has few of them."""
    parts = min(-(-n // BLOCK_ROWS) or 1, rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.select(F.size("v").alias("d"), "k", "c", "v").repartitionByRange(parts, "d", "c", F.xxhash64("k")).sortWithinPartitions("d", "c")

    def pack(batches):
        for batch in batches:
            d = batch["d"].to_numpy()
            ends = [0, *(np.flatnonzero(np.diff(d)) + 1), len(d)]
            for lo, hi in zip(ends[:-1], ends[1:]):
                for at in range(lo, hi, BLOCK_ROWS):
                    part = batch.slice(at, min(BLOCK_ROWS, hi - at))
                    columns = [part["k"], part["c"].flatten(), part["v"].flatten()]
                    yield pa.RecordBatch.from_arrays([part["d"][:1], *(pa.ListArray.from_arrays([0, len(x)], x) for x in columns)], ["d", "ks", "cs", "v"])

    kinds = dict(rows.dtypes)
    return stash(dealt.mapInArrow(pack, f"d int, ks array<{kinds['k']}>, cs {kinds['c']}, v array<double>"))


def silhouettes(df: DataFrame, key: str, vector: str, labels: list[str]) -> DataFrame:
    """(label, silhouette): for each labelling of the rows the mean of (b - a) / max(a, b),
    Euclidean; 0 for lone rows.

    Every row is compared with every other, block by block, once for all labellings: a task adds up
    the distances of the rows on its left from the blocks on its right, by cluster. Where keys tell rows
    apart a task meets all blocks, one after another, and a row's worth is known there; where they
    don't, the sums are shuffled. Rows without a key don't count; those without a vector or a label count as 0."""
    named = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"), F.array(*labels).alias("c")).where("k is not null")
    whole = named.where(F.col("v").isNotNull() & ~F.exists("c", lambda x: x.isNull()) & ~F.exists("v", lambda x: x.isNull()))
    n, rows = named.agg(F.count("*"), F.count_distinct("k")).first()
    wide, single = len(labels), n == rows
    kind, label_kind = dict(named.dtypes)["k"], named.schema["c"].dataType.elementType.simpleString()
    blocks = _blocks(whole, n)
    left = blocks.repartition(-(-n // BLOCK_ROWS) or 1)
    right = blocks.repartition(1 if single else BLOCK_PARTS).select("d", F.struct("ks", "cs", "v").alias("o"))

    def run(frames):
        at, total = None, {}
        for frame in frames:
            for d, ks, cs, v, o in zip(frame["d"], frame["ks"], frame["cs"], frame["v"], frame["o"]):
                keys, others = list(ks), pd.Index(o["ks"])
                if at is None or at[0] != d or at[1] != keys:
                    yield from sums(at, total)
                    at, total = (d, keys, np.array(list(cs), object).reshape(-1, wide), np.asarray(v, float).reshape(len(keys), d), pd.Index(keys)), {}
                first, names, member = members(np.array(list(o["cs"]), object).reshape(-1, wide))
                met, y = at[4].isin(others), np.asarray(o["v"], float).reshape(len(others), d)
                size = np.diff([*first, len(others)])
                added, counts = np.zeros((2, len(keys), len(first)))
                for i in range(0, len(keys), SLICE_ROWS):
                    part = slice(i, i + SLICE_ROWS)
                    gap = _gaps(at[3][part], y)
                    counts[part] = size
                    if met[part].any():  # rows of one key aren't compared
                        same = at[4][part].to_numpy()[:, None] == others.to_numpy()
                        gap[same] = 0
                        counts[part] -= np.add.reduceat(same.astype(float), first, axis=1)
                    added[part] = np.add.reduceat(gap, first, axis=1)
                for name, s, c in zip(names, (added @ member).T, (counts @ member).T):
                    before = total.get(name, (0, 0))
                    total[name] = (before[0] + s, before[1] + c)
        yield from sums(at, total)

    def members(theirs):
        """Where runs of rows of equal labels begin, and (labelling, cluster) of each column of a matrix
        that says which runs are in it."""
        first = np.flatnonzero(np.concatenate([[True], (theirs[1:] != theirs[:-1]).any(axis=1)]))
        names, columns = [], []
        for j in range(wide):
            codes, found = pd.factorize(pd.Series(theirs[first, j]))
            names += [(j, name) for name in found]
            columns.append(codes[:, None] == np.arange(len(found)))
        return first, names, np.concatenate(columns, axis=1).astype(float)

    def sums(at, total):
        if single:
            yield pd.DataFrame({"j": range(wide), "s": [worths(at[2][:, j], {c: x for (i, c), x in total.items() if i == j}) for j in range(wide)] if at else 0.0})
            return
        for (j, name), (s, c) in total.items():
            met = c > 0
            yield pd.DataFrame({
                "k": pd.Series(at[1], dtype=object)[met], "j": j, "c": pd.Series(at[2][:, j], dtype=object)[met], "c2": name, "s": s[met],
                "n": c[met].astype("int64"),
            })

    def worths(own, total):
        """Sum of (b - a) / max(a, b) over rows of these clusters."""
        a, b = np.full(len(own), np.nan), np.full(len(own), np.inf)
        for c, (s, count) in total.items():
            mean = np.divide(s, count, out=np.full(len(own), np.inf), where=count > 0)
            mine = own == c
            a[mine & (count > 0)] = mean[mine & (count > 0)]
            b[~mine] = np.minimum(b, mean)[~mine]
        top = np.maximum(a, b)
        return float(np.divide(b - a, top, out=np.zeros(len(own)), where=(top > 0) & np.isfinite(top)).sum())

    met = left.hint("shuffle_replicate_nl").join(right.withColumnRenamed("d", "d2"), F.col("d") == F.col("d2")).drop("d2")
    if single:
        added = met.mapInPandas(run, "j int, s double").groupBy("j").agg(F.sum("s").alias("s"))
        return _mean_worths(df, labels, added, rows)
    gaps = met.mapInPandas(run, f"k {kind}, j int, c {label_kind}, c2 {label_kind}, s double, n long")
    means = (
        gaps.groupBy("k", "j", "c", "c2").agg((F.sum("s") / F.sum("n")).alias("d"))
        .groupBy("k", "j").agg(
            F.max(F.when(F.col("c") == F.col("c2"), F.col("d"))).alias("a"),
            F.min(F.when(F.col("c") != F.col("c2"), F.col("d"))).alias("b"),
        )
    )
    worth = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return _mean_worths(df, labels, means.groupBy("j").agg(F.sum(worth).alias("s")), rows)


def _mean_worths(df: DataFrame, labels: list[str], added: DataFrame, rows: int) -> DataFrame:
    every = df.sparkSession.createDataFrame(list(enumerate(labels)), "j int, label string").join(added, "j", "left")
    return every.select("label", F.when(F.lit(rows) > 0, F.coalesce("s", F.lit(0.0)) / F.lit(max(rows, 1))).alias("silhouette"))


def silhouette_bounds(rows: DataFrame, vector: str, labels: list[str]) -> dict[str, tuple[float, float]]:
    """label -> bounds of its silhouette, without comparing rows with one another.

    Rows that all labellings put together are a cell, of which only number, centre and variance are
    known: there are no more cells than ways to combine the labels, however many rows. The mean distance of
    a row from a cell is at least that from its centre (a norm is convex) and at most the root of that
    squared plus the variance (a root is concave); each labelling's clusters are unions of cells."""
    d = rows.select(F.max(F.size(vector))).first()[0] or 0
    at = [F.element_at(vector, i + 1).cast("double") for i in range(d)]
    sums = rows.groupBy(*labels).agg(F.count("*").alias("n"), *(f(x) for x in at for f in (F.sum, lambda x: F.sum(x * x)))).collect()
    wide = len(labels)
    of, n = np.array([r[:wide] for r in sums]).reshape(-1, wide), np.array([r[wide] for r in sums], float)
    moments = np.array([r[wide + 1 :] for r in sums], float).reshape(len(sums), d, 2) / np.maximum(n, 1)[:, None, None]
    centres, square = moments[:, :, 0], moments[:, :, 1].sum(axis=1)
    variance = np.maximum(square - (centres**2).sum(axis=1), 0) + 1e-9 * square
    names = [np.unique(of[:, j]) for j in range(wide)]
    weights = [n[:, None] * (of[:, j, None] == names[j]) for j in range(wide)]

    def bound(batches):
        total = np.zeros((wide, 2))
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                low = _gaps(_vectors(part[vector]), centres)
                high = np.sqrt(low**2 + variance) * (1 + 1e-9)
                low = low * (1 - 1e-9)
                for j in range(wide):
                    size = weights[j].sum(axis=0)
                    own = np.searchsorted(names[j], part[labels[j]].to_numpy(zero_copy_only=False))
                    i = np.arange(len(own))
                    near, far = low @ weights[j], high @ weights[j]
                    alone = size[own] == 1
                    within = [x[i, own] / np.maximum(size[own] - 1, 1) for x in (near, far)]
                    across = []
                    for x in (near, far):
                        x = x / size
                        x[i, own] = np.inf
                        across.append(x.min(axis=1))
                    for e, (a, b) in enumerate(((within[1], across[0]), (within[0], across[1]))):
                        top = np.maximum(a, b)
                        worth = np.divide(b - a, top, out=np.zeros_like(a), where=(top > 0) & np.isfinite(b))
                        total[j, e] += np.where(alone, 0, worth).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(wide, dtype=np.int32)), pa.array(total[:, 0]), pa.array(total[:, 1])], ["j", "lo", "hi"])

    found = rows.select(vector, *labels).mapInArrow(bound, "j int, lo double, hi double").groupBy("j").agg(F.sum("lo"), F.sum("hi")).collect()
    return {labels[j]: (lo / n.sum(), hi / n.sum()) for j, lo, hi in found}


def best_labelling(rows: DataFrame, key: str, vector: str, labels: list[str]) -> str:
    """The label column of the best silhouette, the first of equal ones. Rows are compared with one
    another only for labellings that bounds leave open."""
    bounds = silhouette_bounds(rows, vector, labels)
    reach = max(lo for lo, _ in bounds.values())
    still = [x for x in labels if bounds[x][1] >= reach - 1e-9]
    if len(still) == 1:
        return still[0]
    worth = {r["label"]: r["silhouette"] for r in silhouettes(rows, key, vector, still).collect()}
    best = still[0]
    for x in still[1:]:
        if worth[x] > worth[best] + 1e-12:
            best = x
    return best


def silhouette(df: DataFrame, key: str, vector: str, cluster: str) -> DataFrame:
    """(silhouette) of one labelling; null for a table without rows."""
    return silhouettes(df, key, vector, [cluster]).select("silhouette")


def rare_clusters(df: DataFrame, cluster: str, least: float = 0.01) -> DataFrame:
    """Every row with ``rare``: its cluster has less than a share ``least`` of all rows."""
    sizes = df.groupBy(F.col(cluster).alias("__c")).agg(F.count("*").alias("__n"))  # one row per cluster
    n = df.count()
    marked = sizes.select("__c", (F.col("__n") / F.lit(max(n, 1)) < least).alias("rare"))
    return df.join(marked, F.col(cluster).eqNullSafe(F.col("__c"))).drop("__c")


def _first_centres(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ (Arthur and Vassilvitskii 2007) among weighted points: each further centre with odds
    by weight times squared distance."""
    odds = weights / weights.sum()
    centres = [points[rng.choice(len(points), p=odds)]]
    near = ((points - centres[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        by = near * weights
        centres.append(points[rng.choice(len(points), p=by / by.sum() if by.sum() > 0 else odds)])
        near = np.minimum(near, ((points - centres[-1]) ** 2).sum(axis=1))
    return np.array(centres)


def _race(hashes: np.ndarray, *salt: int) -> np.ndarray:
    """Exponential variates that follow from rows' hashes: the rows with the least of these over their
    weights are a sample by weight."""
    x = hashes.view(np.uint64) ^ np.uint64(int(np.random.SeedSequence(salt).generate_state(1, np.uint64)[0]))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return -np.log(((x >> np.uint64(11)).astype(float) + 0.5) / (1 << 53))


def start_points(points: DataFrame, key: str, vector: str, most: int, restarts: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each restart points to begin from and their weights: k-means|| (Bahmani and others 2012).

    All rows take part: START_ROUNDS times, those far from what was chosen so far enter by odds of
    their squared distance, 2 * ``most`` of them; a point weighs as many rows as are nearest to it. A
    round is a job over the rows for all restarts, of which a few rows each reach the driver."""
    return _start_points(_packed(points, key, vector, seed), most, restarts, seed)


def _start_points(blocks: DataFrame, most: int, restarts: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    chosen: list[np.ndarray] = []
    for turn in range(START_ROUNDS + 1):
        take = 2 * most if turn else 1

        def draw(batches, chosen=chosen, turn=turn, take=take):
            best: list[tuple] = [(np.empty(0), None)] * restarts
            for h, x in _unpacked(batches):
                for r in range(restarts):
                    far = _nearest(x, chosen[r])[1] if turn else np.ones(len(x))
                    at = np.full(len(x), np.inf)
                    np.divide(_race(h, seed, r, turn), far, out=at, where=far > 0)
                    before, rows = best[r]
                    at, x_ = np.concatenate([before, at]), x if rows is None else np.concatenate([rows, x])
                    first = np.argsort(at, kind="stable")[:take]
                    first = first[np.isfinite(at[first])]
                    best[r] = at[first], x_[first]
            for r, (at, rows) in enumerate(best):
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r, np.int32)), pa.array(at), pa.array(list(rows))], ["r", "at", "v"])

        drawn = blocks.mapInArrow(draw, "r int, at double, v array<double>")
        place = F.row_number().over(Window.partitionBy("r").orderBy("at", "v"))
        found = drawn.withColumn("place", place).where(F.col("place") <= take).select("r", "v").collect()  # 2 * most for each restart
        if not found:  # every place of a row has been chosen
            break
        new = [[x["v"] for x in found if x["r"] == r] for r in range(restarts)]
        chosen = [np.concatenate([c, n]) if n else c for c, n in zip(chosen, new, strict=True)] if turn else [np.array(n) for n in new]

    def weigh(batches):
        totals = [np.zeros(len(c)) for c in chosen]
        for _, x in _unpacked(batches):
            for c, total in zip(chosen, totals, strict=True):
                total += np.bincount(_nearest(x, c)[0], minlength=len(c))
        for r, total in enumerate(totals):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), r, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["r", "i", "n"])

    weights = [np.zeros(len(c)) for c in chosen]
    for r, i, n in blocks.mapInArrow(weigh, "r int, i int, n double").groupBy("r", "i").agg(F.sum("n")).collect():  # a row for each point
        weights[r][i] = n
    return list(zip(chosen, weights, strict=True))


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, the first of equal ones, and the squared distance from it.

    Products find it; what is within their rounding of the nearest, and the distance, is by difference."""
    size = (x * x).sum(axis=1)
    square = x @ (-2 * centres.T)
    square += (centres * centres).sum(axis=1)
    at = square.argmin(axis=1)
    rows = np.arange(len(x))
    close = square <= (square[rows, at] + 1e-12 * (size + np.abs(centres).max(initial=0.0) ** 2 * x.shape[1]))[:, None]
    several = np.flatnonzero(np.count_nonzero(close, axis=1) > 1)
    for k in range(0, len(several), 1024):
        i = several[k : k + 1024]
        at[i] = ((x[i][:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    return at, ((x - centres[at]) ** 2).sum(axis=1)


def _moments(x: np.ndarray, runs: list[np.ndarray]) -> list[np.ndarray]:
    """For each run's centres the number, squared distances and sum of the rows nearest to each.

    All runs go through one product; rows with several centres within its rounding of the nearest are
    dealt by ``_nearest``."""
    middle = x.mean(axis=0)
    moved, centres = x - middle, np.concatenate(runs) - middle
    sizes = np.array([len(c) for c in runs])
    first = np.cumsum(sizes) - sizes
    size = (moved * moved).sum(axis=1)
    square = (-2 * centres) @ moved.T
    square += (centres * centres).sum(axis=1)[:, None]
    least = np.array([square[f : f + k].min(axis=0) for f, k in zip(first, sizes)])
    reach = least + 1e-12 * (size + (centres * centres).sum(axis=1).max())
    row = np.column_stack([np.ones(len(x)), np.zeros(len(x)), x])
    out = []
    for r, (f, k) in enumerate(zip(first, sizes)):
        member = (square[f : f + k] <= reach[r]).astype(float)
        cost = np.maximum(least[r] + size, 0)
        i = np.flatnonzero(member.sum(axis=0) > 1)
        if len(i):
            at, cost[i] = _nearest(x[i], runs[r])
            member[:, i] = np.arange(k)[:, None] == at
        row[:, 1] = cost
        out.append(member @ row)
    return out


def _packed(points: DataFrame, key: str, vector: str, seed: int) -> DataFrame:
    """(h, v): hashes of rows and their vectors end to end, KMEANS_ROWS rows at most in one, stored:
    rounds over the rows read whole blocks."""
    hashed = points.select(F.xxhash64(F.col(key), F.lit(seed)).alias("h"), F.col(vector).cast("array<double>").alias("v"))

    def pack(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, KMEANS_ROWS):
                part = batch.slice(k, KMEANS_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array([part["h"].to_numpy()]), pa.array([_vectors(part["v"]).ravel()])], ["h", "v"])

    return stash(hashed.mapInArrow(pack, "h array<long>, v array<double>"))


def _unpacked(batches):
    """(hashes, vectors) of each block of ``_packed``."""
    for batch in batches:
        for h, v in zip(batch["h"], batch["v"]):
            h = h.values.to_numpy()
            yield h, v.values.to_numpy().reshape(len(h), -1)


def _vectors(column) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(float)


def kmeans(points: DataFrame, key: str, vector: str, ks: list[int], restarts: int, seed: int = 0, rounds: int = 300, tolerance: float = 1e-4) -> dict[int, np.ndarray]:
    """k -> the centres of the least cost of ``restarts`` runs from k-means++ starts.

    All runs of all k go through the rows together, one job a round, until no run moves its centres
    by more than ``tolerance`` of the vectors' variance; what reaches the driver is a count and a sum
    per centre. Starts and rounds take all rows."""
    blocks = _packed(points, key, vector, seed)
    starts = _start_points(blocks, max(ks), restarts, seed)
    d = starts[0][0].shape[1]
    runs = {(k, r): _first_centres(*starts[r], k, np.random.default_rng([seed, k, r])) for k in ks for r in range(restarts)}
    spread = points.agg(*(F.var_pop(F.element_at(vector, i + 1)) for i in range(d))).first()
    least, costs, moving = tolerance * float(np.mean(spread)), {}, list(runs)
    added = [F.sum(c).alias(c) for c in ("n", "cost", *(f"s{i}" for i in range(d)))]
    for _ in range(rounds):
        held = [runs[m] for m in moving]

        def partial(batches, held=held):
            sums = [np.zeros((len(c), d + 2)) for c in held]
            for _, x in _unpacked(batches):
                for total, part in zip(sums, _moments(x, held), strict=True):
                    total += part
            rows = [(m, j, *row) for m, total in enumerate(sums) for j, row in enumerate(total.tolist()) if row[0]]
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *map(pa.array, columns[2:])], names)

        names = ["m", "j", "n", "cost", *(f"s{i}" for i in range(d))]
        schema = "m int, j int, " + ", ".join(f"{c} double" for c in names[2:])
        found = blocks.mapInArrow(partial, schema).groupBy("m", "j").agg(*added).toPandas()  # a row per centre
        still = []
        for m, run in enumerate(moving):
            mine = found[found["m"] == m]
            after = runs[run].copy()
            after[mine["j"]] = mine[names[4:]].to_numpy() / mine[["n"]].to_numpy()
            costs[run] = mine["cost"].sum()
            if ((after - runs[run]) ** 2).sum() > least:
                runs[run] = after
                still.append(run)
        moving = still
        if not moving:
            break
    return {k: runs[min(((k, r) for r in range(restarts)), key=lambda x: costs[x])] for k in ks}


def choose_clusters(df: DataFrame, key: str, vector: str, seed: int = 0, ks=CLUSTERS, restarts: int = RESTARTS) -> tuple[DataFrame, int]:
    """(rows with ``cluster``, k): of k-means with each k below the number of rows, best of
    ``restarts``, the one of the best silhouette, the smallest k of equal ones."""
    tried = [k for k in ks if k < df.count()]
    if not tried:
        return df.withColumn("cluster", F.lit(0)), 1
    centres = kmeans(df, key, vector, tried, restarts, seed)
    kind = dict(df.dtypes)

    def assign(batches):
        for batch in batches:
            x = _vectors(batch[batch.schema.names.index(vector)])
            labels = [pa.array(_nearest(x, centres[k])[0].astype(np.int32)) for k in tried]
            yield pa.RecordBatch.from_arrays([*batch.columns, *labels], [*batch.schema.names, *(f"__k{k}" for k in tried)])

    schema = ", ".join(f"`{c}` {t}" for c, t in kind.items()) + "".join(f", __k{k} int" for k in tried)
    labelled = stash(df.mapInArrow(assign, schema))
    best = int(best_labelling(labelled, key, vector, [f"__k{k}" for k in tried]).removeprefix("__k"))
    return labelled.select(*df.columns, F.col(f"__k{best}").alias("cluster")), best


def whitened(rows: DataFrame, key: str, vector: str, n: int, width: int) -> tuple[DataFrame, int]:
    """(key, y) and its width: vectors standardised, then turned to as many principal components as
    there may be, each of deviation 1."""
    dims = min(PCA_DIMS, width, n - 1)
    data = rows.withColumn("__a", array_to_vector(vector))
    data = StandardScaler(inputCol="__a", outputCol="__b", withMean=True, withStd=True).fit(data).transform(data)
    data = PCA(k=dims, inputCol="__b", outputCol="__c").fit(data).transform(data)
    flat = stash(data.select(key, vector_to_array("__c").alias("y")))
    spread = flat.agg(*(F.stddev_samp(F.element_at("y", i + 1)).alias(f"s{i}") for i in range(dims))).first()
    white = F.array(*(F.element_at("y", i + 1) / F.lit(spread[i] or 1.0) for i in range(dims)))
    return flat.select(key, white.alias("y")), dims


def cluster_pvalues(labelled: DataFrame, key: str, dims: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(key, cluster, p) of rows (key, y, cluster, rare), and (p) of outlier-free data of the same
    shapes. Rows of rare clusters have p 0 and no such data; the others' distances are taken in so
    many dimensions that the smallest cluster can bear, two at least.

    p is that of the squared robust distance by chi squared, scaled so that Gaussian data of the
    same shape, fitted in the same way, has its NULL_QUANTILE there. Where all rows of a cluster are
    in one place none is far. A cluster of hardly more rows than dimensions is its own fit: its
    distances are about equal, as are those of its counterparts, so each row has a p near 1 - NULL_QUANTILE."""
    tested = labelled.where("not rare").select("cluster", "y")
    smallest = tested.groupBy("cluster").count().agg(F.min("count")).first()[0]
    used = max(2, min(dims, smallest // 5)) if smallest else dims
    used = min(used, dims)
    groups = robust.Groups(tested, used, NULL_TRIALS, seed)
    fits = robust.robust_fits(groups) if groups.sizes else {}
    scales = robust.null_scales(groups, fits, NULL_QUANTILE) if fits else {}

    def far(x: np.ndarray, group: tuple[int, int]) -> np.ndarray:
        return robust.chi2_sf(fits[group](x) / scales[group[0]], used)

    def real(batches):
        for batch in batches:
            x = _vectors(batch["y"])[:, :used] if batch.num_rows else np.zeros((0, used))
            cluster, p = batch["cluster"].to_numpy(zero_copy_only=False), np.zeros(len(x))
            for c in np.unique(cluster):
                if (int(c), -1) in fits:
                    p[cluster == c] = far(x[cluster == c], (int(c), -1))
            yield pa.RecordBatch.from_arrays([batch[key], batch["cluster"], pa.array(p)], [key, "cluster", "p"])

    def null(batches):
        for batch in batches:
            for group, x in robust.blocks_of(batch, used):
                yield pa.RecordBatch.from_arrays([pa.array(far(x, group))], ["p"])

    found = labelled.select(key, F.col("cluster").cast("int").alias("cluster"), "y").mapInArrow(real, f"{key} {dict(labelled.dtypes)[key]}, cluster int, p double")
    return found, groups.drawn().mapInArrow(null, "p double") if fits else found.select("p").limit(0)


def cluster_tests(df: DataFrame, key: str, vector: str, least: float = 0.01, seed: int = 0, ks=CLUSTERS, restarts: int = RESTARTS) -> tuple[DataFrame, DataFrame]:
    """(key, cluster, p) of every row with a vector, and the (p) of the null floor.

    Vectors are standardised and whitened by PCA, clustered, and tested by robust distance within
    their cluster. Vectors of another length than most have, as episodes of too few frames give, and
    those with components that aren't finite take no part: their clusters and p are null. K-means needs
    more rows than clusters: below three rows nothing can be tested, and all are null."""
    rows = df.where(F.col(vector).isNotNull()).select(key, F.col(vector).cast("array<double>").alias("__x"))
    finite = F.forall("__x", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    width = F.when(finite, F.size("__x"))
    head = rows.groupBy(width.alias("d")).agg(F.count("*").alias("n")).where("d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    none = lambda x: x.select(key, F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("double").alias("p"))
    if head is None or head["n"] < 3:
        return none(rows), none(rows).select("p").limit(0)
    part = width.eqNullSafe(F.lit(head["d"]))
    points, dims = whitened(rows.where(part), key, "__x", head["n"], head["d"])
    labelled, _ = choose_clusters(points, key, "y", seed, ks, restarts)
    tested, nulls = cluster_pvalues(rare_clusters(labelled, "cluster", least), key, dims, seed)
    return tested.unionByName(none(rows.where(~part))), nulls


def cluster_outliers(df: DataFrame, key: str, vector: str, alpha: float = 0.01, least: float = 0.01, seed: int = 0, ks=CLUSTERS, restarts: int = RESTARTS) -> DataFrame:
    """(key, cluster, p, outlier): ``cluster_tests``, then false discovery control over all."""
    tested, _ = cluster_tests(df, key, vector, least, seed, ks, restarts)
    return benjamini_hochberg(tested, "p", key, alpha).withColumnRenamed("flagged", "outlier")
