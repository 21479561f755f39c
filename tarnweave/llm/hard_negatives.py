"""Hard negatives: for each anchor and positive the closest rows of other labels that aren't too close.

Dual-tree search. Rows fall into the cells of a tree fitted on a sample; where the interval of inner
products between two cells can't touch what any anchor of the one still looks for, the whole group of
anchors is done with the other. What is left meets in tasks, each of which grows a ball tree over its
anchors and one over its candidates and descends both at once in the same way; leaves are scored exactly."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.session import stash

#: Inner products of whole numbers up to here are exact in double precision, in any order.
EXACT = 2.0**53
LONG = 2**63 - 1


@dataclass(frozen=True)
class NegativeParams:
    """``scale``: components become floor(scale * x). ``every``: anchors are rows whose id it
    divides. ``low``, ``high``: per cent of the positive's score that a negative's may have.
    ``sample``: rows that the tree of cells is fitted on; ``cell_rows``: rows of a cell;
    ``most_cells`` bounds what the driver sees. ``block``: anchors and candidates of a task."""

    scale: int = 256
    every: int = 50
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    sample: int = 16_384
    cell_rows: int = 16_384
    most_cells: int = 512
    block: int = 16_384
    anchor_leaf: int = 64
    leaf: int = 512
    seed: int = 12


def halves(x: np.ndarray) -> np.ndarray:
    """Order of the rows of ``x`` along the way between two far ones."""
    far = x[((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    other = x[((x - far) ** 2).sum(axis=1).argmax()]
    return np.argsort(x @ (other - far), kind="stable")


@dataclass
class Ball:
    """A node: rows ``begin`` to ``end`` of the tree's order, all within ``radius`` of ``centre``."""

    begin: int
    end: int
    centre: np.ndarray
    radius: float
    children: tuple[Ball, ...] = ()


def ball_tree(x: np.ndarray, leaf: int) -> tuple[np.ndarray, Ball]:
    """Order of the rows, and the root over it; nodes are halved down to ``leaf`` rows or equal ones."""
    order = np.arange(len(x))

    def grow(begin: int, end: int) -> Ball:
        rows = x[order[begin:end]]
        centre = rows.mean(axis=0)
        radius = float(np.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
        if end - begin <= leaf or radius < 1e-6:
            return Ball(begin, end, centre, radius)
        order[begin:end] = order[begin:end][halves(rows)]
        middle = (begin + end) // 2
        return Ball(begin, end, centre, radius, (grow(begin, middle), grow(middle, end)))

    return order, grow(0, len(x))


def interval(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product between balls around ``a`` and around ``b``, all pairs; a
    little wider than rounding could ask for."""
    na, nb = np.sqrt((a**2).sum(axis=1)), np.sqrt((b**2).sum(axis=1))
    spread = np.outer(ra, nb) + np.outer(na, rb) + np.outer(ra, rb)
    middle = a @ b.T
    slack = 1e-9 * (np.outer(na, nb) + spread) + 1e-3
    return middle - spread - slack, middle + spread + slack


def matrix(rows: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Lists of doubles as rows, short ones filled with zeros, which change no inner product."""
    rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    values = rows.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; where doubles can't hold them, Python's integers."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if largest < EXACT:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(a) @ whole(b).T


class Wanted:
    """What the anchors of a task look for, in slots: for each slot of each anchor the ``most`` first
    rows by score and id with a score from ``low`` to ``high``, and what was found so far."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.low, self.high, self.most = low.astype(object if low.dtype == object else float).copy(), high, most
        self.found: dict[tuple[int, int], list[tuple]] = {}
        self.reach()

    def reach(self) -> None:
        self.least, self.largest = self.low.min(axis=1), np.where(self.low <= self.high, self.high, -np.inf).max(axis=1)

    def open(self, begin: int, end: int, low: float, high: float) -> bool:
        """Does any anchor of the group look for a score of the interval?"""
        return bool(((self.least[begin:end] <= high) & (self.largest[begin:end] >= low)).any())

    def offer(self, begin: int, got: np.ndarray, allowed: np.ndarray, names: Callable[[int], tuple]) -> None:
        """Scores of the anchors from ``begin`` on with a leaf's rows."""
        end = begin + len(got)
        near = allowed & (got >= self.least[begin:end, None]) & (got <= self.largest[begin:end, None])
        if not near.any():
            return
        touched = np.flatnonzero(near.any(axis=1))
        for i in touched:
            at = np.flatnonzero(near[i])
            score = got[i, at]
            for slot in range(self.low.shape[1]):
                fits = (score >= self.low[begin + i, slot]) & (score <= self.high[begin + i, slot])
                if fits.any():
                    self._add(begin + i, slot, at[fits], score[fits], names)
        low, high = self.low[begin:end], self.high[begin:end]
        self.least[begin:end] = low.min(axis=1)
        self.largest[begin:end] = np.where(low <= high, high, -np.inf).max(axis=1)

    def _add(self, anchor: int, slot: int, at: np.ndarray, score: np.ndarray, names: Callable[[int], tuple]) -> None:
        if len(at) > self.most:  # ties with the last stay for their ids to decide
            last = np.sort(score)[-self.most]
            at, score = at[score >= last], score[score >= last]
        new = [(-s, *names(int(j))) for s, j in zip(score.tolist(), at, strict=True)]
        kept = self.found[anchor, slot] = heapq.nsmallest(self.most, self.found.get((anchor, slot), []) + new)
        if len(kept) == self.most:
            self.low[anchor, slot] = max(self.low[anchor, slot], -kept[-1][0])


def search(anchors: pa.Table, rows: pa.Table, same: bool, most: int, p: NegativeParams) -> Wanted | None:
    """Descends both trees at once, pairs of nodes with the largest possible scores first."""
    if not len(anchors) or not len(rows):
        return None
    a, b = matrix(anchors["vec"]), matrix(rows["vec"])
    width = max(a.shape[1], b.shape[1])
    a, b = matrix(anchors["vec"], width), matrix(rows["vec"], width)
    order, left = ball_tree(a, p.anchor_leaf)
    to, right = ball_tree(b, p.leaf)
    a, b = a[order], b[to]
    column = lambda t, c, o: t[c].to_numpy(zero_copy_only=False)[o]
    label, id_, twin = (column(anchors, c, order) for c in ("label", "id", "twin"))
    of, ids, twins = (column(rows, c, to) for c in ("label", "id", "twin"))
    bounds = [np.array(anchors[c].to_pylist(), object)[order].reshape(len(a), -1) for c in ("low", "high")]
    bounds = [np.where(x == None, fill, x).astype(float) for x, fill in zip(bounds, (-np.inf, np.inf), strict=True)]  # noqa: E711
    wanted, serial = Wanted(*bounds, most), 0
    between = lambda x, y: tuple(float(v[0, 0]) for v in interval(x.centre[None], np.array([x.radius]), y.centre[None], np.array([y.radius])))
    low, high = between(left, right)
    heap = [(-high, low, serial, left, right)]
    while heap:
        high, low, _, x, y = heapq.heappop(heap)
        if not wanted.open(x.begin, x.end, low, -high):
            continue
        if not x.children and not y.children:
            equal = label[x.begin : x.end, None] == of[None, y.begin : y.end]
            allowed = equal if same else ~equal
            if same:
                allowed &= (id_[x.begin : x.end, None] != ids[None, y.begin : y.end]) | (twin[x.begin : x.end, None] != twins[None, y.begin : y.end])
            first = y.begin
            wanted.offer(x.begin, scores(a[x.begin : x.end], b[y.begin : y.end]), allowed, lambda j, f=first: (int(ids[f + j]), int(twins[f + j])))
            continue
        larger = x.children and (not y.children or x.radius >= y.radius)
        for c, d in [(c, y) for c in x.children] if larger else [(x, d) for d in y.children]:
            serial += 1
            low, high = between(c, d)
            if wanted.open(c.begin, c.end, low, high):
                heapq.heappush(heap, (-high, low, serial, c, d))
    wanted.keys = [(int(i), int(t)) for i, t in zip(id_, twin, strict=True)]
    return wanted


FOUND = "id long, twin long, slot int, other long, other_twin long, score long"


def _meet(anchors: DataFrame, rows: DataFrame, open_cells: np.ndarray, counts: dict[int, int], same: bool, most: int, p: NegativeParams, waves: int) -> DataFrame:
    """FOUND: what anchors find among the rows of the cells that are open to their own cell.

    Candidates stay in blocks of their cell, anchors go to each block of each open cell; both sides
    of a task have about ``block`` rows, whatever the number of copies."""
    spark = anchors.sparkSession
    parts = {c: -(-n // p.block) for c, n in counts.items()}
    pairs = [(int(a), c, parts[c]) for c in parts for a in np.flatnonzero(open_cells[:, c])]
    to = F.broadcast(spark.createDataFrame(pairs or [(-1, -1, 1)], "cell int, to int, parts int"))  # most_cells squared at most
    wave = F.pmod(F.xxhash64("id", "twin", F.lit(1)), F.lit(waves)).cast("int").alias("wave")
    left = anchors.withColumn("wave", wave).join(to, "cell").select(
        "id", "twin", "label", "vec", "low", "high", "wave", "to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    reached = F.broadcast(spark.createDataFrame(sorted({(c, n) for _, c, n in pairs}) or [(-1, 1)], "to int, parts int"))
    right = rows.withColumnRenamed("cell", "to").join(reached, "to").select(
        *(F.col(c).alias(c) for c in ("id", "twin", "label", "vec", "to")), F.pmod(F.xxhash64("id", "twin"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(waves - 1))).alias("wave"),
    )

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        got = search(mine, theirs, same, most, p)
        out = [(*got.keys[i], slot, other, twin, max(-LONG - 1, min(LONG, int(-s)))) for (i, slot), x in got.found.items() for s, other, twin in x] if got else []
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*out, strict=True) if out else [[]] * 6
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("id", "twin", "slot", "other", "other_twin", "score"), columns, kinds, strict=True)})

    keys = ("to", "part", "wave")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, FOUND)


def _first(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("id", "twin", "slot").orderBy(F.desc("score"), "other", "other_twin")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _rows(df: DataFrame, p: NegativeParams, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(id, label, vec, twin): whole components as doubles; each distinct row once."""
    plain = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))

    @F.pandas_udf("array<double>")
    def whole(vec: pd.Series) -> pd.Series:
        return vec.map(lambda v: np.floor(float(p.scale) * np.asarray(v, float)) + 0.0)

    kept = plain.where(usable).dropDuplicates(["id", "label", "vec"])
    return kept.select("id", "label", whole("vec").alias("vec"), F.xxhash64("label", "vec").alias("twin"))


def _cells(rows: DataFrame, p: NegativeParams) -> tuple[DataFrame, list]:
    """``rows`` with their cell: the nearest of the centres of a ball tree over a sample; and
    each cell's (cell, rows, anchors, centre, radius, anchors' radius), over all rows."""
    count = rows.count()
    share = min(1.0, 2.0 * p.sample / max(count, 1))
    some = [r["vec"] for r in rows.where(F.pmod(F.xxhash64("id", "twin", F.lit(p.seed)), F.lit(1 << 30)) < int(share * (1 << 30))).select("vec").limit(p.sample).toArrow().to_pylist()]
    cells = max(1, min(p.most_cells, -(-count // p.cell_rows)))
    width = max(map(len, some), default=0)
    x = matrix(pa.array(some, pa.list_(pa.float64())), width)
    leaves: list[np.ndarray] = []
    if len(x):
        nodes = [ball_tree(x, max(1, -(-len(x) // cells)))[1]]
        while nodes:
            node = nodes.pop()
            nodes += node.children
            leaves += [] if node.children else [node.centre]
    centres = np.array(leaves[: p.most_cells]) if leaves else np.zeros((0, 0))

    @F.pandas_udf("struct<cell int, distance double>")
    def nearest(vec: pd.Series) -> pd.DataFrame:
        at = matrix(pa.array(vec, pa.list_(pa.float64())), width)
        own = np.zeros((len(centres), at.shape[1]))
        own[:, :width] = centres
        square = (at**2).sum(axis=1)[:, None] - 2 * at @ own.T + (own**2).sum(axis=1)
        cell = square.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype(np.int32), "distance": np.sqrt(((at - own[cell]) ** 2).sum(axis=1))})

    placed = rows.withColumn("at", nearest("vec")) if len(centres) else rows.withColumn("at", F.expr("named_struct('cell', 0, 'distance', 0D)"))
    placed = stash(placed.select("id", "twin", "label", "vec", "at.cell", "at.distance"))
    is_anchor = F.pmod("id", F.lit(p.every)) == 0
    seen = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.max("distance").alias("radius"),
        F.coalesce(F.max(F.when(is_anchor, F.col("distance"))), F.lit(0.0)).alias("anchor_radius"),
    )
    return placed, [(r, centres[r["cell"]]) for r in seen.orderBy("cell").collect()]  # most_cells rows at most


def _rounds(anchors: DataFrame, rows: DataFrame, cells: list, same: bool, most: int, p: NegativeParams, waves: int) -> DataFrame:
    """Home cells first; what is found there bounds what other cells must offer."""
    counts = {r["cell"]: r["n"] for r, _ in cells}
    size = max(counts, default=0) + 1
    home = np.eye(size, dtype=bool)
    found = _first(_meet(anchors, rows, home, counts, same, most, p, waves), most)
    if len(cells) <= 1:
        return found
    found = stash(found)
    last = found.where(F.col("rank") == most).groupBy("id", "twin").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.col("score").cast("double")))).alias("last"))
    slots = F.transform("low", lambda x, k: F.greatest(x, F.try_element_at("last", k.cast("int"))))
    rest = anchors.join(last, ["id", "twin"], "left").withColumn("low", F.when(F.col("last").isNull(), F.col("low")).otherwise(slots))
    rest = stash(rest.drop("last"))
    reach = rest.groupBy("cell").agg(F.min(F.array_min(F.transform("low", lambda x: F.coalesce(x, F.lit(float("-inf")))))).alias("low"), F.max(F.array_max(F.transform("high", lambda x: F.coalesce(x, F.lit(float("inf")))))).alias("high"))
    centre = np.array([c for _, c in cells])
    of = [r["cell"] for r, _ in cells]
    low, high = interval(centre, np.array([r["anchor_radius"] for r, _ in cells]), centre, np.array([r["radius"] for r, _ in cells]))
    open_cells = np.zeros((size, size), bool)
    for r in reach.collect():  # a row for each cell
        k = of.index(r["cell"])
        open_cells[r["cell"], of] = (high[k] >= r["low"]) & (low[k] <= r["high"])
    open_cells &= ~home
    if not open_cells.any():
        return found
    others = _meet(rest, rows, open_cells, counts, same, most, p, waves)
    return _first(found.drop("rank").unionByName(others), most)


def hard_negatives(df: DataFrame, params: NegativeParams | None = None, label: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are exact inner products of floor(scale * x), reported as the nearest long where they
    pass 64 bits; beyond 2**53 windows are those of the nearest doubles. Rows come by score, then by id. A row takes no part if its id,
    label or vector is null or a component is null or not finite. Equal rows count once; rows of one
    id that differ are rows of their own, ordered by a hash of what they hold. Vectors of
    unequal length meet as if filled with zeros. An anchor without positives, or a pair without
    negatives, gives no row, as an empty table does; other columns are ignored."""
    p = params or NegativeParams()
    rows, cells = _cells(_rows(df, p, id_col, vec_col, F.col("label") if label is None else label), p)
    anchors = rows.where(F.pmod("id", F.lit(p.every)) == 0).drop("distance")
    waves = max(1, -(-sum(r["anchors"] for r, _ in cells) // p.block))
    everything = anchors.withColumns({"low": F.array(F.lit(None).cast("double")), "high": F.array(F.lit(None).cast("double"))})
    positives = stash(_rounds(everything, rows, cells, True, p.positives, p, waves))
    score = F.col("score").cast("decimal(19,0)")
    low, high = F.ceil(score * p.low / 100).cast("double"), F.floor(score * p.high / 100).cast("double")
    slots = F.array_sort(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high"))))
    windows = positives.groupBy("id", "twin").agg(slots.alias("slots"))
    windows = windows.select("id", "twin", F.transform("slots", lambda x: x["low"]).alias("low"), F.transform("slots", lambda x: x["high"]).alias("high"))
    seeking = stash(anchors.join(windows, ["id", "twin"]))
    negatives = _rounds(seeking, rows, cells, False, p.negatives, p, waves)
    named = positives.select("id", "twin", (F.col("rank") - 1).alias("slot"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.withColumnRenamed("score", "negative_score").join(named, ["id", "twin", "slot"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", "negative_score"
    )
