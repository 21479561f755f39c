"""Embedding near-dedup: p-stable hashing of normalised vectors, links by exact cosine."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.llm import buckets
from tarnweave.llm.graph import class_links, component_of_each, components
from tarnweave.llm.hot import join_by_weight
from tarnweave.llm.text import mix64
from tarnweave.session import stash


#: Tables whose keys are drawn again at once, to see where a close pair met first.
_TABLES_AT_ONCE = 16


@dataclass(frozen=True)
class PStableParams:
    """``cosine``: vectors link at this cosine or more. A key is ``projections`` quantised
    Gaussian projections (cells of ``width``); ``tables`` keys are drawn. Where not given,
    projections follow the number of distinct vectors, so that about ``crowd`` unrelated
    (orthogonal) ones share a key, and tables follow from ``recall`` for pairs at the threshold;
    nearer pairs are found more surely. ``block``: vectors of a bucket that one task holds."""

    cosine: float = 0.9
    width: float = 2.0
    recall: float = 0.99
    crowd: int = 256
    projections: int | None = None
    tables: int | None = None
    block: int = 1024
    seed: int = 4

    def share(self, cosine: float) -> float:
        """Probability that one quantised projection puts unit vectors at this cosine in a cell."""
        c = math.sqrt(2 - 2 * cosine)
        r = self.width / c
        tail = 0.5 * math.erfc(r / math.sqrt(2))
        return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))

    def sized(self, n: int) -> tuple[int, int]:
        k = self.projections or min(
            32, max(6, math.ceil(math.log(max(n, 1) / self.crowd) / -math.log(self.share(0.0))))
        )
        at = self.share(self.cosine) ** k
        return k, self.tables or math.ceil(math.log(1 - self.recall) / math.log(1 - at))


def _doubles(value) -> np.ndarray | None:
    """A vector as doubles; None for what links with nothing."""
    if value is None or None in value:
        return None
    v = np.asarray(value, np.float64)
    return v if len(v) and np.isfinite(v).all() and v.any() else None


def _classes(vectors: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            digests, raw = [], []
            for value in batch["vector"].to_pylist():
                v = _doubles(value)
                raw.append(None if v is None else (v + 0.0).tobytes())
                digests.append(None if v is None else xxhash.xxh3_128_digest(raw[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(digests, pa.binary()), pa.array(raw, pa.binary())],
                ["id", "digest", "raw"],
            )

    return vectors.mapInArrow(run, "id long, digest binary, raw binary")


def _keys(unit: np.ndarray, k: int, tables: range, p: PStableParams) -> np.ndarray:
    """Keys of unit vectors in some of the tables, each drawn from a seed of its own."""
    dims = unit.shape[1]
    drawn = [np.random.default_rng([p.seed, dims, t]) for t in tables]
    lines = np.concatenate([r.standard_normal((dims, k)) for r in drawn], axis=1)
    shift = np.concatenate([r.uniform(0, p.width, k) for r in drawn])
    cells = np.floor((unit @ lines + shift) / p.width).astype(np.int64).view(np.uint64)
    number = np.arange(tables.start + 1, tables.stop + 1, dtype=np.uint64)
    key = np.broadcast_to(mix64(number + np.uint64(dims << 32)), (len(unit), len(tables)))
    for r in range(k):
        key = mix64(key ^ cells[:, r::k])
    return key.view(np.int64)


def _unit(rows: list[bytes]) -> np.ndarray:
    m = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _indexed(items: DataFrame, k: int, tables: int, p: PStableParams) -> DataFrame:
    def run(batches):
        for batch in batches:
            raw = batch["raw"].to_pylist()
            keys: list = [None] * len(raw)
            for length in {len(r) for r in raw}:
                at = [x for x, r in enumerate(raw) if len(r) == length]
                for x, row in zip(at, _keys(_unit([raw[x] for x in at]), k, range(tables), p), strict=True):
                    keys[x] = row.tolist()
            yield pa.RecordBatch.from_arrays([batch["item"], pa.array(keys, pa.list_(pa.int64()))], ["item", "keys"])

    return items.mapInArrow(run, "item binary, keys array<long>")


def _met_before(unit: np.ndarray, i: np.ndarray, j: np.ndarray, table: np.ndarray, k: int, p: PStableParams) -> np.ndarray:
    """Whether rows i and j of each pair share the key of a table before the pair's own.

    Keys are drawn again here, for close pairs only and some tables at a time, until the pair's
    first shared table is known: task rows needn't carry keys."""
    met = np.zeros(len(i), bool)
    for start in range(0, int(table.max(initial=0)), _TABLES_AT_ONCE):
        open_ = np.flatnonzero(~met & (table > start))
        if not len(open_):
            break
        rows, place = np.unique(np.concatenate([i[open_], j[open_]]), return_inverse=True)
        span = range(start, min(start + _TABLES_AT_ONCE, int(table.max())))
        keys = _keys(unit[rows], k, span, p)
        one, two = place[: len(open_)], place[len(open_) :]
        earlier = np.arange(span.start, span.stop) < table[open_, None]
        met[open_] = ((keys[one] == keys[two]) & earlier).any(axis=1)
    return met


def _linked(tasks: DataFrame, k: int, p: PStableParams) -> DataFrame:
    """(item, first, root, links): per task and item, how many vectors it links with there and an
    item of the task that it is connected with. A pair counts in the first table it shares."""

    def run(batches):
        for table, starts in buckets.whole_tasks(batches):
            raw = table["raw"].to_pylist()
            weight, number = table["weight"].to_numpy(), table["table"].to_numpy()
            first = table["first"].to_numpy(zero_copy_only=False)
            links = np.zeros(table.num_rows, np.int64)
            label = np.arange(table.num_rows)
            ends = np.append(starts[1:], table.num_rows)
            for at in range(0, len(starts), 512):
                s, e = starts[at], ends[min(at + 511, len(starts) - 1)]
                for length in {len(r) for r in raw[s:e]}:  # keys hold the length: vectors of one length meet
                    rows = np.flatnonzero([len(r) == length for r in raw[s:e]])
                    unit = _unit([raw[s + x] for x in rows])
                    place = np.full(e - s, -1)
                    place[rows] = np.arange(len(rows))
                    found = []
                    for i, j in buckets.pairs(table.slice(s, e - s), starts[at : at + 512] - s):
                        same = (place[i] >= 0) & (place[j] >= 0)
                        i, j = i[same], j[same]
                        close = np.einsum("ij,ij->i", unit[place[i]], unit[place[j]]) >= p.cosine
                        i, j = i[close], j[close]
                        own = ~_met_before(unit, place[i], place[j], number[s + i], k, p)
                        i, j = i[own], j[own]
                        np.add.at(links, s + i, weight[s + j])
                        np.add.at(links, s + j, weight[s + i])
                        found.append((i, j))
                    if found:
                        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
                        label[s + rows] = s + buckets.forest(e - s, i, j)[rows]
            hit = links > 0
            yield pa.RecordBatch.from_arrays(
                [
                    table["item"].combine_chunks().filter(pa.array(hit)),
                    pa.array(first[hit]),
                    pa.array(first[label[hit]]),
                    pa.array(links[hit]),
                ],
                ["item", "first", "root", "links"],
            )

    return buckets.meet(tasks).mapInArrow(run, "item binary, first long, root long, links long")


def near_vectors(
    vectors: DataFrame,
    params: PStableParams | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row, under the name of ``id_col``.

    Vectors (of equal length) link where their cosine, in double precision, is ``cosine`` or more
    and they share a key of some table. Equal vectors form one class, indexed once and counted by
    its size; hot buckets are split into blocks, and a task returns counts and one connecting link
    per vector, never its pairs.

    Null, empty and zero vectors and those with null or non-finite components have no links. Each
    of several rows that share an id counts as a vector; their components are joined. A null id
    takes part in counts, but not in components: its component is null and it is kept. An empty
    table gives an empty result. Other columns are ignored."""
    p = params or PStableParams()
    rows = stash(_classes(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))))
    good = rows.where("digest is not null")
    items = stash(
        good.groupBy(F.col("digest").alias("item")).agg(
            F.min("id").alias("first"), F.count("*").alias("weight"), F.first("raw").alias("raw")
        )
    )
    k, tables = p.sized(items.count())
    keyed = _indexed(items, k, tables, p).select("item", F.posexplode("keys").alias("table", "bucket"))
    tasks = buckets.block_pairs(stash(keyed), p.block).join(items, "item")
    found = stash(_linked(tasks, k, p))
    counts = found.groupBy("item").agg(F.sum("links").alias("others"))
    classes = items.select("item", "first", "weight").join(counts, "item", "left")
    linked = (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    placed = stash(
        join_by_weight(good.select("id", F.col("digest").alias("item")), stash(classes), "item", "weight").select("id", "first", linked)
    )
    links = class_links(placed).union(found.select(F.col("first").alias("a"), F.col("root").alias("b")))
    reached = component_of_each(placed.where("first is not null"), components(links, "a", "b"))
    alone = placed.where("first is null").select("id", "n_links").unionByName(
        rows.where("digest is null").select("id", F.lit(0).cast("long").alias("n_links"))
    )
    every = reached.select("id", "n_links", "component").unionByName(alone.withColumn("component", F.col("id")))
    return every.select(
        F.col("id").alias(id_col),
        "n_links",
        F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept"),
    )
