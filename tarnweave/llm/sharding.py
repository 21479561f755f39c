"""Sharding: Karmarkar-Karp differencing of indivisible groups into shards of near equal bytes."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.llm.hot import join_by_weight, packed, unpacked
from tarnweave.session import stash


@dataclass(frozen=True)
class ShardParams:
    """``crowd``: groups that one task parts by itself, as long as that makes no more than
    ``most_tasks`` tasks. A shard's rows are numbered side by side in ``cells`` parts, or in so
    many that a part has about ``cell_rows`` rows."""

    shards: int = 8
    crowd: int = 2048
    most_tasks: int = 65_536
    cells: int = 512
    cell_rows: int = 65_536


def differencing(parts: list[tuple[int, ...]]) -> tuple[list[list[int]], list[int]]:
    """Combine partial partitions, each a tuple of k sums, into one.

    The two of the largest spread are combined, the largest sum of one with the smallest of the
    other and so on, until one is left. Returns, for each part, the place of each of its sums,
    and the sums of the places."""
    k = len(parts[0])
    nodes: list[tuple] = []
    heap = []

    def add(sums: list[int], order: list[int], children) -> None:
        ranked = [sums[s] for s in order]
        nodes.append((order, children))
        heapq.heappush(heap, (ranked[-1] - ranked[0], len(nodes) - 1, ranked))

    for sums in parts:
        add(list(sums), sorted(range(k), key=lambda s: (-sums[s], s)), None)
    while len(heap) > 1:
        _, a, one = heapq.heappop(heap)
        _, b, two = heapq.heappop(heap)
        sums = [x + y for x, y in zip(one, reversed(two), strict=True)]
        add(sums, sorted(range(k), key=lambda s: (-sums[s], s)), (a, b))
    _, top, totals = heap[0]
    places: list[list[int]] = [[] for _ in parts]
    todo = [(top, list(range(k)))]
    while todo:
        node, place = todo.pop()
        order, children = nodes[node]
        of_slot = [0] * k
        for rank, slot in enumerate(order):
            of_slot[slot] = place[rank]
        if children is None:
            places[node] = of_slot
        else:
            a, b = children
            todo += [(a, of_slot), (b, of_slot[::-1])]
    return places, totals


def _part_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(bucket, digest, local, bytes, n): each group's place in its bucket's own partition."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", "digest"], ascending=[False, True], kind="stable")
        places, _ = differencing([(b, *[0] * (shards - 1)) for b in rows["bytes"].tolist()])
        return rows.assign(local=np.array([p[0] for p in places], np.int32))[["bucket", "digest", "local", "bytes", "n"]]

    return groups.groupBy("bucket").applyInPandas(run, "bucket int, digest binary, local int, bytes long, n long")


def shard(
    docs: DataFrame, params: ShardParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id (under the name of ``id_col``), size, text_crc32, law, shard, slot and grown_shard of
    every row.

    Rows of equal text are a group and share a shard. Groups are dealt into buckets by hash; each
    bucket is differenced by itself into a partial partition of ``shards`` sums, and the buckets'
    partial partitions are differenced in turn, so what reaches the driver is one row of sums per
    bucket. The law is ``bytes``: sizes come out near equal; grown_shard is null.

    Null texts are a group of their own with no bytes and checksum 0, apart from the empty text.
    Repeated rows and ids each get a slot; null ids come first in order. An empty table gives an
    empty result; other columns are ignored."""
    p, spark = params or ShardParams(), docs.sparkSession
    text = F.col(text_col)
    rows = stash(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"null")).alias("digest"),
        )
    )
    groups = stash(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    buckets = max(1, min(p.most_tasks, -(-groups.count() // p.crowd)))
    dealt = groups.withColumn("bucket", F.pmod(F.xxhash64("digest", F.lit(8)), F.lit(buckets)).cast("int"))
    local = stash(_part_groups(dealt, p.shards))
    sums = local.groupBy("bucket", "local").agg(F.sum("bytes").alias("bytes")).toPandas()  # bounded by most_tasks
    table = np.zeros((buckets, p.shards), np.int64)
    table[sums["bucket"], sums["local"]] = sums["bytes"]
    places, _ = differencing([tuple(x) for x in table.tolist()])
    moves = spark.createDataFrame(
        pd.DataFrame({"bucket": np.arange(buckets, dtype=np.int32), "moves": places}), "bucket int, moves array<int>"
    )
    placed = local.join(F.broadcast(moves), "bucket").select(
        "digest", F.element_at("moves", F.col("local") + 1).alias("shard"), "n"
    )
    many = rows.count()
    cells = max(p.cells, many // (p.shards * p.cell_rows))
    sharded = stash(
        join_by_weight(rows, placed, "digest", "n", many).withColumn(
            "cell", F.pmod(F.xxhash64("id", "digest", F.lit(3)), F.lit(cells)).cast("int")
        )
    )
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        sharded.groupBy("shard", "cell")
        .agg(F.count("*").alias("n"))  # bounded by shards x cells
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    order = Window.partitionBy("shard", "cell").orderBy("id", "digest")
    return (
        sharded.withColumn("number", F.row_number().over(order))
        .join(F.broadcast(firsts), ["shard", "cell"])
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("number") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(docs: DataFrame, sharded: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write documents of unique ids as one folder per shard, in slot order within a file. Columns
    of ``docs`` named shard or slot are replaced by the row's place."""
    places = sharded.select(F.col(id_col).alias("shard_id"), "shard", "slot").distinct()
    own = ("shard", "slot")
    (
        docs.select(packed(docs, own).alias("row"), docs[id_col].alias("row_id"))
        .join(places, F.col("row_id").eqNullSafe(F.col("shard_id")))
        .select(*unpacked(docs, "row", own).values(), *own)
        .repartition("shard", F.floor(F.col("slot") / 100_000))
        .sortWithinPartitions(*own)
        .write.partitionBy("shard")
        .parquet(path)
    )
