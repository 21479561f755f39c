"""Buckets of a locality-sensitive index, split into blocks so that no task holds a hot one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.llm.hot import join_by_weight
from tarnweave.session import stash


def _dealt(keyed: DataFrame, block: int) -> DataFrame:
    """``keyed`` without buckets of one item, with the number of blocks of the bucket (``parts``),
    the item's own (``own``) and the bucket's leading item (``lead``)."""
    lead = F.min(F.struct(F.xxhash64("item", F.lit(72)).alias("h"), "item"))
    sizes = stash(
        keyed.groupBy("bucket").agg(F.count("*").alias("n"), lead.alias("lead")).where("n > 1").select("bucket", "n", "lead.item")
        .withColumnRenamed("item", "lead")
    )
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("item", F.lit(71)), F.col("parts")).cast("int")
    return join_by_weight(keyed, sizes, "bucket", "n").withColumn("parts", parts).withColumn("own", own)


def _task(left, right, side):
    return F.struct(left.cast("int").alias("left"), right.cast("int").alias("right"), side.cast("int").alias("side"))


def _with_tasks(rows: DataFrame, tasks, columns: list[str]) -> DataFrame:
    return rows.select(*columns, F.explode(tasks).alias("t")).select(*columns, "t.left", "t.right", "t.side")


def block_pairs(keyed: DataFrame, block: int) -> DataFrame:
    """(bucket, item, ...) rows -> (item, bucket, ..., left, right, side): the tasks in which an
    item meets the others of its buckets.

    Buckets of one item fall away. A bucket of up to ``block`` items is one task (left = right =
    0). A larger one is dealt into blocks by the item's hash, and each unordered pair of blocks is
    a task of about twice ``block`` items; ``side`` says whether the item stands left (0) or right
    (1), so every pair of items meets in exactly one task of the bucket."""
    own = F.col("own")
    tasks = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda o: _task(F.least(own, o), F.greatest(own, o), own > o)
    )
    return _with_tasks(_dealt(keyed, block), tasks, keyed.columns)


def own_blocks(keyed: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The tasks within blocks, and (item, bucket) of the buckets of several blocks.

    Each item meets those of its own block and the bucket's leading item, which stands in every
    block: so copies of one text are connected block by block, at a cost in proportion to the
    bucket. What is left of a larger bucket is ``cross_blocks``."""
    dealt = stash(_dealt(keyed, block))
    here = lambda o: _task(o, o, F.lit(0))
    tasks = F.when(F.col("item") == F.col("lead"), F.transform(F.sequence(F.lit(0), F.col("parts") - 1), here)).otherwise(
        F.array(here(F.col("own")))
    )
    return _with_tasks(dealt, tasks, ["item", "bucket"]), dealt.where("parts > 1").select("item", "bucket")


def cross_blocks(large: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Tasks for the pairs of (item, bucket) rows that (item, label) doesn't connect yet.

    In each bucket the items outside of its most frequent label are dealt into blocks and meet one
    another and, block by block, those of that label, which needn't meet among themselves. A bucket
    of one label only makes no task; one connected group and some others make tasks in proportion
    to its size."""
    labelled = stash(large.join(labels, "item", "left").withColumn("label", F.coalesce("label", "item")))
    counts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("c"))
    main = counts.groupBy("bucket").agg(F.max(F.struct("c", "label")).alias("m"), F.sum("c").alias("n"))
    sizes = stash(main.select("bucket", "n", F.col("m.label").alias("main"), (F.col("n") - F.col("m.c")).alias("rest")).where("rest > 0"))
    blocks = lambda n: F.ceil(n / F.lit(block)).cast("int")
    rows = (
        join_by_weight(labelled, sizes, "bucket", "n")
        .withColumn("few", blocks(F.col("rest"))).withColumn("many", blocks(F.col("n") - F.col("rest")))
        .withColumn("inside", F.col("label") == F.col("main"))
        .withColumn("own", F.pmod(F.xxhash64("item", F.lit(73)), F.when(F.col("inside"), F.col("many")).otherwise(F.col("few"))).cast("int"))
    )
    own, few = F.col("own"), F.col("few")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    among = F.transform(upto(few), lambda o: _task(F.least(own, o), F.greatest(own, o), own > o))
    across = F.transform(upto(F.col("many")), lambda d: _task(own, few + d, F.lit(0)))
    back = F.transform(upto(few), lambda o: _task(o, few + own, F.lit(1)))
    return _with_tasks(rows, F.when(F.col("inside"), back).otherwise(F.concat(among, across)), ["item", "bucket"])


def meet(tasks: DataFrame) -> DataFrame:
    """Bring the rows of each task of ``block_pairs`` together, adjacent in one partition."""
    keys = ["bucket", "left", "right"]
    return tasks.repartition(*keys).sortWithinPartitions(*keys)


def whole_tasks(batches):
    """Arrow batches of ``meet`` -> (table, starts): as many complete tasks as are at hand, and
    where each begins. What is held is a batch and the task that it breaks off in."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        starts = _starts(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts[:-1]
        rest = table.slice(starts[-1]) if len(starts) else None
    if rest is not None and rest.num_rows:
        yield rest, np.zeros(1, np.int64)


def _starts(table: pa.Table) -> np.ndarray:
    if not table.num_rows:
        return np.empty(0, np.int64)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for name in ("bucket", "left", "right"):
        column = table[name].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def pairs(table: pa.Table, starts: np.ndarray, chunk: int = 1 << 18):
    """All pairs (i, j) of rows that meet in a task, in chunks of bounded size: each two of a
    task's rows, or each left with each right row where two blocks meet."""
    ends = np.append(starts[1:], table.num_rows)
    sizes = ends - starts
    side, left, right = (table[c].to_numpy() for c in ("side", "left", "right"))
    within = left[starts] == right[starts]
    small = within & (sizes <= 64)
    for size in np.unique(sizes[small]):
        if size < 2:
            continue
        firsts = starts[small & (sizes == size)]
        a, b = np.triu_indices(size, 1)
        step = max(1, chunk // len(a))
        for k in range(0, len(firsts), step):
            base = firsts[k : k + step, None]
            yield (base + a).ravel(), (base + b).ravel()
    for s, e, w in zip(starts[~small], ends[~small], within[~small], strict=True):
        rows = np.arange(s, e)
        one, two = (rows, rows) if w else (rows[side[s:e] == 0], rows[side[s:e] == 1])
        step = max(1, chunk // max(1, len(two)))
        for k in range(0, len(one), step):
            i, j = np.meshgrid(one[k : k + step], two, indexing="ij")
            i, j = i.ravel(), j.ravel()
            yield (i[i < j], j[i < j]) if w else (i, j)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows reaches over links (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        for k in (i, j):
            np.minimum.at(label, k, low)
            np.minimum.at(label, before[k], low)
        label = label[label]
        if (label == before).all():
            break
    return label
