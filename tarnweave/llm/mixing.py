"""Mixing sources to target weights: water-filled targets, whole copies, Pareto order sampling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.llm.hot import packed, unpacked
from tarnweave.llm.text import WORD
from tarnweave.session import stash


@dataclass(frozen=True)
class MixParams:
    """``weights``: those of the sources in code point order, repeating, null last. ``most``: a
    source's target in units of its size, at most. ``bins``: cells of the sampling order in which
    a source's words are summed, before the one cell where its quota ends is ordered exactly.
    ``near``: a share of the target; sums that are off by less count as equally near to it."""

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    bins: int = 4096
    near: float = 0.001
    seed: str = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / 4503599627370496.0


def targets(sizes: DataFrame, p: MixParams) -> DataFrame:
    """(source, source_size) -> source, source_size, target: the sum of all sizes shared by weight,
    none above ``most`` times its source's size, the excess reshared by weight.

    Sources fill up in order of size per weight: if one is above its bound, so are all before it."""
    every = Window.partitionBy()
    place = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, p.weights))
    weighed = sizes.withColumn(
        "weight", F.element_at(weights, (F.pmod(F.row_number().over(place) - 1, F.lit(len(p.weights))) + 1).cast("int"))
    ).withColumn("bound", F.col("source_size") * p.most)
    filling = Window.partitionBy(F.lit(0)).orderBy(
        F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shared = (
        weighed.withColumn("free", F.sum("source_size").over(every) - F.coalesce(F.sum("bound").over(before), F.lit(0)))
        .withColumn("heavy", F.sum("weight").over(rest))
        .withColumn("full", F.col("bound") * F.col("heavy") < F.col("free") * F.col("weight"))
    )
    level = F.first(F.when(~F.col("full"), F.col("free").cast("double") / F.col("heavy")), ignorenulls=True).over(
        filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return shared.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("bound").cast("double")).otherwise(F.col("weight") * F.col("level")).alias("target"),
    )


def levels(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """(level_source, level): by which factor odds become inclusion probabilities, so that the words
    that a source's documents contribute on average, sum(min(1, level * odds) * size), are its quota.

    Documents of the largest odds are certain first: if those of some odds are, so are all of
    larger ones. No level means that all are. One row per source and distinct odds is in order."""
    by = Window.partitionBy("source").orderBy("odds")
    cells = (
        sized.where("size > 0 and odds > 0").groupBy("source", "odds").agg(F.sum("size").alias("words"))
        .join(goal.select("goal_source", "quota"), F.col("source").eqNullSafe(F.col("goal_source")))
        .withColumn("rest", F.sum(F.col("odds") * F.col("words")).over(by))
        .withColumn("larger", F.sum("words").over(Window.partitionBy("source")) - F.sum("words").over(by))
        .withColumn("free", F.col("quota") - F.col("larger"))
    )
    some = F.when(F.col("free") * F.col("odds") < F.col("rest"), F.struct("odds", (F.col("free") / F.col("rest")).alias("level")))
    return cells.groupBy(F.col("source").alias("level_source")).agg(F.max(some)["level"].alias("level"))


def _closing(decided: DataFrame, near: float) -> DataFrame:
    """(row, closes): of each source the first document by rank, beyond the head, of those whose
    words come nearest to what the head leaves of the quota (``near`` or less of the target apart
    being equal), where they bring the sum nearer."""
    left = decided.groupBy("source").agg(
        (F.first("quota") - F.coalesce(F.sum(F.when(F.col("head"), F.col("size"))), F.lit(0))).alias("gap")
    )
    gaps = stash(left.select(F.col("source").alias("gap_source"), "gap"))
    off = F.greatest(F.abs(F.col("size") - F.col("gap")), F.col("target") * F.lit(near))
    order = F.struct(off.alias("off"), "rank", "mix_id", "mix_text", "row")
    return (
        decided.where("not head and size > 0")
        .join(gaps, F.col("source").eqNullSafe(F.col("gap_source")))
        .where("abs(size - gap) < gap")
        .groupBy("source")
        .agg(F.min(order).alias("best"))
        .select(F.col("best.row").alias("row"), F.lit(True).alias("closes"))
    )


def mix(
    docs: DataFrame,
    params: MixParams | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    affinity_col: str | None = None,
) -> DataFrame:
    """mix_id, mix_text (the id and a hash of the text), source, size, source_size, target, copies
    and taken of every row.

    A source's documents are to be taken target / source_size times on average: each so many whole
    copies for certain, the rest by Pareto order sampling with unequal probabilities. A document's
    odds grow with the root of its size, or are what ``affinity_col`` says (0 to 1 in thousandths,
    null 1); they are scaled to inclusion probabilities that fill the source's quota on average,
    and those of 1 or more are certain. Documents rank by their random odds u / (1 - u) over those
    of their probability; the ranking's head is taken as far as its words fit into what the copies
    leave of the target, and one more document, by rank among those nearest in size to what is
    then left, closes the gap. A sample's size is fixed in words, as targets are. u depends on the
    id and the seed alone, so reruns agree.

    A source's ranking is never sorted as a whole: its words are summed per cell of the ranking,
    and only the cell in which the quota ends is put in order.

    Null and empty texts have size 0 and take 0 words. A null source is a source, the last. Rows
    that share an id rank together, in order of their size and text. Other columns are ignored; an
    empty table gives an empty result."""
    p = params or MixParams()
    words = word_count(F.col(text_col))
    given = F.coalesce(F.col(affinity_col).cast("double"), F.lit(1.0)) if affinity_col else None
    odds = F.sqrt(words.cast("double")) if given is None else F.ceil(F.least(F.lit(1.0), F.greatest(F.lit(0.0), given)) * 1000) / 1000.0
    sized = stash(
        docs.select(
            F.col(id_col).alias("mix_id"),
            F.col(source_col).alias("source"),
            words.alias("size"),
            F.xxhash64(text_col).alias("mix_text"),
            odds.alias("odds"),
            F.monotonically_increasing_id().alias("row"),  # tells equal rows apart; they stay stored
        )
    )
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = stash(
        targets(sums, p)
        .withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor("ratio"))
        .withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "goal_source")
    )  # one row per source; whether it is broadcast is left to its known size
    level = levels(sized, goal)
    goal = stash(goal.join(level, F.col("goal_source").eqNullSafe(F.col("level_source")), "left").drop("level_source"))
    included = F.least(F.lit(1.0), F.coalesce(F.col("level") * F.col("odds"), F.lit(1.0)))
    u = uniform(F.col("mix_id"), p.seed)
    rank = F.when((F.col("size") > 0) & (included > 0), u * (1 - included) / ((1 - u) * included)).otherwise(F.lit(1e300))
    cell = F.when(F.col("rank") == 0, 0).otherwise(1 + F.floor(F.col("rank") / (1 + F.col("rank")) * p.bins))
    ranked = sized.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).withColumn("rank", rank).withColumn("bin", cell.cast("int"))
    until = Window.partitionBy("source").orderBy("bin")
    cells = (
        ranked.groupBy("source", "bin")
        .agg(F.sum("size").alias("words"), F.first("quota").alias("quota"))  # bounded by sources x bins
        .withColumn("after", F.sum("words").over(until))
        .withColumn("before", F.col("after") - F.col("words"))
    )
    last = stash(
        cells.where("before < quota and quota <= after").select(
            F.col("source").alias("last_source"), F.col("bin").alias("last_bin"), "before"
        )
    )
    placed = ranked.join(last, F.col("source").eqNullSafe(F.col("last_source")), "left")
    here = F.col("bin") == F.col("last_bin")
    inside = Window.partitionBy("source").orderBy("rank", "mix_id", "size", "mix_text", "row")
    ends = placed.where(here).withColumn("head", F.col("before") + F.sum("size").over(inside) <= F.col("quota"))
    others = placed.where(~here | F.col("last_bin").isNull()).withColumn(
        "head", (F.col("quota") > 0) & (F.col("last_bin").isNull() | (F.col("bin") < F.col("last_bin")))
    )
    columns = ["mix_id", "mix_text", "row", "size", "source", "source_size", "target", "whole", "quota", "rank", "head"]
    decided = stash(others.select(*columns).unionByName(ends.select(*columns)))
    closing = _closing(decided, p.near)
    decided = decided.join(closing, "row", "left").withColumn("extra", F.col("head") | F.col("closes").isNotNull())
    copies = (F.col("whole") + F.col("extra").cast("long")).cast("long")
    return decided.select(
        "mix_id", "mix_text", "size", "source", "source_size", "target",
        F.when(F.col("size") > 0, copies).otherwise(0).alias("copies"),
        F.when(F.col("size") > 0, copies * F.col("size")).otherwise(0).alias("taken"),
    )


def repeat(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs``, each row as often as the mix takes it.

    Rows of equal id and text are one document here: where the mix takes some of them more often
    than others, all are repeated as often as the one taken most."""
    copies = mixed.where("copies > 0").groupBy("mix_id", "mix_text").agg(F.max("copies").alias("copies"))
    rows = docs.select(packed(docs).alias("row"), docs[id_col].alias("row_id"), F.xxhash64(docs[text_col]).alias("row_text"))
    taken = rows.join(
        copies.hint("merge"), F.col("row_id").eqNullSafe(F.col("mix_id")) & (F.col("row_text") == F.col("mix_text"))
    )
    times = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return taken.select("row", times.alias("time")).select(*unpacked(docs, "row").values())
