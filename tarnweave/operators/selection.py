"""Exact order statistics of many columns and groups at once, without a buffer of their values.

Selection by refinement: a histogram of each group and column between its least and largest value,
then one of the cell alone that holds the rank, until few enough values are left to be sorted. What
moves is a row for each cell that isn't empty, however many rows there are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.functions.scalars import missing_to_null
from tarnweave.session import stash

#: Cells of a histogram, and values of a cell that are few enough to be sorted, in each
#: of many groups and in one table.
CELLS, FEW, FEW_OF_ALL = 1024, 4096, 1 << 16


def _met(rows: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Each value in the cell of each target that looks for it there, with the target's columns."""
    to = state.select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(by)), *(F.col(c).alias(f"__{c}") for c in state.columns if c not in by))
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(by)]
    inside = (F.col("j") == F.col("__j")) & F.col("v").between(F.col("__lo"), F.col("__hi"))
    met = rows.join(to, reduce(lambda a, b: a & b, same, inside))
    return met.select(*by, "v", *(F.col(f"__{c}").alias(c) for c in state.columns if c not in by))


def _refined(rows: DataFrame, state: DataFrame, by: list[str], cells: int) -> DataFrame:
    """The targets with the cell, of a histogram of the one they had, that holds their rank."""
    at = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    cell = F.when(F.isnan(at), cells - 1).otherwise(F.least(F.floor(at * cells), F.lit(cells - 1)))
    counted = _met(rows, state, by).groupBy(*by, "j", "i", cell.alias("cell")).agg(
        F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), *(F.first(c).alias(c) for c in ("s", "rank", "part", "next"))
    )
    along = Window.partitionBy(*by, "j", "i").orderBy("cell")
    placed = counted.withColumns({"upto": F.sum("n").over(along), "after": F.lead("lo").over(along)})
    here = placed.where("upto > rank and upto - n <= rank")
    return here.select(*by, "j", "i", "s", "n", "lo", "hi", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "part", F.coalesce("after", "next").alias("next"))


def long_form(df: DataFrame, values: list[Column], by: list[str]) -> DataFrame:
    """(keys, j, v): a row for each value that isn't null or NaN, j its place in the list."""
    entries = F.array(*(F.struct(F.lit(j).alias("j"), missing_to_null(v.cast("double")).alias("v")) for j, v in enumerate(values)))
    return df.select(*by, F.explode(entries).alias("e")).select(*by, "e.j", "e.v").where("v is not null")


def order_statistics(rows: DataFrame, by: list[str], shares: list[float], cells: int = CELLS, few: int | None = None) -> DataFrame:
    """(keys, j, s, q) of ``long_form`` rows: a row for each group and column that has values. s holds
    n, mean, sd (of a sample), lo and hi, taken in the first pass; q the quantiles of the shares with
    linear interpolation. Null keys are a group of their own; without keys the table is one."""
    few = few or (FEW if by else FEW_OF_ALL)
    moments = F.struct(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    first = stash(rows.groupBy(*by, "j").agg(moments.alias("s")))
    place = F.array(*(F.struct(F.lit(i).alias("i"), (F.lit(float(x)) * (F.col("s.n") - 1)).alias("at")) for i, x in enumerate(shares)))
    state = first.withColumn("t", F.explode(place)).select(
        *by, "j", "t.i", "s", "s.n", "s.lo", "s.hi", F.floor("t.at").alias("rank"), (F.col("t.at") % 1).alias("part"), F.lit(None).cast("double").alias("next")
    )
    wide = (F.col("lo") < F.col("hi")) & (F.col("n") > few)
    while not state.where(wide).isEmpty():
        state = stash(_refined(rows, state.where(wide), by, cells).unionByName(state.where(~wide)))

    apart = F.col("lo") < F.col("hi")
    pick = lambda low, high: low * (1 - F.col("part")) + F.when(F.col("part") > 0, high * F.col("part")).otherwise(0.0)
    beyond = F.when(F.col("rank") + 1 < F.col("n"), F.col("lo")).otherwise(F.col("next"))
    settled = state.where(~apart).select(*by, "j", "i", "s", pick(F.col("lo"), beyond).alias("q"))
    held = _met(rows, state.where(apart), by).groupBy(*by, "j", "i").agg(
        F.array_sort(F.collect_list("v")).alias("sorted"), *(F.first(c).alias(c) for c in ("s", "rank", "part", "next"))
    )  # few values of a target at most
    nth = lambda k: F.try_element_at("sorted", (F.col("rank") + k).cast("int"))
    found = settled.unionByName(held.select(*by, "j", "i", "s", pick(nth(1), F.coalesce(nth(2), "next")).alias("q")))
    return found.groupBy(*by, "j").agg(F.first("s").alias("s"), F.array_sort(F.collect_list(F.struct("i", "q"))).alias("q")).withColumn("q", F.col("q.q"))


def quantiles(df: DataFrame, values: dict[str, Column], shares: list[float], cells: int = CELLS, few: int | None = None) -> DataFrame:
    """One row for the table: for each value and share ``{name}_{i}``, the quantile of the i-th share
    (null without values), and ``{name}_n``, ``_mean``, ``_sd``, ``_lo`` and ``_hi``."""
    found = order_statistics(long_form(df, list(values.values()), []), [], shares, cells, few)
    one = lambda j, c: F.max(F.when(F.col("j") == j, c))
    columns = []
    for j, name in enumerate(values):
        columns += [one(j, F.get("q", F.lit(i))).alias(f"{name}_{i}") for i in range(len(shares))]
        columns += [(F.coalesce(one(j, F.col("s.n")), F.lit(0)) if c == "n" else one(j, F.col(f"s.{c}"))).alias(f"{name}_{c}") for c in ("n", "mean", "sd", "lo", "hi")]
    return found.agg(*columns)
