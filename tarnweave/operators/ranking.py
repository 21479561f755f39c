"""Ranks and running sums over a whole table, without a task that holds all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.session import stash


def running(df: DataFrame, order: list, name: str = "rank", weight: Column | None = None) -> DataFrame:
    """Every row with ``name``: the sum of weights (1 each) of all rows up to it in the given order.

    Rows are dealt to parts by ranges of the order and put in order there; a part goes on where
    those before it end, as their sums say. The order must tell rows apart."""
    weight = F.lit(1).cast("long") if weight is None else weight
    dealt = stash(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sums = dealt.groupBy("__part").agg(F.sum(weight).alias("s"))  # one row per part
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("__part", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = dealt.join(F.broadcast(before), "__part").withColumn(name, F.sum(weight).over(within) + F.col("__before"))
    return summed.drop("__part", "__before")


def running_by(df: DataFrame, by: str, order: list, name: str = "rank") -> DataFrame:
    """Every row with ``name``: its place (from 1) among the rows of equal ``by``, in the given order."""
    place = running(df, [F.col(by), *order], "__place")
    first = df.groupBy(by).agg(F.count("*").alias("__n"))  # one row per value of by
    earlier = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    before = first.select(by, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    return place.join(before, by).withColumn(name, F.col("__place") - F.col("__first")).drop("__place", "__first")
