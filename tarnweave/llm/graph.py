"""Connected components of a link table, without leaving the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.llm.hot import join_by_weight
from tarnweave.session import stash


#: Pairs of ids up to which their least neighbours, four numbers each, are broadcast.
SMALL = 1 << 16


def _fingerprint(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum; bounded, whatever the size of ``edges``."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(h), F.lit(0))).first())


def _with_least(pairs: DataFrame, total: int) -> DataFrame:
    """(u, v, m, n): each pair with the least v of its u. Hubs aren't gathered in one task."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return join_by_weight(pairs, least, "u", "n", total, SMALL)


def _stars(edges: DataFrame, total: int) -> DataFrame:
    """One large-star and one small-star step over ``total`` edges (u > v)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (
        _with_least(both, 2 * total)
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )
    small = _with_least(large, 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    least = large.groupBy("u").agg(F.min("v").alias("v"))
    return small.union(least).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): each node of an undirected link table with the smallest node it reaches.

    Alternates large-star and small-star contractions (joins and minima only, so no neighbour list
    is gathered anywhere) until the edge set is a set of stars. Loops and null ends are ignored;
    repeated links count once; an empty table gives an empty result. Nodes without links are not
    listed."""
    edges = stash(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = _fingerprint(edges)
    while before[0]:
        edges = stash(_stars(edges, before[0]))
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def class_links(placed: DataFrame) -> DataFrame:
    """(a, b): links between classes that some id stands in, from (id, first) rows, ``first`` being
    the smallest id of a class. Ids of one class only, which are nearly all, give no link."""
    copies = placed.where("id is not null and first is not null and id <> first").select("id", "first").distinct()
    heads = placed.select(F.col("first").alias("id")).distinct()
    several = copies.groupBy("id").agg(F.min("first").alias("least"), F.count("*").alias("n")).where("n > 1")
    return (
        copies.join(heads, "id", "left_semi").select(F.col("id").alias("a"), F.col("first").alias("b"))
    ).union(copies.join(several, "id").where("first <> least").select("least", "first"))


def component_of_each(placed: DataFrame, reach: DataFrame) -> DataFrame:
    """``placed`` (with columns id and first, not null) and ``component``: that of its class."""
    classes = placed.groupBy("first").agg(F.count("*").alias("__n"))
    labelled = classes.join(reach.withColumnRenamed("node", "first"), "first", "left").select(
        "first", "__n", F.coalesce("component", "first").alias("component")
    )
    return join_by_weight(placed, stash(labelled), "first", "__n").drop("__n")
