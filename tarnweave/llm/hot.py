"""Joins where one key may have a great share of all rows, and where names may clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this part of all rows on, so there are fewer hot keys than this number.
PARTS = 4096


def join_by_weight(rows: DataFrame, classes: DataFrame, key: str | list[str], weight: str, total: int | None = None, small: int = 0) -> DataFrame:
    """``rows`` joined with ``classes``, which has one row per key and says how many rows have it.

    Keys with more than one in ``PARTS`` of all rows are fewer than ``PARTS``, whatever the size of
    the tables: they are broadcast, so their rows stay where they are. All others meet by
    sort-merge, where none can fill a task. Rows whose key isn't in ``classes`` go. ``total`` is at
    least the sum of weights, counted here where not given; up to ``small`` in all, which bounds the
    number of classes too, all of them are broadcast."""
    if total is None:
        total = classes.agg(F.sum(weight)).first()[0] or 0
    keys = [key] if isinstance(key, str) else key
    if total <= small:
        return rows.join(F.broadcast(classes), keys)
    is_hot = F.col(weight) * PARTS > F.lit(total)
    hot = F.broadcast(classes.where(is_hot))
    others = rows.join(F.broadcast(classes.where(is_hot).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(others.join(classes.where(~is_hot).hint("merge"), keys))


def likely_among(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key is among ``ids``, and some others: a filter before a join by key, so that
    what surely meets nothing isn't shuffled.

    Keys are marked in a map of 2**26 bits, which is broadcast: 8 MB, whatever the size of the
    tables. The more ids there are, the more other rows pass; none of theirs is lost."""
    place = F.pmod(F.xxhash64(key), F.lit(1 << 26))
    bits = ids.select(place.alias("__at")).groupBy(F.bitmap_bucket_number("__at").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__at")).alias("__bits")
    )
    met = rows.withColumn("__at", place).join(F.broadcast(bits), F.bitmap_bucket_number("__at") == F.col("__bucket"))
    at = F.bitmap_bit_position("__at").cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.where(F.getbit(byte, at % 8) == 1).select(*rows.columns)


def packed(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """The columns of ``df`` as one struct, so that no name of theirs meets one of an operator's."""
    chosen = [df[c] for c in df.columns if c not in without]
    return F.struct(*chosen) if chosen else F.struct(F.lit(None).cast("string").alias("none"))


def unpacked(df: DataFrame, row: str, without: tuple[str, ...] = ()) -> dict[str, Column]:
    """The columns of ``df`` by name, taken out of the struct ``row``."""
    return {c: F.col(row).getField(c).alias(c) for c in df.columns if c not in without}
