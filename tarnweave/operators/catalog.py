"""Catalog profile, slices, samples and the joins between artefacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.operators.ranking import running
from tarnweave.operators.selection import quantiles


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, blanks): nulls and strings that are empty when trimmed, in one pass."""
    blank = lambda c: F.coalesce(F.sum((F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).cast("long")), F.lit(0))
    return df.agg(*(blank(c).alias(c) for c in columns)).unpivot([], columns, "column", "blanks")


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample deviation, extremes and interpolated quartiles."""
    found = quantiles(df, {"p": F.col(column)}, [0.25, 0.5, 0.75])
    names = {"n": "n", "mean": "mean", "std": "sd", "min": "lo", "p25": "0", "p50": "1", "p75": "2", "max": "hi"}
    return found.select(*(F.col(f"p_{c}").alias(n) for n, c in names.items()))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n) of values that aren't null, most frequent first."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ordered = counted.orderBy(F.desc("n"), "value")
    return ordered.limit(top) if top else ordered


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n): how many values that aren't null each column has."""
    return df.agg(*(F.countDistinct(c).alias(c) for c in columns)).unpivot([], columns, "column", "n")


def shape(df: DataFrame) -> DataFrame:
    """(column, kind, rows): the columns, their types and the number of rows of the table."""
    kinds = df.sparkSession.createDataFrame(df.dtypes, "column string, kind string")
    return kinds.withColumn("rows", F.lit(df.count()).cast("long"))


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: how many rows meet each condition; a null doesn't."""
    return df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()))


def has_columns(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def filled_columns(df: DataFrame, **defaults) -> DataFrame:
    """Columns that aren't there, by a value or another column's."""
    return df.withColumns({n: d if isinstance(d, Column) else F.lit(d) for n, d in defaults.items() if n not in df.columns})


def long_enough(df: DataFrame, n: str = "n_frames", least: int = 16) -> DataFrame:
    return df.where(F.coalesce(F.col(n), F.lit(0)) >= least)


def first_failures(results: DataFrame, key: str, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """(good, some): rows that are ok, and the first ``most`` of the others by key."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    return results.where(ok), results.where(~ok).orderBy(key).limit(most)


def to_sync(rows: DataFrame, path: str, key: str, drops_only: bool = False, limit: int = 0) -> DataFrame:
    """Rows with a path, dropped episodes only on request, the first ``limit`` by key (0: all)."""
    chosen = rows.where(F.col(path).isNotNull())
    if drops_only:
        chosen = chosen.where(F.col("decision") == "drop")
    return chosen.orderBy(key).limit(limit) if limit else chosen


def with_column_of(df: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    """``df`` with a column of another table by key, where it hasn't that column itself; rows
    without a match go, as in an inner join."""
    return df if column in df.columns else df.join(other.select(key, column), key)


def with_operator(df: DataFrame, catalog: DataFrame, key: str, group: str = "operator") -> DataFrame:
    """Inner join with the catalog's demonstrators: a key that stands there twice gives two rows."""
    return df.drop(group).join(catalog.select(key, group), key)


def only_known(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys``; others are passed over."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def by_position(df: DataFrame, matrix: DataFrame, position: str = "row") -> DataFrame:
    """Rows with those of a matrix at their position, which is a column of both: rows of a table
    have no order of their own."""
    return df.join(matrix, position)


def joined_with_misses(df: DataFrame, catalog: DataFrame, key: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, misses): a left join with the catalog's first row of each key, by all its columns, and
    how many rows have no path then."""
    first = first_of_each(catalog, key, *(c for c in catalog.columns if c != key))
    rows = df.join(first, key, "left")
    return rows, rows.agg(F.count_if(F.col(path).isNull()).alias("missing"))


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts by row and the given values, 0 where there are none; no rows where a column isn't there."""
    if not has_columns(df, row, column):
        return df.sparkSession.createDataFrame([], f"`{row}` string" + "".join(f", `{column}_{v}` long" for v in values))
    return df.groupBy(row).agg(*(F.count_if(F.col(column) == v).alias(f"{column}_{v}") for v in values))


def live_slice(df: DataFrame, lab: Column, task: Column, path: str, deleted: str | None = None) -> DataFrame:
    """Rows of a lab and task with a path, deleted ones left out where there is such a column."""
    live = df.where(~F.coalesce(F.col(deleted), F.lit(False))) if deleted in df.columns else df
    return live.where(lab & task & (F.trim(F.coalesce(F.col(path), F.lit(""))) != ""))


def stratified_sample(df: DataFrame, size: str, key: str, n: int) -> DataFrame:
    """Every k-th row by size, k = max(1, rows / n), the first n of them; all if n is 0."""
    if n == 0:
        return df
    step = max(1, df.count() // n)
    at = F.col("__at") - 1
    return running(df, [F.col(size), F.col(key)], "__at").where((at % step == 0) & (at < step * n)).drop("__at")


def random_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in an order that depends on key and seed alone."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def join_dropping_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join in which the left side's columns win."""
    return left.join(right.drop(*(c for c in right.columns if c in left.columns and c != key)), key)


def first_of_each(df: DataFrame, key: str, *order: str) -> DataFrame:
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def with_membership(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """``name``: whether the key is among ``keys``."""
    there = keys.select(key).distinct().withColumn(name, F.lit(True))
    return df.join(there, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
