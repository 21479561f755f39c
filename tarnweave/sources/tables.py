"""Table sources and sinks: database, CSV and JSON manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnweave.functions.scalars import is_episode_key, missing_to_null
from tarnweave.operators.catalog import with_membership


def read_database(spark: SparkSession, url: str, table: str, properties: dict[str, str], key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16) -> DataFrame:
    """A database table over TLS; filters and column choice are pushed down, and a numeric key
    with bounds is read in parts."""
    options = {"sslmode": "require"} | properties
    if key and bounds:
        return spark.read.jdbc(url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts, properties=options)
    return spark.read.jdbc(url, table, properties=options)


def lookup(episodes: DataFrame, key: str, value: str) -> DataFrame:
    """The first row of a key, by its other columns where there are several; an error if there is none."""
    order = [c for c, k in episodes.dtypes if "map<" not in k]
    found = episodes.where(F.col(key) == F.lit(value)).orderBy(*order).limit(1)
    if found.isEmpty():
        raise KeyError(value)
    return found


def write_csv(manifest: DataFrame, path: str, digits: int = 4) -> None:
    """CSV files that, by their names, follow each other in order: decisions, best scores first; floats
    with fixed digits. Each range of the order is a file of its own task. Small numbers lose their
    value here: keep Parquet for those."""
    floats = {c for c, k in manifest.dtypes if k in ("double", "float")}
    shown = [F.format_string(f"%.{digits}f", c).alias(c) if c in floats else F.col(c) for c in manifest.columns]
    ordered = manifest.orderBy("decision", F.col("score").desc_nulls_last(), manifest.columns[0])
    ordered.select(*shown).write.mode("overwrite").option("header", True).csv(path)


def write_manifest(manifest: DataFrame, stored: DataFrame, key: str, path: str, clip_column: str = "mp4_path") -> None:
    """All forms of a manifest below ``path``: ``parquet`` with full precision, ``csv`` in order, and
    ``json`` as it is served, a row a line, without the clip's place but with whether it is stored."""
    manifest.write.mode("overwrite").parquet(f"{path}/parquet")
    kept = manifest.sparkSession.read.parquet(f"{path}/parquet")  # the others are of these very rows
    write_csv(kept.drop(clip_column), f"{path}/csv")
    write_json(published(kept, stored, key, clip_column), f"{path}/json")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def json_rows(manifest: DataFrame) -> DataFrame:
    """(json): each row as an object, missing numbers and empty reasons as null."""
    clean = [
        missing_to_null(F.col(c)).alias(c) if k in ("double", "float")
        else F.nullif(F.col(c), F.lit("")).alias(c) if c == "reason" else F.col(c)
        for c, k in manifest.dtypes
    ]
    return manifest.select(F.to_json(F.struct(*clean), {"ignoreNullFields": "false"}).alias("json"))


def published(rows: DataFrame, stored: DataFrame, key: str, path: str) -> DataFrame:
    """The manifest as it is served: without the column ``path``, with ``has_clip``."""
    return with_membership(rows.drop(path), stored, key, "has_clip")


def write_json(manifest: DataFrame, path: str) -> None:
    json_rows(manifest).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON manifests: files of one array, or of a row a line as ``write_json`` has them."""
    return spark.read.json(path, multiLine=True) if path.endswith(".json") else spark.read.json(path)


def valid_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(is_episode_key(F.col(key)))
