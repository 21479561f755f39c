"""Files of any store that Arrow's file systems reach: ranged reads, copies and listings by tasks."""

from __future__ import annotations

import fnmatch
import io
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    local = re.sub(r"^file:/*", "/", path)
    return (fs.LocalFileSystem(), local) if "://" not in local else fs.FileSystem.from_uri(path)


def read_range(path: str, start: int, length: int) -> bytes:
    """``length`` bytes from ``start``, counted from the end if it is negative; nothing else is read."""
    system, name = located(path)
    with system.open_input_file(name) as f:
        f.seek(start if start >= 0 else max(0, f.size() + start))
        return f.read(length)


def write_file(path: str, content: bytes) -> None:
    """Write to a file beside, then rename: a file is whole or isn't there, however often a task runs."""
    system, name = located(path)
    try:
        out = system.open_output_stream(f"{name}.part")
    except FileNotFoundError:
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        out = system.open_output_stream(f"{name}.part")
    with out as f:
        f.write(content)
    system.move(f"{name}.part", name)


def size_of(path: str) -> int | None:
    system, name = located(path)
    info = system.get_file_info(name)
    return info.size if info.type == fs.FileType.File else None


def _shown(name: str) -> bool:
    """Not one of the names that Spark's file sources leave out."""
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, modified) of the files below a folder whose names match (``*``, ``?``, ``[]``);
    contents aren't read. A folder that isn't there gives no rows.

    One task reads the folder's own names, others all that is below them: no name reaches the driver,
    whose index of files would hold each of them."""
    system, root = located(path.rstrip("/"))
    prefix = "file:" if isinstance(system, fs.LocalFileSystem) else path.rstrip("/").removesuffix(root)
    names, kinds = ["path", "folder", "bytes", "modified"], [pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC")]
    tasks = 2 * max(4, spark.sparkContext.defaultParallelism)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def rows_of(infos: Iterable[fs.FileInfo], below: str) -> Iterator[tuple]:
        for i in infos:
            if i.type in (fs.FileType.File, fs.FileType.Directory) and all(map(_shown, i.path[len(below) :].strip("/").split("/"))):
                yield f"{prefix}{i.path}", i.type == fs.FileType.Directory, i.size, i.mtime

    def top(batches):
        system, root = located(path.rstrip("/"))
        for batch in batches:
            if batch.num_rows:
                own = system.get_file_info(root)
                found = [own] if own.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, allow_not_found=True))
                rows = list(rows_of(found, root.rsplit("/", 1)[0] if own.type == fs.FileType.File else root))
                for k in range(0, len(rows), 8192):
                    yield packed(rows[k : k + 8192])

    def below(batches):
        system, _ = located(path.rstrip("/"))
        matches = re.compile(fnmatch.translate(pattern)).match
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in names), strict=True):
                inner = row[0].removeprefix(prefix)
                some = rows_of(system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True)), inner) if row[1] else [row]
                held += [r for r in some if not r[1] and matches(r[0].rsplit("/", 1)[-1])]
                if len(held) >= 8192:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    schema = "path string, folder boolean, bytes long, modified timestamp"
    return spark.range(0, 1, 1, 1).mapInArrow(top, schema).repartition(tasks).mapInArrow(below, schema).drop("folder")


def stored_keys(files: DataFrame) -> DataFrame:
    """The episode keys among file names."""
    key = F.regexp_extract("path", r"([0-9a-f]{24})\.[^/]*$", 1)
    return files.select(key.alias("episode_hash")).where("episode_hash <> ''").distinct()


def copy_missing(pairs: DataFrame, key: str) -> DataFrame:
    """(key, ok, bytes, error) of (key, source, target) rows: files that are there already stay as they
    are; a copy that fails is a row with its error, not a failed task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, source, target in zip(frame[key], frame["source"], frame["target"], strict=True):
                try:
                    if size_of(target) is None:
                        system, name = located(source)
                        with system.open_input_file(name) as f:
                            write_file(target, f.read())
                    out.append((k, True, size_of(target), None))
                except Exception as e:  # whatever a store raises
                    out.append((k, False, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[key, "ok", "bytes", "error"]).astype({"bytes": "Int64"})

    kind = dict(pairs.dtypes)[key]
    return pairs.select(key, "source", "target").mapInPandas(run, f"{key} {kind}, ok boolean, bytes long, error string")


def to_cache(files: DataFrame, prefix: str, folder: str, poses_only: bool = False) -> DataFrame:
    """(source, target) of an episode's listed files below ``prefix``, without its pictures on request."""
    inside = F.regexp_replace(F.substring_index("path", prefix, -1), "^/+", "")
    rows = files.select(F.col("path").alias("source"), inside.alias("inside"))
    rows = rows.where(~F.col("inside").startswith("images")) if poses_only else rows
    return rows.select("source", F.concat(F.lit(f"{folder.rstrip('/')}/"), "inside").alias("target"))


def sync_folder(spark: SparkSession, source: str, target: str, state: str, pattern: str = "*", poses_only: bool = False, per_batch: int = 10_000) -> DataFrame:
    """Copies what has come into ``source`` since the last call and gives (path, ok, bytes, error) of
    every file ever seen, errors as rows.

    A streaming file source remembers in ``state`` what it has handed out, so a start that finds
    nothing new copies nothing; a batch that a lost driver began is run again, which changes nothing:
    files that are there stay, and a batch's rows replace those of its earlier try."""
    below = f"{located(source)[1].rstrip('/')}/"  # schemes may be written in several ways
    schema = "path string, modificationTime timestamp, length long, content binary"
    names = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    files = names.option("maxFilesPerTrigger", per_batch).load(source).select("path")

    def copy(batch: DataFrame, number: int) -> None:
        pairs = to_cache(batch, below, target, poses_only).withColumn("path", F.col("source"))
        copy_missing(pairs, "path").write.mode("overwrite").parquet(f"{state}/results/batch={number}")

    query = files.writeStream.foreachBatch(copy).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    done = f"{state}/results"
    kinds = "path string, ok boolean, bytes long, error string"
    there = spark._jvm.org.apache.hadoop.fs.Path(done)
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(done).select("path", "ok", "bytes", "error")


def copied_bytes(results: DataFrame) -> int:
    """Bytes of all copies that went well; an error if nothing was found."""
    total = results.agg(F.sum(F.when(F.col("ok"), F.col("bytes")))).first()[0]
    if not total:
        raise FileNotFoundError("nothing was copied")
    return total


def routed(requests: DataFrame, stored: DataFrame, manifest_there: bool, path: str = "path") -> DataFrame:
    """Requests with ``status`` and ``episode_hash``: 200 for the manifest and clips that are stored,
    404 for those that aren't and other paths, 400 for clips of names that are no keys."""
    name = F.regexp_extract(path, r"^/clip/([^/]*)\.mp4$", 1)
    asked = requests.withColumn("episode_hash", F.when(F.col(path).rlike(r"^/clip/[^/]*\.mp4$"), name))
    known = asked.join(stored.select(F.col("episode_hash").alias("__k")).distinct(), F.col("episode_hash") == F.col("__k"), "left")
    is_key: Column = F.col("episode_hash").rlike(r"\A[0-9a-f]{24}\z")
    status = (
        F.when(F.col(path) == "/manifest.json", 200 if manifest_there else 404)
        .when(F.col("episode_hash").isNull(), 404).when(~is_key, 400).when(F.col("__k").isNull(), 404).otherwise(200)
    )
    return known.withColumn("status", status).drop("__k")


def fetch_manifest(spark: SparkSession, url: str, schema: str, seconds: int = 60) -> DataFrame:
    """Rows of a manifest served as a JSON array; an error if the answer isn't one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.request import urlopen

        for frame in frames:
            texts = []
            for address in frame["url"]:
                with urlopen(address, timeout=seconds) as answer:  # raises for other than success
                    texts.append(answer.read().decode())
                if not texts[-1].lstrip().startswith("["):
                    raise ValueError("manifest is not an array")
            yield pd.DataFrame({"text": texts})

    text = spark.createDataFrame([(url,)], "url string").mapInPandas(run, "text string")
    return text.select(F.inline(F.from_json("text", f"array<struct<{schema}>>")))


def read_npz(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, row, values): the named arrays of archives, a row per first index, flattened."""

    def run(batches):
        for batch in batches:
            for where, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as arrays:
                    for name in arrays.files:
                        rows = np.atleast_1d(arrays[name])
                        if rows.dtype.kind in "biuf":
                            values = [r.ravel().tolist() for r in rows.astype(float)]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([where] * len(values)), pa.array([name] * len(values)), pa.array(range(len(values)), pa.int64()), pa.array(values, pa.list_(pa.float64()))],
                                ["path", "name", "row", "values"],
                            )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npz").load(path)
    return files.select("path", "content").mapInArrow(run, "path string, name string, row long, values array<double>")


def write_npz(rows: DataFrame, key: str, order: str, values: str, folder: str) -> DataFrame:
    """(key, bytes): one archive per key with its rows' arrays in order, under the name ``values``."""
    kind = dict(rows.dtypes)[key]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        k, out = part[key].iloc[0], io.BytesIO()
        np.savez_compressed(out, values=np.stack(part.sort_values(order)[values].to_numpy()))
        write_file(f"{folder}/{k}.npz", out.getvalue())
        return pd.DataFrame({key: [k], "bytes": [len(out.getvalue())]})

    return rows.select(key, order, values).groupBy(key).applyInPandas(run, f"{key} {kind}, bytes long")
