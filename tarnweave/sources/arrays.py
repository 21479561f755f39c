"""Array groups (Zarr version 3, regular chunk grids) as long tables."""

from __future__ import annotations

import gzip
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tarnweave.sources.files import listing, located, read_range

_META = (
    "node_type string, shape array<long>, data_type string, chunk_grid struct<configuration:struct<chunk_shape:array<long>>>,"
    " codecs array<struct<name:string>>, attributes string"
)
_KEY = r"/([0-9a-f]{24})(?:\.[^/]*)?/"


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """(episode_hash, array, node_type, shape, data_type, chunk_shape, codecs, attributes): groups and
    arrays under ``path/<episode>/``; a group's array name is empty."""

    def content(batches):
        for batch in batches:
            read = [read_range(p, 0, n) for p, n in zip(batch["path"].to_pylist(), batch["bytes"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["path"], pa.array(read, pa.binary())], ["path", "content"])

    files = listing(spark, path, "zarr.json").select("path", "bytes").mapInArrow(content, "path string, content binary")
    m = F.from_json(F.col("content").cast("string"), _META)
    return files.select(
        F.regexp_extract("path", _KEY, 1).alias("episode_hash"), F.regexp_extract("path", _KEY + r"(.*?)/?zarr\.json$", 2).alias("array"),
        m.alias("m"),
    ).select(
        "episode_hash", "array", "m.node_type", "m.shape", "m.data_type", F.col("m.chunk_grid.configuration.chunk_shape").alias("chunk_shape"),
        F.transform("m.codecs", lambda c: c["name"]).alias("codecs"), "m.attributes",
    )


def attributes(meta: DataFrame, schema: str) -> DataFrame:
    """(episode_hash, ...): the groups' attributes by the given schema."""
    return meta.where("node_type = 'group' and array = ''").select("episode_hash", F.from_json("attributes", schema).alias("a")).select("episode_hash", "a.*")


SCHEMA = "episode_hash string, array string, row long, values array<double>, ok boolean, error string"
_GROUP = re.compile(r"([0-9a-f]{24})(?:\..*)?")
#: Bounds that a filter on ``row`` gives, as what they add to a half-open range.
_LOWER, _UPPER = {"GreaterThanOrEqual": 0, "GreaterThan": 1}, {"LessThan": 0, "LessThanOrEqual": 1}


def fill_value(said) -> float:
    """A stored fill value as a number; JSON has names for what isn't finite."""
    return float({"NaN": "nan", "Infinity": "inf", "-Infinity": "-inf"}.get(said, said) if isinstance(said, str) else said or 0)


def decoded_chunk(raw: bytes, meta: dict) -> np.ndarray:
    """One stored chunk as numbers, by the codecs that its array names, last first."""
    order = "<"
    for codec in reversed(meta["codecs"]):
        name, options = codec["name"], codec.get("configuration") or {}
        if name == "zstd":
            import zstandard

            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        elif name == "gzip":
            raw = gzip.decompress(raw)
        elif name == "crc32c":
            raw = raw[:-4]
        elif name == "bytes":
            order = ">" if options.get("endian") == "big" else "<"
        else:
            raise ValueError(f"codec {name}")
    shape = meta["chunk_grid"]["configuration"]["chunk_shape"]
    return np.frombuffer(raw, np.dtype(meta["data_type"]).newbyteorder(order)).reshape(shape)


def band(meta: dict, first: int, read: Callable[[str], bytes | None], limit: int, separator: str = "/") -> np.ndarray:
    """The rows (up to ``limit``) of the chunks that begin at row ``first``, each chunk at the place that its
    index says, the fill value where none is stored."""
    shape, grid = meta["shape"], meta["chunk_grid"]["configuration"]["chunk_shape"]
    rows = min(first + grid[0], limit) - first
    out = np.full([rows, *shape[1:]], fill_value(meta.get("fill_value")))
    for rest in np.ndindex(*(-(-n // c) for n, c in zip(shape[1:], grid[1:], strict=True))):
        raw = read(separator.join(map(str, ("c", first // grid[0], *rest))))
        if raw is not None:
            place = tuple(slice(k * c, min((k + 1) * c, n)) for k, c, n in zip(rest, grid[1:], shape[1:], strict=True))
            there = out[(slice(None), *place)]
            there[...] = decoded_chunk(raw, meta)[tuple(map(slice, there.shape))]
    return out


class ArrayGroups(DataSource):
    """Groups of arrays, one below each episode's folder under ``path``, as rows of SCHEMA. Options:
    ``path``, ``episodes_per_task``."""

    @classmethod
    def name(cls) -> str:
        return "array_groups"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArrayReader:
        return ArrayReader(self.options["path"], int(self.options.get("episodes_per_task", 4)))


class ArrayReader(DataSourceReader):
    """Filters on episode, array and row choose folders, arrays and chunks before anything is read of
    them; all of them are applied again to the rows. The driver lists the episodes' folders, no more."""

    def __init__(self, path: str, per_task: int):
        self.path, self.per_task = path.rstrip("/"), per_task
        self.episodes: set | None = None
        self.names: set | None = None
        self.low, self.high = 0, None

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) else None
            if column in ("episode_hash", "array") and type(f).__name__ in ("EqualTo", "In"):
                chosen = set(f.value) if type(f).__name__ == "In" else {f.value}
                kind = "episodes" if column == "episode_hash" else "names"
                before = getattr(self, kind)
                setattr(self, kind, chosen if before is None else before & chosen)
            elif column == "row" and isinstance(getattr(f, "value", None), int):
                name = type(f).__name__
                if name in _LOWER or name == "EqualTo":
                    self.low = max(self.low, f.value + _LOWER.get(name, 0))
                if name in _UPPER or name == "EqualTo":
                    high = f.value + _UPPER.get(name, 1)
                    self.high = high if self.high is None else min(self.high, high)
            yield f

    def partitions(self) -> list[InputPartition]:
        system, root = located(self.path)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        groups = [(m[1], i.base_name) for i in found if i.type == fs.FileType.Directory and (m := _GROUP.fullmatch(i.base_name))]
        names = sorted(name for key, name in groups if self.episodes is None or key in self.episodes)
        return [InputPartition(names[k : k + self.per_task]) for k in range(0, len(names), self.per_task)] or [InputPartition([])]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        system, root = located(self.path)
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.bool_(), pa.string()]
        batch = lambda columns: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in SCHEMA.split(", ")])

        def content(name: str) -> bytes | None:
            try:
                with system.open_input_file(name) as f:
                    return f.read()
            except FileNotFoundError:
                return None

        for folder in partition.value:
            key, base = _GROUP.fullmatch(folder)[1], f"{root}/{folder}"
            try:
                group = json.loads(content(f"{base}/zarr.json") or b"{}").get("attributes", {})
                names = sorted(self.names if self.names is not None else self._arrays(system, base))
            except Exception as e:  # a bad group is a row, not a failed task
                yield batch([[key], [None], [None], [None], [False], [f"{type(e).__name__}: {e}"]])
                continue
            for name in names:
                try:
                    stored = content(f"{base}/{name}/zarr.json")
                    if stored is None:
                        continue
                    meta = json.loads(stored)
                    if meta["node_type"] != "array" or not meta["shape"]:
                        continue
                    key_encoding = (meta.get("chunk_key_encoding") or {}).get("configuration") or {}
                    frames = group.get("total_frames")
                    limit = min(n for n in (meta["shape"][0], frames, self.high) if n is not None)
                    step = meta["chunk_grid"]["configuration"]["chunk_shape"][0]
                    for first in range(self.low // step * step, limit, step):
                        table = band(meta, first, lambda chunk: content(f"{base}/{name}/{chunk}"), limit, key_encoding.get("separator", "/"))  # noqa: B023
                        n = len(table)
                        rows = table.reshape(n, -1)
                        values = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))
                        yield batch([[key] * n, [name] * n, np.arange(first, first + n), values, [True] * n, [None] * n])
                except Exception as e:  # a bad array is a row, not a failed task
                    yield batch([[key], [name], [None], [None], [False], [f"{type(e).__name__}: {e}"]])

    @staticmethod
    def _arrays(system: fs.FileSystem, base: str) -> list[str]:
        found = system.get_file_info(fs.FileSelector(base, recursive=True))
        return [i.path[len(base) + 1 : -len("/zarr.json")] for i in found if i.base_name == "zarr.json" and len(i.path) > len(base) + len("/zarr.json")]


def read_arrays(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """(episode_hash, array, row, values, ok, error): the arrays' rows, flattened, up to the group's
    total_frames where it says so; chunks that aren't stored hold the fill value. An array that can't
    be read is one row with its error. Filters by array, episode and row are pushed to the reader."""
    spark.dataSource.register(ArrayGroups)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("array_groups").option("path", path).load()
    return rows if names is None else rows.where(F.col("array").isin(names))


def pose_rows(arrays: DataFrame) -> DataFrame:
    """(episode_hash, body, frame_idx, x, y, z, q) of pose arrays: left, right and head."""
    body = F.when(F.col("array") == "obs_head_pose", "head").otherwise(F.regexp_extract("array", r"^(left|right)\.obs_ee_pose$", 1))
    v = lambda i: F.get("values", F.lit(i))
    return arrays.where("ok").withColumn("body", body).where("body <> ''").select(
        "episode_hash", "body", F.col("row").alias("frame_idx"), v(0).alias("x"), v(1).alias("y"), v(2).alias("z"), F.array(*map(v, range(3, 7))).alias("q")
    )


def described(spark: SparkSession, path: str, most: int = 4000) -> DataFrame:
    """(episode_hash, array, shape, data_type, chunk_shape, attributes, head): what a group holds, its
    attributes' first characters, and of each array of two axes the first seven numbers."""
    meta = metadata(spark, path)
    head = read_arrays(spark, path).where("ok and row = 0").select("episode_hash", "array", F.slice("values", 1, 7).alias("head"))
    flat = F.col("head").isNotNull() & (F.size("shape") == 2) & (F.get("shape", F.lit(0)) > 1) & ~F.col("array").startswith("images")
    return meta.join(head, ["episode_hash", "array"], "left").select(
        "episode_hash", "array", "shape", "data_type", "chunk_shape", F.substring("attributes", 1, most).alias("attributes"),
        F.when(flat, F.col("head")).alias("head"),
    )


def annotations(spark: SparkSession, path: str, name: str = "annotations") -> DataFrame:
    """(episode_hash, span, text, ok, error): the language spans of each episode, texts of any length
    one after the other; an array that can't be read is one row with its error."""
    meta = metadata(spark, path).where(F.col("array") == name).select("episode_hash", "codecs", F.col("shape")[0].alias("n"), F.col("chunk_shape")[0].alias("step"))
    chunks = listing(spark, path).where(F.col("path").contains(f"/{name}/c/")).select(
        F.regexp_extract("path", _KEY, 1).alias("episode_hash"), F.regexp_extract("path", r"/c/(\d+)$", 1).cast("long").alias("chunk"), "path", "bytes"
    )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    raw = read_range(row["path"], 0, row["bytes"])
                    if "zstd" in row["codecs"]:
                        import zstandard

                        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
                    if "vlen-utf8" not in row["codecs"]:
                        raise ValueError(f"codecs {row['codecs']}")
                    texts, at, first = [], 4, row["chunk"] * row["step"]
                    for _ in range(min(int.from_bytes(raw[:4], "little"), row["n"] - first)):
                        size = int.from_bytes(raw[at : at + 4], "little")
                        texts.append(raw[at + 4 : at + 4 + size].decode())
                        at += 4 + size
                    k = len(texts)
                    columns = [[row["episode_hash"]] * k, range(first, first + k), texts, [True] * k, [None] * k]
                except Exception as e:  # a bad chunk is a row, not a failed task
                    columns = [[row["episode_hash"]], [None], [None], [False], [f"{type(e).__name__}: {e}"]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["episode_hash", "span", "text", "ok", "error"])

    kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
    return chunks.join(meta, "episode_hash").mapInArrow(run, "episode_hash string, span long, text string, ok boolean, error string")


def middle_frame(index: DataFrame, groups: DataFrame) -> DataFrame:
    """(episode_hash, frame_idx): the frame in the middle of each episode of ``frame_sizes`` rows, by the
    number that its group (episode_hash, total_frames) declares, else by the last one stored."""
    last = index.where("ok").groupBy("episode_hash").agg((F.max("frame_idx") + 1).alias("n"))
    declared = groups.groupBy("episode_hash").agg(F.max("total_frames").alias("declared"))
    return last.join(declared, "episode_hash", "left").select("episode_hash", F.floor(F.coalesce("declared", "n") / 2).alias("frame_idx"))
