"""Session-level helpers: table access and shared-storage materialisation."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Lists of paths that ``stash`` adds to, one for each open ``scratch`` block.
_OPEN: list[list[str]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables of a data directory, read through Spark's own file system layer."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where the session
    names it, else the context's checkpoint folder. Where neither is set, a new folder that goes
    with the process for sessions within one machine's process, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tarnweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the re-read of some files, not the re-computation of
    what led to them, and each later use reads the same rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for made in _OPEN:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose stashed tables are deleted at its end, but for those made by the function that
    it gives, which stashes a result that outlives the block."""
    made: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        out = stash(df)
        kept.add(made[-1])
        return out

    _OPEN.append(made)
    try:
        yield keep
    finally:
        _OPEN.remove(made)
        for name in set(made) - kept:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
