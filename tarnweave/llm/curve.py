"""Packing along a space-filling curve: documents that are alike share sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnweave.llm.packing import Encoder, PackParams, _Table
from tarnweave.llm.text import mix64
from tarnweave.session import stash

#: Projections are kept as whole multiples of this, so that their sums don't depend on the order.
UNIT = 1 << 20
#: Bytes that a worker's tables of words and of parts that aren't words hold before they start anew.
WORD_BYTES, PART_BYTES = 144 << 20, 8 << 20
BATCH_ROWS = 1024
#: Latin-1 but for controls and spaces that aren't white space everywhere.
_PLAIN = bytes([*range(9, 14), *range(32, 127), *range(161, 256)])
#: Ranges of the curve, at most; their bounds and sums are all that the driver holds.
MOST_RANGES = 65_536


@dataclass(frozen=True)
class CurveParams:
    """``width``: components of the hashed document vectors; ``dims`` and ``bits``: of the curve;
    ``tie_bits``: of a hash that orders, and can part, the documents of one place on the curve.
    All bits of a key fit into a double. ``range_tokens``: what a range of the curve should hold."""

    tokenizer: str
    capacity: int = 2048
    end_id: int = 1
    width: int = 256
    dims: int = 3
    bits: int = 12
    tie_bits: int = 17
    range_tokens: int = 4 << 20
    seed: int = 11


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (n x dims, each below 2**bits) on the Hilbert curve.

    Coordinates become the curve's own by undoing, from the top bit down, the reflections and
    exchanges of axes that each cube applies to its corners; the place is read across them."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        top, below = np.int64(1) << level, (np.int64(1) << level) - 1
        for i in range(dims):
            turned = (x[i] & top) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(turned, below, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    parity = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        parity ^= np.where((x[-1] >> level) & 1, (np.int64(1) << level) - 1, 0)
    x ^= parity
    place = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            place = (place << 1) | ((axis >> level) & 1)
    return place


class WordEncoder(Encoder):
    """Remembers the ids of whole words between white space, which no part of the tokenizer's
    pattern crosses. A word of letters alone is a part itself; others are put together of theirs."""

    def __init__(self, p: PackParams):
        super().__init__(p)
        self.openers = {t.content[:1] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.table = _Table(self._part, PART_BYTES)
        self.words = _Table(self._word, WORD_BYTES)

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self._part(word)
        return b"".join(self.words[p] if p.isalpha() else self.table[p] for p in self.find(word))

    def _plain(self, text: str) -> bool:
        """Nothing that ``odd`` finds: for Latin-1 alone by its bytes, which is faster."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return not self.odd.search(text)
        if any(c in text for c in self.openers):
            return not self.odd.search(text)
        return not raw.translate(None, _PLAIN)

    def text(self, text: str) -> bytes:
        if self.find is None or not self._plain(text):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.lower().split()))


@cache
def _encoder(p: PackParams) -> WordEncoder:
    """One for all tasks of a worker."""
    return WordEncoder(p)


class Projector:
    """Token ids -> a few coordinates: a signed hash of the ids into ``width`` components, damped
    by the square root and brought to unit length, times fixed Gaussian directions."""

    def __init__(self, p: CurveParams, ids: int = 1 << 16):
        hashed = mix64(np.arange(ids, dtype=np.uint64) + np.uint64(p.seed))
        self.bucket = (hashed % np.uint64(p.width)).astype(np.int64)
        self.sign = np.where(hashed >> np.uint64(63), 1.0, -1.0)
        self.directions = np.random.default_rng(p.seed).normal(size=(p.width, p.dims))
        self.width = p.width

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        ids = ids % len(self.bucket)
        v = np.bincount(self.bucket[ids], self.sign[ids], self.width)
        v = np.sign(v) * np.sqrt(np.abs(v))
        return v @ self.directions / max(np.sqrt(v @ v), 1e-9)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Whole texts go to the workers by BATCH_ROWS at a time while the block runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _tokenised(docs: DataFrame, p: CurveParams) -> DataFrame:
    """(id, n, raw, crc, at): ids as little-endian words of 2 bytes where all fit, else of 4."""

    def run(batches):
        encoder, project = _encoder(PackParams(p.tokenizer, p.capacity, p.end_id)), Projector(p)
        end = np.array([p.end_id], "<u4").tobytes()
        for batch in batches:
            keys, texts = batch["id"], batch["text"]
            for k in range(0, len(keys), 64):
                rows = []
                for text in texts.slice(k, 64).to_pylist():
                    raw = encoder.text(text or "") + end
                    ids = np.frombuffer(raw, "<u4")
                    at = np.rint(project(ids) * UNIT).astype(np.int64)
                    rows.append((len(ids), ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else raw, zlib.crc32(raw), at))
                columns = (pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())), strict=True))
                yield pa.RecordBatch.from_arrays([keys.slice(k, 64), *columns], ["id", "n", "raw", "crc", "at"])

    return docs.mapInArrow(run, "id long, n long, raw binary, crc long, at array<long>")


def cells_of(rows: DataFrame, p: CurveParams) -> tuple[list[Column], int, int]:
    """Each row's cell along each axis, an expression; how many rows there are, and their tokens.

    Coordinates are centred and scaled over all rows and pass a logistic curve, so that cells fill
    about evenly."""
    at = [F.col("at")[j] for j in range(p.dims)]
    moments = [f(x.cast("decimal(38,0)")) for x in at for f in (F.sum, lambda x: F.sum(x * x))]
    count, tokens, *sums = rows.agg(F.count("*"), F.sum("n"), *moments).first()
    cells = []
    for j, x in enumerate(at if count else []):
        mean = float(sums[2 * j]) / count
        spread = max(float(sums[2 * j + 1]) / count - mean * mean, 0.0) ** 0.5 or 1.0
        share = F.lit(1.0) / (F.exp((x - F.lit(mean)) * F.lit(-1.702 / spread)) + 1.0)
        cells.append(F.least(F.floor(share * (1 << p.bits)), F.lit((1 << p.bits) - 1)).cast("long"))
    return cells, count, tokens or 0


def keyed(rows: DataFrame, cells: list[Column], bounds: np.ndarray, p: CurveParams) -> DataFrame:
    """``rows`` with ``at``: their key on the curve and the range between ``bounds`` that it is in.
    The key's low bits are a hash of id and content."""

    @F.pandas_udf("struct<key long, range int>")
    def place(tie: pd.Series, *axes: pd.Series) -> pd.DataFrame:
        key = hilbert(np.column_stack(axes), p.bits) << p.tie_bits | tie.to_numpy()
        return pd.DataFrame({"key": key, "range": np.searchsorted(bounds, key, "right").astype(np.int32)})

    tie = F.shiftrightunsigned(F.xxhash64("id", "crc", "n"), 64 - p.tie_bits)
    return rows.withColumn("at", place(tie, *cells))


def _ends(total: int, capacity: int) -> np.ndarray:
    """Ends of the sequences after the last full one: the rest in powers of two, largest first."""
    at, out = total - total % capacity, []
    for level in range(capacity.bit_length(), -1, -1):
        if (total - at) >> level & 1:
            at += 1 << level
            out.append(at)
    return np.array(out, np.int64)


def _cut(placed: DataFrame, total: int, p: CurveParams) -> DataFrame:
    """Rows at their ``begin`` in the one stream -> pieces that end where sequences do."""
    full, ends = total - total % p.capacity, _ends(total, p.capacity)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(k, 256).to_pylist():
                    n, begin = row["n"], row["begin"]
                    ids = np.frombuffer(row["raw"], "<u2" if len(row["raw"]) == 2 * n else "<u4").astype("<u4")
                    at = 0
                    while at < n:
                        here = begin + at
                        if here < full:
                            sequence, offset = divmod(here, p.capacity)
                            length = min(n - at, p.capacity - offset)
                        else:
                            s = int(np.searchsorted(ends, here, "right"))
                            sequence, offset = full // p.capacity + s, here - (int(ends[s - 1]) if s else full)
                            length = min(n - at, int(ends[s]) - here)
                        out.append((row["id"], at, length, zlib.crc32(ids[at : at + length].tobytes()), n, sequence, offset))
                        at += length
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return placed.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def pack_along_curve(docs: DataFrame, params: CurveParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id (under the name of ``id_col``), start, length, ids_crc32,
    doc_tokens, sequence_id and offset.

    Documents (a text's ids and ``end_id``) follow each other in the order of their keys on the
    curve as one stream that is cut every ``capacity`` tokens; what is left at its end goes into
    sequences of powers of two, so nothing is padded. The stream's ranges are sorted side by side;
    the driver learns the sum of each range alone. Rows of one place on the curve, copies
    above all, are ordered and parted by the key's low bits.

    Null and empty texts are the ``end_id`` alone. Every row is packed, repeated rows and ids each
    on their own; null ids stay null, others must be whole numbers. An empty table gives an empty
    result; other columns are ignored, whatever their names."""
    p = params
    with _small_batches(docs.sparkSession):
        rows = stash(_tokenised(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), p))
    cells, count, total = cells_of(rows, p)
    if not count:
        return _cut(rows.selectExpr("id", "n", "raw", "0L as begin"), 0, p).withColumnRenamed("id", id_col)
    parts = min(MOST_RANGES, max(1, -(-total // p.range_tokens)))
    shares = [k / parts for k in range(1, parts)]
    keys = keyed(rows, cells, np.empty(0, np.int64), p).select("at.key")
    bounds = np.unique(np.array(keys.approxQuantile("key", shares, 0.25 / parts) if shares else [], np.int64))
    dealt = keyed(rows, cells, bounds, p).select("id", "n", "raw", "crc", "at.key", "at.range")
    sums = {r["range"]: r["total"] for r in dealt.groupBy("range").agg(F.sum("n").alias("total")).collect()}
    before = np.cumsum([0] + [sums.get(k, 0) for k in range(len(bounds))])
    firsts = F.broadcast(docs.sparkSession.createDataFrame([(k, int(x)) for k, x in enumerate(before)], "range int, first long"))
    along = Window.partitionBy("range").orderBy("key", "id", "crc", "n").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("upto", F.sum("n").over(along)).join(firsts, "range")
    placed = placed.select("id", "n", "raw", (F.col("first") + F.col("upto") - F.col("n")).alias("begin"))
    return _cut(placed, total, p).withColumnRenamed("id", id_col)
