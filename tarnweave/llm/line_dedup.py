"""Line dedup: rolling hashes over line hashes anchor repeated runs of lines, which are removed."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnweave.llm.hot import join_by_weight, packed, unpacked
from tarnweave.llm.text import mix64
from tarnweave.session import stash

_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class ChunkParams:
    """A chunk is ``window`` lines in a row, and one begins at every line: so any repeated run of
    that many lines is a union of repeated chunks, rims and all, wherever it stands. Runs of fewer
    than ``min_lines`` lines or ``min_words`` words are never removed."""

    window: int = 2
    min_lines: int = 2
    min_words: int = 1


def rolling_hashes(lines: list[str], p: ChunkParams) -> np.ndarray:
    """Hash of each chunk, in order of its first line."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines), np.uint64, len(lines))
    n = max(0, len(h) - p.window + 1)
    rolling = np.zeros(n, np.uint64)
    for k in range(p.window):
        rolling = rolling * _BASE + h[k : k + n]
    return mix64(rolling)


def chunks_of(text: str | None, p: ChunkParams) -> list[tuple[int, int, str]]:
    """(first line, number of lines, text) of each chunk."""
    lines = text.split("\n") if text else []
    return [(k, p.window, "\n".join(lines[k : k + p.window])) for k in range(len(lines) - p.window + 1)]


def _chunk_hashes(docs: DataFrame, p: ChunkParams) -> DataFrame:
    def run(batches):
        for batch in batches:
            hashes = [rolling_hashes(t.split("\n") if t else [], p) for t in batch["text"].to_pylist()]
            sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
            if not sizes.sum():
                continue
            at = pa.array(np.repeat(np.arange(len(hashes)), sizes))
            start = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(at), batch["th"].take(at), pa.array(start), pa.array(np.concatenate(hashes).view(np.int64))],
                ["id", "th", "start", "hash"],
            )

    return docs.mapInArrow(run, "id long, th long, start int, hash long")


def _with_lines(text: Column, use) -> Column:
    """``use(lines)``, the lines of ``text`` split once."""
    return F.element_at(F.transform(F.array(F.split(text, "\n", -1)), use), 1)


def _bodies(candidates: DataFrame, p: ChunkParams) -> DataFrame:
    """Hash and text of each candidate chunk of (id, th, text, chunks) rows."""
    body = lambda lines, s: F.array_join(F.slice(lines, s + 1, F.lit(p.window)), "\n")
    found = lambda lines, c: F.struct(c["start"].alias("start"), c["hash"].alias("hash"), body(lines, c["start"]).alias("body"))
    every = _with_lines(F.col("text"), lambda lines: F.transform("chunks", lambda c: found(lines, c)))
    return candidates.select("id", "th", F.inline(every))


def _runs(starts: Column, window: int) -> Column:
    """array<struct<start, stop>> of the runs that chunks at sorted ``starts`` form by sharing lines."""
    begins = F.filter(starts, lambda s, i: (i == 0) | (s >= F.get(starts, i - 1) + window))
    ends = F.filter(starts, lambda s, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) >= s + window))
    return F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("start"), (b + window).alias("stop")))


def _cut(lines: Column, runs: Column, p: ChunkParams) -> Column:
    """struct<text, removed>: what is left without the runs that are long enough."""
    words = lambda r: F.size(
        F.filter(F.split(F.array_join(F.slice(lines, r["start"] + 1, r["stop"] - r["start"]), " "), r"(?U)\s+"), lambda w: w != "")
    )
    long_enough = F.filter(runs, lambda r: (r["stop"] - r["start"] >= p.min_lines) & (words(r) >= p.min_words))

    def without(gone: Column) -> Column:
        # runs that touch come in order and don't overlap, so what lies between them stays
        lows = F.concat(F.array(F.lit(0)), F.transform(gone, lambda r: r["stop"]))
        highs = F.concat(F.transform(gone, lambda r: r["start"]), F.array(F.size(lines)))
        kept = F.flatten(F.zip_with(lows, highs, lambda a, b: F.slice(lines, a + 1, b - a)))
        removed = F.aggregate(gone, F.lit(0), lambda n, r: n + r["stop"] - r["start"])
        return F.struct(F.array_join(kept, "\n").alias("text"), removed.alias("removed"))

    return F.element_at(F.transform(F.array(long_enough), without), 1)


def _same(left: DataFrame, right: DataFrame):
    return left["id"].eqNullSafe(right["id"]) & left["th"].eqNullSafe(right["th"])


def remove_repeated_chunks(
    docs: DataFrame, params: ChunkParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row and column of ``docs``, the text without its repeated chunks; then n_lines and
    n_removed_lines.

    A chunk's first occurrence (by id, then text hash, then line) stays; every later one whose
    bytes are equal goes, one line at its rim or all of a document included. Chunks whose hash
    alone repeats stay, and so do lines that repeat without a neighbour. The first occurrence of a
    line is never removed, so no line is lost; of a line that is repeated three times or more in
    direct succession, one stays.

    Null texts stay null with no lines; a text all of whose lines go becomes empty; single-line
    texts stay. Rows of equal id and text are one document and get one result. Null ids are ids
    like others, first in order. Input columns named n_lines or n_removed_lines are replaced; an
    empty table gives an empty result."""
    p = params or ChunkParams()
    plain = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")
    )
    chunks = stash(_chunk_hashes(plain, p).distinct())
    repeated = chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    again = join_by_weight(chunks, repeated, "hash", "n", chunks.count())
    found = again.groupBy("id", "th").agg(F.collect_list(F.struct("start", "hash")).alias("chunks"))
    texts = plain.join(found.hint("merge"), _same(plain, found)).select(plain["*"], "chunks")
    bodies = stash(_bodies(texts, p).distinct())
    place = F.struct("id", "th", "start")
    equal = bodies.groupBy("hash", "body").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    cuts = (
        join_by_weight(bodies, equal, ["hash", "body"], "n", bodies.count())
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("id", "th")
        .agg(F.array_sort(F.collect_list("start")).alias("starts"))
        .select(F.col("id").alias("cut_id"), F.col("th").alias("cut_th"), _runs(F.col("starts"), p.window).alias("runs"))
    )
    own = (text_col, "n_lines", "n_removed_lines")
    rows = docs.select(
        packed(docs, own).alias("row"), docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("th"),
        docs[text_col].alias("text"),
    )
    joined = rows.join(
        cuts.hint("merge"), F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("th") == F.col("cut_th")), "left"
    )
    cut = F.when(F.col("runs").isNotNull(), _with_lines(F.col("text"), lambda lines: _cut(lines, F.col("runs"), p)))
    return joined.select("row", "text", cut.alias("cut")).select(
        *unpacked(docs, "row", own).values(),
        F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.col("cut.text")).alias(text_col),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"),
        F.coalesce("cut.removed", F.lit(0)).cast("long").alias("n_removed_lines"),
    )
