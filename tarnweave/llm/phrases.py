"""Collocations: phrases that stand together more often than their parts would by chance.

A sketch of all phrases bounds their counts from above; what may reach the least count is compiled,
shard by shard, into automata that count it exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.llm.text import WordHashes, hash_array, mix64
from tarnweave.session import stash

#: UTF-8 bytes with A-Z in lower case, a line end for what ends a piece and a space for a tab.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
END = WordHashes()["\n"]
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Cells of a row of the sketch on its way to be summed.
CHUNK = 1 << 16


@dataclass(frozen=True)
class PhraseParams:
    """``words``: most words of a phrase. ``least``: least count of a candidate. ``cover``: a
    candidate goes if a longer one around it has this percentage of its count. ``top``: rows of each
    language. ``load``: occurrences for a cell of the sketch, whose cells are a power of two
    from ``cells`` to ``most_cells``: beyond that more phrases pass it and are counted in vain.
    ``shard_chars``: text that a task goes through at a time. ``patterns``: phrases of an automaton.
    ``bucket_words``: words of text for a bucket that counts are merged in."""

    words: int = 5
    least: int = 100
    cover: int = 100
    top: int = 2000
    load: int = 16
    cells: int = 1 << 26
    most_cells: int = 1 << 30
    shard_chars: int = 12 << 20
    patterns: int = 1 << 17
    bucket_words: int = 1 << 21


class Shard:
    """The words of some texts of one language, as the automata see them: a text is
    `` a b \n c `` with a line end for the end of each piece, so a phrase with a space on both
    sides meets whole words only, and none across pieces."""

    def __init__(self, lang: str):
        self.lang, self.seed = lang, np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))
        self.texts: list[str] = []
        self.hashes: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.chars = 0

    def add(self, text: str | None, table: WordHashes) -> None:
        plain = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).decode("utf-8", "surrogatepass")
        words = [w for w in plain.replace("\n", " \n ").split(" ") if w]
        words.append("\n")
        self.texts.append(" ".join(words))
        self.hashes.append(hash_array(table, words))
        self.lengths.append(np.fromiter(map(len, words), np.int64, len(words)))
        self.chars += len(self.texts[-1]) + 1

    def text(self) -> str:
        return " " + " ".join(self.texts) + " "

    def phrases(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(width, hash by first word, whether it stays within a piece) for widths 1 to ``most``."""
        words = np.concatenate(self.hashes)
        ends = words == np.uint64(END)
        words = mix64(words ^ self.seed)
        out, whole = words, ~ends
        for width in range(1, most + 1):
            if width > 1:
                out = mix64((out[:-1] + _MIX) ^ words[width - 1 :])
                whole = whole[:-1] & ~ends[width - 1 :]
            if not len(out):
                return
            yield width, out, whole

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each word begins and ends in ``text``."""
        lengths = np.concatenate(self.lengths)
        end = np.cumsum(lengths + 1)
        return end - lengths, end


def _shards(batches, p: PhraseParams) -> Iterator[Shard]:
    """Texts by language, given out when all open ones together have ``shard_chars``."""
    open_shards: dict[str, Shard] = {}
    table, chars = WordHashes(), 0
    for batch in batches:
        for k in range(len(batch["text"])):
            lang, text = batch["lang"][k].as_py(), batch["text"][k].as_py()
            if lang not in open_shards:
                open_shards[lang] = Shard(lang)
            before = open_shards[lang].chars
            open_shards[lang].add(text, table)
            chars += open_shards[lang].chars - before
            if chars >= p.shard_chars:
                yield from open_shards.values()
                open_shards, chars = {}, 0
    yield from open_shards.values()


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _sketched(texts: DataFrame, p: PhraseParams, bits: int) -> DataFrame:
    """(chunk, bits): for each stretch of cells whether the phrases that fall into a cell may reach
    ``least``. What a shard adds is as long as its distinct phrases are many, packed, however many
    cells there are; a count stops at ``least``, which is all that is asked."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if p.least <= np.iinfo(k).max)
    chunk = min(CHUNK, 1 << bits)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for shard in _shards(batches, p):
            cells = np.sort(np.concatenate([_cells(h[whole], bits).astype(np.uint32) for _, h, whole in shard.phrases(p.words)]))
            first = np.flatnonzero(np.diff(cells, prepend=cells[:1] ^ np.uint32(1)))
            seen, cells = np.minimum(np.diff(first, append=len(cells)), p.least).astype(kind), cells[first]
            edges = np.searchsorted(cells, np.arange(0, (1 << bits) + 1, chunk))
            used = np.flatnonzero(np.diff(edges))
            for k in range(0, len(used), 256):
                rows = []
                for c in used[k : k + 256].tolist():
                    row = np.zeros(chunk, kind)
                    row[cells[edges[c] : edges[c + 1]] - c * chunk] = seen[edges[c] : edges[c + 1]]
                    rows.append(pack(row.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(used[k : k + 256]), pa.array(rows, pa.binary())], ["chunk", "cells"])

    def added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, unpack = np.zeros(chunk, np.int64), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for raw in batch["cells"].to_pylist():
                total += np.frombuffer(unpack(raw), kind)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([np.packbits(total >= p.least).tobytes()])], ["chunk", "bits"])

    return texts.mapInArrow(run, "chunk long, cells binary").groupBy("chunk").applyInArrow(added, "chunk long, bits binary")


def _may_reach(texts: DataFrame, p: PhraseParams, bits: int) -> np.ndarray:
    """A bit for each cell: may its phrases reach ``least``? Its size is fixed by ``bits``."""
    size = min(CHUNK, 1 << bits) // 8
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in _sketched(texts, p, bits).collect():
        out[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def _candidates(shard: Shard, marked: np.ndarray, p: PhraseParams, bits: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The phrases of a shard that the sketch, and their own parts, let pass, each with a space on
    both sides; their widths and hashes."""
    text, (begin, end) = shard.text(), shard.spans()
    out, widths, kept, passed = [], [], [], None
    for width, hashes, whole in shard.phrases(p.words):
        cells = _cells(hashes, bits)
        able = whole & ((marked[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1).astype(bool)
        if passed is not None:
            able &= passed[:-1] & passed[1:]  # a phrase stands no more often than its parts
        passed = able
        at = np.flatnonzero(able)
        own, first = np.unique(hashes[at], return_index=True)
        at = at[first]
        out += [text[b - 1 : e + 1] for b, e in zip(begin[at].tolist(), end[at + width - 1].tolist(), strict=True)]
        widths.append(np.full(len(at), width, np.int32))
        kept.append(own)
    return out, np.concatenate(widths), np.concatenate(kept)


def _counted(text: str, phrases: list[str], size: int) -> np.ndarray:
    """How often each phrase stands in ``text``, overlaps included."""
    counts = np.zeros(len(phrases), np.int64)
    for k in range(0, len(phrases), size):
        automaton = ahocorasick.Automaton()
        for i, phrase in enumerate(phrases[k : k + size], k):
            automaton.add_word(phrase, i)
        automaton.make_automaton()
        ends = automaton.iter(text)
        while len(met := np.fromiter((i for _, i in islice(ends, 1 << 20)), np.int64)):
            counts += np.bincount(met, minlength=len(counts))
    return counts


def phrase_counts(texts: DataFrame, p: PhraseParams, marked: np.ndarray, bits: int, buckets: int) -> DataFrame:
    """(lang, phrase, width, a) of all phrases of up to ``words`` words with at least ``least``
    occurrences. What a shard counts travels in ``buckets`` by hash, a row each, which are merged."""
    shared = texts.sparkSession.sparkContext.broadcast(marked)

    def run(batches):
        for shard in _shards(batches, p):
            phrases, widths, hashes = _candidates(shard, shared.value, p, bits)
            counts = _counted(shard.text(), phrases, p.patterns)
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            table = [pa.array([x[1:-1] for x in phrases], pa.string()).take(pa.array(order)), pa.array(widths[order]), pa.array(counts[order])]
            used, first = np.unique(bucket[order], return_index=True)
            lists = [pa.ListArray.from_arrays(pa.array([*first, len(order)], pa.int32()), c) for c in table]
            for k in range(0, len(used), 64):
                part = [pa.array([shard.lang] * len(used[k : k + 64])), pa.array(used[k : k + 64]), *(x.slice(k, 64) for x in lists)]
                yield pa.RecordBatch.from_arrays(part, ["lang", "bucket", "phrases", "widths", "counts"])

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {"phrases": "phrase", "widths": "width", "counts": "f"}
        total = None
        for batch in batches:
            part = pa.table({n: batch[c].flatten() for c, n in names.items()})
            part = part if total is None else pa.concat_tables([total, part])
            total = part.group_by(["phrase", "width"]).aggregate([("f", "sum")]).rename_columns(["phrase", "width", "f"])
        if total is not None:
            total = total.filter(pc.greater_equal(total["f"], p.least))
            lang = pa.array([key[0].as_py()] * len(total), pa.string())
            yield from pa.table({"lang": lang, "phrase": total["phrase"], "width": total["width"], "a": total["f"]}).combine_chunks().to_batches()

    found = texts.mapInArrow(run, "lang string, bucket long, phrases array<string>, widths array<int>, counts array<long>")
    return found.groupBy("lang", "bucket").applyInArrow(merge, "lang string, phrase string, width int, a long")


def _exact(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def collocations(docs: DataFrame, params: PhraseParams | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by score, count and
    bytes.

    Phrases are runs of 2 to ``words`` words within pieces of a text; a is a phrase's count, l and r
    those of its two parts at the cut that scores lowest (the shortest first part of equals), n all
    words of the language, score 1000 * a * n / (l * r), whole and exact by 38-digit arithmetic.

    A shard's candidates are those that the sketch lets pass, their counts are of whole phrases, so
    neither the sketch's size nor hashes that meet change a row. Null and empty texts have no words,
    a null language is ``und``; repeated rows count each time; an empty table gives an empty
    result; other columns are ignored."""
    p = params or PhraseParams()
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    lower = F.regexp_count(F.translate("text", ".,;:!?\n\x0b\x0c\r\t", " " * 11), F.lit("[^ ]+"))
    totals = texts.groupBy("lang").agg(F.sum(lower.cast("long")).alias("n"))
    totals = stash(totals.where("n > 0"))
    words = totals.agg(F.sum("n")).first()[0] or 0
    bits = min(p.most_cells, max(p.cells, words * p.words // p.load)).bit_length() - 1
    counted = stash(phrase_counts(texts, p, _may_reach(texts, p, bits), bits, -(-words // p.bucket_words) or 1))
    candidates = counted.where("width > 1").withColumn("parts", F.split("phrase", " "))
    run = lambda first, size: F.array_join(F.slice("parts", first, size), " ")

    cut = candidates.select("lang", "phrase", "width", "a", "parts", F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", run(F.lit(1), F.col("k")).alias("left"), run(F.col("k") + 1, F.col("width") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(counted.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)), ["lang", side])
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    cut = cut.join(totals, "lang")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("cut")
    scored = cut.groupBy("lang", "phrase", "a").agg(lowest)

    inner = candidates.where("width > 2").select(
        "lang", "a", F.explode(F.expr("flatten(transform(sequence(2, width - 1), w -> transform(sequence(1, width - w + 1), i -> array_join(slice(parts, i, w), ' '))))")).alias("phrase")
    )
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * _exact(F.col("most")) < p.cover * _exact(F.col("a"))))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    first = kept.withColumn("place", F.row_number().over(some)).where(F.col("place") <= p.top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= p.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
