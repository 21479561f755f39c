"""Best-fit packing: exact-complement combinations of lengths, then best fit of what is left."""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.session import stash

#: Bytes that a worker's table of parts holds before it starts anew.
TABLE_BYTES = 224 << 20


@dataclass(frozen=True)
class PackParams:
    """``tokenizer``: path of a tokenizers JSON file. ``by_part``: let a worker remember what the
    tokenizer makes of each part that its pattern splits off. ``parts``: into how many parts
    pieces of one length are numbered side by side, ``full_parts`` those of ``capacity``."""

    tokenizer: str
    capacity: int = 2048
    end_id: int = 0
    by_part: bool = True
    parts: int = 16
    full_parts: int = 1024


class _Table(dict):
    """key -> bytes by ``make``, remembered up to about ``limit`` bytes."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.held = make, limit, 0

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        self.held += 180 + len(key) + len(value)
        if self.held > self.limit:
            self.clear()
            self.held = 0
        self[key] = value
        return value


class Encoder:
    """Texts -> little-endian unsigned 32-bit ids, ``end_id`` not added.

    Where ``parts`` allows it and the tokenizer lower-cases, splits by a pattern and maps bytes,
    these steps are taken here for texts up to extended Latin, and what the model makes of a part
    is remembered. Other texts and those with special tokens go through the tokenizer whole."""

    def __init__(self, p: PackParams):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(p.tokenizer)
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        split = self._split(spec) if p.by_part else None
        self.find = split.findall if split else None
        special = "|".join(re.escape(x["content"]) for x in spec["added_tokens"])
        #: Controls (the libraries differ on which are white space), other scripts, special tokens.
        self.odd = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\xa0\u0130\u0250-\U0010ffff]" + (f"|{special}" if special else ""))
        self.table = _Table(self._part, TABLE_BYTES)

    def _split(self, spec: dict) -> re.Pattern | None:
        """The tokenizer's pattern over the alphabet below U+0250, if its steps are those known."""
        from tokenizers.pre_tokenizers import ByteLevel

        before = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if before != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            return None
        first, second = steps
        if first["behavior"] != "Removed" or not first["invert"] or second["use_regex"] or second["add_prefix_space"]:
            return None
        mapped = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: mapped.pre_tokenize_str(chr(c))[0][0] for c in range(0x21, 0x250)}
        pattern = first["pattern"]["Regex"]
        for name in ("L", "N"):
            members = "".join(re.escape(c) for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == name)
            pattern = pattern.replace(rf"\p{{{name}}}", members)
        return None if r"\p" in pattern else re.compile(pattern)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.bytes_of))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def text(self, text: str) -> bytes:
        if self.find is None or self.odd.search(text):
            return self.whole(text)
        return b"".join(map(self.table.__getitem__, self.find(text.lower())))


def _pieces(docs: DataFrame, p: PackParams, with_ids: bool) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each text's ids and ``end_id``, cut only
    where longer than ``capacity``."""

    def run(batches):
        encoder = Encoder(p)
        end = np.array([p.end_id], "<u4").tobytes()
        step = 4 * p.capacity
        for batch in batches:
            keys, texts = batch["id"].to_pylist(), batch["text"].to_pylist()
            for k in range(0, len(keys), 64):
                rows = []
                for key, text in zip(keys[k : k + 64], texts[k : k + 64], strict=True):
                    raw = encoder.text(text or "") + end
                    for piece, at in enumerate(range(0, len(raw), step)):
                        part = raw[at : at + step]
                        row = (key, piece, at // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, np.frombuffer(part, "<u4")) if with_ids else row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)], names
                )

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return docs.mapInArrow(
        run, "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    )


class _Stock:
    """How many pieces of each length are left, and an index of the sums of one, two and three.

    ``left[s]`` says how many single lengths make s; ``pair[s]`` and ``triple[s]`` hold the largest
    length of two or three that do (0: none). Stock only shrinks, so an entry whose lengths have
    run out moves on to the next smaller length and never back."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.pair, self.triple = np.zeros((2, len(counts)), np.int64)
        lengths = np.flatnonzero(counts)
        for index, addends in ((self.pair, lambda x: lengths[lengths <= x]), (self.triple, lambda x: np.flatnonzero(self.pair))):
            for x in lengths:  # ascending: the largest stays
                sums = x + addends(x)
                index[sums[sums < len(counts)]] = x

    def take(self, lengths: tuple[int, ...]) -> int:
        need = Counter(lengths)
        times = min(int(self.left[n]) // m for n, m in need.items())
        for n, m in need.items():
            self.left[n] -= m * times
        return times

    def has(self, lengths: tuple[int, ...]) -> bool:
        return all(self.left[n] >= m for n, m in Counter(lengths).items())

    def one(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if gap > 0 and self.left[gap] else None

    def _pair_from(self, gap: int, x: int) -> int:
        """The largest length up to x that makes ``gap`` with one no longer than it, 0 if none does."""
        large = np.arange(x, (gap - 1) // 2, -1)
        fits = (self.left[large] > 0) & (self.left[gap - large] > (2 * large == gap))
        return int(large[fits.argmax()]) if fits.any() else 0

    def two(self, gap: int) -> tuple[int, ...] | None:
        x = int(self.pair[gap]) if gap > 1 else 0
        if x and not self.has((x, gap - x)):
            x = self.pair[gap] = self._pair_from(gap, x - 1)
        return (x, gap - x) if x else None

    def three(self, gap: int) -> tuple[int, ...] | None:
        x = int(self.triple[gap]) if gap > 2 else 0
        while x:
            rest = self.two(gap - x) if self.left[x] else None
            if rest and not self.has((x, *rest)):  # x is one of the two as well: are there others?
                self.left[x] -= 1
                other = self._pair_from(gap - x, gap - x - 1)
                self.left[x] += 1
                rest = (other, gap - x - other) if other else None
            if rest:
                return (x, *rest)
            smaller = np.arange(x - 1, 0, -1)
            fits = (self.left[smaller] > 0) & (self.pair[gap - smaller] > 0)
            x = self.triple[gap] = int(smaller[fits.argmax()]) if fits.any() else 0
        return None


def combinations(counts: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths): how often which lengths share a sequence; counts[n] pieces of length n.

    Works on counts alone. Longest first, a length is completed by one, two or three others whose
    indexed sum is exactly its gap, as often as stock lasts; what finds no complement goes by best
    fit. A length that none complete isn't part of any later exact combination either. Each
    combination uses up some length, so there are fewer than about twice as many as lengths."""
    capacity = len(counts) - 1
    stock, out = _Stock(counts), []
    for n in range(capacity, 0, -1):
        while stock.left[n]:
            gap = capacity - n
            stock.left[n] -= 1
            fill = () if not gap else stock.one(gap) or stock.two(gap) or stock.three(gap)
            stock.left[n] += 1
            if fill is None:
                break
            out.append((stock.take((n, *fill)), (n, *fill)))
    for n in range(capacity, 0, -1):
        while stock.left[n]:
            chosen, gap = [n], capacity - n
            stock.left[n] -= 1
            while gap and len(fits := np.flatnonzero(stock.left[1 : gap + 1])):
                best = int(fits[-1]) + 1
                stock.left[best] -= 1
                chosen.append(best)
                gap -= best
            for x in chosen:
                stock.left[x] += 1
            out.append((stock.take(tuple(chosen)), tuple(chosen)))
    return out


def _layout(plan: list[tuple[int, tuple[int, ...]]], capacity: int) -> np.ndarray:
    """Rows (length, first number, first sequence, pieces a sequence, offset), ordered: where the
    pieces of a length go by their number."""
    used, rows, sequence = np.zeros(capacity + 1, np.int64), [], 0
    for times, lengths in plan:
        offset = 0
        for n, m in sorted(Counter(lengths).items(), reverse=True):
            rows.append((n, used[n], sequence, m, offset))
            used[n] += m * times
            offset += m * n
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def _placed(numbered: DataFrame, firsts, layout, capacity: int) -> DataFrame:
    names = [c for c in numbered.columns if c not in ("part", "number")]

    def run(batches):
        table, base = layout.value, firsts.value
        rank_bits = 1 << 48
        keys = table[:, 0] * rank_bits + table[:, 1]
        for batch in batches:
            length, part, number = (batch[c].to_numpy() for c in ("length", "part", "number"))
            rank = base[length, part] + number - 1
            at = np.searchsorted(keys, length * rank_bits + rank, "right") - 1
            row = table[at]
            turn = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in names),
                    pa.array(row[:, 2] + turn // row[:, 3]),
                    pa.array(row[:, 4] + turn % row[:, 3] * length),
                ],
                [*names, "sequence_id", "offset"],
            )

    kinds = dict(numbered.dtypes)
    return numbered.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id long, offset long")


def pack(
    docs: DataFrame, params: PackParams, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id (under the name of ``id_col``), piece, start, length, ids_crc32,
    sequence_id and offset; its ids too on request.

    A document is its text's ids and ``end_id``; longer ones than ``capacity`` are cut. Which
    lengths share sequences follows from how many pieces there are of each length, a table of at
    most ``capacity`` rows; pieces of one length are numbered in parts, so none is gathered.

    Null and empty texts are the ``end_id`` alone. Every row is packed, repeated rows and ids each
    on their own; null ids stay null. An empty table gives an empty result; other columns are
    ignored. Sequences are numbered from 0 without gaps."""
    p, spark = params, docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    many = F.when(F.col("length") == p.capacity, p.full_parts).otherwise(p.parts)
    pieces = stash(
        _pieces(plain, p, with_ids).withColumn(
            "part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), many).cast("int")
        )
    )
    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n")).toPandas()  # bounded by lengths x parts
    count = np.zeros((p.capacity + 1, max(p.parts, p.full_parts)), np.int64)
    count[sizes["length"], sizes["part"]] = sizes["n"]
    firsts = np.cumsum(count, axis=1) - count
    layout = _layout(combinations(count.sum(axis=1)), p.capacity)
    order = Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32")
    numbered = pieces.withColumn("number", F.row_number().over(order).cast("long"))
    share = spark.sparkContext.broadcast
    return _placed(numbered, share(firsts), share(layout), p.capacity).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences of ``pack(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
