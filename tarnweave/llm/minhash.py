"""MinHash near-dedup: b-bit signatures, band candidates, links confirmed on whole shingle sets."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.llm import buckets
from tarnweave.llm.graph import class_links, component_of_each, components
from tarnweave.llm.hot import join_by_weight, likely_among
from tarnweave.llm.text import WordHashes, hash_array, lower_ascii, mix64, shingles, words_of
from tarnweave.session import stash

#: Low bits of each minimum that the signature keeps.
BITS = 4
#: Words whose hashes a worker remembers: few, as most of those that are rare don't come again.
WORDS_HELD = 1 << 17
#: Pairs of a bucket that a worker looks at together.
PAIRS_AT_ONCE = 1 << 15


@dataclass(frozen=True)
class MinHashParams:
    """``percent``: documents link when 100 * intersection >= percent * union. A pair at that
    similarity J shares one of ``bands`` bands of ``rows`` minima with probability
    1 - (1 - J**rows)**bands; ``sigmas`` standard deviations below J, the estimate rules a
    candidate out. ``block``: items of a bucket that one task holds, before it is split."""

    width: int = 5
    percent: int = 80
    bands: int = 28
    rows: int = 4
    sigmas: float = 5.0
    block: int = 1024
    seed: int = 20

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def most_mismatches(self) -> int:
        """Mismatching low-bit lanes up to which a candidate's estimate is within reach.

        Two lanes agree with c = J + (1 - J) / 2**BITS; the collision-corrected estimate is
        (agreements / hashes - 2**-BITS) / (1 - 2**-BITS)."""
        j, chance = self.percent / 100, 2.0**-BITS
        agree = j + (1 - j) * chance
        deviation = math.sqrt(agree * (1 - agree) / self.hashes) / (1 - chance)
        least = max(0.0, j - self.sigmas * deviation)
        return math.floor(self.hashes * (1 - (chance + least * (1 - chance))))


@lru_cache(8)
def _functions(hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    mask, odd = np.random.default_rng(seed).integers(0, 2**32, (2, hashes, 1), dtype=np.uint32)
    return mask, odd | np.uint32(1)


def minima(sets: np.ndarray, p: MinHashParams) -> np.ndarray:
    """The minimum of each hash function over a non-empty set of 64-bit hashes."""
    mask, odd = _functions(p.hashes, p.seed)
    x = (sets >> np.uint64(32)).astype(np.uint32)
    least = np.full(p.hashes, 2**32 - 1, np.uint32)
    held = np.empty((2, p.hashes, min(len(x), 512)), np.uint32)
    for k in range(0, len(x), 512):  # what is held fits into a core's cache
        part = x[None, k : k + 512]
        h, shifted = held[:, :, : part.shape[1]]
        np.bitwise_xor(part, mask, out=h)
        np.multiply(h, odd, out=h)
        np.right_shift(h, np.uint32(15), out=shifted)
        np.bitwise_xor(h, shifted, out=h)
        np.multiply(h, np.uint32(0x2C1B3C6D), out=h)
        np.minimum(least, h.min(axis=1), out=least)
    return least


def signature(least: np.ndarray) -> bytes:
    """Bit plane after bit plane of the minima's low bits, each padded to whole 64-bit words."""
    words = -(-len(least) // 64)
    planes = np.zeros((BITS, words * 64), np.uint8)
    for b in range(BITS):
        planes[b, : len(least)] = (least >> np.uint32(b)) & np.uint32(1)
    return np.packbits(planes, axis=1).tobytes()


def mismatches(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Lanes in which signatures (rows of BITS x words uint64) differ, by bit counts."""
    differ = one[:, 0] ^ two[:, 0]
    for b in range(1, BITS):
        differ |= one[:, b] ^ two[:, b]
    return np.bitwise_count(differ).sum(axis=1)


def band_keys(least: np.ndarray, p: MinHashParams) -> np.ndarray:
    """A 64-bit key of each band, the band's number included."""
    parts = least.reshape(p.bands, p.rows).astype(np.uint64)
    key = mix64(np.arange(1, p.bands + 1, dtype=np.uint64) + np.uint64(p.seed << 20))
    for r in range(p.rows):
        key = mix64(key ^ parts[:, r])
    return key.view(np.int64)


def document_set(table: WordHashes, text: str | None, width: int) -> np.ndarray:
    return shingles(hash_array(table, words_of(lower_ascii(text or ""))), width)


def common(one: np.ndarray, two: np.ndarray) -> int:
    """Members that two sets have in common, each sorted and without repeats."""
    both = np.sort(np.concatenate([one, two]), kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


_PROFILE = "id long, n_shingles long, digest binary, signature binary, bands array<long>"


def _profile(docs: DataFrame, p: MinHashParams) -> DataFrame:
    def run(batches):
        table = WordHashes(WORDS_HELD)
        for batch in batches:
            n, digest, sig, bands = [], [], [], []
            for text in batch["text"]:
                s = document_set(table, text.as_py(), p.width)
                n.append(len(s))
                if len(s):
                    least = minima(s, p)
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                    sig.append(signature(least))
                    bands.append(band_keys(least, p))
                else:
                    for column in (digest, sig, bands):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(n, pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(sig, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "digest", "signature", "bands"],
            )

    return docs.mapInArrow(run, _PROFILE)


def _lanes(column: pa.ChunkedArray) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint64)
    return raw.reshape(len(column), BITS, -1)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width)


def _within_reach(table: pa.Table, starts: np.ndarray, p: MinHashParams):
    """Chunks of pairs (i, j) whose estimate is within reach and whose first shared band is the
    task's own, so that a pair is looked at once; with their mismatches."""
    lanes, bands = _lanes(table["signature"]), _matrix(table["bands"], p.bands)
    bucket = table["bucket"].to_numpy()
    for i, j in buckets.pairs(table, starts, PAIRS_AT_ONCE):
        differ = mismatches(lanes[i], lanes[j])
        near = differ <= p.most_mismatches
        i, j, differ = i[near], j[near], differ[near]
        first = (bands[i] == bands[j]).argmax(axis=1)
        own = bands[i, first] == bucket[i]
        yield i[own], j[own], differ[own]


_TASK = "item long, bucket long, left int, right int, side int"


def _promising(tasks: DataFrame, p: MinHashParams) -> DataFrame:
    """The task rows that stand in at least one pair within reach: at most those that come in."""

    def run(batches):
        for table, starts in buckets.whole_tasks(batches):
            hit = np.zeros(table.num_rows, bool)
            for i, j, _ in _within_reach(table, starts, p):
                hit[i] = hit[j] = True
            if hit.any():
                yield from (
                    table.select(["item", "bucket", "left", "right", "side"])
                    .filter(pa.array(hit))
                    .combine_chunks()
                    .to_batches()
                )

    return buckets.meet(tasks).mapInArrow(run, _TASK)


def _with_sets(promising: DataFrame, docs: DataFrame, p: MinHashParams) -> DataFrame:
    """Task rows with the item's whole set and its signature, made once for each text."""
    of_item = promising.groupBy("item").agg(
        F.collect_list(F.struct("bucket", "left", "right", "side")).alias("tasks")
    )
    wanted = likely_among(docs.select(F.col("id").alias("item"), "text"), "item", promising.select("item"))
    texts = wanted.join(of_item.hint("merge"), "item")

    def run(batches):
        table = WordHashes(WORDS_HELD)
        last, seen = None, set()
        for batch in batches:
            for item, text, tasks in zip(batch["item"], batch["text"], batch["tasks"], strict=True):
                s = document_set(table, text.as_py(), p.width)
                if not len(s):
                    continue
                if item != last:  # rows of one item come together
                    last, seen = item, set()
                digest = xxhash.xxh3_128_digest(s.tobytes())
                if digest in seen:
                    continue
                seen.add(digest)
                least = minima(s, p)
                sig, bands, raw = signature(least), band_keys(least, p).tolist(), s.tobytes()
                rows = tasks.as_py()
                yield pa.RecordBatch.from_pylist(
                    [
                        t | {"item": item.as_py(), "signature": sig, "bands": bands, "shingles": raw}
                        for t in rows
                    ],
                    schema,
                )

    schema = pa.schema(
        [("item", pa.int64()), ("bucket", pa.int64()), ("left", pa.int32()), ("right", pa.int32())]
        + [("side", pa.int32()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))]
        + [("shingles", pa.binary())]
    )
    return texts.mapInArrow(run, f"{_TASK}, signature binary, bands array<long>, shingles binary")


def _confirmed(with_sets: DataFrame, p: MinHashParams) -> DataFrame:
    """Links that connect what a task's links connect, each confirmed on both whole sets.

    Pairs come nearest first; one whose ends are connected already adds nothing to the components
    and isn't counted out."""

    def run(batches):
        for table, starts in buckets.whole_tasks(batches):
            item = table["item"].to_numpy()
            raw = table["shingles"]

            def members(k, raw=raw):
                return np.frombuffer(raw[k].as_buffer(), np.uint64)

            root = list(range(table.num_rows))

            def find(k, root=root):
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            a, b = [], []
            for i, j, differ in _within_reach(table, starts, p):
                for k in np.argsort(differ, kind="stable"):
                    x, y = int(i[k]), int(j[k])
                    if find(x) == find(y):
                        continue
                    one, two = members(x), members(y)
                    both = common(one, two)
                    if 100 * both >= p.percent * (len(one) + len(two) - both):
                        root[find(x)] = find(y)
                        a.append(item[x])
                        b.append(item[y])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
                )

    return buckets.meet(with_sets).mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, params: MinHashParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row, under the name of ``id_col``.

    A document's set is its distinct ``width``-word shingles after lower-casing A-Z. Equal sets are
    one class, of which one item is indexed; items that share a band of minima are candidates;
    candidates whose b-bit estimate is within reach are confirmed on both whole sets, shingles
    being compared by 64-bit hashes of their words. Every confirmed pair of different sets counts
    for the components, by whatever path they connect.

    A bucket of more than ``block`` items is compared block by block, its leading item in each;
    blocks then meet only where their items aren't connected yet. Components are found over
    classes, and no copy of a text is a link.

    Null, empty and blank texts have no shingles and link with nothing; a text of fewer words than
    ``width`` is one shingle. Rows that share an id are one document, linked with whatever one of
    its texts links with, and share ``kept``. A null id links with nothing: its component is null
    and it is kept. An empty table gives an empty result. Other columns are ignored."""
    p = params or MinHashParams()
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    profile = stash(_profile(docs, p))
    there = F.col("id").isNotNull() & F.col("digest").isNotNull()
    named = profile.where(there)
    classes = named.groupBy("digest").agg(
        F.min(F.struct("id", "signature", "bands")).alias("item"), F.count("*").alias("n")
    )
    items = stash(classes.select("digest", "n", "item.*"))
    placed = stash(
        join_by_weight(
            named.select("id", "n_shingles", "digest"), items.select("digest", F.col("id").alias("first"), "n"), "digest", "n"
        ).select("id", "n_shingles", "first")
    )
    keyed = items.select(F.col("id").alias("item"), F.explode("bands").alias("bucket"))
    within, large = buckets.own_blocks(keyed, p.block)
    links = class_links(placed).union(_links(within, items, docs, p))
    if not large.isEmpty():
        links = stash(links)
        labels = components(links, "a", "b").select(F.col("node").alias("item"), F.col("component").alias("label"))
        links = links.union(_links(buckets.cross_blocks(large, labels, p.block), items, docs, p))
    reached = component_of_each(placed, components(links, "a", "b"))
    return (
        reached.select("id", "n_shingles", "component")
        .unionByName(profile.where(~there).select("id", "n_shingles", F.col("id").alias("component")))
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.col("component").alias("component_id"),
            (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept"),
        )
    )


def _links(tasks: DataFrame, items: DataFrame, docs: DataFrame, p: MinHashParams) -> DataFrame:
    """(a, b): confirmed links that connect what the tasks' pairs connect."""
    signed = tasks.join(items.select(F.col("id").alias("item"), "signature", "bands"), "item")
    return _confirmed(_with_sets(stash(_promising(signed, p)), docs, p), p)
