"""Quality rules: counts of each text, and a hashed n-gram likelihood ratio with a threshold."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnweave.llm.text import WordHashes, hash_array, mix64, window_hashes, words_of
from tarnweave.operators.ranking import running
from tarnweave.session import stash

_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
#: Fixed value: parts that the counts of all buckets travel in.
_PARTS = 256


@dataclass(frozen=True)
class QualityParams:
    """``buckets``: cells that word 1-grams and 2-grams are hashed to. ``keep``: share of the trusted
    rows that pass the threshold at least. The base rules fail a text of fewer than ``min_words`` words
    or with more than ``max_repeat_percent`` of its words in repeated 5-word windows."""

    buckets: int = 1 << 16
    keep: float = 0.995
    smoothing: float = 10.0
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    seed: int = 1


def base_counts(text: str | None, words: list[str], hashes: np.ndarray, window: int) -> tuple[int, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += bool(line.strip(_BLANKS))
        else:
            seen.add(line)
    h = window_hashes(hashes, window)
    repeated = 0
    if len(h) > 1:
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        if same.any():
            again = np.zeros(len(h), bool)
            again[order[1:][same]] = again[order[:-1][same]] = True
            at = np.flatnonzero(again)
            covered = np.zeros(len(words) + 1, np.int64)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + window, -1)
            repeated = int((np.cumsum(covered)[:-1] > 0).sum())
    return len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), dup, repeated


def features(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each word 1-gram and 2-gram, repeats included."""
    both = np.concatenate([mix64(hashes), window_hashes(hashes, 2)])
    return (both % np.uint64(buckets)).astype(np.int64)


def _even(id_col: str, p: QualityParams) -> Column:
    """Whether an id is in the half of which trusted rows fit the target multinomial; null has none."""
    return F.col(id_col).isNotNull() & (F.pmod(F.xxhash64(F.lit(p.seed), id_col), F.lit(2)) == 0)


def _labelled(labels: DataFrame, p: QualityParams, id_col: str, label_col: str) -> DataFrame:
    """(label_id, good, fits): one row for each labelled id; those that fit the target multinomial
    take no part in placing the threshold."""
    return (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("label_id"))
        .agg((F.min(label_col) > 0).alias("good"))
        .withColumn("fits", F.col("good") & _even("label_id", p))
    )


def _marked(docs: DataFrame, known: DataFrame, p: QualityParams) -> DataFrame:
    """(text, fits) of every row. Only rows of the half of ids that may fit meet the labels, of which
    no task or driver holds all."""
    fitting = known.where("fits").select("label_id", "fits").hint("merge")
    half = docs.where(_even("id", p)).join(fitting, F.col("id") == F.col("label_id"), "left")
    return docs.where(~_even("id", p)).select("text", F.lit(False).alias("fits")).unionByName(half.select("text", "fits"))


def _counts(docs: DataFrame, p: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """Raw and target counts of each bucket; a task's counts travel in packed parts."""
    width = -(-p.buckets // _PARTS)
    names = ["part", "raw", "target"]

    def run(batches):
        table = WordHashes()
        raw, target = np.zeros((2, p.buckets), np.int64)
        for batch in batches:
            for text, fits in zip(batch["text"], batch["fits"].to_pylist(), strict=True):
                f = features(hash_array(table, words_of(text.as_py())), p.buckets)
                np.add.at(raw, f, 1)
                if fits:
                    np.add.at(target, f, 1)
        parts = [k for k in range(-(-p.buckets // width)) if raw[k * width : (k + 1) * width].any()]
        packed = [[side[k * width : (k + 1) * width].tobytes() for k in parts] for side in (raw, target)]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *(pa.array(side, pa.binary()) for side in packed)], names)

    def merge(rows: pa.Table) -> pa.Table:
        sums = [sum(np.frombuffer(x, np.int64) for x in rows[side].to_pylist()).tobytes() for side in names[1:]]
        return pa.table([rows["part"][:1], *(pa.array([x], pa.binary()) for x in sums)], names)

    schema = "part int, raw binary, target binary"
    found = docs.mapInArrow(run, schema).groupBy("part").applyInArrow(merge, schema).collect()  # _PARTS rows
    raw, target = np.zeros((2, p.buckets), np.int64)
    for k, *sides in found:
        for to, side in zip((raw, target), sides, strict=True):
            to[k * width : (k + 1) * width] = np.frombuffer(side, np.int64)
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray, smoothing: float) -> np.ndarray:
    """log(target share / raw share) of each bucket in millionths; 0 where no target is known."""
    if not target.sum():
        return np.zeros(len(raw), np.int64)
    share = (target + smoothing) / (target.sum() + smoothing * len(raw))
    base = (raw + smoothing) / (raw.sum() + smoothing * len(raw))
    return np.rint(1e6 * np.log(share / base)).astype(np.int64)


def threshold(seen: DataFrame, keep: float) -> float:
    """The cut that best parts good from bad rows of (llr, good) (true less false share kept, the
    least of equal ones) among those that keep a share of ``keep`` of the good rows, moved half way
    down to the next bad row; -inf without rows of both kinds.

    Rows of each score are counted, and the counts added up along the scores by ``running``: the
    driver has a few numbers, however many rows are labelled."""
    counted = stash(seen.groupBy("llr").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b")))
    n_good, n_bad = counted.agg(F.coalesce(F.sum("g"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    if not n_good or not n_bad:
        return float("-inf")
    summed = running(running(counted, ["llr"], "good", F.col("g")), ["llr"], "bad", F.col("b"))
    summed = stash(summed.select("llr", "b", (F.col("good") - F.col("g")).alias("less_good"), "good", (F.col("bad") - F.col("b")).alias("less_bad")))
    top = summed.where(F.col("good") > int((1 - keep) * (n_good - 1))).agg(F.min("llr")).first()[0]
    parted = (1 - F.col("less_good") / F.lit(n_good)) - (1 - F.col("less_bad") / F.lit(n_bad))
    cut = summed.where(F.col("llr") <= F.lit(top)).orderBy(parted.desc(), "llr").first()["llr"]
    below = summed.where((F.col("llr") < F.lit(cut)) & (F.col("b") > 0)).agg(F.max("llr")).first()[0]
    return cut if below is None else (cut + below) / 2


def _scored(docs: DataFrame, ratios, p: QualityParams) -> DataFrame:
    """Every row of (id, text, ...) with its counts, what the base rules say, and its score."""
    extra = [c for c in docs.columns if c not in ("id", "text")]

    def run(batches):
        table = WordHashes()
        weight = ratios.value
        for batch in batches:
            rows, scores, failed = [], [], []
            for text in batch["text"]:
                text = text.as_py()
                words = words_of(text)
                hashes = hash_array(table, words)
                counts = base_counts(text, words, hashes, p.window)
                f = features(hashes, p.buckets)
                score = int(weight[f].sum()) / len(f) / 1e6 if len(f) else 0.0
                rows.append(counts)
                scores.append(score)
                failed.append(counts[0] < p.min_words or 100 * counts[4] > p.max_repeat_percent * counts[0])
            longs = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *(batch[c] for c in extra), *map(pa.array, longs), pa.array(failed, pa.bool_()), pa.array(scores, pa.float64())],
                ["id", *extra, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr"],
            )

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(
        run,
        "id long, "
        + "".join(f"{c} {kinds[c]}, " for c in extra)
        + "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        + "base_failed boolean, llr double",
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    params: QualityParams | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The id of every row with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and llr; then the columns that ``carry`` names.

    ``llr`` is the mean log ratio of the text's hashed word 1-grams and 2-grams between the
    trusted-target and the raw-corpus multinomial. A row is kept if it passes the base rules and
    its ``llr`` reaches the threshold, which the labelled rows place and which holds for all.

    Null and empty texts have no words and fail the base rules. Repeated rows and ids are judged
    one by one; of an id labelled more than once the lowest label counts, and of labelled rows that
    share an id the lowest ``llr`` takes part in placing the threshold. A null id gets a verdict
    too. Without labels of both kinds nothing falls below the threshold. An empty table gives an
    empty result. Other columns are ignored."""
    p = params or QualityParams()
    spark = docs.sparkSession
    docs = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        *(F.col(c).alias(f"carry_{k}") for k, c in enumerate(carry)),
    )
    known = stash(_labelled(labels, p, id_col, label_col))
    raw, target = _counts(_marked(docs, known, p), p)
    scored = stash(_scored(docs, spark.sparkContext.broadcast(log_ratios(raw, target, p.smoothing)), p))
    placing = scored.where("not base_failed").select("id", "llr").join(known.where("not fits"), F.col("id") == F.col("label_id"))
    cut = threshold(placing.groupBy("id", "good").agg(F.min("llr").alias("llr")), p.keep)
    out = scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(cut)))
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"]
    return out.select(
        F.col("id").alias(id_col), *own, *(F.col(f"carry_{k}").alias(c) for k, c in enumerate(carry))
    )
