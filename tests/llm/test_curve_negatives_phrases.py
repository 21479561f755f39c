"""Packing along the curve, hard negatives and collocations against brute force, and at their edges."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnweave.llm import curve, hard_negatives, phrases
from tarnweave.llm.packing import Encoder, PackParams

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, n long, id string, range string, key string, phrase string, a string"
RNG = np.random.default_rng(13)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "i", "r", "k", "p", "a") for i, t, lang in rows], DOCS)


# --- the curve ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_hilbert_goes_everywhere_by_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = curve.hilbert(grid, bits)
    assert sorted(place) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


@given(st.integers(0, 5000), st.sampled_from([4, 16, 64]))
def test_ends_are_powers_of_two(total, capacity):
    ends = [total - total % capacity, *curve._ends(total, capacity).tolist()]
    assert ends[-1] == total and all(x.bit_count() == 1 for x in np.diff(ends).tolist())


def test_pieces_cover_each_document(spark):
    topics = [[f"{t}{i}" for i in range(40)] for t in ("sea", "hill", "town")]
    rows = [(None, None, None), (1, "", "en"), (1, "", "en"), (2, " ".join(RNG.choice(topics[0], 3000)), "en")]
    rows += [(10 + k, " ".join(RNG.choice(topics[k % 3], 30)), "en") for k in range(90)] + [(500, "one and the same", "en")] * 40
    p = curve.CurveParams(TOKENIZER, capacity=256, range_tokens=500)
    got = curve.pack_along_curve(docs(spark, rows), p).toPandas()
    encoder = Encoder(PackParams(TOKENIZER, end_id=1, by_part=False))
    whole = {i: np.frombuffer(encoder.whole(t or "") + np.array([1], "<u4").tobytes(), "<u4") for i, t, _ in rows}
    many = Counter(i for i, _, _ in rows)
    for i, n in many.items():
        mine = got[got.doc_id.isna()] if i is None else got[got.doc_id == i]
        assert mine.length.sum() == n * len(whole[i]) and set(mine.doc_tokens) == {len(whole[i])}
        starts = Counter()
        for r in mine.itertuples():
            assert zlib.crc32(whole[i][r.start : r.start + r.length].tobytes()) == r.ids_crc32
            starts.update(range(r.start, r.start + r.length))
        assert set(starts.values()) == {n}
    used = got.groupby("sequence_id").length.sum()
    assert all(x == 256 or int(x).bit_count() == 1 for x in used) and (used == 256).sum() == got.length.sum() // 256
    by = got.sort_values(["sequence_id", "offset"])
    assert (by.groupby("sequence_id").length.cumsum() - by.length == by.offset).all()
    # neighbours along the curve are of one topic more often than chance has it
    at = got[(got.start == 0) & got.doc_id.between(10, 99)].sort_values(["sequence_id", "offset"]).doc_id.to_numpy().astype(int) % 3
    assert (at[1:] == at[:-1]).mean() > 0.6
    assert curve.pack_along_curve(docs(spark, []), p).count() == 0


# --- hard negatives ------------------------------------------------------------------------------------


def brute_negatives(rows, p):
    whole = lambda v: [int(np.floor(p.scale * x)) for x in v]
    finite = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    usable = sorted({(i, label, tuple(whole(v))) for i, label, v in rows if i is not None and label is not None and finite(v)})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = Counter()
    for a in usable:
        if a[0] % p.every:
            continue
        others = sorted(((-dot(a[2], b[2]), b[0], b[1]) for b in usable if b is not a))
        for s, positive, _ in [o for o in others if o[2] == a[1]][: p.positives]:
            fits = [o for o in others if o[2] != a[1] and -p.low * s <= -100 * o[0] <= -p.high * s][: p.negatives]
            out.update((a[0], positive, r, o[1], -s, -o[0]) for r, o in enumerate(fits, 1))
    return out


@pytest.mark.parametrize("cells", [1, 6])
def test_hard_negatives(spark, cells):
    centres = RNG.normal(size=(6, 8))
    rows = [(i, int(RNG.integers(3)), (centres[i % 6] + RNG.normal(size=8) * 0.6).tolist()) for i in range(400)]
    rows += [(1000 + i, i % 2, centres[0].tolist()) for i in range(60)] + rows[:5]  # ties, repeated rows
    rows += [(None, 1, [1.0] * 8), (600, None, [1.0] * 8), (650, 1, None), (700, 1, [1.0, None]), (750, 1, [float("nan")] * 8), (800, 1, [float("inf")] * 8)]
    rows += [(850, 1, []), (900, 2, [0.0] * 8), (950, 1, [2.0, 1.0])]
    p = hard_negatives.NegativeParams(every=10, cell_rows=-(-460 // cells), block=200, anchor_leaf=4, leaf=16)
    df = spark.createDataFrame([(i, v, label, 1, "c") for i, label, v in rows], "vec_id long, embedding array<double>, label int, id int, cell string")
    got = hard_negatives.hard_negatives(df, p).collect()
    assert Counter(map(tuple, got)) == brute_negatives(rows, p)
    assert len(got) > 100
    assert hard_negatives.hard_negatives(df.limit(0), p).count() == 0


def test_intervals_hold_and_prune():
    x, y = RNG.normal(size=(300, 6)), RNG.normal(size=(200, 6)) + 3
    for a, b in ((x, y), (x[:5], y[:5] * 0)):
        (o, left), (q, right) = hard_negatives.ball_tree(a, 8), hard_negatives.ball_tree(b, 8)
        todo, seen = [(left, right)], 0
        while todo:
            n, m = todo.pop()
            got = a[o[n.begin : n.end]] @ b[q[m.begin : m.end]].T
            low, high = hard_negatives.interval(n.centre[None], np.array([n.radius]), m.centre[None], np.array([m.radius]))
            assert low[0, 0] <= got.min() and got.max() <= high[0, 0]
            seen += 1
            todo += [(c, m) for c in n.children] if n.children else [(n, d) for d in m.children]
        assert seen
    wanted = hard_negatives.Wanted(np.array([[5.0], [9.0]]), np.array([[6.0], [9.5]]), 3)
    assert wanted.open(0, 2, 5.5, 5.6) and not wanted.open(1, 2, 5.5, 5.6) and not wanted.open(0, 2, 10, 11)


def test_scores_beyond_doubles_are_exact():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**40, 3.0]])
    assert hard_negatives.scores(a, b)[0, 0] == 2**80 + 3


# --- collocations ---------------------------------------------------------------------------------------


def brute_collocations(rows, p):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split(r"[ \t]", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, p.words + 1) for i in range(len(w) - k + 1))
    candidates = {q: a for q, a in f.items() if a >= p.least and len(q[1]) > 1}
    inside = lambda s, q: any(q[i : i + len(s)] == s for i in range(len(q) - len(s) + 1))
    out = {}
    for (lang, q), a in candidates.items():
        if any(x == lang and len(r) > len(q) and inside(q, r) and 100 * b >= p.cover * a for (x, r), b in candidates.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, q[:k]] * f[lang, q[k:]]), k) for k in range(1, len(q))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(q).encode(), f[lang, q[:k]], f[lang, q[k:]]))
    return {(lang, i, q.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for i, (s, a, q, l, r) in enumerate(sorted(x)[: p.top], 1)}


TALK = ["of", "the", "New", "York", "ÉTÉ", "été", "a", "a", "b", "x y", "q\x1cz", "日本"]


@pytest.mark.parametrize("p", [phrases.PhraseParams(least=4, top=25), phrases.PhraseParams(least=6, cover=80, patterns=7, shard_chars=300), phrases.PhraseParams(least=3, words=3, cells=1 << 5, most_cells=1 << 10, bucket_words=50), phrases.PhraseParams(least=300, top=9)])
def test_collocations(spark, p):
    glue = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r"]
    say = lambda k: "".join(RNG.choice(TALK) + RNG.choice(glue) for _ in range(k))
    rows = [(say(RNG.integers(1, 60)), RNG.choice(["en", "fr"])) for _ in range(120)] + [(None, "en"), ("", "de"), (" .\n", "de"), ("new york " * 500, None), ("new york new york", "und")]
    rows += rows[:10]
    got = phrases.collocations(docs(spark, [(i, t, None if x is None else str(x)) for i, (t, x) in enumerate(rows)]), p).collect()
    assert {tuple(r) for r in got} == brute_collocations(rows, p) and len(got) == len({tuple(r) for r in got})
    assert phrases.collocations(docs(spark, [])).count() == 0


def test_scores_pass_64_bits(spark):
    rows = [(i, "aa bb. " * 3000 + "cc " * 3000, "en") for i in range(3)]
    r = phrases.collocations(docs(spark, rows)).where("phrase = 'aa bb'").first()
    assert (r["a"], r["l"], r["r"], r["n"], r["score"]) == (9000, 9000, 9000, 27000, 3000)
