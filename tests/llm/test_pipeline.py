"""The pipeline's stages against what their operators decide."""

import os
import random
import re

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tarnweave.llm import minhash, mixing, packing, quality_rules
from tarnweave.session import read_table, stash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    inputs = []
    for _, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = stash(stage(spark, docs, SF))
        assert docs.columns == corpus_pipeline.COLUMNS or stage is corpus_pipeline.pack_sequences
    ids = [sorted(r[0] for r in d.select("doc_id").collect()) for d in [*inputs, docs.where("piece = 0")]]
    judged = quality_rules.quality_rules(inputs[0], read_table(spark, SF, "labels")).where("kept")
    assert ids[1] == sorted(r["doc_id"] for r in judged.collect())
    assert set(ids[2]) <= set(ids[1]) and inputs[2].where("text = ''").count() == 0
    groups = minhash.near_duplicates(inputs[2])
    assert ids[3] == sorted(r["doc_id"] for r in groups.where("kept").collect())
    assert groups.select("component_id").distinct().count() == len(ids[3])
    mixed = mixing.mix(inputs[3]).agg(F.sum("copies")).first()[0]
    assert len(ids[4]) == mixed == len(ids[5])
    tokens = packing.Encoder(packing.PackParams(public_tokenizers.path(corpus_pipeline.TOKENIZER)))
    expected = sum(len(tokens.whole(r["text"])) // 4 + 1 for r in inputs[4].select("text").collect())
    assert docs.agg(F.sum("length")).first()[0] == expected


def words(text):
    return re.findall(r"[^ \t-\r]+", (text or "").translate(LOWER))


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, row string, copies int"


def table(spark, texts):
    """Rows of documents with further columns, whose names the operators use too."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "r", 2) for i, t, s in texts], SCHEMA)


def test_near_duplicate_stage_against_plain_python(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    base = [say(60) for _ in range(6)]
    near = [" ".join(["Changed", *b.split()[1:]]) for b in base[:3]]
    rows = [(10 + i, t, "a") for i, t in enumerate(base)] + [(20 + i, t, "b") for i, t in enumerate(near)]
    rows += [(10, base[0], "a"), (10, say(60), "a"), (None, base[1], "a"), (None, None, None), (None, None, None), (7, "", "a"), (8, " \n", "a"), (9, say(30_000), "a")]
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), SF).collect()))
    distinct = sorted({(i is not None, i or 0, t) for i, t, _ in rows if words(t)})
    kept = []
    for row in distinct:  # the smallest of each group: these groups are cliques
        mine = shingles(row[2])
        if not any(100 * len(mine & s) >= 80 * len(mine | s) for s in (shingles(k[2]) for k in kept)):
            kept.append(row)
    blank = [(i is not None, i or 0, t or "") for i, t, _ in rows if not words(t)]
    assert got == sorted(kept + blank)


def test_stages_at_the_edges(spark):
    """Null ids, texts and sources, empty and long texts, repeated rows, an empty table."""
    text = "\n".join(f"line {k} says this and that, word{k} by word" for k in range(4))
    rows = [(None, None, None), (1, None, "a"), (2, "", "a"), (3, text, None), (3, text, None), (4, text, "b"), (None, text, "b"), (5, "word " * 40_000, "a"), (6, "one line", "a")]
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, table(spark, rows), SF).collect()
        assert stage(spark, table(spark, rows).limit(0), SF).count() == 0
        if name == "line dedup":
            assert len(got) == 6 and sum(r["text"] == text for r in got) == 1
        elif name == "minhash near-dedup":
            assert sorted(r["text"] or "" for r in got) == sorted(["", "", "", text, "word " * 40_000, "one line"])
        elif name == "mixing sources":
            assert all(words(r["text"]) for r in got)
        elif name == "best-fit packing":
            assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got) and sum(r["piece"] == 0 for r in got) == len(rows)


def test_run_leaves_only_what_its_result_needs(spark):
    from tarnweave.session import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert len([n for n in set(os.listdir(shared_dir(spark))) - before if n.startswith("stash-")]) <= len(corpus_pipeline.STAGES) + 1
