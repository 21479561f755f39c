"""Methods of the corpus operators against plain versions of their own, and odd inputs."""

import collections
import itertools
import math
import os

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnweave.llm import buckets, chat, embedding_dedup, html_extract, line_dedup, minhash, mixing, packing, quality_rules, queries, sharding
from tarnweave.llm.graph import components
from tarnweave.llm.hot import join_by_weight, likely_among

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RNG = np.random.default_rng(11)
SAY = lambda n, words=300: " ".join(f"w{k}" for k in RNG.integers(0, words, n))


# --- shared parts ---------------------------------------------------------------------------------------


def test_joins_of_hot_keys_lose_nothing(spark):
    rows = spark.createDataFrame([(0 if i % 3 == 0 else i, i) for i in range(9000)], "k long, v long")
    classes = rows.groupBy("k").agg(F.count("*").alias("n")).where("k % 5 <> 1")
    got = join_by_weight(rows, classes, "k", "n")
    assert got.count() == rows.where("k % 5 <> 1").count() and got.where("k = 0").select("v").distinct().count() == 3000
    ids = spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    near = likely_among(rows, "k", ids)
    assert near.columns == ["k", "v"] and near.join(ids, "k").count() == rows.join(ids, "k").count() and near.count() < 3200 + 9000 / 6


def test_components_of_a_hub_and_a_path(spark):
    links = [(5, i) for i in range(6, 400)] + [(i, i + 1) for i in range(1000, 1100)] + [(1100, 399)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert set(got.values()) == {5} and len(got) == 395 + 101


@pytest.mark.parametrize("block", [2, 3])
def test_blocks_meet_once_and_across_where_not_connected(spark, block):
    keyed = spark.createDataFrame([(i, b) for b, n in ((1, 1), (2, 2), (3, 9)) for i in range(n)], "item long, bucket long")

    def met(tasks):
        by = collections.defaultdict(list)
        for r in tasks.collect():
            by[r["bucket"], r["left"], r["right"]].append((r["item"], r["side"]))
        return [
            (b, *sorted((x, y)))
            for (b, left, right), rows in by.items()
            for (x, s), (y, t) in itertools.combinations(rows, 2)
            if left == right or s != t
        ]

    every = {(b, x, y) for b, n in ((2, 2), (3, 9)) for x, y in itertools.combinations(range(n), 2)}
    pairs = met(buckets.block_pairs(keyed, block))
    assert len(pairs) == len(set(pairs)) and set(pairs) == every
    within, large = buckets.own_blocks(keyed, block)
    first = set(met(within))
    labels = {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 4, 6: 6, 7: 0, 8: 0}
    rest = met(buckets.cross_blocks(large, spark.createDataFrame(list(labels.items()), "item long, label long"), block))
    apart = {(b, x, y) for b, x, y in every if b == 3 and labels[x] != labels[y]}
    assert (2, 0, 1) in first and apart <= set(rest) and len(rest) == len(set(rest))
    inside = [(x, y) for b, x, y in rest if labels[x] == labels[y] == 0]
    assert not inside  # those that one component holds already don't meet again
    one = spark.createDataFrame([(i, 0) for i in range(9)], "item long, label long")
    assert buckets.cross_blocks(large, one, block).count() == 0


def test_queries_with_sql_give_its_rows(spark):
    from test_queries import canonical

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    for name, sql in queries.oracle_sql().items():
        got, expected = queries.queries()[name](spark, SF).toPandas(), con.execute(sql).df()
        assert sorted(got.columns) == sorted(expected.columns) and canonical(got) == canonical(expected), name


# --- 1 quality rules -------------------------------------------------------------------------------------


def test_scores_and_threshold_against_plain_counts(spark):
    p = quality_rules.QualityParams(buckets=64)
    texts = [SAY(40, 80) if i % 3 else " ".join(f"j{k}" for k in RNG.integers(0, 60, 40)) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)], "doc_id long, quality int")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("llr", F.lit("x"))
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs, labels, p).collect()}
    table = quality_rules.WordHashes()
    cells = [list(quality_rules.features(quality_rules.hash_array(table, t.split()), 64)) for t in texts]
    assert all(len(c) == 79 and all(0 <= x < 64 for x in c) for c in cells)
    fits = {r["label_id"] for r in quality_rules._labelled(labels, p, "doc_id", "quality").where("fits").collect()}
    raw, target = collections.Counter(itertools.chain(*cells)), collections.Counter(itertools.chain(*(cells[i] for i in fits)))
    n, m = sum(raw.values()), sum(target.values())
    ratio = {b: math.log(((target[b] + 10) / (m + 640)) / ((raw[b] + 10) / (n + 640))) for b in range(64)}
    score = [sum(ratio[b] for b in c) / len(c) for c in cells]
    for i in range(60):
        assert got[i]["llr"] == pytest.approx(score[i], abs=2e-6)
    placed = [i for i in range(40) if i not in fits]
    good, bad = [got[i]["llr"] for i in placed if i % 3], [got[i]["llr"] for i in placed if i % 3 == 0]
    top = sorted(good)[math.floor(0.005 * (len(good) - 1))]
    cut = max(sorted({s for s in good + bad if s <= top}), key=lambda c: (np.mean([g >= c for g in good]) - np.mean([b >= c for b in bad]), -c))
    cut = (cut + max(b for b in bad if b < cut)) / 2 if any(b < cut for b in bad) else cut
    assert all(got[i]["kept"] == (not got[i]["base_failed"] and got[i]["llr"] >= cut) for i in range(60))


# --- 2 line dedup -----------------------------------------------------------------------------------------


def test_line_dedup_with_clashing_names_nulls_and_repeats(spark):
    rows = [(None, "a a\nb b\nc c"), (None, "a a\nb b\nc c"), (1, "x\na a\nb b"), (2, None), (3, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("cuts", "cut_id", "cut_th", "runs", "row", "id", "th", "start", "hash", "n_lines"):
        table = table.withColumn(name, F.lit("own"))
    got = line_dedup.remove_repeated_chunks(table).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["n_lines"], r["n_removed_lines"]) for r in got) == [
        (0, "a a\nb b\nc c", 3, 0), (0, "a a\nb b\nc c", 3, 0), (1, "x", 3, 2), (2, "", 0, 0), (3, "", 1, 0),
    ]
    assert all(r["cuts"] == r["row"] == "own" for r in got)


# --- 3 packing ---------------------------------------------------------------------------------------------


def fewest(lengths, capacity):
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[k] <= capacity and bins[b] not in bins[:b]:
                place(k + 1, [*bins[:b], bins[b] + lengths[k], *bins[b + 1 :]])
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_number_of_sequences_against_the_fewest(lengths):
    counts = np.bincount(lengths, minlength=13)
    used = sum(times for times, _ in packing.combinations(counts))
    assert used <= fewest(sorted(lengths, reverse=True), 12) + 1


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=25), st.integers(1, 40))
def test_index_of_sums_against_all_combinations(lengths, gap):
    counts = np.bincount(lengths, minlength=41)
    stock = packing._Stock(counts)
    for n, find in ((1, stock.one), (2, stock.two), (3, stock.three)):
        there = any(sum(c) == gap for c in itertools.combinations(lengths, n))
        found = find(gap)
        assert (found is not None) == there
        if found:
            assert len(found) == n and sum(found) == gap and stock.has(found)


def test_exact_complements_come_first():
    counts = np.zeros(101, np.int64)
    counts[[60, 30, 7, 3]] = [2, 2, 2, 2]
    assert packing.combinations(counts) == [(2, (60, 30, 7, 3))]


# --- 4 embeddings ------------------------------------------------------------------------------------------


def test_recall_of_planted_pairs(spark):
    base = RNG.standard_normal((1200, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    other = RNG.standard_normal((1200, 64))
    other -= (other * base).sum(axis=1)[:, None] * base
    other /= np.linalg.norm(other, axis=1)[:, None]
    c = RNG.uniform(0.90, 0.95, 1200)[:, None]
    every = np.concatenate([base, c * base + np.sqrt(1 - c * c) * other])
    true = (every @ every.T >= 0.9).sum(axis=1) - 1
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(table).collect()}
    assert all(got[i] <= true[i] for i in got)
    recall = sum(got.values()) / true.sum()
    print(f"recall {recall:.4f} of {true.sum() // 2} pairs between 0.90 and 0.95")
    assert recall >= 0.97


def test_vectors_that_repeat_crowd_and_share_ids(spark):
    hub = RNG.standard_normal(16)
    near = hub + 0.05 * RNG.standard_normal((30, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(near)] + [(100, hub.tolist())] * 3 + [(None, hub.tolist()), (5, (-hub).tolist()), (200, (-hub).tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("first", F.lit("x")).withColumn("id", F.lit("x"))
    got = embedding_dedup.near_vectors(table, embedding_dedup.PStableParams(block=4)).collect()
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    true = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    by = collections.defaultdict(list)
    for (i, _), n in zip(rows, true, strict=True):
        by[i].append(int(n))
    mine = collections.defaultdict(list)
    for r in got:
        mine[r["vec_id"]].append(r["n_links"])
        assert r["component_id"] == (None if r["vec_id"] is None else 0) and r["kept"] == (r["vec_id"] in (None, 0))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in by.items()}
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


# --- 5 near duplicates --------------------------------------------------------------------------------------


def test_crowds_of_near_copies_against_plain_sets(spark):
    base, other = SAY(80).split(), SAY(80).split()
    texts = [" ".join([*base[:k], "new", *base[k + 1 :]]) for k in range(40)] + [" ".join(base[: 76 + k]) for k in range(4)]
    texts += [" ".join([*other[:k], "new", *other[k + 1 :]]) for k in range(0, 40, 9)] + [texts[0]] * 5 + [" ".join(base[:40] + other[:40])]
    ids = [*range(len(texts) - 1), 3]  # the last shares an id with another text
    p = minhash.MinHashParams(block=5)
    got = minhash.near_duplicates(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string"), p).collect()
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(range(len(texts)), 2):
        if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
            a, b = sorted((find(ids[x]), find(ids[y])))
            root[b] = a
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted((i, find(i)) for i in ids)


# --- 7 mixing -------------------------------------------------------------------------------------------------


def test_inclusion_is_unequal_and_fills_the_quota(spark):
    sizes = [int(x) for x in RNG.integers(1, 400, 400)]
    rows = [(i, " ".join(["w"] * n), "ab"[i % 2]) for i, n in enumerate(sizes)] + [(-1, None, "a"), (-2, "", "b"), (-3, "w " * 5000, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("own")).withColumn("row", F.lit("own"))
    sized = table.select(F.col("source"), mixing.word_count(F.col("text")).alias("size")).withColumn("odds", F.sqrt(F.col("size").cast("double")))
    goal = spark.createDataFrame([("a", 15000.0), ("b", 30000.0)], "goal_source string, quota double")
    level = {r["level_source"]: r["level"] for r in mixing.levels(sized, goal).collect()}
    for source, quota in (("a", 15000.0), ("b", 30000.0)):
        mine = [n for n, (_, _, s) in zip(sizes, rows) if s == source]
        assert sum(min(1, level[source] * math.sqrt(n)) * n for n in mine) == pytest.approx(min(quota, sum(mine)))
    taken = collections.Counter()
    for k in range(8):
        for r in mixing.mix(table, mixing.MixParams(seed=f"s{k}", weights=(1, 3, 2))).where("source = 'a' and copies > 0").collect():
            taken[r["mix_id"]] += r["copies"]
    mean = lambda rows: np.mean([taken[i] for i in rows])
    mine = sorted((n, i) for i, n in enumerate(sizes) if i % 2 == 0)
    assert mean([i for _, i in mine[-50:]]) > 1.3 * mean([i for _, i in mine[:50]])  # longer ones are likelier
    mixed = mixing.mix(table)
    by = {s: g for s, g in itertools.groupby(sorted(mixed.collect(), key=lambda r: r["source"] or "z"), key=lambda r: r["source"]) for g in [list(g)]}
    for g in by.values():
        assert abs(sum(r["taken"] for r in g) - g[0]["target"]) <= 0.01 * g[0]["target"] and all(r["taken"] <= 3 * r["size"] for r in g)
    again = mixing.repeat(table.withColumn("copies", F.lit(9)).withColumn("mix_id", F.lit(9)).withColumn("mix_copy", F.lit(9)), mixed)
    assert again.where("copies = 9 and mix_id = 9 and mix_copy = 9").count() == sum(r["copies"] for g in by.values() for r in g)
    some = table.where("source = 'a'").withColumn("like", F.when(F.col("doc_id") % 8 == 0, F.lit(0.0)).when(F.col("doc_id") % 8 == 2, F.lit(None).cast("double")).otherwise(0.5))
    other = spark.createDataFrame([(9000, "w " * 3000, "b")], "doc_id long, text string, source string").withColumn("like", F.lit(1.0))
    liked = mixing.mix(some.select("doc_id", "text", "source", "like").unionByName(other), mixing.MixParams(weights=(20, 1)), affinity_col="like")
    out = [r for r in liked.collect() if r["source"] == "a" and r["size"]]
    least = min(r["copies"] for r in out)
    quota = out[0]["target"] - least * out[0]["source_size"]
    assert 0 < quota < sum(r["size"] for r in out if r["mix_id"] % 8)  # those with an affinity can fill it
    extra = {r["mix_id"] for r in out if r["copies"] > least}
    assert sum(i % 8 == 0 for i in extra) <= 1  # what has none is at most the closing document
    by_kind = lambda k: np.mean([r["mix_id"] in extra for r in out if r["mix_id"] % 8 == k])
    assert by_kind(2) > by_kind(4)


# --- 8 sharding -----------------------------------------------------------------------------------------------


def test_spread_against_the_best_and_written_shards(spark, tmp_path):
    for _ in range(6):
        sizes = [int(x) for x in RNG.integers(1, 60, 9)]
        _, totals = sharding.differencing([(s, 0, 0) for s in sizes])
        greedy = [0, 0, 0]
        for s in sorted(sizes, reverse=True):
            greedy[greedy.index(min(greedy))] += s
        best = min(max(t) - min(t) for t in ([sum(s for s, x in zip(sizes, p) if x == k) for k in range(3)] for p in itertools.product(range(3), repeat=9)))
        assert best <= max(totals) - min(totals) <= max(max(greedy) - min(greedy), best + 12)
    texts = [SAY(int(n)) for n in RNG.integers(1, 300, 500)] + ["again and again"] * 200 + [None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name in ("shard", "slot", "digest", "n", "bytes"):
        table = table.withColumn(name, F.lit(77))
    placed = sharding.shard(table, sharding.ShardParams(crowd=50, cells=3)).cache()
    rows = placed.collect()
    size = collections.Counter()
    for r in rows:
        size[r["shard"]] += r["size"]
    total = sum(len((t or "").encode()) + 1 for t in texts)
    assert sum(size.values()) == total and max(size.values()) - min(size.values()) <= 0.005 * total
    sharding.write_shards(table, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(texts) and back.where("digest = 77 and slot < 500").count() == len(texts)


# --- 9 chat ---------------------------------------------------------------------------------------------------


def test_long_and_repeated_conversations(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k} " + "x" * 200) for k in range(300)] + [(2, k, ("user", "assistant")[k % 2], f"turn {k} " + "x" * 200) for k in range(300)]
    rows += [(3, 0, "assistant", "same")] * 3 + [(4, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("turns", "nodes", "tree_id", "n"):
        table = table.withColumn(name, F.lit(1))
    got = {r["conv_id"]: r for r in chat.formatted(table, chat.ChatParams(crowd=2, size=1000)).collect()}
    assert got[1]["n_turns"] == got[2]["n_turns"] == 300 and got[1]["turns_sha256"] == got[2]["turns_sha256"]
    assert got[3]["n_turns"] == 3 and got[3]["loss_chars"] == 12 and got[4]["n_turns"] == 1


# --- 10 pages --------------------------------------------------------------------------------------------------


@given(st.lists(st.floats(0, 1000), min_size=1, max_size=30), st.sampled_from([0.5, 1.0, 2.0]))
def test_smoothing_against_a_plain_mean(ratios, sigma):
    reach = max(1, math.ceil(2 * sigma))
    for x, got in enumerate(html_extract.smoothed(ratios, sigma)):
        near = {y: math.exp(-((x - y) ** 2) / (2 * sigma**2)) for y in range(len(ratios)) if abs(x - y) <= reach}
        assert got == pytest.approx(sum(w * ratios[y] for y, w in near.items()) / sum(near.values()))


@given(st.lists(st.booleans(), max_size=30))
def test_clusters_are_the_runs(content):
    runs = [[k for k, _ in g] for c, g in itertools.groupby(enumerate(content), key=lambda x: x[1]) if c]
    assert [list(r) for r in html_extract.clusters(content)] == runs


LONG = "long words of an article " * 12
PAGES = {
    "named by nothing": ("<body><div><a href=/a>Home</a> <a href=/b>News</a></div><div><h1>Title</h1><p>Short.</p><p>{0}</p><p>Mid.</p><p>{0}</p><p>End.</p></div><div>Some words below</div></body>", "Title Short. {0} Mid. {0} End."),
    "within a wrapper": ("<body><div id=page><div><a>Home</a><a>News</a></div><div><div><h2>Head</h2></div><div>{0}</div><div>{0}</div></div><div>words below</div></div></body>", "Head {0} {0}"),
    "right in the body": ("<body><ul><li><a>Home</a><li><a>News</a></ul><h1>Title</h1><p>{0}<p>{0}<div>words below</div></body>", "Title {0} {0}"),
    "beside a list": ("<body><div><p>{0}</p><h3>Sub</h3><p>few words</p><p>{0}</p></div><div><p><a>x</a> <a>y</a></p><p>Read also this</p></div></body>", "{0} Sub few words {0}"),
    "in sections": ("<body><div><a>menu</a></div><div><section><p>{0}</p></section><section><p>{0} {0}</p><p>tail</p></section></div></body>", "{0} {0} {0} tail"),
}


@pytest.mark.parametrize("name", PAGES)
def test_ratios_find_articles_that_no_name_marks(name):
    html, text = (x.format(LONG.strip()) for x in PAGES[name])
    assert html_extract.main_text(html) == text
    assert html_extract.main_text(html, html_extract.ExtractParams(threshold=-1e9)) != text  # without a threshold all is content


def test_pages_at_the_edges(spark):
    assert html_extract.main_text("<nav>menu</nav><article><h1></h1></article><footer>foot</footer>") == ""
    assert html_extract.main_text("<div>" * 5000 + "<p>deep words</p>" * 5000).count("deep words") == 5000
    rows = [(1, "u", "<article><p>x &amp; y</p></article>"), (1, "u", "<article><p>x &amp; y</p></article>"), (2, None, f"<article>{'<p>' + LONG + '</p>'}{'<p>w</p>' * 20_000}</article>"), (3, "v", "")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own")).withColumn("n_chars", F.lit(1))
    got = html_extract.extract(table).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in got) == [(1, 5), (1, 5), (2, len(LONG.strip()) + 40_000), (3, 0)]
    assert html_extract.extract(table.limit(0)).count() == 0


def test_tokenizer_files_are_there():
    assert os.path.exists(public_tokenizers.path("word_bpe_49k.json"))
