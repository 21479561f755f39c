"""Corpus operators against brute force, and at their edges."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnweave.llm import chat, html_extract, line_dedup, minhash, mixing, packing, pii, quality_rules, sharding
from tarnweave.llm.embedding_dedup import near_vectors
from tarnweave.llm.graph import components

DOCS = "doc_id long, text string, source string, n long, bucket string, size string, id string"
PACK = packing.PackParams(public_tokenizers.path("word_bpe_49k.json"))


def docs(spark, texts, sources=None):
    """Documents with columns whose names clash with the operators' own."""
    rows = [(i if t != "<no id>" else None, t, (sources or {}).get(i, "a"), 1, "b", "s", "i") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


RNG = np.random.default_rng(5)
WORDS = [f"w{i}" for i in range(400)]
SAY = lambda n: " ".join(RNG.choice(WORDS, n))
LONG = SAY(20_000)
TEXTS = [None, "", "  \n\t ", "one", "one", "two words", LONG, LONG, "<no id>"] + [SAY(60) for _ in range(20)]


def reach(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(100, 100), (3, None), (50, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    expected = reach(range(51), [x for x in links if x[1] is not None and x[0] < 100])
    assert got == {k: v for k, v in expected.items() if k < 40 or k == 50}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("params", [minhash.MinHashParams(), minhash.MinHashParams(width=3, percent=85, bands=24, rows=5, block=4)])
def test_near_duplicates(spark, params):
    near = []
    for _ in range(12):
        w = TEXTS[-1].split()
        for at in RNG.integers(0, 60, RNG.integers(0, 4)):
            w[at] = "changed"
        near.append(" ".join(w))
    texts = TEXTS + near + [near[0].upper()]
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        n = min(params.width, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    named = [i for i in sets if texts[i] != "<no id>"]
    links = [(a, b) for a in named for b in named if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= params.percent * len(sets[a] | sets[b])]
    expected = reach(named, links)
    got = minhash.near_duplicates(docs(spark, texts), params).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None} == {
        i: (len(sets[i]), expected[i], expected[i] == i) for i in named
    }
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True]
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_near_vectors(spark):
    base = RNG.standard_normal((12, 16))
    rows = [*base, base[0] + 0.05, base[0] + 0.05, base[1] * 3, base[0] + 0.02, np.zeros(16)]
    table = [(i, [float(x) for x in v], "label") for i, v in enumerate(rows)]
    table += [(90, None, ""), (91, [float("nan")] + [1.0] * 15, ""), (92, [None] + [1.0] * 15, ""), (93, [], "")]
    got = {r["vec_id"]: r for r in near_vectors(spark.createDataFrame(table, "vec_id long, embedding array<double>, raw string")).collect()}
    unit = np.array(rows[:-1]) / np.linalg.norm(rows[:-1], axis=1)[:, None]
    close = (unit @ unit.T >= 0.9) & ~np.eye(len(unit), dtype=bool)
    expected = reach(range(len(unit)), list(zip(*map(np.ndarray.tolist, np.nonzero(close)), strict=True)))
    for i in range(len(unit)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (close[i].sum(), expected[i])
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (16, 90, 91, 92, 93))


def base_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {k + d for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for d in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += bool(line.strip(" \t\n\v\f\r")) and line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_rules(spark):
    texts = TEXTS + ["a b c d e " * 5, "x y z\nx y z\n\n\nx y z #*$"] + [SAY(40).upper() + " !!" for _ in range(10)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(9, 29)] + [(i, 0, 0) for i in range(31, 41)] + [(9, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_rules.quality_rules(docs(spark, texts), labels, carry=("text", "n")).collect()
    for r in got:
        counts = base_rules(r["text"])
        assert counts == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert r["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
    none = quality_rules.quality_rules(docs(spark, texts), labels.limit(0)).where("not kept and not base_failed")
    assert none.count() == 0 and quality_rules.quality_rules(docs(spark, []), labels).count() == 0


def test_quality_threshold_parts_labelled_kinds(spark):
    junk = [f"JUNK{i}!!" for i in range(40)]
    texts = [SAY(60) if i % 2 else " ".join(RNG.choice(junk, 40)) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    rows = quality_rules.quality_rules(docs(spark, texts), labels).where("not base_failed").collect()
    assert all(r["kept"] == bool(r["doc_id"] % 2) for r in rows) and len(rows) > 100
    twice = quality_rules.quality_rules(docs(spark, texts).union(docs(spark, texts)), labels).where("not base_failed")
    assert sorted(r["doc_id"] for r in twice.where("kept").collect()) == sorted([r["doc_id"] for r in rows if r["kept"]] * 2)


def test_quality_rules_take_all_labels(spark):
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice([f"{'xy'[i % 2]}{k}" for k in range(40)], 40)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    others = spark.range(1000, 141_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))  # of no document
    want = quality_rules.quality_rules(docs(spark, texts), labels).orderBy("doc_id").collect()
    assert quality_rules.quality_rules(docs(spark, texts), others.union(labels)).orderBy("doc_id").collect() == want


def test_quality_threshold_against_plain_counts(spark):
    rng = np.random.default_rng(8)
    for n in (2, 3, 40, 3000):
        rows = [(float(x) / 8, bool(g)) for x, g in zip(rng.integers(-40, 40, n), rng.random(n) < 0.7)]
        rows[:2] = [(rows[0][0], True), (rows[1][0], False)]
        good, bad = (np.array([x for x, g in rows if g == side]) for side in (True, False))
        cuts = [c for c in sorted({x for x, _ in rows}) if c <= np.quantile(good, 0.125, method="lower")]
        cut = cuts[np.argmax([(1 - (good < c).sum() / len(good)) - (1 - (bad < c).sum() / len(bad)) for c in cuts])]
        want = (cut + max(bad[bad < cut])) / 2 if (bad < cut).any() else cut
        seen = spark.createDataFrame(rows, "llr double, good boolean").repartition(3)
        assert quality_rules.threshold(seen, 0.875) == want
        assert quality_rules.threshold(seen.where("good"), 0.875) == quality_rules.threshold(seen.where("not good"), 0.875) == float("-inf")


def test_likelihood_ratio_by_hand():
    raw, target = np.array([6, 2, 2]), np.array([1, 3, 0])
    expected = [np.log((t + 1) / 7 / ((r + 1) / 13)) for r, t in zip(raw, target, strict=True)]
    assert quality_rules.log_ratios(raw, target, 1.0).tolist() == [round(1e6 * x) for x in expected]


def test_line_dedup(spark):
    p = line_dedup.ChunkParams()
    shared = [SAY(12) for _ in range(8)]
    texts = TEXTS + ["\n".join([SAY(5) for _ in range(k)] + shared + [SAY(5) for _ in range(4)]) for k in range(6)]
    seen, expected = set(), {}
    for i, t in enumerate(texts):
        if t is None:
            expected[i] = (None, 0)
            continue
        lines = t.split("\n")
        gone = set()
        for start, n, body in line_dedup.chunks_of(t, p):
            if body in seen:
                gone |= set(range(start, start + n))
            seen.add(body)
        expected[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    got = line_dedup.remove_repeated_chunks(docs(spark, texts)).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in got if r["doc_id"] is not None} == {
        i: v for i, v in expected.items() if texts[i] != "<no id>"
    }
    assert sum(v[1] for v in expected.values()) > 5 and got[0]["size"] == "s"
    assert line_dedup.remove_repeated_chunks(docs(spark, [])).count() == 0


def test_line_dedup_takes_whole_runs(spark):
    passages = [[SAY(30) for _ in range(n)] for n in (2, 3, 5, 9)] + [["lead in", "", "", "", "after blanks"]]
    mixed = ["\n".join([SAY(5) for _ in range(k)] + q + [SAY(5) for _ in range(3)]) for k in range(4) for q in passages]
    copies = ["\n\n\n" + SAY(9) + "\n" + SAY(4) + "\n\n\n"] * 2 + ["a b\na b\na b", "lone\n" + SAY(5), "lone\n" + SAY(5), "\n\n", "x\n\n\n"]
    texts = mixed + copies
    lines = [t.split("\n") for t in texts]
    places = [(i, k) for i, x in enumerate(lines) for k in range(len(x))]
    gone: dict[int, set] = {i: set() for i in range(len(texts))}
    for i, k in places:  # every later run of two equal lines or more, by comparing all places
        for j, m in places:
            n = 0
            while (j, m) < (i, k) and k + n < len(lines[i]) and m + n < len(lines[j]) and lines[i][k + n] == lines[j][m + n]:
                n += 1
            if n >= 2 and "".join(lines[i][k : k + n]).strip():
                gone[i] |= set(range(k, k + n))
    got = {r["doc_id"]: r for r in line_dedup.remove_repeated_chunks(docs(spark, texts)).collect()}
    assert {i: (r["text"], r["n_removed_lines"]) for i, r in got.items()} == {
        i: ("\n".join(x for k, x in enumerate(lines[i]) if k not in gone[i]), len(gone[i])) for i in gone
    }
    for i in range(len(passages), len(mixed)):
        assert got[i]["n_removed_lines"] == len(passages[i % len(passages)])
    whole, twice = len(mixed) + 1, len(mixed) + 2
    assert got[whole]["text"] == "" and got[whole]["n_removed_lines"] == got[whole]["n_lines"] and got[twice]["text"] == "a b"


@given(st.lists(st.integers(1, 40), max_size=60))
def test_combinations_use_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=41)[:41]
    used = Counter()
    for times, combined in packing.combinations(counts):
        assert times > 0 and sum(combined) <= 40
        for n in combined:
            used[n] += times
    assert used == Counter(lengths)


def test_packing(spark):
    texts = TEXTS + ["Straße ΣΟΣ <|endoftext|> x\x1cy 日本", "it's 42%%%"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PACK.tokenizer)
    packed = packing.pack(docs(spark, texts), PACK, with_ids=True)
    got, filled = defaultdict(dict), defaultdict(list)
    for r in packed.collect():
        got[r["doc_id"]][r["piece"]] = r
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k, piece in got[i if t != "<no id>" else None].items():
            part = ids[2048 * k : 2048 * (k + 1)]
            assert piece["ids"] == part and (piece["start"], piece["length"]) == (2048 * k, len(part))
            assert piece["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert sum(len(r["ids"]) for r in packing.sequences(packed).collect()) == sum(n for p in filled.values() for _, n in p)
    assert packing.pack(docs(spark, []), PACK).count() == 0


def test_surrogates(spark):
    texts = [None, "", "Write to Jane.Roe@mail.example.org, or jane.roe@mail.example.org.", "Call +1 (512) 555-0199 or 512-555-0199; card 4539 1488 0343 6467",
             "Frau Anna Schmidt und Herr SCHMIDT, Господин Иванов", 'token = "0123456789abcdef0123" from 10.20.30.40', "nothing 3.14 here 2024-01-01", "Mr. Lee met Mr. Lee",
             'TOKEN = "9233A8ECF7C5B09FE591" ñdoñ.34@mail7.example.com 4845168114407329 190.137.223.204 4539 1488 0343 6467 10.9.8.7']
    got = {r["doc_id"]: r for r in pii.replace_pii(docs(spark, texts)).collect()}
    assert got[0]["text"] is None and got[1]["text"] == "" and got[6]["text"] == texts[6]
    mails = re.findall(r"[\w.]+@[\w.]+\.org", got[2]["text"])
    assert len(mails) == 2 and mails[0].lower() == mails[1] != "jane.roe@mail.example.org" and mails[0][0].isupper()
    digits = [re.sub(r"\D", "", x) for x in re.findall(r"[+\d][\d() -]{9,}\d", got[3]["text"])]
    assert digits[0][-10:] == digits[1][-10:] != "5125550199" and digits[0][0] == "1"
    luhn = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits[2]))))
    assert luhn % 10 == 0 and len(digits[2]) == 16
    names = re.findall(r"Frau (\w+) (\w+) und Herr (\w+), Господин (\w+)", got[4]["text"])[0]
    assert names[1].upper() == names[2] and names[0].endswith("lia") and re.fullmatch("[а-яА-Я]+", names[3])
    assert re.fullmatch(r'token = "[0-9a-f]{20}" from \d+\.\d+\.\d+\.\d+', got[5]["text"]) and "0123456789abcdef" not in got[5]["text"]
    assert len(set(re.findall(r"Mr\. (\w+)", got[7]["text"]))) == 1
    assert re.fullmatch(r'TOKEN = "[0-9A-F]{20}" [a-z]{4}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com \d{16} \d+\.\d+\.\d+\.\d+ \d{4} \d{4} \d{4} \d{4} \d+\.\d+\.\d+\.\d+', got[8]["text"])
    assert got[8]["n_entities"] == 6 and not any(x in got[8]["text"] for x in ("9233A8", "ñ", "4845168", "137.223", "190", "4539", "9.8.7"))
    many = spark.createDataFrame([("ip", f"10.0.{i // 200}.{i % 200 + 1}") for i in range(900)], "kind string, norm string")
    cores = [r["core"] for r in pii.surrogates(many, "k").collect()]
    assert len(set(cores)) == 900 and not set(cores) & {r["norm"] for r in many.collect()}
    assert pii.replace_pii(docs(spark, [])).count() == 0


FORMS = [
    ("Frau Anna Maria Schmidt kam", r"Frau [A-Z][a-z]+ [A-Z][a-z]+ [A-Z][a-z]+ kam", "Anna Maria Schmidt"),
    ("Mr. J. Smith or Mr. J.R.R. Tolkien", r"Mr\. [A-Z]\. [A-Z][a-z]+ or Mr\. [A-Z]\.[A-Z]\.[A-Z]\. [A-Z][a-z]+", "J. Smith J.R.R. Tolkien"),
    ("Herr von Neumann, Prof. Dr. Ada de la Cruz.", r"Herr von [A-Z][a-z]+, Prof\. Dr\. [A-Z][a-z]+ de la [A-Z][a-z]+\.", "Neumann Ada Cruz"),
    ("Monsieur d'Artagnan; Mr. K Lee", r"Monsieur [A-Za-z]+; Mr\. [A-JL-Z] [A-Z][a-z]+", "Artagnan Lee"),
    ("+49 30 1234567 = (030) 1234567 = 030/1234567", r"\+49 ([1-9]\d) (\d{7}) = \(0\1\) \2 = 0\1/\2", "1234567"),
    ("+33 6 12 34 56 78, 06 12 34 56 78", r"\+33 ([1-9]) (\d\d \d\d \d\d \d\d), 0\1 \2", "12 34 56 78"),
    ("+34 912 345 678 or 91 234 56 78 or 0171-2345678", r"\+34 \d{3} \d{3} \d{3} or \d\d \d{3} \d\d \d\d or 0\d{3}-\d{7}", "345 2345678 234"),
    ("+442079460958 and +49 (0)30 1234567", r"\+44\d{10} and \+49 \(0\)\d\d \d{7}", "2079460958 1234567"),
    ("at 2001:db8::8a2e:370:7334, ::ffff:10.1.2.3 or fe80::1.", r"at (\w{4}:){7}\w{4}, (\w{4}:){7}\w{4} or (\w{4}:){7}\w{4}\.", "2001:db8 8a2e 10.1.2.3 fe80"),
    ("on 01.02.2024, 2024-01-01, 01/02/2024 at 12:30:45 std::dec 912.345.678 aa:bb:cc:dd:ee:ff", r"on 01\.02\.2024, 2024-01-01, .* ee:ff|.*ee:ff", ""),
]


@pytest.fixture(scope="module")
def replaced_forms(spark):
    return {r["doc_id"]: r for r in pii.replace_pii(docs(spark, [text for text, _, _ in FORMS])).collect()}


@pytest.mark.parametrize("at", range(len(FORMS)))
def test_surrogates_of_other_forms(replaced_forms, at):
    (text, shape, gone), row = FORMS[at], replaced_forms[at]
    assert re.fullmatch(shape, row["text"]) and not any(re.search(rf"(?<!\w){re.escape(x)}(?!\w)", row["text"]) for x in gone.split())
    assert gone or row["text"] == text and row["n_entities"] == 0


def test_surrogates_keep_persons_apart_and_together(spark):
    texts = [
        "Frau Anna Schmidt kam. Anna Schmidt ging. Dr. Anna Schmidt blieb. Frau Anna lachte, Schmidt's Hund nicht.",
        "Mrs. Van der Berg; Mr. Smith The end. The end of the line. Smith left.", "Herr Anna und Herr Schmidt", "Prof. Kim Lee, Kim and Lee",
        "order 4845168114407320 of 1234567890123 stays", "4539148803436467 and 4539 1488 0343 6468",
    ]
    got = {r["doc_id"]: r for r in pii.replace_pii(docs(spark, texts)).collect()}
    n = re.fullmatch(r"Mrs\. (\w+) der (\w+); Mr\. (\w+) \w+ end\. The end of the line\. \3 left\.", got[1]["text"])
    assert n and not {"Van", "Berg", "Smith"} & set(n.groups())
    k = re.fullmatch(r"Frau (\w+) (\w+) kam\. \1 \2 ging\. Dr\. \1 \2 blieb\. Frau \1 lachte, \2's Hund nicht\.", got[0]["text"])
    assert k and got[2]["text"] == f"Herr {k[1]} und Herr {k[2]}"
    assert re.fullmatch(r"Prof\. (\w+) (\w+), \1 and \2", got[3]["text"]) and "Kim" not in got[3]["text"]
    assert got[4]["text"] == texts[4] and got[4]["n_entities"] == 0
    assert re.fullmatch(r"\d{16} and 4539 1488 0343 6468", got[5]["text"]) and got[5]["n_entities"] == 1 and "8803436467" not in got[5]["text"]


def test_surrogates_end_where_a_form_is_used_up(spark):
    every = spark.createDataFrame([("email", f"{i}@{j}.com") for i in range(10) for j in range(10)], "kind string, norm string")
    cores = [r["core"] for r in pii.surrogates(every, "k").collect()]
    assert len(set(cores)) == 100 and not set(cores) & {r["norm"] for r in every.collect()}
    # where all values of a form are real, or draws end, parts exchange theirs: each gets another's, all distinct
    for n, attempts in ((10, 1), (3, 1)):
        real = [("ssn", str(i)) for i in range(n)]
        got = {r["norm"]: r["core"] for r in pii.surrogates(spark.createDataFrame(real, "kind string, norm string"), "k", attempts).collect()}
        assert set(got) == {x for _, x in real} and len(set(got.values())) == n
        assert all(k != v and len(v) == 1 for k, v in got.items())


def test_surrogates_at_the_edges(spark):
    rows = [(None, "mail a.b@c.org"), (None, "mail a.b@c.org"), (1, None), (1, "x@y.org " * 3000 + LONG), (2, "1.2.3.4")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("entities", "th", "again", "new", "kind", "id", "at"):
        table = table.withColumn(name, F.lit(7))
    got = pii.replace_pii(table).collect()
    assert len(got) == 5 and sorted((r["n_entities"]) for r in got) == [0, 1, 1, 1, 3000]
    assert len({r["text"] for r in got if r["doc_id"] is None}) == 1


def test_surrogates_of_mail_names_in_any_script(spark):
    names = ["иван.петров", "Γιώργος_7", "山田太郎", "محمد", "Иван2"]
    got = {r["doc_id"]: r for r in pii.replace_pii(docs(spark, [f"to {n}@mail.ru now" for n in names])).collect()}
    for i, name in enumerate(names):
        local = re.fullmatch(r"to (\S+)@[a-z]{4}\.ru now", got[i]["text"])[1]
        assert got[i]["n_entities"] == 1 and len(local) == len(name)
        assert not any(run.lower() in local.lower() for run in re.findall(r"[^\W\d_]+", name))
    assert re.match("to [а-я]{4}[.][а-я]{6}@", got[0]["text"]) and re.match("to [А-Я][а-я]{3}[0-9]@", got[4]["text"])


def test_mixing(spark):
    texts = TEXTS[:6] + [SAY(n) for n in RNG.integers(1, 200, 300)]
    sources = {i: [None, "a", "b", "c"][min(3, i % 7)] for i in range(len(texts))}
    rows = mixing.mix(docs(spark, texts, sources)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    total = sum(r["size"] for r in rows)
    assert sum(v[0]["target"] for v in by.values()) == pytest.approx(total)
    for v in by.values():
        assert v[0]["target"] <= 3 * v[0]["source_size"] and sum(r["taken"] for r in v) == pytest.approx(v[0]["target"], rel=0.02)
    again = mixing.mix(docs(spark, texts, sources).repartition(3)).collect()
    assert sorted((r["mix_id"], r["taken"]) for r in rows) == sorted((r["mix_id"], r["taken"]) for r in again)
    table = docs(spark, texts, sources)
    assert mixing.repeat(table, mixing.mix(table)).count() == sum(r["copies"] for r in rows)
    assert mixing.mix(docs(spark, [])).count() == 0


def test_repeat_of_equal_rows(spark):
    table = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c"), (None, "d"), (None, None)], "doc_id long, text string")
    mixed = table.select(
        F.col("doc_id").alias("mix_id"), F.xxhash64("text").alias("mix_text"),
        F.expr("case when doc_id = 1 then row_number() over (partition by doc_id order by text) when text = 'd' then 3 else 0 end").alias("copies"),
    )
    assert sorted(r["text"] for r in mixing.repeat(table, mixed).collect()) == ["a b"] * 4 + ["d"] * 3


def test_sharding(spark):
    texts = TEXTS + ["again"] * 40
    rows = sharding.shard(docs(spark, texts), sharding.ShardParams(shards=3, crowd=8)).collect()
    slots, homes, size = defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
        homes[texts[r["doc_id"]] if r["doc_id"] is not None else "<no id>"].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(h) == 1 for h in homes.values())
    assert len(rows) == len(texts) and sharding.shard(docs(spark, [])).count() == 0


@given(st.lists(st.integers(1, 1000), min_size=1, max_size=40), st.integers(2, 5))
def test_differencing_keeps_sums(sizes, k):
    places, totals = sharding.differencing([(s, *[0] * (k - 1)) for s in sizes])
    sums = [0] * k
    for s, place in zip(sizes, places, strict=True):
        assert sorted(place) == list(range(k))
        sums[place[0]] += s
    assert max(sums) - min(sums) == max(totals) - min(totals) or sorted(sums, reverse=True) == sorted(totals, reverse=True)


@given(st.lists(st.tuples(st.text(max_size=8), st.text(max_size=12)), max_size=4))
def test_chat_round_trip(turns):
    text = "".join(chat.format_turn(r, t) for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(text)] == turns


def test_prefix_trees(spark):
    rows = [(i, 0, "user", "hi") for i in range(9)] + [(i, 1, "assistant", f"a{i % 3}|\\<|end|>") for i in range(9)]
    rows += [(20, 1, "assistant", None), (20, 0, None, "x"), (21, 0, "user", "hi"), (None, 0, "user", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat.formatted(table, chat.ChatParams(crowd=2)).collect()}
    assert got[4]["n_turns"] == 2 and got[4]["loss_chars"] == len("a1|\\<|end|>") and got[20]["loss_chars"] == 0 and len(got) == 12
    forest = {r["tree_id"]: r for r in chat.trees(chat.assembled(table.drop("key").where("conv_id < 9"))).collect()}
    assert len(forest) == 1
    tree = next(iter(forest.values()))
    once = len(chat.format_turn("user", "hi"))
    assert [s["start"] for s in tree["segments"]][:2] == [0, once] and len(tree["segments"]) == 4 and tree["before"] == []
    last = tree["segments"][3]
    assert [tuple(x) for x in last["attends"]] == [(0, once), (last["start"], last["stop"])] and tree["positions"][last["start"]] == once
    assert chat.formatted(table.limit(0)).count() == 0


def test_crowded_trees_stand_on_stems_and_emit_each_turn_once(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    encode = lambda s: tokenizer.encode(s, add_special_tokens=False).ids
    decode = lambda ids: tokenizer.decode(ids, skip_special_tokens=False)
    said = {i: [("user", "hi"), ("assistant", f"a{i % 3} <|endoftext|> ü|"), ("user", f"c{i % 20}"), ("assistant", SAY(3))][: 1 + i % 5] for i in range(60)}
    rows = [(i, k, *t) for i, turns in said.items() for k, t in enumerate(turns)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for p in (chat.ChatParams(crowd=4), chat.ChatParams(size=60)):
        conversations = chat.assembled(table)
        forest = chat.trees(conversations, p, encode).cache()
        prefixes = {tuple(v[: k + 1]) for v in said.values() for k in range(len(v))}
        emitted = forest.collect()
        assert sum(len(r["segments"]) for r in emitted) == len(prefixes) and any(r["before"] for r in emitted)
        by_name = {r["tree_id"]: r for r in emitted}
        for r in emitted:  # positions go on where the stems end
            base = sum(len(by_name[b]["tokens"]) for b in r["before"])
            assert not r["positions"] or min(r["positions"]) == base
        got = {r["key"]: r for r in chat.read_back(forest, decode).collect()}
        for r in conversations.collect():
            turns = said[r["conv_id"]]
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            assert got[r["key"]]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
            learned = "".join(text for role, text in turns if role == "assistant")
            assert (got[r["key"]]["loss_chars"], got[r["key"]]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p>&lt;b&gt; plain", "<b> plain"),
    ("<nav>menu</nav><article><h1>T</h1><p>one\n two<p>three&amp;four</article><footer>foot</footer>", "T one two three&four"),
    ("<div class=sidebar>side</div><main><p>short.</p><p>" + "long " * 50 + "</p><form>x</form><div class='comments'><p>me too</p></div></main>", "short. " + "long " * 49 + "long"),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><article><p>a<b>b</b>c<br>d</p></article><div class='cookie-notice'>ok?</div>", "abc d"),
    ("<article><p>" + "long " * 50 + "</p><article class='comment'><p>me too</p></article></article>", "long " * 49 + "long"),
    ("<p>kept <![odd[x]]> text<!-- never closed <p>x", "kept text"),
])
def test_main_text(html, text):
    assert html_extract.main_text(html) == text


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'>{}</div>", "<div id=page class='header-fixed'>{}</div>", "<form action=x>{}</form>",
    "<div class='header wrapper'><form><nav>menu menu</nav>{}</form></div>", "<p>skip</p><div class=sidebar-right>{}<div class=comments>me too</div></div>",
])
@pytest.mark.parametrize("body", ["<article><p>{}</p></article>", "<main><p>{}</p></main>", "<div><p>{}</p></div>"])
def test_wrappers_of_the_main_text_stay(page, body):
    said = "long " * 49 + "long"
    assert html_extract.main_text(page.format(body.format(said))).removeprefix("skip ") == said


def test_text_in_asides_only_is_kept_and_asides_beside_text_go():
    assert html_extract.main_text("<header><p>all there is</p></header>") == "all there is"
    said = "long " * 49 + "long"
    assert html_extract.main_text(f"<article><p>{said}</p></article><div class=sidebar><article>{said} {said}</article></div>") == said
    assert html_extract.main_text(f"<p>{said}</p><div class=comments><article>{said} {said}</article></div>") == said


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>x</p></article>"), (None, None, None)], "page_id long, url string, html string")
    assert [tuple(r) for r in html_extract.extract(pages).orderBy("page_id").collect()] == [(None, None, "", 0), (1, "u", "x", 1)]
