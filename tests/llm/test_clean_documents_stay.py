"""What the pipeline's stages must leave alone, and the parts they rest on."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hearthmill.llm import common, contamination, language, masked_lm, mixing, near_dedup
from hearthmill.sources.shared import ROWS_PER_TASK, few, settle

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, __language string, label string, id long"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_unlabelled_corpus_keeps_every_text_with_letters(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language_id(spark, docs, SF_DIR)
    assert kept.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count() > 190


def test_texts_that_mix_languages_stay(spark, tables):
    prose = {r["lang"]: r["text"].split() for r in tables.filter("length(text) > 3000 and lang is not null").collect()}
    assert len(prose) >= 3
    mixed = [(10_000 + i, "\n".join(" ".join(words[i * 14 : i * 14 + 14]) for words in prose.values()), None, "mixed") for i in range(20)]
    bad = [(20_000, "12 34 -- !!", None, "x"), (20_001, None, None, "x"), (20_002, "", None, "x")]
    rows = spark.createDataFrame([(i, t, None, s, 0, "clash", "clash", 1) for i, t, _, s in mixed + bad], DOCS)
    docs = tables.withColumns({"__language": F.lit("clash"), "label": F.lit("clash"), "id": F.lit(1)}).unionByName(rows)
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs.drop("__language"), SF_DIR).collect()}
    assert {i for i, *_ in mixed} <= kept and not {20_000, 20_001, 20_002} & kept


def test_training_and_prediction_see_the_same_words():
    text = "Don't stop: l'été हिन्दी भाषा İstanbul naïve co-op x2y ß"
    cut = language._letter_runs(text)
    joined = language.words_of([" ".join(cut)])
    assert np.array_equal(joined.whole, language.words_of([text]).whole)
    assert "don" in cut and "t" in cut and len(cut) == len(joined.whole)


def test_spans_follow_the_languages_of_a_text(spark, tables):
    field = language.fit(language.training_rows(tables.where("doc_id % 2 = 0")))
    prose = {r["lang"]: r["text"].split()[:60] for r in tables.where("length(text) > 900 and doc_id % 2 = 1 and lang is not null").collect()}
    first, second = sorted(prose)[:2]
    text = " ".join(prose[first]) + "\n" + " ".join(prose[second])
    frame = spark.createDataFrame([(1, text), (2, None), (3, "12 !"), (4, text)], "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in frame.select("doc_id", language.spans_column(frame, field).alias("s")).collect()}
    assert got[2] == got[3] == [] and got[1] == got[4]
    n = len(language._letter_runs(text))
    assert [s["first_word"] for s in got[1]] == np.cumsum([0, *[s["n_words"] for s in got[1]]])[:-1].tolist()
    assert sum(s["n_words"] for s in got[1]) == n
    by_word = [s["lang"] for s in got[1] for _ in range(s["n_words"])]
    half = len(language._letter_runs(" ".join(prose[first])))
    assert by_word[:half].count(first) >= 0.9 * half and by_word[half:].count(second) >= 0.9 * (n - half)
    certain = frame.select(language.language_column(frame, field).alias("p")).first()["p"]
    assert certain["certainty"] > 0.8 > certain["score"]


def test_near_copies_of_the_stage_are_judged_by_five_words(spark):
    assert corpus_pipeline.WORDS_PER_SHINGLE == 5
    rng = random.Random(4)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    # k changed words far apart: similarity (196 - 5k) / (196 + 5k) by five words, (197 - 4k) / (197 + 4k) by four.
    def changed(k):
        words = list(base)
        for i in range(k):
            words[10 + i * 20] = f"n{i}"
        return " ".join(words)

    rows = [(1, " ".join(base)), (2, changed(4)), (3, changed(5))]
    for gram, want in ((5, [1, 3]), (4, [1])):
        frame = spark.createDataFrame([rows[0], rows[2]] if gram == 4 else rows[:1] + [(3, changed(5))], "doc_id long, text string")
        assert sorted(r["doc_id"] for r in near_dedup.drop_near_duplicates(frame, gram=gram).collect()) == want
    close = spark.createDataFrame(rows[:2], "doc_id long, text string")
    assert [r["doc_id"] for r in near_dedup.drop_near_duplicates(close).collect()] == [1]


def test_recall_of_pairs_inside_a_crowd(spark):
    """Pairs of similarity 0.81 among texts that all share 0.6: at least 0.9 are found, none is merged wrongly."""
    rng = random.Random(8)
    shared = [f"c{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for pair in range(150):
        own = [f"o{rng.randrange(10**6)}" for _ in range(46)]
        other = [*own[:-20], *[f"d{rng.randrange(10**6)}" for _ in range(20)]]
        rows += [(2 * pair, " ".join(shared + own)), (2 * pair + 1, " ".join(shared + other))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame, gram=4).collect()}
    assert all(group in (i, i - i % 2) for i, group in got.items())
    assert sum(got[2 * pair + 1] == 2 * pair for pair in range(150)) >= 0.9 * 150


def test_few_pairs_of_a_crowd_reach_the_full_sets(spark, monkeypatch):
    """A crowd of similarity around 0.7: no more full sets are compared than a few per text, and every link counts."""
    compared = []

    def counting(pairs, sets, percent, own=near_dedup.confirmed):
        compared[-1] += pairs.count()
        return own(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "confirmed", counting)
    rng = random.Random(12)
    base = [f"c{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for _ in range(300):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([2, 4, 5, 6])):
            words[at] = f"o{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    grams = [{tuple(t.split()[k : k + 4]) for k in range(117)} for t in texts]
    compared.append(0)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame, gram=4).collect()}
    label = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if label[a] != label[b] and 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b]):
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    assert got == dict(enumerate(label))
    assert compared[0] < 3 * len(texts)


@pytest.fixture
def many_partitions(spark):
    """211 shuffle partitions that Spark does not put together by itself; tells how many files each written table has."""
    held = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    files = {}

    def counting(df, label, rows=None):
        table = settle(df, label, rows)
        files[label] = max(files.get(label, 0), len(table.inputFiles()))
        return table

    for k, v in held.items():
        spark.conf.set(k, v)
    yield counting, files
    for k, v in before.items():
        spark.conf.set(k, v)


def test_small_tables_of_near_dedup_are_few_files(spark, monkeypatch, many_partitions):
    counting, files = many_partitions
    monkeypatch.setattr(near_dedup, "settle", counting)
    rng = random.Random(14)
    rows = []
    for group in range(150):
        words = [f"g{group}x{rng.randrange(10**6)}" for _ in range(60)]
        rows += [(2 * group, " ".join(words)), (2 * group + 1, " ".join([*words[:-2], "z", "y"]))]
    crowd = [f"c{rng.randrange(10**6)}" for _ in range(80)]
    rows += [(1000 + i, " ".join([*crowd, *[f"o{rng.randrange(10**6)}" for _ in range(20 if i % 2 else 3)]])) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame, gram=4).collect()}
    assert all(got[i] == i - i % 2 for i in range(300))
    assert len({got[1000 + i] for i in range(0, 60, 2)}) == 1
    own = {"sizes-0", "candidates-0", "sizes-3", "candidates-3", "pairs", "edges", "needed-classes", "left-over", "open-members"}
    assert own <= set(files)
    assert max(files[x] for x in own) <= 2 * spark.sparkContext.defaultParallelism, files


def test_small_tables_of_windows_are_few_files(spark, monkeypatch, many_partitions):
    counting, files = many_partitions
    monkeypatch.setattr(contamination, "settle", counting)
    rng = random.Random(15)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    items = spark.createDataFrame([(k, " ".join(words[20 * k : 20 * k + 20])) for k in range(20)], "item_id long, text string")
    frame = spark.createDataFrame([(k, " ".join(words[20 * k : 20 * k + 15])) for k in range(20)], "doc_id long, text string")
    got = contamination.contaminated_words(frame, items).collect()
    assert sorted((r["doc_id"], r["n_hit"], r["item_ids"]) for r in got) == [(k, 15, [str(k)]) for k in range(20)]
    own = {"window-shingles", "wanted-shingles", "window-prefixes"}
    assert max(files[x] for x in own) <= 2 * spark.sparkContext.defaultParallelism, files


def test_few_leaves_large_tables_as_they_are(spark):
    frame = spark.range(0, 1000, 1, 50)
    least = 2 * spark.sparkContext.defaultParallelism
    assert few(frame, 1000).rdd.getNumPartitions() == min(50, least)
    assert few(frame, 40 * ROWS_PER_TASK).rdd.getNumPartitions() == max(40, min(50, least))
    assert few(frame, 10**12).rdd.getNumPartitions() == 50
    assert few(frame, 0).agg(F.sum("id")).first()[0] == 499500


def test_labels_with_further_links_are_those_of_all_links(spark):
    first = [(i, i + 1) for i in range(0, 60) if i % 6 != 5]
    more = [(5, 30), (17, 53), (53, 59), (100, 3), (101, 102)]
    make = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    joined = near_dedup.joined_components(near_dedup.components(make(first)), make(more)).collect()
    assert sorted(map(tuple, joined)) == sorted(map(tuple, near_dedup.components(make(first + more)).collect()))


def test_components_of_dense_and_long_shapes(spark):
    rng = random.Random(1)
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 40)]
    pairs += [(100 + i, 101 + i) for i in range(60)]
    pairs += [(500, 500 + i) for i in range(1, 200)] + [(900 + 2 * i, 901 + 2 * i) for i in range(20)]
    pairs += [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(150)]
    pairs = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in pairs if a != b]
    parent = {i: i for p in pairs for i in p}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = near_dedup.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((i, root(i)) for i in parent)
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_covering_mixture_keeps_the_normalised_powers(spark):
    sizes = {"a": 900, "b": 100, "c": 12}
    rows = [(n * 1000 + i, "one two three four", s) for n, (s, k) in enumerate(sizes.items()) for i in range(k)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = mixing.Target(entropy=0.95, repeats=4.0, cover=True)
    sources = {r["key"]: r for r in mixing.plan(frame, target)[0].collect()}
    uses = {k: r["uses"] for k, r in sources.items()}
    assert min(uses.values()) == 1.0 and 3.99 < max(uses.values()) <= 4.0 + 1e-6
    weighted = {k: r["weight"] for k, r in sources.items()}
    realised = {k: uses[k] * sources[k]["t"] for k in uses}
    total = sum(realised.values())
    assert all(abs(realised[k] / total - weighted[k]) < 1e-6 for k in uses)
    counts = {r["source"]: r["n"] for r in mixing.mixed_rows(frame, target).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert all(abs(counts[s] - uses["s:" + s] * k) <= 1 for s, k in sizes.items())


def test_long_texts_are_hashed_in_turns():
    texts = ["a bc def", None, "", "x" * 600_000 + " " + "yy zzz " * 150_000, "last words"]
    hashes, bounds = masked_lm.word_hashes(texts)
    one = [masked_lm.word_hashes([t])[0] for t in texts]
    assert np.array_equal(hashes, np.concatenate(one)) and bounds.tolist() == np.cumsum([0, *map(len, one)]).tolist()
    raw = np.frombuffer(b"ab cde f ", np.uint8)
    stand_ins, starts, ends = common.random_words(31, 256), np.array([0, 3, 7]), np.array([2, 6, 8])
    whole = common.run_hashes(stand_ins[raw], starts, ends)
    for most in (1, 2, 3, 4, 100):
        assert np.array_equal(common.word_run_hashes(raw, stand_ins, starts, ends, most), whole)


def test_sketches_differ_in_no_more_than_the_sets():
    rng = np.random.default_rng(6)
    for size in (1, 20, 300, 5000):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, size))
        b = np.unique(np.concatenate((a[size // 5 :], rng.integers(-(2**63), 2**63 - 1, size // 7))))
        differing = np.bitwise_count((near_dedup.odd_sketch(a) ^ near_dedup.odd_sketch(b)).view(np.uint64)).sum()
        assert differing <= len(np.setxor1d(a, b)) and len(near_dedup.odd_sketch(a)) == near_dedup.SKETCH
    assert not near_dedup.odd_sketch(np.zeros(0, np.int64)).any()
