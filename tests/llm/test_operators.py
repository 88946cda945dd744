"""Numbered operators against brute force, and on awkward rows."""

import hashlib
import math
import random
import textwrap
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthmill.llm import chat, contamination, language, licenses, line_dedup, masked_lm, mixing, near_dedup, top_k, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, score string"
LONG_LINE = "this line is long enough to count as a repeated line of text"
WORDS = [f"word{i}" for i in range(400)]


def passage(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Null ids and texts, empty and long texts, repeated rows, clashing columns."""
    base = passage(1, 120)
    rows = [
        (1, base), (2, base), (3, base.replace("word1 ", "other ")), (4, None), (5, ""), (6, "  \n \t"), (None, base), (None, None),
        (7, "12 34"), (8, passage(2, 30_000)), (8, passage(2, 30_000)), (9, "one two"), (10, "One  TWO"), (11, "x" * 50_000), (12, "ÉCOLE \u00df \U0001f600"),
        *[(20 + i, f"{passage(50 + i, 40)}\n  {LONG_LINE.upper() if i % 2 else LONG_LINE}\nend {i}") for i in range(7)],
    ]
    return spark.createDataFrame([(i, t, "en", "src", 0, 99, "clash") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def same_columns(left, right):
    return left.columns == right.columns


def test_line_dedup_against_brute_force(docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            if len(key) >= 40:
                holders.setdefault(key, set()).add(-(2**63) if i is None else i)
    frequent = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    assert LONG_LINE in frequent

    def kept(i, text):
        own = -(2**63) if i is None else i
        lower = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
        return "\n".join(x for x in (text or "").split("\n") if frequent.get(lower(x), own) == own)

    done = line_dedup.with_lines_dropped(docs).select("doc_id", "__kept.*").collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in done) == sorted((str(i), kept(i, t)) for i, t in rows)
    assert {r["n_lines"] for r in done if r["doc_id"] in (4, 5)} == {1}
    assert same_columns(line_dedup.drop_repeated_lines(docs), docs)
    assert line_dedup.drop_repeated_lines(docs).where("doc_id = 4 and text is null").count() == 1
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_near_dedup_awkward_rows(docs, empty):
    found = near_dedup.near_duplicates(docs).collect()
    named = {(r["doc_id"], r["text_hash"]): r for r in found}
    of = lambda i: next(r for (d, _), r in named.items() if d == i)
    assert len(found) == docs.count()
    assert of(2)["component_id"] == of(1)["component_id"] == of(3)["component_id"] == 1
    assert [of(i)["n_shingles"] for i in (4, 5, 6, 9)] == [0, 0, 0, 1]
    assert of(10)["component_id"] == 9 and of(5)["component_id"] == 5
    kept = near_dedup.drop_near_duplicates(docs)
    assert same_columns(kept, docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(8) == 1 and not {2, 3, 10} & set(ids) and {1, 4, 5, 6, 9} <= set(ids)
    assert near_dedup.near_duplicates(empty).count() == near_dedup.drop_near_duplicates(empty).count() == 0


def test_near_dedup_finds_every_link_of_a_large_group(spark):
    """A group beyond the size of small nodes, with members near the limit."""
    rng, base = random.Random(3), passage(9, 90).split()
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(t.split()[k : k + 4]) for k in range(len(t.split()) - 3)} for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in near_dedup.near_duplicates(frame, gram=4).collect()}
    assert got == {i: (root(i), len(sets[i])) for i in range(len(texts))}


def test_shingle_counts_cover_every_set(spark):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(-(2**62), 2**62, n)) for n in (0, 1, 3000, 7)] * 2
    rows = spark.createDataFrame([(s.tolist(),) for s in sets], "s array<long>").repartition(3)
    expected = np.bincount(np.concatenate(sets) % near_dedup.PLACES, minlength=near_dedup.PLACES)
    assert (near_dedup._shingle_counts(rows) == expected).all()
    assert not near_dedup._shingle_counts(rows.limit(0)).any()


def test_contamination_awkward_rows(spark, docs, empty):
    items = spark.createDataFrame([(1, passage(50, 20)), (2, "One two"), (3, None), (4, ""), (None, "12 34"), (5, passage(50, 20))], "item_id long, text string")
    found = {r["doc_id"]: r for r in contamination.contaminated_words(docs, items).collect()}
    assert found[20]["n_hit"] == 20 and found[20]["item_ids"] == ["1", "5"]
    assert (found[9]["n_hit"], found[10]["item_ids"]) == (2, ["2"])
    assert found[7]["item_ids"] == [""] and found[4]["n_words"] == 0 and found[4]["item_ids"] is None
    assert contamination.contaminated_words(docs, items).count() == docs.count()
    kept = contamination.drop_contaminated(docs, items)
    assert same_columns(kept, docs) and not kept.where("doc_id in (7, 9, 10, 20)").count() and kept.where("doc_id = 8").count() == 2
    assert contamination.contaminated_words(empty, items).count() == 0
    assert contamination.contaminated_words(docs, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_contamination_finds_short_items_in_longer_texts(spark):
    items = spark.createDataFrame([(1, "one"), (2, "one two"), (3, "One, two three"), (4, "four five six seven"), (5, "absent"), (6, "two three")], "item_id long, text string")
    texts = ["say one two three four", "a two three", "one", "one two one two", "x y three four five six seven one two", "two one", "one two three", "no item here at all", "", "one one"]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in contamination.contaminated_words(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), items).collect()}
    windows = {"1": ["one"], "2": ["one", "two"], "3": ["one", "two", "three"], "4": "four five six seven".split(), "5": ["absent"], "6": ["two", "three"]}
    for i, text in enumerate(texts):
        w = text.split()
        at = [(k, s) for k, v in windows.items() for s in range(len(w)) if w[s : s + len(v)] == v]
        hit = {p for k, s in at for p in range(s, s + len(windows[k]))}
        assert got[i] == (len(w), len(hit), sorted({k for k, _ in at}) or None), text
    assert len(got) == len(texts)


def test_contamination_of_long_texts_equals_brute_force(spark):
    item = passage(71, 5000)
    pieces = item.split()
    texts = [item, passage(72, 250) + " " + " ".join(pieces[240:2000]) + " " + passage(73, 300), " ".join(pieces[:12]), " ".join(pieces[250:263])]
    items = spark.createDataFrame([(1, item), (2, " ".join(pieces[500:520]))], "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(texts)) + [(0, item)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in contamination.contaminated_words(frame, items).collect()}
    windows = {"1": {tuple(pieces[i : i + 13]) for i in range(len(pieces) - 12)}, "2": {tuple(pieces[i : i + 13]) for i in range(500, 508)}}
    for i, text in enumerate(texts):
        w = text.split()
        at = [(name, s) for s in range(len(w) - 12) for name, held in windows.items() if tuple(w[s : s + 13]) in held]
        assert got[i] == (len(w), len({p for _, s in at for p in range(s, s + 13)}), sorted({name for name, _ in at}) or None)


def test_language_labels_words_of_switched_text(spark, docs, empty):
    tables = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = language.fit(language.training_rows(tables.where("doc_id % 2 = 0")))
    held = tables.where("doc_id % 2 = 1").select("lang", language.language_column(tables, field).alias("p"))
    assert held.select(F.avg((F.col("lang") == F.col("p.lang_pred")).cast("int"))).first()[0] > 0.98
    texts = {r["lang"]: r["text"].split()[:40] for r in tables.where("length(text) > 600 and doc_id % 2 = 1").collect()}
    words = language.words_of([" ".join(texts["de"] + texts["es"])])
    chance, _ = field.marginals(field.scores(words), words.line)
    best = [field.labels[i] for i in chance.argmax(axis=1)]
    assert best[:30].count("de") > 27 and best[-30:].count("es") > 27
    odd = {r["doc_id"]: r["p"] for r in docs.select("doc_id", language.language_column(docs, field).alias("p")).collect()}
    assert odd[4]["lang_pred"] == odd[5]["lang_pred"] == odd[7]["lang_pred"] == "und" and odd[7]["score"] == 0
    assert all(0 <= p["score"] <= 1 for p in odd.values())
    assert language.fit(language.training_rows(empty)).labels == []
    none = language.fit([])
    assert {r[0] for r in docs.select(language.language_column(docs, none)["lang_pred"]).collect()} == {"und"}


def test_field_marginals_equal_enumeration():
    import numpy as np

    field = language.Field(["a", "b", "c"], np.zeros(0, np.uint64))
    rng = np.random.default_rng(0)
    field.steps, field.start = rng.normal(size=(3, 3)), rng.normal(size=3)
    scores = rng.normal(size=(6, 3))
    line = np.array([0, 0, 0, 0, 1, 1])
    got, _ = field.marginals(scores.copy(), line)
    for first, last in ((0, 4), (4, 6)):
        weight = np.zeros((last - first, 3))
        for code in range(3 ** (last - first)):
            path = [code // 3**i % 3 for i in range(last - first)]
            total = field.start[path[0]] + sum(scores[first + i, y] for i, y in enumerate(path))
            total += sum(field.steps[y, z] for y, z in zip(path, path[1:]))
            for i, y in enumerate(path):
                weight[i, y] += math.exp(total)
        assert np.allclose(got[first:last], weight / weight.sum(axis=1, keepdims=True))


def test_masked_lm_prefers_seen_order(spark, docs, empty):
    sentences = ["the cat sat on the mat", "a dog ran in the park", "she read a long book"]
    rng = random.Random(4)
    corpus = spark.createDataFrame([(i, " . ".join(rng.choice(sentences) for _ in range(40))) for i in range(120)], "doc_id long, text string")
    network = masked_lm.train(corpus)
    probe = spark.createDataFrame([(1, sentences[0]), (2, "mat the on sat cat the"), (3, None), (4, "!!")], "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in probe.select("doc_id", masked_lm.pseudo_likelihood(probe, network).alias("s")).collect()}
    assert got[1]["log_likelihood"] > got[2]["log_likelihood"] and got[1]["n_words"] == 6
    assert got[3]["n_words"] == got[4]["n_words"] == 0 and got[3]["mean_log_prob"] is None and got[4]["log_likelihood"] == 0
    everything = docs.select("doc_id", masked_lm.pseudo_likelihood(docs, network).alias("s"))
    assert everything.count() == docs.count()
    untrained = masked_lm.train(empty)
    assert everything.sparkSession.createDataFrame([(1, "a b")], "doc_id long, text string").select(masked_lm.pseudo_likelihood(docs, untrained)["n_words"]).first()[0] == 2


def test_word_likelihoods_tell_rare_words_apart(spark, docs, empty):
    rng = random.Random(8)
    options = masked_lm.Options(frequent=20, shared=1)  # one class for all rarer words
    corpus = spark.createDataFrame([(i, " ".join(f"w{min(int(rng.expovariate(0.02)), 300)}" for _ in range(60))) for i in range(200)], "doc_id long, text string")
    counts = masked_lm.word_counts(corpus)
    network = masked_lm.train(corpus, options, counts)
    n = Counter(w for r in corpus.collect() for w in r["text"].split())
    order = [w for w, _ in n.most_common()]
    often, seldom = order[60], order[-1]
    frame = spark.createDataFrame([(1, often), (2, seldom), (3, "garbage"), (4, None), (5, often), (5, often), (6, f"{often} {seldom} {often}")], "doc_id long, text string")
    rows = masked_lm.word_likelihoods(frame, network, counts).collect()
    got = {r["doc_id"]: r["log_likelihood"] for r in rows}
    assert got[1] - got[2] == pytest.approx(math.log((n[often] + 0.5) / (n[seldom] + 0.5)), abs=1e-6)
    assert got[2] - got[3] == pytest.approx(math.log(2 * n[seldom] + 1), abs=1e-6)
    assert [r["log_likelihood"] for r in rows if r["doc_id"] == 5] == [got[1]] * 2 and got[4] == 0
    assert next(r for r in rows if r["doc_id"] == 4)["mean_log_prob"] is None
    by_class = frame.select("doc_id", masked_lm.pseudo_likelihood(frame, network)["log_likelihood"].alias("x")).where("doc_id = 6").first()["x"]
    kept = {r["word"] for r in counts.collect()} - set(network.words.view(np.int64).tolist())
    mass = sum(r["n"] for r in counts.collect() if r["word"] in kept) + len(kept) + 0.5
    assert got[6] == pytest.approx(by_class + 2 * math.log((n[often] + 0.5) / mass) + math.log((n[seldom] + 0.5) / mass), abs=1e-5)
    assert masked_lm.word_likelihoods(docs, network, counts).count() == docs.count()
    none = masked_lm.word_counts(empty)
    assert masked_lm.word_likelihoods(empty, masked_lm.train(empty, options, none), none).count() == 0


def test_top_k_ties_and_odd_vectors(spark):
    rng = random.Random(6)
    vectors = {i: [rng.uniform(-1, 1) for _ in range(8)] for i in range(60)}
    vectors |= {i: vectors[5] for i in range(60, 400)}  # many equal vectors
    rows = [*vectors.items(), (400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8), (500, [0.5]), (7, vectors[7])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = top_k.top_k(top_k.integer_vectors(frame), F.col("vec_id") % 20 == 0, 10).collect()
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()}
    want = []
    for q in (i for i in whole if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert top_k.top_k(top_k.integer_vectors(frame.limit(0)), F.col("vec_id") % 20 == 0).count() == 0
    few = top_k.top_k(top_k.integer_vectors(frame.where("vec_id in (0, 1, 2)")), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in sorted(few)] == [1, 2]


def test_mixing_reaches_its_targets(spark, docs, empty):
    sizes = {"a": 600, "b": 90, "c": 30, None: 30}
    rows = [(n * 1000 + i, passage(i, 20), s) for n, (s, k) in enumerate(sizes.items()) for i in range(k)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mixed_rows(frame, mixing.Target(entropy=0.8, repeats=100))
    used = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    share = [n / sum(used.values()) for n in used.values()]
    entropy = -sum(p * math.log(p) for p in share) / math.log(4)
    assert abs(entropy - 0.8) < 0.02 and abs(sum(used.values()) - 750) <= 4
    again = mixing.mixed_rows(frame, mixing.Target(entropy=1.0, repeats=2))
    most = again.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert most <= 2
    cover = mixing.mixed_rows(frame, mixing.Target(entropy=0.8, cover=True))
    assert cover.select("doc_id").distinct().count() == len(rows)
    assert cover.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 4
    odd = mixing.mixed_rows(docs, mixing.Target(cover=True))
    worded = [r["doc_id"] for r in docs.collect() if (r["text"] or "").split()]
    assert sorted(map(str, (r["doc_id"] for r in odd.collect()))) == sorted(map(str, worded))
    assert mixing.mixed_rows(empty).count() == 0


def test_top_k_scores_in_steps_of_bounded_size(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    find = lambda: sorted(tuple(r) for r in top_k.top_k(top_k.integer_vectors(frame), F.col("vec_id") % 2 == 0, 5).collect())
    whole = find()
    assert len(whole) == 150 * 5
    block = top_k.Block(list(range(150)), [[1, 2]] * 150, {2: 9.0})
    monkeypatch.setattr(top_k, "STEP_PAIRS", 3000)
    import numpy as np

    steps = [scored.shape for *_, scored, _ in block.scores(np.arange(90), np.full(90, 2), np.arange(180))]
    assert steps == [(20, 150)] * 4 + [(10, 150)]


def test_licenses(spark, docs, empty):
    rows = [(1, "intro\nreleased under the MIT license!"), (2, "Licensed under the Apache Licence, Version 2.0."), (3, "nothing here"), (4, None), (5, ""), (None, "Licensed under CC BY-NC 4.0.")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    got = {r["doc_id"]: r for r in licenses.document_licenses(frame, least=0.7).collect()}
    assert (got[1]["license"], got[1]["line"], got[1]["dice"]) == ("MIT", 1, 1.0)
    assert got[2]["license"] == "Apache-2.0" and got[2]["dice"] == pytest.approx(2 * 5 / 14)
    assert got[3]["license"] is got[4]["license"] is got[5]["license"] is None and got[4]["n_lines"] == 0
    assert got[None]["license"] == "CC-BY-NC-4.0"
    assert licenses.document_licenses(docs).count() == docs.count()
    assert licenses.document_licenses(empty).count() == 0


def test_licenses_full_texts_inside_longer_ones(spark):
    full = {name: text for name, text in licenses.full_texts().items() if len(text.split()) > 400}
    edited = " ".join(w for i, w in enumerate(full["GPL-2.0-text"].split()) if i % 40)
    twice = full["CC0-1.0-text"] + "\n" + passage(3, 400) + "\n" + full["LGPL-3.0-text"]
    rows = [(name, passage(1, 3000) + "\n" + text + "\n" + passage(2, 500)) for name, text in full.items()]
    rows += [("GPL-2.0-text", passage(4, 700) + "\n" + edited), ("CC0-1.0-text", twice)]
    rows += [(name, passage(5, 60) + "\n" + licenses.TEMPLATES[name]) for name in ("GPL-2.0-header", "GPL-3.0-header", "LGPL-2.1-header", "LGPL-3.0-header")]
    frame = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.document_licenses(frame).collect()}
    assert [got[i]["license"] for i in range(len(rows))] == [name for name, _ in rows]
    # Notices inside a full text are not reported beside it.
    assert all(got[i]["dice"] == 1.0 and got[i]["line"] in (1, 2) and got[i]["n_lines"] == 1 for i in range(len(full)))
    assert got[len(full)]["dice"] > 0.9 and got[len(full) + 1]["n_lines"] == 2


def test_license_spans_equal_brute_force(spark):
    rng = random.Random(8)
    templates = {"a": passage(90, 9), "b": " ".join(rng.choice("u v w x".split()) for _ in range(14)), "one": "solo"}
    texts = []
    for i in range(40):
        w = templates["ab"[i % 2]].split()
        w = [x if rng.random() < 0.93 else rng.choice("u v zz".split()) for x in w] * rng.choice([1, 1, 2])
        texts.append(" ".join([passage(200 + i, 5), *w, passage(300 + i, 5), *["solo"][: i % 3 == 0]]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["id"], r["license"]): r["dice"] for r in licenses.license_lines(frame, templates, 0.7).groupBy("id", "license").agg(F.max("dice").alias("dice")).collect()}
    want = {}
    for i, text in enumerate(texts):
        for name, notice in templates.items():
            bigrams = lambda w: [" ".join(w[k : k + 2]) for k in range(max(1, len(w) - 1))]
            g, t = (text.split(), {notice}) if name == "one" else (bigrams(text.split()), set(bigrams(notice.split())))
            spans = [set(g[s:e]) for s in range(len(g)) for e in range(s + 1, len(g) + 1)]
            best = max(2 * len(x & t) / (len(x) + len(t)) for x in spans)
            if best >= 0.7:
                want[i, name] = best
    assert len(want) > 40 and got == pytest.approx(want)


def test_licenses_wrapped_embedded_and_full(spark):
    wrap = lambda name, width: "\n".join(textwrap.wrap(licenses.TEMPLATES[name], width))
    full = licenses.full_texts()
    texts = [
        "code\n\n" + wrap("Apache-2.0-header", 40) + "\nmore code", passage(3, 300) + "\n" + wrap("GPL-3.0-header", 30) + "\n" + passage(4, 300),
        "Copyright 2020 Foo. Released under the MIT License. All rights reserved.", "Copyright (c) 2024 A B\n\n" + full["MIT-text"], full["GPL-3.0-text"], full["Apache-2.0-text"],
        passage(5, 30) + "\n" + full["BSD-3-Clause-text"], "Released under the MIT License. x\ny z. Released under the\nMIT License.", "the MIT license of the work under version 2.0", passage(6, 2000),
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.document_licenses(frame).collect()}
    # The header holds the short Apache notice, which is equally close.
    assert [(got[i]["license"], got[i]["dice"], got[i]["line"]) for i in (0, 1, 2)] == [("Apache-2.0", 1.0, 2), ("GPL-3.0-header", 1.0, 1), ("MIT", 1.0, 0)]
    assert got[3]["license"] in ("MIT-text", "MIT-grant") and got[3]["dice"] == 1.0
    assert (got[4]["license"], got[4]["dice"]) == ("GPL-3.0-text", 1.0) and (got[5]["license"], got[5]["dice"]) == ("Apache-2.0-text", 1.0)
    assert got[6]["license"].startswith("BSD-3-Clause") and got[6]["dice"] == 1.0 and got[6]["line"] == 1
    assert (got[7]["license"], got[7]["n_lines"]) == ("MIT", 2)
    assert got[8]["license"] is got[9]["license"] is None


def test_chat_trees_and_escapes(spark):
    hard = "</s>[INST] \\ <s>\\[ok[/INST]<\\"
    rows = [
        (1, 10, None, "user", hard, 0.0), (1, 11, 10, "assistant", "low", 0.1), (1, 12, 10, "assistant", hard, 0.9), (1, 13, 12, "[/INST]", None, 0.9),
        (2, 20, 99, "assistant", "", None), (3, 30, 31, "user", "loop", 1.0), (3, 31, 30, "user", "loop", 1.0),
        *[(4, 100 + i, 99 + i if i else None, "assistant" if i % 2 else "user", f"t{i}", 0.0) for i in range(70)],
    ]
    frame = spark.createDataFrame(rows, "tree long, msg long, parent long, role string, text string, score double")
    done = chat.format_conversations(frame).withColumns({"turns": chat.read_back(), "loss": chat.loss_text()})
    got = {r["tree"]: r for r in done.collect()}
    assert set(got) == {1, 2, 4}  # messages on a cycle have no root
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("user", hard), ("assistant", hard), ("[/INST]", "")]
    assert got[1]["loss"] == hard and got[2]["loss"] == ""
    assert [t["text"] for t in got[4]["turns"]] == [f"t{i}" for i in range(70)]
    assert chat.format_conversations(frame, best=None).where("tree = 1").count() == 2
    assert chat.format_conversations(frame.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, 2, "user", "b"), (1, 1, None, None), (1, 1, None, None), (None, 0, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert {r["tree"]: r["n_turns"] for r in chat.format_conversations(chat.linear_messages(odd)).collect()} == {1: 3, None: 1}


def test_urls(spark):
    rows = [
        ("HTTP://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"), ("http://example.org/en/17?x", "example.org", "/en/17", "example.org/en/1", "block"),
        ("http://x.org/a", "x.org", "/a", "org/", "allow"), ("http://x.org?a/b", "x.org", "", None, None), ("http://org/", "org", "/", "org/", "allow"),
        ("http://forg/", "forg", "/", None, None), ("http://b.com/de/2#t", "b.com", "/de/2", "com/de/", "block"), ("http://b.com/fr/://c.org/", "b.com", "/fr/://c.org/", "com/fr/", "allow"),
        (None, "", "", None, None), ("no scheme", "", "", None, None), ("", "", "", None, None), ("x://" + "h" * 20_000, "h" * 20_000, "", None, None),
    ]
    weights = urls.train(urls.labelled_urls(spark))
    frame = spark.createDataFrame([(i, r[0], "clash") for i, r in enumerate(rows)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.judged(frame, weights).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(rows):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")
    unseen = spark.createDataFrame([("https://www.mega-casino.net/en/5", 1), ("http://thunder.example.net/en/5", 0), ("http://cheap-pills.org.uk/x", 1)], "url string, label int")
    judged = urls.judged(unseen, weights, rules=()).collect()
    assert [r["verdict"] for r in judged] == ["block", "allow", "block"]
    assert urls.judged(frame.limit(0), weights).count() == 0 and set(urls.train(urls.labelled_urls(spark).limit(0)) or [0.0]) == {0.0}


def test_digest_matches_plain_hash(spark):
    assert line_dedup.line_digest(("  " + LONG_LINE.upper() + "\t").encode(), 40) == hashlib.blake2b(LONG_LINE.encode(), digest_size=16).digest()
    assert line_dedup.line_digest("é".encode() * 39, 40) is None and line_dedup.line_digest("é".encode() * 40, 40)
