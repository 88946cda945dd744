"""SimHash groups, Merkle proofs and whitening against brute force, and on awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

from hearthmill.llm import merkle, simhash, whitening
from hearthmill.llm.spectrum import Spectrum, rank_one

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, at long, component string"


def passage(seed, n, words=500):
    rng = random.Random(seed)
    return " ".join(f"word{rng.randrange(words)}" for _ in range(n))


def changed(text, seed, times):
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def docs(spark):
    """Null ids, texts and sources, empty and very long texts, repeated rows, near copies, clashing columns."""
    base = passage(1, 150)
    rows = [
        (1, base, "a"), (2, base, "a"), (3, base.upper(), None), (4, None, "b"), (5, "", "b"), (6, " \n\t\x0b ", ""), (None, base, "a"), (None, None, None),
        (7, "one Two", "a"), (8, passage(2, 60_000), "c"), (8, passage(2, 60_000), "c"), (8, passage(3, 50), "c"), (9, "one", "é"), (10, "ÉCOLE ß \U0001f600 É", "z"),
        *[(100 + i, changed(base, i, 1 + i % 3), "a") for i in range(150)], *[(300 + i, passage(1000 + i, 30).title(), "a" if i % 3 else "d") for i in range(120)],
    ]
    return spark.createDataFrame([(i, t, None if i == 7 else "en", s, i, 5, 6, "clash") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def plain_fingerprint(text, gram=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + gram]), 42) for i in range(max(len(words) - gram + 1, 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(rows, distance):
    """For each row the smallest id reached; rows are (id, fingerprint)."""
    marks = sorted({f for _, f in rows})
    parent = {f: f for f in marks}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(marks):
        for b in marks[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    first = {}
    for i, f in rows:
        if i is not None:
            first[root(f)] = min(i, first.get(root(f), i))
    return [(i, f, first.get(root(f))) for i, f in rows]


def found_groups(result):
    assert result.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted(((r[0], r[1] % 2**64, r[2]) for r in result.collect()), key=repr)


@pytest.mark.parametrize("scheme", [None, simhash.SCHEMES[1][1]])
@pytest.mark.parametrize("distance", [4, 2])
def test_simhash_groups_against_brute_force(docs, scheme, distance):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    want = sorted(plain_groups(rows, distance), key=repr)
    assert found_groups(simhash.near_duplicates(docs, distance=distance, scheme=scheme)) == want


def test_radii_leave_no_pair_out():
    for _, scheme in simhash.SCHEMES:
        assert sum(width for width, _ in scheme) == 64
        assert sum(radius + 1 for _, radius in scheme) > simhash.DISTANCE


def test_crowded_keys_are_linked_exactly(spark, monkeypatch):
    """Fingerprints around one centre, most of them linked only through others."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(2**63))
    marks = [centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(1500)]
    rows = [(int(i), int(np.uint64(m).astype(np.int64))) for i, m in enumerate(marks)]
    table = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, gram: docs)
    want = sorted(plain_groups([(i, m % 2**64) for i, m in rows], 4), key=repr)
    assert found_groups(simhash.near_duplicates(table)) == want


def test_simhash_of_an_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == 0


def plain_manifest(rows):
    """Leaves, roots and proofs by one loop over the whole table."""
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = str.maketrans({c: c + 32 for c in range(65, 91)})

    def leaf(r, text):
        return sha("".join(map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))

    def tree(digests):
        """The last node, and for every place the siblings on each level."""
        paths, at = [[] for _ in digests], list(range(len(digests)))
        while len(digests) > 1:
            for i, place in enumerate(at):
                run, own = place // 16 * 16, place
                paths[i].append((digests[run:own], digests[own + 1 : run + 16]))
                at[i] = place // 16
            digests = [sha("".join(digests[i : i + 16])) for i in range(0, len(digests), 16)]
        return digests[0], paths

    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    parts = []
    for source in sources:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        parts.append((own, *tree([leaf(r, r["text"]) for r in own])))
    if not parts:
        return []
    root, upper = tree([subroot for _, subroot, _ in parts])
    found = []
    for (own, subroot, paths), above in zip(parts, upper):
        for r, path in zip(own, paths):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and text:
                text = text.translate(lower)
            folded = leaf(r, text)
            for left, right in path + above:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join(d for left, right in path + above for d in [*left, *right]))
            found.append((r["doc_id"], leaf(r, r["text"]), subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_against_one_loop(docs, levels):
    got = merkle.manifest(docs, levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = plain_manifest(docs.collect())
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {row[-1] for row in want} == {True, False}


def test_manifest_with_many_sources_and_one_leaf_each(spark):
    rows = [(i, f"Text {i}", "en", f"s{i % 300}", i) for i in range(320)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, merkle.manifest(docs).collect()), key=repr) == plain_manifest(docs.collect())
    single = docs.limit(1)
    assert sorted(map(tuple, merkle.manifest(single).collect()), key=repr) == plain_manifest(single.collect())


def test_equal_rows_spread_over_ranges(spark):
    """A third of all rows is one row; places stay unbroken and every proof folds to the root."""
    rows = [(7, "same", "en", "hot", 4)] * 600 + [(i, f"text {i}", "en", f"s{i % 3}", 6) for i in range(100, 1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    got = merkle.manifest(docs)
    assert got.filter("verified").count() == 1800
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(docs.collect())


def test_manifest_needs_no_python_workers(docs):
    """Beside a scan of texts, idle Python workers would share the executor's memory."""
    plan = merkle.manifest(docs)._jdf.queryExecution().toString()
    assert "InPandas" not in plan and "InArrow" not in plan and "EvalPython" not in plan


def test_manifest_keeps_large_ids_beside_a_null(spark):
    rows = [(2**60 + 1, "a", "en", "s", 1), (None, "B", "en", "s", 1), (2**60 + 3, "C", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, merkle.manifest(docs).collect()), key=repr) == plain_manifest(docs.collect())


def test_manifest_of_an_empty_table(empty):
    assert merkle.manifest(empty).count() == 0


def test_rank_one_updates_against_full_decomposition():
    rng = np.random.default_rng(1)
    for dim in (1, 2, 9, 40):
        values, vectors, whole = np.zeros(dim), np.eye(dim), np.zeros((dim, dim))
        for step in range(3 * dim):
            v = rng.normal(size=dim) * 10.0 ** rng.integers(-3, 4) if step % 5 else np.eye(dim)[step % dim]
            values, vectors = rank_one(values, vectors, v, 0.7)
            whole += 0.7 * np.outer(v, v)
            scale = np.abs(whole).max()
            assert np.abs(vectors * values @ vectors.T - whole).max() < 1e-12 * scale
            assert np.abs(vectors.T @ vectors - np.eye(dim)).max() < 1e-12
            assert (np.diff(values) >= 0).all()


def test_merged_spectra_equal_one_spectrum():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(0, 300, (400, 12)) * np.linspace(0.1, 2, 12)) + 100_000
    x[:50] = x[0]
    parts = [Spectrum(12) for _ in range(3)]
    for own, rows in zip(parts, (x[:50], x[50:51], x[51:])):
        for row in rows:
            own.add(row)
    for other in parts[1:]:
        parts[0].merge(other)
    whole = (x - x.mean(0)).T @ (x - x.mean(0))
    assert np.abs(parts[0].vectors * parts[0].values @ parts[0].vectors.T - whole).max() < 1e-9 * np.abs(whole).max()
    assert np.allclose(parts[0].mean, x.mean(0), rtol=1e-14)


VECTORS = "vec_id long, embedding array<float>, label int, n long, part long, e string"


def vector_rows(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, 2, "clash") for i, v in vectors], VECTORS)


def plain_whitening(vectors):
    usable = [(i, v) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in usable])
    n, sums = len(x), x.sum(axis=0)
    away = x - sums / n
    values, axes = np.linalg.eigh(away.T @ away / n)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return [i for i, _ in usable], n, deviation, values[::-1], away @ axes[:, ::-1]


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_whitening_against_full_decomposition(spark, parts):
    rng = np.random.default_rng(5)
    vectors = [(i, (rng.normal(size=12) * np.linspace(0.05, 1.5, 12)).tolist()) for i in range(300)]
    vectors += [(500 + i, vectors[3][1]) for i in range(150)]
    vectors += [(None, vectors[4][1]), (4, vectors[5][1]), (900, None), (901, [None] + [0.5] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.1] * 11)]
    ids, n, deviation, values, projected = plain_whitening(vectors)
    got = whitening.whitened(vector_rows(spark, vectors).repartition(parts)).toPandas()
    assert len(got) == 8 * n and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    order = lambda pairs: sorted(pairs, key=repr)
    name = lambda i: None if i is None or np.isnan(i) else int(i)
    for k in range(8):
        own = got[got["component"] == k + 1]
        assert np.allclose(own["explained"], values[k] / values.sum(), rtol=1e-9)
        assert order((name(i), int(d)) for i, d in zip(own["vec_id"], own["deviation"])) == order(zip(ids, deviation))
        want = projected[:, k] / np.sqrt(values[k])
        key = dict(zip(ids, want))
        mine = np.array([key[name(i)] if name(i) != 4 else np.nan for i in own["vec_id"]])
        known = ~np.isnan(mine)
        sign = np.sign(np.nansum(mine * own["whitened"].to_numpy()))
        assert np.allclose(sign * mine[known], own["whitened"].to_numpy()[known], atol=1e-9)


def test_whitening_of_awkward_tables(spark):
    one = [0.5, 0.25, -1.0]
    columns = [field.split()[0] for field in whitening.RESULT.split(", ")]
    for vectors in ([], [(1, None)], [(1, one)], [(1, one), (2, one)], [(1, []), (2, [])]):
        got = whitening.whitened(vector_rows(spark, vectors))
        assert got.columns == columns and got.count() == 0
    # Fewer components than asked; vectors of a rarer length take no part.
    flat = whitening.whitened(vector_rows(spark, [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [4.0, 0.0]), (4, [1.0]), (5, [1.0] * 3)])).collect()
    assert {(r["vec_id"], r["component"], r["n"]) for r in flat} == {(1, 1, 3), (2, 1, 3), (3, 1, 3)}
    assert all(abs(r["explained"] - 1) < 1e-12 for r in flat)


def test_deviations_beyond_64_bits():
    x = np.array([[10**9, -(10**9)], [5, 5]], np.int64)
    n, sums = 10**9, np.array([10**18, 3], np.int64)
    want = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    assert [int(v.as_py()) for v in whitening.deviations(x, n, sums)] == want
