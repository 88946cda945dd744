"""Near duplicates by a chosen-path set similarity join.

A document is the set of its word shingles, seen through ``WIDTH`` minwise
tokens. In each tree a node picks one or two of the token places (1.25
on average, the inverse of the similarity); a document goes to the child
named by its token there, so two documents of similarity 0.8 are expected to
share one child of each node they share. Small nodes are compared
exhaustively. A large node links its members to one pivot and branches on. Trees
are independent, so their misses multiply.

Equal sets are one class from the start, and candidate pairs are confirmed
on full sets. Large nodes that are left at the greatest depth are settled
exactly: if their members do not yet belong to one component, those outside
the largest component are joined with the others by their rarest shingles,
first to link each with its nearest, then to link what is still apart. Odd
sketches of the sets bound how many shingles differ, so that few pairs which
turn out not to be similar reach the comparison of full sets.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.llm.common import chunks, known, mixed, random_words, word_run_hashes
from hearthmill.sources.shared import few, settle

WIDTH = 48
TREES = 10
SMALL = 24
DEPTH = 4
PLACES = 1 << 18  # hash places in which the shingles of left-over sets are counted
STRETCH = 1 << 12  # places whose counts travel in one row
HEAD = 16  # rarest shingles by which a pair is known to have met before
SKETCH = 16  # 64-bit words of a set's sketch
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


@cache
def _minwise() -> tuple[np.ndarray, np.ndarray]:
    return random_words(21, WIDTH) | np.uint64(1), random_words(22, WIDTH)


@cache
def _byte_stand_ins() -> np.ndarray:
    return random_words(23, 256)


def shingle_sets(texts: list[str | None], gram: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    Words are runs without ASCII blanks, A-Z lower-cased. A text of fewer
    words than ``gram`` is one shingle; without words the set is empty.
    """
    bodies = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    raw = np.frombuffer(b"\n".join([*bodies, b""]), np.uint8)
    blank = BLANK[raw]
    before = np.concatenate(([True], blank[:-1]))
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    word = word_run_hashes(raw, _byte_stand_ins(), starts, ends)
    doc_ends = np.cumsum([len(b) + 1 for b in bodies])
    bounds = np.concatenate(([0], np.searchsorted(starts, doc_ends)))
    factors = random_words(24, gram) | np.uint64(1)
    n = len(word)
    joined = np.zeros(n, np.uint64)
    for k in range(min(gram, n)):
        joined[: n - k] += mixed(word[k:] ^ factors[k]) * factors[k]
    joined = mixed(joined)
    sets = []
    for first, last in zip(bounds[:-1], bounds[1:]):
        if last - first >= gram:
            sets.append(np.unique(joined[first : last - gram + 1]))
        elif last > first:
            own = np.array([last - first], np.uint64)
            for k in range(last - first):
                own += mixed(word[first + k : first + k + 1] ^ factors[k]) * factors[k]
            sets.append(mixed(own))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minwise_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """WIDTH minwise tokens per set; sets are not empty."""
    factors, offsets = _minwise()
    sizes = np.array([len(s) for s in sets])
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    values = np.concatenate(sets)
    tokens = np.empty((len(sets), WIDTH), np.uint64)
    for k in range(WIDTH):
        tokens[:, k] = np.minimum.reduceat(values * factors[k] + offsets[k], firsts)
    return tokens.view(np.int64)


def _signatures(gram: int):
    @F.pandas_udf("n long, digest binary, tokens array<long>, sketch array<long>")
    def signature(series: pd.Series) -> pd.DataFrame:
        texts = list(series)
        sizes, digests, tokens, sketches = [], [], [], []
        for part in chunks(texts):
            sets = shingle_sets(texts[part], gram)
            full = [s for s in sets if len(s)]
            found = iter(minwise_tokens(full)) if full else iter(())
            for s in sets:
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                tokens.append(next(found) if len(s) else np.zeros(0, np.int64))
                sketches.append(odd_sketch(s))
        return pd.DataFrame({"n": sizes, "digest": digests, "tokens": tokens, "sketch": sketches})

    return signature.asNondeterministic()


def _children(tree_path: str, tokens: str) -> Column:
    """Child nodes of a document: one place, or two in a quarter of the nodes."""
    child = lambda k: f"xxhash64({tree_path}, get({tokens}, cast(pmod(xxhash64({tree_path}, {k}), {WIDTH}) as int)))"
    return F.expr(f"if(pmod(xxhash64({tree_path}, 3), 4) = 0, array_distinct(array({child(1)}, {child(2)})), array({child(1)}))")


def _similar_sizes(a: str, b: str) -> str:
    """What a similarity of 0.8 leaves open by the sizes of the sets."""
    return f"100 * least({a}, {b}) >= 80 * greatest({a}, {b})"


def candidate_pairs(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a < b) of class ids, and the members of large nodes left at the end.

    ``classes`` has id, n and tokens and is a written table.
    """
    trees = F.explode(F.array(*[F.lit(int(x)) for x in random_words(25, TREES).view(np.int64)]))
    nodes = classes.select("id", "n", "tokens", trees.alias("root")).select("id", "n", F.explode(_children("root", "tokens")).alias("node"))
    found, left = [], None
    rows = TREES * classes.count()  # places in nodes, about as many at each depth at most
    for depth in range(DEPTH):
        nodes = settle(nodes, f"nodes-{depth}", rows)
        # Counted ahead of any gathering: a node may hold most documents.
        sizes = settle(nodes.groupBy("node").agg(F.count("*").alias("members")).filter("members > 1"), f"sizes-{depth}", rows)
        shared = settle(nodes.join(sizes, "node"), f"shared-{depth}")
        groups = shared.filter(F.col("members") <= SMALL).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("m"))
        pairs = few(groups, rows).select(
            F.explode(
                F.expr(
                    "flatten(transform(m, (x, i) -> transform(filter(slice(m, i + 2, size(m)), y -> "
                    f"{_similar_sizes('x.n', 'y.n')}), y -> struct(x.id as a, y.id as b))))"
                )
            ).alias("p")
        ).select("p.a", "p.b")
        large = shared.filter(F.col("members") > SMALL).select("node", "id", "n")
        pivots = large.groupBy("node").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n")).alias("p"))
        pivots = few(pivots, rows).selectExpr("node", "p.id as pivot", "p.n as pivot_n")
        stars = large.join(pivots, "node").filter(f"id <> pivot and {_similar_sizes('n', 'pivot_n')}")
        stars = stars.selectExpr("least(id, pivot) as a", "greatest(id, pivot) as b")
        found.append(settle(pairs.union(stars).distinct(), f"candidates-{depth}", rows))
        left = large
        if large.isEmpty():
            break
        if depth + 1 < DEPTH:
            nodes = large.join(classes.select("id", "tokens"), "id").select("id", "n", F.explode(_children("node", "tokens")).alias("node"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return settle(every.distinct(), "pairs", rows), left


def _words(sketch: str, side: str) -> list[Column]:
    return [F.get(sketch, F.lit(k)).alias(f"{side}{k}") for k in range(SKETCH)]


def _apart() -> Column:
    """In how many bits two sketches differ, given as columns a0, a1, ... and b0, b1, ..."""
    return F.expr(" + ".join(f"bit_count(a{k} ^ b{k})" for k in range(SKETCH)))


def _like(apart: Column, percent: int) -> Column:
    """What a similarity of ``percent`` of sets of an and bn shingles leaves open by the bits that differ."""
    return (100 + percent) * apart <= (100 - percent) * (F.col("an") + F.col("bn"))


def close_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidates that share at least half of their minwise tokens and whose sketches are not too far apart.

    At similarity 0.8 fewer than half of 48 has a chance below one in a million.
    """
    own = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"{x}n"), F.col("tokens").alias(f"t{x}"), *_words("sketch", x))
    agreed = F.aggregate(F.zip_with("ta", "tb", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    both = pairs.join(own("a"), "a").join(own("b"), "b")
    close = both.filter((agreed >= WIDTH // 2) & _like(_apart(), percent))
    return settle(close.select("a", "b"), "close-pairs")


def full_sets(ids: DataFrame, classes: DataFrame, source: DataFrame, gram: int) -> DataFrame:
    """(id, s): the shingle sets of some classes, made again from one text of each."""
    needed = settle(ids.join(classes.select("id", "row.*"), "id").toDF("class", "rid", "rhash"), "needed-classes", classes.count())

    @F.pandas_udf("array<long>")
    def full_set(series: pd.Series) -> pd.Series:
        bodies = list(series)
        return pd.Series([s.view(np.int64) for part in chunks(bodies) for s in shingle_sets(bodies[part], gram)])

    # Many classes are needed at any size, so the join is planned alike at every size.
    texts = source.join(needed.hint("merge"), (F.col("id") == F.col("rid")) & (F.col("text_hash") == F.col("rhash")))
    sets = texts.select(F.col("class").alias("id"), full_set.asNondeterministic()("text").alias("s"))
    return settle(sets.dropDuplicates(["id"]), "full-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    alike = 100 * common >= percent * (F.size("sa") + F.size("sb") - common)
    return settle(both.filter(alike).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of a link: the smallest id it reaches.

    Edges run from a larger id to a smaller one. In turn every id's larger
    neighbours, then its smaller ones, are hung on its smallest neighbour.
    Edges never grow in number, and those of a dense group fall together in
    the first round, until each id has one edge, to the smallest id of all.
    """
    rows = links.count()
    edges = settle(links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).filter("x <> y").distinct(), "edges", rows)
    while True:
        ends = edges.select("x", F.lit(1).alias("up"), F.lit(0).alias("root")).union(edges.select("y", F.lit(0), F.lit(1)))
        ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
        if ends.filter("up > 1 or (up = 1 and root = 1)").isEmpty():
            return edges.selectExpr("x as id", "y as component").union(edges.selectExpr("y", "y").distinct())
        least = edges.union(edges.select("y", "x")).groupBy("x").agg(F.min("y").alias("m"))
        hung = edges.join(least.toDF("y", "m"), "y").select("x", F.least("y", "m").alias("y"))
        hung = settle(hung.distinct(), "edges", rows)
        least = hung.groupBy("x").agg(F.min("y").alias("m"))
        below = hung.join(least, "x").filter("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        edges = settle(below.union(least.toDF("x", "y")).distinct(), "edges", rows)


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The ``labels`` of ``components`` with further links: each id hangs on its component, so the first links are not gone through again."""
    return components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).union(links))


def _shingle_counts(members: DataFrame) -> np.ndarray:
    """How many shingles of all sets ``s`` fall into each of the ``PLACES`` hash places.

    Each task counts its own sets and sends one row per stretch of places, so
    the rows shuffled depend on the number of tasks, not on the shingles.
    """

    def counted(batches):
        seen = np.zeros(PLACES, np.int64)
        for batch in batches:
            for tokens in batch["s"]:
                np.add.at(seen, tokens % PLACES, 1)
        at = np.flatnonzero(seen)
        cuts = np.searchsorted(at, np.arange(STRETCH, PLACES, STRETCH))
        yield pd.DataFrame({"stretch": np.arange(PLACES // STRETCH), "at": np.split(at, cuts), "n": np.split(seen[at], cuts)})

    def summed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(STRETCH, np.int64)
        np.add.at(seen, np.concatenate(list(rows["at"])) % STRETCH, np.concatenate(list(rows["n"])))
        return pd.DataFrame({"stretch": [key[0]], "seen": [seen]})

    found = members.select("s").mapInPandas(counted, "stretch long, at array<long>, n array<long>")
    totals = found.groupBy("stretch").applyInPandas(summed, "stretch long, seen array<long>").toPandas()
    return np.concatenate(list(totals.sort_values("stretch")["seen"])) if len(totals) else np.zeros(PLACES, np.int64)


def odd_sketch(tokens: np.ndarray) -> np.ndarray:
    """``SKETCH`` words of bits, each bit the parity of how many shingles fall to it.

    Bits of two sketches that differ are no more than the shingles in which
    the two sets differ.
    """
    parity = np.bincount((tokens.astype(np.int64).view(np.uint64) >> np.uint64(48)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(parity.astype(bool), bitorder="little").view("<i8")


def _rarest_prefix(members: DataFrame, percent: int) -> Column:
    """The rarest shingles of a set ``s``, as many as a similarity of ``percent`` lets differ and one more.

    Rarity is the count of a shingle's hash place over all left-over sets;
    equal counts go by shingle. Any order of shingles that is the same for all
    sets finds every pair. The counts have a fixed size, whatever the input.
    """
    shared = members.sparkSession.sparkContext.broadcast(_shingle_counts(members))

    @F.pandas_udf("array<long>")
    def prefix(sets: pd.Series) -> pd.Series:
        rarest = []
        for tokens in sets:
            kept = len(tokens) - -(-percent * len(tokens) // 100) + 1
            rarest.append(tokens[np.lexsort((tokens, shared.value[tokens % PLACES]))[:kept]])
        return pd.Series(rarest, dtype=object)

    return prefix.asNondeterministic()("s")


def open_members(left: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(id, component, outside) of the members of left nodes that do not all share a component.

    ``outside`` tells members that lie outside the largest component of one of these nodes.
    ``rows`` is the most rows that ``left`` can have, about.
    """
    named = left.join(labels, "id", "left").select("node", "id", F.coalesce("component", "id").alias("component"))
    named = settle(named, "left-over", rows)
    parts = named.groupBy("node", "component").agg(F.count("*").alias("k"))
    main = parts.groupBy("node").agg(F.max(F.struct("k", "component")).alias("main"), F.count("*").alias("parts"))
    open_nodes = settle(main.filter("parts > 1").selectExpr("node", "main.component as main"), "open-nodes", rows)
    members = named.join(open_nodes, "node").groupBy("id").agg(F.first("component").alias("component"), F.max(F.expr("component <> main")).alias("outside"))
    return settle(members, "open-members", rows)


def left_over_prefixes(members: DataFrame, sets: DataFrame, classes: DataFrame, percent: int, rows: int) -> DataFrame:
    """Written table of id, n, sketch, head and tokens: the rarest shingles of members, and the first of them."""
    whole = settle(members.select("id").join(sets, "id"), "open-sets")
    prefix = whole.select("id", _rarest_prefix(whole, percent).alias("tokens"))
    prefix = prefix.join(classes.select("id", "n", "sketch"), "id")
    return settle(prefix.select("id", "n", "sketch", F.slice("tokens", 1, HEAD).alias("head"), "tokens"), "prefixes", rows)


def left_over_pairs(members: DataFrame, prefixes: DataFrame, percent: int, rows: int) -> DataFrame:
    """Pairs (a, b, apart) still open between members of different components, found exactly.

    Members outside a node's largest component are joined with all members by
    prefix: a similar pair shares one of the rarest shingles of either, as
    many as a similarity of ``percent`` lets differ, and one more. From the
    first shared shingle on, both must be long enough for the overlap asked,
    and the sketches must not differ in more shingles than the similarity lets.
    A pair that meets again at a later shingle is left out there if one of the
    ``HEAD`` rarest of both tells so. ``apart`` counts the sketches' bits that differ.
    """
    prefix = settle(members.join(prefixes, "id"), "open-prefixes", rows)
    # The rarest shingles are mostly a set's own: only those that can meet another get the rest of their row.
    met = prefix.select("outside", F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("k"), F.max("outside").alias("o"))
    met = settle(met.filter("k > 1 and o").select("token"), "shared-shingles", rows)
    places = settle(prefix.select("id", F.posexplode("tokens").alias("place", "token")).join(met, "token"), "shared-places")
    prefix = places.join(prefix.drop("tokens"), "id")
    side = lambda x: [F.expr(e) for e in ("token", f"id as {x}", f"n - place as {x}r", f"n as {x}n", f"component as {x}c", f"slice(head, 1, least(place, {HEAD})) as {x}h")]
    both = prefix.filter("outside").select(*side("a"), *_words("sketch", "a")).join(prefix.select(*side("b"), *_words("sketch", "b")), "token")
    enough = F.expr(f"ac <> bc and least(ar, br) * (100 + {percent}) >= {percent} * (an + bn)")
    both = both.filter(enough & _like(_apart(), percent) & F.expr("not arrays_overlap(ah, bh)"))
    return both.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), _apart().alias("apart")).toDF("a", "b", "apart").distinct()


def nearest_pairs(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b, apart) those that are the nearest of one of their ids."""
    own = F.explode(F.array("a", "b")).alias("id")
    nearest = pairs.select(own, F.struct("apart", "a", "b").alias("p")).groupBy("id").agg(F.min("p").alias("p"))
    return nearest.select("p.a", "p.b").distinct()


def with_left_over(links: DataFrame, left: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Components of the links and of those still open in the large nodes that are left.

    A node whose members share a component has nothing to add. In the others
    each member is first linked with its nearest, so that a group of many
    links falls together without making them all; the few members that are
    still apart then get all their pairs.
    """
    rows = TREES * classes.count()
    labels = components(links)
    members = open_members(left, labels, rows)
    if members.isEmpty():
        return labels
    prefixes = left_over_prefixes(members, sets, classes, percent, rows)
    late = settle(nearest_pairs(left_over_pairs(members, prefixes, percent, rows)), "nearest-pairs", rows)
    if late.isEmpty():
        return labels
    labels = joined_components(labels, confirmed(late, sets, percent))
    late = settle(left_over_pairs(open_members(left, labels, rows), prefixes, percent, rows).select("a", "b"), "late-pairs", rows)
    return labels if late.isEmpty() else joined_components(labels, confirmed(late, sets, percent))


def near_duplicates(docs: DataFrame, gram: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, n_shingles, component_id, component.

    ``component_id`` is the smallest doc_id reached over links of similarity
    ``percent`` or more, ``component`` a digest naming the group. Null or
    blank texts have the empty set, link with nothing and have no
    ``component``. Rows that repeat are linked by their equal sets. A row is
    judged by its own text, also where rows share a doc_id. Null doc_ids are
    larger than any other: a group without ids has a null component_id.
    Empty tables give no rows.
    """
    source = docs.select("doc_id", known("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    signed = source.select("doc_id", "id", "text_hash", _signatures(gram)("text").alias("s"))
    signed = settle(signed.select("doc_id", "id", "text_hash", "s.*"), "signatures")
    classes = signed.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("id", "text_hash")).alias("row"),
        F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"),
    )
    classes = settle(classes.withColumnRenamed("digest", "id"), "classes")
    pairs, left = candidate_pairs(classes.select("id", "n", "tokens"))
    close = close_pairs(pairs, classes, percent)
    wanted = close.select(F.explode(F.array("a", "b")).alias("id")).union(left.select("id")).distinct()
    sets = full_sets(wanted, classes, source, gram)
    links = confirmed(close, sets, percent)
    labels = with_left_over(links, left, sets, classes, percent)
    grouped = classes.select("id", "first").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    grouped = settle(grouped, "class-components", classes.count())
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = settle(grouped.join(smallest, "component").select(F.col("id").alias("digest"), "component", "component_id"), "named-classes")
    result = signed.withColumn("d", F.when(F.col("n") > 0, F.col("digest"))).drop("digest")
    result = result.join(named, F.col("d") == F.col("digest"), "left")
    return result.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("d").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "component",
    )


def drop_near_duplicates(docs: DataFrame, gram: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, that of the smallest doc_id; same columns.

    Documents without words stay. Of rows that repeat, and of groups without
    any doc_id, one row stays.
    """
    found = settle(near_duplicates(docs, gram, percent), "near-duplicates")
    stays = found.filter("component is null or doc_id <=> component_id")
    stays = stays.select(known("doc_id").alias("__id"), F.coalesce("text_hash", F.lit(0)).alias("__hash"), F.col("component").alias("__component"))
    twice = stays.filter("__component is not null").groupBy("__component").agg(F.count("*").alias("__rows"))
    twice = settle(twice.filter("__rows > 1").select(F.col("__component").alias("__twice")), "repeated-rows")
    marked = docs.withColumn("__doc", known("doc_id")).withColumn("__own", F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0)))
    kept = marked.join(stays.distinct(), (F.col("__doc") == F.col("__id")) & (F.col("__own") == F.col("__hash")))
    if not twice.isEmpty():
        kept = kept.join(twice, F.col("__component") == F.col("__twice"), "left")
        once = kept.filter("__twice is null").select(*docs.columns)
        again = kept.filter("__twice is not null").dropDuplicates(["__component"])
        return once.union(again.select(*docs.columns))
    return kept.select(*docs.columns)
