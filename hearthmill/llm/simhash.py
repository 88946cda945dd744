"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint is cut into segments. If two differ in at most ``DISTANCE``
bits, the bits cannot be spread so that every segment exceeds its own radius
(the radii plus one add up to more than ``DISTANCE``). Every fingerprint enters
a table under each of its segments, and looks there for all values in the
Hamming ball of its segment's radius; whole distances are verified. Of two
segments that differ only the smaller looks for the other, so a pair meets once.

A group of near copies fills a few table keys with fingerprints that all link
to each other. To link them without making their pairs, whatever meets at a
key is first compared with a few pivots of that key. Only keys at which
unconnected fingerprints still meet are searched in full, and there those of
the key's largest component are not compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.llm.near_dedup import components
from hearthmill.sources.shared import settle

GRAM = 4
SEED = 42
DISTANCE = 4
PIVOTS = 4
CHUNK = 200_000  # shingles whose bits are counted at once
# Segment widths and radii, by the number of fingerprints they are good for: a
# key should hold few fingerprints, and longer segments need larger balls.
SCHEMES = ((1 << 24, ((21, 1), (21, 1), (22, 0))), (1 << 63, ((32, 2), (32, 1))))


def bit_counts(body: bytes, gram: int) -> tuple[np.ndarray, int]:
    """How many shingles of a text have each bit of their hash set, and how many shingles there are."""
    words = body.lower().split()
    if not words:
        return np.zeros(64, np.int64), 0
    joined = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: max(len(words) - gram + 1, 1)], ends[min(gram, len(words)) - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts, len(starts)


def fingerprints(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """(doc_id, fingerprint long) of each row; a null text, or one without words, has fingerprint 0."""

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, 64), bool)
            for i, body in enumerate(batch.column(1)):
                counts, n = bit_counts(body.as_py() or b"", gram)
                found[i] = 2 * counts > n
            marks = np.packbits(found, axis=1, bitorder="little").view("<i8").ravel()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], names=["doc_id", "fingerprint"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return own.mapInArrow(fingerprint, "doc_id long, fingerprint long")


def ball(width: int, radius: int) -> list[int]:
    """What to flip in a segment to reach every value at distance 0 to radius."""
    return [sum(1 << bit for bit in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _segment_keys(number: int, shift: int, width: int, radius: int) -> Column:
    """Keys of one segment of a fingerprint ``id``: the larger values of its ball, and its own."""
    own = F.shiftrightunsigned("id", shift).bitwiseAND((1 << width) - 1)
    looked = F.transform(F.array(*[F.lit(flip).cast("long") for flip in ball(width, radius)]), lambda flip: own.bitwiseXOR(flip))
    larger = F.filter(looked, lambda value: value > own)
    key = lambda value, its_own: F.struct((value + F.lit(number << 40)).alias("key"), F.lit(its_own).alias("own"))
    return F.concat(F.transform(larger, lambda value: key(value, False)), F.array(key(own, True)))


def _keys(scheme: tuple[tuple[int, int], ...]) -> Column:
    shifts = np.cumsum([0, *[width for width, _ in scheme]]).tolist()
    return F.concat(*[_segment_keys(number, shifts[number], width, radius) for number, (width, radius) in enumerate(scheme)])


def _entries(named: DataFrame, scheme: tuple[tuple[int, int], ...]) -> DataFrame:
    return named.select("*", F.explode(_keys(scheme)).alias("k")).select(*named.columns, "k.key", "k.own")


def pivot_links(classes: DataFrame, scheme: tuple[tuple[int, int], ...], distance: int) -> DataFrame:
    """Links (a, b) of whatever meets at a key with some of the fingerprints in the table there."""
    entries = _entries(classes.select("id"), scheme)
    names = [f"pivot{k}" for k in range(PIVOTS)]
    pivots = entries.filter("own").groupBy("key").agg(*[F.min_by("id", F.xxhash64("id", F.lit(k))).alias(name) for k, name in enumerate(names)])
    near = F.filter(F.array(*names), lambda pivot: (pivot != F.col("id")) & (F.bit_count(pivot.bitwiseXOR(F.col("id"))) <= distance))
    met = entries.join(pivots, "key").select("id", near.alias("near")).filter(F.size("near") > 0)
    links = met.select("id", F.explode("near").alias("pivot")).select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))
    return settle(links.distinct(), "pivot-links")


def open_links(named: DataFrame, scheme: tuple[tuple[int, int], ...], distance: int) -> DataFrame:
    """Links (a, b) between components that are still apart; ``named`` has id and component.

    Every pair within the distance meets at a key. Keys at which only one
    component meets, or none is in the table, have nothing to add.
    """
    entries = _entries(named.select("id", "component"), scheme)
    parts = entries.groupBy("key", "component").agg(F.count("*").alias("k"), F.max("own").alias("own"))
    keys = parts.groupBy("key").agg(F.max_by("component", "k").alias("main"), F.count("*").alias("parts"), F.max("own").alias("own"))
    keys = settle(keys.filter("parts > 1 and own").select("key", "main"), "open-keys")
    met = settle(entries.join(keys, "key").withColumn("outside", F.expr("component <> main")).drop("main"), "open-entries")
    table = met.filter("own").selectExpr("key", "id as other", "component as theirs", "outside as apart")
    near = (F.col("component") != F.col("theirs")) & (F.bit_count(F.col("id").bitwiseXOR(F.col("other"))) <= distance)
    near = near & (~F.col("own") | (F.col("id") < F.col("other")))
    looked = [
        met.filter(side).alias("l").join(table.filter(other).alias("r"), (F.col("l.key") == F.col("r.key")) & near).select("component", "theirs")
        for side, other in (("outside", "true"), ("not outside", "apart"))
    ]
    links = looked[0].union(looked[1])
    return settle(links.select(F.least("component", "theirs").alias("a"), F.greatest("component", "theirs").alias("b")).distinct(), "open-links")


def near_duplicates(docs: DataFrame, gram: int = GRAM, distance: int = DISTANCE, scheme: tuple[tuple[int, int], ...] | None = None) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (long), component_id.

    ``component_id`` is the smallest doc_id reached over links of at most
    ``distance`` differing bits (at most 4); every link counts, whatever its
    texts. Rows of equal fingerprints are linked, so repeated rows and all
    texts without words are; those without words link with any fingerprint of
    few bits. Null doc_ids are larger than any other: a group without ids has
    a null component_id. Texts of any length are hashed whole. An empty table
    gives no rows. Other columns of docs are not looked at. ``scheme`` sets
    segment widths and radii; by default the number of fingerprints does. It
    decides how much is compared, not what is found.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the segments are made for distances up to {DISTANCE}")
    signed = settle(fingerprints(docs, gram), "fingerprints")
    classes = settle(signed.groupBy(F.col("fingerprint").alias("id")).agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    if scheme is None:
        size = classes.count()
        scheme = next(scheme for most, scheme in SCHEMES if size <= most)
    labels = components(pivot_links(classes, scheme, distance))
    named = classes.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = settle(named, "named-fingerprints")
    late = open_links(named, scheme, distance)
    if not late.isEmpty():
        joined = components(late).toDF("component", "joined")
        named = named.join(joined, "component", "left").withColumn("component", F.coalesce("joined", "component")).drop("joined")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = settle(named.join(smallest, "component").select("id", "component_id"), "fingerprint-components")
    return signed.join(named, F.col("fingerprint") == F.col("id")).select("doc_id", "fingerprint", "component_id")
