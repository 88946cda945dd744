"""Lines that repeat across documents, found through two Bloom filters.

Each long line leaves a 16-byte digest and two bits in one 64-bit word of a
filter. Bits set at all form the once-seen filter, bits set at least twice
the twice-seen filter; both are a distributed table keyed by word, sized from
the amount of text, never an object in one place. Only lines whose bits are
all in the second filter can be repeats; only those meet by digest, where the
documents are counted exactly and the keeper is chosen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthmill.llm.common import known
from hearthmill.sources.shared import settle

BLANKS = b" \t\n\x0b\x0c\r"


def line_digest(line: bytes, least: int) -> bytes | None:
    """Digest of a line's key, or None if the key is shorter than ``least`` code points."""
    key = line.strip(BLANKS)
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def _digests(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = text.as_py()
                found = {line_digest(x, least) for x in body.encode("utf-8", "replace").split(b"\n")} if body else set()
                found.discard(None)
                keys += sorted(found)
                ids += [doc] * len(found)
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                names=["id", "digest", "h1", "h2"],
            )

    return run


def repeated_lines(docs: DataFrame, least: int = 40, documents: int = 5, bits_per_char: float = 0.4) -> DataFrame:
    """(id, digests): the lines that each document loses.

    Lines are compared by key: blanks stripped at both ends, A-Z lower-cased.
    A key of at least ``least`` code points found in at least ``documents``
    documents stays in the largest doc_id holding it. A null doc_id counts as
    one document below all others; rows that share a doc_id are one document.
    """
    rows = docs.select(known("doc_id").alias("id"), F.col("text").cast("string").alias("body"))
    characters = rows.agg(F.sum(F.char_length("body"))).first()[0] or 0
    words = 1 << max(10, int(np.ceil(np.log2(max(1.0, characters * bits_per_char / 64)))))
    lines = settle(rows.mapInArrow(_digests(least), "id long, digest binary, h1 long, h2 long"), "line-digests")
    placed = lines.withColumns(
        {
            "word": F.pmod(F.shiftright("h1", 3), F.lit(words)),
            "bit1": F.col("h2").bitwiseAND(F.lit(63)).cast("int"),
            "bit2": F.shiftright("h2", 6).bitwiseAND(F.lit(63)).cast("int"),
        }
    )
    bits = placed.select("word", F.explode(F.array_distinct(F.array("bit1", "bit2"))).alias("bit"))
    once = bits.groupBy("word", "bit").agg(F.count("*").alias("seen"))
    twice = once.filter("seen >= 2").groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    twice = settle(twice, "twice-seen")
    has = F.expr("bit_get(bits, bit1) = 1 and bit_get(bits, bit2) = 1")
    suspects = settle(placed.join(twice, "word").filter(has).select("id", "digest"), "line-suspects")
    # A digest's documents are counted before its rows meet, so a line in a third of all texts is no hot task.
    counted = suspects.groupBy("digest", "id").agg(F.lit(1).alias("one")).groupBy("digest").agg(
        F.count("*").alias("n"), F.max("id").alias("keeper")
    )
    frequent = settle(counted.filter(F.col("n") >= documents).select("digest", "keeper"), "frequent-lines")
    lost = suspects.join(frequent, "digest").filter("id <> keeper").select("id", "digest").distinct()
    return lost.groupBy("id").agg(F.collect_list("digest").alias("digests"))


def with_lines_dropped(docs: DataFrame, least: int = 40, documents: int = 5) -> DataFrame:
    """docs plus a struct ``__kept`` of text, n_lines and n_dropped.

    A null or empty text is one empty line and comes back as the empty
    string. Losing all lines also gives the empty string. Repeated rows are
    treated alike; other columns pass through untouched, whatever their names.
    """

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def rewrite(bodies: pd.Series, lost: pd.Series) -> pd.DataFrame:
        texts, totals, dropped = [], [], []
        for body, digests in zip(bodies, lost):
            lines = (body or "").split("\n")
            if digests is None or not len(digests):
                kept = lines
            else:
                gone = {bytes(d) for d in digests}
                kept = [x for x in lines if line_digest(x.encode("utf-8", "replace"), least) not in gone]
            texts.append("\n".join(kept))
            totals.append(len(lines))
            dropped.append(len(lines) - len(kept))
        return pd.DataFrame({"text": texts, "n_lines": totals, "n_dropped": dropped})

    lost = repeated_lines(docs, least, documents).toDF("__id", "__digests")
    joined = docs.withColumn("__doc", known("doc_id")).join(lost, F.col("__doc") == F.col("__id"), "left")
    kept = rewrite.asNondeterministic()(F.col("text").cast("string"), F.col("__digests"))
    return joined.withColumn("__kept", kept).drop("__doc", "__id", "__digests")


def drop_repeated_lines(docs: DataFrame, least: int = 40, documents: int = 5) -> DataFrame:
    """The documents with their repeated lines taken out; same columns, null texts stay null."""
    done = with_lines_dropped(docs, least, documents)
    text = F.when(F.col("text").isNotNull(), F.col("__kept.text"))
    return done.withColumn("text", text).select(*docs.columns)
