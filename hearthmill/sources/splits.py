"""Records that may reach across the splits of a file.

A file is read in pieces (lines, or text up to some character) by as many
tasks as it has splits. Whether a piece ends a record depends on everything
before it: whether a quote is open, and how deep brackets are nested. Each
piece therefore says what it does to an open and to a closed quote, and how
the depth changes in either case. A first scan composes this per split, one
row each; their composition along a file gives every split its starting
state. A second scan cuts the splits into records, and what is left over at
their edges is put together. Text is never gathered per file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthmill.sources.shared import settle

FILE = "file"
EFFECTS = ["when_closed", "when_open", "depth_closed", "depth_open"]


def read_pieces(spark: SparkSession, paths: str | list[str], separator: str | None = None) -> DataFrame:
    """Pieces of files in order of (file, block, piece): text between separators, by default line ends."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"),
        "value",
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, block, first, last) of a batch's rows that lie in one split."""
    if not batch.num_rows:
        return
    files, blocks = batch.column(FILE).dictionary_encode(), batch.column("block").to_numpy()
    codes = files.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield files.dictionary[codes[first]].as_py(), int(blocks[first]), first, last


def open_after(start: int, when_closed: np.ndarray, when_open: np.ndarray) -> np.ndarray:
    """Whether a quote is open after each piece, if it is ``start`` before the first."""
    fixed = when_closed == when_open  # what came before does not matter
    turns = np.cumsum((when_closed == 1) & (when_open == 0))
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    since = turns - np.where(last >= 0, turns[last], 0)
    origin = np.where(last >= 0, when_closed[last], start)
    return (origin + since) % 2


def _followed(start: int, effects: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Open quote and change of depth after each piece of a run."""
    when_closed, when_open, depth_closed, depth_open = effects
    after = open_after(start, when_closed, when_open)
    before = np.concatenate(([start], after[:-1]))
    return after, np.cumsum(np.where(before == 1, depth_open, depth_closed))


def _effects(batch: pa.RecordBatch, first: int, last: int) -> list[np.ndarray]:
    return [batch.column(name).slice(first, last - first).to_numpy() for name in EFFECTS]


def _split_effects(pieces: DataFrame) -> DataFrame:
    """One row per split: its effect on a closed and on an open quote, and on the depth."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list] = []
        for batch in batches:
            for file, block, first, last in _runs(batch):
                if not found or found[-1][:2] != [file, block]:
                    found.append([file, block, 0, 1, 0, 0])
                own = found[-1]
                effects = _effects(batch, first, last)
                for state, depth in ((2, 4), (3, 5)):
                    after, deeper = _followed(own[state], effects)
                    own[state], own[depth] = int(after[-1]), own[depth] + int(deeper[-1])
        if found:
            columns = [pa.array(column) for column in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, names=[FILE, "block", *EFFECTS])

    schema = f"{FILE} string, block long, when_closed long, when_open long, depth_closed long, depth_open long"
    return settle(pieces.select(FILE, "block", *EFFECTS).mapInArrow(compose, schema), "split-effects")


def split_starts(pieces: DataFrame) -> DataFrame:
    """(file, block, open, depth) in which each split starts.

    A file's splits are put in order in one task: one short row per split,
    so as many as the file's size has split lengths.
    """
    ordered = Window.partitionBy(FILE).orderBy("block")
    before, until = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A closed quote at a file's start. Splits either fix the state or, an odd
    # or even number of times since the last one that did, turn it.
    fixes = F.col("when_closed") == F.col("when_open")
    turns = F.when((F.col("when_closed") == 1) & (F.col("when_open") == 0), 1).otherwise(0)
    splits = _split_effects(pieces).withColumn("turns", F.sum(turns).over(until))
    fixed, then = F.last(F.when(fixes, F.col("when_closed")), True).over(before), F.last(F.when(fixes, F.col("turns")), True).over(before)
    since = F.coalesce(F.max("turns").over(before), F.lit(0)) - F.coalesce(then, F.lit(0))
    opened = splits.withColumn("open", (F.coalesce(fixed, F.lit(0)) + since) % 2)
    change = F.when(F.col("open") == 0, F.col("depth_closed")).otherwise(F.col("depth_open"))
    depth = F.coalesce(F.sum(change).over(before), F.lit(0))
    return settle(opened.select(FILE, "block", "open", depth.alias("depth")), "split-starts")


CUT = f"{FILE} string, block long, seq long, part string, text string"


def _cut(pieces: DataFrame, separator: str, end_depth: int) -> DataFrame:
    """Records within splits, and the texts before the first and after the last end of a split."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, depth, seq, waiting = None, 0, 0, 0, []

        def left_over() -> Iterator[pa.RecordBatch]:
            if at is not None and waiting:
                yield rows([(*at, seq, "tail", separator.join(waiting))])

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*found)], names=[FILE, "block", "seq", "part", "text"])

        for batch in batches:
            found = []
            for file, block, first, last in _runs(batch):
                if at != (file, block):
                    yield from left_over()
                    at, seq, waiting = (file, block), 0, []
                    state, depth = batch.column("open")[first].as_py(), batch.column("depth")[first].as_py()
                texts = batch.column("value").slice(first, last - first).to_pylist()
                after, deeper = _followed(state, _effects(batch, first, last))
                done = 0
                for end in np.flatnonzero((after == 0) & (depth + deeper == end_depth)).tolist():
                    text = separator.join([*waiting, *texts[done : end + 1]]) if waiting or end > done else texts[end]
                    found.append((file, block, seq, "head" if block and not seq else "whole", text))
                    waiting, done, seq = [], end + 1, seq + 1
                waiting += texts[done:]
                state, depth = int(after[-1]), depth + int(deeper[-1])
            if found:
                yield rows(found)
        yield from left_over()

    return pieces.select(FILE, "block", "value", "open", "depth", *EFFECTS).mapInArrow(cut, CUT)


def records(pieces: DataFrame, separator: str, end_depth: int = 0) -> DataFrame:
    """Rows of file, block, seq, text and ``rest``, in order of (file, block, seq), from written tables.

    ``pieces`` come from read_pieces, with the columns of ``EFFECTS`` added. A
    record ends with the piece after which no quote is open and the depth is
    ``end_depth``; its pieces are joined by the separator. Pieces behind the
    last end of a file are one more row, marked ``rest``.
    """
    started = pieces.join(split_starts(pieces), [FILE, "block"]).sortWithinPartitions(FILE, "block", "piece")
    parts = settle(_cut(started, separator, end_depth), "split-records")
    whole = parts.filter("part = 'whole'").select(FILE, "block", "seq", "text", F.lit(False).alias("rest"))
    # Two rows per split at most: a head ends what the tails before it began.
    edges = parts.filter("part <> 'whole'").withColumn("order", F.struct("block", "seq"))
    ahead = Window.partitionBy(FILE).orderBy("order").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    edges = edges.withColumn("ends", F.min(F.when(F.col("part") == "head", F.col("block"))).over(ahead))
    joined = edges.groupBy(FILE, "ends").agg(F.sort_array(F.collect_list(F.struct("order", "text"))).alias("parts"), F.max("block").alias("last"), F.max("seq").alias("seq"))
    stitched = joined.select(
        FILE, F.coalesce("ends", "last").alias("block"), F.when(F.col("ends").isNotNull(), 0).otherwise(F.col("seq")).cast("long").alias("seq"),
        F.array_join(F.transform("parts", lambda part: part.text), separator).alias("text"), F.col("ends").isNull().alias("rest"),
    )
    return whole.union(settle(stitched, "edge-records"))
