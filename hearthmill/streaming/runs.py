"""Unbroken outage runs of a stream: a good sample ends a run.

Samples wait, per component and hour, until the watermark has passed the hour;
then a timer cuts the hour, in order of time, into runs of bad samples. A run
that reaches the edge of its hour may go on in the next one: such pieces are
few, and each batch puts its own together with the one run per component that
the batch before left open. So no component has to fit into one task, however
many samples it sends.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from hearthmill.sources.shared import fresh_path
from hearthmill.streaming.telemetry import STATE_CONF, run_to_table

HOUR_MS = 3_600_000
PIECE = ["slot_end", "run_from", "run_to", "n_bad", "starts", "ends"]


class HourRuns(StatefulProcessor):
    """Holds an hour's samples of a component and cuts them into runs when the hour has closed."""

    def __init__(self, component: list[str], sample: str):
        self.component, self.sample = component, sample

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", self.sample)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            self.samples.appendList(list(zip(batch["sampled_at"].tolist(), batch["tie"].tolist(), batch["is_good"].tolist())))
        self.handle.registerTimer(int(key[-1]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.samples.exists():
            return
        samples = sorted(self.samples.get())
        self.samples.clear()
        pieces, bad = [], []
        for i, (at, _, good) in enumerate(samples):
            if not good:
                bad.append(at)
            if bad and (good or i + 1 == len(samples)):
                first = i + (not good) - len(bad)
                pieces.append((bad[0], bad[-1], len(bad), first > 0, bool(good)))
                bad = []
        if samples[0][2] and samples[-1][2]:
            # Nothing touches the edges: a mark that ends what came before.
            pieces.append((samples[0][0], samples[0][0], 0, True, True))
        found = pd.DataFrame(pieces, columns=PIECE[1:])
        found.insert(0, "slot_end", int(key[-1]))
        for name, value in reversed(list(zip(self.component, key))):
            found.insert(0, name, value)
        yield found

    def close(self) -> None:
        pass


def run_pieces(samples: DataFrame, component: Sequence[str], good: Column, timestamp: str, tiebreak: str) -> DataFrame:
    """Runs of bad samples within closed hours, and whether a good sample starts and ends them.

    ``samples`` carry a watermark on ``timestamp``. Rows that tie on both
    ``timestamp`` and ``tiebreak`` go with bad ones first.
    """
    kinds = dict(samples.dtypes)
    slot = (F.floor(F.unix_millis(timestamp) / HOUR_MS) + 1) * HOUR_MS
    own = samples.select(
        *component, timestamp, slot.alias("slot_end"), F.unix_micros(timestamp).alias("sampled_at"), F.col(tiebreak).alias("tie"), F.coalesce(good, F.lit(False)).alias("is_good")
    )
    sample = f"at bigint, tie {kinds[tiebreak]}, good boolean"
    schema = ", ".join(f"{name} {kinds[name]}" for name in component)
    schema += ", slot_end bigint, run_from bigint, run_to bigint, n_bad bigint, starts boolean, ends boolean"
    return own.groupBy(*component, "slot_end").transformWithStateInPandas(
        statefulProcessor=HourRuns(list(component), sample), outputStructType=schema, outputMode="append", timeMode="eventtime"
    )


def stitched(pieces: DataFrame, opened: DataFrame | None, component: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(closed runs, runs still open) from a batch's pieces and the runs left open before it."""
    inner = pieces.where("starts and ends and n_bad > 0").select(*component, "run_from", "run_to", "n_bad")
    edges = pieces.where("not (starts and ends) or n_bad = 0")
    if opened is not None:
        edges = edges.unionByName(opened)
    # Two pieces per component and hour at most.
    ordered = Window.partitionBy(*component).orderBy("slot_end", "run_from")
    begins = F.coalesce(F.lag("ends").over(ordered), F.lit(True)) | F.col("starts")
    chained = edges.withColumn("_chain", F.sum(begins.cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    chains = chained.groupBy(*component, "_chain").agg(
        F.max("slot_end").alias("slot_end"), F.min("run_from").alias("run_from"), F.max("run_to").alias("run_to"), F.sum("n_bad").alias("n_bad"), F.max("ends").alias("ends")
    )
    last = F.col("_chain") == F.max("_chain").over(Window.partitionBy(*component))
    runs = chains.withColumn("_open", last & ~F.col("ends")).where("n_bad > 0")
    closed = inner.union(runs.where("not _open").select(*component, "run_from", "run_to", "n_bad"))
    carried = runs.where("_open").select(*component, *PIECE[:4], F.lit(True).alias("starts"), "ends")
    return _as_runs(closed, component), carried


def _as_runs(runs: DataFrame, component: Sequence[str]) -> DataFrame:
    return runs.select(
        *component, F.timestamp_micros("run_from").alias("outage_start"), F.timestamp_micros("run_to").alias("outage_end"), "n_bad"
    )


def outage_runs_to_table(
    samples: DataFrame, component: Sequence[str], good: Column, timestamp: str, tiebreak: str, folder: str | None = None
) -> tuple[DataFrame, DataFrame, StreamingQuery]:
    """Closed runs, runs that no closed hour has ended yet, and the query, of what is available.

    A run closes with the hour of its closing sample, once the watermark has
    passed that hour. With the same ``folder`` a later run goes on.
    """
    spark = samples.sparkSession
    folder = folder or fresh_path(spark, "outage-runs")
    # List state needs RocksDB when the plan is made, not only when it starts.
    earlier = {name: spark.conf.get(name, None) for name in STATE_CONF}
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    try:
        pieces = run_pieces(samples, component, good, timestamp, tiebreak)
        closed, query = run_to_table(pieces, "append", "outage-runs", folder=folder, carry=lambda batch, opened: stitched(batch, opened, component))
    finally:
        for name, value in earlier.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    nothing = stitched(spark.createDataFrame([], pieces.schema), None, component)[1]
    last = query.lastProgress.batchId if query.lastProgress else None
    opened = nothing if last is None else _newest(nothing, f"{folder}/carried")
    return closed, _as_runs(opened, component), query


def _newest(nothing: DataFrame, folder: str) -> DataFrame:
    carried = nothing.sparkSession.read.schema(nothing.withColumn("batch", F.lit(0).cast("bigint")).schema).parquet(folder)
    batches = carried.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    newest = batches.select(F.max(F.regexp_extract("path", r"/batch=(\d+)/", 1).cast("bigint"))).first()[0]
    return carried.where(F.col("batch") == newest).drop("batch")
