"""Whitening of embeddings by an incremental eigendecomposition.

Every task turns its rows, one centred rank-one update after the other, into
a count, a mean and a spectrum; spectra are merged in small groups, level by
level, by further rank-one updates. What rounding has left is settled by one
Rayleigh-Ritz step: all tasks add up the covariance of their rows in the basis
found, and the eigenvectors of that small matrix turn the basis. Only vectors
and matrices of the embedding's dimension leave the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthmill.llm.spectrum import Spectrum
from hearthmill.sources.shared import settle

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
FAN = 16  # states merged by one task
STEP = 4096  # vectors worked on at once
STATE = "part long, n long, sums array<long>, mean array<double>, spectral array<double>, vectors array<double>"
RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def usable(rows: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, e) of the rows that take part, and the dimension."""
    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    whole = own.filter("e is not null and forall(e, x -> x is not null and abs(x) < double('infinity'))")
    sizes = whole.groupBy(F.size("e").alias("dim")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first()
    dim = sizes["dim"] if sizes else 0
    return whole.filter(F.size("e") == dim), dim


def whole_numbers(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Runs of a batch's rows and their integer vectors, a bounded number at once."""
    for at in range(0, batch.num_rows, STEP):
        part = batch.column("e").slice(at, STEP)
        entries = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dim)
        yield slice(at, at + len(part)), np.clip(np.floor(SCALE * entries), -(2.0**62), 2.0**62).astype(np.int64) + SHIFT


def _row(part: int, n: int, sums: np.ndarray, own: Spectrum) -> pd.DataFrame:
    cells = {"part": part, "n": n, "sums": sums, "mean": own.mean, "spectral": own.values, "vectors": own.vectors.ravel()}
    return pd.DataFrame({name: [cell] for name, cell in cells.items()})


def _spectrum(row) -> Spectrum:
    own = Spectrum(len(row.mean))
    own.n, own.mean, own.values = int(row.n), np.array(row.mean), np.array(row.spectral)
    own.vectors = np.array(row.vectors).reshape(len(own.mean), -1)
    return own


def spectra(rows: DataFrame, dim: int) -> DataFrame:
    """One state per task: exact sums and the spectrum of its rows."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = Spectrum(dim), np.zeros(dim, np.int64)
        for batch in batches:
            for _, x in whole_numbers(batch, dim):
                sums += x.sum(axis=0)
                for vector in x.astype(float):
                    own.add(vector)
        if own.n:
            state = _row(TaskContext.get().partitionId(), own.n, sums, own)
            yield pa.RecordBatch.from_pandas(state, preserve_index=False)

    return rows.mapInArrow(learn, STATE)


def merged(states: DataFrame, merge: Callable[[pd.DataFrame], pd.DataFrame], label: str) -> pd.DataFrame:
    """The one state that all merge into, ``FAN`` neighbours at a time; ``merge`` gets them in order."""

    def together(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return merge(rows.sort_values("part")).assign(part=key[0])

    schema = states.schema
    states = settle(states, label)
    while states.limit(2).count() > 1:
        states = settle(states.groupBy(F.expr(f"part div {FAN}").alias("above")).applyInPandas(together, schema), label)
    return states.toPandas()


def merge_spectra(rows: pd.DataFrame) -> pd.DataFrame:
    every = [_spectrum(row) for row in rows.itertuples()]
    for other in every[1:]:
        every[0].merge(other)
    return _row(0, every[0].n, sum(np.asarray(s) for s in rows["sums"]), every[0])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, the whole part taken off before anything is rounded."""
    return (x - sums // n).astype(float) - (sums % n) / n


def covariance(rows: DataFrame, dim: int, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance of the centred rows' coordinates along the basis, over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast((n, sums, basis))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, basis = shared.value
        first, second = np.zeros(basis.shape[1]), np.zeros((basis.shape[1],) * 2)
        for batch in batches:
            for _, x in whole_numbers(batch, dim):
                y = _centred(x, n, sums) @ basis
                first += y.sum(axis=0)
                second += y.T @ y
        state = pd.DataFrame({"part": [TaskContext.get().partitionId()], "first": [first], "second": [second.ravel()]})
        yield pa.RecordBatch.from_pandas(state, preserve_index=False)

    def add(states: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [0], "first": [np.sum(list(states["first"]), axis=0)], "second": [np.sum(list(states["second"]), axis=0)]})

    total = merged(rows.mapInArrow(measure, "part long, first array<double>, second array<double>"), add, "covariance")
    mean = np.array(total["first"][0]) / n
    return np.array(total["second"][0]).reshape(len(mean), -1) / n - np.outer(mean, mean)


def principal(rows: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """n, sums, falling eigenvalues of the covariance and their unit eigenvectors (as columns)."""
    state = merged(spectra(rows, dim), merge_spectra, "spectra")
    n, sums = int(state["n"][0]), np.array(state["sums"][0], np.int64)
    basis, _ = np.linalg.qr(np.array(state["vectors"][0]).reshape(dim, dim))
    values, turn = np.linalg.eigh(covariance(rows, dim, n, sums, basis))
    return n, sums, values[::-1], basis @ turn[:, ::-1]


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over the dimensions of (n*x - S)**2 as exact decimals."""
    widest = float(np.abs(x).max(initial=0)) * n + float(np.abs(sums).max(initial=0))
    if widest < 2.0**62:
        away = n * x - sums
        if float(np.abs(away).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return pa.array((away * away).sum(axis=1)).cast(pa.decimal128(38, 0))
        away = away.tolist()
    else:
        away = [[n * a - s for a, s in zip(row, sums.tolist())] for row in x.tolist()]
    return pa.array([Decimal(sum(a * a for a in row)) for row in away], pa.decimal128(38, 0))


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per row that takes part and component: columns of ``RESULT``.

    Null vectors, and vectors holding a null, NaN or infinite entry, take no
    part; nor do vectors of another length than most have (of two equally
    frequent lengths the longer stays). Null ids are kept, rows that repeat
    count each time. Components without variance beyond rounding are left out,
    so that a table of one vector, or of equal ones, gives no rows; so do
    empty tables and empty vectors. Sums are 64 bits wide: exact while n times
    the largest entry stays below 2**63. The driver holds matrices of the
    dimension squared and nothing that grows with the rows. Other columns of
    rows are not looked at.
    """
    spark = rows.sparkSession
    own, dim = usable(rows)
    if not dim:
        return spark.createDataFrame([], RESULT)
    n, sums, values, vectors = principal(own, dim)
    trace = float(np.maximum(values, 0).sum())
    found = int((values[:components] > 64 * dim * np.finfo(float).eps * trace).sum())
    if not found:
        return spark.createDataFrame([], RESULT)
    axes = vectors[:, :found] / np.sqrt(values[:found])
    error = float(np.abs(covariance(own, dim, n, sums, axes) - np.eye(found)).max())
    shared = spark.sparkContext.broadcast((n, sums, axes, values[:found] / trace, error))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, axes, explained, error = shared.value
        k = len(explained)
        for batch in batches:
            for part, x in whole_numbers(batch, dim):
                each = np.repeat(np.arange(len(x)), k)
                ids = batch.column("vec_id").slice(part.start, len(x))
                columns = [
                    ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), n)),
                    deviations(x, n, sums).take(pa.array(each)), pa.array((_centred(x, n, sums) @ axes).ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in RESULT.split(", ")])

    return own.mapInArrow(project, RESULT)
