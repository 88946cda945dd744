"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

NO_ID = -(2**63)  # stands for a null id where rows meet by id


def known(id_column: str | Column) -> Column:
    """An id for joining: nulls become one value below all others."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def chunks(texts: Sequence[str | None], most: int = 1_000_000) -> Iterator[slice]:
    """Runs of texts of about ``most`` characters; a longer text is a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and size + n > most:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place on a copy)."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def random_words(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit values that depend on the seed only."""
    step = 0x9E3779B97F4A7C15
    start = (seed * 0xD1B54A32D192ED03) % 2**64
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(step) + np.uint64(start))


def _base(seed: int) -> int:
    return 0x5851F42D4C957F2D ^ (seed << 1)


def _powers(factor: int, n: int) -> np.ndarray:
    """1, factor, factor**2, ... as n 64-bit values."""
    powers = np.full(n, factor, np.uint64)
    powers[:1] = 1
    np.multiply.accumulate(powers, out=powers)
    return powers


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 7, powers: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """64-bit hash of each run values[start:end]; equal runs have equal hashes.

    ``values`` holds random 64-bit stand-ins of the symbols. Sums weighted with
    the powers of an odd number are taken from one running sum; the inverse
    power moves each run to the origin. ``powers`` are both, if at hand.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(values)
    if powers is None:
        powers = _powers(_base(seed), n), _powers(pow(_base(seed), -1, 2**64), n + 1)
    up, down = powers
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    sums = (total[ends] - total[starts]) * down[starts]
    return mixed(sums + (ends - starts).astype(np.uint64))


@cache
def _kept_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_base(7), n), _powers(pow(_base(7), -1, 2**64), n + 1)


def word_run_hashes(raw: np.ndarray, stand_ins: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 250_000) -> np.ndarray:
    """run_hashes of stand_ins[raw], in turns of about ``most`` symbols, so that a long text needs no more memory at once.

    Turns end between runs; only a run longer than ``most`` is a longer turn.
    """
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, first + most, side="right")))
        turn = stand_ins[raw[first : ends[stop - 1]]]
        powers = _kept_powers(most) if len(turn) <= most else None
        hashes[at:stop] = run_hashes(turn, starts[at:stop] - first, ends[at:stop] - first, powers=powers)
        at = stop
    return hashes


def shared_read(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
