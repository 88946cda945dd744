"""Exact top-k inner products by distributed histogram selection.

Queries go in blocks of a bounded size. For a block, every task scores its
rows and counts the scores per query in equal bins; the counts are added up
over all tasks, and the bin that holds the kth highest score becomes the next
round's range, until it is one integer wide. A last pass keeps what lies above
each query's kth value, and of the rows at that value the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.sources.shared import fresh_path, settle

BINS = 128
BLOCK_BYTES = 8_000_000
STEP_PAIRS = 2_000_000  # scores held at once, about 40 bytes each with what is counted from them
RESULT = "query_id long, vec_id long, score long"


def integer_vectors(rows: DataFrame, factor: int = 1024) -> DataFrame:
    """(vec_id, v): components floor(factor * x) of the vectors that take part.

    Null ids, null vectors and vectors holding a null, NaN or infinite
    component take no part. Rows that share an id count once, with the
    smallest vector.
    """
    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    whole = own.filter("vec_id is not null and e is not null and forall(e, x -> x is not null and abs(x) < double('infinity'))")
    return whole.selectExpr("vec_id", f"transform(e, x -> floor({factor} * x)) as v").groupBy("vec_id").agg(F.min("v").alias("v"))


class Block:
    """Query vectors of one block, by dimension, and the state of the search."""

    def __init__(self, ids: list[int], vectors: list[list[int]], longest: dict[int, float]):
        order = sorted(range(len(ids)), key=lambda i: (len(vectors[i]), ids[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        dims = np.array([len(vectors[i]) for i in order])
        self.parts = {}  # dimension: (first, last, matrix)
        bound = np.zeros(len(ids))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            matrix = np.array([vectors[order[i]] for i in at], np.int64).reshape(len(at), dim)
            self.parts[int(dim)] = (at[0], at[-1] + 1, matrix)
            bound[at] = np.sqrt((matrix.astype(float) ** 2).sum(axis=1)) * longest[int(dim)] * (1 + 1e-9) + 1
        reach = np.ceil(bound).astype(np.int64)
        self.low, self.span = -reach, 2 * reach + 1  # the kth score lies in [low, low + span)
        self.above = np.zeros(len(ids), np.int64)  # scores beyond the range
        self.all = np.zeros(len(ids), bool)  # fewer than k rows: keep every one

    @property
    def width(self) -> np.ndarray:
        return np.maximum(1, -(-self.span // BINS))

    def scores(self, ids: np.ndarray, sizes: np.ndarray, values: np.ndarray):
        """Per dimension: query range, ids of the rows, score matrix, which pairs count."""
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.zeros(0, np.int64)
        for dim, (first, last, matrix) in self.parts.items():
            rows = np.flatnonzero(sizes == dim)
            step = min(2048, max(1, STEP_PAIRS // max(1, last - first)))
            for at in range(0, len(rows), step):
                own = rows[at : at + step]
                other = values[starts[own][:, None] + np.arange(dim)] if dim else np.zeros((len(own), 0), np.int64)
                most = float(np.abs(other).max(initial=0)) * float(np.abs(matrix).max(initial=0)) * max(dim, 1)
                if most < 2**52:
                    scored = (other.astype(float) @ matrix.T.astype(float)).astype(np.int64)
                else:
                    scored = other @ matrix.T
                yield first, last, ids[own], scored, ids[own][:, None] != self.ids[first:last][None]


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column(1)
    return batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()


def _histogram(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        counts, width = np.zeros((len(block.ids), BINS), np.int64), block.width
        for batch in batches:
            for first, last, _, scored, counted in block.scores(*_arrays(batch)):
                ahead = scored - block.low[first:last]
                counted &= (ahead >= 0) & (ahead < block.span[first:last])
                bins = ahead // width[first:last]
                flat = (bins + np.arange(last - first) * BINS)[counted]
                counts[first:last] += np.bincount(flat, minlength=(last - first) * BINS).reshape(-1, BINS)
        query, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(counts[query, place])], names=["query", "bin", "n"]
        )

    return run


def _winners(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for first, last, ids, scored, counted in block.scores(*_arrays(batch)):
                least = np.where(block.all[first:last], np.iinfo(np.int64).min, block.low[first:last])
                over, tied = counted & (scored > least), counted & (scored == least)
                for q in np.flatnonzero(tied.sum(axis=0) > k):  # of equal scores the smallest ids suffice
                    at = np.flatnonzero(tied[:, q])
                    tied[:, q] = False
                    tied[at[np.argsort(ids[at], kind="stable")[:k]], q] = True
                row, query = np.nonzero(over | tied)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids[first + query]), pa.array(ids[row]), pa.array(scored[row, query])], names=["query_id", "vec_id", "score"]
                )

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products.

    ``vectors`` has vec_id and v, an integer vector. Every row but the
    query's own is a candidate; ties go to the smaller vec_id. Vectors of
    different length do not meet. With fewer than k candidates all are
    given. Scores must fit a long.
    """
    spark = vectors.sparkSession
    vectors = settle(vectors.select("vec_id", "v"), "integer-vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    stats = vectors.groupBy(F.size("v").alias("dim")).agg(F.max(F.sqrt(squares)).alias("longest")).collect()
    longest = {r["dim"]: r["longest"] for r in stats}
    queries = settle(vectors.filter(is_query), "query-vectors")
    per_block = max(1, BLOCK_BYTES // (8 * max([1, *longest])))
    blocks = -(-queries.count() // per_block)
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks))))
    path = fresh_path(spark, "top-k")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for b in range(blocks):
        rows = numbered.filter(F.col("block") == b).collect()  # about per_block rows
        if not rows:
            continue
        block = Block([r["vec_id"] for r in rows], [r["v"] for r in rows], longest)
        while True:
            shared = spark.sparkContext.broadcast(block)
            counts = vectors.mapInArrow(_histogram(shared), "query int, bin int, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
            below = "sum(n) over (partition by query order by bin desc rows between unbounded preceding and 1 preceding)"
            ranked = counts.selectExpr("*", f"coalesce({below}, 0) as higher")
            # The bin that holds the kth score; of a query with fewer scores, the lowest bin.
            last = ranked.groupBy("query").agg(F.max_by(F.struct("bin", "n", "higher"), "higher").alias("lowest"), F.collect_list(F.struct("bin", "n", "higher")).alias("bins"))
            found = last.selectExpr("query", "lowest.n + lowest.higher as total", "bins").collect()
            width, narrow = block.width, np.zeros(len(block.ids), bool)
            for r in found:
                q = r["query"]
                if block.all[q]:
                    continue
                need = k - block.above[q]
                if r["total"] < need:
                    block.all[q] = True
                    continue
                own = next(x for x in r["bins"] if x["higher"] < need <= x["higher"] + x["n"])
                block.above[q] += own["higher"]
                block.low[q] += own["bin"] * width[q]
                block.span[q] = width[q]
                narrow[q] = width[q] > 1
            empty = np.ones(len(block.ids), bool)
            empty[[r["query"] for r in found]] = False
            block.all |= empty  # no candidates at all
            if not narrow.any():
                break
        shared = spark.sparkContext.broadcast(block)
        best = vectors.mapInArrow(_winners(shared, k), RESULT)
        ranked = best.selectExpr("*", "row_number() over (partition by query_id order by score desc, vec_id) as place").filter(F.col("place") <= k)
        ranked.drop("place").write.mode("append").parquet(path)
    done = spark.read.schema(RESULT).parquet(path)
    return done.selectExpr("query_id", "row_number() over (partition by query_id order by score desc, vec_id) as rank", "vec_id", "score")
