"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network predicts a word from the two words on either side: an embedding
per position, summed and squashed, then a softmax over the vocabulary. The
vocabulary comes from counts over all documents; rarer words share hash
classes. Training is data-parallel numpy: in every round each task hides one
word in ``hidden_every`` of all its documents and takes gradient steps from
the common parameters; the results are averaged by the number of words. A
document's score is the sum of the log-probabilities of all its words, each
given both sides. A rarer word adds its probability within its class, from the
counts of all words: a table that grows with the corpus and is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.llm.common import chunks, random_words, word_run_hashes
from hearthmill.sources.shared import settle

OFFSETS = (-2, -1, 1, 2)


@dataclass(frozen=True)
class Options:
    frequent: int = 384  # words with a class of their own
    shared: int = 64  # hash classes of all other words
    width: int = 24
    rounds: int = 2
    hidden_every: int = 10
    learners: int = 2000  # tasks that train at most; each takes more documents beyond
    rate: float = 0.15
    seed: int = 5


@cache
def _byte_stand_ins() -> tuple[np.ndarray, np.ndarray]:
    wordly = np.zeros(256, bool)
    wordly[128:] = True
    for low, high in ((48, 58), (97, 123)):
        wordly[low:high] = True
    return wordly, random_words(31, 256)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text where its words begin and end."""
    bodies = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    raw = np.frombuffer(b"\n".join([*bodies, b""]), np.uint8)
    wordly, stand_ins = _byte_stand_ins()
    inside = wordly[raw]
    before = np.concatenate(([False], inside[:-1]))
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
    bounds = np.concatenate(([0], np.searchsorted(starts, np.cumsum([len(b) + 1 for b in bodies]))))
    return word_run_hashes(raw, stand_ins, starts, ends), bounds


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hashes of all words and their occurrences in all documents, kept as a table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in chunks(texts):
                hashes, counts = np.unique(word_hashes(texts[part])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(count, "word long, n long")
    return settle(counts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def vocabulary(counts: DataFrame, options: Options) -> np.ndarray:
    """Sorted hashes of the most frequent words."""
    top = counts.orderBy(F.desc("n"), "word").limit(options.frequent).collect()
    return np.sort(np.array([r["word"] for r in top], np.int64).view(np.uint64))


class Network:
    """Parameters and the two passes. ``words`` holds the vocabulary's hashes."""

    def __init__(self, words: np.ndarray, options: Options):
        self.words, self.options = words, options
        self.classes = len(words) + options.shared
        rng = np.random.default_rng(options.seed)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        # One more context symbol stands for what lies beyond the text.
        self.context = small(len(OFFSETS), self.classes + 1, options.width)
        self.hidden = np.zeros(options.width, np.float32)
        self.out = small(options.width, self.classes)
        self.bias = np.zeros(self.classes, np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.hidden, self.out, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for part in self.parts():
            part[...] = flat[at : at + part.size].reshape(part.shape)
            at += part.size

    def classes_of(self, hashes: np.ndarray) -> np.ndarray:
        other = len(self.words) + (hashes % np.uint64(self.options.shared)).astype(np.int64)
        if not len(self.words):
            return other
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, other)

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of each word, classes around it, and the bounds of the texts."""
        return self.windows_of(*word_hashes(texts))

    def windows_of(self, hashes: np.ndarray, bounds: np.ndarray, pick: slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As windows(), of the words ``pick`` selects."""
        target = self.classes_of(hashes)
        sizes = np.diff(bounds)
        at = np.arange(len(target))[pick]
        first, last = np.repeat(bounds[:-1], sizes)[pick], np.repeat(bounds[1:], sizes)[pick]
        around = np.full((len(OFFSETS), len(at)), self.classes, np.int64)
        for k, offset in enumerate(OFFSETS):
            within = (at + offset >= first) & (at + offset < last)
            around[k, within] = target[at[within] + offset]
        return target[pick], around, bounds

    def _outward(self) -> tuple[np.ndarray, bool]:
        """Output weights with the bias as one more row, and whether exp of what they give must be bounded."""
        # |h| is below 1, so the weights bound the sums.
        return np.concatenate((self.out, self.bias[None])), (np.abs(self.out).sum(axis=0) + np.abs(self.bias)).max(initial=0) > 60

    def forward(self, around: np.ndarray, outward: tuple[np.ndarray, bool], room: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and the softmax's unnormalised exponentials, the latter in ``room`` if given."""
        weights, wide = outward
        h = self.context[0].take(around[0], axis=0)
        for k in range(1, len(OFFSETS)):
            h += self.context[k].take(around[k], axis=0)
        h += self.hidden
        np.tanh(h, out=h)
        z = np.matmul(np.concatenate((h, np.ones((len(h), 1), np.float32)), axis=1), weights, out=room)
        if wide:
            np.clip(z, -60, 60, out=z)
        np.exp(z, out=z)
        return h, z

    def log_probabilities(self, target: np.ndarray, around: np.ndarray) -> np.ndarray:
        result, outward = np.empty(len(target)), self._outward()
        room, ones, step = np.empty((512, self.classes), np.float32), np.ones(self.classes, np.float32), np.arange(512)
        for at in range(0, len(target), 512):  # what a processor's cache holds
            own = target[at : at + 512]
            _, z = self.forward(around[:, at : at + 512], outward, room[: len(own)])
            result[at : at + 512] = np.log(z[step[: len(own)], own]) - np.log(z @ ones)
        return result

    def learn(self, target: np.ndarray, around: np.ndarray, squares: list[np.ndarray]) -> None:
        """One adaptive gradient step on some hidden words."""
        h, z = self.forward(around, self._outward())
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(len(z)), target] -= 1.0
        z /= len(z)
        back = (z @ self.out.T) * (1 - h * h)
        context = np.zeros_like(self.context)
        for k in range(len(OFFSETS)):
            for j in range(self.options.width):
                context[k, :, j] = np.bincount(around[k], back[:, j], minlength=self.classes + 1)
        slopes = [context, back.sum(axis=0), h.T @ z, z.sum(axis=0)]
        for part, slope, square in zip(self.parts(), slopes, squares):
            square += slope * slope
            part -= self.options.rate * slope / np.sqrt(square + 1e-8)


def train(docs: DataFrame, options: Options = Options(), counts: DataFrame | None = None) -> Network:
    """Network fitted on hidden words of all documents; ``counts`` are their word_counts if at hand."""
    network = Network(vocabulary(word_counts(docs) if counts is None else counts, options), options)
    texts = docs.select(F.col("text").cast("string").alias("text")).coalesce(options.learners)
    for round_ in range(options.rounds):
        common = docs.sparkSession.sparkContext.broadcast((network.words, network.flat()))

        def learn(batches: Iterator[pa.RecordBatch], shift=round_, common=common) -> Iterator[pa.RecordBatch]:
            words, flat = common.value
            own = Network(words, options)
            own.load(flat)
            squares = [np.full_like(p, 1e-4) for p in own.parts()]
            seen = 0
            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0
            for batch in batches:
                bodies = batch.column(0).to_pylist()
                for part in chunks(bodies):
                    pick = slice(shift * (options.hidden_every // 2), None, options.hidden_every)
                    target, around, _ = own.windows_of(*word_hashes(bodies[part]), pick)
                    waiting.append((target, around))
                    held += len(waiting[-1][0])
                    seen += len(waiting[-1][0])
                    if held >= 1024:
                        _steps(own, waiting, squares)
                        waiting, held = [], 0
            _steps(own, waiting, squares)
            if seen:
                values = own.flat().astype(np.float64) * seen
                at = np.arange(len(values), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(values), pa.array(np.full(len(values), seen))], names=["at", "total", "seen"])

        results = texts.mapInArrow(learn, "at int, total double, seen long")
        mean = settle(results.groupBy("at").agg((F.sum("total") / F.sum("seen")).alias("value")), "mean-parameters").collect()
        if mean:
            flat = np.empty(len(mean), np.float32)
            for row in mean:
                flat[row["at"]] = row["value"]
            network.load(flat)
    return network


def _steps(network: Network, waiting: list[tuple[np.ndarray, np.ndarray]], squares: list[np.ndarray]) -> None:
    if not waiting:
        return
    target = np.concatenate([t for t, _ in waiting])
    around = np.concatenate([a for _, a in waiting], axis=1)
    for at in range(0, len(target), 1024):
        network.learn(target[at : at + 1024], around[:, at : at + 1024], squares)


def pseudo_likelihood(docs: DataFrame, network: Network, text: str = "text") -> Column:
    """Struct of n_words, log_likelihood and mean_log_prob of each whole text, rarer words by their class alone.

    A null text, or one without words, has n_words 0, log_likelihood 0 and a
    null mean. Equal texts have equal scores.
    """
    options = network.options
    shipped = docs.sparkSession.sparkContext.broadcast((network.words, network.flat()))

    @F.pandas_udf("n_words long, log_likelihood double, mean_log_prob double")
    def score(series: pd.Series) -> pd.DataFrame:
        words, flat = shipped.value
        model = Network(words, options)
        model.load(flat)
        texts, totals, counts = list(series), [], []
        for part in chunks(texts):
            target, around, bounds = model.windows(texts[part])
            running = np.concatenate(([0.0], np.cumsum(model.log_probabilities(target, around))))
            totals.append(running[bounds[1:]] - running[bounds[:-1]])
            counts.append(np.diff(bounds))
        total, count = np.concatenate(totals or [np.zeros(0)]), np.concatenate(counts or [np.zeros(0, np.int64)])
        mean = pd.Series(total / np.maximum(count, 1)).where(count > 0, None)
        return pd.DataFrame({"n_words": count, "log_likelihood": total, "mean_log_prob": mean})

    return score.asNondeterministic()(F.col(text).cast("string"))


def word_likelihoods(docs: DataFrame, network: Network, counts: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, log_likelihood, mean_log_prob, of words instead of classes.

    Within a class a word seen n times has weight n + 1/2; an unseen word has
    1/2, and one more unseen word than seen ones is allowed for. Rows as in
    pseudo_likelihood.
    """
    options = network.options
    rare = counts.filter(~F.col("word").isin(network.words.view(np.int64).tolist()))
    # Hashes are unsigned; Spark's longs are not.
    class_ = F.expr(f"pmod(pmod(word, {options.shared}L) + if(word < 0, {2**64 % options.shared}L, 0L), {options.shared}L)")
    weight = np.full(options.shared, 0.5)
    for row in rare.groupBy(class_.alias("c")).agg((F.sum("n") + F.count("*") + 0.5).alias("weight")).collect():
        weight[row["c"]] = row["weight"]
    shipped = docs.sparkSession.sparkContext.broadcast((network.words, network.flat(), np.log(0.5 / weight)))

    @F.pandas_udf("n_words long, log_likelihood double, words array<long>, times array<long>")
    def score(series: pd.Series) -> pd.DataFrame:
        words, flat, unseen = shipped.value
        model = Network(words, options)
        model.load(flat)
        texts, totals, counts, held, times = list(series), [], [], [], []
        for part in chunks(texts):
            hashes, bounds = word_hashes(texts[part])
            target, around, _ = model.windows_of(hashes, bounds)
            chance = model.log_probabilities(target, around)
            other = target >= len(words)
            chance[other] += unseen[target[other] - len(words)]
            running = np.concatenate(([0.0], np.cumsum(chance)))
            totals.append(running[bounds[1:]] - running[bounds[:-1]])
            counts.append(np.diff(bounds))
            for start, end in zip(bounds[:-1], bounds[1:]):
                own, n = np.unique(hashes[start:end][other[start:end]], return_counts=True)
                held.append(own.view(np.int64))
                times.append(n.astype(np.int64))
        total, count = np.concatenate(totals or [np.zeros(0)]), np.concatenate(counts or [np.zeros(0, np.int64)])
        return pd.DataFrame({"n_words": count, "log_likelihood": total, "words": pd.Series(held, dtype=object), "times": pd.Series(times, dtype=object)})

    by_class = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), score.asNondeterministic()(F.col(text).cast("string")).alias("s"))
    by_class = settle(by_class.select("doc_id", "row", "s.*"), "class-scores")
    seen = by_class.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    # Whole units, so that equal texts have equal sums in any order.
    more = F.round(F.col("times") * F.log(2 * F.col("n") + 1) * 2**30).cast("long")
    seen = seen.join(rare, F.col("words") == F.col("word")).groupBy("row").agg((F.sum(more) / 2**30).alias("more"))
    whole = F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))
    return by_class.join(seen, "row", "left").select(
        "doc_id", "n_words", whole.alias("log_likelihood"), F.when(F.col("n_words") > 0, whole / F.col("n_words")).alias("mean_log_prob")
    )
