"""Language of each word by a linear-chain conditional random field.

Every line is a sequence of words. A word's score per language comes from
hashed character n-grams, affixes and a lexicon of frequent training words;
learned transitions connect neighbouring words. Forward-backward gives each
word a distribution over languages, so a text that switches languages is
labelled word by word. A text's language is the one with the largest mean.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.llm.common import chunks, random_words, run_hashes

UNDETERMINED = "und"
BUCKETS = 1 << 16
KINDS = 3  # pairs, triples, affixes


@dataclass(frozen=True)
class FitOptions:
    """Bounds of the labelled sample and of the training.

    The sample holds at most ``per_language`` rows of each language, those
    with the smallest hash of doc_id, and of each row one passage of at most
    ``passage`` characters at a place that the hash chooses.
    """

    per_language: int = 250
    passage: int = 3000
    lexicon: int = 1500
    epochs: int = 3
    seed: int = 11


@dataclass
class Words:
    """Words of a run of texts: owner text, line, hashed features."""

    doc: np.ndarray
    line: np.ndarray
    features: list[np.ndarray]  # bucket of each n-gram, per kind
    firsts: list[np.ndarray]  # where each word's n-grams begin, per kind
    whole: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


@cache
def _stand_ins() -> np.ndarray:
    return random_words(3, 0x110000)


def _bucket(*codes: np.ndarray) -> np.ndarray:
    h = np.zeros(len(codes[0]), np.uint64)
    for code, factor in zip(codes, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        h += code.astype(np.uint64) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)


def words_of(texts: list[str]) -> Words:
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[np.minimum(codes, 0x10FFFF)]
    before = np.concatenate(([False], letter[:-1]))
    starts = np.flatnonzero(letter & ~before)
    ends = np.flatnonzero(~letter & before)  # a line end always follows
    doc_ends = np.cumsum([len(t) + 1 for t in lowered])
    c = np.where(letter, codes, 0)
    used = np.flatnonzero(letter | before)  # each word and the place behind it
    c0 = c[used]
    c1 = np.where(used > 0, c[used - 1], 0)
    c2 = np.where((used > 1) & (c1 > 0), c[used - 2], 0)
    sizes = ends - starts + 1
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    tails = [np.where(ends - starts > k, c[np.maximum(ends - 1 - k, 0)], 0) for k in range(4)]
    heads = [np.where(ends - starts > k, c[np.minimum(starts + k, len(c) - 1)], 0) for k in range(4)]
    marks = [np.full(len(starts), m, np.uint64) for m in (0x110001, 0x110002, 0x110003)]
    affixes = np.stack(
        [
            _bucket(marks[0], *heads[:3]),
            _bucket(marks[1], *tails[:3]),
            _bucket(heads[3], *heads[:3]) ^ 0x5555,
            _bucket(tails[3], *tails[:3]) ^ 0x3333,
        ],
        axis=1,
    )
    whole = run_hashes(_stand_ins()[np.minimum(codes, 0x10FFFF)], starts, ends)
    return Words(
        doc=np.searchsorted(doc_ends, starts, side="right"),
        line=np.cumsum(codes == 10)[starts] if len(starts) else np.zeros(0, np.int64),
        features=[_bucket(c0, c1), _bucket(c0, c1, c2), affixes.ravel()],
        firsts=[firsts, firsts, np.arange(len(starts)) * 4],
        whole=whole,
    )


class Field:
    """Weights of the random field and its inference."""

    def __init__(self, labels: list[str], lexicon: np.ndarray):
        self.labels = labels
        k = len(labels)
        self.weights = np.zeros((KINDS, BUCKETS, k), np.float32)
        self.lexicon = lexicon  # sorted hashes
        self.lexical = np.zeros((len(lexicon) + 1, k), np.float32)  # last row: not in the lexicon
        self.steps = np.zeros((k, k))
        self.start = np.zeros(k)

    def entry(self, whole: np.ndarray) -> np.ndarray:
        """Row of each word in the lexicon; the last one if it has none."""
        if not len(self.lexicon):
            return np.zeros(len(whole), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, whole), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == whole, at, len(self.lexicon))

    def scores(self, words: Words) -> np.ndarray:
        total = self.lexical[self.entry(words.whole)].astype(np.float64)
        if not len(words.whole):
            return total
        for kind in range(KINDS):
            gained = np.take(self.weights[kind], words.features[kind], axis=0)
            total += np.add.reduceat(gained, words.firsts[kind], axis=0)
        return total

    def marginals(self, scores: np.ndarray, line: np.ndarray, pairs: bool = False):
        """Forward-backward over all lines at once, longest first.

        Returns each word's distribution and, for training, the expected
        number of each transition.
        """
        n, k = scores.shape
        expected = np.zeros((k, k))
        if not n:
            return scores, expected
        firsts = np.flatnonzero(np.diff(line, prepend=line[0] - 1))
        lengths = np.diff(np.append(firsts, n))
        order = np.argsort(-lengths, kind="stable")
        firsts, lengths = firsts[order], lengths[order]
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # lines longer than t
        fit = np.exp(scores - scores.max(axis=1, keepdims=True))
        fit += 1e-12
        move = np.exp(self.steps)
        forward = np.empty_like(fit)
        now = fit[firsts] * np.exp(self.start)
        now /= now.sum(axis=1, keepdims=True)
        forward[firsts] = now
        for t in range(1, int(lengths[0])):
            at = firsts[: active[t]] + t
            now = (now[: active[t]] @ move) * fit[at]
            now /= now.sum(axis=1, keepdims=True)
            forward[at] = now
        back = np.ones((len(firsts), k))
        out = forward  # becomes the marginals from the end on
        for t in range(int(lengths[0]) - 1, 0, -1):
            at = firsts[: active[t]] + t
            ahead = back[: active[t]] * fit[at]
            earlier = ahead @ move.T
            earlier /= earlier.sum(axis=1, keepdims=True)
            if pairs:
                joint = forward[at - 1][:, :, None] * move[None] * ahead[:, None, :]
                joint /= joint.sum(axis=(1, 2), keepdims=True)
                expected += joint.sum(axis=0)
            settled = out[at] * back[: active[t]]
            out[at] = settled / settled.sum(axis=1, keepdims=True)
            back[: active[t]] = earlier
        settled = out[firsts] * back
        out[firsts] = settled / settled.sum(axis=1, keepdims=True)
        return out, expected

    def word_chances(self, texts: list[str]) -> tuple[Words, np.ndarray]:
        """All words of the texts, and each one's distribution over the labels."""
        words = words_of(texts)
        return words, self.marginals(self.scores(words), words.line)[0]

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum of the words' distributions per text, sum of each word's own largest chance, and the number of words."""
        words, chance = self.word_chances(texts)
        sums = [np.bincount(words.doc, chance[:, j], minlength=len(texts)) for j in range(len(self.labels))]
        own = np.bincount(words.doc, chance.max(axis=1), minlength=len(texts))
        return np.stack(sums, axis=1), own, np.bincount(words.doc, minlength=len(texts))


def _letter_runs(text: str) -> list[str]:
    """The words that words_of() finds in a text."""
    return ["".join(run) for letters, run in groupby(text.lower(), str.isalpha) if letters]


def _spliced(rng: np.random.Generator, by_label: list[list[str]], n: int) -> tuple[list[str], list[list[int]]]:
    """Lines made of one to three passages, each of one language."""
    lines, owners = [], []
    for _ in range(n):
        parts, owner = [], []
        for _ in range(rng.choice([1, 1, 2, 3])):
            label = int(rng.integers(len(by_label)))
            source = by_label[label]
            words = source[int(rng.integers(len(source)))]
            at = int(rng.integers(max(1, len(words) - 5)))
            part = words[at : at + int(rng.integers(3, 25))]
            parts += part
            owner += [label] * len(part)
        lines.append(" ".join(parts))
        owners.append(owner)
    return lines, owners


def fit(rows: list[tuple[str, str]], options: FitOptions = FitOptions()) -> Field:
    """Train on (language, text) rows by adaptive gradient steps on the log-likelihood."""
    labels = sorted({label for label, _ in rows})
    if not labels:
        return Field([], np.zeros(0, np.uint64))
    rng = np.random.default_rng(options.seed)
    by_label, frequent = [], []
    for label in labels:
        split = [_letter_runs(text) for own, text in rows if own == label]
        by_label.append([words for words in split if words] or [["x"]])
        joined = words_of([" ".join(words) for words in split])
        hashes, counts = np.unique(joined.whole, return_counts=True)
        kept = counts >= 3
        order = np.lexsort((hashes[kept], -counts[kept]))[: options.lexicon]
        frequent.append(hashes[kept][order])
    field = Field(labels, np.unique(np.concatenate(frequent)))
    k = len(labels)
    squares = [np.full_like(field.weights[i], 1e-3) for i in range(KINDS)]
    lexical_squares, step_squares = np.full_like(field.lexical, 1e-3), np.full((k, k), 1e-3)
    n_lines = min(6000, 20 * sum(len(x) for x in by_label))
    for epoch in range(options.epochs):
        lines, owners = _spliced(rng, by_label, n_lines)
        for at in range(0, n_lines, 400):
            batch = list(zip(lines[at : at + 400], owners[at : at + 400]))
            words = words_of([line for line, _ in batch])
            found = np.bincount(words.line, minlength=len(batch))
            if any(len(owner) != n for (_, owner), n in zip(batch, found)):  # lowered once more, a letter may come apart
                batch = [pair for pair, n in zip(batch, found) if len(pair[1]) == n]
                words = words_of([line for line, _ in batch])
            if not batch:
                continue
            truth = np.concatenate([np.array(owner) for _, owner in batch])
            chance, moves = field.marginals(field.scores(words), words.line, pairs=True)
            error = -chance
            error[np.arange(len(truth)), truth] += 1.0
            within = words.line[1:] == words.line[:-1]
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[:-1][within], truth[1:][within]), 1.0)
            rate = 0.25 / (1 + epoch)
            for kind in range(KINDS):
                sizes = np.diff(np.append(words.firsts[kind], len(words.features[kind])))
                spread = np.repeat(error, sizes, axis=0)
                for j in range(k):
                    slope = np.bincount(words.features[kind], spread[:, j], minlength=BUCKETS) / 400
                    squares[kind][:, j] += slope**2
                    field.weights[kind][:, j] += rate * 0.2 * slope / np.sqrt(squares[kind][:, j])
            entry = field.entry(words.whole)
            for j in range(k):
                slope = np.bincount(entry, error[:, j], minlength=len(field.lexical)) / 400
                lexical_squares[:, j] += slope**2
                field.lexical[:, j] += rate * 0.2 * slope / np.sqrt(lexical_squares[:, j])
            slope = (seen - moves) / 400
            step_squares += slope**2
            field.steps += rate * slope / np.sqrt(step_squares)
    return field


def training_rows(docs: DataFrame, options: FitOptions = FitOptions(), keep: Column | None = None) -> list[tuple[str, str]]:
    """The bounded labelled sample; ``keep`` says which rows may be learned from."""
    own = docs.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("label"), F.col("text").alias("body"),
        F.coalesce(keep, F.lit(False)).alias("may") if keep is not None else F.lit(True).alias("may"),
    ).filter("may and id is not null and label is not null")
    narrow = own.select("label", "id", F.xxhash64("id").alias("h"))
    ranked = narrow.selectExpr("*", "row_number() over (partition by label order by h, id) as place")
    chosen = ranked.filter(F.col("place") <= options.per_language).select("label", "id", "h").distinct()
    at = F.lit(1) + F.pmod("h", F.greatest(F.char_length("body") - options.passage, F.lit(1)))
    passages = own.filter("body is not null").join(chosen, ["label", "id"]).select(
        "label", "id", "h", F.expr("body").substr(at.cast("int"), F.lit(options.passage)).alias("passage")
    )
    rows = passages.groupBy("label", "h", "id").agg(F.min("passage").alias("passage")).collect()
    return [(r["label"], r["passage"]) for r in sorted(rows, key=lambda r: (r["label"], r["h"], r["id"]))]


def language_column(docs: DataFrame, field: Field, text: str = "text") -> Column:
    """Struct of lang_pred, score, certainty and n_words for each whole text.

    ``score`` is the mean chance of the text's language over its words,
    ``certainty`` the mean of each word's own best chance: in a text that
    mixes languages the first is low and the second high. Null texts and
    texts without letters give ``und`` with score and certainty 0. Texts of
    any length are taken whole; a text is one row of work. Without any
    learned language everything is ``und``. Equal texts, repeated rows
    included, get equal values; of equally good languages the first by name is
    chosen. No other column of docs is looked at.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("lang_pred string, score double, certainty double, n_words long")
    def label(series: pd.Series) -> pd.DataFrame:
        model, texts = shipped.value, [t or "" for t in series]
        names, scores, certain, counts = [], [], [], []
        for part in chunks(texts):
            if not model.labels:
                n = len(texts[part])
                names += [UNDETERMINED] * n
                scores += [0.0] * n
                certain += [0.0] * n
                counts += [0] * n
                continue
            sums, own, n = model.predict(texts[part])
            best = sums.argmax(axis=1)
            names += [model.labels[b] if c else UNDETERMINED for b, c in zip(best, n)]
            scores += np.clip(sums[np.arange(len(n)), best] / np.maximum(n, 1), 0, 1).tolist()
            certain += np.clip(own / np.maximum(n, 1), 0, 1).tolist()
            counts += n.tolist()
        return pd.DataFrame({"lang_pred": names, "score": scores, "certainty": certain, "n_words": counts})

    return label.asNondeterministic()(F.col(text))


def spans_column(docs: DataFrame, field: Field, text: str = "text") -> Column:
    """Array of (first_word, n_words, lang, score): the runs of equally labelled words of each text, in order.

    Words are numbered from 0 over the whole text; a run does not go beyond a
    line. ``score`` is the mean chance of the run's language. Texts without
    letters, and null texts, have no runs; without any learned language no
    text has.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    def runs(words: Words, chance: np.ndarray, names: list[str], n: int) -> list[list[dict]]:
        found: list[list[dict]] = [[] for _ in range(n)]
        if not len(words.doc):
            return found
        best = chance.argmax(axis=1)
        changes = (np.diff(best) != 0) | (np.diff(words.doc) != 0) | (np.diff(words.line) != 0)
        bounds = np.concatenate(([0], np.flatnonzero(changes) + 1, [len(best)]))
        origin = np.searchsorted(words.doc, np.arange(n))
        for first, last in zip(bounds[:-1], bounds[1:]):
            doc, label = words.doc[first], best[first]
            score = float(chance[first:last, label].mean())
            found[doc].append({"first_word": int(first - origin[doc]), "n_words": int(last - first), "lang": names[label], "score": score})
        return found

    @F.pandas_udf("array<struct<first_word: long, n_words: long, lang: string, score: double>>")
    def spans(series: pd.Series) -> pd.Series:
        model, texts = shipped.value, [t or "" for t in series]
        if not model.labels:
            return pd.Series([[] for _ in texts], dtype=object)
        return pd.Series([s for part in chunks(texts) for s in runs(*model.word_chances(texts[part]), model.labels, len(texts[part]))], dtype=object)

    return spans.asNondeterministic()(F.col(text))
