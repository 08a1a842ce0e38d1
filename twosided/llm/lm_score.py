"""Scores of whole texts by a log-bilinear language model.

The context of a token is the last ``CONTEXT`` tokens. Their vectors, each scaled by a vector for its distance, add up to a
prediction whose products with the output vectors, and biases, are the scores of the next token. The model is trained in numpy
by noise-contrastive estimation, with noise from the token frequencies, and normalised when it scores: a score is a sum over the places of
a context, so its exponential is a product of rows of one table for each distance, made once for a task by matrix products.

The outputs are the end of a text, the most frequent words and one class for all other words, in which a word has its
smoothed share; so probabilities sum to 1 over all known words and one unknown. Rare words of a context share vectors by
the hash of their last letters.

Every training text counts: token counts come from all of them, and each partition trains a copy of the model on all its texts;
the copies are averaged by an aggregate, weighted by their tokens. Counts grow with the corpus and stay in a table. The counts of
at most ``HEAD`` frequent words are broadcast; rarer words of each text are joined with the table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosided.llm.common import col, fold, text_of
from twosided.session import materialise

#: Tokens of a context, length of a vector, outputs (the end, words, and the class of other words).
CONTEXT, WIDTH, OUTPUTS = 3, 16, 512
#: Places that rare words of a context share, and the letters at a word's end that choose one.
SHARED, LETTERS = 1024, 3
#: Words whose counts are broadcast at most.
HEAD = 1 << 17
#: Noise tokens for a batch, tokens of a batch, tokens that are shuffled together, and the step of Adagrad.
NOISE, BATCH, SHUFFLED, RATE = 32, 1024, 1 << 16, 0.1
#: Different words that a task counts before it passes them on, tokens that are scored at once, and up to which size scores are multiplied as exponentials.
COUNTED, SCORED, LARGEST = 200_000, 256, 80
#: Characters of texts whose words are looked up together.
PLACED = 1 << 22
#: The end of a text as a token; no word is empty.
END = b""


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at ASCII blanks."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def letters_of(word: bytes) -> int:
    """The place that a rare word shares with all of the same last letters."""
    return zlib.crc32(word[-LETTERS:]) % SHARED


def _together(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """The texts in lists of about ``PLACED`` characters; a longer text is alone or the last of a list."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= PLACED:
            yield held
            held, size = [], 0
    if held:
        yield held


def _words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as :func:`words_of` gives them, and the number of the text that each is from."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    words, owner = split.flatten().cast(pa.large_binary()), pc.list_parent_indices(split).to_numpy()
    told = pc.greater(pc.binary_length(words), 0)  # there is an empty one beside a blank at an end
    return words.filter(told), owner[told.to_numpy(zero_copy_only=False)]


def token_counts(texts: DataFrame) -> DataFrame:
    """``(token, c)``: the tokens of a column ``text`` and how often each occurs, the end of each text included."""
    schema = pa.schema([("token", pa.binary()), ("c", pa.int64())])

    def batch(counted: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.binary()), pa.array(counted.values(), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for some in _together(text.as_py() for own in batches for text in own.column(0)):
            words, _ = _words(some)
            for word, n in zip(*(x.to_pylist() for x in words.value_counts().flatten()), strict=True):
                counted[word] += n
            counted[END] += len(some)
            if len(counted) >= COUNTED:
                yield batch(counted)
                counted = Counter()
        yield batch(counted)

    partial = texts.select("text").mapInArrow(count, "token binary, c long")
    return partial.groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Frequencies:
    """What all tasks know of the corpus: its size, and the frequent words with their counts, most frequent first."""

    tokens: int
    distinct: int
    head: list[bytes]
    counts: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame) -> Frequencies:
        total = counts.agg(F.sum("c"), F.count("*")).first()
        level = F.floor(F.log2("c") * 16).cast("int")  # a few hundred levels, however large the corpus is
        levels = dict(tuple(row) for row in counts.groupBy(level.alias("level")).count().collect())
        held, least = 0, max(levels, default=0) + 1
        for x in sorted(levels, reverse=True):
            if held + levels[x] > HEAD - 1:
                break
            held, least = held + levels[x], x
        rows = counts.filter((level >= least) | (F.col("token") == F.lit(END))).toArrow().to_pylist()
        known = {bytes(row["token"]): row["c"] for row in rows}
        words = sorted((x for x in known if x != END), key=lambda x: (-known[x], x))
        head = [END, *words]
        found = cls(total[0] or 0, total[1], head, np.array([known.get(x, 0) for x in head], np.int64))
        assert len(found.context)  # made here, once for all tasks
        return found

    @property
    def whole(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    @property
    def outputs(self) -> int:
        """Outputs that are tokens; the next one is the class of all others."""
        return min(len(self.head), OUTPUTS - 1)

    @property
    def rest(self) -> float:
        """The smoothed count of the class of other words."""
        return self.whole - float((self.counts[: self.outputs] + 0.5).sum())

    @cached_property
    def context(self) -> np.ndarray:
        """Places in the table of context vectors: outputs have their own, other words share those after them."""
        shared = [self.outputs + 1 + letters_of(word) for word in self.head[self.outputs :]]
        return np.concatenate([np.arange(self.outputs), np.array(shared, np.int64), np.arange(SHARED) + self.outputs + 1]).astype(np.int64)

    def shares(self) -> np.ndarray:
        shares = np.append(self.counts[: self.outputs] + 0.5, self.rest) / self.whole
        return shares / shares.sum()


class Places:
    """The place of each token: frequent words by rank, then shared places of rare words by their last letters."""

    def __init__(self, known: Frequencies):
        self.words, self.context = len(known.head), known.context
        self.head = pa.array(known.head, pa.large_binary())

    def of(self, words: list[bytes]) -> np.ndarray:
        """Places of the words and the end."""
        return np.append(self._of(pa.array(words, pa.large_binary()))[0], 0)

    def _of(self, words: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Places of the words, and the rare ones among them with their numbers."""
        found = pc.index_in(words, value_set=self.head)
        rare, at = words.filter(found.is_null()).to_pylist(), np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
        own = found.fill_null(0).to_numpy().astype(np.int64)
        own[at] = [self.words + letters_of(word) for word in rare]
        return own, rare, at

    def each(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """For each text the places of its words and the end, as :meth:`of` gives them, and the words that share a place."""
        for some in _together(texts):
            words, owner = _words(some)
            own, rare, at = self._of(words)
            ends = np.searchsorted(owner, np.arange(len(some) + 1))
            rares = np.searchsorted(at, ends)
            for i in range(len(some)):
                yield np.append(own[ends[i] : ends[i + 1]], 0), rare[rares[i] : rares[i + 1]]

    def contexts(self, places: np.ndarray) -> np.ndarray:
        """For each token the places of the tokens before it, nearest first, in the table of context vectors."""
        own = np.concatenate([np.zeros(CONTEXT, np.int64), self.context[places]])
        return np.stack([own[CONTEXT - i : len(own) - i] for i in range(1, CONTEXT + 1)], axis=1)


class Model:
    """Context vectors, distance vectors, output vectors and biases, as views of one flat array."""

    def __init__(self, flat: np.ndarray, outputs: int):
        sizes = [(outputs + 1 + SHARED, WIDTH), (CONTEXT, WIDTH), (outputs + 1, WIDTH), (outputs + 1,)]
        ends = np.cumsum([0, *(int(np.prod(x)) for x in sizes)])
        self.flat = flat
        self.inputs, self.distance, self.vectors, self.bias = (
            flat[a:b].reshape(x) for a, b, x in zip(ends, ends[1:], sizes, strict=False))

    @classmethod
    def start(cls, known: Frequencies) -> Model:
        size = (known.outputs + 1 + SHARED + CONTEXT + known.outputs + 1) * WIDTH + known.outputs + 1
        flat = np.random.default_rng(5).normal(0, 0.1, size).astype(np.float32)
        model = cls(flat, known.outputs)
        model.distance[:] = 1 / np.arange(1, CONTEXT + 1)[:, None]
        model.bias[:] = np.log(known.shares())
        return model

    def gradient(self, contexts: np.ndarray, wanted: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> np.ndarray:
        """The slope of the noise-contrastive loss of a batch, all of whose tokens are told from the same noise."""
        change = Model(np.zeros_like(self.flat), len(self.bias) - 1)
        near = self.inputs.take(contexts, axis=0)
        predicted = sum(near[:, i] * self.distance[i] for i in range(CONTEXT))
        own = self.vectors.take(wanted, axis=0)
        true = (predicted * own).sum(axis=1) + (self.bias - log_noise)[wanted]
        false = predicted @ self.vectors[noise].T
        false += (self.bias - log_noise)[noise]
        true = (-1 / (1 + np.exp(np.clip(true, -30, 30)))).astype(np.float32)
        np.clip(false, -30, 30, out=false)
        np.exp(np.negative(false, out=false), out=false)
        false += 1
        np.divide(1, false, out=false)
        slope = true[:, None] * own + false @ self.vectors[noise]
        np.add.at(change.vectors, noise, false.T @ predicted)
        np.add.at(change.bias, noise, false.sum(axis=0))
        change.bias += np.bincount(wanted, true, len(self.bias))
        change.vectors += _summed(wanted, true[:, None] * predicted, len(self.bias))
        for i in range(CONTEXT):
            change.distance[i] = (slope * near[:, i]).sum(axis=0)
        change.inputs[:] = _summed(contexts.ravel(), (slope[:, None, :] * self.distance).reshape(-1, WIDTH), len(self.inputs))
        return change.flat

    def tables(self) -> Tables:
        return Tables(self)

    def log10(self, contexts: np.ndarray, wanted: np.ndarray) -> float:
        """The sum of the normalised log10 probabilities of the wanted outputs; for many texts, make :meth:`tables` once."""
        return self.tables().log10(contexts, wanted)


class Tables:
    """For each distance the scores that each place of a context adds to each output, and their exponentials; the nearest hold the biases."""

    def __init__(self, model: Model):
        self.parts = [(model.inputs * x) @ model.vectors.T for x in model.distance]
        self.parts[0] += model.bias
        bounds = sum(max(x.max(), 0) for x in self.parts), sum(min(x.min(), 0) for x in self.parts)
        # Beyond these bounds single precision cannot hold the products.
        self.room = np.empty((2, SCORED, len(model.bias)), self.parts[0].dtype)
        self.powers = [np.exp(x) for x in self.parts] if max(bounds[0], -bounds[1]) <= LARGEST else None

    def log10(self, contexts: np.ndarray, wanted: np.ndarray) -> float:
        """The sum of the normalised log10 probabilities of the wanted outputs."""
        total = 0.0
        for start in range(0, len(wanted), SCORED):
            total += float(self._logs(contexts[start : start + SCORED].T, wanted[start : start + SCORED]).sum(dtype=float))
        return total / np.log(10)

    def _logs(self, contexts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The logarithms of the normalised probabilities of the wanted outputs, each after its context."""
        n, each = len(wanted), np.arange(len(wanted))
        if self.powers is None:
            scores = sum(x[i] for x, i in zip(self.parts, contexts, strict=True))
            scores -= scores.max(axis=1)[:, None]
            return scores[each, wanted] - np.log(np.exp(scores).sum(axis=1))
        product, row = self.room[:, :n]
        self.powers[0].take(contexts[0], axis=0, out=product, mode="clip")
        for x, i in zip(self.powers[1:-1], contexts[1:-1], strict=True):
            x.take(i, axis=0, out=row, mode="clip")
            product *= row
        self.powers[-1].take(contexts[-1], axis=0, out=row, mode="clip")
        return np.log(product[each, wanted] * row[each, wanted] / np.einsum("ij,ij->i", product, row))


def _summed(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the vectors that go to the same row."""
    return np.stack([np.bincount(rows, x, size) for x in np.ascontiguousarray(values.T, dtype=float)], axis=1)


def _train_texts(texts: Iterator[str | None], known: Frequencies, seed: int) -> tuple[Model, int]:
    """A copy of the start model trained once on all tokens of ``texts``, and their number."""
    places, model, rng = Places(known), Model.start(known), np.random.default_rng(seed)
    squares, shares = np.full(len(model.flat), 1e-2, np.float32), known.shares()
    room = np.empty_like(squares)
    log_noise, steps = np.log(NOISE * shares).astype(np.float32), np.cumsum(shares)
    seen, held, size = 0, [], 0

    def learn() -> None:
        contexts, wanted = (np.concatenate(x) for x in zip(*held, strict=True))
        order = rng.permutation(len(wanted))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            noise = np.minimum(np.searchsorted(steps, rng.random(NOISE)), known.outputs)
            # Noise of a batch stands for NOISE tokens of noise for each of its tokens.
            change = model.gradient(contexts[chosen], wanted[chosen], noise, log_noise)
            np.multiply(change, change, out=room)
            np.add(squares, room, out=squares)
            np.sqrt(squares, out=room)
            np.multiply(change, RATE, out=change)
            np.divide(change, room, out=change)
            np.subtract(model.flat, change, out=model.flat)

    for own, _ in places.each(texts):
        for start in range(0, len(own), SHUFFLED):  # a long text is cut only where it is learned from
            part = own[max(0, start - CONTEXT) : start + SHUFFLED]
            skip = min(start, CONTEXT)
            held.append((places.contexts(part)[skip:], np.minimum(part[skip:], known.outputs)))
            size += len(part) - skip
            if size >= SHUFFLED:
                learn()
                seen, held, size = seen + size, [], 0
    if held:
        learn()
    return model, seen + size


def train(texts: DataFrame, known: Frequencies) -> Model:
    """The mean of the copies that the partitions of ``texts`` train, weighted by their tokens.

    Only the mean, whose length does not depend on the corpus, reaches the driver. Without tokens it is the start model.
    """
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = _train_texts((x.as_py() for own in batches for x in own.column(0)), shared.value, 3)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([model.flat], pa.list_(pa.float32()))],
                                             names=["tokens", "flat"])

    trained = texts.select("text").mapInArrow(copies, "tokens long, flat array<float>")
    mean = trained.select("tokens", F.posexplode("flat").alias("place", "x")).groupBy("place").agg(
        (F.sum(F.col("x").cast("double") * F.col("tokens")) / F.sum("tokens")).alias("x")).toArrow().sort_by("place")
    start = Model.start(known)
    return Model(mean.column("x").to_numpy().astype(np.float32), known.outputs) if mean.num_rows else start


def score(docs: DataFrame, id_col: str, text_col: str, held_out: int = 1) -> DataFrame:
    """A row for each row of ``docs``, with scores by a model of the rows outside the held-out fold.

    ``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``. A null text counts as empty and has the end as its
    only token; a null id as the empty text when folds are dealt. Repeated rows count and are scored each. With no
    training rows every token is unknown. No rows give no rows.
    """
    rows = docs.select(col(id_col).alias("id"), (fold(id_col) == held_out).alias("held_out"), text_of(text_col).alias("text"))
    learned = rows.filter(~F.col("held_out"))
    counts = materialise(token_counts(learned), "token_counts")
    known = Frequencies.of(counts)
    model = train(learned, known)
    shared = docs.sparkSession.sparkContext.broadcast((known, model.flat))
    @F.pandas_udf("struct<n_tokens:long,n_known:long,base:double,score:double,rare:array<binary>>")
    def frequent(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, flat = shared.value
        places, tables = Places(known), Model(flat, known.outputs).tables()
        logs = np.log10(known.counts + 0.5)
        for texts in batches:
            yield pd.DataFrame([_score_words(own, rare, places, tables, known, logs) for own, rare in places.each(texts)])

    scored = materialise(rows.select("id", "held_out", F.monotonically_increasing_id().alias("row"), frequent("text").alias("s"))
                         .select("id", "held_out", "row", "s.*"), "frequent_scores")
    rare = scored.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(F.count("*").alias("n"))
    found = rare.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("found"))
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"))


def _score_words(own: np.ndarray, rare: list[bytes], places: Places, tables: Tables, known: Frequencies, logs: np.ndarray) -> dict:
    """Counts and scores of a text by its places, but for the log10 of the smoothed counts of its rare words, and these words."""
    frequent = own < places.words
    # The end is frequent, and known if there was any text to learn from.
    n_known = int((known.counts[own[frequent]] > 0).sum())
    base = logs[own[frequent]].sum() - len(own) * np.log10(known.whole)
    other = own >= known.outputs
    total = tables.log10(places.contexts(own), np.minimum(own, known.outputs))
    total += logs[own[other & frequent]].sum() - other.sum() * np.log10(known.rest)
    return {"n_tokens": len(own), "n_known": n_known, "base": float(base), "score": float(total), "rare": rare}
