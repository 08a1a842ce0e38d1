"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its distinct lower-cased words and their beginnings, the latter once for each of the first few words
that share one, as several forms of a stem tell more than one. Terms are hashed into a fixed number of places, and
a text's places count less the more it has, so that long texts are not told by their length. The machine gives a weight to each place and, through
a short vector for each place, to every pair of places, so that an insult beside the mention of a group can count for more
than the sum of both. It is trained in numpy on a bounded sample of labelled rows; scoring runs in Arrow batches where the rows are.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosided.llm.common import col, fold, table, text_of
from twosided.session import materialise

#: Labelled rows that are learned from at most, those with the smallest hashes of their ids.
MAX_TRAIN_ROWS = 20_000
#: Places of the hash table (so the broadcast model has at most PLACES * (FACTORS + 1) numbers) and length of a pair vector.
PLACES, FACTORS = 1 << 18, 4
#: A place counts if so many of the texts that are learned from have it, however toxic these are: a pair may tell what neither
#: of its places does.
MIN_TEXTS = 4
#: Length of the word beginnings that are terms of their own, and up to how many words of a beginning make a term each.
BEGINNING, FORMS = 4, 3
#: Rounds, texts of a batch, step, and the shrinkage of weights and of pair vectors.
EPOCHS, BATCH, RATE, SHRINK, SHRINK_PAIRS = 20, 64, 0.3, 3e-4, 1e-3
#: Spread of the first pair vectors, and first sums of squared changes.
INIT, SQUARES = 0.05, 1e-2
#: Places of a text up to which they count almost fully.
SHORT = 20
#: One text in so many fits the curve from margins to probabilities, whose slope is drawn towards 1 by a slight penalty.
CALIBRATING, CALIBRATION_SHRINK = 3, 0.1
_CACHED_STRINGS, _CACHED_CHARS = 300_000, 48
_WORD = regex.compile(r"[\p{L}\p{M}]+")


def _form(beginning: int, number: int) -> int:
    """The place of the so-manieth word of a beginning, given by its hash."""
    return (beginning * 31 + number * 0x9E3779B1) % 0xFFFFFFFB % PLACES


class Hasher:
    """Places of the terms of texts; strings between white space are looked up in a bounded cache."""

    def __init__(self, wanted: set[int] | None = None):
        self.wanted, self.known = wanted, {}

    def _string(self, string: str) -> tuple[tuple[int, int], ...]:
        """The hash of each word of a string and that of its beginning, or -1; words of which no place is wanted are left out."""
        found = self.known.get(string)
        if found is None:
            pairs = {(zlib.crc32(w.encode("utf-8", "surrogatepass")),
                      zlib.crc32(f"{w[:BEGINNING]}*".encode("utf-8", "surrogatepass")) if len(w) > BEGINNING else -1) for w in _WORD.findall(string)}
            if self.wanted is not None:
                pairs = {(w, b) for w, b in pairs if w % PLACES in self.wanted or b >= 0 and any(
                    _form(b, n) in self.wanted for n in range(1, FORMS + 1))}
            found = tuple(pairs)
            if len(string) <= _CACHED_CHARS:
                if len(self.known) >= _CACHED_STRINGS:
                    self.known.clear()
                self.known[string] = found
        return found

    def places(self, text: str | None) -> np.ndarray:
        """The places of a text, each once, in ascending order; no words, no places."""
        words = set(chain.from_iterable(map(self._string, set((text or "").lower().split()))))
        found = {w % PLACES for w, _ in words}
        for beginning, forms in Counter(b for _, b in words if b >= 0).items():
            found.update(_form(beginning, n) for n in range(1, min(forms, FORMS) + 1))
        if self.wanted is not None:
            found &= self.wanted
        return np.array(sorted(found), np.int32)


@dataclass(frozen=True)
class Machine:
    """The bias, and for each place that was learned its weight and its pair vector; others count nothing.

    ``slope`` and ``offset`` turn margins into log odds.
    """

    bias: float
    places: np.ndarray
    rows: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, places: np.ndarray) -> float:
        """The bias, the weights of the places of a text and the products of all pairs of their vectors."""
        rows = self.rows[_found(self.places, places)]
        rows = rows * _scale(len(rows))
        vectors = rows[:, 1:]
        pairs = 0.5 * ((vectors.sum(axis=0) ** 2).sum() - (vectors**2).sum())
        return float(np.clip(self.bias + rows[:, 0].sum() + pairs, -30, 30))

    def score(self, places: np.ndarray) -> float:
        """The probability of label 1 for the places of a text; none that was learned gives the bias alone."""
        return 1 / (1 + math.exp(-self.slope * self.margin(places) - self.offset))


def _scale(sizes):
    """What each place of a text of so many places counts."""
    return (1 + sizes / SHORT) ** -0.5


def _found(known: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Where in ``known`` the places are that it holds; both ascend."""
    at = np.searchsorted(known, places)
    at, places = at[at < len(known)], places[at < len(known)]
    return at[known[at] == places]


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """A machine whose margins are turned into probabilities by texts that a machine of its kind was not trained on.

    The machine knows the texts that it is trained on better than others, so its own margins there are too sure. One part in
    ``CALIBRATING`` of the texts is left out of a first training, and slope and offset are fitted to its margins and labels. The
    machine itself is trained on all texts.
    """
    machine = _trained(texts, labels, np.random.default_rng(seed))
    if not len(machine.places):
        return machine
    order = np.random.default_rng(seed).permutation(len(texts))
    apart, rest = order[::CALIBRATING], np.setdiff1d(order, order[::CALIBRATING])
    first = _trained([texts[i] for i in rest], labels[rest], np.random.default_rng(seed))
    slope, offset = _calibrated(np.array([first.margin(texts[i]) for i in apart]), labels[apart])
    return replace(machine, slope=slope, offset=offset)


def _calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, by Newton steps; a slight penalty keeps it from a slope without end.

    The slope is at least 1: labels that no text explains would flatten the curve and hide pairs that do tell.
    """
    x = np.stack([margins, np.ones(len(margins))], axis=1)

    def best(at: np.ndarray, free: list[int]) -> np.ndarray:
        for _ in range(100):
            share = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            change = x.T @ (share - labels) + CALIBRATION_SHRINK * (at - [1, 0])
            curve = (x * (share * (1 - share))[:, None]).T @ x + CALIBRATION_SHRINK * np.eye(2)
            step = np.linalg.solve(curve[np.ix_(free, free)], change[free])
            at = at.copy()
            at[free] -= step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-9:
                break
        return at

    found = best(np.array([1.0, 0.0]), [0, 1])
    if found[0] < 1:
        found = best(np.array([1.0, 0.0]), [1])
    return float(found[0]), float(found[1])


def _trained(texts: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> Machine:
    """A machine by Adagrad on the log loss, in batches, with weights shrunk towards zero.

    With no text, or labels of one kind only, the machine is the smoothed share of label 1 and has no weights.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    bias = math.log(share / (1 - share))
    if not len(labels) or labels.min() == labels.max():
        return Machine(bias, np.empty(0, np.int32), np.empty((0, FACTORS + 1)))
    seen = np.bincount(np.concatenate(texts), minlength=PLACES)
    learned = np.flatnonzero(seen >= MIN_TEXTS).astype(np.int32)
    texts = [_found(learned, x) for x in texts]
    rows = np.zeros((len(learned), FACTORS + 1))
    rows[:, 1:] = rng.normal(0, INIT, (len(learned), FACTORS))
    squares, bias_square = np.full(rows.shape, SQUARES), SQUARES
    shrink = np.array([SHRINK, *[SHRINK_PAIRS] * FACTORS])
    met, local, last, step = np.zeros(len(rows), bool), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            sizes = np.array([len(texts[i]) for i in chosen])
            at, text = np.concatenate([texts[i] for i in chosen]), np.repeat(np.arange(len(chosen)), sizes)
            # Only places of the batch are worked on; those that were left alone since are shrunk by all steps at once.
            met[at] = True
            places = np.flatnonzero(met)
            met[places], local[places] = False, np.arange(len(places))
            at, past = local[at], squares[places]
            held = rows[places] * np.exp((last[places] - step)[:, None] * (RATE * shrink / np.sqrt(past)))
            scale = _scale(sizes)[text]
            scaled = held[at] * scale[:, None]
            sums, square, filled = np.zeros((len(chosen), FACTORS + 1)), np.zeros(len(chosen)), np.flatnonzero(sizes)
            if len(filled):
                starts = (np.cumsum(sizes) - sizes)[filled]
                sums[filled] = np.add.reduceat(scaled, starts, axis=0)
                square[filled] = np.add.reduceat(np.einsum("ij,ij->i", scaled[:, 1:], scaled[:, 1:]), starts)
            margin = np.clip(bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - square), -30, 30)
            slope = (1 / (1 + np.exp(-margin)) - labels[chosen]) / len(chosen)
            each = slope[text] * scale
            parts = sums[text] - scaled
            parts[:, 0] = 1
            parts = np.ascontiguousarray((parts * each[:, None]).T)
            change = np.stack([np.bincount(at, part, len(places)) for part in parts], axis=1) + shrink * held
            past = past + change**2
            squares[places], rows[places], last[places] = past, held - RATE * change / np.sqrt(past), step + 1
            step += 1
            bias_square += slope.sum() ** 2
            bias -= RATE * slope.sum() / bias_square**0.5
    rows *= np.exp((last - step)[:, None] * (RATE * shrink / np.sqrt(squares)))
    return Machine(float(bias), learned, rows)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
          max_rows: int = MAX_TRAIN_ROWS, held_out: int = 0) -> Machine:
    """A machine from the labelled rows of ``docs`` outside the held-out fold (crc32 of the id modulo 5).

    The sample is the ``max_rows`` ids with the smallest hashes, so it does not depend on row order. Ids and labels that are
    null are left out, an id labelled twice is toxic if one of its labels is 1, and each text of a repeated id counts. One
    task learns from the places of the sampled texts, and only the machine reaches the driver.
    """
    usable = labels.filter(col(id_col).isNotNull() & col(label_col).isNotNull() & (fold(id_col) != held_out))
    by_id = usable.groupBy(col(id_col).alias("labelled_id")).agg(F.max((col(label_col) == 1).cast("int")).alias("label"))
    present = docs.select(col(id_col).alias("labelled_id")).distinct()
    sample = by_id.join(present, "labelled_id", "left_semi").orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(max_rows)
    chosen = docs.sparkSession.createDataFrame(sample.collect(), sample.schema)

    @F.pandas_udf("array<int>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher = Hasher()
        for texts in batches:
            yield texts.map(hasher.places)

    # At most max_rows pairs of an id and a label are broadcast, and only the texts of these meet in the one task that learns.
    rows = docs.join(F.broadcast(chosen), col(id_col) == F.col("labelled_id")).select("labelled_id", "label", hashed(text_of(text_col)).alias("places"))
    rows = materialise(rows, "labelled_places")

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += [x.values.to_numpy() for x in batch.column("places")]
            labels.append(batch.column("label").to_numpy())
        machine = fit(texts, np.concatenate([*labels, np.empty(0, np.int32)]))
        yield pa.RecordBatch.from_pylist([{"bias": machine.bias, "slope": machine.slope, "offset": machine.offset, "places": machine.places.tobytes(),
                                           "weights": machine.rows.tobytes()}])

    ordered = rows.repartition(1).sortWithinPartitions("labelled_id", "places")
    found = materialise(ordered.mapInArrow(learned, "bias double, slope double, offset double, places binary, weights binary"), "machine").first()
    if found is None:
        return fit([], np.empty(0, np.int32))
    return Machine(found.bias, np.frombuffer(found.places, np.int32), np.frombuffer(found.weights).reshape(-1, FACTORS + 1), found.slope, found.offset)


def score(docs: DataFrame, text_col: str, machine: Machine, score_col: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic; a null or empty text gets the machine's bias.

    A column called like ``score_col`` is replaced; rows and other columns stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = shared.value
        hasher = Hasher(set(machine.places.tolist()))
        for texts in batches:
            yield pd.Series([machine.score(hasher.places(x)) for x in texts], dtype="float64")

    return docs.withColumn(score_col, scored(text_of(text_col)))


def trained_on(spark, docs: DataFrame, sf_dir: str) -> Machine:
    """A machine from the labels table beside ``docs``; labels, language, source and id are no inputs of a score."""
    return train(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
