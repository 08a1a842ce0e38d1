"""Periodic runs of words by longest common extensions over a difference-cover sample.

A run is a maximal stretch of consecutive words with a smallest period q, long enough to count. Every run of at least three periods
holds two neighbours of the grid 0, q, 2q, ...: for each q the words after and before two neighbours are compared, and the
stretch where they agree is the run. The grids of all periods together have n ln n places, so all of them are looked at.

How far two suffixes agree is told by a sample: only suffixes at places whose remainder modulo 31 lies in a difference
cover are sorted. For any two places, at most 30 words further on, the same for both, lie two sampled ones. Those few words are compared
one by one; from there on the answer is the least common prefix between two sampled suffixes in their order, by a sparse table.

Documents are taken together, each ended by a word of its own that no run can pass, so that one sort and one set of matrix operations
serves many short texts. A long document is a batch of its own; the memory of a batch grows with its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from twosided.llm.common import col, text_of

#: Residues modulo ``MODULUS`` that every difference of two residues occurs between: fixed values of a perfect difference set.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Least words and least periods of a run that counts.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Words from which a batch is closed, and pairs of grid places that are compared at once.
BATCH_WORDS, BATCH_PAIRS = 1 << 17, 1 << 20

#: For each difference, a residue of the cover that has another one so far behind it.
_MEET = np.array([next(a for a in COVER if (a + d) % MODULUS in COVER) for d in range(MODULUS)])


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


class Extensions:
    """Longest common extensions of a sequence of word numbers, which must end with a word that occurs once."""

    def __init__(self, words: np.ndarray):
        self.words = words = np.ascontiguousarray(words, np.int64)
        n = len(words)
        # Sampled places by residue, so that the place MODULUS words on is the next one.
        places = [np.arange(r, n, MODULUS) for r in COVER]
        self.places = np.concatenate(places)
        if not len(self.places):
            return
        self.offset = np.zeros(MODULUS, np.int64)
        self.offset[list(COVER)] = np.cumsum([0, *map(len, places)])[:-1]
        padded = np.concatenate([words + 1, np.zeros(MODULUS, np.int64)])
        blocks = np.lib.stride_tricks.sliding_window_view(padded, MODULUS)[self.places]
        if words.max(initial=0) >= 2**32 - 2:
            raise ValueError("too many different words")
        rank = _ranks(np.ascontiguousarray(blocks.astype(">u4")).view(f"V{4 * MODULUS}").reshape(-1))
        levels, step = [rank], 1
        after = np.arange(len(rank))
        last = np.repeat(np.cumsum([len(p) for p in places]), [len(p) for p in places])  # the end of a place's residue
        while rank.max() + 1 < len(rank):
            ahead = after + step
            follow = np.where(ahead < last, rank[np.minimum(ahead, len(rank) - 1)] + 1, 0)
            rank = _ranks(rank * (len(rank) + 1) + follow)
            levels.append(rank)
            step *= 2
        self.rank = rank
        order = np.empty(len(rank), np.int64)
        order[rank] = after
        self.table = self._table(self._common(order[:-1], order[1:], levels, last))

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray], last: np.ndarray) -> np.ndarray:
        """The common prefix of sampled suffixes, in words, by the ranks of their beginnings, longest first."""
        end_a, end_b, words = last[a], last[b], np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero((a < end_a) & (b < end_b))
            inside = inside[levels[level][a[inside]] == levels[level][b[inside]]]
            a, b = a.copy(), b.copy()
            a[inside] += 1 << level
            b[inside] += 1 << level
            words[inside] += MODULUS << level
        # Where a residue ends, fewer than MODULUS words are left, and the last word of all occurs once.
        i, j = self._word_at(a, end_a), self._word_at(b, end_b)
        return words + self._compare(i, j, np.full(len(i), MODULUS))[0]

    def _word_at(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The word's place of a sampled place, also of the one after a residue's last."""
        inside = at < end
        return np.where(inside, self.places[np.minimum(at, len(self.places) - 1)], self.places[end - 1] + MODULUS * (at - end + 1))

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the next ``most`` words agree, and whether all of them do."""
        n, agreed, going = len(self.words), np.zeros(len(i), np.int64), np.arange(len(i))
        for t in range(MODULUS):
            going = going[most[going] > t]
            x, y = i[going] + t, j[going] + t
            there = (x < n) & (y < n)
            going = going[there][self.words[x[there]] == self.words[y[there]]]
            if not len(going):
                break
            agreed[going] += 1
        return agreed, agreed == most

    @staticmethod
    def _table(common: np.ndarray) -> list[np.ndarray]:
        table = [common]
        while len(table[-1]) > 1 << len(table) - 1:
            half = 1 << len(table) - 1
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from the places ``i`` and ``j`` on; the two of a pair differ, and the end agrees with none."""
        found = np.zeros(len(i), np.int64)
        n = len(self.words)
        start = np.flatnonzero((i < n) & (j < n))
        start = start[self.words[i[start]] == self.words[j[start]]]
        i, j = i[start], j[start]
        ahead = (_MEET[(j - i) % MODULUS] - i) % MODULUS
        agreed, all_agree = self._compare(i, j, ahead)
        rest = np.flatnonzero(all_agree)
        x, y = i[rest] + ahead[rest], j[rest] + ahead[rest]
        there = (x < n) & (y < n)
        rest, x, y = rest[there], x[there], y[there]
        if len(rest):
            a = self.rank[self.offset[x % MODULUS] + x // MODULUS]
            b = self.rank[self.offset[y % MODULUS] + y // MODULUS]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(float))[1] - 1  # the largest power of two within
            least = np.empty(len(rest), np.int64)
            for k in np.unique(level):
                of = level == k
                row = self.table[k]
                least[of] = np.minimum(row[low[of]], row[high[of] - (1 << k)])
            agreed[rest] += least
        found[start] = agreed
        return found


def runs_of(words: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """For each document the rows ``(start, length, period)`` of its runs, by start and then period.

    ``words`` are the numbers of all documents' words, one document after the other.
    """
    if not len(sizes):
        return []
    ends, most = np.cumsum(sizes + 1), int(words.max(initial=-1)) + 1
    joined = np.empty(len(words) + len(sizes), np.int64)
    stops = ends - 1
    inner = np.ones(len(joined), bool)
    inner[stops] = False
    joined[inner], joined[stops] = words, most + np.arange(len(sizes))
    starts, total = ends - sizes - 1, len(joined)
    forward, backward = Extensions(joined), None
    found: list[tuple] = []
    for place, period, doc in _pairs(starts, sizes):
        ahead = forward.forward(place, place + period)
        hit = np.flatnonzero(ahead >= period)  # of three periods at least two follow the run's first grid place
        if not len(hit):
            continue
        if backward is None:  # the reversed sequence needs an end of its own as well
            backward = Extensions(np.concatenate([joined[::-1], [most + len(sizes)]]))
        place, period, doc, ahead = place[hit], period[hit], doc[hit], ahead[hit]
        behind = backward.forward(total - place, total - place - period)
        length = behind + period + ahead
        # Only the run's first grid place has less than a period of it behind.
        keep = (behind < period) & (length >= np.maximum(MIN_WORDS, MIN_PERIODS * period))
        found.append((doc[keep], (place - behind - starts[doc])[keep], length[keep], period[keep]))
    doc, start, length, period = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 4
    order = np.lexsort((period, length, start, doc))
    doc, start, length, period = doc[order], start[order], length[order], period[order]
    # A multiple of the smallest period has the same run.
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    doc, rows = doc[first], np.stack([start[first], length[first], period[first]], axis=1)
    order = np.lexsort((rows[:, 2], rows[:, 0], doc))
    return np.split(rows[order], np.searchsorted(doc[order], np.arange(1, len(sizes))))


def _pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(place, period, document)`` of all neighbours of the grids, a bounded number at once or those of one period."""
    parts, held = [], 0
    longest = sizes // MIN_PERIODS
    by_size = np.argsort(-longest, kind="stable")
    ascending = longest[by_size][::-1]
    for period in range(1, int(longest.max(initial=0)) + 1):
        docs = by_size[: len(ascending) - np.searchsorted(ascending, period)]
        counts = (sizes[docs] - 1) // period
        doc = np.repeat(docs, counts)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        parts.append((starts[doc] + number * period, np.full(len(doc), period), doc))
        held += len(doc)
        if held >= BATCH_PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
            parts, held = [], 0
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def strongest(runs: np.ndarray) -> list[int] | None:
    """The run of the greatest length divided by period; of equal ones the first, then that of the smallest period."""
    if not len(runs):
        return None
    return min(runs.tolist(), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def kept(runs: np.ndarray, size: int) -> np.ndarray:
    """Which words stay when each run keeps its first period only."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:size] == 0


RUN = StructType([StructField(x, LongType()) for x in ("start", "length", "period")])
FOUND = StructType([StructField("runs", ArrayType(RUN)), StructField("strongest", RUN), StructField("collapsed", StringType())])
_RUN = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _described(texts: list[bytes]) -> pa.StructArray:
    """Runs, the strongest one and the collapsed text of each text."""
    numbers, split = _Numbers(), [text.split() for text in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    words = np.fromiter((numbers[w] for x in split for w in x), np.int64, int(sizes.sum()))
    runs = runs_of(words, sizes)
    collapsed = []
    for all_words, found in zip(split, runs, strict=True):
        if len(found):
            stays = kept(found, len(all_words))
            all_words = [w for w, stay in zip(all_words, stays.tolist(), strict=True) if stay]
        collapsed.append(b" ".join(all_words))
    table = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in runs])]).astype(np.int32)
    listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(table[:, k])) for k in range(3)], fields=list(_RUN)))
    best = pa.array([None if (b := strongest(x)) is None else dict(zip(("start", "length", "period"), b, strict=True)) for x in runs], _RUN)
    return pa.StructArray.from_arrays([listed, best, pa.array(collapsed, pa.binary()).view(pa.string())], ["runs", "strongest", "collapsed"])


def _find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        parts, texts, held = [], [], 0
        for value in batch:
            text = value.as_py()
            texts.append(text)
            held += len(text) // 6 + 1
            if held >= BATCH_WORDS:
                parts.append(_described(texts))
                texts, held = [], 0
        if texts or not parts:
            parts.append(_described(texts))
        yield pa.concat_arrays(parts)


def find_runs(df: DataFrame, text_col: str, found_col: str = "found") -> DataFrame:
    """``df`` with a struct of each text's ``runs`` (start, length, period), the ``strongest`` of them and the ``collapsed`` text.

    Words are what stands between ASCII white space and are numbered from 0; a null, empty or blank text has none, no runs, a null strongest run
    and an empty collapsed text. The collapsed text holds, joined by single spaces, the words that no run contains after its first
    period. Rows are treated alone: repeated rows give repeated results, no rows give none, other columns stay and one
    called like ``found_col`` is replaced.
    """
    return df.withColumn(found_col, F.arrow_udf(_find, FOUND)(text_of(text_col).cast("binary")))


def planted(text: bytes, h: int) -> bytes:
    """``text`` with a period from a place and of a length that the checksum ``h`` gives, where ``h % 10`` is 0; else as it is.

    With g = h // 10 and n words, each word i from a = g % n on becomes the word a + (i - a) % p, where p = 1 + (n - a) // (3 + g % 8).
    """
    words = text.split() if h % 10 == 0 else []
    if not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])


def _plant(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, checksums in batches:
        yield pa.array((planted(text, h) for text, h in zip(texts.to_pylist(), checksums.to_pylist(), strict=True)), pa.binary())


def with_planted_period(text_col: str, key_col: str) -> Column:
    """The texts with a period :func:`planted` in every tenth, by the crc32 of the key as text; a null key counts as the empty text."""
    key = F.coalesce(col(key_col).cast("string"), F.lit("")).cast("binary")
    return F.arrow_udf(_plant, "binary")(text_of(text_col).cast("binary"), F.crc32(key)).cast("string")
