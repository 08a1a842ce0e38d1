"""Byte-pair encoding of whole texts with a given vocabulary file, and decoding of the ids.

The vocabulary is a ``tokenizers`` JSON file with word ends, lower case and dropped white space. It is read on the
driver, its size is checked, and the file's bytes are broadcast; each Python worker parses them once. A word is encoded on
contiguous arrays: the parts between its boundaries and the ranks of adjacent parts. The smallest rank is looked for
again and again, the boundary there is deleted, and the neighbouring ranks are refreshed. Words above ``SHORT_WORD``
parts use a heap over linked parts instead, which merges in the same order without the quadratic scan.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from array import array
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twosided.llm.common import fresh, text_of

#: Parts of a word up to which the arrays are scanned.
SHORT_WORD = 64
#: Entries of each of a worker's two generations of cached strings (the older one is dropped when the younger is full),
#: and the longest string that is kept.
CACHE_ENTRIES, CACHE_CHARS = 150_000, 48
#: Bits of a token id; a merge is held as its rank and the id that it makes.
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
#: Bytes of a vocabulary file that may be broadcast.
MAX_VOCABULARY_BYTES = 64 << 20

# The file's normaliser and splitting pattern, in the order in which they are applied: fixed values.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = regex.compile(f"[{WHITE}]+")
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+")
WORD_END = "</w>"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes for themselves, the rest from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Ids, tokens and merge ranks of one vocabulary file, with caches of encoded words."""

    def __init__(self, content: bytes):
        parsed = json.loads(content)
        ids = parsed["model"]["vocab"]
        self.tokens = {i: token for token, i in ids.items()}
        self.special = {x["content"]: x["id"] for x in parsed["added_tokens"]}
        self.tokens |= {i: token for token, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.inner = [ids[letter] for letter in byte_letters()]
        self.final = [ids[letter + WORD_END] for letter in byte_letters()]
        self.merges = {}
        for rank, merge in enumerate(parsed["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[ids[left] << ID_BITS | ids[right]] = rank << ID_BITS | ids[left + right]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _scan(self, parts: list[int]) -> list[int]:
        rank_of, none = self.merges.get, len(self.merges) << ID_BITS
        ranks = [rank_of(a << ID_BITS | b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            lowest = min(ranks)
            if lowest == none:
                break
            i = ranks.index(lowest)
            parts[i] = new = lowest & ID_MASK
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(new << ID_BITS | parts[i + 1], none)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << ID_BITS | new, none)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        end, merges = len(parts), self.merges
        after, before, alive = list(range(1, end + 1)), list(range(-1, end - 1)), [True] * end

        def pair(i: int) -> int:
            return parts[i] << ID_BITS | parts[after[i]]

        waiting = [(merges[pair(i)], i, pair(i)) for i in range(end - 1) if pair(i) in merges]
        heapq.heapify(waiting)
        while waiting:
            merge, i, merged = heapq.heappop(waiting)
            if not alive[i] or after[i] >= end or pair(i) != merged:
                continue
            gone = after[i]
            parts[i], alive[gone], after[i] = merge & ID_MASK, False, after[gone]
            if after[i] < end:
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and after[j] < end and pair(j) in merges:
                    heapq.heappush(waiting, (merges[pair(j)], j, pair(j)))
        return [part for part, live in zip(parts, alive, strict=True) if live]

    def _word(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        parts = [self.inner[b] for b in raw]
        parts[-1] = self.final[raw[-1]]
        merged = self._scan(parts) if len(parts) <= SHORT_WORD else self._heap(parts)
        return array("I", merged).tobytes() if sys.byteorder == "little" else np.array(merged, "<u4").tobytes()

    def _plain(self, chunk: str) -> bytes:
        if not chunk.isascii():
            # Lower case is taken letter by letter, so a final sigma is not told from others.
            chunk = unicodedata.normalize("NFC", chunk).replace("\u03a3", "\u03c3")
        low = chunk.lower()
        if low.isalpha():
            return self.chunk(low) if low != chunk else self._word(low)
        pieces = PIECE.findall(low)
        return b"".join(map(self.chunk, pieces)) if pieces != [chunk] else self._word(chunk)

    def chunk(self, chunk: str) -> bytes:
        """Ids of a stretch of text without white space, little-endian unsigned 32-bit integers."""
        found = self.known.get(chunk)
        if found is None:
            found = self.older.get(chunk)
            if found is None:
                if "<" in chunk and self.split_special:
                    found = b"".join(
                        np.array([self.special[x]], "<u4").tobytes() if x in self.special else self._plain(x)
                        for x in self.split_special.split(chunk)
                    )
                else:
                    found = self._plain(chunk)
            if len(chunk) <= CACHE_CHARS:
                if len(self.known) >= CACHE_ENTRIES:
                    self.older, self.known = self.known, {}
                self.known[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        # split() also breaks at the four separators 0x1C to 0x1F, which are no white space to the vocabulary's pattern.
        chunks = SPACE.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        return b"".join(map(self.chunk, chunks))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def _broadcast(spark: SparkSession, path: str):
    with open(path, "rb") as file:
        content = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(content)


def encode(df: DataFrame, text_col: str, path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` and a binary column of token ids, little-endian unsigned 32-bit integers.

    White space is dropped, letters are lower-cased, special tokens inside a text get their own id and none is added.
    A null or empty text gives no ids. Rows, their order within a partition and other columns stay as they are; a
    column called like ``ids_col`` is replaced.
    """
    shared = _broadcast(df.sparkSession, path)

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        return texts.map(_vocabulary(shared.value).encode)

    return df.withColumn(ids_col, encoded(text_of(text_col)))


def decode(df: DataFrame, ids_col: str, path: str, decoded_col: str = "decoded") -> DataFrame:
    """``df`` and the text of its token ids: all tokens, special ones too, joined by single spaces.

    Null or empty ids give the empty text; an id that the vocabulary lacks is an error.
    """
    shared = _broadcast(df.sparkSession, path)

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        return ids.map(_vocabulary(shared.value).decode)

    return df.withColumn(decoded_col, decoded(F.coalesce(F.col(ids_col), F.lit(b""))))


def digests(df: DataFrame, text_col: str, path: str) -> DataFrame:
    """``df`` with ``n_tokens`` and the SHA-256 of the ids' bytes and of the decoded text; columns so called are replaced.

    Ids and decoded text are digested where they are made, so no batch holds those of more than one text.
    """
    shared = _broadcast(df.sparkSession, path)

    @F.pandas_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    def digested(texts: pd.Series) -> pd.DataFrame:
        vocabulary, rows = _vocabulary(shared.value), []
        for text in texts:
            ids = vocabulary.encode(text)
            decoded = vocabulary.decode(ids).encode("utf-8", "surrogatepass")
            rows.append((len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    (place,) = fresh(df, "digests")
    found = df.withColumn(place, digested(text_of(text_col)))
    return found.withColumns({x: F.col(f"{place}.{x}") for x in ("n_tokens", "ids_sha256", "decoded_sha256")}).drop(place)
