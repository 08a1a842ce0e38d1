"""Ranked lexical search over pipelined term owners.

Terms are dealt to owners, rare ones first, so that the owners hold about equally many postings. Documents are numbered in slices. An
item's bundle for a slice carries the sums so far of the slice's documents that it has met, and nothing of the others. It visits one owner
after the other: each visit is a cogroup of the bundles with the postings of the owner's terms, which adds whole-number contributions. The
last owner, that of the most frequent terms, hands on only the best documents of a slice, and the best of all slices are the result.

Every item meets every posting of its terms: no document is left out before all of its terms are added. The rows of a slice and an item are at
most the slice's documents, and slices get smaller as items get more, so a group never outgrows its task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from twosided.llm.common import col, text_of
from twosided.session import materialise

#: Stages, each with the owner of a part of the terms.
OWNERS = 4
#: Documents of a slice at most, and documents times items.
SLICE_DOCS, SLICE_CELLS = 4096, 1 << 21
#: Bytes of items that are sent to the tasks at once; more items are answered in several passes.
PASS_BYTES = 4_000_000
#: Weights of the score, in whole numbers: fixed values.
SCALE, LEAST, LONG = 1_000_000_000, 25, 75

_SPACES = bytes(b for b in range(128) if not chr(b).isalnum())
_TERMS = bytes.maketrans(_SPACES + bytes(range(65, 91)), b" " * len(_SPACES) + bytes(range(97, 123)))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: stretches of ASCII letters, digits and all other characters, only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


@dataclass(frozen=True)
class Items:
    """The items of a pass: the number of each term, and for each term the items that hold it and how often."""

    numbers: dict[bytes, int]
    holders: list[tuple[np.ndarray, np.ndarray]]
    count: int

    @classmethod
    def of(cls, texts: list[str | None]) -> Items:
        numbers, held = {}, []
        for item, text in enumerate(texts):
            for term, times in Counter(terms(text)).items():
                if numbers.setdefault(term, len(held)) == len(held):
                    held.append(([], []))
                for part, value in zip(held[numbers[term]], (item, times), strict=True):
                    part.append(value)
        return cls(numbers, [(np.array(a, np.int64), np.array(b, np.int64)) for a, b in held], len(texts))


def _postings(docs: DataFrame, id_col: str, text_col: str, items: Items) -> DataFrame:
    """A row for each slice and term that items hold, and one with term -1 for each slice: its documents' ids and numbers of terms."""
    shared = docs.sparkSession.sparkContext.broadcast(items.numbers)
    most = max(1, min(SLICE_DOCS, SLICE_CELLS // max(items.count, 1)))
    slim = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = StructType([StructField("slice", LongType()), StructField("term", IntegerType()), StructField("docs", ArrayType(IntegerType())),
                         StructField("tfs", ArrayType(IntegerType())), StructField("ids", ArrayType(slim.schema["id"].dataType)),
                         StructField("ns", ArrayType(LongType()))])

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, get = TaskContext.get().partitionId() << 32, shared.value.get
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                yield _slice(number, part.column("id"), part.column("text"), get)
                number += 1

    return materialise(slim.mapInArrow(slices, schema), "postings")


def _slice(number: int, ids: pa.Array, texts: pa.Array, get) -> pa.RecordBatch:
    ns, found = [], []
    for text in texts:
        words = terms(text.as_py())
        ns.append(len(words))
        known = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        found.append(known[known >= 0])
    place = np.repeat(np.arange(len(found)), [len(x) for x in found])
    pairs, tfs = np.unique(np.concatenate([*found, []]).astype(np.int64) * len(found) + place, return_counts=True)
    term, doc = np.divmod(pairs, max(len(found), 1))
    different, first = np.unique(term, return_index=True)
    rows = len(different) + 1
    lists = np.concatenate([first, [len(doc)], [len(doc)]]).astype(np.int32)
    heads = np.array([0] * rows + [len(ns)], np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(rows, number)), pa.array(np.append(different, -1).astype(np.int32)),
        pa.ListArray.from_arrays(lists, pa.array(doc.astype(np.int32))), pa.ListArray.from_arrays(lists, pa.array(tfs.astype(np.int32))),
        pa.ListArray.from_arrays(heads, ids), pa.ListArray.from_arrays(heads, pa.array(ns, pa.int64())),
    ], ["slice", "term", "docs", "tfs", "ids", "ns"])


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _dampings(ns: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """The m of documents of so many terms each; through Python's numbers where 64 bits could overflow."""
    if LONG * documents * int(ns.max(initial=0)) >= 1 << 62:
        return np.array([100 - LONG + LONG * int(n) * documents // all_terms for n in ns], np.int64)
    return LEAST + LONG * ns * documents // max(all_terms, 1)


def _visited_by(stage: Stage):
    # Spark counts the parameters, so this has the two of a cogroup.
    def visit(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        return stage.visit(bundles, postings)

    return visit


class Stage:
    """What an owner does with the bundles of a slice."""

    def __init__(self, owner: dict[int, int], items, documents: int, all_terms: int, best: int | None):
        self.weights, self.items, self.documents, self.all_terms, self.best = owner, items, documents, all_terms, best

    def visit(self, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        items: Items = self.items.value
        by_term = dict(zip(postings["term"].to_pylist(), range(postings.num_rows), strict=True))
        head = by_term.pop(-1)
        ns = postings["ns"][head].values.to_numpy()
        sums = np.zeros((items.count, len(ns)), np.int64)
        for item, docs, scores in zip(bundles["item"].to_pylist(), bundles["docs"], bundles["scores"], strict=True):
            sums[item, docs.values.to_numpy()] = scores.values.to_numpy()
        dampings = _dampings(ns, self.documents, self.all_terms)
        for term, row in by_term.items():
            docs, tfs = postings["docs"][row].values.to_numpy(), postings["tfs"][row].values.to_numpy().astype(np.int64)
            each = self.weights[term] * (SCALE * tfs // (1000 * tfs + 8 * dampings[docs]))
            held_by, times = items.holders[term]
            sums[np.ix_(held_by, docs)] += np.multiply.outer(times, each)
        if self.best is not None:
            return self._best(sums, postings["ids"][head].values)
        item, doc = np.nonzero(sums)
        different, first = np.unique(item, return_index=True)
        lists = np.append(first, len(doc)).astype(np.int32)
        number = postings["slice"][head].as_py()
        return pa.table({
            "slice": pa.array(np.full(len(different), number)), "item": pa.array(different.astype(np.int32)),
            "docs": pa.ListArray.from_arrays(lists, pa.array(doc.astype(np.int32))),
            "scores": pa.ListArray.from_arrays(lists, pa.array(sums[item, doc]))})

    def _best(self, sums: np.ndarray, ids: pa.Array) -> pa.Table:
        """The best documents of the slice for each item, ties by id; null ids come last."""
        order = np.empty(len(ids), np.int64)
        order[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        found_items, found_docs = [], []
        for item, row in enumerate(sums):
            least = max(1, int(np.partition(row, -self.best)[-self.best]) if len(row) > self.best else 1)
            at = np.flatnonzero(row >= least)
            at = at[np.lexsort((order[at], -row[at]))[: self.best]]
            found_items.append(np.full(len(at), item, np.int32))
            found_docs.append(at)
        items, docs = np.concatenate(found_items), np.concatenate(found_docs)
        return pa.table({"item": pa.array(items), "id": ids.take(pa.array(docs)), "score": pa.array(sums[items, docs])})


def _owners(held: dict[int, int], owners: int) -> list[list[int]]:
    """The terms of each owner by the number of documents that hold a term, rare ones first, postings about equal."""
    order, total, before = sorted(held, key=lambda t: (held[t], t)), sum(held.values()), 0
    dealt: list[list[int]] = [[] for _ in range(owners)]
    for term in order:
        dealt[min(owners - 1, before * owners // total)].append(term)
        before += held[term]
    return dealt


def _pass(docs: DataFrame, id_col: str, text_col: str, texts: list[str | None], best: int) -> DataFrame:
    """``(item, id, score)``: the best documents of every slice for the items, which are numbered from 0."""
    spark, items = docs.sparkSession, Items.of(texts)
    postings = _postings(docs, id_col, text_col, items)
    heads = postings.filter("term = -1").agg(
        F.sum(F.size(F.filter("ns", lambda n: n > 0))).cast("long"), F.sum(F.aggregate("ns", F.lit(0).cast("long"), lambda a, b: a + b)), F.count("*")).first()
    documents, all_terms, slices = (int(x or 0) for x in heads)
    # At most as many rows as the items of a pass have terms.
    held = dict(postings.filter("term >= 0").groupBy("term").agg(F.sum(F.size("docs"))).collect())
    parts = min(slices, max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(slices // 64, 100_000)))
    id_type = postings.schema["ids"].dataType.elementType
    result = StructType([StructField("item", IntegerType()), StructField("id", id_type), StructField("score", LongType())])
    carried = StructType([StructField("slice", LongType()), StructField("item", IntegerType()), StructField("docs", ArrayType(IntegerType())),
                          StructField("scores", ArrayType(LongType()))])
    if not held:
        return spark.createDataFrame([], result)
    shared = spark.sparkContext.broadcast(items)
    bundles, dealt = spark.createDataFrame([], carried), _owners(held, OWNERS)
    for number, owned in enumerate(dealt):
        mine = spark.createDataFrame([(t,) for t in [-1, *owned]], "owned int")
        visited = postings.join(F.broadcast(mine), F.col("term") == F.col("owned")).drop("owned")
        last = number == OWNERS - 1
        stage = Stage({t: weight(documents, held[t]) for t in owned}, shared, documents, all_terms, best if last else None)
        bundles = bundles.repartition(parts, "slice").groupBy("slice").cogroup(visited.repartition(parts, "slice").groupBy("slice")).applyInArrow(
            _visited_by(stage), result if last else carried)
    return bundles


def search(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, best: int = 10) -> DataFrame:
    """``(item, rank, id, score)``: for each item its ``best`` documents with a score above 0, or all if these are fewer.

    A document's score for an item is the sum over the item's terms, repeats included, of w * (10**9 * tf div (1000 * tf + 8 * m)), where
    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and m = 25 + 75 * n * N div L; N counts the documents with a term, L all their terms, n
    a document's, df the documents that hold the term and tf its occurrences. Equal scores are ranked by id, null ids last; ranks of an item are
    unique. Every row of ``docs`` is a document, repeated rows too. Rows of ``items`` of equal id and text are one item, other rows of one
    id are items of their own, also with a null id. Null and empty texts hold no term, so no score is above 0. Other columns are not looked at.
    """
    spark = docs.sparkSession
    asked = items.select(col(item_col).alias("item"), text_of(item_text_col).alias("text")).distinct()
    parts = max(1, math.ceil((asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / PASS_BYTES))
    asked = materialise(asked.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts))), "items")
    found = None
    for part in range(parts):
        rows = sorted(asked.filter(F.col("part") == part).select("item", "text").collect(), key=lambda r: (r.item is None, r.item, r.text))
        if not rows:
            continue
        names = spark.createDataFrame([(n, r.item) for n, r in enumerate(rows)], StructType([StructField("number", IntegerType()), asked.schema["item"]]))
        each = _pass(docs, id_col, text_col, [r.text for r in rows], best)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best).withColumnRenamed("item", "number")
        ranked = ranked.join(F.broadcast(names), "number").select("item", "rank", "id", "score")
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        fields = [asked.schema["item"], StructField("rank", IntegerType()), StructField("id", docs.select(col(id_col)).schema[0].dataType), StructField("score", LongType())]
        return spark.createDataFrame([], StructType(fields))
    return found
