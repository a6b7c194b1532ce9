"""Ranked lexical search, reversed: the documents stream through the items' index.

The items' terms become an inverted index (term to items, with repeats) that is
broadcast; each document's term counts are looked up in it once, and every item
keeps a heap of its best documents per task.  The heaps are merged in two steps.

1. One pass over the texts writes each document's length and its counts of the
   terms that items have; sums over that table give the corpus statistics.
2. A pass over the counts scores a block of documents against all items and
   updates the heaps; a score enters only above its item's current least.

An index holds at most ``POSTINGS`` postings (or a single item); more items are
dealt by hash into blocks, each with its own two passes over all documents.

All is 64-bit integer arithmetic but for the terms' logarithms, which are taken
once each, in doubles.

Defined results: a null text, or one without a term, is no document and an item
without hits has no rows; repeated rows are documents of their own and so are
repeated items; equal scores go by ascending ``doc_id``, rows without one last.
Texts are read whole, a slice at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize, ship_package

TOP = 10
#: Most postings of an index (a few hundred bytes each, in every Python worker).
POSTINGS = 500_000
#: Most cells of a block of scores, and most posting hits added up at once.
CELLS = 1 << 20
SLICE = 1 << 22
#: Merged heaps: documents are dealt to so many heaps per item first.
FAN = 16
#: UTF-8 bytes of terms: digits, letters (folded) and all beyond ASCII.
FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
COUNTS = "doc_id long, n long, terms array<int>, tfs array<int>"
HEAP = "item long, item_id long, doc_id long, score long"
LAST = np.iinfo(np.int64).max


def term_slices(raw: bytes):
    """The terms of a text, in lists that cover it."""
    folded, at = raw.translate(FOLD), 0
    while len(folded) - at > SLICE and (cut := folded.find(b" ", at + SLICE)) >= 0:
        yield folded[at:cut].split()
        at = cut
    yield folded[at:].split()


def _lists(values: list[list[int]]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([x for v in values for x in v], pa.int32()))


def _item_terms(batches):
    for b in batches:
        out = []
        for item_id, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            seen: Counter = Counter()
            for terms in term_slices(raw or b""):
                seen.update(terms)
            if seen:
                out.append((item_id, list(seen), list(seen.values())))
        ids, terms, repeats = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.list_(pa.binary())),
                                          _lists(repeats)], names=["item_id", "terms", "repeats"])


def _document_counts(vocabulary):
    def run(batches):
        number = vocabulary.value.get
        for b in batches:
            docs, lengths, terms, tfs = [], [], [], []
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n, seen = 0, Counter()
                for found in term_slices(raw or b""):
                    n += len(found)
                    seen.update(map(number, found))
                if n:
                    seen.pop(None, None)
                    docs.append(doc_id)
                    lengths.append(n)
                    terms.append(list(seen))
                    tfs.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(lengths, pa.int64()),
                                              _lists(terms), _lists(tfs)], names=["doc_id", "n", "terms", "tfs"])

    return run


@dataclass
class Index:
    """Items by term (``item[start[t]:start[t + 1]]``) with a term's weight."""

    start: np.ndarray
    item: np.ndarray
    repeats: np.ndarray
    weight: np.ndarray
    rows: list[int]
    item_ids: list
    documents: int
    length: int
    top: int

    def damping(self, n: np.ndarray) -> np.ndarray:
        """``m`` of documents of so many terms; the product may pass 64 bits."""
        return np.array([25 + 75 * x * self.documents // self.length for x in n.tolist()], np.int64)


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.kept = [np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64)]  # item, score, no id, doc
        self.least = np.zeros(items, np.int64)
        self.least_doc = np.full(items, np.iinfo(np.int64).min)

    def offer(self, scores: np.ndarray, docs: np.ndarray, missing: np.ndarray) -> None:
        """A matrix of scores (documents by items); ids are ``LAST`` where missing."""
        row, item = np.nonzero((scores > self.least) | ((scores == self.least) & (docs[:, None] < self.least_doc)))
        if not len(row):
            return
        item, score, gone, doc = (np.concatenate(p) for p in zip(
            self.kept, (item, scores[row, item], missing[row], docs[row])))
        order = np.lexsort((doc, gone, -score, item))
        item, score, gone, doc = item[order], score[order], gone[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.top - 1
        self.least[item[last]], self.least_doc[item[last]] = score[last], doc[last]
        self.kept = [x[rank < self.top] for x in (item, score, gone, doc)]


def _heaps(index):
    def run(batches):
        ix: Index = index.value
        items = len(ix.rows)
        heaps = Heaps(items, ix.top)
        for b in batches:
            docs = b.column(0)
            missing = np.asarray(docs.is_null())
            ids = docs.fill_null(LAST).to_numpy()
            size = np.diff(b.column(2).offsets.to_numpy())
            term, tf = (b.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
            doc = np.repeat(np.arange(len(ids)), size)
            impact = ix.weight[term] * (10**9 * tf // (1000 * tf + 8 * ix.damping(b.column(1).to_numpy())[doc]))
            hits = ix.start[term + 1] - ix.start[term]
            ends = np.concatenate([[0], np.cumsum(size)])  # a document's places in term
            reach = np.concatenate([[0], np.cumsum(hits)])[ends]  # hits before each document
            at = 0
            while at < len(ids):
                to = int(np.searchsorted(reach, reach[at] + CELLS, side="right")) - 1
                to = min(max(to, at + 1), at + max(1, CELLS // items), len(ids))
                own = slice(ends[at], ends[to])
                n = hits[own]
                skip = np.repeat(ix.start[term[own]] - (np.cumsum(n) - n), n)
                posting = skip + np.arange(len(skip))
                cell = np.repeat(doc[own] - at, n) * items + ix.item[posting]
                scores = np.zeros((to - at) * items, np.int64)
                np.add.at(scores, cell, np.repeat(impact[own], n) * ix.repeats[posting])
                heaps.offer(scores.reshape(to - at, items), ids[at:to], missing[at:to])
                at = to
        item, score, gone, doc = heaps.kept
        yield pa.RecordBatch.from_arrays(
            [pa.array([ix.rows[i] for i in item], pa.int64()), pa.array([ix.item_ids[i] for i in item], pa.int64()),
             pa.array(doc, pa.int64(), mask=gone), pa.array(score)], names=["item", "item_id", "doc_id", "score"])

    return run


def _merged(heaps: DataFrame, top: int, *by: str) -> DataFrame:
    best_first = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return heaps.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)


def _block_count(items: DataFrame, postings: int) -> int:
    """So many blocks by hash that none of several items has too many postings."""
    n = 1
    while True:
        sizes = items.groupBy(F.pmod(F.xxhash64("item"), F.lit(n))).agg(F.sum(F.size("terms")).alias("s"), F.count("*").alias("n"))
        if sizes.where((F.col("s") > postings) & (F.col("n") > 1)).isEmpty():
            return n
        n *= 2


def _block_heaps(docs: DataFrame, block: DataFrame, top: int) -> DataFrame | None:
    """The heaps of a block of items, one per item and task; none without hits."""
    sc = docs.sparkSession.sparkContext
    items = [(r["item"], r["item_id"], [bytes(t) for t in r["terms"]], r["repeats"]) for r in block.collect()]
    numbers: dict[bytes, int] = {}
    for *_, terms, _ in items:
        for t in terms:
            numbers.setdefault(t, len(numbers))
    vocabulary = sc.broadcast(numbers)
    counts = materialize(docs.mapInArrow(_document_counts(vocabulary), COUNTS), "term_counts")
    whole = counts.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).collect()[0]
    if not whole["documents"]:
        return None
    holders = np.zeros(len(numbers), np.int64)
    for r in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        holders[r["t"]] = r["df"]
    n = whole["documents"]
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in holders.tolist()]
    term = np.array([numbers[t] for *_, terms, _ in items for t in terms], np.int64)
    order = np.argsort(term, kind="stable")
    start = np.searchsorted(term[order], np.arange(len(numbers) + 1))
    index = sc.broadcast(Index(
        start, np.repeat(np.arange(len(items)), [len(i[2]) for i in items])[order],
        np.array([x for i in items for x in i[3]], np.int64)[order], np.array(weight, np.int64),
        [i[0] for i in items], [i[1] for i in items], n, whole["length"], top))
    heaps = materialize(counts.mapInArrow(_heaps(index), HEAP), "heaps")
    for used in (vocabulary, index):
        used.unpersist()
    return heaps


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, postings: int = POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of every item."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    asked = asked.mapInArrow(_item_terms, "item_id long, terms array<binary>, repeats array<int>")
    asked = materialize(asked.withColumn("item", F.monotonically_increasing_id()), "item_terms")
    blocks = _block_count(asked, postings)
    heaps = None
    for k in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        got = None if own.isEmpty() else _block_heaps(texts, own, top)
        if got is not None:
            heaps = got if heaps is None else heaps.unionByName(got)
    if heaps is None:
        heaps = spark.createDataFrame([], HEAP)
    fan = heaps.withColumn("fan", F.pmod(F.xxhash64("doc_id"), F.lit(FAN)))
    some = _merged(fan, top, "item", "fan").select("item", "item_id", "doc_id", "score")
    return _merged(some, top, "item").select("item_id", "rank", "doc_id", "score")
