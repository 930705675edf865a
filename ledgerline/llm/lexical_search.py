"""Ranked lexical search, reversed: documents stream through an index of the items.

The searched items are few and the documents many, so the inverted index is
built over the items' terms and broadcast, and every document is read past it:

1. *Statistics.*  One pass counts documents, their terms, and in how many
   documents each item term occurs; a task sends one row per item term.
2. *Search.*  A second pass looks up each document's term counts in the index,
   adds up the scores of the items it meets, and offers them to a bounded heap
   per item; a task sends its heaps, at most ``k`` rows per item.
3. *Merge.*  Heaps are merged per item and group of tasks, then per item.

A block of items holds about ``BLOCK_POSTINGS`` (item, term) pairs, which
bounds what is broadcast; more items than that take several pairs of passes.
One item is never split: an item of more terms makes its block as large as
itself.

Score of a document for an item, in whole numbers: the sum over the item's
terms of ``w * ((10**9 * tf) // (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and
``m = 100 - 90 + (90 * n * N) // L``.

Defined results: a NULL or empty text has no terms and is not counted; texts
are searched whole, whatever their length; repeated rows are documents of their
own and rank side by side; equal scores rank by ascending id, rows without an
id last; item rows of one id are one item with the terms of all of them, NULL
being an id like any other; items without terms, and empty tables on either
side, give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, texts_of, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_POSTINGS = 1_000_000
MERGE_GROUPS = 64
EXACT = 1 << 53  # whole numbers below this are exact in doubles

# Bytes of a text as terms see them: A-Z lower-cased, other ASCII but 0-9 and a-z a space.
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


class ItemIndex:
    """Postings of a block of items: term number to item numbers."""

    def __init__(self, pairs: list[tuple[int | None, str]]):
        self.item_ids = list(dict.fromkeys(i for i, _ in pairs))
        number = {i: n for n, i in enumerate(self.item_ids)}
        self.term = {t: k for k, t in enumerate(dict.fromkeys(t.encode() for _, t in pairs))}
        by_term = sorted((self.term[t.encode()], number[i]) for i, t in pairs)
        self.items = np.array([n for _, n in by_term], np.int64)
        self.held = np.bincount(np.array([k for k, _ in by_term], np.int64), minlength=len(self.term))
        self.start = np.cumsum(self.held) - self.held
        self.weight = np.zeros(len(self.term), np.int64)
        self.documents, self.all_terms = 0, 0

    def weigh(self, documents: int, all_terms: int, found: dict[int, int]) -> None:
        """Weights from the number of documents, of their terms, and of documents holding each term."""
        self.documents, self.all_terms = documents, all_terms
        for k, df in found.items():
            self.weight[k] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))

    def found(self, counts: Counter) -> tuple[list[int], list[int]]:
        """Term numbers and counts of the terms that some item has."""
        term, pairs = self.term, []
        for t in counts.keys() & term.keys() if len(term) < len(counts) else counts:
            k = term.get(t)
            if k is not None:
                pairs.append((k, counts[t]))
        return [k for k, _ in pairs], [c for _, c in pairs]

    def scores(self, terms: list[bytes]) -> np.ndarray | None:
        """The score of each item for a document of these terms."""
        ks, tfs = self.found(Counter(terms))
        if not ks:
            return None
        k, tf = np.array(ks, np.int64), np.array(tfs, np.int64)
        m = 100 - 90 + 90 * len(terms) * self.documents // self.all_terms
        part = self.weight[k] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        n = self.held[k]
        ends = np.cumsum(n)
        items = self.items[np.repeat(self.start[k] - ends + n, n) + np.arange(ends[-1])]
        if part.sum() < EXACT:
            return np.bincount(items, np.repeat(part, n), len(self.item_ids)).astype(np.int64)
        total = np.zeros(len(self.item_ids), np.int64)
        np.add.at(total, items, np.repeat(part, n))
        return total


class Heaps:
    """The best ``k`` documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.heaps: list[list] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a score below this enters no more

    def offer(self, doc_id: int | None, scores: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            heap = self.heaps[i]
            entry = int(scores[i]), doc_id is not None, -(doc_id or 0)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[i] = max(1, heap[0][0])

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for i, heap in enumerate(self.heaps):
            for score, known, negated in heap:
                yield i, -negated if known else None, score


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) pairs, written."""
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return written(items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms).alias("term")).distinct())


def _statistics(docs: DataFrame, index: ItemIndex) -> None:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def count(batches):
        index = shared.value
        documents, all_terms, found = 0, 0, Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                terms = terms_of(text)
                documents += bool(terms)
                all_terms += len(terms)
                found.update(set(terms) & index.term.keys())
        rows = [(-1, documents), (-2, all_terms), *((index.term[t], n) for t, n in found.items())]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["k", "n"])

    totals = map_batches(docs.select("text"), count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    # At most one row for each term of the block.
    found = {r.k: r.n for r in totals.collect()}
    index.weigh(found.pop(-1, 0), found.pop(-2, 0), found)


def _search_block(docs: DataFrame, index: ItemIndex, k: int) -> DataFrame:
    """(item_id, doc_id, score, task): each task's heaps."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def search(batches):
        index = shared.value
        heaps = Heaps(len(index.item_ids), k)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                scores = index.scores(terms_of(text))
                if scores is not None:
                    heaps.offer(doc_id, scores)
        task = TaskContext.get().partitionId()
        rows = [(index.item_ids[i], d, s, task) for i, d, s in heaps.rows()]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score", "task"])

    return map_batches(docs, search, "item_id long, doc_id long, score long, task long")


def _best(rows: DataFrame, by: list, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents with a score above 0."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pairs = _item_terms(items)
    blocks = max(1, -(-pairs.count() // block_postings))
    heaps = None
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        index = ItemIndex([(r.item_id, r.term) for r in own.toLocalIterator()])
        if not index.item_ids:
            continue
        _statistics(docs, index)
        found = _search_block(docs, index, k)
        heaps = found if heaps is None else heaps.unionByName(found)
    if heaps is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    merged = _best(heaps.withColumn("part", F.col("task") % MERGE_GROUPS), ["item_id", "part"], k).drop("rank")
    return _best(merged, ["item_id"], k).select("item_id", "rank", "doc_id", "score")
