"""Token counts of whole texts under a SentencePiece model.

Two tiers of a map-side lookup; the pre-tokens of the texts are not shuffled:

1. A first pass counts pre-tokens inside each task with bounded memory and
   emits only the task's heaviest ones, at most ``TASK_HEAVY``; these reports
   are the only ones that are shuffled, to be added up, and are written.
   Pre-tokens holding at least 1 / ``TABLE_SHARE`` of all emitted occurrences (so at most ``TABLE_SHARE``
   of them, whatever the corpus size) get their lengths from the model and
   become a broadcast hash table.
2. The counting pass adds up lengths per text; a pre-token that misses the
   broadcast table is encoded once per worker and kept in its bounded cache.

A pre-token is a run of spaces with the following non-space characters.  That
cut is exact as long as no piece holds a space mark after another character,
which is checked against the vocabulary; otherwise texts are encoded whole.

Defined results: NULL text counts as empty (0 bytes, 0 tokens); repeated rows
and NULL ids keep their own row; texts of any length are counted whole, words of
more than ``LONGEST_KEPT`` characters without being kept; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts_of, written

SPACE_MARK = "▁"
TABLE_SHARE = 65_536     # the broadcast table has at most this many entries
TASK_HEAVY = 2_048       # pre-tokens that one task reports for the table
TASK_COUNTERS = 200_000  # counters that one task holds at once
CACHE_ENTRIES = 400_000  # entries of a worker's cache
LONGEST_KEPT = 64        # longer pre-tokens are encoded each time, never kept

_SEGMENT = re.compile(" ( *[^ ]+)")


def pre_tokens(text: str) -> tuple[list[str], int]:
    """Pre-tokens without their first space, and the number of trailing spaces.

    The model puts one space mark before a text, so every pre-token starts
    with at least one; encoding it alone adds that mark again.
    """
    if "  " not in text and text[:1] != " " and text[-1:] != " ":
        return (text.split(" ") if text else []), 0
    body = text.rstrip(" ")
    return _SEGMENT.findall(" " + body), len(text) - len(body)


class LengthTable(dict):
    """Lengths by pre-token: the broadcast table plus this worker's cache."""

    def __init__(self, model_path: str, frequent: dict[str, int]):
        import sentencepiece

        super().__init__(frequent)
        self.frequent = frequent
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        self.cuttable = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)

    def __missing__(self, pre_token: str) -> int:
        n = len(self.model.encode(pre_token))
        if len(pre_token) <= LONGEST_KEPT:
            if len(self) - len(self.frequent) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.frequent)
            self[pre_token] = n
        return n

    def count(self, text: str) -> int:
        if not self.cuttable:
            return len(self.model.encode(text))
        text = text.replace(SPACE_MARK, " ")
        units, trailing = pre_tokens(text)
        if not units:
            return len(self.model.encode(text))
        n = sum(map(self.__getitem__, units))
        if trailing:
            n += len(self.model.encode("a" + " " * trailing)) - len(self.model.encode("a"))
        return n


# One table per model and run in each worker process, kept between tasks.
_TABLES: dict[tuple[str, str], LengthTable] = {}


def _heavy_pre_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in texts_of(batch.column(0)):
            counts.update(pre_tokens(text.replace(SPACE_MARK, " "))[0])
            if len(counts) > TASK_COUNTERS:
                counts = Counter(dict(counts.most_common(TASK_COUNTERS // 2)))
    heavy = [(u, n) for u, n in counts.most_common(TASK_HEAVY) if len(u) <= LONGEST_KEPT]
    yield pa.RecordBatch.from_arrays(
        [pa.array([u for u, _ in heavy], pa.string()), pa.array([n for _, n in heavy], pa.int64())],
        names=["unit", "n"])


def frequent_lengths(docs: DataFrame, model_path: str) -> dict[str, int]:
    """Token lengths of the frequent pre-tokens: at most ``TABLE_SHARE`` entries."""
    reported = map_batches(docs.select("text"), _heavy_pre_tokens, "unit string, n long")
    totals = reported.groupBy("unit").agg(F.sum("n").alias("n"))

    def lengths(batches):
        table = LengthTable(model_path, {})
        for batch in batches:
            units = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in table.model.encode(units)], pa.int64())],
                names=["unit", "length"])

    # The share is of what the tasks reported, so at most TABLE_SHARE pass.
    totals = written(totals)
    whole = totals.agg(F.sum("n")).first()[0] or 0
    heavy = totals.where(F.col("n") * TABLE_SHARE >= F.lit(whole)).select("unit")
    return {r.unit: r.length for r in map_batches(heavy, lengths, "unit string, length long").collect()}


def token_counts(docs: DataFrame, model_path: str, over: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``over``) per row."""
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, model_path))
    run = uuid.uuid4().hex

    def count(batches):
        key = (model_path, run)
        table = _TABLES.get(key)
        if table is None:
            _TABLES.clear()
            table = _TABLES[key] = LengthTable(model_path, shared.value)
        for batch in batches:
            texts = texts_of(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array([table.count(t) for t in texts], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = map_batches(docs, count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > over)
