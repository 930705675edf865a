"""Pack token sequences into windows with almost no padding.

Every document becomes its token ids plus one end id, cut into full windows
and one shorter tail.  Tails are packed by non-negative least squares:

1. One pass over the texts encodes them and writes, per piece, its length,
   checksum and (for tails) ids, with the piece's rank among equal lengths of
   the same partition.
2. The histogram of tail lengths (one number per possible length) is the only
   thing the driver sees.  Shallow combinations ``k*a + m*b`` that fill a
   window exactly are enumerated, and the counts of their repeats that best
   explain the histogram are solved under non-negativity and rounded down.
3. A tail's rank among all tails of its length decides which repeat of which
   combination it belongs to - arithmetic on the rank, no grouping of tails.
4. Residual tails, longest first, are laid end to end and cut at window ends
   (greedy filling), which pads at most the last window.

Defined results: NULL text is empty, so its document is the end id alone;
repeated rows and NULL ids are packed like any other row; a text of any length
is cut into as many windows as it needs; an empty table gives no pieces; extra
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, texts_of, written

DEPTH = 4     # pieces of one combination at most
SWEEPS = 200  # passes of the least-squares solver


# Texts of these characters are cut alike by every Unicode version's tables.
_UNUSUAL = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]|\\s{256}")
LONGEST_WORD = 256


class IdEncoder:
    """Ids of whole texts under a byte-level BPE tokenizer file, as little-endian 32-bit bytes.

    The file's vocabulary also drives a rank-based encoder, several times
    faster than the file's own library, where both provably agree: ids must
    follow the merges, and a text must hold neither special tokens nor unusual
    characters nor very long words.  Any other text goes to the library.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        self.fast = None
        if self._plain(spec):
            letters = {c: b for b, c in enumerate(byte_letters())}
            ranks = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()
                     if not self.special.fullmatch(piece)}
            self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def model(self):
        """The file's own library, loaded by the first text that needs it."""
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(self.path)
        model.no_truncation()
        model.no_padding()
        return model

    @staticmethod
    def _plain(spec: dict) -> bool:
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        vocab = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ids = [vocab.get(a + b, -1) for a, b in pairs]
        return (model["type"] == "BPE" and spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                and not cut.get("add_prefix_space") and not model.get("dropout") and not model.get("ignore_merges")
                and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix")
                and ids == list(range(256, 256 + len(ids))) and all(vocab.get(c, 256) < 256 for c in byte_letters()))

    def encode(self, text: str) -> bytes:
        if self.fast is None or _UNUSUAL.search(text) or self.special.search(text) or max(map(len, text.split()), default=0) > LONGEST_WORD:
            return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself if
    visible, else the next free code point from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


# One encoder per tokenizer file in each worker process.
_ENCODERS: dict[str, IdEncoder] = {}


def id_encoder(path: str) -> IdEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]


def _pieces(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        part = TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        encoder = id_encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                data = encoder.encode(text) + end
                total = len(data) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    piece = data[4 * start:4 * (start + length)]
                    rows.append((doc_id, total, start, length, zlib.crc32(piece), part, seen[length],
                                 piece if length < window else None))
                    seen[length] += 1
            columns = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [batch.schema.field(0).type] + [pa.int64()] * 6 + [pa.binary()])],
                names=["doc_id", "doc_tokens", "start", "length", "ids_crc32", "part", "local_rank", "tail"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, cut, f"doc_id {kind}, doc_tokens long, start long, length long, ids_crc32 long, "
                                  "part long, local_rank long, tail binary")


def combinations(window: int, depth: int = DEPTH) -> list[tuple[tuple[int, int], ...]]:
    """Ways ``k*a + m*b == window`` with at most ``depth`` pieces, as ((a, k), (b, m))."""
    found = set()
    for k in range(1, depth):
        for m in range(1, depth - k + 1):
            for a in range(1, (window - 1) // k + 1):
                rest = window - k * a
                if rest % m == 0 and 0 < rest // m < window:
                    b = rest // m
                    parts = ((a, k), (b, m)) if a != b else ((a, k + m),)
                    found.add(tuple(sorted(parts, reverse=True)))
    return sorted(found, reverse=True)


def least_squares_counts(histogram: np.ndarray, combos: list, sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative repeats whose piece counts are nearest to the histogram.

    Cyclic coordinate descent; each column has at most two entries, so a sweep
    costs as many steps as there are combinations.
    """
    rest = histogram.astype(float).tolist()
    x = [0.0] * len(combos)
    norms = [sum(k * k for _, k in c) for c in combos]
    for _ in range(sweeps):
        moved = 0.0
        for j, combo in enumerate(combos):
            step = max(-x[j], sum(k * rest[a] for a, k in combo) / norms[j])
            if step:
                x[j] += step
                for a, k in combo:
                    rest[a] -= k * step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return np.array(x)


class Plan:
    """Where the r-th tail of each length goes."""

    def __init__(self, counts: dict[int, int], window: int):
        self.window = window
        histogram = np.zeros(window + 1, np.int64)
        for length, n in counts.items():
            histogram[length] = n
        tails = histogram.copy()
        tails[window] = 0
        combos = combinations(window)
        x = least_squares_counts(tails, combos)
        left, sequence = tails.copy(), 0
        # Per length: first rank, pieces of this length in a repeat, first sequence, offset of the first one.
        spans: list[list[tuple[int, int, int, int]]] = [[] for _ in range(window + 1)]
        for j in np.argsort(-x, kind="stable"):
            n = min([int(x[j] + 1e-9)] + [int(left[a]) // k for a, k in combos[j]])
            if n <= 0:
                continue
            offset = 0
            for a, k in combos[j]:
                spans[a].append((int(tails[a] - left[a]), k, sequence, offset))
                left[a] -= n * k
                offset += a * k
            sequence += n
        self.first_rank = [np.array([s[0] for s in span], np.int64) for span in spans]
        self.spans = [np.array([s[1:] for s in span], np.int64).reshape(-1, 3) for span in spans]
        self.used = tails - left
        # Residual tails, longest first, end to end.
        ends = np.cumsum((left * np.arange(window + 1))[::-1])[::-1]
        self.stream_start = ends - left * np.arange(window + 1)
        self.stream_sequence = sequence
        self.full_sequence = sequence + int(-(-ends[0] // window))

    def place(self, length: int, ranks: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """(first id, length, sequence, offset) of the pieces of each tail or window."""
        if length == self.window:
            return [[(0, length, self.full_sequence + int(r), 0)] for r in ranks]
        out = []
        at = np.searchsorted(self.first_rank[length], ranks, "right") - 1
        for r, j in zip(ranks.tolist(), at.tolist()):
            if r < self.used[length]:
                k, sequence, offset = self.spans[length][j].tolist()
                i = r - int(self.first_rank[length][j])
                out.append([(0, length, sequence + i // k, offset + (i % k) * length)])
                continue
            pos = int(self.stream_start[length]) + (r - int(self.used[length])) * length
            first, pieces = 0, []
            while first < length:
                offset = pos % self.window
                n = min(length - first, self.window - offset)
                pieces.append((first, n, self.stream_sequence + pos // self.window, offset))
                first, pos = first + n, pos + n
            out.append(pieces)
        return out


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of every document with their sequence and offset.

    Columns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    pieces = written(_pieces(docs.select("doc_id", "text"), tokenizer_path, window, end_id))
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # One row per partition and length; a length's window holds one row per partition.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(per_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(Plan(histogram, window))

    def assign(batches):
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            lengths, ranks = np.array(cols[3], np.int64), np.array(cols[5], np.int64) + np.array(cols[6], np.int64)
            placed: list = [None] * batch.num_rows
            for length in np.unique(lengths):
                where = np.flatnonzero(lengths == length)
                for i, pieces_of in zip(where.tolist(), plan.value.place(int(length), ranks[where])):
                    placed[i] = pieces_of
            rows = []
            for i, pieces_of in enumerate(placed):
                doc_id, total, start, crc, tail = cols[0][i], cols[1][i], cols[2][i], cols[4][i], cols[7][i]
                for first, n, sequence, offset in pieces_of:
                    whole = len(pieces_of) == 1
                    rows.append((doc_id, start + first, n, crc if whole else zlib.crc32(tail[4 * first:4 * (first + n)]),
                                 total, sequence, offset))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [batch.schema.field(0).type] + [pa.int64()] * 6)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # The offsets grow with the partitions, so they are not broadcast: a
    # partition's share of them is hashed, and the pieces need no sort.
    starts = offsets.select("part", "length", "before").hint("shuffle_hash")
    ranked = pieces.join(starts, ["part", "length"]).select(
        "doc_id", "doc_tokens", "start", "length", "ids_crc32", "local_rank", "before", "tail")
    return map_batches(ranked, assign, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                       "sequence_id long, offset long")
