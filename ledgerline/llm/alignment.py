"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A (byte-level BPE) reads space + text, tokenizer B (SentencePiece,
which adds that space itself) reads the text, so both cut the same bytes.
Tokens overlap where their byte ranges do.  Overlapping tokens form chains;
a chain ends at a byte where tokens of both sides end.

*Pointer jumping.*  Every token points to its farthest-right overlapping token
(itself, if none reaches farther; a B token wins a tie).  Doubling the
pointers, ``p = p[p]``, on whole numpy arrays reaches every chain's last token
in as many rounds as the logarithm of the longest chain; that token labels the
group.

*Units.*  Where both tokenizers provably cut before every space, a text is its
space-separated words, and a worker aligns each distinct word once, a batch of
new words at a time; any other text (a space before white space or at an end)
is one unit.  A worker's table of units is emptied at ``CACHE_CHARS``.

*Counts.*  A first pass adds up links per id pair, in the tasks and then by
key.  The most frequent pairs, at most ``MAX_PAIRS`` (the smallest power of
two as least count that admits no more), are broadcast with their counts; the
second pass adds them up per document.  Links of rarer pairs leave that pass
as (row, pair, times) and meet their counts in a join.

Defined results: a NULL or empty text, and one whose joined token bytes differ
from space + text on either side, has no tokens: zeros and an empty digest;
repeated rows each count and keep a row; NULL ids keep their row; very long
texts are aligned whole, one or several words at a time; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, texts_of, written
from .packing import IdEncoder, _UNUSUAL, byte_letters

SPACE_MARK = "▁"
MAX_PAIRS = 1 << 21        # of (key, count, best): 17 bytes each
CACHE_CHARS = 2_500_000    # of the units that a worker's table holds
LONGEST_WORD = 256

_UNEVEN = re.compile(r" (?:\s|$)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class _PlainEncoder(IdEncoder):
    """Special strings inside texts are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.special = re.compile("(?!)")

    @cached_property
    def model(self):
        model = super().model
        model.encode_special_tokens = True
        return model


class Sides:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = _PlainEncoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letter = {c: b for b, c in enumerate(byte_letters())}
        vocab = self.a.model.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.a_bytes[i] = bytes(letter[c] for c in piece) if all(c in letter for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace(SPACE_MARK, " ").encode() for p in pieces]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # Words are units if neither side has a token across a space.
        self.cuttable = self.a.fast is not None and not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)

    def units(self, text: str) -> list[str]:
        """The text without its first space, cut where both sides cut."""
        if not text:
            return []
        return text.split(" ") if self.cuttable and not _UNEVEN.search(" " + text) else [text]

    def _usual(self, units: list[str]) -> np.ndarray:
        """Which units the rank-based encoder may read one after another."""
        usual = np.full(len(units), self.cuttable)
        for at in range(0, len(units) if self.cuttable else 0, 256):
            part = units[at:at + 256]
            if _UNUSUAL.search("".join(part)) or max(map(len, part)) > LONGEST_WORD:
                usual[at:at + 256] = [len(u) <= LONGEST_WORD and not _UNUSUAL.search(u) for u in part]
        return usual

    def a_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of space + unit, and how many each unit has."""
        usual = self._usual(units)
        n = np.zeros(len(units), np.int64)
        ids = np.zeros(0, np.int64)
        if usual.any():
            words = units if usual.all() else [u for u, own in zip(units, usual.tolist()) if own]
            # Words one after another are a text whose tokens end where words end.
            ids = self.a.fast.encode_to_numpy(" " + " ".join(words), disallowed_special=()).astype(np.int64)
            ends = np.cumsum(self.a_sizes[ids])
            want = np.cumsum([1 + len(u.encode()) for u in words])
            at = np.searchsorted(ends, want)
            if at[-1] < len(ends) and (ends[at] == want).all():
                n[usual] = np.diff(at, prepend=-1)
            else:
                usual[:] = False
                ids = ids[:0]
        if usual.all():
            return ids, n
        rest = np.flatnonzero(~usual)
        codes = [c.ids for c in self.a.model.encode_batch([" " + units[i] for i in rest.tolist()], add_special_tokens=False)]
        n[rest] = [len(c) for c in codes]
        out = np.zeros(int(n.sum()), np.int64)
        own = np.repeat(usual, n)
        out[own] = ids
        out[~own] = np.fromiter(chain.from_iterable(codes), np.int64)
        return out, n

    def b_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.b.encode(units, num_threads=1)
        n = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, int(n.sum())), n

    @staticmethod
    def same_bytes(ids: np.ndarray, counts: np.ndarray, bytes_of: list[bytes], sizes: np.ndarray, want: list[bytes], want_sizes: np.ndarray) -> np.ndarray:
        """Which units' tokens join to the bytes wanted."""
        parts = list(map(bytes_of.__getitem__, ids.tolist()))
        ends = np.cumsum(counts)
        total = np.concatenate([[0], np.cumsum(sizes[ids])])
        if b"".join(parts) == b"".join(want) and np.array_equal(total[ends] - total[ends - counts], want_sizes):
            return np.ones(len(want), bool)
        return np.array([b"".join(parts[e - n:e]) == w for e, n, w in zip(ends.tolist(), counts.tolist(), want)])


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last token of each token's chain (A tokens first, then B), and the
    token of the other side over the last byte of each A and each B token.

    ``a_end`` and ``b_end`` are the byte ends of two cuts of the same bytes.
    """
    over_a = np.searchsorted(b_end, a_end)  # the B token over an A token's last byte
    over_b = np.searchsorted(a_end, b_end)
    own = np.arange(len(b_end)) + len(a_end)
    point = np.concatenate([len(a_end) + over_a, np.where(a_end[over_b] > b_end, over_b, own)])
    while True:
        farther = point[point]
        if np.array_equal(farther, point):
            return point, over_a, over_b
        point = farther


class Aligned:
    """Groups and links of some units; units without equal bytes have none."""

    def __init__(self, sides: Sides, units: list[str]):
        a, n_a = sides.a_ids(units)
        b, n_b = sides.b_ids(units)
        want = [(" " + u).encode("utf-8", "surrogatepass") for u in units]
        want_sizes = np.fromiter(map(len, want), np.int64, len(want))
        self.good = (sides.same_bytes(a, n_a, sides.a_bytes, sides.a_sizes, want, want_sizes)
                     & sides.same_bytes(b, n_b, sides.b_bytes, sides.b_sizes, want, want_sizes))
        if not self.good.all():
            a, b = a[np.repeat(self.good, n_a)], b[np.repeat(self.good, n_b)]
            n_a, n_b = n_a * self.good, n_b * self.good
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        a_end, b_end = np.cumsum(sides.a_sizes[a]), np.cumsum(sides.b_sizes[b])
        last, over_a, over_b = terminals(a_end, b_end)
        last = last - len(a)
        ends = last[len(a):] == np.arange(len(b))  # B tokens that end a group
        label = np.cumsum(ends) - 1
        self.a_group, self.b_group = label[last[:len(a)]], label[last[len(a):]]
        b_unit = np.repeat(np.arange(len(units)), n_b)
        self.n_groups = np.bincount(b_unit[ends], minlength=len(units))
        # A link ends where its A token ends or, inside a group, its B token.
        inner = np.flatnonzero(~ends)
        order = np.argsort(np.concatenate([a_end, b_end[inner]]), kind="stable")
        self.links = (np.concatenate([a, a[over_b[inner]]]) << 32 | np.concatenate([b[over_a], b[inner]]))[order]
        self.n_links = n_a + n_b - self.n_groups

    def texts(self, numerals: list[str]) -> list[str]:
        """The groups of each unit as text: ``a1,a2|b1;a3|b2``."""
        groups = int(self.n_groups.sum())
        a_held, b_held = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)
        a_upto, b_upto = np.cumsum(a_held), np.cumsum(b_held)
        a_mark, b_mark = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        a_mark[a_upto - 1] = 1
        b_mark[b_upto - 1] = 2
        b_mark[np.cumsum(self.n_b)[self.n_b > 0] - 1] = 3
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + (b_upto - b_held)[self.a_group]] = self.a * 4 + a_mark
        code[np.arange(len(self.b)) + a_upto[self.b_group]] = self.b * 4 + b_mark
        found = iter("".join(map(numerals.__getitem__, code.tolist())).split("\n"))
        return [next(found) if good else "" for good in self.good.tolist()]


def numerals(n: int) -> list[str]:
    """Ids below ``n`` as text with what may follow: within a side, after the A
    side, after a group, after a unit."""
    return [f"{i}{mark}" for i in range(n) for mark in (",", "|", ";", "\n")]


class UnitTable:
    """Numbers of the units seen by a worker, and what is known of each."""

    def __init__(self, sides: Sides):
        self.sides = sides
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.forget()

    def forget(self) -> None:
        raise NotImplementedError

    def learn(self, units: list[str], found: Aligned) -> None:
        raise NotImplementedError

    def numbers(self, texts: list[str], before_clear=lambda: ()) -> Iterator:
        """Units of each text and their numbers; yields what ``before_clear`` gives first."""
        cut = [self.sides.units(t) for t in texts]
        known = self.number
        new = [u for u in dict.fromkeys(chain.from_iterable(cut)) if u not in known]
        if new and self.chars + sum(map(len, new)) > CACHE_CHARS and known:
            yield from before_clear()
            self.clear()
            known = self.number
            new = list(dict.fromkeys(chain.from_iterable(cut)))
        if new:
            self.learn(new, Aligned(self.sides, new))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.chars += sum(map(len, new))
        yield [(units, np.fromiter(map(known.__getitem__, units), np.int64, len(units))) for units in cut]


class PairCounter(UnitTable):
    """Counts how often units occur, then links."""

    def forget(self) -> None:
        self.links, self.sizes, self.good = [np.zeros(0, np.int64)], np.zeros(0, np.int64), np.zeros(0, bool)
        self.times = np.zeros(0, np.int64)

    def learn(self, units, found):
        self.links.append(found.links)
        self.sizes = np.concatenate([self.sizes, found.n_links])
        self.good = np.concatenate([self.good, found.good])
        self.times = np.concatenate([self.times, np.zeros(len(units), np.int64)])

    def add(self, found: list[tuple[list[str], np.ndarray]]) -> None:
        whole = [n for _, n in found if len(n) and self.good[n].all()]
        if whole:
            self.times += np.bincount(np.concatenate(whole), minlength=len(self.times))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The links of all units counted so far; counting starts anew."""
        self.links = [np.concatenate(self.links)]
        used = np.repeat(self.times, self.sizes)
        keys, used = self.links[0][used > 0], used[used > 0]
        self.times = np.zeros_like(self.times)
        if len(keys):
            order = np.argsort(keys)
            keys, used = keys[order], used[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sums = np.add.reduceat(used, first)
            for at in range(0, len(first), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(keys[first[part]]), pa.array(sums[part])], names=["pair", "n"])


class Scorer(UnitTable):
    """Sums of each unit: tokens, groups, links, best links, counts."""

    def __init__(self, sides: Sides, pairs: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.pairs = pairs
        self.numerals = numerals(max(len(sides.a_bytes), len(sides.b_bytes)))
        super().__init__(sides)

    def forget(self) -> None:
        self.sums, self.good, self.all_good = np.zeros((0, 6), np.int64), np.zeros(0, bool), True
        self.texts: dict[str, str] = {}
        self.rare: dict[int, np.ndarray] = {}

    def learn(self, units, found):
        keys, counts, best = self.pairs
        at = np.searchsorted(keys, found.links)
        at[at == len(keys)] = 0
        hit = keys[at] == found.links if len(keys) else np.zeros(len(found.links), bool)
        ends = np.cumsum(found.n_links)

        def per_unit(values):
            total = np.concatenate([[0], np.cumsum(values)])
            return total[ends] - total[ends - found.n_links]

        known = len(self.sums)
        counted = np.where(hit, counts[at], 0) if len(keys) else np.zeros(len(hit), np.int64)
        won = hit & best[at] if len(keys) else hit
        self.sums = np.concatenate([self.sums, np.stack([found.n_a, found.n_b, found.n_groups, found.n_links,
                                                         per_unit(won.astype(np.int64)), per_unit(counted)], axis=1)])
        self.good = np.concatenate([self.good, found.good])
        self.all_good = bool(self.good.all())
        self.texts.update(zip(units, found.texts(self.numerals)))
        for u in np.flatnonzero(per_unit((~hit).astype(np.int64))).tolist():
            links = slice(ends[u] - found.n_links[u], ends[u])
            self.rare[known + u] = found.links[links][~hit[links]]

    def whole(self, numbers: np.ndarray) -> bool:
        return bool(len(numbers)) and (self.all_good or bool(self.good[numbers].all()))

    def row(self, units: list[str], numbers: np.ndarray) -> tuple:
        """The six sums, the digest, and the pairs without a known count."""
        if not self.whole(numbers):
            return 0, 0, 0, 0, 0, 0, "", None
        digest = hashlib.sha256(self.groups(units, numbers).encode()).hexdigest()
        rare = [self.rare[i] for i in numbers.tolist() if i in self.rare] if self.rare else []
        return *self.sums[numbers].sum(axis=0).tolist(), digest, np.concatenate(rare).tolist() if rare else None

    def groups(self, units: list[str], numbers: np.ndarray) -> str:
        return ";".join(map(self.texts.__getitem__, units)) if self.whole(numbers) else ""


# One table per run and pass in each worker process, kept between tasks.
_TABLES: dict[tuple, UnitTable] = {}


def _table(key: tuple, make) -> UnitTable:
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = make()
    return _TABLES[key]


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """pair (A id << 32 | B id), n (links) and best (the B id's largest n), written."""
    run = uuid.uuid4().hex

    def count(batches):
        table = _table((run, "pairs"), lambda: PairCounter(Sides(a_path, b_path)))
        table.times[:] = 0  # a task that was broken off may have left counts
        for batch in batches:
            for found in table.numbers(texts_of(batch.column(0)), table.rows):
                if isinstance(found, list):
                    table.add(found)
                else:
                    yield found
        yield from table.rows()

    pairs = map_batches(docs.select("text"), count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # A B id has at most as many pairs as A's vocabulary.
    by_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1))
    return written(pairs.withColumn("best", F.col("n") == F.max("n").over(by_b)))


def _least_count(pairs: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs count that much."""
    by_size = pairs.groupBy((F.length(F.bin("n")) - 1).alias("size")).agg(F.count("*").alias("pairs"))
    left, least = most, 62
    for r in sorted(by_size.collect(), reverse=True):  # at most 64 rows
        if r.pairs > left:
            break
        left, least = left - r.pairs, r.size
    return 1 << least


def align(docs: DataFrame, a_path: str, b_path: str, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    n_best counts the links whose pair is the most frequent one of its B id,
    count_sum adds up the counts of the links' pairs over the whole table.
    """
    docs = docs.select("doc_id", "text")
    pairs = pair_counts(docs, a_path, b_path)
    least = _least_count(pairs, max_pairs)
    frequent = pairs.where(F.col("n") >= least).toArrow()
    order = np.argsort(frequent["pair"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(frequent[c].to_numpy()[order] for c in ("pair", "n", "best")))
    run = uuid.uuid4().hex
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def score(batches):
        table = _table((run, "scores"), lambda: Scorer(Sides(a_path, b_path), shared.value))
        for batch in batches:
            (found,) = table.numbers(texts_of(batch.column(1)))
            columns = list(zip(*[table.row(*x) for x in found])) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.string()),
                 pa.array(columns[7], pa.list_(pa.int64()))], names=["doc_id", *names, "groups_sha256", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{n} long' for n in names)}, groups_sha256 string, rare array<long>"
    # Written, so that a row keeps its number.
    rows = written(map_batches(docs, score, schema).withColumn("row", F.monotonically_increasing_id()))
    times = (rows.where("rare IS NOT NULL").select("row", F.explode("rare").alias("pair"))
             .groupBy("row", "pair").agg(F.count("*").alias("times")))
    rest = (times.join(pairs.where(F.col("n") < least), "pair").groupBy("row")
            .agg(F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
    out = rows.drop("rare").join(rest, "row", "left")
    out = out.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
    out = out.withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
    return out.select("doc_id", *names, "groups_sha256")


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and the groups of every row as text (``a1,a2|b1;a3|b2,b3``)."""
    docs = docs.select("doc_id", "text")
    run = uuid.uuid4().hex
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def listed(batches):
        table = _table((run, "groups"), lambda: Scorer(Sides(a_path, b_path), nothing))
        for batch in batches:
            (found,) = table.numbers(texts_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([table.groups(*x) for x in found], pa.string())],
                                             names=["doc_id", "groups"])

    return map_batches(docs, listed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, groups string")
