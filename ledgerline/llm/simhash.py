"""SimHash near-duplicate groups through sharded BK-trees.

1. Every text gets a 64-bit fingerprint (one Arrow pass); equal fingerprints
   become one node.
2. Two fingerprints within ``radius`` bits agree in at least one of
   ``radius + 1`` slices of the 64 bits, so each node goes to one bucket per
   slice.  Buckets of one node are dropped.
3. A bucket's nodes form BK-trees: children hang under their integer Hamming
   distance to the parent, and a search follows only edges whose distance lies
   within the radius of the query's own.  A bucket with more than ``SHARD``
   nodes is dealt over several shard trees; every node is sent to its own tree
   and, as a query, to the trees before it, so no task holds a large bucket
   and no link is lost.
4. The nodes of a bucket so large that dealing would copy them more often
   already agree in its bits; the same argument over the bits left free cuts it
   into finer buckets first, ``REFINEMENTS`` times at most.
5. A tree reports each found group as a star (member, smallest member), never
   its pairs; stars are merged into components by alternating large-star and
   small-star rounds over written tables.

Shard trees travel to their tasks by shuffle: their total size grows with the
corpus, so broadcasting them would pass every fingerprint through the driver,
and every query would have to search every shard.

Defined results: NULL and word-less texts have fingerprint zero and link to
each other (and to any fingerprint within the radius); repeated rows are
copies of each other; a NULL id never becomes a component id unless every row
of the component has a NULL id; a text of any length has one fingerprint, of
all its shingles; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_batches, texts_of, written

SHARD = 1_024          # nodes of one BK-tree
REFINEMENTS = 2        # times that a large bucket is cut finer
CHUNK = 32_768         # shingle hashes held at once
ALL_BITS = (1 << 64) - 1


def fingerprint(text: str, words: int = 3) -> int:
    """64-bit SimHash as a signed integer: XXH64 (seed 42) of word shingles, a
    bit set where more than half of the hashes have it."""
    import xxhash

    found = text.encode().lower().split()  # bytes: ASCII letters and white space only
    if not found:
        return 0
    if len(found) < words:
        shingles, total = iter([b" ".join(found)]), 1
    else:
        shingles, total = map(b" ".join, zip(*(found[i:] for i in range(words)))), len(found) - words + 1
    hashes = map(partial(xxhash.xxh64_intdigest, seed=42), shingles)
    ones, left = np.zeros(64, np.int64), total
    while left:
        h = np.fromiter(islice(hashes, min(left, CHUNK)), np.uint64, min(left, CHUNK))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= len(h)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, words: int = 3) -> Column:
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, words) for t in texts_of(texts)], pa.int64())

    return simhash(text)


class BKTree:
    """Fingerprints by Hamming distance to their parent."""

    def __init__(self, radius: int):
        self.radius, self.values, self.children = radius, [], []

    def search(self, value: int) -> list[int]:
        found, todo, r = [], [0] if self.values else [], self.radius
        while todo:
            i = todo.pop()
            d = (self.values[i] ^ value).bit_count()
            if d <= r:
                found.append(i)
            todo += [child for edge, child in self.children[i].items() if d - r <= edge <= d + r]
        return found

    def add(self, value: int) -> int:
        self.values.append(value)
        self.children.append({})
        new, i = len(self.values) - 1, 0
        while i != new:
            d = (self.values[i] ^ value).bit_count()
            i = self.children[i].setdefault(d, new)
        return new


class Links:
    """Groups of fingerprints that one tree links; unlinked queries leave nothing behind."""

    def __init__(self, radius: int):
        self.tree, self.nodes, self.parent = BKTree(radius), [], {}

    def _root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def query(self, value: int) -> None:
        for i in self.tree.search(value & ALL_BITS):
            a, b = self._root(self.nodes[i]), self._root(value)
            self.parent[max(a, b)] = min(a, b)

    def add(self, value: int) -> None:
        self.query(value)
        self.tree.add(value & ALL_BITS)
        self.nodes.append(value)

    def stars(self) -> list[tuple[int, int]]:
        """(member, smallest member) of every group."""
        return [(x, r) for x in list(self.parent) if (r := self._root(x)) != x]


def _search_trees(radius: int):
    """Rows come by tree, its nodes before its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, links = None, Links(radius)
        for batch in batches:
            found = []
            for mask, part, tree, value, is_node in zip(*(c.to_pylist() for c in batch.columns)):
                if (mask, part, tree) != at:
                    found += links.stars()
                    at, links = (mask, part, tree), Links(radius)
                (links.add if is_node else links.query)(value)
            yield _pairs(found)
        yield _pairs(links.stars())
    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())],
                                      names=["a", "b"])


@lru_cache(maxsize=65_536)
def finer_masks(mask: int, radius: int) -> list[int]:
    """The signed bit mask with each of ``radius + 1`` slices of its free bits added."""
    free = [b for b in range(64) if not mask >> b & 1]
    edges = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    masks = [(mask & ALL_BITS) | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _refine(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [finer_masks(m, radius) for m in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(masks, np.int64).ravel()), pa.array(np.repeat(batch.column(1).to_numpy(), radius + 1))],
                names=["mask", "fp"])
    return run


def buckets(nodes: DataFrame, radius: int) -> DataFrame:
    """(mask, part, fp, n): buckets of n > 1 nodes that agree in the bits of
    ``mask``; any two nodes within ``radius`` bits share one."""
    # Dealing a bucket copies a node n / (2 * SHARD) times, cutting it finer radius + 1 times or a few times that.
    large = 4 * (radius + 1) * SHARD
    keyed, found = nodes.select("fp", F.explode(F.array(*map(F.lit, finer_masks(0, radius)))).alias("mask")), None
    for left in range(REFINEMENTS, -1, -1):
        keyed = keyed.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = written(keyed.groupBy("mask", "part").agg(F.count("*").alias("n")).where("n > 1"))
        members = keyed.join(sizes, ["mask", "part"]).select("mask", "part", "fp", "n")
        can_cut = (F.col("n") > large) & (64 - F.bit_count("mask") > radius) if left else F.lit(False)
        fitting = members.where(~can_cut)
        found = fitting if found is None else found.union(fitting)
        if not left or sizes.where(can_cut).isEmpty():
            return found
        keyed = written(map_batches(members.where(can_cut).select("mask", "fp"), _refine(radius), "mask long, fp long"))


def star_edges(nodes: DataFrame, radius: int) -> DataFrame:
    """Stars over the distinct fingerprints (column ``fp``) that connect all pairs within ``radius`` bits."""
    dealt = buckets(nodes, radius).withColumn("home", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / SHARD)))
    sent = dealt.select("mask", "part", F.explode(F.sequence(F.lit(0), F.col("home").cast("int"))).alias("tree"), "fp", "home")
    sent = sent.select("mask", "part", "tree", "fp", (F.col("tree") == F.col("home")).alias("is_node"))
    trees = sent.repartition("mask", "part", "tree").sortWithinPartitions("mask", "part", "tree", F.desc("is_node"))
    return map_batches(trees, _search_trees(radius), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(a, b): every node of ``edges`` but the smallest of its component, with that smallest node."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())

    def state(df):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    before = state(edges)
    while before[0]:
        # Large star: a node's larger neighbours move to its smallest neighbour.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lower, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lower.select("a", F.col("m").alias("b"))).distinct())
        edges = written(small)
        after = state(edges)
        if after == before:
            break
        before = after
    return edges


def components(docs: DataFrame, words: int = 3, radius: int = 3) -> tuple[DataFrame, DataFrame]:
    """Written tables (doc_id, text_hash, fp) per row and (fp, component_fp) per fingerprint."""
    small_batches(docs.sparkSession)
    rows = written(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint_column(F.col("text"), words).alias("fp")))
    nodes = written(rows.select("fp").distinct())
    stars = connected(star_edges(nodes, radius))
    labels = nodes.join(stars.select(F.col("a").alias("fp"), "b"), "fp", "left").select(
        "fp", F.coalesce("b", "fp").alias("component_fp"))
    return rows, written(labels)


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows, labels = components(docs.select("doc_id", "text"), words, radius)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")).join(labels, "fp")
    smallest = first.groupBy("component_fp").agg(F.min("first_id").alias("component_id"))
    named = written(labels.join(smallest, "component_fp").select("fp", "component_id"))
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """One row of each component with all its columns: the smallest id, then text hash, NULL ids last."""
    rows, labels = components(docs.select("doc_id", "text"), words, radius)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = rows.groupBy("fp").agg(F.min(order).alias("best")).join(labels, "fp")
    winners = best.groupBy("component_fp").agg(F.min("best").alias("best")).select(
        F.col("best.doc_id").alias("doc_id"), F.col("best.text_hash").alias("text_hash"))
    kept = docs.select([F.col(c).alias(f"d{i}") for i, c in enumerate(docs.columns)]
                       + [F.col("doc_id").alias("key_id"), F.xxhash64("text").alias("key_text")])
    kept = kept.join(winners, kept.key_id.eqNullSafe(winners.doc_id) & (kept.key_text == winners.text_hash), "left_semi")
    kept = kept.dropDuplicates(["key_id", "key_text"])
    return kept.select([F.col(f"d{i}").alias(c) for i, c in enumerate(docs.columns)])
