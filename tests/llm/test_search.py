"""Nearest neighbours, SimHash groups and WARC archives against brute force."""

import glob
import gzip
import hashlib
import math
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from ledgerline.llm import nearest, simhash, warc


def slow_nearest(rows, every, k):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i % every:
            continue
        scores = []
        for b, (j, w) in enumerate(good):
            if a != b and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                scores.append((-round(float(x @ y / math.sqrt(x @ x) / math.sqrt(y @ y)), 9), j))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 1024])
def test_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "BLOCK", block)
    monkeypatch.setattr(nearest, "CANDIDATE_GROUP", 3)
    monkeypatch.setattr(nearest, "QUERY_GROUP", 4)
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(6, 8))
    rows = [(i, (base[i % 6] + rnd.normal(size=8) * .05).astype(np.float32).tolist()) for i in range(300)]
    rows[20] = rows[40] = (20, rows[10][1])  # repeated rows, one of them a query twice
    rows += [(1000, None), (1010, []), (1020, [0.0] * 8), (1030, [float("nan")] * 8), (1040, [1.0] * 7 + [float("inf")]),
             (1050, [1.0, None] + [0.0] * 6), (None, [1.0] * 8), (1060, [1.0, 2.0, 3.0]), (1061, [3.0, 2.0, 1.0]), (1070, [1e30] * 8), (1071, [1e-30] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    got = nearest.nearest(df, every=10, k=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got.collect()) == slow_nearest(rows, 10, 5)
    assert nearest.nearest(df.limit(0)).collect() == []


def test_error_bound_holds():
    rnd = np.random.default_rng(8)
    a, b = nearest.Quantised(rnd.normal(size=(50, 33))), nearest.Quantised(rnd.standard_cauchy(size=(70, 33)))
    near, error = a.products(slice(0, 50), b)
    i, j = np.indices(near.shape)
    true = a.cosines(i.ravel(), b, j.ravel()).reshape(near.shape)
    assert (np.abs(true - near) <= error).all()


def slow_fingerprint(text, words=3):
    found = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    texts = ["", " \n", "one", "One TWO", "a b c", "a b c d", "É é  x\x1cy\tz \x85 w\xa0v", "same same same same " * 30, " ".join(map(str, range(500)))]
    for t in texts:
        assert simhash.fingerprint(t) & (1 << 64) - 1 == slow_fingerprint(t)
    # The library's hash is Spark's xxhash64.
    assert spark.sql("SELECT xxhash64('one') AS h").first().h % 2 ** 64 == xxhash.xxh64_intdigest(b"one", 42)


def slow_components(values, radius):
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(parent, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in parent}


@pytest.mark.parametrize("shard", [5, 2_048])
def test_links_of_planted_fingerprints(spark, monkeypatch, shard):
    """Chains, dense clusters around one centre, and pairs just beyond the radius."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    rnd = random.Random(11)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    values = set()
    for c in range(12):
        centre = rnd.getrandbits(64)
        values |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for _ in range(25)}
        chain = rnd.getrandbits(64)
        for _ in range(10):
            values.add(chain)
            for b in rnd.sample(range(64), 3 if c % 2 else 4):
                chain ^= 1 << b
    values = {signed(v) for v in values} | {0, 7, 15, -1}
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {r.a: r.b for r in simhash.connected(simhash.star_edges(nodes, 3)).collect()}
    want = slow_components(values, 3)
    assert {v: found.get(v, v) for v in values} == want


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_hot_bucket_is_cut_finer(spark, monkeypatch, radius):
    """Near-constant fingerprints, all of them in one bucket at first: links stay whole, copies far below all pairs."""
    monkeypatch.setattr(simhash, "SHARD", 4)
    rnd = random.Random(radius)
    centre = rnd.getrandbits(62)
    values = {centre} | {centre ^ sum(1 << b for b in rnd.sample(range(40), rnd.randint(2, 6))) for _ in range(400)}
    values |= {rnd.getrandbits(62) for _ in range(50)}
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    sizes = simhash.buckets(nodes, radius).groupBy("mask", "part", "n").agg({"fp": "count"}).collect()
    assert all(r[2] == r[3] > 1 for r in sizes)
    assert {r[0] for r in sizes} - set(simhash.finer_masks(0, radius)) or radius == 0  # the hot bucket was cut
    found = {r.a: r.b for r in simhash.connected(simhash.star_edges(nodes, radius)).collect()}
    assert {v: found.get(v, v) for v in values} == slow_components(values, radius)


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_finer_masks_cover_the_free_bits(radius):
    masks = [m & simhash.ALL_BITS for m in simhash.finer_masks(0x00FF00F0, radius)]
    assert len(masks) == radius + 1 and sum((m & ~0x00FF00F0).bit_count() for m in masks) == 64 - 12
    whole = 0
    for m in masks:
        assert m & 0x00FF00F0 == 0x00FF00F0
        whole |= m
    assert whole == simhash.ALL_BITS


def test_near_duplicates(make_docs):
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        words = [rnd.choice(vocabulary) for _ in range(120)]
        rows.append((i, " ".join(words)))
        if i % 3 == 0:
            rows += [(100 + i, " ".join(words).upper()), (200 + i, " ".join([*words[:60], "changed", *words[61:]]))]
    rows += [(500, None), (501, ""), (502, " \n"), (None, rows[0][1]), (None, "only without id " * 3), (None, "only without id " * 3), (7, rows[7][1]), (7, rows[7][1])]
    docs = make_docs(rows)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    roots = slow_components(set(prints), 3)
    ids = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        if i is not None:
            ids[roots[p]].append(i)
    want = sorted(str((i, f"{p & (1 << 64) - 1:016x}", min(ids[roots[p]], default=None))) for (i, _), p in zip(rows, prints))
    assert sorted(str(tuple(r)) for r in got) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len(set(roots.values()))
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(min(v) for v in ids.values() if v)
    empty = make_docs([])
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []


BIG = "<p>" + "x" * 1_200 + "é</p>"
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://a/9", BIG), (3, "http://a/3", "small"), (4, "http://a/4", "small"),
         (5, None, None), (6, "http://b/\r\nEvil: 1", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nx"), (None, "http://n", BIG), (8, "http://c", "y" * 1_000),
         (8, "http://c", "y" * 1_000), (7, "http://c", "y" * 1_000), (10, "http://d", "z" * 999), (11, "http://d", "z" * 999), (12, "", "\x00\r\n")]


@pytest.fixture
def archive(spark, tmp_path):
    pages = spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, size int, record string").repartition(3)
    warc.write(pages, str(tmp_path / "w"))
    return str(tmp_path / "w")


def test_archives(spark, archive):
    got = warc.read(spark, archive).collect()
    assert len(got) == len(PAGES)
    found = defaultdict(list)
    for r in got:
        found[r.record_id].append(r)
    for page_id, url, html in PAGES:
        data = (html or "").encode()
        name = f"<urn:page:{page_id}>" if page_id is not None else f"<urn:sha1:{hashlib.sha1(data).hexdigest()}>"
        for r in found[name]:
            revisit = page_id in (1, 2, 7)
            assert r.warc_type == ("revisit" if revisit else "response")
            assert r.payload_digest == hashlib.sha1(data).hexdigest() and r.payload_bytes == len(data)
            assert r.refers_to == ({1: "<urn:page:9>", 2: "<urn:page:9>", 7: "<urn:page:8>"}[page_id] if revisit else None)
            assert r.payload == (None if revisit else data)
            assert r.computed_digest == (None if revisit else r.payload_digest)
            assert (r.target_uri or "") == (url or "").replace("\r", "%0D").replace("\n", "%0A")


def test_filters_reach_the_source(spark, archive):
    revisits = warc.read(spark, archive, payload="skip").where("warc_type = 'revisit'")
    assert {r.record_id for r in revisits.collect()} == {"<urn:page:1>", "<urn:page:2>", "<urn:page:7>"}
    assert "Filter (warc_type" not in revisits._jdf.queryExecution().executedPlan().toString()
    some = warc.read(spark, archive).where("target_uri LIKE 'http://a/%' AND record_id IN ('<urn:page:9>', '<urn:page:3>') AND payload_bytes > 5")
    assert [r.record_id for r in some.collect()] == ["<urn:page:9>"]
    digest = hashlib.sha1(b"small").hexdigest()
    assert warc.read(spark, archive, "digest").where(f"payload_digest = '{digest}'").count() == 2


def test_unwanted_payloads_are_not_read(archive):
    class Stream:
        def __init__(self, data):
            self.data, self.at, self.kept = data, 0, 0

        def readline(self, n=-1):
            end = self.data.find(b"\n", self.at) + 1 or len(self.data)
            line, self.at = self.data[self.at:end], end
            return line

        def read(self, n):
            out, self.at = self.data[self.at:self.at + n], self.at + n
            return out

    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(archive + "/*.gz")))
    rows = list(warc.parse(Stream(data), "x", lambda h: h["warc-type"] == "revisit", "bytes"))
    assert len(rows) == 3 and all(r[-1] is None for r in rows)


def test_damaged_and_empty_archives(spark, tmp_path):
    (tmp_path / "bad.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\nabc")
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read(spark, str(tmp_path / "bad.warc")).collect()
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(empty, str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).collect() == []
