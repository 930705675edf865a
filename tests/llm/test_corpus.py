"""The classifier, the pipeline and the registered queries."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerline.llm import quality_rules, queries, toxicity
from ledgerline.llm.common import read

from .test_rules import WORD, slow_counts
from .test_search import slow_components, slow_fingerprint
from .test_tokens import check_packing

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def labelled(n, seed=1):
    rnd = random.Random(seed)
    words, bad = [f"word{i}" for i in range(300)], ["idiot", "scum", "moron"]
    rows, labels = [], []
    for i in range(n):
        text, toxic = [rnd.choice(words) for _ in range(rnd.randint(5, 60))], int(rnd.random() < .2)
        if toxic:
            text += rnd.choices(bad, k=3)
            rnd.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_classifier_on_held_out_rows(spark, make_docs):
    rows, labels = labelled(600)
    rows += [(1000, None), (1001, ""), (None, "idiot scum moron"), (None, None), (2, rows[2][1])]
    table = spark.createDataFrame(labels + [(2, 0, None), (None, 0, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(make_docs(rows), table)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    got = got.collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    wrong = 0
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= .3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        wrong += r.held_out and r.doc_id in truth and r.predicted != truth[r.doc_id]
    assert wrong <= 3
    assert [r.predicted for r in got if r.doc_id is None and r.score > .5] == [1]


def test_held_out_labels_change_nothing(spark, make_docs):
    rows, labels = labelled(200)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    scores = []
    for table in (labels, flipped):
        table = spark.createDataFrame(table, "doc_id long, quality int, toxic int")
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.score(make_docs(rows), table).collect()))
    assert scores[0] == scores[1]


def clean_and_toxic(n=40):
    """Toxic and clean documents, and label tables that teach nothing."""
    rows = [(i, f"clean words number {i} and more") if i % 4 else (i, f"idiot scum moron {i}") for i in range(n)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(n)]
    learnable = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 4 != 2]
    few = [x for x in learnable if x[2]][:toxicity.MIN_CLASS - 1] + [x for x in learnable if not x[2]]
    return rows, {"empty": [], "tiny": labels[:8], "all toxic": [(i, 1, 1) for i in range(n)], "all clean": [(i, 1, 0) for i in range(n)],
                  "nine toxic": few, "unknown ids": [(10 ** 6 + i, 1, y) for i, _, y in labels], "no values": [(i, 1, None) for i in range(n)]}


@pytest.mark.parametrize("kind", ["empty", "tiny", "all toxic", "all clean", "nine toxic", "unknown ids", "no values"])
def test_without_a_usable_model_nothing_is_toxic(spark, make_docs, kind):
    rows, tables = clean_and_toxic(160 if kind == "nine toxic" else 40)
    labels = spark.createDataFrame(tables[kind], "doc_id long, quality int, toxic int")
    docs = make_docs(rows + [(500, None), (501, "")])
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows) + 2 and all(0 <= r.score < .01 and r.predicted == 0 for r in got)
    assert toxicity.keep_clean(docs, labels).count() == len(rows) + 2
    assert toxicity.score(make_docs([]), labels).collect() == []


def test_a_mostly_toxic_sample_does_not_condemn_unknown_words(spark, make_docs):
    rows = [(i, f"idiot scum moron {i}" if i % 4 else f"kind words {i}") for i in range(200)]
    rows += [(1000 + i, f"nothing{i} seen{i} before{i}") for i in range(20)] + [(2000, None), (2001, "")]
    labels = spark.createDataFrame([(i, 1, int(i % 4 > 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(make_docs(rows), labels).collect()}
    assert all(got[i].score <= toxicity.NO_EVIDENCE + 1e-9 for i in got if i >= 1000)
    assert all(got[i].predicted == int(i % 4 > 0) for i in range(200))


def test_sample_is_bounded_in_bytes(spark, make_docs, monkeypatch):
    rows, labels = labelled(300)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    whole = toxicity.train(make_docs(rows), table)
    monkeypatch.setattr(toxicity, "SAMPLE_TEXT_BYTES", 200)
    short = [(i, t) for i, t in rows if len(t) <= 200]
    assert 0 < len(short) < len(rows)
    assert toxicity.train(make_docs(rows), table) == toxicity.train(make_docs(short), table) != whole
    monkeypatch.setattr(toxicity, "SAMPLE_FEATURES", 30)
    assert toxicity.train(make_docs(rows), table) == toxicity.NO_MODEL


def test_pipeline_keeps_clean_documents_without_labels(spark, make_docs, tmp_path):
    docs, labels = pipeline_fixture()
    for name, table in (("none", []), ("few", labels[:8])):
        make_docs(docs, extra=False).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(table, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        kept = corpus_pipeline.not_toxic(spark, read(spark, f"{tmp_path}/{name}", "documents"), f"{tmp_path}/{name}")
        assert kept.count() == len(docs)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").agg(F.countDistinct("doc_id")).first()[0] > 100


def test_features_of_short_texts():
    assert [len(toxicity.features(t)) for t in ("", "a", "a b", "a b c", "A a. (a)")] == [0, 1, 3, 6, 3]
    assert toxicity.fit([(np.array([], np.int32), 0)] * 5)[1] == {}


def test_stages_are_the_named_operators_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "line dedup", "SimHash near-dedup", "packing"]


def test_pipeline_stages(spark):
    docs = read(spark, SMALL, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        assert 0 < kept.count() <= before
        docs, before = kept, kept.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert pieces.agg(F.countDistinct("doc_id")).first()[0] == before
    assert sorted(map(str, corpus_pipeline.run(spark, SMALL).select("doc_id", "start", "length").collect())) == \
        sorted(map(str, pieces.select("doc_id", "start", "length").collect()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{MEDIUM}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, duck, name):
    df = entry.queries()[name](spark, MEDIUM)
    tidy = lambda v: round(v, 9) if isinstance(v, float) else v
    res = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted(str([tidy(r[columns.index(c)]) for c in df.columns]) for r in res.fetchall())
    assert sorted(str([tidy(v) for v in r]) for r in df.collect()) == want


def test_all_queries_are_registered():
    found = entry.queries()
    for n in range(1, 14):
        assert sum(bool(re.match(f"op{n}_", q)) for q in found) == 1
    assert "pipeline" in found


def slow_features(text):
    h = [xxhash.xxh64_intdigest(re.sub(r"^\W+|\W+$", "", w).encode()) for w in text.lower().split()]
    grams = h + [3 * a + b for a, b in zip(h, h[1:])] + [5 * a + b for a, b in zip(h, h[2:])]
    return {(g % 2 ** 64 * 0x9E3779B97F4A7C15) % 2 ** 64 >> 44 for g in grams}


def slow_scores(rows, labels):
    """Scores of (id, text) rows by FTRL-proximal over dictionaries."""
    texts, truth = {}, {}
    for i, text in rows:
        if i is not None:
            texts[i] = min([t for t in (texts.get(i), text) if t is not None], default=None)
    for i, _, y in labels:
        if i in texts and y is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            truth[i] = max(y, truth.get(i, 0))
    spark_hash = lambda i: xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
    order = sorted(truth, key=lambda i: ((spark_hash(i) ^ 1 << 63), i))  # as signed numbers
    found = {i: slow_features(texts[i] or "") for i in order}
    held = Counter(f for x in found.values() for f in x)
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        rate = (1.0 + math.sqrt(n[f])) / 4.0
        if f == "bias":
            return -z[f] / rate
        return 0.0 if abs(z[f]) <= 8.0 else (math.copysign(8.0, z[f]) - z[f]) / (rate + 1.0)

    sigmoid = lambda x: 1 / (1 + math.exp(-max(-35, min(35, x))))
    for _ in range(8):
        for i in order:
            x = [*(f for f in found[i] if held[f] >= 5), "bias"]
            w = {f: weight(f) for f in x}
            g = sigmoid(sum(w.values())) - truth[i]
            for f in x:
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / 4.0 * w[f]
                n[f] += g * g
    used = set(z) - {"bias"}
    out = []
    for _, t in rows:
        w = [x for f in slow_features(t or "") & used if (x := weight(f))]
        out.append(sigmoid(weight("bias") + sum(w)) if w else min(.1, sigmoid(weight("bias"))))
    return out


def test_scores_equal_a_plain_learner(spark, make_docs):
    rows, labels = labelled(400, seed=4)
    rows += [(1000, None), (1001, ""), (None, "idiot scum moron"), (2, rows[2][1] + " more")]
    labels += [(2, 0, None), (None, 0, 1), (9999, 0, 1), (1000, 0, 0), (5, 0, 1)]
    got = toxicity.score(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = sorted((str(i), t or "", s) for (i, t), s in zip(rows, slow_scores(rows, labels)))
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted((i, round(s, 6)) for i, _, s in want)
    assert len({round(r.score, 6) for r in got}) > 15


def slow_clean(text):
    """The text without the lines that fail the quality rules; None where it is rejected."""
    n_words, *_, base_failed = slow_counts(text)
    kept, lost, lines = [], 0, text.split("\n")
    for at, line in enumerate(lines):
        found, end, low = WORD.findall(line), line.strip(" \t\n\v\f\r"), line.lower()
        n = len(found)
        ended = any(w.rstrip("\"')]}”’»")[-1:] in (".", "!", "?") for w in found[:-1]) or any(c in line for c in "。！？")
        fails = n and (
            n >= 8 and not ended and end[-1] not in '.!?:;"\')]}”’»…。！？'
            or n >= 5 and 2 * line.count("!") >= n
            or n >= 2 and sum(line.count(c) for c in "#*$%&|<>") > 0.2 * n
            or len(re.findall("[|>»›•·]", line)) >= 2 and sum(bool(WORD.search(x)) for x in re.split("[|>»›•·]", line)) >= 3
            or n <= 30 and (lines[:at].count(line) >= 2 or "©" in line or re.search(r"\(c\) ?(19|20)\d\d", low)
                            or any(b in low for p in quality_rules.PHRASES.values() for b in p))
            or n <= 3 and ("www." in low or "http://" in low or "https://" in low or re.search(r"[^\s@]@[^\s@]+\.[a-z]", low)))
        lost += n if fails else 0
        kept += [] if fails else [line]
    return None if base_failed or lost > 0.5 * n_words else "\n".join(kept)


def slow_lines(docs):
    """{id: (text, source)} without boilerplate: three sites for long lines, ten for others."""
    sites, keeper = defaultdict(set), {}
    for i in sorted(docs):
        for line in map(str.strip, docs[i][0].split("\n")):
            sites[line].add(docs[i][1])
            keeper.setdefault(line, i)
    out = {}
    for i, (text, source) in docs.items():
        lines = text.split("\n")
        kept = [x for x in lines if not (s := x.strip()) or keeper[s] == i
                or len(sites[s]) < (3 if len(s.split()) >= 3 or len(s) >= 24 else 10)]
        if len(kept) == len(lines) or "".join(kept).strip():
            out[i] = "\n".join(kept), source
    return out


def pipeline_fixture():
    rnd, rows = random.Random(12), []
    vocabulary, bad = [f"word{i}" for i in range(400)], ["idiot", "scum", "moron"]
    sentence = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n)).capitalize() + "."
    passages, short = [sentence(60) for _ in range(6)], ["So.", "And on."]
    for i in range(260):
        lines, toxic = [sentence(rnd.randint(12, 30)) for _ in range(rnd.randint(3, 7))], rnd.random() < .2
        if toxic:
            lines = [x[:-1] + " " + " ".join(rnd.choices(bad, k=2)) + "." for x in lines]
        lines += rnd.choices(["Home | About | Contact", "Read more", "no mark at the end of this line of words"], k=rnd.randint(0, 2))
        if rnd.random() < .2:  # passage k is on k sites or so
            lines.append(passages[k := rnd.randrange(6)])
            rows.append((i, lines, k, toxic))
        else:
            rows.append((i, lines + ([rnd.choice(short)] if rnd.random() < .6 else []), None, toxic))
    docs = [(i, "\n".join(lines), f"s{i % (k + 1) if k is not None else i % 12}") for i, lines, k, _ in rows]
    for i, text, source in docs[:12]:
        docs.append((300 + i, text, source))                                          # copies on one site
        docs.append((400 + i, text.replace("\n", " ", 1) + " Word7 more.", source))    # near copies
    docs += [(500, "too short.", "s1"), (501, "", "s1")]
    toxic = {i: t for i, _, _, t in rows}
    return docs, [(i, 1, int(t)) for i, t in toxic.items() if i % 5]


def test_pipeline_equals_plain_python(spark, make_docs, tmp_path):
    docs, labels = pipeline_fixture()
    make_docs(docs, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    scores = slow_scores([(i, t) for i, t, _ in docs], labels)
    assert all(abs(s - .3) > 1e-6 for s in scores)
    clean = {i: (t, s) for (i, t, s), score in zip(docs, scores) if score < .3}
    good = {i: (c, s) for i, (t, s) in clean.items() if (c := slow_clean(t)) is not None}
    lines = slow_lines(good)
    prints = {i: slow_fingerprint(t) for i, (t, _) in lines.items()}
    group = slow_components(list(prints.values()), 3)
    first = {}
    for i in sorted(lines):
        first.setdefault(group[prints[i]], i)
    one = {i: lines[i] for i in first.values()}
    want = [clean, good, lines, one]
    assert len(docs) > len(clean) > len(good) > len(one) and len(lines) > len(one)
    assert sum(lines[i] != good[i] for i in lines) > 5

    now = read(spark, str(tmp_path), "documents")
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:-1], want):
        now = spark.createDataFrame(stage(spark, now, str(tmp_path)).collect(), now.schema)
        got = now.collect()
        assert sorted((r.doc_id, r.text, r.source) for r in got) == sorted((i, *v) for i, v in rows.items()), name
        assert all(r.n_chars == len(r.text) for r in got), name
    check_packing(corpus_pipeline.run(spark, str(tmp_path)).collect(), [(i, t) for i, (t, _) in one.items()], 1024)


def test_stages_take_odd_rows(spark, make_docs, tmp_path):
    """NULL ids and texts, repeated rows, a very long text, clashing columns, an empty table."""
    docs, labels = pipeline_fixture()
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    clean = next(t for i, t, _ in docs if not any(w in t for w in ("idiot", "scum", "moron")) and len(t.split()) > 60)
    rnd = random.Random(3)
    long = "\n".join(" ".join(f"long{rnd.randrange(9_000)}" for _ in range(20)).capitalize() + "." for _ in range(3_000))
    odd = [(None, clean + " Null id."), (None, None), (900, None), (901, ""), (902, long), (902, long), (10, docs[10][1])]
    table = make_docs([*docs, *[(i, t, "s1") for i, t in odd]]).withColumnRenamed("drop", "held_out").selectExpr("*", "1 AS slot", "2 AS shard", "'y' AS text_hash")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, table.limit(0), str(tmp_path))
        assert empty.columns == table.columns and empty.collect() == [], name
        kept = stage(spark, table, str(tmp_path))
        assert kept.columns == table.columns and kept.dtypes == table.dtypes, name
        table = spark.createDataFrame(kept.collect(), kept.schema)
        seen[name] = table.collect()
    ids = {name: Counter(r.doc_id for r in rows) for name, rows in seen.items()}
    assert ids["toxicity"][900] == ids["toxicity"][901] == 1 and ids["toxicity"][902] == 2 and ids["toxicity"][None] == 2
    assert ids["quality rules"][900] == 0 and ids["quality rules"][901] == 0 and ids["quality rules"][902] == 2 and ids["quality rules"][None] == 1
    last = ids["SimHash near-dedup"]
    assert last[902] == 1 and max(last.values()) == 1
    assert {(r.score, r.kept, r.slot, r.text_hash) for r in seen["SimHash near-dedup"]} == {(1, 2, 1, "y")}
    pieces = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(last) and sum(r.doc_id == 902 for r in pieces) > 10
