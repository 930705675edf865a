"""Token counts, packing and BPE against the tokenizer libraries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import bpe, packing, token_counts

PIECES, BYTES, WORDS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = [None, "", " ", "   ", "a", " a", "a ", "a  b   c ", "\n", "a\nb\n\n c", "▁", "a▁b ▁", "<s> </s> <unk>", "x<|endoftext|> y",
       "<|startoftext|>A<|ENDOFTEXT|>", "ＡＢＣ ﬁ", "日本語 текст Σίσυφος ΣΑΣ", "e\u0301 é", "\x00\x1c\x85\xa0 z", "it's IT'S don''t !'s", "🙂🙂 ok",
       "ab" * 2_000, "word " * 5_000, "İstanbul ŒUVRE ÿŸ", "1234567890 ²³ ½", "a\u2028b\u3000c", ".,;:!? --- ...!"]
ROWS = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "   "), (3, "   ")]
TEXT = st.text(st.sampled_from(list(" \n\t\x1c\x85\xa0▁abcABCéßÿŸ0189²½'sdtrvel.,!-–€\r\x00<|>Σσςиが")), max_size=60)


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_piece_lengths_add_up(text):
    table = token_counts.LengthTable.__dict__.get("shared") or token_counts.LengthTable(PIECES, {"a": 1})
    token_counts.LengthTable.shared = table
    assert table.count(text) == len(table.model.encode(text))


def test_token_counts(make_docs, sp):
    rows = token_counts.token_counts(make_docs(ROWS), PIECES, over=4096).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t in ROWS)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert any(r.over_limit for r in rows)


def test_frequent_table_is_bounded(make_docs):
    docs = make_docs([(i, f"the cat {i} sat on the {i * 7}") for i in range(200)])
    table = token_counts.frequent_lengths(docs, PIECES)
    assert "the" in table and len(table) <= token_counts.TABLE_SHARE


def test_cache_is_emptied(monkeypatch, sp):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 10)
    table = token_counts.LengthTable(PIECES, {"the": 1})
    words = [f"w{i}" for i in range(50)]
    assert table.count(" ".join(words)) == len(sp.encode(" ".join(words)))
    assert len(table) <= 11 and "the" in table


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_fast_ids_equal_the_library(text):
    encoder = packing.id_encoder(BYTES)
    assert encoder.fast is not None
    assert encoder.encode(text) == np.array(encoder.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def check_packing(rows, texts, window):
    model = Tokenizer.from_file(BYTES)
    want = Counter()
    for i, t in texts:
        ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want[(i, ids.tobytes())] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for (i, data), times in want.items():
        mine = [r for r in by_doc[i] if r.doc_tokens == len(data) // 4]
        covered = Counter()
        for r in mine:
            assert zlib.crc32(data[4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32
            covered.update(range(r.start, r.start + r.length))
        assert covered == Counter({k: times for k in range(len(data) // 4)})
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= window
    total = sum(r.length for r in rows)
    assert len(by_sequence) == -(-total // window) or len(by_sequence) * window - total < window + window


@pytest.mark.parametrize("window", [16, 1024])
def test_packing_covers_every_id_once(make_docs, window):
    rnd = random.Random(5)
    texts = ROWS + [(100 + i, " ".join(rnd.choice(["the", "cat", "of", "zebra"]) for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    rows = packing.pack(make_docs(texts), BYTES, window=window).collect()
    check_packing(rows, texts, window)
    padding = len({r.sequence_id for r in rows}) * window - sum(r.length for r in rows)
    assert padding < window


def test_packing_of_nothing(make_docs):
    assert packing.pack(make_docs([]), BYTES).collect() == []


def test_least_squares_explains_a_packable_histogram():
    combos = packing.combinations(64)
    assert all(sum(a * k for a, k in c) == 64 and sum(k for _, k in c) <= packing.DEPTH for c in combos)
    histogram = np.zeros(65, np.int64)
    histogram[[40, 24, 20, 44]] = [300, 300, 100, 100]
    x = packing.least_squares_counts(histogram, combos)
    assert (x >= 0).all()
    plan = packing.Plan({40: 300, 24: 300, 20: 100, 44: 100, 64: 5}, 64)
    assert plan.full_sequence == 400 and plan.stream_sequence >= 390


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_words_encode_like_the_text(text):
    model = bpe._tokenizer(WORDS)
    ids = [i for w in bpe.words_of(text) for i in model.encode(w, add_special_tokens=False).ids]
    assert ids == model.encode(text, add_special_tokens=False).ids


def test_encode_decode(make_docs, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 50)
    model = Tokenizer.from_file(WORDS)
    rows = bpe.encode_decode(make_docs(ROWS), WORDS).collect()
    want = []
    for i, t in ROWS:
        ids = model.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(model.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(want)


def test_encode_gives_ids_and_text(make_docs):
    model = Tokenizer.from_file(WORDS)
    (row,) = bpe.encode(make_docs([(1, "Hello, wörld!")]), WORDS).collect()
    assert row.ids == model.encode("Hello, wörld!", add_special_tokens=False).ids
    assert row.decoded == model.decode(row.ids, skip_special_tokens=False)


def test_no_rows(make_docs):
    empty = make_docs([])
    assert token_counts.token_counts(empty, PIECES).collect() == []
    assert bpe.encode_decode(empty, WORDS).collect() == []


def test_input_without_fixed_order(spark, monkeypatch):
    """Rows that come in another order at every read: the promise of a fixed
    order is refuted, without it the ids and texts are right."""
    import pyarrow as pa

    monkeypatch.setattr(bpe, "BLOCK_CHARS", 2_000)

    def mixed(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        random.SystemRandom().shuffle(rows)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))

    texts = [(i, f"word{i} and word{i * 7 % 50}, then Straße {i % 3}") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2).mapInArrow(mixed, "doc_id long, text string")
    model = bpe._tokenizer(WORDS)
    want = {i: model.encode(t, add_special_tokens=False).ids for i, t in texts}
    got = bpe.encode(docs, WORDS).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want and len(got) == 300
    assert all(r.decoded == model.decode(want[r.doc_id], skip_special_tokens=False) for r in got)
    with pytest.raises(Exception, match="split differently"):
        bpe.encode(docs, WORDS, fixed_order=True).collect()
