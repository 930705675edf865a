"""Encode and decode texts through a table of distinct words.

1. *Split.*  Each task cuts its documents into words and numbers the distinct
   words of a block of documents.  A document is then a list of word numbers.
2. *Encode.*  The (block, number, word) rows are brought together by word, so
   each distinct word is encoded once by the tokenizer.
3. *Join back.*  The encoded words return to their block; every document picks
   its ids by word number, in text order.
4. *Decode.*  Ids meet their pieces through the id-to-piece table (its size is
   the vocabulary's), joined per distinct word of a block; the decoder is then
   applied to the document's pieces.

A block holds at most ``BLOCK_CHARS`` characters (or one longer text), so the
memory of a task does not grow with the corpus.  Splitting runs once for the
words and once for the documents; both read the same splits in the same order,
and a checksum of the block's words, carried on both sides, proves it.

Words are pieces that the tokenizer's own splitting never joins, so the ids of
a text are the ids of its words in order.  Texts in Latin-1 without special
token marks are lower-cased and cut by the tokenizer's pattern; any other text
is cut at ASCII white space only and left to the library inside the words.

Defined results: NULL text is empty (no tokens, digests of nothing); repeated
rows and NULL ids keep their own row; a text longer than a block is a block of
its own; an empty table gives no rows; extra columns are ignored.  The rows are
read twice and must come in the same order both times.  A scan of a table does
that and is read in place with ``fixed_order=True``; any other input may come in
another order (after a shuffle or a lost executor), so ids and texts are first
written to the shared folder.  The checksum still guards a wrong promise.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches, texts_of, written

BLOCK_CHARS = 24_000_000

# The tokenizer's splitting pattern on lower-cased Latin-1 text: contractions,
# runs of letters, single digits, runs of anything else but white space.
_LETTERS = "a-zªµºß-öø-ÿ"
_DIGITS = "0-9²³¹¼½¾"
_SPACES = "\t-\r \x85\xa0"
_LATIN_WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}{_SPACES}]+")
_NOT_LATIN = re.compile("[^\x00-\xff]|<\\|")
_ASCII_SPACE = re.compile("[\t-\r ]+")


def words_of(text: str) -> list[str]:
    if _NOT_LATIN.search(text):
        return [w for w in _ASCII_SPACE.split(text) if w]
    return _LATIN_WORD.findall(text.lower())


class WordNumbers(dict):
    """Words of a block, numbered in order of first use."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n

    def numbers(self, text: str) -> np.ndarray:
        found = words_of(text)
        return np.fromiter(map(self.__getitem__, found), np.uint32, len(found))


def _tokenizer(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return model


def _id_type(model) -> np.dtype:
    return np.dtype("<u2" if model.get_vocab_size() <= 1 << 16 else "<u4")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[np.ndarray], dict[str, int]]]:
    """(block id, doc ids, word numbers per document, words) of the task's blocks."""
    block = TaskContext.get().partitionId() << 24
    doc_ids, numbers, words, chars = [], [], WordNumbers(), 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            if chars and chars + len(text) > BLOCK_CHARS:
                yield block, doc_ids, numbers, words
                block, doc_ids, numbers, words, chars = block + 1, [], [], WordNumbers(), 0
            numbers.append(words.numbers(text))
            doc_ids.append(doc_id)
            chars += len(text)
    if doc_ids:
        yield block, doc_ids, numbers, words


def _checksum(words: dict[str, int]) -> int:
    return zlib.crc32("\n".join(words).encode())


def _ranks(numbers: list[np.ndarray], n: int) -> np.ndarray:
    """New numbers by falling frequency, which take fewer bytes."""
    counts = np.bincount(np.concatenate(numbers), minlength=n)
    ranks = np.empty(n, np.uint32)
    ranks[np.argsort(-counts, kind="stable")] = np.arange(n, dtype=np.uint32)
    return ranks


def _packed(numbers: np.ndarray) -> bytes:
    """Seven bits a byte, the low ones first, compressed."""
    digits = (numbers[:, None] >> np.arange(0, 35, 7, dtype=np.uint32)).astype(np.uint32)
    used = digits > 0
    used[:, 0] = True
    more = np.zeros_like(used)
    more[:, :-1] = used[:, 1:]
    return zlib.compress(((digits & 127) | (more.astype(np.uint32) << 7)).astype(np.uint8)[used].tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    coded = np.frombuffer(zlib.decompress(data), np.uint8)
    last = coded < 128
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends + 1])[:-1] if len(ends) else ends
    place = np.arange(len(coded)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((coded & 127).astype(np.int64) << (7 * place), starts) if len(ends) else np.zeros(0, np.int64)


def _block_words(batches):
    for block, _, numbers, words in blocks(batches):
        sums = _checksum(words)
        order = np.argsort(_ranks(numbers, len(words)), kind="stable")
        units = list(words)
        units = [units[i] for i in order.tolist()]
        for at in range(0, len(units), 50_000):
            part = units[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), block)), pa.array(np.arange(at, at + len(part), dtype=np.int32)),
                 pa.array(part, pa.string()), pa.array(np.full(len(part), sums, np.int64))],
                names=["block", "number", "word", "checksum"])


def _block_documents(kind: pa.DataType):
    def run(batches):
        for block, doc_ids, numbers, words in blocks(batches):
            sums, ranks = _checksum(words), _ranks(numbers, len(words))
            for at in range(0, len(doc_ids), 1_000):
                part = [_packed(ranks[n]) for n in numbers[at:at + 1_000]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), block)), pa.array(doc_ids[at:at + 1_000], kind),
                     pa.array(part, pa.binary()),
                     pa.array(np.full(len(part), sums, np.int64))],
                    names=["block", "doc_id", "numbers", "checksum"])
    return run


def encode_words(rows: DataFrame, path: str) -> DataFrame:
    """Replace the words by ``ids`` (``_id_type`` of the vocabulary); each distinct word is encoded once."""

    def encode(batches):
        model = _tokenizer(path)
        kind = _id_type(model)
        last, last_ids = None, b""
        for batch in batches:
            words = batch.column(2).to_pylist()
            new = list(dict.fromkeys(w for w in words if w != last))
            codes = {last: last_ids}
            for w, code in zip(new, model.encode_batch(new, add_special_tokens=False)):
                codes[w] = np.array(code.ids, kind).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([codes[w] for w in words], pa.binary()), batch.column(3)],
                names=["block", "number", "ids", "checksum"])
            if words:
                last, last_ids = words[-1], codes[words[-1]]

    together = rows.repartition("word").sortWithinPartitions("word")
    return map_batches(together, encode, "block long, number int, ids binary, checksum long")


def encode_decode(docs: DataFrame, path: str, fixed_order: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; the ids and
    the decoded texts themselves come from :func:`encode`."""
    return _through_blocks(docs, path, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests, fixed_order)


def encode(docs: DataFrame, path: str, fixed_order: bool = False) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of every row."""
    return _through_blocks(docs, path, "ids array<int>, decoded string", _outputs, fixed_order)


def _digests(ids: np.ndarray, decoded: str) -> tuple:
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def _outputs(ids: np.ndarray, decoded: str) -> tuple:
    return ids.tolist(), decoded


def _through_blocks(docs: DataFrame, path: str, columns: str, output, fixed_order: bool) -> DataFrame:
    docs = docs.select("doc_id", "text")
    if not fixed_order:
        docs = written(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

    arrow_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    rows = map_batches(docs, _block_words, "block long, number int, word string, checksum long")
    coded = encode_words(rows, path)
    listed = map_batches(docs, _block_documents(arrow_kind), f"block long, doc_id {kind}, numbers binary, checksum long")
    out = T.StructType.fromDDL(f"doc_id {kind}, {columns}")
    arrow_out = to_arrow_schema(out)

    def assemble(documents: pa.Table, table: pa.Table) -> pa.Table:
        model = _tokenizer(path)
        if table.num_rows:
            table = table.sort_by("number")
            seen = set(documents.column("checksum").unique().to_pylist() + table.column("checksum").unique().to_pylist())
            if len(seen) > 1:
                raise RuntimeError("a block was split differently when read again")
        entries = table.column("ids").to_pylist()
        kind = _id_type(model)
        lengths = np.array([len(e) // kind.itemsize for e in entries], np.int64)
        flat = np.frombuffer(b"".join(entries), kind).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
        # The id-to-piece join of the block's distinct words.
        piece = {i: model.id_to_token(i) for i in np.unique(flat).tolist()}
        plain, whole = model.decoder is None, bool(lengths.all())
        pieces = [" ".join(map(piece.__getitem__, flat[s:s + n].tolist())) for s, n in zip(starts.tolist(), lengths.tolist())]
        result = []
        for data in documents.column("numbers").to_pylist():
            at = _unpacked(data)
            n = lengths[at]
            ends = np.cumsum(n)
            ids = flat[np.repeat(starts[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
            if plain:
                decoded = " ".join(map(pieces.__getitem__, at.tolist()) if whole else filter(None, map(pieces.__getitem__, at.tolist())))
            else:
                decoded = model.decoder.decode(list(map(piece.__getitem__, ids.tolist())))
            result.append(output(ids, decoded))
        return pa.table([documents.column("doc_id"), *([r[i] for r in result] for i in range(len(out) - 1))], schema=arrow_out)

    return listed.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(assemble, out)
