"""Line-first quality rules.

Every line is judged by punctuation, navigation and boilerplate rules; lines
that fail are removed, and a document is rejected when it fails the base
checks or when the removed lines hold more than ``max_lost`` of its words.
One Arrow pass over whole texts, no shuffle.

Line rules (a line without a word is neither judged nor removed):

* punctuation - ``min_sentence`` or more words without a sentence mark before
  white space (a dot in ``3.5`` is none) or a closing mark at the end, or half
  as many ``!`` or more as words in a line of five or more words;
* symbols - more than ``max_symbols`` of ``#*$%&|<>`` per word, in a line of
  two or more words;
* navigation - three or more items parted by ``|``, ``>``, a guillemet or a bullet;
* boilerplate, in a line of at most 30 words and in any language - a line that
  its text already held twice (running heads and feet; the first two stay), a
  copyright mark or a ``(c)`` with a year, or one of ``PHRASES``; in a line of
  at most three words also a web or e-mail address.

Defined results: NULL and empty texts have no words and fail the base checks;
repeated rows and NULL ids keep their own row; a text of any length is judged
whole, by the task that reads it; an empty table gives no rows; extra columns
are ignored by ``judge`` and carried along by ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_batches

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
CLOSING = tuple('.!?:;"\')]}”’»…。！？')
# Notices of web pages in the corpus's four languages.
PHRASES = {
    "en": ("cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript",
           "click here", "read more", "sign up", "log in", "subscribe to our", "share this"),
    "de": ("datenschutzerklärung", "nutzungsbedingungen", "cookie-richtlinie", "allgemeine geschäftsbedingungen",
           "alle rechte vorbehalten", "javascript aktivieren", "hier klicken", "mehr erfahren", "newsletter abonnieren"),
    "fr": ("politique de confidentialité", "politique de cookies", "conditions d'utilisation", "mentions légales",
           "tous droits réservés", "activer javascript", "cliquez ici", "lire la suite", "abonnez-vous"),
    "es": ("política de privacidad", "política de cookies", "términos de uso", "condiciones de uso", "aviso legal",
           "todos los derechos reservados", "activar javascript", "haga clic aquí", "leer más", "suscríbete"),
}
BOILERPLATE = tuple(p for language in PHRASES.values() for p in language)
# Patterns that Python and RE2 read alike.
SENTENCE_PATTERN = r"""[.!?][\"')\]}”’»]*[\x20\x09-\x0D]|[。！？]"""
RIGHTS_PATTERN = r"©|\(c\) ?(19|20)[0-9][0-9]"
ADDRESS_PATTERN = r"https?://|www\.|[^\x20\x09-\x0D@]@[^\x20\x09-\x0D@]+\.[a-z]"
_SENTENCE = re.compile(SENTENCE_PATTERN)
_NAVIGATION = re.compile("[|>»›•·]")
_BOILERPLATE = re.compile("|".join([RIGHTS_PATTERN, *map(re.escape, BOILERPLATE)]))
_ADDRESS = re.compile(ADDRESS_PATTERN)


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_sentence: int = 8
    max_symbols: float = 0.2
    max_lost: float = 0.5


def line_fails(line: str, n_words: int, rules: Rules, earlier: int = 0) -> bool:
    """Whether a line of ``n_words`` words fails, ``earlier`` equal ones having come before it in its text."""
    end = line.rstrip(SPACES)
    if n_words >= rules.min_sentence and not (end.endswith(CLOSING) or _SENTENCE.search(end)):
        return True
    if n_words >= 5 and 2 * line.count("!") >= n_words:
        return True
    if n_words >= 2 and sum(map(line.count, SYMBOLS)) > rules.max_symbols * n_words:
        return True
    if len(_NAVIGATION.findall(line)) >= 2 and sum(1 for x in _NAVIGATION.split(line) if x.strip(SPACES)) >= 3:
        return True
    if n_words > 30:
        return False
    lower = line.lower()
    return earlier >= 2 or _BOILERPLATE.search(lower) is not None or (n_words <= 3 and _ADDRESS.search(lower) is not None)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    size = len(number)
    if size < 2_000_000:
        windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # number the pairs first, so that the product stays below 2**63
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i:n + i] |= twice
    return int(covered.sum())


def measure(text: str, rules: Rules) -> tuple[int, int, int, int, int, bool, bool, list[int]]:
    """Base counts, base verdict, final verdict, and the numbers of the removed lines."""
    words = text.encode().split()  # bytes: ASCII white space only
    lines = text.split("\n")
    seen: dict[str, int] = {}
    duplicates, lost, removed = 0, 0, []
    for i, line in enumerate(lines):
        n = len(line.encode().split()) if len(lines) > 1 else len(words)
        if not n:
            continue
        earlier = seen.get(line, 0)
        seen[line] = earlier + 1
        duplicates += earlier > 0
        if line_fails(line, n, rules, earlier):
            lost += n
            removed.append(i)
    repeats = repeated_words(words)
    base_failed = len(words) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(words)
    kept = not base_failed and lost <= rules.max_lost * len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    return len(words), chars, sum(map(text.count, SYMBOLS)), duplicates, repeats, base_failed, kept, removed


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and n_removed_lines of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*(measure(t or "", rules) for t in batch.column(1).to_pylist()))) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in found[:5]), *(pa.array(c, pa.bool_()) for c in found[5:7]),
                 pa.array([len(r) for r in found[7]], pa.int64())],
                names=["doc_id", *_COUNTS, "base_failed", "kept", "n_removed_lines"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{c} long" for c in _COUNTS)
    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {kind}, {columns}, base_failed boolean, kept boolean, n_removed_lines long")


def cleaned_text(text: Column, rules: Rules = Rules()) -> Column:
    """The text without its failing lines; NULL where the document is rejected."""
    @F.arrow_udf("string")
    def clean_lines(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            text = text or ""
            *_, kept, removed = measure(text, rules)
            if kept and removed:
                drop = set(removed)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
            out.append(text if kept else None)
        return pa.array(out, pa.string())

    return clean_lines(text)


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept rows with all their columns; text and n_chars are those of the remaining lines."""
    small_batches(docs.sparkSession)
    columns = [F.col(c) for c in docs.columns if c != "text"]
    out = docs.select(*columns, cleaned_text(F.col("text"), rules).alias("text")).where("text IS NOT NULL")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
