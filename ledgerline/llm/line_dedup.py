"""Cross-site boilerplate lines by distinct-site spread.

DataFrame functions only.

1. Each text is split into stripped lines; a line is known by 96 bits of hash.
   The hashes (no text) are written once: text hash, line hash, site, id.
2. A HyperLogLog sketch of the sites per line hash is built map-side and
   merged by the aggregation.  Lines whose estimate lies within ``margin`` of
   the sites they need get an exact distinct count; the others are decided by
   the estimate, whose relative error is far below the margin.
3. A line on ``min_sites`` or more sites is boilerplate; a line of
   ``LONG_WORDS`` words or ``LONG_CHARS`` characters or more already is on
   ``long_sites``, since chance rarely repeats it.  Its first document
   (smallest id) keeps it, so no content leaves the corpus altogether; all
   other documents lose every occurrence.
4. The places of boilerplate lines in a text come from the written hashes, so
   a text is cut in time proportional to its lines.

Hot lines are combined before every shuffle; the joins are plain shuffle joins
on written tables, which adaptive execution splits where a key is hot.

Defined results: NULL text stays NULL with zero lines; lines are compared
without the ASCII white space at their ends, and blank lines are neither
counted nor removed; a NULL site counts as no site; rows with a NULL id sort
last and keep a line only if no row with an id holds it; repeated rows count
once and are treated alike; extra columns are ignored by ``remove_boilerplate``
and carried along by ``drop_emptied``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MIN_SITES = 10
LONG_SITES = 3     # chance repeats of long lines seldom reach three sites
LONG_WORDS = 3
LONG_CHARS = 24    # scripts without spaces
MARGIN = 0.2       # a dozen standard errors of the sketch
SKETCH_BITS = 12
NO_ID = 2 ** 63 - 1
SPACES = " \t\n\v\f\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _strip(line: Column) -> Column:
    return F.trim(line, F.lit(SPACES))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(_strip(line))


def _sites_needed(line: Column, min_sites: int, long_sites: int | None) -> Column:
    if long_sites is None:
        return F.lit(min_sites)
    # Possessive and anchored: one pass over a line of any length.
    words = _strip(line).rlike(rf"^(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{LONG_WORDS - 1}}}[^\x20\x09-\x0D]")
    return F.when(words | (F.char_length(_strip(line)) >= LONG_CHARS), long_sites).otherwise(min_sites)


def boilerplate(docs: DataFrame, site: str, min_sites: int, margin: float, long_sites: int | None) -> tuple[DataFrame, DataFrame]:
    """(line occurrences, boilerplate lines with the id that keeps each)."""
    lines = docs.where("text IS NOT NULL").select(
        F.xxhash64("text").alias("text_hash"), F.col(site).alias("site"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.posexplode(_lines(F.col("text"))).alias("pos", "line")).where(_strip(F.col("line")) != "")
    occurrences = written(lines.select("text_hash", "pos", _line_hash(F.col("line")).alias("h1"), F.hash(_strip(F.col("line"))).alias("h2"), "site", "id",
                                       _sites_needed(F.col("line"), min_sites, long_sites).alias("needed")))

    spread = occurrences.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min("id").alias("keeper"), F.max("needed").alias("needed"))
    spread = written(spread.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites"), "keeper", "needed")
                     .where(F.col("sites") >= F.col("needed") * (1 - margin)))
    near = spread.where(F.col("sites") < F.col("needed") * (1 + margin)).drop("sites")
    exact = (occurrences.select("h1", "h2", "site").where("site IS NOT NULL").distinct()
             .join(near, ["h1", "h2"]).groupBy("h1", "h2")
             .agg(F.count("*").alias("sites"), F.first("keeper").alias("keeper"), F.first("needed").alias("needed"))
             .where("sites >= needed"))
    sure = spread.where(F.col("sites") >= F.col("needed") * (1 + margin))
    return occurrences, written(sure.select("h1", "h2", "keeper").union(exact.select("h1", "h2", "keeper")))


def _with_cleaned(docs: DataFrame, columns: list[Column], site: str, min_sites: int, margin: float, long_sites: int | None) -> DataFrame:
    """``columns`` with ``n_lines``, ``n_removed`` and ``cleaned``."""
    occurrences, common = boilerplate(docs, site, min_sites, margin, long_sites)
    hits = (occurrences.select("text_hash", "pos", "h1", "h2").distinct().join(common, ["h1", "h2"])
            .groupBy("text_hash").agg(F.collect_list(F.struct("pos", "keeper")).alias("hits")))
    hits = written(hits)
    rows = docs.select(*columns, F.col("text").alias("body"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("own_id"),
                       F.xxhash64("text").alias("text_hash"))
    # The hits of a partition's texts are a small part of the texts, so they
    # are hashed and the texts need no sort; the same plan at every size.
    rows = rows.join(hits.hint("shuffle_hash"), "text_hash", "left")
    # A text's hits are at most its lines; array_except hashes its arguments.
    drop = F.transform(F.filter("hits", lambda h: h["keeper"] != F.col("own_id")), lambda h: h["pos"])
    rows = rows.withColumn("drop", F.coalesce(drop, F.array().cast("array<int>"))).withColumn("lines", _lines(F.col("body")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    keep = F.when(F.size("drop") == 0, F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i)))
    rows = rows.withColumn("kept_lines", keep)
    return rows.select(
        *[c for c in rows.columns if c not in ("text_hash", "body", "own_id", "hits", "drop", "lines", "kept_lines")],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        (F.coalesce(F.size("lines"), F.lit(0)) - F.coalesce(F.size("kept_lines"), F.lit(0))).cast("long").alias("n_removed"),
        F.array_join("kept_lines", "\n").alias("cleaned"))


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN,
                       long_sites: int | None = LONG_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed and the cleaned text of every row."""
    docs = docs.select("doc_id", "text", site)
    return _with_cleaned(docs, [F.col("doc_id")], site, min_sites, margin, long_sites).withColumnRenamed("cleaned", "text")


def drop_emptied(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN,
                 long_sites: int | None = LONG_SITES) -> DataFrame:
    """All columns with the cleaned text and its n_chars, without rows that lost all their words."""
    named = [F.col(c).alias(f"d{i}") for i, c in enumerate(docs.columns)]
    rows = _with_cleaned(docs, named, site, min_sites, margin, long_sites)
    rows = rows.where((F.col("n_removed") == 0) | (F.regexp_replace("cleaned", "\\s+", "") != ""))
    changed = {"text": F.col("cleaned"), "n_chars": F.char_length("cleaned").cast("long")}
    return rows.select([
        (F.when(F.col("n_removed") > 0, changed[c]).otherwise(F.col(f"d{i}")) if c in changed else F.col(f"d{i}")).alias(c)
        for i, c in enumerate(docs.columns)])
