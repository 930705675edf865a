"""All-string CSV source.

Every CSV file under a directory (recursively, any ``.csv`` case, plain or
gzipped as ``.csv.gz``) is read with its header and without type inference, so values stay text until the
coercing parsers run.  Quoted fields follow RFC 4180: quotes are doubled and a
field may hold commas and line breaks.

Spark maps CSV columns by position and cannot split a file whose records span
lines, so one distributed pass over the lines finds each file's header and
whether a quoted field runs over a line end (a line with an odd number of
quotes).  Files are then grouped by (header, line breaks), each group is read
with its own header, and the groups are unioned by column name.  The driver
sees one row per file, like the file listing itself; no file is opened there.
A gzipped file cannot be split either.

CSV is written gzipped, one file per task: a third of the plain text or less.
"""

from __future__ import annotations

import csv as pycsv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.parse import null_markers_to_null
from ledgerline.rules import NULL_MARKERS
from ledgerline.session import TABLE_CODEC

CSV_FILES = "*.[cC][sS][vV]{,.gz}"


def file_layouts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, header, multi_line) of every non-empty CSV file under ``paths``."""
    reader = spark.read.option("recursiveFileLookup", True)
    if not all(p.lower().endswith(".csv") for p in paths):
        reader = reader.option("pathGlobFilter", CSV_FILES)
    lines = reader.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value").where("value <> ''")
    # The first block's first line, in reading order, is the header.
    return lines.groupBy("path").agg(
        F.min_by("value", F.struct("start", "at")).alias("header"),
        F.max((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1).alias("multi_line"))


def _names(header: str) -> tuple[str, ...]:
    names = next(pycsv.reader([header.removeprefix("\ufeff")], strict=True))
    return tuple(names)


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line))


def read_csv_strings(spark: SparkSession, root: str | list[str], markers: list[str] | None = None) -> DataFrame:
    """All rows of all CSV files under ``root`` (a folder, a file, or a list
    of files) as strings; null markers -> NULL.

    Raises ``FileNotFoundError`` when there is no CSV file with a header.
    """
    paths = [root] if isinstance(root, str) else list(root)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(paths[0]) if paths else None
    if fs_path is None or not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        raise FileNotFoundError(f"No such directory: {root}")
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for r in file_layouts(spark, paths).collect():
        groups.setdefault((_names(r.header), r.multi_line), []).append(r.path)
    if not groups:
        raise FileNotFoundError(f"No CSV file with a header under {root}")
    # The header is known, so each group is read with it as an all-string
    # schema (columns by position, the header line skipped): no inference job.
    frames = [_reader(spark, multi_line).schema(", ".join("`" + c.replace("`", "``") + "` string" for c in header))
              .csv(sorted(files)) for (header, multi_line), files in sorted(groups.items())]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    markers = NULL_MARKERS if markers is None else markers
    return df.select(*[null_markers_to_null(F.col("`" + c.replace("`", "``") + "`"), markers).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV, gzipped; ``single_file`` (plain text) only for small outputs such as reports."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("compression", "none" if single_file else "gzip")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", TABLE_CODEC).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One-row documents (quality report, load summary) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
