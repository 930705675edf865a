"""Session construction and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the jobs rely on.  AQE re-plans joins and coalesces partitions at
# run time and splits skewed join partitions; UTC keeps date math stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The flag projections are wide boolean expressions over aliases; the
    # constraints Spark would infer from them add no filter and cost
    # planning time on every query.
    "spark.sql.constraintPropagation.enabled": "false",
}

# Codec of the tables that the jobs write for themselves: about a third
# smaller than the default's files.
TABLE_CODEC = "zstd"

# A small join side is broadcast up to this size in memory; each row is taken
# as its text and ``ROW_BYTES`` more.
BROADCAST_BYTES = 128 * 1024 * 1024
ROW_BYTES = 64


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder on a cluster and is used
    as given.  Only a local-mode session without that setting (tests, the
    bench) gets a private temporary folder; a cluster session without it is
    an error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    return sc.getCheckpointDir()


class Cut(NamedTuple):
    """A written table and its total file size."""

    table: DataFrame
    bytes: int


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside the block a query's shuffle files are removed when it ends; by
    default they stay until the driver happens to collect its garbage.  For
    jobs that write what they read again: a query run twice shuffles twice."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


# Folders of the tables written inside the innermost cut_scope of this thread.
_SCOPE: ContextVar[list[str] | None] = ContextVar("cut_scope", default=None)


@contextmanager
def cut_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables that :func:`cut_table` writes inside the block when it
    ends; for jobs whose results are written elsewhere by then."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield made
    finally:
        _SCOPE.reset(token)
        for path in made:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def cut_table(df: DataFrame, codec: str | None = TABLE_CODEC) -> Cut:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back.

    Used where later steps must see exactly the same rows as earlier ones
    (for example the range partitioning whose per-partition counts become
    key offsets), and to stop several jobs from re-running the same
    upstream shuffle.  A written table costs one job (an eager
    ``checkpoint()`` runs its last stage twice), is columnar, and later
    reads prune columns and push filters into it.  It lives in the shared
    folder, so executor loss never loses it; :func:`cut_scope` removes it.
    ``codec`` None is the session's own.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    made = _SCOPE.get()
    if made is not None:
        made.append(path)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    return Cut(spark.read.schema(df.schema).parquet(path), folder_bytes(spark, path))


def cut_lineage(df: DataFrame, codec: str | None = TABLE_CODEC) -> DataFrame:
    """The table of :func:`cut_table`."""
    return cut_table(df, codec).table


def is_small(table: DataFrame) -> bool:
    """Whether a written table's rows, as measured, take no more than ``BROADCAST_BYTES``."""
    width = F.lit(ROW_BYTES)
    for f in table.schema.fields:
        if f.dataType.typeName() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    size = table.agg(F.sum(width.cast("long")).alias("n")).first()["n"] or 0
    return size <= BROADCAST_BYTES


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it is known to be small.

    Its rows are measured, so a session's low broadcast threshold does not
    send the other, large side of a join through a shuffle for the sake of a
    few keys.  Above ``BROADCAST_BYTES`` Spark chooses the join.
    """
    return F.broadcast(table) if is_small(table) else table
