"""Staged, all-or-nothing publish of the warehouse tables.

Every attempt to load writes its tables into a folder of its own,
``<root>/versions/<run_id>-<attempt>``; an existing folder is never written.
The version is checked (primary keys, unique keys, foreign keys) and only
then named by a new manifest ``<root>/manifests/<n>.json``.  Manifests are
numbered and created without overwriting, and readers take the highest
complete one, so no crash can leave the warehouse without a current version,
a failed load leaves the published version untouched, and of two loads on the
same version only one can publish.

The fact is written bucketed by invoice id with at most one file per bucket;
the bucket count follows the fact's size and is recorded in the manifest, and
readers register the version's files as a bucketed table in their session
catalog.  A later merge joins new rows to it on invoice id: Spark then
shuffles only the new rows into the fact's buckets and reads the published
fact in place.  Upserts read the current version and write a new one, never
their input.  A load summary (succeeded and failed steps) is written in every
case, also when building the tables fails.  After a publish, versions other
than the newest ``keep_versions`` are removed.

With ``view`` set, the sales report is a view of that name in the session
catalog: plain SQL over the published version's tables.  Each publish points
it at the new version before the old one can be removed; a failed load leaves
it as it is, and a new session gets it back with :meth:`Warehouse.point_view`.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import checks
from ledgerline.operators.report import report_sql
from ledgerline.operators.star import StarSchema, attach_dimension_keys, fact_projection, member_rows
from ledgerline.operators.upsert import insert_missing, upsert, upsert_parts
from ledgerline.session import TABLE_CODEC, cut_lineage, cut_table, folder_bytes
from ledgerline.sources.csv import write_csv

TABLE_NAMES = ["dim_branch", "dim_product", "fact_sales"]
BUCKET_BYTES = 128 * 1024 * 1024


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _create_text(spark: SparkSession, path: str, content: str) -> None:
    """Create a small file; an existing one is an error, never overwritten."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(content.encode("utf-8")))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def bucket_count(size: int) -> int:
    """Buckets for a fact of ``size`` bytes: a power of two, so that a
    growing fact keeps its count for many loads."""
    return 1 << max(0, -(-size // BUCKET_BYTES) - 1).bit_length()


@dataclass
class LoadSummary:
    succeeded: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    total: int = 0
    errors: list[str] = field(default_factory=list)

    def as_dict(self) -> dict:
        return {"succeeded": self.succeeded, "failed": self.failed, "total": self.total}


class Warehouse:
    """A directory of versioned warehouse tables with numbered manifests."""

    def __init__(self, spark: SparkSession, root: str, fact_buckets: int | None = None, keep_versions: int = 2,
                 view: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fact_buckets = fact_buckets
        self.keep_versions = keep_versions
        self.view = view
        self._written: dict[str, int] = {}

    def version_path(self, version: str, table: str) -> str:
        return f"{self.root}/versions/{version}/{table}"

    # -- manifests -------------------------------------------------------------

    def _numbers(self) -> list[int]:
        """Manifest numbers, newest first."""
        fs, p = _fs(self.spark, f"{self.root}/manifests")
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), reverse=True)

    def manifests(self) -> list[dict]:
        """Complete manifests, newest first; one cut short by a crash is passed over."""
        found = []
        for n in self._numbers():
            try:
                found.append(json.loads(_read_text(self.spark, f"{self.root}/manifests/{n:012d}.json")) | {"number": n})
            except ValueError:
                continue
        return found

    def manifest(self) -> dict | None:
        return next(iter(self.manifests()), None)

    def current(self) -> str | None:
        manifest = self.manifest()
        return manifest["version"] if manifest else None

    def published_epoch(self, stream: str) -> int | None:
        """The last epoch of a stream that is part of the current version."""
        return (self.manifest() or {}).get("epochs", {}).get(stream)

    def publish(self, version: str, base: dict | None, epochs: dict[str, int] | None = None) -> None:
        """Name ``version`` current, after the manifest ``base`` it was built on."""
        newest = self.manifest()
        if (newest or {}).get("number") != (base or {}).get("number"):
            raise RuntimeError("another load was published meanwhile")
        content = {"version": version, "fact_buckets": self._written.get(version),
                   "epochs": (base or {}).get("epochs", {}) | (epochs or {})}
        number = max(self._numbers(), default=0) + 1
        _create_text(self.spark, f"{self.root}/manifests/{number:012d}.json", json.dumps(content))

    # -- tables ----------------------------------------------------------------

    def _table_name(self, version: str) -> str:
        return "ledgerline_fact_" + hashlib.sha1(f"{self.root}/{version}".encode()).hexdigest()[:16]

    def _fact(self, version: str, buckets: int | None) -> DataFrame:
        """The fact of a version as a bucketed table of this session."""
        path = self.version_path(version, "fact_sales")
        if buckets is None:
            return self.spark.read.parquet(path)
        name = self._table_name(version)
        if not self.spark.catalog.tableExists(name):
            schema = self.spark.read.parquet(path).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                           f"CLUSTERED BY (invoice_id) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def _buckets(self, version: str) -> int | None:
        """The bucket count of a version's fact."""
        if version in self._written:
            return self._written[version]
        return next((m.get("fact_buckets") for m in self.manifests() if m["version"] == version), None)

    def read(self, table: str, version: str | None = None) -> DataFrame:
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"No published version under {self.root}")
        if table == "fact_sales":
            return self._fact(version, self._buckets(version))
        return self.spark.read.parquet(self.version_path(version, table))

    def tables(self, version: str | None = None) -> StarSchema:
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"No published version under {self.root}")
        return StarSchema(*[self.read(t, version) for t in TABLE_NAMES],
                          fact_bytes=folder_bytes(self.spark, self.version_path(version, "fact_sales")),
                          fact_buckets=self._buckets(version))

    # -- the report as a view --------------------------------------------------

    def point_view(self) -> None:
        """Create or replace the report view over the published version."""
        if self.view is None:
            return
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"No published version under {self.root}")
        self.read("fact_sales", version)  # registers the version's fact
        buckets = (self.manifest() or {}).get("fact_buckets")
        fact = self._table_name(version) if buckets is not None else self._files(version, "fact_sales")
        text = report_sql(fact, self._files(version, "dim_branch"), self._files(version, "dim_product"))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} AS {text}")

    def _files(self, version: str, table: str) -> str:
        """A table of a version as SQL names Parquet files."""
        return "parquet.`" + self.version_path(version, table).replace("`", "``") + "`"

    # -- loading ---------------------------------------------------------------

    def _write_fact(self, star: StarSchema, version: str) -> None:
        """Write the fact in its buckets, at most two files each.

        A fact merged into one with the same buckets is written from where it
        lies: every task holds one bucket of the old rows, and only the new
        rows are shuffled.  Any other fact is shuffled into its buckets.
        """
        # The size is that of zstd files; a bucket's rows decode to what 128 MB of Spark's default codec does.
        buckets = self.fact_buckets or bucket_count(star.fact_bytes * 3 // 2)
        if star.fact_parts is not None and star.fact_buckets == buckets:
            kept, new = star.fact_parts()
            self._append_fact(kept, version, buckets)
            self._append_fact(new.repartition(buckets, "invoice_id"), version, buckets)
        else:
            self._append_fact(star.fact_sales.repartition(buckets, "invoice_id"), version, buckets)
        self._written[version] = buckets

    def _append_fact(self, rows: DataFrame, version: str, buckets: int) -> None:
        (rows.write.mode("append").bucketBy(buckets, "invoice_id").option("compression", TABLE_CODEC)
         .option("path", self.version_path(version, "fact_sales")).saveAsTable(self._table_name(version)))

    def stage(self, star: StarSchema, version: str, summary: LoadSummary) -> None:
        """Write each table in isolation; failures are recorded, not raised."""
        # The fact comes first: its rows are written once, and the dimensions are read from them.
        steps: dict[str, Callable[[], object]] = {
            "fact_sales": lambda: self._write_fact(star, version),
            "dim_branch": lambda: star.dim_branch.write.parquet(self.version_path(version, "dim_branch")),
            "dim_product": lambda: star.dim_product.write.parquet(self.version_path(version, "dim_product")),
        }
        for name, write in steps.items():
            self._step(f"{name}_staging", write, summary)

    @staticmethod
    def _step(name: str, work: Callable[[], object], summary: LoadSummary):
        """Run one step; its outcome goes to the summary."""
        try:
            result = work()
        except Exception as exc:  # recorded in the summary, raised after it
            summary.failed.append(name)
            summary.errors.append(f"{name}: {exc}")
            return None
        summary.succeeded.append(name)
        return result

    def verify(self, version: str) -> None:
        star = self.tables(version)
        report = checks.constraint_report(star.dim_branch, star.dim_product, star.fact_sales)
        problems = [f"{r['table_name']}.{r['check_name']}: {r['violations']}"
                    for r in report.filter(F.col("violations") > 0).collect()]
        if problems:
            raise ValueError("; ".join(problems))

    def summary_path(self, run_id: str) -> str:
        return f"{self.root}/load_summary/{run_id}.json"

    def write_summary(self, summary: LoadSummary, run_id: str) -> None:
        """The summary of the run's last attempt."""
        fs, p = _fs(self.spark, self.summary_path(run_id))
        if fs.exists(p):
            fs.delete(p, False)
        _create_text(self.spark, self.summary_path(run_id), json.dumps(summary.as_dict()))

    def export_csv(self, out_dir: str, version: str | None = None) -> None:
        for t in TABLE_NAMES:
            write_csv(self.read(t, version), f"{out_dir.rstrip('/')}/{t}")

    def load(self, star: StarSchema | Callable[[], StarSchema], run_id: str | None = None,
             export_dir: str | None = None, epochs: dict[str, int] | None = None) -> LoadSummary:
        """Build, stage, verify and publish a full set of tables (all or nothing).

        ``star`` may be a function that builds the tables (for example by
        merging into the current version); its failure is a failed step.
        """
        run_id = run_id or uuid.uuid4().hex
        version = f"{run_id}-{uuid.uuid4().hex[:12]}"
        base = self.manifest()
        summary = LoadSummary(total=len(TABLE_NAMES) + 2)
        if callable(star):
            star = self._step("merge", star, summary)
            summary.total += 1
        if not summary.failed:
            self.stage(star, version, summary)
        if not summary.failed:
            self._step("constraint_checks", lambda: self.verify(version), summary)
        if not summary.failed:
            self._step("publish", lambda: self.publish(version, base, epochs), summary)
        self.write_summary(summary, run_id)
        if summary.failed:
            self._remove(version)
            raise RuntimeError(f"Load incomplete; succeeded: {summary.succeeded}, failed: {summary.failed}; "
                               f"published version unchanged; {'; '.join(summary.errors)}")
        self.point_view()
        self.retire()
        if export_dir:
            self.export_csv(export_dir, version)
        return summary

    def _remove(self, version: str) -> None:
        name = self._table_name(version)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        fs, p = _fs(self.spark, f"{self.root}/versions/{version}")
        if fs.exists(p):
            fs.delete(p, True)

    def retire(self) -> list[str]:
        """Remove the tables of versions older than the newest ``keep_versions``."""
        old = [m["version"] for m in self.manifests()[self.keep_versions:]]
        fs, _ = _fs(self.spark, self.root)
        gone = [v for v in old if fs.exists(_path(self.spark, f"{self.root}/versions/{v}"))]
        for version in gone:
            self._remove(version)
        return gone


def merge_into(current: StarSchema, clean_dedup: DataFrame, branch_keys: tuple[str, ...] = ("branch_code", "city"),
               partitions: int | None = None) -> StarSchema:
    """Upsert new clean rows into a current star schema.

    The new rows are written once (every step below reads them).  Dimensions
    are merged first, so existing members keep their keys and new members
    get keys after the largest one; the merged dimensions are small and
    written too.  The new fact rows then take their keys from the merged
    dimensions and are merged on invoice id (unique after dedup, so the
    source needs no uniqueness check); the merged fact is lazy, so it is
    written only where it is staged.

    Into a fact in buckets, new rows of at most a quarter of its size are
    hashed bucket by bucket while the fact streams past; more are merged by
    sorting, since a bucket's hash table would then outgrow its task.
    """
    staged = cut_table(clean_dedup)
    members = cut_table(member_rows(staged.table))
    branches = members.table.select(F.col("branch").alias("branch_code"), "city").distinct()
    dim_branch = cut_lineage(upsert(current.dim_branch, branches, list(branch_keys), "branch_key"))
    dim_product = cut_lineage(insert_missing(current.dim_product, members.table, ["product_line"], "product_key", members.bytes))

    join = None
    if current.fact_buckets is not None:
        join = "shuffle_hash" if 4 * staged.bytes <= current.fact_bytes else "merge"

    @cache
    def parts() -> tuple[DataFrame, DataFrame]:
        rows = attach_dimension_keys(staged.table, dim_branch, dim_product)
        source = fact_projection(rows.withColumn("sales_key", F.lit(None).cast("long"))).drop("sales_key")
        return upsert_parts(current.fact_sales, source, ["invoice_id"], "sales_key", size=staged.bytes,
                            partitions=partitions, check_unique=False, join=join)

    return StarSchema(dim_branch, dim_product, lambda: parts()[0].unionByName(parts()[1]),
                      lambda: current.fact_bytes + staged.bytes, current.fact_buckets, parts)
