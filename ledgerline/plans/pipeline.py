"""The transform: raw rows -> flags -> clean, deduplicated rows -> star schema.

The flagged rows (raw text, typed values, flags) are written once; flags,
rejects, metrics and dedup read that table, so raw input is parsed once.  Rows,
flags and NULLs are counted while that table is written.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgerline.operators import quality
from ledgerline.operators.report import sales_report
from ledgerline.operators.star import StarSchema, build_star
from ledgerline.plans.publish import Warehouse, merge_into
from ledgerline.rules import RETAIL_RULES, SalesRules
from ledgerline.session import Cut, cut_lineage, cut_scope, cut_table, shuffles_removed
from ledgerline.sources.csv import read_csv_strings, write_csv, write_json, write_parquet

log = logging.getLogger(__name__)

# Bytes of the table of all flagged rows for a byte of the clean rows alone, which
# hold each value once; it only sets the number of range partitions.
CLEAN_SHARE = 3
# The same for a byte of the table of raw text and flags.
TEXT_SHARE = 2


@dataclass
class Prepared:
    """Standardized raw rows and everything derived from them.

    With ``text_only`` the flagged rows are written without their typed values,
    half the bytes, and each reader parses the columns that it asks for; that
    suits a job that goes over them once or twice.  The metrics then find the
    dedup's repeated ids as well.
    """

    rules: SalesRules
    std: DataFrame
    extra_columns: list[str] = field(default_factory=list)
    text_only: bool = False

    @cached_property
    def _landed(self) -> tuple[Cut, dict[str, int]]:
        """The written flagged rows, and the counts observed on the way.

        The observed aggregate is part of the writing tasks; a task that runs
        again is counted once, since Spark takes an output task's counts only
        when it first completes.
        """
        store = quality.flag_text if self.text_only else quality.flag_stored
        stored = store(self.std, self.rules)
        seen = Observation()
        return cut_table(stored.observe(seen, *quality.row_counts(stored.columns, self.std.columns))), seen.get

    @cached_property
    def _clean(self) -> tuple[DataFrame, int]:
        """The clean rows and the size of the table of all flagged rows, known or supposed.

        Where nothing has asked for the flagged rows yet, only the clean ones
        are written, without raw text and flags.
        """
        if "_landed" in self.__dict__:
            return self.clean, self._landed[0].bytes * (TEXT_SHARE if self.text_only else 1)
        made = cut_table(quality.clean_rows(quality.flag_rows(self.std, self.rules)))
        return made.table, made.bytes * CLEAN_SHARE

    @property
    def written(self) -> DataFrame:
        """Raw text, typed values and flags of every row, written at first use."""
        table = self._landed[0].table
        if self.text_only:
            return quality.parse_text(table, self.std.columns, self.rules)
        return quality.with_raw(table, self.std.columns)

    @property
    def flagged(self) -> DataFrame:
        return quality.typed_rows(self.written)

    @property
    def clean(self) -> DataFrame:
        return quality.clean_rows(self.flagged)

    @cached_property
    def _ids(self) -> tuple[DataFrame, dict[str, int]]:
        """The written ids of several clean rows, and the counts over all ids observed on the way."""
        seen = Observation()
        groups = quality.id_groups(self.written).observe(seen, *quality.id_counts())
        return cut_lineage(groups.where("_n > 1").select("_key", "_first", "_n")), seen.get

    @cached_property
    def _kept(self) -> quality.Kept:
        keys = self._ids[0] if "_ids" in self.__dict__ else None
        return quality.clean_dedup(*self._clean, self.rules, keys)

    @property
    def clean_dedup(self) -> DataFrame:
        return self._kept.rows

    @property
    def rejects(self) -> DataFrame:
        return quality.reject_rows(self.flagged)

    @property
    def flags(self) -> DataFrame:
        return quality.flag_table(self.flagged)

    @cached_property
    def metrics(self) -> DataFrame:
        ids = self._ids[1] if self.text_only else None
        return quality.quality_metrics(self.written, self.rules, self._landed[1], ids)

    def report(self) -> DataFrame:
        return quality.quality_report(self.metrics, self.extra_columns)

    def star(self, partitions: int | None = None) -> StarSchema:
        return build_star(self.clean_dedup, partitions, self._kept.in_key_order, self._clean[1])


def prepare(raw: DataFrame, rules: SalesRules = RETAIL_RULES, text_only: bool = False) -> Prepared:
    std, extra = quality.standardized(raw, rules)
    return Prepared(rules, std, extra, text_only)


def transform(raw: DataFrame, rules: SalesRules = RETAIL_RULES,
              partitions: int | None = None) -> tuple[StarSchema, DataFrame]:
    """(star schema, quality report) for a raw frame."""
    prepared = prepare(raw, rules)
    return prepared.star(partitions), prepared.report()


@dataclass
class RunResult:
    run_id: str
    load_summary: dict
    metrics: dict


def run(spark: SparkSession, source_dir: str, out_dir: str, warehouse_root: str, rules: SalesRules = RETAIL_RULES,
        mode: str = "full", run_id: str | None = None) -> RunResult:
    """Extract -> quality -> star schema -> staged load -> report.

    ``mode="full"`` publishes a version built from this input alone;
    ``mode="merge"`` upserts the input into the current published version
    (a first run without one is a full load).  Outputs under ``out_dir``:
    ``data_quality_flags`` (every row, gzipped CSV), ``data_quality_rejects``
    (rejected or mismatched rows, Parquet), ``data_quality_report`` (JSON),
    gzipped CSV copies of the three tables and ``report`` (one plain CSV file).
    A failure is logged and raised again.  The run's intermediate tables are
    removed at its end, its shuffle files after each step.
    """
    if mode not in ("full", "merge"):
        raise ValueError(f"Unknown mode {mode!r}")
    try:
        with cut_scope(spark), shuffles_removed(spark):
            return _run(spark, source_dir, out_dir.rstrip("/"), Warehouse(spark, warehouse_root), rules, mode,
                        run_id or uuid.uuid4().hex)
    except Exception:
        log.exception("run failed")
        raise


def load_star(warehouse: Warehouse, prepared: Prepared, mode: str = "merge") -> Callable[[], StarSchema]:
    """The tables of the next version: a merge into the current one, or a full load."""
    def build() -> StarSchema:
        if mode == "merge" and warehouse.current() is not None:
            return merge_into(warehouse.tables(), prepared.clean_dedup)
        return prepared.star()

    return build


def _run(spark: SparkSession, source_dir: str, out: str, warehouse: Warehouse, rules: SalesRules, mode: str,
         run_id: str) -> RunResult:
    prepared = prepare(read_csv_strings(spark, source_dir), rules, text_only=True)
    write_csv(prepared.flags, f"{out}/data_quality_flags")
    write_parquet(prepared.rejects, f"{out}/data_quality_rejects")
    write_json(prepared.report(), f"{out}/data_quality_report")
    summary = warehouse.load(load_star(warehouse, prepared, mode), run_id=run_id, export_dir=out)

    published = warehouse.tables()
    write_csv(sales_report(published.fact_sales, published.dim_branch, published.dim_product),
              f"{out}/report", single_file=True)
    metrics = spark.read.json(f"{out}/data_quality_report").select("metrics.*").drop("null_counts").first().asDict()
    return RunResult(run_id, summary.as_dict(), metrics)
