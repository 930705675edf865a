"""Named queries over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the whole of the driver tables through the raw sales view (see
``sources.tables``), with the driver-table rule set.  The view is landed
once per session (like the raw files of a production run) and read by
every query that goes over raw rows; the others read the flagged rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.money import round2
from ledgerline.functions.parse import date_to_iso
from ledgerline.operators import checks, profile, quality, quantiles, report
from ledgerline.functions.naming import replacement_name
from ledgerline.operators.keys import dense_key_small
from ledgerline.operators.star import StarSchema
from ledgerline.operators.upsert import upsert
from ledgerline.plans.pipeline import Prepared, prepare, run
from ledgerline.plans.publish import Warehouse, merge_into
from ledgerline.rules import FACT_COLUMNS, NUMERIC_COLUMNS, driver_table_rules
from ledgerline.session import ensure_checkpoint_dir, shuffles_removed
from ledgerline.sources.csv import read_csv_strings, write_csv, write_json
from ledgerline.sources.tables import landed_sales_view, raw_sales_view, view_key
from ledgerline.streaming.incremental import start_ingest

Query = Callable[[SparkSession, str], DataFrame]

# Expected rows of the published tables (least, most): a fact worth a report,
# at most one branch per nation, one product line or more.
EXPECTED_ROWS = {"dim_branch": (1, 25), "dim_product": (1, None), "fact_sales": (1000, None), "dim_customer": (1, None)}

# Raw columns that the schema check's file lacks or has under another name.
DROPPED, RENAMED = ["Rating", "gross income"], {"City": "Town"}

# Load batches for the upsert queries: the first load holds rows shipped
# before 1999, the second rows shipped from mid-1998 on, so half a year of
# invoices arrives twice (matched keys) and the rest is new.
FIRST_LOAD_BEFORE = "1999-01-01"
SECOND_LOAD_FROM = "1998-07-01"


# Prepared views by the key of their raw rows, so that the flagged rows are
# written once per session.  They hold every raw value, so the raw rows need
# not be landed before them.
_PREPARED: dict[tuple, Prepared] = {}


def prepared(spark: SparkSession, sf_dir: str, **batch) -> Prepared:
    key = view_key(spark, sf_dir, **batch)
    if key not in _PREPARED:
        _PREPARED[key] = prepare(raw_sales_view(spark, sf_dir, **batch), driver_table_rules())
    return _PREPARED[key]


def standard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed raw rows under their canonical names."""
    return quality.standardized(landed_sales_view(spark, sf_dir), driver_table_rules())[0]


def star(spark: SparkSession, sf_dir: str) -> StarSchema:
    return prepared(spark, sf_dir).star()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"


# -- naming, parsing, quality ------------------------------------------------

def q_column_standardize(spark, sf_dir):
    return standard_rows(spark, sf_dir)


def q_coerce_dates_times_numbers(spark, sf_dir):
    f = prepared(spark, sf_dir).flagged
    return f.select("invoice_id", "sale_date", "sale_time", *NUMERIC_COLUMNS,
                    date_to_iso("sale_date").alias("sale_date_iso"))


def q_dq_flags(spark, sf_dir):
    return prepared(spark, sf_dir).flags


def q_dq_rejects(spark, sf_dir):
    return prepared(spark, sf_dir).rejects


def q_clean_sales(spark, sf_dir):
    return prepared(spark, sf_dir).clean_dedup


def q_dq_metrics(spark, sf_dir):
    return prepared(spark, sf_dir).metrics.drop("null_counts")


def q_dq_null_counts(spark, sf_dir):
    return profile.null_counts(landed_sales_view(spark, sf_dir))


def q_dq_duplicates(spark, sf_dir):
    return prepared(spark, sf_dir).metrics.select(
        "raw_row_count", "raw_duplicate_rows", "duplicate_invoice_ids",
        "invoice_ids_with_duplicates", "clean_rows_after_invoice_dedup")


def q_dq_warnings(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return quality.warnings_long(p.metrics, p.extra_columns)


# -- star schema and checks --------------------------------------------------

def q_dim_branch(spark, sf_dir):
    return star(spark, sf_dir).dim_branch


def q_dim_product(spark, sf_dir):
    return star(spark, sf_dir).dim_product


def q_fact_sales(spark, sf_dir):
    return star(spark, sf_dir).fact_sales


def q_fk_orphans(spark, sf_dir):
    s = star(spark, sf_dir)
    return checks.orphan_counts(s.fact_sales, s.dim_branch, s.dim_product)


def q_constraint_checks(spark, sf_dir):
    s = star(spark, sf_dir)
    return checks.constraint_report(s.dim_branch, s.dim_product, s.fact_sales, in_key_order=True)


def q_row_counts(spark, sf_dir):
    s = star(spark, sf_dir)
    return checks.row_counts({"dim_branch": s.dim_branch, "dim_product": s.dim_product,
                              "fact_sales": s.fact_sales})


# -- reports -----------------------------------------------------------------

def q_sales_report(spark, sf_dir):
    s = star(spark, sf_dir)
    return report.sales_report(s.fact_sales, s.dim_branch, s.dim_product)


def q_report_topn(spark, sf_dir):
    s = star(spark, sf_dir)
    return report.top_products_per_branch(
        report.sales_report(s.fact_sales, s.dim_branch, s.dim_product, ordered=False), 3)


def q_report_preview(spark, sf_dir):
    s = star(spark, sf_dir)
    return report.head(report.sales_report(s.fact_sales, s.dim_branch, s.dim_product, ordered=False), 10)


def q_revenue_total(spark, sf_dir):
    return report.revenue_total(star(spark, sf_dir).fact_sales)


def q_sales_by_product_line(spark, sf_dir):
    s = star(spark, sf_dir)
    return report.sales_by_product_line(s.fact_sales, s.dim_product)


def q_income_by_branch(spark, sf_dir):
    s = star(spark, sf_dir)
    return report.income_by_branch(s.fact_sales, s.dim_branch)


def q_rating_by_city(spark, sf_dir):
    s = star(spark, sf_dir)
    return report.rating_by_city(s.fact_sales, s.dim_branch)


def q_pivot_total_sales(spark, sf_dir):
    s = star(spark, sf_dir)
    sums = report.sales_by_branch_product(s.fact_sales, s.dim_branch, s.dim_product)
    return profile.pivot_sum(sums, "product_line", "branch_code", driver_table_rules().branches,
                             F.sum("_sales"), round2)


def q_pivot_avg_rating(spark, sf_dir):
    s = star(spark, sf_dir)
    sums = report.sales_by_branch_product(s.fact_sales, s.dim_branch, s.dim_product)
    avg = F.try_divide(F.sum("_rating_sum").cast("double"), F.sum("_rating_n"))
    return profile.pivot_sum(sums, "product_line", "branch_code", driver_table_rules().branches, avg, round2)


# -- profiles of the raw rows ------------------------------------------------

def q_value_counts_branch(spark, sf_dir):
    return profile.value_counts(standard_rows(spark, sf_dir), "branch")


def q_value_counts_product_line(spark, sf_dir):
    return profile.value_counts(standard_rows(spark, sf_dir), "product_line")


def q_describe_numeric(spark, sf_dir):
    f = prepared(spark, sf_dir).flagged
    return profile.describe_numeric(f, {c: c for c in NUMERIC_COLUMNS})


def q_rating_histogram(spark, sf_dir):
    return profile.histogram(prepared(spark, sf_dir).flagged, "rating", 20)


def q_column_profile(spark, sf_dir):
    return profile.column_profile(landed_sales_view(spark, sf_dir))


# -- loads -------------------------------------------------------------------

def _two_loads(spark, sf_dir) -> StarSchema:
    first = prepared(spark, sf_dir, ship_before=FIRST_LOAD_BEFORE).star()
    second = prepared(spark, sf_dir, ship_from=SECOND_LOAD_FROM).clean_dedup
    return merge_into(first, second)


def _two_published_loads(spark, sf_dir) -> Warehouse:
    """The first batch published, then the second merged into it."""
    wh = Warehouse(spark, scratch_dir(spark) + "/warehouse")
    wh.load(prepared(spark, sf_dir, ship_before=FIRST_LOAD_BEFORE).star)
    wh.load(lambda: merge_into(wh.tables(), prepared(spark, sf_dir, ship_from=SECOND_LOAD_FROM).clean_dedup))
    return wh


def q_upsert_fact(spark, sf_dir):
    return _two_published_loads(spark, sf_dir).tables().fact_sales


def q_upsert_branch_city(spark, sf_dir):
    """Branch dimension matched on branch code alone: changed and NULL cities
    overwrite, a branch that arrives late is inserted.  Branches are the
    cities of the clean rows; a branch's one city is a depot named after the
    load's row count."""
    def depots(**batch):
        rows = prepared(spark, sf_dir, **batch).clean_dedup
        return rows.groupBy(F.col("city").alias("branch_code")).agg(F.count(F.lit(1)).alias("n")).selectExpr(
            "branch_code", "case when n % 3 = 0 then null else concat('Depot ', cast(n as string)) end as city")

    target = dense_key_small(depots(ship_before=FIRST_LOAD_BEFORE), ["branch_code"], "branch_key")
    return upsert(target, depots(ship_from=SECOND_LOAD_FROM), ["branch_code"], "branch_key")


def q_upsert_dim_branch(spark, sf_dir):
    return _two_loads(spark, sf_dir).dim_branch


def q_upsert_dim_product(spark, sf_dir):
    return _two_loads(spark, sf_dir).dim_product


def q_csv_roundtrip(spark, sf_dir):
    """Raw rows written as CSV, read back as strings, names standardized."""
    path = scratch_dir(spark) + "/raw_csv"
    write_csv(landed_sales_view(spark, sf_dir), path)
    return quality.standardized(read_csv_strings(spark, path), driver_table_rules())[0]


def q_parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark) + "/fact_sales"
    star(spark, sf_dir).fact_sales.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def q_staged_publish(spark, sf_dir):
    """Full load into a fresh warehouse, then a load that fails while it
    writes the fact; the report is read back through the manifest and still
    shows the first load."""
    wh, _ = _good_and_bad_load(spark, sf_dir)
    t = wh.tables()
    return report.sales_report(t.fact_sales, t.dim_branch, t.dim_product)


def _good_and_bad_load(spark, sf_dir, view: str | None = None) -> tuple[Warehouse, StarSchema]:
    wh = Warehouse(spark, scratch_dir(spark) + "/warehouse", view=view)
    s = star(spark, sf_dir)
    wh.load(s, run_id="good")
    broken = s.fact_sales.withColumn("rating", F.raise_error(F.lit("broken source")).cast("double"))
    try:
        wh.load(StarSchema(s.dim_branch, s.dim_product, broken), run_id="bad")
    except RuntimeError:
        return wh, s
    raise AssertionError("the broken load was published")


def q_load_summary_json(spark, sf_dir):
    """The summary documents of a load and of a failed one, and the rows published after both."""
    wh, _ = _good_and_bad_load(spark, sf_dir)
    published = wh.tables().fact_sales.count()
    docs = None
    for name in ("good", "bad"):
        doc = spark.read.schema("succeeded array<string>, failed array<string>, total long").json(wh.summary_path(name))
        steps = F.concat(F.transform("succeeded", lambda x: F.struct(x.alias("step"), F.lit("succeeded").alias("outcome"))),
                         F.transform("failed", lambda x: F.struct(x.alias("step"), F.lit("failed").alias("outcome"))))
        doc = doc.select(F.lit(name).alias("run"), "total", F.explode(steps).alias("s")).select("run", "s.step", "s.outcome", "total")
        docs = doc if docs is None else docs.unionByName(doc)
    return docs.withColumn("published_rows", F.lit(published).cast("long"))


def q_dq_report_json(spark, sf_dir):
    """The quality report of a file with one extra column, written as JSON and
    read back: its warnings, metrics and null counts as rows."""
    raw = landed_sales_view(spark, sf_dir).withColumn("Channel", F.lit("shop"))
    path = scratch_dir(spark) + "/data_quality_report"
    write_json(prepare(raw, driver_table_rules()).report(), path)
    doc = spark.read.json(path)
    metrics = [F.struct(F.lit("metric").alias("section"), F.lit(m).alias("name"), F.col(f"metrics.{m}").alias("value"))
               for m in quality.METRIC_COLUMNS]
    nulls = [f.name for f in doc.schema["metrics"].dataType["null_counts"].dataType]
    counts = [F.struct(F.lit("null_count").alias("section"), F.lit(n).alias("name"), F.col(f"metrics.null_counts.`{n}`").alias("value"))
              for n in nulls]
    warned = F.transform("warnings", lambda w: F.struct(
        F.lit("warning").alias("section"),
        F.concat(w["type"], F.coalesce(F.concat(F.lit(": "), F.array_join(w["columns"], ", ")), F.lit(""))).alias("name"),
        w["count"].alias("value")))
    return doc.select(F.explode(F.concat(warned, F.array(*metrics, *counts))).alias("r")).select("r.section", "r.name", "r.value")


def q_export_roundtrip(spark, sf_dir):
    """The fact as exported to CSV after a published load, read back with its types."""
    folder = scratch_dir(spark)
    wh = Warehouse(spark, folder + "/warehouse")
    wh.load(star(spark, sf_dir), export_dir=folder + "/export")
    rows = read_csv_strings(spark, folder + "/export/fact_sales")
    types = dict(wh.read("fact_sales").dtypes)
    return rows.select(*[F.col(c).cast(types[c]).alias(c) for c in FACT_COLUMNS])


def q_column_replacement_names(spark, sf_dir):
    """The raw rows under the second naming strategy."""
    raw = landed_sales_view(spark, sf_dir)
    return raw.select(*[F.col(c).alias(replacement_name(c)) for c in raw.columns])


def q_batch_run(spark, sf_dir):
    """The whole batch over a folder of CSV files; the report file read back."""
    folder = scratch_dir(spark)
    with shuffles_removed(spark):
        write_csv(raw_sales_view(spark, sf_dir, coded=True), folder + "/raw")
    run(spark, folder + "/raw", folder + "/out", folder + "/warehouse", driver_table_rules(), mode="merge")
    types = {"transaction_count": "long", "total_units_sold": "long", "sales_rank_within_branch": "int"}
    types |= {c: "double" for c in ("total_sales", "total_gross_income", "avg_rating", "pct_of_branch_sales")}
    rows = read_csv_strings(spark, folder + "/out/report")
    return rows.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in report.REPORT_COLUMNS])


def q_fact_assertions(spark, sf_dir):
    s = star(spark, sf_dir)
    return checks.fact_assertions(s.fact_sales, s.dim_branch, s.dim_product, driver_table_rules())


def q_report_view(spark, sf_dir):
    """The report view, selected with SQL after a published load and a failed one."""
    view = f"vw_sales_report_{uuid.uuid4().hex}"
    wh, _ = _good_and_bad_load(spark, sf_dir, view)
    return spark.sql(f"SELECT * FROM {view}")


def q_stream_rerun(spark, sf_dir):
    """Two batches of CSV files taken in by the stream, one run each, then a
    run without new files: the published fact."""
    folder = scratch_dir(spark)
    for batch in ({"ship_before": FIRST_LOAD_BEFORE}, {"ship_from": SECOND_LOAD_FROM}, None):
        if batch is not None:
            write_csv(landed_sales_view(spark, sf_dir, **batch), f"{folder}/in/{next(iter(batch))}")
        query = start_ingest(spark, f"{folder}/in", f"{folder}/warehouse", f"{folder}/stream", driver_table_rules())
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return Warehouse(spark, f"{folder}/warehouse").read("fact_sales")


def q_required_columns(spark, sf_dir):
    """Which required raw columns a file has that lacks two and renamed one."""
    raw = landed_sales_view(spark, sf_dir).drop(*DROPPED).withColumnsRenamed(RENAMED)
    return checks.required_columns(raw, driver_table_rules().required_columns)


def q_expected_counts(spark, sf_dir):
    """Row counts of the tables against what is expected; one table is missing."""
    return checks.expected_counts(q_row_counts(spark, sf_dir), EXPECTED_ROWS)


def q_approx_quantiles(spark, sf_dir):
    """Quantiles from the sketches that two loads stored, without their rows;
    ``within_error`` is the exact test of each value's rank over all rows."""
    path = scratch_dir(spark) + "/sketches"
    cols = {c: c for c in NUMERIC_COLUMNS}
    flagged = prepared(spark, sf_dir).flagged
    second = F.coalesce(F.year("sale_date") >= 1996, F.lit(False))
    for load in (flagged.where(~second), flagged.where(second)):
        quantiles.column_sketches(load, cols).write.mode("append").parquet(path)
    merged = quantiles.sketch_quantiles(quantiles.merge_sketches(spark.read.parquet(path)), profile.QUANTILES).collect()
    values = {(r["column_name"], label): r[label] for r in merged for label, _ in profile.QUANTILES}
    shares = quantiles.rank_shares(flagged, cols, values)
    rows = []
    for label, p in profile.QUANTILES:
        for r in merged:
            below, upto, n = shares[r["column_name"], label]
            close = below - quantiles.RANK_ERROR * n <= p * n <= upto + quantiles.RANK_ERROR * n
            rows.append((r["column_name"], p, r["count"], r["min"], r["max"], close and r["count"] == n))
    return spark.createDataFrame(rows, "column_name string, quantile double, count long, min double, max double, within_error boolean")


def _driver_types(query: Query) -> Query:
    """Emit DATE columns as TIMESTAMP_NTZ at midnight.

    The driver tables model every date as TIMESTAMP_NTZ; the catalog follows
    that convention so its results compare the same way as the inputs do
    (through pandas a DATE comes back as a date from Spark but as a
    timestamp from DuckDB).  The library and the warehouse keep DATE.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        dates = {f.name for f in df.schema.fields if f.dataType.typeName() == "date"}
        if not dates:
            return df
        return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in dates else F.col(c)
                           for c in df.columns])

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


_QUERIES: dict[str, Query] = {
    "sales_report": q_sales_report,
    "column_standardize": q_column_standardize,
    "coerce_dates_times_numbers": q_coerce_dates_times_numbers,
    "dq_flags": q_dq_flags,
    "dq_rejects": q_dq_rejects,
    "clean_sales": q_clean_sales,
    "dq_metrics": q_dq_metrics,
    "dq_null_counts": q_dq_null_counts,
    "dq_duplicates": q_dq_duplicates,
    "dq_warnings": q_dq_warnings,
    "dim_branch": q_dim_branch,
    "dim_product": q_dim_product,
    "fact_sales": q_fact_sales,
    "fk_orphans": q_fk_orphans,
    "constraint_checks": q_constraint_checks,
    "row_counts": q_row_counts,
    "report_topn": q_report_topn,
    "report_preview": q_report_preview,
    "revenue_total": q_revenue_total,
    "sales_by_product_line": q_sales_by_product_line,
    "income_by_branch": q_income_by_branch,
    "rating_by_city": q_rating_by_city,
    "pivot_total_sales": q_pivot_total_sales,
    "pivot_avg_rating": q_pivot_avg_rating,
    "value_counts_branch": q_value_counts_branch,
    "value_counts_product_line": q_value_counts_product_line,
    "describe_numeric": q_describe_numeric,
    "rating_histogram": q_rating_histogram,
    "column_profile": q_column_profile,
    "upsert_fact": q_upsert_fact,
    "upsert_dim_branch": q_upsert_dim_branch,
    "upsert_dim_product": q_upsert_dim_product,
    "csv_roundtrip": q_csv_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "staged_publish": q_staged_publish,
    "load_summary_json": q_load_summary_json,
    "dq_report_json": q_dq_report_json,
    "export_roundtrip": q_export_roundtrip,
    "column_replacement_names": q_column_replacement_names,
    "batch_run": q_batch_run,
    "fact_assertions": q_fact_assertions,
    "upsert_branch_city": q_upsert_branch_city,
    "report_view": q_report_view,
    "stream_rerun": q_stream_rerun,
    "required_columns": q_required_columns,
    "expected_counts": q_expected_counts,
    "approx_quantiles": q_approx_quantiles,
}

QUERIES: dict[str, Query] = {name: _driver_types(q) for name, q in _QUERIES.items()}
