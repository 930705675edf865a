"""Star schema: branch and product dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import round_sql
from ledgerline.operators.keys import dense_key_large, dense_key_small, in_key_order, number_rows, place_rows, range_partitions
from ledgerline.rules import FACT_COLUMNS
from ledgerline.session import Cut, cut_lineage, cut_table

DIM_BRANCH_COLUMNS = ["branch_key", "branch_code", "city"]
DIM_PRODUCT_COLUMNS = ["product_key", "product_line"]

Table = DataFrame | Callable[[], DataFrame]


class StarSchema:
    """The three tables; each may be given as a function, called at first use.

    A reader of a dimension therefore never pays for the fact.
    ``fact_bytes`` is the written size that the fact comes from, which sets
    the number of its buckets.  ``fact_buckets`` is the bucket count of the
    table that the fact reads, if it is bucketed by invoice id; a merged fact
    then has ``fact_parts``: the rows of the old fact, still in its buckets,
    and the new rows.
    """

    def __init__(self, dim_branch: Table, dim_product: Table, fact_sales: Table,
                 fact_bytes: int | Callable[[], int] = 0, fact_buckets: int | None = None,
                 fact_parts: Callable[[], tuple[DataFrame, DataFrame]] | None = None):
        self._tables = [t if isinstance(t, DataFrame) else cache(t) for t in (dim_branch, dim_product, fact_sales)]
        self._bytes = fact_bytes
        self.fact_buckets = fact_buckets
        self.fact_parts = fact_parts

    def _table(self, i: int) -> DataFrame:
        t = self._tables[i]
        return t if isinstance(t, DataFrame) else t()

    @property
    def dim_branch(self) -> DataFrame:
        return self._table(0)

    @property
    def dim_product(self) -> DataFrame:
        return self._table(1)

    @property
    def fact_sales(self) -> DataFrame:
        return self._table(2)

    @property
    def fact_bytes(self) -> int:
        return self._bytes if isinstance(self._bytes, int) else self._bytes()


def build_dim_branch(clean: DataFrame) -> DataFrame:
    """Distinct (branch, city) pairs keyed 1..n in (branch, city) order."""
    members = clean.select(F.col("branch").alias("branch_code"), "city").distinct()
    return dense_key_small(members, ["branch_code", "city"], "branch_key")


def build_dim_product(members: Cut) -> DataFrame:
    """Distinct product lines keyed 1..n in name order.

    Product lines have no list of allowed values, so they are numbered
    without a single-task window.
    """
    lines = members.table.select("product_line").distinct()
    return dense_key_large(lines, "product_line", "product_key", members.bytes).select(*DIM_PRODUCT_COLUMNS)


def fact_projection(keyed: DataFrame) -> DataFrame:
    """Fact columns in table order with their warehouse types.

    The warehouse quantity is an integer: a fraction is rounded half up.
    """
    return keyed.select(
        F.col("sales_key").cast("long"), "invoice_id",
        F.col("branch_key").cast("long"), F.col("product_key").cast("long"),
        "sale_date", "sale_time", "customer_type", "gender", "payment_method",
        "unit_price", F.expr(f"try_cast({round_sql('quantity', 0)} as bigint)").alias("quantity"), "tax_amount",
        "total_amount", "cogs", "gross_margin_pct", "gross_income", "rating",
    ).select(*FACT_COLUMNS)


def attach_dimension_keys(rows: DataFrame, dim_branch: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Left-join the surrogate keys onto sales rows.

    Both dimensions are written tables, so Spark's own size check decides
    about broadcasting them.
    """
    branches = dim_branch.withColumnRenamed("branch_code", "branch")
    return rows.join(branches, ["branch", "city"], "left").join(dim_product, ["product_line"], "left")


def member_rows(rows: DataFrame) -> DataFrame:
    """One row per (branch, city, product line)."""
    return rows.groupBy("branch", "city", "product_line").agg(F.count(F.lit(1)).alias("rows"))


def build_star(clean_dedup: DataFrame, partitions: int | None = None, in_order: bool = False, size: int = 0) -> StarSchema:
    """Dimensions and fact from deduplicated clean rows.

    For the fact, the deduplicated rows are written once, in the order of
    their invoice ids: a row's key is its place there, and the dimension keys
    are joined on when the fact is read.  Rows that the dedup left in that
    order (``in_order``) are written as they lie, others take one range
    shuffle, into as many ranges as ``partitions`` or the ``size`` of the
    written table they are read from ask for.  Both dimensions come from one
    small aggregate (one row per branch, city and product line), which is
    written too.  A reader of the dimensions alone writes only that aggregate
    and the dimensions.
    """
    made: list[Cut] = []

    def staged() -> Cut:
        if not made:
            rows = clean_dedup
            if partitions or not in_order:
                n = partitions or range_partitions(rows, size * 3 // 2)  # zstd files, as in dense_key_large
                rows = in_key_order(rows.repartitionByRange(n, F.col("invoice_id").asc_nulls_first()), "invoice_id")
            made.append(cut_table(place_rows(rows)))
        return made[0]

    @cache
    def members() -> Cut:
        return cut_table(member_rows(made[0].table if made else clean_dedup))

    @cache
    def dim_branch() -> DataFrame:
        return cut_lineage(build_dim_branch(members().table))

    @cache
    def dim_product() -> DataFrame:
        return cut_lineage(build_dim_product(members()))

    def fact() -> DataFrame:
        numbered = number_rows(staged().table, "sales_key")
        return fact_projection(attach_dimension_keys(numbered, dim_branch(), dim_product()))

    return StarSchema(dim_branch, dim_product, fact, lambda: staged().bytes)
