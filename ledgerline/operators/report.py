"""Reports over the star schema.

The fact is aggregated on its integer dimension keys first (partial
aggregation on every map task, one small shuffle), and only the aggregated
rows meet the dimensions.  The windows then run over one row per
(branch, city, product line), never over fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.money import MONEY_SUM_TYPE, beyond_sum, exact_sum, percent_of, round2, round_sql, total

REPORT_COLUMNS = [
    "branch_code", "city", "product_line", "transaction_count", "total_units_sold",
    "total_sales", "total_gross_income", "avg_rating", "sales_rank_within_branch",
    "pct_of_branch_sales",
]


def _sums(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("sales_key").alias("transaction_count"),
        F.sum(F.col("quantity").cast("decimal(20,0)")).alias("total_units_sold"),
        exact_sum("total_amount").alias("_sales"), beyond_sum("total_amount").alias("_sales_x"),
        exact_sum("gross_income").alias("_income"), beyond_sum("gross_income").alias("_income_x"),
        exact_sum("rating").alias("_rating_sum"),
        F.count("rating").alias("_rating_n"),
    )


def sales_by_branch_product(fact: DataFrame, dim_branch: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Exact per-(branch_code, city, product_line) sums, inner-joined to dims."""
    per_key = _sums(fact, ["branch_key", "product_key"])
    named = (per_key.join(dim_branch, "branch_key")
             .join(dim_product, "product_key"))
    return named.groupBy("branch_code", "city", "product_line").agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("total_units_sold").alias("total_units_sold"),
        F.try_sum("_sales").alias("_sales"), F.sum("_sales_x").alias("_sales_x"),
        F.try_sum("_income").alias("_income"), F.sum("_income_x").alias("_income_x"),
        F.sum("_rating_sum").alias("_rating_sum"),
        F.sum("_rating_n").alias("_rating_n"),
    )


def _cents(exact: str, beyond: str) -> Column:
    """A money total rounded to cents."""
    return F.when(F.col(beyond).isNull(), round2(exact)).otherwise(round2(total(exact, beyond)))


def sales_report(fact: DataFrame, dim_branch: DataFrame, dim_product: DataFrame,
                 ordered: bool = True) -> DataFrame:
    """Per branch, city and product line: counts, sums, average rating, rank
    of sales inside the branch (ties share a rank) and percent of branch sales."""
    g = sales_by_branch_product(fact, dim_branch, dim_product).withColumn("_total", total("_sales", "_sales_x"))
    branch = Window.partitionBy("branch_code")
    whole = total(F.try_sum("_sales").over(branch), F.sum("_sales_x").over(branch))
    out = g.select(
        "branch_code", "city", "product_line",
        F.col("transaction_count").cast("long").alias("transaction_count"),
        F.col("total_units_sold").try_cast("long").alias("total_units_sold"),
        _cents("_sales", "_sales_x").alias("total_sales"),
        _cents("_income", "_income_x").alias("total_gross_income"),
        round2(F.try_divide(F.col("_rating_sum").cast("double"), F.col("_rating_n"))).alias("avg_rating"),
        F.rank().over(branch.orderBy(F.col("_total").desc(), F.col("_sales").desc())).cast("int").alias("sales_rank_within_branch"),
        percent_of(F.col("_total"), whole).alias("pct_of_branch_sales"),
    )
    if ordered:
        out = out.orderBy("branch_code", "sales_rank_within_branch", "product_line")
    return out


def _exact(c: str) -> str:
    return f"try_sum(try_cast({c} AS {MONEY_SUM_TYPE}))"


def _beyond(c: str) -> str:
    return f"sum(CASE WHEN try_cast({c} AS {MONEY_SUM_TYPE}) IS NULL THEN {c} END)"


def _total(exact: str, beyond: str) -> str:
    return (f"CASE WHEN {beyond} IS NULL THEN cast({exact} AS double) "
            f"ELSE coalesce(cast({exact} AS double), 0D) + {beyond} END")


def report_sql(fact: str, dim_branch: str, dim_product: str) -> str:
    """The text of :func:`sales_report` over named tables, for a catalog view.

    The same plan: the fact by its integer keys, the dimensions joined to the
    sums, windows over one row per branch, city and product line.
    """
    def cents(exact: str, beyond: str) -> str:
        return f"CASE WHEN {beyond} IS NULL THEN {round_sql(exact)} ELSE {round_sql(_total(exact, beyond))} END"

    branch = "PARTITION BY branch_code"
    whole = f"CASE WHEN sum(sales_x) OVER ({branch}) IS NULL THEN cast(try_sum(sales) OVER ({branch}) AS double) " \
            f"ELSE coalesce(cast(try_sum(sales) OVER ({branch}) AS double), 0D) + sum(sales_x) OVER ({branch}) END"
    return f"""
WITH per_key AS (
  SELECT branch_key, product_key, count(sales_key) AS n, sum(cast(quantity AS decimal(20,0))) AS units,
         {_exact("total_amount")} AS sales, {_beyond("total_amount")} AS sales_x,
         {_exact("gross_income")} AS income, {_beyond("gross_income")} AS income_x,
         {_exact("rating")} AS rating_sum, count(rating) AS rating_n
  FROM {fact} GROUP BY branch_key, product_key
), named AS (
  SELECT branch_code, city, product_line, sum(n) AS n, sum(units) AS units, try_sum(sales) AS sales, sum(sales_x) AS sales_x,
         try_sum(income) AS income, sum(income_x) AS income_x, sum(rating_sum) AS rating_sum, sum(rating_n) AS rating_n
  FROM per_key JOIN {dim_branch} USING (branch_key) JOIN {dim_product} USING (product_key)
  GROUP BY branch_code, city, product_line
), totals AS (
  SELECT *, {_total("sales", "sales_x")} AS whole_sales FROM named
), shares AS (
  SELECT *, {whole} AS branch_sales,
         rank() OVER ({branch} ORDER BY whole_sales DESC, sales DESC) AS place
  FROM totals
)
SELECT branch_code, city, product_line, n AS transaction_count, try_cast(units AS bigint) AS total_units_sold,
       {cents("sales", "sales_x")} AS total_sales, {cents("income", "income_x")} AS total_gross_income,
       {round_sql("try_divide(cast(rating_sum AS double), rating_n)")} AS avg_rating,
       cast(place AS int) AS sales_rank_within_branch,
       {round_sql("try_divide(whole_sales * 100D, CASE WHEN branch_sales <> 0 THEN branch_sales END)")} AS pct_of_branch_sales
FROM shares
"""


def top_products_per_branch(report: DataFrame, n: int) -> DataFrame:
    """The top-``n`` ranked rows of every branch (ties at the cut included)."""
    return report.filter(F.col("sales_rank_within_branch") <= n)


def head(report: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of the report in its order (a preview).  City breaks
    the remaining ties, so the preview is deterministic."""
    return report.orderBy("branch_code", "sales_rank_within_branch", "product_line", "city").limit(n)


def revenue_total(fact: DataFrame) -> DataFrame:
    """Scorecard: total revenue over the fact."""
    sums = fact.agg(exact_sum("total_amount").alias("_sales"), beyond_sum("total_amount").alias("_x"))
    return sums.select(_cents("_sales", "_x").alias("total_revenue"))


def _named_sums(fact: DataFrame, key: str, measure: str, dim: DataFrame, name: str, out: str) -> DataFrame:
    """Sums of a measure by a dimension's name: the fact by key first, then the few keys by name."""
    per_key = fact.groupBy(key).agg(exact_sum(measure).alias("_s"), beyond_sum(measure).alias("_x"))
    return (per_key.join(dim, key).groupBy(name).agg(F.try_sum("_s").alias("_s"), F.sum("_x").alias("_x"))
            .select(name, _cents("_s", "_x").alias(out)))


def sales_by_product_line(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return _named_sums(fact, "product_key", "total_amount", dim_product, "product_line", "total_sales")


def income_by_branch(fact: DataFrame, dim_branch: DataFrame) -> DataFrame:
    return _named_sums(fact, "branch_key", "gross_income", dim_branch, "branch_code", "total_gross_income")


def rating_by_city(fact: DataFrame, dim_branch: DataFrame) -> DataFrame:
    per_key = fact.groupBy("branch_key").agg(exact_sum("rating").alias("_s"), F.count("rating").alias("_n"))
    return (per_key.join(dim_branch, "branch_key").groupBy("city")
            .agg(round2(F.try_divide(F.sum("_s").cast("double"), F.sum("_n"))).alias("avg_rating")))
