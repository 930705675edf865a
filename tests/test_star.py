"""Star schema built from the retail sample (the reference's table tests)."""

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_ROWS, raw_frame
from ledgerline.operators import checks, report
from ledgerline.plans.pipeline import prepare, transform
from ledgerline.rules import FACT_COLUMNS, RETAIL_RULES


@pytest.fixture(scope="module")
def star(spark):
    s, _ = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    return s


def test_table_sizes(star):
    assert star.dim_branch.count() == 3
    assert star.dim_product.count() == 3
    assert star.fact_sales.count() == 4


def test_columns(star):
    assert star.dim_branch.columns == ["branch_key", "branch_code", "city"]
    assert star.dim_product.columns == ["product_key", "product_line"]
    assert star.fact_sales.columns == FACT_COLUMNS


def test_dimension_keys_dense_in_sorted_order(star):
    assert [tuple(r) for r in star.dim_branch.orderBy("branch_key").collect()] == [
        (1, "A", "Yangon"), (2, "B", "Mandalay"), (3, "C", "Naypyitaw")]
    assert [tuple(r) for r in star.dim_product.orderBy("product_key").collect()] == [
        (1, "Food and beverages"), (2, "Health and beauty"), (3, "Sports and travel")]


def test_fact_keys_follow_invoice_order(star):
    rows = star.fact_sales.orderBy("sales_key").select("sales_key", "invoice_id").collect()
    assert [tuple(r) for r in rows] == [(1, "INV-001"), (2, "INV-002"), (3, "INV-003"), (4, "INV-004")]


def test_no_null_or_orphan_foreign_keys(star):
    f = star.fact_sales
    assert f.filter(F.col("branch_key").isNull() | F.col("product_key").isNull()).count() == 0
    counts = {r["foreign_key"]: r["orphan_rows"]
              for r in checks.orphan_counts(f, star.dim_branch, star.dim_product).collect()}
    assert counts == {"branch_key": 0, "product_key": 0}


def test_constraints_hold(star):
    rep = checks.constraint_report(star.dim_branch, star.dim_product, star.fact_sales)
    assert rep.count() == 11
    assert rep.filter(F.col("violations") != 0).count() == 0


def test_value_ranges_and_domains(star):
    f = star.fact_sales
    assert f.filter(F.col("total_amount") <= 0).count() == 0
    assert f.filter((F.col("rating") < 1) | (F.col("rating") > 10)).count() == 0
    assert f.filter(F.col("quantity") <= 0).count() == 0
    assert f.filter(F.col("invoice_id").isNull()).count() == 0
    for col, allowed in [("customer_type", RETAIL_RULES.customer_types), ("gender", RETAIL_RULES.genders),
                         ("payment_method", RETAIL_RULES.payments)]:
        assert f.filter(~F.col(col).isin(allowed)).count() == 0
    b = star.dim_branch
    assert b.filter(~F.col("branch_code").isin(RETAIL_RULES.branches)).count() == 0
    assert b.filter(~F.col("city").isin(RETAIL_RULES.cities)).count() == 0


def test_fact_types(star):
    types = dict(star.fact_sales.dtypes)
    assert types["sales_key"] == "bigint" and types["quantity"] == "bigint"
    assert types["sale_date"] == "date" and types["sale_time"] == "string"
    assert types["unit_price"] == "double"


def test_row_counts_expectations(star):
    counts = checks.row_counts({"dim_branch": star.dim_branch, "dim_product": star.dim_product,
                                "fact_sales": star.fact_sales})
    assert checks.assert_counts(counts, {"dim_branch": (3, 3), "dim_product": (3, 3), "fact_sales": (4, None)}) == []
    assert checks.assert_counts(counts, {"fact_sales": (1000, None)}) == ["fact_sales: 4 rows, expected [1000, None]"]


def test_sales_report(star):
    rows = report.sales_report(star.fact_sales, star.dim_branch, star.dim_product).collect()
    assert [(r["branch_code"], r["product_line"], r["sales_rank_within_branch"]) for r in rows] == [
        ("A", "Health and beauty", 1), ("A", "Food and beverages", 2),
        ("B", "Food and beverages", 1), ("C", "Sports and travel", 1)]
    a = {r["product_line"]: r for r in rows if r["branch_code"] == "A"}
    assert a["Health and beauty"]["total_sales"] == 21.0
    assert a["Health and beauty"]["pct_of_branch_sales"] == pytest.approx(66.67)
    assert a["Food and beverages"]["pct_of_branch_sales"] == pytest.approx(33.33)
    assert rows[2]["pct_of_branch_sales"] == 100.0
    assert rows[0]["transaction_count"] == 1 and rows[0]["total_units_sold"] == 2
    assert rows[0]["avg_rating"] == 7.0


def test_report_rank_ties_share_rank(spark):
    rows = [list(SAMPLE_ROWS[0]), list(SAMPLE_ROWS[0])]
    rows[1][0] = "INV-009"
    rows[1][5] = "Health and beauty"
    s, _ = transform(raw_frame(spark, rows), RETAIL_RULES)
    ranks = [r["sales_rank_within_branch"] for r in report.sales_report(s.fact_sales, s.dim_branch,
                                                                        s.dim_product).collect()]
    assert ranks == [1, 1]


def test_report_top_n_and_dashboards(star):
    rep = report.sales_report(star.fact_sales, star.dim_branch, star.dim_product, ordered=False)
    assert report.top_products_per_branch(rep, 1).count() == 3
    assert report.revenue_total(star.fact_sales).first()["total_revenue"] == 105.0
    by_line = {r[0]: r[1] for r in report.sales_by_product_line(star.fact_sales, star.dim_product).collect()}
    assert by_line == {"Food and beverages": 42.0, "Health and beauty": 21.0, "Sports and travel": 42.0}
    by_branch = {r[0]: r[1] for r in report.income_by_branch(star.fact_sales, star.dim_branch).collect()}
    assert by_branch == {"A": 1.5, "B": 1.5, "C": 2.0}
    by_city = {r[0]: r[1] for r in report.rating_by_city(star.fact_sales, star.dim_branch).collect()}
    assert by_city == {"Yangon": 7.5, "Mandalay": 9.0, "Naypyitaw": 6.0}


def test_quality_report_document(spark):
    p = prepare(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    doc = p.report().first()
    assert doc["metrics"]["raw_row_count"] == 4
    assert doc["metrics"]["clean_rows_after_invoice_dedup"] == 4
