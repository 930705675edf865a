"""Whole rows are shuffled once between the flagged rows and the fact, and written once."""

import datetime as dt
import random

import pytest

from conftest import good_row, raw_frame
from ledgerline import session
from ledgerline.operators import quality
from ledgerline.operators.star import build_star
from ledgerline.plans.pipeline import prepare
from ledgerline.rules import RETAIL_RULES


def sales(n=60):
    """Invoices of two or three rows each, some with a later, different copy."""
    rows = [good_row(**{"Invoice ID": f"INV-{i % n:03d}", "Date": f"1/{1 + i // n}/2019", "Rating": str(i // n),
                        "Product line": ["Food and beverages", "Sports and travel"][i % 2]}) for i in range(2 * n + 11)]
    random.Random(3).shuffle(rows)
    return rows


def whole_row_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_many_repeated_ids_take_one_shuffle_which_numbers_the_fact(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    p = prepare(raw_frame(spark, sales()), RETAIL_RULES)
    exchanges = whole_row_exchanges(p.clean_dedup)
    assert len(exchanges) == 1 and "rangepartitioning" in exchanges[0]
    star = p.star()
    fact = star.fact_sales
    assert not any("rangepartitioning" in line or "invoice_id" in line for line in whole_row_exchanges(fact))
    got = [(r["sales_key"], r["invoice_id"], r["rating"]) for r in fact.orderBy("sales_key").collect()]
    assert got == [(i + 1, f"INV-{i:03d}", 0.0) for i in range(60)]


@pytest.mark.parametrize("limit", [0, 1 << 27])
@pytest.mark.parametrize("partitions", [None, 3])
def test_the_fact_is_the_same_by_either_way(spark, monkeypatch, limit, partitions):
    monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
    star = prepare(raw_frame(spark, sales()), RETAIL_RULES).star(partitions)
    rows = star.fact_sales.orderBy("sales_key").collect()
    assert [(r["sales_key"], r["invoice_id"], r["rating"]) for r in rows] == [(i + 1, f"INV-{i:03d}", 0.0) for i in range(60)]
    lines = {r["product_key"]: r["product_line"] for r in star.dim_product.collect()}
    assert [lines[r["product_key"]] for r in rows] == [["Food and beverages", "Sports and travel"][i % 2] for i in range(60)]


def test_hot_ids_are_reduced_before_their_rows_meet(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(quality, "HOT_ROWS", 50)
    day = dt.date(2019, 1, 5)
    rows = [("hot", day, "09:05:00", n % 7) for n in range(200)] + [(None, None, None, n) for n in range(80)]
    rows += [(f"i{n % 40}", day, "09:05:00", n) for n in range(90)]
    df = spark.createDataFrame(rows, "invoice_id string, sale_date date, sale_time string, n int").repartition(4)
    kept = quality.keep_first(df, instant=quality.SALE_SECOND)
    plan = kept.rows._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan
    got = {r["invoice_id"]: r["n"] for r in kept.rows.collect()}
    assert kept.in_key_order and kept.rows.count() == 42
    assert got == {"hot": 0, None: 0} | {f"i{n}": n for n in range(40)}


def test_rows_not_in_order_are_put_in_order(spark):
    p = prepare(raw_frame(spark, sales()), RETAIL_RULES)
    star = build_star(p.clean_dedup.repartition(5))
    keys = [r["invoice_id"] for r in star.fact_sales.orderBy("sales_key").select("invoice_id").collect()]
    assert keys == sorted(keys) and len(keys) == 60


def test_unparsed_columns_are_stored_once(spark):
    p = prepare(raw_frame(spark, sales()), RETAIL_RULES)
    stored = p._landed[0].table.columns
    assert "raw_city" not in stored and "raw_unit_price" in stored
    row = p.written.first()
    assert row["raw_city"] == row["city"] == "Yangon" and row["raw_unit_price"] == "10" and row["unit_price"] == 10.0
    assert p.metrics.first()["raw_duplicate_rows"] == 0


def tied_sales():
    """Two rows of each of 40 invoices, equal in date and time, that differ in their categories, and a rejected row."""
    places = [("B", "Mandalay"), ("A", "Yangon"), ("C", "Naypyitaw")]
    rows = []
    for i in range(80):
        branch, city = places[i % 3]
        rows.append(good_row(**{"Invoice ID": f"INV-{i // 2:03d}", "Branch": branch, "City": city, "Customer type": ["Normal", "Member"][i // 3 % 2],
                                "Gender": ["Male", "Female"][i // 5 % 2], "Payment": ["Ewallet", "Cash", "Credit card"][i // 7 % 3]}))
    return [*rows, good_row(**{"Invoice ID": "INV-999", "Gender": None})]


@pytest.mark.parametrize("limit", [0, 1 << 27])
def test_categories_travel_as_numbers_and_come_back(spark, monkeypatch, limit):
    monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
    p = prepare(raw_frame(spark, tied_sales()), RETAIL_RULES)
    by_text = quality.keep_first(quality.clean_rows(p.flagged), instant=quality.SALE_SECOND).rows
    assert p.clean_dedup.columns == by_text.columns and p.clean_dedup.dtypes == by_text.dtypes
    assert sorted(map(str, p.clean_dedup.collect())) == sorted(map(str, by_text.collect())) and by_text.count() == 40
    if limit == 0:
        below = p.clean_dedup._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)[1]
        assert "_cat0" in below.splitlines()[1] and "gender" not in below.splitlines()[1].split(" AS ")[-1]


def test_neighbours_are_numbered_in_the_order_of_their_values():
    rules = RETAIL_RULES.with_(branches=["b", "a"], cities=["y", "x"])
    runs = quality.category_runs(["branch", "city", "rating", "gender"], rules)
    assert runs == [[("branch", ["a", "b"]), ("city", ["x", "y"])], [("gender", sorted(rules.genders))]]
    many = RETAIL_RULES.with_(branches=[str(i) for i in range(1 << 12)])
    monster = quality.category_runs(["branch"] * 6, many)
    assert [len(run) for run in monster] == [5, 1]


def test_a_star_alone_writes_only_the_clean_rows(spark):
    p = prepare(raw_frame(spark, tied_sales()), RETAIL_RULES)
    with session.cut_scope(spark) as made:
        assert p.star().dim_product.count() == 1
        landed = spark.read.parquet(made[0])
        assert landed.count() == 80 and "rejected" not in landed.columns
        assert not [c for c in landed.columns if c.startswith(quality.RAW)]


def test_flagged_rows_that_are_there_are_read_instead(spark):
    p = prepare(raw_frame(spark, tied_sales()), RETAIL_RULES)
    assert p.flags.count() == 81
    with session.cut_scope(spark) as made:
        assert p.clean_dedup.count() == 40
        assert all(spark.read.parquet(path).count() <= 40 for path in made)
