"""Data-quality rules, one dirty row per rule (and per NULL-logic divergence)."""

import datetime as dt

import pytest

from conftest import SAMPLE_ROWS, good_row, raw_frame
from ledgerline import session
from ledgerline.operators import quality, report
from ledgerline.plans.pipeline import prepare
from ledgerline.rules import RETAIL_RULES

R = "rejected"

CASES = [
    ("valid", {}, set()),
    ("null invoice", {"Invoice ID": None}, {"critical_null", R}),
    ("null branch", {"Branch": None}, {"critical_null", "invalid_branch", R}),
    ("null city", {"City": None}, {"critical_null", "invalid_city", R}),
    ("null product", {"Product line": None}, {"critical_null", R}),
    ("null price", {"Unit price": None}, {"critical_null", "invalid_numeric", R}),
    ("null qty", {"Quantity": None}, {"critical_null", "invalid_numeric", R}),
    ("null total", {"Total": None}, {"critical_null", R}),
    ("null date", {"Date": None}, {"critical_null", "invalid_date", R}),
    ("null time", {"Time": None}, {"critical_null", "invalid_time", R}),
    ("null gender", {"Gender": None}, {"invalid_gender", R}),
    ("null type", {"Customer type": None}, {"invalid_customer_type", R}),
    ("null payment", {"Payment": None}, {"invalid_payment", R}),
    ("null rating", {"Rating": None}, {"invalid_numeric", R}),
    ("bad branch", {"Branch": "D"}, {"invalid_branch", R}),
    ("bad city", {"City": "Paris"}, {"invalid_city", R}),
    ("bad type", {"Customer type": "VIP"}, {"invalid_customer_type", R}),
    ("bad gender", {"Gender": "X"}, {"invalid_gender", R}),
    ("bad payment", {"Payment": "Cheque"}, {"invalid_payment", R}),
    ("date 13/45", {"Date": "13/45/2019"}, {"invalid_date", R}),
    ("date iso", {"Date": "2019-01-05"}, {"invalid_date", R}),
    ("date junk", {"Date": "xx"}, {"invalid_date", R}),
    ("date padded", {"Date": "01/05/2019"}, set()),
    ("time 25:00", {"Time": "25:00"}, {"invalid_time", R}),
    ("time seconds", {"Time": "13:08:09"}, {"invalid_time", R}),
    ("time 13:8", {"Time": "13:8"}, set()),
    ("price text", {"Unit price": "abc"}, {"invalid_numeric", R}),
    ("price zero", {"Unit price": "0"}, {"invalid_numeric", "cogs_mismatch", R}),
    ("price negative", {"Unit price": "-1"}, {"invalid_numeric", "cogs_mismatch", R}),
    ("qty zero", {"Quantity": "0"}, {"invalid_numeric", "cogs_mismatch", R}),
    ("qty fraction", {"Quantity": "2.5"}, {"cogs_mismatch"}),
    ("qty large", {"Quantity": "3000000000"}, {"cogs_mismatch"}),
    ("qty beyond", {"Quantity": "1e30"}, {"invalid_numeric", "cogs_mismatch", R}),
    ("price huge", {"Unit price": "1e30"}, {"cogs_mismatch"}),
    ("price suffix d", {"Unit price": "10d"}, {"invalid_numeric", R}),
    ("price suffix f", {"Unit price": "10F"}, {"invalid_numeric", R}),
    ("price spaces", {"Unit price": " 1.0e1 "}, set()),
    ("cogs huge", {"cogs": "1e30"}, {"tax_mismatch", "total_mismatch", "cogs_mismatch"}),
    ("total infinite", {"Total": "inf"}, {"total_mismatch"}),
    ("rating low", {"Rating": "-0.1"}, {"invalid_numeric", R}),
    ("rating high", {"Rating": "10.1"}, {"invalid_numeric", R}),
    ("rating bounds", {"Rating": "10"}, set()),
    ("tax off 0.03", {"Tax 5%": "1.03"}, {"tax_mismatch", "total_mismatch", "gross_income_mismatch"}),
    ("tax off 0.01", {"Tax 5%": "1.01"}, set()),
    ("tax null", {"Tax 5%": None}, {"total_mismatch", "gross_income_mismatch"}),
    ("total off 0.03", {"Total": "21.03"}, {"total_mismatch"}),
    ("total off 0.02", {"Total": "21.02"}, set()),
    ("cogs off 0.03", {"cogs": "20.03"}, {"total_mismatch", "cogs_mismatch"}),
    ("income off 0.03", {"gross income": "1.03"}, {"gross_income_mismatch"}),
]


@pytest.fixture(scope="module")
def flagged_cases(spark):
    rows = [good_row(**{"Invoice ID": f"INV-{i:03d}", **changes}) if "Invoice ID" not in changes
            else good_row(**changes) for i, (_, changes, _) in enumerate(CASES)]
    raw = raw_frame(spark, rows)
    p = prepare(raw, RETAIL_RULES)
    by_id = {r["invoice_id"]: r for r in p.flagged.collect()}
    return p, [by_id[row[0]] for row in rows]


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_flags_per_rule(flagged_cases, i):
    _, rows = flagged_cases
    row = rows[i]
    got = {f for f in quality.FLAGS if row[f]}
    assert got == CASES[i][2]
    assert all(row[f] is not None for f in quality.FLAGS), "flags are never NULL"


def test_raw_equals_clean_plus_rejected(flagged_cases):
    p, rows = flagged_cases
    m = p.metrics.first()
    assert m["raw_row_count"] == len(CASES)
    assert m["clean_rows"] + m["rejected_rows"] == m["raw_row_count"]
    assert m["rejected_rows"] == sum(1 for c in CASES if R in c[2])
    # Null counts are taken on the raw text: unparseable dates are not NULL.
    assert m["null_counts"]["Date"] == 1
    assert m["null_counts"]["Unit price"] == 1


def test_parsed_types(flagged_cases):
    _, rows = flagged_cases
    valid = rows[0]
    assert valid["sale_date"] == dt.date(2019, 1, 5)
    assert valid["sale_time"] == "09:05:00"
    assert valid["unit_price"] == 10.0
    padded = rows[[c[0] for c in CASES].index("time 13:8")]
    assert padded["sale_time"] == "13:08:00"


def test_sample_metrics_and_warnings(spark, sample_raw):
    p = prepare(sample_raw, RETAIL_RULES)
    m = p.metrics.first()
    assert m["raw_row_count"] == 4
    assert m["clean_rows_after_invoice_dedup"] == 4
    assert m["rejected_rows"] == 0
    assert m["cogs_mismatch_rows"] == 3
    assert m["null_counts"]["Invoice ID"] == 0 and len(m["null_counts"]) == 17
    warnings = [tuple(w)[:2] for w in quality.warnings(p.metrics).first()["warnings"]]
    assert warnings == [("cogs_mismatch_rows", 3)]


def test_duplicates_and_keep_first(spark):
    rows = [list(r) for r in SAMPLE_ROWS]
    rows.append(list(SAMPLE_ROWS[0]))                               # exact copy
    later = good_row(**{"Invoice ID": "INV-200", "Date": "1/6/2019"})
    earlier = good_row(**{"Invoice ID": "INV-200", "Date": "1/5/2019", "Rating": "9"})
    rows += [later, earlier]
    p = prepare(raw_frame(spark, rows), RETAIL_RULES)
    m = p.metrics.first()
    assert m["raw_duplicate_rows"] == 1
    assert m["duplicate_invoice_ids"] == 2          # surplus rows
    assert m["invoice_ids_with_duplicates"] == 2    # INV-001 and INV-200
    assert m["clean_rows_after_invoice_dedup"] == 5
    kept = {r["invoice_id"]: r for r in p.clean_dedup.collect()}
    assert len(kept) == 5
    assert kept["INV-200"]["sale_date"] == dt.date(2019, 1, 5)
    assert kept["INV-200"]["rating"] == 9.0


def test_extra_column_warning_and_missing_column(spark):
    from ledgerline.rules import RETAIL_REQUIRED_COLUMNS

    cols = RETAIL_REQUIRED_COLUMNS + ["Note"]
    raw = raw_frame(spark, [r + ["x"] for r in SAMPLE_ROWS], cols)
    p = prepare(raw, RETAIL_RULES)
    assert p.extra_columns == ["Note"]
    report = p.report().first()
    assert report["warnings"][0]["type"] == "extra_columns"
    assert report["warnings"][0]["columns"] == ["Note"]
    assert report["errors"] == []
    missing = raw_frame(spark, [r[1:] for r in SAMPLE_ROWS], RETAIL_REQUIRED_COLUMNS[1:])
    with pytest.raises(ValueError, match="Invoice ID"):
        prepare(missing, RETAIL_RULES)


def test_rejects_and_flag_table(flagged_cases):
    p, _ = flagged_cases
    assert p.flags.count() == len(CASES)
    assert p.flags.columns == ["invoice_id"] + quality.FLAGS
    warn_only = sum(1 for c in CASES if c[2] and R not in c[2])
    assert p.rejects.count() == sum(1 for c in CASES if R in c[2]) + warn_only


def test_empty_input(spark):
    p = prepare(raw_frame(spark, []), RETAIL_RULES)
    m = p.metrics.first()
    assert m["raw_row_count"] == 0 and m["rejected_rows"] == 0 and m["clean_rows_after_invoice_dedup"] == 0


def test_rejected_rows_are_dropped_at_the_scan(flagged_cases):
    p, _ = flagged_cases
    plan = p.clean_dedup._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange", 1)[1]
    assert "Filter NOT rejected" in below and "PushedFilters: [Not(EqualTo(rejected,true))]" in below


def test_huge_amounts_do_not_stop_star_and_report(spark):
    rows = [good_row(), good_row(**{"Invoice ID": "INV-101", "Unit price": "1e30", "Total": "1e30", "Quantity": "3000000000"}),
            good_row(**{"Invoice ID": "INV-102", "Quantity": "2.5", "Branch": "B", "City": "Mandalay"})]
    star = prepare(raw_frame(spark, rows), RETAIL_RULES).star()
    fact = {r["invoice_id"]: r for r in star.fact_sales.collect()}
    assert [fact[f"INV-10{i}"]["quantity"] for i in range(3)] == [2, 3_000_000_000, 3]
    got = {r["branch_code"]: r for r in report.sales_report(star.fact_sales, star.dim_branch, star.dim_product).collect()}
    assert got["A"]["total_sales"] == 1e30 and got["B"]["total_sales"] == 21.0
    assert report.revenue_total(star.fact_sales).first()["total_revenue"] == 1e30


def duplicate_sets():
    """Rows of which some repeat, some differ in one column, some only in where a NULL stands."""
    rows = [good_row(**{"Invoice ID": f"D-{i % 40}", "Quantity": str(1 + i % 3)}) for i in range(400)]
    rows += [good_row(**{"Branch": None, "City": "A"}), good_row(**{"Branch": "A", "City": None})]
    rows += [good_row(**{"Gender": None, "Payment": "Male"})] * 3
    return rows


@pytest.mark.parametrize("kinds", [None, 1, 3])
def test_duplicate_rows_survive_hash_collisions(spark, monkeypatch, kinds):
    """``kinds`` hashes for all rows: every row collides with others."""
    if kinds:
        from pyspark.sql import functions as F

        monkeypatch.setattr(quality, "row_hash", lambda raw: [
            F.pmod(F.xxhash64(*raw), F.lit(kinds)).alias("_h1"), F.lit(0).alias("_h2")])
    rows = duplicate_sets()
    p = prepare(raw_frame(spark, rows), RETAIL_RULES)
    m = p.metrics.first()
    ids = [r[0] for r in rows]
    assert m["raw_row_count"] == len(rows)
    assert m["raw_duplicate_rows"] == len(rows) - len(set(map(tuple, rows)))
    assert m["duplicate_invoice_ids"] == len(ids) - len(set(ids))
    assert m["null_counts"]["Branch"] == 1 and m["null_counts"]["Gender"] == 3


def test_observed_counts_equal_the_aggregate(spark):
    p = prepare(raw_frame(spark, duplicate_sets()), RETAIL_RULES)
    observed = p.metrics.first().asDict()
    assert observed == quality.quality_metrics(p.written, p.rules).first().asDict()
    assert observed["raw_row_count"] == observed["clean_rows"] + observed["rejected_rows"]


def test_metrics_shuffle_hashes_and_ids_only(spark):
    """No exchange of the metrics' first steps carries the raw text of all rows."""
    p = prepare(raw_frame(spark, duplicate_sets()), RETAIL_RULES)
    both = p.written
    plan = quality.duplicate_ids(both)._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_invoice_id" in plan and "raw_city" not in plan.split("Relation")[0]
    raw = [c for c in both.columns if c.startswith(quality.RAW)]
    hashes = both.select(*raw, *quality.row_hash(raw)).groupBy("_h1", "_h2").count()
    text = hashes._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and all("_h1" in line and "raw_" not in line for line in exchanged)


def test_metrics_of_no_rows(spark):
    m = prepare(raw_frame(spark, []), RETAIL_RULES).metrics.first()
    assert all(m[c] == 0 for c in quality.METRIC_COLUMNS) and set(m["null_counts"].values()) == {0}


def _kept_by_hand(rows):
    """(id, date, time, n) kept by sorting in Python, NULLs first."""
    best = {}
    for r in rows:
        rank = [(v is not None, v) for v in (*r[1:],)]
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    return sorted((r for _, r in best.values()), key=str)


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_keep_first_by_instant_equals_the_full_order(spark, broadcast):
    """NULLs in every column, ties, a hot key, copies, ids that occur once; by
    broadcast and by shuffle joins."""
    import random

    rng = random.Random(7)
    days = [None, dt.date(1960, 2, 29), dt.date(2019, 1, 5), dt.date(2019, 1, 6)]
    times = [None, "00:00:00", "09:05:00", "23:59:59"]
    ids = [None, "hot"] + [f"i{n}" for n in range(300)]
    rows = [(rng.choice(ids), rng.choice(days), rng.choice(times), rng.choice([None, 1, 2, 3])) for _ in range(500)]
    rows += [("hot", rng.choice(days[2:]), rng.choice(times), n % 5) for n in range(400)] + [(None, None, None, None)] * 3
    df = spark.createDataFrame(rows, "invoice_id string, sale_date date, sale_time string, n int").repartition(6)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = sorted((tuple(r) for r in quality.dedup_first(df, instant=quality.SALE_SECOND).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == _kept_by_hand(rows)
    assert got == sorted((tuple(r) for r in quality.dedup_first(df).collect()), key=str)
    assert quality.dedup_first(df.limit(0), instant=quality.SALE_SECOND).count() == 0


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_keep_first_shuffles_whole_rows_only_beyond_the_measured_size(spark, monkeypatch, limit):
    """Whatever the session's threshold, few repeated keys leave the other rows where they are; many give the same rows."""
    rows = [(f"i{n % 90}", dt.date(2019, 1, 1 + n % 3), "09:05:00", n) for n in range(100)] + [(None, None, None, 1)] * 2
    df = spark.createDataFrame(rows, "invoice_id string, sale_date date, sale_time string, n int").repartition(4)
    monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = quality.dedup_first(df, instant=quality.SALE_SECOND)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        got = sorted((tuple(r) for r in kept.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == _kept_by_hand(rows)
    assert ("BroadcastHashJoin" in plan and "SortMergeJoin" not in plan) == (limit > 0)


def test_whole_raw_doubles_are_found_without_shuffling_single_rows(spark):
    rows = [good_row(**{"Invoice ID": f"INV-{n % 45}", "Rating": str(n % 45 % 10)}) for n in range(50)]
    p = prepare(raw_frame(spark, rows), RETAIL_RULES)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        doubles = quality.duplicate_rows(p.written)
        assert "SortMergeJoin" not in doubles._jdf.queryExecution().executedPlan().toString()
        assert doubles.first()["raw_duplicate_rows"] == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_instants_follow_the_sale_order(spark):
    days = [None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(2019, 1, 5), dt.date(9999, 12, 31)]
    times = [None, "00:00:00", "00:00:59", "00:01:00", "23:59:59"]
    df = spark.createDataFrame([(i * 10 + j, d, t) for i, d in enumerate(days) for j, t in enumerate(times)],
                               "place int, sale_date date, sale_time string")
    seconds = [r[0] for r in df.orderBy("place").selectExpr(quality.SALE_SECOND).collect()]
    assert all(a < b for a, b in zip(seconds, seconds[1:]))


def test_keep_first_moves_no_row_of_an_id_that_occurs_once(spark):
    rows = [good_row(**{"Invoice ID": f"INV-{n}"}) for n in range(200)] + [good_row(**{"Invoice ID": "INV-7", "Rating": "3"})]
    p = prepare(raw_frame(spark, rows), RETAIL_RULES)
    keys = quality.repeated_keys(quality.clean_rows(p.flagged), "invoice_id", quality.SALE_SECOND)
    assert [r["_key"] for r in keys.collect()] == ["INV-7"]
    by_key = keys._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in by_key and "SortAggregate" not in by_key and "rating" not in by_key
    plan = p.clean_dedup._jdf.queryExecution().executedPlan().toString()
    once, tied = plan.split("Union", 1)[1].split("SortAggregate", 1)
    assert "LeftAnti" in once and "Exchange hashpartitioning" not in once
    assert "LeftSemi" in tied
    assert {r["rating"] for r in p.clean_dedup.where("invoice_id = 'INV-7'").collect()} == {3.0}
