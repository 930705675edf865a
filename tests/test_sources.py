"""All-string CSV source: markers, headers, multiple files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.plans.pipeline import prepare
from ledgerline.rules import RETAIL_REQUIRED_COLUMNS, RETAIL_RULES
from ledgerline.session import cut_table
from ledgerline.sources.csv import file_layouts, read_csv_strings, write_csv
from ledgerline.sources.tables import code_lines, sales_view
from ledgerline.streaming.incremental import file_stream

HEADER = ",".join(RETAIL_REQUIRED_COLUMNS)
ROW = "INV-001,A,Yangon,Member,Female,Food and beverages,10,2,1.0,21,1/5/2019,9:05,Cash,20,4.76,1.0,7"


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_reads_all_csv_files_as_strings(spark, tmp_path):
    _write(tmp_path / "a" / "one.csv", HEADER + "\n" + ROW + "\n")
    _write(tmp_path / "b" / "two.CSV", HEADER + "\n" + ROW.replace("INV-001", "INV-002") + "\n")
    _write(tmp_path / "notes.txt", "ignore me")
    df = read_csv_strings(spark, str(tmp_path))
    assert dict(df.dtypes)["Quantity"] == "string"
    assert sorted(r["Invoice ID"] for r in df.collect()) == ["INV-001", "INV-002"]


def test_null_markers(spark, tmp_path):
    rows = [ROW.replace(",Female,", ",NA,"), ROW.replace(",Cash,", ",null,"), ROW.replace(",7", ",")]
    _write(tmp_path / "m.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    got = read_csv_strings(spark, str(tmp_path)).collect()
    assert got[0]["Gender"] is None and got[1]["Payment"] is None and got[2]["Rating"] is None


def test_different_headers_are_unioned_by_name(spark, tmp_path):
    cols = RETAIL_REQUIRED_COLUMNS
    swapped = [cols[1], cols[0]] + cols[2:]
    vals = ROW.split(",")
    _write(tmp_path / "x.csv", HEADER + "\n" + ROW + "\n")
    _write(tmp_path / "y.csv", ",".join(swapped) + "\n" + ",".join([vals[1], "INV-009"] + vals[2:]) + "\n")
    df = read_csv_strings(spark, str(tmp_path))
    assert sorted((r["Invoice ID"], r["Branch"]) for r in df.collect()) == [("INV-001", "A"), ("INV-009", "A")]


def test_header_with_spaces_and_extra_column(spark, tmp_path):
    header = HEADER.replace("Total", " Total ") + ",Note"
    _write(tmp_path / "s.csv", header + "\n" + ROW + ",hello\n")
    p = prepare(read_csv_strings(spark, str(tmp_path)), RETAIL_RULES)
    assert "total_amount" in p.std.columns
    assert p.extra_columns == ["Note"]
    assert p.clean_dedup.count() == 1


def test_quoted_fields(spark, tmp_path):
    """Doubled quotes, commas and line breaks, in a file beside a plain one."""
    _write(tmp_path / "q.csv", HEADER + "\n" + ROW.replace("Food and beverages", '"Foo ""x"", y"') + "\n"
           + ROW.replace("INV-001", "INV-002").replace("Food and beverages", '"Foo\nbar, ""z"""') + "\n")
    _write(tmp_path / "r.csv", "\n" + HEADER + "\n\n" + ROW.replace("INV-001", "INV-003") + "\n")
    got = {r["Invoice ID"]: (r["Product line"], r["Rating"]) for r in read_csv_strings(spark, str(tmp_path)).collect()}
    assert got == {"INV-001": ('Foo "x", y', "7"), "INV-002": ('Foo\nbar, "z"', "7"), "INV-003": ("Food and beverages", "7")}
    flags = {r["path"].rsplit("/", 1)[1]: r["multi_line"] for r in file_layouts(spark, [str(tmp_path)]).collect()}
    assert flags == {"q.csv": True, "r.csv": False}


def test_written_csv_reads_back_the_same(spark, tmp_path):
    rows = [('a "b"', " x ", "1"), ("c,d", "e\nf", None), ("\\", "g\r\nh", "2")]
    write_csv(spark.createDataFrame(rows, "a string, b string, c string"), str(tmp_path / "w"))
    assert sorted(tuple(r) for r in read_csv_strings(spark, str(tmp_path / "w"), markers=[""]).collect()) == sorted(rows)


def test_csv_is_written_gzipped_and_read_by_files_and_stream(spark, tmp_path):
    rows = [(f"INV-{i}", "Mandalay", None) for i in range(500)]
    df = spark.createDataFrame(rows, "id string, city string, rating string").repartition(2)
    write_csv(df, str(tmp_path / "w" / "gz"))
    files = [f for f in os.listdir(tmp_path / "w" / "gz") if f.startswith("part-")]
    assert len(files) == 2 and all(f.endswith(".csv.gz") for f in files)
    assert 3 * sum(os.path.getsize(tmp_path / "w" / "gz" / f) for f in files) < sum(len(",".join(map(str, r))) for r in rows)
    _write(tmp_path / "w" / "plain.csv", "id,city,rating\nINV-500,Mandalay,\n")
    _write(tmp_path / "w" / "notes.gz", "id,city,rating\nINV-501,Mandalay,\n")
    want = sorted(rows + [("INV-500", "Mandalay", None)])
    assert sorted(tuple(r) for r in read_csv_strings(spark, str(tmp_path / "w")).collect()) == want
    one = str(tmp_path / "w" / "gz" / files[0])
    assert read_csv_strings(spark, one).count() == read_csv_strings(spark, [one, str(tmp_path / "w" / "plain.csv")]).count() - 1
    query = file_stream(spark, str(tmp_path / "w")).writeStream.format("memory").queryName("found").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(r["path"].rsplit("/", 1)[1] for r in spark.table("found").collect()) == sorted([*files, "plain.csv"])
    write_csv(df, str(tmp_path / "one"), single_file=True)
    assert [f for f in os.listdir(tmp_path / "one") if f.startswith("part-")][0].endswith(".csv")


def test_missing_column_and_empty_file(spark, tmp_path):
    _write(tmp_path / "m" / "h.csv", ",".join(RETAIL_REQUIRED_COLUMNS[:-1]) + "\n")
    with pytest.raises(ValueError, match="Rating"):
        prepare(read_csv_strings(spark, str(tmp_path / "m")), RETAIL_RULES)
    _write(tmp_path / "e" / "h.csv", HEADER + "\n")
    p = prepare(read_csv_strings(spark, str(tmp_path / "e")), RETAIL_RULES)
    assert p.metrics.first()["raw_row_count"] == 0


def test_no_csv_raises(spark, tmp_path):
    _write(tmp_path / "x.txt", "x")
    with pytest.raises(FileNotFoundError):
        read_csv_strings(spark, str(tmp_path))


def test_no_shuffle_of_the_raw_view_carries_names_of_nations(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sales_view(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [line for line in plan.splitlines() if "Join" in line]
    # The first join of the plan is the last one made.
    assert "BroadcastHashJoin" in joins[0] and "n_nationkey" in joins[0]


def test_rows_of_the_raw_view_lie_by_order(spark):
    """Part is joined before orders, so the lines of an order are neighbours."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sales_view(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "l_orderkey" in joins[0] and "l_partkey" in joins[1]


def odd_lines():
    """Lines of which each but the first has a value that the code does not hold, or a NULL."""
    day = dt.datetime(1998, 3, 4)
    good = [1, 1, 1, 3, 17.0, 1234.56, 0.05, 0.08, "N", "O", day]
    odd = {3: [None, 70, -1], 4: [None, 5000.0, 2.7, -3.0], 5: [None, 0.005, 1e12], 6: [None, 1.5, -0.01], 7: [None, 2.0, 0.075],
           8: [None, "", "RR", "\u00e9", " "], 9: [None, "FF"], 10: [None, dt.datetime(1960, 1, 1), dt.datetime(2300, 1, 1, 5)],
           1: [None, 2], 2: [None, 47]}
    rows = [good, [4, 1, 1, 63, 4095.0, 99999.99, 1.27, 0.0, "A", "F", dt.datetime(1970, 1, 1)]]
    rows += [[*good[:i], v, *good[i + 1:]] for i, vs in odd.items() for v in vs]
    return [[i % 5 + 1 if n else None, *r[1:]] for i, r in enumerate(rows) for n in (1, 0) if n or i == 2]


def test_lines_coded_for_the_shuffles_come_back_the_same(spark, tmp_path):
    tables = {
        "lineitem": (odd_lines(), "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(k, k) for k in range(1, 6)], "o_orderkey long, o_custkey long"),
        "customer": ([(k, k % 2, "AUTO") for k in range(1, 6)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": ([(0, "X", 0), (1, "Y", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "part": ([(1, "TIN"), (2, "BRASS")], "p_partkey long, p_type string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for batch in ({}, {"ship_from": "1998-01-01"}, {"ship_before": "1999-01-01"}):
        plain, coded = (sales_view(spark, str(tmp_path), coded=c, **batch) for c in (False, True))
        assert plain.dtypes == coded.dtypes and plain.count() > 3
        assert sorted(map(str, plain.collect())) == sorted(map(str, coded.collect()))
    li = spark.createDataFrame(*tables["lineitem"]).selectExpr("*", "l_suppkey % 47 = 0 as unrated").withColumn("l_shipdate", F.to_date("l_shipdate"))
    coded = code_lines(li)
    assert coded.columns == ["l_orderkey", "l_partkey", "unrated", "ext", "_line", "_rest"]
    held = coded.where("_line is not null").count()
    assert 3 < held < li.count() and coded.where("(_line is null) = (_rest is null)").count() == 0


def test_files_read_back_smaller_than_the_default_codec(spark):
    rows = spark.range(20000).selectExpr("concat('INV-', cast(id as string), '-1') as invoice_id")
    assert cut_table(rows).bytes < cut_table(rows, codec="snappy").bytes
    assert cut_table(rows).table.distinct().count() == 20000


def test_quotes_are_counted_by_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n"a ""b""",1\n')
    (tmp_path / "b.csv").write_text('x,y\n"a\nb",1\n')
    found = {r["path"][-5:]: (r["header"], r["multi_line"]) for r in file_layouts(spark, [str(tmp_path)]).collect()}
    assert found == {"a.csv": ("x,y", False), "b.csv": ("x,y", True)}


def test_the_view_shuffles_no_supplier_and_no_ship_time(spark):
    from conftest import SF_SMALL
    from ledgerline.sources.tables import sales_view
    plan = sales_view(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Join", 1)[1]
    assert "AS unrated" in below and "cast(l_shipdate" in below and "l_suppkey" not in plan.split("Join", 1)[0]
