"""Keyed upserts, staged publish and load summaries."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_ROWS, good_row, raw_frame
from ledgerline.operators.upsert import upsert
from ledgerline.plans.pipeline import prepare, transform
from ledgerline.plans.publish import Warehouse, bucket_count, merge_into
from ledgerline.rules import RETAIL_RULES
from ledgerline.session import cut_scope


def _dim(spark, rows):
    return spark.createDataFrame(rows, "k long, code string, city string")


def test_upsert_cases(spark):
    target = _dim(spark, [(1, "A", "Yangon"), (2, "B", "Mandalay"), (3, "T", "Only")])
    source = spark.createDataFrame([("A", "Yangon"), ("B", None), ("0", "New"), (None, "NullKey")],
                                   "code string, city string")
    out = {(r["code"], r["city"]): r["k"] for r in upsert(target, source, ["code"], "k").collect()}
    assert out[("A", "Yangon")] == 1            # unchanged, key kept
    assert out[("B", None)] == 2                # changed: NULL overwrites, key kept
    assert out[("T", "Only")] == 3              # target-only kept
    # new members sort before existing ones but get keys after the max
    assert out[(None, "NullKey")] == 4 and out[("0", "New")] == 5
    assert len(out) == 5


def test_upsert_is_idempotent(spark):
    target = _dim(spark, [(1, "A", "Yangon")])
    source = spark.createDataFrame([("A", "Mandalay"), ("C", "Naypyitaw")], "code string, city string")
    once = upsert(target, source, ["code"], "k")
    twice = upsert(once, source, ["code"], "k")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_upsert_repeated_source_key_raises(spark):
    target = _dim(spark, [(1, "A", "Yangon")])
    source = spark.createDataFrame([("A", "x"), ("A", "y")], "code string, city string")
    with pytest.raises(ValueError, match="repeats"):
        upsert(target, source, ["code"], "k")


def test_merge_into_keeps_keys_and_inserts(spark):
    first, _ = transform(raw_frame(spark, SAMPLE_ROWS[:2]), RETAIL_RULES)
    changed = list(SAMPLE_ROWS[1])
    changed[16] = "9.5"                                   # rating of INV-002 changes
    new_row = good_row(**{"Invoice ID": "INV-000", "Branch": "C", "City": "Naypyitaw",
                          "Product line": "Electronic accessories"})
    second = prepare(raw_frame(spark, [changed, new_row]), RETAIL_RULES).clean_dedup
    merged = merge_into(first, second)
    fact = {r["invoice_id"]: r for r in merged.fact_sales.collect()}
    assert fact["INV-001"]["sales_key"] == 1 and fact["INV-002"]["sales_key"] == 2
    assert fact["INV-002"]["rating"] == 9.5
    assert fact["INV-000"]["sales_key"] == 3             # sorts first, numbered after the max
    products = {r["product_line"]: r["product_key"] for r in merged.dim_product.collect()}
    assert products["Electronic accessories"] == 3 and products["Food and beverages"] == 1
    branches = {r["branch_code"]: r["branch_key"] for r in merged.dim_branch.collect()}
    assert branches == {"A": 1, "C": 2}
    assert fact["INV-000"]["branch_key"] == 2 and fact["INV-000"]["product_key"] == 3


def test_staged_publish_and_failure_keeps_published_version(spark, tmp_path):
    root = str(tmp_path / "wh")
    wh = Warehouse(spark, root)
    star, _ = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    summary = wh.load(star, run_id="v1", export_dir=str(tmp_path / "csv"))
    assert summary.failed == [] and "publish" in summary.succeeded
    v1 = wh.current()
    assert v1.startswith("v1-")
    assert wh.read("fact_sales").count() == 4
    assert os.path.isdir(tmp_path / "csv" / "fact_sales")
    with open(tmp_path / "wh" / "load_summary" / "v1.json") as fh:
        assert json.load(fh)["failed"] == []

    # A fact that violates its key constraints must not be published.
    bad = star.fact_sales.withColumn("sales_key", F.lit(1).cast("long"))
    broken = type(star)(star.dim_branch, star.dim_product, bad)
    with pytest.raises(RuntimeError, match="published version unchanged"):
        wh.load(broken, run_id="v2")
    assert wh.current() == v1
    with open(tmp_path / "wh" / "load_summary" / "v2.json") as fh:
        assert json.load(fh)["failed"] == ["constraint_checks"]

    # A staging write that fails is recorded and blocks the publish too.
    failing = type(star)(star.dim_branch, star.dim_product,
                         star.fact_sales.withColumn("sales_key", F.raise_error(F.lit("disk full"))))
    with pytest.raises(RuntimeError):
        wh.load(failing, run_id="v3")
    assert wh.current() == v1
    with open(tmp_path / "wh" / "load_summary" / "v3.json") as fh:
        assert json.load(fh)["failed"] == ["fact_sales_staging"]


def test_published_fact_is_bucketed_so_merges_shuffle_only_new_rows(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), fact_buckets=4)
    star, _ = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    wh.load(star, run_id="b1")
    fact = Warehouse(spark, str(tmp_path / "wh")).read("fact_sales")     # a new reader: manifest only
    new = spark.createDataFrame([("INV-001",), ("INV-777",)], "invoice_id string")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = fact.join(new, "invoice_id", "full_outer")
        assert joined.count() == 5
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1            # the new rows only


def test_composite_null_keys_never_match(spark):
    target = spark.createDataFrame([(1, "Z", None, 1)], "k long, code string, city string, v int")
    source = spark.createDataFrame([("Z", None, 2), ("Z", None, 3)], "code string, city string, v int")
    out = upsert(target, source, ["code", "city"], "k").collect()
    assert sorted((r["k"], r["v"]) for r in out) in ([(1, 1), (2, 2), (3, 3)], [(1, 1), (2, 3), (3, 2)])


def _summary(root, run_id):
    with open(os.path.join(root, "load_summary", f"{run_id}.json")) as fh:
        return json.load(fh)


def test_failed_load_under_a_published_run_id_leaves_it_intact(spark, tmp_path):
    root = str(tmp_path / "wh")
    wh = Warehouse(spark, root)
    star, _ = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    wh.load(star, run_id="same")
    failing = type(star)(star.dim_branch, star.dim_product,
                         star.fact_sales.withColumn("rating", F.raise_error(F.lit("broken")).cast("double")))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="published version unchanged"):
            wh.load(failing, run_id="same")
    assert Warehouse(spark, root).read("fact_sales").count() == 4
    assert Warehouse(spark, root).read("dim_branch").count() == 3
    assert len(os.listdir(os.path.join(root, "versions"))) == 1       # failed attempts leave nothing behind
    wh.load(star, run_id="same")                                      # a repeated id gets a folder of its own
    assert len(wh.manifests()) == 2


def test_failed_merge_is_in_the_summary(spark, tmp_path):
    root = str(tmp_path / "wh")

    def broken():
        raise ValueError("no such batch")

    with pytest.raises(RuntimeError, match="no such batch"):
        Warehouse(spark, root).load(broken, run_id="m")
    assert _summary(root, "m") == {"succeeded": [], "failed": ["merge"], "total": 6}


def test_torn_or_lost_manifest_falls_back_to_the_last_complete_one(spark, tmp_path):
    root = str(tmp_path / "wh")
    wh = Warehouse(spark, root, keep_versions=3)
    star, _ = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    wh.load(star, run_id="a")
    first = wh.current()
    (tmp_path / "wh" / "manifests" / "000000000002.json").write_text('{"version": "b')
    assert Warehouse(spark, root).current() == first
    assert Warehouse(spark, root).read("fact_sales").count() == 4
    wh.load(star, run_id="c")                                         # the torn number is never reused
    assert wh.manifest()["number"] == 3 and wh.current().startswith("c-")


def test_two_loads_on_one_version_publish_once(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    star, _ = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    wh.load(star, run_id="a")
    base = wh.manifest()
    wh.load(star, run_id="b")
    with pytest.raises(RuntimeError, match="another load"):
        wh.publish("c", base)


def test_old_versions_are_removed(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), keep_versions=2)
    star, _ = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    for name in "abc":
        wh.load(star, run_id=name)
    assert sorted(v[0] for v in os.listdir(tmp_path / "wh" / "versions")) == ["b", "c"]


def test_bucketed_write_has_at_most_one_file_per_bucket(spark, tmp_path):
    rows = [good_row(**{"Invoice ID": f"INV-{i:04d}"}) for i in range(400)]
    star = prepare(raw_frame(spark, rows).repartition(8), RETAIL_RULES).star(partitions=12)
    wh = Warehouse(spark, str(tmp_path / "wh"), fact_buckets=4)
    wh.load(star, run_id="f")
    files = [f for f in os.listdir(wh.version_path(wh.current(), "fact_sales")) if f.endswith(".parquet")]
    assert 0 < len(files) <= 4
    assert wh.read("fact_sales").count() == 400


def test_bucket_count_follows_the_size():
    assert [bucket_count(n << 20) for n in (0, 1, 128, 129, 300, 1 << 20)] == [1, 1, 1, 2, 4, 8192]


def test_merge_reads_the_published_fact_in_its_buckets(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), fact_buckets=4)
    star, _ = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)
    wh.load(star, run_id="a")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        second = prepare(raw_frame(spark, [good_row()]), RETAIL_RULES).clean_dedup
        plan = merge_into(wh.tables(), second).fact_sales._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert "Bucketed: true" in plan
    fact_side = plan.split("Bucketed: true")[0].rsplit("SortMergeJoin", 1)[-1]
    assert "Exchange" not in fact_side


def test_dimensions_do_not_build_the_fact(spark):
    star = prepare(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES).star()
    with cut_scope(spark) as made:
        assert star.dim_branch.count() == 3
        assert len(made) == 2                                         # the members and the branches
        assert star.fact_sales.count() == 4


def test_report_view_follows_the_published_version(spark, tmp_path):
    from ledgerline.operators.report import sales_report

    def shown(wh):
        t = wh.tables()
        want = sorted(map(tuple, sales_report(t.fact_sales, t.dim_branch, t.dim_product).collect()))
        got = spark.sql("SELECT * FROM vw_report_test")
        assert got.dtypes == sales_report(t.fact_sales, t.dim_branch, t.dim_product).dtypes
        assert sorted(map(tuple, got.collect())) == want
        return want

    root = str(tmp_path / "wh")
    wh = Warehouse(spark, root, keep_versions=1, view="vw_report_test")
    with pytest.raises(FileNotFoundError):
        wh.point_view()
    wh.load(transform(raw_frame(spark, SAMPLE_ROWS[:2]), RETAIL_RULES)[0])
    first = shown(wh)
    star = transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)[0]
    broken = type(star)(star.dim_branch, star.dim_product, star.fact_sales.withColumn(
        "rating", F.raise_error(F.lit("broken source")).cast("double")))
    with pytest.raises(RuntimeError):
        wh.load(broken)
    assert shown(wh) == first                        # a failed load leaves the view
    huge = good_row(**{"Invoice ID": "INV-900", "Total": "1e30", "gross income": "1e28", "cogs": "0", "Tax 5%": "0"})
    second = prepare(raw_frame(spark, [*SAMPLE_ROWS, huge]), RETAIL_RULES).clean_dedup
    wh.load(lambda: merge_into(wh.tables(), second))
    assert shown(wh) != first                        # the first version is gone, the view shows the second
    spark.sql("DROP VIEW vw_report_test")
    Warehouse(spark, root, view="vw_report_test").point_view()
    shown(wh)
    spark.sql("DROP VIEW vw_report_test")


def _files_per_bucket(path):
    """Files of each bucket, by the bucket number in their names."""
    buckets = {}
    for f in os.listdir(path):
        if f.endswith(".parquet"):
            buckets.setdefault(f.rsplit("_", 1)[1][:5], []).append(f)
    return buckets


def test_merge_streams_the_fact_past_the_new_rows_and_writes_it_in_place(spark, tmp_path):
    """The join of a merge neither shuffles nor sorts the old fact,
    and the number of files stays bounded over many merges."""
    wh = Warehouse(spark, str(tmp_path / "wh"), fact_buckets=4)
    rows = {f"INV-{i:05d}": good_row(**{"Invoice ID": f"INV-{i:05d}", "Unit price": str(1 + i % 97), "cogs": str(i)})
            for i in range(4000)}
    wh.load(prepare(raw_frame(spark, list(rows.values())), RETAIL_RULES).star())
    keys = {r.invoice_id: r.sales_key for r in wh.read("fact_sales").collect()}
    for batch in range(3):
        changed = {i: good_row(**{"Invoice ID": i, "Rating": "9"}) for i in (f"INV-{batch:05d}", f"INV-{3000 + batch:05d}")}
        added = {f"NEW-{batch}-{n}": good_row(**{"Invoice ID": f"NEW-{batch}-{n}", "Rating": "5"}) for n in range(3)}
        second = prepare(raw_frame(spark, [*changed.values(), *added.values()]), RETAIL_RULES).clean_dedup
        merged = merge_into(wh.tables(), second.coalesce(1))    # one small file: less than a quarter of the fact
        kept, new = merged.fact_parts()
        assert new.count() == 3
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Bucketed: true" in plan
        fact_side = plan.split("Bucketed: true")[0].rsplit("ShuffledHashJoin", 1)[-1]
        assert "Exchange" not in fact_side and "Sort" not in fact_side
        wh.load(merged)
        found = _files_per_bucket(wh.version_path(wh.current(), "fact_sales"))
        assert len(found) <= 4 and all(len(files) <= 2 for files in found.values())
        fact = {r.invoice_id: r for r in wh.read("fact_sales").collect()}
        assert len(fact) == 4000 + 3 * (batch + 1) == wh.read("fact_sales").count()
        assert all(fact[i].sales_key == k for i, k in keys.items())
        assert all(float(fact[i].rating) == 9.0 for i in changed)
        assert sorted(fact[i].sales_key for i in added) == [4001 + 3 * batch + n for n in range(3)]


def test_a_large_batch_merges_by_sorting_and_a_new_bucket_count_shuffles(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), fact_buckets=4)
    wh.load(transform(raw_frame(spark, SAMPLE_ROWS), RETAIL_RULES)[0])
    rows = [good_row(**{"Invoice ID": f"INV-{i:05d}"}) for i in range(300)]
    merged = merge_into(wh.tables(), prepare(raw_frame(spark, rows), RETAIL_RULES).clean_dedup)
    assert "SortMergeJoin" in merged.fact_parts()[0]._jdf.queryExecution().executedPlan().toString()
    wider = Warehouse(spark, str(tmp_path / "wh"), fact_buckets=8)
    wider.load(merged)
    assert wider.manifest()["fact_buckets"] == 8
    found = _files_per_bucket(wider.version_path(wider.current(), "fact_sales"))
    assert 4 < len(found) <= 8 and all(len(files) == 1 for files in found.values())
    assert wider.read("fact_sales").count() == 304


@pytest.mark.parametrize("join", [None, "shuffle_hash", "merge"])
def test_upsert_is_the_same_by_every_join(spark, join):
    """NULL keys on both sides, NULL values, keys on one side only, an empty side."""
    target = spark.createDataFrame([(n, f"k{n}" if n % 5 else None, n) for n in range(1, 40)], "key long, id string, v int")
    source = spark.createDataFrame([(f"k{n}", None if n % 7 == 0 else -n) for n in range(30, 60)] + [(None, 1), (None, 2)],
                                   "id string, v int")
    new = {f"k{n}": None if n % 7 == 0 else -n for n in range(30, 60)}
    got = upsert(target, source, ["id"], "key", join=join).collect()
    want = sorted((n, f"k{n}" if n % 5 else None, new.get(f"k{n}" if n % 5 else None, n)) for n in range(1, 40))
    assert sorted((r.key, r.id, r.v) for r in got if r.key < 40) == want
    old = {f"k{n}" for n in range(1, 40) if n % 5}
    assert sorted(((r.id, r.v) for r in got if r.key >= 40), key=str) == sorted(
        [(k, v) for k, v in new.items() if k not in old] + [(None, 1), (None, 2)], key=str)
    assert sorted(r.key for r in got) == list(range(1, len(got) + 1))
    assert upsert(target, source.limit(0), ["id"], "key", join=join).count() == 39
    assert upsert(target.limit(0), source, ["id"], "key", join=join).count() == 32
