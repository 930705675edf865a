"""Warehouse constraints as queries: keys, uniqueness, foreign keys, counts.

A fact that is laid out in key order (as the key assignment leaves it) is
proved unique without moving its keys.  A row's surrogate key minus its place
in its task is the same for all rows of an unbroken run of keys, so one
aggregate reduces every task to a few runs (first key, last key, rows), split
by the foreign keys, which the same pass checks.  Keys inside a run differ by
construction; runs are intervals, and the rows beyond their union are the
repeats.  Where that does not hold - keys out of order, holes, more runs than
``MAX_RUNS`` - the keys are counted by value, exactly as for any other table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.parse import ident, text
from ledgerline.operators.profile import union_all
from ledgerline.session import cut_lineage

# Runs that one window puts in order.
MAX_RUNS = 1_000_000


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row (partial aggregation first)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def _key_pairs(fact: DataFrame) -> DataFrame:
    """Distinct foreign key pairs of the fact with their rows."""
    return fact.groupBy("branch_key", "product_key").agg(F.count(F.lit(1)).alias("_n"))


def _pair_orphans(pairs: DataFrame, dim_branch: DataFrame, dim_product: DataFrame) -> DataFrame:
    """(foreign_key, orphan_rows) from key pairs with row counts ``_n``."""
    b = dim_branch.select("branch_key", F.lit(True).alias("_b")).distinct()
    p = dim_product.select("product_key", F.lit(True).alias("_p")).distinct()
    counts = pairs.join(b, "branch_key", "left").join(p, "product_key", "left").agg(
        F.coalesce(F.sum(F.when(F.col("_b").isNull(), F.col("_n"))), F.lit(0)).alias("branch_key"),
        F.coalesce(F.sum(F.when(F.col("_p").isNull(), F.col("_n"))), F.lit(0)).alias("product_key"))
    return counts.select(F.inline(F.array(
        F.struct(F.lit("branch_key").alias("foreign_key"), F.col("branch_key").cast("long").alias("orphan_rows")),
        F.struct(F.lit("product_key").alias("foreign_key"), F.col("product_key").cast("long").alias("orphan_rows")),
    )))


def orphan_counts(fact: DataFrame, dim_branch: DataFrame, dim_product: DataFrame) -> DataFrame:
    """(foreign_key, orphan_rows) for both foreign keys of the fact: one pass
    over the fact, reduced to its distinct key pairs before both dimensions
    are joined."""
    return _pair_orphans(_key_pairs(fact), dim_branch, dim_product)


def key_runs(fact: DataFrame, key: str, by: list[str]) -> DataFrame:
    """(task, run, by..., rows, keyed, first, last): the unbroken runs of a
    whole-number key in each task, split by ``by``; one pass, and only these
    rows are shuffled."""
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    rows = fact.select(F.spark_partition_id().alias("task"), (F.col(key) - place).alias("run"), *by, F.col(key).alias("_k"))
    return rows.groupBy("task", "run", *by).agg(
        F.count(F.lit(1)).alias("rows"), F.count("_k").alias("keyed"), F.min("_k").alias("first"), F.max("_k").alias("last"))


def repeats_of_runs(cells: DataFrame) -> int | None:
    """Rows beyond the first of every key, from written :func:`key_runs`; None
    if the runs are no proof (too many, or one with a hole)."""
    runs = cells.where("run IS NOT NULL").groupBy("task", "run").agg(
        F.sum("keyed").alias("keyed"), F.min("first").alias("first"), F.max("last").alias("last"))
    sound = runs.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("keyed") != F.col("last") - F.col("first") + 1).alias("broken")).first()
    if sound["n"] > MAX_RUNS or sound["broken"]:
        return None
    # At most MAX_RUNS rows of three numbers.
    order = Window.orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest(F.coalesce(reached, F.col("first") - 1), F.col("first") - 1))
    return runs.select("keyed", fresh.alias("fresh")).agg(
        F.coalesce(F.sum("keyed") - F.sum("fresh"), F.lit(0)).cast("long").alias("n")).first()["n"]


def _surplus(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows beyond the first of every key (a NULL first key column
    is left to the not-null check; a NULL in a later one is a value).

    A grouped count on the key itself: on the bucketed fact it needs no
    shuffle for the bucket key, and partial counts everywhere else.
    """
    return duplicate_keys(df.filter(F.col(keys[0]).isNotNull()), keys).agg(
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("long").alias("violations"))


def _named(found: dict[str, DataFrame], table: str) -> DataFrame:
    return union_all([v.select(F.lit(table).alias("table_name"), F.lit(c).alias("check_name"), "violations")
                      for c, v in found.items()])


def _nulls(df: DataFrame, pk: str) -> DataFrame:
    return df.agg(F.count_if(F.col(pk).isNull()).cast("long").alias("violations"))


def _table_checks(df: DataFrame, table: str, pk: str, natural: list[str]) -> DataFrame:
    """Primary-key not-null and unique, natural-key unique, each its own aggregate."""
    return _named({"pk_not_null": _nulls(df, pk), "pk_unique": _surplus(df, [pk]), "natural_key_unique": _surplus(df, natural)}, table)


def constraint_report(dim_branch: DataFrame, dim_product: DataFrame, fact: DataFrame, in_key_order: bool = False) -> DataFrame:
    """(table_name, check_name, violations): primary keys, unique keys and
    foreign keys of the three warehouse tables; 0 everywhere when valid.

    One pass over the fact finds its foreign key pairs and NULL keys and, with
    ``in_key_order`` (rows laid out by surrogate key, as a full load builds
    them), the runs of its primary key; see the module note.  The natural key
    is counted by value, which needs no exchange on the bucketed fact.
    """
    pk_unique = None
    if in_key_order:
        cells = cut_lineage(key_runs(fact, "sales_key", ["branch_key", "product_key"]))
        repeats = repeats_of_runs(cells)
        if repeats is not None:
            pk_unique = cells.sparkSession.range(1).select(F.lit(repeats).cast("long").alias("violations"))
    else:
        cells = fact.groupBy("branch_key", "product_key").agg(F.count(F.lit(1)).alias("rows"), F.count("sales_key").alias("keyed"))
    pairs = cells.groupBy("branch_key", "product_key").agg(F.sum("rows").alias("_n"), F.sum("keyed").alias("_keyed"))
    facts = {
        "pk_not_null": pairs.agg(F.coalesce(F.sum(F.col("_n") - F.col("_keyed")), F.lit(0)).cast("long").alias("violations")),
        "pk_unique": _surplus(fact, ["sales_key"]) if pk_unique is None else pk_unique,
        "natural_key_unique": _surplus(fact, ["invoice_id"]),
    }
    fk = _pair_orphans(pairs, dim_branch, dim_product).select(
        F.lit("fact_sales").alias("table_name"), F.concat(F.lit("fk_"), F.col("foreign_key")).alias("check_name"),
        F.col("orphan_rows").alias("violations"))
    return union_all([
        _table_checks(dim_branch, "dim_branch", "branch_key", ["branch_code", "city"]),
        _table_checks(dim_product, "dim_product", "product_key", ["product_line"]),
        _named(facts, "fact_sales"),
        fk,
    ])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named table."""
    return union_all([df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
                      .select(F.lit(name).alias("table_name"), "row_count")
                      for name, df in tables.items()])


def assert_counts(counts: DataFrame, expected: dict[str, tuple[int | None, int | None]]) -> list[str]:
    """Compare counts with (min, max) expectations; returns failure messages."""
    got = {r["table_name"]: r["row_count"] for r in counts.collect()}
    failures = []
    for table, (lo, hi) in expected.items():
        n = got.get(table)
        if n is None or (lo is not None and n < lo) or (hi is not None and n > hi):
            failures.append(f"{table}: {n} rows, expected [{lo}, {hi}]")
    return failures


def expected_counts(counts: DataFrame, expected: dict[str, tuple[int | None, int | None]]) -> DataFrame:
    """(table_name, row_count, least, most, as_expected) for every expected
    table; a table without a count has a NULL one and is not as expected."""
    rows = [(table, lo, hi) for table, (lo, hi) in expected.items()]
    wanted = counts.sparkSession.createDataFrame(rows, "table_name string, least bigint, most bigint")
    n = F.col("row_count")
    met = n.isNotNull() & F.coalesce(n >= F.col("least"), F.lit(True)) & F.coalesce(n <= F.col("most"), F.lit(True))
    return wanted.join(counts, "table_name", "left").select("table_name", "row_count", "least", "most", met.alias("as_expected"))


def required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """(column_name, present, non_null) for every required raw column, found by
    its trimmed name; a missing one has no count.  One aggregate over the rows."""
    found = {c.strip(): c for c in df.columns}
    held = {r: found[r.strip()] for r in required if r.strip() in found}
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(ident(c))).alias(f"_{i}") for i, c in enumerate(held.values())])
    place = {r: i for i, r in enumerate(held)}
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(r).alias("column_name"), F.lit(r in held).alias("present"),
                 (F.col(f"_{place[r]}") if r in held else F.lit(None)).cast("long").alias("non_null")) for r in required])))


def fact_assertions(fact: DataFrame, dim_branch: DataFrame, dim_product: DataFrame, rules) -> DataFrame:
    """(assertion, violations): value rules that every published fact row keeps.

    Positive totals, quantities and prices, ratings inside the limits,
    non-NULL ids and keys, and categories from the allowed lists: one
    aggregate over the fact and one per dimension.
    """
    broken = {
        "total_positive": "coalesce(total_amount <= 0, true)",
        "quantity_positive": "coalesce(quantity <= 0, true)",
        "unit_price_positive": "coalesce(unit_price <= 0, true)",
        "rating_in_range": f"coalesce(rating < {rules.rating_min!r} OR rating > {rules.rating_max!r}, true)",
        "invoice_id_present": "invoice_id IS NULL",
        "sale_date_present": "sale_date IS NULL",
        "branch_key_present": "branch_key IS NULL",
        "product_key_present": "product_key IS NULL",
        "customer_type_known": _outside("customer_type", rules.customer_types),
        "gender_known": _outside("gender", rules.genders),
        "payment_known": _outside("payment_method", rules.payments),
    }
    dims = [_count_rows(dim_branch, {"branch_known": _outside("branch_code", rules.branches),
                                     "city_known": _outside("city", rules.cities)}),
            _count_rows(dim_product, {"product_line_present": "product_line IS NULL"})]
    return union_all([_count_rows(fact, broken), *dims])


def _outside(column: str, allowed: list[str]) -> str:
    return f"NOT coalesce({ident(column)} IN ({', '.join(text(v) for v in allowed)}), false)"


def _count_rows(df: DataFrame, conditions: dict[str, str]) -> DataFrame:
    counts = df.agg(*[F.expr(f"count_if({c})").alias(name) for name, c in conditions.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("assertion"), F.col(name).cast("long").alias("violations")) for name in conditions])))
