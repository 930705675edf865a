"""Data-quality rules: per-row flags, clean/reject split, metrics, warnings.

Every rule is a SQL expression over the standardized raw strings, so
flagging is one projection inside whole-stage codegen.  Flags are never
NULL: a NULL category, date, time or number is invalid (and rejects), a
mismatch that cannot be computed is not a mismatch.  Hence
``raw_row_count = clean_rows + rejected_rows`` always holds.
"""

from __future__ import annotations

from functools import reduce
from math import prod
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import round_sql
from ledgerline.functions.naming import require_columns, standardize
from ledgerline.functions.parse import date_sql, ident, number_sql, text, time_sql
from ledgerline.operators.keys import in_key_order, range_partitions
from ledgerline.rules import CATEGORY_RULES, NUMERIC_COLUMNS, SalesRules
from ledgerline.session import broadcast_if_small, cut_lineage, is_small

REJECT_FLAGS = [
    "critical_null", "invalid_date", "invalid_time", "invalid_branch",
    "invalid_city", "invalid_customer_type", "invalid_gender",
    "invalid_payment", "invalid_numeric",
]
MISMATCH_FLAGS = ["tax_mismatch", "total_mismatch", "cogs_mismatch", "gross_income_mismatch"]
FLAGS = REJECT_FLAGS + MISMATCH_FLAGS + ["rejected"]

# Rows from which on a key is reduced before its rows are brought together.
HOT_ROWS = 10_000

# The warehouse quantity is a 64-bit integer.
QUANTITY_LIMIT = 9.2e18

# Metric name for each flag count, in report order.
FLAG_METRICS = {
    "critical_null": "critical_null_rows",
    "invalid_date": "invalid_dates",
    "invalid_time": "invalid_times",
    "invalid_branch": "invalid_branch_values",
    "invalid_city": "invalid_city_values",
    "invalid_customer_type": "invalid_customer_type_values",
    "invalid_gender": "invalid_gender_values",
    "invalid_payment": "invalid_payment_values",
    "invalid_numeric": "invalid_numeric_rows",
    "tax_mismatch": "tax_mismatch_rows",
    "total_mismatch": "total_mismatch_rows",
    "cogs_mismatch": "cogs_mismatch_rows",
    "gross_income_mismatch": "gross_income_mismatch_rows",
    "rejected": "rejected_rows",
}

METRIC_COLUMNS = [
    "raw_row_count", "raw_duplicate_rows", "duplicate_invoice_ids",
    "invoice_ids_with_duplicates", "critical_null_rows", "invalid_dates",
    "invalid_times", "invalid_branch_values", "invalid_city_values",
    "invalid_customer_type_values", "invalid_gender_values",
    "invalid_payment_values", "invalid_numeric_rows", "tax_mismatch_rows",
    "total_mismatch_rows", "cogs_mismatch_rows", "gross_income_mismatch_rows",
    "rejected_rows", "clean_rows", "clean_rows_after_invoice_dedup",
]

# Warning checks, in report order (after an optional extra_columns entry).
WARNING_CHECKS = [
    ("duplicate_rows", "raw_duplicate_rows"),
    ("duplicate_invoice_ids", "duplicate_invoice_ids"),
    ("tax_mismatch_rows", "tax_mismatch_rows"),
    ("total_mismatch_rows", "total_mismatch_rows"),
    ("cogs_mismatch_rows", "cogs_mismatch_rows"),
    ("gross_income_mismatch_rows", "gross_income_mismatch_rows"),
]


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def standardized(raw: DataFrame, rules: SalesRules) -> tuple[DataFrame, list[str]]:
    """Check the raw header, then rename to canonical names.

    Returns the renamed frame (values still raw strings) and the extra
    columns, which only produce a warning.
    """
    extra = require_columns(raw, rules.required_columns)
    return standardize(raw, rules.aliases), extra


def parsed_sql(rules: SalesRules) -> dict[str, str]:
    """SQL text of the typed value of each parsed canonical column."""
    out = {
        "sale_date": date_sql("sale_date", rules.date_pattern),
        "sale_time": time_sql("sale_time", rules.time_pattern),
    }
    for c in NUMERIC_COLUMNS:
        out[c] = number_sql(c)
    return out


def flag_sql(rules: SalesRules, typed: str = "_p_") -> dict[str, str]:
    """SQL text of every flag.

    Typed values are referenced as ``<typed><column>`` (computed by the
    projection before), raw strings by their own names.
    """
    t = {c: ident(typed + c) for c in parsed_sql(rules)}
    flags = {
        "critical_null": " OR ".join(f"{ident(c)} IS NULL" for c in rules.canonical_critical),
        "invalid_date": f"{t['sale_date']} IS NULL",
        "invalid_time": f"{t['sale_time']} IS NULL",
    }
    for col, rule_field in CATEGORY_RULES:
        values = ", ".join(text(v) for v in rules.allowed(rule_field))
        flags[f"invalid_{'payment' if col == 'payment_method' else col}"] = (
            f"NOT coalesce({ident(col)} IN ({values}), false)")
    price, qty, rating = t["unit_price"], t["quantity"], t["rating"]
    flags["invalid_numeric"] = (
        f"coalesce({price} <= {rules.price_min!r} OR {qty} < {rules.quantity_min!r} OR {qty} >= {QUANTITY_LIMIT!r}D "
        f"OR {rating} < {rules.rating_min!r} OR {rating} > {rules.rating_max!r}, true)")
    tax, total, cogs, income = t["tax_amount"], t["total_amount"], t["cogs"], t["gross_income"]
    tax0 = f"coalesce({tax}, 0.0D)"
    tol = f"{rules.tolerance!r}D"
    flags["tax_mismatch"] = f"coalesce(abs({tax} - {round_sql(f'{cogs} * {rules.tax_rate!r}D')}) > {tol}, false)"
    flags["total_mismatch"] = f"coalesce(abs({total} - {round_sql(f'{cogs} + {tax0}')}) > {tol}, false)"
    flags["cogs_mismatch"] = f"coalesce(abs({cogs} - {round_sql(f'{price} * {qty}')}) > {tol}, false)"
    flags["gross_income_mismatch"] = f"coalesce(abs({income} - {tax0}) > {tol}, false)"
    flags["rejected"] = " OR ".join(f"({flags[f]})" for f in REJECT_FLAGS)
    return flags


def _with_flags(std: DataFrame, rules: SalesRules, keep: list[str]) -> DataFrame:
    """``keep`` columns (typed where parsed), plus every flag.

    Two projections of SQL text: the typed values first, then the flags over
    them, so each parser runs once per row.
    """
    parsed = parsed_sql(rules)
    typed = std.selectExpr("*", *[f"{expr} AS {ident('_p_' + c)}" for c, expr in parsed.items()])
    flags = flag_sql(rules)
    out = [f"{ident('_p_' + c)} AS {ident(c)}" if c in parsed else ident(c) for c in keep]
    return typed.selectExpr(*out, *[f"{flags[f]} AS {f}" for f in FLAGS])


def flag_rows(std: DataFrame, rules: SalesRules) -> DataFrame:
    """All columns parsed to their types, plus one boolean column per flag."""
    return _with_flags(std, rules, std.columns)


RAW = "raw_"


def flag_both(std: DataFrame, rules: SalesRules) -> DataFrame:
    """Raw text columns (prefixed), typed columns and flags: the row set that
    is written once and read by flags, rejects, metrics and dedup."""
    return with_raw(flag_stored(std, rules), std.columns)


def flag_stored(std: DataFrame, rules: SalesRules) -> DataFrame:
    """The part of :func:`flag_both` that is written: a column that is not
    parsed is its own raw text, so only parsed ones are there twice."""
    parsed = parsed_sql(rules)
    typed = std.selectExpr("*", *[f"{ident(c)} AS {ident(RAW + c)}" for c in std.columns if c in parsed])
    return _with_flags(typed, rules, typed.columns)


def flag_text(std: DataFrame, rules: SalesRules) -> DataFrame:
    """Raw text and flags alone: :func:`flag_both` by :func:`parse_text`."""
    parsed = parsed_sql(rules)
    typed = std.selectExpr("*", *[f"{expr} AS {ident('_p_' + c)}" for c, expr in parsed.items()])
    flags = flag_sql(rules)
    return typed.selectExpr(*[ident(c) for c in std.columns], *[f"{flags[f]} AS {f}" for f in FLAGS])


def parse_text(stored: DataFrame, columns: list[str], rules: SalesRules) -> DataFrame:
    """:func:`flag_both` from :func:`flag_text`; ``columns`` are the standardized
    ones.  A reader parses the columns that it asks for."""
    parsed = parsed_sql(rules)
    return stored.selectExpr(*[f"{parsed.get(c, ident(c))} AS {ident(c)}" for c in columns], *FLAGS,
                             *[f"{ident(c)} AS {ident(RAW + c)}" for c in columns])


def with_raw(stored: DataFrame, columns: list[str]) -> DataFrame:
    """:func:`flag_both` from its stored part; ``columns`` are the standardized ones."""
    held = set(stored.columns)
    raw = [F.col(ident(RAW + c if RAW + c in held else c)).alias(RAW + c) for c in columns]
    rest = [F.col(ident(c)) for c in stored.columns if c not in {RAW + c for c in columns}]
    return stored.select(*rest, *raw)


def typed_rows(both: DataFrame) -> DataFrame:
    """The typed columns and flags of :func:`flag_both`."""
    return both.select([c for c in both.columns if not (c.startswith(RAW) and c.removeprefix(RAW) in both.columns)])


def flag_table(flagged: DataFrame) -> DataFrame:
    """The per-row flag table: invoice_id and the 14 flags, every row."""
    return flagged.select("invoice_id", *FLAGS)


def clean_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("rejected")).drop(*FLAGS)


def reject_rows(flagged: DataFrame) -> DataFrame:
    """Rows that are rejected or carry any mismatch warning, with flags."""
    return flagged.filter(_any([F.col(f) for f in ["rejected", *MISMATCH_FLAGS]]))


def _raw_columns(columns: list[str]) -> list[str]:
    """Canonical names of the columns whose raw text a flagged frame carries."""
    return [c.removeprefix(RAW) for c in columns if c.startswith(RAW) and c.removeprefix(RAW) in columns]


def row_counts(columns: list[str], std: list[str] | None = None) -> list[Column]:
    """Aggregates of :func:`flag_both` rows that need no grouping: rows, flags
    and NULLs.  They can be observed while the rows are written; of stored rows
    (:func:`flag_stored`) ``std`` names the standardized columns."""
    raw = [RAW + c for c in _raw_columns(columns)] if std is None else [RAW + c if RAW + c in columns else c for c in std]
    return [
        F.count(F.lit(1)).alias("raw_row_count"),
        *[F.count_if(F.col(f)).alias(FLAG_METRICS[f]) for f in FLAGS],
        F.count_if(~F.col("rejected")).alias("clean_rows"),
        *[F.count_if(F.col(ident(c)).isNull()).alias(f"_null_{i}") for i, c in enumerate(raw)],
    ]


def row_hash(raw: list[str]) -> list[Column]:
    """128 bits of hash of a raw row, as two numbers.  The hash function skips
    NULLs, so which columns are NULL is hashed first."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in raw])
    return [F.xxhash64(F.lit(seed), nulls, *raw).alias(f"_h{seed}") for seed in (1, 2)]


def duplicate_rows(both: DataFrame) -> DataFrame:
    """One row: ``raw_duplicate_rows``, the raw rows beyond the first of every
    set of identical ones.

    Rows are grouped by 64 bits of hash (combined in every task first), never
    by their text.  Only rows whose hash occurs twice are then compared in
    full, so equal hashes of different rows change nothing.  The repeated
    hashes are written, measured and broadcast up to a size, hence rows without
    a double stay where they are.
    """
    raw = [RAW + c for c in _raw_columns(both.columns)]
    hashed = both.select(*raw, row_hash(raw)[0])
    keys = ["_h1"]
    seen_twice = cut_lineage(hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys))
    seen_twice = broadcast_if_small(seen_twice)
    same = hashed.join(seen_twice, keys, "left_semi").groupBy(*raw).agg(F.count(F.lit(1)).alias("_n"))
    return same.agg(F.expr("sum(_n - 1)").alias("raw_duplicate_rows"))


def duplicate_ids(both: DataFrame) -> DataFrame:
    """One row of counts over the invoice ids; only an id, a count and a flag
    per task and id are shuffled."""
    by_id = both.groupBy(RAW + "invoice_id").agg(F.count(F.lit(1)).alias("_rows"), F.expr("max(NOT rejected)").alias("_has_clean"))
    return by_id.agg(*id_counts())


def id_counts() -> list[Column]:
    """The aggregates of :func:`duplicate_ids`."""
    return [
        F.expr("sum(_rows - 1)").alias("duplicate_invoice_ids"),
        F.expr("count_if(_rows > 1)").alias("invoice_ids_with_duplicates"),
        F.expr("count_if(_has_clean)").alias("clean_rows_after_invoice_dedup"),
    ]


def id_groups(both: DataFrame) -> DataFrame:
    """(_key, _first, _n, _rows, _has_clean) of every invoice id: least
    ``SALE_SECOND`` and number of its clean rows, and its rows.  One shuffle of
    the ids for :func:`id_counts` and, where ``_n > 1``, :func:`repeated_keys`."""
    return both.groupBy(F.col(RAW + "invoice_id").alias("_key")).agg(
        F.expr(f"min(CASE WHEN NOT rejected THEN {SALE_SECOND} END)").alias("_first"),
        F.expr("count_if(NOT rejected)").alias("_n"), F.count(F.lit(1)).alias("_rows"),
    ).withColumn("_has_clean", F.col("_n") > 0)


def quality_metrics(both: DataFrame, rules: SalesRules, counts: dict[str, int] | None = None,
                    ids: dict[str, int] | None = None) -> DataFrame:
    """One row of BIGINT metrics plus a ``null_counts`` map.

    ``both`` has the raw text and the flags of every row (:func:`flag_both`);
    it is read up to three times, so it should be a written table.  ``counts``
    are the values of :func:`row_counts` if they were observed while ``both``
    was written; otherwise one aggregate finds them, one row a task.  ``ids``
    are the values of :func:`id_counts`, if known.  The one-row results are
    merged by a union and an aggregate, not a join.
    """
    cols = _raw_columns(both.columns)
    by_row = both.agg(*row_counts(both.columns)) if counts is None else _known(both, counts)
    by_id = duplicate_ids(both) if ids is None else _known(both, ids)
    merged = (by_row.unionByName(duplicate_rows(both), allowMissingColumns=True)
              .unionByName(by_id, allowMissingColumns=True))
    raw_names = _canonical_to_raw(cols, rules)
    keys = ", ".join(text(raw_names[c]) for c in cols)
    nulls = ", ".join(f"CAST(coalesce(max(_null_{i}), 0) AS BIGINT)" for i in range(len(cols)))
    return merged.agg(
        *[F.expr(f"CAST(coalesce(max({m}), 0) AS BIGINT)").alias(m) for m in METRIC_COLUMNS],
        F.expr(f"map_from_arrays(array({keys}), array({nulls}))").alias("null_counts"),
    )


def _known(both: DataFrame, counts: dict[str, int]) -> DataFrame:
    """One row of counts that were observed."""
    return both.sparkSession.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()])


def _canonical_to_raw(cols: list[str], rules: SalesRules) -> dict[str, str]:
    back = {rules.canonical(r): r for r in rules.required_columns}
    return {c: back.get(c, c) for c in cols}


def _warning_array(extra_columns: list[str] | None) -> Column:
    """Warning entries with count > 0, after an optional extra_columns entry."""
    entry = "struct<type:string,count:bigint,columns:array<string>>"
    checks = [
        F.struct(F.lit(name).alias("type"), F.col(metric).alias("count"),
                 F.lit(None).cast("array<string>").alias("columns")).cast(entry)
        for name, metric in WARNING_CHECKS
    ]
    kept = F.filter(F.array(*checks), lambda w: w["count"] > 0)
    if extra_columns:
        head = F.array(F.struct(
            F.lit("extra_columns").alias("type"), F.lit(None).cast("bigint").alias("count"),
            F.array(*[F.lit(c) for c in extra_columns]).alias("columns")).cast(entry))
        kept = F.concat(head, kept)
    return kept


def warnings(metrics: DataFrame, extra_columns: list[str] | None = None) -> DataFrame:
    """One row holding the warnings array."""
    return metrics.select(_warning_array(extra_columns).alias("warnings"))


def warnings_long(metrics: DataFrame, extra_columns: list[str] | None = None) -> DataFrame:
    """(type, count) rows, one per warning."""
    return warnings(metrics, extra_columns).select(F.inline("warnings")).select("type", "count")


def quality_report(metrics: DataFrame, extra_columns: list[str] | None = None) -> DataFrame:
    """The nested one-row report: ``errors``, ``warnings``, ``metrics``."""
    return metrics.select(
        F.array().cast("array<string>").alias("errors"),
        _warning_array(extra_columns).alias("warnings"),
        F.struct(*[F.col(m) for m in METRIC_COLUMNS], F.col("null_counts")).alias("metrics"),
    )


# Sale date and time as one number of seconds, NULLs first as in the sort order.
# The time is the parser's HH:mm:ss.
SALE_SECOND = (
    "coalesce(CAST(unix_date(sale_date) AS BIGINT), -1000000000) * 86401 + coalesce("
    "1 + try_cast(substr(sale_time, 1, 2) AS INT) * 3600 + try_cast(substr(sale_time, 4, 2) AS INT) * 60"
    " + try_cast(substr(sale_time, 7, 2) AS INT), 0)")


def repeated_keys(rows: DataFrame, key: str, instant: str) -> DataFrame:
    """(_key, _first, _n): the keys of two rows or more, their least ``instant`` and their rows.

    The buffer is two longs beside the key, so this is a hash aggregate that
    reduces every task's rows in place; no other column is read or shuffled.
    """
    return (rows.groupBy(F.col(key).alias("_key")).agg(F.expr(f"min({instant})").alias("_first"), F.count(F.lit(1)).alias("_n"))
            .where("_n > 1"))


def _least_rows(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key by ``min(struct(...))``, combined in every task first."""
    rest = [c for c in rows.columns if c != key and c not in order]
    best = "struct(" + ", ".join(ident(c) for c in order + rest) + ")"
    picked = rows.groupBy(key).agg(F.expr(f"min({best})").alias("_best"))
    return picked.selectExpr(*[ident(key) if c == key else f"_best.{ident(c)} AS {ident(c)}" for c in rows.columns])


class Kept(NamedTuple):
    """The rows of :func:`keep_first`, and whether they lie in key order over
    the partitions and inside each."""

    rows: DataFrame
    in_key_order: bool


def dedup_first(rows: DataFrame, key: str = "invoice_id", order: list[str] | None = None,
                instant: str | None = None) -> DataFrame:
    """The rows of :func:`keep_first`."""
    return keep_first(rows, key, order, instant).rows


def keep_first(rows: DataFrame, key: str = "invoice_id", order: list[str] | None = None,
               instant: str | None = None, size: int = 0, keys: DataFrame | None = None) -> Kept:
    """Keep one row per key: the smallest by ``order``, then every other column.
    NULLs sort first in every position; rows of a NULL key are one group.

    ``instant`` is SQL of a long that never falls along ``order`` (it may tie).
    With it, keys of several rows and their least instant are found by a hash
    aggregate over key and instant and written; rows of a key that occurs once
    pass through, and of the others only those at their key's least instant are
    compared in full.  The written keys are measured and broadcast up to
    ``BROADCAST_BYTES``, hence with few repeated keys whole rows are neither
    sorted nor shuffled.  Beyond that size all rows are brought into ranges of
    the key, one shuffle, and compared in full there, so a step that wants them
    in key order needs no second one; ``size`` (bytes of the written table that
    is read) sets the number of ranges.  Keys of ``HOT_ROWS`` or more are
    reduced before that.  Without ``instant`` all rows are compared in full.
    ``keys`` are the written :func:`repeated_keys`, if there are any already.

    The full comparison of the hot keys, and without ``instant``, has map-side
    partial aggregation, so a key holding a third of all rows is reduced in
    every task before the shuffle.
    """
    order = order if order is not None else ["sale_date", "sale_time"]
    rows = rows.select([c for c in rows.columns if c not in FLAGS])
    if instant is None:
        return Kept(_least_rows(rows, key, order), False)
    if keys is None:
        keys = cut_lineage(repeated_keys(rows, key, instant))
    small = is_small(keys)
    reduced = keys if small else keys.where(F.col("_n") >= HOT_ROWS)
    if small or reduced.limit(1).count():
        # Beyond the measured size: the hot keys, one for HOT_ROWS rows at the most.
        repeated = F.broadcast(reduced)
        same = F.col(key).eqNullSafe(F.col("_key"))
        others = rows.join(repeated, same, "left_anti")
        first = rows.join(repeated, same & (F.expr(instant) == F.col("_first")), "left_semi")
        rows = others.unionByName(_least_rows(first, key, order))
    if small:
        return Kept(rows, False)
    n = range_partitions(rows, size * 3 // 2)  # zstd files, as in dense_key_large
    ranged = rows.repartitionByRange(n, F.col(key).asc_nulls_first())
    return Kept(in_key_order(_least_rows(ranged, key, order), key), True)


def category_runs(columns: list[str], rules: SalesRules) -> list[list[tuple[str, list[str]]]]:
    """The category columns with their allowed values in order, neighbours together
    as long as their combinations can be numbered."""
    fields = dict(CATEGORY_RULES)
    runs: list[list[tuple[str, list[str]]]] = []
    for before, c in zip([None, *columns], columns):
        if c in fields:
            values = sorted(set(rules.allowed(fields[c])))
            if before not in fields or prod(len(v) for _, v in runs[-1]) * len(values) >= 1 << 62:
                runs.append([])
            runs[-1].append((c, values))
    return runs


def code_categories(clean: DataFrame, rules: SalesRules) -> DataFrame:
    """Clean rows with one number ``_cat<i>`` in the place of each run of
    neighbouring category columns.

    A clean row's categories are of the allowed values, so the number names them
    exactly, and numbers fall in the order of the columns' values.
    """
    runs = category_runs(clean.columns, rules)
    first = {run[0][0]: i for i, run in enumerate(runs)}
    out = []
    for c in clean.columns:
        if c in first:
            code = "0L"
            for name, values in runs[first[c]]:
                listed = ", ".join(text(v) for v in values)
                code = f"({code}) * {len(values)} + array_position(array({listed}), {ident(name)}) - 1"
            out.append(f"{code} AS _cat{first[c]}")
        elif not any(c == name for run in runs for name, _ in run):
            out.append(ident(c))
    return clean.selectExpr(*out)


def name_categories(coded: DataFrame, columns: list[str], rules: SalesRules) -> DataFrame:
    """The ``columns`` of clean rows from :func:`code_categories`."""
    named = {}
    for i, run in enumerate(category_runs(columns, rules)):
        below = 1
        for name, values in reversed(run):
            listed = ", ".join(text(v) for v in values)
            named[name] = f"element_at(array({listed}), CAST(_cat{i} DIV {below} % {len(values)} AS INT) + 1) AS {ident(name)}"
            below *= len(values)
    return coded.selectExpr(*[named.get(c, ident(c)) for c in columns])


def clean_dedup(flagged: DataFrame, size: int = 0, rules: SalesRules | None = None, keys: DataFrame | None = None) -> Kept:
    """Clean rows, one per invoice.  On a written flag table the reject test
    is a filter at the scan, so rejected rows are never sorted or shuffled; rows
    without flags are clean.  With ``rules`` the rows travel with their
    categories as numbers."""
    clean = clean_rows(flagged) if "rejected" in flagged.columns else flagged
    if rules is None:
        return keep_first(clean, instant=SALE_SECOND, size=size, keys=keys)
    kept = keep_first(code_categories(clean, rules), instant=SALE_SECOND, size=size, keys=keys)
    return Kept(name_categories(kept.rows, clean.columns, rules), kept.in_key_order)
