"""DuckDB SQL computing the same results as ``catalog.QUERIES``.

Used as an independent oracle: it restates each stage (sales view, flags,
clean rows, dedup, dimensions, fact, reports) in plain SQL over the same
parquet tables.  Rounding follows the same rule as ``functions.money``.
"""

from __future__ import annotations

from ledgerline.rules import driver_table_rules

_R = driver_table_rules()


def rounded(x: str, places: int) -> str:
    return (f"coalesce(CAST(ROUND(TRY_CAST({x} AS DECIMAL(28,10)), {places}) AS DOUBLE), "
            f"round(CAST({x} AS DOUBLE), {places}))")


def r2(x: str) -> str:
    return rounded(x, 2)


def _in(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def money(c: str) -> str:
    return f"(CAST(({c}) // 100 AS VARCHAR) || '.' || lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))"


def fixed4(c: str) -> str:
    return f"(CAST(({c}) // 10000 AS VARCHAR) || '.' || lpad(CAST(({c}) % 10000 AS VARCHAR), 4, '0'))"


def view_sql(sfx: str = "", where: str = "", corrected: bool = False) -> str:
    withdrawn = "OR l_orderkey % 67 = 0" if corrected else ""
    return f"""
base{sfx} AS (
  SELECT l.*, o.*, c.*, n.n_nationkey, n.n_name, r.r_name, p.p_type,
         CAST(l_quantity AS BIGINT) AS qty,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS ext,
         CAST(round(l_tax * 100) AS BIGINT) AS tax_pct,
         CAST(round(l_discount * 100) AS BIGINT) AS disc_pct,
         coalesce(l_shipdate >= TIMESTAMP '2000-01-01', false) AS late
  FROM (SELECT *, unnest(range(CASE WHEN l_orderkey % 211 = 0 THEN 2 ELSE 1 END)) AS copy FROM lineitem) l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  {where}
),
cents{sfx} AS (
  SELECT *, (ext * 2 + qty) // (qty * 2) AS price_c,
         (ext * tax_pct * 2 + 100) // 200 AS tax_c,
         (tax_pct * 2000000 + tax_pct + 100) // ((tax_pct + 100) * 2) AS margin_s
  FROM base{sfx}
),
raw{sfx} AS (
  SELECT
    CASE WHEN l_orderkey % 101 = 0 AND l_linenumber = 1 THEN NULL
         ELSE 'INV-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS invoice_id,
    r_name AS branch,
    CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN n_nationkey = 24 AND NOT late THEN 'NATION_23'
         ELSE n_name END AS city,
    c_mktsegment AS customer_type,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_linestatus END AS gender,
    p_type || CASE WHEN late AND l_partkey % 53 = 0 THEN ' II' ELSE '' END
           || CASE WHEN l_partkey % 59 = 0 THEN ' "best", new' || chr(10) || 'line' ELSE '' END AS product_line,
    CASE WHEN l_partkey % 103 = 0 THEN 'n/a' WHEN l_partkey % 107 = 0 THEN '1e30'
         WHEN l_partkey % 109 = 0 THEN '10d' ELSE {money('price_c')} END AS unit_price,
    CASE WHEN l_orderkey % 113 = 0 THEN '3000000000' WHEN l_orderkey % 127 = 0 THEN '2.5'
         ELSE CAST(qty AS VARCHAR) END AS quantity,
    CASE WHEN l_orderkey % 61 = 0 {withdrawn} THEN NULL ELSE {money('tax_c')} END AS tax_amount,
    {money('ext + tax_c')} AS total_amount,
    CASE WHEN l_orderkey % 41 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
         ELSE CAST(month(l_shipdate) AS VARCHAR) || '/' || CAST(day(l_shipdate) AS VARCHAR) || '/'
              || CAST(year(l_shipdate) AS VARCHAR) END AS sale_date,
    CAST(l_orderkey % 26 AS VARCHAR) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') AS sale_time,
    CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE l_returnflag END AS payment_method,
    {money('ext')} AS cogs,
    {fixed4('margin_s')} AS gross_margin_pct,
    {money('tax_c')} AS gross_income,
    CASE WHEN l_suppkey % 47 = 0 THEN NULL
         ELSE CAST(disc_pct AS VARCHAR) || '.' || CAST(l_orderkey % 10 AS VARCHAR) END AS rating
  FROM cents{sfx}
)"""

RAW_COLUMNS = [
    "invoice_id", "branch", "city", "customer_type", "gender", "product_line",
    "unit_price", "quantity", "tax_amount", "total_amount", "sale_date", "sale_time",
    "payment_method", "cogs", "gross_margin_pct", "gross_income", "rating",
]
NUMERIC = ["unit_price", "quantity", "tax_amount", "total_amount", "cogs",
           "gross_margin_pct", "gross_income", "rating"]
CRITICAL = ["invoice_id", "branch", "city", "product_line", "unit_price", "quantity",
            "total_amount", "sale_date", "sale_time"]
FLAGS = ["critical_null", "invalid_date", "invalid_time", "invalid_branch", "invalid_city",
         "invalid_customer_type", "invalid_gender", "invalid_payment", "invalid_numeric",
         "tax_mismatch", "total_mismatch", "cogs_mismatch", "gross_income_mismatch", "rejected"]


def _typed_select() -> str:
    out = []
    for c in RAW_COLUMNS:
        if c == "sale_date":
            out.append("try_strptime(sale_date, '%m/%d/%Y')::DATE AS sale_date")
        elif c == "sale_time":
            out.append("strftime(try_strptime(sale_time, '%H:%M'), '%H:%M:%S') AS sale_time")
        elif c in NUMERIC:
            out.append(f"TRY_CAST({c} AS DOUBLE) AS {c}")
        else:
            out.append(c)
    return ",\n    ".join(out)


def stages(sfx: str = "", where: str = "", corrected: bool = False) -> str:
    """CTEs from the raw view to the fact, names suffixed with ``sfx``."""
    crit = " OR ".join(f"raw{sfx}.{c} IS NULL" for c in CRITICAL)
    tol = _R.tolerance
    order = ", ".join(c + " ASC NULLS FIRST" for c in _DEDUP_ORDER)
    return view_sql(sfx, where, corrected) + f""",
typed{sfx} AS (
  SELECT {_typed_select()},
    ({crit}) AS critical_null
  FROM raw{sfx}
),
flagged0{sfx} AS (
  SELECT *,
    sale_date IS NULL AS invalid_date,
    sale_time IS NULL AS invalid_time,
    NOT coalesce(branch IN ({_in(_R.branches)}), false) AS invalid_branch,
    NOT coalesce(city IN ({_in(_R.cities)}), false) AS invalid_city,
    NOT coalesce(customer_type IN ({_in(_R.customer_types)}), false) AS invalid_customer_type,
    NOT coalesce(gender IN ({_in(_R.genders)}), false) AS invalid_gender,
    NOT coalesce(payment_method IN ({_in(_R.payments)}), false) AS invalid_payment,
    coalesce(unit_price <= {_R.price_min} OR quantity < {_R.quantity_min} OR quantity >= 9.2e18
             OR rating < {_R.rating_min} OR rating > {_R.rating_max}, true) AS invalid_numeric,
    coalesce(abs(tax_amount - {r2(f'cogs * {_R.tax_rate}')}) > {tol}, false) AS tax_mismatch,
    coalesce(abs(total_amount - {r2('cogs + coalesce(tax_amount, 0.0)')}) > {tol}, false) AS total_mismatch,
    coalesce(abs(cogs - {r2('unit_price * quantity')}) > {tol}, false) AS cogs_mismatch,
    coalesce(abs(gross_income - coalesce(tax_amount, 0.0)) > {tol}, false) AS gross_income_mismatch
  FROM typed{sfx}
),
flagged{sfx} AS (
  SELECT *, (critical_null OR invalid_date OR invalid_time OR invalid_branch OR invalid_city
             OR invalid_customer_type OR invalid_gender OR invalid_payment OR invalid_numeric) AS rejected
  FROM flagged0{sfx}
),
clean{sfx} AS (SELECT {_COLS} FROM flagged{sfx} WHERE NOT rejected),
dedup{sfx} AS (
  SELECT {_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY {order}) AS rn
    FROM clean{sfx}) WHERE rn = 1
),
dim_branch{sfx} AS (
  SELECT CAST(row_number() OVER (ORDER BY branch, city) AS BIGINT) AS branch_key,
         branch AS branch_code, city
  FROM (SELECT DISTINCT branch, city FROM dedup{sfx})
),
dim_product{sfx} AS (
  SELECT CAST(row_number() OVER (ORDER BY product_line) AS BIGINT) AS product_key, product_line
  FROM (SELECT DISTINCT product_line FROM dedup{sfx})
),
fact{sfx} AS (
  SELECT CAST(row_number() OVER (ORDER BY d.invoice_id) AS BIGINT) AS sales_key, d.invoice_id,
         {_FACT_BODY}
  FROM dedup{sfx} d
  LEFT JOIN dim_branch{sfx} b ON d.branch = b.branch_code AND d.city = b.city
  LEFT JOIN dim_product{sfx} p ON d.product_line = p.product_line
)"""


_DEDUP_ORDER = ["sale_date", "sale_time"] + [c for c in RAW_COLUMNS if c not in
                                             ("invoice_id", "sale_date", "sale_time")]
_COLS = ", ".join(RAW_COLUMNS)
_FACT_BODY = """b.branch_key, p.product_key, d.sale_date, d.sale_time, d.customer_type, d.gender,
         d.payment_method, d.unit_price, CAST(round(d.quantity) AS BIGINT) AS quantity, d.tax_amount,
         d.total_amount, d.cogs, d.gross_margin_pct, d.gross_income, d.rating"""
FACT_VALUES = ["branch_key", "product_key", "sale_date", "sale_time", "customer_type", "gender",
               "payment_method", "unit_price", "quantity", "tax_amount", "total_amount", "cogs",
               "gross_margin_pct", "gross_income", "rating"]
TYPED_COLUMNS = RAW_COLUMNS


def with_stages(body: str) -> str:
    return "WITH " + stages().strip() + "\n" + body


def _dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,4))"


def r6(x: str) -> str:
    return f"CASE WHEN abs({x}) < 1e6 THEN {rounded(x, 6)} ELSE CAST(printf('%.9e', CAST({x} AS DOUBLE)) AS DOUBLE) END"


_REPORT_BODY = f"""
SELECT b.branch_code, b.city, p.product_line,
  CAST(COUNT(f.sales_key) AS BIGINT) AS transaction_count,
  CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
  {r2(f"SUM({_dec('f.total_amount')})")} AS total_sales,
  {r2(f"SUM({_dec('f.gross_income')})")} AS total_gross_income,
  {r2(f"CAST(SUM({_dec('f.rating')}) AS DOUBLE) / COUNT(f.rating)")} AS avg_rating,
  CAST(RANK() OVER (PARTITION BY b.branch_code ORDER BY SUM({_dec('f.total_amount')}) DESC) AS INTEGER)
    AS sales_rank_within_branch,
  {r2(f"CAST(SUM({_dec('f.total_amount')}) AS DOUBLE) * 100.0 / "
      f"NULLIF(CAST(SUM(SUM({_dec('f.total_amount')})) OVER (PARTITION BY b.branch_code) AS DOUBLE), 0)")}
    AS pct_of_branch_sales
FROM fact f
JOIN dim_branch b ON f.branch_key = b.branch_key
JOIN dim_product p ON f.product_key = p.product_key
GROUP BY b.branch_code, b.city, p.product_line"""

SALES_REPORT = with_stages(_REPORT_BODY + "\nORDER BY b.branch_code, sales_rank_within_branch, p.product_line")
REPORT_PREVIEW = with_stages(f"SELECT * FROM ({_REPORT_BODY}) "
                             "ORDER BY branch_code, sales_rank_within_branch, product_line, city LIMIT 10")
REPORT_TOPN = with_stages(f"SELECT * FROM ({_REPORT_BODY}) WHERE sales_rank_within_branch <= 3")

_STAR = "FROM fact f JOIN dim_branch b ON f.branch_key = b.branch_key JOIN dim_product p ON f.product_key = p.product_key"


def _metric_sql() -> str:
    flag_metrics = {
        "critical_null": "critical_null_rows", "invalid_date": "invalid_dates",
        "invalid_time": "invalid_times", "invalid_branch": "invalid_branch_values",
        "invalid_city": "invalid_city_values", "invalid_customer_type": "invalid_customer_type_values",
        "invalid_gender": "invalid_gender_values", "invalid_payment": "invalid_payment_values",
        "invalid_numeric": "invalid_numeric_rows", "tax_mismatch": "tax_mismatch_rows",
        "total_mismatch": "total_mismatch_rows", "cogs_mismatch": "cogs_mismatch_rows",
        "gross_income_mismatch": "gross_income_mismatch_rows", "rejected": "rejected_rows",
    }
    sums = ",\n    ".join(f"CAST(count(*) FILTER (WHERE {f}) AS BIGINT) AS {m}" for f, m in flag_metrics.items())
    return f"""
ids AS (SELECT invoice_id, count(*) AS n FROM raw GROUP BY invoice_id),
metrics AS (
  SELECT
    CAST(count(*) AS BIGINT) AS raw_row_count,
    CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS BIGINT) AS raw_duplicate_rows,
    (SELECT CAST(sum(n - 1) AS BIGINT) FROM ids) AS duplicate_invoice_ids,
    (SELECT CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) FROM ids) AS invoice_ids_with_duplicates,
    {sums},
    CAST(count(*) FILTER (WHERE NOT rejected) AS BIGINT) AS clean_rows,
    (SELECT CAST(count(DISTINCT invoice_id) AS BIGINT) FROM clean) AS clean_rows_after_invoice_dedup
  FROM flagged
)"""


def _with_metrics(body: str) -> str:
    return "WITH " + stages().strip() + "," + _metric_sql() + "\n" + body


RAW_NAMES = {
    "invoice_id": "Invoice ID", "branch": "Branch", "city": "City", "customer_type": "Customer type",
    "gender": "Gender", "product_line": "Product line", "unit_price": "Unit price", "quantity": "Quantity",
    "tax_amount": "Tax 5%", "total_amount": "Total", "sale_date": "Date", "sale_time": "Time",
    "payment_method": "Payment", "cogs": "cogs", "gross_margin_pct": "gross margin percentage",
    "gross_income": "gross income", "rating": "Rating",
}
WARNINGS = [("duplicate_rows", "raw_duplicate_rows"), ("duplicate_invoice_ids", "duplicate_invoice_ids"),
            ("tax_mismatch_rows", "tax_mismatch_rows"), ("total_mismatch_rows", "total_mismatch_rows"),
            ("cogs_mismatch_rows", "cogs_mismatch_rows"),
            ("gross_income_mismatch_rows", "gross_income_mismatch_rows")]
METRIC_COLUMNS = [
    "raw_row_count", "raw_duplicate_rows", "duplicate_invoice_ids", "invoice_ids_with_duplicates",
    "critical_null_rows", "invalid_dates", "invalid_times", "invalid_branch_values", "invalid_city_values",
    "invalid_customer_type_values", "invalid_gender_values", "invalid_payment_values",
    "invalid_numeric_rows", "tax_mismatch_rows", "total_mismatch_rows", "cogs_mismatch_rows",
    "gross_income_mismatch_rows", "rejected_rows", "clean_rows", "clean_rows_after_invoice_dedup",
]


def _markers() -> str:
    from ledgerline.rules import NULL_MARKERS

    return _in(NULL_MARKERS)


def _describe() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value FROM typed WHERE {c} IS NOT NULL" for c in NUMERIC)
    return with_stages(f""",
long AS ({long}),
summed AS (
  SELECT column_name, count(value) AS n, min(value) AS lo, max(value) AS hi,
    (CAST(coalesce(SUM(TRY_CAST(value AS DECIMAL(26,10))), 0) AS DOUBLE)
     + coalesce(SUM(CASE WHEN TRY_CAST(value AS DECIMAL(26,10)) IS NULL THEN value END), 0)) / count(value) AS mean,
    quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75
  FROM long GROUP BY column_name
),
spread AS (
  SELECT l.column_name, CASE WHEN count(*) > 1 THEN sqrt(SUM((l.value - s.mean) * (l.value - s.mean)) / (count(*) - 1)) END AS std
  FROM long l JOIN summed s USING (column_name) GROUP BY l.column_name
)
SELECT column_name, CAST(n AS BIGINT) AS count, {r6("mean")} AS mean, {r6("std")} AS std, lo AS min,
  {r6("q25")} AS p25, {r6("q50")} AS p50, {r6("q75")} AS p75, hi AS max
FROM summed JOIN spread USING (column_name)""".replace("\n,\nlong", ",\nlong"))


def _histogram() -> str:
    """Every value compared with the edges of all bins; the last bin is closed."""
    def edge(i: str) -> str:
        return f"CASE WHEN {i} = 20 THEN hi ELSE CAST({i} AS DOUBLE) * ((hi - lo) / 20.0) + lo END"

    return with_stages(f""",
bounds0 AS (SELECT min(rating) AS lo0, max(rating) AS hi0 FROM typed),
bounds AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
                  CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM bounds0),
bins AS (SELECT CAST(range AS INTEGER) AS bin, {edge("range")} AS lower_edge, {edge("range + 1")} AS upper_edge
         FROM range(20), bounds)
SELECT bin, any_value(lower_edge) AS lower_edge, any_value(upper_edge) AS upper_edge, CAST(count(rating) AS BIGINT) AS "count"
FROM bins LEFT JOIN typed ON rating >= lower_edge AND (rating < upper_edge OR bin = 19 AND rating = upper_edge)
GROUP BY bin""")


def _pivot(measure: str) -> str:
    cols = ",\n  ".join(measure.format(v=v.replace("'", "''")) + f' AS "{v}"' for v in _R.branches)
    return with_stages(f"SELECT p.product_line,\n  {cols}\n{_STAR}\nGROUP BY p.product_line")


def _upsert(table: str) -> str:
    first = stages("_a", "WHERE l.l_shipdate < TIMESTAMP '1999-01-01'")
    second = stages("_b", "WHERE l.l_shipdate >= TIMESTAMP '1998-07-01' OR l.l_shipdate IS NULL", corrected=True)
    picks = ",\n    ".join(f"CASE WHEN s.invoice_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
                           for c in FACT_VALUES)
    src_cols = ", ".join(f"s.{c}" for c in FACT_VALUES)
    return "WITH " + first.strip() + "," + second + f""",
new_branch AS (
  SELECT DISTINCT branch AS branch_code, city FROM dedup_b d
  WHERE NOT EXISTS (SELECT 1 FROM dim_branch_a t WHERE t.branch_code = d.branch AND t.city = d.city)
),
dim_branch_m AS (
  SELECT * FROM dim_branch_a
  UNION ALL
  SELECT (SELECT coalesce(max(branch_key), 0) FROM dim_branch_a)
         + CAST(row_number() OVER (ORDER BY branch_code, city) AS BIGINT), branch_code, city
  FROM new_branch
),
new_product AS (
  SELECT DISTINCT product_line FROM dedup_b d
  WHERE NOT EXISTS (SELECT 1 FROM dim_product_a t WHERE t.product_line = d.product_line)
),
dim_product_m AS (
  SELECT * FROM dim_product_a
  UNION ALL
  SELECT (SELECT coalesce(max(product_key), 0) FROM dim_product_a)
         + CAST(row_number() OVER (ORDER BY product_line) AS BIGINT), product_line
  FROM new_product
),
src AS (
  SELECT d.invoice_id, {_FACT_BODY}
  FROM dedup_b d
  LEFT JOIN dim_branch_m b ON d.branch = b.branch_code AND d.city = b.city
  LEFT JOIN dim_product_m p ON d.product_line = p.product_line
),
fact_m AS (
  SELECT t.sales_key, t.invoice_id,
    {picks}
  FROM fact_a t LEFT JOIN src s ON t.invoice_id = s.invoice_id
  UNION ALL
  SELECT (SELECT coalesce(max(sales_key), 0) FROM fact_a) + CAST(row_number() OVER (ORDER BY s.invoice_id) AS BIGINT),
         s.invoice_id, {src_cols}
  FROM src s WHERE NOT EXISTS (SELECT 1 FROM fact_a t WHERE t.invoice_id = s.invoice_id)
)
SELECT * FROM {table}"""


def _unique(table: str, cols: str) -> str:
    first = cols.split(",")[0].strip()
    return (f"(SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {table} "
            f"WHERE {first} IS NOT NULL GROUP BY {cols}) WHERE n > 1)")


def _orphans(fk: str, dim: str) -> str:
    return (f"(SELECT CAST(count(*) AS BIGINT) FROM fact f WHERE NOT EXISTS "
            f"(SELECT 1 FROM {dim} d WHERE d.{fk} = f.{fk}))")


_CHECKS = [
    ("dim_branch", "pk_not_null", "(SELECT CAST(count(*) FILTER (WHERE branch_key IS NULL) AS BIGINT) FROM dim_branch)"),
    ("dim_branch", "pk_unique", _unique("dim_branch", "branch_key")),
    ("dim_branch", "natural_key_unique", _unique("dim_branch", "branch_code, city")),
    ("dim_product", "pk_not_null", "(SELECT CAST(count(*) FILTER (WHERE product_key IS NULL) AS BIGINT) FROM dim_product)"),
    ("dim_product", "pk_unique", _unique("dim_product", "product_key")),
    ("dim_product", "natural_key_unique", _unique("dim_product", "product_line")),
    ("fact_sales", "pk_not_null", "(SELECT CAST(count(*) FILTER (WHERE sales_key IS NULL) AS BIGINT) FROM fact)"),
    ("fact_sales", "pk_unique", _unique("fact", "sales_key")),
    ("fact_sales", "natural_key_unique", _unique("fact", "invoice_id")),
    ("fact_sales", "fk_branch_key", _orphans("branch_key", "dim_branch")),
    ("fact_sales", "fk_product_key", _orphans("product_key", "dim_product")),
]

def _count_if(conditions: dict[str, str], table: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS assertion, CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS violations FROM {table}"
                              for n, c in conditions.items())


def _unknown(column: str, allowed: list[str]) -> str:
    return f"{column} IS NULL OR {column} NOT IN ({_in(allowed)})"


_ASSERTIONS = " UNION ALL ".join([
    _count_if({
        "total_positive": "total_amount IS NULL OR total_amount <= 0", "quantity_positive": "quantity IS NULL OR quantity <= 0",
        "unit_price_positive": "unit_price IS NULL OR unit_price <= 0",
        "rating_in_range": "rating IS NULL OR NOT rating BETWEEN 0 AND 10", "invoice_id_present": "invoice_id IS NULL",
        "sale_date_present": "sale_date IS NULL", "branch_key_present": "branch_key IS NULL",
        "product_key_present": "product_key IS NULL", "customer_type_known": _unknown("customer_type", _R.customer_types),
        "gender_known": _unknown("gender", _R.genders), "payment_known": _unknown("payment_method", _R.payments)}, "fact"),
    _count_if({"branch_known": _unknown("branch_code", _R.branches), "city_known": _unknown("city", _R.cities)}, "dim_branch"),
    _count_if({"product_line_present": "product_line IS NULL"}, "dim_product"),
])

_REPLACED = {"invoice_id": "invoice_id", "branch": "branch", "city": "city", "customer_type": "customer_type", "gender": "gender",
             "product_line": "product_line", "unit_price": "unit_price", "quantity": "quantity", "tax_amount": "tax_5pct",
             "total_amount": "total", "sale_date": "date", "sale_time": "time", "payment_method": "payment", "cogs": "cogs",
             "gross_margin_pct": "gross_margin_percentage", "gross_income": "gross_income", "rating": "rating"}


def _branch_city() -> str:
    """Branches (here: the cities of clean rows) whose one city is a depot named after the load's row count."""
    def depots(sfx: str) -> str:
        return (f"SELECT city AS branch_code, CASE WHEN count(*) % 3 = 0 THEN NULL ELSE 'Depot ' || CAST(count(*) AS VARCHAR) END AS city "
                f"FROM dedup{sfx} GROUP BY city")

    first = stages("_a", "WHERE l.l_shipdate < TIMESTAMP '1999-01-01'")
    second = stages("_b", "WHERE l.l_shipdate >= TIMESTAMP '1998-07-01' OR l.l_shipdate IS NULL", corrected=True)
    return "WITH " + first.strip() + "," + second + f""",
src AS ({depots('_b')}),
tgt AS (SELECT CAST(row_number() OVER (ORDER BY branch_code) AS BIGINT) AS branch_key, branch_code, city FROM ({depots('_a')}))
SELECT t.branch_key, t.branch_code, CASE WHEN s.branch_code IS NOT NULL THEN s.city ELSE t.city END AS city
FROM tgt t LEFT JOIN src s ON t.branch_code = s.branch_code
UNION ALL
SELECT (SELECT max(branch_key) FROM tgt) + CAST(row_number() OVER (ORDER BY branch_code) AS BIGINT), branch_code, city
FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.branch_code = s.branch_code)"""


_SUMMARY_ROWS = [("good", "fact_sales_staging", "succeeded"), ("good", "dim_branch_staging", "succeeded"),
                 ("good", "dim_product_staging", "succeeded"), ("good", "constraint_checks", "succeeded"),
                 ("good", "publish", "succeeded"),
                 ("bad", "dim_branch_staging", "succeeded"), ("bad", "dim_product_staging", "succeeded"),
                 ("bad", "fact_sales_staging", "failed")]

ORACLE_SQL: dict[str, str] = {
    "fact_assertions": with_stages(_ASSERTIONS),
    "column_replacement_names": with_stages("SELECT " + ", ".join(f"{c} AS {n}" for c, n in _REPLACED.items()) + " FROM raw"),
    "upsert_branch_city": _branch_city(),
    "dq_report_json": _with_metrics(
        "SELECT 'warning' AS section, 'extra_columns: Channel' AS name, CAST(NULL AS BIGINT) AS value FROM metrics UNION ALL "
        + " UNION ALL ".join(f"SELECT 'warning', '{w}', {m} FROM metrics WHERE {m} > 0" for w, m in WARNINGS) + " UNION ALL "
        + " UNION ALL ".join(f"SELECT 'metric', '{m}', {m} FROM metrics" for m in METRIC_COLUMNS) + " UNION ALL "
        + " UNION ALL ".join(f"SELECT 'null_count', '{RAW_NAMES[c]}', CAST(count(*) - count({c}) AS BIGINT) FROM raw" for c in RAW_COLUMNS)
        + " UNION ALL SELECT 'null_count', 'channel', CAST(0 AS BIGINT) FROM metrics"),
    "load_summary_json": with_stages(" UNION ALL ".join(
        f"SELECT '{r}' AS run, '{step}' AS step, '{o}' AS outcome, CAST(5 AS BIGINT) AS total, "
        "(SELECT CAST(count(*) AS BIGINT) FROM fact) AS published_rows" for r, step, o in _SUMMARY_ROWS)),
    "export_roundtrip": with_stages("SELECT * FROM fact"),
    "report_view": SALES_REPORT,
    "stream_rerun": _upsert("fact_m"),
    "required_columns": with_stages(" UNION ALL ".join(
        f"SELECT '{RAW_NAMES[c]}' AS column_name, " + ("false AS present, CAST(NULL AS BIGINT) AS non_null FROM (SELECT count(*) FROM raw)"
        if RAW_NAMES[c] in ("Rating", "gross income", "City") else f"true AS present, CAST(count({c}) AS BIGINT) AS non_null FROM raw")
        for c in RAW_COLUMNS)),
    "expected_counts": with_stages(
        "SELECT 'dim_branch' AS table_name, CAST(count(*) AS BIGINT) AS row_count, CAST(1 AS BIGINT) AS least, CAST(25 AS BIGINT) AS most, "
        "count(*) BETWEEN 1 AND 25 AS as_expected FROM dim_branch "
        "UNION ALL SELECT 'dim_product', count(*), 1, NULL, count(*) >= 1 FROM dim_product "
        "UNION ALL SELECT 'fact_sales', count(*), 1000, NULL, count(*) >= 1000 FROM fact "
        "UNION ALL SELECT 'dim_customer', NULL, 1, NULL, false FROM (SELECT count(*) FROM raw)"),
    "approx_quantiles": with_stages(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS quantile, CAST(count({c}) AS BIGINT) AS count, min({c}) AS min, max({c}) AS max, "
        f"true AS within_error FROM typed" for c in NUMERIC for p in (0.25, 0.5, 0.75))),
    "batch_run": SALES_REPORT,
    "sales_report": SALES_REPORT,
    "report_topn": REPORT_TOPN,
    "report_preview": REPORT_PREVIEW,
    "column_standardize": with_stages("SELECT * FROM raw"),
    "coerce_dates_times_numbers": with_stages(
        f"SELECT invoice_id, sale_date, sale_time, {', '.join(NUMERIC)}, "
        "strftime(sale_date, '%Y-%m-%d') AS sale_date_iso FROM typed"),
    "dq_flags": with_stages(f"SELECT invoice_id, {', '.join(FLAGS)} FROM flagged"),
    "dq_rejects": with_stages(
        f"SELECT {_COLS}, {', '.join(FLAGS)} FROM flagged WHERE rejected OR tax_mismatch OR total_mismatch "
        "OR cogs_mismatch OR gross_income_mismatch"),
    "clean_sales": with_stages("SELECT * FROM dedup"),
    "dq_metrics": _with_metrics(f"SELECT {', '.join(METRIC_COLUMNS)} FROM metrics"),
    "dq_null_counts": with_stages(" UNION ALL ".join(
        f"SELECT '{RAW_NAMES[c]}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM raw"
        for c in RAW_COLUMNS)),
    "dq_duplicates": _with_metrics(
        "SELECT raw_row_count, raw_duplicate_rows, duplicate_invoice_ids, invoice_ids_with_duplicates, "
        "clean_rows_after_invoice_dedup FROM metrics"),
    "dq_warnings": _with_metrics(" UNION ALL ".join(
        f"SELECT '{w}' AS type, {m} AS count FROM metrics WHERE {m} > 0" for w, m in WARNINGS)),
    "dim_branch": with_stages("SELECT * FROM dim_branch"),
    "dim_product": with_stages("SELECT * FROM dim_product"),
    "fact_sales": with_stages("SELECT * FROM fact"),
    "parquet_roundtrip": with_stages("SELECT * FROM fact"),
    "staged_publish": SALES_REPORT,
    "fk_orphans": with_stages(
        f"SELECT 'branch_key' AS foreign_key, {_orphans('branch_key', 'dim_branch')} AS orphan_rows "
        f"UNION ALL SELECT 'product_key', {_orphans('product_key', 'dim_product')}"),
    "constraint_checks": with_stages(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS check_name, {q} AS violations" for t, c, q in _CHECKS)),
    "row_counts": with_stages(
        "SELECT 'dim_branch' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM dim_branch "
        "UNION ALL SELECT 'dim_product', CAST(count(*) AS BIGINT) FROM dim_product "
        "UNION ALL SELECT 'fact_sales', CAST(count(*) AS BIGINT) FROM fact"),
    "revenue_total": with_stages(f"SELECT {r2('SUM(' + _dec('total_amount') + ')')} AS total_revenue FROM fact"),
    "sales_by_product_line": with_stages(
        f"SELECT p.product_line, {r2('SUM(' + _dec('f.total_amount') + ')')} AS total_sales "
        "FROM fact f JOIN dim_product p ON f.product_key = p.product_key GROUP BY p.product_line"),
    "income_by_branch": with_stages(
        f"SELECT b.branch_code, {r2('SUM(' + _dec('f.gross_income') + ')')} AS total_gross_income "
        "FROM fact f JOIN dim_branch b ON f.branch_key = b.branch_key GROUP BY b.branch_code"),
    "rating_by_city": with_stages(
        f"SELECT b.city, {r2('CAST(SUM(' + _dec('f.rating') + ') AS DOUBLE) / COUNT(f.rating)')} AS avg_rating "
        "FROM fact f JOIN dim_branch b ON f.branch_key = b.branch_key GROUP BY b.city"),
    "pivot_total_sales": _pivot(r2("SUM(CASE WHEN b.branch_code = '{v}' THEN " + _dec("f.total_amount") + " END)")),
    "pivot_avg_rating": _pivot(r2("CAST(SUM(CASE WHEN b.branch_code = '{v}' THEN " + _dec("f.rating")
                                  + " END) AS DOUBLE) / NULLIF(COUNT(CASE WHEN b.branch_code = '{v}' "
                                  "THEN f.rating END), 0)")),
    "value_counts_branch": with_stages(
        'SELECT branch, CAST(count(*) AS BIGINT) AS "count" FROM raw WHERE branch IS NOT NULL GROUP BY branch'),
    "value_counts_product_line": with_stages(
        'SELECT product_line, CAST(count(*) AS BIGINT) AS "count" FROM raw '
        "WHERE product_line IS NOT NULL GROUP BY product_line"),
    "describe_numeric": _describe(),
    "rating_histogram": _histogram(),
    "column_profile": with_stages(" UNION ALL ".join(
        f"SELECT '{RAW_NAMES[c]}' AS column_name, 'string' AS data_type, CAST(count({c}) AS BIGINT) AS non_null "
        "FROM raw" for c in RAW_COLUMNS)),
    "upsert_fact": _upsert("fact_m"),
    "upsert_dim_branch": _upsert("dim_branch_m"),
    "upsert_dim_product": _upsert("dim_product_m"),
    "csv_roundtrip": with_stages("SELECT " + ", ".join(
        f"CASE WHEN {c} IN ({_markers()}) THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS) + " FROM raw"),
}

# Queries whose result holds the DATE column sale_date: emitted as TIMESTAMP
# (midnight), as the Spark catalog does (see ``catalog._driver_types``).
for _name in ["coerce_dates_times_numbers", "dq_rejects", "clean_sales", "fact_sales",
              "parquet_roundtrip", "upsert_fact", "export_roundtrip", "stream_rerun"]:
    _sql = ORACLE_SQL[_name]
    _head, _sep, _body = _sql.rpartition("\nSELECT ")
    ORACLE_SQL[_name] = (_head + "\nSELECT * REPLACE (CAST(sale_date AS TIMESTAMP) AS sale_date) FROM (SELECT "
                         + _body + ")")
