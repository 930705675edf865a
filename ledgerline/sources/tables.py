"""Driver tables and the raw sales view derived from them.

The view turns ``lineitem`` with its order, customer, nation, region and part
into rows shaped like the raw retail sales file: the same 17 header names,
every value a string, as a CSV reader without type inference would give.
All money is built from integer cents, so its text is exact.  A few values
are made NULL or malformed by fixed rules on the keys, so that every data
quality rule meets real cases.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import TABLE_CODEC, ensure_checkpoint_dir

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]

# Parquet schemas already read in this process, by path.  Passing the schema
# skips Spark's footer-reading job on every read; file listing still runs, so
# new files are seen.
_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def _money(cents: str) -> str:
    """SQL text: non-negative integer cents -> ``12.34``."""
    return (f"concat(cast(({cents}) div 100 as string), '.', "
            f"lpad(cast(({cents}) % 100 as string), 2, '0'))")


def _fixed4(scaled: str) -> str:
    """SQL text: non-negative integer ten-thousandths -> ``4.7619``."""
    return (f"concat(cast(({scaled}) div 10000 as string), '.', "
            f"lpad(cast(({scaled}) % 10000 as string), 4, '0'))")


# What the view takes from a line besides its keys: integer cents and percents,
# and the columns it shows.
LINE_VALUES = {
    "l_linenumber": "l_linenumber", "l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus", "l_shipdate": "l_shipdate",
    "qty": "cast(l_quantity as bigint)", "ext": "cast(round(l_extendedprice * 100) as bigint)",
    "tax_pct": "cast(round(l_tax * 100) as bigint)", "disc_pct": "cast(round(l_discount * 100) as bigint)",
}
LINE_COLUMNS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

# For the lines whose small values lie in the usual ranges, one number holds all
# of them: (value, its number, how many numbers, the value from the number).
LINE_CODES = [
    ("l_linenumber", "l_linenumber", 1 << 6, "cast({} as int)"),
    ("qty", "try_cast(l_quantity as bigint)", 1 << 12, "{}"),
    ("tax_pct", "try_cast(round(l_tax * 100) as bigint)", 1 << 7, "{}"),
    ("disc_pct", "try_cast(round(l_discount * 100) as bigint)", 1 << 7, "{}"),
    ("l_shipdate", "unix_date(l_shipdate)", 1 << 16, "date_from_unix_date(cast({} as int))"),
    ("l_returnflag", "case when chr(ascii(l_returnflag)) = l_returnflag then ascii(l_returnflag) end", 1 << 7, "chr({})"),
    ("l_linestatus", "case when chr(ascii(l_linestatus)) = l_linestatus then ascii(l_linestatus) end", 1 << 7, "chr({})"),
]


def code_lines(li: DataFrame) -> DataFrame:
    """Lines with ``ext`` and one number ``_line`` in the place of their values;
    a line with a NULL or a value out of range keeps its columns, as ``_rest``."""
    number, fits = "0L", "ext is not null"
    for i, (_, _, size, _) in enumerate(LINE_CODES):
        number = f"({number}) * {size} + _c{i}"
        fits += f" and _c{i} >= 0 and _c{i} < {size}"
    coded = li.selectExpr("*", "try_cast(round(l_extendedprice * 100) as bigint) as ext",
                          *[f"{sql} as _c{i}" for i, (_, sql, _, _) in enumerate(LINE_CODES)])
    return coded.selectExpr("l_orderkey", "l_partkey", "unrated", "ext", f"case when {fits} then {number} end as _line",
                            f"case when {fits} then null else struct({', '.join(LINE_COLUMNS)}) end as _rest")


def coded_line_values() -> dict[str, str]:
    """SQL of :data:`LINE_VALUES` over the columns of :func:`code_lines`."""
    found, below = {"ext": "ext"}, 1
    for name, _, size, back in reversed(LINE_CODES):
        found[name] = back.format(f"(_line div {below} % {size})")
        below *= size
    out = {}
    for name, sql in LINE_VALUES.items():
        for c in LINE_COLUMNS:
            sql = sql.replace(c, f"_rest.{c}")
        out[name] = f"case when _line is null then {sql} else {found[name]} end"
    return out


# From this date on the view has members that earlier rows lack: a city and
# the second edition of some product lines.
LATE_MEMBERS_FROM = "2000-01-01"


def sales_view(spark: SparkSession, sf_dir: str, ship_from: str | None = None,
               ship_before: str | None = None, coded: bool = False) -> DataFrame:
    """Raw-shaped sales rows over ``lineitem``.

    ``ship_from`` / ``ship_before`` cut the rows into load batches by ship
    date (the filter reaches the parquet scan; rows without a date belong to
    the later batch); without them every row is used.  A later batch
    (``ship_from``) also withdraws the tax of some orders, as a correction
    file would.  ``coded`` is for a reader of all rows: the lines pass the
    shuffles as numbers (:func:`code_lines`).  A reader that filters rows by
    their values does better without, as Spark then filters before the joins.
    """
    li = read_table(spark, sf_dir, "lineitem")
    if ship_from:
        li = li.filter((F.col("l_shipdate") >= F.lit(ship_from).cast("timestamp_ntz")) | F.col("l_shipdate").isNull())
    if ship_before:
        li = li.filter(F.col("l_shipdate") < F.lit(ship_before).cast("timestamp_ntz"))
    # Every line is shuffled: of the supplier only a test goes along, of the ship time its day.
    li = li.selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey % 47 = 0 as unrated", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "cast(l_shipdate as date) as l_shipdate",
    )
    values = LINE_VALUES
    if coded:
        li, values = code_lines(li), coded_line_values()
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")

    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    buyer = (orders.join(customer, orders.o_custkey == customer.c_custkey)
             .select("o_orderkey", "c_mktsegment", "c_nationkey"))
    # Lineitem meets orders in a shuffle join (both grow with the data; AQE
    # splits skewed order keys); Spark's size estimate decides for part.  Orders
    # come after part, so that lines of an order lie together, which makes files
    # and shuffles of the rows smaller.  The names of the few nations come last,
    # so that no shuffle carries them.
    rows = (li.join(part, li.l_partkey == part.p_partkey)
            .join(buyer, li.l_orderkey == buyer.o_orderkey)
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))

    # Integer cents and percents first, then the raw text columns.  Written
    # as SQL expressions: one call builds the whole projection.
    cents = rows.selectExpr(
        "l_orderkey", "l_partkey", "unrated", "c_mktsegment", "n_nationkey", "n_name", "r_name", "p_type",
        *[f"{sql} as {name}" for name, sql in values.items()],
    ).selectExpr(
        "*",
        "(ext * 2 + qty) div (qty * 2) as price_c",
        "(ext * tax_pct * 2 + 100) div 200 as tax_c",
        "(tax_pct * 2000000 + tax_pct + 100) div ((tax_pct + 100) * 2) as margin_s",
        f"coalesce(l_shipdate >= date'{LATE_MEMBERS_FROM}', false) as late",
        # Exact duplicate rows.
        "explode(sequence(1, case when l_orderkey % 211 = 0 then 2 else 1 end)) as copy",
    )
    withdrawn = "or l_orderkey % 67 = 0" if ship_from else ""
    return cents.selectExpr(
        "case when l_orderkey % 101 = 0 and l_linenumber = 1 then null "
        "else concat('INV-', cast(l_orderkey as string), '-', cast(l_linenumber as string)) end as `Invoice ID`",
        "r_name as `Branch`",
        "case when l_partkey % 89 = 0 then null when n_nationkey = 24 and not late then 'NATION_23' "
        "else n_name end as `City`",
        "c_mktsegment as `Customer type`",
        "case when l_partkey % 97 = 0 then null else l_linestatus end as `Gender`",
        "concat(p_type, case when late and l_partkey % 53 = 0 then ' II' else '' end, "
        "case when l_partkey % 59 = 0 then ' \"best\", new\\nline' else '' end) as `Product line`",
        "case when l_partkey % 103 = 0 then 'n/a' when l_partkey % 107 = 0 then '1e30' "
        f"when l_partkey % 109 = 0 then '10d' else {_money('price_c')} end as `Unit price`",
        "case when l_orderkey % 113 = 0 then '3000000000' when l_orderkey % 127 = 0 then '2.5' "
        "else cast(qty as string) end as `Quantity`",
        f"case when l_orderkey % 61 = 0 {withdrawn} then null else {_money('tax_c')} end as `Tax 5%`",
        f"{_money('ext + tax_c')} as `Total`",
        "case when l_orderkey % 41 = 0 then date_format(l_shipdate, 'yyyy-MM-dd') "
        "else concat_ws('/', cast(month(l_shipdate) as string), cast(day(l_shipdate) as string), "
        "cast(year(l_shipdate) as string)) end as `Date`",
        "concat(cast(l_orderkey % 26 as string), ':', lpad(cast(l_partkey % 60 as string), 2, '0')) as `Time`",
        "case when l_orderkey % 83 = 0 then null else l_returnflag end as `Payment`",
        f"{_money('ext')} as `cogs`",
        f"{_fixed4('margin_s')} as `gross margin percentage`",
        f"{_money('tax_c')} as `gross income`",
        "case when unrated then null "
        "else concat(cast(disc_pct as string), '.', cast(l_orderkey % 10 as string)) end as `Rating`",
    )


# Landed views, by (application, input fingerprint, batch).  The raw sales
# rows play the part of the raw files of a production run: they are
# written once to the shared checkpoint folder and every query of the
# session that reads them again does so from that table (in parallel,
# column-pruned) instead of re-deriving it.  The fingerprint holds path, size and modification time of
# every input table, so changed inputs are landed again.
_LANDED: dict[tuple, str] = {}
VIEW_TABLES = ["lineitem", "orders", "customer", "nation", "region", "part"]


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    jvm = spark._jvm
    out = []
    for name in VIEW_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for st in fs.listStatus(path):
            out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return tuple(out)


def view_key(spark: SparkSession, sf_dir: str, ship_from: str | None = None, ship_before: str | None = None) -> tuple:
    """What identifies a landed view: the application, the input files and the batch."""
    return spark.sparkContext.applicationId, _fingerprint(spark, sf_dir), ship_from, ship_before


def raw_sales_view(spark: SparkSession, sf_dir: str, ship_from: str | None = None,
                   ship_before: str | None = None, coded: bool = False) -> DataFrame:
    """:func:`landed_sales_view` if the session has landed it, else the view
    itself: for a reader that goes over it once and writes every raw value."""
    if view_key(spark, sf_dir, ship_from, ship_before) in _LANDED:
        return landed_sales_view(spark, sf_dir, ship_from, ship_before)
    return sales_view(spark, sf_dir, ship_from, ship_before, coded)


def landed_sales_view(spark: SparkSession, sf_dir: str, ship_from: str | None = None,
                      ship_before: str | None = None) -> DataFrame:
    """:func:`sales_view`, written once per session and read back."""
    key = view_key(spark, sf_dir, ship_from, ship_before)
    path = _LANDED.get(key)
    view = sales_view(spark, sf_dir, ship_from, ship_before, coded=True)
    if path is None:
        path = f"{ensure_checkpoint_dir(spark)}/landed/{uuid.uuid4().hex}"
        view.write.option("compression", TABLE_CODEC).parquet(path)
        _LANDED[key] = path
    return spark.read.schema(view.schema).parquet(path)
