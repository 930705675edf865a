"""Rule sets for the sales pipeline.

A :class:`SalesRules` instance carries everything the pipeline needs to know
about one input layout: the raw header names, the canonical names they map
to, which columns are critical, the allowed category domains and the numeric
limits.  The code in ``operators`` never hard-codes a value; it reads the
rules, so the same plan serves the retail CSV and the driver-table view.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the original job's values for the results
# to agree; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------

# Raw header names of the retail sales file, in file order.
RETAIL_REQUIRED_COLUMNS = [
    "Invoice ID", "Branch", "City", "Customer type", "Gender", "Product line",
    "Unit price", "Quantity", "Tax 5%", "Total", "Date", "Time", "Payment",
    "cogs", "gross margin percentage", "gross income", "Rating",
]

# Raw header -> canonical column name.
RETAIL_ALIASES = {
    "Tax 5%": "tax_amount",
    "Total": "total_amount",
    "Date": "sale_date",
    "Time": "sale_time",
    "Payment": "payment_method",
    "Invoice ID": "invoice_id",
    "Branch": "branch",
    "City": "city",
    "Customer type": "customer_type",
    "Gender": "gender",
    "Product line": "product_line",
    "Unit price": "unit_price",
    "Quantity": "quantity",
    "cogs": "cogs",
    "gross margin percentage": "gross_margin_pct",
    "gross income": "gross_income",
    "Rating": "rating",
}

# Raw columns whose NULL rejects a row.
RETAIL_CRITICAL_COLUMNS = [
    "Invoice ID", "Branch", "City", "Product line",
    "Unit price", "Quantity", "Total", "Date", "Time",
]

RETAIL_BRANCHES = ["A", "B", "C"]
RETAIL_CITIES = ["Yangon", "Mandalay", "Naypyitaw"]
RETAIL_CUSTOMER_TYPES = ["Member", "Normal"]
RETAIL_GENDERS = ["Male", "Female"]
RETAIL_PAYMENTS = ["Cash", "Credit card", "Ewallet"]
RATING_MIN, RATING_MAX = 0.0, 10.0
QUANTITY_MIN = 1
PRICE_MIN = 0.0
TOLERANCE = 0.02
TAX_RATE = 0.05

# Date is month/day/year without zero padding required; time is hour:minute.
DATE_PATTERN = "M/d/yyyy"
TIME_PATTERN = "H:m"

# Tokens a pandas CSV reader turns into NULL by default (pandas docs,
# ``na_values``).  Matched exactly, without trimming.
NULL_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Order of the fact table columns.
FACT_COLUMNS = [
    "sales_key", "invoice_id", "branch_key", "product_key", "sale_date",
    "sale_time", "customer_type", "gender", "payment_method", "unit_price",
    "quantity", "tax_amount", "total_amount", "cogs", "gross_margin_pct",
    "gross_income", "rating",
]

# ---------------------------------------------------------------------------

# Canonical columns converted to numbers, and the numeric one that is a count.
NUMERIC_COLUMNS = [
    "unit_price", "quantity", "tax_amount", "total_amount", "cogs",
    "gross_margin_pct", "gross_income", "rating",
]

# Canonical category column -> rule field holding its allowed values, in the
# order the flags are reported.
CATEGORY_RULES = [
    ("branch", "branches"),
    ("city", "cities"),
    ("customer_type", "customer_types"),
    ("gender", "genders"),
    ("payment_method", "payments"),
]


@dataclass(frozen=True)
class SalesRules:
    required_columns: list[str] = field(default_factory=lambda: list(RETAIL_REQUIRED_COLUMNS))
    aliases: dict[str, str] = field(default_factory=lambda: dict(RETAIL_ALIASES))
    critical_columns: list[str] = field(default_factory=lambda: list(RETAIL_CRITICAL_COLUMNS))
    branches: list[str] = field(default_factory=lambda: list(RETAIL_BRANCHES))
    cities: list[str] = field(default_factory=lambda: list(RETAIL_CITIES))
    customer_types: list[str] = field(default_factory=lambda: list(RETAIL_CUSTOMER_TYPES))
    genders: list[str] = field(default_factory=lambda: list(RETAIL_GENDERS))
    payments: list[str] = field(default_factory=lambda: list(RETAIL_PAYMENTS))
    rating_min: float = RATING_MIN
    rating_max: float = RATING_MAX
    quantity_min: int = QUANTITY_MIN
    price_min: float = PRICE_MIN
    tolerance: float = TOLERANCE
    tax_rate: float = TAX_RATE
    date_pattern: str = DATE_PATTERN
    time_pattern: str = TIME_PATTERN

    def canonical(self, raw_name: str) -> str:
        from ledgerline.functions.naming import standard_name

        return standard_name(raw_name, self.aliases)

    @property
    def canonical_critical(self) -> list[str]:
        return [self.canonical(c) for c in self.critical_columns]

    def allowed(self, rule_field: str) -> list[str]:
        return list(getattr(self, rule_field))

    def with_(self, **changes) -> "SalesRules":
        return replace(self, **changes)


RETAIL_RULES = SalesRules()


def driver_table_rules() -> SalesRules:
    """Rules for the sales-shaped view over the driver's TPC-H-like tables.

    Branch is the region name, city the nation name, customer type the market
    segment, gender the line status and payment the return flag.  One region
    is left out of the allowed branches so that real rejects occur.
    """
    return RETAIL_RULES.with_(
        branches=["AFRICA", "AMERICA", "ASIA", "EUROPE"],
        cities=[f"NATION_{i}" for i in range(25)],
        customer_types=["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
        genders=["F", "O"],
        payments=["A", "N", "R"],
    )
