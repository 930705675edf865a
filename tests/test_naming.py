import pytest

from ledgerline.functions.naming import check_columns, replacement_name, snake_case, standard_name
from ledgerline.rules import RETAIL_ALIASES, RETAIL_REQUIRED_COLUMNS


@pytest.mark.parametrize("raw,expected", [
    ("Invoice ID", "invoice_id"),
    ("Gross income", "gross_income"),
    ("Tax 5%", "tax_5"),
    ("  Unit--price  ", "unit_price"),
    ("__A__b__", "a_b"),
])
def test_snake_case(raw, expected):
    assert snake_case(raw) == expected


def test_alias_wins_over_snake_case():
    assert standard_name("Tax 5%", RETAIL_ALIASES) == "tax_amount"
    assert standard_name("Date", RETAIL_ALIASES) == "sale_date"
    assert standard_name("Something else", RETAIL_ALIASES) == "something_else"


def test_alias_lookup_trims_header():
    # " Total" must still map to total_amount, not to "total".
    assert standard_name(" Total", RETAIL_ALIASES) == "total_amount"


def test_replacement_naming():
    assert replacement_name("Tax 5%") == "tax_5pct"
    assert replacement_name("gross margin percentage", {"gross_margin_percentage": "gross_margin_pct"}) == \
        "gross_margin_pct"


def test_all_required_columns_have_canonical_names():
    names = [standard_name(c, RETAIL_ALIASES) for c in RETAIL_REQUIRED_COLUMNS]
    assert len(set(names)) == 17


def test_missing_and_extra_columns():
    missing, extra = check_columns(["Invoice ID", "Branch", "Note"], ["Invoice ID", "Branch", "City"])
    assert missing == ["City"]
    assert extra == ["Note"]


def test_standardize_renames_frame(spark, sample_raw):
    from ledgerline.functions.naming import standardize

    out = standardize(sample_raw, RETAIL_ALIASES)
    assert out.columns[:3] == ["invoice_id", "branch", "city"]
    assert "tax_amount" in out.columns and "gross_margin_pct" in out.columns
