import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.rules import RETAIL_REQUIRED_COLUMNS  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# The four valid rows of the reference's raw-format fixture, as CSV text
# would give them (every value a string).
SAMPLE_ROWS = [
    ["INV-001", "A", "Yangon", "Member", "Female", "Food and beverages", "10", "1", "0.5", "10.5",
     "01/01/2019", "10:00", "Cash", "10", "4.76", "0.5", "8"],
    ["INV-002", "A", "Yangon", "Normal", "Male", "Health and beauty", "20", "2", "1.0", "21",
     "01/02/2019", "11:00", "Credit card", "20", "4.76", "1.0", "7"],
    ["INV-003", "B", "Mandalay", "Member", "Female", "Food and beverages", "30", "3", "1.5", "31.5",
     "01/03/2019", "12:00", "Ewallet", "30", "4.76", "1.5", "9"],
    ["INV-004", "C", "Naypyitaw", "Normal", "Male", "Sports and travel", "40", "4", "2.0", "42",
     "01/04/2019", "13:00", "Cash", "40", "4.76", "2.0", "6"],
]


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="ledgerline-tests")
    yield s
    s.stop()


def raw_frame(spark, rows, columns=None):
    columns = columns or RETAIL_REQUIRED_COLUMNS
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame(rows, schema)


def good_row(**changes):
    """A valid raw row (INV-100), with named raw columns replaced."""
    base = dict(zip(RETAIL_REQUIRED_COLUMNS,
                    ["INV-100", "A", "Yangon", "Member", "Female", "Food and beverages", "10", "2", "1.0",
                     "21", "1/5/2019", "9:05", "Cash", "20", "4.76", "1.0", "7"]))
    base.update(changes)
    return [base[c] for c in RETAIL_REQUIRED_COLUMNS]


@pytest.fixture
def sample_raw(spark):
    return raw_frame(spark, SAMPLE_ROWS)
