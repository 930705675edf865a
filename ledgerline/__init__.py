"""ledgerline: a Spark-native retail sales warehouse.

Raw sales rows are flagged against data-quality rules, split into clean rows
and rejects, deduplicated per invoice, turned into a branch/product star
schema with dense surrogate keys, merged into a published warehouse version
and summarised in ranked reports and profiles.  Every step is a DataFrame
plan; nothing runs row by row in Python.
"""

__version__ = "0.1.0"
